"""Analytics over tables of segmented tissue cells, as Spark DataFrame operators."""
