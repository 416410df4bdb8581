"""DataFrame operators: joins, aggregations, windows and fits over cell tables."""
