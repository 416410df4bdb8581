"""Labels for combinations and for test results."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def short_name(cell_type: Column, names: dict[str, str]) -> Column:
    """Display name of a type where one is given, else the type itself."""
    shown = [F.when(cell_type == full, F.lit(short)) for full, short in names.items()]
    return F.coalesce(*shown, cell_type)


def combo_label(anchor: Column, partner1: Column, partner2: Column,
                anchor_names: dict[str, str] | None = None,
                partner1_names: dict[str, str] | None = None,
                partner2_names: dict[str, str] | None = None) -> Column:
    """``anchor__partner1__partner2``, each role with its own short names."""
    return F.concat_ws(
        "__",
        short_name(anchor, anchor_names or {}),
        short_name(partner1, partner1_names or {}),
        short_name(partner2, partner2_names or {}),
    )


def significance_stars(p: Column) -> Column:
    """``***``, ``**``, ``*`` or ``ns``; a missing p is ``ns``."""
    known = p.isNotNull() & ~F.isnan(p)
    return (F.when(known & (p < 0.001), "***")
            .when(known & (p < 0.01), "**")
            .when(known & (p < 0.05), "*")
            .otherwise("ns"))


def group_label(group: Column) -> Column:
    """Clinical group number as its label; anything else is Unknown."""
    # 1 is CLR, 2 is DII.
    return (F.when(group.cast("int") == 1, "CLR")
            .when(group.cast("int") == 2, "DII")
            .otherwise("Unknown"))


def event_flag(censor: Column, censor_is_one: bool = True) -> Column:
    """1 where the event was observed."""
    flag = censor.cast("int")
    return 1 - flag if censor_is_one else flag


def with_bonferroni(tests, p: str = "p_value", alpha: float = 0.05):
    """Add the corrected level (shown to 8 places) and the verdict against the exact one.

    ``tests`` is a result table with one row per test, so the single window is small.
    """
    level = F.lit(alpha) / F.count(F.lit(1)).over(Window.partitionBy(F.lit(0)))
    return (tests
            .withColumn("exact_level", level)
            .withColumn("bonferroni_alpha", F.round("exact_level", 8))
            .withColumn("sig_bonferroni", F.coalesce(F.col(p) < F.col("exact_level"), F.lit(False)))
            .drop("exact_level"))
