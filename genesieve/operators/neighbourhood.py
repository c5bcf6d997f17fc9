"""A gene's value against its neighbourhood: the best value of any gene at the locus.

The neighbourhood's extreme is a window over the locus, so the locus is
shuffled once and nothing is joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from genesieve.functions.scalar import ratio
from genesieve.schema import sort_order


def _extreme(df: DataFrame, value: str, locus: Sequence[str], kind: str) -> Column:
    return getattr(F, kind)(value).over(Window.partitionBy(*sort_order(locus)))


def with_ratio(df: DataFrame, value: str, locus: Sequence[str], out: str) -> DataFrame:
    """value / max over the locus; null where that max is 0 or null."""
    return df.withColumn(out, ratio(F.col(value), _extreme(df, value, locus, "max")))


def with_log_gap(df: DataFrame, value: str, locus: Sequence[str], out: str, best: str = "max") -> DataFrame:
    """For logarithms, never positive: value - max (scores), or min - value (distances)."""
    top = _extreme(df, value, locus, best)
    return df.withColumn(out, F.col(value) - top if best == "max" else top - F.col(value))
