"""Top-1 per group and de-duplication, always under a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from genesieve.schema import sort_order


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each group. Catalyst limits each partition before the shuffle."""
    first = Window.partitionBy(*sort_order(keys)).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def distinct_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the least by all the other columns, nulls last."""
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    return top_per_group(df, keys, rest) if rest else df.distinct()
