"""Checks and reports that are gathered by the very job that writes a table, in place of further jobs over it.

A stage that Spark runs again, after an executor is lost, adds to what it has observed. So counts are only taken at the top of a
written table, whose tasks count once; further down only sets are gathered, which repeats don't change.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def _observed(df: DataFrame, metrics: Sequence[Column]) -> tuple[DataFrame, Callable[[], dict]]:
    """Where Spark finds a table empty and leaves out the part of the plan that was to be observed, the metrics are taken of ``df`` by a job of their own."""
    seen = Observation()
    watched = df.observe(seen, *metrics)
    return watched, lambda: seen.get if seen._jo.getRow().size() else df.agg(*metrics).first().asDict()


def with_values(df: DataFrame, value: Column) -> tuple[DataFrame, Callable[[], set]]:
    """``df``, and a function that tells the distinct values (few; null doesn't count) of a column once ``df`` has been used. It waits until then."""
    watched, told = _observed(df, [F.collect_set(value).alias("values")])
    return watched, lambda: set(told()["values"])


def with_counts(df: DataFrame, by: str, groups: Sequence[str | None], counts: dict[str, Column]) -> tuple[DataFrame, Callable[[], list[tuple]]]:
    """``df``, and a function that tells (group, counts...) once ``df`` has been written. ``groups`` are all values that ``by`` may have, a few; those without rows are left out."""
    metrics = [F.count_if(F.col(by).eqNullSafe(F.lit(g)) & c).alias(f"{name}-{i}") for i, g in enumerate(groups) for name, c in counts.items()]
    if not metrics:
        return df, list
    watched, told = _observed(df, metrics)

    def rows() -> list[tuple]:
        seen = told()
        found = [(g, *[seen[f"{name}-{i}"] for name in counts]) for i, g in enumerate(groups)]
        return [row for row in found if any(row[1:])]

    return watched, rows
