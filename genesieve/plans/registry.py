"""The queries over the star-schema tables, by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from genesieve.plans import oracle
from genesieve.plans.queries import ALL, bound

FLAGSHIP = "feature_matrix"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: bound(q) for q in ALL}


def oracle_sql() -> dict[str, str]:
    return oracle.all_sql()
