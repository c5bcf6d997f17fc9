"""Shared helpers: row keys, free column names, gapless numbering."""

from __future__ import annotations

import math

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from genesieve.sources.scratch import compact, materialise, release_scratch, shared_dir

__all__ = ["compact", "even_salts", "free_name", "materialise", "release_scratch", "salted_rank", "shared_dir", "with_row_key"]


def free_name(wanted: str, taken: list[str]) -> str:
    """``wanted``, with as many underscores after it as it takes to differ from ``taken``."""
    while wanted.lower() in (t.lower() for t in taken):
        wanted += "_"
    return wanted


def with_row_key(df: DataFrame, name: str = "_row") -> DataFrame:
    """``df`` with a key that no two rows share, whatever their ids: the file that a row lies in, and its place there.

    The key is the same each time the files are read. A table that isn't read from Parquet files is written first.
    """
    key = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place")).alias(name)
    try:
        return df.select("*", key)
    except AnalysisException:
        return materialise(df, "keyed").select("*", key)


def even_salts(most_rows: int) -> int:
    return max(1, math.isqrt(max(0, most_rows)))


def salted_rank(df: DataFrame, key: list[str], order: list[Column], salt: Column, salts: int, out: str) -> DataFrame:
    """Add ``out``: a gapless number from 0 within ``key``, without ever gathering a key in one task.

    Rows of a key are dealt by ``salt`` into ``salts`` pieces; each piece is
    numbered on its own and shifted by the rows of the pieces before it. With the
    square root of the largest key's rows as ``salts`` (``even_salts``), neither a piece
    nor a key's list of pieces grows faster than that root. ``order`` must be
    total within a piece for the numbers to be the same after a task is run again.
    """
    dealt = df.withColumn("_salt", F.pmod(salt, F.lit(salts)).cast("int"))
    sizes = dealt.groupBy(*key, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*key).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(*key, "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    own = Window.partitionBy(*key, "_salt").orderBy(*order)
    ranked = dealt.withColumn("_own", F.row_number().over(own).cast("long") - 1)
    return ranked.join(shifts, [*key, "_salt"]).withColumn(out, F.col("_own") + F.col("_shift")).drop("_salt", "_own", "_shift")
