"""Exact dedup by distributed most-significant-digit radix partitioning.

Documents are split by byte length and their first bytes; groups of one leave at
once, the others are split again by the next bytes, in digits that widen
sixteenfold, until a group is a single document or its texts have ended. Equality
is decided by the bytes alone: a group's name is a number that is given to it when
its split is written down, not a digest.

Each split is a partial aggregation (so a hot group is combined where it lies)
and an equi-join of documents to the surviving groups, whose document side Spark
may split when it is skewed. The whole text is shuffled once, in the first
split; later ones move only the unread rest of documents that still share a
prefix with another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

FIRST_DIGIT = 64
WIDEN = 16


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", first_digit: int = FIRST_DIGIT, row_col: str | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the largest id stays. A null text counts as empty, so null and
    empty texts are one group. Without ``row_col``, rows that repeat an id and its text each count in
    ``group_size`` and share the verdict; a null id never outranks another, and a group of null
    ids, whose size counts them all, keeps all of them. With ``row_col``, a column that no two rows share, exactly one row
    of each group stays, equal ids being ranked by it; it is returned as well. Texts of any length are read whole. Further
    columns of ``docs`` are ignored, whatever their names. An empty table gives an empty result.
    """
    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    row = F.col(row_col) if row_col else F.lit(None).cast("long")
    rows = docs.select(F.struct(F.col(id_col).cast("long").alias("id"), row.alias("row")).alias("_who"), body.alias("_rest"))
    rows = rows.select("_who", F.sha2("_rest", 256).alias("text_sha256"), F.octet_length("_rest").cast("long").alias("_group"), "_rest")
    digit, done = first_digit, []
    while True:
        level = materialise(_split(rows, digit), f"radix-{digit}")
        done.append(level.where("_rest is null").select("_who", "_keep", "group_size", "text_sha256"))
        rows = level.where("_rest is not null").select("_who", "text_sha256", "_group", "_rest")
        if rows.isEmpty():
            break
        digit *= WIDEN
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    out = out.select(F.col("_who.id").alias("doc_id"), F.col("_keep.id").alias("keep_id"), "group_size", F.col("_who").eqNullSafe(F.col("_keep")).alias("kept"), "text_sha256", F.col("_who.row").alias("_at"))
    return out.withColumnRenamed("_at", row_col) if row_col else out.drop("_at")


def _split(rows: DataFrame, digit: int) -> DataFrame:
    """Split each group by the next ``digit`` bytes; _rest becomes null where a row leaves."""
    rows = rows.withColumn("_digit", F.substring("_rest", 1, digit))
    shared = rows.groupBy("_group", "_digit").agg(F.count(F.lit(1)).alias("_n"), F.max("_who").alias("_max")).where("_n > 1")
    # written before it is used, so that each group has one name and keeps it
    shared = materialise(shared.withColumn("_name", F.monotonically_increasing_id()), "radix-groups")
    more = (F.col("_n") > 1) & (F.octet_length("_rest") > digit)
    # one more key than the aggregation has: the join gets exchanges of its own, so that Spark may split a hot group
    rows, shared = (x.withColumn("_bytes", F.octet_length("_digit")) for x in (rows, shared))
    return rows.join(shared.hint("shuffle_hash"), ["_group", "_digit", "_bytes"], "left").select(
        "_who",
        "text_sha256",
        F.when(F.col("_n").isNull(), F.col("_who")).otherwise(F.col("_max")).alias("_keep"),
        F.coalesce("_n", F.lit(1)).cast("long").alias("group_size"),
        F.col("_name").alias("_group"),
        F.when(more, F.expr(f"substring(_rest, {digit + 1})")).alias("_rest"),
    )
