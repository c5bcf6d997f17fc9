"""Tables written to the cluster's shared folder: they cut lineage, and any executor can read them again."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: A table of at most so many narrow rows is worked on in one task: a few MB, and no shuffle. Results don't depend on it.
SMALL_ROWS = 200_000


@functools.cache
def _own_dir() -> str:
    return f"file://{tempfile.mkdtemp(prefix='genesieve-')}"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Only in local mode, where driver and executors are one process, may it be unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _own_dir()


def scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/genesieve-{spark.sparkContext.applicationId}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a scratch table that ``materialise`` returned, once nothing will read it again."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        if path.getParent() == spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_root(spark)).makeQualified(path.toUri(), path):
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch tables; call it once no result of theirs is needed any more."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def laid_out(df: DataFrame, parts: int, *keys: str) -> DataFrame:
    """``df`` in so many partitions by ``keys``, which adaptive execution leaves apart; with 0 as it is."""
    return df.repartition(parts, *keys) if parts else df


def compact(df: DataFrame, most: int | None = None) -> DataFrame:
    """``df``, a materialised table, in one partition if it is small (its rows are counted); larger ones stay as they are."""
    return df.coalesce(1) if df.count() <= (SMALL_ROWS if most is None else most) else df
