"""An addition to the batch jobs: evidence features of loci as their credible sets arrive.

A locus's features need all of its tags, so a source delivers whole credible sets, and
each micro-batch is a small run of the batch operator. A locus that arrives again gets
new rows under a later batch; ``latest`` keeps the last ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from genesieve.operators.evidence import evidence_features
from genesieve.operators.ranking import top_per_group
from genesieve.schema import LOCUS_GENE


def score_stream(tags: DataFrame, evidence: DataFrame, names: Sequence[str], path: str, checkpoint: str) -> StreamingQuery:
    """Start a query that appends features of each batch's loci under ``path``, a folder a batch, so that a batch run again replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        out = evidence_features(batch, evidence, names).withColumn("batch", F.lit(number))
        out.write.mode("overwrite").parquet(f"{path}/run={number}")

    return tags.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(scores: DataFrame) -> DataFrame:
    return top_per_group(scores, LOCUS_GENE, [F.col("batch").desc()])
