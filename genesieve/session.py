"""A session with the settings that the plans count on."""

from pyspark.sql import SparkSession


def session(name: str = "genesieve", **settings: str) -> SparkSession:
    """Adaptive execution on, UTC; master and memory are left to the cluster unless given."""
    builder = SparkSession.builder.appName(name)
    fixed = {
        "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.session.timeZone": "UTC",
        # tables laid out by locus are joined on (locus, gene) without another shuffle; there are very many loci
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
    }
    return builder.config(map=fixed | settings).getOrCreate()
