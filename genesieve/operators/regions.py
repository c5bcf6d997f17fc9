"""Tags and what is known of them, met where their loci lie.

A join on tags followed by sums over loci would shuffle every pair of a tag's locus and a tag's gene, and pairs grow with the square of the density.
Here tags are laid out by the region of their locus, and what is known of a tag is copied to the regions that hold it, once each; pairs are
made and summed there and are never shuffled. A region with many pairs is cut into narrower ones, as what is known of a tag is then copied to the few that
hold it; only the narrowest, if they still have many, are dealt by a hash of the locus into pieces, each of which gets all of it. There are as many
partitions as keep each at about ``TASK_PAIRS`` pairs. A locus lies in one piece of one region, so results don't depend on any of this.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from genesieve.schema import LOCUS, TAG
from genesieve.sources.scratch import materialise

#: Positions of a region, and of the narrowest; tags of a locus that lie in others are right too, but what is known of them is copied more often.
REGION, FINEST = 200_000, 5_000
#: About so many pairs in a region or a piece of one, and in a task.
PIECE_PAIRS, TASK_PAIRS = 500_000, 1_000_000
#: With the chromosome of the locus, the place of its rows.
PLACE = ("_at", "_piece")


def partitions(spark, pairs: int, most: int = TASK_PAIRS) -> int:
    """The session's number, or more if there are many pairs."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-pairs // most))


def _places(pairs: DataFrame) -> DataFrame:
    """(chrom, _fine, _at, _pieces): the region, named by its first narrow one, of each narrow region, and its pieces; ``pairs`` has the pairs (``_pairs``) of each (chrom, _fine)."""
    most = REGION // FINEST
    region = F.floor(F.col("_fine") / most)
    parts = F.ceil(F.sum("_pairs").over(Window.partitionBy("chrom", region)) / PIECE_PAIRS)
    step = F.greatest(F.floor(most / parts), F.lit(1))
    cut = pairs.withColumn("_at", region * most + F.floor((F.col("_fine") - region * most) / step) * step)
    held = F.sum("_pairs").over(Window.partitionBy("chrom", "_at"))
    return cut.select("chrom", "_fine", "_at", F.ceil(held / PIECE_PAIRS).cast("int").alias("_pieces"), "_pairs")


def meet(tags: DataFrame, known: DataFrame, on: Sequence[str] = TAG, distinct: bool = False, wide: int = 1) -> DataFrame:
    """``tags`` (with their locus) joined with ``known`` on ``on``, and ``PLACE``. All rows of a locus are in one partition by (chrom, ``PLACE``).

    ``distinct``: equal rows of ``known`` count once. Rows with a null locus position or ``on`` meet nothing. A task gets one part of ``wide`` of the usual pairs, where a pair takes so much more memory.
    """
    values = F.struct(*[c for c in known.columns if c not in on])
    used = materialise(tags.dropna(subset=["chrom", "pos", *on]).withColumn("_fine", F.floor(F.col("pos") / FINEST)), "tags")
    each = known.dropna(subset=[*on]).groupBy(*on).agg((F.collect_set if distinct else F.collect_list)(values).alias("_found"))
    each = materialise(each.withColumn("_n", F.size("_found")), "known")
    wanted = used.groupBy("chrom", "_fine", *on).agg(F.count(F.lit(1)).alias("_tags"))
    pairs = each.select(*on, "_n").join(wanted, [*on]).groupBy("chrom", "_fine").agg(F.sum(F.col("_n") * F.col("_tags")).alias("_pairs"))
    places = materialise(_places(pairs), "regions")
    n = partitions(tags.sparkSession, places.agg(F.sum("_pairs")).first()[0] or 0, -(-TASK_PAIRS // wide))
    places = places.drop("_pairs")
    rest = [c for c in tags.columns if c != "chrom" and c not in on]
    left = used.join(places, ["chrom", "_fine"]).withColumn("_piece", F.pmod(F.xxhash64(*LOCUS), F.col("_pieces")).cast("int"))
    left = left.select("chrom", *PLACE, *on, F.struct(*rest).alias("_tag"))
    asked = wanted.join(places, ["chrom", "_fine"]).select("chrom", "_at", "_pieces", *on).distinct()
    right = each.join(asked, [*on])
    right = right.select("chrom", "_at", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1)).alias("_piece"), *on, "_found")
    # a join of both would be shuffled again by its other keys, so what is known is handed to the tags by a window
    both = left.unionByName(right, allowMissingColumns=True).repartition(n, "chrom", *PLACE)
    here = Window.partitionBy("chrom", *PLACE, *on)
    met = both.withColumn("_found", F.first("_found", ignorenulls=True).over(here)).where(F.col("_tag").isNotNull())
    return met.select("chrom", *PLACE, *on, "_tag.*", F.explode("_found").alias("_f")).select("*", "_f.*").drop("_f")
