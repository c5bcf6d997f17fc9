"""Distances from loci and their tags to genes, and the density of genes around a locus.

Pairs of a locus and a gene grow with the square of the density, so they are never shuffled: loci and genes are laid out by regions of the genome, and pairs
are made, summed and compared where they lie. Both sides are shuffled whatever the size of the gene table; a broadcast would grow with it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from genesieve.functions.scalar import footprint_distance
from genesieve.operators.neighbourhood import with_log_gap
from genesieve.operators.regions import PLACE, partitions
from genesieve.schema import DENSITY, LOCUS, LOCUS_GENE, LOCUS_SORT, sort_order
from genesieve.sources.scratch import materialise

REACH = 500_000
GENE = {"chrom": "_gene_chrom", "gene_start": "_start", "gene_end": "_end", "tss": "_tss"}


#: Positions of a region: genes are copied to each that they reach.
REGION = 250_000
#: About so many pairs of tags and genes in a piece of a region, and in a task; each piece gets all genes that its region may be near.
PIECE_PAIRS, TASK_PAIRS = 2_000_000, 2_000_000


def _by_region(genes: DataFrame) -> DataFrame:
    """Genes, once for each region (``_region``) with positions that they are near."""
    sides = genes.select("gene_id", *[F.col(c).alias(n) for c, n in GENE.items()])
    reached = [F.sequence(F.floor((F.col(c) - REACH) / REGION), F.floor((F.col(c) + REACH) / REGION)) for c in ("_start", "_end")]
    return sides.withColumn("_region", F.explode(F.array_distinct(F.concat(*reached))))


def _is_near(pos: str) -> Column:
    return (F.abs(F.col(pos) - F.col("_start")) <= REACH) | (F.abs(F.col(pos) - F.col("_end")) <= REACH)


def _distances(pos: str) -> list[Column]:
    return [footprint_distance(F.col(pos), F.col("_start"), F.col("_end")).alias("foot"), F.abs(F.col(pos) - F.col("_tss")).alias("tss")]


def _laid_out(loci: DataFrame) -> DataFrame:
    n = partitions(loci.sparkSession, 0)
    return loci.withColumn("_at", F.floor(F.col("pos") / REGION)).repartition(n, "chrom", "_at")


def _met(laid: DataFrame, genes: DataFrame) -> DataFrame:
    """Loci from ``_laid_out`` with each gene near them; the rows of a locus stay in its partition."""
    sides = _by_region(genes).repartition(partitions(laid.sparkSession, 0), "_gene_chrom", "_region").hint("shuffle_hash")
    near = laid.join(sides, (F.col("chrom") == F.col("_gene_chrom")) & (F.col("_at") == F.col("_region")) & _is_near("pos"))
    return near.select(*laid.columns, "gene_id", *_distances("pos"))


def near_genes(loci: DataFrame, genes: DataFrame) -> DataFrame:
    """Each locus, with all its columns, and each gene near it: gene_id, foot, tss (distances)."""
    return _met(_laid_out(loci), genes).drop("_at")


def own_genes_near(loci: DataFrame, own: str, genes: DataFrame) -> DataFrame:
    """``near_genes`` of the genes that each locus has in its array ``own`` only, without distances: found by their ids, so no other pair is made."""
    sides = genes.select("gene_id", *[F.col(c).alias(n) for c, n in GENE.items()]).dropna(subset=["gene_id", "_gene_chrom", "_start", "_end"])
    each = loci.withColumn("gene_id", F.explode(own)).drop(own)
    return each.join(sides, "gene_id").where((F.col("chrom") == F.col("_gene_chrom")) & _is_near("pos")).drop(*GENE.values())


def near_counts(loci: DataFrame, genes: DataFrame) -> DataFrame:
    """Per locus with any, how many rows ``near_genes`` makes of it with a gene's id (``_rows``); a locus given twice has them twice. Every gene near it is within the widest radius."""
    return gene_density(loci, genes.where(F.col("gene_id").isNotNull())).select(*LOCUS, F.col(DENSITY[-1]).alias("_rows"))


def _beside(points: DataFrame, genes: DataFrame, chrom: str, pos: str) -> DataFrame:
    """Points (with their locus) and the genes near them, and ``PLACE``: all rows of a locus are in one partition by (chrom, ``PLACE``).

    Each region of loci gets the genes that its points may be near, wherever those lie. A region with many pairs is dealt by a hash of the locus.
    """
    used = materialise(points.withColumns({"_at": F.floor(F.col("pos") / REGION), "_bin": F.floor(F.col(pos) / REGION)}), "points")
    wanted = used.groupBy("chrom", "_at", F.col(chrom).alias("_c"), "_bin").agg(F.count(F.lit(1)).alias("_points"))
    sides = _by_region(genes).repartition("_gene_chrom", "_region").hint("shuffle_hash")
    sides = wanted.join(sides, (F.col("_c") == F.col("_gene_chrom")) & (F.col("_bin") == F.col("_region")))
    sides = materialise(sides.select("chrom", "_at", "gene_id", *GENE.values()).dropDuplicates(), "near-genes")
    counts = sides.groupBy("chrom", "_at").agg(F.count(F.lit(1)).alias("_genes"))
    counts = counts.join(wanted.groupBy("chrom", "_at").agg(F.sum("_points").alias("_points")), ["chrom", "_at"])
    counts = materialise(counts.withColumn("_pairs", F.col("_genes") * F.col("_points")), "regions")
    n = partitions(points.sparkSession, counts.agg(F.sum("_pairs")).first()[0] or 0, TASK_PAIRS)
    pieces = counts.select("chrom", "_at", F.ceil(F.col("_pairs") / PIECE_PAIRS).cast("int").alias("_pieces"))
    left = used.join(pieces, ["chrom", "_at"]).withColumn("_piece", F.pmod(F.xxhash64(*LOCUS), F.col("_pieces")).cast("int"))
    left = left.select(*points.columns, *PLACE).repartition(n, "chrom", *PLACE)
    right = sides.join(pieces, ["chrom", "_at"]).select(F.col("chrom").alias("_rc"), F.col("_at").alias("_ra"), F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1)).alias("_rp"), "gene_id", *GENE.values())
    right = right.repartition(n, "_rc", "_ra", "_rp").hint("shuffle_hash")
    # not a key of the join, or both sides were shuffled again by it
    same = (F.col(chrom) <= F.col("_gene_chrom")) & (F.col(chrom) >= F.col("_gene_chrom"))
    on = (F.col("chrom") == F.col("_rc")) & (F.col("_at") == F.col("_ra")) & (F.col("_piece") == F.col("_rp"))
    return left.join(right, on & same & _is_near(pos)).select(*left.columns, "gene_id", *_distances(pos))


def _ln1(x: str) -> Column:
    return F.ln(F.col(x) + 1)


def sentinel_distances(loci: DataFrame, genes: DataFrame) -> DataFrame:
    """Per (locus, gene near it): the locus's own distances, with their neighbourhood gaps.

    Pairs are made twice, first to find the least distances of each locus, as a window would sort and keep them.
    """
    own = _laid_out(loci.select(*LOCUS)).groupBy("_at", *LOCUS).agg(F.count(F.lit(1)).cast("int").alias("_times"))
    best = _met(own, genes).groupBy("_at", *LOCUS, "_times").agg(F.min("foot").alias("_foot"), F.min("tss").alias("_tss_least"))
    near = _met(best.withColumn("_i", F.explode(F.array_repeat(F.lit(0), F.col("_times")))), genes)
    out = near.select(*LOCUS_GENE, _ln1("foot").alias("dist_foot_sentinel"), _ln1("tss").alias("dist_tss_sentinel"), "foot", "_foot", "_tss_least")
    gaps = {"dist_foot_sentinel_nbh": _ln1("_foot") - F.col("dist_foot_sentinel"), "dist_tss_sentinel_nbh": _ln1("_tss_least") - F.col("dist_tss_sentinel")}
    return out.withColumns(gaps).drop("_foot", "_tss_least")


def nearest_starts(loci: DataFrame, genes: DataFrame, width: int) -> DataFrame:
    """Each locus, with all its columns, its first two pairs with genes of its chromosome that start in the same stretch of ``width`` positions: gene_id and n (1, 2).

    Pairs come by distance to the start, then gene, then the locus's other columns; a locus given twice has its pairs twice. Genes and loci are sorted along the genome, and the two genes to either side of a locus are enough.
    """
    kept = [c for c in loci.columns if c not in LOCUS]
    start = F.struct(F.col("gene_start").alias("at"), "gene_id").alias("g")
    known = genes.dropna(subset=["chrom", "gene_start"]).select("chrom", F.floor(F.col("gene_start") / width).alias("_bin"), F.col("gene_start").alias("_at"), start)
    stretch = Window.partitionBy("chrom", "_bin")
    by_id = F.col("g.gene_id").desc()
    known = known.withColumns({"_before": F.lag("g").over(stretch.orderBy("_at", by_id)), "_after": F.lag("g").over(stretch.orderBy(F.col("_at").desc(), by_id))})
    known = known.select("chrom", "_bin", "_at", "g", F.struct("g", F.col("_before").alias("h")).alias("_left"), F.struct("g", F.col("_after").alias("h")).alias("_right"))
    asked = loci.dropna(subset=["chrom", "pos"]).select("chrom", F.floor(F.col("pos") / width).alias("_bin"), F.col("pos").alias("_at"), F.struct(*loci.columns).alias("_locus"))
    both = known.unionByName(asked, allowMissingColumns=True).withColumn("_asked", F.col("_locus").isNotNull())
    # genes at the locus itself are to its left
    left, right = stretch.orderBy("_at", "_asked", by_id), stretch.orderBy(F.col("_at").desc(), F.col("_asked").desc(), by_id)
    sides = both.withColumns({"_left": F.last("_left", ignorenulls=True).over(left), "_right": F.last("_right", ignorenulls=True).over(right)}).where("_asked")
    found = F.filter(F.array("_left.g", "_left.h", "_right.g", "_right.h"), lambda g: g.isNotNull())
    ranked = F.sort_array(F.transform(found, lambda g: F.struct(F.abs(F.col("_at") - g["at"]).alias("far"), g["gene_id"].alias("gene_id"))))
    pairs = sides.select("_locus.*", F.explode(F.slice(ranked, 1, 2)).alias("_g")).select(*loci.columns, "_g.*")
    n = F.row_number().over(Window.partitionBy(*LOCUS_SORT).orderBy("far", "gene_id", *kept))
    return pairs.withColumn("n", n).where("n <= 2").drop("far")


def _density(foot: Column) -> dict[str, Column]:
    return {c: F.count_if(foot <= k * 1000) for k, c in zip((50, 100, 250, 500), DENSITY, strict=True)}


def _covered(genes: DataFrame) -> DataFrame:
    """(chrom, at, one column a radius): by how much the number of genes within each radius changes at a position.

    A gene counts over one stretch, or over two if it is longer than both reaches (its middle is not near it) or has its ends the wrong way round and far apart.
    """
    start, end = F.col("gene_start"), F.col("gene_end")
    changes = []
    for i, k in enumerate((50, 100, 250, 500)):
        r = k * 1000
        first = F.when(start > end, F.struct((end - r).alias("a"), (end + r).alias("b"))).otherwise(F.struct((start - r).alias("a"), (start + REACH).alias("b")))
        second = F.when(start > end, F.struct((start - r).alias("a"), (start + r).alias("b"))).otherwise(F.struct((end - REACH).alias("a"), (end + r).alias("b")))
        two = second["a"] > first["b"]
        one = F.struct(first["a"].alias("a"), second["b"].alias("b"))
        for stretch in (F.when(two, first).otherwise(one), F.when(two, second)):
            for at, by in ((stretch["a"], 1), (stretch["b"] + 1, -1)):
                changes.append(F.struct(at.alias("at"), *[F.lit(by if j == i else 0).cast("long").alias(c) for j, c in enumerate(DENSITY)]))
    known = genes.select("chrom", "gene_start", "gene_end").dropna()
    return known.select("chrom", F.explode(F.array(*changes)).alias("_c")).select("chrom", "_c.*").where(F.col("at").isNotNull())


def gene_density(loci: DataFrame, genes: DataFrame) -> DataFrame:
    """Per locus: genes whose footprint lies within 50, 100, 250 and 500 kb; of loci given twice each counts.

    Genes open and close stretches of positions, and a running sum along the genome is the number at each, so no pair of a locus and a
    gene is made. Positions are dealt by ranges with sampled bounds: a sum inside each range, on top of those of the ranges before it.
    """
    own = loci.groupBy(*LOCUS).agg(F.count(F.lit(1)).alias("_times"))
    asked = own.select("chrom", F.col("pos").alias("at"), F.lit(True).alias("_asked"), *[F.lit(0).cast("long").alias(c) for c in DENSITY]).dropna(subset=["chrom", "at"])
    changes = _covered(genes).withColumn("_asked", F.lit(False)).unionByName(asked)
    steps = changes.groupBy("chrom", "at").agg(F.max("_asked").alias("_asked"), *[F.sum(c).alias(c) for c in DENSITY])
    dealt = materialise(steps.repartitionByRange("chrom", "at").withColumn("_range", F.spark_partition_id()), "density")  # a range's number must stay the rows' own
    above = Window.partitionBy("_c").orderBy("_r")
    sums = dealt.groupBy(F.col("chrom").alias("_c"), F.col("_range").alias("_r")).agg(*[F.sum(c).alias(f"_{c}") for c in DENSITY])
    sums = sums.select("_c", "_r", *[(F.sum(f"_{c}").over(above) - F.col(f"_{c}")).alias(f"_{c}") for c in DENSITY])
    along = Window.partitionBy("chrom", "_range").orderBy("at")
    here = dealt.select("chrom", "at", "_range", "_asked", *[F.sum(c).over(along).alias(c) for c in DENSITY]).where("_asked")
    here = here.join(sums, (F.col("chrom") == F.col("_c")) & (F.col("_range") == F.col("_r")))
    counts = here.select("chrom", F.col("at").alias("pos"), *[(F.col(c) + F.col(f"_{c}")).alias(c) for c in DENSITY]).where(F.col(DENSITY[-1]) > 0)
    return own.join(counts, ["chrom", "pos"]).select(*LOCUS, *[(F.col(c) * F.col("_times")).alias(c) for c in DENSITY])


TAG_VALUES = ("dist_foot_min", "dist_tss_min", "dist_foot_ave", "dist_tss_ave")


def _tag_sums() -> list[Column]:
    least = [F.ln(F.min(F.when(F.col("in95"), F.col(d))) + 1).alias(f"dist_{d}_min") for d in ("foot", "tss")]
    return least + [F.ln(F.sum(F.col(d) * F.col("weight")) + 1).alias(f"dist_{d}_ave") for d in ("foot", "tss")]


def tag_distances(tags: DataFrame, genes: DataFrame) -> DataFrame:
    """Per (locus, gene near a tag): least distance over the 95 % set, and posterior-weighted distance over all tags, with gaps."""
    near = _beside(tags.select(*LOCUS, "tag_chrom", "tag_pos", "weight", "in95").dropna(), genes, "tag_chrom", "tag_pos")
    out = near.groupBy(*PLACE, *LOCUS_GENE).agg(*_tag_sums())
    for c in TAG_VALUES:
        out = with_log_gap(out, c, (*PLACE, *LOCUS), f"{c}_nbh", "min")
    return out.drop(*PLACE)


def distance_features(loci: DataFrame, tags: DataFrame, genes: DataFrame) -> DataFrame:
    """The spine: genes whose footprint is nearer than 500 kb to the locus, with every distance feature and the density.

    Loci and tags are points of one near-gene join, laid out by regions, so the aggregation and all windows need no other shuffle.
    """
    own = loci.select(*LOCUS, F.col("chrom").alias("at_chrom"), F.col("pos").alias("at_pos"), F.lit(None).cast("double").alias("weight"), F.lit(None).cast("boolean").alias("in95"), F.lit(True).alias("own"))
    others = tags.select(*LOCUS, "tag_chrom", "tag_pos", "weight", "in95").dropna().select(*LOCUS, F.col("tag_chrom").alias("at_chrom"), F.col("tag_pos").alias("at_pos"), "weight", "in95", F.lit(False).alias("own"))
    near = _beside(own.unionByName(others), genes, "at_chrom", "at_pos")
    first = [F.min(F.when(F.col("own"), F.col("foot"))).alias("_foot")]
    first += [F.ln(F.min(F.when(F.col("own"), F.col(d))) + 1).alias(f"dist_{d}_sentinel") for d in ("foot", "tss")]
    out = near.groupBy(*PLACE, *LOCUS_GENE).agg(*first, *_tag_sums())
    for c in ("dist_foot_sentinel", "dist_tss_sentinel", *TAG_VALUES):
        out = with_log_gap(out, c, (*PLACE, *LOCUS), f"{c}_nbh", "min")
    here = Window.partitionBy(*sort_order((*PLACE, *LOCUS)))
    out = out.withColumns({c: n.over(here) for c, n in _density(F.col("_foot")).items()})
    return out.where(F.col("dist_foot_sentinel") <= math.log(REACH)).drop("_foot", *PLACE)
