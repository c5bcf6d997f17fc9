"""Raw inputs into the tables that the features read."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genesieve.functions.scalar import gene_of_phenotype, neglog10
from genesieve.operators.observed import with_values
from genesieve.operators.ranking import distinct_by
from genesieve.schema import LEAD, TAG
from genesieve.sources.scratch import laid_out

#: Tags below this posterior are not used.
MIN_POSTERIOR = 0.001
CREDSET = ("study_id", *LEAD, *TAG)


def top_loci(raw: DataFrame) -> DataFrame:
    return raw.select("study_id", "chrom", "pos", "ref", "alt", neglog10(F.col("pval_mantissa"), F.col("pval_exponent")).alias("neglog_p"))


def unify_credible_sets(fine_mapped: DataFrame, pics: DataFrame, parts: int = 0) -> DataFrame:
    """Both methods' weights side by side, and the combined one: fine mapping wherever the study has any of it, of any type, else PICS.

    Both lie by locus in ``parts`` partitions (0: Spark's choice) and meet in an aggregation, which leaves them there. A full join would be shuffled again, by
    those of its keys that are no constants, into as few partitions as their compressed bytes fill. A row with a null in its key meets none.
    """
    has_fm = fine_mapped.select("study_id", F.lit(True).alias("has_fm")).distinct()
    fm = fine_mapped.where((F.col("type") == "gwas") & (F.col("postprob") >= MIN_POSTERIOR)).select(*CREDSET, F.struct(F.col("postprob").alias("fm_postprob"), F.col("is95_credset").alias("fm_is95")).alias("_fm"), F.lit(1).alias("_side"))
    ld = pics.where(F.col("pics_postprob") >= MIN_POSTERIOR).select(*CREDSET, F.struct("pics_postprob", F.col("pics_95perc_credset").alias("pics_is95")).alias("_ld"), F.lit(2).alias("_side"))
    known = reduce(Column.__and__, [F.col(c).isNotNull() for c in CREDSET])
    rows = fm.unionByName(ld, allowMissingColumns=True).withColumn("_side", F.when(known, 0).otherwise(F.col("_side")))
    met = laid_out(rows, parts, "study_id", "lead_chrom", "lead_pos").groupBy(*CREDSET, "_side").agg(F.collect_list("_fm").alias("_fm"), F.collect_list("_ld").alias("_ld"))
    both = met.select(*CREDSET, F.explode_outer("_fm").alias("_fm"), "_ld").select(*CREDSET, "_fm", F.explode_outer("_ld").alias("_ld")).select(*CREDSET, "_fm.*", "_ld.*")
    both = both.join(F.broadcast(has_fm), "study_id", "left")  # a row a study; shuffled by study, rows would gather in few tasks
    choose = lambda a, b: F.when(F.col("has_fm"), F.col(a)).otherwise(F.col(b))
    return both.withColumns({"combined_postprob": choose("fm_postprob", "pics_postprob"), "combined_is95": choose("fm_is95", "pics_is95")}).drop("has_fm")


def prepare_qtl(fine_mapped: DataFrame, genes_of_phenotypes: DataFrame, parts: int = 0) -> DataFrame:
    """QTL credible sets with genes: from the lookup, else from the phenotype's own id ('' if it has none). Joined in ``parts`` partitions (0: Spark's choice)."""
    kept = fine_mapped.where((F.col("type") != "gwas") & (F.col("postprob") >= MIN_POSTERIOR))
    lookup = genes_of_phenotypes.select("phenotype_id", F.col("gene_id").alias("_known"))
    same = (F.col("lead_chrom") == F.col("tag_chrom")) & (F.col("lead_pos") == F.col("tag_pos")) & (F.col("lead_ref") == F.col("tag_ref")) & (F.col("lead_alt") == F.col("tag_alt"))
    out = laid_out(kept, parts, "phenotype_id").join(laid_out(lookup, parts, "phenotype_id"), "phenotype_id", "left").withColumn("gene_id", F.coalesce("_known", gene_of_phenotype(F.col("phenotype_id"))))
    out = out.withColumns({"is_sentinel": F.coalesce(same, F.lit(False)), "qtl_neglog_p": neglog10(F.col("tag_pval_cond"))}).where(F.col("gene_id").isNotNull())
    return out.select("type", "study_id", "bio_feature", "phenotype_id", "gene_id", *LEAD, *TAG, "postprob", "qtl_neglog_p", "is_sentinel")


def prepare_qtl_checked(fine_mapped: DataFrame, genes_of_phenotypes: DataFrame) -> tuple[DataFrame, Callable[[], set[str]]]:
    """``prepare_qtl``, and a function that tells, once the result has been written, the QTL types of ``fine_mapped`` that it lacks.

    Both sides' types are observed by the job that writes; a run should stop unless none is lost.
    """
    before, told_before = with_values(fine_mapped, F.when(F.col("type") != "gwas", F.col("type")))
    after, told_after = with_values(prepare_qtl(before, genes_of_phenotypes), F.col("type"))
    return after, lambda: told_before() - told_after()


def prepare_coloc(raw: DataFrame, coding_genes: DataFrame, min_variants: int = 250, parts: int = 0) -> DataFrame:
    """Molecular QTLs with enough shared variants and a finite (or null) log ratio, for protein-coding genes. Joined in ``parts`` partitions (0: Spark's choice)."""
    kept = raw.where((F.col("right_type") != "gwas") & (F.col("coloc_n_vars") >= min_variants) & ~F.coalesce(F.isnan("coloc_log2_h4_h3"), F.lit(False)))
    kept = kept.withColumnRenamed("right_gene_id", "gene_id").drop("coloc_n_vars")
    return laid_out(kept, parts, "gene_id").join(laid_out(coding_genes.select("gene_id"), parts, "gene_id"), "gene_id", "left_semi")


def split_variant_to_gene(mixed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The interval rows and the consequence rows of the mixed table: each is what is complete for its columns."""
    variant = {"chr_id": "chrom", "position": "pos", "ref_allele": "ref", "alt_allele": "alt"}
    at = [F.col(a).alias(b) for a, b in variant.items()]
    interval = mixed.select(*at, F.col("type_id").alias("interval_type"), F.col("source_id").alias("interval_source"), F.col("feature").alias("interval_feature"), "interval_score", "gene_id")
    consequence = mixed.select(*at, F.col("fpred_max_label").alias("csq"), F.col("fpred_max_score").alias("csq_score"), "gene_id")
    return interval.distinct().dropna(), consequence.distinct().dropna()


def protein_coding(genes: DataFrame) -> DataFrame:
    names = {"chr": "chrom", "description": "gene_description", "biotype": "gene_biotype"}
    return genes.where(F.col("biotype") == "protein_coding").withColumnsRenamed(names).select("gene_id", "chrom", "gene_start", "gene_end", "tss", "fwdstrand", "gene_name", "gene_description", "gene_biotype")


def interaction_network(links: DataFrame, aliases: DataFrame, genes: DataFrame) -> DataFrame:
    """Protein links (raw score of at least 250, scaled by 1000) as gene pairs with coordinates; the second gene must be known, the first need not."""
    to_gene = distinct_by(aliases.where(F.col("gene_id").startswith("ENSG")).groupBy("string_id").agg(F.min("gene_id").alias("gene_id")), ["string_id"])
    scaled = links.withColumn("string_score", F.col("string_score") / 1000).where(F.col("string_score") >= 0.25)
    out = scaled
    for i in (1, 2):
        out = out.join(to_gene.select(F.col("string_id").alias(f"p{i}"), F.col("gene_id").alias(f"gene_id_{i}")), f"p{i}")
    for i, how in ((1, "left"), (2, "inner")):
        side = genes.select(F.col("gene_id").alias(f"gene_id_{i}"), *[F.col(c).alias(f"gene_{i}_{c.removeprefix('gene_')}") for c in ("chrom", "gene_start", "gene_end")])
        out = out.join(side, f"gene_id_{i}", how)
    return out.withColumnsRenamed({"p1": "string_id_1", "p2": "string_id_2"})


def resolve_names(values: DataFrame, genes: DataFrame) -> DataFrame:
    """``values`` (gene_name, value) by gene id: official names first, then synonyms that are nobody's official name.

    A name without an id has a null one, for the caller to report; a gene with several rows keeps that of the least name.
    """
    official = genes.select("gene_name", "gene_id")
    synonyms = genes.select(F.explode("gene_synonyms").alias("gene_name"), "gene_id").join(official.select("gene_name"), "gene_name", "left_anti")
    ids = official.unionByName(synonyms).groupBy("gene_name").agg(F.min("gene_id").alias("gene_id"))
    return values.join(ids, "gene_name", "left")


def one_value_per_gene(resolved: DataFrame) -> DataFrame:
    known = resolved.where(F.col("gene_id").isNotNull())
    return known.groupBy("gene_id").agg(F.min_by(F.struct("gene_name", "value"), F.struct("gene_name", "value")).alias("x")).select("gene_id", "x.*")


def fix_traits(studies: DataFrame, study_id: str, traits: list[str]) -> DataFrame:
    """One study's traits overwritten."""
    return studies.withColumn("trait_efos", F.when(F.col("study_id") == study_id, F.array(*[F.lit(t) for t in traits])).otherwise(F.col("trait_efos")))


def restrict_variants(index: DataFrame, credsets: DataFrame) -> DataFrame:
    """Variants of the index that occur as a tag; three unused columns go, two take their short names."""
    slim = index.drop("locus", "alleles", "locus_GRCh38").withColumnsRenamed({"chrom_b38": "chrom", "pos_b38": "pos"})
    tags = credsets.select(*[F.col(c).alias(c.removeprefix("tag_")) for c in TAG])
    return slim.join(tags, ["chrom", "pos", "ref", "alt"], "left_semi")


def credible_set_size(credsets: DataFrame) -> DataFrame:
    """Rows of the 95 % set per locus."""
    return credsets.where("in95").groupBy("study_id", "chrom", "pos", "ref", "alt").agg(F.count(F.lit(1)).alias("count_credset_95"))


def study_flags(studies: DataFrame) -> DataFrame:
    return studies.select("study_id", "has_sumstats")
