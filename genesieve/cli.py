"""Command lines of the pipeline's steps: ``python -m genesieve.cli STEP --help``."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import functions as F

from genesieve.ml import train
from genesieve.operators import components, evidence, interlocus, labels, matrix, metrics, staging
from genesieve.operators.coloc import clpp_features, coloc_features
from genesieve.operators.distance import distance_features
from genesieve.schema import EVIDENCE_COLUMNS, LOCUS, LOCUS_GENE, TAG, feature_sets, missing_features, sort_order
from genesieve.session import session
from genesieve.sources.catalog import FINE_MAPPING, GENES, GOLD_STANDARDS, PHENOTYPES, PROTEIN_ATTENUATION, STRING_ALIASES, STRING_LINKS, SYNONYMS, VARIANT_TO_GENE, Catalog, Dataset, csv, write_report

STAGED = ("studies", "toploci", "credsets_v2d", "credsets_qtl", "genes", "coloc", "interval", "vep", "polyphen", "string", "clusters", "contacts", "attenuation", "variants")
FEATURES = ("distance", "vep", "polyphen", "dhs_prmtr", "enhc_tss", "pchicJung", "clpp", "coloc", "interlocus", "matrix")


def catalog(spark, root: str, version: str, buckets: int = 0) -> Catalog:
    """Raw tables under <root>/raw, staged ones under <root>/<version>/staged, features under <root>/<version>/features, with ``buckets`` in as many buckets by (locus, gene)."""
    raw = {f"raw_{n}": Dataset(f"{root}/raw/{n}") for n in ("studies", "toploci", "pics", "coloc", "contacts", "annotation")}
    json = {"fine_mapping": FINE_MAPPING, "phenotypes": PHENOTYPES, "v2g": VARIANT_TO_GENE, "genes": GENES, "synonyms": SYNONYMS}
    raw |= {f"raw_{n}": Dataset(f"{root}/raw/{n}", "json", schema) for n, schema in json.items()}
    raw |= {"raw_links": csv(f"{root}/raw/links", STRING_LINKS, " "), "raw_aliases": csv(f"{root}/raw/aliases", STRING_ALIASES, "\t"), "raw_attenuation": csv(f"{root}/raw/attenuation", PROTEIN_ATTENUATION)}
    staged = {n: Dataset(f"{root}/{{version}}/staged/{n}") for n in STAGED}
    layout = {"buckets": (buckets, tuple(sort_order(LOCUS_GENE)))} if buckets else {}
    return Catalog(spark, version, raw | staged | {f"ft_{n}": Dataset(f"{root}/{{version}}/features/{n}", **({} if n in ("interlocus", "matrix") else layout)) for n in FEATURES})


def stage(args: argparse.Namespace) -> None:
    """Raw inputs into staged tables."""
    cat = catalog(session("stage"), args.root, args.version)
    fine, keep = cat.read("raw_fine_mapping"), args.overwrite
    studies = cat.read("raw_studies")
    cat.write("studies", staging.fix_traits(studies, args.fix_study, args.fix_traits) if args.fix_study else studies, keep)
    cat.write("toploci", staging.top_loci(cat.read("raw_toploci")), keep, LOCUS[:3])
    cat.write("credsets_v2d", staging.unify_credible_sets(fine, cat.read("raw_pics")), keep, ("study_id", "lead_chrom", "lead_pos"))
    if keep or not cat.exists("credsets_qtl"):
        qtl, lost = staging.prepare_qtl_checked(fine, cat.read("raw_phenotypes"))
        cat.write("credsets_qtl", qtl, True, ("study_id", "lead_chrom", "lead_pos"))
        if lost():
            cat.remove("credsets_qtl")
            raise ValueError(f"QTL types without a gene: {sorted(lost())}")
    cat.write("genes", staging.protein_coding(cat.read("raw_genes").withColumnsRenamed({"start": "gene_start", "end": "gene_end"})), keep, files=10)
    genes = cat.read("genes")
    cat.write("coloc", staging.prepare_coloc(cat.read("raw_coloc"), genes), keep, ("left_study", "left_chrom", "left_pos"))
    interval, consequence = staging.split_variant_to_gene(cat.read("raw_v2g"))
    cat.write("interval", interval, keep, ("chrom", "pos"))
    cat.write("vep", consequence, keep, ("chrom", "pos"))
    cat.write("polyphen", evidence.best_transcript(cat.read("raw_annotation").withColumnsRenamed({"chrom_b38": "chrom", "pos_b38": "pos"})), keep, ("chrom", "pos"))
    cat.write("string", staging.interaction_network(cat.read("raw_links"), cat.read("raw_aliases"), genes), keep, ("gene_id_1",))
    cat.write("clusters", components.cluster_loci(cat.read("toploci"), _tags(cat)), keep)
    cat.copy("raw_contacts", "contacts", keep)
    values = cat.read("raw_attenuation", ["gene", "attenuation"]).toDF("gene_name", "value")
    cat.write("attenuation", staging.one_value_per_gene(staging.resolve_names(values, cat.read("raw_synonyms"))).select("gene_id", F.col("value").alias("proteinAttenuation")), keep)
    cat.write("variants", staging.restrict_variants(cat.read("raw_annotation"), cat.read("credsets_v2d")), keep, ("chrom", "pos"))


def _tags(cat: Catalog):
    return cat.read("credsets_v2d").select("study_id", *[F.col(f"lead_{c}").alias(c) for c in LOCUS[1:]], *TAG, F.col("combined_postprob").alias("weight"), F.col("combined_is95").alias("in95"))


def _scored(df, score: str):
    return df.select(*[F.col(t.removeprefix("tag_")).alias(t) for t in TAG], "gene_id", F.col(score).alias("score"))


def features(args: argparse.Namespace) -> None:
    """Staged tables into feature tables and the matrix."""
    cat = catalog(session("features"), args.root, args.version, args.buckets)
    tags, qtl, keep = _tags(cat), cat.read("credsets_qtl"), args.overwrite
    loci = cat.read("toploci")
    interval = cat.read("interval")
    made = {
        "vep": evidence.evidence_features(tags, _scored(cat.read("vep"), "csq_score"), EVIDENCE_COLUMNS["vep"]),
        "polyphen": evidence.evidence_features(tags, _scored(cat.read("polyphen"), "polyphen_score"), EVIDENCE_COLUMNS["polyphen"]),
        "dhs_prmtr": evidence.evidence_features(tags, _scored(interval.where("interval_type = 'dhscor'"), "interval_score"), EVIDENCE_COLUMNS["dhs_prmtr"]),
        "enhc_tss": evidence.evidence_features(tags, _scored(interval.where("interval_type = 'fantom5'"), "interval_score"), EVIDENCE_COLUMNS["enhc_tss"]),
        "pchicJung": evidence.contact_features(tags, cat.read("contacts").withColumnRenamed("bio_feature", "tissue"), EVIDENCE_COLUMNS["pchicJung"]),
        "clpp": clpp_features(tags, qtl),
        "coloc": coloc_features(cat.read("coloc"), qtl),
        "distance": matrix.with_helpers(distance_features(loci, tags, cat.read("genes")), [staging.credible_set_size(tags)], [staging.study_flags(cat.read("studies"))], [cat.read("attenuation")]),
    }
    for name, df in made.items():
        cat.write(f"ft_{name}", df, keep, LOCUS[:3])
    families = [cat.read(f"ft_{n}") for n in made if n != "distance"]
    whole = matrix.assemble(cat.read("ft_distance"), families)
    cat.write("ft_matrix", whole, True, LOCUS[:3])


def between_loci(args: argparse.Namespace) -> None:
    """Scores of genes by their interactions with genes at other loci, from the distance features."""
    cat = catalog(session("between_loci"), args.root, args.version)
    network = cat.read("string").where(F.col("string_score") >= args.min_string_score)
    partners = network.select(F.col("gene_id_1").alias("gene_id"), F.col("gene_id_2").alias("partner"), F.col("string_score").alias("score"))
    data = interlocus.with_context(cat.read("ft_distance"), cat.read("clusters"), cat.read("studies"))
    cat.write("ft_interlocus", interlocus.interlocus_features(data, partners), args.overwrite, LOCUS[:3])


def gold(args: argparse.Namespace) -> None:
    """Labels for the matrix, the training rows, and reports of what was lost."""
    spark = session("gold")
    read = spark.read.parquet
    records = labels.parse_gold(spark.read.schema(GOLD_STANDARDS).json(args.in_gs), args.gs_classes)
    write = lambda df: df.write.mode("overwrite").parquet(args.out_full)
    report = labels.label_and_report(records, read(args.in_clusters), read(args.in_toploci), read(args.in_features), read(args.in_string), write, args.min_string_score)
    labels.training_rows(read(args.out_full)).write.mode("overwrite").parquet(args.out_training)
    write_report(report, args.out_log)


def fit(args: argparse.Namespace) -> None:
    """Cross-validated models of every feature set, kept under out_dir."""
    spark = session("train")
    df = spark.read.parquet(args.in_path).withColumnRenamed(args.outcome_field, train.LABEL)
    if lacking := missing_features(df.columns):
        raise ValueError(f"the matrix lacks features: {sorted(lacking)}")
    train.train_all(
        df, feature_sets(), args.out_dir, outer_folds=args.cv_outer_folds, inner_folds=args.cv_inner_folds, draws=args.cv_iters, seed=args.random_state,
        early_stop=args.early_stop, metric=args.eval_metric, most_trees=args.most_trees,
    )


def predict(args: argparse.Namespace) -> None:
    """Held-out scores of a matrix, and the models' importances."""
    spark = session("predict")
    models, sets = train.saved(spark, args.in_model_pattern), feature_sets()
    if models is None:
        raise ValueError(f"no model matches {args.in_model_pattern}")
    train.held_out_predictions(spark.read.parquet(args.in_ft), models, sets).write.mode("overwrite").parquet(args.out_pred)
    if args.out_ftimp:
        train.importances(models, sets).write.mode("overwrite").parquet(args.out_ftimp)


def validate(args: argparse.Namespace) -> None:
    """Metrics and curve tables of held-out predictions."""
    spark = session("validate")
    by = ["training_clf", "training_ft", "training_gs"]
    pred = spark.read.parquet(args.in_pred)
    if metrics.incomplete_predictions(pred, LOCUS_GENE, by).count():
        raise ValueError("some models don't predict every row")
    judged = pred.select(*by, "training_fold", F.col(train.LABEL).cast("int").alias("label"), F.col("y_proba").alias("score")).persist()
    report = metrics.confusion(judged, by).join(metrics.average_precision(judged, by), by).join(metrics.roc_auc(judged, by), by)
    write_report(report, args.out_report, "\t")
    for name, of in (("pr", metrics.pr_curve), ("roc", metrics.roc_curve), ("calibration", metrics.calibration)):
        of(judged, by).write.mode("overwrite").parquet(f"{args.out_plotdir}/{name}")
        of(judged, [*by, "training_fold"]).write.mode("overwrite").parquet(f"{args.out_plotdir}/{name}_by_fold")
    metrics.mean_importance(spark.read.parquet(args.in_ftimp)).write.mode("overwrite").parquet(f"{args.out_plotdir}/importance")


def usage(args: argparse.Namespace) -> None:
    """How often each setting was chosen."""
    spark = session("usage")
    write_report(metrics.parameter_usage(train.saved(spark, args.in_model_pattern).runs), args.out, "\t")


def wide(args: argparse.Namespace) -> None:
    """Long scores of all loci into one row per (locus, gene)."""
    spark = session("wide")
    out = matrix.pivot_scores(spark.read.parquet(args.in_long), list(feature_sets()), args.exclude_studies, args.keep_clf, args.keep_gsset)
    out.repartitionByRange("study_id", "chrom", "pos").write.mode("overwrite").parquet(args.out_l2g)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="genesieve", description=__doc__)
    steps = top.add_subparsers(dest="step", required=True)

    def step(run, *required: str, **optional: object) -> argparse.ArgumentParser:
        p = steps.add_parser(run.__name__, help=run.__doc__)
        p.set_defaults(run=run)
        for name in required:
            p.add_argument(f"--{name}", required=True)
        for name, default in optional.items():
            kind = {"nargs": "*"} if isinstance(default, list) else {"type": type(default)} if default is not None else {}
            p.add_argument(f"--{name}", default=default, **kind)
        return p

    by_date = {"version": f"{date.today():%y%m%d}"}
    for run, more in ((stage, {"fix_study": None, "fix_traits": []}), (features, {"buckets": 200}), (between_loci, {"min_string_score": 0.0})):
        p = step(run, "root", **by_date, **more)
        p.add_argument("--overwrite", action="store_true")
    step(gold, "in_features", "in_gs", "in_toploci", "in_clusters", "in_string", "out_full", "out_training", "out_log", min_string_score=0.9, gs_classes=["High", "Medium", "Low"])
    step(fit, "in_path", "out_dir", outcome_field="gold_standard_status", cv_outer_folds=5, cv_inner_folds=5, cv_iters=500, random_state=123, early_stop=10, eval_metric="logloss", most_trees=1000)
    step(predict, "in_ft", "in_model_pattern", "out_pred", out_ftimp=None)
    step(validate, "in_pred", "in_ftimp", "out_plotdir", "out_report")
    step(usage, "in_model_pattern", "out")
    step(wide, "in_long", "out_l2g", exclude_studies=[], keep_clf="gbt", keep_gsset="high_medium")
    return top


def main() -> None:
    args = parser().parse_args()
    args.run(args)


if __name__ == "__main__":
    main()
