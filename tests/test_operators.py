"""Operators on hand-computed frames."""

import math

import pytest
from pyspark.sql.classic.dataframe import DataFrame
from pyspark.sql import functions as F

from genesieve.ml.folds import assign, fold_name, with_folds
from genesieve.operators import coloc, components, distance, evidence, interlocus, labels, matrix, metrics, ranking, rangejoin, staging
from genesieve.operators.observed import with_counts
from genesieve.schema import LOCUS, LOCUS_GENE, feature_sets, missing_features
from genesieve.sources.scratch import materialise

S1 = ("S1", "1", 1_000_000, "A", "G")
LOCUS_DDL = "study_id string, chrom string, pos long, ref string, alt string"
TAGS_DDL = LOCUS_DDL + ", tag_chrom string, tag_pos long, tag_ref string, tag_alt string, weight double, in95 boolean"


def tags(spark, rows, locus=S1):
    return spark.createDataFrame([(*locus, "1", p, "A", "G", w, b) for p, w, b in rows], TAGS_DDL)


def by_gene(df, *columns):
    return {r["gene_id"]: tuple(None if r[c] is None else round(r[c], 6) for c in columns) for r in df.collect()}


def evidence_frame(spark, rows):
    return spark.createDataFrame([("1", p, "A", "G", g, s) for p, g, s in rows], "tag_chrom string, tag_pos long, tag_ref string, tag_alt string, gene_id string, score double")


FOUR = ("max", "max_nbh", "ave", "ave_nbh")


def test_evidence_maxima_and_averages(spark):
    t = tags(spark, [(1, 0.6, True), (2, 0.38, True), (3, 0.02, False)])
    e = evidence_frame(spark, [(1, "G1", 0.5), (2, "G1", 0.25), (2, "G2", 1.0), (3, "G2", 0.9), (3, "G3", 0.4)])
    found = by_gene(evidence.evidence_features(t, e, FOUR), *FOUR)
    assert found == {"G1": (0.5, 0.5, 0.395, 0.992462), "G2": (1.0, 1.0, 0.398, 1.0), "G3": (None, None, 0.008, 0.020101)}


def test_evidence_of_zeros_has_no_ratio(spark):
    t = tags(spark, [(1, 1.0, True)])
    assert by_gene(evidence.evidence_features(t, evidence_frame(spark, [(1, "G1", 0.0)]), FOUR), *FOUR) == {"G1": (0.0, None, 0.0, None)}


def test_evidence_of_nothing(spark):
    assert evidence.evidence_features(tags(spark, []), evidence_frame(spark, []), FOUR).count() == 0


def test_tissue_is_chosen_apart_for_max_and_average(spark):
    t = tags(spark, [(1, 0.9, True), (2, 0.1, True)])
    rows = [("1", 1, "A", "G", "G1", 0.4, "a"), ("1", 2, "A", "G", "G1", 0.9, "b"), ("1", 1, "A", "G", "G2", 0.8, "a")]
    e = spark.createDataFrame(rows, "tag_chrom string, tag_pos long, tag_ref string, tag_alt string, gene_id string, score double, tissue string")
    found = by_gene(evidence.tissue_features(evidence.score_tags(t, e), FOUR), *FOUR)
    assert found == {"G1": (0.9, 1.0, 0.36, 0.5), "G2": (0.8, 1.0, 0.72, 1.0)}


def test_contacts_are_closed_and_equal_hits_count_once(spark):
    contacts = spark.createDataFrame([("1", 100, 200, 3.0, "t", "G"), ("1", 150, 300, 3.0, "t", "G"), ("1", 10, 150, 5.0, "t", "G"), ("1", 151, 400, 9.0, "t", "G")], "chrom string, start long, end long, score double, tissue string, gene_id string")
    for width in (7, 100, 50_000):
        hits = evidence.tags_in_contacts(tags(spark, [(150, 1.0, True)]), contacts, width)
        assert sorted(r["score"] for r in hits.collect()) == [3.0, 5.0]


GENES_DDL = "gene_id string, chrom string, gene_start long, gene_end long, tss long"
GENES = [("G1", "1", 900_000, 950_000, 900_000), ("G2", "1", 990_000, 1_010_000, 1_010_000), ("G3", "1", 1_500_000, 1_600_000, 1_500_000), ("G4", "1", 100_000, 2_000_000, 100_000), ("G5", "2", 1_000_000, 1_000_001, 1_000_000)]


def test_sentinel_distances_and_density(spark):
    loci, genes = spark.createDataFrame([S1], LOCUS_DDL), spark.createDataFrame(GENES, GENES_DDL)
    found = by_gene(distance.sentinel_distances(loci, genes), "dist_foot_sentinel", "dist_foot_sentinel_nbh", "dist_tss_sentinel")
    assert found == {"G1": (10.819798, -10.819798, 11.512935), "G2": (0.0, 0.0, 9.21044), "G3": (13.122365, -13.122365, 13.122365)}
    assert distance.gene_density(loci, genes).select("gene_count_lte_50k", "gene_count_lte_100k", "gene_count_lte_250k", "gene_count_lte_500k").collect() == [(2, 2, 2, 3)]
    spine = distance.distance_features(loci, tags(spark, [(1_000_000, 1.0, True)]), genes)
    assert {r["gene_id"] for r in spine.collect()} == {"G1", "G2"}


def test_weighted_distance(spark):
    t = tags(spark, [(1_000_000, 0.6, True), (950_000, 0.4, True)])
    found = by_gene(distance.tag_distances(t, spark.createDataFrame(GENES[:1], GENES_DDL)), "dist_foot_ave")
    assert found["G1"] == (10.308986,)


def test_binned_joins_equal_plain_ones(spark):
    import random

    rng = random.Random(4)
    points = [(rng.choice("ab"), rng.randrange(-500, 5000)) for _ in range(300)]
    spans = [(rng.choice("ab"), s, s + rng.randrange(0, 900)) for s in (rng.randrange(-500, 5000) for _ in range(120))]
    p, i = spark.createDataFrame(points, "c string, pos long"), spark.createDataFrame(spans, "d string, lo long, hi long")
    found = sorted(map(tuple, rangejoin.points_in_intervals(p, i, ("c", "d"), "pos", "lo", "hi", 130).select("c", "pos", "lo", "hi").collect()))
    assert found == sorted((c, x, lo, hi) for c, x in points for d, lo, hi in spans if c == d and lo <= x <= hi)
    near = sorted(map(tuple, rangejoin.points_near_ends(p, i, ("c", "d"), "pos", "lo", "hi", 100, 70).select("c", "pos", "lo", "hi").collect()))
    assert near == sorted((c, x, lo, hi) for c, x in points for d, lo, hi in spans if c == d and (abs(x - lo) <= 100 or abs(x - hi) <= 100))


QTL_DDL = "type string, study_id string, bio_feature string, phenotype_id string, gene_id string, lead_chrom string, lead_pos long, lead_ref string, lead_alt string, tag_chrom string, tag_pos long, tag_ref string, tag_alt string, postprob double, qtl_neglog_p double, is_sentinel boolean"


def test_clpp(spark):
    t = tags(spark, [(1, 0.5, True), (2, 0.5, True), (3, 0.0, True)])
    lead = ("1", 1, "A", "G")
    rows = [("eqtl", "Q", "b", "p", "G1", *lead, "1", 1, "A", "G", 0.8, 7.0, True), ("eqtl", "Q", "b", "p", "G1", *lead, "1", 2, "A", "G", 0.1, None, False), ("eqtl", "Q", "b", "z", "G2", *lead, "1", 3, "A", "G", 0.5, None, False)]
    out = coloc.clpp_features(t, spark.createDataFrame(rows, QTL_DDL))
    found = by_gene(out, "eqtl_pics_clpp_max", "eqtl_pics_clpp_max_neglogp", "eqtl_pics_clpp_max_nhb", "sqtl_pics_clpp_max")
    assert found == {"G1": (round(math.log(0.45), 6), 7.0, 0.0, None), "G2": (None, None, None, None)}


def test_credible_sets_unify(spark):
    lead, fm_ddl = ("1", 1, "A", "G"), "type string, study_id string, lead_chrom string, lead_pos long, lead_ref string, lead_alt string, tag_chrom string, tag_pos long, tag_ref string, tag_alt string, postprob double, is95_credset boolean"
    pics_ddl = fm_ddl.replace("type string, ", "").replace("postprob", "pics_postprob").replace("is95_credset", "pics_95perc_credset")
    fm = spark.createDataFrame([("gwas", "X", *lead, "1", 2, "A", "G", 0.7, True), ("gwas", "X", *lead, "1", 4, "A", "G", 0.001, False), ("gwas", "X", *lead, "1", 5, "A", "G", 0.0009, False)], fm_ddl)
    pics = spark.createDataFrame([("X", *lead, "1", 2, "A", "G", 0.4, True), ("X", *lead, "1", 3, "A", "G", 0.3, True), ("Y", *lead, "1", 3, "A", "G", 0.2, False)], pics_ddl)
    found = {(r["study_id"], r["tag_pos"]): (r["combined_postprob"], r["combined_is95"]) for r in staging.unify_credible_sets(fm, pics).collect()}
    assert found == {("X", 2): (0.7, True), ("X", 3): (None, None), ("X", 4): (0.001, False), ("Y", 3): (0.2, False)}
    only_qtl = spark.createDataFrame([("eqtl", "Y", *lead, "1", 9, "A", "G", 0.7, True)], fm_ddl)
    assert {r["study_id"]: r["combined_postprob"] for r in staging.unify_credible_sets(only_qtl, pics).where("study_id = 'Y'").collect()} == {"Y": None}


def test_qtl_preparation(spark):
    ddl = "type string, study_id string, bio_feature string, phenotype_id string, lead_chrom string, lead_pos long, lead_ref string, lead_alt string, tag_chrom string, tag_pos long, tag_ref string, tag_alt string, postprob double, is95_credset boolean, tag_pval_cond double"
    v = ("1", 5, "A", "G")
    rows = [("eqtl", "Q", "b", "chr1:10:20^ENSG00000000001.5", *v, *v, 0.5, True, 0.01), ("eqtl", "Q", "b", "ABC", *v, "1", 6, "A", "G", 0.5, True, 0.0), ("gwas", "Q", "b", "ABC", *v, *v, 0.5, True, 0.5)]
    raw = spark.createDataFrame(rows, ddl)
    out = staging.prepare_qtl(raw, spark.createDataFrame([("other", "G9")], "phenotype_id string, gene_id string"))
    assert sorted((r["gene_id"], r["is_sentinel"], r["qtl_neglog_p"]) for r in out.collect()) == [("", False, None), ("ENSG00000000001", True, 2.0)]


def test_lost_types_and_dropouts_are_seen_while_writing(spark):
    side = "chrom string, pos long, ref string, alt string"
    ddl = f"type string, study_id string, bio_feature string, phenotype_id string, {', '.join(f'{x}_{c}' for x in ('lead', 'tag') for c in side.split(', '))}, postprob double, is95_credset boolean, tag_pval_cond double"
    v = ("1", 5, "A", "G")
    row = lambda kind, phenotype, p: (kind, "Q", "b", phenotype, *v, *v, p, True, 0.5)
    names = spark.createDataFrame([("P", "G9")], "phenotype_id string, gene_id string")
    for rows, lost in (([row("eqtl", "P", 0.5), row("gwas", "P", 0.5)], set()), ([row("eqtl", "P", 0.5), row("pqtl", "P", 0.0), row("gwas", "P", 0.5)], {"pqtl"}), ([], set())):
        df, told = staging.prepare_qtl_checked(spark.createDataFrame(rows, ddl), names)
        materialise(df, "test-qtl")
        assert told() == lost


def test_dropouts_are_counted_by_the_jobs_that_write(spark):
    k5 = ("S1", "1", 3, "A", "G")
    gold = spark.createDataFrame([(*k5, "G1", "High", "a"), (*k5, "G2", "Low", "b"), ("S1", "1", 9, "A", "G", "G1", "High", "b"), ("S9", "1", 9, "A", "G", "G1", "High", None)], LOCUS_DDL + ", gene_id string, gs_confidence string, gs_set string")
    clusters = spark.createDataFrame([(*k5, "c")], LOCUS_DDL + ", cluster_label string")
    loci = spark.createDataFrame([(*k5, 8.0), ("S1", "1", 9, "A", "G", 7.0)], LOCUS_DDL + ", neglog_p double")
    m = spark.createDataFrame([(*k5, x) for x in ("G1", "G2", "G3")] + [("S1", "1", 9, "A", "G", "G1")], LOCUS_DDL + ", gene_id string")
    links = spark.createDataFrame([("G3", "G1", 0.95, "1", "1")], "gene_id_1 string, gene_id_2 string, string_score double, gene_1_chrom string, gene_2_chrom string")
    written = []
    got = labels.label_and_report(gold, clusters, loci, m, links, lambda df: written.append(materialise(df, "test-labelled")))
    attached = labels.attach_locus(gold, clusters, loci)
    want = labels.dropout_reports(attached, labels.choose_gold(attached), written[0])
    tuples = lambda df: sorted(df.collect(), key=str)
    assert tuples(got) == tuples(want) and len(tuples(want)) > 5
    none = labels.label_and_report(gold.where("false"), clusters, loci, m, links, lambda df: materialise(df, "test-labelled"))
    assert none.collect() == [] and written[0].count() == 4


def test_a_table_is_read_once_for_its_counts(spark, tmp_path):
    df = spark.range(1000).withColumn("set", F.col("id") % 3)
    df.write.parquet(f"{tmp_path}/in")
    read = spark.read.parquet(f"{tmp_path}/in")
    jobs = lambda group: len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("plain", "")
    read.write.parquet(f"{tmp_path}/plain")
    counted, told = with_counts(read, "set", [0, 1, 2, 7], {"n": F.lit(True), "even": F.col("id") % 2 == 0})
    spark.sparkContext.setJobGroup("counted", "")
    counted.write.parquet(f"{tmp_path}/counted")
    assert told() == [(0, 334, 167), (1, 333, 166), (2, 333, 167)]
    assert jobs("counted") == jobs("plain")
    spark.sparkContext.setJobGroup("none", "")


def test_best_transcript(spark):
    ddl = "chrom string, pos long, ref string, alt string, vep struct<transcript_consequences:array<struct<gene_id:string,transcript_id:string,polyphen_score:double>>>"
    rows = [("1", 1, "A", "G", ([("g1", "tA", 0.2), ("g1", "tB", 0.9), ("g1", "tC", None), ("g2", "tD", 0.0)],)), ("1", 2, "A", "G", ([],))]
    found = {(r["gene_id"], r["transcript_id"], r["polyphen_score"]) for r in evidence.best_transcript(spark.createDataFrame(rows, ddl)).collect()}
    assert found == {("g1", "tB", 0.9), ("g2", "tD", 0.0)}


def test_names_and_synonyms(spark):
    genes = spark.createDataFrame([("A", "g1", ["B", "C"]), ("B", "g2", [])], "gene_name string, gene_id string, gene_synonyms array<string>")
    values = spark.createDataFrame([("A", 1.0), ("C", 2.0), ("Z", 3.0), ("B", 4.0)], "gene_name string, value double")
    resolved = staging.resolve_names(values, genes)
    assert {r["gene_name"]: r["gene_id"] for r in resolved.collect()} == {"A": "g1", "B": "g2", "C": "g1", "Z": None}
    assert {(r["gene_id"], r["gene_name"]) for r in staging.one_value_per_gene(resolved).collect()} == {("g1", "A"), ("g2", "B")}


def test_clusters(spark):
    loci = spark.createDataFrame([(s, "1", i, "A", "G") for i, s in enumerate("ABCDE")], LOCUS_DDL)
    rows = [("A", 0, 10), ("B", 1, 10), ("B", 1, 11), ("C", 2, 11), ("D", 3, 99), ("other", 9, 99)]
    t = spark.createDataFrame([(s, "1", p, "A", "G", "1", tag, "A", "G", 1.0, True) for s, p, tag in rows], TAGS_DDL)
    found = {r["study_id"]: r["cluster_label"] for r in components.cluster_loci(loci, t).collect()}
    assert found["A"] == found["B"] == found["C"] != found["D"] and found["E"] == components.UNKNOWN and found["D"] != components.UNKNOWN


@pytest.mark.parametrize("seed", [0, 1])
def test_components_equal_union_find(spark, seed):
    import random

    rng = random.Random(seed)
    edges = [(f"n{rng.randrange(80):03}", f"n{rng.randrange(80):03}") for _ in range(60)] + [(f"p{i:03}", f"p{i + 1:03}") for i in range(40)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in edges:
        a, b = sorted((find(u), find(v)))
        root[b] = a
    found = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "u string, v string")).collect()}
    assert found == {x: find(x) for x in root}


def test_interlocus_weights(spark):
    g = lambda s, p, gene, c: (s, "1", p, "A", "G", gene, c, ["T"])
    data = spark.createDataFrame([g("S", 1, "g", "c1"), g("S", 2, "a", "c2"), g("S", 2, "b", "c2")], LOCUS_DDL + ", gene_id string, cluster_label string, trait_efos array<string>")
    links = spark.createDataFrame([("g", "a", 0.4), ("g", "b", 0.6)], "gene_id string, partner string, score double")
    for by_trait in (False, True):
        row = interlocus.interlocus_scores(data, links, by_trait, "x").first()
        assert [round(row[c], 6) for c in ("x_unweighted", "x_target_weighted", "x_loci_weighted", "x_both_weighted")] == [1.0, 0.5, 0.5, 0.25]
        assert [(p["gene"], p["score"]) for p in row["x_partners"]] == [("a", 0.4), ("b", 0.6)]
    assert interlocus.interlocus_features(data, links).count() == 1


def test_gold_choice_and_labels(spark):
    ddl = LOCUS_DDL + ", gene_id string, gs_confidence string, gs_set string, cluster_label string, neglog_p double, gs_confidence_num int"
    row = lambda p, conf, num, x: ("S1", "1", p, "A", "G", "G1", conf, "set", "c", x, num)
    chosen = labels.choose_gold(spark.createDataFrame([row(1, "Medium", 2, 20.0), row(2, "High", 1, 5.0), row(3, "High", 1, 8.0), row(4, "High", 1, None)], ddl))
    assert [(r["gs_confidence"], r["neglog_p"]) for r in chosen.collect()] == [("High", 8.0)]
    genes = ("G1", "G2", "G3", "G4")
    m = spark.createDataFrame([("S1", "1", 3, "A", "G", x) for x in genes] + [("S1", "1", 9, "A", "G", "G1")], LOCUS_DDL + ", gene_id string")
    links = spark.createDataFrame([("G2", "G1", 0.95, "1", "1"), ("G3", "G1", 0.95, "2", "1"), ("G4", "G1", 0.89, "1", "1")], "gene_id_1 string, gene_id_2 string, string_score double, gene_1_chrom string, gene_2_chrom string")
    found = {(r["pos"], r["gene_id"]): r["gold_standard_status"] for r in labels.label_genes(m, chosen, links).collect()}
    assert found == {(3, "G1"): 1, (3, "G2"): -1, (3, "G3"): 0, (3, "G4"): 0, (9, "G1"): None}
    assert labels.training_rows(labels.label_genes(m, chosen, links)).count() == 3
    two = spark.createDataFrame([("S1", "1", 3, "A", "G", x, "High", "set", "c", 8.0, 1) for x in ("G1", "G2")], ddl)
    both = {r["gene_id"]: r["gold_standard_status"] for r in labels.label_genes(m, two, links).where("pos = 3").collect()}
    assert both["G1"] == both["G2"] == 1


def test_folds(spark):
    folds = assign({"1": 5, "10": 3, "2": 4}, 2, ("1", "2", "3", "10"))
    assert folds == [["1", "3"], ["10", "2"]] and fold_name(1, folds[1]) == "fold1=10|2"
    df = spark.createDataFrame([("1",), ("2",), ("Y",)], "chrom string")
    assert {r["chrom"]: r["fold"] for r in with_folds(df, folds).collect()} == {"1": 0, "2": 1}


def test_metrics(spark):
    rows = [("m", 1, 0.9), ("m", 0, 0.8), ("m", 1, 0.7), ("m", 0, 0.1), ("t", 1, 0.5), ("t", 0, 0.5)]
    df = spark.createDataFrame(rows, "g string, label int, score double")
    c = metrics.confusion(df.where("g = 'm'"), ["g"]).first()
    assert (c["tp"], c["fp"], c["tn"], c["fn"]) == (2, 1, 1, 0)
    assert [round(c[x], 6) for x in ("accuracy", "balanced_accuracy", "precision", "recall", "f1", "fdr")] == [0.75, 0.75, 0.666667, 1.0, 0.8, 0.333333]
    assert {r["g"]: round(r["average_precision"], 6) for r in metrics.average_precision(df, ["g"]).collect()} == {"m": 0.833333, "t": 0.5}
    assert {r["g"]: r["roc_auc"] for r in metrics.roc_auc(df, ["g"]).collect()} == {"m": 0.75, "t": 0.5}
    one_class = spark.createDataFrame([("x", 1, 0.2)], "g string, label int, score double")
    assert metrics.roc_auc(one_class, ["g"]).first()["roc_auc"] is None and metrics.confusion(one_class, ["g"]).first()["tnr"] is None
    bins = metrics.calibration(spark.createDataFrame([("x", 1, 1.0), ("x", 0, 0.95)], "g string, label int, score double"), ["g"]).collect()
    assert [(r["bin"], r["n"], r["share_positive"]) for r in bins] == [(9, 2, 0.5)]


def test_pivot(spark):
    ddl = LOCUS_DDL + ", gene_id string, training_clf string, training_ft string, training_gs string, training_fold string, y_proba double"
    rows = [(*S1, "G", "gbt", "full_model", "hm", "f", 0.7), (*S1, "G", "gbt", "dist_foot", "hm", "f", 0.2), ("bad", *S1[1:], "G", "gbt", "dist_foot", "hm", "f", 0.2)]
    out = matrix.pivot_scores(spark.createDataFrame(rows, ddl), ["full_model", "dist_foot", "dist_tss"], ["bad"], "gbt", "hm").collect()
    assert [(r["y_proba_full_model"], r["y_proba_dist_foot"], r["y_proba_dist_tss"]) for r in out] == [(0.7, 0.2, None)]


def test_assembly_keeps_the_spine(spark):
    spine = spark.createDataFrame([(*S1, "G1", 1.0), (*S1, "G1", 2.0), (*S1, None, 1.0)], LOCUS_DDL + ", gene_id string, d double")
    family = spark.createDataFrame([(*S1, "G1", 5.0), (*S1, "G9", 6.0)], LOCUS_DDL + ", gene_id string, f double")
    out = matrix.assemble(spine, [family]).collect()
    assert [(r["gene_id"], r["d"], r["f"]) for r in out] == [("G1", 1.0, 5.0)]


def test_ranking_is_total(spark):
    df = spark.createDataFrame([("k", 1, "b"), ("k", 1, "a"), ("k", None, "c"), ("n", None, "z")], "k string, v int, t string")
    assert {r["k"]: r["t"] for r in ranking.top_per_group(df, ["k"], [F.col("v").desc_nulls_last(), F.col("t").asc()]).collect()} == {"k": "a", "n": "z"}
    assert {r["k"]: r["t"] for r in ranking.distinct_by(df, ["k"]).collect()} == {"k": "a", "n": "z"}


def test_feature_sets():
    sets = feature_sets()
    assert len(sets) == 11 and len(sets["full_model"]) == len(set(sets["full_model"])) == 53
    assert missing_features([c for c in {c for s in sets.values() for c in s} if c != "vep_ave"]) == {"vep_ave"}
    assert len(LOCUS) == 5 and LOCUS_GENE[-1] == "gene_id"


def test_thresholds_equal_brute_force(spark):
    import random

    rng = random.Random(8)
    rows = [(rng.choice(["a", None]), rng.randrange(2), rng.choice([-3.0, 0.0, 0.25, 0.2501, 0.9, 1.0, 7.5, None, rng.random()])) for _ in range(400)]
    df = spark.createDataFrame(rows, "g string, label int, score double")
    low = float("-inf")
    for r in metrics.thresholds(df, ["g"]).collect():
        own = [(y, low if s is None else s) for g, y, s in rows if g == r["g"]]
        cut = low if r["score"] is None else r["score"]
        assert (r["tp"], r["fp"]) == (sum(y == 1 and s >= cut for y, s in own), sum(y == 0 and s >= cut for y, s in own))
        assert (r["all_p"], r["all_n"]) == (sum(y for y, _ in own), sum(1 - y for y, _ in own))
    assert metrics.thresholds(df.where("false"), ["g"]).count() == 0


def test_families_together_equal_each_alone(spark):
    import random

    rng = random.Random(2)
    tags = spark.createDataFrame([(f"S{i % 3}", "1", i // 6, "A", "G", "1", rng.randrange(20), "A", "G", rng.random(), rng.random() < 0.5) for i in range(200)], LOCUS_DDL + ", tag_chrom string, tag_pos long, tag_ref string, tag_alt string, weight double, in95 boolean")
    ddl = "tag_chrom string, tag_pos long, tag_ref string, tag_alt string, gene_id string, score double"
    tables = {n: spark.createDataFrame([("1", p, "A", "G", f"G{g}", rng.choice([None, 0.0, round(rng.random(), 3)])) for p in range(20) for g in range(5) if rng.random() < share], ddl) for n, share in (("a", 0.3), ("b", 0.1))}
    names = {n: tuple(f"{n}_{x}" for x in ("max", "max_nbh", "ave", "ave_nbh")) for n in tables}
    both = {tuple(r[c] for c in LOCUS_GENE): r for r in evidence.family_features(tags, {n: (t, names[n]) for n, t in tables.items()}).collect()}
    for n, t in tables.items():
        alone = {tuple(r[c] for c in LOCUS_GENE): r for r in evidence.evidence_features(tags, t, names[n]).collect()}
        for key, row in both.items():
            for c in names[n]:
                want = alone[key][c] if key in alone else None
                assert row[c] == want or abs(row[c] - want) < 1e-12
        assert alone.keys() <= both.keys()


def test_dense_bins_are_split(spark):
    """Nine tenths of the points lie in one bin, half of them at one place: pairs are the same as without splitting, and no key gathers them."""
    import functools
    import random

    rng = random.Random(3)
    rows = [(i, "1", 7_000_123 if i % 2 else rng.randrange(7_000_000, 7_050_000)) if i % 10 else (i, rng.choice("12"), rng.randrange(20_000_000)) for i in range(3000)]
    rows += [(3000, "1", None), (3001, None, 5), (3002, "1", 7_000_123), (3002, "1", 7_000_123)]
    points = spark.createDataFrame(rows, "i int, c string, at long")
    spans = [(j, rng.choice("12"), (a := rng.randrange(20_000_000)), a + rng.randrange(400_000)) for j in range(100)]
    spans += [(100, "1", 6_999_000, 7_001_000), (101, "1", 7_000_123, 7_000_123), (102, "1", None, 5), (103, "1", 9, 5), (104, "1", 6_000_000, 8_000_000)]
    intervals = spark.createDataFrame(spans, "j int, d string, low long, high long")
    split = functools.partial(rangejoin.dense_bins, parts=20, least=10)
    for join in (rangejoin.points_in_intervals, rangejoin.points_near_ends):
        plain = join(points, intervals, ("c", "d"), "at", "low", "high", split=None)
        got = join(points, intervals, ("c", "d"), "at", "low", "high", split=split)
        assert got.columns == plain.columns and sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    dense = split(points, "c", "at", 50_000).collect()
    assert {r["_coarse"] for r in dense} == {140} and max(r["_pieces"] for r in dense) >= 9 and len(dense) <= rangejoin.FINE
    # rows of the largest key of the join
    seen = []
    real = DataFrame.join

    def spy(self, other, *a, **k):
        if "_piece" in self.columns and "_ipiece" in other.columns:
            seen.append(self.groupBy("c", "_bin", "_f", "_piece").count().agg(F.max("count")).first()[0])
        return real(self, other, *a, **k)

    DataFrame.join, kept = spy, DataFrame.join
    try:
        rangejoin.points_in_intervals(points, intervals, ("c", "d"), "at", "low", "high", split=split).count()
    finally:
        DataFrame.join = kept
    assert seen and seen[0] < 3004 / 20 * 1.5


def test_close_scores_are_ranked_by_several_tasks(spark):
    # all scores lie inside 1e-4 of each other, and one group holds nearly all of them
    df = spark.range(4000).select(F.when(F.col("id") < 3900, "big").otherwise("small").alias("g"), (F.col("id") % 3 == 0).cast("int").alias("label"), (0.5 + F.col("id") / 4e7).alias("score"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = metrics.thresholds(df, ["g"])
        rows = sorted(((r["g"], -r["score"], r["tp"], r["fp"]) for r in out.collect()))
        ranges = scored_ranges(spark)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    tp = fp = 0
    for (g, _, got_tp, got_fp), i in zip(rows, [*range(3899, -1, -1), *range(3999, 3899, -1)], strict=True):
        if i in (3899, 3999):
            tp = fp = 0
        tp, fp = tp + (i % 3 == 0), fp + (i % 3 != 0)
        assert (g, got_tp, got_fp) == ("big" if i < 3900 else "small", tp, fp)
    assert len(ranges) == 4 and max(ranges) < 2000


def scored_ranges(spark):
    """Rows by range of the scores written last."""
    import glob
    import os

    from genesieve.sources.scratch import scratch_root

    last = max(glob.glob(f"{scratch_root(spark).removeprefix('file://')}/scores-*"), key=os.path.getmtime)
    return [r["count"] for r in spark.read.parquet(last).groupBy("_range").count().collect()]


def test_a_source_whose_study_no_partner_has_meets_none(spark):
    rows = [("S1", "1", 1, "A", "G", "G1", "c1"), ("S2", "1", 2, "A", "G", "G2", "c2"), ("S3", "1", 3, "A", "G", "G1", "c3"), ("S2", "1", 4, "A", "G", "G1", "c4")]
    df = spark.createDataFrame(rows, LOCUS_DDL + ", gene_id string, cluster_label string").withColumn("trait_efos", F.when(F.col("study_id") != "S3", F.array("study_id")))
    inter = spark.createDataFrame([("G1", "G2", 0.5)], "gene_id string, partner string, score double")
    for by_trait in (True, False):
        got = interlocus.interlocus_scores(df, inter, by_trait, "x").collect()
        assert [(r["study_id"], r["pos"], r["x_unweighted"]) for r in got] == [("S2", 4, 0.5)]


def test_hub_genes_are_spread_over_cells(spark, monkeypatch):
    import random

    rng = random.Random(6)
    rows = [(f"S{rng.randrange(4)}", "1", i, "A", "G", "HUB" if i % 3 == 0 else f"G{rng.randrange(30)}", f"c{rng.randrange(12)}") for i in range(300)]
    df = spark.createDataFrame(rows, LOCUS_DDL + ", gene_id string, cluster_label string").withColumn("trait_efos", F.transform(F.sequence(F.lit(0), F.length("study_id")), lambda x: F.concat(F.lit("T"), (x + F.substring("study_id", 2, 1).cast("int")).cast("string"))))
    inter = spark.createDataFrame([(a, b, rng.randrange(1, 9) / 10) for a in ("HUB", "G1", "G2") for b in [f"G{i}" for i in range(30)]], "gene_id string, partner string, score double")

    def both():
        return [sorted(str(tuple(r)) for r in interlocus.interlocus_scores(df, inter, t, "x").selectExpr("study_id", "pos", "gene_id", "round(x_unweighted, 9)", "round(x_both_weighted, 9)", "x_partners").collect()) for t in (True, False)]

    want = both()
    monkeypatch.setattr(interlocus, "CELL_PLACES", 20)
    monkeypatch.setattr(interlocus, "CELL_SOURCES", 5)
    assert both() == want and all(want)


def test_interlocus_equals_brute_force(spark):
    import random

    from genesieve.operators import interlocus

    rng = random.Random(3)
    traits = {"S1": ["t1"], "S2": ["t2", "t1"], "S3": ["t3"], "S4": None}
    data = [(f"S{i % 4 + 1}", "1", i, "A", "G", f"G{rng.randrange(6)}", f"c{rng.randrange(5)}") for i in range(60)]
    links = [(f"G{a}", f"G{b}", (a + 2 * b) / 10) for a in range(6) for b in range(6) if a != b and (a * b) % 3]
    df = spark.createDataFrame([(*d, traits[d[0]]) for d in data], LOCUS_DDL + ", gene_id string, cluster_label string, trait_efos array<string>")
    inter = spark.createDataFrame(links, "gene_id string, partner string, score double")
    for by_trait in (False, True):
        meets = (lambda a, b: bool(set(traits[a] or ()) & set(traits[b] or ()))) if by_trait else (lambda a, b: a == b)
        want = {}
        for d in data:
            pairs = {(p, e[6], w) for g, p, w in links if g == d[5] for e in data if e[5] == p and e[6] != d[6] and meets(d[0], e[0])}
            size = {c: len({p for p, x, _ in pairs if x == c}) for _, c, _ in pairs}
            chosen = {p: min((size[c], c, w) for q, c, w in pairs if q == p) for p, _, _ in pairs}
            if chosen:
                n = len({e[6] for e in data if meets(d[0], e[0])})
                want[d[:6]] = tuple(round(x, 9) for x in (sum(w for _, _, w in chosen.values()), sum(w / k for k, _, w in chosen.values()), sum(w / k / n for k, _, w in chosen.values())))
        out = interlocus.interlocus_scores(df, inter, by_trait, "x").collect()
        assert len(out) == len(want)
        assert {tuple(r[:6]): tuple(round(r[c], 9) for c in ("x_unweighted", "x_target_weighted", "x_both_weighted")) for r in out} == want


def test_scores_that_tie_as_the_sql_rounds_them_tie(spark):
    """Products of posteriors that should be equal differ in the last bit; their logarithms decide whether p-values rank them."""
    from genesieve.functions.scalar import ln_or_null

    rows = [(0.05707317073170732,), (0.05707317073170731,), (0.18000000000000002,), (0.18,), (0.0494949494949495,), (0.049494949494949494,), (1.0,), (0.0,), (5e-324,), (math.inf,)]
    got = [r[0] for r in spark.createDataFrame(rows, "x double").select(ln_or_null(F.col("x"))).collect()]
    assert got[0] == got[1] and got[2] == got[3] and got[4] > got[5]
    assert got == [None if x == 0 else math.log(x) for (x,) in rows]


@pytest.mark.parametrize("piece", [3, 250_000])
def test_pairs_of_tags_and_evidence_are_never_shuffled(spark, monkeypatch, piece):
    import random

    from genesieve.operators import regions

    monkeypatch.setattr(regions, "PIECE_PAIRS", piece)
    monkeypatch.setattr(regions, "TASK_PAIRS", 10 * piece)
    rng = random.Random(5)
    rows = [(f"S{i % 3}", rng.choice("12"), 150_000 * (i // 40) + i, "A", "G", rng.choice("12"), 1000 * rng.randrange(30), "A", "G", rng.random(), rng.random() < 0.5) for i in range(200)]
    t = spark.createDataFrame(rows + [("S1", None, 5, "A", "G", "1", 0, "A", "G", 0.5, True)], TAGS_DDL)
    found = [(c, 1000 * p, "A", "G", f"G{rng.randrange(6)}", round(rng.random(), 3), rng.choice("ab")) for c in "12" for p in range(30) for _ in range(3)]
    e = spark.createDataFrame(found + found[:5], "tag_chrom string, tag_pos long, tag_ref string, tag_alt string, gene_id string, score double, tissue string")
    canon = lambda df: sorted(tuple(round(v, 9) if isinstance(v, float) else str(v) for v in r) for r in df.select(*LOCUS_GENE, *FOUR).collect())
    laid = evidence.evidence_features(t, e.drop("tissue"), FOUR)
    assert canon(laid) == canon(evidence.summarise(evidence.score_tags(t, e.drop("tissue")))) != []
    assert canon(evidence.tissue_evidence_features(t, e, FOUR)) == canon(evidence.tissue_features(evidence.score_tags(t, e), FOUR)) != []
    spans = e.select(F.col("tag_chrom").alias("chrom"), (F.col("tag_pos") - 1500).alias("start"), (F.col("tag_pos") + 500).alias("end"), "score", "tissue", "gene_id")
    contacts = evidence.contact_features(t, spans, FOUR)
    assert canon(contacts) == canon(evidence.tissue_features(evidence.tags_in_contacts(t, spans), FOUR)) != []
    for df in (laid, contacts):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan.split("Generate explode(_found")[0]


def test_density_makes_no_pairs_and_equals_brute_force(spark):
    import random

    rng = random.Random(7)
    ends = [(rng.randrange(4_000_000), rng.choice([0, 5_000, 999_999, 1_000_000, 1_000_001, 2_500_000, -300_000, -1_200_000])) for _ in range(60)]
    genes = [(f"G{i}", rng.choice("12"), a, a + n, a) for i, (a, n) in enumerate(ends)] + [("GN", "1", None, 5, 5)]
    loci = [("S", rng.choice("123"), rng.randrange(-100_000, 6_000_000), "A", "G") for _ in range(150)]
    loci += [("S", g[1], g[k] + d, "A", "C") for g in genes[:20] for k in (2, 3) for d in (-500_001, -500_000, -50_000, 100_000, 250_000, 250_001, 500_000, 500_001)]
    loci += loci[:7] + [("S", "1", None, "A", "G"), ("S", None, 5, "A", "G")]
    want = {}
    for row in loci:
        for _, chrom, a, b, _ in genes:
            if row[2] is not None and a is not None and chrom == row[1] and (abs(row[2] - a) <= 500_000 or abs(row[2] - b) <= 500_000):
                foot = 0 if a <= row[2] <= b else min(abs(row[2] - a), abs(row[2] - b))
                n = want.setdefault(row, [0, 0, 0, 0])
                for i, k in enumerate((50, 100, 250, 500)):
                    n[i] += foot <= 1000 * k
    out = distance.gene_density(spark.createDataFrame(loci, LOCUS_DDL), spark.createDataFrame(genes, GENES_DDL))
    assert "_bin" not in out._jdf.queryExecution().analyzed().toString()
    rows = out.collect()
    assert len(rows) == len(want) and {tuple(r)[:5]: list(r)[5:] for r in rows} == want


def shuffles_after_pairs(df) -> list[str]:
    """Exchanges above the first join with genes in the plan as it is run, and windows there."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    top = plan[: plan.index("ShuffledHashJoin")]
    return [line for line in top.splitlines() if "Exchange" in line]


def random_places(rng, n, span=3_000_000):
    return [(f"S{rng.randrange(2)}", rng.choice("12"), rng.randrange(span), "A", "G") for _ in range(n)]


def random_genes(rng, n, span=3_000_000):
    rows = [(f"G{i}", rng.choice("12"), a := rng.randrange(span), b := a + rng.randrange(0, 1_500_000), rng.choice((a, b))) for i in range(n)]
    return [*rows, ("same", *rows[0][1:])]


def test_sentinel_pairs_are_made_where_they_lie(spark):
    """A locus given twice has its rows twice; pairs are neither shuffled nor sorted."""
    import random

    rng = random.Random(5)
    loci, genes = random_places(rng, 40), random_genes(rng, 40)
    loci.append(loci[0])
    out = distance.sentinel_distances(spark.createDataFrame(loci, LOCUS_DDL), spark.createDataFrame(genes, GENES_DDL))
    assert not shuffles_after_pairs(out) and "Window" not in out._jdf.queryExecution().executedPlan().toString()
    foot = lambda x, a, b: 0 if a <= x <= b else min(abs(x - a), abs(x - b))
    want = []
    for place in loci:
        near = [(g, foot(place[2], a, b), abs(place[2] - t)) for g, c, a, b, t in genes if c == place[1] and min(abs(place[2] - a), abs(place[2] - b)) <= 500_000]
        want += [(*place, g, f, round(math.log(min(x[1] for x in near) + 1) - math.log(f + 1), 9), round(math.log(min(x[2] for x in near) + 1) - math.log(t + 1), 9)) for g, f, t in near]
    got = [(*[r[c] for c in LOCUS_GENE], r["foot"], round(r["dist_foot_sentinel_nbh"], 9), round(r["dist_tss_sentinel_nbh"], 9)) for r in out.collect()]
    assert sorted(got) == sorted(want)


def test_tag_pairs_are_made_where_they_lie(spark):
    """Tags far from their locus, and on another chromosome, meet the genes near themselves; no pair is shuffled, however small the pieces."""
    import random

    rng = random.Random(6)
    genes, rows = random_genes(rng, 40), []
    for place in random_places(rng, 30):
        rows += [(*place, rng.choice(("1", "2", place[1], place[1])), rng.choice((place[2], rng.randrange(3_000_000))), "A", "G", rng.random(), rng.random() < 0.7) for _ in range(4)]
    t = spark.createDataFrame(rows, LOCUS_DDL + ", tag_chrom string, tag_pos long, tag_ref string, tag_alt string, weight double, in95 boolean")
    total = {}
    for s, c, p, ref, alt, tc, tp, _, _, w, _ in rows:
        for g, gc, a, b, _ in genes:
            if gc == tc and min(abs(tp - a), abs(tp - b)) <= 500_000:
                key, d = (s, c, p, ref, alt, g), 0 if a <= tp <= b else min(abs(tp - a), abs(tp - b))
                total[key] = total.get(key, 0) + d * w
    want = {}
    for s, c, p, ref, alt, tc, tp, _, _, _, sure in rows:
        for g, gc, a, b, _ in genes:
            if gc == tc and min(abs(tp - a), abs(tp - b)) <= 500_000 and sure:
                key, d = (s, c, p, ref, alt, g), 0 if a <= tp <= b else min(abs(tp - a), abs(tp - b))
                want[key] = min(want.get(key, d), d)
    before = distance.PIECE_PAIRS
    try:
        for distance.PIECE_PAIRS in (before, 50):
            out = distance.tag_distances(t, spark.createDataFrame(genes, GENES_DDL))
            assert not shuffles_after_pairs(out)
            got = {tuple(r[c] for c in LOCUS_GENE): r for r in out.collect()}
            assert set(got) == set(total)
            assert all(abs(got[k]["dist_foot_ave"] - math.log(total[k] + 1)) < 1e-9 for k in total)
            assert {k: round(math.exp(r["dist_foot_min"]) - 1) for k, r in got.items() if r["dist_foot_min"] is not None} == want
    finally:
        distance.PIECE_PAIRS = before


def test_nearest_starts_equal_brute_force(spark):
    """Few places, so that starts, distances and loci tie; no pair of each locus and gene is made."""
    import random

    rng = random.Random(7)
    loci = [(*p[:2], rng.randrange(40) * 5, *p[3:], i) for i, p in enumerate(random_places(rng, 60))]
    genes = [(f"G{i}", rng.choice("12"), a := rng.randrange(40) * 5, a + 1, a) for i in range(50)]
    out = distance.nearest_starts(spark.createDataFrame(loci, LOCUS_DDL + ", k int"), spark.createDataFrame(genes, GENES_DDL), 50)
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
    want = []
    for key in {x[:5] for x in loci}:
        pairs = sorted((abs(key[2] - a), g, x[5]) for x in loci if x[:5] == key for g, c, a, _, _ in genes if c == key[1] and a // 50 == key[2] // 50)
        want += [(*key, k, g, n + 1) for n, (_, g, k) in enumerate(pairs[:2])]
    assert sorted(map(tuple, out.select(*LOCUS, "k", "gene_id", "n").collect())) == sorted(want)


def test_labels_need_no_join_of_pairs(spark):
    """Loci that carry their gold give their genes' labels; those equal the labels of a joined matrix."""
    import random

    rng = random.Random(8)
    places, genes = random_places(rng, 30), random_genes(rng, 30)
    loci, g = spark.createDataFrame(places, LOCUS_DDL), spark.createDataFrame(genes, GENES_DDL)
    gold = spark.createDataFrame([(*p, rng.choice(genes)[0], "High", rng.choice("ab"), 1) for p in rng.sample(places, 12) for _ in range(2)], LOCUS_DDL + ", gene_id string, gs_confidence string, gs_set string, gs_confidence_num int")
    links = spark.createDataFrame([(rng.choice(genes)[0], rng.choice(genes)[0], 0.95, "1", "1") for _ in range(80)], "gene_id_1 string, gene_id_2 string, string_score double, gene_1_chrom string, gene_2_chrom string")
    direct = labels.with_labels(distance.near_genes(loci.join(labels.gold_of_loci(gold, links), [*LOCUS], "left"), g)).select(*LOCUS_GENE, *labels.LABELS)
    assert not shuffles_after_pairs(direct)
    joined = labels.label_genes(distance.sentinel_distances(loci, g).select(*LOCUS_GENE), gold, links)
    assert sorted(map(str, direct.collect())) == sorted(map(str, joined.collect()))
    assert {r["gold_standard_status"] for r in direct.collect()} >= {None, 0}


def test_partners_are_not_shuffled_after_their_cells(spark):
    g = lambda s, p, gene, c: (s, "1", p, "A", "G", gene, c, ["T", s])
    rows = [g("S", 1, "g", "c1"), g("S", 2, "a", "c2"), g("S", 2, "b", "c2"), g("R", 3, "a", "c3"), g("R", 4, "g", "c1"), g("S", 5, "g", "c1")]
    data = spark.createDataFrame(rows, LOCUS_DDL + ", gene_id string, cluster_label string, trait_efos array<string>")
    links = spark.createDataFrame([("g", "a", 0.4), ("g", "b", 0.6)], "gene_id string, partner string, score double")
    both = interlocus.interlocus_features(data, links, "target_gene || ':' || score")
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapCoGroupsInArrow") == 1 and "Exchange" not in plan.split("FlatMapCoGroupsInArrow")[0]
    found = {r["pos"]: (r["interlocus_study_partners"], round(r["interlocus_study_target_weighted"], 6), r["interlocus_trait_partners"], round(r["interlocus_trait_target_weighted"], 6)) for r in both.collect()}
    assert found == {1: (["a:0.4", "b:0.6"], 0.5, ["a:0.4", "b:0.6"], 0.7), 5: (["a:0.4", "b:0.6"], 0.5, ["a:0.4", "b:0.6"], 0.7), 4: (["a:0.4"], 0.4, ["a:0.4", "b:0.6"], 0.7)}


def test_credible_sets_meet_where_they_are_laid_out(spark):
    keys = "study_id string, lead_chrom string, lead_pos bigint, lead_ref string, lead_alt string, tag_chrom string, tag_pos bigint, tag_ref string, tag_alt string"
    k = lambda s, p: (s, "1", p, "A", "G", "1", p, "A", "G")
    fm = spark.createDataFrame([(*k("S", 1), "gwas", 0.5, True), (*k("S", 1), "gwas", 0.4, False), (*k("S", 2), "gwas", 0.3, True), (*k(None, 3), "gwas", 0.2, True)], f"{keys}, type string, postprob double, is95_credset boolean")
    pics = spark.createDataFrame([(*k("S", 1), 0.9, True), (*k("R", 4), 0.8, True), (*k(None, 3), 0.7, True)], f"{keys}, pics_postprob double, pics_95perc_credset boolean")
    out = staging.unify_credible_sets(fm, pics, 7)
    assert out.rdd.getNumPartitions() == 7
    found = sorted((str(r["study_id"]), r["lead_pos"], str(r["fm_postprob"]), str(r["pics_postprob"]), r["combined_postprob"] or 0) for r in out.collect())
    assert found == [("None", 3, "0.2", "None", 0), ("None", 3, "None", "0.7", 0.7), ("R", 4, "None", "0.8", 0.8), ("S", 1, "0.4", "0.9", 0.4), ("S", 1, "0.5", "0.9", 0.5), ("S", 2, "0.3", "None", 0.3)]


def test_coloc_rows_take_p_values_of_their_leads_where_they_lie(spark):
    qtl = "qtl_study string, qtl_bio_feature string, qtl_phenotype string, qtl_chrom string, qtl_pos bigint, qtl_ref string, qtl_alt string"
    leads = spark.createDataFrame([("Q", "F", "P", "1", 1, "A", "G", 3.0), ("Q", None, "P", "1", 1, "A", "G", 9.0)], f"{qtl}, neglogp double")
    rows = [("S", "1", p, "A", "G", "g", "eqtl", "Q", f, "P", "1", q, "A", "G", 0.5) for p, f, q in ((1, "F", 1), (2, None, 1), (3, "F", 2))]
    scored = spark.createDataFrame(rows, f"{LOCUS_DDL}, gene_id string, qtl_type string, {qtl}, score double")
    out = coloc.best_by_type(scored, leads, ("x", "p", "gap"), parts=7)
    assert out.rdd.getNumPartitions() == 7 and {r["pos"]: r["eqtl_p"] for r in out.collect()} == {1: 3.0, 2: None, 3: None}


def test_cells_where_nothing_meets_have_sums_of_the_declared_type(spark):
    """A cell whose sources meet no partner makes no row, and fails no job."""
    df = spark.createDataFrame([("S1", "1", 1, "A", "G", "g", "c1", ["T"]), ("S2", "1", 9, "A", "G", "h", "c2", ["U"])], LOCUS_DDL + ", gene_id string, cluster_label string, trait_efos array<string>")
    links = spark.createDataFrame([("g", "h", 0.5)], "gene_id string, partner string, score double")
    for by_trait in (True, False):
        assert interlocus.interlocus_scores(df, links, by_trait, "x").collect() == []
    assert interlocus.interlocus_features(df, links).collect() == []


def test_positives_and_dropouts_need_no_pairs(spark):
    """Genes of both kinds of ends, twice or without an id or an end, at loci given twice: what the labelled rows tell, but without making them."""
    import random

    rng = random.Random(8)
    at = lambda: rng.randrange(4_000_000)
    genes = [(rng.choice(["G1", "G2", "G3", "G4", None]), rng.choice("12"), a := at(), rng.choice([a + 30_000, a + 2_500_000, a - 20_000, None]), a) for _ in range(60)]
    genes = spark.createDataFrame(genes, "gene_id string, chrom string, gene_start long, gene_end long, tss long")
    loci = [(f"S{i % 2}", rng.choice("12"), at(), "A", "G") for i in range(30)]
    gold = [(*x, rng.choice(["G1", "G2", None]), rng.choice(["High", "Low"]), rng.choice(["a", "b", None]), 1) for x in loci[:20] for _ in range(2)]
    gold = spark.createDataFrame(gold, LOCUS_DDL + ", gene_id string, gs_confidence string, gs_set string, gs_confidence_num int")
    loci = spark.createDataFrame([*loci, *loci[:5]], LOCUS_DDL)
    links = spark.createDataFrame([("G3", "G1", 0.95, "1", "1")], "gene_id_1 string, gene_id_2 string, string_score double, gene_1_chrom string, gene_2_chrom string")
    labelled = labels.with_labels(distance.near_genes(loci.join(labels.gold_of_loci(gold, links), [*LOCUS]), genes))
    want = labelled.where("gs_set IS NOT NULL").groupBy("gs_set").agg(F.count_if(F.col("gold_standard_status") == 1), F.count_if(F.col("gold_standard_status") != 1))
    known = labels.gold_of_loci(gold, None)
    own = loci.join(known, [*LOCUS])
    positives = distance.own_genes_near(own, "_gold", genes)
    yes = labelled.where("gold_standard_status = 1").select(*LOCUS_GENE)
    assert sorted(positives.select(*LOCUS_GENE).collect()) == sorted(yes.collect()) != []
    told = labels.labelled_report(distance.near_counts(own.select(*LOCUS), genes), positives, known)
    assert sorted(told.collect()) == sorted(want.collect()) != []


def test_six_places_are_those_of_decimal_numbers(spark):
    from genesieve.plans.queries import _six_places, rounded

    values = [0.0, -0.0, 5e-7, -5e-7, 2.5e-6, 1e-10, -1e-10, 0.1 + 0.2, -3.1234565, 123456.7891235, 999_999_999.9999995, 1e9, 12345678901.123457, 1e300, float("nan"), float("inf"), float("-inf"), None]
    df = spark.createDataFrame([(v,) for v in values], "x double").unionByName(spark.range(20_000).select((F.xxhash64("id") / 1e14).alias("x")))
    off = df.select("x", F.round("x", 6).cast("string").alias("a"), _six_places(F.col("x")).cast("string").alias("b")).where(~F.col("a").eqNullSafe(F.col("b")))
    assert off.collect() == []
    assert rounded(df.limit(3)).dtypes == [("x", "double")]


def test_dense_regions_are_cut_by_position_before_they_are_dealt(spark):
    """What is known of a tag goes to the narrow region that holds it; only a narrowest region that still has many pairs is dealt by a hash."""
    from genesieve.operators import regions

    most = regions.REGION // regions.FINEST
    rows = [("1", i, regions.PIECE_PAIRS // 2) for i in range(most)] + [("1", most, 10), ("1", most + 7, 10), ("2", -1, 3 * regions.PIECE_PAIRS)]
    got = {(r["chrom"], r["_fine"]): (r["_at"], r["_pieces"]) for r in regions._places(spark.createDataFrame(rows, "chrom string, _fine long, _pairs long")).collect()}
    assert [got["1", i] for i in range(most)] == [(i // 2 * 2, 1) for i in range(most)]
    assert got["1", most] == got["1", most + 7] == (most, 1)
    assert got["2", -1][1] == 3 and len(got) == len(rows)


def test_clpp_pairs_are_made_where_they_lie(spark, monkeypatch):
    import random
    from collections import defaultdict

    from genesieve.operators import regions

    monkeypatch.setattr(regions, "PIECE_PAIRS", 20)
    rng = random.Random(9)
    t = [(f"S{i % 3}", "1", 150_000 * (i // 8), "A", "G", "1", 1000 * rng.randrange(12), "A", "G", rng.randrange(1, 5) / 8, True) for i in range(60)]
    keys = ("type", "study_id", "bio_feature", "phenotype_id", "lead_chrom", "lead_pos", "lead_ref", "lead_alt")
    q = [(rng.choice(["eqtl", "sqtl"]), "Q1", rng.choice(["b", None]), f"P{rng.randrange(3)}", rng.choice(["G1", "G2", None]), "1", 1000 * rng.randrange(12), "A", "G", "1", 1000 * rng.randrange(12), "A", "G", rng.randrange(3) / 4, rng.choice([1.0, 2.0, None]), rng.random() < 0.5) for _ in range(80)]
    names = ("type", "study_id", "bio_feature", "phenotype_id", "gene_id", "lead_chrom", "lead_pos", "lead_ref", "lead_alt", "tag_chrom", "tag_pos", "tag_ref", "tag_alt", "postprob", "qtl_neglog_p", "is_sentinel")
    q = [dict(zip(names, r, strict=True)) for r in q]
    ddl = ", ".join(f"{n} {'long' if n.endswith('_pos') else 'double' if n in ('postprob', 'qtl_neglog_p') else 'boolean' if n == 'is_sentinel' else 'string'}" for n in names)
    out = coloc.clpp_features(spark.createDataFrame(t, TAGS_DDL), spark.createDataFrame([tuple(r.values()) for r in q], ddl))
    sums, leads = defaultdict(float), defaultdict(list)
    for r in q:
        own = tuple(r[k] for k in keys[1:])
        if r["is_sentinel"] and r["qtl_neglog_p"] is not None and None not in own:
            leads[own].append(r["qtl_neglog_p"])
    for x in t:
        for r in q:
            if r["gene_id"] and x[6] == r["tag_pos"]:
                sums[(*x[:5], r["gene_id"], *[r[k] for k in keys])] += x[9] * r["postprob"]
    best = defaultdict(list)
    for k, v in sums.items():
        best[(*k[:6], k[6])].append((math.log(v) if v else -math.inf, min(leads.get(k[7:], [-math.inf]))))
    want = {k: max(v) for k, v in best.items()}
    tops = defaultdict(lambda: -math.inf)
    for k, (score, _) in want.items():
        tops[(*k[:5], k[6])] = max(tops[(*k[:5], k[6])], score)
    known = lambda v: None if v is None or v == -math.inf else round(v, 9)
    got = {tuple(r[c] for c in LOCUS_GENE): r for r in out.collect()}
    assert set(got) == {k[:6] for k in want} and len(got) > 20
    for k, (score, p) in want.items():
        r, x = got[k[:6]], k[6]
        assert [known(r[f"{x}_pics_clpp_{n}"]) for n in ("max", "max_neglogp")] == [known(score), known(p)]
        assert known(r[f"{x}_pics_clpp_max_nhb"]) == (known(score - tops[(*k[:5], x)]) if score > -math.inf else None)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString().split("Generate explode(_found")[0]


def test_a_piece_of_a_region_is_no_smaller_than_a_task(spark):
    """Each piece gets a copy of the genes near its region, so smaller pieces would shuffle more genes for the same task."""
    assert distance.PIECE_PAIRS >= distance.TASK_PAIRS
