"""The command lines from raw tables to wide scores, and the streaming addition, on the smallest tables."""

import os

import pytest
from pyspark.sql import functions as F

from genesieve import cli
from genesieve.operators.evidence import evidence_features
from genesieve.schema import EVIDENCE_COLUMNS, LOCUS_GENE
from genesieve.sources.star import Star
from genesieve.streaming.rescore import latest, score_stream

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def run(*args):
    parsed = cli.parser().parse_args(args)
    parsed.run(parsed)


def raw_tables(s, root):
    traits = s["study_traits"].groupBy("study_id").agg(F.collect_set("trait").alias("trait_efos"))
    nested = s["transcripts"].groupBy(F.col("chrom").alias("chrom_b38"), F.col("pos").alias("pos_b38"), "ref", "alt").agg(F.struct(F.collect_list(F.struct("gene_id", "transcript_id", "polyphen_score")).alias("transcript_consequences")).alias("vep"))
    synonyms = s["synonyms"].groupBy("gene_id").agg(F.collect_list("synonym").alias("gene_synonyms"))
    parquet = {
        "studies": s["study_list"].join(traits, "study_id", "left"), "toploci": s["toploci_raw"], "pics": s["pics_raw"], "coloc": s["coloc_raw"],
        "contacts": s["contacts"].withColumnRenamed("tissue", "bio_feature"), "annotation": nested.withColumns({"locus": F.lit("l"), "alleles": F.array(F.col("ref")), "locus_GRCh38": F.lit("g")}),
    }
    kinds = F.when(F.col("type_id") == "F", "dhscor").when(F.col("type_id") == "O", "fantom5")
    json = {
        "fine_mapping": s["fm_raw"], "phenotypes": s["phenotype_lut"], "v2g": s["v2g_raw"].withColumn("type_id", kinds), "genes": s["genes_raw"].withColumnsRenamed({"gene_start": "start", "gene_end": "end"}),
        "synonyms": s["genes_raw"].select("gene_name", "gene_id").join(synonyms, "gene_id", "left"),
    }
    for name, df in parquet.items():
        df.write.parquet(f"{root}/raw/{name}")
    for name, df in json.items():
        df.write.json(f"{root}/raw/{name}")
    s["string_links"].write.csv(f"{root}/raw/links", sep=" ", header=True)
    s["string_aliases"].write.csv(f"{root}/raw/aliases", sep="\t", header=True)
    empty = F.lit(0.0)
    s["attenuation"].select(F.col("gene_name").alias("gene"), empty.alias("a"), empty.alias("b"), empty.alias("c"), empty.alias("d"), F.col("value").alias("attenuation"), F.lit("x").alias("class")).write.csv(f"{root}/raw/attenuation", header=True)


def test_stage_and_features(spark, tmp_path):
    s, root = Star(spark, SF), str(tmp_path)
    raw_tables(s, root)
    run("stage", "--root", root, "--version", "v", "--fix_study", "S7", "--fix_traits", "EFO_fixed")
    run("features", "--root", root, "--version", "v", "--buckets", "4")
    run("between_loci", "--root", root, "--version", "v")
    assert [r["trait_efos"] for r in spark.read.parquet(f"{root}/v/staged/studies").where("study_id = 'S7'").collect()] == [["EFO_fixed"]]
    between = spark.read.parquet(f"{root}/v/features/interlocus")
    assert {"interlocus_study_unweighted", "interlocus_trait_both_weighted"} <= set(between.columns)
    assert between.count() == between.select(*LOCUS_GENE).distinct().count()
    m = spark.read.parquet(f"{root}/v/features/matrix")
    assert m.count() == m.select(*LOCUS_GENE).distinct().count() > 0
    assert {"vep_ave", "pchicJung_max", "eqtl_pics_clpp_max", "proteinAttenuation", "has_sumstats", "count_credset_95"} <= set(m.columns)
    variants = spark.read.parquet(f"{root}/v/staged/variants")
    assert variants.columns[:2] == ["chrom", "pos"] and variants.count() > 0


def test_gold(spark, tmp_path):
    k5, keys = ("S1", "1", 3, "A", "G"), "study_id string, chrom string, pos bigint, ref string, alt string"
    tables = {
        "features": spark.createDataFrame([(*k5, g, 0.5) for g in ("G1", "G2", "G3")], keys + ", gene_id string, x double"),
        "clusters": spark.createDataFrame([(*k5, "c")], keys + ", cluster_label string"),
        "toploci": spark.createDataFrame([(*k5, 8.0)], keys + ", neglog_p double"),
        "string": spark.createDataFrame([("G3", "G1", 0.95, "1", "1")], "gene_id_1 string, gene_id_2 string, string_score double, gene_1_chrom string, gene_2_chrom string"),
    }
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}")
    line = '{"association_info": {"otg_id": "%s"}, "sentinel_variant": {"locus_GRCh38": {"chromosome": "1", "position": 3}, "alleles": {"reference": "A", "alternative": "G"}}, "gold_standard_info": {"gene_id": "G1", "highest_confidence": "High"}, "metadata": {"set_label": "%s"}}\n'
    with open(f"{tmp_path}/gs.json", "w") as f:
        f.write(line % ("S1", "a") + line % ("S2", "b"))
    outs = [x for name in ("full", "training", "log") for x in (f"--out_{name}", f"{tmp_path}/{name}")]
    run("gold", *[x for name in tables for x in (f"--in_{name}", f"{tmp_path}/{name}")], "--in_gs", f"{tmp_path}/gs.json", *outs)
    status = {r["gene_id"]: r["gold_standard_status"] for r in spark.read.parquet(f"{tmp_path}/full").collect()}
    assert status == {"G1": 1, "G2": 0, "G3": -1} and spark.read.parquet(f"{tmp_path}/training").count() == 2
    report = {tuple(r) for r in spark.read.csv(f"{tmp_path}/log", header=True).collect()}
    assert report == {("p_value", "a", "1", "0"), ("p_value", "b", "0", "1"), ("cluster", "a", "1", "0"), ("chosen", "a", "1", "0"), ("labelled", "a", "1", "2")}


def test_wide(spark, tmp_path):
    s = Star(spark, SF)
    s["predictions"].write.parquet(f"{tmp_path}/long")
    run("wide", "--in_long", f"{tmp_path}/long", "--out_l2g", f"{tmp_path}/wide", "--exclude_studies", "S3")
    out = spark.read.parquet(f"{tmp_path}/wide")
    assert "y_proba_full_model" in out.columns and out.where("study_id = 'S3'").count() == 0 < out.count()


def test_stream_equals_batch(spark, tmp_path):
    s = Star(spark, SF)
    names = EVIDENCE_COLUMNS["vep"]
    one, two = s["tags"].where("pos % 2 = 0"), s["tags"].where("pos % 2 = 1")
    evidence = s["evidence"].persist()
    for part in (one, two):
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(s["tags"].schema).parquet(f"{tmp_path}/in")
        score_stream(stream, evidence, names, f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()
    got = latest(spark.read.parquet(f"{tmp_path}/out").drop("run")).drop("batch")
    want = evidence_features(s["tags"], evidence, names)
    assert got.count() == want.count() and got.select(*LOCUS_GENE).exceptAll(want.select(*LOCUS_GENE)).count() == 0
