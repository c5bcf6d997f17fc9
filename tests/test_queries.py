"""Every query with SQL against DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

from genesieve.plans import registry
from genesieve.schema import LOCUS_GENE, feature_sets
from genesieve.sources import star

SF = "/root/testdata/sf0.001"
SQL = registry.oracle_sql()


def canonical(rows):
    def one(v):
        if v is None or v != v:
            return "~"
        if isinstance(v, float):
            return f"{v:.6g}"
        return str(v)

    return sorted(tuple(one(v) for v in r) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("orders", "lineitem", "part"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    other = duck.execute(f"SELECT {', '.join(f'\"{c}\"' for c in columns)} FROM ({SQL[name]})").fetchall()
    got = df.select(*columns).collect()
    assert len(got) == len(other)
    floats = [i for i, c in enumerate(columns) if dict(df.dtypes)[c] == "double"]
    other = [tuple(float(v) if i in floats and v is not None else v for i, v in enumerate(r)) for r in other]
    assert canonical(got) == canonical(other)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_trained_scores_are_held_out(spark):
    """Eleven feature sets of the matrix: every row is scored once a set, by the model of the fold that holds its chromosome."""
    out = registry.queries()["trained_scores"](spark, SF)
    rows = out.select(*LOCUS_GENE, "training_ft", "training_fold", "y_proba").collect()
    assert rows and all(0 <= r["y_proba"] <= 1 and not math.isnan(r["y_proba"]) for r in rows)
    assert all(r["chrom"] in r["training_fold"].split("=")[1].split("|") for r in rows)
    keys = [(r["training_ft"], *[r[c] for c in LOCUS_GENE]) for r in rows]
    n = registry.queries()["feature_matrix"](spark, SF).count()
    assert len(keys) == len(set(keys)) == 11 * n and {k[0] for k in keys} == set(feature_sets())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_importances_and_parameters_are_those_of_trained_models(spark):
    used = registry.queries()["model_importances"](spark, SF).collect()
    by_model = {}
    for r in used:
        by_model.setdefault((r["ft"], r["fold"]), []).append(r)
    assert len(by_model) == 55
    for (ft, _), rows in by_model.items():
        assert {r["feature"] for r in rows} == set(feature_sets()[ft])
        total = sum(r["importance"] for r in rows)
        assert abs(total - 1) < 1e-3 or (total == 0 and all(r["splits"] == 0 for r in rows))
    chosen = registry.queries()["model_parameters"](spark, SF).collect()
    assert sum(r["n"] for r in chosen if r["parameter"] == "max_depth") == 5


@pytest.mark.parametrize("name", ["qtl_prepare", "completeness"])
def test_partitions_grow_with_the_lines(spark, monkeypatch, name):
    """Laid out by keys, the tables of a query have as many partitions as keep one small, and the same rows."""
    rows = lambda df: sorted(map(str, df.collect()))
    want = rows(registry.queries()[name](spark, SF))
    monkeypatch.setattr(star, "PART_LINES", 500)
    found = star.Star(spark, SF)
    assert found.parts == -(-found["lineitem"].count() // 500) > spark.sparkContext.defaultParallelism
    for view in ("lines", "qtl_sums", "tags", "fm_qtl", "predictions"):
        assert found[view].rdd.getNumPartitions() == found.parts, view
    assert rows(registry.queries()[name](spark, SF)) == want


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_only_loci_with_gold_meet_genes_for_training(spark):
    from genesieve.operators import distance, labels
    from genesieve.plans import queries

    s = star.Star(spark, SF)
    chosen = labels.choose_gold(queries._gold(s))
    found = queries._gold_pairs(s, chosen)
    columns = [*LOCUS_GENE, "dist_foot_sentinel_nbh", "dist_tss_sentinel_nbh", *labels.LABELS]
    every = labels.label_genes(distance.sentinel_distances(s["loci"], s["genes"]), chosen, s["coloc_network"])
    want = canonical(every.where("gold_standard_status IS NOT NULL").select(*columns).collect())
    assert canonical(found.select(*columns).collect()) == want and want
