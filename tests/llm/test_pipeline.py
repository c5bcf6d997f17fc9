"""The pipeline's stages against plain Python on a small fixture."""

import random

import corpus_pipeline
from genesieve.llm.near_dedup import NearSettings, similarity

from .helpers import DOCS, empty, odd


def test_stages(spark, tmp_path):
    rng = random.Random(8)
    make = lambda lang, n: " ".join(rng.choice({"en": ["the", "and", "thing", "ing", "tion"], "de": ["der", "und", "keit", "schein", "lich"]}[lang]) + rng.choice(["", "a", "b"]) for _ in range(n))
    base = [(i, make("en" if i % 2 else "de", rng.choice([30, 200])), "en" if i % 2 else "de", "s", 1) for i in range(60)]
    rows = base + [(100 + i, base[i][1], base[i][2], "t", 1) for i in range(5)]
    long = [r for r in base if len(r[1].split()) == 200][:6]
    rows += [(200 + i, r[1].replace(r[1].split()[50], "edited", 1), r[2], "t", 1) for i, r in enumerate(long)]
    rows += [(300, None, "en", "s", 0), (301, "123 456", "en", "s", 7), (302, "mail me a@b.com " + make("en", 40), "en", "s", 1)]
    mixed = " ".join(x for pair in zip(base[0][1].split()[:30], base[1][1].split()[:30]) for x in pair)
    rows += [(303, mixed, None, "s", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    ids = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, "unused")
        assert docs.columns == before.columns
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        ids[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert {r[0] for r in rows} - set(ids["language_id"]) == {300, 301, 303}
    best = {}
    for i, t in ids["language_id"].items():
        best[t] = max(i, best.get(t, i))
    assert set(ids["exact_dedup"]) == set(best.values())
    left, s = sorted(ids["exact_dedup"].items()), NearSettings()
    lost = {b for a, x in left for b, y in left if a < b and similarity(x, y, s) >= s.similarity}
    assert set(ids["near_dedup"]) == set(ids["exact_dedup"]) - lost and lost
    assert set(ids["pii"]) == set(ids["near_dedup"]) and "<email>" in ids["pii"][302] and "@" not in ids["pii"][302]
    assert all(ids["pii"][i] == t for i, t in ids["near_dedup"].items() if i != 302)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "unused").collect()
    assert {r["doc_id"] for r in packed} == set(ids["pii"])


CLASH = ("lang_pred", "score", "_text", "_row", "_lang", "_sure", "keep_id", "kept", "class_id", "_kept0", "_new", "piece")


def test_odd_rows_and_clashing_columns(spark):
    left = {}
    for clash in ((), CLASH):
        for name, stage in corpus_pipeline.STAGES:
            docs = odd(spark, clash)
            out = stage(spark, docs, "unused")
            assert name == "packing" or out.columns == docs.columns
            left[name, clash] = sorted((r["doc_id"] for r in out.collect()), key=str)
    assert all(left[name, ()] == left[name, CLASH] for name, _ in corpus_pipeline.STAGES)
    assert set(left["language_id", ()]) >= {4, 6, 7} and not {1, 2, 3} & set(left["language_id", ()])
    # of 6, 7 and 7 again, one row stays; null and empty are one text
    assert left["exact_dedup", ()] == sorted([2, 3, 4, 5, 7, 8, None], key=str)
    assert left["near_dedup", ()] == sorted([1, 2, 3, 4, 5, 6, 8, None], key=str)
    assert len(left["pii", ()]) == 10


def test_null_and_repeated_ids(spark):
    long = " ".join(f"w{i}" for i in range(300))
    other = long.replace("w7 ", "edited ")
    rows = [(None, long), (None, long), (9, "first text"), (9, "second text"), (5, other), (5, other), (None, "alone")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    once = lambda out: sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    exact = once(corpus_pipeline.exact_copies(spark, docs, "unused"))
    assert exact == sorted(set(rows), key=str)
    near = once(corpus_pipeline.near_copies(spark, docs, "unused"))
    assert near == sorted([(5, other), (9, "first text"), (9, "second text"), (None, "alone")], key=str)


def test_empty_table(spark):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty(spark), "unused").count() == 0
