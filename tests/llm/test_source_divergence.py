"""Word divergences against counting in plain Python, and the query against its SQL."""

import os
import random
import re
import subprocess
import sys
from collections import Counter, defaultdict

import duckdb
import pyarrow as pa
import pytest

from genesieve.llm import registry, source_divergence as module
from genesieve.llm.source_divergence import shares, source_divergence

from .helpers import DOCS, empty, odd

SF = "/root/testdata/sf0.001"


def brute(rows, least_docs=10, top=10):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))) for _, text, lang, source, _ in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        holds = Counter(t for _, _, terms in mine for t in set(terms))
        kept = sorted((t for t, n in holds.items() if n >= least_docs), key=str.encode)
        counts = defaultdict(Counter)
        for _, source, terms in mine:
            counts[source].update(t for t in terms if holds[t] >= least_docs)
        whole, v = sum(counts.values(), Counter()), len(kept)
        p = {s: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * v) for t in kept} for s, c in counts.items()}
        q = {t: 1 + 10**9 * (whole[t] + 2) // (sum(whole.values()) + 2 * v) for t in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in counts:
            pairs = sorted(((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in counts if o != s))
            terms = sorted((-f(p[s][t], q[t]), t.encode(), t) for t in kept if counts[s][t] > 0 and p[s][t] > q[t])
            out |= {(lang, s, "pair", o, -value, n) for n, (value, _, o) in enumerate(pairs, 1)}
            out |= {(lang, s, "term", t, -value, n) for n, (value, _, t) in enumerate(terms[:top], 1)}
    return out


def found(df, **more):
    rows = source_divergence(df, **more).collect()
    got = {(r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in rows}
    assert len(got) == len(rows)
    return got


def corpus(n=400, seed=3):
    rng = random.Random(seed)
    words = ["The", "the", "Ärger", "ärger", "naïve", "漢字", "x", "İ", "don't", "a1b", "über", "cat", "DOG", "dog", "\x00nul", "tab\tbed", "😀", "a_b", "ONE-two"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = []
    for i in range(n):
        text = None if rng.random() < 0.05 else " ".join(rng.choice(words[: rng.choice((5, 19, len(words)))]) for _ in range(rng.randrange(12)))
        rows.append((i, text, rng.choice(("en", "de", None, "rare" if i < 8 else "en")), rng.choice(("a", "b", None, "", "c" * (i % 3))), 1))
    return rows


def test_equals_counting_in_plain_python(spark):
    rows = corpus()
    assert found(spark.createDataFrame(rows, DOCS).repartition(3)) == brute(rows)


def test_pieces_shards_and_chunks_do_not_matter(spark, monkeypatch):
    rows = corpus(300, 5)
    for name, value in (("CHUNK_BYTES", 200), ("HELD_ROWS", 20), ("SHARD_ROWS", 7), ("PIECE_CELLS", 16)):
        monkeypatch.setattr(module, name, value)
    assert found(spark.createDataFrame(rows, DOCS).repartition(2)) == brute(rows)


def test_ties_long_texts_and_clashing_names(spark):
    rows = [(i, "same words here " + chr(97 + i % 5) * 3, "en", "ab"[i % 2], 1) for i in range(60)] + [(60, "same WORDS " * 50_000 + "z" * 300_000, "en", "c", 1)]
    df = spark.createDataFrame(rows, DOCS)
    want = brute(rows)
    assert found(df.withColumns({c: module.F.lit("clash") for c in ("term", "n", "docs", "shard", "value", "part")})) == want
    assert found(df, top=2) == brute(rows, top=2)


def test_odd_rows_and_empty_table(spark):
    rows = [tuple(r) for r in odd(spark).collect()]
    assert found(odd(spark), least_docs=2) == brute(rows, 2) and found(odd(spark)) == brute(rows)
    assert source_divergence(empty(spark)).count() == 0


def test_shares_are_exact():
    rng = random.Random(1)
    pairs = [(rng.randrange(10**15 // 9), rng.randrange(1, 9 * 10**15)) for _ in range(2000)]
    pairs = [(min(c, t - 2), t) for c, t in pairs if t > 2]
    got = shares(module.np.array([c for c, _ in pairs]), module.np.array([t for _, t in pairs]))
    assert got.tolist() == [1 + 10**9 * (c + 2) // t for c, t in pairs]


def test_slices_inside_a_buffer(spark):
    texts = [f"word{chr(97 + i % 26)} ünd {chr(97 + i % 7)}" * 50 for i in range(3000)]
    batch = pa.RecordBatch.from_arrays([pa.array(["l"] * 3000), pa.array(["s"] * 3000), pa.array(texts)], names=["a", "b", "c"])
    tables = list(module._count_task(iter([batch.slice(500, 2000)])))
    got = {r["term"]: r["n"] for t in tables for r in t.to_pylist()}
    want = Counter(w for t in texts[500:2500] for w in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", t))
    assert {k: v for k, v in got.items() if k is not None} == want


def test_counting_starts_no_threads():
    """Threads of a group-by each hold hash tables of their own, beside the task's."""
    code = """
import os, pyarrow as pa
from genesieve.llm.source_divergence import _count_task
texts = [" ".join(f"w{chr(97 + i % 26)}{chr(97 + j % 26)}{chr(97 + i * j % 26)}" for j in range(300)) for i in range(3000)]
batch = pa.RecordBatch.from_arrays([pa.array(["l"] * 3000), pa.array(["s"] * 3000), pa.array(texts)], names=["a", "b", "c"])
before = len(os.listdir("/proc/self/task"))
assert sum(t.num_rows for t in _count_task(iter([batch]))) > 100
assert len(os.listdir("/proc/self/task")) == before
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.dirname(os.path.dirname(__file__))))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_queries_equal_their_sql(spark, name):
    """All of this folder's queries that SQL can express."""
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = registry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    other = con.execute(f"SELECT {', '.join(f'\"{c}\"' for c in columns)} FROM ({registry.oracle_sql()[name]})").fetchall()
    assert sorted(map(str, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(str, other))
