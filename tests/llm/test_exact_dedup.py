import hashlib
import random

import pytest

from genesieve.llm.exact_dedup import exact_dedup

from .helpers import DOCS, empty, odd


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    best = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(((i, best[t or ""], len(groups[t or ""]), i == best[t or ""], hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows), key=str)


def result(df, digit):
    return sorted(map(tuple, exact_dedup(df, first_digit=digit).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


@pytest.mark.parametrize("digit", [1, 64])
def test_odd_rows(spark, digit):
    df = odd(spark, ("_rest", "_n", "_max", "keep_id", "_digit"))
    assert result(df, digit) == brute([(r["doc_id"], r["text"]) for r in df.collect()])


def test_prefixes_of_one_another(spark):
    rng = random.Random(3)
    texts = ["ab" * n for n in range(0, 400, 7)] + ["ab" * 150 + x for x in "abc"] + ["é" * 90, "é" * 90 + "e"]
    rows = [(i, rng.choice(texts), None, None, None) for i in range(300)]
    assert result(spark.createDataFrame(rows, DOCS), 3) == brute([r[:2] for r in rows])


def test_empty_table(spark):
    assert exact_dedup(empty(spark)).count() == 0


def test_null_and_repeated_ids(spark):
    long = "x" * 1000
    rows = [(None, long), (None, long), (4, long + "y"), (4, long + "z"), (4, long + "z"), (4, "")]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    assert result(df, 64) == brute(rows)
    keyed = spark.createDataFrame([(i, t, None, None, None, k) for k, (i, t) in enumerate(rows)], DOCS + ", k long")
    found = {r["k"]: r["kept"] for r in exact_dedup(keyed, row_col="k").collect()}
    assert found == {0: False, 1: True, 2: True, 3: False, 4: True, 5: True}
