import random

import numpy as np
import pytest

from genesieve.llm import near_dedup
from genesieve.llm.near_dedup import NearSettings, dart_sketches, near_duplicates, shingle_weights, similarity

from genesieve.sources import scratch

from .helpers import DOCS, empty, odd

S = NearSettings()


def classes(df):
    return {r["doc_id"]: r["class_id"] for r in near_duplicates(df).collect()}


def brute(rows):
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, x in rows:
        for b, y in rows:
            if a < b and similarity(x or "", y or "", S) >= S.similarity:
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: find(i) for i, _ in rows}


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def test_classes_equal_brute_force(spark):
    rng = random.Random(11)
    rows, i = [], 0
    for family in range(12):
        words = [f"v{rng.randrange(5000)}" for _ in range(rng.choice([40, 120, 400]))]
        for _ in range(rng.choice([1, 2, 6, 30])):
            i += 1
            rows.append((i, edited(rng, words, rng.randrange(0, 5)), None, None, None))
    assert classes(spark.createDataFrame(rows, DOCS)) == brute([r[:2] for r in rows])


def test_odd_rows(spark):
    df = odd(spark, ("digest", "keys", "key", "class_id", "_text")).where("doc_id is not null").dropDuplicates(["doc_id"])
    found = classes(df)
    assert found[6] == found[7] == 6 and all(found[i] == i for i in (1, 2, 3, 4, 5, 8))


def test_repeats_and_null_ids(spark):
    found = near_duplicates(odd(spark, ("_row", "node", "kept"))).select("doc_id", "class_id", "class_size", "kept").collect()
    rows = sorted((tuple(r) for r in found), key=str)
    assert [r for r in rows if r[0] in (6, 7)] == [(6, 6, 3, True), (7, 6, 3, False), (7, 6, 3, False)]
    assert [r for r in rows if r[0] is None] == [(None, None, 1, True)] and len(rows) == 10


def test_one_id_with_two_texts(spark):
    one, two = (" ".join(f"{x}{i}" for i in range(60)) for x in "xy")
    rows = [(1, one), (1, two), (2, one), (2, two), (None, two), (None, "alone"), (None, "alone")]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    found = sorted((tuple(r) for r in near_duplicates(df).select("doc_id", "class_id", "class_size", "kept").collect()), key=str)
    want = [(1, 1, 2, True), (1, 1, 3, True), (2, 1, 2, False), (2, 1, 3, False), (None, 1, 3, False), (None, None, 2, False), (None, None, 2, True)]
    assert found == want


@pytest.mark.parametrize("small", [0, 10**9])
def test_classes_do_not_depend_on_what_counts_as_small(spark, monkeypatch, small):
    """A large near-copy group, with the plans of small and of large tables: both are brute force's classes."""
    monkeypatch.setattr(near_dedup, "SMALL_SKETCHES", small)
    monkeypatch.setattr(scratch, "SMALL_ROWS", small)
    rng = random.Random(5)
    words = [f"v{rng.randrange(5000)}" for _ in range(150)]
    rows = [(i, edited(rng, words, rng.randrange(0, 7)), None, None, None) for i in range(250)]
    assert classes(spark.createDataFrame(rows, DOCS)) == brute([r[:2] for r in rows])


def test_empty_table(spark):
    assert near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("weights", ["set", "count"])
def test_sketches_estimate_similarity(weights):
    rng = np.random.default_rng(2)
    s = NearSettings(bands=200, rows=6, weights=weights)
    pool = rng.integers(0, 2**63, 900).astype(np.uint64)
    count = lambda n: rng.integers(1, 9, n) if weights == "count" else np.ones(n)
    a, wa = pool[:600], count(600)
    b, wb = pool[200:], count(700)
    _, i, j = np.intersect1d(a, b, return_indices=True)
    low = np.minimum(wa[i], wb[j]).sum()
    true = low / (wa.sum() + wb.sum() - low)
    x, y = dart_sketches([(a, wa), (b, wb)], s)
    assert abs((x == y).mean() - true) < 0.06


def test_fractional_weights_and_tiny_sets():
    s = NearSettings(weights="count")
    x = (np.array([5], np.uint64), np.array([0.25]))
    a, b = dart_sketches([x, (np.array([5, 9], np.uint64), np.array([0.25, 0.01]))], s)
    assert (a == b).mean() > 0.85


def test_shingles():
    assert len(shingle_weights("a b c d e f", 5)[0]) == 2
    assert len(shingle_weights("a b", 5)[0]) == 1 and len(shingle_weights("  ", 5)[0]) == 0
    assert similarity("a b c", "A  B\nC", S) == 1.0


ONE = NearSettings(shingle=1, bands=1, rows=1)


def replaced(words, n, at, name):
    """``words`` with ``n`` of them, from place ``at`` on, made its own."""
    return [f"{name}-{i}" if at <= i < at + n else w for i, w in enumerate(words)]


def in_one_bucket(make):
    """The word lists of the first of make("s0"), make("s1") ... that share the only bucket there is."""
    for seed in range(2000):
        made = make(f"s{seed}")
        sets = [shingle_weights(" ".join(words), 1)[:1] for words in made]
        if len(np.unique(dart_sketches([(x[0], np.ones(len(x[0]))) for x in sets], ONE))) == 1:
            return [(i + 1, " ".join(words), None, None, None) for i, words in enumerate(made)]
    raise AssertionError("no such texts")


def hub(members, outsiders):
    """Copies of one text, and for the first of them another that is similar to that copy alone."""

    def make(seed):
        text = [f"{seed}w{i}" for i in range(200)]
        main = [replaced(text, 8, 2 * j, f"{seed}m{j}") for j in range(members)]
        return main + [replaced(main[j], 16, 180, f"{seed}o{j}") for j in range(outsiders)]

    return in_one_bucket(make)


def one_bucket_classes(spark, rows):
    found = {r["doc_id"]: r["class_id"] for r in near_duplicates(spark.createDataFrame(rows, DOCS), ONE).collect()}
    sets = {r[0]: set(r[1].split()) for r in rows}
    linked = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= ONE.similarity
    return found, [(a, b) for a in sets for b in sets if a < b and linked(a, b)]


def test_outsider_linked_to_one_member_of_the_main_class(spark):
    rows = hub(14, 5)
    found, links = one_bucket_classes(spark, rows)
    assert all(sum(a == i or b == i for a, b in links) == 1 for i in range(15, 20))
    assert set(found.values()) == {1}


def test_no_member_of_a_large_main_class_is_dropped(spark):
    rows = hub(60, 20)
    found, _ = one_bucket_classes(spark, rows)
    assert set(found.values()) == {1}
    small = NearSettings(shingle=1, bands=1, rows=1, block=7)
    assert {r["class_id"] for r in near_duplicates(spark.createDataFrame(rows, DOCS), small).collect()} == {1}


def test_every_pair_of_a_bucket_of_many_classes_is_compared(spark):
    def make(seed):
        shared = [f"{seed}w{i}" for i in range(130)]
        ones = [shared + [f"{seed}p{j}-{i}" for i in range(70)] for j in range(20)]
        return ones + [replaced(words, 10, 190, f"{seed}t{j}") for j, words in enumerate(ones)]

    found, links = one_bucket_classes(spark, in_one_bucket(make))
    assert links == [(j, j + 20) for j in range(1, 21)]
    assert all(found[a] == found[b] == a for a, b in links)
