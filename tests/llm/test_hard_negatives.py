"""Hard negatives against all inner products in plain Python, and the bounds against true scores."""

import math
import random

import numpy as np
import pytest

from genesieve.llm.hard_negatives import angles_to, mine_hard_negatives, reference_directions, score_bounds

DDL = "vec_id long, embedding array<double>, label int"


def brute(rows, every=100, share=80):
    used = []
    for place, (i, vec, label) in enumerate(rows):
        if label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        used.append((place, i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, [math.floor(256 * x) for x in vec]))
    order = lambda s: (-s[0], s[2] is None, s[2] or 0, s[1])
    out = []
    for place, i, label, vec in used:
        if i is None or i % every:
            continue
        scores = [(sum(x * y for x, y in zip(vec, v, strict=True)), p, j, lab) for p, j, lab, v in used if p != place and len(v) == len(vec)]
        for ps, _, pid, _ in sorted((s for s in scores if s[3] == label), key=order)[:5]:
            fits = sorted((s for s in scores if s[3] != label and share * ps <= 100 * s[0] <= 100 * ps), key=order)[:5]
            out += [(i, pid, n, s[2], ps, s[0]) for n, s in enumerate(fits, 1)]
    return sorted(map(str, out))


def found(spark, rows, **more):
    df = spark.createDataFrame(rows, DDL).coalesce(1)
    got = mine_hard_negatives(df, **more).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()
    return sorted(str(tuple(r)) for r in got)


def vectors(n, seed=1, dims=12, spread=0.4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(10, dims))
    rows = []
    for i in range(n):
        v = centres[i % 10] + spread * rng.normal(size=dims)
        rows.append((i, (v / np.linalg.norm(v) * (1 + (i % 3) / 4)).tolist(), int(rng.integers(10)) if i % 4 == 0 else i % 10))
    return rows


@pytest.mark.parametrize("group_rows,block_anchors", [(4096, 8192), (70, 3)])
def test_equals_all_inner_products(spark, group_rows, block_anchors):
    rows = vectors(900)
    want = brute(rows, every=20)
    assert len(want) > 300 and found(spark, rows, anchor_every=20, group_rows=group_rows, block_anchors=block_anchors) == want


def test_ties_copies_and_a_hot_vector(spark):
    rng = random.Random(2)
    rows = [(i, [1.0, 0.5, 0.25], rng.randrange(3)) for i in range(300)] + [(300 + i, [round(rng.random(), 1) for _ in range(3)], rng.randrange(3)) for i in range(200)]
    assert found(spark, rows, group_rows=64) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (0, [0.5, 0.5], 1), (100, [0.5, 0.4], 1), (200, None, 1), (300, [0.1, None], 1), (400, [float("nan"), 1.0], 1), (500, [float("inf"), 1.0], 2), (600, [0.1, 0.2], None),
        (1, [0.5, 0.5], 2), (2, [0.5, 0.45], 3), (None, [0.5, 0.5], 2), (None, [0.45, 0.5], 1), (0, [0.5, 0.49], 1), (0, [0.5, 0.5], 2), (3, [], 1), (700, [], 2), (701, [], 3), (800, [0.0, 0.0], 4),
        (4, [0.0, 0.0], 4), (5, [-0.5, -0.5], 4), (900, [0.5], 1), (6, [0.4], 1), (8, [0.5], 2), (1000, [-1.0, -1.0], 9), (9, [1.0, 1.0], 9), (10, [-1.0, -0.9], 8),
    ]
    want = brute(rows)
    assert want and found(spark, rows) == want
    assert mine_hard_negatives(spark.createDataFrame([], DDL)).count() == 0


def test_scores_beyond_doubles_are_exact(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice((1e6, 1e6 + 1 / 256, 3e6, -2e6)) for _ in range(3)], i % 3) for i in range(120)]
    want = brute(rows)
    assert want and found(spark, rows) == want
    assert found(spark, [(i, [1e300, -1e300], i % 2) for i in range(101)]) is not None


def test_clashing_names(spark):
    rows = vectors(200)
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], f"{DDL}, dims string, score string").withColumnsRenamed({"dims": "norm", "score": "row"}).coalesce(1)
    got = mine_hard_negatives(df).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()
    assert sorted(str(tuple(r)) for r in got) == brute(rows)


def test_bounds_hold(spark):
    rng = np.random.default_rng(5)
    whole = np.floor(256 * rng.normal(size=(400, 8)))
    whole[0], whole[1] = 0, whole[2]
    norms = np.linalg.norm(whole, axis=1)
    stored = angles_to(whole, norms, reference_directions(whole, 6)).astype("<f4").astype(np.float64)
    for i in range(40):
        low, high = score_bounds(stored[i], norms[i], stored.T, norms)
        true = whole @ whole[i]
        assert (low <= true).all() and (true <= high).all()
        assert (high - low).mean() < 1.9 * norms[i] * norms.mean() + 3
