import random
import re

import pytest

from genesieve.llm.quality_rules import RULES, ablations, apply_policy, ledger, policy_mask

from .helpers import DOCS, empty, odd


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = {w for w in windows if windows.count(w) > 1}
    hit = {p for i, w in enumerate(windows) if w in many for p in (i, i + 1, i + 2)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit)


def measured(df):
    return [(r["doc_id"], (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])) for r in ledger(df).collect()]


def test_measurements_equal_brute_force(spark):
    rng = random.Random(4)
    texts = {i: "".join(rng.choice(["a", "b", " ", "\n", "\t", "#", "é", "　", "a b a b ", "x\n", "\x0b", "\x1f"]) for _ in range(rng.randrange(60))) for i in range(500)}
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in texts.items()], DOCS)
    assert dict(measured(df)) == {i: brute(t) for i, t in texts.items()}


def test_odd_rows(spark):
    df = odd(spark, ("words", "lines", "failed", "_text", "_windows"))
    got = sorted(measured(df), key=str)
    want = sorted(((r["doc_id"], brute(r["text"]) if r["doc_id"] != 5 else (20_000, 80_000, 0, 0, 20_000)) for r in df.collect()), key=str)
    assert got == want
    assert ledger(empty(spark)).count() == 0


def test_policies_and_ablations(spark):
    good = " ".join(f"word{i} is here" for i in range(40))
    rows = [(1, good), (2, "short"), (3, "#### " * 30 + good), (4, "a b c " * 60), (5, "\n".join(["same line again and again"] * 12 + [good]))]
    led = ledger(spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS))
    first = {r["doc_id"]: r["kept"] for r in apply_policy(led, 1).collect()}
    second = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in apply_policy(led, 2).collect()}
    assert first == {1: True, 2: False, 3: True, 4: False, 5: True} and second[1] == (False, True) and second[2] == (True, False)
    report = {r["rule"]: (r["n_rows"], r["n_failed"], r["n_only"]) for r in ablations(led, 2).collect()}
    assert set(report) == {r.name for r in RULES} and report["too_few_words"][0] == 5
    rejected = sum(not k for _, k in second.values())
    assert all(only <= failed <= rejected for _, failed, only in report.values())


@pytest.mark.parametrize("version", [1, 2])
def test_masks(version):
    assert policy_mask(version) & policy_mask(1) == policy_mask(1)
