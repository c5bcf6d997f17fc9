import hashlib
import random
import re

import pytest

from pyspark.sql import functions as F

from genesieve.llm.pii import KINDS, Model, added_of, digest, find_spans, redact, train, weak_lines

from .helpers import DOCS, empty, odd

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0


def passes(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.split(".")), "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]


def base(text):
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k in KINDS for m in re.finditer(PATTERNS[k], text or "") if passes(k, m.group()))


@pytest.fixture(scope="module")
def model(spark):
    return train(spark)


def frame(spark, texts):
    return spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)


def test_base_spans_equal_the_patterns(spark, model):
    rng = random.Random(5)
    parts = ["a", "1", "2", ".", "@", "+", " ", "-", "(", ")", "é", "😀", "12", "555", "4111 1111 1111 1111", "a@b.co", "1.2.3.4", "_", "\n", "%"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(1500)]
    texts += [None, "", "1" * 20_000, "a" * 40_000, "1.2.3.4 " * 1500, "4111 1111 1111 1111, " * 600, "a@b.com_c@d.org", "000255.1.1.1 256.1.1.1 1.2.3.4.5.6.7.8"]
    for r in digest(find_spans(frame(spark, texts), model)).collect():
        want = base(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in KINDS] == [sum(x.startswith(k) for x in want.split(",")) for k in KINDS]
        assert set(filter(None, want.split(","))) <= set(r["spans"].split(","))


FOUND = {"call 2125550187 soon": "phone", "mail joe at example.org now": "email", "host 2001:db8::1 up": "ip", "please call (212) 555-0187 now": "phone", "tel 212-555-0187": "phone", "write to bob [at] example [dot] com ok": "email", "card 4111.1111.1111.1111 ok": "card", "kim77 at example dot net hi": "email", "ip 2001:0db8:85a3:0000:0000:8a2e:0370:7334 x": "ip"}
CLEAN = ["serial 2125550187 soon", "look at this.that one", "a::b c", "order 2021-03-04 done", "version 1.2.3 build", "meet at noon dot then", "id 7663683147833396 x", "at 12:30:45:10", "plain words only", "total 12.345.678 units"]


def test_the_method_adds_spans(spark, model):
    rows = digest(find_spans(frame(spark, list(FOUND)), model)).collect()
    assert {list(FOUND)[r["doc_id"]]: r["spans"].split(":")[0] for r in rows} == FOUND
    assert all(r["spans"] == "" for r in digest(find_spans(frame(spark, CLEAN), model)).collect())


def test_added_spans_are_precise_and_complete(spark, model):
    rng = random.Random(9)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    words = lambda n: " ".join(rng.choice(["river", "stone", "walk", "green", "often", "paper"]) for _ in range(n))

    def card():
        return next(x for x in iter(lambda: ".".join(digits(4) for _ in range(4)), None) if luhn(x.replace(".", "")))

    texts, truth = [], []
    for i in range(400):
        kind, form = rng.choice([
            ("phone", f"({digits(3)}) {digits(3)}-{digits(4)}"), ("phone", f"{digits(3)}-{digits(3)}-{digits(4)}"), ("email", f"{rng.choice(['ann', 'bob'])}{digits(2)} [at] example [dot] com"), ("email", f"tom{digits(2)} at example dot net"), ("card", card()),
            (None, f"20{digits(2)}-{digits(2)}-{digits(2)}"), (None, f"{digits(2)}.{digits(3)}.{digits(3)}"), (None, "meet at noon dot then"), (None, digits(12)), (None, f"{digits(2)}:{digits(2)}:{digits(2)}:{digits(2)}"),
        ])
        lead = words(8)
        texts.append(f"{lead} {form} {words(5)}")
        truth.append(f"{kind}:{len(lead) + 1}:{len(lead) + 1 + len(form)}" if kind else "")
    rows = digest(find_spans(frame(spark, texts), model)).collect()
    found = {(r["doc_id"], x) for r in rows for x in r["spans"].split(",") if x}
    true = {(i, x) for i, x in enumerate(truth) if x}
    assert len(found & true) >= 0.9 * len(true) and len(found & true) >= 0.9 * len(found)


def test_overlapping_added_spans(spark):
    """A beats B, which beats C; A and C are apart, so both stay. The same rule in plain Python over random spans."""
    rng = random.Random(2)
    model = Model(0.0, (), 1.0, 0.0, {k: 0.0 for k in KINDS})
    cases = [[(0, 10, 0.9), (5, 15, 0.8), (12, 20, 0.7)]] + [[(s := rng.randrange(60), s + rng.randrange(1, 12), rng.random()) for _ in range(rng.randrange(1, 9))] for _ in range(200)]

    def greedy(spans):
        out = []
        for s, e, p in sorted(spans, key=lambda x: (-x[2], x[0] - x[1], x[0])):
            if all(e <= a or s >= b for a, b in out):
                out.append((s, e))
        return sorted(out)

    sure = spark.createDataFrame([(i, [(s, e, False, p, "phone") for s, e, p in c]) for i, c in enumerate(cases)], "i int, sp array<struct<s:bigint,e:bigint,base:boolean,p:double,kind:string>>")
    rows = sure.select("i", F.expr(added_of("sp")).alias("added")).collect()
    assert model.thresholds and all([(x["s"], x["e"]) for x in r["added"]] == greedy(cases[r["i"]]) for r in rows)


def test_weak_lines_come_from_the_documents(spark):
    texts = ["call +1 (212) 555-0187 or mail a.b@c.org and 4111 1111 1111 1111 ok 4111 1111 1111 1112 no"] * 3
    rows = {(r["_text"], r["label"]) for r in weak_lines(frame(spark, texts)).collect()}
    assert any("(212) 555-0187" in t and "+" not in t and y == 1 for t, y in rows) and any("a.b " in t and " c dot org" in t and y == 1 for t, y in rows)
    assert any("4111.1111.1111.1112" in t and y == 0 for t, y in rows) and any("4111.1111.1111.1111" in t and y == 1 for t, y in rows)


def test_a_text_of_very_many_spans(spark, model):
    text = "tel (212) 555-0187, " * 10_000 + "a@b.co " * 10_000
    found = digest(find_spans(frame(spark, [text]), model)).first()
    assert found["n_email"] == 10_000 and found["spans"].count("phone:") == 10_000
    assert redact(frame(spark, [text]), model).first()["text"] == "tel <phone>, " * 10_000 + "<email> " * 10_000


def test_redaction(spark, model):
    texts = ["mail a@b.com, call +1 (212) 555-0187!", "none", None, "+4111 1111 1111 1111 x"]
    out = {r["doc_id"]: r["text"] for r in redact(frame(spark, texts), model).collect()}
    assert out[0] == "mail <email>, call <phone>!" and out[1] == "none" and out[2] is None
    assert not re.search("[0-9]", out[3]) and out[3].endswith(" x")


def test_odd_rows(spark, model):
    df = odd(spark, ("email", "added", "_all", "spans", "_keep_text"))
    assert digest(find_spans(df, model)).count() == 10
    out = redact(df, model)
    assert out.columns == df.columns and out.count() == 10
    assert sorted(map(str, out.collect())) == sorted(map(str, df.collect()))
    assert redact(empty(spark), model).count() == 0 and digest(find_spans(empty(spark), model)).count() == 0
