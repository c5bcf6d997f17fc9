import random

import numpy as np

from genesieve.llm.language_id import RUN, document_probabilities, held_out, loss_and_gradients, new_network, predict, to_runs, train, train_on

from .helpers import DOCS, empty, odd

WORDS = {"en": "the of and with that thing ing tion".split(), "de": "der die und keit schein lich über ge".split()}


def corpus(n, seed):
    rng = random.Random(seed)
    langs = [rng.choice(list(WORDS)) for _ in range(n)]
    return [(i, " ".join(rng.choice(WORDS[x]) for _ in range(rng.randrange(3, 60))), x, "s", 1) for i, x in enumerate(langs)]


def test_gradients_equal_differences():
    net = new_network(["a", "b", "c"], 4, 0)
    net.params = {k: v.astype(np.float64) for k, v in net.params.items()}
    runs, valid = to_runs([b"hello world" * 5, b"abc", "été".encode()])
    target, rng = np.array([0, 1, 2]), random.Random(0)
    _, g = loss_and_gradients(net, runs, valid, target)
    for k, v in net.params.items():
        for _ in range(3):
            at = (ord("l"), rng.randrange(12)) if k[0] == "x" else tuple(rng.randrange(n) for n in v.shape)
            v[at] += 1e-3
            up = loss_and_gradients(net, runs, valid, target)[0]
            v[at] -= 2e-3
            down = loss_and_gradients(net, runs, valid, target)[0]
            v[at] += 1e-3
            assert abs((up - down) / 2e-3 - g[k][at]) < 2e-4


def test_held_out_accuracy(spark):
    df = spark.createDataFrame(corpus(600, 1), DOCS)
    net = train_on(df.where(~held_out()), per_lang=150, runs_per_doc=1, epochs=3)
    rows = predict(df, net, keep=("doc_id", "lang")).where(held_out()).collect()
    assert len(rows) > 80 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)
    assert all(0.5 <= r["score"] <= 1 for r in rows)


def test_blocks_and_batches_do_not_matter():
    net = train([("en", b"the of and"), ("de", b"der die das")], min_steps=5)
    texts = [b"", b"x" * (3 * RUN), b"abc", "ä".encode() * 77, b"y" * (RUN + 1)]
    whole = document_probabilities(net, texts)
    assert np.allclose(whole, document_probabilities(net, texts, block=2), atol=1e-5)
    assert np.allclose(whole[2], document_probabilities(net, [texts[2]])[0], atol=1e-5)
    assert whole[0].sum() == 0 and np.allclose(whole[1:].sum(axis=1), 1, atol=1e-4)


def test_odd_rows(spark):
    net = train([("en", b"the of and with"), ("de", b"der die und das")], min_steps=20)
    rows = predict(odd(spark, ("lang_pred_", "score_", "_text")), net).collect()
    assert len(rows) == 10 and {r["lang_pred"] for r in rows if r["doc_id"] in (1, 2, 3)} == {"und"}
    assert all(r["lang_pred"] in ("en", "de") for r in rows if r["doc_id"] in (4, 5, 6, 7, 8, None))


def test_nothing_to_learn_from(spark):
    net = train_on(empty(spark))
    assert predict(empty(spark), net).count() == 0
    assert {r["lang_pred"] for r in predict(odd(spark), net).collect()} == {"und"}


def test_held_out_rule(spark):
    import zlib

    rows = spark.range(200).select("id", held_out("id").alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in rows)


def test_texts_are_read_in_little_memory(spark):
    """Texts that are kept are sent once, and a task's arrays don't grow with the texts."""
    import tracemalloc

    net = new_network(["a", "b", "c", "d"], 12, 1)
    docs = spark.createDataFrame([(1, "some text", "a"), (2, None, "b"), (3, "ü" * 300, "c")], "doc_id long, text string, lang string")
    kept = predict(docs, net, keep=("doc_id", "text", "lang"), names=("p", "s"))
    sent = kept._jdf.queryExecution().optimizedPlan().toString().split("MapInArrow")[1].splitlines()[1]
    assert sent.count("text") + sent.count("kept1") <= 2
    other = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in predict(docs, net).collect()}
    assert {r["doc_id"]: (r["p"], r["s"]) for r in kept.collect()} == other and {r["doc_id"]: r["text"] for r in kept.collect()}[3] == "ü" * 300
    texts = [b"word " * 4000] * 100
    tracemalloc.start()
    document_probabilities(net, texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20e6
