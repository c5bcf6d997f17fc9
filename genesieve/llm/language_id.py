"""Language ID: a bidirectional gated recurrent network over bytes, trained in numpy.

A text's UTF-8 bytes are cut into runs of ``RUN`` bytes; both directions of the
network read each run, every position gets a probability for each language, and a
document's probabilities are the means over its positions. Runs are independent,
so a text of any length is read whole, in blocks of bounded memory, thousands of
runs at a time.

Training is by backpropagation through time (Adam) on the driver, over runs from a
bounded sample: at most ``per_lang`` documents of each language, chosen by a hash,
and ``runs_per_doc`` runs of each. The byte embedding and the input weights
are one table, as a one-hot input needs no more.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType
from pyspark.sql.window import Window

RUN = 64
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


@dataclass
class Network:
    """Weights; x* are (256, 3h) tables by byte, u* (h, 3h), b* (3h,), in the order update, reset, candidate."""

    langs: list[str]
    params: dict[str, np.ndarray]
    #: Predictions below this score are not to be believed.
    least_score: float = 0.0

    @property
    def hidden(self) -> int:
        return self.params["uf"].shape[0]


def new_network(langs: list[str], hidden: int, seed: int) -> Network:
    rng = np.random.default_rng(seed)
    p: dict[str, np.ndarray] = {}
    for d in "fb":
        p[f"x{d}"] = rng.normal(0, 0.3, (256, 3 * hidden))
        p[f"u{d}"] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden))
    p["w"] = rng.normal(0, 1 / np.sqrt(2 * hidden), (2 * hidden, len(langs)))
    p["c"] = np.zeros(len(langs))
    return Network(langs, {k: v.astype(np.float32) for k, v in p.items()})


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _direction(p: dict, d: str, runs: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """States (RUN, n, h) of one direction over byte runs (RUN, n); what the way back needs, if ``keep``."""
    x, u = p[f"x{d}"], p[f"u{d}"]
    h = u.shape[0]
    steps, n = runs.shape
    states, kept = np.empty((steps, n, h), np.float32), []
    state = np.zeros((n, h), np.float32)
    # update, reset and candidate apart, so that every array below is contiguous
    xz, xr, xc = (np.ascontiguousarray(x[:, i * h : (i + 1) * h]) for i in range(3))
    uz, ur, uc = (np.ascontiguousarray(u[:, i * h : (i + 1) * h]) for i in range(3))
    for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
        byte = runs[t].astype(np.intp)
        z = state @ uz
        z += xz.take(byte, axis=0)
        _sigmoid(z)
        r = state @ ur
        r += xr.take(byte, axis=0)
        _sigmoid(r)
        old = state
        reset = r * old
        c = reset @ uc
        c += xc.take(byte, axis=0)
        np.tanh(c, out=c)
        state = states[t]
        np.subtract(old, c, out=state)
        state *= z
        state += c
        if keep:
            kept.append((t, z, r, c, old, reset))
    return states, kept


def position_probabilities(net: Network, runs: np.ndarray) -> np.ndarray:
    """(RUN, n, langs) for byte runs (RUN, n)."""
    p, h = net.params, net.hidden
    forward, backward = _direction(p, "f", runs, False)[0], _direction(p, "b", runs, False)[0]
    logits = forward @ p["w"][:h] + backward @ p["w"][h:] + p["c"]
    logits -= logits.max(axis=2, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=2, keepdims=True)
    return logits


def loss_and_gradients(net: Network, runs: np.ndarray, valid: np.ndarray, target: np.ndarray) -> tuple[float, dict]:
    """Mean cross-entropy over valid positions, and its gradients by backpropagation through time."""
    p, h = net.params, net.hidden
    passes = {d: _direction(p, d, runs, True) for d in "fb"}
    both = np.concatenate([passes["f"][0], passes["b"][0]], axis=2)
    logits = both @ p["w"] + p["c"]
    logits -= logits.max(axis=2, keepdims=True)
    prob = np.exp(logits)
    prob /= prob.sum(axis=2, keepdims=True)
    total = valid.sum()
    own = np.take_along_axis(prob, np.broadcast_to(target[None, :, None], (*runs.shape, 1)), 2)[:, :, 0]
    loss = float(-(np.log(own + 1e-9) * valid).sum() / total)
    dl = prob
    dl[:, np.arange(len(target)), target] -= 1
    dl *= (valid / total)[:, :, None]
    g = {"w": np.tensordot(both, dl, ((0, 1), (0, 1))), "c": dl.sum((0, 1))}
    dboth = dl @ p["w"].T
    for d, part in (("f", dboth[:, :, :h]), ("b", dboth[:, :, h:])):
        u = p[f"u{d}"]
        gx, gu = np.zeros_like(p[f"x{d}"]), np.zeros_like(u)
        carry = np.zeros_like(part[0])
        for t, z, r, c, old, reset in reversed(passes[d][1]):
            ds = part[t] + carry
            dc = ds * (1 - z) * (1 - c * c)
            dz = ds * (old - c) * z * (1 - z)
            dreset = dc @ u[:, 2 * h :].T
            dr = dreset * old * r * (1 - r)
            dzr = np.concatenate([dz, dr], axis=1)
            gu[:, : 2 * h] += old.T @ dzr
            gu[:, 2 * h :] += reset.T @ dc
            # sum rows that read the same byte
            da = np.concatenate([dzr, dc], axis=1)
            order = np.argsort(runs[t], kind="stable")
            seen, first = np.unique(runs[t][order], return_index=True)
            gx[seen] += np.add.reduceat(da[order], first, axis=0)
            carry = ds * z + dreset * r + dzr @ u[:, : 2 * h].T
        g[f"x{d}"], g[f"u{d}"] = gx, gu
    return loss, g


def to_runs(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte runs (RUN, n) padded with zero bytes, and which positions are real."""
    buffer = np.frombuffer(b"".join(x.ljust(RUN, b"\0") for x in pieces), np.uint8).reshape(-1, RUN)
    lengths = np.array([len(x) for x in pieces])
    return np.ascontiguousarray(buffer.T), (np.arange(RUN)[:, None] < lengths[None, :]).astype(np.float32)


def train(samples: list[tuple[str, bytes]], hidden: int = 12, epochs: int = 6, batch: int = 256, rate: float = 0.01, seed: int = 7, min_steps: int = 150) -> Network:
    """``samples``: (language, run of at most RUN bytes). Small sets are gone over more often, for ``min_steps`` steps at least."""
    langs = sorted({lang for lang, _ in samples})
    net = new_network(langs, hidden, seed)
    if len(langs) < 2:
        return net
    rng = np.random.default_rng(seed)
    runs, valid = to_runs([x for _, x in samples])
    target = np.array([langs.index(lang) for lang, _ in samples])
    m = {k: np.zeros_like(v) for k, v in net.params.items()}
    s = {k: np.zeros_like(v) for k, v in net.params.items()}
    step, epoch = 0, 0
    while epoch < epochs or step < min_steps:
        order = rng.permutation(len(target))
        for at in range(0, len(order), batch):
            pick = order[at : at + batch]
            _, g = loss_and_gradients(net, runs[:, pick], valid[:, pick], target[pick])
            norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
            step += 1
            for k, v in net.params.items():
                gk = g[k] * min(1.0, 1.0 / (norm + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * gk
                s[k] = 0.99 * s[k] + 0.01 * gk * gk
                v -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        epoch += 1
    return net


def document_probabilities(net: Network, texts: list[bytes], block: int = 1024) -> np.ndarray:
    """(documents, langs): mean over all positions; zeros for an empty text. Memory is bounded by ``block`` runs."""
    counts = np.array([-(-len(x) // RUN) for x in texts])
    total = np.zeros((len(texts), len(net.langs)))
    owner = np.repeat(np.arange(len(texts)), counts)
    joined = np.frombuffer(b"".join(x.ljust(c * RUN, b"\0") for x, c in zip(texts, counts.tolist(), strict=True)), np.uint8).reshape(-1, RUN)
    last = np.cumsum(counts) - 1
    real = np.full(len(joined), RUN)
    some = counts > 0
    lengths = np.array([len(x) for x in texts])
    real[last[some]] = lengths[some] - (counts[some] - 1) * RUN
    for at in range(0, len(joined), block):
        runs = np.ascontiguousarray(joined[at : at + block].T)
        prob = position_probabilities(net, runs)
        short = np.flatnonzero(real[at : at + block] < RUN)
        if len(short):
            prob[:, short] *= (np.arange(RUN)[:, None] < real[at : at + block][short][None, :])[:, :, None]
        np.add.at(total, owner[at : at + block], prob.sum(axis=0))
    return total / np.maximum(lengths, 1)[:, None]


def sample_runs(docs: DataFrame, per_lang: int, runs_per_doc: int, id_col: str, text_col: str, lang_col: str) -> list[tuple[str, list[bytes]]]:
    """(language, runs of RUN bytes) of the ``per_lang`` documents of each language whose hash of id and text is least.

    What reaches the driver is bounded by that and the number of languages. A first
    cut by the hash leaves about twice as many rows as wanted to be ranked.
    """
    body = F.col(text_col).cast("binary")
    chosen = docs.where(F.col(lang_col).isNotNull() & (F.octet_length(body) > 0))
    counts = {r["lang"]: r["n"] for r in chosen.groupBy(F.col(lang_col).cast("string").alias("lang")).agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, 2 * per_lang / n))).otherwise(share)
    drawn = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)), F.lit(1 << 40))
    chosen = chosen.select(F.col(lang_col).cast("string").alias("lang"), drawn.alias("h"), F.octet_length(body).alias("n"), body.alias("body")).where(F.col("h") < share * float(1 << 40))
    starts = [F.pmod(F.hash("h", F.lit(i)), F.greatest(F.col("n") - RUN + 1, F.lit(1))) + 1 for i in range(runs_per_doc)]
    runs = chosen.select("lang", "h", F.array(*[F.substring(F.col("body"), s, F.lit(RUN)) for s in starts]).alias("runs"))
    least = Window.partitionBy("lang").orderBy("h", "runs")
    rows = runs.withColumn("_rank", F.row_number().over(least)).where(F.col("_rank") <= per_lang).collect()
    return [(lang, own) for lang, _, own in sorted((r["lang"], r["h"], [bytes(x) for x in r["runs"]]) for r in rows)]


def train_on(docs: DataFrame, per_lang: int = 1500, runs_per_doc: int = 4, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options: object) -> Network:
    """A network trained on the sample, with the least score at which a prediction is to be believed (``least_score``)."""
    sample = sample_runs(docs, per_lang, runs_per_doc, id_col, text_col, lang_col)
    net = train([(lang, x) for lang, own in sample for x in own], **options)
    return calibrate(net, sample)


def calibrate(net: Network, sample: list[tuple[str, list[bytes]]], lost: float = 0.001) -> Network:
    """Set ``least_score``: how sure the network is to be, whatever it predicts.

    Over the sampled documents (their runs pooled) it is the score that a share of ``lost`` stays below, halfway
    to that of a network that knows nothing, so that texts like the labelled ones stay.
    """
    if len(net.langs) < 2 or not sample:
        return net
    best = np.sort(document_probabilities(net, [b"".join(own) for _, own in sample]).max(axis=1))
    blind = 1 / len(net.langs)
    return replace(net, least_score=float((best[int(lost * len(best))] + blind) / 2))


def predict(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] | None = None, names: tuple[str, str] = ("lang_pred", "score"), block_bytes: int = 1 << 20) -> DataFrame:
    """doc_id, lang_pred, score: the likeliest language and its pooled probability; ``und`` and 0 for a text without a letter.

    Null and empty texts have no letter. Texts of any length are read whole. Of equally likely languages the first
    by name is taken. Rows that repeat an id, or have none, are judged each; an
    empty table gives an empty result. If nothing was learned (no labelled row), every
    text is ``und``. With ``keep``, those columns of ``docs`` are returned in place of doc_id;
    ``names`` are those of the two new columns. Other columns are ignored, whatever their names.
    """

    def judge(texts: list[str | None]) -> Iterator[tuple[str, float]]:
        bodies = [t.encode("utf-8") if t and LETTER.search(t) else b"" for t in texts]
        prob = document_probabilities(net, bodies) if net.langs else np.zeros((len(bodies), 1))
        for body, best, row in zip(bodies, prob.argmax(axis=1).tolist(), prob, strict=True):
            yield (net.langs[best], min(1.0, float(row[best]))) if body and net.langs else (UNKNOWN, 0.0)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, pending, size = [], [], 0
            for value in batch.column(text_at):
                pending.append(value.as_py())
                size += len(pending[-1] or "")
                if size >= block_bytes:
                    found += judge(pending)
                    pending, size = [], 0
            if pending:
                found += judge(pending)
            arrays = [*batch.columns[extra:], pa.array([x for x, _ in found], pa.string()), pa.array([y for _, y in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    kept = {"doc_id": F.col(id_col).cast("long")} if keep is None else {c: F.col(c) for c in keep}
    # names of their own inside, as a kept column may have any
    sent = [c.alias(f"kept{i}") for i, c in enumerate(kept.values())]
    if keep and text_col in keep and isinstance(docs.schema[text_col].dataType, StringType):
        # texts are most of a batch, so they are sent once
        rows, text_at, extra = docs.select(*sent), keep.index(text_col), 0
    else:
        rows, text_at, extra = docs.select(F.col(text_col).cast("string").alias("text"), *sent), 0, 1
    schema = StructType([*rows.schema.fields[extra:], StructField("lang", StringType()), StructField("sure", DoubleType())])
    judged = rows.mapInArrow(work, schema)
    return judged.select(*[F.col(f"kept{i}").alias(c) for i, c in enumerate(kept)], F.col("lang").alias(names[0]), F.col("sure").alias(names[1]))


def held_out(id_col: str = "doc_id") -> Column:
    """Documents kept from training: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
