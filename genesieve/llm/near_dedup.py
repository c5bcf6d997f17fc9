"""Near-duplicate classes by DartMinHash and a banded join.

Sketching. A document is a weighted set of word shingles. Each shingle's region is cut
into strips by weight, [0, 1), [1, 2), [2, 4) and so on; hashed darts arrive in a strip in
order of rank, as a Poisson process that is the same in every document. Darts whose
weight lies below the shingle's and whose rank lies below a threshold (a fixed
expected number of darts over the document's weight) are thrown to ``coordinates``
by their hash, and the dart of least rank stays in each. A document with an empty
coordinate is thrown again with twice the threshold. Two documents agree in a
coordinate with the probability of their weighted Jaccard similarity.

Joining. Consecutive coordinates form bands. Buckets (documents that agree in a band)
are not expanded into pairs of rows: members are compared with one member of
their bucket, and with one of those that also agree in the next band. These comparisons
are estimated from the sketches first; what may reach the bound is verified on the
shingle sets of the whole texts. In every bucket that then spans several classes, all
pairs of different classes are compared, in blocks and on the shingle sets. So two documents
that share a bucket and are similar enough are always in one class.

Copies (equal words) are one document for all of this and share its class.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genesieve.operators.components import linked_components

from .common import compact, free_name, materialise, with_row_key

GOLDEN, MIX_A, MIX_B = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
#: So many sketches (of 200 bytes, so 8 MB) are broadcast; more are joined by shuffling. Results don't depend on it.
SMALL_SKETCHES = 40_000
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
LOW = np.uint64(0xFFFFFFFF)


@dataclass(frozen=True)
class NearSettings:
    shingle: int = 5
    similarity: float = 0.8
    bands: int = 32
    rows: int = 6
    #: Darts expected a coordinate, beyond its logarithm.
    spare: float = 3.0
    #: Estimates below this are not verified among the first comparisons; the closing ones estimate nothing.
    verify_from: float = 0.68
    #: Members of a bucket, about, that are compared with as many of its outsiders in one group.
    block: int = 256
    weights: str = "set"  # or "count": a shingle weighs as often as it occurs

    @property
    def coordinates(self) -> int:
        return self.bands * self.rows


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, in place."""
    x ^= x >> np.uint64(30)
    x *= MIX_A
    x ^= x >> np.uint64(27)
    x *= MIX_B
    x ^= x >> np.uint64(31)
    return x


class _WordHashes(dict):
    MOST = 500_000

    def __missing__(self, word: str) -> int:
        value = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        if len(word) <= 64:
            if len(self) >= self.MOST:
                self.clear()
            self[word] = value
        return value


_words = _WordHashes()


def shingle_weights(text: str, shingle: int) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Distinct shingle hashes, how often each occurs, and a digest of the words.

    Words are lower-cased and parted by white space; fewer than ``shingle`` words make one shingle.
    """
    words = text.lower().split()
    hashes = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    if not words:
        return hashes, hashes.astype(np.int64), b""
    digest = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
    n = max(1, len(words) - shingle + 1)
    total = np.zeros(n, np.uint64)
    for i in range(min(shingle, len(words))):
        total *= GOLDEN
        total += mix(hashes[i : i + n] + np.uint64(i))
    return (*np.unique(mix(total), return_counts=True), digest)


def dart_sketches(sets: list[tuple[np.ndarray, np.ndarray]], s: NearSettings) -> np.ndarray:
    """(documents, coordinates) of 32-bit dart names, for non-empty weighted sets."""
    k = s.coordinates
    out = np.zeros((len(sets), k), np.uint32)
    todo, factor = np.arange(len(sets)), 1.0
    while len(todo):
        sizes = np.array([len(sets[i][0]) for i in todo])
        elements = np.concatenate([sets[i][0] for i in todo])
        weights = np.concatenate([sets[i][1] for i in todo]).astype(np.float32)
        owner = np.repeat(np.arange(len(todo)), sizes)
        heavy = np.add.reduceat(weights, np.cumsum(sizes) - sizes)
        limit = (factor * k * (np.log(k) + s.spare) / heavy).astype(np.float32)
        best = np.full(len(todo) * k, NONE)
        strip, low, width = 0, 0.0, 1.0
        alive = np.arange(len(elements))
        while len(alive):
            _throw(elements[alive], weights[alive], owner[alive], limit, strip, low, width, k, best)
            strip, low, width = strip + 1, low + width, max(1.0, low + width)
            alive = alive[weights[alive] > low]
        best = best.reshape(len(todo), k)
        full = (best != NONE).all(axis=1)
        out[todo[full]] = (best[full] & LOW).astype(np.uint32)
        todo, factor = todo[~full], factor * 2
    return out


def _throw(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, limit: np.ndarray, strip: int, low: float, width: float, k: int, best: np.ndarray) -> None:
    """Throw the darts of one strip: ``best`` keeps, by document and coordinate, (rank, name) of the least rank."""
    seeds = mix(elements + np.uint64((strip + 1) * int(GOLDEN) % 2**64))
    base, bound = owner * k, limit[owner]
    rank = np.zeros(len(elements), np.float32)
    count = 0
    partial = width > 1.0 or bool((weights < low + width).any())
    while len(seeds):
        count += 1
        h = mix(seeds + np.uint64(count * int(GOLDEN) % 2**64))
        u = ((h >> np.uint64(40)).astype(np.float32) + np.float32(0.5)) * np.float32(2**-24)
        rank -= np.log(u) / np.float32(width)
        inside = np.flatnonzero(rank <= bound)
        if not len(inside):
            break
        seeds, base, bound, rank, h, weights = (x[inside] for x in (seeds, base, bound, rank, h, weights))
        name = h & LOW
        packed = (rank.view(np.uint32).astype(np.uint64) << np.uint64(32)) | name
        at = base + ((name * np.uint64(k)) >> np.uint64(32)).astype(np.int64)
        if partial:
            v = low + width * (mix(h + GOLDEN) >> np.uint64(40)).astype(np.float64) * 2**-24
            hit = v < weights
            np.minimum.at(best, at[hit], packed[hit])
        else:
            np.minimum.at(best, at, packed)


def band_keys(sketches: np.ndarray, s: NearSettings) -> np.ndarray:
    """(documents, bands) of signed 64-bit bucket names."""
    parts = sketches.reshape(len(sketches), s.bands, s.rows).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, s.bands + 1, dtype=np.uint64) * GOLDEN, parts.shape[:2]).copy()
    for i in range(s.rows):
        keys = mix(keys * GOLDEN + parts[:, :, i])
    return keys.view(np.int64)


def sketch_documents(rows: DataFrame, s: NearSettings, block_shingles: int = 300_000) -> DataFrame:
    """For rows of (doc_id, _row, _text): doc_id, _row, digest (binary, null without a word), keys (array<bigint>), sketch (8 bits a coordinate)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(batch: pa.RecordBatch, sets: list, digests: list) -> pa.RecordBatch:
            some = [i for i, x in enumerate(sets) if len(x[0])]
            keys, sketches = [None] * len(sets), [None] * len(sets)
            if some:
                made = dart_sketches([sets[i] for i in some], s)
                for i, row, sketch in zip(some, band_keys(made, s), made.astype(np.uint8), strict=True):
                    keys[i], sketches[i] = row, sketch.tobytes()
            arrays = [batch.column(0), batch.column(1), pa.array([d or None for d in digests], pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "_row", "digest", "keys", "sketch"])

        for batch in batches:
            sets, digests, n, done = [], [], 0, 0
            for i, value in enumerate(batch.column(2)):
                elements, counts, digest = shingle_weights(value.as_py() or "", s.shingle)
                sets.append((elements, counts if s.weights == "count" else np.ones(len(elements))))
                digests.append(digest)
                n += len(elements)
                if n >= block_shingles:
                    yield block(batch.slice(done, i + 1 - done), sets, digests)
                    sets, digests, n, done = [], [], 0, i + 1
            if sets:
                yield block(batch.slice(done), sets, digests)

    key = rows.schema["_row"].dataType.simpleString()
    return rows.select("doc_id", "_row", "_text").mapInArrow(work, f"doc_id long, _row {key}, digest binary, keys array<long>, sketch binary")


def _estimated(pairs: DataFrame, sketches: DataFrame, s: NearSettings) -> DataFrame:
    """The pairs (a, b) whose sketches agree in at least ``verify_from`` of the coordinates."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in (2, 3))
                yield batch.select([0, 1]).filter(pa.array((x == y).mean(axis=1) >= s.verify_from))

    left = sketches.select(F.col("node").alias("a"), F.col("sketch").alias("_x"))
    right = sketches.select(F.col("node").alias("b"), F.col("sketch").alias("_y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "_x", "_y").mapInArrow(work, "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame, s: NearSettings) -> DataFrame:
    """The pairs (a, b) whose similarity over the whole texts reaches the bound."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                keep.append(similarity(x.as_py() or "", y.as_py() or "", s) >= s.similarity)
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    left = texts.select(F.col("node").alias("a"), F.col("_text").alias("_x"))
    right = texts.select(F.col("node").alias("b"), F.col("_text").alias("_y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "_x", "_y").mapInArrow(work, "a long, b long")


def similarity(x: str, y: str, s: NearSettings) -> float:
    (a, na, _), (b, nb, _) = shingle_weights(x, s.shingle), shingle_weights(y, s.shingle)
    if not len(a) or not len(b):
        return 0.0
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if s.weights != "count":
        return len(i) / (len(a) + len(b) - len(i))
    common = np.minimum(na[i], nb[j]).sum()
    return float(common / (na.sum() + nb.sum() - common))


def near_duplicates(docs: DataFrame, settings: NearSettings = NearSettings(), id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """One row per input row: doc_id, class_id (the least id of its class), class_size, kept (exactly one row of a class).

    A class holds rows joined by links of at least ``similarity``; equal words are a link, whatever
    the ids. Null and empty texts, and those without a word, are classes of their own. Rows are told apart by
    their place in the input, or by ``row_col``, a column that no two rows share, which is then returned as well: so null and repeated
    ids are rows like others. The row with the least id stays, the first of equal ids; null ids come last, and a class
    without any other has a null class_id. Texts of any length are read whole. Other columns are ignored, whatever their names;
    an empty table gives an empty result.
    """
    s = settings
    key = row_col or free_name("_row", docs.columns)
    keyed = docs if row_col else with_row_key(docs, key)
    own = keyed.select(F.col(id_col).cast("long").alias("doc_id"), F.col(key).alias("_row"), F.col(text_col).cast("string").alias("_text"))
    sketches = materialise(sketch_documents(own, s), "sketches")
    # equal words are one node, numbered as it is written
    copies = sketches.where("digest is not null").groupBy("digest").agg(F.min("_row").alias("_row")).withColumn("node", F.monotonically_increasing_id())
    copies = materialise(copies, "copies")
    reps = sketches.join(copies.select("_row", "node"), "_row")

    # buckets with at least two members: (key, sub, a); sub names those that also agree in the next band
    rows = reps.select(F.col("node").alias("a"), F.posexplode("keys").alias("i", "key"), "keys")
    rows = rows.select("a", "key", F.xxhash64("key", F.element_at("keys", F.col("i") % s.bands + 1)).alias("sub"))
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("key", F.lit(1).alias("_one"))
    members = materialise(rows.withColumn("_one", F.lit(1)).join(shared, ["key", "_one"], "left_semi").drop("_one"), "members")
    within = copies.join(members.select(F.col("a").alias("node")).distinct(), "node", "left_semi")
    within = materialise(within.select("node", "_row"), "within")
    near = materialise(sketches.join(within, "_row").select("node", "sketch"), "near-sketches")
    if near.count() <= SMALL_SKETCHES:
        near = F.broadcast(near)
    texts = materialise(own.join(within, "_row").select("node", "_text"), "near-texts")

    def tested(pairs: DataFrame, label: str) -> DataFrame:
        return materialise(_verified(materialise(_estimated(pairs, near, s), f"{label}-likely"), texts, s), f"{label}-links")

    pairs = materialise(_with_least(members, "key").unionByName(_with_least(members, "sub")).distinct(), "pairs")
    links = tested(pairs, "first").toDF("u", "v")
    classes = materialise(linked_components(links), "classes")
    rows = members.join(classes.select(F.col("node").alias("a"), "component"), "a", "left").select("a", "key", F.coalesce("component", "a").alias("class"))
    # also buckets of two, whose star may have been ruled out by the estimate alone
    rows = compact(materialise(_open(rows, 2), "open"))
    ends = compact(materialise(_across_classes(rows, texts, s), "class-links"))
    # classes that the new links join: a small graph, whose nodes are classes
    moved = compact(materialise(linked_components(ends.toDF("u", "v")), "moved"))
    step = moved.select(F.col("node").alias("component"), F.col("component").alias("_to"))
    later = classes.join(step, "component", "left").select("node", F.coalesce("_to", "component").alias("component"))
    classes = compact(materialise(later.unionByName(moved.join(classes, "node", "left_anti")), "classes"))

    of_digest = copies.join(classes, "node", "left").select("digest", F.coalesce("component", "node").alias("class"))
    out = materialise(sketches.select("doc_id", "_row", "digest").join(of_digest, "digest", "left").select("doc_id", "_row", "class"), "near-classes")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row"))
    sizes = out.where("class is not null").groupBy("class").agg(F.count(F.lit(1)).alias("_n"), first.alias("_first"))
    sized = out.withColumn("_one", F.lit(1)).join(sizes.withColumn("_one", F.lit(1)), ["class", "_one"], "left")
    alone = F.col("_n").isNull()
    found = sized.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("_first.doc_id")).alias("class_id"),
        F.coalesce("_n", F.lit(1)).cast("long").alias("class_size"),
        (alone | (F.col("_row") == F.col("_first._row"))).alias("kept"),
        "_row",
    )
    return found.withColumnRenamed("_row", row_col) if row_col else found.drop("_row")


def _pair(a: Column, b: Column) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _with_least(members: DataFrame, key: str) -> DataFrame:
    """Each member with one member of its group: the least by a hash of the id, of which there are four."""
    centre = members.groupBy(key).agg(F.min(F.struct(F.xxhash64("a", F.pmod(key, F.lit(4))).alias("h"), F.col("a").alias("c"))).alias("least"), F.lit(1).alias("_one"))
    joined = members.withColumn("_one", F.lit(1)).join(centre, [key, "_one"])
    return joined.where(F.col("a") != F.col("least.c")).select(*_pair(F.col("a"), F.col("least.c")))


def _open(rows: DataFrame, least: int) -> DataFrame:
    """Rows of buckets of at least ``least`` members that span several classes."""
    span = rows.groupBy("key").agg(F.min("class").alias("x"), F.max("class").alias("y"), F.count(F.lit(1)).alias("_n")).where(f"x <> y and _n >= {least}").select("key", F.lit(1).alias("_one"))
    return rows.withColumn("_one", F.lit(1)).join(span, ["key", "_one"], "left_semi").drop("_one")


def _across_classes(rows: DataFrame, texts: DataFrame, s: NearSettings) -> DataFrame:
    """The pairs of classes (a, b) that a bucket holds similar members of: every two members of different classes are compared.

    Outsiders, the members outside a bucket's largest class, meet all members. Both are
    dealt into blocks of about ``s.block``, and each two blocks are a group of their own, so
    a large bucket is many groups. No member is left out, and nothing is estimated.
    """
    sizes = rows.groupBy("key", "class").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.groupBy("key").agg(F.sum("n").alias("n"), F.max(F.struct("n", "class")).alias("main"), F.lit(1).alias("_one"))
    sizes = sizes.select("key", "_one", F.col("main.class").alias("main"), F.ceil(F.col("n") / s.block).alias("i_n"), F.ceil((F.col("n") - F.col("main.n")) / s.block).alias("o_n"))
    outside, hashed = F.col("class") != F.col("main"), F.xxhash64("a", "key")
    as_member = F.transform(F.sequence(F.lit(0), F.col("o_n") - 1), lambda o: F.struct(F.pmod(hashed, "i_n").alias("i"), o.cast("long").alias("o"), F.lit(False).alias("out")))
    as_outsider = F.transform(F.sequence(F.lit(0), F.col("i_n") - 1), lambda i: F.struct(i.cast("long").alias("i"), F.pmod(hashed, "o_n").alias("o"), F.lit(True).alias("out")))
    dealt = rows.withColumn("_one", F.lit(1)).join(sizes, ["key", "_one"]).select("a", "key", "class", F.explode(F.when(outside, F.concat(as_member, as_outsider)).otherwise(as_member)).alias("at"))
    dealt = dealt.select(F.col("a").alias("node"), "key", "class", "at.*").join(texts, "node").select("key", "i", "o", "class", "out", "_text")

    def work(group: pa.Table) -> pa.Table:
        sets = [shingle_weights(text.as_py() or "", s.shingle)[:2] for text in group.column("_text")]
        sizes = np.array([len(x[0]) for x in sets])
        kinds, out = (group.column(c).to_numpy() for c in ("class", "out"))
        known, names = np.unique(np.concatenate([x[0] for x in sets]), return_inverse=True)
        counts = np.concatenate([x[1] for x in sets]) if s.weights == "count" else np.ones(len(names), np.int64)
        starts = np.cumsum(sizes) - sizes
        total = np.add.reduceat(counts, starts)
        found = set()
        for o in np.flatnonzero(out):
            own, at = np.zeros(len(known), np.int64), slice(starts[o], starts[o] + sizes[o])
            own[names[at]] = counts[at]
            common = np.add.reduceat(np.minimum(own[names], counts), starts)
            like = (common / (total + total[o] - common) >= s.similarity) & (kinds != kinds[o])
            found.update((min(k, kinds[o]), max(k, kinds[o])) for k in np.unique(kinds[like]))
        x, y = np.array(sorted(found), np.int64).reshape(-1, 2).T
        return pa.table({"a": pa.array(x), "b": pa.array(y)})

    return dealt.groupBy("key", "i", "o").applyInArrow(work, "a long, b long").distinct()
