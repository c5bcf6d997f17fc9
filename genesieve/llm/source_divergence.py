"""How far the sources of a language differ in their words: exact integer divergences between term distributions.

Each task counts terms with Arrow's compute functions: texts are lower-cased, split and
dictionary-encoded, and a hash group-by over codes makes (language, source, term) partial
counts with the number of documents. Spark adds these up. The kept terms are dealt into
shards by a hash of the term; a shard holds all counts of its terms as columns, next to the totals of its language's
sources, and computes its part of every divergence. What shards return is added and ranked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise

#: Between terms: every ASCII character that isn't a letter.
SEPARATORS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
UNIT = 1_000_000_000
#: Text bytes that are split at once, and partial counts that a task holds before it passes them on.
CHUNK_BYTES, HELD_ROWS = 8 << 20, 500_000
#: Counts of a shard, and cells of a dense piece of it.
SHARD_ROWS, PIECE_CELLS = 100_000, 1 << 20
COUNTS = pa.schema([("lang", pa.large_string()), ("source", pa.large_string()), ("term", pa.large_string()), ("n", pa.int64()), ("docs", pa.int64())])


def count_terms(lang: pa.Array, source: pa.Array, text: pa.Array) -> pa.Table:
    """Per (lang, source, term): occurrences and documents. A null term counts the group's documents, with or without terms."""
    langs, sources = lang.dictionary_encode(), source.dictionary_encode()
    split = pc.split_pattern_regex(pc.ascii_lower(text), SEPARATORS)
    row, term = pc.list_parent_indices(split), pc.list_flatten(split)
    real = pc.not_equal(term, "")
    row, terms = row.filter(real), term.filter(real).dictionary_encode()
    each = pa.table({"row": row, "term": terms.indices}).group_by(["row", "term"], use_threads=False).aggregate([([], "count_all")])
    each = each.append_column("lang", langs.indices.take(each["row"])).append_column("source", sources.indices.take(each["row"]))
    sums = each.group_by(["lang", "source", "term"], use_threads=False).aggregate([("count_all", "sum"), ("count_all", "count")])
    found = [langs.dictionary.take(sums["lang"]), sources.dictionary.take(sums["source"]), terms.dictionary.take(sums["term"]), sums["count_all_sum"], sums["count_all_count"]]
    groups = pa.table({"lang": langs.indices, "source": sources.indices}).group_by(["lang", "source"], use_threads=False).aggregate([([], "count_all")])
    none = pa.nulls(len(groups), pa.string())
    seen = [langs.dictionary.take(groups["lang"]), sources.dictionary.take(groups["source"]), none, pa.array(np.zeros(len(groups), np.int64)), groups["count_all"]]
    return pa.concat_tables([pa.table(c, names=COUNTS.names).cast(COUNTS) for c in (found, seen)])


def _merged(parts: list[pa.Table]) -> pa.Table:
    sums = pa.concat_tables(parts).group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return pa.table([sums["lang"], sums["source"], sums["term"], sums["n_sum"], sums["docs_sum"]], schema=COUNTS)


def _chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``CHUNK_BYTES`` of text; a longer text is a run of its own. They are copies: Arrow casts and splits slices that start inside a buffer wrongly."""
    ends = np.cumsum(pc.binary_length(batch.column(2)).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        until = max(at + 1, int(np.searchsorted(ends, before + CHUNK_BYTES, "right")))
        yield batch.take(pa.array(range(at, until)))
        at = until


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    rows = 0
    for batch in batches:
        for run in _chunks(batch):
            held.append(count_terms(*run.columns))
            rows += len(held[-1])
            if rows > HELD_ROWS:
                held = [_merged(held)]
                rows = len(held[0])
                if rows > HELD_ROWS // 2:
                    yield from held[0].to_batches()
                    held, rows = [], 0
    if held:
        yield from _merged(held).to_batches()


def shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(UNIT * (count + 2) / total), exact for totals up to 9e15: long division by three digits at a time."""
    rest, out = (count + 2) % total, (count + 2) // total
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // total, rest % total
    return 1 + out


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _shard(top: int):
    """(lang, source, part, item, value) of one shard: sums over its terms of each pair of sources, and each source's ``top`` terms."""

    def work(kept: pa.Table, groups: pa.Table) -> pa.Table:
        groups = groups.sort_by("source")
        names, totals = groups["source"].to_pylist(), groups["total"].to_numpy()
        size, v = len(names), groups["v"].to_numpy()
        lang = groups["lang"][0].as_py()
        sums = np.zeros((size, size), np.int64)
        best: list[list[tuple[int, bytes, str]]] = [[] for _ in names]
        if len(kept):
            coded = kept["term"].combine_chunks().dictionary_encode()
            terms, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            source = pc.index_in(kept["source"], value_set=groups["source"].combine_chunks()).to_numpy()
            count, order = kept["n"].to_numpy(), np.argsort(code, kind="stable")
            code, source, count = code[order], source[order], count[order]
            # a plain total of the language is that of its sources
            below, whole = totals + 2 * v, totals.sum() + 2 * v[0]
            step = max(1, PIECE_CELLS // size)
            for first in range(0, len(terms), step):
                a, b = np.searchsorted(code, (first, first + step))
                dense = np.zeros((size, min(step, len(terms) - first)), np.int64)
                dense[source[a:b], code[a:b] - first] = count[a:b]
                p, q = shares(dense, below[:, None]), shares(dense.sum(0), whole)
                for i in range(size):
                    sums[i] += divergence(p[i], p).sum(1)
                    at = np.flatnonzero((dense[i] > 0) & (p[i] > q))
                    value = divergence(p[i][at], q[at])
                    if len(at) > top:
                        least = np.partition(value, -top)[-top]
                        at, value = at[value >= least], value[value >= least]
                    best[i] += [(-int(x), terms[first + j].encode(), terms[first + j]) for x, j in zip(value, at, strict=True)]
                    best[i] = sorted(best[i])[:top]
        rows = [(lang, names[i], "pair", names[j], int(sums[i, j])) for i in range(size) for j in range(size) if i != j]
        rows += [(lang, names[i], "term", term, -value) for i in range(size) for value, _, term in best[i]]
        kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int64())
        return pa.table([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["lang", "source", "part", "item", "value"])

    return work


def source_divergence(docs: DataFrame, least_docs: int = 10, top: int = 10, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank. Part ``pair``: the divergence from each other source of the language;
    part ``term``: the ``top`` terms that the source has more of than its language.

    Terms are runs of ASCII letters (lower-cased) and characters beyond ASCII; those in at least ``least_docs`` documents of a
    language count there. Null texts, languages and sources are empty ones; every row is a document, whatever its id, and repeated rows count
    each. A source without terms has shares like any other; a language without a kept term has divergences of 0. A text of any length is
    split whole. Ties are broken by the item's UTF-8 bytes. Other columns are ignored, whatever their names; an empty
    table gives an empty result. A task holds one run of texts, one shard, or the totals of a language's sources.
    """
    blank = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))]
    partial = docs.select(*blank).mapInArrow(_count_task, "lang string, source string, term string, n long, docs long")
    counts = partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    # a language's term is marked once, at its first source, so that marks count terms
    counts = counts.withColumns({"seen": F.sum("docs").over(term), "first": F.row_number().over(term.orderBy("source")) == 1})
    kept = materialise(counts.where(F.col("term").isNull() | (F.col("seen") >= least_docs)), "terms")

    real = F.col("term").isNotNull()
    groups = kept.groupBy("lang", "source").agg(F.sum(F.when(real, F.col("n")).otherwise(0)).alias("total"), F.count_if(real & F.col("first")).alias("firsts"))
    groups = groups.select("lang", "source", "total", F.sum("firsts").over(Window.partitionBy("lang")).alias("v"))
    shards = max(1, -(-kept.count() // SHARD_ROWS))
    dealt = kept.where(real).select("lang", F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int").alias("shard"), "source", "term", "n")
    everywhere = groups.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    everywhere = everywhere.toDF(*everywhere.columns)  # columns of its own, apart from those of ``dealt``
    parts = dealt.groupBy("lang", "shard").cogroup(everywhere.groupBy("lang", "shard")).applyInArrow(_shard(top), "lang string, source string, part string, item string, value long")
    parts = materialise(parts, "divergences")

    place = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    pairs = parts.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value")).withColumn("rank", F.row_number().over(place))
    terms = parts.where("part = 'term'").withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)
    return pairs.unionByName(terms)
