"""Hard negatives by angular triangle filtering.

Every vector is stored with its norm and its angles to a few reference directions. By the
triangle inequality the angle between two vectors lies between the difference and the sum of
their angles to a reference, so every reference gives an interval for their cosine; times the
norms, and widened by more than rounding can do, it bounds their score. Only rows whose bounds
overlap a wanted window of scores are scored, in integers.

Anchors are a query set against all rows, in blocks: rows and anchors are dealt by a hash into groups
and blocks of a bounded size, and each (group, block) cell is worked on by itself. A first pass over the cells
finds the anchors' positives, a second one negatives in the windows that the positives' scores
open; each returns at most the wanted number per anchor and cell, and windows pick the first of these.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise

#: Rows of a group and anchors of a block.
GROUP_ROWS, BLOCK_ANCHORS = 4096, 8192
#: Reference directions, and the rows that they are fitted on. Results don't depend on them.
REFERENCES, SAMPLE_ROWS = 16, 2000
#: More than angles (radians, stored in single precision) and scores (as a share of the norms' product) are off by rounding.
ANGLE_SLACK, SCORE_SLACK = 1e-5, 1e-6
LONGEST = 2**63 - 1
SCALE = 256


def reference_directions(sample: np.ndarray, n: int = REFERENCES, rounds: int = 5) -> np.ndarray:
    """Unit vectors spread over the sample: farthest points first, then means of what is nearest to each."""
    norms = np.linalg.norm(sample, axis=1)
    unit = sample[norms > 0] / norms[norms > 0, None]
    if not len(unit):
        return np.zeros((0, sample.shape[1]))
    chosen, nearest = [0], unit @ unit[0]
    while len(chosen) < min(n, len(unit)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
    refs = unit[chosen]
    for _ in range(rounds):
        own = np.argmax(unit @ refs.T, axis=1)
        for r in range(len(refs)):
            mean = unit[own == r].sum(0) if (own == r).any() else refs[r]
            length = np.linalg.norm(mean)
            refs[r] = mean / length if length > 0 else refs[r]
    return refs


def angles_to(vectors: np.ndarray, norms: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Rows x references; a vector of length 0 is at right angles to all, as its scores are 0 anyway."""
    cosine = (vectors @ refs.T) / np.where(norms > 0, norms, 1)[:, None]
    return np.arccos(np.clip(cosine, -1, 1))


def score_bounds(angle: np.ndarray, norm: float, angles: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) of the scores of one vector with each row; ``angles`` is references x rows."""
    scale = norm * norms
    slack = SCORE_SLACK * scale + 1
    if not len(angles):
        return -scale - slack, scale + slack
    near = np.abs(angles - angle[:, None]).max(0) - ANGLE_SLACK
    # the smaller way round of t1 + t2 is pi - |pi - (t1 + t2)|
    far = np.pi - np.abs(np.pi - (angles + angle[:, None])).max(0) + ANGLE_SLACK
    return scale * np.cos(np.minimum(far, np.pi)) - slack, scale * np.cos(np.maximum(near, 0)) + slack


class _Side:
    """One side of a cell as arrays."""

    def __init__(self, table: pa.Table) -> None:
        n = len(table)
        self.row, self.label = table["row"].to_numpy(), table["label"].to_numpy()
        self.id = table["vec_id"].to_pylist()
        # null ids come last among equal scores
        self.order = np.array([LONGEST if i is None else i for i in self.id], dtype=np.int64)
        self.null = np.array([i is None for i in self.id], dtype=bool)
        self.whole = np.frombuffer(b"".join(table["vector"].to_pylist()), dtype="<i8").reshape(n, -1)
        self.norm = table["norm"].to_numpy()
        self.angles = np.ascontiguousarray(np.frombuffer(b"".join(table["angles"].to_pylist()), dtype="<f4").reshape(n, -1).T.astype(np.float64))  # references x rows
        self.floats = self.whole.astype(np.float64)
        self.largest = float(np.abs(self.floats).max(initial=0))


def _scores(a: _Side, i: int, rows: _Side, at: np.ndarray) -> np.ndarray:
    """Exact inner products: doubles where every partial sum is a whole number below 2^53, else Python integers, held within 64 bits."""
    if a.largest * rows.largest * a.whole.shape[1] < 2**53:
        return (rows.floats[at] @ a.floats[i]).astype(np.int64)
    own = [int(x) for x in a.whole[i]]
    exact = [sum(x * int(y) for x, y in zip(own, rows.whole[j], strict=True)) for j in at]
    return np.array([max(-LONGEST, min(LONGEST, x)) for x in exact], dtype=np.int64)


def _first(rows: _Side, at: np.ndarray, score: np.ndarray, n: int) -> list[int]:
    """Places in ``at`` of the first ``n``: by score downwards, then id (null last), then row."""
    if len(at) > 4 * n:
        least = np.partition(score, -n)[-n]
        some = np.flatnonzero(score >= least)
    else:
        some = np.arange(len(at))
    order = np.lexsort((rows.row[at[some]], rows.order[at[some]], rows.null[at[some]], -score[some]))
    return some[order[:n]].tolist()


def _by_label(side: _Side) -> dict[int, np.ndarray]:
    order = np.argsort(side.label, kind="stable")
    values, starts = np.unique(side.label[order], return_index=True)
    return {int(v): at for v, at in zip(values, np.split(order, starts[1:]), strict=True)}


def _positives(n: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Of a cell's rows with the anchor's label, those whose upper bound reaches the n-th largest lower bound are scored."""

    def work(row_table: pa.Table, anchor_table: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(row_table) and len(anchor_table):
            rows, anchors = _Side(row_table), _Side(anchor_table)
            labels = _by_label(rows)
            for i in range(len(anchors.row)):
                at = labels.get(int(anchors.label[i]))
                at = at[rows.row[at] != anchors.row[i]] if at is not None else ()
                if not len(at):
                    continue
                if len(at) > n:
                    low, high = score_bounds(anchors.angles[:, i], anchors.norm[i], rows.angles[:, at], rows.norm[at])
                    at = at[high >= np.partition(low, -n)[-n]]
                score = _scores(anchors, i, rows, at)
                out += [(anchors.row[i], anchors.id[i], rows.row[at[j]], rows.id[at[j]], score[j]) for j in _first(rows, at, score, n)]
        return _hits(out, "anchor_id")

    return work


def _negatives(n: int, least_share: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Of a cell's rows with other labels, those whose bounds overlap a positive's window are scored; the first ``n`` in each window are returned."""

    def work(row_table: pa.Table, anchor_table: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(row_table) and len(anchor_table):
            rows, anchors = _Side(row_table), _Side(anchor_table)
            by_angle = [np.argsort(a, kind="stable") for a in rows.angles]
            sorted_angles = [a[o] for a, o in zip(rows.angles, by_angle, strict=True)]
            longest = float(rows.norm.max())
            for i, positives in enumerate(anchor_table["positives"].to_pylist()):
                wanted = [(p["row"], p["vec_id"], p["score"]) for p in positives if p["score"] >= 0]
                if not wanted:
                    continue
                floor = min(-(-least_share * s // 100) for _, _, s in wanted)
                at = _within(anchors.angles[:, i], anchors.norm[i] * longest, floor, by_angle, sorted_angles, len(rows.row))
                at = at[rows.label[at] != anchors.label[i]]
                if not len(at):
                    continue
                low, high = score_bounds(anchors.angles[:, i], anchors.norm[i], rows.angles[:, at], rows.norm[at])
                overlaps = np.zeros(len(at), bool)
                for _, _, s in wanted:
                    overlaps |= (high >= -(-least_share * s // 100)) & (low <= s)
                at = at[overlaps]
                score = _scores(anchors, i, rows, at)
                for row, _, s in wanted:
                    fits = np.flatnonzero((score >= -(-least_share * s // 100)) & (score <= s))
                    out += [(anchors.row[i], row, rows.row[at[fits[j]]], rows.id[at[fits[j]]], score[fits[j]]) for j in _first(rows, at[fits], score[fits], n)]
        return _hits(out, "positive_row")

    return work


def _within(angle: np.ndarray, scale: float, floor: int, orders: list[np.ndarray], angles: list[np.ndarray], n: int) -> np.ndarray:
    """Rows that can score ``floor``, as the reference with the narrowest window of angles tells; all of them if there is none."""
    if not orders or floor <= SCORE_SLACK * scale + 1:
        return np.arange(n)
    cosine = (floor - 1 - SCORE_SLACK * scale) / scale if scale > 0 else 2.0
    if cosine > 1:
        return np.arange(0)
    reach = float(np.arccos(cosine)) + ANGLE_SLACK
    spans = [(np.searchsorted(a, angle[r] - reach), np.searchsorted(a, angle[r] + reach, "right")) for r, a in enumerate(angles)]
    r = min(range(len(spans)), key=lambda k: spans[k][1] - spans[k][0])
    return np.sort(orders[r][spans[r][0] : spans[r][1]])


def _hits(out: list[tuple], second: str) -> pa.Table:
    columns = list(zip(*out, strict=True)) if out else [()] * 5
    return pa.table([pa.array(list(c), pa.int64()) for c in columns], names=["anchor_row", second, "row", "vec_id", "score"])


def prepared(embeddings: DataFrame, id_col: str, vector_col: str, label_col: str, relabel_every: int, n_labels: int) -> DataFrame:
    """The rows that take part: row, vec_id, label, vector (whole components, packed), norm, angles (packed), dims."""
    vec, vec_id = F.col(vector_col), F.col(id_col).cast("long")
    label = F.col(label_col).cast("long")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    used = embeddings.where(F.col(label_col).isNotNull() & vec.isNotNull() & finite).select(
        vec_id.alias("vec_id"),
        F.when(vec_id % relabel_every == 0, (label + 1) % n_labels).otherwise(label).alias("label"),
        F.transform(vec, lambda x: F.floor(x.cast("double") * SCALE).cast("long")).alias("whole"),
    )
    used = materialise(used.withColumn("row", F.monotonically_increasing_id()), "vectors")
    refs = _fit_references(used)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pc.list_value_length(batch.column(3)).to_numpy()
            for dims in np.unique(lengths):
                part = batch.take(pa.array(np.flatnonzero(lengths == dims)))
                whole = part.column(3).flatten().to_numpy().astype("<i8").reshape(part.num_rows, dims)
                floats = whole.astype(np.float64)
                norms = np.linalg.norm(floats, axis=1)
                angles = angles_to(floats, norms, refs.get(int(dims), np.zeros((0, dims)))).astype("<f4")
                packed = [pa.array([v.tobytes() for v in of], pa.binary()) for of in (whole, angles)]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], packed[0], pa.array(norms), packed[1]], names=["row", "vec_id", "label", "vector", "norm", "angles"])

    ready = used.select("row", "vec_id", "label", "whole").mapInArrow(work, "row long, vec_id long, label long, vector binary, norm double, angles binary")
    return materialise(ready.withColumn("dims", (F.length("vector") / 8).cast("int")), "angles")


def _fit_references(used: DataFrame) -> dict[int, np.ndarray]:
    """By number of components, from at most ``SAMPLE_ROWS`` rows in the order of a hash."""
    sample = used.select("whole").orderBy(F.xxhash64("row")).limit(SAMPLE_ROWS).toArrow()["whole"].to_pylist()
    by_dims: dict[int, list] = {}
    for values in sample:
        by_dims.setdefault(len(values), []).append(values)
    return {d: reference_directions(np.array(v, dtype=np.float64)) for d, v in by_dims.items() if d}


def mine_hard_negatives(
    embeddings: DataFrame, anchor_every: int = 100, n_positives: int = 5, n_negatives: int = 5, least_share: int = 80, relabel_every: int = 7, n_labels: int = 10,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", group_rows: int = GROUP_ROWS, block_anchors: int = BLOCK_ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows with a null label, a null vector or a component that is null or not finite take no part. Each component x counts as floor(256 x), held within
    64 bits, as are scores. Labels of ids divisible by ``relabel_every`` become the next of ``n_labels``. Rows are told apart by place, so
    rows that repeat an id are anchors, positives and negatives each; a row without an id is no anchor and comes last among equal
    scores. Vectors of different lengths have no score with each other; those without components score 0. A positive with a score below 0 opens no window. Other columns are
    ignored, whatever their names; an empty table gives an empty result.
    """
    vectors = prepared(embeddings, id_col, vector_col, label_col, relabel_every, n_labels)
    is_anchor = F.coalesce(F.col("vec_id") % anchor_every == 0, F.lit(False))
    sizes = vectors.groupBy("dims").agg(F.ceil(F.count(F.lit(1)) / group_rows).cast("int").alias("groups"), F.greatest(F.lit(1), F.ceil(F.count_if(is_anchor) / block_anchors).cast("int")).alias("blocks"))
    dealt = vectors.join(sizes, "dims").withColumns({"group": F.pmod(F.xxhash64("row"), F.col("groups")).cast("int"), "block": F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")})
    carried = ["row", "vec_id", "label", "vector", "norm", "angles"]
    rows = dealt.select("dims", "group", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), *carried)
    anchors = dealt.where(is_anchor).select("dims", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group"), "block", *carried)
    anchors = anchors.toDF(*anchors.columns)  # columns of its own, apart from those of ``rows``
    cell = ["dims", "group", "block"]

    found = rows.groupBy(*cell).cogroup(anchors.groupBy(*cell)).applyInArrow(_positives(n_positives), "anchor_row long, anchor_id long, row long, vec_id long, score long")
    first = Window.partitionBy("anchor_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), F.col("row").asc())
    positives = found.withColumn("n", F.row_number().over(first)).where(F.col("n") <= n_positives).drop("n")
    positives = materialise(positives, "positives")

    # at most n_positives an anchor
    lists = positives.groupBy(F.col("anchor_row").alias("row")).agg(F.collect_list(F.struct("row", "vec_id", "score")).alias("positives"))
    seeking = anchors.join(lists, "row")
    near = rows.groupBy(*cell).cogroup(seeking.groupBy(*cell)).applyInArrow(_negatives(n_negatives, least_share), "anchor_row long, positive_row long, row long, vec_id long, score long")
    best = Window.partitionBy("anchor_row", "positive_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), F.col("row").asc())
    ranked = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n_negatives)
    ranked = ranked.select("anchor_row", "positive_row", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    known = positives.select("anchor_row", "anchor_id", F.col("row").alias("positive_row"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return known.join(ranked, ["anchor_row", "positive_row"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
