"""Sharding by a k-d tree over document metadata.

Documents with equal texts form a group; a group has a weight (its bytes) and
metadata: source and language (as places among their distinct values, whole strings compared) and size, on a
logarithmic scale; a hash of the text stands in where these are all equal. Starting from one node, each
node with more than one shard is split along its widest dimension (ranges are
taken relative to the whole table; of equal ones the first as listed), at the value where the weight falls into
equal halves. That weighted median is found exactly, by radix selection: each pass
aggregates weights by the next 12 bits of a 60-bit key into at most 4096 sums per
node, so what reaches the driver is bounded by the number of shards alone.

Groups heavier than a hundredth of a shard are "atoms": there are at most 100 per
shard. They are laid on the lighter side of each split first, and the median of
the remaining light groups balances them, so a large group of copies stays in one
shard without upsetting the sizes. A group larger than a shard is cut into
pieces by a hash of the row's number, so null and repeated ids are dealt like others; each piece is an atom of its own: only such groups span shards.

Built-in SQL expressions only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import even_salts, materialise, salted_rank

METADATA = ("source", "lang", "size")
DIMENSIONS = (*METADATA, "hash")
DIGIT_BITS, DIGITS, RANGE_BITS = 12, 5, 24
ATOM_SHARE = 0.01
CUT_SHARE = 1.0


@dataclass
class Node:
    first: int
    shards: int
    test: Column
    atoms: list = field(default_factory=list)


def shard_by_tree(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot (gapless from 0 in each shard).

    ``size`` is the text's UTF-8 bytes plus one; null counts as empty, in size as in
    equality. Shards come out near equal in bytes (law ``bytes``); with fewer groups
    than shards some stay empty. Null source or language sorts first; the least source
    and language of a group of equal texts are the group's. Texts of any length are read whole. Rows that
    repeat an id, or have none, are rows of their own. Other columns are ignored, whatever their names; an empty table
    gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("_same"),
        F.col(source_col).cast("string").alias("_source"),
        F.col(lang_col).cast("string").alias("_lang"),
    )
    rows = materialise(rows.withColumn("_row", F.monotonically_increasing_id()), "kd-rows")
    groups = rows.groupBy("_same").agg(F.sum("size").alias("w"), F.min("_source").alias("source"), F.min("_lang").alias("lang"), F.first("size").cast("double").alias("size"), F.count(F.lit(1)).alias("n"))
    # a 24-bit number from the text's digest: breaks ties between groups the same way each time
    groups = groups.withColumns({"size": F.log2("size"), "hash": F.conv(F.substring(F.hex("_same"), 1, 6), 16, 10).cast("double"), "_tie": F.conv(F.substring(F.hex("_same"), 7, 9), 16, 10).cast("long")})
    groups = materialise(groups, "kd-groups")
    groups = materialise(_with_ordinals(_with_ordinals(groups, "source"), "lang"), "kd-groups")
    span = groups.agg(F.sum("w").alias("w"), *[f(d).alias(f"{d}_{f.__name__}") for d in DIMENSIONS for f in (F.min, F.max)]).first()
    total = span["w"] or 0
    low = {d: span[f"{d}_min"] or 0.0 for d in DIMENSIONS}
    full = {d: ((span[f"{d}_max"] or 0.0) - low[d]) or 1.0 for d in DIMENSIONS}
    atom_above, piece = total / shards * ATOM_SHARE, max(1.0, total / shards * CUT_SHARE)
    pieces = F.when(F.col("w") > piece, F.ceil(F.col("w") / F.lit(piece))).otherwise(1).cast("int")
    groups = groups.withColumns({"_atom": F.col("w") > F.lit(float(atom_above)), "_pieces": pieces})
    light = groups.where("not _atom")

    leaves, open_nodes = [], [Node(0, shards, F.lit(True))]
    atoms = groups.where("_atom").select(F.hex("_same").alias("k"), "w", "_pieces").collect()  # at most shards / ATOM_SHARE rows
    open_nodes[0].atoms = sorted(((r["w"] / r["_pieces"], r["k"], i) for r in atoms for i in range(r["_pieces"])), reverse=True)
    while open_nodes:
        leaves += [n for n in open_nodes if n.shards == 1]
        open_nodes = [n for n in open_nodes if n.shards > 1]
        if open_nodes:
            open_nodes = _split(light, open_nodes, low, full)

    of_light = F.lit(None).cast("int")
    for leaf in leaves:
        of_light = F.when(leaf.test, F.lit(leaf.first)).otherwise(of_light)
    placed = light.select("_same", of_light.alias("shard"), F.lit(1).alias("_pieces"), F.lit(0).alias("_piece"))
    spark = docs.sparkSession
    fixed = [(k, leaf.first, i) for leaf in leaves for _, k, i in leaf.atoms]
    fixed = spark.createDataFrame(fixed, "_k string, shard int, _piece int").select(F.unhex("_k").alias("_same"), "shard", "_piece")
    cut = groups.where("_atom").select("_same", "_pieces").join(fixed, "_same").select("_same", "shard", "_pieces", "_piece")
    where = placed.unionByName(cut)
    # a row of a cut group goes with one piece of it; the piece is part of the join's key
    n_pieces = cut.where("_pieces > 1").select("_same", "_pieces").distinct()
    dealt = rows.join(F.broadcast(n_pieces), "_same", "left")  # fewer than shards / CUT_SHARE rows
    dealt = dealt.withColumn("_piece", F.coalesce(F.pmod(F.xxhash64("_row"), F.col("_pieces")), F.lit(0)).cast("int")).drop("_pieces")
    out = materialise(dealt.join(where.drop("_pieces"), ["_same", "_piece"]).select("_row", "doc_id", "size", "text_crc32", "shard"), "kd-placed")
    salts = even_salts(out.count() // shards)
    return salted_rank(out, ["shard"], [F.col("doc_id"), F.col("text_crc32"), F.col("_row")], F.xxhash64("_row"), salts, "slot").select("doc_id", "size", "text_crc32", "shard", "slot")


def _ordinals(groups: DataFrame, dim: str) -> DataFrame:
    """(dim, ordinal): the place of each distinct value among all of them, in order; null comes first.

    Values are dealt to partitions by ranges and numbered in each; a partition's numbers
    begin after those of the partitions before it, of which there is one row each.
    """
    spark = groups.sparkSession
    values = groups.select(dim).distinct()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    values = values.repartitionByRange(parts, F.col(dim).asc_nulls_first()).withColumn("_part", F.spark_partition_id())
    values = materialise(values, "kd-values")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = values.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(F.col(dim).asc_nulls_first()))
    return values.withColumn("_own", own).join(F.broadcast(starts), "_part").select(dim, (F.col("_own") + F.col("_start") - 1).cast("double").alias(f"_{dim}"))  # a row a partition is broadcast


def _with_ordinals(groups: DataFrame, dim: str) -> DataFrame:
    values = _ordinals(groups, dim).withColumnRenamed(dim, "_value")
    return groups.join(values, groups[dim].eqNullSafe(values["_value"])).drop(dim, "_value").withColumnRenamed(f"_{dim}", dim)


def _key(dim: str, low: dict, full: dict) -> Column:
    """60 bits: where the group lies in the dimension's whole range (24), then its tie-breaker (36)."""
    at = F.least(F.floor((F.col(dim) - F.lit(low[dim])) / F.lit(full[dim]) * F.lit(float(1 << RANGE_BITS))), F.lit((1 << RANGE_BITS) - 1)).cast("long")
    return F.shiftleft(at, DIGIT_BITS * DIGITS - RANGE_BITS) + F.col("_tie")


def _split(light: DataFrame, nodes: list[Node], low: dict, full: dict) -> list[Node]:
    """Split every node once; all nodes of a level share the same passes over the groups."""
    at = F.lit(None).cast("int")
    for i, node in enumerate(nodes):
        at = F.when(node.test, F.lit(i)).otherwise(at)
    here = light.withColumn("_node", at)
    ranges = {r["_node"]: r for r in here.groupBy("_node").agg(F.sum("w").alias("w"), *[f(d).alias(f"{d}_{f.__name__}") for d in DIMENSIONS for f in (F.min, F.max)]).collect()}
    plans = []
    for i, node in enumerate(nodes):
        r = ranges.get(i)
        width = {d: (r[f"{d}_max"] - r[f"{d}_min"]) / full[d] if r else 0.0 for d in DIMENSIONS}
        # the hash only where no metadata differ
        dim = max(METADATA, key=lambda d: width[d])
        dim = dim if width[dim] > 0 else "hash"
        w, left_shards = (r["w"] if r else 0), node.shards // 2
        atom_w = sum(a[0] for a in node.atoms)
        goal = (w + atom_w) * left_shards / node.shards
        sides, load = ([], []), [0.0, 0.0]
        for a in node.atoms:  # heaviest first, to the side with more room
            s = 0 if goal - load[0] >= (w + atom_w - goal) - load[1] else 1
            sides[s].append(a)
            load[s] += a[0]
        plans.append({"dim": dim, "want": min(max(goal - load[0], 0.0), float(w)), "sides": sides, "prefix": 0, "before": 0.0, "left": left_shards})
    key, plan_key = F.lit(None).cast("long"), {}
    for i, p in enumerate(plans):
        plan_key[i] = _key(p["dim"], low, full)
        key = F.when(F.col("_node") == i, plan_key[i]).otherwise(key)
    keyed = here.where("_node is not null").select("_node", "w", key.alias("_key"))
    for d in range(DIGITS):
        shift = DIGIT_BITS * (DIGITS - 1 - d)
        inside = F.lit(False)
        for i, p in enumerate(plans):
            inside = inside | ((F.col("_node") == i) & (F.shiftright("_key", shift + DIGIT_BITS) == p["prefix"]))
        sums: dict = {}
        for r in keyed.where(inside).groupBy("_node", F.shiftright("_key", shift).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1)).alias("digit")).agg(F.sum("w").alias("w")).collect():
            sums.setdefault(r["_node"], {})[r["digit"]] = r["w"]
        for i, p in enumerate(plans):
            digit = 0
            for digit, w in sorted(sums.get(i, {}).items()):
                if p["before"] + w > p["want"]:
                    break
                p["before"] += w
            else:
                digit = (1 << DIGIT_BITS) - 1 if sums.get(i) else 0
            p["prefix"] = (p["prefix"] << DIGIT_BITS) | digit
    out = []
    for i, (node, p) in enumerate(zip(nodes, plans, strict=True)):
        below = plan_key[i] < F.lit(p["prefix"])
        out += [Node(node.first, p["left"], node.test & below, p["sides"][0]), Node(node.first + p["left"], node.shards - p["left"], node.test & ~below, p["sides"][1])]
    return out
