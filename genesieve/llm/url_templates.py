"""URL filter: explicit rules first, then a path-template tree per host.

Numbers and long hex ids in a segment become wildcards at once. The tree of what is left
is built level by level, each under the generalised nodes of the level above, to the end of every path. Shares are those of pages, but
pages of one url are evidence only once. A round goes down by one level, and through all further ones that have an only child; the last of
``rounds`` takes what is left of a path as one segment, so a path nested without end costs no more rounds:

* Children with less than ``rare`` of their node's pages become one wildcard (if there are several), so at most
  1 / ``rare`` + 1 siblings are left. Nodes of all sizes are treated alike.
* Siblings are compared in pairs by a chi-square test of what follows below them, allowing for a
  difference of ``effect`` that doesn't matter, and by a test of their labelled shares where both have labels. A sibling without a
  similar larger one leads; others join the largest leader that they are similar to. A branch
  without labels may so share the evidence of a labelled one. Siblings below which nothing follows stay apart.
* A node's purity is its share of bad pages among the labelled ones, smoothed by its parent's, down from that of
  the host and of the whole table (an only child has that of its parent). A template is rejected when it has labels and its purity reaches a bound.

Labels are the pages that the rules decide, or a table of the caller's.

Only aggregates over (host, path shape) are joined, never pages with pages. All of
it is built-in SQL expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import compact, materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
REST = "{*}"


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return f"{self.host}{self.path}"


def parse_rule(verdict: str, text: str) -> UrlRule:
    host, slash, path = text.partition("/")
    return UrlRule(verdict, host, slash + path)


#: The rules of the query.
RULES = tuple(parse_rule(*r) for r in (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")))


@dataclass(frozen=True)
class TreeSettings:
    #: Children with a smaller share of their node's pages are variable.
    rare: float = 0.05
    #: A chi-square statistic of so much a url is no difference that matters.
    effect: float = 0.05
    #: Standard deviations by which a statistic may exceed what is expected of similar siblings.
    deviations: float = 3.0
    #: Labelled urls that a parent's purity counts for.
    smoothing: float = 10.0
    reject_at: float = 0.9
    #: Jobs go down the tree so often, whatever the depth of the paths.
    rounds: int = 16


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[UrlRule, ...]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; both null where none does. Of equally long rules that with the longer host wins, then the last by text."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), len(r.host), r.text)):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        text, verdict = F.when(fits, F.lit(r.text)).otherwise(text), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return text, verdict


def _shape(segment: Column) -> Column:
    """Numbers and long hex ids become wildcards wherever they stand in a segment."""
    return F.regexp_replace(F.regexp_replace(segment, r"[0-9a-fA-F]{12,}", "{hex}"), r"[0-9]+", "{n}")


def filter_urls(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES, labels: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", settings: TreeSettings = TreeSettings()) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, template, purity.

    ``labels`` may give (page_id, bad 0/1); else a page decided by a rule is
    labelled by it. A null url, or one without ``://``, has empty host and path and
    is judged like others. Rows that repeat an id, or have none, are judged each; rows of one url are evidence as one, which is
    bad if one of them is labelled so. Paths are read whole, however
    long and deep. Other columns are ignored, whatever their names; an empty table gives an empty result.
    """
    p = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("_url"))
    p = p.select("page_id", host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    p = p.withColumns({"rule": rule, "_ruled": verdict})
    p = p.withColumn("_shape", F.array_join(F.transform(F.split(F.expr("ltrim('/', path)"), "/"), _shape), "/"))
    if labels is None:
        p = p.withColumn("_bad", F.when(F.col("_ruled") == "block", 1).when(F.col("_ruled") == "allow", 0))
    else:
        known = labels.groupBy(F.col(labels.columns[0]).cast("long").alias("page_id")).agg(F.max(labels.columns[1]).cast("int").alias("_bad"))
        p = p.join(known, "page_id", "left")
    urls = p.groupBy("host", "path", "_shape").agg(F.count(F.lit(1)).alias("_n"), F.max("_bad").alias("_bad"))
    leaves = urls.groupBy("host", "_shape").agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("urls"), F.count("_bad").alias("labelled"), F.coalesce(F.sum("_bad"), F.lit(0)).alias("bad"))
    judged = template_tree(materialise(leaves, "url-leaves"), settings)
    # one more key than the aggregation has: the join gets exchanges of its own, so that Spark may split a hot host
    by_leaf = judged.withColumn("_one", F.lit(1)).select("host", "_shape", "_one", "template", "purity", "_reject")
    out = p.withColumn("_one", F.lit(1)).join(by_leaf, ["host", "_shape", "_one"], "left")
    own = F.when(F.col("_reject"), F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("_ruled", own).alias("verdict"), "template", "purity")


def template_tree(leaves: DataFrame, s: TreeSettings) -> DataFrame:
    """For leaves (host, _shape, n, urls, labelled, bad): host, _shape, template, purity, _reject."""
    leaves = compact(leaves)
    total = leaves.agg(F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled")).first()  # one row
    prior = (total["bad"] or 0) / total["labelled"] if total["labelled"] else 0.0
    hosts = leaves.groupBy("host").agg(_smoothed(F.lit(prior), s).alias("purity"), F.sum("n").alias("mass"))
    # node: the generalised path so far, with mass pages; rest: what is left of the shape, null once a leaf has ended
    open_leaves = leaves.join(hosts, "host").withColumns({"node": F.lit(""), "rest": F.col("_shape")})
    done = []
    for left in range(s.rounds - 1, -1, -1):
        level = compact(materialise(_descend(open_leaves, s, last=not left), "url-level"))
        done.append(level.where("rest is null"))
        open_leaves = level.where("rest is not null")
        if not left or open_leaves.isEmpty():
            break
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select("host", "_shape", F.col("node").alias("template"), "purity", ((F.col("known") > 0) & (F.col("purity") >= s.reject_at)).alias("_reject"))


def _smoothed(parent: Column, s: TreeSettings) -> Column:
    return (F.sum("bad") + s.smoothing * parent) / (F.sum("labelled") + s.smoothing)


def _descend(leaves: DataFrame, s: TreeSettings, last: bool) -> DataFrame:
    """The leaves one level further down, to the end if it is the ``last``: node and rest moved on; purity, mass and known (labelled urls) are the new node's."""
    keys = ["host", "node"]
    first = F.col("rest") if last else F.substring_index("rest", "/", 1)
    later = F.lit(None).cast("string") if last else F.when(F.contains("rest", F.lit("/")), F.expr("substr(rest, instr(rest, '/') + 1)"))
    leaves = leaves.select(*keys, "_shape", "n", "urls", "labelled", "bad", "purity", "mass", first.alias("seg"), later.alias("rest"))

    # variable segments: children of a small share, if there are several
    children = leaves.groupBy(*keys, "seg").agg(F.sum("n").alias("n"), F.max("mass").alias("mass"))
    low = children.where(F.col("n") < s.rare * F.col("mass")).withColumn("_one", F.lit(1))
    several = low.groupBy(*keys).agg(F.count(F.lit(1)).alias("_several"), F.lit(1).alias("_one")).where("_several > 1")
    low = low.select(*keys, "seg", "_one").join(several, [*keys, "_one"]).select(*keys, "seg", F.lit(True).alias("_low"))
    leaves = leaves.join(low, [*keys, "seg"], "left").withColumn("seg", F.when(F.col("_low"), F.lit(REST)).otherwise(F.col("seg"))).drop("_low")
    leaves = compact(materialise(leaves, "url-children"))

    # what follows below each sibling: cells of what is common below the node, and one of all the rest
    after = F.coalesce("rest", F.lit("{end}"))
    follow = leaves.groupBy(*keys, after.alias("cell")).agg(F.sum("n").alias("n"), F.max("mass").alias("mass"))
    common = follow.where(F.col("n") >= s.rare * F.col("mass")).select(*keys, "cell", F.lit(True).alias("_common"))
    cells = leaves.groupBy(*keys, "seg", after.alias("cell")).agg(F.sum("urls").alias("n")).join(common, [*keys, "cell"], "left")
    cells = cells.groupBy(*keys, "seg", F.when(F.col("_common"), F.col("cell")).otherwise(F.lit(REST)).alias("cell")).agg(F.sum("n").alias("n"))
    siblings = leaves.groupBy(*keys, "seg").agg(F.sum("urls").alias("n"), *[F.sum(c).alias(c) for c in ("labelled", "bad")], F.count("rest").alias("longer"))
    leader = _leaders(siblings.where("longer > 0"), cells, s)

    leaves = leaves.join(leader, [*keys, "seg"], "left")
    name = F.when(F.col("leader").isNull(), F.col("seg")).otherwise(F.concat(F.lit("{"), F.col("leader"), F.lit("~}")))
    leaves = leaves.withColumn("below", F.concat(F.col("node"), F.lit("/"), name)).drop("node", "seg", "leader").withColumnRenamed("below", "node")
    only = F.sum("n") == F.max("mass")
    nodes = leaves.groupBy(*keys).agg(F.when(only, F.max("purity")).otherwise(_smoothed(F.max("purity"), s)).alias("purity"), F.sum("n").alias("mass"), F.sum("labelled").alias("known"), F.lit(1).alias("_one"), _shared_way().alias("way"))
    leaves = leaves.drop("purity", "mass").withColumn("_one", F.lit(1)).join(nodes, [*keys, "_one"])
    # only children of only children are passed at once
    leaves = leaves.withColumns({"node": F.concat_ws("/", "node", F.nullif("way", F.lit(""))), "rest": F.when(F.col("way") == "", F.col("rest")).otherwise(F.expr("substr(rest, length(way) + 2)"))})
    return leaves.select("host", "_shape", "n", "urls", "labelled", "bad", "purity", "mass", "known", "node", "rest")


def _shared_way() -> Column:
    """The segments that all rests of a group begin with and go on from, joined: those that its least and its greatest share."""
    a, b = F.split(F.min("rest"), "/"), F.split(F.max("rest"), "/")
    most = F.least(F.size(a), F.size(b)) - 1
    same = F.transform(F.arrays_zip(F.slice(a, 1, most), F.slice(b, 1, most)), lambda x: x["0"] == x["1"])
    # up to the first place where they differ
    k = F.coalesce(F.nullif(F.array_position(same, False), F.lit(0)) - 1, most).cast("int")
    alone = (F.count("rest") < F.count(F.lit(1))) | (most < 1)
    return F.when(alone, F.lit("")).otherwise(F.array_join(F.slice(a, 1, k), "/"))


def _leaders(siblings: DataFrame, cells: DataFrame, s: TreeSettings) -> DataFrame:
    """(host, node, seg, leader) of the siblings that share a node with others, the leader among them. A node has at most 1 / rare + 1 siblings and cells."""
    keys = ["host", "node"]
    side = lambda t: siblings.select(*keys, *[F.col(c).alias(f"{c}_{t}") for c in ("seg", "n", "labelled", "bad")])
    larger = (F.col("n_a") > F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("seg_a") < F.col("seg_b")))
    pairs = side("a").join(side("b"), keys).where(larger)
    both = cells.select(*keys, F.col("seg").alias("seg_a"), "cell", F.col("n").alias("x"))
    each = pairs.join(both, [*keys, "seg_a"]).select(*keys, "seg_a", "seg_b", "cell", "x", F.lit(0).cast("long").alias("y"))
    other = cells.select(*keys, F.col("seg").alias("seg_b"), "cell", F.col("n").alias("y"))
    each = each.unionByName(pairs.join(other, [*keys, "seg_b"]).select(*keys, "seg_a", "seg_b", "cell", F.lit(0).cast("long").alias("x"), "y"))
    met = each.groupBy(*keys, "seg_a", "seg_b", "cell").agg(F.sum("x").alias("x"), F.sum("y").alias("y")).join(pairs, [*keys, "seg_a", "seg_b"])
    term = F.pow(F.col("x") * F.sqrt(F.col("n_b") / F.col("n_a")) - F.col("y") * F.sqrt(F.col("n_a") / F.col("n_b")), F.lit(2.0)) / (F.col("x") + F.col("y"))
    tested = met.groupBy(*keys, "seg_a", "seg_b", "n_a", "n_b", "labelled_a", "labelled_b", "bad_a", "bad_b").agg(F.sum(term).alias("chi"), (F.count(F.lit(1)) - 1).alias("df"))
    slack = s.effect * (F.col("n_a") + F.col("n_b"))
    alike = F.col("chi") <= F.col("df") + slack + s.deviations * F.sqrt(2.0 * F.col("df") + 4 * slack)
    pooled = (F.col("bad_a") + F.col("bad_b")) / (F.col("labelled_a") + F.col("labelled_b"))
    apart = F.abs(F.col("bad_a") / F.col("labelled_a") - F.col("bad_b") / F.col("labelled_b"))
    agree = (F.col("labelled_a") == 0) | (F.col("labelled_b") == 0) | (apart <= s.effect + s.deviations * F.sqrt(pooled * (1 - pooled) * (1 / F.col("labelled_a") + 1 / F.col("labelled_b"))))
    similar = materialise(tested.where(alike & agree).select(*keys, "seg_a", "seg_b", "n_a"), "url-similar")
    followers = similar.select(*keys, F.col("seg_b").alias("seg_a")).distinct()
    # of a follower's similar larger siblings, those that lead
    joined = similar.join(followers, [*keys, "seg_a"], "left_anti")
    best = joined.groupBy(*keys, F.col("seg_b").alias("seg")).agg(F.min(F.struct((-F.col("n_a")).alias("n"), F.col("seg_a").alias("seg"))).alias("best"))
    found = best.select(*keys, "seg", F.col("best.seg").alias("leader"))
    return found.unionByName(found.select(*keys, F.col("leader").alias("seg"), "leader").distinct())
