"""The operators' queries over the synthetic tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bin_packing import pack_documents
from .byte_bpe import encode_documents
from .exact_dedup import exact_dedup
from .hard_negatives import mine_hard_negatives
from .kd_shards import shard_by_tree
from .language_id import held_out, predict, train_on
from .license_scan import scan_licenses
from .line_blocks import extract_pages
from .near_dedup import near_duplicates
from .pii import digest, find_spans, train
from .quality_rules import apply_policy, ledger
from .source_divergence import source_divergence
from .url_templates import RULES, filter_urls

SHARDS = 16
#: Added before rounding, so that ties are rounded alike whatever their last bits.
NUDGE = 3.7e-10

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op2_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = filter_urls(table(spark, sf_dir, "pages"))
    return judged.withColumn("purity", F.round(F.col("purity") + NUDGE, 6))


def op9_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_by_tree(table(spark, sf_dir, "documents"), SHARDS)
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_documents(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, keep_ids=False).drop("ids")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return digest(find_spans(docs, train(spark, docs)))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = train_on(docs.where(~held_out()))
    return predict(docs, net).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op7_bin_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_policy(ledger(table(spark, sf_dir, "documents")))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_hard_negatives(table(spark, sf_dir, "embeddings"))


def op12_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


def _op2_sql() -> str:
    longest_first = sorted(RULES, key=lambda r: (len(r.text), len(r.host), r.text), reverse=True)
    fits = [(f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')", r) for r in longest_first]
    rule = " ".join(f"WHEN {f} THEN '{r.text}'" for f, r in fits)
    verdict = " ".join(f"WHEN {f} THEN '{r.verdict}'" for f, r in fits)
    return rf"""
WITH u AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages
), p AS (
  SELECT *, CASE {rule} END AS rule, CASE {verdict} END AS ruled,
         list_transform(string_split(ltrim(path, '/'), '/'), lambda x: regexp_replace(regexp_replace(x, '[0-9a-fA-F]{{12,}}', '{{hex}}', 'g'), '[0-9]+', '{{n}}', 'g')) AS parts FROM u
), s AS (
  SELECT *, array_to_string(parts, '/') AS shape, CASE ruled WHEN 'block' THEN 1 WHEN 'allow' THEN 0 END AS bad FROM p
), leaves AS MATERIALIZED (
  SELECT host, shape, CAST(sum(k) AS BIGINT) AS n, count(*) AS urls, count(bad) AS labelled, coalesce(sum(bad), 0) AS bad
  FROM (SELECT host, path, shape, bad, count(*) AS k FROM s GROUP BY ALL) GROUP BY host, shape
), prior AS (
  SELECT CASE WHEN sum(labelled) > 0 THEN sum(bad) / sum(labelled) ELSE 0 END AS prior FROM leaves
), hosts AS (
  SELECT host, (sum(bad) + 10 * any_value(prior)) / (sum(labelled) + 10) AS purity, sum(n) AS mass FROM leaves, prior GROUP BY host
), level0 AS MATERIALIZED (
  SELECT host, shape, n, urls, labelled, bad, purity, mass, 0 AS known, '' AS node, shape AS rest FROM leaves JOIN hosts USING (host)
){"".join(_op2_level(i) for i in range(1, SQL_LEVELS + 1))}, judged AS (
  {" UNION ALL ".join(f"SELECT host, shape, node, purity, known FROM level{i} WHERE rest IS NULL" for i in range(1, SQL_LEVELS + 1))}
)
SELECT page_id, s.host, s.path, rule, coalesce(ruled, CASE WHEN known > 0 AND purity >= 0.9 THEN 'block' ELSE 'allow' END) AS verdict,
       node AS template, round(CAST(purity AS DOUBLE) + {NUDGE}, 6) AS purity
FROM s JOIN judged j ON s.host = j.host AND s.shape = j.shape
"""


#: Levels that the SQL spells out; the tables' paths have three.
SQL_LEVELS = 4


def _op2_level(i: int) -> str:
    return f"""
, seg{i} AS (
  SELECT * EXCLUDE (rest), split_part(rest, '/', 1) AS seg, CASE WHEN contains(rest, '/') THEN substr(rest, instr(rest, '/') + 1) END AS rest
  FROM level{i - 1} WHERE rest IS NOT NULL
), few{i} AS (
  SELECT host, node, seg, count(*) OVER (PARTITION BY host, node) AS several
  FROM (SELECT host, node, seg FROM seg{i} GROUP BY host, node, seg HAVING sum(n) < 0.05 * any_value(mass))
), wide{i} AS MATERIALIZED (
  SELECT l.* REPLACE (CASE WHEN several > 1 THEN '{{*}}' ELSE l.seg END AS seg), coalesce(l.rest, '{{end}}') AS after
  FROM seg{i} l LEFT JOIN few{i} f ON l.host = f.host AND l.node = f.node AND l.seg = f.seg
), common{i} AS (
  SELECT host, node, after FROM wide{i} GROUP BY host, node, after HAVING sum(n) >= 0.05 * any_value(mass)
), cells{i} AS MATERIALIZED (
  SELECT w.host, w.node, seg, CASE WHEN c.after IS NULL THEN '{{*}}' ELSE w.after END AS cell, CAST(sum(urls) AS DOUBLE) AS n
  FROM wide{i} w LEFT JOIN common{i} c ON w.host = c.host AND w.node = c.node AND w.after = c.after GROUP BY ALL
), sibling{i} AS MATERIALIZED (
  SELECT host, node, seg, CAST(sum(urls) AS DOUBLE) AS n, CAST(sum(labelled) AS DOUBLE) AS labelled, CAST(sum(bad) AS DOUBLE) AS bad
  FROM wide{i} GROUP BY host, node, seg HAVING count(rest) > 0
), pair{i} AS (
  SELECT a.host, a.node, a.seg AS sa, b.seg AS sb, a.n AS na, b.n AS nb, a.labelled AS la, b.labelled AS lb, a.bad AS ba, b.bad AS bb
  FROM sibling{i} a JOIN sibling{i} b ON a.host = b.host AND a.node = b.node AND (a.n > b.n OR a.n = b.n AND a.seg < b.seg)
), met{i} AS (
  SELECT p.*, c.cell, sum(CASE WHEN c.seg = sa THEN c.n ELSE 0 END) AS x, sum(CASE WHEN c.seg = sb THEN c.n ELSE 0 END) AS y
  FROM pair{i} p JOIN cells{i} c ON p.host = c.host AND p.node = c.node AND c.seg IN (sa, sb) GROUP BY ALL
), tested{i} AS (
  SELECT host, node, sa, sb, na, nb, la, lb, ba, bb, sum((x * sqrt(nb / na) - y * sqrt(na / nb)) ** 2 / (x + y)) AS chi, count(*) - 1 AS df FROM met{i} GROUP BY ALL
), similar{i} AS MATERIALIZED (
  SELECT host, node, sa, sb, na FROM tested{i}
  WHERE chi <= df + 0.05 * (na + nb) + 3 * sqrt(2.0 * df + 4 * 0.05 * (na + nb))
    AND (la = 0 OR lb = 0 OR abs(ba / la - bb / lb) <= 0.05 + 3 * sqrt((ba + bb) / (la + lb) * (1 - (ba + bb) / (la + lb)) * (1 / la + 1 / lb)))
), follower{i} AS (
  SELECT host, node, sb AS seg, first(sa ORDER BY na DESC, sa) AS leader FROM similar{i} s
  WHERE NOT EXISTS (SELECT 1 FROM similar{i} t WHERE t.host = s.host AND t.node = s.node AND t.sb = s.sa) GROUP BY host, node, sb
), leader{i} AS (
  SELECT host, node, seg, leader FROM follower{i} UNION SELECT host, node, leader, leader FROM follower{i}
), below{i} AS MATERIALIZED (
  SELECT w.host, shape, n, urls, labelled, bad, purity, mass, rest, w.node || '/' || CASE WHEN leader IS NULL THEN w.seg ELSE '{{' || leader || '~}}' END AS node
  FROM wide{i} w LEFT JOIN leader{i} l ON w.host = l.host AND w.node = l.node AND w.seg = l.seg
), node{i} AS (
  SELECT host, node, sum(n) AS mass, sum(labelled) AS known,
         CASE WHEN sum(n) = max(mass) THEN max(purity) ELSE (sum(bad) + 10 * max(purity)) / (sum(labelled) + 10) END AS purity
  FROM below{i} GROUP BY host, node
), level{i} AS MATERIALIZED (
  SELECT b.host, shape, n, urls, labelled, bad, k.purity, k.mass, known, b.node, rest FROM below{i} b JOIN node{i} k ON b.host = k.host AND b.node = k.node
)"""


OP2_SQL = _op2_sql()

OP8_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

OP10_SQL = r"""
WITH t AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM t
), m AS (
  SELECT row_id, doc_id, words, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines
  FROM w
), g AS (
  SELECT row_id, unnest(range(n_words - 2)) AS i,
         unnest(list_transform(range(1, n_words - 1), lambda k: array_to_string(list_slice(words, k, k + 2), ' '))) AS win
  FROM m WHERE n_words >= 3
), r AS (
  SELECT row_id, i FROM g QUALIFY count(*) OVER (PARTITION BY row_id, win) > 1
), rep AS (
  SELECT row_id, count(DISTINCT i + k) AS n FROM r, unnest([0, 1, 2]) AS u(k) GROUP BY row_id
), x AS (
  SELECT m.*, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words FROM m LEFT JOIN rep USING (row_id)
), f AS (
  SELECT *, CAST((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT
         + 4 * (10 * n_symbols > n_words)::INT + 8 * (word_chars > 60 * n_words)::INT
         + 16 * (n_lines >= 8 AND 10 * n_dup_lines > 9 * n_lines)::INT
         + 32 * (n_words >= 50 AND word_chars < n_words * 1.2)::INT AS BIGINT) AS failed
  FROM x
)
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, failed,
       CAST(2 AS INTEGER) AS policy, failed & 3 <> 0 AS base_failed, failed = 0 AS kept
FROM f
"""

OP11_SQL = """
WITH e AS (
  SELECT row_number() OVER () AS row_id, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS MATERIALIZED (
  SELECT a.row_id AS a, a.vec_id AS anchor_id, b.row_id AS b, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.row_id <> b.row_id AND len(a.v) = len(b.v)
), p AS (
  SELECT a, anchor_id, b AS p, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id NULLS LAST, b) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.a, p.p ORDER BY score DESC, vec_id NULLS LAST, b) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.a = s.a AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""

OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), t AS MATERIALIZED (
  SELECT row_id, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), k AS MATERIALIZED (
  SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT row_id) >= 10
), c AS MATERIALIZED (
  SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY lang, source, term
), g AS (
  SELECT lang, source, coalesce(total, 0) AS total, coalesce(v, 0) AS v
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source) USING (lang, source)
  LEFT JOIN (SELECT lang, count(*) AS v FROM k GROUP BY lang) USING (lang)
), p AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(n, 0) + 2) // (total + 2 * v) AS p
  FROM g JOIN k ON g.lang = k.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), whole AS (
  SELECT lang, sum(total) + 2 * any_value(v) AS below FROM g GROUP BY lang
), q AS (
  SELECT lang, term, 1 + 1000000000::HUGEINT * (sum(n) + 2) // any_value(below) AS q FROM c JOIN whole USING (lang) GROUP BY lang, term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT p.lang, p.source, 'term', p.term, (p - q) * (p - q) // (p + q) FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM found QUALIFY part = 'pair' OR rank <= 10
"""


def queries() -> dict[str, Query]:
    found = (
        op1_license_scan, op2_url_templates, op3_byte_bpe, op4_pii, op5_near_dedup, op6_language_id, op7_bin_packing, op8_exact_dedup, op9_kd_shards, op10_quality_rules,
        op11_hard_negatives, op12_line_blocks, op13_source_divergence,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op2_url_templates": OP2_SQL, "op8_exact_dedup": OP8_SQL, "op10_quality_rules": OP10_SQL, "op11_hard_negatives": OP11_SQL, "op13_source_divergence": OP13_SQL}
