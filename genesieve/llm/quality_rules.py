"""Quality rules kept as a bitmask ledger.

Every rule is evaluated once per document; the ledger stores the measurements and
one failure bit per rule. Policies are versions: a mask of rules that count. A
verdict is ``failed & mask = 0``, and an ablation (what would a policy keep without
one of its rules) is a bitwise aggregate over the ledger, which never reads the
texts again. All of it is built-in SQL expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The characters that part words, and the symbols that are counted.
SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A named failure condition over the ledger's measurements; its bit is its place in the list."""

    name: str
    fails: str


#: The order fixes the bits: only ever append.
RULES = (
    Rule("too_few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbol_heavy", "10 * n_symbols > n_words"),
    Rule("word_too_long_on_average", "word_chars > 60 * n_words"),
    Rule("duplicate_lines", "n_lines >= 8 and 10 * n_dup_lines > 9 * n_lines"),
    Rule("very_short_words", "n_words >= 50 and word_chars < n_words * 1.2"),
)
BASE_RULES = ("too_few_words", "repeated_windows")
#: Versioned policies: the rules that each version applies.
POLICIES = {1: BASE_RULES, 2: (*BASE_RULES, "symbol_heavy", "word_too_long_on_average", "duplicate_lines", "very_short_words")}
CURRENT_POLICY = 2


def policy_mask(version: int, rules: tuple[Rule, ...] = RULES) -> int:
    names = [r.name for r in rules]
    return sum(1 << names.index(n) for n in POLICIES[version])


def _measure(text: Column) -> Column:
    """struct(n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words) of one text, never null."""
    trimmed = F.trim(F.translate(text, SPACE[1:], " " * (len(SPACE) - 1)))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, " +"))
    lines = F.filter(F.split(text, "\n"), lambda line: F.translate(line, SPACE, "") != "")
    return F.struct(
        words.alias("words"),
        F.length(F.translate(text, SPACE, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
    )


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, the measurements as longs, and ``failed`` (bigint, bit i for rule i).

    A null text has no words and no lines, like an empty one. ``n_repeat_words``
    counts the words that lie in a three-word window which the text holds at least
    twice, first places included. Rows that repeat an id are measured each; other
    columns are ignored; an empty table gives an empty ledger.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    rows = rows.select("doc_id", _measure(F.col("_text")).alias("_m")).select("doc_id", "_m.*")
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    rows = rows.withColumn("_windows", F.expr("case when n_words < 3 then array() else transform(sequence(0, cast(n_words as int) - 3), i -> xxhash64(words[i], words[i + 1], words[i + 2])) end"))
    # windows with an equal hash are rare: only then are the windows themselves compared
    rows = rows.withColumn("_suspect", F.size(F.array_distinct("_windows")) < F.size("_windows"))
    window = "concat_ws(' ', words[i], words[i + 1], words[i + 2])"
    rows = rows.withColumn("_sorted", F.expr(f"case when _suspect then array_sort(transform(sequence(0, cast(n_words as int) - 3), i -> struct(_windows[i] as h, {window} as w, i as i))) end"))
    at = "filter(transform(_sorted, (x, j) -> case when (j > 0 and _sorted[j - 1].h = x.h and _sorted[j - 1].w = x.w) or (j < size(_sorted) - 1 and _sorted[j + 1].h = x.h and _sorted[j + 1].w = x.w) then x.i end), p -> p is not null)"
    rows = rows.withColumn("_at", F.expr(f"case when _suspect then {at} end"))
    rows = rows.withColumn("n_repeat_words", F.expr("case when _suspect then size(array_distinct(flatten(transform(_at, p -> array(p, p + 1, p + 2))))) else 0 end").cast("long"))
    rows = rows.withColumns({"n_lines": F.size("lines").cast("long"), "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")})
    failed = F.lit(0).cast("long")
    for bit, rule in enumerate(rules):
        failed = failed.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << bit)).otherwise(F.lit(0)).cast("long"))
    return rows.withColumn("failed", failed).select("doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "failed")


def apply_policy(led: DataFrame, version: int = CURRENT_POLICY) -> DataFrame:
    """Add base_failed, policy and kept; a document that fails a base rule is never kept."""
    base = policy_mask(1)
    mask = policy_mask(version) | base
    return led.withColumns({"policy": F.lit(version), "base_failed": F.col("failed").bitwiseAND(F.lit(base)) != 0, "kept": F.col("failed").bitwiseAND(F.lit(mask)) == 0})


def ablations(led: DataFrame, version: int = CURRENT_POLICY, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per rule of the policy: rows failing it, and rows that only it rejects (kept if it were dropped)."""
    mask = policy_mask(version, rules)
    hit = F.col("failed").bitwiseAND(F.lit(mask))
    sums = []
    for bit, rule in enumerate(rules):
        if mask >> bit & 1:
            sums += [F.count_if(hit.bitwiseAND(F.lit(1 << bit)) != 0).alias(f"f_{rule.name}"), F.count_if(hit == (1 << bit)).alias(f"o_{rule.name}")]
    one = led.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(hit == 0).alias("n_kept"), *sums)
    names = [r.name for b, r in enumerate(rules) if mask >> b & 1]
    stack = ", ".join(f"'{n}', f_{n}, o_{n}" for n in names)
    return one.selectExpr("n_rows", "n_kept", f"stack({len(names)}, {stack}) as (rule, n_failed, n_only)")
