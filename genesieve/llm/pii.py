"""Personal data: base patterns, and gradient-boosted candidates beyond them.

Base spans come from fixed patterns with fixed checks. Around them, generators of
high recall propose wider candidates (digits without a plus sign, in groups or not, spelled-out
addresses, colon-separated hex groups), which may overlap one another, but not a base span. Each candidate is described by its
format and its context in small integers; boosted trees, trained here on generated
labelled lines and on a bounded sample of the documents' own base spans with their formats blurred,
give it a probability, calibrated on lines held back from
training; per kind, the lowest threshold whose held-back precision suffices selects spans.

Spark's SQL functions give matches without their places, so places are summed up
from the lengths of matches and of what lies between them. Trees become one SQL
expression. Overlaps are found by running maxima over sorted spans, so the work grows in proportion to a text's spans. Executors run built-in expressions only; the driver fits the trees on
counts of distinct feature vectors.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise

#: The kinds in their order, and their patterns. Quantifiers are possessive
#: and starts anchored to the run they begin, which matches the same spans in linear time.
KINDS = ("email", "ip", "card", "phone")
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GATE = {"email": "@", "ip": ".", "card": None, "phone": "+"}
#: Candidates beyond the base patterns, and the kind that each generator proposes by.
GENERATORS = {
    "digits": r"(?<![0-9A-Za-z])[(]?[0-9]++(?:[\x20./()-]{1,2}[0-9]++)*+(?![A-Za-z])",
    "spelled": r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,64}+\x20{0,2}(?:[\[(]\x20?at\x20?[\])]|\bat\b)\x20{0,2}[A-Za-z0-9-]{2,63}+(?:\x20{0,2}(?:[\[(]\x20?dot\x20?[\])]|\bdot\b|\.)\x20{0,2}[A-Za-z0-9-]{2,63}+){1,4}+",
    "colons": r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}(?:::?[0-9A-Fa-f]{1,4}){1,7}(?![0-9A-Za-z:])",
}
#: What a text must hold for a generator to be run on it.
GENERATOR_GATE = {"digits": r"[0-9]", "spelled": r"(?i)[a-z0-9][\x20\])(\[]{1,3}at[\x20\])(\[]{1,3}[a-z0-9-]{2,63}[\x20\])(\[]{0,3}(?:\.|dot)", "colons": r"[0-9A-Fa-f]:[0-9A-Fa-f:]"}
#: Which matches are candidates: 7 to 19 digits, of one group 9 to 12; four groups of hex digits, or a gap among them.
PROPOSED = {
    "digits": "length(regexp_replace(x.m, '[^0-9]', '')) between 7 and 19 and (x.m rlike '[0-9][^0-9]+[0-9]' or length(regexp_replace(x.m, '[^0-9]', '')) between 9 and 12)",
    "spelled": "true",
    "colons": "contains(x.m, '::') or x.m rlike '(:.*){3}'",
}
SPAN = "struct<s:bigint,e:bigint,m:string>"
CONTEXT = 24
BLOCK = 256
CHUNK = 2048

#: Words before a candidate, by what they speak for: fixed lists.
PHONE_WORDS = ("call", "tel", "telephone", "phone", "fax", "mobile", "cell", "dial", "whatsapp", "sms")
CARD_WORDS = ("card", "visa", "mastercard", "amex", "credit", "debit", "pan")
MAIL_WORDS = ("mail", "email", "contact", "write", "reach", "address")
IP_WORDS = ("ip", "host", "server", "addr", "ipv6", "login", "from")
OTHER_WORDS = ("order", "invoice", "version", "isbn", "id", "serial", "part", "ref", "date", "page", "ticket", "total")


def _let(name: str, value: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def _running(values: str, join: Callable[[str, str], str]) -> str:
    """SQL for the running result (from 0) before each of ``values``; in blocks, so that long arrays stay cheap."""
    blocks = f"transform(sequence(0, (size(vs) - 1) div {BLOCK}), k -> slice(vs, k * {BLOCK} + 1, {BLOCK}))"
    running = "aggregate({x}, array({first}), (r, v) -> concat(r, array({last})))"
    offsets = running.format(x=f"transform(bl, x -> aggregate(x, 0L, (a, v) -> {join('a', 'v')}))", first="0L", last=join("element_at(r, -1)", "v"))
    inside = running.format(x="x", first="of[k]", last=join("element_at(r, -1)", "v"))
    whole = _let("bl", blocks, _let("of", offsets, f"flatten(transform(bl, (x, k) -> slice({inside}, 1, size(x))))"))
    return _let("vs", values, f"case when size(vs) = 0 then cast(array() as array<bigint>) else {whole} end")


def _sum(a: str, b: str) -> str:
    return f"{a} + {b}"


def _most(a: str, b: str) -> str:
    return f"greatest({a}, {b})"


def _places(text: str, matches: str, pattern_sql: str) -> str:
    """SQL for array<struct<s, e, m>> from a matches column: sums of lengths."""
    between = f"transform(split({text}, {pattern_sql}, -1), x -> cast(length(x) as bigint))"
    steps = f"transform({matches}, (m, i) -> b[i] + length(m))"
    body = f"transform({matches}, (m, i) -> named_struct('s', sm[i] + b[i], 'e', sm[i] + b[i] + length(m), 'm', m))"
    whole = _let("b", between, _let("sm", _running(steps, _sum), body))
    return f"case when size({matches}) = 0 then cast(array() as array<{SPAN}>) else {whole} end"


def _clusters(spans: str) -> str:
    """SQL for ``spans`` (whose first fields are s and e) in order, parted wherever none reaches over: array of arrays."""
    starts = "filter(transform(sp, (x, i) -> case when x.s >= reached[i] then i end), i -> i is not null)"
    parts = "transform(st, (i, j) -> slice(sp, i + 1, coalesce(try_element_at(st, j + 2), size(sp)) - i))"
    return _let("sp", f"array_sort({spans})", _let("reached", _running("transform(sp, x -> x.e)", _most), _let("st", starts, parts)))


def _free(spans: str) -> str:
    """SQL for those ``spans`` (s, e, base, ...) that are not base and overlap none that is: each is held against the bases that begin before it and after it."""
    left = _running("transform(sp, x -> if(x.base, x.e, 0L))", _most)
    # from the right: the least start, as the running maximum of its distance to the end of all
    right = f"reverse({_running('reverse(transform(sp, x -> if(x.base, top - x.s, 0L)))', _most)})"
    clear = "filter(transform(sp, (x, i) -> case when not x.base and l[i] <= x.s and top - r[i] >= x.e then x end), x -> x is not null)"
    top = "aggregate(sp, 0L, (a, x) -> greatest(a, x.e))"
    return _let("sp", f"array_sort({spans})", _let("top", top, _let("l", left, _let("r", right, clear))))


def _chunks(text: str) -> str:
    """SQL for the text in parts of CHUNK characters: to cut a long text at a place, Spark counts its characters from the beginning."""
    return f"transform(sequence(0, length({text}) div {CHUNK}), k -> substring({text}, k * {CHUNK} + 1, {CHUNK}))"


def _cut(chunks: str, start: str, end: str) -> str:
    """SQL for the characters from start to end."""
    part = f"array_join(slice({chunks}, cast({start} div {CHUNK} as int) + 1, cast({end} div {CHUNK} - {start} div {CHUNK} as int) + 1), '')"
    return f"substring({part}, cast({start} % {CHUNK} as int) + 1, cast({end} - {start} as int))"


def _quoted(pattern: str) -> str:
    return "r'" + pattern.replace("'", "\\'") + "'"


def _with_spans(rows: DataFrame, patterns: dict[str, tuple[str, Column]]) -> DataFrame:
    """Add one span array per name; matches are a column of their own, so that each pattern is run once for them."""
    rows = rows.withColumns({f"_m_{n}": F.when(gate, F.regexp_extract_all("_text", F.lit(p), 0)).otherwise(F.array().cast("array<string>")) for n, (p, gate) in patterns.items()})
    rows = rows.withColumns({n: F.expr(_places("_text", f"_m_{n}", _quoted(p))) for n, (p, _) in patterns.items()})
    return rows.drop(*[f"_m_{n}" for n in patterns])


def _passes(kind: str) -> str:
    """The check of a base match ``x.m``."""
    digits = "regexp_replace(x.m, '[^0-9]', '')"
    return {
        "email": "true",
        "ip": "forall(split(x.m, '[.]'), p -> length(ltrim('0', p)) <= 3 and cast(concat('0', right(ltrim('0', p), 3)) as int) <= 255)",
        "card": f"length({digits}) between 13 and 19 and luhn_check({digits})",
        "phone": f"length({digits}) between 9 and 15",
    }[kind]


def base_spans(rows: DataFrame) -> DataFrame:
    """Add a span array per base kind, matches that fail their check dropped. Needs ``_text``, not null."""
    digit = F.col("_text").rlike("[0-9]")
    gates = {k: (digit if g is None else F.contains("_text", F.lit(g)) & (F.lit(True) if k == "email" else digit)) for k, g in GATE.items()}
    rows = _with_spans(rows, {k: (BASE[k], gates[k]) for k in KINDS})
    return rows.withColumns({k: F.expr(f"filter({k}, x -> {_passes(k)})") for k in KINDS})


def _has_word(words: tuple[str, ...]) -> str:
    return f"cast(lower(x.left) rlike r'(?<![a-z])({'|'.join(words)})(?![a-z])' as int)"


def _candidates(rows: DataFrame) -> DataFrame:
    """Add ``_cand``: array of struct(g, s, e, m, left, right) from every generator."""
    rows = _with_spans(rows, {f"_g_{g}": (p, F.col("_text").rlike(GENERATOR_GATE[g])) for g, p in GENERATORS.items()})
    rows = rows.withColumn("_ch", F.expr("case when {} = 0 then array('') else {} end".format(" + ".join(f"size(_g_{g})" for g in GENERATORS), _chunks("_text"))))
    parts = []
    for i, g in enumerate(GENERATORS):
        parts.append(f"transform(filter(_g_{g}, x -> {PROPOSED[g]}), x -> named_struct('g', {i}, 's', x.s, 'e', x.e, 'm', x.m, 'left', {_cut('_ch', f'greatest(x.s - {CONTEXT}, 0L)', 'x.s')}, 'right', {_cut('_ch', 'x.e', '(x.e + 1)')}))")
    return rows.withColumn("_cand", F.expr(f"concat({', '.join(parts)})")).drop("_ch", *[f"_g_{g}" for g in GENERATORS])


#: Feature name -> SQL over a candidate ``x``; all small integers.
FEATURES = {
    "generator": "x.g",
    "digits": "length(regexp_replace(x.m, '[^0-9]', ''))",
    "groups": "least(size(split(trim(regexp_replace(x.m, '[^0-9A-Za-z]+', ' ')), ' ')), 12)",
    "last_group": "least(length(regexp_extract(x.m, '([0-9A-Fa-f]+)$', 1)), 12)",
    "first_group": "least(length(regexp_extract(x.m, '^[(]?([0-9A-Fa-f]+)', 1)), 12)",
    "middle_three": "cast(x.m rlike '[^0-9][0-9]{3}[^0-9]' as int)",
    "parens": "cast(contains(x.m, '(') as int)",
    "dashes": "cast(contains(x.m, '-') as int)",
    "dots": "cast(contains(x.m, '.') as int)",
    "slashes": "cast(contains(x.m, '/') as int)",
    "blanks": "cast(contains(x.m, ' ') as int)",
    "luhn": "cast(coalesce(luhn_check(nullif(regexp_replace(x.m, '[^0-9]', ''), '')), false) as int)",
    "fours": "cast(x.m rlike '^[0-9]{4}[^0-9][0-9]{4}[^0-9][0-9]{4}[^0-9][0-9]{4}$' as int)",
    "bracket_at": "cast(lower(x.m) rlike '[\\\\[(] ?at' as int)",
    "spelled_dot": "cast(lower(x.m) rlike '(dot)' as int)",
    "ends_in_domain": "cast(lower(x.m) rlike '[^a-z](com|org|net|edu|gov|io|de|fr|es|uk|eu|info)$' as int)",
    "hex_letters": "cast(x.m rlike '[A-Fa-f]' as int)",
    "year_first": "cast(x.m rlike '^(19|20)[0-9]{2}[^0-9]' as int)",
    "zero_first": "cast(x.m rlike '^[(]?0' as int)",
    "phone_word": _has_word(PHONE_WORDS),
    "card_word": _has_word(CARD_WORDS),
    "mail_word": _has_word(MAIL_WORDS),
    "ip_word": _has_word(IP_WORDS),
    "other_word": _has_word(OTHER_WORDS),
    "gap": "cast(contains(x.m, '::') as int)",
    "letter_after": "cast(x.right rlike '[0-9A-Za-z]' as int)",
}
#: Which base kind a generator's accepted candidate becomes; digit groups of 13 and more are cards.
KIND_OF = "case when x.g = 1 then 'email' when x.g = 2 then 'ip' when length(regexp_replace(x.m, '[^0-9]', '')) >= 13 then 'card' else 'phone' end"


@dataclass(frozen=True)
class Model:
    """Boosted trees as (feature, bound, feature, bound, four leaves), a calibration (scale, shift) and thresholds by kind."""

    start: float
    trees: tuple[tuple, ...]
    scale: float
    shift: float
    thresholds: dict[str, float]

    def score_sql(self, features: str) -> str:
        """The calibrated probability, from a struct of features."""
        total = [f"{self.start!r}D"]
        for f, b, left, right in self.trees:
            arm = lambda side: f"case when {features}.{side[0]} <= {side[1]} then {side[2]!r}D else {side[3]!r}D end"
            total.append(f"case when {features}.{f} <= {b} then {arm(left)} else {arm(right)} end")
        return f"1D / (1D + exp(-({self.scale!r}D * ({' + '.join(total)}) + {self.shift!r}D)))"


def _best_split(x: np.ndarray, values: list[np.ndarray], g: np.ndarray, h: np.ndarray, inside: np.ndarray) -> tuple[int, int]:
    """(feature, bound) of the best split of the rows ``inside``, by the usual second-order gain; ``x`` holds places among each feature's ``values``."""
    x, g, h = x[inside], g[inside], h[inside]
    best = (-1.0, 0, 10**6)
    for f, own in enumerate(values):
        n = np.bincount(x[:, f], minlength=len(own)) > 0
        left_g, left_h = (np.cumsum(np.bincount(x[:, f], w, len(own)))[n][:-1] for w in (g, h))
        if len(left_g):
            gain = left_g**2 / (left_h + 1) + (g.sum() - left_g) ** 2 / (h.sum() - left_h + 1) - g.sum() ** 2 / (h.sum() + 1)
            at = int(gain.argmax())
            if gain[at] > best[0] + 1e-12:
                best = (float(gain[at]), f, int(own[n][at]))
    return best[1:]


def fit(counts: list[tuple[tuple, str, int, int, int]], rounds: int = 40, rate: float = 0.4, precision: float = 0.98) -> Model:
    """Fit to (features, kind, label, fold, count) rows: fold 0 calibrates and sets thresholds, the others train."""
    names = list(FEATURES)
    train = [(x, y, n) for x, _, y, fold, n in counts if fold]
    raw = np.array([x for x, _, _ in train], np.int64).reshape(len(train), len(names))
    y, n = (np.array([t[i] for t in train], float) for i in (1, 2))
    values, places = zip(*[np.unique(raw[:, f], return_inverse=True) for f in range(len(names))], strict=True)
    places = np.stack(places, axis=1)
    start = math.log(((n * y).sum() + 1) / ((n * (1 - y)).sum() + 1))
    scores = np.full(len(train), start)
    trees = []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-scores))
        g, h = n * (y - p), n * p * (1 - p)
        f, b = _best_split(places, values, g, h, np.ones(len(train), bool))
        sides = []
        for part in (raw[:, f] <= b, raw[:, f] > b):
            f2, b2 = _best_split(places, values, g, h, part)
            leaves = []
            for leaf in (part & (raw[:, f2] <= b2), part & (raw[:, f2] > b2)):
                leaves.append(round(float(rate * g[leaf].sum() / (h[leaf].sum() + 1)), 9))
                scores[leaf] += leaves[-1]
            sides.append((names[f2], b2, *leaves))
        trees.append((names[f], b, *sides))
    held = [(start + sum(_leaf(t, dict(zip(names, x, strict=True))) for t in trees), kind, y, n) for x, kind, y, fold, n in counts if not fold]
    scale, shift = _platt(held)
    thresholds = {}
    for kind in KINDS:
        own = sorted(((1 / (1 + math.exp(-(scale * s + shift))), y, n) for s, k, y, n in held if k == kind), reverse=True)
        best, good, bad = 1.1, 0, 0  # 1.1: nothing is selected
        for i, (p, y, n) in enumerate(own):
            good, bad = good + n * y, bad + n * (1 - y)
            if (i + 1 == len(own) or own[i + 1][0] < p) and good / (good + bad) >= precision:
                best = (p + (own[i + 1][0] if i + 1 < len(own) else 0.0)) / 2  # midway to what comes next
        thresholds[kind] = max(0.5, best)
    return Model(start, tuple(trees), scale, shift, thresholds)


def _leaf(tree: tuple, x: dict) -> float:
    f, b, left, right = tree
    f2, b2, low, high = left if x[f] <= b else right
    return low if x[f2] <= b2 else high


def _platt(held: list) -> tuple[float, float]:
    """Logistic calibration of scores, by Newton's method with a small ridge."""
    a, c = 1.0, 0.0
    for _ in range(25):
        ga = gc = 0.0
        haa = hcc = 1e-3
        hac = 0.0
        for s, _, y, n in held:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, a * s + c))))
            w = n * p * (1 - p)
            ga, gc = ga + n * (y - p) * s, gc + n * (y - p)
            haa, hac, hcc = haa + w * s * s, hac + w * s, hcc + w
        ga, gc = ga - 1e-3 * (a - 1), gc - 1e-3 * c
        det = haa * hcc - hac * hac
        a, c = a + (hcc * ga - hac * gc) / det, c + (haa * gc - hac * ga) / det
    return a, c


def training_lines(spark: SparkSession, per_form: int = 150) -> DataFrame:
    """Generated labelled lines (_text, label, fold): ``per_form`` of each form below; '#' is a digit, '@' a hex digit."""
    good = {
        "phone": ["(###) ###-####", "(###) ### ####", "###-###-####", "###.###.####", "0## #### ####", "00## ### ### ####", "0### ######", "### ### ####"],
        "mail": ["ana.k## [at] example [dot] com", "joe## (at) example.org", "kim## at example dot net", "lee_## [at] mail## dot example dot org", "eva## at mail.example dot com", "max## at example.org"],
        "ip": ["20@@:@@@@:@@@@:@@@@:@@@@:@@@@:@@@@:@@@@", "fe80:@@@@:@@@:@@:@@@@:@@@@:@@@:@", "20##:@@@@::@@", "fe80::@@@@:@@@@", "20##:db8::@"],
        "card": ["####.####.####.####", "#### / #### / #### / ####"],
    }
    bad = {
        "phone": ["20##-##-##", "19##/##/##", "##.###.###", "###.###.###", "# ### ###", "978-#-####-####-#", "###-##-######-##", "#.##.###.##", "## ## ## ## ##", "#######-#", "### ### ###", "#### ########", "1## ###.##", "####-####", "##-##-20## ##:##"],
        "mail": ["look at this dot here", "meet at noon dot then", "stay at home. and", "was at there. The", "arrive at ten dot matrix", "meet at noon.then go", "look at this.that one"],
        "ip": ["##:##:##:##", "@@:@@:@@:@@:@@:@@", "#:#:#:#", "ab::cd", "a::b", "dead::beef"],
        "card": ["####.####.####.###", "################ ##", "##### ##### #####", "###.###.###.###.###", "# ### ### ### ### ###"],
    }
    # runs of digits are telephone numbers only where a word says so
    told = {"phone": ["##########", "0##########", "#########"]}
    words = {"phone": PHONE_WORDS, "mail": MAIL_WORDS, "ip": IP_WORDS, "card": CARD_WORDS}
    other = " ".join(OTHER_WORDS)
    rows = [(form, 1, " ".join(words[k]), other, 2, k) for k, forms in good.items() for form in forms]
    rows += [(form, 0, other, " ".join(words[k]), 2, k) for k, forms in bad.items() for form in forms]
    rows += [(form, 1, " ".join(words[k]), other, 5, k) for k, forms in told.items() for form in forms]
    rows += [(form, 0, other, other, 2, k) for k, forms in told.items() for form in forms]
    forms = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "form int, shape string, label int, words string, wrong string, own int, kind string")
    lines = forms.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(per_form - 1))))
    filled = "array_join(transform(split(shape, ''), (ch, j) -> case when ch = '#' then cast(pmod(hash(form, i, j), 10) as string) when ch = '@' then substr('0123456789abcdef', pmod(hash(form, i, j), 16) + 1, 1) else ch end), '')"
    lines = lines.withColumn("x", F.expr(filled))
    # a card's last digit is set so that it passes Luhn
    tail = F.expr("filter(transform(sequence(0, 9), d -> concat(left(x, length(x) - 1), cast(d as string))), c -> luhn_check(regexp_replace(c, '[^0-9]', '')))[0]")
    lines = lines.withColumn("x", F.when((F.col("kind") == "card") & (F.col("label") == 1), tail).otherwise(F.col("x")))
    # of five lines two (all, where only the word tells) have a word of their own before, one has one that misleads, the others none
    pick = lambda words: f"split({words}, ' ')[pmod(hash(i, form, 7), size(split({words}, ' ')))]"
    lines = lines.withColumn("turn", F.pmod(F.hash("i", "form"), F.lit(5)))
    word = F.expr(f"case when turn < own then {pick('words')} when turn = 2 and own = 2 then {pick('wrong')} end")
    lead = F.when(word.isNull(), F.element_at(F.array(F.lit("and thus "), F.lit(""), F.lit("See: ")), F.pmod(F.hash("form", "i"), F.lit(3)) + 1))
    lead = lead.otherwise(F.concat(F.element_at(F.array(F.lit("so the "), F.lit("My "), F.lit("")), F.pmod(F.hash("form", "i"), F.lit(3)) + 1), word, F.element_at(F.array(F.lit(" "), F.lit(": "), F.lit(" is ")), F.pmod(F.hash("i"), F.lit(3)) + 1)))
    return lines.select(F.concat(lead, F.col("x"), F.lit(" then more")).alias("_text"), "label", F.pmod(F.hash("form", "i", F.lit(3)), F.lit(3)).alias("fold"))


def weak_lines(docs: DataFrame, most_docs: int = 2000, per_doc: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Labelled lines from the documents themselves: in their own contexts, telephone numbers without the plus sign, and addresses and cards written another way.

    They come from about ``most_docs`` documents, chosen by a hash of id and text, and at most ``per_doc`` spans of a kind of each.
    What failed its check, blurred alike, is labelled 0. Base spans themselves need no model.
    """
    n = docs.count()
    drawn = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)), F.lit(1 << 20))
    rows = docs.where(F.col(text_col).isNotNull() & (drawn < F.lit(min(1.0, most_docs / max(1, n)) * (1 << 20)))).select(drawn.alias("h"), F.col(text_col).alias("_text"))
    rows = _with_spans(rows, {k: (BASE[k], F.col("_text").rlike("[0-9@]")) for k in KINDS})
    blur = {
        "email": "concat(substring_index(x.m, '@', 1), if(pmod(hash(x.m), 2) = 0, ' [at] ', ' at '), replace(substring_index(x.m, '@', -1), '.', ' dot '))",
        "card": "regexp_replace(x.m, '([0-9]{4})[ -]?(?=[0-9])', '$1.')",
        "phone": "regexp_replace(x.m, '^[+](1[^0-9]+)?', '')",
    }
    left = f"substring(_text, cast(greatest(x.s - {CONTEXT}, 0) + 1 as int), cast(least(x.s, {CONTEXT}) as int))"
    right = f"substring(_text, cast(x.e + 1 as int), {CONTEXT})"
    lines = [f"transform(slice({k}, 1, {per_doc}), x -> named_struct('text', concat({left}, {sql}, {right}), 'label', cast({_passes(k)} as int)))" for k, sql in blur.items()]
    rows = rows.select("h", F.explode(F.expr(f"concat({', '.join(lines)})")).alias("x"))
    return rows.select(F.col("x.text").alias("_text"), F.col("x.label").alias("label"), F.pmod("h", F.lit(3)).cast("int").alias("fold"))


def _described(rows: DataFrame) -> DataFrame:
    """Add ``_f``: for each candidate, its span, kind and features."""
    features = ", ".join(f"'{n}', {sql}" for n, sql in FEATURES.items())
    return rows.withColumn("_f", F.expr(f"transform(_cand, x -> named_struct('s', x.s, 'e', x.e, 'kind', {KIND_OF}, {features}))"))


def train(spark: SparkSession, docs: DataFrame | None = None, per_form: int = 150) -> Model:
    """Fit on generated lines, and on lines from ``docs`` if given; only counts of distinct feature vectors reach the driver (fewer than there are lines)."""
    lines = training_lines(spark, per_form)
    # written first, so that the candidates' expressions stand in the plan once
    lines = materialise(lines if docs is None else lines.unionByName(weak_lines(docs)), "pii-lines")
    found = _described(_candidates(lines)).select("label", "fold", F.explode("_f").alias("x"))
    rows = found.groupBy("label", "fold", "x.kind", *[f"x.{n}" for n in FEATURES]).agg(F.count(F.lit(1)).alias("n")).collect()
    counts = [(tuple(r[n] for n in FEATURES), r["kind"], r["label"], r["fold"], r["n"]) for r in rows]
    return fit(sorted(counts))


def added_of(sure: str) -> str:
    """SQL for the spans (kind, s, e) that stay of ``sure`` (s, e, base, p, kind): the likeliest first, each unless it overlaps one that stays. Only spans that meet are compared."""
    none = "cast(array() as array<struct<kind:string,s:bigint,e:bigint>>)"
    order = "transform(array_sort(transform(c, x -> named_struct('p', -x.p, 'n', x.s - x.e, 's', x.s, 'e', x.e, 'kind', x.kind))), x -> named_struct('kind', x.kind, 's', x.s, 'e', x.e))"
    greedy = f"aggregate({order}, {none}, (a, x) -> if(exists(a, y -> x.s < y.e and y.s < x.e), a, concat(a, array(x))))"
    added = f"array_sort(flatten(transform({_clusters(sure)}, c -> {greedy})), (x, y) -> case when x.s < y.s then -1 when x.s > y.s then 1 else 0 end)"
    return f"case when size({sure}) = 0 then {none} else {added} end"


def find_spans(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, one array of base spans (s, e, m) per kind, and ``added``: array<struct<kind, s, e>> of the model's spans.

    Places count code points from 0, end exclusive. A null text counts as empty; texts of any length are read whole. An
    added span overlaps no base span, and of overlapping added ones the likelier
    (then the longer, then the first) stays, and so on among those that it doesn't overlap. Rows that repeat an id, or have none, are searched each;
    an empty table gives an empty result. ``keep`` names columns of ``docs`` to carry, as ``_keep_`` and their name; others are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"), *[F.col(c).alias(f"_keep_{c}") for c in keep])
    rows = _described(_candidates(base_spans(rows)))
    limit = " ".join(f"when '{k}' then {v!r}D" for k, v in model.thresholds.items())
    scored = f"transform(_f, x -> named_struct('s', x.s, 'e', x.e, 'base', false, 'p', {model.score_sql('x')}, 'kind', x.kind))"
    rows = rows.withColumn("_sure", F.expr(f"filter({scored}, x -> x.p >= case x.kind {limit} end)"))
    base = ", ".join(f"transform({k}, x -> named_struct('s', x.s, 'e', x.e, 'base', true, 'p', 0D, 'kind', '{k}'))" for k in KINDS)
    rows = rows.withColumn("_sure", F.expr(f"case when size(_sure) = 0 then _sure else {_free(f'concat(_sure, {base})')} end"))
    rows = rows.withColumn("added", F.expr(added_of("_sure")))
    return rows.drop("_cand", "_f", "_sure")


def spans_text(columns: dict[str, str]) -> Column:
    """``kind:start:end`` of the arrays, by kind as listed, then start, joined by commas."""
    parts = [f"transform(array_sort(transform({sql}, x -> named_struct('s', x.s, 'e', x.e))), x -> concat('{k}:', x.s, ':', x.e))" for k, sql in columns.items()]
    return F.expr(f"array_join(concat({', '.join(parts)}), ',')")


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (base and added)."""
    both = {k: f"concat(transform({k}, x -> named_struct('s', x.s, 'e', x.e)), transform(filter(added, x -> x.kind = '{k}'), x -> named_struct('s', x.s, 'e', x.e)))" for k in KINDS}
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(spans_text({k: k for k in KINDS}), 256).alias("base_sha256"), spans_text(both).alias("spans"))


def redact(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in angle brackets; other columns, and texts without spans, stay as they are.

    So do null and empty texts. Every row is one of the result, those that repeat an id or have none as well; an empty table gives an empty result.
    """
    keep = tuple(docs.columns)
    found = find_spans(docs, model, id_col, text_col, keep)
    spans = "concat({}, added)".format(", ".join(f"transform({k}, x -> named_struct('kind', '{k}', 's', x.s, 'e', x.e))" for k in KINDS))
    found = found.withColumn("_spans", F.expr(f"array_sort(transform({spans}, x -> named_struct('s', x.s, 'e', x.e, 'kind', x.kind)))"))
    # spans of different kinds may overlap: what overlaps is one redaction, named by the span that begins first
    joined = f"transform({_clusters('_spans')}, c -> named_struct('s', c[0].s, 'e', array_max(transform(c, x -> x.e)), 'kind', c[0].kind))"
    found = found.withColumn("_spans", F.expr(f"case when size(_spans) = 0 then _spans else {joined} end"))
    found = found.withColumn("_ch", F.expr(f"case when size(_spans) = 0 then array('') else {_chunks('_text')} end"))
    gone = "if(i = 0, 0L, _spans[i - 1].e)"
    pieces = f"transform(_spans, (x, i) -> concat({_cut('_ch', gone, 'x.s')}, '<', x.kind, '>'))"
    rest = _cut("_ch", "element_at(_spans, -1).e", "cast(length(_text) as bigint)")
    text = f"case when size(_spans) = 0 then _keep_{text_col} else concat(array_join({pieces}, ''), {rest}) end"
    return found.withColumn("_new", F.expr(text)).select(*[(F.col("_new") if c == text_col else F.col(f"_keep_{c}")).alias(c) for c in keep])
