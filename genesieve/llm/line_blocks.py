"""Main text of web pages by the distribution of text over lines.

Markup is stripped to lines: each block of text is a line, and each container or
piece of furniture (menus, adverts, forms, comments and the like) leaves empty ones.
A line weighs as many characters as it has outside links. Weights are summed over a window
that slides down the lines. Where the sums surge from 0 to a bound the main text begins, and where they
dive to 0 again it ends; text between surge and dive is kept whole, other runs of lines are left out.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lines of a window, and the sum at which the main text surges: this many characters, or this share of the page's largest sum.
WINDOW, SURGE, SURGE_SHARE = 3, 80, 0.1
#: Where a page marks its article, lines in it weigh this much more, and all others this much less.
INSIDE, OUTSIDE = 100.0, 0.1

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>""")
PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
WORDS = re.compile(r"[a-z]+|[0-9]+")

#: Element names by what they do to text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template svg math iframe object canvas textarea title audio video".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CONTAINERS = frozenset("article main section div ul ol dl table body tbody blockquote figure details".split())
FURNITURE = frozenset("nav footer aside form menu dialog button select noscript".split())
#: Words of class names, ids and roles that name furniture.
NAMED = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial sponsor sponsored promo promos promotion promoted banner sidebar rail menu menus nav navbar navigation navi breadcrumb breadcrumbs "
    "cookie cookies consent gdpr notice notices notification notifications alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations "
    "comment comments commentlist disqus reply replies respond footer masthead topbar toolbar pagination pager widget widgets copyright disclaimer search contentinfo complementary skiplink".split()
)
#: Before such a word, the class tells of the page's layout, as in "has-sidebar".
LAYOUT = frozenset(("with", "has", "no", "is", "without"))
HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(text)} if "=" in text or "hidden" in text else {}


def is_furniture(name: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether an element holds none of the main text, by its name, class, id and role. The page's own containers never are furniture."""
    if name in FURNITURE or (name == "header" and not in_article):
        return True
    if not attributes or name in ("html", "body", "main"):
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or HIDDEN_STYLE.search(attributes.get("style", "")):
        return True
    named = " ".join(attributes.get(k, "") for k in ("class", "id", "role"))
    for one in f"{named} {CAMEL.sub('-', named)}".lower().split():
        words = WORDS.findall(one)
        if any(w in NAMED and (i == 0 or words[i - 1] not in LAYOUT) for i, w in enumerate(words)):
            return True
        if not in_article and words and words[-1] == "header" and name in ("div", "section"):
            return True
    return False


class _Lines:
    """Lines as they come: text, characters outside links, and the landmark (2 article, 1 main, 0 none) that they lie in."""

    def __init__(self) -> None:
        self.lines: list[tuple[str, int, int]] = []
        self.parts: list[str] = []
        self.plain = 0
        self.landmark = 0

    def add(self, text: str, linked: bool) -> None:
        self.parts.append(text)
        if not linked:
            self.plain += sum(map(len, text.split()))

    def end(self, empty: int = 0) -> None:
        text = " ".join("".join(self.parts).split()) if self.parts else ""
        if text:
            self.lines.append((text, self.plain, self.landmark))
        self.lines.extend([("", 0, self.landmark)] * empty)
        self.parts, self.plain = [], 0


def strip_markup(page: str) -> list[tuple[str, int, int]]:
    """One pass over the page. Tags, comments, scripts and furniture are gone; an element that is never closed ends with the one around it."""
    out, stack, open_names = _Lines(), [], Counter()
    skipping, landmarks, links = 0, [], 0  # height of the stack inside furniture; heights of landmarks; open links
    at, size, seen_article, tag = 0, len(page), False, TAG
    last_end = page.rfind(">")  # no tag ends after it

    def close_to(height: int) -> None:
        nonlocal skipping, links
        while len(stack) > height:
            name = stack.pop()
            open_names[name] -= 1
            links -= name == "a"
            if skipping and len(stack) < skipping:
                skipping = 0
                out.end(0 if landmarks else WINDOW)
            if landmarks and len(stack) < landmarks[-1][0]:
                out.end(WINDOW)
                landmarks.pop()
                out.landmark = landmarks[-1][1] if landmarks else 0

    while at < size:
        mark = page.find("<", at)
        if mark != at and not skipping:
            out.add(html.unescape(page[at : mark if mark >= 0 else size]), links > 0)
        if mark < 0:
            break
        if page.startswith("<!--", mark):
            end = page.find("-->", mark + 4)
            at = end + 3 if end >= 0 else size
            continue
        if page[mark + 1 : mark + 2] in ("!", "?"):
            end = page.find(">", mark)
            at = end + 1 if end >= 0 else size
            continue
        found = tag.match(page, mark) if mark < last_end else None
        if not found:
            if mark < last_end and tag is TAG and page[mark + 1 : mark + 3].lstrip("/")[:1].isalpha():
                # a quote that is never closed: from here on, quotes mean nothing
                tag = PLAIN_TAG
                continue
            if not skipping:
                out.add("<", links > 0)
            at = mark + 1
            continue
        at, closing, name = found.end(), found.group(1), found.group(2).lower()
        if closing:
            if open_names[name]:
                if name not in INLINE:
                    out.end()
                height = len(stack) - 1
                while stack[height] != name:
                    height -= 1
                close_to(height)
            if not skipping and name not in INLINE:
                out.end(1 if name in CONTAINERS and not landmarks else 0)
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, at)
            after = page.find(">", end.start()) if end else -1
            at = after + 1 if after >= 0 else size
            continue
        article = name == "article"
        landmark = article or name == "main"
        attributes = _attributes(found.group(3))
        if not skipping or (landmark and not seen_article):
            furniture = is_furniture(name, attributes, bool(landmarks))
            if skipping and not furniture:
                close_to(skipping - 1)  # furniture that was never closed
            if not skipping:
                if name not in INLINE:
                    out.end(1 if name in CONTAINERS and not landmarks else 0)
                if furniture and name not in VOID:
                    if name in INLINE:
                        out.add(" ", True)
                    out.end(0 if landmarks else WINDOW)
                    skipping = len(stack) + 1
                elif landmark or attributes.get("role") == "main":
                    seen_article = seen_article or article
                    out.end(WINDOW)
                    landmarks.append((len(stack) + 1, 2 if article or any(v == 2 for _, v in landmarks) else 1))
                    out.landmark = landmarks[-1][1]
        if name not in VOID and not found.group(3).endswith("/"):
            stack.append(name)
            open_names[name] += 1
            links += name == "a"
        elif skipping > len(stack):
            skipping = 0
    out.end()
    return out.lines


def main_text(page: str) -> str:
    """The text between surges and dives, lines joined by one space."""
    lines = strip_markup(page)
    marked = max((mark for text, _, mark in lines if text), default=0)
    weights = []
    for text, plain, mark in lines:
        if marked:
            plain = INSIDE * len(text) if mark == marked else OUTSIDE * plain
        weights.append(float(plain))
    total = [0.0, *accumulate(weights)]
    half, n = WINDOW // 2, len(lines)
    blocks = [total[min(n, i + half + 1)] - total[max(0, i - half)] for i in range(n)]
    greatest = max(blocks, default=0.0)
    surge = SURGE if marked else min(greatest, max(SURGE, SURGE_SHARE * greatest))
    kept: list[str] = []
    start, risen = 0, False
    for i in range(n + 1):
        if i == n or blocks[i] <= 1e-6:  # a dive, or no surge yet
            if risen:
                kept += [text for text, _, _ in lines[start:i] if text]
            start, risen = i + 1, False
        elif blocks[i] >= surge:
            risen = True
    return " ".join(kept)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars.

    A page without main text, an empty and a null one have an empty text. Every row is a page, whatever its id and url (null, repeated), and stays.
    Pages of any length are read whole, in time that grows with their length. Other columns are ignored, whatever their names; an
    empty table gives an empty result. No row depends on another, so nothing is shuffled.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(value.as_py() or "") for value in batch.column(2)]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    used = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return used.mapInArrow(work, "page_id long, url string, text string, n_chars long")
