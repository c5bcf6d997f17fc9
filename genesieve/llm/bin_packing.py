"""Best-fit packing by minimum bin slack.

Documents are tokenised and cut into pieces of at most the sequence's capacity.
How full sequences get depends on the lengths alone, so the packing is solved on
the histogram of lengths (at most ``capacity`` rows, whatever the corpus): per bin
the longest length left is placed, a bitset subset-sum over the lengths that remain
finds the fullest feasible combination, and that combination is removed as often
as its lengths last - the same as removing it bin by bin. Each removal exhausts a
length, so there are at most ``capacity`` distinct combinations per length left over.

Pieces then find their place by rank: each is numbered within its length (salted,
so a frequent length is spread over tasks) and joined to the table of combinations.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import pack
from .common import even_salts, materialise, salted_rank

#: Texts of these characters alone are tokenised stretch by stretch; others are handed to the tokenizer whole.
PLAIN = regex.compile(r"[\t\n\r\x20-\x7e\xa1-\xff]*")
#: The tokenizer's own split pattern, on lower-cased text.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: How a tokenizer file has to normalise and split for these two to hold; the texts of any other file are handed to the tokenizer whole.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLITS = [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
CACHED = 500_000
LONGEST_CACHED = 64


def splits_as_assumed(tokenizer: tokenizers.Tokenizer) -> bool:
    """Whether words can be tokenised apart: the file normalises and splits as above, and its added tokens all hold ``<|``."""
    spec = json.loads(tokenizer.to_str())
    steps = (spec["normalizer"], spec["pre_tokenizer"], spec["post_processor"], spec["truncation"], spec["padding"])
    added = all("<|" in token["content"] for token in spec["added_tokens"])
    return added and steps == (NORMALIZER, {"type": "Sequence", "pretokenizers": SPLITS}, None, None, None)


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 stands for itself, other bytes for letters from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordIds(dict):
    """Stretch without white space -> packed ids, in two generations of bounded size."""

    def __init__(self, path: str) -> None:
        super().__init__()
        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.apart = splits_as_assumed(self.tokenizer)
        self.letters = _byte_letters()
        self.old: dict[str, bytes] = {}

    def __missing__(self, stretch: str) -> bytes:
        value = self.old.get(stretch)
        if value is None:
            pieces = PIECES.findall(stretch)
            if len(pieces) > 1:
                value = b"".join(map(self.__getitem__, pieces))
            else:
                level = stretch.encode("utf-8").decode("latin-1").translate(self.letters)
                value = pack(array("I", [t.id for t in self.model.tokenize(level)]))
        if len(stretch) <= LONGEST_CACHED:
            if len(self) >= CACHED:
                self.old = dict(self)
                self.clear()
            self[stretch] = value
        return value

    def encode_packed(self, text: str) -> bytes:
        if not self.apart or "<|" in text or not PLAIN.fullmatch(text):
            return pack(array("I", self.tokenizer.encode(text, add_special_tokens=False).ids))
        return b"".join(map(self.__getitem__, text.lower().split()))


_loaded: dict[str, WordIds] = {}


def load(path: str) -> WordIds:
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    return _loaded[path]


def tokenise_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids, packed, if ``keep_ids``)."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if keep_ids else "")
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + ([pa.binary()] if keep_ids else [])
    names = [f.split()[0] for f in schema.split(", ")]
    end = pack(array("I", [end_id]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = load(tokenizer_path)
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                packed = words.encode_packed(value.as_py() or "") + end
                for piece, at in enumerate(range(0, len(packed), 4 * capacity)):
                    part = packed[at : at + 4 * capacity]
                    row = (doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part), part)
                    for values, x in zip(out, row, strict=False):
                        values.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)], names=names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("_text")).mapInArrow(work, schema)


def fullest(available: dict[int, int], room: int, order: list[int]) -> list[int]:
    """Lengths whose sum is the largest that fits ``room``: subset-sum by bitset, bit s set if s can be made."""
    reach, steps, goal = 1, [], 1 << room
    below = (goal << 1) - 1
    for length in order:
        if length > room:
            continue
        for _ in range(min(available[length], room // length)):
            wider = (reach | reach << length) & below
            if wider == reach:
                break
            steps.append((length, reach))
            reach = wider
            if reach & goal:
                break
        if reach & goal:
            break
    total, chosen = reach.bit_length() - 1, []
    for length, before in reversed(steps):
        if not before >> total & 1:
            chosen.append(length)
            total -= length
    return chosen


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, from_rank, to_rank, per_bin, first_bin, offset): where the ranks of each length go."""
    left = {n: c for n, c in counts.items() if c}
    order = sorted(left, reverse=True)
    used = dict.fromkeys(left, 0)
    bin_id, rows = 0, []
    while order:
        longest = order[0]
        left[longest] -= 1
        chosen = [longest, *fullest(left, capacity - longest, order)]
        left[longest] += 1
        per_bin: dict[int, int] = {}
        for n in chosen:
            per_bin[n] = per_bin.get(n, 0) + 1
        times = min(left[n] // q for n, q in per_bin.items())
        offset = 0
        for n, q in per_bin.items():
            rows.append((n, used[n], used[n] + q * times, q, bin_id, offset))
            used[n] += q * times
            left[n] -= q * times
            offset += n * q
        bin_id += times
        order = [n for n in order if left[n]]
    return rows


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids if ``keep_ids``).

    A null text counts as empty and still has the end id. Only documents longer than
    ``capacity`` are cut, whatever their length. Rows that repeat an id, or have none, are packed each; pieces of equal lengths are
    placed in the order in which they lie in the table of pieces; extra columns are ignored; an empty table gives an empty result.
    """
    pieces = tokenise_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col, keep_ids)
    pieces = materialise(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``capacity`` rows
    rows = plan_bins(counts, capacity)
    places = docs.sparkSession.createDataFrame(rows, "length long, _from long, _to long, _per long, _bin long, _offset long")
    salts = even_salts(max(counts.values(), default=1))
    ranked = salted_rank(pieces, ["length"], [F.col("_row")], F.xxhash64("_row"), salts, "_rank")
    # the table of places is bounded by the capacity (see above), not by the corpus
    placed = ranked.join(F.broadcast(places), "length").where("_rank >= _from and _rank < _to")
    within = F.col("_rank") - F.col("_from")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("_bin") + F.floor(within / F.col("_per"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + within % F.col("_per") * F.col("length")).cast("long").alias("offset"),
        *(["ids"] if keep_ids else []),
    )
