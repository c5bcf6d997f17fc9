"""Byte-level BPE with a hierarchical-bitmap rank queue.

A pre-token's bytes are a linked list. Each adjacent pair whose concatenation is in
the vocabulary lies in the bucket of its rank; a two-level bitmap (words of 64
ranks, and a summary of which words are not empty) gives the lowest rank by
find-first-set. A bucket pops its leftmost position; an entry is stale, and
skipped, when the pair at that position no longer makes that rank. So a merge costs
the same in a pre-token of ten bytes as in one of ten million.

Encodings are kept per stretch of text (white space and what follows up to the next
white space: no match of the public pattern crosses such a border), in a table of bounded size.
With any other pattern a text is matched as a whole.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
from array import array
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD_BITS, WORD_MASK = 6, 63
BIT = [1 << i for i in range(WORD_MASK + 1)]
#: Unicode White_Space: what \s is to the tokenizer's pattern.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Texts whose only white space is single blanks and line feeds between other characters: their parts between blanks can be encoded apart.
EVEN = re.compile(r"\S+(?:[ \n]\S+)*\Z")
#: Entries of a generation; two are kept, of about 200 bytes an entry.
CACHED = 900_000
LONGEST_CACHED = 64


def read_ranks(lines: Iterable[bytes]) -> dict[bytes, int]:
    """A rank file: base64 of the token's bytes, a space, its rank."""
    return {base64.b64decode(t): int(r) for t, r in (line.split() for line in lines if line.strip())}


class ByteBpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.pattern = regex.compile(pattern)
        self.by_stretch = pattern == public_tokenizers.PATTERN
        self.stretches = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
        self.packed, self.spaced = _Packed(self, ""), _Packed(self, " ")

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one pre-token.

        The queue is spelled out at each use, as a method call for each entry would
        cost more than the entry: ``buckets`` (rank -> a position, or a heap of
        several), ``words`` (64 ranks each) and ``summary`` (a bit for each word that
        isn't 0).
        """
        rank_of = self.ranks.get
        whole = rank_of(piece)
        if whole is not None or not piece:
            return [] if whole is None else [whole]
        n = len(piece)
        token = [piece[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        at = [rank_of(piece[i : i + 2]) for i in range(n)]  # the rank of the pair that starts here
        at[-1] = None
        buckets = {}
        words = {}
        summary = 0
        bucket_of, word_of = buckets.get, words.get
        i = 0
        for rank in at:
            if rank is not None:
                bucket = bucket_of(rank)
                if bucket is None:
                    buckets[rank] = i
                    word = rank >> WORD_BITS
                    words[word] = word_of(word, 0) | BIT[rank & WORD_MASK]
                    summary |= 1 << word
                elif bucket.__class__ is int:
                    buckets[rank] = [bucket, i]
                else:
                    bucket.append(i)
            i += 1
        while summary:
            word = (summary & -summary).bit_length() - 1  # find-first-set, twice
            bits = words[word]
            low = bits & -bits
            rank = (word << WORD_BITS) + low.bit_length() - 1
            i = buckets[rank]
            if i.__class__ is int:
                del buckets[rank]
                words[word] = bits = bits ^ low
                if not bits:
                    summary ^= 1 << word
            else:
                bucket = i
                i = heappop(bucket)
                if len(bucket) == 1:
                    buckets[rank] = bucket[0]
            if at[i] != rank:
                continue  # stale
            j = after[i]
            token[i] = merged = token[i] + token[j]
            after[i] = k = after[j]
            at[j] = None
            if k < n:
                before[k] = i
                at[i] = rank = rank_of(merged + token[k])
                if rank is not None:
                    bucket = bucket_of(rank)
                    if bucket is None:
                        buckets[rank] = i
                        word = rank >> WORD_BITS
                        words[word] = word_of(word, 0) | BIT[rank & WORD_MASK]
                        summary |= 1 << word
                    elif bucket.__class__ is int:
                        buckets[rank] = [bucket, i] if bucket < i else [i, bucket]
                    else:
                        heappush(bucket, i)
            else:
                at[i] = None
            h = before[i]
            if h >= 0:
                at[h] = rank = rank_of(token[h] + merged)
                if rank is not None:
                    bucket = bucket_of(rank)
                    if bucket is None:
                        buckets[rank] = h
                        word = rank >> WORD_BITS
                        words[word] = word_of(word, 0) | BIT[rank & WORD_MASK]
                        summary |= 1 << word
                    elif bucket.__class__ is int:
                        buckets[rank] = [bucket, h] if bucket < h else [h, bucket]
                    else:
                        heappush(bucket, h)
        out, i = [], 0
        while i < n:
            out.append(rank_of(token[i]))
            i = after[i]
        return out

    def encode_packed(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not self.by_stretch:
            return b"".join(pack(array("I", self.merge(m.group().encode("utf-8")))) for m in self.pattern.finditer(text))
        if EVEN.match(text):
            first, *rest = text.split(" ")
            return self.packed[first] + b"".join(map(self.spaced.__getitem__, rest))
        return b"".join(map(self.packed.__getitem__, self.stretches.findall(text)))

    def encode(self, text: str) -> list[int]:
        return unpack(self.encode_packed(text)).tolist()

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class _Packed(dict):
    """Part of a text, which ``before`` precedes -> packed ids, in two generations: when the young one is full it becomes the old one, so memory is bounded."""

    def __init__(self, bpe: ByteBpe, before: str) -> None:
        super().__init__()
        self.bpe = bpe
        self.before = before
        self.old: dict[str, bytes] = {}

    def __missing__(self, part: str) -> bytes:
        value = self.old.get(part)
        if value is None:
            bpe, whole = self.bpe, self.before + part
            pieces = bpe.pattern.findall(whole)
            if pieces == [whole]:
                value = pack(array("I", bpe.merge(whole.encode("utf-8"))))
            else:
                value = b"".join([bpe.spaced[x[1:]] if x[0] == " " and len(x) > 1 else bpe.packed[x] for x in pieces])
        if len(part) <= LONGEST_CACHED:
            if len(self) >= CACHED:
                self.old = dict(self)
                self.clear()
            self[part] = value
        return value


def pack(ids: array) -> bytes:
    if sys.byteorder == "big":
        ids = array("I", ids)
        ids.byteswap()
    return ids.tobytes()


def unpack(packed: bytes) -> array:
    ids = array("I", packed)
    if sys.byteorder == "big":
        ids.byteswap()
    return ids


_loaded: dict[tuple[str, str], ByteBpe] = {}


def load(path: str, pattern: str) -> ByteBpe:
    """One encoder per Python worker, whatever the number of its tasks."""
    if (path, pattern) not in _loaded:
        with open(path, "rb") as lines:
            _loaded[path, pattern] = ByteBpe(read_ranks(lines), pattern)
    return _loaded[path, pattern]


def encode_documents(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids (binary, packed; null unless ``keep_ids``), ids_sha256, decoded_sha256.

    A null text is encoded as an empty one: no ids, digests of nothing. Rows that
    repeat an id are encoded each. A rank file is installed with the tokenizers on
    every machine; ``rank_path`` is where. Other columns are ignored.
    """
    schema = "doc_id long, n_tokens long, ids binary, ids_sha256 string, decoded_sha256 string"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(rank_path, pattern)
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [])
            for value in batch.column(1):
                packed = bpe.encode_packed(value.as_py() or "")
                out[0].append(len(packed) // 4)
                out[1].append(packed if keep_ids else None)
                out[2].append(hashlib.sha256(packed).hexdigest())
                out[3].append(hashlib.sha256(bpe.decode(unpack(packed))).hexdigest())
            kinds = (pa.int64(), pa.binary(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(v, t) for v, t in zip(out, kinds, strict=True)]], names=["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("_text")).mapInArrow(work, schema)
