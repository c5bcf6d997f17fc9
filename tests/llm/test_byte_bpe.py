import hashlib
import random
from array import array

import public_tokenizers
import pytest
import tiktoken

from genesieve.llm.byte_bpe import ByteBpe, encode_documents, load

from .helpers import empty, odd

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def pair():
    ours = load(PATH, public_tokenizers.PATTERN)
    return ours, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ours.ranks, special_tokens={})


def test_equals_the_library(pair):
    ours, theirs = pair
    rng = random.Random(3)
    alphabet = "aab \n\t  '\x1c\x85\xa0　​sté漢字😀1²,.!\x00İΣſ\r t'lle"
    for _ in range(4000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(30)))
        assert ours.encode(text) == theirs.encode_ordinary(text)
        assert ours.decode(ours.encode(text)) == text.encode()


@pytest.mark.parametrize("text", ["a" * 20_000, "ab" * 10_000 + "é" * 5_000, " " * 5_000, "\n" * 999 + "x"])
def test_very_long_pre_tokens(pair, text):
    assert pair[0].encode(text) == pair[1].encode_ordinary(text)


@pytest.mark.parametrize("pattern", [r"[a-z]+\s+[a-z]+|\s+|.", r"(a|b)+|[^ab]", r"(?s:.{1,7})"])
def test_other_patterns_are_matched_over_the_whole_text(pair, pattern):
    ours, rng = ByteBpe(pair[0].ranks, pattern), random.Random(4)
    theirs = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=ours.ranks, special_tokens={})
    for _ in range(500):
        text = "".join(rng.choice("aab the\n 漢é") for _ in range(rng.randrange(40)))
        assert ours.encode(text) == theirs.encode_ordinary(text)


def test_ties_go_left():
    bpe = ByteBpe({b"a": 0, b"aa": 1, b"aaa": 2}, "a+")
    assert bpe.merge(b"aaaaa") == tiktoken.Encoding("t", pat_str="a+", mergeable_ranks=bpe.ranks, special_tokens={}).encode_ordinary("aaaaa")
    assert bpe.merge(b"") == [] and bpe.encode("") == []


def test_cache_is_bounded(pair, monkeypatch):
    import genesieve.llm.byte_bpe as module

    monkeypatch.setattr(module, "CACHED", 10)
    bpe = ByteBpe(pair[0].ranks, public_tokenizers.PATTERN)
    words = [f"word{i}" for i in range(100)]
    assert [bpe.encode(w) for w in words] == [pair[1].encode_ordinary(w) for w in words]
    assert len(bpe.packed) <= 10 and len(bpe.packed.old) <= 10


def test_odd_rows(spark, pair):
    rows = encode_documents(odd(spark, ("ids", "n_tokens", "_text")), PATH, public_tokenizers.PATTERN).collect()
    texts = [r["text"] for r in odd(spark).collect()]
    assert len(rows) == len(texts)
    want = sorted((len(x := pair[1].encode_ordinary(t or "")), hashlib.sha256(array("I", x).tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for t in texts)
    assert sorted((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows) == want


def test_empty_table(spark):
    assert encode_documents(empty(spark), PATH, public_tokenizers.PATTERN).count() == 0
