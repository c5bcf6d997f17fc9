import json
import random
import zlib
from array import array

import public_tokenizers
import pytest
import tokenizers

from genesieve.llm.bin_packing import WordIds, fullest, pack_documents, plan_bins

from .helpers import DOCS, empty, odd

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_words_are_tokenised_as_the_library_does():
    ours, rng = WordIds(PATH), random.Random(5)
    theirs = tokenizers.Tokenizer.from_file(PATH)
    alphabet = "aAb \n\t  '0ßÉé\xad×ªµ¼²,.!$'lre<|x^~`¡ÿÀ\x00\x85　Σœ漢😀İ"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(3000)] + ["<|endoftext|> a", "I'll it's", "x" * 3000]
    for t in texts:
        assert array("I", ours.encode_packed(t)).tolist() == theirs.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("change", ["case", "split", "token"])
def test_other_tokenizer_files_get_whole_texts(tmp_path, change):
    spec = json.load(open(PATH))
    if change == "case":
        spec["normalizer"]["normalizers"].pop()
    elif change == "split":
        spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]+"
    else:
        spec["added_tokens"][0]["content"] = "[start]"
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec))
    ours, theirs = WordIds(str(path)), tokenizers.Tokenizer.from_file(str(path))
    assert WordIds(PATH).apart and not ours.apart
    for t in ("It's 2024, ABC abc3 [start] x", "", "one Two\n\nThree  4", "İ漢"):
        assert array("I", ours.encode_packed(t)).tolist() == theirs.encode(t, add_special_tokens=False).ids


def test_fullest_equals_brute_force():
    import itertools

    rng = random.Random(1)
    for _ in range(60):
        counts = {n: rng.randrange(1, 3) for n in rng.sample(range(1, 30), 5)}
        room = rng.randrange(1, 60)
        items = [n for n, c in counts.items() for _ in range(c)]
        best = max(sum(s) for k in range(len(items) + 1) for s in itertools.combinations(items, k) if sum(s) <= room)
        chosen = fullest(counts, room, sorted(counts, reverse=True))
        assert sum(chosen) == best and all(chosen.count(n) <= counts[n] for n in chosen)


def test_plan_places_every_rank_once():
    counts = {4096: 5, 3000: 7, 1096: 3, 1000: 40, 7: 1}
    rows = plan_bins(counts, 4096)
    bins, seen = {}, dict.fromkeys(counts, 0)
    for n, first, last, per, b, offset in sorted(rows, key=lambda r: (r[0], r[1])):
        assert first == seen[n]
        seen[n] = last
        for r in range(first, last):
            bins.setdefault(b + (r - first) // per, []).append((offset + (r - first) % per * n, n))
    assert seen == counts
    for held in bins.values():
        end = 0
        for offset, n in sorted(held):
            assert offset == end
            end += n
        assert end <= 4096


def check(rows, texts, capacity=4096):
    tok = tokenizers.Tokenizer.from_file(PATH)
    held = {}
    for r in rows:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in held.values():
        end = 0
        for offset, n in sorted(spans):
            assert offset == end
            end += n
        assert end <= capacity
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    for i, text in texts.items():
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 1]
        parts = sorted(by[i], key=lambda r: r["piece"])
        assert [(r["piece"], r["start"]) for r in parts] == [(k, k * capacity) for k in range(len(parts))]
        assert [zlib.crc32(array("I", ids[k : k + capacity]).tobytes()) for k in range(0, len(ids), capacity)] == [r["ids_crc32"] for r in parts]
    return len(held)


def test_documents(spark):
    rng = random.Random(2)
    texts = {i: " ".join(rng.choice(["alpha", "beta", "gamma1", "d"]) for _ in range(rng.choice([1, 50, 900, 6000]))) for i in range(120)}
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in texts.items()], DOCS)
    rows = pack_documents(df, PATH).collect()
    n = check(rows, texts)
    first_fit: list[int] = []
    for length in sorted((r["length"] for r in rows), reverse=True):
        at = next((i for i, used in enumerate(first_fit) if used + length <= 4096), None)
        if at is None:
            first_fit.append(length)
        else:
            first_fit[at] += length
    assert n <= len(first_fit)


def test_odd_rows(spark):
    df = odd(spark, ("length", "piece", "_rank", "_salt", "ids"))
    rows = pack_documents(df, PATH).collect()
    assert len([r for r in rows if r["doc_id"] == 7]) == 2
    once = {r["doc_id"]: r["text"] for r in df.collect() if r["doc_id"] not in (7, None)}
    check(rows, {}, 4096)
    for i, t in once.items():
        assert sum(r["length"] for r in rows if r["doc_id"] == i) == len(tokenizers.Tokenizer.from_file(PATH).encode(t or "", add_special_tokens=False).ids) + 1


def test_empty_table(spark):
    assert pack_documents(empty(spark), PATH).count() == 0


@pytest.mark.parametrize("counts", [{}, {1: 1}, {5: 3}])
def test_small_plans(counts):
    assert sum(r[2] - r[1] for r in plan_bins(counts, 5)) == sum(counts.values())
