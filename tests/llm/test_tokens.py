import hashlib
import random
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm import bpe, packing

TEXTS = ["Hello WORLD's  été ñ ΑΣ Σ. İx", "a<|endoftext|>b <|startoftext|>", "日本語 \U0001f600 x", "", "  ", " <|ENDOFTEXT|>",
         "é  x y \x1c z\x85q", "''s 'S x'll'd 12½²", "\r\n\t a\x0bb", "the" * 8000, "a" * 20000, "é" * 9000, "!?" * 7000,
         "".join(random.Random(1).choice("abehinorst") for _ in range(30000)), "\U00016ea0ꟋᲉ ՘"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    return TEXTS + ["".join(rng.choice("  aeiou'stré日!12\n<|") for _ in range(rng.randrange(60))) for _ in range(300)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_transducer_equals_the_library(texts, name):
    theirs, ours = Tokenizer.from_file(public_tokenizers.path(name)), bpe.load(public_tokenizers.path(name))
    for text in texts:
        ids = theirs.encode(text, add_special_tokens=False).ids
        assert ours.encode(text) == ids
        assert bpe.decode(ours, ids) == theirs.decode(ids, skip_special_tokens=False)


def test_tokens_before_the_lookahead_are_final():
    ours = bpe.load(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(9)
    for _ in range(300):
        word = "".join(rng.choice("aehinorst") for _ in range(60))
        whole, part = ours.merge(list(word)), ours.merge(list(word[:45]))
        final = part[: max(0, len(part) - ours.lookahead)]
        assert whole[: len(final)] == final


def test_lookahead_of_small_merge_lists():
    assert bpe.sufficient_lookahead({}) == 0
    assert bpe.sufficient_lookahead({("a", "b"): 0}) == 1
    assert bpe.sufficient_lookahead({("b", "c"): 0, ("a", "b"): 1, ("x", "a"): 2}) == 3


def test_words_beyond_a_block_are_streamed(monkeypatch):
    ours = bpe.Bpe(public_tokenizers.path("word_bpe_49k.json"))
    words = [w * 400 for w in ("hello", "antidis", "éa", "zx")]
    want = [ours.encode(w) for w in words]
    monkeypatch.setattr(bpe, "BLOCK", 700)
    ours.lookahead = 60
    assert [ours.encode(w) for w in words] == want


def test_round_trip_digests(docs, texts):
    theirs = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = [*enumerate(texts), (None, None), (0, texts[0])]
    got = bpe.round_trip(docs(rows), public_tokenizers.path("word_bpe_49k.json")).collect()

    def row(i, t):
        ids = theirs.encode(t or "", add_special_tokens=False).ids
        return i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(theirs.decode(ids, skip_special_tokens=False).encode()).hexdigest()

    assert sorted(map(tuple, got), key=str) == sorted((row(i, t) for i, t in rows), key=str)
    assert bpe.round_trip(docs([]), public_tokenizers.path("word_bpe_49k.json")).count() == 0


def unpacked(pieces, docs_, length):
    """Checks that the pieces tile documents and sequences; the sequences."""
    theirs = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: theirs.encode(t or "", add_special_tokens=False).ids + [0] for i, t, *_ in docs_}
    seen = {}
    for p in sorted(pieces, key=lambda p: (str(p["doc_id"]), p["start"])):
        assert p["start"] == len(seen.setdefault(p["doc_id"], []))
        seen[p["doc_id"]] += p["ids"]
        assert p["length"] == len(p["ids"]) and p["doc_tokens"] == len(want[p["doc_id"]])
        assert p["ids_crc32"] == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in p["ids"]))
    assert seen == want
    sequences = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        s = sequences.setdefault(p["sequence_id"], [])
        assert p["offset"] == sum(n for _, n in s)
        s.append((p["source"], p["length"]))
    sizes = [sum(n for _, n in sequences[k]) for k in sorted(sequences)]
    assert sizes[:-1] == [length] * (len(sizes) - 1) and sorted(sequences) == list(range(len(sizes)))
    return [sequences[k] for k in sorted(sequences)]


def test_packing_is_whole_and_mixed(docs):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(("alpha", "beta", "gamma é", "\n")) for _ in range(rng.randrange(200))), rng.choice("aaabbc")) for i in range(300)]
    rows += [(300, None, "a"), (301, "", "b"), (302, "x " * 20000, "a"), (303, "tiny", "z"), (None, "no id", None)]
    got = packing.pack(docs(rows).repartition(5), public_tokenizers.path("byte_bpe_50k.json"), 64, 8).collect()
    sequences = unpacked(got, rows, 64)
    total = {s: sum(n for q in sequences for t, n in q if t == s) for s in "abc"}
    everything = sum(n for q in sequences for _, n in q)
    served = dict.fromkeys("abc", 0)
    for w in range(0, len(sequences) - 8, 8):  # after every window, each source has had its share but for a token and the run of small sources
        for q in sequences[w:w + 8]:
            for s, n in q:
                if s in served:
                    served[s] += n
        for s in "ab":
            assert abs(served[s] - total[s] * (w + 8) * 64 / everything) <= 8


def test_packing_to_targets(docs):
    rows = [(i, "word " * 50, "ab"[i % 2]) for i in range(120)] + [(500, "rest " * 30, "c")]
    sequences = unpacked(packing.pack(docs(rows), public_tokenizers.path("byte_bpe_50k.json"), 64, 4, {"a": 3.0, "b": 1.0}).collect(), rows, 64)
    first = [x for q in sequences[:16] for x in q]
    assert sum(n for s, n in first if s == "a") == 3 * sum(n for s, n in first if s == "b") == 768
    assert {s for s, _ in sequences[-1]} == {"c"} or sequences[-1][-1][0] == "c"


def test_packing_of_nothing(docs):
    assert packing.pack(docs([]), public_tokenizers.path("byte_bpe_50k.json")).count() == 0
