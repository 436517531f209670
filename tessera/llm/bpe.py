"""Byte-level BPE as a bounded-lookahead streaming transducer.

Encoding reads a text once and emits tokens as soon as nothing that follows
can change them. A merge reaches back over the end of what was read only as
a chain of rules ``r1 < r2 < ...`` of rising rank, in which the right side of
each starts with the left side of the one before: the boundary between what
is settled and what is not moves left by one segment for each rule. The
longest such chain in the merge list is the *sufficient lookahead* ``K``: of
the tokens of an open prefix, all but the last ``K`` are final, and encoding
can start anew behind them. So a word of any length takes the memory of one
block and ``K`` tokens. Words up to a block are encoded at once and remembered
in a bounded cache.

Decoding is a state machine fed with ids: `Decoder` keeps an unfinished UTF-8
sequence between tokens, or joins the tokens of files without a decoder by a
space, as the tokenizers library does.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The word patterns of the two supported kinds of file.
LOWER_WORDS = "'s|'t|'re|'ve|'m|'ll|'d|[{L}]+|[{N}]|[^{S}{L}{N}]+"
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LOWER_WORDS_ASCII = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+"
# The same over Latin-1 and over ASCII, lower-cased.
LOWER_WORDS_LATIN = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]|[^\t-\r \x85\xa00-9a-z\xaa\xb2\xb3\xb5\xb9\xba\xbc-\xbe\xdf-\xf6\xf8-\xff]+"
# Letters, and capitals with their small letters, that the
# tokenizers library knows from Unicode versions after Python's table.
NEWER_LETTERS = [(0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
                 (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1),
                 (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF),
                 (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0)]
NEWER_LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
NEWER_LOWER |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}
BYTE_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

BLOCK = 4096  # symbols of a word encoded at once
CHUNK = 1 << 16  # characters of a text read at once, up to the next white space
CACHE = 1_000_000  # words remembered, about 200 MB


class _Cache(dict):
    """Results by argument, emptied when full."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        if len(self) >= CACHE:
            self.clear()
        out = self.make(key)
        if len(key) <= 64:
            self[key] = out
        return out


class Bpe:
    """The merge list of a tokenizers file with byte-level BPE."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.lower = (spec.get("normalizer") or {}).get("type") == "Sequence"
        _supported(spec, self.lower)
        self.ranks: dict[tuple[str, str], int] = {}
        for rank, merge in enumerate(model["merges"]):
            self.ranks[tuple(merge if isinstance(merge, list) else merge.split(" "))] = rank
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.chars = [chr(b) for b in range(256)]
        for i, b in enumerate(sorted(set(range(256)) - set(own))):
            self.chars[b] = chr(256 + i)
        self.bytes = {c: b for b, c in enumerate(self.chars)}
        self.words = _lower_words() if self.lower else regex.compile(BYTE_WORDS)
        self.ascii_words, self.latin_words = re.compile(LOWER_WORDS_ASCII), re.compile(LOWER_WORDS_LATIN)
        self.lookahead = sufficient_lookahead(self.ranks)
        self.decoder = (spec.get("decoder") or {}).get("type")

    # -- encoding ---------------------------------------------------------
    def merge(self, symbols: list[str]) -> list[str]:
        """Tokens of a short run of symbols, by rank and then from the left."""
        ranks = self.ranks
        while len(symbols) > 1:
            pairs = [ranks.get(p, 1 << 60) for p in zip(symbols, symbols[1:])]
            low = min(pairs)
            if low == 1 << 60:
                break
            out, i, n = [], 0, len(pairs)
            while i < n:
                if pairs[i] == low:
                    out.append(symbols[i] + symbols[i + 1])
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            if i == n:
                out.append(symbols[n])
            symbols = out
        return symbols

    def merge_long(self, symbols: list[str]) -> list[str]:
        """The same for a block, with a heap over a linked list."""
        ranks, n = self.ranks, len(symbols)
        symbols, nxt, prv = list(symbols), [*range(1, n), -1], list(range(-1, n - 1))
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if (r := ranks.get((a, b))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if symbols[i] != a or j < 0 or symbols[j] != b:
                continue  # a merge took one of them meanwhile
            symbols[i], symbols[j] = a + b, ""
            nxt[i] = nxt[j]
            if nxt[j] >= 0:
                prv[nxt[j]] = i
            for k in (prv[i], i):
                if k >= 0 and nxt[k] >= 0 and (r := ranks.get((symbols[k], symbols[nxt[k]]))) is not None:
                    heapq.heappush(heap, (r, k, symbols[k], symbols[nxt[k]]))
        return [s for s in symbols if s]

    def word(self, word: str) -> Iterator[str]:
        """Tokens of one word, each as soon as it is final."""
        if len(word) <= BLOCK // 4:
            symbols = [self.chars[b] for b in word.encode("utf-8")]
            if self.suffix:
                symbols[-1] += self.suffix
            yield from self.merge(symbols) if len(symbols) < 64 else self.merge_long(symbols)
            return
        pending: list[str] = []
        for at in range(0, len(word), BLOCK):
            pending += [self.chars[b] for b in word[at:at + BLOCK].encode("utf-8")]
            if at + BLOCK >= len(word):
                break
            made = self.merge_long(pending)
            final = made[:-self.lookahead] if self.lookahead else made
            yield from final
            pending = pending[sum(map(len, final)):]  # symbols of an open word are one character each
        if self.suffix:
            pending[-1] += self.suffix
        yield from self.merge_long(pending)

    def ids_of(self, word: str) -> str:
        """Ids of a word, joined by a space."""
        vocab = self.vocab
        return " ".join(str(vocab[t]) for t in self.word(word) if t in vocab)

    def pieces(self, text: str) -> Iterator[list[str] | int]:
        """The words of a text, a chunk at a time, and ids of special tokens."""
        parts = self.split.split(text) if self.split and "<" in text else [text]
        for i, part in enumerate(parts):
            if i % 2:
                yield self.special[part]
                continue
            for body in chunks(part) if self.lower else [part]:
                if not self.lower:
                    yield self.words.findall(body)
                elif body.isascii():
                    yield self.ascii_words.findall(body.lower())
                else:
                    body = _lower(body)
                    yield (self.words if _WIDE.search(body) else self.latin_words).findall(body)

    def encode(self, text: str | None) -> list[int]:
        """All ids of a text; `stream` is the same with bounded memory."""
        return [int(i) for s in self.stream(text, _Cache(self.ids_of)) for i in s.split(" ")]

    def stream(self, text: str | None, cache: _Cache) -> Iterator[str]:
        """Ids of a text, joined by a space, some at a time; never empty."""
        for piece in self.pieces(text or ""):
            if isinstance(piece, int):
                yield str(piece)
            elif piece:
                if max(map(len, piece)) <= BLOCK // 4:
                    if out := " ".join(filter(None, map(cache.__getitem__, piece))):
                        yield out
                else:
                    for w in piece:
                        if len(w) <= BLOCK // 4:
                            if out := cache[w]:
                                yield out
                        else:
                            yield from (str(self.vocab[t]) for t in self.word(w) if t in self.vocab)


@lru_cache(maxsize=1)
def _lower_words() -> re.Pattern:
    """LOWER_WORDS with letters and numbers as ranges of Python's Unicode
    table and the newer letters; the regex module's table is newer still than
    that of the pattern engine in the tokenizers library."""
    ranges: dict[str, list[list[int]]] = {"L": [], "N": []}
    newer = {c for a, b in NEWER_LETTERS for c in range(a, b + 1)}
    for c in range(0x110000):
        kind = "L" if c in newer else unicodedata.category(chr(c))[0]
        if kind in ranges:
            if ranges[kind] and ranges[kind][-1][1] == c - 1:
                ranges[kind][-1][1] = c
            else:
                ranges[kind].append([c, c])
    classes = {k: "".join(f"{chr(a)}-{chr(b)}" for a, b in v) for k, v in ranges.items()}
    pattern = LOWER_WORDS.replace("{S}", SPACES)
    for k, v in classes.items():
        pattern = pattern.replace(f"{{{k}}}", v)
    return re.compile(pattern)


def _supported(spec: dict, lower: bool) -> None:
    pre = spec.get("pre_tokenizer") or {}
    kinds = [p["type"] for p in pre.get("pretokenizers", [pre])]
    if spec["model"].get("type") != "BPE" or kinds not in (["ByteLevel"], ["Split", "ByteLevel"]) or lower != (len(kinds) == 2):
        raise ValueError("only byte-level BPE files, plain or lower-cased with word ends, are supported")


def _lower(text: str) -> str:
    """NFC, then the lower case of each character by itself."""
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    text = text.replace("Σ", "σ").lower()
    return text.translate(NEWER_LOWER) if _NEWER.search(text) else text


def chunks(text: str, size: int = CHUNK) -> Iterator[str]:
    """A text in parts of about ``size`` characters, cut before white space,
    where neither words nor composed characters reach across."""
    at = 0
    while len(text) - at > size:
        end = _SPACE.search(text, at + size)
        if not end:
            break
        yield text[at:end.start()]
        at = end.start()
    yield text[at:] if at else text


_SPACE = re.compile(r"[ \n]")
_NEWER = re.compile("[" + "".join(map(chr, NEWER_LOWER)) + "]")
_WIDE = re.compile("[^\x00-\xff]")


def sufficient_lookahead(ranks: dict[tuple[str, str], int]) -> int:
    """Length of the longest chain of rules by which what follows a text can
    move the end of its settled tokens (see the module's text)."""
    longest: dict[str, int] = {}
    most = 0
    for left, right in ranks:  # in order of rank
        n = 1 + max(map(longest.get, (right[:i] for i in range(1, len(right) + 1)), [0] * len(right)), default=0)
        longest[left] = max(longest.get(left, 0), n)
        most = max(most, n)
    return most


class Decoder:
    """Ids to text, incrementally: `feed` some ids, `end` after the last."""

    def __init__(self, bpe: Bpe):
        self.bpe, self.first = bpe, True
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace") if bpe.decoder == "ByteLevel" else None

    def feed(self, ids: Iterable[int]) -> str:
        tokens, special = self.bpe.tokens, self.bpe.special
        if self.utf8:
            return "".join(self.utf8.decode(b"", True) + t if t in special else self.utf8.decode(bytes(map(self.bpe.bytes.__getitem__, t)))
                           for t in map(tokens.__getitem__, ids))
        out = " ".join(map(tokens.__getitem__, ids))
        lead = "" if self.first or not out else " "
        self.first = self.first and not out
        return lead + out

    def end(self) -> str:
        return self.utf8.decode(b"", True) if self.utf8 else ""


@lru_cache(maxsize=4)
def load(path: str) -> Bpe:
    return Bpe(path)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for each row of
    ``docs(doc_id, text)``: the whole text encoded, and the ids decoded, each
    digested as they stream by. A null text is empty; it has no ids and the
    digests of the empty string. Rows that repeat are encoded each."""

    def run(batches):
        bpe = load(path)
        ids_of = _Cache(bpe.ids_of)
        # text of a run of ids; a word's run starts and ends between characters, so it decodes by itself
        text_of = _Cache(lambda ids: Decoder(bpe).feed(map(int, ids.split(" "))))
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                n, ids, plain, first, decoder = 0, hashlib.sha256(), hashlib.sha256(), True, Decoder(bpe)
                for run_ids in bpe.stream(text, ids_of):
                    n += run_ids.count(" ") + 1
                    ids.update((run_ids if first else " " + run_ids).encode())
                    first = False
                    plain.update(_decode(decoder, run_ids, text_of).encode())
                plain.update(decoder.end().encode())
                out.append((n, ids.hexdigest(), plain.hexdigest()))
            n, a, b = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _decode(decoder: Decoder, ids: str, cache: _Cache) -> str:
    """Feeds a run of ids; where tokens are joined, id by id from the cache."""
    if decoder.utf8:
        return decoder.feed(map(int, ids.split(" ")))
    out = " ".join(map(cache.__getitem__, ids.split(" ")))
    lead = "" if decoder.first else " "
    decoder.first = False
    return lead + out


def decode(bpe: Bpe, ids: Iterable[int]) -> str:
    d = Decoder(bpe)
    return "".join(chain([d.feed(ids)], [d.end()]))
