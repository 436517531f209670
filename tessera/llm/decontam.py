"""Benchmark decontamination by a distributed positional inverted index.

`build` makes the index: documents are dealt into blocks of about half a million
words, and for each block the postings of every word (its sorted positions)
are stored as one row, by the tasks that read the texts; no posting is
shuffled. `phrases` and `nearby` search the stored index with windows of test
items. In a block a window's posting lists are intersected from its rarest
word there: the positions of the rarest, moved by the word's place in the
window, are looked up in the moved lists of the others, the next rarest first,
and what is left after the last is an occurrence. All windows go through these
steps together, as arrays; a window with a word that the block lacks ends
before the first. For proximity the lists are met within a span instead of at
an offset.

Test items are a stated query set: they are searched in passes of at most
`PASS_WORDS` words, each broadcast and bounded by that number, so a larger set
takes more passes over the index. A text of more than `PIECE_WORDS` words is
indexed in pieces that overlap by a window less one word on both sides; each
piece answers for the words that it owns.

A word is a run of a-z (A-Z lower-cased), 0-9 and characters beyond ASCII.

Cases: a null or empty text has no words and no hits, a null item no windows.
Rows that repeat a doc_id, or lack one, are judged each. Items that repeat an
item_id count once; a null item_id counts as an item named by the empty text.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, during
from .words import byte_table, text_rows, word_slices

WORD = byte_table(digits=True)
WINDOW = 10
SPAN = 15  # words that a proximity match may take
BLOCK_WORDS = 1 << 19
PIECE_WORDS = 1 << 20
PASS_WORDS = 1 << 20  # words of test items in a pass
AT_ONCE = 1 << 18  # candidates in a step
# What goes to Python at once: few texts, and blocks (a row each) one by one, so
# that a task holds some MB of them and not up to 64 on both sides. Of blocks,
# the Parquet reader unpacks few at once as well.
TEXTS_AT_ONCE = {"spark.sql.execution.arrow.maxBytesPerBatch": str(2 << 20)}
BLOCKS_AT_ONCE = TEXTS_AT_ONCE | {"spark.sql.parquet.columnarReaderBatchSize": "2"}

INDEX = ("row array<long>, doc_id array<long>, at array<long>, first array<int>, own_from array<int>, own_to array<int>, whole array<boolean>, "
         "terms array<binary>, ends array<int>, positions array<int>")


def pieces(body: bytes | None, size: int, around: int) -> Iterator[tuple[int, list[bytes], int, int]]:
    """``at, words, own_from, own_to``: the text's words in pieces of ``size``
    with up to ``around`` words of context on both sides; ``at`` is the place
    in the text of the first word that the piece owns."""
    held, base, at = [], 0, 0
    for words in word_slices(body, WORD):
        held += words
        while len(held) - base > size + around:
            yield at, held[:base + size + around], base, base + size
            keep = min(around, base + size)
            held, base, at = held[base + size - keep:], keep, at + size
    yield at, held, base, len(held)


class _Block:
    """Texts of a block and their words, numbered in order of appearance."""

    def __init__(self, gap: int):
        self.gap = max(1, gap)  # places that hold no word and keep texts apart
        self.ids = defaultdict(itertools.count().__next__)
        self.codes, self.places, self.texts, self.size = [], [], [], 0

    def add(self, row, doc, at, words, own_from, own_to, whole):
        self.texts.append((row, doc, at, self.size, self.size + own_from, self.size + own_to, whole))
        self.codes.append(np.fromiter(map(self.ids.__getitem__, words), np.int32, len(words)))
        self.places.append(np.arange(self.size, self.size + len(words), dtype=np.int32))
        self.size += len(words) + self.gap

    def batch(self) -> pa.RecordBatch:
        codes = np.concatenate(self.codes)
        positions = np.concatenate(self.places)[np.argsort(codes, kind="stable")]
        ends = np.cumsum(np.bincount(codes, minlength=len(self.ids)))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_()]
        cols = [pa.array([list(c)], pa.list_(k)) for c, k in zip(zip(*self.texts), kinds)]
        whole = lambda v: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v)
        cols += [whole(pa.array(list(self.ids), pa.binary())), whole(pa.array(ends.astype(np.int32))), whole(pa.array(positions))]
        return pa.RecordBatch.from_arrays(cols, names=["row", "doc_id", "at", "first", "own_from", "own_to", "whole", "terms", "ends", "positions"])


def build(docs: DataFrame, around: int = WINDOW - 1, block_words: int = BLOCK_WORDS, piece_words: int = PIECE_WORDS) -> DataFrame:
    """The stored index of ``docs(doc_id, text)``: a row for each block."""
    src = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                      F.col("text").cast("string").alias("text"))

    def run(batches):
        block = _Block(around)
        for batch in batches:
            for row, doc, body in text_rows(batch, ["row", "doc_id", "text"]):
                for n, (at, words, lo, hi) in enumerate(pieces(body, piece_words, around)):
                    block.add(row, doc, at, words, lo, hi, n == 0 and hi == len(words))
                    if block.size >= block_words:
                        yield block.batch()
                        block = _Block(around)
        if block.texts:
            yield block.batch()

    with during(docs.sparkSession, TEXTS_AT_ONCE):
        return cut(src.mapInArrow(run, INDEX))


class _Windows:
    """Windows of items, equal ones once, by length; words are numbered."""

    def __init__(self, items: list[tuple[str, bytes | None]], window: int):
        ids = defaultdict(itertools.count().__next__)
        found: dict[tuple, set] = defaultdict(set)
        names = {}
        for name, body in items:
            words = [ids[w] for ws in word_slices(body, WORD) for w in ws]
            item = names.setdefault(name, len(names))
            for i in range(max(1, len(words) - window + 1) if words else 0):
                found[tuple(words[i:i + window])].add(item)
        self.names = list(names)
        self.vocabulary = pa.array(list(ids), pa.binary())
        by_length = defaultdict(list)
        for w in found:
            by_length[len(w)].append(w)
        self.tables = {n: np.array(ws, np.int64) for n, ws in by_length.items()}
        self.items = {n: _lists([sorted(found[w]) for w in ws]) for n, ws in by_length.items()}


def _lists(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum([0, *map(len, rows)]), np.array([x for r in rows for x in r], np.int64)


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts 2, 0, 3: 0 0 2 2 2 and 0 1 0 1 2."""
    which = np.repeat(np.arange(len(counts)), counts)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)


class _Postings:
    """The posting lists of a block for the words of some windows."""

    def __init__(self, terms, ends, positions, vocabulary):
        place = pc.index_in(vocabulary.cast(terms.type), value_set=terms).to_numpy(zero_copy_only=False)
        place = np.where(np.isnan(place), -1, place).astype(np.int64) if place.dtype.kind == "f" else place.astype(np.int64)
        ends = ends.astype(np.int64)
        self.first = np.where(place < 0, 0, np.where(place > 0, ends[place - 1], 0)) if len(ends) else np.zeros(len(place), np.int64)
        self.count = np.where(place < 0, 0, ends[place] - self.first) if len(ends) else np.zeros(len(place), np.int64)
        self.positions = positions
        which, nth = _spread(self.count)
        # all lists in one sorted array: the word's number, then the position
        self.keys = (which << 32) + positions[self.first[which] + nth]

    def holds(self, word, position):
        key = (word << 32) + position
        i = np.searchsorted(self.keys, key)
        return self.keys[np.minimum(i, len(self.keys) - 1)] == key

    def within(self, word, lo, hi):
        return np.searchsorted(self.keys, (word << 32) + np.maximum(lo, 0)) < np.searchsorted(self.keys, (word << 32) + hi, side="right")

    def candidates(self, table: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``window, position, order``: each position of a window's rarest
        word, and the window's places from the rarest on; some windows at a
        time, a word that repeats in a window once."""
        if not len(self.keys):
            return
        count = self.count[table]
        alive = np.flatnonzero(count.min(axis=1) > 0)
        order = np.argsort(count[alive], axis=1, kind="stable").astype(np.int32)
        rarest = table[alive, order[:, 0]]
        n = self.count[rarest]
        start = 0
        total = np.cumsum(n)
        while start < len(alive):
            stop = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + AT_ONCE, side="right")))
            which, nth = _spread(n[start:stop])
            yield alive[start:stop][which], self.positions[self.first[rarest[start:stop]][which] + nth].astype(np.int64), order[start:stop][which]
            start = stop


def matches(post: _Postings, table: np.ndarray, span: int | None) -> tuple[np.ndarray, ...]:
    """``window, start`` of all places where a window's words follow each
    other, and ``window, position`` of its rarest word where all its words lie
    within ``span`` words in any order."""
    none = np.empty(0, np.int64)
    exact, near = [(none, none)], [(none, none)]
    width = table.shape[1]
    for window, position, order in post.candidates(table):
        w, at, o = window, position, order
        for k in range(1, width):
            here = post.holds(table[w, o[:, k]], at - o[:, 0] + o[:, k])
            w, at, o = w[here], at[here], o[here]
        exact.append((w, at - o[:, 0]))
        if span is None:
            continue
        if width <= span:  # these are near as well, and need no further look
            near.append((w, at))
            left = ~np.isin((window << 32) + position, (w << 32) + at)
            window, position, order = window[left], position[left], order[left]
        for k in range(1, width):
            here = post.within(table[window, order[:, k]], position - span + 1, position + span - 1)
            window, position, order = window[here], position[here], order[here]
        good = np.array([_fits(post, np.unique(table[x]), p, span) for x, p in zip(window, position)], bool)
        near.append((window[good], position[good]))
    return (*map(np.concatenate, zip(*exact)), *map(np.concatenate, zip(*near)))


def _fits(post: _Postings, words: np.ndarray, position: int, span: int) -> bool:
    lo = np.searchsorted(post.keys, (words << 32) + max(0, position - span + 1))
    hi = np.searchsorted(post.keys, (words << 32) + position + span - 1, side="right")
    around = [post.keys[a:b] & 0xFFFFFFFF for a, b in zip(lo, hi)]
    return any(all(((x >= s) & (x < s + span)).any() for x in around) for s in range(max(0, position - span + 1), position + 1))


def _passes(items: DataFrame, words: int) -> Iterator[list[tuple[str, bytes | None]]]:
    """The items in bounded lists: their rows come to the driver a part at a time."""
    named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text").cast("string").alias("text"))
    held, size = [], 0
    for r in named.where("text is not null").toLocalIterator():
        body = r["text"].encode("utf-8", "replace")
        n = len(body) // 2 + 1  # at least as many as its words
        if held and size + n > words:
            yield held
            held, size = [], 0
        held.append((r["item_id"], body))
        size += n
    yield held


def _search(index: DataFrame, items: DataFrame, window: int, span: int | None, pass_words: int) -> DataFrame:
    """``row, spans, items, near`` of pieces with an occurrence: hit words as
    ranges of the text, items with an occurrence, items nearby."""
    spark = index.sparkSession

    def searcher(windows):
        def run(batches):
            w = windows.value
            for batch in batches:
                out = []
                for i in range(batch.num_rows):
                    col = lambda n: batch.column(n)[i].values  # noqa: B023, E731
                    post = _Postings(col("terms"), col("ends").to_numpy(), col("positions").to_numpy(), w.vocabulary)
                    texts = [col(n).to_numpy() for n in ("row", "at", "first", "own_from", "own_to")]
                    out += _answers(post, w, texts, span)
                cols = list(zip(*out)) if out else [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.list_(pa.int64())), pa.array(cols[2], pa.list_(pa.int64())),
                     pa.array(cols[3], pa.list_(pa.string())), pa.array(cols[4], pa.list_(pa.string()))], names=["row", "lo", "hi", "items", "near"])

        return run

    found = None
    for part in _passes(items, pass_words):
        windows = spark.sparkContext.broadcast(_Windows(part, window))
        one = index.mapInArrow(searcher(windows), "row long, lo array<long>, hi array<long>, items array<string>, near array<string>")
        found = one if found is None else found.unionByName(one)
    return found


def _answers(post: _Postings, w: _Windows, texts: list[np.ndarray], span: int | None) -> list[tuple]:
    row, at, first, own_from, own_to = texts
    text_of = lambda place: np.searchsorted(first, place, side="right") - 1
    cover = np.zeros(int(post.positions.max(initial=0)) + 2, np.int64)
    pairs, near = [], []
    for n, table in w.tables.items():
        window, start, close, place = matches(post, table, span)
        np.add.at(cover, start, 1)
        np.add.at(cover, start + n, -1)
        # matches in the context count as well: a document's items are a set
        pairs.append(_with_items(window, text_of(start), w.items[n]))
        near.append(_with_items(close, text_of(place), w.items[n]))
    hit = np.cumsum(cover) > 0
    edge = np.diff(hit.astype(np.int8), prepend=0, append=0)
    lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    spans = defaultdict(list)
    for j, a, b in zip(text_of(lo), lo, hi):
        if (x := max(a, own_from[j])) < (y := min(b, own_to[j])):
            spans[j].append((int(at[j] + x - own_from[j]), int(at[j] + y - own_from[j])))
    named, close = _grouped(pairs), _grouped(near)
    out = []
    for j in sorted({*spans, *named, *close}):
        s = spans.get(j, [])
        out.append((int(row[j]), [a for a, _ in s], [b for _, b in s], [w.names[k] for k in named.get(j, [])], [w.names[k] for k in close.get(j, [])]))
    return out


def _with_items(window: np.ndarray, text: np.ndarray, lists: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Distinct ``text, item`` of matches."""
    firsts, items = lists
    which, nth = _spread((firsts[1:] - firsts[:-1])[window])
    return np.unique((text[which] << 32) + items[firsts[window][which] + nth])


def _grouped(parts: list[np.ndarray]) -> dict[int, list[int]]:
    out = defaultdict(list)
    if parts:
        for key in np.unique(np.concatenate(parts)).tolist():
            out[key >> 32].append(key & 0xFFFFFFFF)
    return out


def _texts(index: DataFrame) -> DataFrame:
    """``row, doc_id, n_words`` of every text in the index."""
    one = index.select(F.explode(F.arrays_zip("row", "doc_id", "own_from", "own_to", "whole")).alias("t")).select("t.*")
    one = one.select("row", "doc_id", "whole", (F.col("own_to") - F.col("own_from")).cast("long").alias("n_words"))
    rest = one.where("not whole").groupBy("row").agg(F.min("doc_id").alias("doc_id"), F.sum("n_words").alias("n_words"))
    return one.where("whole").select("row", "doc_id", "n_words").unionByName(rest)


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, span: int | None = SPAN, block_words: int = BLOCK_WORDS,
                  piece_words: int = PIECE_WORDS, pass_words: int = PASS_WORDS) -> DataFrame:
    """For each row of ``docs(doc_id, text)``: ``doc_id, n_words, n_hit``
    (words inside an occurrence of a window of ``items(item_id, text)``),
    ``items`` (sorted ids of items with one), ``near`` (items with a window
    whose words all lie within ``span`` words; without a span, none).

    A window is ``window`` consecutive words of an item; an item of fewer,
    but not none, is one window."""
    index = build(docs, max(window, span or 0) - 1, block_words, piece_words)
    with during(index.sparkSession, BLOCKS_AT_ONCE):
        found = cut(_search(index, items, window, span, pass_words))
    union = F.aggregate(  # length of the union of sorted ranges
        F.array_sort(F.flatten(F.collect_list(F.arrays_zip("lo", "hi")))), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda acc, x: F.struct((acc["n"] + F.greatest(x["hi"] - F.greatest(x["lo"], acc["end"]), F.lit(0))).alias("n"), F.greatest(acc["end"], x["hi"]).alias("end")))
    names = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    hits = found.groupBy("row").agg(union["n"].alias("n_hit"), names("items"), names("near"))
    none = F.array().cast("array<string>")
    return _texts(index).join(hits, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", none).alias("items"), F.coalesce("near", none).alias("near"))


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near``."""
    got = contamination(docs, items)
    return got.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
                      F.size("near").cast("long").alias("n_near"))
