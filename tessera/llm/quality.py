"""Quality classifier from weak labels.

Eight overlapping heuristics vote junk, good or nothing on each document.
Expectation-maximisation over the counts of vote patterns of all documents
(at most 3^8 rows reach the driver) estimates how often each heuristic is
right on junk and on good documents, and so the posterior of each pattern; a
heuristic that does not vote says nothing.
The posteriors of a bounded sample train a linear scorer over hashed features:
trigrams of character shapes and the habits of its words. The scorer judges
every document; its weights are all that is sent to the tasks.

Cases: a text without a word (null, empty, white space) is not kept, with
score 0 and no votes. Rows that repeat are judged each, alike; a null doc_id
is judged by its text (but does not enter the fitted sample).
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import boxed, cut, unboxed

HEURISTICS = ["symbols", "capitals", "columns", "echoes", "variety", "decorated", "function_words", "sentences"]
# Kinds of junk by the heuristics that see them, and how far a vote for junk is trusted at the start.
KINDS = [["symbols", "decorated"], ["capitals"], ["columns"], ["echoes", "variety"], ["function_words", "sentences"]]
TRUST = dict.fromkeys(HEURISTICS, 0.9) | dict.fromkeys(["variety", "function_words", "sentences"], 0.3)
SHAPES = 1 << 12  # hashed dimensions of the scorer
FIT_ROWS = 4000  # documents that the scorer is fitted on, about
NONE, GOOD, JUNK = 0, 1, 2

# classes of characters: space, newline, lower, upper, digit, other letters, marks; then ASCII symbols by themselves
_SPACE, _LINE, _LOWER, _UPPER, _DIGIT, _LETTER, _OTHER, _SYMBOL = range(8)
_CLASSES = 48


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    table = np.full(0x110000, _OTHER, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))
        if kind == "Ll":
            table[c] = _LOWER
        elif kind in ("Lu", "Lt"):
            table[c] = _UPPER
        elif kind[0] == "L" or kind[0] == "M":
            table[c] = _LETTER
        elif kind[0] == "N":
            table[c] = _DIGIT
        elif kind[0] == "Z":
            table[c] = _SPACE
    for i, c in enumerate(c for c in map(chr, range(33, 127)) if not c.isalnum()):
        table[ord(c)] = _SYMBOL + i
    table[[9, 11, 12, 13]] = _SPACE
    table[10] = _LINE
    return table


def features(text: str | None, shapes: bool = True) -> tuple[list[int], np.ndarray | None] | None:
    """Votes of the heuristics and, with ``shapes``, the scorer's hashed
    features; nothing for a text without a word."""
    points = np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32)
    kind = _classes()[points]
    gap = kind <= _LINE
    edge = np.diff(gap.astype(np.int8), prepend=1, append=1)
    first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    n = len(first)
    if not n:
        return None
    word = (kind >= _LOWER) & (kind <= _LETTER)
    symbol = kind >= _SYMBOL
    letters = max(1, int(((kind == _LOWER) | (kind == _UPPER) | (kind == _LETTER)).sum()))
    ink = len(points) - int(gap.sum())
    capitals = int((kind == _UPPER).sum()) / letters
    symbols = int(symbol.sum()) / ink
    core = np.add.reduceat(word.astype(np.int64), first)  # letters and digits of each word (and the gap behind it)
    size = last - first
    columns = float(((core == 0) & (size == 1)).mean())
    decorated = float((symbol[last - 1] & symbol[np.maximum(last - 2, 0)] & (size > 2)).mean())
    # words by a rolling hash, to see echoes and variety
    with np.errstate(over="ignore"):
        codes = (points.astype(np.uint64) + np.uint64(0x9E37)) * np.uint64(0x9E3779B97F4A7C15)
        codes = np.where(word, codes ^ (codes >> np.uint64(29)), np.uint64(0))
        start_of = np.repeat(first, np.diff(np.append(first, len(points))))
        place = (np.arange(first[0], len(points)) - start_of).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        hashes = np.add.reduceat(codes[first[0]:] * place, first - first[0])
    echoes = float((hashes[1:] == hashes[:-1]).mean()) if n > 1 else 0.0
    variety = len(np.unique(hashes)) / n
    function = float(((core > 0) & (core <= 3)).mean())
    ends = points[last - 1]
    stop = ((ends == 46) | (ends == 33) | (ends == 63)) & word[np.maximum(last - 2, 0)]
    sentences = float(stop.mean())

    long = n >= 40
    votes = [
        NONE if n < 20 and symbols < 0.3 else JUNK if symbols > 0.14 else GOOD if symbols < 0.07 else NONE,
        NONE if letters < 12 else JUNK if capitals > 0.35 else GOOD if capitals < 0.12 else NONE,
        JUNK if columns > 0.1 else GOOD if columns < 0.01 else NONE,
        JUNK if echoes > 0.15 else GOOD if echoes < 0.05 else NONE,
        NONE if n < 20 else JUNK if variety < 0.2 and n < 4000 else GOOD if variety > 0.4 else NONE,
        JUNK if decorated > 0.15 else GOOD if decorated < 0.03 else NONE,
        NONE if not long else JUNK if function < 0.05 else GOOD if 0.15 < function < 0.6 else NONE,
        NONE if not long else JUNK if sentences < 0.002 else GOOD if 0.02 < sentences < 0.25 else NONE,
    ]
    if not shapes:
        return votes, None
    k = np.minimum(kind, _CLASSES - 1).astype(np.int64)
    grams = (k[:-2] * _CLASSES + k[1:-1]) * _CLASSES + k[2:]
    x = np.bincount((grams * 40503 >> 4) % (SHAPES - 64), minlength=SHAPES).astype(np.float64)
    x = np.sqrt(x / max(1, len(grams)))
    for i, v in enumerate((symbols, capitals, columns, echoes, variety, decorated, function, sentences)):
        x[SHAPES - 64 + 8 * i + min(7, int(np.sqrt(v) * 8))] = 1.0
    return votes, x


def _pattern(votes: list[int]) -> int:
    return sum(v * 3 ** i for i, v in enumerate(votes))


def _votes(pattern: int) -> list[int]:
    return [pattern // 3 ** i % 3 for i in range(len(HEURISTICS))]


def accuracies(counts: dict[int, int], rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Shares of good documents and of each kind of junk, and of the votes of
    each heuristic on them where it votes: ``prior[class], table[class,
    heuristic, vote]``, from the counts of vote patterns; class 0 is good.

    Junk of one kind is good in the eyes of the heuristics for others, so each
    kind is a class of its own, inside which heuristics err independently. A
    vote for a defect is trusted at the start with ``TRUST``."""
    votes = np.array([_votes(p) for p in counts], int).reshape(-1, len(HEURISTICS))
    n = np.array(list(counts.values()), float)
    bad = votes == JUNK
    hits = np.array([bad[:, [HEURISTICS.index(h) for h in kind]].sum(axis=1) for kind in KINDS]).reshape(len(KINDS), -1).T
    trust = np.max(np.where(bad, [TRUST[h] for h in HEURISTICS], 0.01), axis=1, initial=0.01)
    share = np.column_stack([1 - trust, (hits + 1e-3) / (hits + 1e-3).sum(axis=1, keepdims=True) * trust[:, None]])
    prior, table = np.ones(share.shape[1]), np.ones((share.shape[1], len(HEURISTICS), 3))
    for _ in range(rounds):
        weight = n[:, None] * share
        prior = (weight.sum(axis=0) + 1) / (weight.sum() + len(prior))
        for v in (GOOD, JUNK):
            table[:, :, v] = weight.T @ (votes == v) + 0.5
        table[:, :, 1:] /= table[:, :, 1:].sum(axis=2, keepdims=True)
        before, share = share, _shares(votes, prior, table)
        if not len(n) or np.abs(share - before).max() < 1e-9:
            break
    return prior, table


def _shares(votes: np.ndarray, prior: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Probability of each class for each pattern."""
    log = np.log(prior) + sum((np.log(table[:, h, votes[:, h]]).T for h in range(votes.shape[1])), np.zeros((len(votes), len(prior))))
    log -= log.max(axis=1, keepdims=True, initial=-1e9)
    return np.exp(log) / np.exp(log).sum(axis=1, keepdims=True)


def posteriors(counts: dict[int, int]) -> dict[int, float]:
    """Probability of good for each vote pattern."""
    prior, table = accuracies(counts)
    return dict(zip(counts, _shares(np.array([_votes(p) for p in counts], int).reshape(-1, len(HEURISTICS)), prior, table)[:, 0]))


def fit(x: np.ndarray, good: np.ndarray, rounds: int = 400, ridge: float = 1e-3) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by accelerated gradient steps."""
    w, b = np.zeros(x.shape[1]), 0.0
    if not len(x):
        return w, b
    most = max((x[at:at + 256] ** 2).sum(axis=1).max() for at in range(0, len(x), 256))  # of some rows at a time: no second matrix
    ahead, ahead_b, step = w, b, 1 / (0.25 * (most + 1) + ridge)
    for i in range(rounds):
        gap = 1 / (1 + np.exp(-(x @ ahead + ahead_b))) - good
        w_new, b_new = ahead - step * (x.T @ gap / len(x) + ridge * ahead), ahead_b - step * gap.mean()
        momentum = i / (i + 3)
        ahead, ahead_b = w_new + momentum * (w_new - w), b_new + momentum * (b_new - b)
        w, b = w_new, b_new
    return w, b


def _patterns(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            got = [features(t, shapes=False) for t in batch.column("text").slice(at, 256).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([_pattern(g[0]) if g else None for g in got], pa.int64())], names=["pattern"])


def _sampled(batches):
    for batch in batches:
        rows = [(_pattern(g[0]), np.flatnonzero(g[1]), g[1]) for t in batch.column("text").to_pylist() if (g := features(t))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _, _ in rows], pa.int64()), pa.array([i for _, i, _ in rows], pa.list_(pa.int64())),
             pa.array([x[i] for _, i, x in rows], pa.list_(pa.float64()))], names=["pattern", "at", "value"])


def judge(docs: DataFrame, threshold: float = 0.4, fit_rows: int = FIT_ROWS) -> DataFrame:
    """``row, doc_id, votes, weak_good, score, keep`` for each row of ``docs``:
    the row itself, a letter j, g or - for each heuristic, the posterior of
    good, the scorer's probability of good and its decision. About ``fit_rows`` documents, chosen by a hash of doc_id, fit
    the scorer; the votes of all documents fit the posteriors."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = text.select("text").mapInArrow(_patterns, "pattern long").where("pattern is not null").groupBy("pattern").count()
    counts = {r["pattern"]: r["count"] for r in counts.orderBy("pattern").collect()}  # at most 3^8 rows
    weak = posteriors(counts)

    share = min(1.0, fit_rows / max(1, sum(counts.values())))
    few = text.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 30)) < int(share * (1 << 30))).where("doc_id is not null")
    few = cut(few.mapInArrow(_sampled, "pattern long, at array<long>, value array<double>")).orderBy("pattern", "at", "value").toArrow()
    x = np.zeros((len(few), SHAPES))
    row = 0
    for batch in few.to_batches():  # as columns: as Python objects the values take ten times the space
        at, value = batch.column("at"), batch.column("value")
        rows = np.repeat(np.arange(row, row + len(batch)), np.diff(at.offsets.to_numpy()))
        x[rows, at.flatten().to_numpy()] = value.flatten().to_numpy()
        row += len(batch)
    w, b = fit(x, np.array([weak[p] for p in few.column("pattern").to_pylist()]))
    del x, few

    model = docs.sparkSession.sparkContext.broadcast((weak, w, b))

    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weak, w, b = model.value
        for batch in batches:
            yield pa.concat_arrays([_scored(batch.slice(at, 256).to_pylist(), weak, w, b, threshold) for at in range(0, max(1, len(batch)), 256)])

    # Only the texts go to Python; the rows stay. It is not to be copied into a filter on its result.
    judged = F.arrow_udf(scored, "votes string, weak_good double, score double, keep boolean").asNondeterministic()
    return boxed(docs).select("row", "doc_id", judged("text").alias("judged")).select("row", "doc_id", "judged.*")


def _scored(texts: list[str | None], weak: dict[int, float], w: np.ndarray, b: float, threshold: float) -> pa.StructArray:
    out = []
    for t in texts:
        got = features(t)
        if got is None:
            out.append(("-" * len(HEURISTICS), 0.0, 0.0, False))
            continue
        score = float(1 / (1 + np.exp(-(got[1] @ w + b))))
        out.append(("".join("-gj"[v] for v in got[0]), float(weak.get(_pattern(got[0]), 0.5)), score, score >= threshold))
    cols = list(zip(*out)) if out else [()] * 4
    return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.float64(), pa.float64(), pa.bool_()))],
                                      names=["votes", "weak_good", "score", "keep"])


def report(docs: DataFrame) -> DataFrame:
    """``doc_id, votes, weak_good, score, keep``."""
    return judge(docs.select("doc_id", "text")).drop("row")


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the scorer keeps."""
    return unboxed(judge(docs).where("keep"), docs)
