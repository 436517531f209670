"""Mixture-controlled packing: deficit round-robin over source queues.

Every source is a queue of tokens. A window of ``window_sequences`` sequences
is filled by all queues in turn, each due its target share of the window's
tokens. Served are whole tokens; the fraction left over is the queue's
deficit and is carried into the next window, so that after any number of
windows each queue has had its target within one token, and the rounding of
the running sums makes each window exactly full.

Because the deficits are the fractional parts of running sums, the service
that a queue had before window ``k`` has a closed form, and every partition
of the input places its own documents: it needs only the number of tokens of
its queue in the partitions before it. Nothing is passed from window to
window or through one task.

Default targets are the queues' shares of all tokens; all queues then end in
the last window. With other targets a queue can run dry; the rest go on in
proportion to their targets (a new phase). Queues without a target follow at
the end. Only the last sequence can be short of ``length`` tokens.

A source with less than one token a window shares one queue with the other
such sources, which bounds the number of queues by the tokens of a window.
A null source is the source ''.
"""

from __future__ import annotations

import base64
import json
import zlib
from bisect import bisect_right
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut

# Fixed value: the word pattern of byte-level BPE vocabularies.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# A table of at most so many rows (about 60 bytes each) is broadcast.
BROADCAST_ROWS = 200_000


@lru_cache(maxsize=4)
def encoder(path: str):
    """``text -> ids`` of a tokenizers file.

    A byte-level BPE file whose ids follow its merges is run by tiktoken,
    which gives the same ids at four times the speed; any other by tokenizers.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    vocab = model.get("vocab", {})
    merges = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
    plain = (model.get("type") == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
             and not spec.get("normalizer") and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
             and not any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]))
    made = [vocab[a + b] for a, b in merges] if plain else []
    if plain and made == sorted(set(made)) and made[0] >= 256:
        import tiktoken

        to_byte = byte_of_char()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(to_byte[c] for c in token): i for token, i in vocab.items() if token not in special}
        enc = tiktoken.Encoding(base64.b32encode(path.encode()).decode(), pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens=special)
        return lambda text: enc.encode_to_numpy(text, allowed_special="all", disallowed_special=())
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return lambda text: np.array(tok.encode(text, add_special_tokens=False).ids, np.uint32)


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for:
    printable Latin-1 for itself, the other bytes in order from U+0100."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def tokens(docs: DataFrame, path: str) -> DataFrame:
    """``part, source, doc_id, at, n, ids``: ids of each document with the
    closing id 0, and the number of ids of its source before it in the part."""
    kind = pa.schema([("source", pa.string()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        encode, ahead = encoder(path), {}
        for batch in batches:
            out = []
            for source, doc, text in zip(*(batch.column(c).to_pylist() for c in ("source", "doc_id", "text"))):
                ids = np.append(encode(text), 0).astype("<u4")
                at = ahead.get(source, 0)
                ahead[source] = at + len(ids)
                body = ids.astype("<u2") if ids.max() < 1 << 16 else ids
                out.append((source, doc, at, len(ids), body.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), kind)] if out else
                                             [pa.array([], t.type) for t in kind], schema=kind)

    src = docs.select(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), F.col("doc_id").cast("long").alias("doc_id"),
                      F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = src.mapInArrow(run, "source string, doc_id long, at long, n long, ids binary")
    return cut(rows.withColumn("part", F.spark_partition_id()))


class Layout:
    """Where each token of each queue goes.

    ``phases``: lists of tokens due per queue; inside a phase all queues run
    at constant shares and end together.
    """

    def __init__(self, totals: list[int], weights: list[float] | None, window: int):
        self.window, self.phases = window, []
        left = list(totals)
        self.ahead: list[list[int]] = [[0] for _ in totals]  # tokens of the queue before each phase
        start = 0
        for due in _phases(left, weights, window):
            runs, total = [0], 0
            for q, n in enumerate(due):
                total += n
                runs.append(total)
                self.ahead[q].append(self.ahead[q][-1] + n)
            self.phases.append((start, total, runs))
            start += total
        self.total = start

    def served(self, phase: int, q: int, k: int) -> tuple[int, int]:
        """Tokens of queue ``q`` before window ``k`` of the phase, and the
        phase's tokens of lower queues before then."""
        _, total, runs = self.phases[phase]
        n = min(k * self.window, total)
        low = runs[q] * n // total
        return runs[q + 1] * n // total - low, low

    def spans(self, q: int, at: int, n: int):
        """``start, position, length`` of the runs that tokens ``at .. at+n``
        of queue ``q`` fall into."""
        done, ahead = 0, self.ahead[q]
        while done < n:
            phase = bisect_right(ahead, at + done) - 1
            first, total, runs = self.phases[phase]
            u, due = at + done - ahead[phase], runs[q + 1] - runs[q]
            k = u * total // (due * self.window)
            while self.served(phase, q, k + 1)[0] <= u:
                k += 1
            while (got := self.served(phase, q, k))[0] > u:
                k -= 1
            before, low = got
            after, _ = self.served(phase, q, k + 1)
            # in window k, lower queues come first; they get what their running sums grow by
            lower = self.served(phase, q, k + 1)[1] - low
            size = min(n - done, after - u)
            yield done, first + k * self.window + lower + (u - before), size
            done += size


def _phases(left: list[int], weights: list[float] | None, window: int):
    """Tokens due per queue in each phase, until all are served."""
    while any(left):
        live = [q for q, n in enumerate(left) if n and weights and weights[q] > 0]
        if live:
            turns = min(left[q] / weights[q] for q in live)
            due = [min(n, int(weights[q] * turns)) if q in live else 0 for q, n in enumerate(left)]
            last = min(live, key=lambda q: left[q] / weights[q])
            due[last] = left[last]
        else:
            due = list(left)
        total = sum(due)
        for q, n in enumerate(due):  # less than a token a window: served in one run
            if 0 < n * window < total:
                yield [n if p == q else 0 for p in range(len(due))]
        due_now = [n if n * window >= total else 0 for n in due]
        if any(due_now):
            yield due_now
        left = [a - b for a, b in zip(left, due)]


def pack(docs: DataFrame, path: str, length: int = 1024, window_sequences: int = 16,
         targets: dict[str, float] | None = None, with_ids: bool = True) -> DataFrame:
    """Packs ``docs(doc_id, source, text)`` into sequences of ``length`` ids.

    Returns one row per piece: ``doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset, source, padded_length``, and ``ids`` unless
    ``with_ids`` is off. A null
    text is empty: its document is the one id 0. Rows that repeat a doc_id are
    packed each. ``padded_length`` is ``length``, but for a last sequence whose
    ids number a power of two and need no padding.
    """
    window = length * window_sequences
    toks = tokens(docs, path)
    sums = cut(toks.groupBy("source", "part").agg(F.sum("n").alias("n")))
    by_source = sums.groupBy("source").agg(F.sum("n").alias("n"))
    all_ids = int(by_source.agg(F.sum("n")).first()[0] or 0)
    named = sorted(targets or {})
    large = F.col("n").cast("decimal(38,0)") * window >= all_ids
    if named:
        large = large | F.col("source").isin(named)
    # at most one row per token of a window, and one per named target
    own = {r["source"]: int(r["n"]) for r in by_source.where(large).orderBy("source").collect()}
    names = [*own, None]
    totals = [*own.values(), all_ids - sum(own.values())]
    layout = Layout(totals, [targets.get(s, 0.0) if s is not None else 0.0 for s in names] if targets else None, window)
    number = {s: i for i, s in enumerate(own)}
    queues = docs.sparkSession.createDataFrame([(s, i) for s, i in number.items()] or [("", 0)], "source string, queue int")

    keyed = sums.join(F.broadcast(queues), "source", "left").withColumn("queue", F.coalesce("queue", F.lit(len(own))))
    per_part = keyed.groupBy("queue", "part").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per_part = per_part.select("queue", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("queue", "part").orderBy("source").rowsBetween(Window.unboundedPreceding, -1)
    base = keyed.withColumn("inner", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(per_part, ["queue", "part"])
    base = cut(base.select("source", "part", "queue", (F.col("base") + F.col("inner")).alias("base")))
    if base.count() <= BROADCAST_ROWS:
        base = F.broadcast(base)
    rows = toks.join(base, ["source", "part"]).select("doc_id", "source", "queue", (F.col("base") + F.col("at")).alias("at"), "n", "ids")

    tail = layout.total % length
    last, last_length = layout.total // length, tail if tail & (tail - 1) == 0 else length

    def run(batches):
        for batch in batches:
            out = []
            for doc, source, q, at, n, body in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.frombuffer(body, "<u2" if len(body) == 2 * n else "<u4")
                for start, pos, size in layout.spans(q, at, n):
                    while size:
                        seq, offset = divmod(pos, length)
                        part = min(size, length - offset)
                        piece = ids[start:start + part].astype("<u4")
                        out.append((doc, start, part, zlib.crc32(piece.tobytes()), n, seq, offset, source,
                                    last_length if seq == last else length) + ((piece,) if with_ids else ()))
                        start, pos, size = start + part, pos + part, size - part
                if len(out) >= 4096:
                    yield _batch(out)
                    out = []
            if out:
                yield _batch(out)

    return rows.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
                                "offset long, source string, padded_length long" + ", ids array<int>" * with_ids)


def _batch(rows) -> pa.RecordBatch:
    kinds = (*[pa.int64()] * 7, pa.string(), pa.int64(), pa.list_(pa.int32()))[:len(rows[0])]
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source", "padded_length", "ids"][:len(rows[0])]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
