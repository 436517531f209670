"""Words of whole texts as bytes, in slices, and counts of them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

SLICE = 1 << 22  # bytes split at once


def byte_table(digits: bool) -> bytes:
    """Maps A-Z to a-z, keeps a-z, bytes beyond ASCII and, with ``digits``, 0-9; all else becomes a space."""
    keep = lambda b: b >= 128 or chr(b).islower() or (digits and chr(b).isdigit())
    return bytes(b if keep(b) else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def word_slices(body: bytes | None, table: bytes) -> Iterator[list[bytes]]:
    """The words of a UTF-8 text in order, a bounded number of bytes at a time
    (but a word is never cut)."""
    body = (body or b"").translate(table)
    if len(body) <= SLICE:
        yield body.split()
        return
    at = 0
    while at < len(body):
        end = body.find(b" ", at + SLICE)
        end = len(body) if end < 0 else end
        yield body[at:end].split()
        at = end


def text_rows(batch: pa.RecordBatch, names: list[str], rows: int = 256) -> Iterator[tuple]:
    """Tuples of the named columns, texts as bytes; few rows become Python objects at a time."""
    for at in range(0, batch.num_rows, rows):
        few = batch.slice(at, rows)
        cols = [few.column(n) for n in names]
        cols = [c.cast(pa.large_binary() if pa.types.is_large_string(c.type) else pa.binary()) if pa.types.is_string(c.type) or pa.types.is_large_string(c.type) else c for c in cols]
        yield from zip(*(c.to_pylist() for c in cols))
