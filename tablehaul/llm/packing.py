"""Token sequences of fixed length from documents of any length, by harmonic classes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.tokens import encoder, split, with_end
from tablehaul.llm.words import slices

#: Pieces up to 1/16 of the capacity stay whole; longer ones if their class leaves 1/64 at most.
SHORT, SLACK = 16, 64


def cuts(n: int, capacity: int) -> list[int]:
    """Lengths into which a document of ``n`` tokens is cut.

    Pieces of the full capacity first. The rest stays whole if k of it, the most that fit, nearly
    fill a sequence; otherwise 1/(k + 1) of the capacity is cut off, and so on with what is left,
    which is less than 1/(k * (k + 1)) of it.
    """
    lengths = [capacity] * (n // capacity)
    rest = n % capacity
    while rest:
        k = capacity // rest
        if rest * SHORT <= capacity or (capacity - k * rest) * SLACK <= capacity:
            lengths.append(rest)
            break
        lengths.append(capacity // (k + 1))
        rest -= capacity // (k + 1)
    return lengths


class _Bins:
    """Open bins of a worker, one for each class: class k closes with k pieces."""

    def __init__(self, capacity: int, first: int):
        self.capacity, self.next = capacity, first
        self.open: dict[int, list] = {}
        self.rows: list[tuple] = []

    def _close(self, pieces: list) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            self.rows.append((doc, start, len(ids), ids.tobytes(), total, self.next, offset))
            offset += len(ids)
        self.next += 1

    def add(self, doc, ids: np.ndarray) -> None:
        start = 0
        for length in cuts(len(ids), self.capacity):
            k = self.capacity // length
            pieces = self.open.setdefault(k, [])
            pieces.append((doc, start, ids[start : start + length].copy(), len(ids)))
            if len(pieces) == k:
                self._close(self.open.pop(k))
            start += length

    def finish(self) -> None:
        """What is left in open bins, one after the other; the last tokens in powers of two."""
        left = [p for k in sorted(self.open) for p in self.open[k]]
        total = sum(len(p[2]) for p in left)
        room = [self.capacity] * (total // self.capacity)
        room += [1 << b for b in range(self.capacity.bit_length(), -1, -1) if total % self.capacity >> b & 1]
        pieces, want = [], list(reversed(room))
        for doc, start, ids, of in left:
            while len(ids):
                free = want[-1] - sum(len(p[2]) for p in pieces)
                pieces.append((doc, start, ids[:free], of))
                start, ids = start + len(ids[:free]), ids[free:]
                if sum(len(p[2]) for p in pieces) == want[-1]:
                    self._close(pieces)
                    pieces = []
                    want.pop()
        self.open = {}

    def take(self) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        columns = zip(*self.rows, strict=True) if self.rows else [[]] * len(kinds)
        self.rows = []
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _pack(tokenizer: str, spaced: bool, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = encoder(tokenizer, spaced)
        bins = _Bins(capacity, TaskContext.get().partitionId() << 33)
        for batch in batches:
            names = batch.column("id").to_pylist()
            for row, data, at in slices(batch.column("text")):
                ids, edges = with_end(*codes.encode(data, at), end_id)
                for i, own in enumerate(split(ids.astype("<u4"), edges)):
                    bins.add(names[row + i], own)
                yield bins.take()
        bins.finish()
        yield bins.take()

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = 1024,
    id_col: str = "doc_id",
    text_col: str = "text",
    spaced: bool = True,
) -> DataFrame:
    """Pieces of all documents, dealt into sequences of at most ``capacity`` tokens.

    Each text is encoded whole (a null as an empty one) and ``end_id`` follows. A piece that fits k
    times into a sequence is of class k, and a sequence of class k takes k pieces. Every task
    fills its own sequences from the documents that it reads; nothing is shuffled. What its open
    sequences hold at the end is laid out one after the other into full ones, and the last
    tokens into sequences whose lengths are powers of two.

    Returns ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``; ``ids`` are
    little-endian unsigned 32-bit. Sequence numbers are unique, with gaps between tasks. Every
    row is a document of its own, also with a null or repeated id; no rows give none.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(
        _pack(tokenizer, spaced, end_id, capacity),
        "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, "
        "offset long",
    )
