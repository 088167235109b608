"""Token ids as wavelet matrices, one for each shard of documents, in compressed files."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablehaul.llm.tokens import encoder, with_end
from tablehaul.llm.words import slices
from tablehaul.shared import stage

#: Bits between two kept ranks; ids in a shard, after which the next begins; text bytes of a task.
BLOCK = 512
SHARD_IDS = 1 << 20
TASK_BYTES = 32 << 20
#: Files whose sizes are sent to all tasks, and places that one row asks for.
FEW_FILES, QUESTIONS = 100_000, 4096
SHAPE = (
    "part long, shard long, within long, n_ids long, doc_ids binary, doc_sizes binary, named binary, "
    "zeros array<long>, planes array<binary>, ranks array<binary>"
)


@dataclass
class WaveletMatrix:
    """Bit-planes from the highest bit to the lowest, each ordered by the bits above it.

    A plane's zeros come first in the next plane, its ones after them, both in order. ``ranks``
    holds the ones before every block of 512 bits.
    """

    size: int
    zeros: list[int]
    planes: list[np.ndarray]
    ranks: list[np.ndarray]

    @classmethod
    def build(cls, ids: np.ndarray, n_planes: int) -> WaveletMatrix:
        zeros, planes, ranks = [], [], []
        size, step = len(ids), BLOCK // 8
        ids = ids.astype(np.uint16 if n_planes <= 16 else np.uint32)
        for level in range(n_planes - 1, -1, -1):
            one = (ids & ids.dtype.type(1 << level)) != 0
            packed = np.packbits(one, bitorder="little")
            bits = np.zeros(-(-len(packed) // step) * step, np.uint8)
            bits[: len(packed)] = np.bitwise_count(packed)
            blocks = bits.reshape(-1, step).sum(1, dtype=np.int64)
            planes.append(packed)
            ranks.append(np.concatenate([[0], np.cumsum(blocks)]).astype(np.uint32))
            zeros.append(size - int(ranks[-1][-1]))
            if level:
                ids = np.concatenate([ids[~one], ids[one]])
        return cls(size, zeros, planes, ranks)

    def ids(self) -> np.ndarray:
        """All ids, from the lowest plane up."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        values = np.zeros(self.size, kind)
        for depth in range(len(self.planes) - 1, -1, -1):
            one = np.unpackbits(self.planes[depth], count=self.size, bitorder="little").astype(bool)
            above = np.empty(self.size, kind)
            above[~one] = values[: self.zeros[depth]]
            above[one] = values[self.zeros[depth] :] | kind(1 << (len(self.planes) - 1 - depth))
            values = above
        return values

    def _rank(self, depth: int, at: int) -> int:
        """Ones before a place of a plane."""
        block = at // BLOCK
        bits = self.planes[depth][block * BLOCK // 8 : (at + 7) // 8]
        return int(self.ranks[depth][block]) + int(
            np.unpackbits(bits, count=at - block * BLOCK, bitorder="little").sum()
        )

    def _select(self, depth: int, one: bool, nth: int) -> int:
        """The place of the nth one, or zero, of a plane; counted from 0."""
        ones = self.ranks[depth].astype(np.int64)
        before = ones if one else np.minimum(np.arange(len(ones)) * BLOCK, self.size) - ones
        block = int(np.searchsorted(before, nth, "right")) - 1
        bits = np.unpackbits(
            self.planes[depth][block * BLOCK // 8 : (block + 1) * BLOCK // 8],
            count=min(BLOCK, self.size - block * BLOCK), bitorder="little",
        )
        return block * BLOCK + int(np.flatnonzero(bits == one)[nth - int(before[block])])

    def access(self, at: int) -> int:
        """The id at a place."""
        if not 0 <= at < self.size:
            raise IndexError(at)
        value = 0
        for depth in range(len(self.planes)):
            one = self.planes[depth][at // 8] >> (at % 8) & 1
            ones = self._rank(depth, at)
            at = self.zeros[depth] + ones if one else at - ones
            value = value << 1 | int(one)
        return value

    def _range(self, value: int, first: int, last: int) -> tuple[int, int]:
        for depth in range(len(self.planes)):
            a, b = self._rank(depth, first), self._rank(depth, last)
            if value >> (len(self.planes) - 1 - depth) & 1:
                first, last = self.zeros[depth] + a, self.zeros[depth] + b
            else:
                first, last = first - a, last - b
        return first, last

    def count(self, value: int, first: int = 0, last: int | None = None) -> int:
        """How often an id occurs in a range of places."""
        if value >> len(self.planes):
            return 0
        a, b = self._range(value, first, self.size if last is None else last)
        return b - a

    def find(self, value: int, nth: int) -> int:
        """The place of the nth occurrence of an id, counted from 0."""
        if not 0 <= nth < self.count(value):
            raise IndexError(nth)
        at = self._range(value, 0, self.size)[0] + nth
        for depth in range(len(self.planes) - 1, -1, -1):
            one = bool(value >> (len(self.planes) - 1 - depth) & 1)
            at = self._select(depth, one, at - self.zeros[depth] if one else at)
        return at


def _shard(part: int, shard: int, within: int, docs: list, sizes: list, ids: np.ndarray, n_planes: int):
    matrix = WaveletMatrix.build(ids, n_planes)
    named = np.array([d is not None for d in docs], np.uint8)
    numbers = np.array([d or 0 for d in docs], np.int64)
    values = [
        part, shard, within, len(ids), numbers.tobytes(), np.array(sizes, np.int64).tobytes(),
        named.tobytes(), matrix.zeros, [p.tobytes() for p in matrix.planes],
        [r.tobytes() for r in matrix.ranks],
    ]
    kinds = [pa.int64()] * 4 + [pa.binary()] * 3 + [
        pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.binary())
    ]
    names = [c.split()[0] for c in SHAPE.split(", ")]
    return pa.record_batch([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names)


def _encode(tokenizer: str, spaced: bool, end_id: int, n_planes: int, shard_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = encoder(tokenizer, spaced)
        part, shard, within = TaskContext.get().partitionId(), 0, 0
        docs, sizes, held = [], [], []
        for batch in batches:
            names = batch.column("id").to_pylist()
            for row, data, at in slices(batch.column("text")):
                ids, edges = with_end(*codes.encode(data, at), end_id)
                docs += names[row : row + len(at) - 1]
                sizes += np.diff(edges).tolist()
                held.append(ids)
                if sum(map(len, held)) >= shard_ids:
                    yield _shard(part, shard, within, docs, sizes, np.concatenate(held), n_planes)
                    within += sum(sizes)
                    docs, sizes, held, shard = [], [], [], shard + 1
        if docs:
            yield _shard(part, shard, within, docs, sizes, np.concatenate(held), n_planes)

    return run


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    n_planes: int = 16,
    spaced: bool = False,
    shard_ids: int = SHARD_IDS,
) -> None:
    """Writes the ids of all texts to ``path``, in ascending id order, null ids first.

    Each text is encoded whole, as an empty one if null, and ``end_id`` follows. Documents are
    dealt out by ranges of their id; each task writes one file of shards, each shard a row that
    holds its documents' ids and sizes, and its wavelet matrix. ``n_planes`` bits must hold every
    token id. Documents with equal ids follow each other in the order of their texts. An empty
    table writes files without rows.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranged = texts.repartitionByRange(1 + total // TASK_BYTES, F.col("id").asc_nulls_first())
    rows = ranged.sortWithinPartitions(F.col("id").asc_nulls_first(), "text")
    shards = rows.mapInArrow(_encode(tokenizer, spaced, end_id, n_planes, shard_ids), SHAPE)
    shards.write.option("compression", "zstd").parquet(path)


def _matrix(row: dict) -> WaveletMatrix:
    return WaveletMatrix(
        row["n_ids"], row["zeros"], [np.frombuffer(p, np.uint8) for p in row["planes"]],
        [np.frombuffer(r, np.uint32) for r in row["ranks"]],
    )


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            ids = _matrix(row).ids().astype("<u4").tobytes()
            docs, sizes = np.frombuffer(row["doc_ids"], np.int64), np.frombuffer(row["doc_sizes"], np.int64)
            named = np.frombuffer(row["named"], np.uint8) == 1
            ends = np.cumsum(sizes)
            step = 1 << 12
            for a in range(0, len(docs), step):
                b = min(a + step, len(docs))
                yield pa.record_batch(
                    [
                        pa.array(docs[a:b], mask=~named[a:b]),
                        pa.array(row["before"] + ends[a:b] - sizes[a:b]),
                        pa.array(sizes[a:b]),
                        pa.array(
                            [ids[4 * (e - n) : 4 * e] for e, n in zip(ends[a:b].tolist(), sizes[a:b].tolist(), strict=True)],
                            pa.binary(),
                        ),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards of written files, and before each the number of ids of all shards before it.

    Files' sizes are added up in groups of a thousand files, then the groups'. There is a file for every 32 MB
    of text; the sums go to all tasks while there are at most FEW_FILES of them.
    """
    shards = spark.read.schema(SHAPE).parquet(path)
    sizes = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    sizes = stage(sizes.withColumn("group", F.floor(F.col("part") / 1000)), "sizes")
    within = Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = sizes.groupBy("group").agg(F.sum("n").alias("n"))
    groups = groups.select("group", F.coalesce(F.sum("n").over(across), F.lit(0)).alias("ahead"))
    parts = sizes.withColumn("inner", F.coalesce(F.sum("n").over(within), F.lit(0))).join(groups, "group")
    parts = parts.select("part", (F.col("ahead") + F.col("inner")).alias("base"))
    met = shards.join(F.broadcast(parts) if sizes.count() <= FEW_FILES else parts, "part")
    return met.withColumn("before", F.col("base") + F.col("within")).drop("base", "within")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` from written files.

    ``start`` counts the ids of all documents before; ``ids`` are little-endian unsigned 32-bit.
    """
    return read_shards(spark, path).mapInArrow(
        _decode, "doc_id long, start long, n_tokens long, ids binary"
    )


def _accessed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            matrix = _matrix(row)
            found = [matrix.access(p - row["before"]) for p in row["places"]]
            yield pa.record_batch([pa.array(row["places"], pa.int64()), pa.array(found, pa.int64())], names=["place", "token"])


def tokens_at(spark: SparkSession, path: str, places: DataFrame, place_col: str = "place") -> DataFrame:
    """``(place, token)``: the ids at the given places of all ids, once for each different place.

    Places that are null, or beyond the ids, have no row. A place finds its shard by an equi-join on
    stretches of SHARD_IDS places; only bit-planes of shards that are asked are read on, with QUESTIONS places
    at a time, and the ids come from rank alone.
    """
    shards = read_shards(spark, path)
    stretch = F.explode(F.sequence(
        F.floor(F.col("before") / SHARD_IDS), F.floor((F.col("before") + F.col("n_ids") - 1) / SHARD_IDS)
    ))
    spans = shards.where("n_ids > 0").select("part", "shard", "before", "n_ids", stretch.alias("stretch"))
    asked = places.select(F.col(place_col).cast("long").alias("place")).where("place >= 0").distinct()
    asked = asked.withColumn("stretch", F.floor(F.col("place") / SHARD_IDS))
    met = asked.join(spans, "stretch").where("place >= before and place < before + n_ids")
    part = F.floor((F.col("place") - F.col("before")) / QUESTIONS)
    rows = met.groupBy("part", "shard", part.alias("some")).agg(F.collect_list("place").alias("places"))
    return shards.join(rows, ["part", "shard"]).mapInArrow(_accessed, "place long, token long")


def _counted(tokens: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(tokens), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                matrix = _matrix(batch.slice(i, 1).to_pylist()[0])
                total += [matrix.count(t) for t in tokens]
        yield pa.record_batch([pa.array(tokens, pa.int64()), pa.array(total)], names=["token", "n"])

    return run


def count_occurrences(spark: SparkSession, path: str, tokens: list[int]) -> DataFrame:
    """``(token, n)``: how often each of some ids occurs, from two ranks a plane and shard."""
    wanted = sorted({int(t) for t in tokens if t is not None and t >= 0})
    shards = spark.read.schema(SHAPE).parquet(path)
    return shards.mapInArrow(_counted(wanted), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def _found(tokens: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                matrix = _matrix(row)
                docs, sizes = np.frombuffer(row["doc_ids"], np.int64), np.frombuffer(row["doc_sizes"], np.int64)
                named = np.frombuffer(row["named"], np.uint8) == 1
                ends = np.cumsum(sizes)
                for token in tokens:
                    for a in range(0, n := matrix.count(token), QUESTIONS):
                        at = np.array([matrix.find(token, k) for k in range(a, min(n, a + QUESTIONS))], np.int64)
                        doc = np.searchsorted(ends, at, "right")
                        yield pa.record_batch(
                            [
                                pa.array(np.full(len(at), token)), pa.array(row["before"] + at),
                                pa.array(docs[doc], mask=~named[doc]), pa.array(at - (ends - sizes)[doc]),
                            ],
                            names=["token", "place", "doc_id", "offset"],
                        )

    return run


def find_occurrences(spark: SparkSession, path: str, tokens: list[int]) -> DataFrame:
    """``(token, place, doc_id, offset)``: every occurrence of some ids, by select; no shard is decoded.

    ``place`` counts all ids before, ``offset`` those of the document.
    """
    wanted = sorted({int(t) for t in tokens if t is not None and t >= 0})
    shape = "token long, place long, doc_id long, offset long"
    return read_shards(spark, path).mapInArrow(_found(wanted), shape)
