"""Draws documents whose words and word pairs are like those of a target."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.grams import crc32s, joined, number_runs, numbered
from tablehaul.llm.words import MARKS, slices, word_bounds
from tablehaul.operators.ordering import number_in_order
from tablehaul.shared import stage

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def feature_buckets(
    data: np.ndarray, at: np.ndarray, longest: int, buckets: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bucket of every feature, text by text, where each text's begin, and how many words each has.

    Features are all runs of 1 to ``longest`` words of a text, joined by one space. Each different
    one is put together and hashed once.
    """
    data = _LOWER[data]
    starts, ends, first = word_bounds(data, at, MARKS)
    counts = np.diff(first)
    owner = np.repeat(np.arange(len(counts)), counts)
    number, member = number_runs(data, starts, ends)
    run, of_text, found = number, [], []
    words = member[:, None]
    for size in range(1, min(longest, len(number)) + 1):
        if size > 1:
            whole = owner[size - 1 :] == owner[: len(owner) - size + 1]
            one, run = numbered(np.where(whole, run[:-1] * max(1, len(member)) + number[size - 1 :], -1))
            places = one[:, None] + np.arange(size)  # a run is spelt by the words where it first stands
        else:
            whole, places = np.ones(len(run), bool), words
        held = np.zeros(len(places), bool)
        held[run[whole]] = True
        kept = np.flatnonzero(held)
        text, edge = joined(data, starts, ends, places[kept])
        bucket = np.zeros(len(places), np.int64)
        bucket[kept] = crc32s(text, edge[:-1], edge[1:]) % np.uint32(buckets)
        of_text.append(owner[: len(run)][whole])
        found.append(bucket[run[whole]])
    every = np.concatenate(found) if found else np.zeros(0, np.int64)
    place = np.concatenate(of_text) if of_text else np.zeros(0, np.int64)
    order = np.argsort(place, kind="stable")
    reach = np.concatenate([[0], np.cumsum(np.bincount(place, minlength=len(counts)))])
    return every[order], reach, counts


def _width(buckets: int) -> type:
    return np.uint16 if buckets <= 1 << 16 else np.uint32


def _featured(longest: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, at in slices(batch.column("text")):
                found, reach, words = feature_buckets(data, at, longest, buckets)
                raw, wide = found.astype(_width(buckets)).tobytes(), _width(buckets)().itemsize
                yield pa.record_batch(
                    [
                        batch.column("id").slice(row, len(words)),
                        pa.array(words),
                        pa.array(np.diff(reach)),
                        pa.array(
                            [raw[a * wide : b * wide] for a, b in zip(reach[:-1].tolist(), reach[1:].tolist(), strict=True)],
                            pa.binary(),
                        ),
                    ],
                    names=["id", "n_words", "n_features", "buckets"],
                )

    return run


def text_buckets(texts: DataFrame, longest: int, buckets: int) -> DataFrame:
    """``(id, n_words, n_features, buckets)`` of rows ``(id, text)``; the buckets as packed numbers."""
    kind = texts.schema["id"].dataType.simpleString()
    shape = f"id {kind}, n_words long, n_features long, buckets binary"
    return texts.mapInArrow(_featured(longest, buckets), shape)


def _counted(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for raw in batch.column("buckets"):
                total += np.bincount(np.frombuffer(raw.as_buffer(), _width(buckets)), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.record_batch([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    return run


def bucket_counts(bucketed: DataFrame, buckets: int) -> np.ndarray:
    """How many features each bucket holds; every task adds up its own, the driver gets one number a bucket."""
    parts = bucketed.select("buckets").mapInArrow(_counted(buckets), "bucket long, n long")
    total = np.zeros(buckets, np.int64)
    for bucket, n in parts.groupBy("bucket").agg(F.sum("n")).collect():
        total[bucket] = n
    return total


def bucket_gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Whole thousandths of the log ratio of each bucket's share in the target to its share here."""
    every, wanted = float(own.sum() + len(own)), float(target.sum() + len(target))
    ratio = ((target + 1.0) * every) / ((own + 1.0) * wanted)
    return np.floor(1000.0 * np.log(ratio)).astype(np.int64)


def _weighed(gains: np.ndarray):
    width = _width(len(gains))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(raw.as_buffer(), width) for raw in batch.column("buckets")]
            weights = [int(gains[f].sum()) // len(f) if len(f) else 0 for f in found]
            kept = [batch.column(c) for c in ("id", "n_words", "n_features")]
            yield pa.record_batch([*kept, pa.array(weights, pa.int64())], names=["id", "n_words", "n_features", "weight"])

    return run


def chance(row_id: Column, seed: int) -> Column:
    """A Gumbel number of the id in whole thousandths, the same wherever it is computed."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(row_id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    longest: int = 2,
    buckets: int = 10_000,
    min_words: int = 20,
    percent: int = 25,
    seed: int = 7,
) -> DataFrame:
    """``(id, n_words, n_features, weight, score, rank)`` of every document; drawn ones have a rank from 1.

    Words are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased.
    Features are the runs of 1 to ``longest`` words, in buckets by CRC-32. A document's weight is the
    floored mean of its buckets' gains, in thousandths: how much commoner the bucket is in the whole
    target than in all documents. A number drawn by the id is added, and of the N documents with
    ``min_words`` words the ``percent`` * N / 100 of highest score are drawn, ties to the smaller id.

    A null or empty text has no words, weight 0 and a score, and is never drawn unless ``min_words`` is
    0. Every row counts by itself, also with a null id (named ``null`` for its number, first among
    ties) or a repeated one. Without target texts all gains come from the documents alone. An empty table
    gives an empty one. Columns of ``docs`` other than the two named are not read.

    Documents are read once; their bucket numbers, two bytes a feature, are staged. The driver gets two
    numbers a bucket. Rows are ranked over ranges of the score, never in one task.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    bucketed = stage(text_buckets(texts, longest, buckets), "buckets")
    wanted = text_buckets(target.select(F.lit(0).alias("id"), F.col(target_col).alias("text")), longest, buckets)
    gains = bucket_gains(bucket_counts(bucketed, buckets), bucket_counts(wanted, buckets))
    kind = docs.schema[id_col].dataType.simpleString()
    weighed = bucketed.mapInArrow(_weighed(gains), f"id {kind}, n_words long, n_features long, weight long")
    scored = weighed.withColumn("score", F.col("weight") + chance(F.col("id"), seed))
    long_enough = F.col("n_words") >= min_words
    ranked = number_in_order(scored.where(long_enough), [F.col("score").desc(), F.col("id").asc()], "rank", 1)
    drawn = percent * ranked.count() // 100
    every = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).unionByName(
        scored.where(~long_enough).withColumn("rank", F.lit(None).cast("long"))
    )
    return every.select(F.col("id").alias(id_col), "n_words", "n_features", "weight", "score", "rank")
