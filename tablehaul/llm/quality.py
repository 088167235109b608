"""Quality of texts by a regularised quadratic discriminant."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.words import shingles, slices, span_hashes, word_bounds
from tablehaul.shared import stage

#: How far class covariances are drawn to the pooled one, and that to a multiple of the identity.
TO_POOLED, TO_SPHERE = 0.3, 0.05
#: So many words' worth of the average text is added to each text's statistics.
AVERAGE_WORDS = 8
_KINDS = np.zeros(256, np.int64)  # 0: other ASCII, 1 lower, 2 upper, 3 digit, 4 white, 5 stop, 6 high
_KINDS[97:123], _KINDS[65:91], _KINDS[48:58], _KINDS[128:] = 1, 2, 3, 6
_KINDS[[9, 10, 11, 12, 13, 32]] = 4
_KINDS[[ord(c) for c in ".,;:!?'\"()-"]] = 5
N_FEATURES = 22


def _share(part, whole):
    return np.sqrt(part / np.maximum(whole, 1))


def features(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Transformed statistics of each text: one row each, finite for any text."""
    n = len(at) - 1
    out = np.zeros((n, N_FEATURES))
    size = np.diff(at)
    of = np.repeat(np.arange(n), size)
    kinds = np.bincount(of * 7 + _KINDS[data], minlength=7 * n).reshape(n, 7)
    letters = kinds[:, 1] + kinds[:, 2] + kinds[:, 6]
    out[:, 0] = np.log1p(size)
    for i, part in enumerate((kinds[:, 0], kinds[:, 2], kinds[:, 3], kinds[:, 4], kinds[:, 5], kinds[:, 6])):
        out[:, 1 + i] = _share(part, size)
    out[:, 7] = _share(letters, size)
    seen = np.bincount(of * 256 + data, minlength=256 * n).reshape(n, 256)
    p = seen / np.maximum(size, 1)[:, None]
    out[:, 8] = -(p * np.log2(np.where(p > 0, p, 1))).sum(1)
    starts, ends, first = word_bounds(data, at)
    count = np.diff(first)
    length = (ends - starts).astype(float)
    owner = np.repeat(np.arange(n), count)
    mean = np.bincount(owner, length, n) / np.maximum(count, 1)
    square = np.bincount(owner, length**2, n) / np.maximum(count, 1)
    out[:, 9], out[:, 10] = np.log1p(mean), np.log1p(np.sqrt(np.maximum(0, square - mean**2)))
    out[:, 11] = _share(np.bincount(owner, length <= 3, n), count)
    out[:, 12] = _share(np.bincount(owner, length >= 15, n), count)
    last = data[ends - 1] if len(ends) else data[:0]
    out[:, 13] = _share(np.bincount(owner, _KINDS[last] == 5, n), count)
    out[:, 14] = _share(np.bincount(owner, _KINDS[last] == 0, n), count)
    capital = data[starts] if len(starts) else data[:0]
    out[:, 15] = _share(np.bincount(owner, _KINDS[capital] == 2, n), count)
    hashes = span_hashes(data, starts, ends)
    same = np.zeros(len(hashes))
    same[1:] = hashes[1:] == hashes[:-1]
    same[first[:-1][first[:-1] < len(same)]] = 0
    out[:, 16] = _share(np.bincount(owner, same, n), count)
    runs = shingles(hashes, first, 3)
    ends_of_lines = np.bincount(of, data == 10, n)
    for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
        if b > a:
            times = np.unique(hashes[a:b], return_counts=True)[1]
            out[i, 17] = np.log(len(times)) / np.log(b - a + 1)
            out[i, 18] = np.sqrt(times.max() / (b - a))
            out[i, 19] = len(runs[i]) / max(1, b - a - 2)
    out[:, 20] = np.log1p(count / (1 + ends_of_lines))
    out[:, 21] = np.log1p(count)
    return out


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, data, at in slices(batch.column("text")):
            values = features(data, at)
            ends = np.arange(0, values.size + 1, N_FEATURES, dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(values.reshape(-1)))
            yield pa.record_batch(
                [batch.column("id").slice(row, len(values)), lists], names=["id", "x"]
            )


def text_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, x)``: the statistics of each whole text. A null text counts as an empty one."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(_featured, f"id {texts.schema['id'].dataType.simpleString()}, x array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _standard(x: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Distances from the average; those of short texts, which vary by chance, are drawn in."""
    words = np.expm1(x[:, -1:])
    return (x - centre) / scale * (words / (words + AVERAGE_WORDS))


def _sums(centre: np.ndarray, scale: np.ndarray):
    """Counts, sums and products of each class, one partial sum for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            x, y = _matrix(batch.column("x")), batch.column("y").to_numpy(zero_copy_only=False)
            x = _standard(x, centre, scale) if centre is not None else x
            for label in (0, 1):
                own = np.hstack([np.ones((int((y == label).sum()), 1)), x[y == label]])
                total[label] = total.get(label, 0) + (own.T @ own).reshape(-1)
        for label, values in total.items():
            yield pa.record_batch(
                [
                    pa.array(np.full(len(values), label)),
                    pa.array(np.arange(len(values))),
                    pa.array(values),
                ],
                names=["y", "at", "value"],
            )

    return run


def _moments(known: DataFrame, centre=None, scale=None) -> np.ndarray:
    parts = known.mapInArrow(_sums(centre, scale), "y long, at long, value double")
    sums = np.zeros((2, (N_FEATURES + 1) ** 2))
    for y, at, value in parts.groupBy("y", "at").agg(F.sum("value")).collect():
        sums[y, at] = value
    return sums.reshape(2, N_FEATURES + 1, N_FEATURES + 1)


@dataclass(frozen=True)
class Discriminant:
    """Means and Cholesky factors of both classes in standardised units, and the log prior odds."""

    centre: np.ndarray
    scale: np.ndarray
    means: tuple[np.ndarray, np.ndarray]
    factors: tuple[np.ndarray, np.ndarray]
    odds: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        z = _standard(x, self.centre, self.scale)
        densities = []
        for mean, factor in zip(self.means, self.factors, strict=True):
            away = np.linalg.solve(factor, (z - mean).T)
            densities.append(-0.5 * (away**2).sum(0) - np.log(np.diag(factor)).sum())
        return densities[1] - densities[0] + self.odds


def fit(featured: DataFrame, labels: DataFrame) -> Discriminant | None:
    """Fits both classes to all rows of ``(id, x)`` that ``(id, y)`` labels 0 or 1.

    Averages first, then the classes. Sums are added up in the tasks; the driver gets one small matrix for each
    class. None if a class has fewer than two rows.
    """
    known = featured.join(labels.where("y in (0, 1) and id is not null"), "id").select(
        "x", F.col("y").cast("int").alias("y")
    )
    sums = _moments(known)
    if (sums[:, 0, 0] < 2).any():
        return None
    both = sums.sum(0)
    centre = both[0, 1:] / both[0, 0]
    scale = np.sqrt(np.maximum(np.diag(both)[1:] / both[0, 0] - centre**2, 1e-6))
    sums = _moments(known, centre, scale)
    means = [s[0, 1:] / s[0, 0] for s in sums]
    covariances = [s[1:, 1:] / s[0, 0] - np.outer(m, m) for s, m in zip(sums, means, strict=True)]
    weight = sums[:, 0, 0] / both[0, 0]
    pooled = weight[0] * covariances[0] + weight[1] * covariances[1]
    factors = []
    for own in covariances:
        drawn = (1 - TO_POOLED) * own + TO_POOLED * pooled
        sphere = np.trace(drawn) / N_FEATURES * np.eye(N_FEATURES)
        factors.append(np.linalg.cholesky((1 - TO_SPHERE) * drawn + TO_SPHERE * sphere + 1e-6 * np.eye(N_FEATURES)))
    return Discriminant(
        centre, scale, tuple(means), tuple(factors),
        float(np.log(weight[1] / weight[0])),
    )


def _scores(model: Discriminant | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if model is None:
                score = np.full(batch.num_rows, 0.5)
            elif batch.num_rows:
                odds = np.clip(model.log_odds(_matrix(batch.column("x"))), -500, 500)
                score = 1 / (1 + np.exp(-odds))
            else:
                score = np.zeros(0)
            yield pa.record_batch([batch.column("id"), pa.array(score)], names=["id", "score"])

    return run


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """``(id, score)`` of every document: how likely its text is of label 1, from 0 to 1.

    Only the text is used. ``labels`` has the rows to learn from: id and a 0 or 1; other values and
    null ids are left out, and a label given twice counts twice. If a class has fewer than
    two labelled documents, all scores are 0.5. A null text scores as an empty one. Every
    row gets its score, also with a null or repeated id; no rows give none.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    featured = stage(text_features(docs, id_col, text_col), "features")
    own = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y"))
    model = fit(featured, own)
    scored = featured.mapInArrow(_scores(model), f"id {kind}, score double")
    return scored.withColumnRenamed("id", id_col)
