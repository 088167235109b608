"""Near-duplicate texts by circulant MinHash, bands and exact set similarity."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.graph import components, least_labels
from tablehaul.llm.words import mix, slices, text_shingles
from tablehaul.shared import stage

#: At 85 in 100 similarity a pair misses all 24 bands of 6 with a chance of 0.00001.
BANDS, ROWS = 24, 6
#: Rows of a tile, and elements that are counted at a time.
TILE, COLUMNS = 512, 4096
#: Parts into which the rows of a class of equal sets are dealt.
SALTS = 16
_FIRST, _SECOND = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)


def signature(sets: list[np.ndarray], lanes: int) -> np.ndarray:
    """Circulant MinHash of non-empty sets: one row each, ``lanes`` coordinates.

    The first permutation scatters the elements over 2**32 places. Coordinate k is the least
    value of the second permutation, shifted circularly by k, over those places. The second one
    begins with a product, so a shift by k is one addition after it.
    """
    places = (mix(np.concatenate(sets)) >> np.uint64(32)).astype(np.uint32) * _FIRST
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), lanes), np.uint32)
    for k in range(lanes):
        shifted = places + np.uint32((k * int(_FIRST)) % 2**32)
        shifted ^= shifted >> np.uint32(15)
        shifted *= _SECOND
        out[:, k] = np.minimum.reduceat(shifted, at)
    return out


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.zeros((len(signatures), bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64)
    for r in range(rows):
        lane = signatures[:, r : bands * rows : rows].astype(np.uint64)
        keys = mix(keys * np.uint64(0xD6E8FEB86659FD93) + lane)
    return keys


def _profiles(size: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, at in slices(batch.column("text")):
                sets = text_shingles(data, at, size)
                full = np.array([len(s) > 0 for s in sets])
                keys = np.zeros((len(sets), bands), np.uint64)
                print_a, print_b = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
                if full.any():
                    held = [s for s in sets if len(s)]
                    keys[full] = band_keys(signature(held, bands * rows), bands, rows)
                    starts = np.concatenate([[0], np.cumsum([len(s) for s in held])[:-1]])
                    elements = np.concatenate(held)
                    print_a[full] = np.add.reduceat(mix(elements + np.uint64(11)), starts)
                    print_b[full] = np.add.reduceat(mix(elements ^ np.uint64(2**63 + 7)), starts)
                ends = np.cumsum(np.where(full, bands, 0)).astype(np.int32)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], ends]).astype(np.int32)),
                    pa.array(keys[full].reshape(-1).view(np.int64)),
                )
                yield pa.record_batch(
                    [
                        batch.column("id").slice(row, len(sets)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(print_a.view(np.int64)),
                        pa.array(print_b.view(np.int64)),
                        lists,
                    ],
                    names=["id", "n", "p", "q", "bands"],
                )

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, at in slices(batch.column("text")):
                sets = text_shingles(data, at, size)
                yield pa.record_batch(
                    [
                        batch.column("id").slice(row, len(sets)),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    names=["id", "elements"],
                )

    return run


def _similar(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                one = np.frombuffer(x.as_buffer(), np.uint64)
                two = np.frombuffer(y.as_buffer(), np.uint64)
                few, many = (one, two) if len(one) < len(two) else (two, one)
                place = np.minimum(np.searchsorted(many, few), len(many) - 1)
                both = int(np.count_nonzero(many[place] == few))
                linked.append(100 * both >= percent * (len(one) + len(two) - both))
            found = pa.record_batch([batch.column("a"), batch.column("b")], names=["a", "b"])
            yield found.filter(pa.array(linked, pa.bool_()))

    return run


def _shared(rows: list[np.ndarray]) -> np.ndarray:
    """How many elements every two of the sets share."""
    elements, place = np.unique(np.concatenate(rows), return_inverse=True)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    times = np.bincount(place, minlength=len(elements))
    column = np.cumsum(times > 1) - 1
    owner, column = owner[times[place] > 1], column[place[times[place] > 1]]
    total = np.zeros((len(rows), len(rows)), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    edges = np.searchsorted(column, np.arange(0, column.max(initial=-1) + 1 + COLUMNS, COLUMNS))
    for k, (i, j) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        part = np.zeros((len(rows), COLUMNS), np.float32)
        part[owner[i:j], column[i:j] - k * COLUMNS] = 1
        total += part @ part.T
    return total


def _compared(percent: int):
    """Links between the rows of a tile that are outside a bucket's main component and all others.

    Of these links as many are returned as it takes to connect what they connect.
    """

    def run(table: pa.Table) -> pa.Table:
        ids, label = table["id"].to_numpy(), table["label"].to_numpy()
        ids, first = np.unique(ids, return_index=True)
        label = label[first]
        held = table["elements"].to_pylist()
        rows = [np.frombuffer(held[i], np.uint64) for i in first.tolist()]
        size = np.array([len(r) for r in rows], np.float32)
        both = _shared(rows)
        near = 100 * both >= percent * (size[:, None] + size - both)
        near &= label[:, None] != label
        i, j = np.nonzero(np.triu(near, 1))
        root = least_labels(len(ids), i, j)
        moved = np.flatnonzero(root != np.arange(len(ids)))
        return pa.table({"a": ids[root[moved]], "b": ids[moved]})

    return run


def _tiled(spread: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between members of a bucket in different components, found tile by tile."""
    outside = F.col("label") != F.col("main")
    counts = stage(spread.groupBy("bucket").agg(
        F.ceil(F.sum(outside.cast("int")) / TILE).cast("int").alias("outsiders"),
        F.ceil(F.count("*") / TILE).cast("int").alias("tiles"),
    ), "counts")
    own = F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int")
    mine = F.pmod(F.xxhash64("id", F.lit(1)), F.col("outsiders")).cast("int")
    every = F.transform(
        F.sequence(F.lit(0), F.col("outsiders") - 1), lambda i: F.struct(i.alias("i"), own.alias("j"))
    )
    more = F.transform(
        F.sequence(F.lit(0), F.col("tiles") - 1), lambda j: F.struct(mine.alias("i"), j.alias("j"))
    )
    dealt = spread.join(counts, "bucket").select(
        "bucket", "id", "label",
        F.explode(F.when(outside, F.array_union(every, more)).otherwise(every)).alias("u"),
    )
    work = dealt.select("bucket", "id", "label", "u.*").join(sets, "id")
    return work.groupBy("bucket", "i", "j").applyInArrow(_compared(percent), "a long, b long")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """Each text's group of near-duplicates: id, n_shingles, component_id, kept.

    Texts are words between ASCII white space, A-Z lower-cased; a set holds the distinct runs of
    ``shingle`` words, or all words of a shorter text as one. Sets are compared by 64-bit hashes
    of their elements, all of them, and linked if 100 * shared >= percent * together.

    Equal sets become one class before bands are made. In each bucket all classes are first
    compared with the one that shares most buckets with others. Then those still outside a
    bucket's largest component are compared with all others in it, in tiles that tasks take one by
    one, so that no candidate pair goes unseen, a group of n near copies costs about n
    comparisons, and no task returns pairs, but only enough links to connect them.

    A null or blank text has an empty set and is linked with nothing. A row with a null id is
    returned with a null component and kept. Rows with equal ids are one node. Other columns
    do not matter; an empty table gives an empty one.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    shape = "id long, n long, p long, q long, bands array<long>"
    profiles = stage(texts.mapInArrow(_profiles(shingle, bands, rows), shape), "profiles")
    named = profiles.where("id is not null and n > 0")
    alike = ["n", "p", "q"]
    classes = named.groupBy(*alike).agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    copied = classes.where("copies > 1").select(
        *alike, "rep", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    )
    salted = named.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    rep = F.coalesce("rep", "id")
    member = stage(
        salted.join(copied, [*alike, "salt"], "left").select(
            "id", "n", rep.alias("rep"), F.when(F.col("id") == rep, F.col("bands")).alias("bands")
        ),
        "members",
    )
    entries = member.where("id = rep").select(
        F.explode("bands").alias("bucket"), "id", "n"
    ).distinct()
    sizes = entries.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    buckets = stage(entries.join(sizes, "bucket"), "buckets")
    score = buckets.groupBy("id").agg(F.sum("size").alias("score"))
    best = F.struct("score", -F.col("id"))
    heads = buckets.join(score, "id").groupBy("bucket").agg(
        F.max_by(F.struct("id", "n"), best).alias("head")
    )

    def close(x: str, y: str):
        return 100 * F.least(x, y) >= percent * F.greatest(x, y)

    to_head = buckets.join(heads, "bucket").where(
        (F.col("id") != F.col("head.id")) & close("n", "head.n")
    )
    pairs = to_head.select(
        F.least("id", "head.id").alias("a"), F.greatest("id", "head.id").alias("b")
    ).distinct()
    shared = buckets.select("id").distinct()
    sets = stage(
        texts.join(shared, "id", "left_semi").mapInArrow(_sets(shingle), "id long, elements binary"),
        "sets",
    )
    x = sets.select(F.col("id").alias("a"), F.col("elements").alias("x"))
    y = sets.select(F.col("id").alias("b"), F.col("elements").alias("y"))
    met = pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y")
    links = stage(met.mapInArrow(_similar(percent), "a long, b long").distinct(), "links")
    label = components(links)
    spread = buckets.where("size > 2").join(label, "id", "left").select(
        "bucket", "id", F.coalesce("component", "id").alias("label")
    )
    shares = spread.groupBy("bucket", "label").agg(F.count("*").alias("share"))
    split = shares.groupBy("bucket").agg(
        F.count("*").alias("labels"), F.max_by("label", F.struct("share", -F.col("label"))).alias("main")
    ).where("labels > 1").drop("labels")
    spread = stage(spread.join(split, "bucket"), "spread")
    more = _tiled(spread, sets, percent)
    label = stage(components(links.unionByName(more)), "labels")
    found = member.join(label.withColumnRenamed("id", "rep"), "rep", "left").select(
        "id", F.coalesce("component", "rep").alias("component_id")
    ).groupBy("id").agg(F.min("component_id").alias("component_id"))
    return (
        profiles.join(found, "id", "left")
        .select(
            F.col("id").alias(id_col),
            F.col("n").alias("n_shingles"),
            F.coalesce("component_id", "id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("component_id") == F.col(id_col), F.lit(True)))
    )
