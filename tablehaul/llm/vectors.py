"""Near-duplicate vectors by a join of rotated subspaces."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.graph import components, least_labels
from tablehaul.shared import stage

#: Subspaces; rows of a tile; rows of a tile that are compared at a time.
BLOCKS, TILE, STRIP = 4, 2048, 256
#: Added to squared distances against rounding. The cosine itself is compared exactly.
ROUNDING = 1e-9


def rotation(size: int) -> np.ndarray:
    """A random rotation, the same for every vector of this size."""
    made = np.random.default_rng(size).standard_normal((size, size))
    factor, corner = np.linalg.qr(made)
    return factor * np.sign(np.diag(corner))


def block_edges(size: int, blocks: int) -> list[int]:
    return [size * b // blocks for b in range(blocks + 1)]


def _rotated(cosine: float, blocks: int):
    """Unit vectors, rotated, and for each block the slab of its first coordinate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            out: list[tuple] = []
            groups = zip(*(batch.column(c).to_pylist() for c in ("id", "label")), batch.column("vector"), strict=True)
            for name, label, vector in groups:
                values = vector.values
                if name is None or label is None or values is None or values.null_count:
                    continue
                unit = values.to_numpy(zero_copy_only=False).astype(np.float64)
                top = np.abs(unit).max() if len(unit) else 0.0
                if not np.isfinite(top) or top == 0:
                    continue
                unit = unit / top
                unit /= np.sqrt(unit @ unit)
                size = len(unit)
                if size not in turns:
                    turns[size] = rotation(size)
                turned = unit @ turns[size]
                edges = block_edges(size, blocks)
                slabs = [
                    int(np.floor(turned[a] / np.sqrt(_budget(cosine, size, b - a)))) if b > a else None
                    for a, b in zip(edges[:-1], edges[1:], strict=True)
                ]
                out.append((name, label, size, turned.tobytes(), slabs))
            kinds = [pa.int64(), batch.column("label").type, pa.int32(), pa.binary(), pa.list_(pa.int32())]
            names = ["id", "label", "size", "v", "slabs"]
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return run


def _budget(cosine: float, size: int, width: int) -> float:
    """The share that a block of this width has of the squared distance of two unit vectors."""
    return (2 - 2 * cosine) * width / size + ROUNDING


def _compare(cosine: float, blocks: int):
    """Links between the rows of two tiles, or of one with itself."""

    def run(table: pa.Table) -> pa.Table:
        block, size = table["block"][0].as_py(), table["size"][0].as_py()
        edges = block_edges(size, blocks)
        table = table.sort_by([("second", "ascending"), ("id", "ascending")])
        ids = table["id"].to_numpy()
        split = int(np.count_nonzero(~table["second"].to_numpy()))
        flat = b"".join(table["v"].to_pylist())
        rows = np.frombuffer(flat, np.float64).reshape(len(ids), size)
        alone = not table["next"][0].as_py() and table["i"][0].as_py() == table["j"][0].as_py()
        ones, twos = (0, split), (0, split) if alone else (split, len(ids))
        budgets = [_budget(cosine, size, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        part = slice(edges[block], edges[block + 1])
        right = rows[twos[0] : twos[1], part]
        norms = (right**2).sum(1)
        found_i, found_j = [], []
        for at in range(ones[0], ones[1], STRIP):
            left = rows[at : min(at + STRIP, ones[1]), part]
            away = (left**2).sum(1)[:, None] + norms - 2 * (left @ right.T)
            i, j = np.nonzero(away <= budgets[block] + ROUNDING)
            i, j = i + at, j + twos[0]
            if alone:
                i, j = i[i < j], j[i < j]
            for k in range(0, len(i), 1 << 14):
                a, b = i[k : k + (1 << 14)], j[k : k + (1 << 14)]
                close = np.einsum("ij,ij->i", rows[a], rows[b]) >= cosine
                close &= ids[a] != ids[b]
                a, b = a[close], b[close]
                gaps = (rows[a] - rows[b]) ** 2
                own = np.ones(len(a), bool)
                for c in range(block + 1):
                    if edges[c] == edges[c + 1]:
                        continue
                    inside = gaps[:, edges[c] : edges[c + 1]].sum(1) <= budgets[c]
                    own &= inside if c == block else ~inside
                found_i.append(a[own])
                found_j.append(b[own])
        i = np.concatenate(found_i) if found_i else np.zeros(0, np.int64)
        j = np.concatenate(found_j) if found_j else np.zeros(0, np.int64)
        times = np.bincount(i, minlength=len(ids)) + np.bincount(j, minlength=len(ids))
        root = least_labels(len(ids), i, j)
        hit = np.flatnonzero(times)
        return pa.table({"id": ids[hit], "n": times[hit], "root": ids[root[hit]]})

    return run


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    cosine: float = 0.93,
    blocks: int = BLOCKS,
    tile: int = TILE,
) -> DataFrame:
    """Links between vectors of equal label with at least this cosine: id, n_links, component_id, kept.

    Unit vectors are rotated and cut into ``blocks`` subspaces. If two are within the squared
    distance that the cosine allows, then in at least one subspace they are within its share.
    Each subspace is cut into slabs as wide as that distance, so partners lie in the same slab
    or in the next. Slabs are dealt into tiles of about ``tile`` rows by a hash, and every pair of
    tiles that may hold partners is compared by a task of its own, so that a hot label or a
    large group of copies spreads over many tasks. A pair that several subspaces find is counted
    in the first. Tasks return the number of links of each row and one edge for it,
    never the pairs.

    Vectors that are null, zero, or hold null or non-finite components, and rows with a null label
    or id, have no links; vectors of different lengths are never linked. Every row is
    returned, also with a null id (null component, kept); rows that share an id are one node,
    not linked with itself, and their links add up. No rows give none.
    """
    named = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    kind = named.schema["label"].dataType.simpleString()
    units = stage(
        named.mapInArrow(
            _rotated(cosine, blocks), f"id long, label {kind}, size int, v binary, slabs array<int>"
        ),
        "vectors",
    )
    group = ["label", "size", "block", "slab"]
    placed = units.select(
        "id", "label", "size", F.xxhash64("id").alias("h"), F.posexplode("slabs").alias("block", "slab")
    ).where("slab is not null")
    tiles = placed.groupBy(*group).agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    tiles = stage(tiles, "tiles")
    around = tiles.withColumnRenamed("tiles", "n")
    known = tiles
    for side, shift in (("before", 1), ("after", -1)):
        other = around.withColumn("slab", F.col("slab") + shift).withColumnRenamed("n", side)
        known = known.join(other, group, "left")
    own = F.expr("cast(pmod(h, tiles) as int)")

    def pairs(count, make):
        return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), make)).otherwise(
            F.array().cast("array<struct<slab:int,i:int,next:boolean,j:int,second:boolean>>")
        )

    def unit(slab, i, following: bool, j, second):
        return F.struct(
            slab.alias("slab"), i.alias("i"), F.lit(following).alias("next"), j.alias("j"),
            second.alias("second"),
        )

    within = pairs(
        F.col("tiles"),
        lambda k: unit(F.col("slab"), F.least(own, k), False, F.greatest(own, k), own > k),
    )
    ahead = pairs(
        F.coalesce("after", F.lit(0)), lambda k: unit(F.col("slab"), own, True, k, F.lit(False))
    )
    behind = pairs(
        F.coalesce("before", F.lit(0)), lambda k: unit(F.col("slab") - 1, k, True, own, F.lit(True))
    )
    dealt = placed.join(known, group).select(
        "id", "label", "size", "block", F.explode(F.concat(within, ahead, behind)).alias("u")
    )
    dealt = dealt.select("id", "label", "size", "block", "u.*").join(
        units.select("id", "label", "size", "v"), ["id", "label", "size"]
    )
    work = dealt.groupBy("label", "size", "block", "slab", "i", "next", "j")
    found = stage(work.applyInArrow(_compare(cosine, blocks), "id long, n long, root long"), "links")
    links = found.groupBy("id").agg(F.sum("n").alias("n_links"))
    label = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"))
    return (
        rows.join(links, "id", "left").join(label, "id", "left")
        .select(
            F.col("id").alias(id_col),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("component_id") == F.col(id_col), F.lit(True)))
    )
