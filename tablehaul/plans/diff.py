"""Rows that differ between two tables that should be the same.

Both sides are read once and reduced to sums of row hashes, which do not depend on the order of rows: a tree
of ranges of the first key column, and of cells of the key's hash inside them. Where the sums of
a cell agree its rows are never looked at again. Cells that differ are cut finer, from reads of their ranges
only, until few rows are left or a cell is a key, and only these are brought together by key.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablehaul.functions.frames import small_frame
from tablehaul.functions.keys import PRIMARY, Constraint
from tablehaul.functions.names import columns as named
from tablehaul.functions.names import quoted
from tablehaul.operators.brackets import Digit, column_digits, quantiles, range_of
from tablehaul.plans.compare import _in_threads, _partners
from tablehaul.shared import stage, unstage
from tablehaul.sources.tables import TableSet

MISSING, EXTRA, CHANGED = "missing", "extra", "changed"
#: Ranges of the first key column, and cells that are summed at once on each side.
RANGES, CELLS = 64, 1 << 16
#: Rows of differing cells that are brought together without cutting the cells finer.
FEW_ROWS = 1_000_000
#: Bits of a cell that holds one key, and cells that are sent to all tasks to find their rows.
KEY_BITS, SENT_CELLS = 60, 1_000_000

_log = logging.getLogger(__name__)

_NESTED = (T.ArrayType, T.MapType, T.StructType)
_LITERAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.StringType, T.DecimalType)


@dataclass(frozen=True)
class Sides:
    """Two tables with the same columns and types, and how to cut them."""

    ours: DataFrame
    theirs: DataFrame
    keys: tuple[str, ...]
    digit: Digit
    edges: tuple[float, ...]

    def both(self) -> tuple[DataFrame, DataFrame]:
        return self.ours, self.theirs


def _aligned(ours: DataFrame, theirs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both with the first one's column names and, for each, the type that holds both sides' values."""
    found = {c.lower(): c for c in theirs.columns}
    if len(found) < len(theirs.columns) or len({c.lower() for c in ours.columns}) < len(ours.columns):
        raise ValueError("column names differ only in case")
    alone = {c.lower() for c in ours.columns} ^ found.keys()
    if alone:
        raise ValueError(f"columns of one side only: {sorted(alone)}")
    theirs = theirs.select(*[F.col(quoted(found[c.lower()])).alias(c) for c in ours.columns])
    kinds = {f.name: f.dataType for f in ours.unionAll(theirs).schema.fields}

    def typed(df: DataFrame) -> DataFrame:
        return df.select(
            *[
                F.col(quoted(f.name)) if f.dataType == kinds[f.name] else F.col(quoted(f.name)).cast(kinds[f.name]).alias(f.name)
                for f in df.schema.fields
            ]
        )

    return typed(ours), typed(theirs)


def _hashable(field: T.StructField) -> list[Column]:
    """The value, and whether it is NULL, which a hash of several values passes over."""
    value = F.col(quoted(field.name))
    if isinstance(field.dataType, T.MapType):
        value = F.array_sort(F.map_entries(value))
    if isinstance(field.dataType, _NESTED):
        value = F.to_json(F.struct(value), {"ignoreNullFields": "false"})
    return [value, value.isNull()]


def _hash(df: DataFrame, names: Sequence[str], seed: int) -> Column:
    kinds = {f.name: f for f in df.schema.fields}
    parts = [p for n in names for p in _hashable(kinds[n])]
    return F.xxhash64(F.lit(seed), *parts)


def _marked(sides: Sides, df: DataFrame) -> DataFrame:
    """The rows with ``__range`` and ``__key``, a hash of their key."""
    coded = df.withColumns({"__code": sides.digit.code, "__key": _hash(df, sides.keys, 0)})
    return coded.withColumn("__range", range_of(F.col("__code"), sides.edges)).drop("__code")


def _halves(value: Column) -> list[Column]:
    """Two numbers whose sums over two billion rows stay within 64 bits."""
    return [F.shiftrightunsigned(value, 32), value.bitwiseAND(F.lit((1 << 32) - 1))]


def content_sums() -> list[Column]:
    """Aggregates over rows of :func:`hashed` that are equal for equal rows in any order: 128 bits, added up."""
    return [F.sum(h) for seed in (1, 2) for h in _halves(F.col(f"__h{seed}"))]


def hashed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The rows with ``__h1`` and ``__h2``, two hashes of the named columns."""
    return df.withColumns({f"__h{seed}": _hash(df, names, seed) for seed in (1, 2)})


def _cells(sides: Sides, read: tuple[DataFrame, DataFrame], bits: int) -> DataFrame:
    """``(range, cell, rows, lo, hi, nulls)`` of the cells whose sums differ, staged.

    Ours are added and theirs taken away. Cells of one key are summed behind a shuffle of their rows' hashes.
    """
    cell = F.col("__key").bitwiseAND(F.lit((1 << bits) - 1))
    first = F.col(quoted(sides.keys[0]))

    def signed(df: DataFrame, sign: int) -> DataFrame:
        return hashed(df, sides.ours.columns).select(
            F.col("__range").alias("range"), cell.alias("cell"), first.alias("first"),
            F.lit(sign).cast("bigint").alias("sign"), "__h1", "__h2",
        )

    both = signed(read[0], 1).unionAll(signed(read[1], -1))
    if bits == KEY_BITS:
        both = both.repartition("range", "cell")
    halves = [F.col("sign") * h for seed in (1, 2) for h in _halves(F.col(f"__h{seed}"))]
    sums = [F.sum(value).alias(f"s{i}") for i, value in enumerate([F.col("sign"), *halves])]
    met = both.groupBy("range", "cell").agg(
        *sums, F.count(F.lit(1)).alias("rows"), F.min("first").alias("lo"), F.max("first").alias("hi"),
        F.count_if(F.col("first").isNull()).alias("nulls"),
    )
    differs = reduce(Column.__or__, [F.col(f"s{i}") != 0 for i in range(len(sums))])
    return stage(met.where(differs).select("range", "cell", "rows", "lo", "hi", "nulls"), "cells")


def _of_ranges(sides: Sides, cells: DataFrame) -> Column:
    """The rows of the ranges that hold differing cells, in words that a scan can use to skip files.

    Neighbours are named together, which keeps the condition short.
    """
    kind = sides.ours.schema[sides.keys[0]].dataType
    column = F.col(quoted(sides.keys[0]))
    held = cells.groupBy("range").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("nulls").alias("nulls"))
    if not isinstance(kind, _LITERAL):
        return range_of(sides.digit.code, sides.edges).isin([r.range for r in held.select("range").collect()])

    runs: list[dict] = []
    for r in sorted(held.collect(), key=lambda r: r.range):
        if runs and runs[-1]["range"] == r.range - 1:
            last = runs[-1]
            lo, hi = r.lo if last["lo"] is None else last["lo"], last["hi"] if r.hi is None else r.hi
            runs[-1] = {"range": r.range, "lo": lo, "hi": hi, "nulls": last["nulls"] + r.nulls}
        else:
            runs.append(r.asDict())

    def within(r: dict) -> Column:
        lo, hi = r["lo"], r["hi"]
        inside = F.lit(False) if lo is None else (column >= F.lit(lo).cast(kind)) & (column <= F.lit(hi).cast(kind))
        return inside | column.isNull() if r["nulls"] else inside

    return reduce(Column.__or__, [within(r) for r in runs])


def _suspects(sides: Sides, cells: DataFrame, number: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """Both sides' rows of the differing cells, so many; no range without one is read."""
    inside = _of_ranges(sides, cells)
    by = ["__cell"] if bits == KEY_BITS else ["__range", "__cell"]
    wanted = cells.select(F.col("range").alias("__range"), F.col("cell").alias("__cell")).select(*by)
    wanted = F.broadcast(wanted) if number <= SENT_CELLS else wanted
    cell = F.col("__key").bitwiseAND(F.lit((1 << bits) - 1))

    def of(df: DataFrame) -> DataFrame:
        marked = _marked(sides, df.where(inside)).withColumn("__cell", cell)
        return marked.join(wanted, by, "left_semi").drop("__cell")

    return of(sides.ours), of(sides.theirs)


def _by_key(sides: Sides, read: tuple[DataFrame, DataFrame]) -> DataFrame:
    """One row for each key that is not the same on both sides."""
    names = sides.ours.columns
    values = [n for n in names if n not in sides.keys]
    ours, theirs = (hashed(df, names) for df in read)
    both = ours.withColumn("__side", F.lit(0)).unionByName(theirs.withColumn("__side", F.lit(1)))
    aggregates = []
    for side, name in enumerate(("o", "t")):
        own = F.col("__side") == side
        halves = [h for seed in (1, 2) for h in _halves(F.col(f"__h{seed}"))]
        held = F.struct(F.lit(1), *[F.col(quoted(n)).alias(f"v{i}") for i, n in enumerate(values)])
        aggregates += [
            F.count_if(own).alias(f"__{name}_rows"),
            F.struct(*[F.sum(F.when(own, h)) for h in halves]).alias(f"__{name}"),
            F.any_value(F.when(own, held), True).alias(f"__{name}_values"),
        ]
    met = both.groupBy(*named(sides.keys)).agg(*aggregates)
    met = met.where((F.col("__o_rows") != F.col("__t_rows")) | ~F.col("__o").eqNullSafe(F.col("__t")))
    change = F.when(F.col("__t_rows") == 0, MISSING).when(F.col("__o_rows") == 0, EXTRA).otherwise(CHANGED)
    differs = []
    kinds = {f.name: f.dataType for f in sides.ours.schema.fields}
    for i, n in enumerate(values):
        one, two = F.col(f"__o_values.v{i}"), F.col(f"__t_values.v{i}")
        if isinstance(kinds[n], _NESTED):
            one, two = (F.to_json(F.struct(v), {"ignoreNullFields": "false"}) for v in (one, two))
        differs.append(F.when(~one.eqNullSafe(two), F.lit(n)))
    single = (F.col("__o_rows") == 1) & (F.col("__t_rows") == 1)
    which = F.array_compact(F.array(*differs)) if differs else F.array().cast("array<string>")
    return met.select(
        *named(sides.keys), change.alias("change"), F.col("__o_rows").alias("source_rows"),
        F.col("__t_rows").alias("target_rows"), F.when(single, which).alias("columns"),
    )


def diff_rows(
    ours: DataFrame, theirs: DataFrame, keys: Sequence[str] = (), few_rows: int = FEW_ROWS, cells: int = CELLS
) -> DataFrame:
    """``(keys…, change, source_rows, target_rows, columns)`` for every key whose rows are not the same.

    ``change`` is ``missing`` where the target has no row of the key, ``extra`` where only it has, else
    ``changed``. ``columns`` names the columns that differ if the key has one row on each side. Without keys whole
    rows are keys, and repeated rows differ by their number. A key may be NULL or repeated; its rows
    are compared as a bag. Columns are matched without regard to case and compared in the type that holds
    both sides' values; a column of one side only is an error, as is a key that is not there. Equal
    rows are told by 128 bits of hash.

    Both sides are read once whole, and shuffle ``cells`` sums a task at most. After that only ranges that
    hold a difference are read, which Parquet and JDBC scans are told as bounds on the first key. If
    differences lie in most cells and more than ``few_rows`` rows with them, the hashes of these rows are shuffled once,
    to find the keys that differ; of other keys no values are shuffled. The sides must stay the same meanwhile.
    """
    ours, theirs = _aligned(ours, theirs)
    spelled = {c.lower(): c for c in ours.columns}
    absent = [k for k in keys if k.lower() not in spelled]
    if absent:
        raise ValueError(f"no key columns {absent}")
    keys = tuple(spelled[k.lower()] for k in keys) or tuple(ours.columns)
    digit = column_digits(keys[0], ours.schema[keys[0]].dataType)[0]
    edges = tuple(sorted(set(quantiles(ours, digit.code, RANGES)[1:-1])))
    sides = Sides(ours, theirs, keys, digit, edges)
    bits = max(0, (cells // (len(edges) + 1)).bit_length() - 1)
    differing = _cells(sides, tuple(_marked(sides, df) for df in sides.both()), bits)
    left, number = _size(differing)
    before = None
    while left > few_rows and bits < KEY_BITS:
        gained = (cells // number).bit_length() - 1
        parted = before is None or left <= before // 2
        finer = min(KEY_BITS, bits + gained) if gained > 0 and parted else KEY_BITS
        next_cells = _cells(sides, _suspects(sides, differing, number, bits), finer)
        unstage(differing)
        differing, bits, before = next_cells, finer, left
        left, number = _size(differing)
    if not left:
        return _by_key(sides, tuple(_marked(sides, df).limit(0) for df in sides.both()))
    return _by_key(sides, _suspects(sides, differing, number, bits))


def _size(cells: DataFrame) -> tuple[int, int]:
    found = cells.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.count(F.lit(1))).first()
    return found[0], found[1]


def primary_keys(constraints: Sequence[Constraint]) -> dict[str, tuple[str, ...]]:
    """Each table's primary key, by lower-case table name."""
    return {c.table.lower(): tuple(c.columns) for c in constraints if c.kind == PRIMARY}


def compare_values(
    source: TableSet, target: TableSet, keys: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """``(table_name, missing, extra, changed, is_success)`` for every table that both sides have.

    ``keys`` names the key columns of a table; otherwise its primary key counts, and without one whole rows do.
    ``missing``, ``extra`` and ``changed`` are keys, as in :func:`diff_rows`. A table that cannot be
    compared, because its columns differ, has NULL counts and ``N``.
    """
    known = primary_keys(source.constraints()) | {t.lower(): tuple(k) for t, k in (keys or {}).items()}

    def compared(pair: tuple[str, str]) -> tuple:
        ours, theirs = pair
        try:
            found = diff_rows(source.read(ours), target.read(theirs), known.get(ours.lower(), ()))
        except ValueError as error:
            _log.error("%s cannot be compared: %s", ours, error)
            return ours, None, None, None, "N"
        counts = dict(found.groupBy("change").count().collect())
        sizes = [counts.get(c, 0) for c in (MISSING, EXTRA, CHANGED)]
        return ours, *sizes, "N" if any(sizes) else "Y"

    pairs = sorted(_partners(source.table_names(), target.table_names()).items())
    lines = _in_threads(source.spark, compared, pairs)
    return small_frame(
        source.spark, lines, "table_name string, missing bigint, extra bigint, changed bigint, is_success string"
    )
