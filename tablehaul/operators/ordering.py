"""Ranks and running positions over tables of any size.

A window without PARTITION BY would put the whole table into one task. Here rows or keys are put
into ranges along their order first, as many as their number asks for. The driver adds up the
ranges' row counts, one number for about a million keys, and only positions inside a range need
a window.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablehaul.functions.frames import small_frame
from tablehaul.functions.names import columns as named
from tablehaul.functions.names import quoted
from tablehaul.shared import stage

ROWS_PER_BUCKET = 1_000_000


def sortable(kind: T.DataType, value: Column) -> Column:
    """The key in a form with the same order whose values survive the way to the driver and back.

    Times would be moved by the local time zone on the way, so they go as microseconds.
    """
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, T.TimestampNTZType):
        days = F.unix_date(value.cast("date")).cast("bigint") * 86_400
        seconds = days + F.hour(value) * 3600 + F.minute(value) * 60
        within = F.extract(F.lit("SECOND"), value) * 1_000_000
        return seconds * 1_000_000 + within.cast("bigint")
    return F.hex(value) if isinstance(kind, T.BinaryType) else value


@dataclass(frozen=True)
class KeyRanges:
    """The distinct values of some columns, staged, in ranges along their order.

    ``keys`` holds the columns, ``__count``, the rows with those values, and ``__part``, the range. ``sizes``
    has the rows of each range.
    """

    keys: DataFrame
    columns: tuple[str, ...]
    sizes: tuple[int, ...]

    def first_rows(self) -> DataFrame:
        """``keys`` with ``__first``, how many rows of the table have smaller values."""
        before = list(accumulate(self.sizes, initial=0))[:-1]
        starts = small_frame(
            self.keys.sparkSession, list(enumerate(before)), "__part int, __before bigint"
        )
        upto = (
            Window.partitionBy("__part").orderBy(*named(self.columns))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        within = F.sum("__count").over(upto) - F.col("__count")
        placed = self.keys.withColumn("__within", within).join(starts, "__part")
        first = F.col("__before") + F.col("__within")
        return placed.withColumn("__first", first).drop("__part", "__before", "__within")


def _ranged(df: DataFrame, columns: Sequence[str], keys_per_range: int) -> DataFrame:
    """Each value of the columns with ``__count``, its rows, and ``__part``, its range."""
    keys = df.select(*named(columns))
    distinct = keys.agg(F.approx_count_distinct(F.struct(*named(columns)))).first()[0]
    counted = keys.groupBy(*named(columns)).agg(F.count(F.lit(1)).alias("__count"))
    ranges = max(1, -(-distinct // keys_per_range))
    return counted.repartitionByRange(ranges, *named(columns)).withColumn(
        "__part", F.spark_partition_id()
    )


def key_ranges(
    df: DataFrame, columns: Sequence[str], keys_per_range: int = ROWS_PER_BUCKET
) -> KeyRanges:
    """Count the rows of each value of ``columns`` and order the values, NULL first.

    Rows are counted per value before anything is ordered, so a frequent value costs one row. There
    is a range for about ``keys_per_range`` values however many there are. Only the named columns
    are read; the ranges are staged, so that a lost executor cannot change what has been counted.
    """
    staged = stage(_ranged(df, columns, keys_per_range), "keys")
    found = dict(staged.groupBy("__part").agg(F.sum("__count")).collect())
    sizes = tuple(found.get(i, 0) for i in range(max(found, default=-1) + 1))
    return KeyRanges(staged, tuple(columns), sizes)


def number_in_order(df: DataFrame, order_by: Sequence[Column], name: str, start: int) -> DataFrame:
    """Number the rows ``start``, ``start + 1``, … in the given order, without gaps.

    Rows are sorted into range partitions and staged with their place, so that a lost executor
    cannot change what has been numbered. A row's number is its place in its partition plus
    the rows of the partitions before. Rows that tie are told apart by the partition they came
    from: a third of all rows may share one value and still spread over many tasks.
    """
    place = "__place"
    origin = "__origin"
    arranged = (
        df.withColumn(origin, F.spark_partition_id())
        .repartitionByRange(*order_by, F.col(origin))
        .sortWithinPartitions(*order_by, F.col(origin))
        .drop(origin)
        .withColumn(place, F.monotonically_increasing_id())
    )
    placed = stage(arranged, "numbered")
    part = F.shiftright(F.col(place), 33).cast("int")
    within = F.col(place).bitwiseAND(F.lit((1 << 33) - 1))
    sizes = dict(placed.groupBy(part.alias("part")).count().collect())
    parts = max(sizes, default=0) + 1
    before = list(accumulate((sizes.get(i, 0) for i in range(parts - 1)), initial=start))
    first = F.get(F.lit(before).cast("array<bigint>"), part)
    return placed.withColumn(name, first + within).drop(place)


