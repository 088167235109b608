"""Writing tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehaul.conf import JobConf
from tablehaul.functions.names import columns as named
from tablehaul.functions.types import ColumnSpec
from tablehaul.operators.brackets import column_digits, quantiles, range_of
from tablehaul.operators.conform import REJECT_REASON, with_defaults, with_reject_reason
from tablehaul.sources.tables import TableSet

#: Bits of a column's range on a curve: 64 ranges.
_CURVE_BITS = 6


def write_table(
    df: DataFrame, target: TableSet, table: str, mode: str = "overwrite", conf: JobConf = JobConf()
) -> None:
    """Make ``df`` the table: an earlier table of that name is replaced, also by zero rows."""
    if mode != "overwrite":
        raise ValueError("tables are replaced; the only mode is 'overwrite'")
    target.replace(table, df, conf)


def write_existing(
    df: DataFrame,
    target: TableSet,
    table: str,
    columns: Sequence[ColumnSpec] | None = None,
    conf: JobConf = JobConf(),
) -> None:
    """Replace the rows of a table that is there already and keep its columns.

    Input columns are matched by name. Those missing get the default in ``columns``, or in the
    target's own records; a missing NOT NULL column without one is an error. So is a value that
    does not fit its column: it is never stored as NULL, and the old rows stay.
    """
    specs = target.columns(table) if columns is None else columns
    known = {s.column_name.lower() for s in specs}
    extra = [c for c in df.columns if c.lower() not in known]
    if extra:
        raise ValueError(f"{table} has no columns {extra}")
    given = {c.lower() for c in df.columns}
    marked = with_reject_reason(
        df, [s for s in specs if s.column_name.lower() in given], conf.length_unit
    )
    reason = F.col(REJECT_REASON)
    refused = F.raise_error(F.concat(F.lit(f"a row does not fit {table}: "), reason))
    fitting = marked.filter(F.when(reason == "", True).otherwise(refused.cast("boolean")))
    target.replace(table, with_defaults(fitting.drop(REJECT_REASON), specs), conf)


def clustered(df: DataFrame, cols: Sequence[str], files: int | None = None) -> DataFrame:
    """The rows in ranges of ``cols``, sorted in each.

    The input partition breaks ties between equal keys, so that a key with a great share of the
    rows is spread over several ranges. A row's partition does not change when a task is repeated.
    """
    origin = "__origin"
    keys = named(cols)
    tagged = df.withColumn(origin, F.spark_partition_id())
    parts = [files] if files else []
    return (
        tagged.repartitionByRange(*parts, *keys, F.col(origin))
        .sortWithinPartitions(*keys)
        .drop(origin)
    )


def curve_place(df: DataFrame, cols: Sequence[str]) -> Column:
    """Where a row lies on a curve that visits rows near each other in every one of ``cols`` one after the other.

    Each column is cut into ranges of about equal numbers of rows, found by a sketch; the curve takes the bits
    of the ranges' numbers in turn, the highest ones first. ``df`` is read once for each column.
    """
    bits = min(_CURVE_BITS, 62 // len(cols))
    ranks = []
    for name in cols:
        code = column_digits(name, df.schema[name].dataType)[0].code
        edges = sorted(set(quantiles(df, code, 1 << bits)[1:-1]))
        ranks.append(range_of(code, edges).cast("bigint"))
    place = F.lit(0).cast("bigint")
    for bit in range(bits - 1, -1, -1):
        for rank in ranks:
            place = F.shiftleft(place, 1) + F.shiftright(rank, bit).bitwiseAND(F.lit(1))
    return place


def curved(df: DataFrame, cols: Sequence[str], files: int | None = None) -> DataFrame:
    """The rows in ranges of a space-filling curve through ``cols``, which serves a filter on any of them.

    Rows are dealt by the curve, then by the columns; the input partition breaks ties, so that equal rows are
    spread too.
    """
    origin, curve = "__origin", "__curve"
    keys = [F.col(curve), *named(cols)]
    tagged = df.withColumns({curve: curve_place(df, cols), origin: F.spark_partition_id()})
    parts = [files] if files else []
    return (
        tagged.repartitionByRange(*parts, *keys, F.col(origin))
        .sortWithinPartitions(*keys)
        .drop(origin, curve)
    )


def write_clustered(
    df: DataFrame,
    target: TableSet,
    table: str,
    cols: Sequence[str],
    files: int | None = None,
    conf: JobConf = JobConf(),
    curve: bool = False,
) -> None:
    """Write a table whose files hold narrow ranges of ``cols``, so that filters skip files.

    In their order the first column gets the narrowest ranges. With ``curve`` all get ranges, each wider than if
    it were alone: one layout in place of several indexes.
    """
    target.replace(table, (curved if curve else clustered)(df, cols, files), conf)
