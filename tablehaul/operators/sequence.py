"""Numbers for rows whose key is missing, continuing where the table stands."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehaul.functions.frames import small_frame
from tablehaul.functions.keys import AutoColumn
from tablehaul.functions.names import columns as named
from tablehaul.functions.names import quoted
from tablehaul.operators.ordering import number_in_order
from tablehaul.sources.tables import TableSet

OUTCOME_SCHEMA = (
    "table_name string, column_name string, sequence_name string, "
    "next_value bigint, is_success string"
)

_log = logging.getLogger(__name__)


def _after(largest: int | None, start: int | None) -> int:
    return max((largest or 0) + 1, start if start is not None else 1)


def next_value(existing: DataFrame, key: str, start: int | None = None) -> int:
    """The first free number: after the largest key in use, and not below ``start``."""
    return _after(existing.agg(F.max(quoted(key)).cast("bigint")).first()[0], start)


def append_with_sequence(
    existing: DataFrame,
    new_rows: DataFrame,
    key: str,
    order_by: Sequence[str],
    start: int | None = None,
) -> DataFrame:
    """``existing`` and the new rows; those without a key are numbered in ``order_by`` order.

    A new row that brings its own key keeps it, and numbering begins after it.
    """
    kind = existing.schema[key].dataType
    first = next_value(existing, key, start)
    if key.lower() in {c.lower() for c in new_rows.columns}:
        has_key = F.col(quoted(key)).isNotNull()
        own = new_rows.filter(has_key)
        first = next_value(own, key, first)
        existing = existing.unionByName(own)
        new_rows = new_rows.filter(~has_key).drop(key)
    order: list[Column] = named(order_by)
    numbered = number_in_order(new_rows, order, key, first)
    return existing.unionByName(numbered.withColumn(key, F.col(quoted(key)).cast(kind)))


def sequence_starts(target: TableSet, auto_columns: Sequence[AutoColumn]) -> DataFrame:
    """``(table_name, column_name, sequence_name, next_value, is_success)`` of each sequence.

    A sequence fails when its table or column is not in the target. A database is asked for its largest
    value; no rows come from it.
    """
    rows = []
    for auto in auto_columns:
        try:
            found = _after(target.largest(auto.table, auto.column), auto.next_value)
            rows.append((auto.table, auto.column, auto.sequence_name, found, "Y"))
        except Exception as error:
            _log.error("the start of %s failed: %s", auto.sequence_name, error)
            rows.append((auto.table, auto.column, auto.sequence_name, None, "N"))
    return small_frame(target.spark, rows, OUTCOME_SCHEMA)
