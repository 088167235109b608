"""Keys of a table, checked over all its rows."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablehaul.functions.frames import small_frame
from tablehaul.functions.keys import FOREIGN, INDEX, PRIMARY, UNIQUE, Constraint
from tablehaul.functions.names import columns as named
from tablehaul.functions.names import quoted
from tablehaul.sources.tables import TableSet

OUTCOME_SCHEMA = (
    "kind string, table_name string, constraint_name string, violations bigint, is_success string"
)

#: Bytes of Spark's bitmaps and of a shuffled key, and how many times less bitmaps have to be.
BITMAP_BYTES, KEY_BYTES, LESS = 4096, 16, 8

_log = logging.getLogger(__name__)


def _bucket(key: Column) -> Column:
    """The stretch of whole numbers a key lies in, one of a bitmap's size each."""
    return F.bitmap_bucket_number(key)


def dense_enough(df: DataFrame, key: str) -> bool:
    """Whether bitmaps of a whole-number key are much less to shuffle than the key itself.

    A task makes a bitmap for each stretch that its rows touch; lowest and highest key and number of rows of
    each task bound how many that can be.
    """
    k = F.col(quoted(key)).cast("bigint")
    tasks = df.where(k.isNotNull()).groupBy(F.spark_partition_id().alias("task")).agg(
        F.count(F.lit(1)).alias("n"), F.min(_bucket(k)).alias("lo"), F.max(_bucket(k)).alias("hi")
    )
    touched = F.least(F.col("n"), F.col("hi") - F.col("lo") + 1)
    rows, bitmaps = tasks.agg(F.sum("n"), F.sum(touched)).first()
    return bool(rows) and bitmaps * BITMAP_BYTES * LESS < rows * KEY_BYTES


def repeated_stretches(df: DataFrame, key: str) -> DataFrame:
    """``(bucket)``: the stretches of a whole-number key in which some value occurs again.

    A stretch's bitmap has a bit for each value; it holds fewer bits than there were rows if one came twice.
    """
    k = F.col(quoted(key)).cast("bigint")
    found = df.where(k.isNotNull()).groupBy(_bucket(k).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.bitmap_construct_agg(F.bitmap_bit_position(k)).alias("bits")
    )
    return found.where(F.col("n") > F.bitmap_count("bits")).select("bucket")


def _suspects(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The rows whose key may occur again, and those without one."""
    kinds = {f.name.lower(): f.dataType for f in df.schema.fields}
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    keys = df.select(*named(cols))
    if len(cols) != 1 or not isinstance(kinds[cols[0].lower()], whole) or not dense_enough(keys, cols[0]):
        return keys
    k = F.col(quoted(cols[0])).cast("bigint")
    again = repeated_stretches(keys, cols[0]).withColumnRenamed("bucket", "__bucket")
    in_doubt = keys.join(again, _bucket(k) == F.col("__bucket"), "left_semi")
    return in_doubt.unionAll(keys.where(k.isNull()))


def check_primary_key(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keys that occur more than once or hold a NULL, with their number of rows.

    A key of one whole-number column that lies in its files in order is first looked for in bitmaps, a bit a
    value; only keys of stretches that hold one twice are then grouped. Any other key is grouped
    whole. ``df`` may be read three times and must stay the same meanwhile.
    """
    a_null = reduce(lambda a, b: a | b, [c.isNull() for c in named(cols)])
    counted = _suspects(df, cols).groupBy(*named(cols)).agg(F.count(F.lit(1)).alias("dup_count"))
    return counted.filter((F.col("dup_count") > 1) | a_null)


def _all_known(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in named(cols)])


def check_unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, found as :func:`check_primary_key` finds them. A key with a NULL in it is
    never a duplicate."""
    return (
        _suspects(df.filter(_all_known(cols)), cols)
        .groupBy(*named(cols))
        .agg(F.count(F.lit(1)).alias("dup_count"))
        .filter(F.col("dup_count") > 1)
    )


def _orphan_keys(
    child: DataFrame, child_cols: Sequence[str], parent: DataFrame, parent_cols: Sequence[str]
) -> DataFrame:
    """Distinct child keys without a parent, with their rows; columns ``k0, k1, …, n``."""
    keys = [f"k{i}" for i in range(len(child_cols))]
    used = (
        child.filter(_all_known(child_cols))
        .select(*[F.col(quoted(c)).alias(k) for c, k in zip(child_cols, keys)])
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = parent.select(
        *[F.col(quoted(c)).alias(k) for c, k in zip(parent_cols, keys)]
    ).distinct()
    return used.join(known, keys, "left_anti")


def check_foreign_key(
    child: DataFrame, child_cols: Sequence[str], parent: DataFrame, parent_cols: Sequence[str]
) -> DataFrame:
    """Child rows whose key is not in the parent. A key with a NULL in it is not looked up.

    Only distinct keys are shuffled for the look-up. Whole child rows are read again for the keys
    found to be missing: those are few as a rule and are then broadcast by adaptive execution.
    """
    if not child_cols or len(child_cols) != len(parent_cols):
        raise ValueError("child and parent keys need the same number of columns")
    orphans = _orphan_keys(child, child_cols, parent, parent_cols)
    match = reduce(
        lambda a, b: a & b,
        [child[quoted(c)] == orphans[f"k{i}"] for i, c in enumerate(child_cols)],
    )
    return child.join(orphans, match, "left_semi")


def _violations(tables: TableSet, constraint: Constraint) -> int:
    counted = tables.count_violations(constraint)
    if counted is not None:
        return counted
    df = tables.read(constraint.table)
    if constraint.kind == PRIMARY:
        return check_primary_key(df, constraint.columns).count()
    if constraint.kind == UNIQUE:
        return check_unique(df, constraint.columns).count()
    if constraint.kind == FOREIGN:
        orphans = _orphan_keys(
            df, constraint.columns, tables.read(constraint.parent), constraint.parent_columns
        )
        return orphans.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if constraint.kind == INDEX:
        df.select(*named(constraint.columns))
        return 0
    raise ValueError(f"unknown kind of constraint {constraint.kind!r}")


def run_checks(
    tables: TableSet, constraints: Sequence[Constraint], parallelism: int = 4
) -> DataFrame:
    """``(kind, table_name, constraint_name, violations, is_success)``, one row per constraint.

    Primary and unique keys count violating keys, foreign keys orphan rows. A database counts its own. A plain
    index only needs its columns. One constraint's failure does not stop the others.
    """

    def check(constraint: Constraint) -> tuple:
        try:
            found = _violations(tables, constraint)
            verdict = "Y" if found == 0 else "N"
        except Exception as error:
            _log.error("constraint %s on %s failed: %s", constraint.name, constraint.table, error)
            found, verdict = None, "N"
        return constraint.kind, constraint.table, constraint.name, found, verdict

    run = inheritable_thread_target(tables.spark)(check)
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        rows = list(pool.map(run, constraints))
    return small_frame(tables.spark, rows, OUTCOME_SCHEMA)


def constraints_from_catalog(
    statistics: DataFrame, key_usage: DataFrame, referential: DataFrame
) -> list[Constraint]:
    """Keys described by the catalog's index statistics and key usage, columns in key order.

    Foreign keys are grouped by child table and constraint; a table may have several.
    """
    ordered = F.array_sort(F.collect_list(F.struct("seq_in_index", "column_name")))
    indexes = (
        statistics.groupBy("table_name", "index_name")
        .agg(F.min("non_unique").alias("non_unique"), ordered.alias("cols"))
        .orderBy("table_name", "index_name")
        .collect()
    )
    found = []
    for row in indexes:
        if row.index_name.upper() == "PRIMARY":
            kind = PRIMARY
        else:
            kind = INDEX if int(row.non_unique) else UNIQUE
        columns = tuple(c.column_name for c in row.cols)
        found.append(Constraint(kind, row.table_name, row.index_name, columns))
    pairs = F.array_sort(
        F.collect_list(F.struct("ordinal_position", "column_name", "referenced_column_name"))
    )
    names = ["table_name", "constraint_name"]
    foreign = (
        key_usage.filter(F.col("referenced_table_name").isNotNull())
        .join(referential.select(*names), names)
        .groupBy("table_name", "constraint_name")
        .agg(F.first("referenced_table_name").alias("parent"), pairs.alias("cols"))
        .orderBy("table_name", "constraint_name")
        .collect()
    )
    for row in foreign:
        found.append(
            Constraint(
                FOREIGN,
                row.table_name,
                row.constraint_name,
                tuple(c.column_name for c in row.cols),
                row.parent,
                tuple(c.referenced_column_name for c in row.cols),
            )
        )
    return found
