"""Reconciling two table sets: row counts, views, failures and totals."""

from __future__ import annotations

import logging
from collections import Counter
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import chain

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablehaul.functions.frames import small_frame
from tablehaul.sources.tables import REPORT_TABLE, TableSet

NO_TABLE = "TABLE NOT EXIST"
NO_VIEW = "NOT EXISTS VIEW"
MISSING_ROWS = -1
TABLE, VIEW = "TABLE", "VIEW"

_REPORT = (
    "id int, source_db_name string, source_table_name string, source_rows bigint, db_type string, "
    "target_table_name string, target_rows bigint, is_success string"
)

PLANNING_THREADS = 8
TABLES_PER_JOB = 100

_log = logging.getLogger(__name__)


def _in_threads(spark: SparkSession, function: Callable, items: Sequence) -> list:
    """``function`` of each item. Looking up files and starting jobs is mostly waiting."""
    with ThreadPoolExecutor(max_workers=PLANNING_THREADS) as pool:
        return list(pool.map(inheritable_thread_target(spark)(function), items))


def _counted(tables: TableSet) -> list[tuple[str, int]]:
    """Name and rows of every table; -1 where counting failed.

    Many tables are counted by one job. Only if that fails are its tables counted one by one, so
    that an unreadable table costs its own verdict and no other.
    """

    def counted(name: str) -> DataFrame:
        return tables.count_frame(name).select(
            F.lit(name).alias("name"), F.col("rows").cast("bigint").alias("rows")
        )

    def counted_alone(name: str) -> tuple:
        try:
            return tuple(counted(name).first())
        except Exception as error:
            _log.error("counting %s.%s failed: %s", tables.name, name, error)
            return name, MISSING_ROWS

    def counted_together(names: Sequence[str]) -> list[tuple]:
        try:
            sizes = tables.count_together(names)
            if sizes is not None:
                return list(sizes.items())
            planned = _in_threads(tables.spark, counted, names)
            return [tuple(r) for r in reduce(DataFrame.unionByName, planned).collect()]
        except Exception as error:
            _log.warning("counting %s one by one: %s", tables.name, error)
            return [counted_alone(name) for name in names]

    names = tables.table_names()
    batches = [names[i : i + TABLES_PER_JOB] for i in range(0, len(names), TABLES_PER_JOB)]
    return list(chain.from_iterable(_in_threads(tables.spark, counted_together, batches)))


def row_counts(tables: TableSet) -> DataFrame:
    """``(name, rows)`` of every table; ``rows`` is -1 where counting failed."""
    return small_frame(tables.spark, _counted(tables), "name string, rows bigint")


def _require(source: TableSet, target: TableSet) -> None:
    for side, tables in (("source", source), ("target", target)):
        if not tables.exists():
            raise ValueError(f"{side} {tables.name!r} does not exist")


def _report(source: TableSet, lines: list[tuple], after: int) -> DataFrame:
    """Lines without id and source name, one for each catalog object, as a report; ids follow the names."""
    numbered = [
        (after + i, source.name.upper(), *line)
        for i, line in enumerate(sorted(lines, key=lambda line: line[0]), 1)
    ]
    return small_frame(source.spark, numbered, _REPORT).withColumn("compare_time", F.current_timestamp())


def _partners(ours: list[str], theirs: list[str]) -> dict[str, str]:
    """The target's table for each of the source's: of that very name, else the only one left
    whose name differs in case."""
    found = {n: n for n in ours if n in set(theirs)}
    left: dict[str, list[str]] = {}
    for n in theirs:
        if n not in found:
            left.setdefault(n.upper(), []).append(n)
    open_ones = Counter(n.upper() for n in ours if n not in found)
    for n in ours:
        same = left.get(n.upper(), [])
        if n not in found and len(same) == 1 and open_ones[n.upper()] == 1:
            found[n] = same[0]
    return found


def compare_counts(source: TableSet, target: TableSet) -> DataFrame:
    """A verdict for every source table: ``Y`` if the target has it with as many rows."""
    _require(source, target)
    ours, theirs = _in_threads(source.spark, _counted, [source, target])
    found = dict(theirs)
    partners = _partners(source.table_names(), target.table_names())
    lines = []
    for name, rows in ours:
        partner = partners.get(name)
        there = partner in found
        known, same = rows != MISSING_ROWS, there and found[partner] == rows
        lines.append((
            name.upper(), rows, TABLE, partner.upper() if there else NO_TABLE,
            found[partner] if there else MISSING_ROWS, "Y" if known and same else "N",
        ))
    return _report(source, lines, 0)


def compare_views(source: TableSet, target: TableSet) -> DataFrame:
    """A verdict for every source view: ``Y`` if the target has it. Ids follow the tables'."""
    _require(source, target)
    theirs = {n.upper() for n in target.view_names()}
    lines = [
        (n, 0, VIEW, n if n in theirs else NO_VIEW, 0, "Y" if n in theirs else "N")
        for n in (name.upper() for name in source.view_names())
    ]
    return _report(source, lines, len(source.table_names()))


def compare(source: TableSet, target: TableSet) -> DataFrame:
    """The whole report: tables, then views."""
    return compare_counts(source, target).unionByName(compare_views(source, target))


def compare_failures(report: DataFrame) -> DataFrame:
    """The failed lines with ``delta``: how many rows the target has over the source."""
    return report.filter(F.col("is_success") == "N").withColumn(
        "delta", F.col("target_rows") - F.col("source_rows")
    )


def store_report(report: DataFrame, target: TableSet) -> None:
    """Keep the report in the target, in a table that is not listed among its own."""
    target.replace(REPORT_TABLE, report)


def shown(report: DataFrame) -> DataFrame:
    """The report as it is printed: times without the year."""
    return report.drop("source_db_name").withColumn(
        "compare_time", F.date_format("compare_time", "MM-dd HH:mm:ss")
    )


def object_totals(report: DataFrame, target: TableSet) -> DataFrame:
    """``(db_type, source_total, target_total, source_rows, target_rows)`` for tables and views.

    The target's total includes objects that the source does not have.
    """
    totals = small_frame(
        target.spark,
        [(TABLE, len(target.table_names())), (VIEW, len(target.view_names()))],
        "db_type string, target_total bigint",
    )
    present = F.when(F.col("target_rows") != MISSING_ROWS, F.col("target_rows"))
    known = F.when(F.col("source_rows") != MISSING_ROWS, F.col("source_rows"))
    sums = report.groupBy("db_type").agg(
        F.count(F.lit(1)).alias("source_total"),
        F.sum(known).alias("source_rows"),
        F.sum(present).alias("target_rows"),
    )
    none = F.lit(0).cast("bigint")
    return totals.join(sums, "db_type", "left").select(
        "db_type",
        F.coalesce("source_total", none).alias("source_total"),
        "target_total",
        F.coalesce("source_rows", none).alias("source_rows"),
        F.coalesce("target_rows", none).alias("target_rows"),
    )
