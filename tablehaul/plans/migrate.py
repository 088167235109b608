"""Moving every table of a source to a target."""

from __future__ import annotations

import datetime
import itertools
import logging
import threading
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tablehaul.conf import JobConf
from tablehaul.functions.frames import small_frame
from tablehaul.functions.keys import FOREIGN, INDEX, AutoColumn, Constraint
from tablehaul.operators.checks import run_checks
from tablehaul.operators.conform import split_marked, with_reject_reason
from tablehaul.operators.sequence import sequence_starts
from tablehaul.operators.sinks import clustered, curved, write_existing
from tablehaul.operators.views import OUTCOME_SCHEMA as VIEW_SCHEMA
from tablehaul.operators.views import register_views
from tablehaul.plans.resume import stage_in_pages
from tablehaul.plans.summary import migration_summary
from tablehaul.shared import stage, unstage
from tablehaul.sources.tables import TASK_TABLE, TableSet

TASK_SCHEMA = (
    "table_name string, task_start_time timestamp, task_end_time timestamp, thread int, "
    "run_time int, source_table_rows bigint, target_table_rows bigint, is_success string"
)

#: Columns that share a layout; with more of them none gets narrow ranges.
MOST_CURVE_COLUMNS = 4

_log = logging.getLogger(__name__)


def table_list(lines: Iterable[str]) -> list[str]:
    """Names from a table list: blank lines are skipped, the first comma field counts."""
    return [line.split(",")[0].strip() for line in lines if line.strip()]


def _copy(
    source: TableSet, target: TableSet, table: str, conf: JobConf, data_only: bool
) -> tuple[int, int]:
    """Copy one table; ``(source_rows, target_rows)``.

    A source that reads the same each time is written in one pass, and rows that do not fit are looked for
    only if there are any. Source rows are counted in that pass, or without one where that is cheap. A
    live source is read once: its rows are staged, parted from there, and the staged ones deleted. With
    ``resume_dir`` they are staged there in pages, and a run that failed goes on with the pages it lacks.
    """
    scan = source.scan(table, conf)
    specs = source.columns(table, scan)
    if data_only:
        # The rows have to fit the table that is there.
        given = {c.lower() for c in scan.columns}
        own = target.columns(target.resolve(table))
        extra = given - {s.column_name.lower() for s in own}
        if extra:
            raise ValueError(f"{table} has no columns {sorted(extra)}")
        specs = [s for s in own if s.column_name.lower() in given]
    marked = with_reject_reason(scan, specs, conf.length_unit)
    sorted_by, curve_by = conf.cluster_by.get(table), conf.curve_by.get(table)

    def write(rows: DataFrame) -> None:
        good, _ = split_marked(rows, specs)
        if sorted_by:
            good = clustered(good, sorted_by)
        elif curve_by:
            good = curved(good, curve_by)
        if data_only:
            write_existing(good, target, table, conf=conf)
        else:
            target.replace(table, good, conf)

    laid_out = bool(sorted_by or curve_by)
    if not source.reads_repeat():
        if conf.resume_dir:
            mark = partial(with_reject_reason, columns=specs, length_unit=conf.length_unit)
            staged = stage_in_pages(source, table, conf, mark)
            write(staged)
            counts = _settled(target, table, staged.count(), split_marked(staged, specs)[1])
            unstage(staged)
            return counts
        staged = stage(marked, "live")
        try:
            write(staged)
            return _settled(target, table, staged.count(), split_marked(staged, specs)[1])
        finally:
            unstage(staged)
    if source.cheap_count or laid_out:
        write(marked)
        rows = source.count_frame(table).first()[0]
    else:
        rows = _write_counted(marked, write)
    return _settled(target, table, rows, split_marked(marked, specs)[1])


def _settled(target: TableSet, table: str, rows: int, rejected: DataFrame) -> tuple[int, int]:
    """Keep the rows that did not fit, if any; ``(rows, rows written)``."""
    written = target.count_frame(target.resolve(table)).first()[0]
    if written < rows:
        target.keep_rejected(table, rejected)
    else:
        target.clear_rejected(table)
    return rows, written


def _write_counted(marked: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Write the rows that fit; how many rows were seen."""
    seen = Observation()
    write(marked.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def migrate(
    source: TableSet,
    target: TableSet,
    conf: JobConf = JobConf(),
    tables: Iterable[str] | None = None,
    data_only: bool = False,
) -> DataFrame:
    """Copy tables and return the task table, one record per table.

    ``tables`` are lines of a table list; without it every base table is copied. ``data_only``
    keeps the target's own columns and needs its tables to be there. Tables are copied by
    ``table_parallelism`` threads, each submitting its jobs to a scheduler pool of its own; the
    rows stay on the executors. A table that fails is recorded and the others go on. The records
    are kept in the target as well, in a table that is not listed among its own.
    """
    names = source.table_names() if tables is None else _spelled(source, table_list(tables))
    spark = source.spark
    numbers = itertools.count()
    worker = threading.local()

    def task(name: str) -> tuple:
        if not hasattr(worker, "number"):
            worker.number = next(numbers)
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"tables-{worker.number}")
        begun = datetime.datetime.now(datetime.UTC)
        rows = written = None
        try:
            rows, written = _copy(source, target, name, conf, data_only)
        except Exception as error:
            _log.error("table %s failed: %s", name, error)
        ended = datetime.datetime.now(datetime.UTC)
        seconds = int((ended - begun).total_seconds())
        verdict = "Y" if rows is not None and rows == written else "N"
        return name, begun, ended, worker.number, seconds, rows, written, verdict

    # Large tables first: the run then does not end waiting for one that began last.
    queue = sorted(names, key=source.size_hint, reverse=True)
    run = inheritable_thread_target(spark)(task)
    with ThreadPoolExecutor(max_workers=conf.table_parallelism) as pool:
        done = dict(zip(queue, pool.map(run, queue)))
    tasks = small_frame(spark, [done[name] for name in names], TASK_SCHEMA)
    try:
        target.replace(TASK_TABLE, tasks, conf)
    except Exception as error:
        _log.error("the task table could not be kept in %s: %s", target.name, error)
    return tasks


def _spelled(source: TableSet, listed: Sequence[str]) -> list[str]:
    """Each listed table once, as the source spells it; unknown names as they are."""
    known = {name.lower(): name for name in source.all_names()}
    return list({name.lower(): known.get(name.lower(), name) for name in listed}.values())


@dataclass(frozen=True)
class Migration:
    """What a whole run did."""

    tasks: DataFrame
    sequences: DataFrame
    views: DataFrame
    checks: DataFrame
    summary: DataFrame


def _laid_out(conf: JobConf, source: TableSet, keys: Sequence[Constraint]) -> JobConf:
    """The settings with a layout for each table that has plain indexes and none yet."""
    spelled = {name.lower(): name for name in source.all_names()}
    indexes: dict[str, list[tuple[str, ...]]] = {}
    for key in keys:
        table = spelled.get(key.table.lower())
        if key.kind == INDEX and table and table not in conf.cluster_by and table not in conf.curve_by:
            indexes.setdefault(table, []).append(key.columns)
    one = {t: found[0] for t, found in indexes.items() if len(found) == 1}
    several = {
        t: tuple(dict.fromkeys(columns[0] for columns in found))[:MOST_CURVE_COLUMNS]
        for t, found in indexes.items() if len(found) > 1
    }
    return replace(conf, cluster_by={**conf.cluster_by, **one}, curve_by={**conf.curve_by, **several})


def migrate_database(
    source: TableSet,
    target: TableSet,
    conf: JobConf = JobConf(),
    tables: Iterable[str] | None = None,
    data_only: bool = False,
    auto_columns: Sequence[AutoColumn] | None = None,
    constraints: Sequence[Constraint] | None = None,
) -> Migration:
    """Tables, then sequences, views, keys and foreign keys, and a summary.

    Self-numbering columns and keys are those of the source's catalog unless they are given. A
    table list leaves out views and the keys of other tables. ``data_only`` copies rows alone.

    Plain indexes become the layout of a table's files: along its one index, or along a curve through the first
    columns of up to four. A target without files, or a run without ``index_layout``, has no use
    for them, and they are left out of checks and summary.
    """
    autos = source.auto_columns() if auto_columns is None else auto_columns
    keys = source.constraints() if constraints is None else constraints
    if conf.index_layout and target.lays_out and not data_only:
        conf = _laid_out(conf, source, keys)
    else:
        keys = [c for c in keys if c.kind != INDEX]
    lines = None if tables is None else list(tables)
    tasks = migrate(source, target, conf, lines, data_only)
    listed = None if lines is None else {n.lower() for n in table_list(lines)}

    def wanted(table: str) -> bool:
        return not data_only and (listed is None or table.lower() in listed)

    sequences = sequence_starts(target, [a for a in autos if wanted(a.table)])
    if data_only or listed is not None:
        views = small_frame(source.spark, [], VIEW_SCHEMA)
    else:
        views = register_views(target, source.view_definitions(), source.name)
    kept = [c for c in keys if wanted(c.table)]
    own = run_checks(target, [c for c in kept if c.kind != FOREIGN], conf.table_parallelism)
    between = run_checks(target, [c for c in kept if c.kind == FOREIGN], conf.table_parallelism)
    checks = own.unionByName(between)
    return Migration(
        tasks, sequences, views, checks, migration_summary(tasks, views, checks, sequences)
    )
