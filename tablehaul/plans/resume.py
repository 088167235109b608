"""Reading a table in pages that a later run need not read again.

Every page's rows go to a folder of their own, and only then a line with their number and the sum of their
hashes to a ledger. A run that finds a ledger reads the pages that are missing from it, or whose rows no longer
add up to their line. A page is written whole or anew, so it may be written any number of times.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import quote

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tablehaul.conf import JobConf
from tablehaul.functions.frames import small_frame
from tablehaul.plans.diff import content_sums, hashed
from tablehaul.sources.tables import TableSet

PAGE = "__page"
_LEDGER = f"{PAGE} int, rows bigint, s0 bigint, s1 bigint, s2 bigint, s3 bigint"


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def _folder(source: TableSet, table: str, conf: JobConf) -> str:
    return f"{conf.resume_dir.rstrip('/')}/{quote(source.name, safe='')}/{quote(table, safe='')}"


def _planned(source: TableSet, table: str, conf: JobConf, folder: str) -> list[str]:
    """The pages as the first run cut them: later ones must not cut them otherwise."""
    spark = source.spark
    place = f"{folder}/plan"
    if not _exists(spark, f"{place}/_SUCCESS"):
        rows = list(enumerate(source.page_predicates(table, conf)))
        plan = small_frame(spark, rows, f"{PAGE} int, predicate string")
        plan.coalesce(1).write.mode("overwrite").parquet(place)
    kept = spark.read.parquet(place).orderBy(PAGE).collect()
    return [r.predicate for r in kept]


def _sums(df: DataFrame) -> list:
    """The columns of a ledger line but for the page."""
    return [F.count(F.lit(1)).alias("rows"), *[s.alias(f"s{i}") for i, s in enumerate(content_sums())]]


def _whole_pages(spark: SparkSession, folder: str, names: list[str]) -> set[int]:
    """The pages whose rows add up to their line in the ledger."""
    if not _exists(spark, f"{folder}/ledger"):
        return set()
    lines = spark.read.schema(_LEDGER).option("recursiveFileLookup", True).parquet(f"{folder}/ledger")
    if lines.isEmpty():
        return set()
    rows = spark.read.option("basePath", f"{folder}/rows").parquet(f"{folder}/rows")
    wanted = lines.where("rows > 0")
    found = hashed(rows.join(wanted.select(PAGE), PAGE, "left_semi"), names).groupBy(PAGE).agg(*_sums(rows))
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"f.{c}")) for c in ("rows", "s0", "s1", "s2", "s3")]
    met = wanted.alias("l").join(found.alias("f"), PAGE).where(same[0] & same[1] & same[2] & same[3] & same[4])
    pages = met.select(PAGE).unionAll(lines.where("rows = 0").select(PAGE))
    return {r[0] for r in pages.collect()}


def stage_in_pages(
    source: TableSet, table: str, conf: JobConf, mark: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """The rows of a live table as ``mark`` makes them, from pages that outlive the application.

    Pages are the ranges that the source itself cuts the table into. ``read_parallelism`` pages are read at a
    time; one that fails leaves the others, and the error is raised at the end.
    """
    spark = source.spark
    table = source.resolve(table)
    folder = _folder(source, table, conf)
    predicates = _planned(source, table, conf, folder)
    shape = mark(source.read(table).limit(0))
    names = shape.columns
    done = _whole_pages(spark, folder, names)

    def read(page: int) -> Exception | None:
        try:
            seen = Observation()
            marked = mark(source.read_page(table, predicates[page]))
            own = hashed(marked, names).observe(seen, *_sums(marked)).drop("__h1", "__h2")
            own.write.mode("overwrite").parquet(f"{folder}/rows/{PAGE}={page}")
            line = [(page, *(seen.get[c] for c in ("rows", "s0", "s1", "s2", "s3")))]
            small_frame(spark, line, _LEDGER).write.mode("overwrite").parquet(f"{folder}/ledger/{page}")
        except Exception as error:
            return error
        return None

    missing = [i for i in range(len(predicates)) if i not in done]
    with ThreadPoolExecutor(max_workers=conf.read_parallelism) as pool:
        errors = [e for e in pool.map(inheritable_thread_target(spark)(read), missing) if e]
    if errors:
        raise errors[0]
    places = [f"{folder}/rows/{PAGE}={i}" for i in range(len(predicates))]
    staged = spark.read.schema(shape.schema).parquet(*places)
    staged.staged_at = folder
    return staged
