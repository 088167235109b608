"""Times the headline work on one machine and prints one JSON line.

Before the clock starts two of the smallest tables are moved, so that loading classes into a new
JVM is not counted.

BENCH_SF_DIR names the folder of test tables, BENCH_CPUS the number of cores.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tablehaul import (
    ColumnSpec,
    JobConf,
    ParquetTables,
    append_with_sequence,
    check_foreign_key,
    check_primary_key,
    compare,
    fit_report,
    migrate,
    page_bounds,
    read_delimited,
    split_valid,
    tag_pages,
    write_clustered,
    write_delimited,
)
from tablehaul.shared import new_folder

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
DOCUMENTS = [ColumnSpec("text", "VARCHAR", 255), ColumnSpec("lang", "CHAR", 2, is_nullable=False)]


def session() -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def all_rows(df) -> None:
    """Compute every row and column without keeping them."""
    df.write.format("noop").mode("overwrite").save()


def cases(spark: SparkSession) -> dict:
    source = ParquetTables(spark, SF_DIR)
    orders, lines = source.read("orders"), source.read("lineitem")
    moved = ParquetTables(spark, new_folder(spark, "bench"))
    narrow = ParquetTables(spark, new_folder(spark, "bench-rejects"))
    strict = ParquetTables(spark, SF_DIR, specs={"documents": [
        ColumnSpec("doc_id", "BIGINT"), *DOCUMENTS,
        ColumnSpec("source", "VARCHAR", 4), ColumnSpec("n_chars", "BIGINT"),
    ]})

    def round_trip():
        path = new_folder(spark, "bench-text")
        pages = source.read("pages")
        all_rows(read_delimited(spark, path, pages.schema, write_delimited(pages, path)))

    def append():
        new = source.read("events").select(F.col("user_id").alias("o_custkey"))
        keyed = orders.select("o_orderkey", "o_custkey")
        all_rows(append_with_sequence(keyed, new, "o_orderkey", ["o_custkey"]))

    return {
        "migrate_all": lambda: migrate(source, moved, JobConf(table_parallelism=int(CPUS))),
        "migrate_rejects": lambda: migrate(strict, narrow, tables=["documents"]),
        "compare": lambda: all_rows(compare(source, moved)),
        "page_bounds": lambda: all_rows(page_bounds(lines, "l_orderkey", 5000, 8)),
        "page_bounds_buckets": lambda: all_rows(
            page_bounds(lines, "l_orderkey", 5000, 8, rows_per_bucket=10_000)
        ),
        "tag_pages": lambda: all_rows(tag_pages(lines, "l_orderkey", 5000)),
        "fit_report": lambda: all_rows(fit_report(source.read("documents"), DOCUMENTS)),
        "quarantine": lambda: all_rows(split_valid(source.read("documents"), DOCUMENTS)[1]),
        "sequence_append": append,
        "clustered": lambda: write_clustered(lines, moved, "by_date", ["l_shipdate"]),
        "delimited": round_trip,
        "check_pk": lambda: all_rows(check_primary_key(lines, ["l_orderkey", "l_linenumber"])),
        "check_fk": lambda: all_rows(
            check_foreign_key(lines, ["l_orderkey"], orders, ["o_orderkey"])
        ),
    }


def main() -> None:
    os.chdir(tempfile.mkdtemp(prefix="bench-"))
    spark = session()
    warm = ParquetTables(spark, new_folder(spark, "bench-warm"))
    migrate(ParquetTables(spark, SF_DIR), warm, tables=["region", "nation"])
    seconds = {}
    for name, run in cases(spark).items():
        started = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - started, 3)
    source = ParquetTables(spark, SF_DIR)
    moved_rows = sum(source.count_frame(n).first()[0] for n in source.table_names())
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
                "migrated_rows": moved_rows,
                "migrated_rows_per_sec": round(moved_rows / seconds["migrate_all"]),
            }
        )
    )


if __name__ == "__main__":
    main()
