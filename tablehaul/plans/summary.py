"""How many objects of each kind a run moved."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehaul.functions.frames import small_frame
from tablehaul.functions.keys import FOREIGN

KINDS = ("tables", "views", "auto columns", "indexes/constraints", "foreign keys")


def migration_summary(
    tasks: DataFrame, views: DataFrame, checks: DataFrame, sequences: DataFrame
) -> DataFrame:
    """``(kind, total, success, failed)``; a kind without objects has zeros."""

    def outcomes(df: DataFrame, kind: Column) -> DataFrame:
        return df.select(kind.alias("kind"), "is_success")

    check_kind = F.when(F.col("kind") == FOREIGN, "foreign keys").otherwise("indexes/constraints")
    every = (
        outcomes(tasks, F.lit("tables"))
        .unionByName(outcomes(views, F.lit("views")))
        .unionByName(outcomes(sequences, F.lit("auto columns")))
        .unionByName(outcomes(checks, check_kind))
    )
    won = F.count_if(F.col("is_success") == "Y")
    counted = every.groupBy("kind").agg(F.count(F.lit(1)).alias("total"), won.alias("success"))
    kinds = small_frame(tasks.sparkSession, [(k,) for k in KINDS], "kind string")
    none = F.lit(0).cast("bigint")
    total, success = F.coalesce("total", none), F.coalesce("success", none)
    return kinds.join(counted, "kind", "left").select(
        "kind", total.alias("total"), success.alias("success"), (total - success).alias("failed")
    )


def failed_tables(tasks: DataFrame) -> DataFrame:
    """Names of the tables that were not copied whole."""
    return tasks.filter(F.col("is_success") == "N").select("table_name")
