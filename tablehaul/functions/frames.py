"""DataFrames of a few rows that the driver already holds."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def small_frame(spark: SparkSession, rows: Iterable[Sequence], schema: str) -> DataFrame:
    """Rows of outcomes, one per table or object, as a local relation.

    Going through Arrow, they are part of the plan: no Python worker reads them.
    """
    typed = T.StructType.fromDDL(schema)
    names = typed.fieldNames()
    table = pa.Table.from_pylist(
        [dict(zip(names, row)) for row in rows], schema=to_arrow_schema(typed)
    )
    return spark.createDataFrame(table, schema=typed)
