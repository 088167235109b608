"""Numbers that tell rows apart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.shared import stage

_LAST = (1 << 63) - 1
#: Numbers that rows without an id of their own take at most.
_ROOM = 1 << 62
_WHOLE = ("tinyint", "smallint", "int", "bigint")


def free_name(docs: DataFrame, name: str) -> str:
    """The name, with as many underscores before it as no column of the rows has."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def numbered(docs: DataFrame, id_col: str, name: str) -> DataFrame:
    """The rows with a number of their own, called ``name``: the id, if it is given and no other row has it.

    Rows with a null or repeated id, and only these, are written once with numbers that no id has, so that they
    keep them. If ids are no whole numbers, or leave no room, all rows are.
    """
    if name in docs.columns:
        raise ValueError(f"the rows already have a column {name!r}")
    fresh = F.monotonically_increasing_id()
    if docs.schema[id_col].dataType.simpleString() not in _WHOLE:
        return stage(docs.withColumn(name, fresh), "numbered")
    own = F.col(id_col).cast("long")
    ids = docs.groupBy(own.alias("id")).agg(F.count(F.lit(1)).alias("n"))
    is_odd = F.col("id").isNull() | (F.col("n") > 1)
    odd, least, most = ids.agg(F.count_if(is_odd), F.min("id"), F.max("id")).first()
    if not odd:
        return docs.withColumn(name, own)
    if (most or 0) <= _LAST - _ROOM:
        fresh = F.lit(max(0, (most or 0) + 1)) + fresh
    elif least > _ROOM - _LAST:
        fresh = F.lit(min(0, least - 1)) - fresh
    else:
        return stage(docs.withColumn(name, fresh), "numbered")
    wanted = ids.where(is_odd).select(F.col("id").alias("_odd"))
    same = own.eqNullSafe(F.col("_odd"))
    apart = stage(docs.join(wanted, same, "left_semi").withColumn(name, fresh), "numbered")
    return docs.join(wanted, same, "left_anti").withColumn(name, own).unionByName(apart)
