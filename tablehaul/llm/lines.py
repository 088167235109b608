"""Lines that many documents share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WHITE = " \t\n\x0b\x0c\r"
#: Parts into which the documents that share a line are dealt.
SALTS = 16


def _key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, LOWER)


def drop_common_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = 10,
    min_chars: int = 1,
) -> DataFrame:
    """The documents without the lines that ``min_docs`` or more of them have.

    A line's key is the line without ASCII white space at its ends, A-Z lower-cased; keys
    shorter than ``min_chars`` are never dropped. Keys are told apart by 128 bits of hash. Each
    document counts a key once, before the shuffle. Positions of dropped lines come back by
    document, and the lines at the other positions are joined again by newlines.

    Returns the columns of ``docs`` with the text replaced (null becomes empty), then ``n_lines``
    and ``n_dropped``, which take the place of columns so named. A null or empty text is one
    empty line. Every row is a document of its own, also with a null or repeated id. An empty
    table gives an empty one.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    mark = [F.col(id_col).alias("_id"), F.xxhash64(text).alias("_mark")]
    pieces = F.split(text, "\n", -1)
    keys = F.transform(pieces, _key)
    both = [F.xxhash64("key").alias("h"), F.xxhash64(F.lit(1), "key").alias("g")]
    long_enough = F.length("key") >= min_chars
    common = (
        docs.select(F.explode(F.array_distinct(keys)).alias("key"))
        .where(long_enough).select(*both)
        .groupBy("h", "g").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs)
        .select("h", "g", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    salt = F.pmod("_mark", F.lit(SALTS)).cast("int").alias("salt")
    at = docs.select(*mark, F.posexplode(keys).alias("at", "key")).where(long_enough)
    dropped = (
        at.select("_id", "_mark", "at", salt, *both).join(common, ["h", "g", "salt"])
        .groupBy("_id", "_mark").agg(F.collect_set("at").alias("_at"))
    )
    rows = docs.select(F.struct("*").alias("_row"), *mark).alias("r")
    met = rows.join(
        dropped.alias("d"),
        F.col("r._id").eqNullSafe(F.col("d._id")) & (F.col("r._mark") == F.col("d._mark")),
        "left",
    ).select("_row", F.col("_at"))
    text = F.coalesce(F.col("_row")[text_col], F.lit(""))
    met = met.withColumn("_lines", F.split(text, "\n", -1))
    every = F.sequence(F.lit(0), F.size("_lines") - 1)
    left = F.array_sort(F.array_except(every, F.col("_at")))
    kept = F.array_join(F.transform(left, lambda i: F.col("_lines")[i]), "\n")
    n_dropped = F.coalesce(F.size("_at"), F.lit(0)).cast("long")
    named = [
        F.when(F.col("_at").isNull(), text).otherwise(kept).alias(c)
        if c == text_col else F.col("_row")[c].alias(c)
        for c in docs.columns if c not in ("n_lines", "n_dropped")
    ]
    return met.select(
        *named,
        F.size("_lines").cast("long").alias("n_lines"),
        F.when(F.col("_at").isNull(), F.lit(0)).otherwise(n_dropped).cast("long").alias("n_dropped"),
    )
