"""Delimited text in which NULL and the empty string stay apart."""

from __future__ import annotations

from dataclasses import dataclass, replace
from itertools import chain, count, islice, repeat

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablehaul.functions.binary import hex_bytes, hex_text
from tablehaul.functions.names import quoted
from tablehaul.shared import stage

MAX_RECORDS_PER_FILE = 1_000_000
_MARKERS_PER_PASS = 8
#: Lines that are brought together at once, as a power of two.
_LINE_BITS = 10


@dataclass(frozen=True)
class DelimitedText:
    """The format: every value quoted with quotes doubled, NULL as the bare marker.

    ``multiline`` says that values may hold line ends; it is off where none does.
    """

    separator: str = ";"
    quote: str = '"'
    null_marker: str = "\\N"
    multiline: bool = True


def _as_text(field: T.StructField):
    value = F.col(quoted(field.name))
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        raise ValueError(f"{field.name}: {field.dataType.simpleString()} has no delimited form")
    if isinstance(field.dataType, T.BinaryType):
        return hex_text(value)
    return value.cast("string")


def _fitted(df: DataFrame, dialect: DelimitedText) -> DelimitedText:
    """The dialect with a NULL marker that no cell equals, found by one scan of the text columns.

    A reader cannot tell a quoted marker from a bare one, so the marker has to be absent.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not texts:
        return replace(dialect, multiline=False)
    cells = [F.col(quoted(c)) for c in texts]
    candidates = (dialect.null_marker + (str(i) if i else "") for i in count())

    def anywhere(test) -> Column:
        found = F.lit(False)
        for cell in cells:
            found = found | F.coalesce(test(cell), F.lit(False))
        return F.coalesce(F.bool_or(found), F.lit(False))

    for wanted in chain([1], repeat(_MARKERS_PER_PASS)):
        markers = list(islice(candidates, wanted))
        seen = df.agg(
            anywhere(lambda c: F.contains(c, F.lit("\n")) | F.contains(c, F.lit("\r"))),
            *[anywhere(lambda c, m=m: c == F.lit(m)) for m in markers],
        ).first()
        for marker, used in zip(markers, seen[1:]):
            if not used:
                return replace(dialect, null_marker=marker, multiline=bool(seen[0]))
    raise AssertionError("unreachable: a finite table cannot hold every marker")


def write_delimited(
    df: DataFrame,
    path: str,
    dialect: DelimitedText = DelimitedText(),
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
) -> DelimitedText:
    """Write the rows as text and return the dialect to read them with.

    Lines are made by column functions.
    """
    used = _fitted(df, dialect)
    quote = used.quote
    cells = [
        F.coalesce(
            F.concat(
                F.lit(quote), F.replace(_as_text(f), F.lit(quote), F.lit(quote * 2)), F.lit(quote)
            ),
            F.lit(used.null_marker),
        )
        for f in df.schema.fields
    ]
    line = F.concat_ws(used.separator, *cells).alias("value")
    (
        df.select(line)
        .write.mode("overwrite")
        .option("lineSep", "\n")
        .option("maxRecordsPerFile", max_records_per_file)
        .text(path)
    )
    return used


def _blocks(spark: SparkSession, path: str, quote: str) -> DataFrame:
    """Lines as the file system's blocks hold them: file (a hash of its path), block, part of it (1,024 lines at
    most), place in it, and whether its quotes do not pair up."""
    lines = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    placed = lines.select(
        "value", F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"),
        (quotes % 2).alias("odd"),
    )
    return placed.withColumn("part", F.shiftright("at", _LINE_BITS))


def _in_order(parts: Column, value: str = "value") -> Column:
    """Collected ``(at, value)`` structs as one text with their line ends."""
    return F.array_join(F.transform(F.array_sort(parts), lambda p: p[value]), "\n")


def records(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """``(file, block, part, number, record)``: the records of quoted text, line ends inside quotes and all.

    A line begins a record if an even number of quotes lies before it in its file. Quotes are counted for each
    part of the files' blocks; sums over a file's parts tell for each of them whether it begins inside a value,
    which needs one row a part. A part that does gives its first lines, up to the one that closes the
    value, to the part where the record began, however many parts before. All other lines are
    cut into records part by part: a task sorts the lines of some parts, however large blocks and files are.
    """
    lines = _blocks(spark, path, quote)
    own = ["file", "block", "part"]
    parts = lines.groupBy(*own).agg(
        (F.sum("odd") % 2).alias("odd"), F.min(F.when(F.col("odd") == 1, F.col("at"))).alias("closes"),
        F.max("at").alias("last"),
    )
    along = Window.partitionBy("file").orderBy("block", "part")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2
    parts = parts.withColumn("inside", inside)
    # A record begins in a part that is not wholly inside a value.
    begins = (F.col("inside") == 0) | F.col("closes").isNotNull() & (F.col("closes") < F.col("last"))
    owner = F.last(F.when(begins, F.struct("block", "part")), ignorenulls=True).over(before)
    parts = stage(parts.withColumn("owner", owner), "parts")

    known = parts.where("inside = 1").select(*own, "closes", "owner")
    heads = lines.join(known, own).where(F.col("closes").isNull() | (F.col("at") <= F.col("closes")))
    place = F.struct("block", "part", "at", "value")
    tails = heads.groupBy("file", F.col("owner.block").alias("block"), F.col("owner.part").alias("part")).agg(
        _in_order(F.collect_list(place)).alias("tail")
    )

    opened = parts.select(*own, "inside", "closes")
    body = lines.join(opened, own).where((F.col("inside") == 0) | (F.col("at") > F.col("closes")))
    within = Window.partitionBy(*own).orderBy("at")
    pairs = F.coalesce(F.sum("odd").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    body = body.withColumn("begins", (pairs % 2 == 0).cast("bigint"))
    upto_here = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    body = body.withColumn("number", F.sum("begins").over(upto_here))
    found = body.groupBy(*own, "number").agg(
        _in_order(F.collect_list(F.struct("at", "value"))).alias("record")
    )
    last = F.max("number").over(Window.partitionBy(*own))
    found = found.withColumn("last", last).join(tails, own, "left")
    whole = F.when(F.col("number") == F.col("last"), F.concat_ws("\n", "record", "tail")).otherwise(F.col("record"))
    return found.select(*own, "number", whole.alias("record"))


def _largest_file(spark: SparkSession, path: str) -> int:
    files = spark.read.format("binaryFile").load(path)
    return files.agg(F.max("length")).first()[0] or 0


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    dialect: DelimitedText = DelimitedText(),
    split: bool | None = None,
) -> DataFrame:
    """Read the format into ``schema``. A value that is not of its column's type raises.

    Values may be quoted only where they need it: a cell without characters is an empty text,
    quoted or not, and only the marker is NULL. Empty lines between records are passed over.

    Files whose values hold line ends are read by one task each, unless ``split`` cuts them into blocks
    (:func:`records`), at the price of a shuffle of their lines. By default they are cut if one is larger than
    ``spark.sql.files.maxPartitionBytes``.
    """
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    options = dict(
        sep=dialect.separator, quote=dialect.quote, escape=dialect.quote, nullValue="", emptyValue="",
        ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false", mode="FAILFAST",
    )
    if split is None:
        most = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
        split = dialect.multiline and _largest_file(spark, path) > most
    if split and dialect.multiline:
        whole = records(spark, path, dialect.quote).where("record <> ''")
        row = F.from_csv("record", ", ".join(f"{quoted(n)} string" for n in schema.fieldNames()), options)
        lines = whole.select(row.alias("row")).select("row.*")
    else:
        lines = spark.read.schema(as_text).options(lineSep="\n", multiLine=dialect.multiline, **options).csv(path)

    def cell(name: str) -> Column:
        value = F.coalesce(F.col(quoted(name)), F.lit(""))
        return F.when(value != dialect.null_marker, value)

    return lines.select(
        *[
            (
                hex_bytes(cell(f.name))
                if isinstance(f.dataType, T.BinaryType)
                else cell(f.name).cast(f.dataType)
            ).alias(f.name)
            for f in schema.fields
        ]
    )
