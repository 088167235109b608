"""Pages of a table: ranges of its key that hold about the same number of rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.functions.names import columns as named
from tablehaul.functions.names import quoted
from tablehaul.operators.brackets import brackets
from tablehaul.operators.ordering import ROWS_PER_BUCKET, key_ranges, number_in_order, sortable
from tablehaul.shared import stage

#: Places up to which Spark's own OFFSET is used, which takes that many rows of every task to the driver.
NEAR = 10_000


def _key_pages(df: DataFrame, key: str, page_size: int, rows_per_bucket: int) -> DataFrame:
    """``(k, c, page)``: each distinct key, its rows, and the page its first row falls on.

    A key with more rows than a page leaves a gap in these numbers.
    """
    keys = df.select(F.col(quoted(key)).alias("k"))
    first = key_ranges(keys, ["k"], rows_per_bucket).first_rows()
    page = F.floor(F.col("__first") / F.lit(page_size))
    return first.select("k", F.col("__count").alias("c"), page.alias("raw_page"))


def _numbered_pages(keys: DataFrame) -> DataFrame:
    """``(raw_page, lo, hi, n_rows, page)``: the pages, staged, numbered without gaps."""
    pages = keys.groupBy("raw_page").agg(
        F.min("k").alias("lo"), F.max("k").alias("hi"), F.sum("c").alias("n_rows")
    )
    return number_in_order(pages, [F.col("raw_page")], "page", 0)


def page_bounds(
    df: DataFrame,
    key: str,
    page_size: int,
    shards: int,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """``(page, lo, hi, n_rows, shard)``: key intervals of about ``page_size`` rows.

    No key is split between pages, so a page can hold a little more or less when keys repeat.
    Rows with a NULL key count towards page 0. Pages are dealt to ``min(shards, pages)``
    contiguous shards. The key of ``df`` is read several times and must stay the same meanwhile;
    the result is staged, so that reading it does not scan ``df`` again.
    """
    if page_size < 1 or shards < 1:
        raise ValueError("page_size and shards must be at least 1")
    pages = _numbered_pages(_key_pages(df, key, page_size, rows_per_bucket))
    count = max(1, pages.count())
    shard = F.floor(F.col("page") * F.lit(min(shards, count)) / F.lit(count)).cast("int")
    return pages.select("page", "lo", "hi", "n_rows", shard.alias("shard"))


def shard_bounds(bounds: DataFrame) -> list[tuple[Any, Any, int]]:
    """``(lo, hi, n_rows)`` of each shard in order; as many rows as there are shards."""
    rows = (
        bounds.groupBy("shard")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n_rows").alias("n_rows"))
        .orderBy("shard")
        .collect()
    )
    return [(r.lo, r.hi, r.n_rows) for r in rows]


def tag_pages(
    df: DataFrame, key: str, page_size: int, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Every row with the ``page`` that :func:`page_bounds` puts its key on.

    Only keys are ordered. Rows meet their key's page in an equi-join, whose hot keys adaptive
    execution splits.
    """
    if "page" in {c.lower() for c in df.columns}:
        raise ValueError("the input already has a column 'page'")
    keys = stage(_key_pages(df, key, page_size, rows_per_bucket), "key_pages")
    numbers = _numbered_pages(keys).select("raw_page", "page")
    by_key = keys.join(numbers, "raw_page").select(F.col("k").alias("__key"), "page")
    tagged = df.join(by_key, F.col(quoted(key)).eqNullSafe(F.col("__key")))
    return tagged.select(*named(df.columns), "page")


def seek_page(df: DataFrame, key: str, after: Any, limit: int) -> DataFrame:
    """The ``limit`` rows that follow the key value ``after``; from the start if it is None.

    All rows of the last key are returned, so that a walk from last key to last key sees every
    row once; a page can be longer than ``limit`` by them. NULL keys come last, all on the last
    page: a walk ends at a page without rows or whose last key is NULL. The last key of a long page is found
    as by :func:`offset_page`, which reads the keys several times.
    """
    k = F.col(quoted(key))
    rest = df if after is None else df.filter((k > F.lit(after)) | k.isNull())
    place = sortable(df.schema[key].dataType, k)
    keys, skip = rest.select(place.alias("k")), max(limit, 1) - 1
    if skip <= NEAR:
        last = keys.orderBy(F.col("k").asc_nulls_last()).offset(skip).limit(1).first()
    else:
        last = offset_page(keys.where("k is not null"), ["k"], skip, 1).first()
    if limit < 1:
        rest = rest.limit(0)
    elif last is not None and last.k is not None:
        rest = rest.filter(place <= F.lit(last.k))
    return rest.orderBy(k.asc_nulls_last())


def offset_page(
    df: DataFrame,
    order_by: Sequence[str],
    offset: int,
    limit: int,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` of the given ascending order, NULL first.

    The page's place is found at any depth by sketches and exact counts (:mod:`brackets`), and only the
    rows of a bracket around it are sorted, about ``rows_per_bucket`` at most. Rows that tie keep the order of
    the input, so a frequent value spreads over many tasks. ``df`` is read several times
    and must stay the same meanwhile. :func:`seek_page` needs no such search.
    """
    held = brackets(df, order_by, offset, offset + limit, rows_per_bucket) if limit > 0 else []
    if not held:
        return df.limit(0)
    number, at = "__number", "__at"
    parts = []
    for part in held:
        # Few rows, which numbering reads twice; ties keep the order of the input.
        inside = stage(df.filter(part.inside).withColumn(at, F.monotonically_increasing_id()), "bracket")
        numbered = number_in_order(inside, [*named(order_by), F.col(at)], number, part.before)
        parts.append(numbered.filter((F.col(number) >= part.first) & (F.col(number) < part.end)))
    return reduce(DataFrame.unionAll, parts).orderBy(number).drop(number, at)
