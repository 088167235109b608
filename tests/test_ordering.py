"""Pages and numbers over keys of every shape."""

import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablehaul import append_with_sequence, offset_page, page_bounds, seek_page, tag_pages
from tablehaul.operators import paging
from tablehaul.operators.brackets import brackets
from tablehaul.operators.ordering import key_ranges, number_in_order, sortable
from tablehaul.operators.sinks import clustered


def _frame(spark, values, kind):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("k", kind)]))


def _mixed(make, n, hot_share, nulls, seed):
    """``n`` keys of which one holds ``hot_share``, and some NULLs."""
    chance = random.Random(seed)
    hot = make(chance.randrange(n))
    keys = [hot if chance.random() < hot_share else make(chance.randrange(n)) for _ in range(n)]
    return keys + [None] * nulls


SHAPES = {
    "long": (T.LongType(), lambda i: i * 7 - 500),
    "outlier": (T.LongType(), lambda i: 10**17 if i % 50 == 0 else i),
    "text": (T.StringType(), lambda i: f"http://example.org/é{i}"),
    "date": (T.DateType(), lambda i: datetime.date(2001, 1, 1) + datetime.timedelta(days=i)),
    "wall clock": (
        T.TimestampNTZType(),
        lambda i: datetime.datetime(2024, 3, 31) + datetime.timedelta(seconds=i * 17.25),
    ),
    "instant": (
        T.TimestampType(),
        lambda i: datetime.datetime(2024, 3, 31) + datetime.timedelta(minutes=i),
    ),
    "decimal": (T.DecimalType(20, 3), lambda i: Decimal(i) / 8),
    "double": (T.DoubleType(), lambda i: i / 3),
    "binary": (T.BinaryType(), lambda i: i.to_bytes(3, "big")),
}


def _expected_pages(keys, page_size):
    """Pages by brute force: each key on the page of its first row, numbered densely."""
    # NULL first, then the order of the values.
    ordered = sorted(set(keys), key=lambda k: (k is not None, k if k is not None else 0))
    raw, before = {}, 0
    for key in ordered:
        raw[key] = before // page_size
        before += keys.count(key)
    dense = {page: i for i, page in enumerate(sorted(set(raw.values())))}
    return {key: dense[page] for key, page in raw.items()}


@pytest.mark.parametrize("hot_share", [0, 1 / 3])
@pytest.mark.parametrize("shape", SHAPES)
def test_pages_partition_the_table(spark, shape, hot_share):
    kind, make = SHAPES[shape]
    keys = _mixed(make, 400, hot_share, 5, shape)
    df = _frame(spark, keys, kind)
    expected = _expected_pages([bytes(k) if isinstance(k, bytearray) else k for k in keys], 30)
    bounds = page_bounds(df, "k", 30, 4, rows_per_bucket=20).orderBy("page").collect()
    assert [b.page for b in bounds] == list(range(max(expected.values()) + 1))
    assert sum(b.n_rows for b in bounds) == len(keys)
    assert sorted({b.shard for b in bounds}) == list(range(min(4, len(bounds))))
    assert [b.shard for b in bounds] == sorted(b.shard for b in bounds)
    ends = [(b.lo, b.hi) for b in bounds if b.lo is not None]
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))
    found = tag_pages(df, "k", 30, rows_per_bucket=20).collect()
    assert len(found) == len(keys)
    assert {(bytes(r.k) if isinstance(r.k, bytearray) else r.k): r.page for r in found} == expected


@pytest.mark.parametrize("n", [1, 99, 100, 101, 200])
def test_unique_keys_fill_pages(spark, n):
    df = spark.range(n).withColumnRenamed("id", "k")
    bounds = page_bounds(df, "k", 100, 3, rows_per_bucket=10).orderBy("page").collect()
    assert len(bounds) == -(-n // 100)
    assert all(b.n_rows == 100 for b in bounds[:-1])


def test_no_rows_no_pages(spark):
    df = spark.createDataFrame([], "k bigint")
    assert page_bounds(df, "k", 10, 2).count() == 0
    assert tag_pages(df, "k", 10).count() == 0


def test_only_null_keys(spark):
    bounds = page_bounds(_frame(spark, [None] * 7, T.LongType()), "k", 3, 2).collect()
    assert [tuple(b) for b in bounds] == [(0, None, None, 7, 0)]


def test_ranges_follow_the_number_of_keys(spark):
    for keys in (1000, 4000):
        ranges = key_ranges(spark.range(keys), ["id"], 20)
        assert sum(ranges.sizes) == keys and len(ranges.sizes) > 0.8 * keys / 20
    hot = key_ranges(spark.range(9000).selectExpr("if(id < 3000, 7, id) as k"), ["k"], 100)
    assert sum(hot.sizes) == 9000 and hot.keys.filter("k = 7").first()["__count"] == 3000
    assert max(r["count"] for r in hot.keys.groupBy("__part").count().collect()) < 400


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_wall_clock_times_keep_their_order(spark, zone):
    kept = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    times = ["0001-01-01 00:00:00.5", "1969-12-31 23:59:59.999999", "2024-03-10 01:59:59.999999",
             "2024-03-10 02:30:00", "2024-03-10 03:30:00", "9999-12-31 00:00:00", "+10000-01-01 00:00:00"]
    try:
        df = spark.createDataFrame(list(enumerate(times)), "i int, s string")
        df = df.withColumn("k", F.col("s").cast("timestamp_ntz"))
        place = sortable(T.TimestampNTZType(), F.col("k"))
        assert [r.i for r in df.orderBy(place).select("i").collect()] == list(range(7))
        assert df.filter("i = 1").select(place).first()[0] == -1
        assert [r.i for r in offset_page(df, ["k"], 5, 2).select("i").collect()] == [5, 6]
    finally:
        spark.conf.set("spark.sql.session.timeZone", kept)


def test_a_filter_on_pages_stays_a_small_plan(spark, plan):
    found = tag_pages(_frame(spark, range(3000), T.LongType()), "k", 10, rows_per_bucket=50)
    found = found.filter("page = 7")
    assert sorted(r.k for r in found.collect()) == list(range(70, 80))
    assert "SinglePartition" not in plan(found) and "Python" not in plan(found)


def test_ranking_a_large_input_is_not_one_task(spark, plan):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    text = plan(key_ranges(df, ["o_orderkey"], 100).first_rows())
    assert "SinglePartition" not in text and "Python" not in text
    assert text.count("Exchange hashpartitioning") == 1


def test_numbers_are_dense_when_nearly_all_rows_tie(spark):
    df = spark.range(0, 3000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("o"), F.col("id").alias("v")
    )
    numbered = number_in_order(df, [F.col("o")], "n", 11).orderBy("n").collect()
    assert [r.n for r in numbered] == list(range(11, 3011))
    assert [r.o for r in numbered] == sorted(r.o for r in numbered)
    assert sorted(r.v for r in numbered) == list(range(3000))


def test_ties_are_spread_over_tasks(spark):
    df = spark.range(0, 4000, 1, 8).select(F.lit("same").alias("o"), "id")
    sizes = clustered(df, ["o"], files=8).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) <= 1000


@pytest.mark.parametrize("start,first", [(None, 8), (3, 8), (50, 50)])
def test_append_starts_after_what_is_there(spark, start, first):
    existing = spark.createDataFrame([(3, "a"), (7, "b")], "id int, s string")
    new = spark.createDataFrame([("y",), ("x",)], "s string")
    got = append_with_sequence(existing, new, "id", ["s"], start)
    assert got.schema == existing.schema
    assert {(r.id, r.s) for r in got.collect()} == {
        (3, "a"), (7, "b"), (first, "x"), (first + 1, "y"),
    }


def test_append_keeps_keys_that_are_supplied(spark):
    existing = spark.createDataFrame([], "id bigint, s string")
    new = spark.createDataFrame([(None, "b"), (40, "own"), (None, "a")], "id bigint, s string")
    got = append_with_sequence(existing, new, "id", ["s"])
    assert {(r.id, r.s) for r in got.collect()} == {(40, "own"), (41, "a"), (42, "b")}


@pytest.mark.parametrize("hot_share", [0, 1 / 3])
def test_deep_offsets(spark, hot_share):
    keys = _mixed(lambda i: i * 3, 500, hot_share, 20, "deep")
    df = spark.createDataFrame(list(enumerate(keys)), "v bigint, k bigint")
    ordered = sorted(enumerate(keys), key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    for offset, limit in ((31, 1), (100, 50), (200, 250), (519, 5), (520, 5), (900, 5), (31, 0)):
        page = offset_page(df, ["k", "v"], offset, limit, rows_per_bucket=30)
        assert [(r.v, r.k) for r in page.collect()] == ordered[offset : offset + limit]


def test_deep_offsets_behind_a_hot_first_column(spark, plan):
    """No task sorts what lies before the page, whichever column tells the rows apart."""
    df = spark.range(4000).selectExpr("id % 2 as k", "id as v", "cast(null as int) as page")
    ordered = sorted((i % 2, i) for i in range(4000))
    for offset in (0, 1990, 3995):
        page = offset_page(df, ["k", "v"], offset, 20, rows_per_bucket=100)
        assert [(r.k, r.v) for r in page.collect()] == ordered[offset : offset + 20]
        assert "TakeOrdered" not in plan(page) and "Limit" not in plan(page)


def test_offset_pages_of_rows_that_all_tie_hold_every_row_once(spark):
    df = spark.range(0, 900, 1, 6).selectExpr("'same' as k", "id")
    pages = [offset_page(df, ["k"], at, 300, rows_per_bucket=10).collect() for at in (0, 300, 600)]
    assert sorted(r.id for page in pages for r in page) == list(range(900))


def test_seek_reads_a_range_of_keys(spark, plan):
    df = spark.range(1000).select(F.col("id").alias("k"))
    page = seek_page(df, "k", 10, 5)  # may be longer than five rows, so it is a range of keys
    assert "(id" in plan(page) and "<= 15" in plan(page)
    assert [r.k for r in page.collect()] == [11, 12, 13, 14, 15]
    assert [r.k for r in seek_page(df, "k", None, 2).collect()] == [0, 1]


def test_seek_page_walks_over_repeated_and_null_keys(spark):
    df = spark.createDataFrame([(k, i) for k in [*range(10), None] for i in range(3)], "k int, i int")
    last, seen = None, []
    while True:
        page = [tuple(r) for r in seek_page(df, "k", last, 4).collect()]
        seen += page
        last = page[-1][0] if page else None
        if last is None:
            break
    assert sorted(seen, key=str) == sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("shape", ["long", "text", "instant", "bytes"])
def test_long_pages_take_no_rows_to_the_driver(spark, monkeypatch, shape):
    kind, make = SHAPES.get(shape, (T.BinaryType(), lambda i: str(i).encode()))
    monkeypatch.setattr(paging, "NEAR", 50)
    frame, skipped = type(spark.range(1)), []
    plain = frame.offset
    monkeypatch.setattr(frame, "offset", lambda self, n: skipped.append(n) or plain(self, n))
    keys = _mixed(make, 600, 0.3, 40, 5)
    df = _frame(spark, keys, kind).repartition(3).cache()
    ordered = sorted(k for k in keys if k is not None)
    for limit in (30, 200, 600, 601, 5000):
        page = [r.k for r in seek_page(df, "k", None, limit).collect()]
        whole = [None] * 40 if limit > len(ordered) else []
        assert page == [k for k in ordered if limit > len(ordered) or k <= ordered[limit - 1]] + whole
    after = ordered[100]
    rest = [k for k in ordered if k > after]
    assert [r.k for r in seek_page(df, "k", after, 120).collect()] == [k for k in rest if k <= rest[119]]
    assert max(skipped) <= 50


def placed(rows, offset, limit):
    """The page of a plain sort, NULL first and NaN last."""
    key = lambda v: (v is not None, v != v if isinstance(v, float) else False, v if v is not None and v == v else 0)
    return sorted(rows, key=lambda r: [key(v) for v in r[:-1]])[offset : offset + limit]


@pytest.mark.parametrize(
    "shape, values",
    [
        ("k double, v long", [None, float("nan"), float("inf"), float("-inf"), -0.0, 0.0, 1.5, 2.5]),
        ("k long, v long", [None, -(2**63), 2**63 - 1, 2**53, 2**53 + 1, 0, -1]),
        ("k string, v long", [None, "", "a", "a\0", "prefix of more than twenty-four bytes 1", "prefix of more than twenty-four bytes 2", "é", "日本"]),
        ("k binary, v long", [None, b"", b"\0", b"\0\0", b"\xff", b"a" * 30, b"a" * 31]),
        ("k boolean, v long", [None, True, False]),
        ("k decimal(38,10), v long", [None, Decimal("1.0000000001"), Decimal("1.0000000002"), Decimal(-5), Decimal(10) ** 20]),
        ("k date, v long", [None, datetime.date(1, 1, 1), datetime.date(2020, 1, 1), datetime.date(9999, 12, 31)]),
        ("k timestamp, v long", [None, datetime.datetime(1900, 1, 1), datetime.datetime(2020, 1, 1, 1, 2, 3, 4)]),
    ],
)
def test_offset_pages_of_every_type_of_key(spark, shape, values):
    rnd = random.Random(4)
    rows = [(rnd.choice(values[: 1 + i % len(values)]), i, i) for i in range(600)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, shape + ", n int").repartition(5)
    for offset, limit in ((0, 7), (250, 40), (590, 50), (600, 5), (100, 450)):
        got = [r.n for r in offset_page(df, ["k", "v"], offset, limit, rows_per_bucket=20).collect()]
        assert got == [r[2] for r in placed(rows, offset, limit)]


def test_offset_pages_sort_only_a_bracket(spark):
    """A frequent first value, a second column of many values, and pages at and across the edges of values."""
    rnd = random.Random(5)
    rows = [(rnd.choice([0, 0, 0, 1]), rnd.randrange(1000), i) for i in range(40_000)]
    df = spark.createDataFrame(rows, "a int, b int, c int").repartition(4)
    ordered = sorted(rows)
    edge = sum(r[0] == 0 for r in rows)
    for offset in (0, 10_000, edge - 30, edge, len(rows) - 40):
        parts = brackets(df, ["a", "b", "c"], offset, offset + 60, 500)
        assert all(df.where(p.inside).count() <= 500 for p in parts)
        assert [tuple(r) for r in offset_page(df, ["a", "b", "c"], offset, 60, 500).collect()] == ordered[offset : offset + 60]
