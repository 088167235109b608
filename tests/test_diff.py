"""Rows that differ, against a full comparison by key."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import demo_queries
from tablehaul import FrameTables, ParquetTables, compare_values, diff_rows
from tablehaul.plans import diff

SHAPE = "k long, s string, d double, n decimal(10,2), a array<int>, m map<string,int>, t timestamp"


def plain(ours, theirs, width):
    def by_key(rows):
        found = {}
        for r in rows:
            found.setdefault(r[:width], Counter())[repr(r)] += 1
        return found

    one, two, out = by_key(ours), by_key(theirs), {}
    for k in one.keys() | two.keys():
        a, b = one.get(k, Counter()), two.get(k, Counter())
        if a != b:
            out[k] = ("missing" if not b else "extra" if not a else "changed", a.total(), b.total())
    return out


def found(df, width):
    return {tuple(r[:width]): (r.change, r.source_rows, r.target_rows) for r in df.collect()}


def made(seed, n=3000):
    import datetime
    import decimal

    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = None if i % 400 == 7 else i if i % 3 else 55  # a third of the rows share one key
        rows.append((
            k, rnd.choice([None, "", "x", "y" * 40]), rnd.choice([None, 0.0, float("nan"), 1.5]),
            rnd.choice([None, decimal.Decimal("1.10")]), rnd.choice([None, [], [1, None], [None, 1]]),
            rnd.choice([None, {"a": 1}, {"a": None}]), datetime.datetime(2020, 1, 1) if i % 2 else None,
        ))
    return rows


@pytest.mark.parametrize("few", [1_000_000, 20, 1])
def test_differences_at_every_depth_of_the_tree(spark, few):
    ours = made(1)
    theirs = [r for i, r in enumerate(ours) if i not in (5, 6, 900)]
    theirs[40] = (theirs[40][0], "other", *theirs[40][2:])
    theirs[41] = (*theirs[41][:4], [1, None] if theirs[41][4] != [1, None] else [None, 1], *theirs[41][5:])
    theirs += [(10**6, "new", None, None, None, None, None), ours[8], (None, "q", None, None, None, None, None)]
    random.Random(2).shuffle(theirs)
    a, b = spark.createDataFrame(ours, SHAPE), spark.createDataFrame(theirs, SHAPE).repartition(5)
    got = found(diff_rows(a, b, ["K"], few_rows=few, cells=256), 1)
    assert got == plain(ours, theirs, 1) and len(got) >= 6
    assert found(diff_rows(a, a.repartition(3), ["k"], few_rows=few), 1) == {}
    assert found(diff_rows(a, b.limit(0), ["k"]), 1) == plain(ours, [], 1)
    assert found(diff_rows(a.limit(0), b, ["k"]), 1) == plain([], theirs, 1)
    assert found(diff_rows(a.limit(0), b.limit(0), ["k"]), 1) == {}


def test_whole_rows_are_keys_without_any(spark):
    ours = [(1, "a"), (1, "a"), (2, None), (None, "b"), (3, "c")]
    theirs = [(1, "a"), (2, None), (None, "b"), (None, "b"), (4, "c")]
    shape = "k int, s string"
    got = found(diff_rows(spark.createDataFrame(ours, shape), spark.createDataFrame(theirs, shape)), 2)
    assert got == {
        (1, "a"): ("changed", 2, 1), (None, "b"): ("changed", 1, 2), (3, "c"): ("missing", 1, 0), (4, "c"): ("extra", 0, 1),
    }


def test_columns_that_differ_are_named_and_types_may_differ(spark):
    a = spark.createDataFrame([(1, 2, "x"), (2, 3, None), (3, 4, "z")], "id int, n int, s string")
    b = spark.createDataFrame([("x", 2, 1), (None, 9, 2), ("y", 5, 3)], "S string, N long, ID long")
    got = {r.id: r["columns"] for r in diff_rows(a, b, ["id"]).collect()}
    assert got == {2: ["n"], 3: ["n", "s"]}
    with pytest.raises(ValueError, match="one side only"):
        diff_rows(a, b.drop("N"), ["id"])
    with pytest.raises(ValueError, match="no key columns"):
        diff_rows(a, b, ["nothing"])


@pytest.mark.parametrize("key", ["id", "name", "day", "at"])
def test_equal_ranges_are_not_read_again(spark, tmp_path, key):
    rows = spark.range(64_000).select(
        "id", F.format_string("n%08d", "id").alias("name"), F.date_add(F.lit("2000-01-01"), F.col("id").cast("int")).alias("day"),
        F.timestamp_seconds(F.col("id") * 3600).alias("at"), (F.col("id") % 7).alias("v"),
    )
    rows.repartitionByRange(64, key).sortWithinPartitions(key).write.parquet(f"{tmp_path}/a")
    changed = rows.withColumn("v", F.when(F.col("id").isin(5, 40_000), -1).otherwise(F.col("v")))
    changed.repartitionByRange(64, key).sortWithinPartitions(key).write.parquet(f"{tmp_path}/b")
    a, b = spark.read.parquet(f"{tmp_path}/a"), spark.read.parquet(f"{tmp_path}/b")
    assert {r.id for r in diff_rows(a, b, ["id"] if key == "id" else [key, "id"]).collect()} == {5, 40_000}
    digit = diff.column_digits(key, a.schema[key].dataType)[0]
    edges = tuple(sorted(set(diff.quantiles(a, digit.code, 64)[1:-1])))
    sides = diff.Sides(a, b, (key,), digit, edges)
    cells = diff._cells(sides, tuple(diff._marked(sides, df) for df in sides.both()), 4)
    again = [df.where(diff._of_ranges(sides, cells)) for df in sides.both()]
    assert [df.select("id").distinct().count() < 64_000 // 10 for df in again] == [True, True]
    if key != "at":
        for df in again:
            assert "PushedFilters: [Or(" in str(df._jdf.queryExecution().executedPlan())
            files = df.select(F.input_file_name()).distinct().count()
            assert files <= 8


def test_values_of_all_tables(spark, tmp_path):
    a = spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string")
    c = spark.createDataFrame([(1, 1), (1, 1)], "x int, y int")
    ours = FrameTables(spark, "one", {"A": a, "c": c, "alone": a, "wide": a})
    theirs = FrameTables(spark, "two", {"a": a.where("id = 1").unionAll(a.selectExpr("id + 5", "s")), "c": c, "wide": a.drop("s")})
    got = [tuple(r) for r in compare_values(ours, theirs, {"a": ["id"]}).collect()]
    assert got == [("A", 1, 2, 0, "N"), ("c", 0, 0, 0, "Y"), ("wide", None, None, None, "N")]
    folder = ParquetTables(spark, str(tmp_path))
    folder.replace("c", c)
    assert compare_values(ours, folder).first().is_success == "Y"


@pytest.mark.parametrize("sent", [1_000_000, 0])
def test_only_keys_that_differ_are_brought_together(spark, monkeypatch, sent):
    a = spark.range(20_000).select(F.nullif(F.col("id") % 4000, F.lit(7)).alias("k"), "id", F.lit("v").alias("v"))
    changed = F.when(F.col("id") % 100 == 3, "w").otherwise(F.col("v"))
    b = a.where("id <> 5000").withColumn("v", changed).repartition(3)
    met, by_key = [], diff._by_key
    monkeypatch.setattr(diff, "SENT_CELLS", sent, raising=False)
    monkeypatch.setattr(diff, "_by_key", lambda sides, read: met.append([df.count() for df in read]) or by_key(sides, read))
    got = {(r.k, r.id): r.change for r in diff_rows(a, b, ["k", "id"], few_rows=10, cells=64).collect()}
    of = lambda i: None if i % 4000 == 7 else i % 4000
    assert got == {(of(i), i): "missing" if i == 5000 else "changed" for i in [*range(3, 20_000, 100), 5000]}
    assert met == [[201, 200]]


def test_a_copy_of_documents_is_dealt_by_more_than_a_language(spark, tmp_path, monkeypatch):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("MIT License").alias("text"), F.lit("en").alias("lang"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    sides = []
    monkeypatch.setattr(demo_queries, "diff_rows", lambda *a: sides.append(a[1]) or diff_rows(*a))
    assert demo_queries.documents_that_differ(spark, str(tmp_path)).count() == 2000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        shares = [r["count"] for r in sides[0].groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(shares) == 1960 and max(shares) < 980
