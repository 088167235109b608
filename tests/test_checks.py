import pytest
from pyspark.sql import functions as F

from tablehaul import (
    Constraint,
    FrameTables,
    check_foreign_key,
    check_primary_key,
    check_unique,
    constraints_from_catalog,
    register_views,
    run_checks,
)
from tablehaul.operators import checks
from tablehaul.operators.checks import dense_enough, repeated_stretches
from tablehaul.operators.views import view_body
from tests.conftest import rows


def test_primary_key(spark):
    df = spark.createDataFrame(
        [(1, "a"), (1, "a"), (1, "b"), (None, "c"), (2, None)], "k int, s string"
    )
    assert sorted(map(str, rows(check_primary_key(df.filter("k is not null"), ["k"])))) == [
        "(1, 3)"
    ]
    found = {(r.k, r.s): r.dup_count for r in check_primary_key(df, ["k", "s"]).collect()}
    assert found == {(1, "a"): 2, (None, "c"): 1, (2, None): 1}


def test_unique_ignores_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x"), (2, "x")], "k int, s string")
    assert rows(check_unique(df, ["k", "s"])) == [(2, "x", 2)]


def test_foreign_key(spark):
    parent = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, "z")], "pk int, ps string")
    child = spark.createDataFrame(
        [(1, "a", 10), (1, "b", 11), (1, "b", 11), (None, "q", 12), (9, None, 13), (2, "b", 14)],
        "k int, s string, v int",
    )
    assert rows(check_foreign_key(child, ["k", "s"], parent, ["pk", "ps"])) == [
        (1, "b", 11), (1, "b", 11),
    ]
    assert [r.v for r in check_foreign_key(child, ["k"], parent, ["pk"]).collect()] == [13]
    with pytest.raises(ValueError):
        check_foreign_key(child, ["k"], parent, ["pk", "ps"])


def test_foreign_key_to_the_same_table(spark):
    staff = spark.createDataFrame([(1, None), (2, 1), (3, 9)], "id int, boss int")
    assert rows(check_foreign_key(staff, ["boss"], staff, ["id"])) == [(3, 9)]


def test_foreign_key_plan_without_broadcast(spark, plan):
    """Only keys are shuffled for the look-up, and a repeated key once per task."""
    child = spark.range(1000).select((F.col("id") % 3).alias("k"), F.lit("wide").alias("w"))
    parent = spark.range(2).withColumnRenamed("id", "p")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = check_foreign_key(child, ["k"], parent, ["p"])
        text = plan(found)
        assert found.count() == 333
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    anti = text[text.index("LeftAnti"):]
    assert "LeftSemi" in text and "partial_" not in text[: text.index("LeftAnti")]
    assert "wide" not in anti and anti.count("HashAggregate") >= 2


def test_run_checks_isolates_failures(spark):
    tables = FrameTables(
        spark, "db", {"t": spark.createDataFrame([(1,), (1,)], "k int"), "u": spark.range(1)}
    )
    outcomes = run_checks(
        tables,
        [
            Constraint("primary key", "t", "PRIMARY", ("k",)),
            Constraint("index", "t", "ix", ("k",)),
            Constraint("index", "t", "ix_gone", ("gone",)),
            Constraint("unique", "absent", "u", ("k",)),
            Constraint("foreign key", "t", "fk", ("k",), "u", ("id",)),
        ],
    )
    assert [(r.constraint_name, r.violations, r.is_success) for r in outcomes.collect()] == [
        ("PRIMARY", 1, "N"), ("ix", 0, "Y"), ("ix_gone", None, "N"), ("u", None, "N"),
        ("fk", 2, "N"),
    ]


def test_constraints_from_the_catalog(spark):
    statistics = spark.createDataFrame(
        [("t", "PRIMARY", 0, "b", 2), ("t", "PRIMARY", 0, "a", 1), ("t", "uq", 0, "c", 1),
         ("t", "ix", 1, "z", 1), ("t", "ix", 1, "y", 2)],
        "table_name string, index_name string, non_unique int, column_name string, "
        "seq_in_index int",
    )
    usage = spark.createDataFrame(
        [("t", "fk1", "d", 2, "p", "y"), ("t", "fk1", "c", 1, "p", "x"),
         ("t", "fk2", "e", 1, "q", "id"), ("u", "fk1", "f", 1, "q", "id"),
         ("t", "PRIMARY", "a", 1, None, None)],
        "table_name string, constraint_name string, column_name string, ordinal_position int, "
        "referenced_table_name string, referenced_column_name string",
    )
    referential = spark.createDataFrame(
        [("t", "fk1"), ("t", "fk2"), ("u", "fk1")], "table_name string, constraint_name string"
    )
    assert constraints_from_catalog(statistics, usage, referential) == [
        Constraint("primary key", "t", "PRIMARY", ("a", "b")),
        Constraint("index", "t", "ix", ("z", "y")),
        Constraint("unique", "t", "uq", ("c",)),
        Constraint("foreign key", "t", "fk1", ("c", "d"), "p", ("x", "y")),
        Constraint("foreign key", "t", "fk2", ("e",), "q", ("id",)),
        Constraint("foreign key", "u", "fk1", ("f",), "q", ("id",)),
    ]


@pytest.mark.parametrize(
    "text,body",
    [
        ("create view `v` as select 1", "select 1"),
        ("CREATE ALGORITHM=MERGE DEFINER=`VIEW`@`%` SQL SECURITY INVOKER VIEW `a b` AS select 1;",
         "select 1"),
        ("select 'CREATE VIEW x AS y' AS `t`", "select 'CREATE VIEW x AS y' AS `t`"),
        ("create view v as select 'a view v as b' from t", "select 'a view v as b' from t"),
        ("select convert(`a` using utf8mb4) from t", "select `a` from t"),
        ("select CONVERT( f(convert(a using utf8), ')') USING latin1 ) from t",
         "select  f(a, ')') from t"),
        ("select convert(a, char) from t", "select convert(a, char) from t"),
        ("select 'it''s convert(a using utf8)', 'x\\' convert(b using c)' from t",
         "select 'it''s convert(a using utf8)', 'x\\' convert(b using c)' from t"),
    ],
)
def test_view_text(text, body):
    assert view_body(text) == body


def test_views_in_any_order(spark):
    tables = FrameTables(spark, "db", {"t": spark.range(4)})
    outcomes = register_views(
        tables,
        {
            "v3": "select * from v2",
            "v2": "select * from v1 where (id > 1)",
            "v1": "select id from t",
            "bad": "select * from gone",
        },
    )
    assert [(r.view_name, r.is_success) for r in outcomes.collect()] == [
        ("v3", "Y"), ("v2", "Y"), ("v1", "Y"), ("bad", "N"),
    ]
    assert "gone" in outcomes.filter("view_name = 'bad'").first().error
    assert tables.read_view("v3").count() == 2
    assert tables.view_names() == ["v1", "v2", "v3"]


def test_comma_join_becomes_an_equi_join(spark, plan):
    tables = FrameTables(
        spark, "db", {n: spark.range(5).withColumnRenamed("id", n) for n in ("a", "b", "c")}
    )
    register_views(
        tables,
        {"v": "select a from ((`a` join `b`) join `c` on(((c = a) and (c = b)))) where (a = b)"},
    )
    text = plan(tables.read_view("v"))
    assert "Cartesian" not in text and "NestedLoop" not in text


def shuffled(spark, df):
    """Bytes that the plan of a finished query has shuffled."""
    df.collect()
    total, open_ones = 0, [df._jdf.queryExecution().executedPlan()]
    while open_ones:
        node = open_ones.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            open_ones.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            open_ones.append(node.plan())
        if name == "Exchange":
            total += node.metrics().apply("shuffleBytesWritten").value()
        children = node.children()
        open_ones += [children.apply(i) for i in range(children.size())]
    return total


def test_unique_keys_in_order_are_not_shuffled(spark, tmp_path, monkeypatch):
    spark.range(0, 2_000_000, 1, 4).select((F.col("id") - 1_000_000).alias("k"), "id").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert dense_enough(df, "k")
    for check in (check_primary_key, check_unique):
        checked = check(df, ["K"])
        less = shuffled(spark, checked)
        assert checked.count() == 0
        with monkeypatch.context() as patch:
            patch.setattr(checks, "LESS", 10**9)
            whole = check(df, ["k"])
            assert "bitmap" not in str(whole._jdf.queryExecution().analyzed().toString())
            assert shuffled(spark, whole) > 10 * less


def test_keys_in_bitmaps_that_occur_again(spark, tmp_path):
    again = [-1_000_000, -32768, -1, 0, 1, 32768, 32769, 5, 5]
    once = spark.range(0, 400_000, 1, 2).select((F.col("id") - 200_000).cast("int").alias("k"))
    extra = spark.createDataFrame([(k,) for k in [*again, None, None, 2**31 - 1, -(2**31)]], "k int")
    df = once.unionAll(extra.coalesce(1))
    assert not dense_enough(df.repartition(50), "k")
    for frame in (df, df.repartition(3)):
        want = {(-32768, 2), (-1, 2), (0, 2), (1, 2), (32768, 2), (32769, 2), (5, 3)}
        assert set(map(tuple, check_unique(frame, ["k"]).collect())) == want
        assert set(map(tuple, check_primary_key(frame, ["k"]).collect())) == want | {(None, 2)}
    stretches = repeated_stretches(df, "k")
    assert {r.bucket for r in stretches.collect()} == {r[0] for r in df.where("k in (-32768, -1, 0, 1, 5, 32768, 32769)").select(
        F.bitmap_bucket_number(F.col("k").cast("bigint"))).distinct().collect()}
    assert check_unique(df.limit(0), ["k"]).count() == 0
