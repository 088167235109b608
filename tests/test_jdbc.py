"""The JDBC text that can be checked without a database: Spark itself reads the MySQL dialect."""

import dataclasses
import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from demo_queries import SparkServer
from tablehaul import (
    MYSQL,
    MYSQL_57,
    POSTGRESQL,
    AutoColumn,
    ColumnSpec,
    JdbcTables,
    JobConf,
    Constraint,
    FrameTables,
    page_bounds,
    read_partitioned,
    register_views,
    run_checks,
    sequence_starts,
)
from tablehaul.operators.paging import shard_bounds
from tablehaul.sources import jdbc
from tablehaul.sources.jdbc import (
    PLACE,
    column_record,
    paging_key,
    paging_keys,
    reading_shards,
    shard_predicates,
    shard_start_sql,
    writing_tasks,
)
from tablehaul.sources.keysets import keyset_predicates, places, probe_sql, probed_starts


def _each_row_once(df, predicates):
    hits = sum((F.expr(f"CASE WHEN {p} THEN 1 ELSE 0 END") for p in predicates), F.lit(0))
    return [r[0] for r in df.select(hits).distinct().collect()] == [1]


@pytest.mark.parametrize("table,key", [("orders", "o_orderkey"), ("lineitem", "l_orderkey"),
                                       ("customer", "c_name"), ("events", "ts"),
                                       ("lineitem", "l_linenumber")])
def test_predicates_hold_every_row_once(spark, table, key):
    df = spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet")
    bounds = page_bounds(df, key, 100, 5, rows_per_bucket=100)
    starts = [lo for lo, _, _ in shard_bounds(bounds)]
    predicates = shard_predicates(key, starts, MYSQL)
    assert 1 < len(predicates) <= 5
    assert _each_row_once(df, predicates)


def test_predicates_with_null_and_equal_starts(spark):
    df = spark.createDataFrame([(None,), (-5,), (1,), (2,), (3,), (99,)], "k int")
    for starts in ([], [1], [None, 2], [1, 2, 2, 3], [1, 1]):
        predicates = shard_predicates("k", starts, MYSQL)
        assert len(predicates) == max(1, 1 + len({s for s in starts[1:] if s is not None}))
        assert _each_row_once(df, predicates)


def test_equal_parts_by_the_database(spark):
    spark.range(100).select((F.col("id") * 3).alias("k")).createOrReplaceTempView("parts")
    found = spark.sql(shard_start_sql("parts", "k", 4, MYSQL)).orderBy("shard").collect()
    assert [(r.lo, r.n_rows) for r in found] == [(0, 25), (75, 25), (150, 25), (225, 25)]


@pytest.mark.parametrize(
    "value",
    [1, -2.5, Decimal("1.10"), True, "it's", "ä\"`", "back\\slash\\", datetime.date(2020, 2, 29),
     datetime.datetime(2020, 1, 1, 1, 2, 3, 456), b"\x00\xff"],
)
def test_literals(spark, value):
    assert spark.sql(f"SELECT {MYSQL.literal(value)} AS v").first().v in (
        value, Decimal(str(value)) if isinstance(value, float) else value
    )


def test_backslashes_as_the_dialect_has_them():
    assert POSTGRESQL.literal("a\\b") == "'a\\b'"
    assert MYSQL.literal("a\\b") == "'a\\\\b'"


def test_names_are_quoted():
    assert MYSQL.name("a`b") == "`a``b`"
    assert POSTGRESQL.name('a"b') == '"a""b"'


def _key(name, key="", extra=""):
    return {"column_name": name, "column_key": key, "extra": extra}


@pytest.mark.parametrize(
    "keys,wanted",
    [
        ([_key("id", "PRI"), _key("n", "", "auto_increment")], "id"),
        ([_key("a", "PRI"), _key("b", "PRI")], None),
        ([_key("a", "PRI"), _key("b", "PRI"), _key("n", "UNI", "auto_increment")], "n"),
        ([_key("n", "MUL", "auto_increment")], "n"),
        ([_key("a")], None),
        ([], None),
    ],
)
def test_paging_key(keys, wanted):
    assert paging_key(keys) == wanted


@pytest.mark.parametrize(
    "rows,shards", [(0, 1), (1, 1), (100, 1), (101, 2), (399, 4), (10**12, 4)]
)
def test_small_tables_use_few_connections(rows, shards):
    assert reading_shards(rows, 100, 4) == shards


def test_large_tables_get_as_many_tasks_as_their_rows_ask_for():
    assert reading_shards(10**9, 5000, 4, 5_000_000) == 200
    assert reading_shards(10**6, 5000, 4, 5_000_000) == 4
    assert reading_shards(9, 5, 4, 1) == 2
    assert writing_tasks(10**9, JobConf()) == 200 and writing_tasks(0, JobConf()) == 4
    assert writing_tasks(10**9, JobConf(max_connections=30)) == 30
    assert writing_tasks(10**9, JobConf(rows_per_task=None)) == 4
    with pytest.raises(ValueError, match="max_connections"):
        JobConf(max_connections=0)


def test_paging_keys_of_several_columns_are_in_the_keys_own_order():
    keys = [{**_key("a", "PRI"), "position": Decimal(2)}, {**_key("b", "PRI"), "position": 1}, _key("c")]
    assert paging_keys(keys) == ("b", "a")
    assert paging_keys([*keys, _key("n", "UNI", "auto_increment")]) == ("n",)
    assert paging_keys([_key("id", "PRI")]) == ("id",) and paging_keys([_key("a")]) == ()


def test_column_record():
    row = {
        "column_name": "n", "data_type": "int", "character_maximum_length": None,
        "is_nullable": "NO", "column_default": None, "numeric_precision": Decimal(10),
        "numeric_scale": 0, "datetime_precision": None, "column_key": "PRI",
        "column_comment": "", "column_type": "int(10) unsigned", "extra": "auto_increment",
    }
    assert column_record(row) == ColumnSpec(
        "n", "int", is_nullable=False, numeric_precision=10, numeric_scale=0, column_key="PRI",
        unsigned=True, auto_increment=True,
    )


class CatalogOnly(JdbcTables):
    """A database whose catalog answers from given rows."""

    def query(self, sql):
        for word, frame in self.answers.items():
            if f"information_schema.{word}" in sql:
                return frame
        raise AssertionError(sql)


@pytest.fixture
def shop(spark):
    tables = CatalogOnly(spark, "jdbc:x:y", {}, MYSQL, "shop")
    tables.answers = {
        "statistics": spark.createDataFrame(
            [("orders", "PRIMARY", 0, "id", 1), ("orders", "ix", 1, "day", 1)],
            "table_name string, index_name string, non_unique int, column_name string, "
            "seq_in_index int",
        ),
        "key_column_usage": spark.createDataFrame(
            [("fk", "orders", "customer", 1, "customers", "id")],
            "constraint_name string, table_name string, column_name string, "
            "ordinal_position int, referenced_table_name string, referenced_column_name string",
        ),
        "referential_constraints": spark.createDataFrame(
            [("orders", "fk")], "table_name string, constraint_name string"
        ),
        "columns c": spark.createDataFrame(
            [("orders", "id", Decimal(91)), ("logs", "n", None)],
            "table_name string, column_name string, next_value decimal(20,0)",
        ),
        "tables": spark.createDataFrame(
            [("orders",), ("DATA_COMPARE",), ("orders__rejected",)], "table_name string"
        ),
        "views": spark.createDataFrame([("v", "select 1")], "view_name string, body string"),
    }
    return tables


def test_catalog_of_a_database(shop):
    assert [(c.kind, c.name, c.columns, c.parent) for c in shop.constraints()] == [
        ("primary key", "PRIMARY", ("id",), ""), ("index", "ix", ("day",), ""),
        ("foreign key", "fk", ("customer",), "customers"),
    ]
    assert shop.auto_columns() == [AutoColumn("logs", "n"), AutoColumn("orders", "id", 91)]
    assert shop.table_names() == ["orders"] and shop.resolve("ORDERS") == "orders"
    assert shop.view_definitions() == {"v": "select 1"}
    assert shop.spelled("Orders") == "orders" and shop.spelled("New") == "New"


def test_new_tables_of_a_folding_server(spark, shop):
    folding = CatalogOnly(spark, "jdbc:x:y", {}, POSTGRESQL, "shop")
    folding.answers = shop.answers
    assert folding.spelled("New") == "new" and folding.constraints() == []


class Collated(JdbcTables):
    """A database that compares text without regard to case; Spark plays its part."""

    def query(self, sql):
        return self.spark.sql(sql)

    def all_names(self):
        return ["names"]

    def _frame(self, name):
        return self.spark.table(name)

    def _read_ranges(self, table, predicates):
        hits = sum((F.expr(f"CASE WHEN {p} THEN 1 ELSE 0 END") for p in predicates), F.lit(0))
        return self._frame(table).withColumn("hits", hits)


def test_text_ranges_are_the_databases_own(spark):
    names = spark.createDataFrame([(c * n,) for c in "AaBbCcDd" for n in range(1, 21)], "name string")
    names.selectExpr("name COLLATE UTF8_LCASE AS name").createOrReplaceTempView("names")
    bounds = page_bounds(names, "name", 20, 4)
    for ntile in (True, False):
        tables = Collated(spark, "jdbc:x:y", {}, dataclasses.replace(MYSQL, has_ntile=ntile), "shop")
        found = read_partitioned(tables, "names", "name", bounds)
        assert found.count() == 160
        if ntile:
            assert [r.hits for r in found.select("hits").distinct().collect()] == [1]


def test_views_on_a_database_are_registered_with_spark(spark, shop):
    spark.range(3).createOrReplaceTempView("kept_rows")
    outcomes = register_views(shop, {"w": "select id from `src`.`kept_rows`"}, "src").collect()
    assert [r.is_success for r in outcomes] == ["Y"]
    assert shop.view_names() == ["v", "w"] and shop.read_view("w").count() == 3


def test_options_and_secrets(spark):
    login = {"user": "u", "password": "secret", "driver": "org.example.Driver"}
    tables = JdbcTables(spark, "jdbc:x:y", login, POSTGRESQL, "db", JobConf(fetchsize=77))
    assert "secret" not in repr(tables)
    reading = tables.read_options()
    assert reading["fetchsize"] == "77" and "datestyle" in reading["sessionInitStatement"]
    writing = tables.write_options(99, 3)
    assert (writing["batchsize"], writing["numPartitions"], writing["truncate"]) == (
        "99", "3", "true",
    )
    assert not tables.reads_repeat()


class Served(JdbcTables):
    """A database whose queries Spark answers over given frames, and whose statements change these."""

    def __init__(self, spark, frames, dialect, conf=JobConf()):
        super().__init__(spark, "", {}, dialect, "shop", conf)
        self.frames = frames
        self.log = []

    def query(self, sql):
        self.log.append(sql)
        if "information_schema" in sql:
            return self.spark.createDataFrame(self.keys, "column_name string, column_key string, extra string, position int")
        for name, frame in self.frames.items():
            frame.createOrReplaceTempView(name)
        return self.spark.sql(sql.replace(self.dialect.quote, "`"))

    def all_names(self):
        self._names = sorted(self.frames)
        return [n for n in self._names if not n.endswith(jdbc.LOADING_SUFFIX)]

    def _frame(self, name):
        return self.frames[name]

    def _read_ranges(self, table, predicates):
        frame = self.frames[table]
        parts = [frame.where(p.replace(self.dialect.quote, "`")).withColumn("shard", F.lit(i)) for i, p in enumerate(predicates)]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionAll(part)
        return whole

    def execute(self, statements):
        after = dict(self.frames)
        for sql in statements:
            self.log.append(sql)
            words = sql.replace(self.dialect.quote, " ").replace("(", " ( ").split()
            if words[0] == "DROP":
                after.pop(words[2])
            elif words[0] == "DELETE":
                after[words[2]] = after[words[2]].limit(0)
            elif words[0] == "CREATE":
                after[words[2]] = self.query(sql[sql.index("SELECT") :].replace("AS SIGNED", "AS BIGINT"))
            else:
                shape = after[words[2]].schema
                after[words[2]] = self.spark.createDataFrame(self.query(sql[sql.index("SELECT") :]).collect(), shape)
        self.frames = after

    def _append(self, df, table, conf, tasks):
        self.tasks = tasks
        again = df.where(F.spark_partition_id() == 1) if self.repeats else df.limit(0)
        lost = df.where(F.spark_partition_id() != self.loses)
        self.frames[table] = self.spark.createDataFrame(lost.unionAll(again).collect(), df.schema)

    repeats, loses = False, -1


@pytest.mark.parametrize("dialect", [MYSQL, MYSQL_57, POSTGRESQL], ids=["mysql", "mysql57", "postgresql"])
@pytest.mark.parametrize("shards", [2, 7, 16])
def test_keys_of_several_columns_are_cut_evenly(spark, dialect, shards):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").dropDuplicates(["l_orderkey", "l_linenumber"])
    tables = Served(spark, {"lineitem": lines}, dialect, JobConf(page_size=1, read_parallelism=shards))
    tables.keys = [("l_linenumber", "PRI", "", 2), ("l_orderkey", "PRI", "", 1)]
    found = tables.scan("lineitem", tables.conf)
    sizes = [r["count"] for r in found.groupBy("shard").count().collect()]
    assert len(sizes) == shards and max(sizes) - min(sizes) <= 1 and sum(sizes) == lines.count()
    assert found.select("l_orderkey", "l_linenumber").distinct().count() == lines.count()
    probes = [q for q in tables.log if "OFFSET" in q]
    assert len(probes) == (0 if dialect.has_ntile else shards - 1)


def test_keys_of_dates_texts_and_repeated_values(spark):
    rows = [(datetime.date(2020, 1, 1 + i % 3), "x'" * (i % 5), i % 2) for i in range(300)]
    frame = spark.createDataFrame(rows, "d date, s string, n int")
    tables = Served(spark, {"t": frame}, MYSQL_57, JobConf(page_size=1, read_parallelism=8))
    found = read_partitioned(tables, "t", ["d", "s", "n"])
    assert found.count() == 300 and found.select("shard").distinct().count() > 4
    assert found.groupBy("d", "s", "n").agg(F.count_distinct("shard").alias("n2")).where("n2 > 1").count() == 0


def test_probes_of_a_table_that_shrinks():
    keys = list(range(50))  # of 100 rows that were counted

    def ask(probes):
        at = [(0 if low is None else keys.index(low[0])) + skip for low, skip in probes]
        return [(keys[i],) if i < len(keys) else None for i in at]

    starts = [s[0] for s in probed_starts(ask, 100, 10)]
    assert starts == [10, 20, 30, 40] and places(100, 4) == [0, 25, 50, 75]
    assert probed_starts(ask, 0, 1) == []
    assert keyset_predicates(["a", "b"], [(None,), (1, None)], MYSQL) == ["1 = 1"]


@pytest.fixture
def loads(spark, monkeypatch):
    def create(df, target, table, batch, parallelism):
        target.frames[table] = df

    monkeypatch.setattr(jdbc, "write_jdbc", create)
    old = spark.createDataFrame([(0, "old")], "id int, s string")
    return Served(spark, {"t": old}, POSTGRESQL), spark.range(0, 40, 1, 4).selectExpr("cast(id as int) id", "concat('r', id) s")


def test_a_load_is_published_whole(loads):
    tables, new = loads
    for name in ("T", "fresh"):
        tables.replace(name, new)
        assert sorted(map(tuple, tables.frames[name.lower()].collect())) == sorted(map(tuple, new.collect()))
    assert sorted(tables.frames) == ["fresh", "t"] and not any("DISTINCT \"load_place\", \"id\"" in q for q in tables.log)
    at = [q.split(" ")[0] for q in tables.log if q.split(" ")[0] in ("CREATE", "DELETE", "INSERT", "DROP")]
    assert at == ["CREATE", "DELETE", "INSERT", "DROP"] * 2


def test_a_task_that_ran_twice_counts_once(loads):
    tables, new = loads
    tables.repeats = True
    tables.replace("t", new)
    assert sorted(map(tuple, tables.frames["t"].collect())) == sorted(map(tuple, new.collect()))
    assert any(f"DISTINCT \"{PLACE}\", \"id\"" in q for q in tables.log)


def test_a_load_that_lost_rows_leaves_the_old_table(loads):
    tables, new = loads
    tables.loses = 2
    with pytest.raises(OSError, match="of 40 rows arrived"):
        tables.replace("t", new)
    assert [tuple(r) for r in tables.frames["t"].collect()] == [(0, "old")] and sorted(tables.frames) == ["t"]
    tables.loses = -1
    tables.replace("t", new.limit(0))
    assert tables.frames["t"].count() == 0


def test_keys_and_largest_values_are_the_databases_own_work(spark):
    rows = [(1, "a", 10), (1, "b", 11), (2, "a", 99), (None, "a", None), (3, None, 10), (3, None, 10)]
    frames = {
        "child": spark.createDataFrame(rows, "id int, s string, parent int"),
        "parent": spark.createDataFrame([(10,), (11,)], "id int"),
    }
    checks = [
        Constraint("primary key", "CHILD", "p1", ("id",)), Constraint("primary key", "child", "p2", ("id", "s")),
        Constraint("unique", "child", "u1", ("id",)), Constraint("unique", "child", "u2", ("s", "id")),
        Constraint("foreign key", "child", "f1", ("parent",), "Parent", ("id",)), Constraint("index", "child", "i1", ("s",)),
        Constraint("unique", "child", "bad", ("nothing",)),
    ]
    served = Served(spark, frames, POSTGRESQL)
    plain = FrameTables(spark, "shop", frames)
    got, want = (sorted(map(tuple, run_checks(t, checks).collect())) for t in (served, plain))
    assert got == want and len([q for q in served.log if "COUNT(*)" in q]) == 6
    autos = [AutoColumn("child", "parent"), AutoColumn("child", "id", 50), AutoColumn("child", "s"), AutoColumn("x", "id")]
    got, want = (sorted(map(tuple, sequence_starts(t, autos).collect())) for t in (served, plain))
    assert got == want and got[1][3] == 100


def test_views_in_the_database_itself(spark):
    tables = Served(spark, {"orders": spark.range(5)}, POSTGRESQL, JobConf(database_views=True))
    tables.execute = tables.log.extend
    views = {
        "V_All": "create view `V_All` as select `o`.`ID` AS `Id`, 'a `b` \\'c' as x from `shop`.`Orders` `o`",
        "v_two": "create view v_two as select * from `v_all`",
    }
    got = register_views(tables, dict(reversed(views.items())), "shop").collect()
    assert [(r.view_name, r.is_success) for r in got] == [("v_two", "Y"), ("V_All", "Y")]
    assert [q for q in tables.log if "VIEW" in q] == [
        'CREATE OR REPLACE VIEW "v_all" AS select "o"."id" AS "id", \'a `b` \\\'c\' as x from "orders" "o"',
        'CREATE OR REPLACE VIEW "v_two" AS select * from "v_all"',
    ]
    assert jdbc.requoted("select `a``b` from `T`", MYSQL) == "select `a``b` from `T`"


def test_probes_answered_by_spark_take_no_rows_to_the_driver(spark, plan):
    pairs = [(k // 4, k % 4) for k in range(2000)]
    df = spark.createDataFrame(pairs, "a long, b long").repartition(4)
    server = SparkServer(FrameTables(spark, "db", {"t": df}), 4)
    for low, skip in ((None, 0), (None, 1203), ((250, 1), 700), ((250, 1), 999), ((250, 1), 5000)):
        found = server.query(probe_sql("t", ["a", "b"], low, skip, MYSQL_57))
        assert "TakeOrdered" not in plan(found) and "Limit" not in plan(found)
        left = [p for p in pairs if low is None or p >= low]
        assert [tuple(r) for r in found.collect()] == left[skip : skip + 1]
