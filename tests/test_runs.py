"""Migration, comparison and summary."""

import pytest
from pyspark.sql import functions as F

from tablehaul import (
    AutoColumn,
    ColumnSpec,
    Constraint,
    FrameTables,
    JobConf,
    ParquetTables,
    compare,
    compare_counts,
    compare_failures,
    failed_tables,
    migrate,
    migrate_database,
    object_totals,
    register_views,
    remove_staged,
    sequence_starts,
    store_report,
    table_list,
    write_clustered,
)
from tablehaul.plans.compare import row_counts, shown
from tablehaul.shared import shared_root
from tests.conftest import rows

LONG = ColumnSpec("s", "VARCHAR", 3)


@pytest.fixture
def source(spark):
    return FrameTables(
        spark,
        "src",
        {
            "Words": spark.createDataFrame([("a",), ("toolong",), (None,)], "s string"),
            "empty": spark.createDataFrame([], "k int, s string"),
            "numbers": spark.range(0, 100, 1, 4),
            "broken": spark.range(3).filter(F.raise_error(F.lit("unreadable")).isNull()),
        },
        views={"small": "select id from numbers where (id < 10)", "bad": "select 1 from gone"},
        specs={"words": [LONG]},
    )


@pytest.fixture
def target(spark, tmp_path):
    return ParquetTables(spark, str(tmp_path / "tgt"), name="tgt")


def test_tables_are_copied_and_recorded(spark, source, target):
    tasks = migrate(source, target, JobConf(table_parallelism=2))
    found = {r.table_name: r for r in tasks.collect()}
    assert {n: (r.source_table_rows, r.target_table_rows, r.is_success) for n, r in found.items()} \
        == {"Words": (3, 2, "N"), "empty": (0, 0, "Y"), "numbers": (100, 100, "Y"),
            "broken": (None, None, "N")}
    assert all(r.task_start_time <= r.task_end_time and r.run_time >= 0 for r in found.values())
    assert {r.thread for r in found.values()} <= {0, 1}
    assert rows(target.rejected("Words")) == [("toolong", "s:length")]
    assert target.read("empty").dtypes == [("k", "int"), ("s", "string")]
    assert target.table_names() == ["Words", "empty", "numbers"]
    assert rows(target.read("my_mig_task_info").select("table_name", "is_success")) == rows(
        tasks.select("table_name", "is_success")
    )
    assert sorted(r[0] for r in failed_tables(tasks).collect()) == ["Words", "broken"]


def test_a_second_run_changes_nothing(spark, source, target):
    only = ["numbers", "EMPTY", "Numbers"]
    first = migrate(source, target, tables=only)
    again = migrate(source, target, tables=only)
    kept = ["table_name", "source_table_rows", "target_table_rows", "is_success"]
    assert rows(first.select(*kept)) == rows(again.select(*kept))
    assert rows(target.read("numbers")) == rows(source.read("numbers"))


def test_empty_source_empties_the_target(spark, source, target):
    target.replace("empty", spark.createDataFrame([(1, "old")], "k int, s string"))
    assert migrate(source, target, tables=["empty"], data_only=True).first().is_success == "Y"
    assert target.read("empty").count() == 0


def test_data_only_needs_the_table(spark, source, target):
    assert migrate(source, target, tables=["numbers"], data_only=True).first().is_success == "N"
    target.replace("numbers", spark.createDataFrame([], "id string"))
    assert migrate(source, target, tables=["numbers"], data_only=True).first().is_success == "Y"
    assert target.read("numbers").dtypes == [("id", "string")]


def test_nothing_to_copy(spark, target):
    tasks = migrate(FrameTables(spark, "none", {}), target)
    assert tasks.count() == 0 and len(tasks.columns) == 8


def test_a_source_read_once(spark, target):
    """Rows of a live source are staged: what is kept and what is rejected are of one read."""

    class Live(FrameTables):
        def reads_repeat(self):
            return False

    changing = spark.range(0, 1000, 1, 4).select(
        F.when(F.rand() < 0.5, "ok").otherwise("too long").alias("s")
    )
    live = Live(spark, "live", {"t": changing}, specs={"t": [LONG]})
    record = migrate(live, target).first()
    assert record.source_table_rows == 1000 and record.is_success == "N"
    assert target.read("t").count() + target.rejected("t").count() == 1000
    assert record.target_table_rows == target.read("t").count()


@pytest.mark.parametrize("cluster_by", [{}, {"t": ("id",)}])
def test_a_clean_live_source(spark, target, cluster_by):
    class Live(FrameTables):
        def reads_repeat(self):
            return False

    live = Live(spark, "live", {"t": spark.range(0, 500, 1, 4)})
    record = migrate(live, target, JobConf(cluster_by=cluster_by)).first()
    assert (record.source_table_rows, record.target_table_rows) == (500, 500)
    assert rows(target.read("t")) == [(i,) for i in range(500)]


def test_rejects_of_an_earlier_load_are_forgotten(spark, source, target):
    migrate(source, target, tables=["words"])
    assert target.rejected("Words").count() == 1
    clean = FrameTables(spark, "src", {"Words": source.read("words").limit(1)},
                        specs={"words": [LONG]})
    assert migrate(clean, target).first().is_success == "Y"
    with pytest.raises(Exception):
        target.rejected("Words")


def test_copying_plainly_reads_and_writes(spark, source, target, plan):
    migrate(source, target, JobConf(cluster_by={"numbers": ("id",)}), tables=["numbers"])
    assert rows(target.read("numbers")) == rows(source.read("numbers"))


def test_table_list():
    assert table_list(["a,comment\n", "\n", "  ", " B \n", "c"]) == ["a", "B", "c"]


def test_whole_run(spark, source, target):
    run = migrate_database(
        source,
        target,
        auto_columns=[AutoColumn("numbers", "id", 5), AutoColumn("gone", "id")],
        constraints=[
            Constraint("primary key", "numbers", "PRIMARY", ("id",)),
            Constraint("foreign key", "numbers", "fk", ("id",), "numbers", ("id",)),
            Constraint("unique", "gone", "uq", ("id",)),
        ],
    )
    assert {r.kind: (r.total, r.success, r.failed) for r in run.summary.collect()} == {
        "tables": (4, 2, 2), "views": (2, 1, 1), "auto columns": (2, 1, 1),
        "indexes/constraints": (2, 1, 1), "foreign keys": (1, 1, 0),
    }
    assert run.sequences.filter("is_success = 'Y'").first().next_value == 100
    assert target.view_names() == ["small"]
    assert target.read_view("small").count() == 10


def test_part_of_a_run(spark, source, target):
    keys = [Constraint("primary key", t, "PRIMARY", ("id",)) for t in ("numbers", "other")]
    run = migrate_database(source, target, tables=["numbers"], constraints=keys)
    assert [r.total for r in run.summary.orderBy("kind").collect()] == [0, 0, 1, 1, 0]
    rerun = migrate_database(source, target, tables=["numbers"], data_only=True, constraints=keys)
    assert {r.kind for r in rerun.summary.filter("total > 0").collect()} == {"tables"}


def test_compare_with_itself(spark):
    source = ParquetTables(spark, "/root/testdata/sf0.001")
    report = compare(source, source)
    assert {r.is_success for r in report.collect()} == {"Y"}
    assert compare_failures(report).count() == 0
    assert report.columns[0] == "id" and len(report.columns) == 9
    assert dict(report.dtypes)["id"] == "int" and dict(report.dtypes)["source_rows"] == "bigint"


def test_compare_verdicts(spark, source):
    target = FrameTables(
        spark,
        "tgt",
        {
            "WORDS": spark.range(3),
            "numbers": spark.range(90),
            "broken": spark.range(3),
            "extra": spark.range(7),
            "data_compare": spark.range(1),
        },
        views={"SMALL": "select 1"},
    )
    report = compare(source, target)
    lines = {r.source_table_name: r for r in report.collect()}
    assert {n: (r.source_rows, r.target_table_name, r.target_rows, r.is_success)
            for n, r in lines.items()} == {
        "BROKEN": (-1, "BROKEN", 3, "N"),
        "EMPTY": (0, "TABLE NOT EXIST", -1, "N"),
        "NUMBERS": (100, "NUMBERS", 90, "N"),
        "WORDS": (3, "WORDS", 3, "Y"),
        "BAD": (0, "NOT EXISTS VIEW", 0, "N"),
        "SMALL": (0, "SMALL", 0, "Y"),
    }
    assert [r.id for r in report.orderBy("id").collect()] == [1, 2, 3, 4, 5, 6]
    assert [r.source_table_name for r in report.orderBy("id").collect()] == [
        "BROKEN", "EMPTY", "NUMBERS", "WORDS", "BAD", "SMALL",
    ]
    deltas = {r.source_table_name: r.delta for r in compare_failures(report).collect()}
    assert deltas == {"BROKEN": 4, "EMPTY": -1, "NUMBERS": -10, "BAD": 0}
    totals = {r.db_type: tuple(r)[1:] for r in object_totals(report, target).collect()}
    assert totals == {"TABLE": (4, 4, 103, 96), "VIEW": (2, 1, 0, 0)}
    assert shown(report).filter("compare_time rlike '^[0-9]{2}-[0-9]{2} [0-9:]{8}$'").count() == 6


def test_tables_are_counted_in_batches(spark, source, monkeypatch):
    monkeypatch.setattr("tablehaul.plans.compare.TABLES_PER_JOB", 3)
    many = FrameTables(spark, "many", {f"t{i}": spark.range(i) for i in range(10)})
    assert rows(row_counts(many)) == [(f"t{i}", i) for i in range(10)]
    assert dict(rows(row_counts(source)))["broken"] == -1
    assert row_counts(FrameTables(spark, "none", {})).count() == 0


def test_report_is_kept_in_the_target(spark, source, target):
    migrate(source, target, tables=["numbers"])
    chosen = FrameTables(spark, "src", {"numbers": source.read("numbers")})
    store_report(compare(chosen, target), target)
    assert target.read("data_compare").select("is_success").collect() == [("Y",)]
    assert target.table_names() == ["numbers"]


def test_compare_needs_both_sides(spark):
    here = ParquetTables(spark, "/root/testdata/sf0.001")
    nowhere = ParquetTables(spark, "/root/testdata/none")
    with pytest.raises(ValueError, match="target"):
        compare_counts(here, nowhere)
    with pytest.raises(ValueError, match="source"):
        compare_counts(nowhere, here)


def test_counting_reads_no_columns(spark, plan):
    source = ParquetTables(spark, "/root/testdata/sf0.001")
    assert "ReadSchema: struct<>" in plan(source.count_frame("lineitem"))


def test_sequences(spark):
    tables = FrameTables(
        spark, "db", {"t": spark.range(5), "e": spark.createDataFrame([], "id int")}
    )
    found = sequence_starts(
        tables,
        [AutoColumn("t", "id"), AutoColumn("t", "id", 90), AutoColumn("e", "id"),
         AutoColumn("t", "gone")],
    )
    assert [(r.sequence_name, r.next_value, r.is_success) for r in found.collect()] == [
        ("T_ID_SEQ", 5, "Y"), ("T_ID_SEQ", 90, "Y"), ("E_ID_SEQ", 1, "Y"),
        ("T_GONE_SEQ", None, "N"),
    ]


def test_settings_are_checked():
    with pytest.raises(ValueError):
        JobConf(page_size=0)
    with pytest.raises(ValueError):
        JobConf(length_unit="words")


def test_names_that_differ_in_case_are_compared_with_their_own(spark):
    few, many = spark.range(2), spark.range(3)
    ours = FrameTables(spark, "ours", {"x": few, "X": many, "y": few})
    theirs = FrameTables(spark, "theirs", {"X": many, "x": few, "Y": few})
    rows = [(r.source_rows, r.target_rows, r.is_success) for r in compare_counts(ours, theirs).collect()]
    assert sorted(rows) == [(2, 2, "Y"), (2, 2, "Y"), (3, 3, "Y")]


def test_a_live_source_is_read_once_and_leaves_nothing_staged(spark, target, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    class Live(FrameTables):
        def reads_repeat(self):
            return False

        def scan(self, table, conf):
            def seen(batches):
                for batch in batches:
                    reads.add(batch.num_rows)
                    yield batch

            return self._frame(table).mapInArrow(seen, self._frame(table).schema)

    remove_staged(spark)
    texts = spark.range(0, 300, 1, 3).select(F.when(F.col("id") % 100 != 7, F.col("id").cast("string")).otherwise("x").alias("n"))
    live = Live(spark, "live", {"t": texts}, specs={"t": [ColumnSpec("n", "INT")]})
    record = migrate(live, target).first()
    assert (record.source_table_rows, record.target_table_rows, reads.value) == (300, 297, 300)
    assert target.rejected("t").count() == 3
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_root(spark)}/tablehaul-{spark.sparkContext.applicationId}")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    assert not files.exists(folder) or not files.listStatus(folder)


def test_indexes_become_layout(spark, tmp_path):
    wide = spark.range(0, 20_000, 1, 8).select("id", (F.xxhash64("id") % 1000).alias("a"), (F.xxhash64("id", F.lit(1)) % 1000).alias("b"))
    source = FrameTables(spark, "s", {"two": wide, "One": wide.limit(50), "none": wide.limit(5)})
    keys = [
        Constraint("index", "TWO", "ia", ("a",)), Constraint("index", "two", "ib", ("b", "id")),
        Constraint("index", "one", "i", ("b", "a")), Constraint("unique", "two", "u", ("id",)),
    ]
    seen = {}

    class Files(ParquetTables):
        def replace(self, table, df, conf=JobConf()):
            seen[table] = (conf.cluster_by.get(table), conf.curve_by.get(table))
            super().replace(table, df, conf)

    folder = Files(spark, str(tmp_path / "files"))
    run = migrate_database(source, folder, constraints=keys)
    assert seen["two"] == (None, ("a", "b")) and seen["One"] == (("b", "a"), None) and seen["none"] == (None, None)
    assert {r.kind: r.total for r in run.summary.collect()}["indexes/constraints"] == 4
    assert rows(folder.read("two")) == rows(wide)
    run = migrate_database(source, folder, JobConf(index_layout=False), constraints=keys)
    assert {r.kind: r.total for r in run.summary.collect()}["indexes/constraints"] == 1
    assert seen["two"] == (None, None)


def test_a_curve_serves_a_filter_on_any_of_its_columns(spark, tmp_path):
    wide = spark.range(0, 64_000, 1, 8).select(
        "id", (F.xxhash64("id") % 5000).alias("a"), F.format_string("k%05d", F.abs(F.xxhash64("id", F.lit(1))) % 5000).alias("b"),
        F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id")).alias("c"),
    )
    folder = ParquetTables(spark, str(tmp_path / "curve"))
    write_clustered(wide, folder, "t", ["a", "b"], files=64, curve=True)
    kept = folder.read("t")
    files = kept.select(F.input_file_name()).distinct().count()
    assert rows(kept) == rows(wide) and files == 64
    for column, low, high in (("a", 1000, 1100), ("b", "k01000", "k01100")):
        inside = kept.groupBy(F.input_file_name()).agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
        touched = inside.where((F.col("lo") <= high) & (F.col("hi") >= low)).count()
        assert touched <= files // 3
    hot = wide.withColumn("a", F.lit(7))
    write_clustered(hot, folder, "hot", ["a", "c"], files=16, curve=True)
    sizes = [r["count"] for r in folder.read("hot").groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 3 * 64_000 // 16
    write_clustered(wide.limit(0), folder, "empty", ["a", "b"], curve=True)
    assert folder.read("empty").count() == 0


def test_views_are_defined_in_the_order_they_need_each_other(spark, target):
    target.replace("t", spark.range(3).toDF("id"))
    tried = []

    class Counting(type(target)):
        def create_view(self, name, body):
            tried.append(name)
            super().create_view(name, body)

    counting = Counting(spark, target.path)
    views = {
        "v1": "create view v1 as select id + 1 as id from V2", "v2": "select * from `shop`.`v3` where id in (select id from v5)",
        "V3": "with w as (select * from v4) select * from w", "v4": "select x.id from t x, (select max(id) m from v5) y",
        "v5": "select id, 'from v1' as note from t", "a": "select * from b", "b": "select * from c union select * from a",
        "c": "select exists(select 1 from a) as e", "self": "select * from self", "late": "select * from a join v1",
        "t2": "select * from nothing", "bad": "select from from", "after_bad": "select * from bad",
    }
    got = {r.view_name: r for r in register_views(counting, views, "shop").collect()}
    assert list(got) == list(views)
    assert [n for n in views if got[n].is_success == "Y"] == ["v1", "v2", "V3", "v4", "v5"]
    assert tried.index("v5") < tried.index("v4") < tried.index("V3") < tried.index("v2") < tried.index("v1")
    assert len(tried) == len(set(tried))
    for name in "abc":
        assert got[name].error == "views need each other: a, b, c"
    assert got["self"].error == "views need each other: self" and got["late"].error == "needs a, which failed"
    assert got["after_bad"].error == "needs bad, which failed" and "nothing" in got["t2"].error
    assert rows(counting.read_view("v1").select("id")) == [(1,), (2,), (3,)]


class Paged(FrameTables):
    """A live source in pages, of which some cannot be read."""

    def __init__(self, *args, **kwargs):
        super().__init__(*args, **kwargs)
        self.broken, self.read_pages, self.cuts = set(), [], 5

    def reads_repeat(self):
        return False

    def scan(self, table, conf):
        return self.read(table)

    def page_predicates(self, table, conf):
        return [f"id % {self.cuts} = {i}" for i in range(self.cuts)]

    def read_page(self, table, predicate):
        self.read_pages.append(predicate)
        if predicate in self.broken:
            raise OSError("the server went away")
        return super().read_page(table, predicate)


def test_a_run_goes_on_where_it_failed(spark, target, tmp_path):
    frame = spark.range(0, 500, 1, 3).select("id", F.when(F.col("id") % 100 != 7, F.col("id").cast("string")).otherwise("x").alias("n"))
    live = Paged(spark, "li/ve", {"t": frame.where("id % 5 <> 4")}, specs={"t": [ColumnSpec("id", "BIGINT"), ColumnSpec("n", "INT")]})
    conf = JobConf(resume_dir=str(tmp_path / "pages"), read_parallelism=2)
    live.broken = {"id % 5 = 1", "id % 5 = 3"}
    assert migrate(live, target, conf).first().is_success == "N" and "t" not in target.table_names()
    assert len(live.read_pages) == 5
    live.broken, live.read_pages, live.cuts = set(), [], 7  # the first run's cuts count
    damaged = next((tmp_path / "pages").rglob("__page=2/part-*.parquet"))
    damaged.write_bytes(next((tmp_path / "pages").rglob("__page=0/part-*.parquet")).read_bytes())
    next(damaged.parent.glob(f".{damaged.name}.crc")).unlink()
    record = migrate(live, target, conf).first()
    assert sorted(live.read_pages) == ["id % 5 = 1", "id % 5 = 2", "id % 5 = 3"]
    assert (record.source_table_rows, record.target_table_rows) == (400, 395)
    assert rows(target.read("t")) == rows(frame.where("id % 5 <> 4 and n <> 'x'").selectExpr("id", "cast(n as int) n"))
    assert target.rejected("t").count() == 5
    assert not list((tmp_path / "pages").rglob("*.parquet"))
    live.read_pages = []
    assert migrate(live, target, conf).first().source_table_rows == 400
    assert len(live.read_pages) == 7


def test_pages_of_a_table_that_turned_up_empty(spark, target, tmp_path):
    live = Paged(spark, "live", {"t": spark.range(0).select("id")})
    record = migrate(live, target, JobConf(resume_dir=str(tmp_path / "pages"))).first()
    assert (record.source_table_rows, record.is_success) == (0, "Y") and target.read("t").count() == 0


def test_frames_that_change_between_reads(spark, target):
    changing = spark.range(0, 200, 1, 4).select(F.when(F.rand() < 0.5, F.lit("toolong")).otherwise(F.lit("a")).alias("s"))
    live = FrameTables(spark, "live", {"t": changing}, specs={"t": [LONG]}, live=True)
    record = migrate(live, target).first()
    assert record.target_table_rows + target.rejected("t").count() == record.source_table_rows == 200
