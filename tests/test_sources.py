import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import demo_queries
from tablehaul import (
    CatalogTables,
    ColumnSpec,
    DelimitedText,
    FrameTables,
    ParquetTables,
    read_delimited,
    read_table,
    register_views,
    write_clustered,
    write_delimited,
    write_existing,
    write_table,
)
from tablehaul.sources.delimited import records
from tests.conftest import rows

CELLS = [
    None, "", "\\N", "\\N1", "a;b", 'say "hi"', '"', "line\nfeed", "carriage\rreturn", "both\r\n",
    "trailing\r", "tab\t", "nul\0", "\0", "back\\slash", "trailing\\", "  padded  ", "# comment",
    "höchst ünüblich 漢字 🙂", "x" * 40000, "NULL", "null", "'", ";", ";;", '";"', "\n", " ",
]


@pytest.fixture
def cells(spark):
    return spark.createDataFrame(list(enumerate(CELLS)), "k int, s string").repartition(3)


def test_delimited_cells_survive(spark, cells, tmp_path):
    both = cells.withColumn("again", F.col("s"))
    used = write_delimited(both, str(tmp_path / "t"))
    assert used.null_marker == "\\N2" and used.multiline
    back = read_delimited(spark, str(tmp_path / "t"), both.schema, used)
    assert rows(back.fillna("~null")) == rows(both.fillna("~null"))


def test_delimited_marker_beyond_the_first_candidates(spark, tmp_path):
    taken = ["\\N"] + [f"\\N{i}" for i in range(1, 20)]
    df = spark.createDataFrame([(t,) for t in [*taken, None]], "s string")
    used = write_delimited(df, str(tmp_path / "t"))
    assert used.null_marker == "\\N20"
    back = read_delimited(spark, str(tmp_path / "t"), df.schema, used)
    assert back.exceptAll(df).count() == 0 and back.filter("s is null").count() == 1


def test_delimited_without_line_ends_can_be_split(spark, tmp_path):
    df = spark.range(100).select("id", F.concat(F.lit('q"'), "id").alias("s"))
    used = write_delimited(df, str(tmp_path / "t"), max_records_per_file=10)
    assert not used.multiline
    assert len(list((tmp_path / "t").glob("part-*"))) >= 10
    assert rows(read_delimited(spark, str(tmp_path / "t"), df.schema, used)) == rows(df)


def test_delimited_line_format(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "", 'a"b', b"\x01")], "a int, b string, c string, "
                               "d string, e binary")
    write_delimited(df.coalesce(1), str(tmp_path / "t"), DelimitedText())
    (file,) = (tmp_path / "t").glob("part-*")
    assert file.read_bytes() == b'"1";\\N;"";"a""b";"\\x01"\n'


def test_delimited_types(spark, tmp_path):
    df = spark.sql(
        "select 1Y a, 2.5D b, cast('1.10' as decimal(9,2)) c, date'2020-02-29' d, "
        "timestamp_ntz'2020-01-01 01:02:03.000456' e, true f, X'00FF' g, 1e300D h, "
        "cast(null as timestamp_ntz) i"
    )
    used = write_delimited(df, str(tmp_path / "t"))
    back = read_delimited(spark, str(tmp_path / "t"), df.schema, used)
    assert back.dtypes == df.dtypes and rows(back) == rows(df)


def test_delimited_has_no_form_for_nested_columns(spark, tmp_path):
    with pytest.raises(ValueError, match="no delimited form"):
        write_delimited(spark.sql("select array(1) a"), str(tmp_path / "t"))


@pytest.fixture
def target(spark, tmp_path):
    return ParquetTables(spark, str(tmp_path / "db"))


def test_projection_reaches_the_scan(spark, plan):
    source = ParquetTables(spark, "/root/testdata/sf0.001")
    text = plan(read_table(source, "orders", ["o_orderkey", "o_totalprice"]))
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text


def test_overwrite_is_repeatable_and_takes_no_rows(spark, target):
    df = spark.range(10)
    for content in (df, df, df.filter("id < 3"), df.limit(0)):
        write_table(content, target, "t")
        assert rows(target.read("t")) == rows(content)
        assert target.count_frame("t").first().rows == content.count()
    assert target.table_names() == ["t"]
    with pytest.raises(ValueError):
        write_table(df, target, "t", mode="append")


def test_a_table_can_be_replaced_by_itself(spark, target):
    write_table(spark.range(10), target, "t")
    write_table(target.read("t").filter("id > 4"), target, "T")
    assert target.read("t").count() == 5 and target.table_names() == ["t"]


def test_failed_write_leaves_the_old_table(spark, target):
    write_table(spark.range(10), target, "t")
    failing = spark.range(0, 100, 1, 4).select(
        F.when(F.col("id") == 99, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id")
    )
    with pytest.raises(Exception):
        write_table(failing, target, "t")
    assert target.read("t").count() == 10
    assert target.table_names() == ["t"]
    import os

    assert sorted(os.listdir(target.path)) == ["t.parquet"]


def test_names_are_matched_without_case(spark, target):
    write_table(spark.range(1), target, "MiXed")
    assert target.resolve("mixed") == "MiXed" and target.read("MIXED").count() == 1
    with pytest.raises(ValueError, match="no table"):
        target.read("other")


def test_tables_of_the_run_are_not_listed(spark, target):
    write_table(spark.range(1), target, "data_compare")
    write_table(spark.range(1), target, "MY_MIG_TASK_INFO")
    assert target.table_names() == []
    assert target.read("DATA_COMPARE").count() == 1


def test_write_existing_keeps_the_table_columns(spark, target):
    first = spark.createDataFrame([(1, "a", 2.0)], "id int, name string, x double")
    write_table(first, target, "t")
    write_existing(spark.createDataFrame([("b", 7)], "NAME string, id bigint"), target, "t")
    assert target.read("t").dtypes == first.dtypes
    assert rows(target.read("t")) == [(7, "b", None)]
    with pytest.raises(ValueError, match="no columns"):
        write_existing(spark.range(1).withColumn("other", F.lit(1)), target, "t")
    strict = [ColumnSpec("id", "INT"), ColumnSpec("x", "INT", is_nullable=False)]
    with pytest.raises(ValueError, match="NOT NULL"):
        write_existing(spark.range(1), target, "t", strict)
    with pytest.raises(ValueError, match="no table"):
        write_existing(spark.range(1), target, "absent")


def test_clustered_files_hold_narrow_ranges(spark, target):
    orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    write_clustered(orders, target, "orders", ["o_custkey", "o_orderdate"], files=6)
    written = target.read("orders")
    ranges = sorted(
        tuple(r)
        for r in written.groupBy(F.input_file_name())
        .agg(F.min("o_custkey").alias("lo"), F.max("o_custkey").alias("hi"))
        .select("lo", "hi")
        .collect()
    )
    assert len(ranges) == 6
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    assert written.exceptAll(orders).count() == orders.exceptAll(written).count() == 0


@pytest.fixture
def catalog(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS moved")
    yield CatalogTables(spark, "moved")
    spark.sql("DROP DATABASE moved CASCADE")


def test_catalog_tables(spark, catalog):
    assert catalog.exists() and not CatalogTables(spark, "nowhere").exists()
    assert CatalogTables(spark, "nowhere").table_names() == []
    for content in (spark.range(5), spark.range(3)):
        write_table(content, catalog, "t")
        assert rows(catalog.read("T")) == rows(content)
    catalog.keep_rejected("t", spark.range(2))
    assert catalog.table_names() == ["t"]
    failing = spark.range(3).select(F.raise_error(F.lit("no")).cast("int").alias("id"))
    with pytest.raises(Exception):
        write_table(failing, catalog, "t")
    assert catalog.read("t").count() == 3 and catalog.table_names() == ["t"]
    spark.range(99).createOrReplaceTempView("t")
    outcomes = register_views(catalog, {"v": "CREATE VIEW `v` AS select `id` from `t`"})
    assert [r.is_success for r in outcomes.collect()] == ["Y"]
    assert catalog.view_names() == ["v"] and catalog.read_view("v").count() == 3
    assert spark.catalog.currentDatabase() == "default"


def test_given_frames_cannot_be_written(spark):
    with pytest.raises(NotImplementedError):
        write_table(spark.range(1), FrameTables(spark, "f", {}), "t")


def test_schema_types_survive_a_replace(spark, target):
    df = spark.createDataFrame(
        [], T.StructType.fromDDL("a array<float>, b timestamp_ntz, c decimal(9,2), d binary")
    )
    write_table(df, target, "t")
    assert target.read("t").dtypes == df.dtypes


def test_write_existing_refuses_what_does_not_fit(spark, target):
    specs = [ColumnSpec("id", "INT"), ColumnSpec("s", "VARCHAR", 3)]
    write_table(spark.createDataFrame([(1, "old")], "id int, s string"), target, "strict_t")
    for bad in ((3_000_000_000, "a"), (2, "long")):
        with pytest.raises(Exception, match="does not fit"):
            write_existing(spark.createDataFrame([bad], "id bigint, s string"), target, "strict_t", specs)
    assert [tuple(r) for r in target.read("strict_t").collect()] == [(1, "old")]


def test_tables_of_a_folder_are_counted_by_one_scan(spark, tmp_path):
    tables = ParquetTables(spark, f"{tmp_path}/a b")
    for name, n in (("plain", 5), ("with space", 3), ("a+b", 2), ("none", 0)):
        write_table(spark.range(n), tables, name)
    spark.range(6).selectExpr("id", "id % 2 as p").write.partitionBy("p").parquet(f"{tmp_path}/a b/parts.parquet")
    spark.range(4).coalesce(1).write.parquet(f"{tmp_path}/one")
    file = next((tmp_path / "one").glob("part-*.parquet"))
    (tmp_path / "a b" / "file.parquet").write_bytes(file.read_bytes())
    expected = {"plain": 5, "with space": 3, "a+b": 2, "none": 0, "parts": 6, "file": 4}
    assert tables.count_together(tables.table_names()) == expected


@pytest.fixture
def small_blocks(spark):
    """Files are cut every few bytes."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def quoted_cells():
    rnd = random.Random(8)
    parts = ["a", '"', '""', "\n", "\n\n", ";", "\r\n", "\\", "é", "", " ", "word", '";"', '"\n"', "\\N"]
    cell = lambda: None if rnd.random() < 0.2 else "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 9)))
    found = [(i, cell(), cell()) for i in range(400)]
    found[100] = (100, "x" * 70 + "\n" + "y\n" * 120 + '"', "end")  # over more than three blocks
    found[101] = (101, "\n" * 300, None)
    found[102] = (102, "z" * 1000, "\n")
    return found


@pytest.mark.parametrize("files", [1, 3])
def test_quoted_line_ends_across_blocks(spark, small_blocks, tmp_path, files):
    df = spark.createDataFrame(quoted_cells(), "i int, a string, b string").repartition(files)
    used = write_delimited(df, str(tmp_path / "t"))
    assert used.multiline
    path = str(tmp_path / "t")
    assert spark.read.text(path).rdd.getNumPartitions() > 20
    got = read_delimited(spark, path, df.schema, used)
    assert sorted(map(tuple, got.collect())) == sorted(quoted_cells(), key=lambda r: r[0])
    assert sorted(map(tuple, read_delimited(spark, path, df.schema, used, split=False).collect())) == quoted_cells()


def test_split_text_in_one_block_and_empty_text(spark, tmp_path):
    df = spark.createDataFrame(quoted_cells(), "i int, a string, b string").coalesce(1)
    used = write_delimited(df, str(tmp_path / "t"))
    assert rows(read_delimited(spark, str(tmp_path / "t"), df.schema, used, split=True).select("i")) == rows(df.select("i"))
    (tmp_path / "empty.csv").write_text("")
    assert read_delimited(spark, str(tmp_path / "empty.csv"), df.schema, used, split=True).count() == 0
    (tmp_path / "gaps.csv").write_text('1;"a\n\nb";c\n\n\n2;"";\\N\n3;x;"y"')
    for split in (True, False):
        got = read_delimited(spark, str(tmp_path / "gaps.csv"), df.schema, split=split)
        assert rows(got.fillna("null")) == [(1, "a\n\nb", "c"), (2, "", "null"), (3, "x", "y")]


def test_a_bad_record_of_split_text_raises(spark, tmp_path):
    (tmp_path / "bad.csv").write_text('"1";"a\nb"\n"x";"c"\n')
    shape = spark.createDataFrame([], "i int, s string").schema
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
        read_delimited(spark, str(tmp_path / "bad.csv"), shape, split=True).collect()


def test_parts_of_a_block_are_cut_apart(spark, tmp_path):
    cells = [(i, "line\n" * (i % 7) + '"' * (i % 3), None if i % 5 == 0 else "x") for i in range(1500)]
    cells[700] = (700, "y\n" * 3000, '"\n"')  # over more than two parts
    df = spark.createDataFrame(cells, "i int, a string, b string").coalesce(1)
    path = str(tmp_path / "t")
    used = write_delimited(df, path)
    found = records(spark, path)
    assert found.select("file", "block").distinct().count() == 1
    assert found.groupBy("file", "block", "part").count().count() >= 5
    got = read_delimited(spark, path, df.schema, used, split=True)
    assert sorted(map(tuple, got.collect())) == cells


def test_large_texts_are_written_by_several_tasks(spark, tmp_path, monkeypatch):
    shape = "doc_id long, text string"
    docs = spark.createDataFrame([(i, f"{i}\n" * 20) for i in range(800)], shape)
    docs.repartition(8).write.parquet(f"{tmp_path}/documents.parquet")
    tasks, write = [], demo_queries.write_delimited
    monkeypatch.setattr(demo_queries, "write_delimited", lambda df, *a, **k: tasks.append(df.rdd.getNumPartitions()) or write(df, *a, **k))
    monkeypatch.setattr(demo_queries, "BYTES_PER_FILE", 6000, raising=False)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = demo_queries.delimited_split(spark, str(tmp_path))
        assert rows(got) == rows(docs) and tasks[0] > 1
        monkeypatch.setattr(demo_queries, "BYTES_PER_FILE", 1 << 27)
        assert rows(demo_queries.delimited_split(spark, str(tmp_path))) == rows(docs) and tasks[1] == 1
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
