"""Queries over the test tables, one or more for each operator."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablehaul import (
    AutoColumn,
    ColumnSpec,
    Constraint,
    MYSQL_57,
    FrameTables,
    JdbcTables,
    JobConf,
    ParquetTables,
    append_with_sequence,
    check_foreign_key,
    check_primary_key,
    check_unique,
    compare,
    compare_counts,
    compare_failures,
    compare_values,
    compare_views,
    conform,
    decode_binary,
    decode_bits,
    diff_rows,
    encode_binary,
    fit_report,
    migrate,
    migrate_database,
    object_totals,
    offset_page,
    page_bounds,
    read_delimited,
    read_partitioned,
    read_table,
    register_views,
    run_checks,
    seek_page,
    sequence_starts,
    split_valid,
    tag_pages,
    with_defaults,
    write_clustered,
    write_delimited,
    write_existing,
    write_table,
)
from tablehaul.shared import new_folder

TABLES = (
    "benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels",
    "lineitem", "nation", "orders", "pages", "part", "region", "supplier",
)
# Small buckets, so that ranking is spread over several of them at every scale of the test data.
ROWS_PER_BUCKET = 1000
# Of a table, so that its delimited text is larger than a block of the file system.
BYTES_PER_FILE = 1 << 27

CUSTOMER_SPECS = [
    ColumnSpec("c_custkey", "MEDIUMINT", is_nullable=False),
    ColumnSpec("C_NAME", "VARCHAR", 25),
    ColumnSpec("c_nationkey", "BIGINT"),
    ColumnSpec("c_acctbal", "DECIMAL", numeric_precision=15, numeric_scale=2),
    ColumnSpec("c_mktsegment", "CHAR", 10),
]
DOCUMENT_SPECS = [
    ColumnSpec("doc_id", "BIGINT", is_nullable=False),
    ColumnSpec("text", "VARCHAR", 255),
    ColumnSpec("lang", "CHAR", 2),
    ColumnSpec("source", "VARCHAR", 4),
    ColumnSpec("n_chars", "BIGINT"),
]
BALANCE_SPECS = [
    ColumnSpec("c_custkey", "BIGINT", is_nullable=False),
    ColumnSpec("c_acctbal", "DECIMAL", numeric_precision=5, numeric_scale=2),
    ColumnSpec("c_mktsegment", "VARCHAR", 8, is_nullable=False),
]
EVENT_SPECS = [
    ColumnSpec("event_id", "INT", is_nullable=False),
    ColumnSpec("seen_at", "DATETIME", is_nullable=False),
    ColumnSpec("value", "FLOAT", numeric_precision=4, numeric_scale=2),
]
NATION_SPECS = [
    ColumnSpec("n_nationkey", "INT"),
    ColumnSpec("n_name", "VARCHAR", 25),
    ColumnSpec("n_regionkey", "INT", column_default="9"),
    ColumnSpec("n_comment", "VARCHAR", 20, column_default=""),
    ColumnSpec("n_added", "DATETIME", column_default="2020-01-01 00:00:00"),
]
VIEWS = {
    "view_order_customer": (
        "CREATE ALGORITHM=UNDEFINED DEFINER=`app`@`%` SQL SECURITY DEFINER "
        "VIEW `view_order_customer` AS select `o`.`o_orderkey` AS `o_orderkey`,"
        "convert(`c`.`c_name` using utf8mb4) AS `c_name`,`o`.`o_totalprice` AS `o_totalprice` "
        "from (`orders` `o` join `customer` `c`) where (`o`.`o_custkey` = `c`.`c_custkey`)"
    ),
    "view_line_part_order": (
        "CREATE ALGORITHM=UNDEFINED DEFINER=`app`@`%` SQL SECURITY DEFINER "
        "VIEW `view_line_part_order` AS select `l`.`l_orderkey` AS `l_orderkey`,"
        "`l`.`l_linenumber` AS `l_linenumber`,`p`.`p_brand` AS `p_brand`,"
        "`o`.`o_orderpriority` AS `o_orderpriority` "
        "from ((`part` `p` join `orders` `o`) join `lineitem` `l` "
        "on(((`l`.`l_orderkey` = `o`.`o_orderkey`) and (`l`.`l_partkey` = `p`.`p_partkey`))))"
    ),
    "view_clean_documents": (
        "CREATE VIEW `view_clean_documents` AS select `d`.`doc_id` AS `doc_id`,"
        "upper(convert(`d`.`lang` using utf8mb4)) AS `lang`,'VIEW convert(x using y)' AS `note` "
        "from (`documents` `d` join `labels` `l` on((`d`.`doc_id` = `l`.`doc_id`))) "
        "where (`l`.`toxic` = 0)"
    ),
}
# Listed before the view it reads, so that it needs a second round.
VIEW_OF_VIEW = {
    "a_clean_per_lang": (
        "CREATE VIEW `a_clean_per_lang` AS select `lang`,count(*) AS `n` "
        "from `view_clean_documents` group by `lang`"
    ),
}


def source_of(spark: SparkSession, sf_dir: str, **options) -> ParquetTables:
    return ParquetTables(spark, sf_dir, name="testdata", **options)


def scratch(spark: SparkSession, label: str) -> ParquetTables:
    return ParquetTables(spark, new_folder(spark, label), name="moved")


def full_scan(spark, sf_dir):
    columns = ["o_orderkey", "o_custkey", "o_totalprice"]
    return read_table(source_of(spark, sf_dir), "orders", columns)


def paged_scan(spark, sf_dir):
    events = read_partitioned(source_of(spark, sf_dir), "events", "event_id")
    return tag_pages(events, "event_id", 2500, ROWS_PER_BUCKET)


def paged_scan_joined(spark, sf_dir):
    lines = source_of(spark, sf_dir).read("lineitem").select("l_orderkey", "l_linenumber")
    return tag_pages(lines, "l_orderkey", 10000, ROWS_PER_BUCKET)


def bounds_of(table, key, page_size, shards):
    def query(spark, sf_dir):
        df = source_of(spark, sf_dir).read(table)
        return page_bounds(df, key, page_size, shards, ROWS_PER_BUCKET)

    return query


class SparkServer(JdbcTables):
    """Stands for a database without window functions: Spark answers its queries over the test tables.

    The place of a probe is found by ``offset_page``, as a database finds it along an index: Spark's own OFFSET
    takes all the rows before the place to the driver.
    """

    def __init__(self, tables, shards):
        super().__init__(tables.spark, "", {}, MYSQL_57, tables.name, JobConf(page_size=1, read_parallelism=shards))
        self.tables = tables

    def all_names(self):
        return self.tables.all_names()

    def query(self, sql):
        probe = re.fullmatch(r"(SELECT .*) ORDER BY .* LIMIT 1 OFFSET (\d+)", sql)
        if probe:
            keys = self.query(probe[1])
            return offset_page(keys, keys.columns, int(probe[2]), 1)
        for name in self.all_names():
            if f"`{name}`" in sql:
                return self.spark.sql(sql.replace(f"`{name}`", "{t}"), t=self.tables.read(name))
        raise ValueError(sql)

    def _read_ranges(self, table, predicates):
        shard = reduce(
            lambda rest, p: F.when(F.expr(p[1]), p[0]).otherwise(rest), enumerate(predicates), F.lit(-1)
        )
        hits = sum((F.expr(p).cast("int") for p in predicates), F.lit(0))
        return self.tables.read(table).withColumns({"shard": shard, "hits": hits})


def paged_scan_composite(spark, sf_dir):
    """Ranges of a key of two columns, found by probes along it; whether they are within twice of each other."""
    server = SparkServer(source_of(spark, sf_dir), 16)
    lines = read_partitioned(server, "lineitem", ["l_orderkey", "l_linenumber"])
    sizes = lines.groupBy("shard").count().agg(F.count("*"), F.min("count"), F.max("count")).first()
    is_even = F.lit(sizes[0] == 16 and sizes[2] <= 2 * sizes[1])
    return lines.select("l_orderkey", "l_linenumber", "hits", is_even.alias("is_even"))


def seek(spark, sf_dir):
    return seek_page(source_of(spark, sf_dir).read("orders"), "o_orderkey", 7499, 500)


def offset(spark, sf_dir):
    return offset_page(
        source_of(spark, sf_dir).read("orders"), ["o_custkey", "o_orderkey"], 5000, 500
    )


def offset_deep(spark, sf_dir):
    events = source_of(spark, sf_dir).read("events")
    return offset_page(events, ["ts", "event_id"], 900, 50, rows_per_bucket=100)


def offset_hot(spark, sf_dir):
    """Behind a first column of a few values, and deep among them."""
    lines = source_of(spark, sf_dir).read("lineitem")
    columns = ["l_linestatus", "l_orderkey", "l_linenumber"]
    return offset_page(lines.select(*columns), columns, 4000, 300, rows_per_bucket=500)


def _binary_names(spark, sf_dir):
    name = F.when(F.col("c_nationkey") != 0, F.encode("c_name", "UTF-8"))
    return source_of(spark, sf_dir).read("customer").select("c_custkey", name.alias("c_name"))


def binary_hex(spark, sf_dir):
    return encode_binary(_binary_names(spark, sf_dir), ["c_name"])


def binary_decode(spark, sf_dir):
    back = decode_binary(binary_hex(spark, sf_dir), ["c_name"])
    return back.select("c_custkey", F.decode("c_name", "UTF-8").alias("c_name"))


def bits_flags(spark, sf_dir):
    def one_byte(name):
        return F.unhex(F.lpad(F.hex(name), 2, "0")).alias(name)

    labels = source_of(spark, sf_dir).read("labels")
    return decode_bits(
        labels.select("doc_id", one_byte("quality"), one_byte("toxic")), ["quality", "toxic"], 1
    )


def bits_wide(spark, sf_dir):
    keys = source_of(spark, sf_dir).read("orders").select(
        "o_orderkey", F.unhex(F.lpad(F.hex("o_custkey"), 16, "0")).alias("flags")
    )
    return decode_bits(keys, ["flags"], 40)


def conform_customer(spark, sf_dir):
    return conform(source_of(spark, sf_dir).read("customer"), CUSTOMER_SPECS)


def _text_events(spark, sf_dir):
    zero = F.lit("0000-00-00 00:00:00")
    seen = F.when(F.col("event_type") == "error", zero).otherwise(F.col("ts").cast("string"))
    return source_of(spark, sf_dir).read("events").select(
        "event_id", seen.alias("seen_at"), F.col("value").cast("string").alias("value")
    )


def conform_text(spark, sf_dir):
    return conform(_text_events(spark, sf_dir), EVENT_SPECS)


def _with_null_segment(spark, sf_dir):
    segment = F.when(F.col("c_nationkey") != 0, F.col("c_mktsegment")).alias("c_mktsegment")
    return source_of(spark, sf_dir).read("customer").select("c_custkey", "c_acctbal", segment)


def fit(spark, sf_dir):
    documents = fit_report(source_of(spark, sf_dir).read("documents"), DOCUMENT_SPECS)
    balances = fit_report(_with_null_segment(spark, sf_dir), BALANCE_SPECS)
    return documents.unionByName(balances).unionByName(
        fit_report(_text_events(spark, sf_dir), EVENT_SPECS)
    )


def fit_bytes(spark, sf_dir):
    return fit_report(source_of(spark, sf_dir).read("documents"), DOCUMENT_SPECS, "byte")


def quarantine(spark, sf_dir):
    return split_valid(source_of(spark, sf_dir).read("documents"), DOCUMENT_SPECS)[1]


def quarantine_staged(spark, sf_dir):
    return split_valid(_with_null_segment(spark, sf_dir), BALANCE_SPECS, stage=True)[1]


def accepted(spark, sf_dir):
    return split_valid(_with_null_segment(spark, sf_dir), BALANCE_SPECS)[0]


def defaults(spark, sf_dir):
    nations = source_of(spark, sf_dir).read("nation")
    return with_defaults(nations.drop("n_regionkey"), NATION_SPECS)


def sequence_append(spark, sf_dir):
    source = source_of(spark, sf_dir)
    newcomers = source.read("supplier").select(
        F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_acctbal").alias("c_acctbal"),
        F.lit("SUPPLIER").alias("c_mktsegment"),
    )
    return append_with_sequence(source.read("customer"), newcomers, "c_custkey", ["c_name"])


def sequence_own_keys(spark, sf_dir):
    source = source_of(spark, sf_dir)
    orders = source.read("orders")
    own = F.col("o_orderkey") + F.lit(1_000_000_000)
    again = orders.withColumn("o_orderkey", F.when(F.col("o_orderstatus") == "F", own))
    # Two values order the numbered rows, so nearly all of them tie.
    numbered = append_with_sequence(orders, again, "o_orderkey", ["o_orderstatus"], start=50)
    return numbered.select("o_orderkey", "o_orderstatus")


def sequences(spark, sf_dir):
    columns = [
        AutoColumn("orders", "o_orderkey"),
        AutoColumn("customer", "c_custkey", 1_000_000),
        AutoColumn("nothing", "id", 1),
    ]
    return sequence_starts(source_of(spark, sf_dir), columns)


def overwrite(spark, sf_dir):
    source, target = source_of(spark, sf_dir), scratch(spark, "overwrite")
    write_table(source.read("orders"), target, "t")
    write_table(source.read("customer"), target, "t")
    write_table(source.read("customer"), target, "t")
    return target.read("t")


def data_only(spark, sf_dir):
    source, target = source_of(spark, sf_dir), scratch(spark, "data-only")
    suppliers = source.read("supplier")
    write_table(suppliers, target, "supplier")
    shuffled = suppliers.select("s_acctbal", "s_name", "s_nationkey", "s_suppkey")
    write_existing(shuffled, target, "supplier")
    return target.read("supplier")


def cluster(spark, sf_dir):
    target = scratch(spark, "clustered")
    orders = source_of(spark, sf_dir).read("orders")
    write_clustered(orders, target, "orders", ["o_custkey", "o_orderdate"], files=8)
    return target.read("orders")


def cluster_by_curve(spark, sf_dir):
    """One layout for filters on either of two columns."""
    target = scratch(spark, "curve")
    orders = source_of(spark, sf_dir).read("orders")
    write_clustered(orders, target, "orders", ["o_custkey", "o_orderdate"], files=16, curve=True)
    return target.read("orders")


def _round_trip(spark, df):
    path = new_folder(spark, "delimited")
    return read_delimited(spark, path, df.schema, write_delimited(df, path))


def delimited_pages(spark, sf_dir):
    pages = source_of(spark, sf_dir).read("pages")
    return _round_trip(spark, pages)


def delimited_gaps(spark, sf_dir):
    lang = F.col("lang")
    marked = F.when(lang == "en", "").when(lang == "fr", "\\N").when(lang != "de", lang)
    documents = source_of(spark, sf_dir).read("documents")
    return _round_trip(spark, documents.withColumn("lang", marked))


def delimited_split(spark, sf_dir):
    """Texts with line ends in large files, cut into blocks of the files and those into records.

    One file holds as much as one task should write.
    """
    source = source_of(spark, sf_dir)
    documents = source.read("documents")
    files = max(1, -(-source.size_hint("documents") // BYTES_PER_FILE))
    path = new_folder(spark, "delimited")
    used = write_delimited(documents.coalesce(files), path, max_records_per_file=0)
    return read_delimited(spark, path, documents.schema, used, split=True)


def delimited_orders(spark, sf_dir):
    return _round_trip(spark, source_of(spark, sf_dir).read("orders"))


def check_pk(spark, sf_dir):
    lines = source_of(spark, sf_dir).read("lineitem")
    return check_primary_key(lines, ["l_orderkey", "l_linenumber"])


def check_pk_nulls(spark, sf_dir):
    customers = source_of(spark, sf_dir).read("customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment")
    )
    return check_primary_key(customers, ["c_custkey", "segment"])


def check_uniqueness(spark, sf_dir):
    customers = source_of(spark, sf_dir).read("customer").select(
        "c_nationkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment")
    )
    return check_unique(customers, ["c_nationkey", "segment"])


def check_fk(spark, sf_dir):
    source = source_of(spark, sf_dir)
    solvent = source.read("customer").filter("c_acctbal > 0")
    return check_foreign_key(source.read("orders"), ["o_custkey"], solvent, ["c_custkey"])


def check_fk_multi(spark, sf_dir):
    source = source_of(spark, sf_dir)
    lines = source.read("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.nullif("l_returnflag", F.lit("A")).alias("flag"),
    )
    parent = source.read("lineitem").filter("l_linestatus = 'F'")
    return check_foreign_key(
        lines, ["l_partkey", "flag"], parent, ["l_partkey", "l_returnflag"]
    )


CONSTRAINTS = [
    Constraint("primary key", "orders", "PRIMARY", ("o_orderkey",)),
    Constraint("primary key", "lineitem", "PRIMARY", ("l_orderkey", "l_linenumber")),
    Constraint("unique", "customer", "uq_name", ("c_name",)),
    Constraint("index", "orders", "ix_customer", ("o_custkey",)),
    Constraint("foreign key", "orders", "fk_customer", ("o_custkey",), "customer", ("c_custkey",)),
    Constraint("foreign key", "labels", "fk_flag", ("quality",), "region", ("r_regionkey",)),
    Constraint("foreign key", "lineitem", "fk_none", ("l_suppkey",), "nation", ("n_nationkey",)),
]


def checks(spark, sf_dir):
    return run_checks(source_of(spark, sf_dir), CONSTRAINTS)


def conform_times(spark, sf_dir):
    """Times of day and years as drivers deliver them, and dates of which some are zero."""
    events = source_of(spark, sf_dir).read("events")
    day = F.when(F.col("event_id") % 100 == 0, "0000-00-00")
    rows = events.select(
        "event_id",
        F.col("ts").alias("at"),
        F.to_date("ts").alias("in_year"),
        day.otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("on_day"),
    )
    columns = [
        ColumnSpec("event_id", "BIGINT"), ColumnSpec("at", "TIME"),
        ColumnSpec("in_year", "YEAR"), ColumnSpec("on_day", "DATE"),
    ]
    good, rejected = split_valid(rows, columns)
    lost = rejected.select("event_id", F.lit(None).alias("at"), F.lit(None).alias("in_year"), "reject_reason")
    kept = good.withColumn("reject_reason", F.lit("")).withColumn("on_day", F.col("on_day").cast("string"))
    return kept.unionByName(lost.withColumn("on_day", F.lit(None)))


QUALIFIED = {
    "view_big_orders": (
        "CREATE ALGORITHM=UNDEFINED DEFINER=`root`@`%` SQL SECURITY DEFINER VIEW `shop`.`view_big_orders` AS "
        "select `shop`.`orders`.`o_orderkey` AS `o_orderkey`,'shop.x' AS `tag` from `shop`.`orders` "
        "where `shop`.`orders`.`o_totalprice` > 100000"
    ),
    "view_names": (
        "CREATE VIEW `shop`.`view_names` (`id`, `label`) AS select `c`.`c_custkey`,`c`.`c_name` "
        "from `shop`.`customer` `c` WITH CASCADED CHECK OPTION"
    ),
}


def qualified_view(name):
    def query(spark, sf_dir):
        tables = source_of(spark, sf_dir)
        register_views(tables, QUALIFIED, "shop")
        return tables.read_view(name)

    return query


def view(name, views=VIEWS):
    def query(spark, sf_dir):
        tables = source_of(spark, sf_dir)
        register_views(tables, views)
        return tables.read_view(name)

    return query


CHAIN = {
    "v_top": "create view v_top as select * from v_fourth where o_totalprice > 100000",
    "v_fourth": "create view v_fourth as select o_orderkey, o_totalprice from v_third",
    "v_third": "create view v_third as select * from v_second where o_custkey in (select o_custkey from v_first)",
    "v_second": (
        "create view v_second as select f.* from v_first f "
        "join (select o_custkey as c, count(*) as n from v_first group by o_custkey) x on f.o_custkey = x.c"
    ),
    "v_first": "create view v_first as select * from orders",
}


def view_chain(spark, sf_dir):
    """Five views, each of which needs the next, listed from the last to the first."""
    tables = source_of(spark, sf_dir)
    register_views(tables, CHAIN)
    return tables.read_view("v_top")


def view_outcomes(spark, sf_dir):
    tables = source_of(spark, sf_dir)
    broken = {"view_broken": "CREATE VIEW `view_broken` AS select `x` from `nothing`"}
    outcomes = register_views(tables, {**VIEW_OF_VIEW, **VIEWS, **broken})
    sizes = [
        tables.read_view(name).agg(
            F.lit(name).alias("view_name"), F.count(F.lit(1)).alias("n_rows")
        )
        for name in tables.view_names()
    ]
    counted = sizes[0]
    for size in sizes[1:]:
        counted = counted.unionByName(size)
    return outcomes.drop("error").join(counted, "view_name", "left")


def _without_times(tasks: DataFrame) -> DataFrame:
    return tasks.select("table_name", "source_table_rows", "target_table_rows", "is_success")


def migrate_all(spark, sf_dir):
    return _without_times(migrate(source_of(spark, sf_dir), scratch(spark, "all")))


def migrate_subset(spark, sf_dir):
    lines = ["ORDERS,all of them", "", "customer", "   ", "missing"]
    return _without_times(migrate(source_of(spark, sf_dir), scratch(spark, "some"), tables=lines))


def migrated_rows(table):
    def query(spark, sf_dir):
        target = scratch(spark, "rows")
        conf = JobConf(cluster_by={"lineitem": ("l_shipdate",)})
        migrate(source_of(spark, sf_dir), target, conf, tables=[table])
        return target.read(table)

    return query


def migrated_rejects(spark, sf_dir):
    source = source_of(spark, sf_dir, specs={"documents": DOCUMENT_SPECS})
    target = scratch(spark, "rejects")
    migrate(source, target, tables=["documents"])
    kept = target.read("documents").withColumn("reject_reason", F.lit(""))
    return kept.unionByName(target.rejected("documents"))


def migrate_data_only(spark, sf_dir):
    source, target = source_of(spark, sf_dir), scratch(spark, "reload")
    write_table(source.read("part").select("p_size", "p_name", "p_partkey"), target, "part")
    narrow = source.read("part").select("p_partkey", "p_name", "p_size")
    moved = FrameTables(spark, "narrow", {"part": narrow})
    migrate(moved, target, tables=["part"], data_only=True)
    return target.read("part")


def migrate_data_only_rejects(spark, sf_dir):
    specs = [
        ColumnSpec("id", "INT"), ColumnSpec("s", "VARCHAR", 8),
        ColumnSpec("n", "INT", is_nullable=False),
    ]
    wide = source_of(spark, sf_dir).read("orders").select(
        (F.col("o_orderkey") * 1_000_000).alias("id"),
        F.col("o_orderpriority").alias("s"),
        F.nullif(F.col("o_custkey") % 50, F.lit(0)).alias("n"),
    )
    target = ParquetTables(spark, new_folder(spark, "strict"), specs={"t": specs})
    write_table(spark.createDataFrame([], "id int, s string, n int"), target, "t")
    migrate(FrameTables(spark, "wide", {"t": wide}), target, tables=["t"], data_only=True)
    kept = target.read("t").select(F.col("id").cast("bigint"), "s", F.col("n").cast("bigint"))
    return kept.withColumn("reject_reason", F.lit("")).unionByName(target.rejected("t"))


def seek_pages_repeated(spark, sf_dir):
    """A walk over a key with several rows each: all pages together are the table."""
    lines = source_of(spark, sf_dir).read("lineitem")
    limit, last, pages = lines.count() // 4 + 1, None, []
    while True:
        page = seek_page(lines, "l_orderkey", last, limit)
        last = page.agg(F.max("l_orderkey")).first()[0]
        if last is None:
            return reduce(DataFrame.unionByName, pages)
        pages.append(page)


def delimited_plain(spark, sf_dir):
    """Text that quotes only where it must: a bare empty cell is an empty text, the marker NULL."""
    pages = source_of(spark, sf_dir).read("pages").select(
        "page_id",
        F.when(F.col("page_id") % 7 != 0, F.when(F.col("page_id") % 5 == 0, "").otherwise(F.col("html"))).alias("html"),
        F.col("url"),
    )

    def cell(name):
        text = F.col(name).cast("string")
        in_quotes = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.coalesce(F.when(text.rlike('[;"\r\n]'), in_quotes).otherwise(text), F.lit("\\N"))

    path = new_folder(spark, "plain")
    pages.select(F.concat_ws(";", *map(cell, pages.columns)).alias("value")).write.text(path)
    return read_delimited(spark, path, pages.schema)


def _two_sides(spark, sf_dir):
    """The tables, and a copy with no labels, fewer orders, another table and one view less."""
    source = source_of(spark, sf_dir, views=VIEWS)
    frames = {name: source.read(name) for name in TABLES if name != "labels"}
    frames["orders"] = frames["orders"].filter("o_orderstatus <> 'P'")
    frames["leftover"] = source.read("region")
    views = {k: v for k, v in VIEWS.items() if k != "view_clean_documents"}
    frames = {name.upper(): df for name, df in frames.items()}
    return source, FrameTables(spark, "copy", frames, views)


def counts_report(spark, sf_dir):
    return compare_counts(*_two_sides(spark, sf_dir)).drop("compare_time")


def views_report(spark, sf_dir):
    source, target = _two_sides(spark, sf_dir)
    tables = compare_counts(source, target)
    return tables.unionByName(compare_views(source, target)).drop("compare_time")


def failures(spark, sf_dir):
    return compare_failures(compare(*_two_sides(spark, sf_dir))).drop("compare_time")


def totals(spark, sf_dir):
    source, target = _two_sides(spark, sf_dir)
    return object_totals(compare(source, target), target)


def summary(spark, sf_dir):
    source = source_of(spark, sf_dir, views=VIEWS)
    run = migrate_database(
        source,
        scratch(spark, "summary"),
        auto_columns=[AutoColumn("orders", "o_orderkey"), AutoColumn("nothing", "id")],
        constraints=CONSTRAINTS,
    )
    return run.summary


def _changed(df, key, value):
    """A copy with rows lost, added, repeated and changed."""
    kept = df.filter(F.col(key) % 997 != 3)
    changed = kept.withColumn(value, F.when(F.col(key) % 1009 == 5, F.lit(None)).otherwise(F.col(value)))
    again = df.filter(F.col(key) % 1013 == 7)
    new = df.filter(F.col(key) % 1019 == 9).withColumn(key, -F.col(key))
    return changed.unionByName(again).unionByName(new)


def rows_that_differ(spark, sf_dir):
    lines = source_of(spark, sf_dir).read("lineitem")
    theirs = _changed(lines, "l_orderkey", "l_shipdate")
    found = diff_rows(lines, theirs, ["l_orderkey", "l_linenumber"], few_rows=100, cells=1024)
    return found.withColumn("columns", F.array_join("columns", ","))


def documents_that_differ(spark, sf_dir):
    documents = source_of(spark, sf_dir).read("documents")
    theirs = documents.withColumn("text", F.regexp_replace("text", "(?i)license", "licence"))
    dealt = theirs.filter("doc_id % 50 <> 1").repartition("lang", "doc_id")
    found = diff_rows(documents, dealt, ["doc_id"])
    return found.withColumn("columns", F.array_join("columns", ","))


KEYS = {"lineitem": ["l_orderkey", "l_linenumber"], "orders": ["o_orderkey"], "documents": ["doc_id"]}


def migrated_values(spark, sf_dir):
    """All tables after a run, compared value by value; one table has lost rows since."""
    source = source_of(spark, sf_dir)
    target = scratch(spark, "values")
    migrate(source, target)
    write_table(source.read("orders").filter("o_orderkey % 100 <> 0"), target, "orders")
    return compare_values(source, target, KEYS)


class Failing(FrameTables):
    """A live source that goes away once while its pages are read."""

    def page_predicates(self, table, conf):
        return [f"l_orderkey % 4 = {i}" for i in range(4)]

    def read_page(self, table, predicate):
        if not hasattr(self, "failed") and predicate.endswith("2"):
            self.failed = True
            raise OSError("connection lost")
        return super().read_page(table, predicate)


def migrated_after_failure(spark, sf_dir):
    """The second run reads the page that the first one lacked, and writes the table."""
    live = Failing(spark, "live", {"lineitem": source_of(spark, sf_dir).read("lineitem")}, live=True)
    target = scratch(spark, "resumed")
    conf = JobConf(resume_dir=new_folder(spark, "pages"))
    migrate(live, target, conf)
    migrate(live, target, conf)
    return target.read("lineitem")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Move two tables, then compare both sides."""
    source = source_of(spark, sf_dir)
    target = scratch(spark, "flagship")
    moved = ["orders", "customer"]
    migrate(source, target, tables=moved)
    chosen = FrameTables(spark, source.name, {name: source.read(name) for name in moved})
    return compare_counts(chosen, target)


QUERIES = {
    "q_full_scan": full_scan,
    "q_paged_scan": paged_scan,
    "q_paged_scan_joined": paged_scan_joined,
    "q_paged_scan_composite": paged_scan_composite,
    "q_page_bounds": bounds_of("orders", "o_orderkey", 4000, 3),
    "q_page_bounds_repeated": bounds_of("lineitem", "l_orderkey", 10000, 4),
    "q_page_bounds_text": bounds_of("customer", "c_name", 400, 3),
    "q_page_bounds_time": bounds_of("events", "ts", 700, 4),
    "q_page_bounds_hot": bounds_of("lineitem", "l_linenumber", 1000, 4),
    "q_seek_page": seek,
    "q_seek_pages_repeated": seek_pages_repeated,
    "q_offset_page": offset,
    "q_offset_page_deep": offset_deep,
    "q_offset_page_hot": offset_hot,
    "q_binary_hex": binary_hex,
    "q_binary_decode": binary_decode,
    "q_bits": bits_flags,
    "q_bits_wide": bits_wide,
    "q_conform": conform_customer,
    "q_conform_text": conform_text,
    "q_fit_report": fit,
    "q_fit_report_bytes": fit_bytes,
    "q_quarantine": quarantine,
    "q_quarantine_staged": quarantine_staged,
    "q_accepted": accepted,
    "q_defaults": defaults,
    "q_sequence_append": sequence_append,
    "q_sequence_own_keys": sequence_own_keys,
    "q_sequence_starts": sequences,
    "q_overwrite": overwrite,
    "q_data_only": data_only,
    "q_clustered": cluster,
    "q_clustered_curve": cluster_by_curve,
    "q_delimited_roundtrip": delimited_pages,
    "q_delimited_split": delimited_split,
    "q_delimited_gaps": delimited_gaps,
    "q_delimited_plain": delimited_plain,
    "q_delimited_typed": delimited_orders,
    "q_check_pk": check_pk,
    "q_check_pk_nulls": check_pk_nulls,
    "q_check_unique": check_uniqueness,
    "q_check_fk": check_fk,
    "q_check_fk_multi": check_fk_multi,
    "q_run_checks": checks,
    "q_view_join2": view("view_order_customer"),
    "q_view_join3": view("view_line_part_order"),
    "q_view_filter": view("view_clean_documents"),
    "q_view_of_view": view("a_clean_per_lang", {**VIEW_OF_VIEW, **VIEWS}),
    "q_view_outcomes": view_outcomes,
    "q_view_chain": view_chain,
    "q_view_qualified": qualified_view("view_big_orders"),
    "q_view_columns": qualified_view("view_names"),
    "q_conform_times": conform_times,
    "q_migrate_all": migrate_all,
    "q_migrate_subset": migrate_subset,
    "q_migrate_lineitem": migrated_rows("lineitem"),
    "q_migrate_events": migrated_rows("events"),
    "q_migrate_rejects": migrated_rejects,
    "q_migrate_data_only": migrate_data_only,
    "q_migrate_data_only_rejects": migrate_data_only_rejects,
    "q_compare_counts": counts_report,
    "q_compare_views": views_report,
    "q_compare_failures": failures,
    "q_object_totals": totals,
    "q_summary": summary,
    "q_diff_rows": rows_that_differ,
    "q_diff_documents": documents_that_differ,
    "q_migrate_values": migrated_values,
    "q_migrate_resumed": migrated_after_failure,
}
