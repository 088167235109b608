"""The same results in SQL, by query name."""

from __future__ import annotations

from demo_queries import TABLES, VIEWS


def _pages(table: str, key: str, page_size: int, shards: int) -> str:
    return f"""
        with ks as (select {key} as k, count(*) as c from {table} group by 1),
        placed as (select k, c, (sum(c) over (order by k) - c) // {page_size} as raw from ks),
        pages as (select raw, min(k) as lo, max(k) as hi, cast(sum(c) as bigint) as n_rows
                  from placed group by raw),
        numbered as (select row_number() over (order by raw) - 1 as page, lo, hi, n_rows,
                     count(*) over () as n_pages from pages)
        select cast(page as bigint) as page, lo, hi, n_rows,
               cast(page * least({shards}, n_pages) // n_pages as int) as shard
        from numbered"""


def _page_tags() -> str:
    return """
        with ks as (select l_orderkey as k, count(*) as c from lineitem group by 1),
        placed as (select k, (sum(c) over (order by k) - c) // 10000 as raw from ks),
        numbered as (select k, dense_rank() over (order by raw) - 1 as page from placed)
        select l_orderkey, l_linenumber, cast(page as bigint) as page
        from lineitem join numbered on l_orderkey = k"""


def _violation_counts(table: str, rules: list[tuple[str, str, str]]) -> str:
    return " union all ".join(
        f"select '{column}' as column_name, '{rule}' as rule, "
        f"count(*) filter ({test}) as violations from {table}"
        for column, rule, test in rules
    )


_NULL_SEGMENT = (
    "(select c_custkey, c_acctbal, case when c_nationkey <> 0 then c_mktsegment end "
    "as c_mktsegment from customer)"
)
_TEXT_EVENTS = (
    "(select event_id, case when event_type = 'error' then '0000-00-00 00:00:00' "
    "else cast(ts as varchar) end as seen_at, cast(value as varchar) as value from events)"
)
_BAD_BALANCE = "try_cast(c_acctbal as decimal(5,2)) is null"
_REASONS = (
    "select *, concat_ws(',', case when {balance} then 'c_acctbal:decimal' end, "
    "case when c_mktsegment is null then 'c_mktsegment:not_null' end, "
    "case when length(c_mktsegment) > 8 then 'c_mktsegment:length' end) as reject_reason from {t}"
).format(balance=_BAD_BALANCE, t=_NULL_SEGMENT)
_DOCUMENT_REASON = (
    "concat_ws(',', case when length(text) > 255 then 'text:length' end, "
    "case when length(source) > 4 then 'source:length' end)"
)


def _table_report(where: str = "true") -> str:
    lines = []
    for number, name in enumerate(sorted(TABLES), 1):
        target, rows = f"'{name.upper()}'", f"(select count(*) from {name})"
        found = rows
        if name == "labels":
            target, found = "'TABLE NOT EXIST'", "cast(-1 as bigint)"
        if name == "orders":
            found = "(select count(*) from orders where o_orderstatus <> 'P')"
        lines.append(
            f"select {number} as id, 'TESTDATA' as source_db_name, '{name.upper()}' as "
            f"source_table_name, {rows} as source_rows, 'TABLE' as db_type, "
            f"{target} as target_table_name, {found} as target_rows"
        )
    return _verdicts(" union all ".join(lines), where)


def _full_report(where: str = "true") -> str:
    lines = []
    for number, name in enumerate(sorted(VIEWS), len(TABLES) + 1):
        target = "NOT EXISTS VIEW" if name == "view_clean_documents" else name.upper()
        lines.append(
            f"select {number} as id, 'TESTDATA' as source_db_name, '{name.upper()}' as "
            f"source_table_name, cast(0 as bigint) as source_rows, 'VIEW' as db_type, "
            f"'{target}' as target_table_name, cast(0 as bigint) as target_rows"
        )
    views = _verdicts(" union all ".join(lines), where)
    return f"{_table_report(where)} union all {views}"


def _verdicts(lines: str, where: str) -> str:
    return (
        "select * from (select *, case when source_rows = target_rows and "
        "source_table_name = target_table_name then 'Y' else 'N' end as is_success "
        f"from ({lines})) where {where}"
    )


def _copied(names) -> str:
    return " union all ".join(
        f"select '{n}' as table_name, count(*) as source_table_rows, "
        f"count(*) as target_table_rows, 'Y' as is_success from {n}"
        for n in names
    )


_DUPLICATE_LINES = (
    "select l_orderkey, l_linenumber, count(*) as dup_count from lineitem "
    "group by 1, 2 having count(*) > 1"
)
_CHECKS = f"""
    with found as (
        select 'primary key' as kind, 'orders' as table_name, 'PRIMARY' as constraint_name,
               (select count(*) from (select o_orderkey from orders group by 1
                                      having count(*) > 1)) as violations
        union all select 'primary key', 'lineitem', 'PRIMARY',
               (select count(*) from ({_DUPLICATE_LINES}))
        union all select 'unique', 'customer', 'uq_name',
               (select count(*) from (select c_name from customer group by 1 having count(*) > 1))
        union all select 'index', 'orders', 'ix_customer', 0
        union all select 'foreign key', 'orders', 'fk_customer',
               (select count(*) from orders where not exists
                    (select 1 from customer where c_custkey = o_custkey))
        union all select 'foreign key', 'labels', 'fk_flag',
               (select count(*) from labels where not exists
                    (select 1 from region where r_regionkey = quality))
        union all select 'foreign key', 'lineitem', 'fk_none',
               (select count(*) from lineitem where not exists
                    (select 1 from nation where n_nationkey = l_suppkey)))
    select *, case when violations = 0 then 'Y' else 'N' end as is_success from found"""
_CLEAN_DOCUMENTS = (
    "select d.doc_id, upper(lang) as lang, 'VIEW convert(x using y)' as note "
    "from documents d join labels l on d.doc_id = l.doc_id where toxic = 0"
)

ORACLES = {
    "q_full_scan": "select o_orderkey, o_custkey, o_totalprice from orders",
    "q_paged_scan": (
        "select *, cast((row_number() over (order by event_id) - 1) // 2500 as bigint) as page "
        "from events"
    ),
    "q_paged_scan_joined": _page_tags(),
    "q_paged_scan_composite": "select l_orderkey, l_linenumber, 1 as hits, true as is_even from lineitem",
    "q_page_bounds": _pages("orders", "o_orderkey", 4000, 3),
    "q_page_bounds_repeated": _pages("lineitem", "l_orderkey", 10000, 4),
    "q_page_bounds_text": _pages("customer", "c_name", 400, 3),
    "q_page_bounds_time": _pages("events", "ts", 700, 4),
    "q_page_bounds_hot": _pages("lineitem", "l_linenumber", 1000, 4),
    "q_seek_pages_repeated": "select * from lineitem",
    "q_migrate_data_only_rejects": """
        select *, concat_ws(',', case when id > 2147483647 then 'id:cast' end,
            case when length(s) > 8 then 's:length' end, case when n is null then 'n:not_null' end
        ) as reject_reason
        from (select o_orderkey * 1000000 as id, o_orderpriority as s, nullif(o_custkey % 50, 0) as n from orders)
    """,
    "q_delimited_plain": """
        select page_id, url, case when page_id % 7 = 0 then null when page_id % 5 = 0 then '' else html end as html
        from pages
    """,
    "q_seek_page": "select * from orders where o_orderkey > 7499 order by o_orderkey limit 500",
    "q_offset_page": "select * from orders order by o_custkey, o_orderkey limit 500 offset 5000",
    "q_offset_page_deep": "select * from events order by ts, event_id limit 50 offset 900",
    "q_offset_page_hot": "select l_linestatus, l_orderkey, l_linenumber from lineitem "
    "order by 1, 2, 3 limit 300 offset 4000",
    "q_binary_hex": (
        "select c_custkey, case when c_nationkey <> 0 "
        "then concat('\\x', hex(encode(c_name))) end as c_name from customer"
    ),
    "q_binary_decode": (
        "select c_custkey, case when c_nationkey <> 0 then c_name end as c_name from customer"
    ),
    "q_bits": "select doc_id, quality = 1 as quality, toxic = 1 as toxic from labels",
    "q_bits_wide": "select o_orderkey, o_custkey as flags from orders",
    "q_conform": (
        "select cast(c_custkey as int) as c_custkey, c_name, cast(c_nationkey as bigint) as "
        "c_nationkey, cast(c_acctbal as decimal(15,2)) as c_acctbal, c_mktsegment from customer"
    ),
    "q_conform_text": (
        "select cast(event_id as int) as event_id, try_cast(seen_at as timestamp) as seen_at, "
        f"try_cast(value as decimal(4,2)) as value from {_TEXT_EVENTS}"
    ),
    "q_fit_report": " union all ".join(
        [
            _violation_counts(
                "documents",
                [
                    ("doc_id", "not_null", "doc_id is null"),
                    ("text", "length", "length(text) > 255"),
                    ("lang", "length", "length(lang) > 2"),
                    ("source", "length", "length(source) > 4"),
                ],
            ),
            _violation_counts(
                _NULL_SEGMENT,
                [
                    ("c_custkey", "not_null", "c_custkey is null"),
                    ("c_acctbal", "decimal", _BAD_BALANCE),
                    ("c_mktsegment", "not_null", "c_mktsegment is null"),
                    ("c_mktsegment", "length", "length(c_mktsegment) > 8"),
                ],
            ),
            _violation_counts(
                _TEXT_EVENTS,
                [
                    ("event_id", "not_null", "event_id is null"),
                    ("event_id", "cast", "try_cast(event_id as int) is null"),
                    ("seen_at", "not_null", "seen_at is null"),
                    ("seen_at", "cast", "try_cast(seen_at as timestamp) is null"),
                    ("value", "decimal", "try_cast(value as decimal(4,2)) is null"),
                    ("value", "cast", "try_cast(value as double) is null"),
                ],
            ),
        ]
    ),
    "q_fit_report_bytes": _violation_counts(
        "documents",
        [
            ("doc_id", "not_null", "doc_id is null"),
            ("text", "length", "strlen(text) > 255"),
            ("lang", "length", "strlen(lang) > 2"),
            ("source", "length", "strlen(source) > 4"),
        ],
    ),
    "q_quarantine": (
        f"select * from (select *, {_DOCUMENT_REASON} as reject_reason from documents) "
        "where reject_reason <> ''"
    ),
    "q_quarantine_staged": f"select * from ({_REASONS}) where reject_reason <> ''",
    "q_accepted": (
        "select c_custkey, cast(c_acctbal as decimal(5,2)) as c_acctbal, c_mktsegment "
        f"from ({_REASONS}) where reject_reason = ''"
    ),
    "q_defaults": (
        "select n_nationkey, n_name, 9 as n_regionkey, '' as n_comment, "
        "timestamp '2020-01-01 00:00:00' as n_added from nation"
    ),
    "q_sequence_append": (
        "select * from customer union all select (select max(c_custkey) from customer) + "
        "row_number() over (order by s_name) as c_custkey, s_name, s_nationkey, s_acctbal, "
        "'SUPPLIER' from supplier"
    ),
    "q_sequence_own_keys": """
        with own as (select o_orderkey + 1000000000 as k, o_orderstatus from orders
                     where o_orderstatus = 'F'),
        fresh as (select row_number() over (order by o_orderstatus) as n, o_orderstatus
                  from orders where o_orderstatus <> 'F')
        select o_orderkey, o_orderstatus from orders
        union all select k, o_orderstatus from own
        union all select (select max(k) from own) + n, o_orderstatus from fresh""",
    "q_sequence_starts": """
        select 'orders' as table_name, 'o_orderkey' as column_name,
               'ORDERS_O_ORDERKEY_SEQ' as sequence_name,
               (select max(o_orderkey) + 1 from orders) as next_value, 'Y' as is_success
        union all select 'customer', 'c_custkey', 'CUSTOMER_C_CUSTKEY_SEQ',
               (select greatest(max(c_custkey) + 1, 1000000) from customer), 'Y'
        union all select 'nothing', 'id', 'NOTHING_ID_SEQ', null, 'N'""",
    "q_overwrite": "select * from customer",
    "q_data_only": "select * from supplier",
    "q_clustered": "select * from orders",
    "q_delimited_roundtrip": "select * from pages",
    "q_clustered_curve": "select * from orders",
    "q_view_chain": "select o_orderkey, o_totalprice from orders where o_totalprice > 100000",
    "q_delimited_split": "select * from documents",
    "q_diff_rows": """
        with theirs as (
            select * replace (case when l_orderkey % 1009 = 5 then null else l_shipdate end as l_shipdate)
            from lineitem where l_orderkey % 997 <> 3
            union all select * from lineitem where l_orderkey % 1013 = 7
            union all select * replace (-l_orderkey as l_orderkey) from lineitem where l_orderkey % 1019 = 9
        ), o as (
            select l_orderkey, l_linenumber, count(*) as n, list_sort(list(lineitem::varchar)) as v, min(l_shipdate) as d
            from lineitem group by all
        ), t as (
            select l_orderkey, l_linenumber, count(*) as n, list_sort(list(theirs::varchar)) as v, min(l_shipdate) as d
            from theirs group by all
        )
        select l_orderkey, l_linenumber,
            case when t.n is null then 'missing' when o.n is null then 'extra' else 'changed' end as change,
            coalesce(o.n, 0) as source_rows, coalesce(t.n, 0) as target_rows,
            case when o.n = 1 and t.n = 1 then 'l_shipdate' end as columns
        from o full join t using (l_orderkey, l_linenumber) where o.v is distinct from t.v
    """,
    "q_diff_documents": """
        select doc_id, case when doc_id % 50 = 1 then 'missing' else 'changed' end as change, 1::bigint as source_rows,
            case when doc_id % 50 = 1 then 0 else 1 end::bigint as target_rows,
            case when doc_id % 50 <> 1 then 'text' end as columns
        from documents
        where doc_id % 50 = 1 or text <> regexp_replace(text, 'license', 'licence', 'gi')
    """,
    "q_migrate_values": " union all ".join(
        f"select '{table}' as table_name, "
        + ("(select count(*) from orders where o_orderkey % 100 = 0)" if table == "orders" else "0::bigint")
        + " as missing, 0::bigint as extra, 0::bigint as changed, "
        + (
            "case when exists (from orders where o_orderkey % 100 = 0) then 'N' else 'Y' end as is_success"
            if table == "orders" else "'Y' as is_success"
        )
        for table in sorted(TABLES)
    ),
    "q_delimited_gaps": (
        "select doc_id, text, case lang when 'en' then '' when 'fr' then '\\N' "
        "when 'de' then null else lang end as lang, source, n_chars from documents"
    ),
    "q_delimited_typed": "select * from orders",
    "q_check_pk": _DUPLICATE_LINES,
    "q_check_pk_nulls": (
        "select c_custkey, nullif(c_mktsegment, 'BUILDING') as segment, count(*) as dup_count "
        "from customer group by 1, 2 having count(*) > 1 or segment is null"
    ),
    "q_check_unique": (
        "select * from (select c_nationkey, nullif(c_mktsegment, 'BUILDING') as segment, "
        "count(*) as dup_count from customer group by 1, 2) "
        "where dup_count > 1 and segment is not null"
    ),
    "q_check_fk": (
        "select * from orders where not exists (select 1 from customer "
        "where c_custkey = o_custkey and c_acctbal > 0)"
    ),
    "q_check_fk_multi": (
        "select l_orderkey, l_linenumber, l_partkey, l_returnflag as flag from lineitem c "
        "where l_returnflag <> 'A' and not exists (select 1 from lineitem p "
        "where p.l_linestatus = 'F' and p.l_partkey = c.l_partkey "
        "and p.l_returnflag = c.l_returnflag)"
    ),
    "q_run_checks": _CHECKS,
    "q_view_join2": (
        "select o_orderkey, c_name, o_totalprice from orders join customer "
        "on o_custkey = c_custkey"
    ),
    "q_view_join3": (
        "select l_orderkey, l_linenumber, p_brand, o_orderpriority from lineitem "
        "join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey"
    ),
    "q_view_filter": _CLEAN_DOCUMENTS,
    "q_view_of_view": f"select lang, count(*) as n from ({_CLEAN_DOCUMENTS}) group by lang",
    "q_view_qualified": (
        "select o_orderkey, 'shop.x' as tag from orders where o_totalprice > 100000"
    ),
    "q_view_columns": "select c_custkey as id, c_name as label from customer",
    "q_conform_times": """
        select event_id,
               case when event_id % 100 <> 0 then strftime(ts, '%H:%M:%S') end as at,
               case when event_id % 100 <> 0 then year(ts)::int end as in_year,
               case when event_id % 100 <> 0 then strftime(ts, '%Y-%m-%d') end as on_day,
               case when event_id % 100 = 0 then 'on_day:cast' else '' end as reject_reason
        from events""",
    "q_view_outcomes": f"""
        select 'view_order_customer' as view_name, 'Y' as is_success,
               (select count(*) from orders join customer on o_custkey = c_custkey) as n_rows
        union all select 'view_line_part_order', 'Y',
               (select count(*) from lineitem join part on l_partkey = p_partkey
                join orders on l_orderkey = o_orderkey)
        union all select 'view_clean_documents', 'Y', (select count(*) from ({_CLEAN_DOCUMENTS}))
        union all select 'a_clean_per_lang', 'Y',
               (select count(distinct lang) from ({_CLEAN_DOCUMENTS}))
        union all select 'view_broken', 'N', null""",
    "q_migrate_all": _copied(sorted(TABLES)),
    "q_migrate_subset": (
        f"{_copied(['orders', 'customer'])} "
        "union all select 'missing', cast(null as bigint), cast(null as bigint), 'N'"
    ),
    "q_migrate_lineitem": "select * from lineitem",
    "q_migrate_resumed": "select * from lineitem",
    "q_migrate_events": "select * from events",
    "q_migrate_rejects": f"select *, {_DOCUMENT_REASON} as reject_reason from documents",
    "q_migrate_data_only": "select p_size, p_name, p_partkey from part",
    "q_compare_counts": _table_report(),
    "q_compare_views": _full_report(),
    "q_compare_failures": (
        f"select *, target_rows - source_rows as delta from ({_full_report()}) "
        "where is_success = 'N'"
    ),
    "q_object_totals": f"""
        select db_type, count(*) as source_total,
               cast(case db_type when 'TABLE' then {len(TABLES)} else {len(VIEWS) - 1} end
                    as bigint) as target_total,
               cast(sum(source_rows) as bigint) as source_rows,
               cast(sum(case when target_rows >= 0 then target_rows end) as bigint) as target_rows
        from ({_full_report()}) group by db_type""",
    "q_summary": f"""
        with checks as ({_CHECKS}),
        kinds as (
            select 'tables' as kind, 'Y' as is_success from range({len(TABLES)})
            union all select 'views', 'Y' from range({len(VIEWS)})
            union all select 'auto columns', 'Y'
            union all select 'auto columns', 'N'
            union all select case kind when 'foreign key' then 'foreign keys'
                             else 'indexes/constraints' end, is_success from checks)
        select kind, count(*) as total, count(*) filter (is_success = 'Y') as success,
               count(*) filter (is_success = 'N') as failed
        from kinds group by kind""",
}
