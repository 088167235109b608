"""Tables of a database reached over JDBC."""

from __future__ import annotations

import datetime
import decimal
import re
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablehaul.conf import JobConf
from tablehaul.functions.keys import FOREIGN, PRIMARY, UNIQUE, AutoColumn, Constraint
from tablehaul.functions.types import ColumnSpec
from tablehaul.operators.checks import constraints_from_catalog
from tablehaul.operators.paging import shard_bounds
from tablehaul.shared import stage, unstage
from tablehaul.sources.keysets import (
    Key,
    keyset_predicates,
    numbered_starts_sql,
    places,
    probe_sql,
    probed_starts,
)
from tablehaul.sources.tables import REJECTED_SUFFIX, TableSet

#: Of the table that a load fills before its rows are published.
LOADING_SUFFIX = "__loading"
PLACE = "load_place"


@dataclass(frozen=True)
class Dialect:
    """How a database quotes names, and where its catalog lists things.

    ``session`` runs on every reading connection and ``properties`` go to the driver. Without
    ``columns_sql`` the columns are those that Spark sees, and without ``indexes_sql`` no keys are
    known. ``has_ntile`` is off for servers without window functions, ``lower_names`` on for
    those that fold unquoted names. ``long_type`` is what a cast calls 64-bit numbers.
    """

    quote: str
    tables_sql: str
    views_sql: str
    key_sql: str
    columns_sql: str = ""
    indexes_sql: str = ""
    key_usage_sql: str = ""
    references_sql: str = ""
    auto_columns_sql: str = ""
    session: str = ""
    has_ntile: bool = True
    long_type: str = "BIGINT"
    lower_names: bool = False
    backslash_escapes: bool = False
    properties: Mapping[str, str] = field(default_factory=dict)

    def literal(self, value: Any) -> str:
        """A value as a SQL literal."""
        if isinstance(value, bool):
            return "TRUE" if value else "FALSE"
        if isinstance(value, (int, float, decimal.Decimal)):
            return str(value)
        if isinstance(value, (bytes, bytearray)):
            return f"X'{bytes(value).hex()}'"
        if isinstance(value, datetime.datetime):
            return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
        if isinstance(value, datetime.date):
            return f"DATE '{value.isoformat()}'"
        text = str(value)
        if self.backslash_escapes:
            text = text.replace("\\", "\\\\")
        return "'" + text.replace("'", "''") + "'"

    def name(self, identifier: str) -> str:
        return self.quote + identifier.replace(self.quote, self.quote * 2) + self.quote


MYSQL = Dialect(
    quote="`",
    tables_sql=(
        "SELECT table_name AS table_name FROM information_schema.tables "
        "WHERE table_schema = DATABASE() AND table_type = 'BASE TABLE'"
    ),
    views_sql=(
        "SELECT table_name AS view_name, view_definition AS body "
        "FROM information_schema.views WHERE table_schema = DATABASE()"
    ),
    columns_sql=(
        "SELECT column_name AS column_name, data_type AS data_type, "
        "character_maximum_length AS character_maximum_length, is_nullable AS is_nullable, "
        "column_default AS column_default, numeric_precision AS numeric_precision, "
        "numeric_scale AS numeric_scale, datetime_precision AS datetime_precision, "
        "column_key AS column_key, column_comment AS column_comment, "
        "column_type AS column_type, extra AS extra, ordinal_position AS ordinal_position "
        "FROM information_schema.columns "
        "WHERE table_schema = DATABASE() AND table_name = {table}"
    ),
    key_sql=(
        "SELECT c.column_name AS column_name, c.column_key AS column_key, c.extra AS extra, "
        "k.ordinal_position AS position FROM information_schema.columns c "
        "LEFT JOIN information_schema.key_column_usage k ON k.table_schema = c.table_schema "
        "AND k.table_name = c.table_name AND k.column_name = c.column_name "
        "AND k.constraint_name = 'PRIMARY' "
        "WHERE c.table_schema = DATABASE() AND c.table_name = {table}"
    ),
    indexes_sql=(
        "SELECT table_name AS table_name, index_name AS index_name, non_unique AS non_unique, "
        "column_name AS column_name, seq_in_index AS seq_in_index "
        "FROM information_schema.statistics "
        "WHERE table_schema = DATABASE() AND index_type NOT IN ('FULLTEXT', 'SPATIAL')"
    ),
    key_usage_sql=(
        "SELECT constraint_name AS constraint_name, table_name AS table_name, "
        "column_name AS column_name, ordinal_position AS ordinal_position, "
        "referenced_table_name AS referenced_table_name, "
        "referenced_column_name AS referenced_column_name "
        "FROM information_schema.key_column_usage WHERE constraint_schema = DATABASE()"
    ),
    references_sql=(
        "SELECT table_name AS table_name, constraint_name AS constraint_name "
        "FROM information_schema.referential_constraints WHERE constraint_schema = DATABASE()"
    ),
    auto_columns_sql=(
        "SELECT c.table_name AS table_name, c.column_name AS column_name, "
        "t.auto_increment AS next_value FROM information_schema.columns c "
        "JOIN information_schema.tables t "
        "ON t.table_schema = c.table_schema AND t.table_name = c.table_name "
        "WHERE c.table_schema = DATABASE() AND c.extra LIKE '%auto_increment%'"
    ),
    backslash_escapes=True,
    long_type="SIGNED",
    properties={"tinyInt1isBit": "false"},
)

MYSQL_57 = replace(MYSQL, has_ntile=False)

POSTGRESQL = Dialect(
    quote='"',
    tables_sql=(
        "SELECT table_name FROM information_schema.tables "
        "WHERE table_schema = current_schema() AND table_type = 'BASE TABLE'"
    ),
    views_sql=(
        "SELECT table_name AS view_name, view_definition AS body "
        "FROM information_schema.views WHERE table_schema = current_schema()"
    ),
    key_sql=(
        "SELECT k.column_name AS column_name, 'PRI' AS column_key, '' AS extra, "
        "k.ordinal_position AS position "
        "FROM information_schema.table_constraints c "
        "JOIN information_schema.key_column_usage k ON k.constraint_name = c.constraint_name "
        "AND k.table_schema = c.table_schema AND k.table_name = c.table_name "
        "WHERE c.constraint_type = 'PRIMARY KEY' AND c.table_schema = current_schema() "
        "AND c.table_name = {table}"
    ),
    session="SET datestyle = 'YMD'",
    lower_names=True,
)


def shard_predicates(key: str, starts: Sequence[Any], dialect: Dialect) -> list[str]:
    """:func:`keyset_predicates` of a key of one column. ``starts`` are the lowest keys of the shards."""
    return keyset_predicates([key], [(s,) for s in starts], dialect)


def reading_shards(
    rows: int, page_size: int, parallelism: int, rows_per_task: int | None = None
) -> int:
    """How many tasks read a table: ``parallelism`` or, of a large one, as many as its rows ask for.

    No more than it has pages.
    """
    pages = -(-rows // page_size)
    wanted = max(parallelism, -(-rows // rows_per_task)) if rows_per_task else parallelism
    return max(1, min(wanted, pages))


def writing_tasks(rows: int, conf: JobConf) -> int:
    """How many tasks write a table: ``write_parallelism`` or, of a large one, as many as its rows ask for."""
    wanted = max(conf.write_parallelism, -(-rows // conf.rows_per_task) if conf.rows_per_task else 1)
    return min(wanted, conf.max_connections or wanted)


def shard_start_sql(table: str, key: str, shards: int, dialect: Dialect) -> str:
    """A query the database answers with the lowest key of each of ``shards`` equal parts.

    The database orders the key itself, so this holds for text keys under any collation.
    """
    k = dialect.name(key)
    return (
        f"SELECT shard, MIN({k}) AS lo, COUNT(*) AS n_rows FROM "
        f"(SELECT {k}, NTILE({shards}) OVER (ORDER BY {k}) AS shard FROM {dialect.name(table)}) t "
        f"GROUP BY shard"
    )


def paging_key(keys: Sequence[Mapping[str, str]]) -> str | None:
    """The column to page by: a primary key of one column, else an auto-increment column."""
    primary = [k["column_name"] for k in keys if k["column_key"] == "PRI"]
    if len(primary) == 1:
        return primary[0]
    auto = [k["column_name"] for k in keys if "auto_increment" in k["extra"].lower()]
    return auto[0] if auto else None


def paging_keys(keys: Sequence[Mapping[str, Any]]) -> tuple[str, ...]:
    """The columns to page by: :func:`paging_key`, else all columns of the primary key in its order."""
    single = paging_key(keys)
    if single is not None:
        return (single,)
    primary = [k for k in keys if k["column_key"] == "PRI"]
    return tuple(k["column_name"] for k in sorted(primary, key=lambda k: int(k.get("position") or 0)))


_QUOTED = re.compile(r"'(?:[^'\\]|\\.|'')*'|`((?:[^`]|``)+)`", re.DOTALL)


def requoted(body: str, dialect: Dialect) -> str:
    """A view's text with its names in backticks quoted, and folded, as the dialect has them; literals stay."""

    def name(match: re.Match) -> str:
        if match[1] is None:
            return match[0]
        plain = match[1].replace("``", "`")
        return dialect.name(plain.lower() if dialect.lower_names else plain)

    return _QUOTED.sub(name, body)


def violations_sql(constraint: Constraint, dialect: Dialect) -> str | None:
    """A query that counts a key's violations in the database itself, as :func:`run_checks` counts them."""
    name = dialect.name
    cols, table = [name(c) for c in constraint.columns], name(constraint.table)
    named = ", ".join(cols)
    known = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    if constraint.kind == PRIMARY:
        holds = f"GROUP BY {named} HAVING COUNT(*) > 1 OR NOT ({known})"
        return f"SELECT COUNT(*) AS n FROM (SELECT {named} FROM {table} {holds}) t"
    if constraint.kind == UNIQUE:
        holds = f"WHERE {known} GROUP BY {named} HAVING COUNT(*) > 1"
        return f"SELECT COUNT(*) AS n FROM (SELECT {named} FROM {table} {holds}) t"
    if constraint.kind == FOREIGN:
        known = " AND ".join(f"c.{c} IS NOT NULL" for c in cols)
        pairs = zip(constraint.parent_columns, cols, strict=True)
        same = " AND ".join(f"p.{name(p)} = c.{c}" for p, c in pairs)
        return (
            f"SELECT COUNT(*) AS n FROM {table} c WHERE {known} "
            f"AND NOT EXISTS (SELECT 1 FROM {name(constraint.parent)} p WHERE {same})"
        )
    return None


def publish_sql(table: str, staging: str, columns: Sequence[str], repeated: bool, dialect: Dialect) -> list[str]:
    """The statements of the transaction that makes the staged rows the table's.

    A task that ran twice has left its rows twice, each with its place; ``repeated`` says that some have.
    """
    named = ", ".join(dialect.name(c) for c in columns)
    staged, place = dialect.name(staging), dialect.name(PLACE)
    rows = f"(SELECT DISTINCT {place}, {named} FROM {staged}) s" if repeated else staged
    return [
        f"DELETE FROM {dialect.name(table)}",
        f"INSERT INTO {dialect.name(table)} ({named}) SELECT {named} FROM {rows}",
    ]


class JdbcTables(TableSet):
    """A database schema. ``properties`` holds user, password and driver and is never shown."""

    def __init__(
        self,
        spark: SparkSession,
        url: str,
        properties: Mapping[str, str],
        dialect: Dialect,
        name: str,
        conf: JobConf = JobConf(),
    ) -> None:
        super().__init__(spark, name)
        self.url = url
        self._properties = dict(properties)
        self.dialect = dialect
        self.conf = conf
        self._names: list[str] | None = None

    def __repr__(self) -> str:
        return f"JdbcTables({self.name!r})"

    def reads_repeat(self) -> bool:
        return False

    def read_options(self) -> dict[str, str]:
        options = {
            **self.dialect.properties,
            **self._properties,
            "url": self.url,
            "fetchsize": str(self.conf.fetchsize),
            "preferTimestampNTZ": "true",
        }
        if self.dialect.session:
            options["sessionInitStatement"] = self.dialect.session
        return options

    def query(self, sql: str) -> DataFrame:
        """Rows of a query that the database runs."""
        return self.spark.read.format("jdbc").options(**self.read_options(), query=sql).load()

    def all_names(self) -> list[str]:
        if self._names is None:
            self._names = sorted(r[0] for r in self.query(self.dialect.tables_sql).collect())
        return [n for n in self._names if not n.endswith((REJECTED_SUFFIX, LOADING_SUFFIX))]

    def spelled(self, table: str) -> str:
        name = super().spelled(table)
        is_new = name not in self.all_names()
        return name.lower() if is_new and self.dialect.lower_names else name

    def view_definitions(self) -> dict[str, str]:
        return {r[0]: r[1] for r in self.query(self.dialect.views_sql).collect()}

    def view_names(self) -> list[str]:
        """The database's views, and those registered with Spark on its tables."""
        return sorted({*self.view_definitions(), *self._views})

    def create_view(self, name: str, body: str) -> None:
        """Define a view with Spark, or with ``database_views`` in the database itself, as it spells names."""
        if not self.conf.database_views:
            super().create_view(name, body)
            return
        text = requoted(body, self.dialect)
        self.execute([f"CREATE OR REPLACE VIEW {self.dialect.name(self.folded(name))} AS {text}"])
        self._views[self.folded(name)] = body

    def read_view(self, name: str) -> DataFrame:
        return self._frame(self.folded(name)) if self.conf.database_views else super().read_view(name)

    def folded(self, name: str) -> str:
        return name.lower() if self.dialect.lower_names else name

    def expose_tables(self, text: str) -> None:
        if not self.conf.database_views:
            super().expose_tables(text)

    def columns(self, table: str, df: DataFrame | None = None) -> list[ColumnSpec]:
        if not self.dialect.columns_sql:
            return super().columns(table, df)
        sql = self.dialect.columns_sql.format(table=self.dialect.literal(self.resolve(table)))
        records = self.query(sql).orderBy("ordinal_position").collect()
        return [column_record(r.asDict()) for r in records]

    def constraints(self) -> list[Constraint]:
        if not self.dialect.indexes_sql:
            return []
        return constraints_from_catalog(
            self.query(self.dialect.indexes_sql),
            self.query(self.dialect.key_usage_sql),
            self.query(self.dialect.references_sql),
        )

    def auto_columns(self) -> list[AutoColumn]:
        if not self.dialect.auto_columns_sql:
            return []
        found = self.query(self.dialect.auto_columns_sql).orderBy("table_name").collect()
        return [
            AutoColumn(
                r.table_name, r.column_name, None if r.next_value is None else int(r.next_value)
            )
            for r in found
        ]

    def _frame(self, name: str) -> DataFrame:
        return (
            self.spark.read.format("jdbc")
            .options(**self.read_options(), dbtable=self.dialect.name(name))
            .load()
        )

    def _read_ranges(self, table: str, predicates: list[str]) -> DataFrame:
        options = self.read_options()
        options.pop("url")
        return self.spark.read.jdbc(
            self.url, self.dialect.name(table), predicates=predicates, properties=options
        )

    def _read_equal_ranges(self, table: str, key: str, parts: int) -> DataFrame:
        k = self.dialect.name(key)
        ends = self.query(
            f"SELECT MIN({k}) AS lo, MAX({k}) AS hi FROM {self.dialect.name(table)}"
        ).first()
        if ends.lo is None:
            return self._frame(table)
        return (
            self.spark.read.format("jdbc")
            .options(
                **self.read_options(),
                dbtable=self.dialect.name(table),
                partitionColumn=key,
                lowerBound=str(ends.lo),
                upperBound=str(ends.hi),
                numPartitions=str(parts),
            )
            .load()
        )

    def _read_shards(self, table: str, key: str, parts: int) -> DataFrame:
        sql = shard_start_sql(table, key, parts, self.dialect)
        starts = [r.lo for r in self.query(sql).orderBy("shard").collect()]
        return self._read_ranges(table, shard_predicates(key, starts, self.dialect))

    def _side_by_side(self, queries: Sequence[str], most: int) -> list[Key | None]:
        """The first row of each query, ``most`` connections at a time."""

        def first(sql: str) -> Key | None:
            row = self.query(sql).first()
            return None if row is None else tuple(row)

        with ThreadPoolExecutor(max_workers=max(1, min(most, len(queries)))) as pool:
            return list(pool.map(inheritable_thread_target(self.spark)(first), queries))

    def shard_starts(self, table: str, keys: Sequence[str], rows: int, shards: int, most: int = 4) -> list[Key]:
        """The lowest keys of equal parts of a table but for the first, as the database orders them."""
        if self.dialect.has_ntile:
            sql = numbered_starts_sql(table, keys, places(rows, shards)[1:], self.dialect)
            found = sorted(self.query(sql).collect(), key=lambda r: r[-1]) if shards > 1 else []
            return [tuple(r)[:-1] for r in found]

        def ask(probes: list[tuple[Key | None, int]]) -> list[Key | None]:
            return self._side_by_side(
                [probe_sql(table, keys, low, skip, self.dialect) for low, skip in probes], most
            )

        return probed_starts(ask, rows, shards)

    def _keysets(self, table: str, keys: Sequence[str], rows: int, parts: int, most: int) -> list[str]:
        starts = self.shard_starts(table, keys, rows, parts, most)
        return keyset_predicates(keys, [(None,), *starts], self.dialect)

    def _read_keysets(self, table: str, keys: Sequence[str], rows: int, parts: int, conf: JobConf) -> DataFrame:
        return self._merged(self._keysets(table, keys, rows, parts, conf.read_parallelism), table, conf)

    def _merged(self, predicates: list[str], table: str, conf: JobConf) -> DataFrame:
        df = self._read_ranges(table, predicates)
        return df.coalesce(conf.max_connections) if conf.max_connections else df

    def page_predicates(self, table: str, conf: JobConf) -> list[str]:
        """Ranges of equal row counts of the paging key; one without a key or with a single page.

        A key may have several columns. A server that numbers rows answers one query, any other is
        probed along its index.
        """
        table = self.resolve(table)
        found = self.query(self.dialect.key_sql.format(table=self.dialect.literal(table))).collect()
        keys = paging_keys([k.asDict() for k in found])
        if not keys or conf.read_parallelism == 1:
            return ["1 = 1"]
        rows = self.count_frame(table).first()[0]
        parts = reading_shards(rows, conf.page_size, conf.read_parallelism, conf.rows_per_task)
        if parts == 1:
            return ["1 = 1"]
        if self.dialect.has_ntile and len(keys) == 1:
            sql = shard_start_sql(table, keys[0], parts, self.dialect)
            starts = [r.lo for r in self.query(sql).orderBy("shard").collect()]
            return shard_predicates(keys[0], starts, self.dialect)
        return self._keysets(table, keys, rows, parts, conf.read_parallelism)

    def read_page(self, table: str, predicate: str) -> DataFrame:
        return self._read_ranges(self.resolve(table), [predicate])

    def scan(self, table: str, conf: JobConf) -> DataFrame:
        """The table in the ranges of :meth:`page_predicates`, each read by a task of its own."""
        table = self.resolve(table)
        predicates = self.page_predicates(table, conf)
        return self._frame(table) if len(predicates) == 1 else self._merged(predicates, table, conf)

    def largest(self, table: str, column: str) -> int | None:
        """The database's own answer, mostly from an index."""
        name = self.dialect.name
        found = self.query(f"SELECT MAX({name(column)}) AS largest FROM {name(self.resolve(table))}")
        return found.select(F.col("largest").cast("bigint")).first()[0]

    def count_violations(self, constraint: Constraint) -> int | None:
        own = replace(constraint, table=self.resolve(constraint.table))
        if own.parent:
            own = replace(own, parent=self.resolve(own.parent))
        sql = violations_sql(own, self.dialect)
        return None if sql is None else int(self.query(sql).first()[0])

    def count_frame(self, name: str) -> DataFrame:
        name = self.dialect.name(name)
        return self.query(f"SELECT COUNT(*) AS {self.dialect.name('rows')} FROM {name}")

    def execute(self, statements: Sequence[str]) -> None:
        """Run statements in one transaction, by one connection of the driver."""
        jvm = self.spark._jvm
        if "driver" in self._properties:
            jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(
                self._properties["driver"]
            )
        login = jvm.java.util.Properties()
        for key, value in {**self.dialect.properties, **self._properties}.items():
            login.setProperty(key, str(value))
        connection = jvm.java.sql.DriverManager.getConnection(self.url, login)
        try:
            connection.setAutoCommit(False)
            statement = connection.createStatement()
            for sql in statements:
                statement.executeUpdate(sql)
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            connection.close()

    def _exists(self, table: str) -> bool:
        self.all_names()
        return table in (self._names or ())

    def _append(self, df: DataFrame, table: str, conf: JobConf, tasks: int) -> None:
        options = self.write_options(conf.batchsize, tasks)
        (
            df.write.format("jdbc").options(**options)
            .option("dbtable", self.dialect.name(table)).mode("append").save()
        )

    def replace(self, table: str, df: DataFrame, conf: JobConf = JobConf()) -> None:
        """Make ``df`` the whole table, all of it or none.

        The rows are staged with their place, so that a task that runs again writes the same rows with the
        same places, and go to a table next to the target, each connection committing by itself. Only if
        every place has arrived are they published: one transaction empties the target and fills it
        from there, each place once. A load that fails before leaves the target as it was.
        """
        table = self.spelled(table)
        loading = table + LOADING_SUFFIX
        name, place = self.dialect.name, self.dialect.name(PLACE)
        staged = stage(df.withColumn(PLACE, F.monotonically_increasing_id()), "loading")
        expected = staged.count()
        if not self._exists(table):
            write_jdbc(staged.drop(PLACE).limit(0), self, table, conf.batchsize, 1)
        drop = [f"DROP TABLE {name(loading)}"]
        if self._exists(loading):
            self.execute(drop)
        none = f"SELECT t.*, CAST(0 AS {self.dialect.long_type}) AS {place} FROM {name(table)} t WHERE 1 = 0"
        self.execute([f"CREATE TABLE {name(loading)} AS {none}"])
        self._names = None
        try:
            self._append(staged, loading, conf, writing_tasks(expected, conf))
            counts = self.query(
                f"SELECT COUNT(*) AS held, COUNT(DISTINCT {place}) AS arrived FROM {name(loading)}"
            ).first()
            if counts.arrived != expected:
                raise OSError(f"{counts.arrived} of {expected} rows arrived for {table}")
            self.execute(publish_sql(table, loading, df.columns, counts.held > expected, self.dialect))
        finally:
            self.execute(drop)
            unstage(staged)
            self._names = None

    def keep_rejected(self, table: str, df: DataFrame) -> None:
        write_jdbc(
            df,
            self,
            self.spelled(table) + REJECTED_SUFFIX,
            self.conf.batchsize,
            self.conf.write_parallelism,
        )
        self._names = None

    def clear_rejected(self, table: str) -> None:
        left = self.spelled(table) + REJECTED_SUFFIX
        self.all_names()
        if left in (self._names or ()):
            write_jdbc(self._frame(left).limit(0), self, left, self.conf.batchsize, 1)

    def write_options(self, batch: int, parallelism: int) -> dict[str, str]:
        """``truncate`` empties a table that exists and keeps its own definition."""
        return {
            **self._properties,
            "url": self.url,
            "truncate": "true",
            "batchsize": str(batch),
            "numPartitions": str(parallelism),
            "isolationLevel": "READ_COMMITTED",
        }


def column_record(row: Mapping[str, Any]) -> ColumnSpec:
    """A column record from a row of the catalog's column list."""

    def number(name: str) -> int | None:
        return None if row[name] is None else int(row[name])

    extra = (row.get("extra") or "").lower()
    return ColumnSpec(
        column_name=row["column_name"],
        data_type=row["data_type"],
        character_maximum_length=number("character_maximum_length"),
        is_nullable=str(row["is_nullable"]).upper() == "YES",
        column_default=row["column_default"],
        numeric_precision=number("numeric_precision"),
        numeric_scale=number("numeric_scale"),
        datetime_precision=number("datetime_precision"),
        column_key=row["column_key"] or "",
        column_comment=row["column_comment"] or "",
        unsigned="unsigned" in (row.get("column_type") or "").lower(),
        auto_increment="auto_increment" in extra,
        default_is_expression="default_generated" in extra,
    )


def read_partitioned(
    source: TableSet, table: str, key: str | Sequence[str], bounds: DataFrame | None = None
) -> DataFrame:
    """A parallel scan, one partition for each shard of ``bounds``.

    Over JDBC every shard becomes a predicate of its own connection; without bounds a numeric key
    is cut into equal ranges. A key of several columns, which must hold no NULL, is cut by the database
    into parts of equal row counts. Text keys take only the number of shards from the bounds: a
    database may order them otherwise than Spark does, so it finds the ranges itself, and where
    it cannot, the table is read whole. Tables that Spark stores are already split by file block, so they
    are read whole and the bounds do not matter.
    """
    if not isinstance(source, JdbcTables):
        return source.read(table)
    table = source.resolve(table)
    if not isinstance(key, str):
        conf = source.conf
        rows = source.count_frame(table).first()[0]
        parts = reading_shards(rows, conf.page_size, conf.read_parallelism, conf.rows_per_task)
        return source._read_keysets(table, key, rows, parts, conf)
    if bounds is None:
        return source._read_equal_ranges(table, key, source.conf.read_parallelism)
    starts = [lo for lo, _, _ in shard_bounds(bounds)]
    if isinstance(bounds.schema["lo"].dataType, T.StringType):
        if len(starts) > 1 and source.dialect.has_ntile:
            return source._read_shards(table, key, len(starts))
        return source._frame(table)
    return source._read_ranges(table, shard_predicates(key, starts, source.dialect))


def write_jdbc(df: DataFrame, target: JdbcTables, table: str, batch: int, parallelism: int) -> None:
    """Replace a table's rows over ``parallelism`` connections, ``batch`` rows per round trip.

    Spark merges partitions down to that number and shuffles nothing. Each connection commits by
    itself. A failed load leaves the table part-filled and is to be
    repeated; it starts by emptying the table. ``JdbcTables.replace`` publishes all rows or none.
    """
    (
        df.write.format("jdbc")
        .options(**target.write_options(batch, parallelism))
        .option("dbtable", target.dialect.name(table))
        .mode("overwrite")
        .save()
    )
