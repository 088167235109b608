"""Named sets of tables and views: the two sides of a run."""

from __future__ import annotations

import re
import uuid
from abc import ABC, abstractmethod
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablehaul.conf import JobConf
from tablehaul.functions.keys import AutoColumn, Constraint
from tablehaul.functions.names import columns as named
from tablehaul.functions.names import quoted
from tablehaul.functions.types import ColumnSpec, spec_of_field

# Names of the tables that runs leave in a target, and of a server's own log.
REPORT_TABLE = "data_compare"
TASK_TABLE = "my_mig_task_info"
REJECTED_SUFFIX = "__rejected"
_UNFINISHED = re.compile(r"__(?:loading|replaced)_[0-9a-f]{8}$")
ENGINE_TABLES = (REPORT_TABLE, TASK_TABLE, "hg_t_audit_log")


class TableSet(ABC):
    """Tables and views under one name. Names are matched without regard to case.

    ``cheap_count`` says that a table's size is known without reading its rows, ``lays_out`` that the order of
    written rows decides what a filter reads.
    """

    cheap_count = False
    lays_out = False

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.name = name
        self._views: dict[str, str] = {}

    @abstractmethod
    def all_names(self) -> list[str]:
        """The base tables, sorted by name, with those that runs leave behind."""

    def table_names(self) -> list[str]:
        """The base tables, sorted by name, without those that runs leave behind."""
        return [n for n in self.all_names() if n.lower() not in ENGINE_TABLES]

    @abstractmethod
    def _frame(self, name: str) -> DataFrame:
        """The table with exactly this name."""

    def exists(self) -> bool:
        return True

    def resolve(self, table: str) -> str:
        """The spelling this set uses for a table."""
        for name in self.all_names():
            if name.lower() == table.lower():
                return name
        raise ValueError(f"{self.name} has no table {table!r}")

    def spelled(self, table: str) -> str:
        """The spelling of a table that is to be written: an existing one, or the given name."""
        try:
            return self.resolve(table)
        except ValueError:
            return table

    def read(self, table: str) -> DataFrame:
        return self._frame(self.resolve(table))

    def columns(self, table: str, df: DataFrame | None = None) -> list[ColumnSpec]:
        """The catalog's records of the columns, in order; ``df`` is the table if at hand."""
        return [spec_of_field(f) for f in (df or self.read(table)).schema.fields]

    def constraints(self) -> list[Constraint]:
        """The keys of the tables, as far as the catalog knows them."""
        return []

    def auto_columns(self) -> list[AutoColumn]:
        """The columns that the source numbers itself."""
        return []

    def scan(self, table: str, conf: JobConf) -> DataFrame:
        """The whole table for copying, read in parallel."""
        return self.read(table)

    def page_predicates(self, table: str, conf: JobConf) -> list[str]:
        """Ranges that hold every row of the table once, as conditions this set understands."""
        return ["1 = 1"]

    def read_page(self, table: str, predicate: str) -> DataFrame:
        """The rows of one of these ranges."""
        return self.read(table).where(predicate)

    def reads_repeat(self) -> bool:
        """Whether a second read of a table is sure to see the same rows."""
        return True

    def count_frame(self, name: str) -> DataFrame:
        """One row ``(rows)``: the size of the table with exactly this name."""
        return self._frame(name).agg(F.count(F.lit(1)).alias("rows"))

    def count_together(self, names: Sequence[str]) -> dict[str, int] | None:
        """The sizes of several tables from one scan, or None if this set has no such scan."""
        return None

    def largest(self, table: str, column: str) -> int | None:
        """The largest value of a whole-number column; None without one."""
        return self.read(table).agg(F.max(quoted(column)).cast("bigint")).first()[0]

    def count_violations(self, constraint: Constraint) -> int | None:
        """A key's violations, if this set counts them itself; otherwise None."""
        return None

    def size_hint(self, table: str) -> int:
        """Bytes of the table if they are known, to begin large tables first."""
        return 0

    def view_definitions(self) -> dict[str, str]:
        return dict(self._views)

    def view_names(self) -> list[str]:
        return sorted(self._views)

    def replace(self, table: str, df: DataFrame, conf: JobConf = JobConf()) -> None:
        """Make ``df`` the whole content of the table, creating the table if need be."""
        raise NotImplementedError(f"{type(self).__name__} cannot be written")

    def keep_rejected(self, table: str, df: DataFrame) -> None:
        """Store rows of the table that did not fit, apart from its tables."""
        raise NotImplementedError(f"{type(self).__name__} cannot be written")

    def clear_rejected(self, table: str) -> None:
        """Forget the rejected rows of an earlier load."""

    def expose_tables(self, text: str) -> None:
        """Make the tables that a text mentions known to Spark by name."""
        for table in self.table_names():
            if table.lower() in text.lower():
                self._frame(table).createOrReplaceTempView(quoted(table))

    def create_view(self, name: str, body: str) -> None:
        """Define a view whose text names the tables of this set."""
        self.spark.sql(f"CREATE OR REPLACE TEMP VIEW {quoted(name)} AS {body}")
        self._views[name] = body

    def read_view(self, name: str) -> DataFrame:
        return self.spark.table(quoted(name))


class FrameTables(TableSet):
    """Tables given as DataFrames; ``live`` ones may have other rows at each read."""

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        frames: Mapping[str, DataFrame],
        views: Mapping[str, str] | None = None,
        specs: Mapping[str, Sequence[ColumnSpec]] | None = None,
        live: bool = False,
    ) -> None:
        super().__init__(spark, name)
        self._live = live
        self._frames = dict(frames)
        self._views.update(views or {})
        self._specs = {k.lower(): list(v) for k, v in (specs or {}).items()}

    def all_names(self) -> list[str]:
        return sorted(self._frames)

    def reads_repeat(self) -> bool:
        return not self._live

    def _frame(self, name: str) -> DataFrame:
        return self._frames[name]

    def columns(self, table: str, df: DataFrame | None = None) -> list[ColumnSpec]:
        return self._specs.get(table.lower()) or super().columns(table, df)


class ParquetTables(TableSet):
    """A folder with one ``<table>.parquet`` file or folder per table.

    A table is replaced by writing its rows next to it and renaming the finished folder, so
    that a failed job leaves the old table in place. Rejected rows go to ``_rejected/``.
    """

    SUFFIX = ".parquet"
    cheap_count = True
    lays_out = True

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        name: str | None = None,
        views: Mapping[str, str] | None = None,
        specs: Mapping[str, Sequence[ColumnSpec]] | None = None,
    ) -> None:
        path = path.rstrip("/")
        super().__init__(spark, name or path.rsplit("/", 1)[-1])
        self.path = path
        self._views.update(views or {})
        self._specs = {k.lower(): list(v) for k, v in (specs or {}).items()}

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self):
        return self._path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self._files().exists(self._path(self.path))

    def all_names(self) -> list[str]:
        if not self.exists():
            return []
        entries = [s.getPath().getName() for s in self._files().listStatus(self._path(self.path))]
        names = [e[: -len(self.SUFFIX)] for e in entries if e.endswith(self.SUFFIX)]
        return sorted(n for n in names if n[0] not in "_.")

    def _table_path(self, table: str) -> str:
        return f"{self.path}/{table}{self.SUFFIX}"

    def _frame(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self._table_path(name))

    def size_hint(self, table: str) -> int:
        place = self._path(self._table_path(table))
        files = self._files()
        return files.getContentSummary(place).getLength() if files.exists(place) else 0

    def count_frame(self, name: str) -> DataFrame:
        # Without columns the row counts of the file footers suffice, and no schema is looked up.
        no_columns = self.spark.read.schema(T.StructType([])).parquet(self._table_path(name))
        return no_columns.agg(F.count(F.lit(1)).alias("rows"))

    def count_together(self, names: Sequence[str]) -> dict[str, int]:
        reader = self.spark.read.schema(T.StructType([])).option("recursiveFileLookup", "true")
        files = reader.parquet(*[self._table_path(name) for name in names])
        place = F.regexp_replace("_metadata.file_path", r"^[A-Za-z][\w+.-]*:(//[^/]*)?", "")
        depth = self._files().makeQualified(self._path(self.path)).depth()
        folder = F.element_at(F.split(place, "/"), 2 + depth)
        found = files.groupBy(folder).agg(F.count(F.lit(1))).collect()
        sizes = {unquote(entry)[: -len(self.SUFFIX)]: rows for entry, rows in found}
        if not sizes.keys() <= set(names):
            raise ValueError(f"files of {self.name} that belong to no table: {sorted(sizes)}")
        return {name: sizes.get(name, 0) for name in names}

    def columns(self, table: str, df: DataFrame | None = None) -> list[ColumnSpec]:
        return self._specs.get(table.lower()) or super().columns(table, df)

    def replace(self, table: str, df: DataFrame, conf: JobConf = JobConf()) -> None:
        self._swap_in(df, self._table_path(self.spelled(table)))

    def _rejected_path(self, table: str) -> str:
        return f"{self.path}/_rejected/{table}{self.SUFFIX}"

    def keep_rejected(self, table: str, df: DataFrame) -> None:
        self._swap_in(df, self._rejected_path(table))

    def clear_rejected(self, table: str) -> None:
        self._files().delete(self._path(self._rejected_path(table)), True)

    def rejected(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self._rejected_path(table))

    def _swap_in(self, df: DataFrame, place: str) -> None:
        token = uuid.uuid4().hex
        staged = self._path(f"{self.path}/_loading-{token}")
        replaced = self._path(f"{self.path}/_replaced-{token}")
        final = self._path(place)
        files = self._files()
        try:
            df.write.parquet(staged.toString())
        except Exception:
            files.delete(staged, True)
            raise
        files.mkdirs(final.getParent())
        had_old = files.exists(final)
        if had_old and not files.rename(final, replaced):
            raise OSError(f"could not move {place} aside")
        if not files.rename(staged, final):
            if had_old:
                files.rename(replaced, final)
            raise OSError(f"could not move the finished load to {place}")
        if had_old:
            files.delete(replaced, True)


class CatalogTables(TableSet):
    """A database of Spark's catalog; views in it are permanent ones."""

    cheap_count = True
    lays_out = True

    def __init__(self, spark: SparkSession, database: str) -> None:
        super().__init__(spark, database)

    def exists(self) -> bool:
        return self.spark.catalog.databaseExists(self.name)

    def _listed(self, views: bool) -> list[str]:
        return sorted(
            t.name
            for t in self.spark.catalog.listTables(self.name)
            if not t.isTemporary and (t.tableType == "VIEW") == views
        )

    def all_names(self) -> list[str]:
        if not self.exists():
            return []
        return [
            n
            for n in self._listed(views=False)
            if not n.endswith(REJECTED_SUFFIX) and not _UNFINISHED.search(n)
        ]

    def view_names(self) -> list[str]:
        return self._listed(views=True) if self.exists() else []

    def _qualified(self, name: str) -> str:
        return f"{quoted(self.name)}.{quoted(name)}"

    def _frame(self, name: str) -> DataFrame:
        return self.spark.table(self._qualified(name))

    def replace(self, table: str, df: DataFrame, conf: JobConf = JobConf()) -> None:
        token = uuid.uuid4().hex[:8]
        staged, replaced = f"{table}__loading_{token}", f"{table}__replaced_{token}"
        try:
            df.write.format("parquet").saveAsTable(self._qualified(staged))
        except Exception:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._qualified(staged)}")
            raise
        had_old = self.spark.catalog.tableExists(self._qualified(table))
        if had_old:
            self._rename(table, replaced)
        try:
            self._rename(staged, table)
        except Exception:
            if had_old:
                self._rename(replaced, table)
            raise
        if had_old:
            self.spark.sql(f"DROP TABLE {self._qualified(replaced)}")

    def _rename(self, old: str, new: str) -> None:
        self.spark.sql(f"ALTER TABLE {self._qualified(old)} RENAME TO {self._qualified(new)}")

    def keep_rejected(self, table: str, df: DataFrame) -> None:
        self.replace(table + REJECTED_SUFFIX, df)

    def clear_rejected(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self._qualified(table + REJECTED_SUFFIX)}")

    def expose_tables(self, text: str) -> None:
        """Nothing to do: the catalog knows its tables."""

    def create_view(self, name: str, body: str) -> None:
        # A session of its own: a temporary view of the caller could hide a table of the database.
        session = self.spark.newSession()
        session.catalog.setCurrentDatabase(self.name)
        session.sql(f"CREATE OR REPLACE VIEW {self._qualified(name)} AS {body}")

    def read_view(self, name: str) -> DataFrame:
        return self.spark.table(self._qualified(name))


def read_table(source: TableSet, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A full scan; only the named columns reach it."""
    df = source.read(table)
    return df if columns is None else df.select(*named(columns))
