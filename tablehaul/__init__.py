"""Moving a database's tables with Spark, checking what arrived and reconciling both sides."""

from tablehaul.conf import JobConf
from tablehaul.functions.binary import decode_binary, decode_bits, encode_binary
from tablehaul.functions.keys import AutoColumn, Constraint
from tablehaul.functions.types import ColumnSpec, target_type
from tablehaul.operators.checks import (
    check_foreign_key,
    check_primary_key,
    check_unique,
    constraints_from_catalog,
    run_checks,
)
from tablehaul.operators.conform import conform, fit_report, split_valid, with_defaults
from tablehaul.operators.paging import offset_page, page_bounds, seek_page, tag_pages
from tablehaul.operators.sequence import append_with_sequence, sequence_starts
from tablehaul.operators.sinks import write_clustered, write_existing, write_table
from tablehaul.operators.views import register_views
from tablehaul.plans.compare import (
    compare,
    compare_counts,
    compare_failures,
    compare_views,
    object_totals,
    store_report,
)
from tablehaul.plans.diff import compare_values, diff_rows
from tablehaul.plans.migrate import Migration, migrate, migrate_database, table_list
from tablehaul.plans.summary import failed_tables, migration_summary
from tablehaul.shared import remove_staged
from tablehaul.sources.delimited import DelimitedText, read_delimited, write_delimited
from tablehaul.sources.jdbc import (
    MYSQL,
    MYSQL_57,
    POSTGRESQL,
    JdbcTables,
    read_partitioned,
    write_jdbc,
)
from tablehaul.sources.tables import (
    CatalogTables,
    FrameTables,
    ParquetTables,
    TableSet,
    read_table,
)
