"""Settings of a run."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class JobConf:
    """Settings shared by every table of a run.

    ``fetchsize`` and ``batchsize`` are rows per JDBC round trip, ``page_size`` rows per page of a
    keyed read. ``table_parallelism`` tables are moved at a time, each read by
    ``read_parallelism`` connections and written by ``write_parallelism``. A table of more than
    ``rows_per_task`` rows for each of these gets more tasks, which the cluster's cores take one after the
    other; ``max_connections`` merges them to so many.
    ``database_views`` defines views of a database target in the database instead of with Spark.
    ``resume_dir`` is a folder that outlives the application: rows of a live source are kept there page
    by page until their table is written, so that a run that failed need not read them again.
    ``length_unit`` says whether a VARCHAR length counts characters or bytes.
    ``cluster_by`` maps a table to the columns its files are sorted by, ``curve_by`` to the columns that
    share its layout. A whole run lays a table out by its plain indexes if ``index_layout`` is on and
    it has no layout yet.
    """

    fetchsize: int = 5000
    batchsize: int = 5000
    page_size: int = 5000
    table_parallelism: int = 4
    read_parallelism: int = 4
    write_parallelism: int = 4
    rows_per_task: int | None = 5_000_000
    max_connections: int | None = None
    database_views: bool = False
    resume_dir: str | None = None
    length_unit: str = "char"
    cluster_by: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    curve_by: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    index_layout: bool = True

    def __post_init__(self) -> None:
        for name in ("fetchsize", "batchsize", "page_size", "table_parallelism",
                     "read_parallelism", "write_parallelism"):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} must be at least 1")
        for name in ("rows_per_task", "max_connections"):
            if getattr(self, name) is not None and getattr(self, name) < 1:
                raise ValueError(f"{name} must be at least 1 or None")
        if self.length_unit not in ("char", "byte"):
            raise ValueError("length_unit must be 'char' or 'byte'")
