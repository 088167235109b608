"""Keys and self-numbering columns as a catalog describes them."""

from __future__ import annotations

from dataclasses import dataclass

PRIMARY, UNIQUE, INDEX, FOREIGN = "primary key", "unique", "index", "foreign key"


@dataclass(frozen=True)
class Constraint:
    """A key of a table. ``parent`` and ``parent_columns`` are for foreign keys."""

    kind: str
    table: str
    name: str
    columns: tuple[str, ...]
    parent: str = ""
    parent_columns: tuple[str, ...] = ()


@dataclass(frozen=True)
class AutoColumn:
    """A column the source numbers itself, with the next value its catalog names."""

    table: str
    column: str
    next_value: int | None = None

    @property
    def sequence_name(self) -> str:
        return f"{self.table}_{self.column}_seq".upper()
