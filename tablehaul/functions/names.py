"""Column names in expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """The name as one identifier, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def columns(names) -> list[Column]:
    return [F.col(quoted(n)) for n in names]


def replace_columns(df: DataFrame, replacements: Mapping[str, Column]) -> DataFrame:
    """The same columns in the same order, some of them computed anew."""
    by_name = {name.lower(): value for name, value in replacements.items()}
    known = {name.lower() for name in df.columns}
    missing = sorted(set(by_name) - known)
    if missing:
        raise ValueError(f"no such columns: {missing}")
    return df.select(
        *[
            by_name[name.lower()].alias(name) if name.lower() in by_name else F.col(quoted(name))
            for name in df.columns
        ]
    )
