"""Source column types and the Spark types they map to."""

from __future__ import annotations

import re
from dataclasses import asdict, dataclass

from pyspark.sql import types as T

# The source type words of each mapping branch.
SIZED_TEXT = ("VARCHAR", "CHAR")
LONG_TEXT = ("LONGTEXT", "MEDIUMTEXT", "TEXT", "TINYTEXT")
SMALL_INTEGERS = ("MEDIUMINT", "TINYINT")
SCALED_NUMBERS = ("DECIMAL", "DOUBLE", "FLOAT")
TIMES = ("DATETIME", "TIMESTAMP")
BINARY_OBJECTS = ("TINYBLOB", "BLOB", "MEDIUMBLOB", "LONGBLOB")

_OTHER_WORDS = {
    "SMALLINT": T.ShortType(),
    "INT": T.IntegerType(),
    "INTEGER": T.IntegerType(),
    "YEAR": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DATE": T.DateType(),
    "TIME": T.StringType(),
    "ENUM": T.StringType(),
    "SET": T.StringType(),
    "JSON": T.StringType(),
    "BINARY": T.BinaryType(),
    "VARBINARY": T.BinaryType(),
}
_UNSIGNED_WIDER = {
    T.ShortType(): T.IntegerType(),
    T.IntegerType(): T.LongType(),
    T.LongType(): T.DecimalType(20, 0),
}
MAX_PRECISION = 38


@dataclass(frozen=True)
class ColumnSpec:
    """One column of a source table as its catalog describes it."""

    column_name: str
    data_type: str
    character_maximum_length: int | None = None
    is_nullable: bool = True
    column_default: str | None = None
    numeric_precision: int | None = None
    numeric_scale: int | None = None
    datetime_precision: int | None = None
    column_key: str = ""
    column_comment: str = ""
    unsigned: bool = False
    auto_increment: bool = False
    default_is_expression: bool = False

    @property
    def word(self) -> str:
        return self.data_type.strip().upper()

    @property
    def max_length(self) -> int | None:
        """The length the target enforces: only VARCHAR and CHAR keep theirs."""
        return self.character_maximum_length if self.word in SIZED_TEXT else None


def target_type(spec: ColumnSpec) -> T.DataType:
    """The Spark type a source column becomes."""
    word = spec.word
    if word in SIZED_TEXT or word in LONG_TEXT:
        return T.StringType()
    if word in SMALL_INTEGERS:
        return T.IntegerType()
    if word in SCALED_NUMBERS:
        return _number_type(spec)
    if word in TIMES:
        return T.TimestampNTZType()
    if word in BINARY_OBJECTS:
        return T.BinaryType()
    if word == "BIT":
        return _bit_type(bit_width(spec))
    if word in _OTHER_WORDS:
        plain = _OTHER_WORDS[word]
        return _UNSIGNED_WIDER.get(plain, plain) if spec.unsigned else plain
    return _type_from_ddl(spec)


def bit_width(spec: ColumnSpec) -> int:
    return spec.numeric_precision or 1


def _number_type(spec: ColumnSpec) -> T.DataType:
    if spec.numeric_scale is None:
        return T.DoubleType()
    precision = spec.numeric_precision or 10
    if precision > MAX_PRECISION:
        raise ValueError(
            f"{spec.column_name}: precision {precision} exceeds {MAX_PRECISION} digits"
        )
    return T.DecimalType(precision, spec.numeric_scale)


def _bit_type(width: int) -> T.DataType:
    if width == 1:
        return T.BooleanType()
    return T.DecimalType(20, 0) if width == 64 else T.LongType()


def _type_from_ddl(spec: ColumnSpec) -> T.DataType:
    """Any other word is passed on as it stands, so it has to be a type Spark knows."""
    try:
        return T.StructType.fromDDL(f"c {spec.data_type}").fields[0].dataType
    except Exception as error:
        raise ValueError(f"{spec.column_name}: unknown type {spec.data_type!r}") from error


def spec_of_field(field: T.StructField) -> ColumnSpec:
    """The column record of a Spark column.

    A record stored in the field's metadata by an earlier run is taken as it is, provided that
    it still leads to the field's type. Other fields are described from their Spark type.
    """
    stored = field.metadata.get("column_spec") if field.metadata else None
    if stored:
        spec = ColumnSpec(**stored)
        if target_type(spec) == field.dataType:
            return spec
    kind = field.dataType
    name, nullable = field.name, field.nullable
    if isinstance(kind, T.StringType):
        return ColumnSpec(name, "TEXT", is_nullable=nullable)
    if isinstance(kind, T.TimestampNTZType):
        return ColumnSpec(name, "DATETIME", is_nullable=nullable)
    if isinstance(kind, T.BinaryType):
        return ColumnSpec(name, "BLOB", is_nullable=nullable)
    if isinstance(kind, T.DoubleType):
        return ColumnSpec(name, "DOUBLE", is_nullable=nullable)
    if isinstance(kind, T.DecimalType):
        return ColumnSpec(name, "DECIMAL", is_nullable=nullable,
                          numeric_precision=kind.precision, numeric_scale=kind.scale)
    if isinstance(kind, T.BooleanType):
        return ColumnSpec(name, "BIT", is_nullable=nullable, numeric_precision=1)
    if isinstance(kind, T.FloatType):
        return ColumnSpec(name, "REAL", is_nullable=nullable)
    if isinstance(kind, T.TimestampType):
        return ColumnSpec(name, "TIMESTAMP_LTZ", is_nullable=nullable)
    return ColumnSpec(name, kind.simpleString(), is_nullable=nullable)


def spec_metadata(spec: ColumnSpec) -> dict:
    """Field metadata that lets a later read find the record again."""
    return {"column_spec": {k: v for k, v in asdict(spec).items() if v is not None}}


_CURRENT_TIME = re.compile(
    r"(?i)^(current_timestamp|now|localtime|localtimestamp)(\s*\(\s*\d*\s*\))?$"
)


def default_text(spec: ColumnSpec) -> tuple[str | None, bool]:
    """A column's default and whether it is an expression rather than a literal."""
    text = spec.column_default
    if text is None:
        return None, False
    if text == "( 'user' )":
        return "user", False
    if spec.default_is_expression or spec.word in TIMES:
        if _CURRENT_TIME.match(text.strip()):
            return "current_timestamp()", True
    return text, spec.default_is_expression
