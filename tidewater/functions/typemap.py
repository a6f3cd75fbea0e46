"""Source column metadata -> Spark types.

The source catalog gives, per column, a type name, a length/precision and a
scale. This module turns that into a Spark ``StructType`` (plus the DDL text
with declared widths) and applies it to the data as one ``select`` of casts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The source type names, the widths at which text becomes
# unbounded, the defaults for a missing width, and the decimal used when the
# scale is unknown. They must equal the reference's mapping.
#   NVARCHAR, ALPHANUM, SHORTTEXT: width default 255, above 4000 unbounded
#   VARCHAR: width default 255, above 8000 unbounded
#   NCHAR: width default 1, clamped to 1..4000
#   CHAR: width default 1, clamped to 1..8000
#   TINYINT, SMALLINT, INTEGER/INT, BIGINT
#   DECIMAL, DEC, SMALLDECIMAL: scale NULL -> DECIMAL(38,10);
#       otherwise precision default 38 clamped to 1..38, scale clamped to 0..precision
#   DOUBLE, REAL, DATE, TIME, TIMESTAMP, SECONDDATE, BOOLEAN
#   CLOB, NCLOB, TEXT, BINTEXT: unbounded text
#   BLOB, VARBINARY, BINARY: binary
#   anything else: unbounded text
NTEXT_NAMES = ("NVARCHAR", "ALPHANUM", "SHORTTEXT")
NTEXT_DEFAULT, NTEXT_MAX = 255, 4000
VARCHAR_DEFAULT, VARCHAR_MAX = 255, 8000
NCHAR_MAX, CHAR_MAX = 4000, 8000
DECIMAL_NAMES = ("DECIMAL", "DEC", "SMALLDECIMAL")
DECIMAL_UNKNOWN_SCALE = (38, 10)
LOB_TEXT_NAMES = ("CLOB", "NCLOB", "TEXT", "BINTEXT")
BINARY_NAMES = ("BLOB", "VARBINARY", "BINARY")


@dataclass(frozen=True)
class SourceColumn:
    """One row of source catalog metadata."""

    name: str
    type_name: str
    length: int | None = None
    scale: int | None = None
    position: int | None = None


@dataclass(frozen=True)
class MappedType:
    """What a source column becomes: a Spark type, and for text the width that values must keep."""

    spark: T.DataType
    width: int | None = None
    padded: bool = False  # declared with a fixed width

    @property
    def ddl(self) -> str:
        """The type as declared, with its width."""
        if self.width is None:
            return self.spark.simpleString().upper()
        return f"{'CHAR' if self.padded else 'VARCHAR'}({self.width})"


@dataclass(frozen=True)
class TextWidth:
    """How a declared text length becomes a width: the default when missing or
    0, the most, and whether a longer one is unbounded or cut to the most."""

    default: int
    most: int
    padded: bool = False

    def __call__(self, col: SourceColumn) -> MappedType:
        asked = int(col.length) if col.length else self.default
        if asked > self.most and not self.padded:
            return MappedType(T.StringType())
        return MappedType(T.StringType(), sorted((1, asked, self.most))[1], self.padded)


def _decimal(col: SourceColumn) -> MappedType:
    if col.scale is None:
        return MappedType(T.DecimalType(*DECIMAL_UNKNOWN_SCALE))
    digits = sorted((1, int(col.length or 38), 38))[1]
    return MappedType(T.DecimalType(digits, sorted((0, int(col.scale), digits))[1]))


TEXT_RULES = dict.fromkeys(NTEXT_NAMES, TextWidth(NTEXT_DEFAULT, NTEXT_MAX)) | {
    "VARCHAR": TextWidth(VARCHAR_DEFAULT, VARCHAR_MAX),
    "NCHAR": TextWidth(1, NCHAR_MAX, padded=True),
    "CHAR": TextWidth(1, CHAR_MAX, padded=True),
}
RULES = TEXT_RULES | dict.fromkeys(DECIMAL_NAMES, _decimal)
# An unsigned TINYINT (0..255) needs a SMALLINT. Parquet cannot store Spark's
# TIME type, which stays 'HH:mm:ss[.ffffff]' text.
PLAIN_TYPES = {
    T.ShortType(): ("TINYINT", "SMALLINT"),
    T.IntegerType(): ("INTEGER", "INT"),
    T.LongType(): ("BIGINT",),
    T.DoubleType(): ("DOUBLE",),
    T.FloatType(): ("REAL",),
    T.DateType(): ("DATE",),
    T.TimestampNTZType(): ("TIMESTAMP", "SECONDDATE"),
    T.BooleanType(): ("BOOLEAN",),
    T.StringType(): ("TIME", *LOB_TEXT_NAMES),
    T.BinaryType(): BINARY_NAMES,
}
_PLAIN = {name: MappedType(kind) for kind, names in PLAIN_TYPES.items() for name in names}


def mapped(col: SourceColumn) -> MappedType:
    """The type map; an unknown type name is unbounded text."""
    name = str(col.type_name).upper()
    rule = RULES.get(name)
    return rule(col) if rule else _PLAIN.get(name, MappedType(T.StringType()))


def ddl_type(col: SourceColumn) -> str:
    """Spark DDL type for a source column, with declared text widths."""
    return mapped(col).ddl


def map_type(col: SourceColumn) -> T.DataType:
    """Spark data type of a source column (text widths are not enforced here)."""
    return mapped(col).spark


def declared_width(col: SourceColumn) -> int | None:
    """Declared text width (VARCHAR(n) / CHAR(n)), or None when unbounded."""
    return mapped(col).width


def _typed(df: DataFrame, name: str, meta: SourceColumn, enforce_width: bool):
    """One column cast by the type map; text longer than its declared width
    fails the load, as an insert into the declared column would."""
    if str(meta.type_name).upper() == "TIME":
        out = _time_text(df, name)
    else:
        out = F.col(name).cast(map_type(meta))
    width = declared_width(meta) if enforce_width else None
    if width is not None:
        msg = f"value longer than {width} characters in column {meta.name}"
        out = F.when(F.length(out) > width, F.raise_error(F.lit(msg))).otherwise(out)
    return out.alias(meta.name)


def _time_text(df: DataFrame, name: str):
    """TIME as 'HH:mm:ss[.ffffff]' text: formatted from a timestamp (JDBC
    reads TIME as one), passed through when the source already gives text."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.when(F.date_format(c, "SSSSSS") == "000000", F.date_format(c, "HH:mm:ss")).otherwise(
            F.date_format(c, "HH:mm:ss.SSSSSS")
        )
    return c.cast("string")


def source_schema(columns: list[SourceColumn]) -> T.StructType:
    """Ordered ``StructType``; every raw column is nullable."""
    return T.StructType([T.StructField(c.name, map_type(c), True) for c in columns])


def match_columns(available: list[str], configured: list[str]) -> list[str]:
    """Configured columns found in ``available`` (case-insensitive), in
    configured order. A configured column absent at the source is dropped; an
    empty configuration means every source column; nothing found raises."""
    by_upper = {c.upper(): c for c in available}
    if not configured:
        return list(available)
    found = [by_upper[c.upper()] for c in configured if c.upper() in by_upper]
    if not found:
        raise ValueError(f"none of the configured columns exist at the source: {configured}")
    return found


def typed_projection(df: DataFrame, columns: list[SourceColumn], enforce_width: bool = True) -> DataFrame:
    """One ``select`` that keeps the metadata's columns, in position order,
    cast to their mapped types. Metadata rows absent in ``df`` are dropped."""
    ordered = sorted(columns, key=lambda c: (c.position is None, c.position or 0))
    present = {c.upper(): c for c in df.columns}
    exprs = []
    for c in ordered:
        if c.name.upper() not in present:
            continue
        exprs.append(_typed(df, present[c.name.upper()], c, enforce_width))
    if not exprs:
        raise ValueError("no metadata column is present in the data")
    return df.select(*exprs)


def cast_columns(df: DataFrame, columns: list[SourceColumn], enforce_width: bool = True) -> DataFrame:
    """S8 keeping ``df``'s column order (the configured order, T4): columns
    with a metadata row are cast to their mapped type, others stay as read."""
    meta = {c.name.upper(): c for c in columns}
    exprs = []
    for name in df.columns:
        m = meta.get(name.upper())
        if m is None:
            exprs.append(F.col(name))
            continue
        exprs.append(_typed(df, name, m, enforce_width).alias(name))
    return df.select(*exprs)
