"""Column selection and additive schema growth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.typemap import match_columns


def scan_projected(source: DataFrame, columns: list[str] | None = None, where=None) -> DataFrame:
    """The configured columns of a source, in configured order, with an
    optional predicate. Column pruning and the predicate reach the scan."""
    cols = match_columns(source.columns, list(columns or []))
    df = source if where is None else source.where(where)
    return df.select(*cols)


def missing_columns(raw_schema: T.StructType, source_schema: T.StructType) -> list[T.StructField]:
    """Source fields whose name (case-insensitive) is not in the raw table."""
    have = {f.name.upper() for f in raw_schema.fields}
    out, seen = [], set()
    for f in source_schema.fields:
        u = f.name.upper()
        if u not in have and u not in seen:
            out.append(T.StructField(f.name, f.dataType, True))
            seen.add(u)
    return out


def evolve_schema(raw: DataFrame, source_schema: T.StructType) -> DataFrame:
    """S6 on the data: add each missing source column at the end, NULL for
    every existing row. Never drops, retypes or back-fills a column."""
    extra = missing_columns(raw.schema, source_schema)
    if not extra:
        return raw
    return raw.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in extra])


def align_to(raw_schema: T.StructType, batch: DataFrame) -> DataFrame:
    """Rename batch columns to the raw table's spelling (matched
    case-insensitively) so a later union by name lines them up."""
    spelled = {f.name.upper(): f.name for f in raw_schema.fields}
    return batch.select(*[F.col(c).alias(spelled.get(c.upper(), c)) for c in batch.columns])
