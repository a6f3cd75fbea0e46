"""High-water marks read back from the raw table.

A mark is one scalar (day) or a pair (day, HHMMSS int). Each is computed by a
global aggregate -- a partial aggregate per task plus one tiny final merge --
so reading it costs one column-pruned scan and no sort, whatever the size of
the raw table. The scalar then comes back to the driver as a literal for the
source predicate, which is what lets the predicate reach the source scan.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Mark:
    """A high-water mark. ``day is None`` means the raw side is empty."""

    day: date | None = None
    time: int | None = None
    composite: bool = False

    @property
    def empty(self) -> bool:
        return self.day is None

    @staticmethod
    def none(composite: bool = False) -> "Mark":
        return Mark(None, None, composite)


def to_mark_day(c: Column) -> Column:
    """First ten characters as a date, also written ``20240105``; text that is not a date gives NULL."""
    text = c.cast("string").substr(1, 10)
    dashed = F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    return F.when(dashed.rlike(r"^\d{4}-\d{2}-\d{2}$"), dashed.try_cast("date"))


def composite_mark_frame(raw: DataFrame, date_col: str, time_col: str) -> DataFrame:
    """T1 as one aggregate row ``(mark_date, mark_time, mark_text)``.

    Newest ``(d, t)`` among rows with a non-NULL ``d``: ``max(struct(d, t))``
    ranks a NULL ``t`` below any value, exactly like ``ORDER BY d DESC, t DESC``
    with NULLs last, and a NULL ``t`` on the newest day becomes 0 (X5).
    """
    top = F.max(F.struct(F.col(date_col).alias("d"), F.col(time_col).alias("t"))).alias("m")
    return raw.where(F.col(date_col).isNotNull()).agg(top).select(
        to_mark_day(F.col("m.d")).alias("mark_date"),
        F.when(F.col("m").isNotNull(), F.coalesce(F.col("m.t").cast("int"), F.lit(0))).alias("mark_time"),
        F.col("m.d").cast("string").alias("mark_text"),
    )


def day_mark_frame(raw: DataFrame, col: str) -> DataFrame:
    """A1 as one aggregate row ``(mark_day, mark_text)``: ``max(col)`` cut to a date."""
    return raw.agg(F.max(F.col(col)).alias("m")).select(
        to_mark_day(F.col("m")).alias("mark_day"),
        F.col("m").cast("string").alias("mark_text"),
    )


def top_value(df: DataFrame, date_col: str, time_col: str | None = None):
    """The raw newest ``(d, t)`` (``t`` may be NULL) among rows with a
    non-NULL ``d``, or ``None``; one global aggregate."""
    t = F.col(time_col) if time_col else F.lit(None).cast("int")
    row = df.where(F.col(date_col).isNotNull()).agg(
        F.max(F.struct(F.col(date_col).alias("d"), t.alias("t"))).alias("m")
    ).first()
    m = row["m"] if row is not None else None
    return None if m is None else (m["d"], m["t"])


def mark_from_top(top, composite: bool) -> Mark:
    """T1/A1 from a raw top value: day = first ten characters as a date (a
    value that is not a date raises), time = ``t`` with NULL as 0."""
    if top is None:
        return Mark.none(composite)
    d, t = top
    try:
        day = date.fromisoformat(str(d)[:10])
    except ValueError as exc:
        raise ValueError(f"mark {d!r} is not a date") from exc
    return Mark(day, int(t or 0), True) if composite else Mark(day, None, False)


def read_composite_mark(raw: DataFrame, date_col: str, time_col: str) -> Mark:
    """Run T1 and return it; an empty raw side gives an empty mark."""
    row = composite_mark_frame(raw, date_col, time_col).first()
    if row is None or row["mark_text"] is None:
        return Mark.none(composite=True)
    if row["mark_date"] is None:
        raise ValueError(f"mark {date_col}={row['mark_text']!r} is not a date")
    return Mark(row["mark_date"], int(row["mark_time"]), True)


def read_day_mark(raw: DataFrame, col: str) -> Mark:
    """Run A1 and return it.

    Only a raw side with no value at all gives an empty mark; a value that is
    not a date raises instead of silently re-reading the whole source.
    """
    row = day_mark_frame(raw, col).first()
    if row is None or row["mark_text"] is None:
        return Mark.none()
    if row["mark_day"] is None:
        raise ValueError(f"mark {col}={row['mark_text']!r} is not a date")
    return Mark(row["mark_day"], None, False)
