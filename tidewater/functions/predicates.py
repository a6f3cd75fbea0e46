"""Row predicates of the loads (F1-F7), as Column builders.

Marks and window bounds enter as literals, so every predicate that touches a
source column reaches the scan (``PushedFilters`` for Parquet and JDBC). Null
handling is SQL three-valued logic throughout: a row whose mark date is NULL is
never new, never inside a window and never deleted by a day or window delete.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions.marks import Mark

INGEST_COL = "_ingested_at"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _day(v: date | datetime | str) -> Column:
    if isinstance(v, datetime):
        v = v.date()
    if isinstance(v, str):
        v = date.fromisoformat(v[:10])
    return F.lit(v)


def newer_than_composite(d: str | Column, t: str | Column, mark: Mark) -> Column:
    """strictly after ``(D, T)``: ``d > D OR (d = D AND t > T)``.

    Kept in OR form (not a struct compare) so it is pushed to the source. A
    NULL ``t`` on day ``D`` is never selected.
    """
    dd, tt = _c(d), _c(t)
    D, T = _day(mark.day), F.lit(int(mark.time or 0))
    return (dd > D) | ((dd == D) & (tt > T))


def newer_than_day(d: str | Column, mark: Mark) -> Column:
    """``d >= D`` -- inclusive, the boundary day is read again."""
    return _c(d) >= _day(mark.day)


def newer_than(mark: Mark, date_col: str | Column, time_col: str | Column | None = None) -> Column | None:
    """Pick F1, F2 or F3 for a mark; ``None`` (F3) means read the whole source."""
    if mark.empty:
        return None
    if mark.composite:
        if time_col is None:
            raise ValueError("a composite mark needs its time column")
        return newer_than_composite(date_col, time_col, mark)
    return newer_than_day(date_col, mark)


def in_window(d: str | Column, start: date | str, end: date | str) -> Column:
    """closed ``[start, end]``; a timestamp on the end day after midnight is outside."""
    return _c(d).between(_day(start), _day(end))


def drop_day(d: str | Column, day: date | str) -> Column:
    """rows of the boundary day; NULL never matches."""
    return F.coalesce(_c(d) == _day(day), F.lit(False))


def drop_window(d: str | Column, start: date | str, end: date | str) -> Column:
    """rows inside a window; NULL never matches."""
    return F.coalesce(in_window(d, start, end), F.lit(False))


def drop_today(run_day: date | str, ingest_col: str | Column = INGEST_COL) -> Column:
    """rows ingested on the run's day (``CAST(_ingested_at AS DATE)``)."""
    return F.coalesce(F.to_date(_c(ingest_col)) == _day(run_day), F.lit(False))


def mark_sql(mark: Mark, date_col: str, time_col: str | None = None, quote: str = '"') -> str | None:
    """F1/F2/F3 as SQL text for a source that evaluates the predicate itself
    (a JDBC subquery); ``None`` for an empty mark."""
    if mark.empty:
        return None
    d, day = f"{quote}{date_col}{quote}", mark.day.isoformat()
    if mark.composite:
        t = f"{quote}{time_col}{quote}"
        return f"({d} > '{day}' OR ({d} = '{day}' AND {t} > {int(mark.time or 0)}))"
    return f"{d} >= '{day}'"


def where_opt(df, pred: Column | None):
    """Apply an optional predicate (F3: ``None`` keeps every row)."""
    return df if pred is None else df.where(pred)
