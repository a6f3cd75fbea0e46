"""Windowed history loads (L8, L9): N-month date slices.

The window list is built on the driver from three parameters (start, end,
months); its length is bounded by the parameters, never by the data. Rows
get their window number from a pure projection -- month arithmetic plus one
look-up in a literal array of bounds -- so assigning windows needs no join,
no shuffle and stays inside whole-stage codegen.
"""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.predicates import in_window
from tidewater.operators.common import WINDOW_COL, LoadPlan, stamp


@dataclass(frozen=True)
class Window:
    number: int  # 1-based, in time order
    start: date
    end: date


def _as_date(v: date | datetime | str) -> date:
    if isinstance(v, datetime):
        return v.date()
    if isinstance(v, date):
        return v
    return date.fromisoformat(str(v)[:10])


def add_months(d: date, n: int) -> date:
    """Calendar month step; the day is clamped to the last day of the month."""
    y, m = divmod(d.month - 1 + n, 12)
    year, month = d.year + y, m + 1
    return date(year, month, min(d.day, calendar.monthrange(year, month)[1]))


def make_windows(start, end, months: int, legacy_end: bool = False) -> list[Window]:
    """Windows ``[c, min(c + N months - 1 day, end)]`` stepping from ``start``.

    Each step is taken from the previous (already clamped) start, so a start
    on the 31st drifts: 31 Jan, 28 Feb, 28 Mar. With ``legacy_end=True`` the
    loop runs ``while c < end`` like the reference, which leaves ``end`` in no
    window when a step lands on it exactly; the default ``c <= end`` covers it.
    """
    if months is None or int(months) < 1:
        raise ValueError(f"window months must be >= 1, got {months!r}")
    lo, hi = _as_date(start), _as_date(end)
    out: list[Window] = []
    c = lo
    while (c < hi) if legacy_end else (c <= hi):
        nxt = add_months(c, int(months))
        out.append(Window(len(out) + 1, c, min(nxt - timedelta(days=1), hi)))
        c = nxt
    return out


def window_number(col: str | Column, windows: list[Window], months: int) -> Column:
    """Window number of each row's ``col`` (NULL when in no window).

    Window ``k`` starts in calendar month ``month(start_1) + k*N`` (only the
    day drifts), so ``floor(months since start_1 / N)`` is the window or the
    one before it; one look-up in the literal start/end arrays settles it.
    The final closed-range check keeps the reference's midnight rule: a
    timestamp after midnight on a window's last day is in no window.
    """
    if not windows:
        return F.lit(None).cast("int")
    d = F.col(col) if isinstance(col, str) else col
    s0 = windows[0].start
    starts = F.array(*[F.lit(w.start) for w in windows])
    ends = F.array(*[F.lit(w.end) for w in windows])
    n = len(windows)
    m = (F.year(d) - s0.year) * 12 + (F.month(d) - s0.month)
    # integer division of a possibly negative month count, clamped to a valid window
    k0 = F.greatest(F.least(F.floor(m / F.lit(int(months))).cast("int"), F.lit(n - 1)), F.lit(0))
    prev = F.greatest(k0, F.lit(1))  # 1-based index of window k0-1, always valid
    in_k0 = (d >= F.element_at(starts, k0 + 1)) & (d <= F.element_at(ends, k0 + 1))
    in_prev = (k0 >= 1) & (d >= F.element_at(starts, prev)) & (d <= F.element_at(ends, prev))
    first = windows[0].number  # a slice of the window list keeps its own numbers
    return F.when(in_k0, k0 + first).when(in_prev, k0 + (first - 1))


def assign_windows(df: DataFrame, col: str, windows: list[Window], months: int, out: str = "window_no") -> DataFrame:
    """L8 + F4: rows inside some window, with their window number.

    The covering range ``[first start, last end]`` is applied first as a plain
    closed-range filter, which reaches the scan; the exact per-window check
    then drops rows that fall in a gap.
    """
    if not windows:
        return df.where(F.lit(False)).withColumn(out, F.lit(None).cast("int"))
    cover = in_window(col, windows[0].start, windows[-1].end)
    return df.where(cover).withColumn(out, window_number(col, windows, months)).where(F.col(out).isNotNull())


def load_windows(
    raw: DataFrame,
    source: DataFrame,
    col: str,
    windows: list[Window],
    months: int,
    run_ts: datetime | str,
) -> LoadPlan:
    """L9 over any number of windows in one pass: raw rows inside a window are
    removed (F6; NULL stays), source rows inside a window are added (F4).
    Re-running gives the same table. The batch keeps its window numbers, so
    the rows of each window are counted as they are written (A2)."""
    batch = stamp(assign_windows(source, col, windows, months, out=WINDOW_COL), run_ts)
    gone = F.coalesce(window_number(col, windows, months).isNotNull(), F.lit(False))
    days = (col, windows[0].start, windows[-1].end) if windows else None
    return LoadPlan(
        kept=raw.where(~gone), batch=batch, kind="predicate", delete_pred=gone, delete_days=days,
        windows=[w.number for w in windows],
    )


def window_counts(batch: DataFrame, windows: list[Window], out: str = "window_no") -> DataFrame:
    """A2 per window: rows loaded in each window (windows with no row show 0).

    The count is a grouped aggregate over at most ``len(windows)`` groups with
    partial aggregation, so the broadcast side has at most one row per window
    (bounded by the parameters); windows with no row come from the window list.
    """
    counts = batch.groupBy(out).agg(F.count(F.lit(1)).alias("rows"))
    spark = batch.sparkSession
    wins = spark.createDataFrame(
        [(w.number, w.start, w.end) for w in windows], f"{out} int, window_start date, window_end date"
    )
    return (
        wins.join(F.broadcast(counts), out, "left")
        .select(out, "window_start", "window_end", F.coalesce(F.col("rows"), F.lit(0)).cast("bigint").alias("rows"))
    )
