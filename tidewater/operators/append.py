"""Append loads L1-L3: new source rows past the raw mark are added.

Keys are ignored: a changed document becomes another version row.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from tidewater.functions.marks import Mark, read_composite_mark, read_day_mark
from tidewater.functions.predicates import drop_day, newer_than_composite, newer_than_day, where_opt
from tidewater.operators.common import LoadPlan, stamp


def append_composite(
    raw: DataFrame,
    source: DataFrame,
    date_col: str,
    time_col: str,
    run_ts: datetime | str,
    mark: Mark | None = None,
) -> LoadPlan:
    """L1: batch = source rows strictly after the raw's newest ``(d, t)``.

    Running it again with no source change adds nothing.
    """
    mark = mark if mark is not None else read_composite_mark(raw, date_col, time_col)
    pred = None if mark.empty else newer_than_composite(date_col, time_col, mark)
    batch = stamp(where_opt(source, pred), run_ts)
    return LoadPlan(kept=raw, batch=batch, kind="append")


def append_day(
    raw: DataFrame,
    source: DataFrame,
    date_col: str,
    run_ts: datetime | str,
    local_col: str | None = None,
    idempotent: bool = False,
    mark: Mark | None = None,
) -> LoadPlan:
    """L2 / L3: day mark ``D = max(local_col)`` read from the raw side; batch =
    source rows with ``date_col >= D``.

    Plain (L2): the rows of day ``D`` are added again on each run.
    Idempotent (L3): raw rows with ``date_col = D`` are removed first, so the
    boundary day is replaced instead of duplicated.
    """
    local_col = local_col or date_col
    mark = mark if mark is not None else read_day_mark(raw, local_col)
    pred = None if mark.empty else newer_than_day(date_col, mark)
    batch = stamp(where_opt(source, pred), run_ts)
    if idempotent and not mark.empty:
        gone = drop_day(date_col, mark.day)
        return LoadPlan(
            kept=raw.where(~gone), batch=batch, kind="predicate", delete_pred=gone,
            delete_days=(date_col, mark.day, mark.day),
        )
    return LoadPlan(kept=raw, batch=batch, kind="append")
