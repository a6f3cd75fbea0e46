"""Whole-source loads: full reload (L6), daily snapshot (L7), initial full."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame

from tidewater.functions.predicates import INGEST_COL, drop_today
from tidewater.operators.common import LoadPlan, empty_like, stamp


def full_reload(raw: DataFrame | None, source: DataFrame, run_ts: datetime | str) -> LoadPlan:
    """The raw table becomes the whole source (published atomically by the sink)."""
    batch = stamp(source, run_ts)
    kept = empty_like(raw if raw is not None else batch)
    return LoadPlan(kept=kept, batch=batch, kind="overwrite")


def _run_day(run_ts: datetime | str) -> date:
    if isinstance(run_ts, datetime):
        return run_ts.date()
    return date.fromisoformat(str(run_ts)[:10])


def daily_snapshot(raw: DataFrame, source: DataFrame, run_ts: datetime | str) -> LoadPlan:
    """Remove rows ingested on the run's day, add the whole source stamped
    with the run time. Twice on one day replaces that day's rows; other days
    are history and are never touched. One ``run_ts`` per run keeps a run that
    crosses midnight on one day (trap 23 fix)."""
    day = _run_day(run_ts)
    gone = drop_today(day)
    return LoadPlan(
        kept=raw.where(~gone), batch=stamp(source, run_ts), kind="predicate", delete_pred=gone,
        delete_days=(INGEST_COL, day, day),
    )


def initial_full(
    raw: DataFrame | None,
    source: DataFrame,
    run_ts: datetime | str,
    raw_is_empty: bool = True,
) -> LoadPlan:
    """Insert the whole source into a raw table (no mark, F3).

    The reference never truncates here, so a second run duplicates. For an
    append-style table we only allow it into an empty raw table; the
    strategy-aware re-run rules live in :func:`tidewater.plans.runs.initial_plan`.
    """
    if not raw_is_empty:
        raise ValueError("initial full load into a non-empty append table would duplicate rows")
    batch = stamp(source, run_ts)
    kept = raw if raw is not None else empty_like(batch)
    return LoadPlan(kept=kept, batch=batch, kind="append")
