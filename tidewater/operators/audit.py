"""Audit log of loads (Q0a-c) and its monitoring queries (Q1-Q3, A3, A4).

The log is append-only *events* (start, success, error); the per-table state
of a run is the latest event per (run, table). Appending never rewrites a
row, so a failure that happens before the start event is still recorded, and
logging stays cheap on any file-based table.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.common import ts_literal

RUNNING, SUCCESS, ERROR = "running", "success", "error"
MESSAGE_MAX = 4000

EVENT_SCHEMA = (
    "run_id string, table string, strategy string, frequency string, "
    "event_at timestamp_ntz, status string, rows bigint, message string"
)


def audit_event(
    spark: SparkSession,
    run_id: str,
    table: str,
    strategy: str | None,
    frequency: str | None,
    status: str,
    at: datetime,
    rows: int | None = None,
    message: str | None = None,
) -> DataFrame:
    """One event row (start, success or error)."""
    if status not in (RUNNING, SUCCESS, ERROR):
        raise ValueError(f"unknown audit status {status!r}")
    base = spark.createDataFrame(
        [(run_id, table, strategy, frequency, status, rows, message)],
        "run_id string, table string, strategy string, frequency string, status string, rows bigint, message string",
    )
    return base.select(
        "run_id", "table", "strategy", "frequency",
        ts_literal(at).alias("event_at"), "status", "rows", "message",
    )


def seconds_between(a: Column, b: Column) -> Column:
    """Whole-second boundaries crossed from ``a`` to ``b`` (0.9 s -> 1.1 s is 1).

    Both ends are cut to the second first; on zone-free timestamps this is
    independent of the session time zone.
    """
    return F.timestamp_diff("SECOND", F.date_trunc("second", a), F.date_trunc("second", b))


def audit_state(events: DataFrame, messages: bool = True) -> DataFrame:
    """One row per (run, table): first event time, latest status and its data.

    ``max(struct(event_at, terminal, ...))`` picks the latest event with a
    partial aggregate per task (sort-based, as the buffer is a struct), so a
    run or table holding a large share of events is merged inside each task
    before the shuffle -- no window over a whole group. On equal times a
    terminal event outranks the start event. The message is cut to 4,000
    characters (X7) before it is aggregated; ``messages=False`` leaves it out,
    for the queries that do not show it.
    """
    terminal = F.when(F.col("status") == RUNNING, 0).otherwise(1)
    data = [F.col("event_at").alias("at"), terminal.alias("terminal"), F.col("status"), F.col("rows")]
    if messages:
        data.append(F.substring("message", 1, MESSAGE_MAX).alias("message"))
    last = F.max(F.struct(*data, "strategy", "frequency"))
    g = events.groupBy("run_id", "table").agg(F.min("event_at").alias("started_at"), last.alias("l"))
    state = g.select(
        "run_id",
        "table",
        F.col("l.strategy").alias("strategy"),
        F.col("l.frequency").alias("frequency"),
        "started_at",
        F.when(F.col("l.terminal") == 1, F.col("l.at")).alias("ended_at"),
        F.col("l.rows").alias("rows"),
        F.col("l.status").alias("status"),
        *([F.col("l.message").alias("error_message")] if messages else []),
    )
    return state


def newest_run(events: DataFrame) -> str | None:
    """The run whose first event of some table is the latest: one scalar, no join.

    The state's start is the first event of a table; within a run these never
    precede the run's first one, so the newest first event over (run, table)
    names the run. Ties go to the largest run id.
    """
    firsts = events.groupBy("run_id", "table").agg(F.min("event_at").alias("at"))
    row = firsts.agg(F.max(F.struct("at", "run_id")).alias("m")).first()
    return None if row is None or row["m"] is None else row["m"]["run_id"]


def last_run(events: DataFrame) -> DataFrame:
    """Q1: the newest run's tables with strategy, rows, seconds and status, by start.

    Only the newest run's events are aggregated to a state; its id is a literal
    in the scan of the log.
    """
    state = audit_state(events.where(F.col("run_id") == F.lit(newest_run(events))), messages=False)
    return state.select(
        "table", "strategy", "rows",
        seconds_between(F.col("started_at"), F.col("ended_at")).alias("seconds"),
        "status", "started_at",
    ).orderBy("started_at")


def run_history(state: DataFrame) -> DataFrame:
    """Q2 / A3: per run its start, end, rows, tables and errors, newest first."""
    return (
        state.groupBy("run_id")
        .agg(
            F.min("started_at").alias("started_at"),
            F.max("ended_at").alias("finished_at"),
            F.sum("rows").cast("bigint").alias("total_rows"),
            F.count(F.lit(1)).alias("tables"),
            F.sum(F.when(F.col("status") == ERROR, 1).otherwise(0)).cast("bigint").alias("errors"),
        )
        .orderBy(F.col("started_at").desc())
    )


def error_list(state: DataFrame) -> DataFrame:
    """Q3: tables that failed, with start and message, newest first."""
    return (
        state.where(F.col("status") == ERROR)
        .select("table", "started_at", "error_message")
        .orderBy(F.col("started_at").desc())
    )


def run_summary(state: DataFrame) -> DataFrame:
    """A4: per run, tables succeeded / total, elapsed seconds and the failed
    tables (sorted, comma separated). A run holds one row per configured
    table, so the failed-table list is bounded by the configuration."""
    failed = F.when(F.col("status") == ERROR, F.col("table"))
    return state.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("tables"),
        F.sum(F.when(F.col("status") == SUCCESS, 1).otherwise(0)).cast("bigint").alias("succeeded"),
        F.sum(F.when(F.col("status") == ERROR, 1).otherwise(0)).cast("bigint").alias("failed"),
        seconds_between(F.min("started_at"), F.max("ended_at")).alias("elapsed_s"),
        F.concat_ws(",", F.array_sort(F.collect_list(failed))).alias("failed_tables"),
    )
