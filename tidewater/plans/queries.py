"""Registered queries: one per operator of the inventory, over the given tables.

Each takes ``(spark, sf_dir)`` and returns a DataFrame built only from the
library's public functions, applied to whole tables. Marks are read from the
derived raw side with one small aggregate job and then enter the plan as
literals -- the same order of work as a real incremental run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.marks import composite_mark_frame, day_mark_frame, read_composite_mark, read_day_mark
from tidewater.functions.predicates import newer_than_composite, newer_than_day
from tidewater.functions.typemap import SourceColumn, typed_projection
from tidewater.operators import (
    append_composite,
    append_day,
    assign_windows,
    audit_state,
    daily_snapshot,
    error_list,
    evolve_schema,
    full_reload,
    initial_full,
    last_run,
    load_window_by_header,
    load_windows,
    make_windows,
    replace_by_header,
    run_history,
    run_summary,
    scan_projected,
    stamp,
    upsert,
    window_counts,
)
from tidewater.functions.marks import Mark
from tidewater.operators.common import empty_like, newest_per_key, semi_by_key
from tidewater.operators.schema import align_to
from tidewater.plans import fixtures as fx
from tidewater.plans.sink_queries import SINK_QUERIES

# Parameters of the registered queries.
SCAN_COLUMNS = ["O_ORDERKEY", "o_orderdate", "o_totalprice", "o_custkey", "o_comment"]
ORDERS_METADATA = [
    SourceColumn("o_orderkey", "BIGINT", None, None, 1),
    SourceColumn("o_custkey", "INTEGER", None, None, 2),
    SourceColumn("o_orderstatus", "NCHAR", 1, None, 3),
    SourceColumn("o_totalprice", "DECIMAL", 15, 2, 4),
    SourceColumn("o_orderdate", "DATE", None, None, 5),
    SourceColumn("o_orderpriority", "NVARCHAR", 15, None, 6),
    SourceColumn("o_comment", "NVARCHAR", 79, None, 7),
]
LINES_METADATA = [
    SourceColumn("l_orderkey", "BIGINT", None, None, 1),
    SourceColumn("l_linenumber", "TINYINT", None, None, 2),
    SourceColumn("l_quantity", "DECIMAL", 15, 2, 3),
    SourceColumn("l_extendedprice", "DECIMAL", 15, 2, 4),
    SourceColumn("l_discount", "SMALLDECIMAL", 4, 2, 5),
    SourceColumn("l_tax", "DOUBLE", None, None, 6),
    SourceColumn("l_returnflag", "NCHAR", 1, None, 7),
    SourceColumn("l_linestatus", "ST_MEMO", None, None, 8),
    SourceColumn("l_shipdate", "SECONDDATE", None, None, 9),
    SourceColumn("l_comment", "NVARCHAR", 44, None, 10),
]
LINE_KEY = ["l_orderkey", "l_linenumber"]
HISTORY = ("1995-01-01", "2001-08-01", 3)
LEGACY = ("1995-01-01", "2001-07-01", 3)
MONTH_END = ("1995-01-31", "2001-08-01", 1)
RELOAD_WINDOW = ("1999-01-01", "2001-08-01", 3)
HEADER_WINDOW = ("1999-01-01", "1999-12-31", 3)
DAY1_TS = "2024-01-02 10:00:00"


def _hdr(spark, sf):
    return fx.header_source(spark, sf), fx.header_raw(spark, sf)


def q_scan_projected(spark: SparkSession, sf: str) -> DataFrame:
    return stamp(scan_projected(fx.table(spark, sf, "orders"), SCAN_COLUMNS), fx.RUN_TS)


def q_typed_projection(spark: SparkSession, sf: str) -> DataFrame:
    return typed_projection(fx.table(spark, sf, "orders"), ORDERS_METADATA)


def q_top_mark(spark: SparkSession, sf: str) -> DataFrame:
    return composite_mark_frame(fx.header_raw(spark, sf), "updatedate", "updatets").select("mark_date", "mark_time")


def q_max_mark(spark: SparkSession, sf: str) -> DataFrame:
    return day_mark_frame(fx.header_raw(spark, sf), "updatedate").select("mark_day")


def q_newer_composite(spark: SparkSession, sf: str) -> DataFrame:
    src, raw = _hdr(spark, sf)
    mark = read_composite_mark(raw, "updatedate", "updatets")
    return src.where(newer_than_composite("updatedate", "updatets", mark))


def q_newer_day(spark: SparkSession, sf: str) -> DataFrame:
    src, raw = _hdr(spark, sf)
    return src.where(newer_than_day("updatedate", read_day_mark(raw, "updatedate")))


def q_append_composite(spark: SparkSession, sf: str) -> DataFrame:
    src, raw = _hdr(spark, sf)
    return append_composite(raw, src, "updatedate", "updatets", fx.RUN_TS).result()


def q_append_day(spark: SparkSession, sf: str) -> DataFrame:
    src, raw = _hdr(spark, sf)
    return append_day(raw, src, "updatedate", fx.RUN_TS).result()


def q_append_idempotent(spark: SparkSession, sf: str) -> DataFrame:
    src, raw = _hdr(spark, sf)
    return append_day(raw, src, "updatedate", fx.RUN_TS, idempotent=True).result()


def q_upsert_composite(spark: SparkSession, sf: str) -> DataFrame:
    src, raw = _hdr(spark, sf)
    return upsert(raw, src, ["docentry"], "updatedate", fx.RUN_TS, time_col="updatets").result()


def q_upsert_composite_key(spark: SparkSession, sf: str) -> DataFrame:
    src, raw = _hdr(spark, sf)
    return upsert(raw, src, ["docentry", "cardcode"], "updatedate", fx.RUN_TS, time_col="updatets").result()


def q_upsert_dup_batch(spark: SparkSession, sf: str) -> DataFrame:
    src, raw = _hdr(spark, sf)
    return upsert(raw, src, ["cardcode"], "updatedate", fx.RUN_TS, time_col="updatets").result()


def q_upsert_day(spark: SparkSession, sf: str) -> DataFrame:
    src, raw = _hdr(spark, sf)
    return upsert(raw, src, ["docentry"], "updatedate", fx.RUN_TS).result()


def q_replace_by_header(spark: SparkSession, sf: str) -> DataFrame:
    src, raw = _hdr(spark, sf)
    mark = read_composite_mark(raw, "updatedate", "updatets")  # P1: captured before any write
    plan = replace_by_header(
        fx.lines_raw(spark, sf), fx.lines_source(spark, sf), src, mark,
        doc_key="docentry", header_date_col="updatedate", header_time_col="updatets", run_ts=fx.RUN_TS,
    )
    return plan.result()


def q_replace_by_header_day(spark: SparkSession, sf: str) -> DataFrame:
    src, raw = _hdr(spark, sf)
    mark = read_day_mark(raw, "updatedate")
    plan = replace_by_header(
        fx.lines_raw(spark, sf), fx.lines_source(spark, sf), src, mark,
        doc_key="docentry", header_date_col="updatedate", run_ts=fx.RUN_TS, delete_from="headers",
    )
    return plan.result()


def q_full_reload(spark: SparkSession, sf: str) -> DataFrame:
    return full_reload(None, fx.table(spark, sf, "nation"), fx.RUN_TS).result()


def q_snapshot_two_days(spark: SparkSession, sf: str) -> DataFrame:
    src = fx.table(spark, sf, "supplier")
    empty = empty_like(stamp(src, fx.PREV_TS))
    r1 = daily_snapshot(empty, src, DAY1_TS).result()
    r1b = daily_snapshot(r1, src, fx.RUN2_TS).result()
    day2 = src.withColumn("s_acctbal", F.col("s_acctbal") + F.lit(1.0))
    return daily_snapshot(r1b, day2, fx.DAY2_TS).result()


def q_assign_windows(spark: SparkSession, sf: str) -> DataFrame:
    start, end, months = HISTORY
    wins = make_windows(start, end, months)
    return assign_windows(fx.header_source(spark, sf), "updatedate", wins, months).select(
        "docentry", "updatedate", "window_no"
    )


def q_assign_windows_month_end(spark: SparkSession, sf: str) -> DataFrame:
    start, end, months = MONTH_END  # a start on the 31st drifts
    wins = make_windows(start, end, months)
    return assign_windows(fx.header_source(spark, sf), "updatedate", wins, months).select(
        "docentry", "updatedate", "window_no"
    )


def q_window_counts(spark: SparkSession, sf: str) -> DataFrame:
    start, end, months = HISTORY
    wins = make_windows(start, end, months)
    return window_counts(assign_windows(fx.header_source(spark, sf), "updatedate", wins, months), wins)


def q_load_window_rerun(spark: SparkSession, sf: str) -> DataFrame:
    src, raw = _hdr(spark, sf)
    start, end, months = RELOAD_WINDOW
    wins = make_windows(start, end, months)
    once = load_windows(raw, src, "updatedate", wins, months, fx.RUN_TS).result()
    return load_windows(once, src, "updatedate", wins, months, fx.RUN2_TS).result()


def q_load_window_by_header(spark: SparkSession, sf: str) -> DataFrame:
    start, end, months = HEADER_WINDOW
    wins = make_windows(start, end, months)
    src = fx.header_source(spark, sf)
    lines = fx.lines_source(spark, sf)
    empty = empty_like(stamp(lines, fx.PREV_TS))
    once = load_window_by_header(empty, lines, src, "docentry", "updatedate", wins, months, fx.RUN_TS).result()
    return load_window_by_header(once, lines, src, "docentry", "updatedate", wins, months, fx.RUN2_TS).result()


def q_initial_full(spark: SparkSession, sf: str) -> DataFrame:
    return initial_full(None, fx.table(spark, sf, "customer"), fx.RUN_TS).result()


def q_evolve_schema(spark: SparkSession, sf: str) -> DataFrame:
    raw = fx.header_raw(spark, sf).drop("doctotal")
    new = fx.header_new(spark, sf).select(
        F.col("docentry").alias("DOCENTRY"), F.col("cardcode").alias("CardCode"),
        F.col("doctotal").alias("DocTotal"), F.col("updatedate").alias("UpdateDate"),
        F.col("updatets").alias("UpdateTS"),
    )
    grown = evolve_schema(raw, new.schema)
    return grown.unionByName(stamp(align_to(grown.schema, new), fx.RUN_TS), allowMissingColumns=True)


def q_semi_by_header(spark: SparkSession, sf: str) -> DataFrame:
    src, raw = _hdr(spark, sf)
    mark = read_composite_mark(raw, "updatedate", "updatets")
    changed = src.where(newer_than_composite("updatedate", "updatets", mark))
    return semi_by_key(fx.lines_source(spark, sf), changed, "docentry", "docentry")


def q_newest_per_line_key(spark: SparkSession, sf: str) -> DataFrame:
    li = fx.table(spark, sf, "lineitem")
    return newest_per_key(li, LINE_KEY, ["l_shipdate"])


def q_typed_projection_lines(spark: SparkSession, sf: str) -> DataFrame:
    return typed_projection(fx.table(spark, sf, "lineitem"), LINES_METADATA)


def q_initial_full_upsert(spark: SparkSession, sf: str) -> DataFrame:
    src, raw = _hdr(spark, sf)
    plan = upsert(raw, src, ["docentry"], "updatedate", fx.RUN_TS, time_col="updatets", mark=Mark.none(True))
    return plan.result()


def q_assign_windows_legacy(spark: SparkSession, sf: str) -> DataFrame:
    start, end, months = LEGACY
    wins = make_windows(start, end, months, legacy_end=True)
    return assign_windows(fx.header_plain(spark, sf), "updatedate", wins, months).select(
        "docentry", "updatedate", "window_no"
    )


def _state(spark, sf, messages=True):
    return audit_state(fx.audit_events(spark, sf), messages)


def q_audit_state(spark: SparkSession, sf: str) -> DataFrame:
    return _state(spark, sf)


def q_audit_last_run(spark: SparkSession, sf: str) -> DataFrame:
    return last_run(fx.audit_events(spark, sf))


def q_audit_history(spark: SparkSession, sf: str) -> DataFrame:
    return run_history(_state(spark, sf, messages=False))


def q_audit_errors(spark: SparkSession, sf: str) -> DataFrame:
    return error_list(_state(spark, sf))


def q_run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return run_summary(_state(spark, sf, messages=False))


REGISTRY = {
    "scan_projected": q_scan_projected,
    "typed_projection": q_typed_projection,
    "top_mark": q_top_mark,
    "max_mark": q_max_mark,
    "newer_composite": q_newer_composite,
    "newer_day": q_newer_day,
    "append_composite": q_append_composite,
    "append_day": q_append_day,
    "append_idempotent": q_append_idempotent,
    "upsert_composite": q_upsert_composite,
    "upsert_composite_key": q_upsert_composite_key,
    "upsert_dup_batch": q_upsert_dup_batch,
    "upsert_day": q_upsert_day,
    "replace_by_header": q_replace_by_header,
    "replace_by_header_day": q_replace_by_header_day,
    "full_reload": q_full_reload,
    "snapshot_two_days": q_snapshot_two_days,
    "assign_windows": q_assign_windows,
    "assign_windows_month_end": q_assign_windows_month_end,
    "window_counts": q_window_counts,
    "load_window_rerun": q_load_window_rerun,
    "load_window_by_header": q_load_window_by_header,
    "initial_full": q_initial_full,
    "evolve_schema": q_evolve_schema,
    "semi_by_header": q_semi_by_header,
    "newest_per_line_key": q_newest_per_line_key,
    "typed_projection_lines": q_typed_projection_lines,
    "initial_full_upsert": q_initial_full_upsert,
    "assign_windows_legacy": q_assign_windows_legacy,
    "audit_state": q_audit_state,
    "audit_last_run": q_audit_last_run,
    "audit_history": q_audit_history,
    "audit_errors": q_audit_errors,
    "run_summary": q_run_summary,
}

# queries that go through the run drivers and the sink
REGISTRY.update(SINK_QUERIES)
