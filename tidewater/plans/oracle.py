"""DuckDB SQL equal to each registered query, over the same tables.

Written independently of the Spark code: marks as ORDER BY ... LIMIT 1 or
MAX, keyed deletes as NOT EXISTS, semi-joins as IN, windows as a recursive
CTE of month steps joined on BETWEEN, latest-event state as ROW_NUMBER.
"""

from __future__ import annotations

from tidewater.plans import fixtures as fx
from tidewater.plans.queries import HEADER_WINDOW, HISTORY, LEGACY, MONTH_END, RELOAD_WINDOW

H = fx.with_ctes(fx.HEADER_CTES)
HL = fx.with_ctes(fx.HEADER_CTES, fx.LINES_CTES)
A = fx.with_ctes(fx.AUDIT_CTES)
RUN = f"TIMESTAMP '{fx.RUN_TS}'"
RUN2 = f"TIMESTAMP '{fx.RUN2_TS}'"
DAY2 = f"TIMESTAMP '{fx.DAY2_TS}'"
NEWER = "(h.updatedate > wm.d or (h.updatedate = wm.d and h.updatets > wm.t))"
HDR_COLS = "docentry, cardcode, doctotal, updatedate, updatets"


def _values(start, end, months, legacy_end=False) -> str:
    """The windows from DuckDB's own month arithmetic, each start stepped from the one before."""
    step, more = f"INTERVAL {months} MONTH", "<" if legacy_end else "<="
    return (
        f"(with recursive s(window_no, window_start) as (select 1, DATE '{start}' union all "
        f"select window_no + 1, cast(window_start + {step} as date) from s where window_start + {step} {more} DATE '{end}') "
        f"select window_no, window_start, cast(least(window_start + {step} - INTERVAL 1 DAY, DATE '{end}') as date) window_end from s) w"
    )


def _upsert(keys: list[str], newer: str, dedupe_order: str | None = None) -> str:
    match = " and ".join(f"b.{k} = r.{k}" for k in keys)
    if dedupe_order:
        part = ", ".join(keys)
        batch = (
            f"b0 as (select h.* from hdr_all h, wm where {newer}), "
            f"b1 as (select *, row_number() over (partition by {part} order by {dedupe_order}) rn from b0), "
            f"b as (select {HDR_COLS}, {RUN} _ingested_at from b1 where rn = 1)"
        )
    else:
        batch = f"b as (select h.*, {RUN} _ingested_at from hdr_all h, wm where {newer})"
    return (
        H.rstrip("\n") + f", {batch}\n"
        f"select * from hdr_raw r where not exists (select 1 from b where {match})\n"
        "union all select * from b"
    )


ORDER_ALL = "updatedate desc nulls last, updatets desc nulls last, docentry desc nulls last, doctotal desc nulls last"

SQL: dict[str, str] = {
    "scan_projected": f"select o_orderkey, o_orderdate, o_totalprice, o_custkey, {RUN} _ingested_at from orders",
    "typed_projection": (
        "select cast(o_orderkey as bigint) o_orderkey, cast(o_custkey as integer) o_custkey, "
        "cast(o_orderstatus as varchar) o_orderstatus, cast(o_totalprice as decimal(15,2)) o_totalprice, "
        "cast(o_orderdate as date) o_orderdate, cast(o_orderpriority as varchar) o_orderpriority from orders"
    ),
    "top_mark": H + "select d mark_date, t mark_time from wm",
    "max_mark": H + "select d mark_day from dm",
    "newer_composite": H + f"select h.* from hdr_all h, wm where {NEWER}",
    "newer_day": H + "select h.* from hdr_all h, dm where h.updatedate >= dm.d",
    "append_composite": H + f"select * from hdr_raw union all select h.*, {RUN} from hdr_all h, wm where {NEWER}",
    "append_day": H + f"select * from hdr_raw union all select h.*, {RUN} from hdr_all h, dm where h.updatedate >= dm.d",
    "append_idempotent": H + (
        "select r.* from hdr_raw r, dm where not coalesce(r.updatedate = dm.d, false) "
        f"union all select h.*, {RUN} from hdr_all h, dm where h.updatedate >= dm.d"
    ),
    "upsert_composite": _upsert(["docentry"], NEWER),
    "upsert_composite_key": _upsert(["docentry", "cardcode"], NEWER),
    "upsert_dup_batch": _upsert(["cardcode"], NEWER, ORDER_ALL),
    "upsert_day": H.rstrip("\n") + (
        f", b as (select h.*, {RUN} _ingested_at from hdr_all h, dm where h.updatedate >= dm.d)\n"
        "select * from hdr_raw r where not exists (select 1 from b where b.docentry = r.docentry)\n"
        "union all select * from b"
    ),
    "replace_by_header": HL.rstrip("\n") + (
        f", changed as (select h.docentry from hdr_all h, wm where {NEWER}),\n"
        f"b as (select l.*, {RUN} _ingested_at from lines_src l where l.docentry in (select docentry from changed))\n"
        "select * from lines_raw r where not exists (select 1 from b where b.docentry = r.docentry)\n"
        "union all select * from b"
    ),
    "replace_by_header_day": HL.rstrip("\n") + (
        ", changed as (select h.docentry from hdr_all h, dm where h.updatedate >= dm.d),\n"
        f"b as (select l.*, {RUN} _ingested_at from lines_src l where l.docentry in (select docentry from changed))\n"
        "select * from lines_raw r where not exists (select 1 from changed c where c.docentry = r.docentry)\n"
        "union all select * from b"
    ),
    "full_reload": f"select *, {RUN} _ingested_at from nation",
    "snapshot_two_days": (
        f"select *, {RUN2} _ingested_at from supplier union all "
        f"select s_suppkey, s_name, s_nationkey, s_acctbal + 1.0 s_acctbal, {DAY2} _ingested_at from supplier"
    ),
    "assign_windows": fx.with_ctes(fx.HEADER_CTES) + (
        f"select h.docentry, h.updatedate, w.window_no from hdr_all h join {_values(*HISTORY)} "
        "on h.updatedate between w.window_start and w.window_end"
    ),
    "assign_windows_month_end": fx.with_ctes(fx.HEADER_CTES) + (
        f"select h.docentry, h.updatedate, w.window_no from hdr_all h join {_values(*MONTH_END)} "
        "on h.updatedate between w.window_start and w.window_end"
    ),
    "window_counts": fx.with_ctes(fx.HEADER_CTES) + (
        f"select w.window_no, w.window_start, w.window_end, cast(count(h.docentry) as bigint) \"rows\" "
        f"from {_values(*HISTORY)} left join hdr_all h on h.updatedate between w.window_start and w.window_end "
        "group by w.window_no, w.window_start, w.window_end"
    ),
    "load_window_rerun": H + (
        f"select * from hdr_raw where not coalesce(updatedate between DATE '{RELOAD_WINDOW[0]}' and DATE '{RELOAD_WINDOW[1]}', false) "
        f"union all select h.*, {RUN2} from hdr_all h "
        f"where h.updatedate between DATE '{RELOAD_WINDOW[0]}' and DATE '{RELOAD_WINDOW[1]}'"
    ),
    "load_window_by_header": HL + (
        f"select l.*, {RUN2} _ingested_at from lines_src l where l.docentry in "
        f"(select docentry from hdr_all where updatedate between DATE '{HEADER_WINDOW[0]}' and DATE '{HEADER_WINDOW[1]}')"
    ),
    "initial_full": f"select *, {RUN} _ingested_at from customer",
    "evolve_schema": H + (
        "select docentry, cardcode, updatedate, updatets, _ingested_at, cast(null as double) \"DocTotal\" from hdr_raw "
        f"union all select docentry, cardcode, updatedate, updatets, {RUN}, doctotal from hdr_new"
    ),
    "semi_by_header": HL + (
        f"select l.* from lines_src l where l.docentry in (select h.docentry from hdr_all h, wm where {NEWER})"
    ),
    "newest_per_line_key": (
        "select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
        "l_returnflag, l_linestatus, l_shipdate from (select *, row_number() over (partition by l_orderkey, l_linenumber "
        "order by l_shipdate desc nulls last, l_partkey desc nulls last, l_suppkey desc nulls last, "
        "l_quantity desc nulls last, l_extendedprice desc nulls last, l_discount desc nulls last, "
        "l_tax desc nulls last, l_returnflag desc nulls last, l_linestatus desc nulls last) rn "
        "from lineitem where l_orderkey is not null and l_linenumber is not null) where rn = 1 "
        "union all select * from lineitem where l_orderkey is null or l_linenumber is null"
    ),
    "typed_projection_lines": (
        "select cast(l_orderkey as bigint) l_orderkey, cast(l_linenumber as smallint) l_linenumber, "
        "cast(l_quantity as decimal(15,2)) l_quantity, cast(l_extendedprice as decimal(15,2)) l_extendedprice, "
        "cast(l_discount as decimal(4,2)) l_discount, cast(l_tax as double) l_tax, "
        "cast(l_returnflag as varchar) l_returnflag, cast(l_linestatus as varchar) l_linestatus, "
        "cast(l_shipdate as timestamp) l_shipdate from lineitem"
    ),
    "initial_full_upsert": H.rstrip("\n") + (
        f", b as (select h.*, {RUN} _ingested_at from hdr_all h)\n"
        "select * from hdr_raw r where not exists (select 1 from b where b.docentry = r.docentry)\n"
        "union all select * from b"
    ),
    "assign_windows_legacy": fx.with_ctes(fx.HEADER_CTES) + (
        f"select h.docentry, h.updatedate, w.window_no from hdr_plain h join {_values(*LEGACY, legacy_end=True)} "
        "on h.updatedate between w.window_start and w.window_end"
    ),
    "audit_state": A + "select * from state",
    "audit_last_run": A + (
        "select \"table\", strategy, \"rows\", date_diff('second', started_at, ended_at) \"seconds\", status, started_at "
        "from state where run_id = (select run_id from state order by started_at desc, run_id desc limit 1)"
    ),
    "audit_history": A + (
        "select run_id, min(started_at) started_at, max(ended_at) finished_at, cast(sum(\"rows\") as bigint) total_rows, "
        "count(*) \"tables\", cast(sum(case when status = 'error' then 1 else 0 end) as bigint) errors "
        "from state group by run_id"
    ),
    "audit_errors": A + "select \"table\", started_at, error_message from state where status = 'error'",
    "run_summary": A + (
        "select run_id, count(*) \"tables\", "
        "cast(sum(case when status = 'success' then 1 else 0 end) as bigint) succeeded, "
        "cast(sum(case when status = 'error' then 1 else 0 end) as bigint) failed, "
        "date_diff('second', min(started_at), max(ended_at)) elapsed_s, "
        "coalesce(string_agg(case when status = 'error' then \"table\" end, ',' order by \"table\"), '') failed_tables "
        "from state group by run_id"
    ),
}

# the same loads through the run drivers and the sink end in the same tables
SQL |= {
    "run_append_twice": SQL["append_composite"],
    "run_upsert": SQL["upsert_composite"],
    "run_replace_by_header": SQL["replace_by_header"],
    "run_windows_rerun": SQL["load_window_rerun"],
    "run_snapshot_days": SQL["snapshot_two_days"],
    "run_full_reload": SQL["full_reload"],
    "run_evolve": SQL["evolve_schema"],
    "run_audit_log": (
        "select 'nation' \"table\", 'full_reload' strategy, 'daily' frequency, (select count(*) from nation) \"rows\", 'success' status, false has_message "
        "union all select 'orders', 'append', 'weekly', (select count(*) from orders), 'success', false "
        "union all select 'missing', 'full_reload', 'daily', null, 'error', true"
    ),
    "run_frequency": (
        f"select 'customer' \"table\", c_custkey k, TIMESTAMP '{fx.PREV_TS}' _ingested_at from customer "
        f"union all select 'supplier', s_suppkey, {RUN} from supplier"
    ),
    "run_window_rows": (
        f"select w.window_no, cast(count(h.docentry) as bigint) \"rows\" from {_values(*HISTORY)} "
        "left join (select * from hdr_all) h on h.updatedate between w.window_start and w.window_end group by w.window_no"
    ),
}
SQL["run_window_rows"] = fx.with_ctes(fx.HEADER_CTES) + SQL["run_window_rows"]
SQL |= {
    "run_truncate": H + f"select h.*, {RUN} _ingested_at from hdr_all h",
    "run_marks": H + "select t.* , wm.d mark_date, wm.t mark_time, dm.d mark_day from (values ('hdr'), ('keyed')) t(\"table\"), wm, dm",
    "run_window_rows_by_header": HL + (
        f"select w.window_no, cast(count(l.docentry) as bigint) \"rows\" from {_values(*HISTORY)} "
        "left join hdr_all h on h.updatedate between w.window_start and w.window_end "
        "left join lines_src l on l.docentry = h.docentry group by w.window_no"
    ),
    "run_until_today": H + (
        f"select w.window_no, cast(count(h.docentry) as bigint) \"rows\" from {_values('1995-01-01', fx.RUN_TS[:10], 6)} "
        "left join hdr_all h on h.updatedate between w.window_start and w.window_end group by w.window_no"
    ),
    "run_ids": (
        "select 36 id_length, 2 \"tables\", (select count(*) from nation) + (select count(*) from region) total_rows, "
        "0 errors, 'success' status from (values (1), (2)) runs(run)"
    ),
    "split_read": " union all ".join(
        f"select '{t}' \"table\", count(*) \"rows\", 1 times, true even from {t}" for t in ("orders", "events", "lineitem")
    ),
}
