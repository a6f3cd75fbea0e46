"""Reference-shaped inputs derived from the supplied test tables.

``orders`` plays the document header, ``lineitem`` its lines, ``customer`` /
``part`` master data, ``nation`` a small reference table, ``supplier`` the
stock snapshot and ``events`` the audit log. Each frame has a Spark builder
and the same derivation as a SQL common table expression, so the oracle runs
exactly the same inputs.

"Raw before" is the header up to 1999-06-30; "source now" re-dates every
order whose key is divisible by 7 to 2001-12-01 (a late update), and drops
line 1 of those orders at the source.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RAW_CUTOFF = "1999-06-30 00:00:00"
REDATE = date(2001, 12, 1)
PREV_TS = "2024-01-01 00:00:00"  # when the raw side was loaded
RUN_TS = "2024-01-02 06:00:00"  # the run under test
RUN2_TS = "2024-01-02 18:30:00"  # a re-run the same day
DAY2_TS = "2024-01-03 07:15:00"  # the next day's run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _hhmmss(k):
    """Derived HHMMSS mark time of an order key."""
    return (((k * 37) % 24) * 10000 + ((k * 17) % 60) * 100 + (k * 11) % 60).cast("int")


def _ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


def header_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source now: every order, keys divisible by 7 updated on 2001-12-01."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("docentry"),
        F.col("o_custkey").alias("cardcode"),
        F.col("o_totalprice").alias("doctotal"),
        F.when(k % 7 == 0, F.lit(REDATE)).otherwise(F.to_date("o_orderdate")).alias("updatedate"),
        _hhmmss(k).alias("updatets"),
    )


def header_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with its own date (no late update)."""
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        k.alias("docentry"),
        F.col("o_custkey").alias("cardcode"),
        F.col("o_totalprice").alias("doctotal"),
        F.to_date("o_orderdate").alias("updatedate"),
        _hhmmss(k).alias("updatets"),
        F.col("o_orderdate"),
    )


def header_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw before: orders up to the cut-off, loaded at ``PREV_TS``."""
    h = header_plain(spark, sf_dir)
    return h.where(F.col("o_orderdate") <= _ts(RAW_CUTOFF)).drop("o_orderdate").withColumn("_ingested_at", _ts(PREV_TS))


def header_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders after the cut-off, with their own dates."""
    h = header_plain(spark, sf_dir)
    return h.where(F.col("o_orderdate") > _ts(RAW_CUTOFF)).drop("o_orderdate")


def _lines(li: DataFrame) -> DataFrame:
    return li.select(
        F.col("l_orderkey").alias("docentry"),
        F.col("l_linenumber").alias("linenum"),
        F.col("l_partkey").alias("itemcode"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("linetotal"),
    )


def lines_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines now: line 1 of every order divisible by 7 was removed."""
    li = table(spark, sf_dir, "lineitem")
    return _lines(li.where(~((F.col("l_linenumber") == 1) & (F.col("l_orderkey") % 7 == 0))))


def lines_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines before: every line of the raw headers."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").where(F.col("o_orderdate") <= _ts(RAW_CUTOFF)).select("o_orderkey")
    o = o.hint("shuffle_hash")  # the lines of the join are not sorted in memory
    return _lines(li.join(o, li["l_orderkey"] == o["o_orderkey"], "left_semi")).withColumn("_ingested_at", _ts(PREV_TS))


def audit_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit events shaped from ``events``: 20 tables per run, a start event
    at ``ts`` and an end event 90 s later (error when ``event_type='error'``)."""
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    common = [
        F.concat(F.lit("run-"), (eid - eid % 20).cast("string")).alias("run_id"),
        F.concat(F.lit("T"), (eid % 20).cast("string")).alias("table"),
        F.col("event_type").alias("strategy"),
        F.when(F.col("user_id") % 2 == 0, F.lit("daily")).otherwise(F.lit("weekly")).alias("frequency"),
    ]
    is_err = F.col("event_type") == "error"
    start = e.select(
        *common, F.col("ts").alias("event_at"), F.lit("running").alias("status"),
        F.lit(None).cast("int").alias("rows"), F.lit(None).cast("string").alias("message"),
    )
    end = e.select(
        *common,
        (F.col("ts") + F.expr("INTERVAL 90 SECONDS")).alias("event_at"),
        F.when(is_err, F.lit("error")).otherwise(F.lit("success")).alias("status"),
        F.when(~is_err, F.floor("value").cast("int")).alias("rows"),
        F.when(is_err, F.repeat(F.col("props"), 500)).alias("message"),
    )
    return start.unionByName(end)


# --- the same inputs as SQL (DuckDB) ---------------------------------------

HHMMSS_SQL = "cast((({k}*37) % 24)*10000 + (({k}*17) % 60)*100 + ({k}*11) % 60 as int)"

HEADER_CTES = f"""
hdr_all as (
  select o_orderkey docentry, o_custkey cardcode, o_totalprice doctotal,
         case when o_orderkey % 7 = 0 then DATE '{REDATE.isoformat()}' else cast(o_orderdate as date) end updatedate,
         {HHMMSS_SQL.format(k='o_orderkey')} updatets
  from orders),
hdr_plain as (
  select o_orderkey docentry, o_custkey cardcode, o_totalprice doctotal, cast(o_orderdate as date) updatedate,
         {HHMMSS_SQL.format(k='o_orderkey')} updatets, o_orderdate
  from orders),
hdr_raw as (
  select docentry, cardcode, doctotal, updatedate, updatets, TIMESTAMP '{PREV_TS}' _ingested_at
  from hdr_plain where o_orderdate <= TIMESTAMP '{RAW_CUTOFF}'),
hdr_new as (
  select docentry, cardcode, doctotal, updatedate, updatets
  from hdr_plain where o_orderdate > TIMESTAMP '{RAW_CUTOFF}'),
wm as (
  select updatedate d, coalesce(updatets, 0) t from hdr_raw
  where updatedate is not null order by updatedate desc, updatets desc nulls last limit 1),
dm as (select max(updatedate) d from hdr_raw)"""

LINES_CTES = f"""
lines_src as (
  select l_orderkey docentry, l_linenumber linenum, l_partkey itemcode, l_quantity quantity, l_extendedprice linetotal
  from lineitem where not (l_linenumber = 1 and l_orderkey % 7 = 0)),
lines_raw as (
  select l_orderkey docentry, l_linenumber linenum, l_partkey itemcode, l_quantity quantity, l_extendedprice linetotal,
         TIMESTAMP '{PREV_TS}' _ingested_at
  from lineitem where l_orderkey in (select o_orderkey from orders where o_orderdate <= TIMESTAMP '{RAW_CUTOFF}'))"""

AUDIT_CTES = """
ev as (
  select 'run-' || cast(event_id - event_id % 20 as varchar) run_id,
         'T' || cast(event_id % 20 as varchar) "table",
         event_type strategy,
         case when user_id % 2 = 0 then 'daily' else 'weekly' end frequency,
         ts, event_type, value, props
  from events),
audit_ev as (
  select run_id, "table", strategy, frequency, ts event_at, 'running' status,
         cast(null as integer) "rows", cast(null as varchar) message from ev
  union all
  select run_id, "table", strategy, frequency, ts + INTERVAL 90 SECOND event_at,
         case when event_type = 'error' then 'error' else 'success' end status,
         case when event_type <> 'error' then cast(floor(value) as integer) end "rows",
         case when event_type = 'error' then repeat(props, 500) end message from ev),
ranked as (
  select *, row_number() over (partition by run_id, "table"
              order by event_at desc, case when status = 'running' then 0 else 1 end desc) rn,
         min(event_at) over (partition by run_id, "table") started_at
  from audit_ev),
state as (
  select run_id, "table", strategy, frequency, started_at,
         case when status <> 'running' then event_at end ended_at,
         "rows", status, substring(message, 1, 4000) error_message
  from ranked where rn = 1)"""


def with_ctes(*blocks: str) -> str:
    return "with " + ",".join(b.strip("\n") for b in blocks) + "\n"
