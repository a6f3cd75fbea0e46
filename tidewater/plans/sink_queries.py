"""Queries that load the given tables through the run drivers and the sink.

Each loads into a fresh raw layer under the shared checkpoint folder and
returns what the raw table then holds, so that the rows compared are those on
storage: the catalog, staging, Spark's commits, marks and audit are part of the result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.plans import fixtures as fx
from tidewater.plans.runs import RunResult, incremental_load, initial_load, read_mark
from tidewater.plans.settings import InitialLoad, TableSpec
from tidewater.session import ensure_checkpoint_dir
from tidewater.sources.audit_log import AuditLog
from tidewater.sources.readers import split_predicates
from tidewater.sources.sink import RawTable

SINK_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

HEADER = TableSpec("hdr", "append", mark_col="updatedate", mark_time_col="updatets")


def _query(f):
    SINK_QUERIES[f.__name__] = f
    return f


def _at(ts: str) -> datetime:
    return datetime.fromisoformat(ts)


def _root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark)}/tidewater-raw-{uuid.uuid4().hex}"


def _done(result: RunResult) -> RunResult:
    if not result.ok:
        raise RuntimeError(f"loads failed: {result.failures}")
    return result


def _loads(spark: SparkSession, specs: Iterable[TableSpec], first: dict, *later: tuple[dict, str]) -> str:
    """An initial run of ``first`` at PREV_TS, then an incremental run of each (sources, time)."""
    root, specs = _root(spark), list(specs)
    _done(initial_load(spark, specs, first.__getitem__, root, run_ts=_at(fx.PREV_TS)))
    for sources, ts in later:
        _done(incremental_load(spark, specs, sources.__getitem__, root, run_ts=_at(ts)))
    return root


def _headers(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return fx.header_raw(spark, sf).drop("_ingested_at"), fx.header_source(spark, sf)


@_query
def run_append_twice(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _headers(spark, sf)
    root = _loads(spark, [HEADER], {"hdr": old}, ({"hdr": new}, fx.RUN_TS), ({"hdr": new}, fx.RUN2_TS))
    return RawTable(spark, root, "hdr").read()


@_query
def run_upsert(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _headers(spark, sf)
    spec = TableSpec("hdr", "upsert", keys=("docentry",), mark_col="updatedate", mark_time_col="updatets", buckets=8)
    return RawTable(spark, _loads(spark, [spec], {"hdr": old}, ({"hdr": new}, fx.RUN_TS)), "hdr").read()


@_query
def run_replace_by_header(spark: SparkSession, sf: str) -> DataFrame:
    """Headers load before their lines, so the lines need the mark captured before the run."""
    old, new = _headers(spark, sf)
    lines = TableSpec("lines", "replace_by_header", header_table="hdr", header_mark_col="updatedate",
                      header_mark_time_col="updatets", doc_key="docentry", buckets=8)
    first = {"hdr": old, "lines": fx.lines_raw(spark, sf).drop("_ingested_at")}
    root = _loads(spark, [HEADER, lines], first, ({"hdr": new, "lines": fx.lines_source(spark, sf)}, fx.RUN_TS))
    return RawTable(spark, root, "lines").read()


@_query
def run_windows_rerun(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _headers(spark, sf)
    root = _loads(spark, [HEADER], {"hdr": old})
    window = InitialLoad(date(1999, 1, 1), date(2001, 8, 1), 3, 4)
    spec = TableSpec("hdr", "append", mark_col="updatedate", mark_time_col="updatets", initial=window)
    for ts in (fx.RUN_TS, fx.RUN2_TS):
        _done(initial_load(spark, [spec], {"hdr": new}.__getitem__, root, run_ts=_at(ts)))
    return RawTable(spark, root, "hdr").read()


@_query
def run_window_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A2: the row count of each history window that the run reports."""
    start, end, months = date(1995, 1, 1), date(2001, 8, 1), 3
    spec = TableSpec("hdr", "append", mark_col="updatedate", initial=InitialLoad(start, end, months, 10))
    source = fx.header_source(spark, sf)
    result = _done(initial_load(spark, [spec], {"hdr": source}.__getitem__, _root(spark), run_ts=_at(fx.RUN_TS)))
    return spark.createDataFrame([*result.windows["hdr"].items()], "window_no int, rows long")


@_query
def run_snapshot_days(spark: SparkSession, sf: str) -> DataFrame:
    src = fx.table(spark, sf, "supplier")
    spec, root = TableSpec("sup", "daily_snapshot"), _root(spark)
    _done(initial_load(spark, [spec], {"sup": src}.__getitem__, root, run_ts=datetime(2024, 1, 2, 10)))
    _done(incremental_load(spark, [spec], {"sup": src}.__getitem__, root, run_ts=_at(fx.RUN2_TS)))
    day2 = src.withColumn("s_acctbal", F.col("s_acctbal") + F.lit(1.0))
    _done(incremental_load(spark, [spec], {"sup": day2}.__getitem__, root, run_ts=_at(fx.DAY2_TS)))
    return RawTable(spark, root, "sup").read()


@_query
def run_full_reload(spark: SparkSession, sf: str) -> DataFrame:
    """The table held other rows before; none may stay."""
    src = fx.table(spark, sf, "nation")
    old = src.unionByName(src.withColumn("n_nationkey", F.col("n_nationkey") + 1000)).withColumn("n_name", F.lit("old"))
    root = _loads(spark, [TableSpec("nat")], {"nat": old}, ({"nat": src}, fx.RUN_TS))
    return RawTable(spark, root, "nat").read()


@_query
def run_evolve(spark: SparkSession, sf: str) -> DataFrame:
    """A column that the source gained, and its names in another case."""
    old, _ = _headers(spark, sf)
    new = fx.header_new(spark, sf).select(
        F.col("docentry").alias("DOCENTRY"), F.col("cardcode").alias("CardCode"), F.col("doctotal").alias("DocTotal"),
        F.col("updatedate").alias("UpdateDate"), F.col("updatets").alias("UpdateTS"),
    )
    root = _loads(spark, [HEADER], {"hdr": old.drop("doctotal")}, ({"hdr": new}, fx.RUN_TS))
    return RawTable(spark, root, "hdr").read()


@_query
def run_truncate(spark: SparkSession, sf: str) -> DataFrame:
    """An emptied table has no mark, so the next run reads the whole source."""
    old, new = _headers(spark, sf)
    root = _loads(spark, [HEADER], {"hdr": old})
    RawTable(spark, root, "hdr").truncate()
    _done(incremental_load(spark, [HEADER], {"hdr": new}.__getitem__, root, run_ts=_at(fx.RUN_TS)))
    return RawTable(spark, root, "hdr").read()


@_query
def run_marks(spark: SparkSession, sf: str) -> DataFrame:
    """The marks of a stored table, the day from file statistics."""
    old, _ = _headers(spark, sf)
    by_key = TableSpec("keyed", "upsert", keys=("docentry",), mark_col="updatedate", mark_time_col="updatets", buckets=8)
    root = _loads(spark, [HEADER, by_key], {"hdr": old, "keyed": old})
    marks = []
    for name in ("hdr", "keyed"):
        table = RawTable(spark, root, name)
        newest, day = read_mark(table, "updatedate", "updatets"), read_mark(table, "updatedate", None)
        marks.append((name, newest.day, newest.time, day.day))
    return spark.createDataFrame(marks, "table string, mark_date date, mark_time int, mark_day date")


@_query
def run_window_rows_by_header(spark: SparkSession, sf: str) -> DataFrame:
    """A2 of a line table: rows of each history window of its header."""
    start, end, months = date(1995, 1, 1), date(2001, 8, 1), 3
    spec = TableSpec("lines", "replace_by_header", header_table="hdr", header_mark_col="updatedate", doc_key="docentry",
                     buckets=8, initial=InitialLoad(start, end, months))
    sources = {"hdr": fx.header_source(spark, sf), "lines": fx.lines_source(spark, sf)}
    result = _done(initial_load(spark, [spec], sources.__getitem__, _root(spark), run_ts=_at(fx.RUN_TS)))
    return spark.createDataFrame([*result.windows["lines"].items()], "window_no int, rows long")


@_query
def run_until_today(spark: SparkSession, sf: str) -> DataFrame:
    """X11: a history load without an end goes to the day of the run."""
    spec = TableSpec("hdr", "append", mark_col="updatedate", initial=InitialLoad(date(1995, 1, 1), None, 6))
    source = fx.header_source(spark, sf)
    result = _done(initial_load(spark, [spec], {"hdr": source}.__getitem__, _root(spark), run_ts=_at(fx.RUN_TS)))
    return spark.createDataFrame([*result.windows["hdr"].items()], "window_no int, rows long")


@_query
def run_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Each run writes its tables' audit rows under one new id."""
    root, specs, read = _root(spark), [TableSpec("nation"), TableSpec("region")], lambda name: fx.table(spark, sf, name)
    audit = AuditLog(spark, f"{root}/_audit")
    _done(initial_load(spark, specs, read, root, audit=audit))
    _done(incremental_load(spark, specs, read, root, audit=audit))
    runs = audit.history().join(audit.state().groupBy("run_id").agg(F.max("status").alias("status")), "run_id")
    return runs.select(F.length("run_id").alias("id_length"), "tables", "total_rows", "errors", "status")


@_query
def split_read(spark: SparkSession, sf: str) -> DataFrame:
    """A table read by predicates of equal depth holds each row once, and no split is over twice the mean."""
    out = None
    for name, column in (("orders", "o_custkey"), ("events", "ts"), ("lineitem", "l_extendedprice")):
        source = fx.table(spark, sf, name)
        number = F.lit(-1)
        for k, p in enumerate(predicates := split_predicates(source, column, 8, quote="`")):
            number = F.when(F.expr(p), k).otherwise(number)
        taken = sum(F.expr(p).cast("int") for p in predicates)
        per = source.select(number.alias("split"), taken.alias("taken")).groupBy("split").agg(F.count("*").alias("n"), F.max("taken").alias("taken"))
        one = per.agg(F.sum("n").alias("rows"), F.max("taken").alias("times"), (F.max("n") * F.count("*") <= 2 * F.sum("n")).alias("even"))
        one = one.select(F.lit(name).alias("table"), "rows", F.col("times").cast("int").alias("times"), "even")
        out = one if out is None else out.unionByName(one)
    return out


@_query
def run_audit_log(spark: SparkSession, sf: str) -> DataFrame:
    """The log's own rows for a run with a table that fails."""
    root = _root(spark)
    audit = AuditLog(spark, f"{root}/_audit")
    specs = [
        TableSpec("nation"),
        TableSpec("orders", "append", mark_col="o_orderdate", frequency="weekly"),
        TableSpec("missing"),
    ]

    def read(name: str) -> DataFrame:
        if name == "missing":
            raise FileNotFoundError(name)
        return fx.table(spark, sf, name)

    initial_load(spark, specs, read, root, audit=audit)
    return audit.state().select(
        "table", "strategy", "frequency", "rows", "status", F.col("error_message").isNotNull().alias("has_message")
    )


@_query
def run_frequency(spark: SparkSession, sf: str) -> DataFrame:
    """A weekly run loads the weekly table only."""
    specs = [TableSpec("customer"), TableSpec("supplier", frequency="weekly")]
    read, root = lambda name: fx.table(spark, sf, name), _root(spark)
    _done(initial_load(spark, specs, read, root, run_ts=_at(fx.PREV_TS)))
    _done(incremental_load(spark, specs, read, root, frequency="weekly", run_ts=_at(fx.RUN_TS)))
    keys = {"customer": "c_custkey", "supplier": "s_suppkey"}
    one, two = (
        RawTable(spark, root, t).read().select(F.lit(t).alias("table"), F.col(k).alias("k"), "_ingested_at") for t, k in keys.items()
    )
    return one.unionByName(two)
