"""Run drivers: initial load (R1) and incremental load (R2).

The drivers only say what runs after what; every table's work is Spark jobs: a
mark read (file statistics, then one day's rows), then one write, or a staging
write plus an overwrite of the partitions it touches. Tables load side by side,
each in a scheduler pool of its own; line tables wait for the header they
follow. A table that fails is logged, and only those that wait for it fail with
it; the result lists every failure.
"""

from __future__ import annotations

import time
import traceback
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.marks import Mark, mark_from_top, top_value
from tidewater.functions.predicates import mark_sql
from tidewater.functions.typemap import cast_columns
from tidewater.operators import (
    HeaderRef,
    LoadPlan,
    append_composite,
    append_day,
    capture_header_marks,
    daily_snapshot,
    full_reload,
    initial_full,
    load_window_by_header,
    load_windows,
    make_windows,
    replace_by_header,
    scan_projected,
    upsert,
)
from tidewater.operators.upsert import merge_into
from tidewater.operators.windows import Window
from tidewater.plans.settings import APPEND, BY_HEADER, FULL_RELOAD, SNAPSHOT, UPSERT, TableSpec
from tidewater.sources.audit_log import AuditLog
from tidewater.sources.readers import window_predicates
from tidewater.sources.layout import DAY_COL
from tidewater.sources.names import ensure_schema
from tidewater.sources.sink import RawTable

SourceReader = Callable[[str], DataFrame]
PARALLEL_TABLES = 4  # tables that load at the same time, unless the caller says otherwise


@dataclass
class RunResult:
    """Outcome of one run: rows and seconds per table, and failures by table."""

    run_id: str
    started_at: datetime
    finished_at: datetime | None = None
    rows: dict[str, int] = field(default_factory=dict)
    failures: dict[str, str] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)
    windows: dict[str, dict[int, int]] = field(default_factory=dict)  # A2 per window

    @property
    def ok(self) -> bool:
        return not self.failures


def by_frequency(specs: Iterable[TableSpec], frequency: str | None) -> list[TableSpec]:
    """F8: keep tables of one frequency; ``None`` keeps all."""
    return [s for s in specs if frequency is None or s.frequency == frequency]


def newest_values(table: RawTable, col: str) -> DataFrame:
    """``max(col)`` of a raw table, answered from the footers of its files.

    Spark's V2 Parquet reader pushes the aggregate down (``PushedAggregation``),
    so no row is read; in a table partitioned by ``col`` only the newest period's
    footers are. Types without usable statistics (text, timestamps) are scanned.
    """
    lay = table.layout
    periods = [p for p in table.partitions() if p is not None] if lay.kind == "day" and lay.day_col.upper() == col.upper() else []
    return table.by_footers(periods[-1] if periods else None).agg(F.max(col).alias("d"))


def read_mark(table: RawTable, date_col: str, time_col: str | None) -> Mark:
    """The newest day from file statistics, then the newest time of that day, whose filter skips all other row groups."""
    day = newest_values(table, date_col).first()["d"]
    if day is None or time_col is None:
        return mark_from_top(None if day is None else (day, None), time_col is not None)
    kind = table.schema[next(n for n in table.schema.names if n.upper() == date_col.upper())].dataType
    on_day = F.col(date_col) == F.lit(str(day)).cast(kind) if isinstance(kind, (T.DateType, T.StringType)) else F.col(date_col).isNotNull()
    rows, lay = table.read(with_partition=True), table.layout
    if isinstance(kind, T.DateType) and lay.kind == "day" and lay.day_col.upper() == date_col.upper():
        rows = rows.where(F.col(DAY_COL) == F.lit(lay.period(day)))
    return mark_from_top(top_value(rows.where(on_day), date_col, time_col), True)


def _source(spec: TableSpec, read_source: SourceReader) -> DataFrame:
    """S1 + S7/S8: configured columns in configured order, cast by the type map."""
    return _typed_source(spec, read_source(spec.name), read_source)


def _typed_source(spec: TableSpec, raw_source: DataFrame, read_source: SourceReader) -> DataFrame:
    """The spec's own column metadata decides the types, else what the reader's
    ``columns_of(name)`` tells; without either the source's types stay."""
    df = scan_projected(raw_source, list(spec.columns))
    metadata = list(spec.metadata)
    if not metadata and hasattr(read_source, "columns_of"):
        metadata = list(read_source.columns_of(spec.name))
    return cast_columns(df, metadata) if metadata else df


def incremental_plan(
    spec: TableSpec, table: RawTable, source: DataFrame, read_source: SourceReader,
    run_ts: datetime, header_marks: dict,
) -> LoadPlan:
    """R2 dispatch for one table."""
    raw = table.read()
    if spec.strategy == APPEND:
        if spec.mark_time_col:
            mark = read_mark(table, spec.mark_col, spec.mark_time_col)
            return append_composite(raw, source, spec.mark_col, spec.mark_time_col, run_ts, mark=mark)
        mark = read_mark(table, spec.local_mark, None)
        return append_day(raw, source, spec.mark_col, run_ts, local_col=spec.local_mark,
                          idempotent=spec.idempotent, mark=mark)
    if spec.strategy == UPSERT:
        mark = read_mark(table, spec.mark_col, spec.mark_time_col)
        return upsert(raw, source, list(spec.keys), spec.mark_col, run_ts, time_col=spec.mark_time_col, mark=mark)
    if spec.strategy == BY_HEADER:
        ref = HeaderRef(spec.header_table, spec.header_mark_col, spec.header_mark_time_col)
        mark = header_marks.get(ref)
        if isinstance(mark, Exception):
            raise RuntimeError(f"header mark of {spec.header_table} could not be read") from mark
        if mark is None:
            raise RuntimeError(f"header mark of {spec.header_table} was not captured before the run")
        headers = read_source(spec.header_table)
        where = mark_sql(mark, spec.header_mark_col, spec.header_mark_time_col,
                         quote=getattr(read_source, "quote", '"'))
        if where is not None and hasattr(read_source, "lines_in"):
            # the source evaluates the semi-join itself; the plan's own semi-join stays for exactness
            source = _lines_in(spec, read_source, where)
        return replace_by_header(
            raw, source, headers, mark, doc_key=spec.doc_key, header_date_col=spec.header_mark_col,
            run_ts=run_ts, header_key=spec.header_key, header_time_col=spec.header_mark_time_col,
            delete_from=spec.delete_from,
        )
    if spec.strategy == SNAPSHOT:
        return daily_snapshot(raw, source, run_ts)
    return full_reload(raw, source, run_ts)


def _lines_in(spec: TableSpec, read_source: SourceReader, where: str) -> DataFrame:
    """The lines of the headers that satisfy ``where``, selected by the source itself."""
    key = spec.header_key or spec.doc_key
    return _typed_source(spec, read_source.lines_in(spec.name, spec.doc_key, spec.header_table, key, where), read_source)


def incremental_load(
    spark: SparkSession,
    specs: Iterable[TableSpec],
    read_source: SourceReader,
    root: str,
    audit: AuditLog | None = None,
    frequency: str | None = None,
    run_ts: datetime | None = None,
    header_marks: dict | None = None,
    parallel: int = PARALLEL_TABLES,
) -> RunResult:
    """R2: frequency filter, header marks captured first (P1), then the tables,
    ``parallel`` at a time: evolve schema, log start, load, log result.

    ``header_marks`` lets the caller supply a line table's header mark (for
    example the one its last successful load used), so header changes made
    while a line load failed or ran less often are not skipped (trap 13).
    """
    run_ts = run_ts or datetime.now()
    selected = by_frequency(specs, frequency)
    layouts = {s.name: s.layout() for s in selected}
    result = RunResult(str(uuid.uuid4()), run_ts)
    refs = [
        HeaderRef(s.header_table, s.header_mark_col, s.header_mark_time_col)
        for s in selected if s.strategy == BY_HEADER
    ]
    supplied = dict(header_marks or {})
    header_marks = capture_header_marks(
        [r for r in refs if r not in supplied],
        mark_of=lambda ref: read_mark(_existing(RawTable(spark, root, ref.table), layouts.get(ref.table)), ref.date_col, ref.time_col),
    )
    header_marks.update(supplied)
    _run_all(spark, selected, audit, result, parallel, lambda spec: _run_one(
        spark, spec, root, audit, result, read_source, create=False,
        make_plan=lambda t, s: incremental_plan(spec, t, s, read_source, run_ts, header_marks),
    ))
    return result


def _existing(table: RawTable, layout=None) -> RawTable:
    if not (table.exists() or layout is not None and table.adopt(layout)):
        raise FileNotFoundError(f"raw table {table.name} does not exist; run the initial load first")
    return table


def _run_all(spark, specs: list[TableSpec], audit, result: RunResult, parallel: int, load: Callable[[TableSpec], None]) -> None:
    """Load every table, ``parallel`` at a time; a line table after the header it follows, if that loads in this run.

    Headers are handed out first, so a waiting table never holds the thread
    that its header needs.
    """
    names = {s.name for s in specs}
    waits = {s.name: s.header_table for s in specs if s.strategy == BY_HEADER and s.header_table in names - {s.name}}
    done: dict[str, Future] = {}

    def run(spec: TableSpec) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"tidewater-{spec.name}")
        header = waits.get(spec.name)
        if header is not None:
            done[header].result()
            if header in result.failures:
                result.failures[spec.name] = f"{header}, which it follows, failed"
                if audit:
                    audit.error(result.run_id, spec.name, spec.strategy, spec.frequency, message=result.failures[spec.name])
                return
        load(spec)

    with ThreadPoolExecutor(max(1, parallel)) as pool:
        for spec in sorted(specs, key=lambda s: s.name in waits):
            done[spec.name] = pool.submit(inheritable_thread_target(spark)(run), spec)
    for f in done.values():
        f.result()
    for part in (result.rows, result.failures, result.seconds, result.windows):  # in the order of the settings
        ordered = {s.name: part[s.name] for s in specs if s.name in part}
        part.clear()
        part.update(ordered)
    result.finished_at = datetime.now()


def initial_plan(
    spec: TableSpec, table: RawTable, source: DataFrame, read_source: SourceReader,
    run_ts: datetime, today: date,
):
    """R1 choice for one table: windows on the table's own mark, windows on the
    header's mark, else a whole load whose re-run rule follows the strategy."""
    ini = spec.initial
    raw = table.read()
    if ini.start and ini.months and (spec.mark_col or (spec.header_table and spec.header_mark_col)):
        wins = make_windows(ini.start, ini.end or today, ini.months)
        # a bucketed table is rewritten whole by each publish, so it takes all windows at once
        step = max(len(wins), 1) if table.layout.kind == "bucket" else ini.windows_per_job or max(len(wins), 1)
        slices = [wins[i:i + step] for i in range(0, len(wins), step)]

        def plans():  # built one at a time, each after the previous slice is published
            for part in slices:
                if spec.mark_col:
                    src = source
                    if hasattr(read_source, "read_windows"):  # one source task per window
                        src = _typed_source(spec, read_source.read_windows(spec.name, spec.mark_col, part), read_source)
                    yield load_windows(table.read(), src, spec.mark_col, part, ini.months, run_ts)
                else:
                    src = source
                    if hasattr(read_source, "lines_in"):  # the windows' headers select the lines at the source
                        where = window_predicates(spec.header_mark_col, [Window(0, part[0].start, part[-1].end)],
                                                  getattr(read_source, "quote", '"'))[0]
                        src = _lines_in(spec, read_source, where)
                    yield load_window_by_header(
                        table.read(), src, read_source(spec.header_table), spec.doc_key,
                        spec.header_mark_col, part, ini.months, run_ts, header_key=spec.header_key, stage=table.staged,
                    )

        return plans()
    if spec.strategy == FULL_RELOAD:
        return full_reload(raw, source, run_ts)
    if spec.strategy == UPSERT:
        return upsert(raw, source, list(spec.keys), spec.mark_col, run_ts, time_col=spec.mark_time_col,
                      mark=Mark.none(bool(spec.mark_time_col)))
    if spec.strategy == SNAPSHOT:
        return daily_snapshot(raw, source, run_ts)
    if spec.strategy == BY_HEADER:
        return replace_by_header(
            raw, source, read_source(spec.header_table), Mark.none(), doc_key=spec.doc_key,
            header_date_col=spec.header_mark_col, run_ts=run_ts, header_key=spec.header_key,
        )
    return initial_full(raw, source, run_ts, raw_is_empty=raw.isEmpty())


def initial_load(
    spark: SparkSession,
    specs: Iterable[TableSpec],
    read_source: SourceReader,
    root: str,
    audit: AuditLog | None = None,
    run_ts: datetime | None = None,
    today: date | None = None,
    parallel: int = PARALLEL_TABLES,
) -> RunResult:
    """The tables, ``parallel`` at a time: create if missing, evolve, log start, load, log result."""
    run_ts = run_ts or datetime.now()
    today = today or run_ts.date()
    ensure_schema(spark, root)
    result = RunResult(str(uuid.uuid4()), run_ts)
    _run_all(spark, list(specs), audit, result, parallel, lambda spec: _run_one(
        spark, spec, root, audit, result, read_source, create=True,
        make_plan=lambda t, s: initial_plan(spec, t, s, read_source, run_ts, today),
    ))
    return result


def _run_one(spark, spec, root, audit, result, read_source, create: bool, make_plan) -> None:
    if spec.merge_table:
        return _merge_one(spark, spec, audit, result, result.started_at, read_source)
    table = RawTable(spark, root, spec.name)
    args = (result.run_id, spec.name, spec.strategy, spec.frequency)
    t0 = time.perf_counter()
    try:
        source = _source(spec, read_source)
        if create:
            table.create_if_missing(source.schema, spec.layout())
        else:
            _existing(table, spec.layout())
        table.add_missing_columns(source.schema)
        if audit:
            audit.start(*args)
        planned = make_plan(table, source)
        rows, windows = 0, {}
        for plan in [planned] if isinstance(planned, LoadPlan) else planned:
            rows += table.publish(plan)
            windows |= table.window_rows
        result.rows[spec.name] = rows
        if windows:  # A2 of a history load
            result.windows[spec.name] = windows
        if audit:
            audit.success(*args, rows=result.rows[spec.name])
    except Exception as exc:  # noqa: BLE001 - one table's failure must not stop the run
        result.failures[spec.name] = f"{type(exc).__name__}: {exc}"
        if audit:
            audit.error(*args, message=traceback.format_exc())
    finally:
        result.seconds[spec.name] = round(time.perf_counter() - t0, 3)


def _merge_one(spark, spec, audit, result, run_ts, read_source) -> None:
    """An upsert by the table format's own MERGE: the mark is read from the table, the batch merged into it."""
    args = (result.run_id, spec.name, spec.strategy, spec.frequency)
    try:
        raw = spark.table(spec.merge_table)
        if audit:
            audit.start(*args)
        plan = upsert(raw, _source(spec, read_source), list(spec.keys), spec.mark_col, run_ts, time_col=spec.mark_time_col)
        rows = Observation()
        merge_into(plan.batch.observe(rows, F.count(F.lit(1)).alias("rows")), spec.merge_table, list(spec.keys)).merge()
        result.rows[spec.name] = int(rows.get["rows"])
        if audit:
            audit.success(*args, rows=result.rows[spec.name])
    except Exception as exc:  # noqa: BLE001 - one table's failure must not stop the run
        result.failures[spec.name] = f"{type(exc).__name__}: {exc}"
        if audit:
            audit.error(*args, message=traceback.format_exc())
