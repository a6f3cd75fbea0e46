"""Sink and run drivers end to end: initial load, incremental runs, audit.

Properties from the reference's documented promises: composite append twice
adds nothing; upsert leaves one row per key; header lines use the pre-run
header mark; snapshot replaces within a day and adds across days; full reload
equals the source; window loads re-run to the same table; the schema only
grows; a failing table does not stop the run.
"""

from datetime import date, datetime

from pyspark.sql import functions as F

from tidewater.operators import replace_by_header
from tidewater.functions import read_composite_mark
from tidewater.plans import fixtures as fx
from tidewater.plans.runs import incremental_load, initial_load
from tidewater.plans.settings import InitialLoad, TableSpec, spec_from_mapping
from tidewater.sources.audit_log import AuditLog
from tidewater.sources.sink import RawTable

SF = "/root/testdata/sf0.001"
HDR_COLS = ["docentry", "cardcode", "doctotal", "updatedate", "updatets"]
LINE_COLS = ["docentry", "linenum", "itemcode", "quantity", "linetotal"]


def _specs():
    return [
        TableSpec("hdr", "append", keys=("docentry",), mark_col="updatedate", mark_time_col="updatets",
                  initial=InitialLoad(date(1995, 1, 1), date(2001, 12, 31), 12)),
        TableSpec("lines", "replace_by_header", header_table="hdr", header_mark_col="updatedate",
                  header_mark_time_col="updatets", doc_key="docentry",
                  initial=InitialLoad(date(1995, 1, 1), date(2001, 12, 31), 12), buckets=8),
        TableSpec("cust", "upsert", keys=("c_custkey",), mark_col="upd", buckets=8),
        TableSpec("nat", "full_reload"),
        TableSpec("sup", "daily_snapshot", frequency="daily"),
    ]


def _sources(spark, version):
    cust = fx.table(spark, SF, "customer").withColumn(
        "upd", F.when(F.col("c_custkey") % 2 == 0, F.lit(date(2023, 12, 1))).otherwise(F.lit(date(2024, 1, 1)))
    )
    if version == 1:
        hdr, lines = fx.header_raw(spark, SF).drop("_ingested_at"), fx.lines_raw(spark, SF).drop("_ingested_at")
    else:
        hdr, lines = fx.header_source(spark, SF), fx.lines_source(spark, SF)
        cust = cust.withColumn("upd", F.when(F.col("c_custkey") % 5 == 0, F.lit(date(2024, 2, 1))).otherwise(F.col("upd")))
        cust = cust.withColumn("c_acctbal", F.col("c_acctbal") + 1).withColumn("c_note", F.lit("v2"))
    return {
        "hdr": hdr, "lines": lines, "cust": cust,
        "nat": fx.table(spark, SF, "nation"), "sup": fx.table(spark, SF, "supplier"),
    }


def _bag(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_initial_then_incremental(spark, scratch):
    root = f"{scratch}/raw"
    audit = AuditLog(spark, f"{scratch}/audit")
    specs = _specs()
    v1 = _sources(spark, 1)
    r1 = initial_load(spark, specs, v1.__getitem__, root, audit=audit, run_ts=datetime(2024, 1, 1, 8))
    assert r1.ok, r1.failures
    t = {s.name: RawTable(spark, root, s.name) for s in specs}
    assert t["hdr"].read().count() == v1["hdr"].count()
    assert t["lines"].read().count() == v1["lines"].count()
    # window loads re-run to the same table
    r1b = initial_load(spark, specs[:2], v1.__getitem__, root, run_ts=datetime(2024, 1, 1, 9))
    assert r1b.ok and t["hdr"].read().count() == v1["hdr"].count()
    assert t["lines"].read().count() == v1["lines"].count()

    # the expected line table: pure plan over the pre-run state
    v2 = _sources(spark, 2)
    pre_mark = read_composite_mark(t["hdr"].read(), "updatedate", "updatets")
    want_lines = _bag(
        replace_by_header(t["lines"].read(), v2["lines"], v2["hdr"], pre_mark, "docentry", "updatedate",
                          "2024-01-02 06:00:00", header_time_col="updatets").result(), LINE_COLS)

    r2 = incremental_load(spark, specs, v2.__getitem__, root, audit=audit, run_ts=datetime(2024, 1, 2, 6))
    assert r2.ok, r2.failures
    assert _bag(t["lines"].read(), LINE_COLS) == want_lines  # lines used the pre-run header mark
    hdr_after = t["hdr"].read().count()
    assert hdr_after > v1["hdr"].count()
    cust = t["cust"].read()
    assert cust.count() == cust.select("c_custkey").distinct().count() == v2["cust"].count()
    assert "c_note" in cust.columns  # schema grew
    # day mark D = 2024-01-01 is inclusive: rows at or after D were replaced, older rows kept NULL
    assert cust.where("c_note is null").count() == cust.where("upd = date'2023-12-01'").count() > 0
    assert _bag(t["nat"].read(), ["n_nationkey", "n_name"]) == _bag(v2["nat"], ["n_nationkey", "n_name"])
    assert t["sup"].read().count() == 2 * v2["sup"].count()  # day 1 (initial) + day 2

    # no source change: composite append adds nothing, snapshot same day replaces
    r3 = incremental_load(spark, specs, v2.__getitem__, root, audit=audit, run_ts=datetime(2024, 1, 2, 18))
    assert r3.ok, r3.failures
    assert t["hdr"].read().count() == hdr_after
    assert t["sup"].read().count() == 2 * v2["sup"].count()
    assert _bag(t["lines"].read(), LINE_COLS) == want_lines

    before = sorted(map(tuple, audit.state().collect()))
    audit.compact(files=1)
    st = audit.state()
    assert sorted(map(tuple, st.collect())) == before
    assert st.count() == 3 * 5  # three audited runs (the window re-run was not audited)
    assert audit.history().count() == 3 and audit.errors().count() == 0
    assert audit.last_run().count() == 5
    # the monitoring queries as plain SQL over the views
    audit.create_views("mon")
    sql_last = spark.sql(
        "SELECT `table`, strategy, `rows`, unix_seconds(cast(ended_at as timestamp)) - "
        "unix_seconds(cast(started_at as timestamp)) AS seconds, status, started_at FROM mon_state "
        "WHERE run_id = (SELECT run_id FROM mon_state ORDER BY started_at DESC, run_id DESC LIMIT 1)"
    )
    assert sorted(map(tuple, sql_last.collect())) == sorted(map(tuple, audit.last_run().collect()))
    sql_hist = spark.sql(
        "SELECT run_id, MIN(started_at) AS started_at, MAX(ended_at) AS finished_at, "
        "CAST(SUM(`rows`) AS BIGINT) AS total_rows, COUNT(*) AS tables, "
        "CAST(SUM(CASE WHEN status = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS errors FROM mon_state GROUP BY run_id"
    )
    assert sorted(map(tuple, sql_hist.collect())) == sorted(map(tuple, audit.history().collect()))


def test_failing_table_is_isolated_and_logged(spark, scratch):
    root = f"{scratch}/raw"
    audit = AuditLog(spark, f"{scratch}/audit")
    v1 = _sources(spark, 1)

    def read(name):
        if name == "broken":
            raise RuntimeError("source unavailable")
        return v1[name]

    specs = [TableSpec("broken", "full_reload"), TableSpec("nat", "full_reload")]
    res = initial_load(spark, specs, read, root, audit=audit, run_ts=datetime(2024, 1, 1, 8))
    assert set(res.failures) == {"broken"} and res.rows["nat"] == 25
    err = audit.errors().collect()
    assert len(err) == 1 and err[0].table == "broken" and "source unavailable" in err[0].error_message
    # incremental into a table never created fails alone, header missing fails only its lines
    specs2 = specs + [TableSpec("lines", "replace_by_header", header_table="nohdr",
                                header_mark_col="updatedate", doc_key="docentry")]
    res2 = incremental_load(spark, specs2, read, root, audit=audit)
    assert set(res2.failures) == {"broken", "lines"} and res2.rows["nat"] == 25


def test_spec_validation():
    import pytest

    with pytest.raises(ValueError):
        spec_from_mapping("x", {"strategy": "nonsense"})
    with pytest.raises(ValueError):
        spec_from_mapping("x", {"strategy": "upsert", "mark_col": "d"})
    with pytest.raises(ValueError):
        spec_from_mapping("x", {"strategy": "append", "mark_col": "d", "initial": {"start": "2024-01-01", "months": 0}})
    s = spec_from_mapping("x", {})
    assert s.strategy == "full_reload" and s.frequency == "daily"


def test_emptied_partition_is_dropped(spark, scratch):
    from tidewater.operators import daily_snapshot

    root = f"{scratch}/raw"
    src = spark.createDataFrame([(1, 1.0)], "k int, v double")
    t = RawTable(spark, root, "snap")
    t.create_if_missing(src.schema, TableSpec("snap", "daily_snapshot").layout())
    t.publish(daily_snapshot(t.read(), src, "2024-01-01 10:00:00"))
    t.publish(daily_snapshot(t.read(), src, "2024-01-02 10:00:00"))
    assert t.read().count() == 2
    t.publish(daily_snapshot(t.read(), src.limit(0), "2024-01-02 11:00:00"))
    assert t.read().count() == 1  # today's partition emptied and removed


def test_metadata_types_the_source(spark, scratch):
    from tidewater.functions.typemap import SourceColumn

    spec = spec_from_mapping("nat", {
        "strategy": "full_reload", "columns": ["n_name", "N_NATIONKEY"],
        "metadata": [{"name": "n_nationkey", "type": "TINYINT", "position": 1},
                     {"name": "n_name", "type": "NVARCHAR", "length": 25, "position": 2}],
    })
    assert spec.metadata[0] == SourceColumn("n_nationkey", "TINYINT", None, None, 1)
    nat = spark.read.parquet(f"{SF}/nation.parquet")
    res = initial_load(spark, [spec], {"nat": nat}.__getitem__, f"{scratch}/raw")
    assert res.ok, res.failures
    t = RawTable(spark, f"{scratch}/raw", "nat")
    assert [f.name for f in t.schema.fields] == ["n_name", "n_nationkey", "_ingested_at"]  # configured order
    assert t.schema["n_nationkey"].dataType.simpleString() == "smallint"
    assert t.read().count() == 25


def test_mark_from_statistics_equals_a_scan(spark, scratch):
    from tidewater.functions.marks import mark_from_top, top_value
    from tidewater.plans.runs import newest_values, read_mark

    root = f"{scratch}/raw"
    specs = [
        TableSpec("hdr", "append", mark_col="updatedate", mark_time_col="updatets",
                  initial=InitialLoad(date(1995, 1, 1), date(2001, 12, 31), 12)),
        TableSpec("cust", "upsert", keys=("c_custkey",), mark_col="upd", mark_time_col="updts", buckets=4),
    ]
    cust = fx.table(spark, SF, "customer")
    v1 = {"hdr": fx.header_raw(spark, SF).drop("_ingested_at"),
          "cust": cust.withColumn("upd", F.lit(date(2024, 1, 1))).withColumn("updts", F.lit(None).cast("int"))}
    v2 = {"hdr": fx.header_source(spark, SF),
          "cust": v1["cust"].withColumn("updts", F.when(F.col("c_custkey") % 3 == 0, F.lit(5)))}
    v3 = {"hdr": v2["hdr"], "cust": v2["cust"].withColumn(
        "upd", F.when(F.col("c_custkey") % 4 == 0, F.lit(date(2024, 3, 1))).otherwise(F.col("upd")))}
    assert initial_load(spark, specs, v1.__getitem__, root, run_ts=datetime(2024, 1, 1)).ok
    for i, v in enumerate((v2, v2, v3), 2):
        res = incremental_load(spark, specs, v.__getitem__, root, run_ts=datetime(2024, 1, i))
        assert res.ok, res.failures
        for name, d, t in (("hdr", "updatedate", "updatets"), ("cust", "upd", "updts")):
            table = RawTable(spark, root, name)
            assert read_mark(table, d, t) == mark_from_top(top_value(table.read(), d, t), True), (i, name)
            assert read_mark(table, d, None) == mark_from_top(top_value(table.read(), d), False)
            plan = newest_values(table, d)._jdf.queryExecution().executedPlan().toString()
            assert f"PushedAggregation: [MAX({d})]" in plan, plan


def test_marks_without_statistics(spark, scratch):
    """Text and timestamp marks, also one written 20240105, and a mark that is no date."""
    import pytest

    from tidewater.plans.runs import read_mark

    rows = [("2024-01-04", datetime(2024, 1, 4, 9), 1), ("20240105", datetime(2024, 1, 5, 8), 2), (None, None, 9), ("2024-01-03", datetime(2024, 1, 5, 8), 7)]
    src = spark.createDataFrame(rows, "s string, ts timestamp_ntz, t int")
    table = RawTable(spark, f"{scratch}/raw", "odd")
    table.create_if_missing(src.schema)
    assert read_mark(table, "s", "t").empty and read_mark(table, "ts", None).empty
    from tidewater.operators import full_reload

    table.publish(full_reload(None, src, "2024-02-01 00:00:00"))
    assert (read_mark(table, "s", "t").day, read_mark(table, "s", "t").time) == (date(2024, 1, 5), 2)
    assert (read_mark(table, "ts", "t").day, read_mark(table, "ts", "t").time) == (date(2024, 1, 5), 7)
    table.publish(full_reload(None, src.withColumn("s", F.lit("soon")), "2024-02-01 00:00:00"))
    with pytest.raises(ValueError, match="not a date"):
        read_mark(table, "s", None)


def test_tables_load_side_by_side(spark, scratch):
    """Four tables of which two wait for each other finish only if they run at the same time; a line table waits for its header."""
    import threading

    meet, order = threading.Barrier(2, timeout=120), []
    hdr, lines = fx.header_raw(spark, SF).drop("_ingested_at"), fx.lines_raw(spark, SF).drop("_ingested_at")

    def read(name):
        order.append(name)
        if name in ("nation", "region"):
            meet.wait()
        if name == "bad":
            raise RuntimeError("no source")
        return {"hdr": hdr, "lines": lines, "badlines": lines}.get(name) or fx.table(spark, SF, name)

    lines_of = lambda name, header: TableSpec(
        name, "replace_by_header", header_table=header, header_mark_col="updatedate", doc_key="docentry", buckets=4)
    specs = [lines_of("lines", "hdr"), lines_of("badlines", "bad"), TableSpec("nation"), TableSpec("region"),
             TableSpec("hdr", "append", mark_col="updatedate"), TableSpec("bad", "append", mark_col="updatedate")]
    audit = AuditLog(spark, f"{scratch}/audit")
    res = initial_load(spark, specs, read, f"{scratch}/raw", audit=audit, run_ts=datetime(2024, 1, 1))
    assert set(res.failures) == {"bad", "badlines"} and "bad, which it follows" in res.failures["badlines"]
    assert list(res.rows) == ["lines", "nation", "region", "hdr"]  # in the order of the settings
    assert order.index("hdr") < order.index("lines")
    assert audit.failures == []
    states = {r.table: r.status for r in audit.state().collect()}
    assert states == {"lines": "success", "nation": "success", "region": "success", "hdr": "success", "bad": "error", "badlines": "error"}
    one = initial_load(spark, specs[2:5], fx_read(spark, hdr), f"{scratch}/one", run_ts=datetime(2024, 1, 1), parallel=1)
    assert one.ok and one.rows["hdr"] == res.rows["hdr"]


def fx_read(spark, hdr):
    return lambda name: hdr if name == "hdr" else fx.table(spark, SF, name)


def test_reference_vocabulary_settings():
    from tidewater.plans.settings import specs_from_yaml

    text = """
HDR:
  tipo: tabela
  estrategia: incremental_append
  chave_primaria: [DocEntry]
  coluna_watermark: UpdateDate
  coluna_watermark_ts: UpdateTS
  coluna_watermark_local: _ingestao_em
  carga_inicial: {inicio: "2023-01-01", fim: null, janela_meses: 3}
  colunas: [DocEntry, UpdateDate, UpdateTS]
LIN:
  estrategia: incremental_via_cabecalho
  chave_primaria: [DocEntry, LineNum]
  tabela_cabecalho: HDR
  coluna_watermark_cabecalho: UpdateDate
  coluna_watermark_cabecalho_ts: UpdateTS
STK:
  estrategia: snapshot_diario
  frequencia: semanal
REF:
  chave_primaria: [ID]
"""
    hdr, lin, stk, ref = specs_from_yaml(text)
    assert (hdr.strategy, hdr.mark_col, hdr.mark_time_col, hdr.local_mark_col) == (
        "append", "UpdateDate", "UpdateTS", "_ingested_at")
    assert hdr.initial.start == date(2023, 1, 1) and hdr.initial.months == 3 and hdr.columns[0] == "DocEntry"
    assert (lin.strategy, lin.doc_key, lin.header_table, lin.header_mark_time_col) == (
        "replace_by_header", "DocEntry", "HDR", "UpdateTS")
    assert (stk.strategy, stk.frequency) == ("daily_snapshot", "weekly")
    assert ref.strategy == "full_reload" and ref.frequency == "daily"
    import pytest

    with pytest.raises(ValueError):
        specs_from_yaml("X:\n  estrategia: mystery\n")


def test_window_slices_give_the_same_table(spark, scratch):
    v1 = {"hdr": fx.header_raw(spark, SF).drop("_ingested_at")}
    out = []
    for label, per_job in (("one", None), ("sliced", 5)):
        spec = TableSpec("hdr", "append", mark_col="updatedate", mark_time_col="updatets",
                         initial=InitialLoad(date(1995, 1, 1), date(2001, 12, 31), 3, per_job))
        res = initial_load(spark, [spec], v1.__getitem__, f"{scratch}/{label}", run_ts=datetime(2024, 1, 1))
        assert res.ok, res.failures
        out.append((res.rows["hdr"], _bag(RawTable(spark, f"{scratch}/{label}", "hdr").read(), HDR_COLS)))
        per_window = res.windows["hdr"]  # A2 per window, observed during the writes
        assert sorted(per_window) == list(range(1, 29)) and sum(per_window.values()) == res.rows["hdr"]
    assert out[0] == out[1] and out[0][0] == v1["hdr"].count()


def test_cli_runs_with_reference_settings(spark, scratch, capsys):
    import os

    from tidewater.plans.cli import main

    src = f"{scratch}/src"
    os.makedirs(src)
    spark.read.parquet(f"{SF}/nation.parquet").write.parquet(f"{src}/nat.parquet")
    settings = f"{scratch}/tables.yaml"
    with open(settings, "w") as f:
        f.write("nat:\n  estrategia: full_reload\n  frequencia: diaria\nmissing:\n  estrategia: full_reload\n")
    args = ["--settings", settings, "--parquet-source", src, "--root", f"{scratch}/raw"]
    assert main(["initial", *args], spark=spark) == 1  # "missing" has no source: reported, others loaded
    out = capsys.readouterr().out
    assert "1/2 tables loaded" in out and "missing" in out
    assert main(["incremental", *args, "--frequency", "weekly"], spark=spark) == 0  # nothing weekly
    assert RawTable(spark, f"{scratch}/raw", "nat").read().count() == 25


def test_truncated_table_has_no_mark(spark, scratch):
    from tidewater.plans.runs import read_mark

    v = {"hdr": fx.header_raw(spark, SF).drop("_ingested_at"), "nat": fx.table(spark, SF, "nation").withColumn("d", F.lit(date(2024, 1, 1)))}
    specs = [TableSpec("hdr", "append", mark_col="updatedate", mark_time_col="updatets"), TableSpec("nat")]
    root = f"{scratch}/raw"
    assert initial_load(spark, specs, v.__getitem__, root, run_ts=datetime(2024, 1, 1)).ok
    for name, d in (("hdr", "updatedate"), ("nat", "d")):
        t = RawTable(spark, root, name)
        assert not read_mark(t, d, None).empty
        t.truncate()
        assert t.read().count() == 0 and t.partitions() == []
        assert read_mark(RawTable(spark, root, name), d, None).empty


def test_merge_statement_is_built(spark, scratch):
    """Built only: no installed table format has a row-level MERGE."""
    import pytest

    from tidewater.operators.upsert import merge_into

    batch = spark.createDataFrame([(1, "a")], "k int, v string")
    assert hasattr(merge_into(batch, "lake.db.t", ["k"]), "merge")
    with pytest.raises(ValueError, match="merge_table"):
        TableSpec("t", "full_reload", merge_table="lake.db.t")
    spec = TableSpec("t", "upsert", keys=("k",), mark_col="d", merge_table="no_such_table")
    res = incremental_load(spark, [spec], lambda name: batch, f"{scratch}/raw")
    assert "no_such_table" in res.failures["t"]


def test_source_catalog_gives_the_types(spark, scratch):
    """A reader with columns_of types every table, also lines that the source selects."""
    from tidewater.functions.typemap import SourceColumn

    class Source:
        quote = '"'

        def __call__(self, name):
            return spark.read.parquet(f"{SF}/{name}.parquet")

        def columns_of(self, name):
            return [SourceColumn("n_nationkey", "SMALLINT", None, None, 1), SourceColumn("n_name", "NVARCHAR", 30, None, 2)]

    res = initial_load(spark, [TableSpec("nation")], Source(), f"{scratch}/raw", run_ts=datetime(2024, 1, 1))
    assert res.ok, res.failures
    assert RawTable(spark, f"{scratch}/raw", "nation").schema["n_nationkey"].dataType.simpleString() == "smallint"


def test_header_windows_are_selected_at_the_source(spark, scratch):
    asked = []
    hdr, lines = fx.header_raw(spark, SF).drop("_ingested_at"), fx.lines_raw(spark, SF).drop("_ingested_at")

    class Source:
        quote = '"'

        def __call__(self, name):
            return {"hdr": hdr, "lines": lines}[name]

        def lines_in(self, name, doc_key, header, header_key, where):
            asked.append((name, doc_key, header, header_key, where))
            return lines.join(hdr.where(where.replace('"', "`")).select(header_key).distinct(), doc_key, "left_semi")

    ini = InitialLoad(date(1995, 1, 1), date(2001, 12, 31), 12)
    spec = TableSpec("lines", "replace_by_header", header_table="hdr", header_mark_col="updatedate", doc_key="docentry",
                     initial=ini, buckets=4)
    res = initial_load(spark, [spec], Source(), f"{scratch}/raw", run_ts=datetime(2024, 1, 1))
    assert res.ok, res.failures
    assert [a[:4] for a in asked] == [("lines", "docentry", "hdr", "docentry")] and "1995-01-01" in asked[0][4]
    got = RawTable(spark, f"{scratch}/raw", "lines").read().count()
    assert sum(res.windows["lines"].values()) == res.rows["lines"] == got > 0
