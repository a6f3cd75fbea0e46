"""Load strategies as pure plans, on literal frames (FIXTURES.md edge cases)."""

import random
from datetime import date

from pyspark.sql import functions as F

from tidewater.functions import Mark
from tidewater.operators import (
    HeaderRef,
    append_composite,
    append_day,
    capture_header_marks,
    daily_snapshot,
    evolve_schema,
    full_reload,
    replace_by_header,
    upsert,
)

D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)
T0 = "2024-01-01 00:00:00"
ROW = "k int, d date, t int, v string, _ingested_at timestamp_ntz"
SRC = "k int, d date, t int, v string"


def _rows(df, cols=("k", "d", "t", "v")):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_composite_append_twice_adds_nothing(spark):
    raw = spark.createDataFrame([(1, D1, 5, "a", None)], ROW)
    src = spark.createDataFrame([(1, D1, 5, "a"), (2, D1, 6, "b"), (3, D2, 0, "c")], SRC)
    once = append_composite(raw, src, "d", "t", "2024-01-02 00:00:00").result()
    twice = append_composite(once, src, "d", "t", "2024-01-02 01:00:00").result()
    assert once.count() == 3 and twice.count() == 3


def test_day_append_duplicates_boundary_but_idempotent_does_not(spark):
    raw = spark.createDataFrame([(1, D1, 5, "a", None), (9, None, 1, "n", None)], ROW)
    src = spark.createDataFrame([(1, D1, 5, "a"), (2, D2, 6, "b")], SRC)
    plain = append_day(raw, src, "d", "2024-01-02 00:00:00").result()
    assert plain.count() == 4  # day D1 read again
    idem = append_day(raw, src, "d", "2024-01-02 00:00:00", idempotent=True).result()
    assert _rows(idem) == sorted([(1, D1, 5, "a"), (2, D2, 6, "b"), (9, None, 1, "n")], key=repr)
    again = append_day(idem, src, "d", "2024-01-02 00:00:00", idempotent=True).result()
    assert _rows(again) == _rows(idem)


def test_upsert_one_row_per_key_newest_wins_null_keys_kept(spark):
    raw = spark.createDataFrame([(1, D1, 1, "old", None), (None, D1, 1, "nk-old", None), (2, D1, 1, "x", None)], ROW)
    src = spark.createDataFrame(
        [(1, D2, 1, "mid"), (1, D3, 1, "new"), (1, D3, 1, "newer"), (None, D2, 1, "nk-new"), (3, D2, 0, "c")], SRC
    )
    out = upsert(raw, src, ["k"], "d", "2024-01-04 00:00:00", time_col="t").result()
    got = _rows(out)
    assert (1, D3, 1, "newer") in got and not any(r[0] == 1 and r[3] != "newer" for r in got)
    assert sum(1 for r in got if r[0] is None) == 2  # NULL keys never match
    assert (2, D1, 1, "x") in got and (3, D2, 0, "c") in got


LINE = "doc int, ln int, v string, _ingested_at timestamp_ntz"
LSRC = "doc int, ln int, v string"
HDR = "doc int, d date, t int"


def test_header_replace_cases(spark):
    raw = spark.createDataFrame(
        [(1, 1, "a", None), (1, 2, "b", None), (2, 1, "c", None), (3, 1, "d", None), (3, 2, "e", None)], LINE
    )
    headers = spark.createDataFrame([(1, D2, 1), (2, D2, 1), (3, D1, 0)], HDR)
    # doc 1 changed, line 2 removed; doc 2 changed, all lines removed; doc 3 unchanged
    src = spark.createDataFrame([(1, 1, "a2"), (3, 1, "d"), (3, 2, "e")], LSRC)
    mark = Mark(D1, 5, True)
    plan = replace_by_header(raw, src, headers, mark, "doc", "d", "2024-01-03 00:00:00", header_time_col="t")
    got = sorted((r.doc, r.ln, r.v) for r in plan.result().collect())
    assert got == [(1, 1, "a2"), (2, 1, "c"), (3, 1, "d"), (3, 2, "e")]  # doc 2's old lines stay
    plan_h = replace_by_header(
        raw, src, headers, mark, "doc", "d", "2024-01-03 00:00:00", header_time_col="t", delete_from="headers"
    )
    got_h = sorted((r.doc, r.ln, r.v) for r in plan_h.result().collect())
    assert got_h == [(1, 1, "a2"), (3, 1, "d"), (3, 2, "e")]


def test_empty_header_raw_loads_every_line(spark):
    raw = spark.createDataFrame([], LINE)
    headers = spark.createDataFrame([(1, D2, 1)], HDR)
    src = spark.createDataFrame([(1, 1, "a"), (7, 1, "orphan")], LSRC)
    out = replace_by_header(raw, src, headers, Mark.none(True), "doc", "d", "2024-01-03 00:00:00", header_time_col="t")
    assert out.result().count() == 2


def test_capture_marks_per_header_and_columns(spark):
    hdr = spark.createDataFrame([(1, D2, 7)], HDR)
    empty = spark.createDataFrame([], HDR)
    tables = {"H": hdr, "E": empty}

    def read(ref):
        return tables[ref.table]

    refs = [HeaderRef("H", "d", "t"), HeaderRef("H", "d"), HeaderRef("E", "d", "t"), HeaderRef("X", "d")]
    marks = capture_header_marks(refs, read)
    assert marks[HeaderRef("H", "d", "t")] == Mark(D2, 7, True)
    assert marks[HeaderRef("H", "d")] == Mark(D2)
    assert marks[HeaderRef("E", "d", "t")].empty
    assert isinstance(marks[HeaderRef("X", "d")], Exception)


def test_snapshot_same_day_replaces_next_day_adds_empty_source_clears_today(spark):
    schema = "k int, v double"
    src = spark.createDataFrame([(1, 1.0), (2, 2.0)], schema)
    empty_raw = spark.createDataFrame([], schema + ", _ingested_at timestamp_ntz")
    r1 = daily_snapshot(empty_raw, src, "2024-01-01 10:00:00").result()
    r1b = daily_snapshot(r1, src, "2024-01-01 23:00:00").result()
    assert r1b.count() == 2
    r2 = daily_snapshot(r1b, src, "2024-01-02 01:00:00").result()
    assert r2.count() == 4
    r2e = daily_snapshot(r2, src.limit(0), "2024-01-02 09:00:00").result()
    assert r2e.count() == 2


def test_full_reload_is_the_source(spark):
    src = spark.createDataFrame([(1, "a")], "k int, v string")
    raw = spark.createDataFrame([(5, "z", None)], "k int, v string, _ingested_at timestamp_ntz")
    assert [(r.k, r.v) for r in full_reload(raw, src, T0).result().collect()] == [(1, "a")]


def test_evolve_adds_once_case_insensitively(spark):
    raw = spark.createDataFrame([(1, "a")], "Id int, Name string")
    src = spark.createDataFrame([(1, "a", 2.0, 3)], "ID int, NAME string, Price double, price2 int")
    grown = evolve_schema(raw, src.schema)
    assert grown.columns == ["Id", "Name", "Price", "price2"]
    assert grown.collect()[0].Price is None


def test_id_ranges_hold_every_id_and_leave_out_the_widest_gaps(spark):
    from tidewater.operators.header import id_ranges

    rng = random.Random(3)
    for ids in ([5], [5, 6], [-(2**62), 0, 2**62], [1, *range(10**6, 10**6 + 500)], [rng.randrange(10**9) for _ in range(300)], [None, 3, None, 9_000]):
        df = spark.createDataFrame([(i,) for i in ids], "k long")
        for most in (1, 2, 16):
            got = id_ranges(df, "k", most=most)
            assert 1 <= len(got) <= most and got == sorted(got)
            assert all(sum(a <= i <= b for a, b in got) == 1 for i in ids if i is not None)
    df = spark.createDataFrame([(7,), *((i,) for i in range(900_000, 900_100))], "k long")
    assert id_ranges(df, "k") == [(7, 7), (900_000, 900_099)]
    assert id_ranges(df.where("k < 0"), "k") == []
    assert id_ranges(spark.createDataFrame([("b",), ("a",)], "k string"), "k") == [("a", "b")]


def test_a_late_change_to_an_old_document_does_not_widen_the_scan(spark, scratch):
    """One old and many new documents change; the row groups between are not read."""
    n = 40_000
    lines = spark.range(0, n, 1, 1).select(F.col("id").alias("doc"), (F.col("id") * 3).alias("v"))
    lines.write.option("parquet.block.size", 16 * 1024).option("parquet.page.size", 4 * 1024).parquet(f"{scratch}/lines")
    source = spark.read.parquet(f"{scratch}/lines")
    headers = spark.range(n).select(
        F.col("id").alias("doc"),
        F.when((F.col("id") == 3) | (F.col("id") >= n - 1000), F.lit("2024-02-01")).otherwise(F.lit("2023-01-01")).cast("date").alias("d"),
    )
    headers.write.parquet(f"{scratch}/headers")
    raw = source.withColumn("_ingested_at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    got = {}
    for prefilter in (True, False):
        plan = replace_by_header(raw, source, spark.read.parquet(f"{scratch}/headers"), Mark(date(2024, 1, 1)), "doc", "d",
                                 "2024-02-02 00:00:00", id_range_prefilter=prefilter)
        rows = sorted(map(tuple, plan.batch.select("doc", "v").collect()))
        tree = plan.batch._jdf.queryExecution().executedPlan().toString()
        got[prefilter] = rows
        assert ("GreaterThanOrEqual(doc,39000)" in tree and "LessThanOrEqual(doc,3)" in tree) == prefilter, tree
    assert got[True] == got[False] and len(got[True]) == 1001
    scanned = source.where("doc between 3 and 3 or doc between 39000 and 39999")
    assert len(scanned.collect()) == 1001
    leaf = scanned._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert leaf.metrics().apply("numOutputRows").value() < n / 2  # row groups between the ranges were skipped
