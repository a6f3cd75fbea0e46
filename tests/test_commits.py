"""Publishes by Spark's own writer: what fails before the commit changes nothing, and a repeated load ends as an unbroken one."""

import os

import pytest
from pyspark.sql import functions as F

from tidewater.operators import append_composite, full_reload, load_windows, make_windows, upsert
from tidewater.operators.common import LoadPlan, stamp
from tidewater.sources.audit_log import AuditLog
from tidewater.sources.layout import Layout
from tidewater.sources.names import schema_name, table_name
from tidewater.sources.sink import RawTable

T1, T2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def _source(spark, n, day="2023-01-05"):
    return spark.range(n).select(
        F.col("id").alias("k"),
        F.date_add(F.lit(day).cast("date"), (F.col("id") % 90).cast("int")).alias("d"),
        (F.col("id") * 7 % 86400).cast("int").alias("t"),
    )


LOADS = {
    "append": (Layout("day", day_col="d", grain="month"), lambda raw, s, ts, m: append_composite(raw, s, "d", "t", ts, mark=m)),
    "upsert": (Layout("bucket", ["k"], 4), lambda raw, s, ts, m: upsert(raw, s, ["k"], "d", ts, time_col="t", mark=m)),
    "reload": (Layout(), lambda raw, s, ts, m: full_reload(raw, s, ts)),
    "windows": (
        Layout("day", day_col="d", grain="month"),
        lambda raw, s, ts, m: load_windows(raw, s, "d", make_windows("2023-01-01", "2023-04-30", 1), 1, ts),
    ),
}


def _load(table, kind, source, ts):
    from tidewater.plans.runs import read_mark

    mark = read_mark(table, "d", "t") if kind in ("append", "upsert") else None
    return table.publish(LOADS[kind][1](table.read(), source, ts, mark))


def _table(spark, root, kind):
    table = RawTable(spark, root, "x")
    table.create_if_missing(_source(spark, 1).schema, LOADS[kind][0])
    return table


def _rows(table):
    return sorted(tuple(r) for r in table.read().select("k", "d", "t", "_ingested_at").collect())


@pytest.mark.parametrize("kind", [k for k in LOADS if k != "reload"])
def test_a_failed_write_changes_nothing(spark, scratch, kind):
    """A task fails after others have written; the table stays, and the load run again ends as an unbroken one."""
    first, second = _source(spark, 200), _source(spark, 200).unionByName(_source(spark, 60, "2023-03-20").withColumn("k", F.col("k") + 150))
    broken = second.withColumn("t", F.when(F.col("k") == 170, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("t")))
    whole, table = _table(spark, f"{scratch}/whole", kind), _table(spark, f"{scratch}/cut", kind)
    for t in (whole, table):
        _load(t, kind, first, T1)
    _load(whole, kind, second, T2)
    before = _rows(table)
    with pytest.raises(Exception, match="lost"):
        _load(table, kind, broken, T2)
    assert _rows(table) == before
    again = RawTable(spark, f"{scratch}/cut", "x")
    _load(again, kind, second, T2)
    assert _rows(again) == _rows(whole)


def test_only_touched_partitions_are_written(spark, scratch):
    """Dynamic overwrite by the table's own option, also in a session that says otherwise."""
    table = _table(spark, scratch, "upsert")
    _load(table, "upsert", _source(spark, 200), T1)
    files = lambda: {p: sorted(os.listdir(f"{scratch}/x/{p}")) for p in os.listdir(f"{scratch}/x") if p.startswith("_bucket")}
    old, mode = files(), spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        one = _source(spark, 1).withColumn("d", F.date_add("d", 500))
        _load(table, "upsert", one, T2)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    new = files()
    assert sum(old[p] != new[p] for p in old) == 1 and table.read().count() == 200


def test_partitions_left_without_rows_go(spark, scratch):
    """Deletes without inserts, over buckets and periods; the period of rows without a day stays."""
    src = _source(spark, 40).unionByName(spark.createDataFrame([(99, None, 1)], "k long, d date, t int"))
    for kind in ("upsert", "windows"):
        table = _table(spark, f"{scratch}/{kind}", kind)
        table.publish(LoadPlan(kept=table.read(), batch=stamp(src, T1), kind="append"))
        parts = table.partitions()
        nothing = stamp(src.limit(0), T2)
        if kind == "upsert":
            table.publish(LoadPlan(kept=table.read(), batch=nothing, kind="keyed", delete_keys=["k"], delete_ids=src.select("k")))
            assert len(parts) == 4 and table.read().count() == 0
        else:
            table.publish(load_windows(table.read(), src.limit(0), "d", make_windows("2023-01-01", "2023-04-30", 1), 1, T2))
            assert None in parts and table.partitions() == [None] and table.read().count() == 1
            table.publish(full_reload(None, src.where("k < 3"), T2))
            assert table.partitions() == parts[1:2] and table.read().count() == 3
        assert RawTable(spark, f"{scratch}/{kind}", "x").by_footers().count() == table.read().count()


def test_tables_are_in_the_catalog(spark, scratch):
    """By the layer's own name, with columns added where the source grew; a layer named by a schema needs no folder."""
    name = "tidewater_" + os.path.basename(os.path.dirname(scratch + "/")).replace("-", "_")
    try:
        table = RawTable(spark, name, "Sales Lines")
        assert not table.exists()
        assert table.create_if_missing(_source(spark, 1).schema, Layout("bucket", ["k"], 2))
        assert not table.create_if_missing(_source(spark, 1).schema, Layout("bucket", ["k"], 7)) and table.layout.buckets == 2
        table.publish(LoadPlan(kept=table.read(), batch=stamp(_source(spark, 5), T1), kind="append"))
        grown = _source(spark, 9).withColumn("The Note", F.lit("n")).withColumnRenamed("t", "T")
        assert table.add_missing_columns(grown.schema) == ["The Note"] and table.add_missing_columns(grown.schema) == []
        table.publish(LoadPlan(kept=table.read(), batch=stamp(grown, T2), kind="keyed", delete_keys=["k"]))
        got = spark.sql(f"SELECT count(*) n, count(`The Note`) notes FROM {table.table}").first()
        assert (got.n, got.notes) == (9, 9)
        assert table.schema.names == ["k", "d", "t", "The Note", "_ingested_at"]
        assert [r.tableName for r in spark.sql(f"SHOW TABLES IN {name}").collect()] == [table_name("Sales Lines")]
        assert (table_name("OINV"), table_name("@A") != table_name("_A")) == ("oinv", True)
    finally:
        spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")


@pytest.mark.parametrize("kind", list(LOADS))
def test_a_folder_s_tables_are_found_again(spark, scratch, kind):
    """A catalog that forgot a layer (here: dropped entries over kept files) takes its tables up, and loads go on."""
    whole = _table(spark, f"{scratch}/whole", kind)
    _load(whole, kind, _source(spark, 90), T1)
    whole.spark.sql(f"DROP SCHEMA IF EXISTS {schema_name(f'{scratch}/again')} CASCADE")
    os.rename(f"{scratch}/whole", f"{scratch}/again")  # other folder, so no catalog entry
    table = RawTable(spark, f"{scratch}/again", "x")
    assert not table.exists() and not table.create_if_missing(_source(spark, 1).schema, LOADS[kind][0])
    assert table.read().count() == 90 and table.layout == LOADS[kind][0]
    _load(table, kind, _source(spark, 120, "2023-02-05"), T2)
    want = {"append": 90 + _source(spark, 120, "2023-02-05").where("d > date'2023-04-04' or d = date'2023-04-04' and t > 623").count()}
    assert table.read().count() == want.get(kind, table.read().select("k", "d").distinct().count())
    table.truncate()
    assert table.read().count() == 0 and table.partitions() == []


def test_first_loads_are_one_write(spark, scratch):
    """No staging into an empty table, and none for windows at all."""
    for kind in LOADS:
        table = _table(spark, f"{scratch}/{kind}", kind)
        staged = []
        real = table.staged
        table.staged = lambda *a, **k: staged.append(1) or real(*a, **k)  # noqa: B023
        _load(table, kind, _source(spark, 100), T1)
        assert staged == []
        _load(table, kind, _source(spark, 120), T2)
        assert bool(staged) == (kind == "upsert")


def test_log_takes_counts_beyond_32_bits(spark, scratch):
    audit = AuditLog(spark, f"{scratch}/audit")
    audit.start("r", "t", "append", "daily")
    audit.success("r", "t", "append", "daily", rows=3_000_000_000)
    assert audit.failures == [] and audit.last_run().first().rows == 3_000_000_000
    for q in (audit.last_run(), audit.history(), audit.summary()):
        assert "message" not in q._jdf.queryExecution().executedPlan().toString()


def test_scratch_folder_only_on_a_local_master(spark, monkeypatch):
    from types import SimpleNamespace

    from tidewater.session import ensure_checkpoint_dir

    context = SimpleNamespace(master="spark://host:7077", getConf=lambda: {}, getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=context))


def test_second_start_and_new_checkpoint_lose_no_file(spark, scratch):
    from tidewater.streaming.feed import stream_into

    nat = spark.read.parquet("/root/testdata/sf0.001/nation.parquet")
    table = RawTable(spark, f"{scratch}/raw", "nat")
    table.create_if_missing(nat.schema, Layout())

    def run(checkpoint=None):
        stream = spark.readStream.schema(nat.schema).parquet(f"{scratch}/in/*")
        stream_into(stream, table, "append", checkpoint=checkpoint).awaitTermination(300)

    nat.where("n_nationkey < 5").write.parquet(f"{scratch}/in/a")
    run()
    nat.where("n_nationkey between 5 and 9").write.parquet(f"{scratch}/in/b")
    run()  # the default checkpoint goes on: only the new file
    assert table.read().count() == 10
    run(f"{scratch}/other")  # a new checkpoint counts its epochs anew: all files again
    assert table.read().count() == 20
