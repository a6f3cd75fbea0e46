"""A key holding a third of all rows: results stay exact and AQE splits the
hot partition of the keyed delete instead of sending it to one task."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tidewater.operators import delete_by_key, newest_per_key

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2048",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _raw(spark, n=30000):
    # a third of the rows share key 0; the rest are distinct
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"),
    )


def test_hot_key_anti_join_is_split_and_exact(spark):
    raw = _raw(spark)
    batch = spark.range(0, 3000, 7).select(F.col("id").alias("k"))
    with conf(spark, SKEW_CONF):
        kept = delete_by_key(raw, batch, ["k"])
        got = len(kept.collect())
        plan = kept._jdf.queryExecution().executedPlan().toString()  # the final adaptive plan
    want = raw.join(batch, "k", "left_anti").count()
    assert got == want == raw.where("k % 7 <> 0 or k >= 3000").count()
    assert "skew=true" in plan, plan


def test_hot_key_dedupe_is_exact(spark):
    raw = _raw(spark).withColumn("d", (F.col("v") % 97).cast("int"))
    with conf(spark, SKEW_CONF):
        out = newest_per_key(raw, ["k"], ["d"])
        rows = out.count()
        hot = out.where("k = 0").collect()
    assert rows == raw.select("k").distinct().count()
    best = raw.where("k = 0").orderBy(F.col("d").desc(), F.col("v").desc()).first()
    assert len(hot) == 1 and (hot[0].d, hot[0].v) == (best.d, best.v)


def test_hot_period_is_written_by_several_tasks(spark, scratch):
    import os

    from tidewater.operators import append_composite
    from tidewater.plans.settings import TableSpec
    from tidewater.sources.sink import RawTable

    n = 60000
    src = spark.range(n).select(
        F.col("id").alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit("2024-01-15").cast("date"))
        .otherwise(F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 1000).cast("int")))
        .alias("d"),
        (F.col("id") % 86400).cast("int").alias("t"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"),
    )
    table = RawTable(spark, f"{scratch}/raw", "hot")
    table.create_if_missing(src.schema, TableSpec("hot", "append", mark_col="d", mark_time_col="t").layout())
    small = dict(SKEW_CONF, **{"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(64 * 1024)})
    with conf(spark, small):
        rows = table.publish(append_composite(table.read(), src, "d", "t", "2024-02-01 00:00:00"))
    assert rows == n and table.read().count() == n
    hot_dir = f"{scratch}/raw/hot/_period=2024-01-01"
    files = [f for f in os.listdir(hot_dir) if f.endswith(".parquet")]
    assert len(files) > 1, files  # the hot month was split across tasks, not written by one


def _stored(df, path):
    """Written and read back: a scan has no partitioning that could hide an exchange."""
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@pytest.mark.parametrize("keys", [["k"], ["k", "k2"]])
def test_hot_key_of_stored_tables_is_split(spark, scratch, keys):
    raw = _stored(_raw(spark).withColumn("k2", F.lit(1)), f"{scratch}/raw")
    batch = _stored(spark.range(1, 3000, 7).select(F.col("id").alias("k"), F.lit(1).alias("k2")), f"{scratch}/batch")
    with conf(spark, SKEW_CONF):
        kept = delete_by_key(raw, batch, keys)
        got = kept.count(), kept.where("k = 0").count()
        rows = kept.collect()
        plan = kept._jdf.queryExecution().executedPlan().toString()
    assert len(rows) == got[0] == raw.where("k % 7 <> 1 or k >= 3000").count() and got[1] == 10000
    assert "skew=true" in plan, plan


@pytest.mark.parametrize("keys", [["k"], ["k2", "k"]])
def test_null_keys_pass_around_the_join(spark, scratch, keys):
    raw = _stored(
        spark.range(30000).select(
            F.when(F.col("id") % 3 == 0, F.lit(None).cast("long")).otherwise(F.col("id")).alias("k"),
            F.col("id").alias("v"), F.lit(1).alias("k2"),
        ),
        f"{scratch}/raw",
    )
    batch = _stored(spark.range(0, 3000, 7).select(F.col("id").alias("k"), F.lit(1).alias("k2")), f"{scratch}/batch")
    with conf(spark, SKEW_CONF):
        kept = delete_by_key(raw, batch.unionByName(batch.select(F.lit(None).cast("long").alias("k"), "k2")), keys)
        got = kept.collect()
        plan = kept._jdf.queryExecution().executedPlan().toString()
    assert sum(1 for r in got if r.k is None) == 10000  # NULL keys never match, all kept
    assert len(got) == raw.where("k is null or k % 7 <> 0 or k >= 3000").count()
    assert "IsNotNull(k)" in plan.replace("isnotnull(k#", "IsNotNull(k)"), plan  # none of them is in the join's exchange


def test_keys_are_broadcast_by_their_bytes(spark, scratch):
    """Few rows of very long keys are not broadcast; the same rows of short keys are."""
    from tidewater.operators.common import LoadPlan, stamp
    from tidewater.sources.layout import Layout
    from tidewater.sources.sink import RawTable

    for width, joined in ((1000, "SortMergeJoin"), (1, "BroadcastHashJoin")):
        src = spark.range(400).select(F.concat(F.lpad(F.col("id").cast("string"), 5, "0"), F.repeat(F.lit("x"), width)).alias("k"))
        table = RawTable(spark, f"{scratch}/raw{width}", "t")
        table.broadcast_bytes = 100_000
        table.create_if_missing(src.schema, Layout("bucket", ["k"], 4))
        for ts in ("2024-01-01 00:00:00", "2024-01-02 00:00:00"):
            batch = stamp(src, ts)
            with conf(spark, {k: v for k, v in SKEW_CONF.items() if "Threshold" in k and "Broadcast" in k}):
                table.publish(LoadPlan(kept=table.read(), batch=batch, kind="keyed", delete_keys=["k"]))
            with conf(spark, {k: v for k, v in SKEW_CONF.items() if "Broadcast" in k}):
                plan = table.last_write.select("*")._jdf.queryExecution().executedPlan().toString()
        assert joined in plan, plan
        assert table.read().count() == 400


def _plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _documents(spark, scratch):
    """Headers and raw lines, of which document 0 has a third."""
    raw = _raw(spark).select(F.col("k").alias("doc"), "v", F.lit(None).cast("timestamp_ntz").alias("_ingested_at"))
    day = F.when(F.col("id") % 7 == 1, F.lit("2024-02-01")).otherwise(F.lit("2023-01-01")).cast("date")
    return _stored(raw, f"{scratch}/raw"), _stored(spark.range(30000).select(F.col("id").alias("doc"), day.alias("d")), f"{scratch}/headers")


def test_lines_of_changed_headers_are_not_sorted_in_memory(spark, scratch):
    """Only document ids are held by a task, the lines stream past; a hot document is still split."""
    from datetime import date

    from tidewater.functions.marks import Mark
    from tidewater.operators import replace_by_header

    raw, headers = _documents(spark, scratch)
    for delete_from in ("headers", "lines"):
        with conf(spark, SKEW_CONF):
            load = replace_by_header(raw, raw.drop("_ingested_at"), headers, Mark(date(2024, 1, 1)), "doc", "d", "2024-02-02 00:00:00", delete_from=delete_from)
            plan = _plan(load.result())
            kept, batch = load.kept.count(), load.batch.count()
        assert (kept, batch) == (raw.where("doc % 7 <> 1").count(), raw.where("doc % 7 = 1").count())
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan and "Sort " not in plan, plan
        assert delete_from == "lines" or "skew=true" in plan, plan


def test_lines_of_header_windows_are_not_sorted_in_memory(spark, scratch):
    from tidewater.operators import load_window_by_header, make_windows

    raw, headers = _documents(spark, scratch)
    with conf(spark, SKEW_CONF):
        load = load_window_by_header(raw, raw.drop("_ingested_at"), headers, "doc", "d", make_windows("2024-01-01", "2024-03-31", 1), 1, "2024-04-01 00:00:00")
        plan = _plan(load.result())
        kept, batch = load.kept.count(), load.batch.count()
    assert (kept, batch) == (raw.where("doc % 7 <> 1").count(), raw.where("doc % 7 = 1").count())
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan and "Sort " not in plan, plan
