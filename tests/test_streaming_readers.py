"""Streaming loads through foreachBatch, and the source readers."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tidewater.operators.windows import make_windows
from tidewater.plans.settings import TableSpec
from tidewater.sources.readers import parquet_source, split_predicates, window_predicates
from tidewater.sources.sink import RawTable
from tidewater.streaming import feed, stream_into

SF = "/root/testdata/sf0.001"


def test_stream_upsert_applies_each_file_once(spark, scratch):
    src_dir = f"{scratch}/incoming"
    cust = spark.read.parquet(f"{SF}/customer.parquet").withColumn("upd", F.lit(date(2024, 1, 1)))
    cust.where("c_custkey % 2 = 0").coalesce(1).write.parquet(f"{src_dir}/f1")
    cust.where("c_custkey % 2 = 1").coalesce(1).write.parquet(f"{src_dir}/f2")
    table = RawTable(spark, f"{scratch}/raw", "cust")
    table.create_if_missing(cust.schema, TableSpec("cust", "upsert", keys=("c_custkey",), mark_col="upd").layout())

    def run(ckpt):
        stream = spark.readStream.schema(cust.schema).option("maxFilesPerTrigger", 1).parquet(f"{src_dir}/*")
        q = stream_into(stream, table, "upsert", keys=["c_custkey"], mark_col="upd", name="cust_feed",
                        checkpoint=ckpt)
        q.awaitTermination(300)

    ckpt = f"{scratch}/stream-ckpt"
    run(ckpt)
    assert table.read().count() == cust.count()
    changed = cust.where("c_custkey % 10 = 0").withColumn("c_acctbal", F.lit(-1.0)).withColumn(
        "upd", F.lit(date(2024, 2, 1)))
    changed.coalesce(1).write.parquet(f"{src_dir}/f3")
    run(ckpt)
    out = table.read()
    assert out.count() == out.select("c_custkey").distinct().count() == cust.count()
    assert out.where("c_acctbal = -1.0").count() == changed.count()


def test_readers(spark):
    read = parquet_source(spark, SF)
    assert read("nation").count() == 25
    preds = window_predicates("UpdateDate", make_windows("2024-01-01", "2024-06-30", 3))
    assert preds == [
        "\"UpdateDate\" >= '2024-01-01' AND \"UpdateDate\" <= '2024-03-31'",
        "\"UpdateDate\" >= '2024-04-01' AND \"UpdateDate\" <= '2024-06-30'",
    ]


@pytest.mark.parametrize("kind", ["long", "date", "timestamp_ntz", "timestamp", "double", "decimal(12,2)"])
def test_splits_of_equal_depth(spark, kind):
    """A skewed column with NULLs: each row is in one split, and none is much larger than the others."""
    skewed = (F.pow(F.col("id") / 5000, 6) * 100_000).cast("long")
    value = skewed if kind in ("long", "double") or kind.startswith("decimal") else F.timestamp_seconds(skewed)
    df = spark.range(5000).select(F.when(F.col("id") % 50 != 0, value.cast(kind)).alias("My Col"), "id")
    if kind == "date":
        df = df.withColumn("My Col", F.when(F.col("My Col").isNotNull(), F.date_add(F.lit(date(2000, 1, 1)), (skewed / 10).cast("int"))))
    preds = split_predicates(df, "my col", 8, quote="`")
    assert len(preds) > 4
    sizes = [df.where(p).count() for p in preds]
    assert sum(sizes) == 5000 == df.where(" OR ".join(preds)).count()
    # the least value is over half of all rows of some types: it is a split of its own
    assert sorted(sizes)[-2] <= 2 * 5000 / 8


def test_splits_of_one_value_and_of_none(spark):
    for df in (spark.range(100).select(F.lit(7).alias("k")), spark.range(100).select(F.lit(None).cast("int").alias("k")), spark.range(0).select(F.col("id").alias("k"))):
        assert sum(df.where(p).count() for p in split_predicates(df, "k", 4, quote="`")) == df.count()


class SqlSource:
    """A source that evaluates pushed SQL itself (Spark SQL stands in for the
    source database), shaped like ``JdbcSource``."""

    quote = "`"

    def __init__(self, spark, frames):
        self.spark, self.calls = spark, []
        for name, df in frames.items():
            df.createOrReplaceTempView(f"src_{name}")

    def __call__(self, name):
        return self.spark.table(f"src_{name}")

    def lines_in(self, name, doc_key, header, header_key, header_where):
        self.calls.append(header_where)
        return self.spark.sql(
            f"SELECT * FROM src_{name} WHERE `{doc_key}` IN (SELECT `{header_key}` FROM src_{header} WHERE {header_where})"
        )


def test_header_semi_join_pushed_into_source(spark, scratch):
    from datetime import datetime

    from tidewater.plans import fixtures as fx
    from tidewater.plans.runs import incremental_load, initial_load

    specs = [
        TableSpec("hdr", "append", mark_col="updatedate", mark_time_col="updatets"),
        TableSpec("lines", "replace_by_header", header_table="hdr", header_mark_col="updatedate",
                  header_mark_time_col="updatets", doc_key="docentry", buckets=4),
    ]
    v1 = {"hdr": fx.header_raw(spark, SF).drop("_ingested_at"), "lines": fx.lines_raw(spark, SF).drop("_ingested_at")}
    v2 = {"hdr": fx.header_source(spark, SF), "lines": fx.lines_source(spark, SF)}
    results = []
    for label, make in (("plain", lambda: v2.__getitem__), ("pushed", lambda: SqlSource(spark, v2))):
        root = f"{scratch}/{label}"
        assert initial_load(spark, specs, v1.__getitem__, root, run_ts=datetime(2024, 1, 1)).ok
        reader = make()
        assert incremental_load(spark, specs, reader, root, run_ts=datetime(2024, 1, 2)).ok
        if label == "pushed":
            assert reader.calls and "`updatedate` >" in reader.calls[0]
        lines = RawTable(spark, root, "lines").read()
        results.append(sorted(tuple(r) for r in lines.drop("_ingested_at").collect()))
    assert results[0] == results[1]


class WindowedSource(SqlSource):
    """Shaped like ``JdbcSource``: reads history one partition per window."""

    def __init__(self, spark, frames):
        super().__init__(spark, frames)
        self.window_reads = []

    def read_windows(self, name, col, windows):
        from functools import reduce

        self.window_reads.append((name, len(windows)))
        parts = [
            self.spark.table(f"src_{name}").where(f"`{col}` >= '{w.start}' AND `{col}` <= '{w.end}'") for w in windows
        ]
        return reduce(lambda a, b: a.unionByName(b), parts)


def test_history_read_one_task_per_window(spark, scratch):
    from datetime import datetime

    from tidewater.plans import fixtures as fx
    from tidewater.plans.runs import initial_load
    from tidewater.plans.settings import InitialLoad

    hdr = fx.header_raw(spark, SF).drop("_ingested_at")
    spec = TableSpec("hdr", "append", mark_col="updatedate", mark_time_col="updatets",
                     initial=InitialLoad(date(1995, 1, 1), date(2001, 12, 31), 12, 3))
    reader = WindowedSource(spark, {"hdr": hdr})
    res = initial_load(spark, [spec], reader, f"{scratch}/raw", run_ts=datetime(2024, 1, 1))
    assert res.ok, res.failures
    assert reader.window_reads == [("hdr", 3), ("hdr", 3), ("hdr", 1)]
    assert RawTable(spark, f"{scratch}/raw", "hdr").read().count() == hdr.count()


def test_stream_append_replay_is_not_duplicated(spark, scratch, monkeypatch):
    src_dir = f"{scratch}/incoming"
    nat = spark.read.parquet(f"{SF}/nation.parquet")
    nat.where("n_nationkey < 10").coalesce(1).write.parquet(f"{src_dir}/f1")
    nat.where("n_nationkey >= 10").coalesce(1).write.parquet(f"{src_dir}/f2")
    table = RawTable(spark, f"{scratch}/raw", "nat")
    table.create_if_missing(nat.schema, TableSpec("nat", "full_reload").layout())
    ckpt = f"{scratch}/ckpt"
    real, calls = feed._record, {"n": 0}

    def crash_after_first_publish(spark, path, status, run_ts):
        # die between the publish of epoch 0 and its "done" marker, once
        if status == "done" and calls["n"] == 0:
            calls["n"] += 1
            raise RuntimeError("simulated crash")
        return real(spark, path, status, run_ts)

    def run():
        stream = spark.readStream.schema(nat.schema).option("maxFilesPerTrigger", 1).parquet(f"{src_dir}/*")
        q = stream_into(stream, table, "append", name="nat_feed", checkpoint=ckpt)
        try:
            q.awaitTermination(300)
        except Exception:  # noqa: BLE001 - the simulated crash stops the query
            pass

    monkeypatch.setattr(feed, "_record", crash_after_first_publish)
    run()
    assert calls["n"] == 1 and table.read().count() == 10  # epoch 0 landed, marker missing
    run()  # epoch 0 is re-delivered, then epoch 1
    out = table.read()
    assert out.count() == 25 and out.select("n_nationkey").distinct().count() == 25
