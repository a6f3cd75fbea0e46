"""Apply the same loads to a stream of source changes (Structured Streaming).

Where the source arrives as a stream (new files, a change feed), Spark's own
offset tracking replaces the high-water mark: every micro-batch is "the new
rows", applied to the raw table through ``foreachBatch`` with the same
strategy functions and the same sink as the batch runs. ``availableNow``
processes what is there and stops, so a scheduled job keeps batch semantics.

Exactly once: a micro-batch can be re-delivered after a failure. Beside Spark's
own progress the checkpoint keeps, under the query's id, what was done with
each epoch: before a publish its ingest timestamp as *pending*, after it *done*.
A stream started on another checkpoint counts its epochs anew. A done epoch is
skipped. A pending epoch seen again may or may not have landed, so an append
replaces the rows stamped with that exact timestamp instead of adding them
again (a whole-table rewrite, but only on this rare replay); an upsert simply
replaces the same keys again.
"""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater.functions.marks import Mark
from tidewater.functions.predicates import INGEST_COL
from tidewater.operators import LoadPlan, stamp, upsert
from tidewater.operators.common import ts_literal
from tidewater.sources.sink import RawTable


def _plan(table: RawTable, batch: DataFrame, strategy: str, keys, mark_col, mark_time_col, run_ts) -> LoadPlan:
    raw = table.read()
    if strategy == "append":
        return LoadPlan(kept=raw, batch=stamp(batch, run_ts), kind="append")
    if strategy == "upsert":
        # the micro-batch is the change set: no mark filter, newest row per key wins
        return upsert(raw, batch, list(keys), mark_col, run_ts, time_col=mark_time_col,
                      mark=Mark.none(bool(mark_time_col)))
    raise ValueError(f"streaming supports 'append' and 'upsert', not {strategy!r}")


def _seen(spark: SparkSession, path: str) -> dict[str, str]:
    """status -> ingest timestamp that the checkpoint holds for an epoch (two rows at most)."""
    try:
        return {r.status: r.run_ts for r in spark.read.schema("status string, run_ts string").json(path).collect()}
    except AnalysisException:  # a new epoch
        return {}


def _record(spark: SparkSession, path: str, status: str, run_ts: str) -> None:
    spark.createDataFrame([(status, run_ts)], "status string, run_ts string").coalesce(1).write.mode("append").json(path)


def stream_into(
    stream: DataFrame,
    table: RawTable,
    strategy: str = "append",
    keys: list[str] | None = None,
    mark_col: str | None = None,
    mark_time_col: str | None = None,
    name: str | None = None,
    checkpoint: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start a streaming load of ``stream`` into ``table``; returns the query.

    Without ``checkpoint`` the stream keeps its progress in a fixed folder
    beside the table, one for each table and ``name``, so a second start goes
    on where the first one ended.
    """
    name = name or f"{table.name}_feed"
    ckpt = checkpoint or f"{table.root}/_streams/{table.name}-{name}"

    def apply(batch: DataFrame, epoch: int) -> None:
        # the query id, which Spark writes to the checkpoint before the first batch
        spark = table.spark
        query_id = json.loads(spark.read.text(f"{ckpt}/metadata").first()["value"])["id"]
        path = f"{ckpt}/loads/{query_id}/{epoch}"
        seen = _seen(spark, path)
        if "done" in seen:
            return
        table.add_missing_columns(batch.schema)
        if strategy == "append" and "pending" in seen:
            # a replay: the earlier attempt may have landed; replace its rows
            run_ts = seen["pending"]
            gone = F.coalesce(F.col(INGEST_COL) == ts_literal(run_ts), F.lit(False))
            raw = table.read()
            plan = LoadPlan(kept=raw.where(~gone), batch=stamp(batch, run_ts), kind="predicate", delete_pred=gone)
        else:
            run_ts = datetime.now().isoformat(sep=" ")
            _record(spark, path, "pending", run_ts)
            plan = _plan(table, batch, strategy, keys, mark_col, mark_time_col, run_ts)
        table.publish(plan)
        _record(spark, path, "done", run_ts)

    w = stream.writeStream.queryName(name).option("checkpointLocation", ckpt).foreachBatch(apply)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
