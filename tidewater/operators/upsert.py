"""Keyed upsert L4: replace raw rows whose key appears in the batch."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.marks import Mark, read_composite_mark, read_day_mark
from tidewater.functions.predicates import newer_than, where_opt
from tidewater.operators.common import LoadPlan, delete_by_key, newest_per_key, stamp


def upsert(
    raw: DataFrame,
    source: DataFrame,
    keys: list[str],
    date_col: str,
    run_ts: datetime | str,
    time_col: str | None = None,
    mark: Mark | None = None,
    broadcast: bool | None = None,
    one_per_key: bool = True,
) -> LoadPlan:
    """L4: mark (composite F1 when a time column is set, else day F2 ``>=``),
    batch = new source rows, raw rows with a batch key removed, batch added.

    ``one_per_key`` keeps only the newest row per key inside the batch, so the
    raw side ends with exactly one row per non-NULL key. The delete is one
    ``left_anti`` join on every key column; ``broadcast`` is passed by a caller
    that has measured the batch (see :func:`maybe_broadcast`).
    """
    if not keys:
        raise ValueError("upsert needs a key")
    if mark is None:
        mark = read_composite_mark(raw, date_col, time_col) if time_col else read_day_mark(raw, date_col)
    batch = where_opt(source, newer_than(mark, date_col, time_col))
    if one_per_key:
        batch = newest_per_key(batch, keys, [date_col] + ([time_col] if time_col else []))
    batch = stamp(batch, run_ts)
    kept = delete_by_key(raw, batch, keys, broadcast=broadcast)
    return LoadPlan(
        kept=kept, batch=batch, kind="keyed", delete_keys=list(keys), delete_ids=None if one_per_key else batch,
    )


def merge_into(batch: DataFrame, table: str, keys: list[str]):
    """L4 as one row-level MERGE into a catalog table whose format supports it:
    matched keys are replaced, others inserted. Returns the writer; ``merge()``
    runs it. NULL keys never match, so their rows are inserted. No such table
    format is installed here: only the statement's building is tested."""
    on = None
    for k in keys:
        same = F.col(f"{table}.{k}") == F.col(f"batch.{k}")
        on = same if on is None else on & same
    return batch.alias("batch").mergeInto(table, on).whenMatched().updateAll().whenNotMatched().insertAll()
