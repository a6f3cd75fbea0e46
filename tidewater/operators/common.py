"""Pieces shared by the load strategies: stamping, keyed deletes, union, dedupe."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.predicates import INGEST_COL

#: A batch's column that holds the number of a row's history window; it is never stored.
WINDOW_COL = "__window_no"


def ts_literal(ts: datetime | str) -> Column:
    """A TIMESTAMP_NTZ literal, exact to the microsecond and zone-free."""
    text = ts.isoformat(sep=" ") if isinstance(ts, datetime) else str(ts)
    return F.lit(text).cast("timestamp_ntz")


def stamp(df: DataFrame, run_ts: datetime | str, col: str = INGEST_COL) -> DataFrame:
    """One ingest timestamp per run, the same for every row of the run."""
    return df.withColumn(col, ts_literal(run_ts))


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, same schema (folded by the optimizer to an empty relation)."""
    return df.where(F.lit(False))


def union_all(kept: DataFrame, batch: DataFrame) -> DataFrame:
    """Kept rows then the batch, matched by name; a column on one side only
    comes back NULL on the other (schema growth, S6)."""
    return kept.unionByName(batch, allowMissingColumns=True)


def maybe_broadcast(df: DataFrame, broadcast: bool | None) -> DataFrame:
    """Broadcast only when the caller has *measured* the side to be small.

    ``None`` leaves the choice to the planner and AQE, which switch a join to a
    broadcast only after the runtime size of the small side is known and below
    ``spark.sql.adaptive.autoBroadcastJoinThreshold``; above it the join stays a
    shuffle join whose hot partitions AQE splits.
    """
    return F.broadcast(df) if broadcast else df


def hashed(df: DataFrame, broadcast: bool | None) -> DataFrame:
    """The key side of a join with lines: hashed by partition, or left to ``maybe_broadcast``.

    A merge join sorts the lines, whole rows, in the memory of a task, and the
    planner takes a key side for small by the bytes of its packed file. A hash
    join of the shuffled sides holds only a partition's distinct keys (of an
    inner join its rows); the lines stream past, and AQE still splits hot ones.
    """
    return df if broadcast else df.hint("shuffle_hash")


def delete_by_key(
    raw: DataFrame,
    keys_from: DataFrame,
    keys: list[str],
    broadcast: bool | None = None,
    raw_keys: list[str] | None = None,
) -> DataFrame:
    """Raw rows whose key (every column equal) is not in ``keys_from``.

    A ``left_anti`` join. A NULL in any key column never matches, so rows with
    one pass around the join by a filter and a union, and no NULL group can
    gather in a task. The key side is used as it is: an aggregate between the
    exchange and the join would keep AQE from splitting a hot key of ``raw``.
    Callers whose key side repeats keys make it distinct where they stage it.
    """
    raw_keys = raw_keys or keys
    right = keys_from.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)])
    for c in right.columns:
        right = right.where(F.col(c).isNotNull())
    cond = [raw[rk] == right[f"__k{i}"] for i, rk in enumerate(raw_keys)]
    nullable = [rk for rk in raw_keys if raw.schema[raw.columns[[c.upper() for c in raw.columns].index(rk.upper())]].nullable]
    if not nullable:
        return raw.join(maybe_broadcast(right, broadcast), cond, "left_anti")
    known, has_null = raw, F.lit(False)
    for rk in nullable:
        known, has_null = known.where(raw[rk].isNotNull()), has_null | raw[rk].isNull()
    return known.join(maybe_broadcast(right, broadcast), cond, "left_anti").unionByName(raw.where(has_null))


def semi_by_key(
    lines: DataFrame,
    ids_from: DataFrame,
    line_key: str,
    id_col: str,
    broadcast: bool | None = None,
) -> DataFrame:
    """Lines whose document id occurs in ``ids_from`` (``IN (subquery)``)."""
    right = hashed(ids_from.select(F.col(id_col).alias("__id")), broadcast)
    return lines.join(maybe_broadcast(right, broadcast), lines[line_key] == right["__id"], "left_semi")


def newest_per_key(batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Trap 17 fix: one row per key, the newest by ``order`` (mark date, mark
    time), ties broken by every other column, all descending, NULLs last.

    Done as ``groupBy(keys).agg(max(struct(order..., rest...)))``: partial
    (sort-based) aggregation collapses a hot key inside each task before the
    shuffle, so a
    key holding a third of the batch never lands whole in one task. Rows with
    a NULL in a key column are not the same key as anything (SQL equality) and
    pass through unmerged, as they would be inserted by the reference.
    """
    cols = batch.columns
    rest = [c for c in cols if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest]).alias("__top")
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    with_keys = batch.where(~null_key).groupBy(*keys).agg(F.max(packed).alias("__top"))
    deduped = with_keys.select(*keys, *[F.col(f"__top.{c}").alias(c) for c in order + rest]).select(*cols)
    return deduped.unionByName(batch.where(null_key))


@dataclass
class LoadPlan:
    """What one load does to a raw table, kept apart so the sink can write
    only what changed.

    ``kept`` is the surviving raw rows, ``batch`` the stamped rows to insert.
    ``kind`` tells the sink how the delete was expressed:
    ``append`` (nothing deleted), ``keyed`` (anti-join on ``delete_keys``),
    ``predicate`` (rows matching ``delete_pred`` removed) or ``overwrite``
    (everything replaced).
    """

    kept: DataFrame
    batch: DataFrame
    kind: str
    delete_keys: list[str] = field(default_factory=list)
    delete_pred: Column | None = None
    delete_ids: DataFrame | None = None
    # (column, first day, last day): every row the delete can reach has its
    # ``column`` day in this range -- lets a day-partitioned sink rewrite only
    # those days instead of scanning the table.
    delete_days: tuple | None = None
    # numbers of the history windows that the batch's ``WINDOW_COL`` holds: the
    # sink counts the rows of each while it writes them
    windows: list[int] = field(default_factory=list)

    def result(self) -> DataFrame:
        """The new raw table as one DataFrame (kept UNION ALL batch)."""
        batch = self.batch.drop(WINDOW_COL)
        return batch if self.kind == "overwrite" else union_all(self.kept, batch)
