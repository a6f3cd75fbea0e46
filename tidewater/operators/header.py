"""Header-driven line loads (L5, L10) and the header-mark capture.

Line tables have no mark of their own: the lines to reload are those whose
document id belongs to a changed header. The header mark must be read
*before* the header table itself is loaded in the same run, or the freshly
loaded header would move the mark past the changes (P1).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.marks import Mark, read_composite_mark, read_day_mark
from tidewater.functions.predicates import newer_than
from tidewater.operators.common import WINDOW_COL, LoadPlan, delete_by_key, hashed, maybe_broadcast, semi_by_key, stamp
from tidewater.operators.windows import Window, assign_windows


@dataclass(frozen=True)
class HeaderRef:
    """Which header mark a line table follows (P1 key; trap 12 fix)."""

    table: str
    date_col: str
    time_col: str | None = None


def capture_header_marks(
    refs: Iterable[HeaderRef],
    read_raw: Callable[[HeaderRef], DataFrame] | None = None,
    mark_of: Callable[[HeaderRef], Mark] | None = None,
) -> dict[HeaderRef, Mark | Exception]:
    """Read every needed header mark before any write of the run.

    Keyed by (header, date column, time column), so two line tables following
    the same header on different columns each get their own mark. A header that
    cannot be read yields its exception as the value: only the line tables that
    depend on it fail, not the whole run (trap 11 fix). An empty raw header
    yields ``Mark.none()`` -- captured, and meaning "load every line" (trap 10).
    ``read_raw(ref)`` returns the raw header rows that can hold the mark;
    ``mark_of(ref)``, when given, returns the mark directly (a sink that keeps
    marks in table metadata).
    """
    marks: dict[HeaderRef, Mark | Exception] = {}
    for ref in refs:
        if ref in marks:
            continue
        try:
            if mark_of is not None:
                marks[ref] = mark_of(ref)
                continue
            raw = read_raw(ref)
            marks[ref] = (
                read_composite_mark(raw, ref.date_col, ref.time_col)
                if ref.time_col
                else read_day_mark(raw, ref.date_col)
            )
        except Exception as exc:  # noqa: BLE001 - kept per header, raised per table
            marks[ref] = exc
    return marks


def id_ranges(ids: DataFrame, key: str, most: int = 16, blocks: int = 4096) -> list[tuple]:
    """Up to ``most`` closed ranges that hold every value of ``key``, cut at its widest gaps.

    One aggregate finds the bounds, a second the least and greatest value in
    each of ``blocks`` equal parts between them (that many rows at most come
    back); the ranges end at the widest gaps between neighbouring parts. A late
    change to an old document so gets a range of its own. Keys that are not
    integers get one range. Without a value there is no range.
    """
    values = ids.select(F.col(key).alias("k")).where(F.col("k").isNotNull())
    lo, hi = values.agg(F.min("k"), F.max("k")).first()
    if lo is None:
        return []
    if not isinstance(lo, int) or hi - lo < 2:
        return [(lo, hi)]
    part = F.floor((F.col("k").cast("double") - F.lit(float(lo))) / F.lit(max(1.0, (hi - lo) / blocks)))
    found = sorted(tuple(r) for r in values.groupBy(part.alias("part")).agg(F.min("k").alias("a"), F.max("k").alias("b")).select("a", "b").collect())
    gaps = sorted(range(1, len(found)), key=lambda i: found[i - 1][1] - found[i][0])[: most - 1]
    cuts = [0, *sorted(i for i in gaps if found[i][0] - found[i - 1][1] > 1), len(found)]
    return [(found[i][0], found[j - 1][1]) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]


def replace_by_header(
    raw_lines: DataFrame,
    source_lines: DataFrame,
    source_headers: DataFrame,
    header_mark: Mark,
    doc_key: str,
    header_date_col: str,
    run_ts: datetime | str,
    header_key: str | None = None,
    header_time_col: str | None = None,
    delete_from: str = "lines",
    broadcast: bool | None = None,
    id_range_prefilter: bool = True,
) -> LoadPlan:
    """Reload the lines of every header changed since ``header_mark``.

    changed = headers past the mark (F1, or F2 for a day mark); batch = lines
    semi-joined to changed ids (J1); raw lines whose document id is in the
    batch are removed (J2 on the document id only, once per run: J4 falls out
    of set semantics) and the batch is added.

    ``delete_from="lines"`` (the reference's behaviour) takes the delete set
    from the fetched lines, so a changed document that now has no line keeps
    its old lines; ``"headers"`` deletes by changed header instead.

    ``id_range_prefilter`` first reads a bounded list of ranges that hold the
    changed headers' document ids (``id_ranges``) and adds them to the line
    scan: literal ranges reach the Parquet scan, whose row-group statistics then
    skip lines outside them. They only narrow what the semi-join keeps anyway,
    so the result is unchanged.
    """
    header_key = header_key or doc_key
    pred = newer_than(header_mark, header_date_col, header_time_col)
    if pred is None:
        batch = source_lines
        changed = source_headers
    else:
        changed = source_headers.where(pred)
        lines = source_lines
        if id_range_prefilter:
            inside = F.lit(False)  # no changed header: no line
            for lo, hi in id_ranges(changed, header_key):
                inside = inside | F.col(doc_key).between(F.lit(lo), F.lit(hi))
            lines = source_lines.where(inside)
        batch = semi_by_key(lines, changed, doc_key, header_key, broadcast=broadcast)
    batch = stamp(batch, run_ts)
    if delete_from == "headers":
        kept = delete_by_key(raw_lines, hashed(changed, broadcast), [header_key], broadcast=broadcast, raw_keys=[doc_key])
        ids = changed.select(changed[header_key].alias(doc_key))
    elif delete_from == "lines":
        kept = delete_by_key(raw_lines, hashed(batch, broadcast), [doc_key], broadcast=broadcast)
        ids = batch
    else:
        raise ValueError(f"delete_from must be 'lines' or 'headers', not {delete_from!r}")
    return LoadPlan(kept=kept, batch=batch, kind="keyed", delete_keys=[doc_key], delete_ids=ids)


def load_window_by_header(
    raw_lines: DataFrame,
    source_lines: DataFrame,
    source_headers: DataFrame,
    doc_key: str,
    header_date_col: str,
    windows: list[Window],
    months: int,
    run_ts: datetime | str,
    header_key: str | None = None,
    replace: bool = True,
    broadcast: bool | None = None,
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> LoadPlan:
    """Lines whose header mark lies in one of the windows (F4 on the
    header), all windows in one pass. A line keeps its header's window (the
    first one, if the header stands in several), so the rows of each window are
    counted as they are written (A2). ``stage`` may write the documents'
    windows, one row each, somewhere: AQE splits a hot document of a join with
    a stored side, not of one with an aggregate.

    ``replace=True`` (our fix) first removes raw lines of the loaded documents,
    so re-running a window never duplicates; ``replace=False`` is the
    reference's insert-only behaviour.
    """
    header_key = header_key or doc_key
    in_win = assign_windows(source_headers, header_date_col, windows, months, out=WINDOW_COL)
    docs = in_win.groupBy(F.col(header_key).alias("__doc")).agg(F.min(WINDOW_COL).alias(WINDOW_COL))
    docs = stage(docs) if stage else docs
    docs = maybe_broadcast(hashed(docs, broadcast), broadcast)
    batch = stamp(source_lines.join(docs, source_lines[doc_key] == docs["__doc"]).drop("__doc"), run_ts)
    numbers = [w.number for w in windows]
    if not replace:
        return LoadPlan(kept=raw_lines, batch=batch, kind="append", windows=numbers)
    kept = delete_by_key(raw_lines, hashed(batch, broadcast), [doc_key], broadcast=broadcast)
    return LoadPlan(kept=kept, batch=batch, kind="keyed", delete_keys=[doc_key], delete_ids=batch, windows=numbers)
