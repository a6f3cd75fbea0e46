"""Load strategies as pure DataFrame plans (L1-L11), plus audit queries."""

from tidewater.operators.append import append_composite, append_day
from tidewater.operators.audit import (
    audit_event,
    audit_state,
    error_list,
    last_run,
    run_history,
    run_summary,
)
from tidewater.operators.common import LoadPlan, delete_by_key, newest_per_key, semi_by_key, stamp, union_all
from tidewater.operators.header import HeaderRef, capture_header_marks, load_window_by_header, replace_by_header
from tidewater.operators.reload import daily_snapshot, full_reload, initial_full
from tidewater.operators.schema import align_to, evolve_schema, missing_columns, scan_projected
from tidewater.operators.upsert import upsert
from tidewater.operators.windows import Window, assign_windows, load_windows, make_windows, window_counts

__all__ = [
    "HeaderRef",
    "LoadPlan",
    "Window",
    "align_to",
    "append_composite",
    "append_day",
    "assign_windows",
    "audit_event",
    "audit_state",
    "capture_header_marks",
    "daily_snapshot",
    "delete_by_key",
    "error_list",
    "evolve_schema",
    "full_reload",
    "initial_full",
    "last_run",
    "load_window_by_header",
    "load_windows",
    "make_windows",
    "missing_columns",
    "newest_per_key",
    "replace_by_header",
    "run_history",
    "run_summary",
    "scan_projected",
    "semi_by_key",
    "stamp",
    "union_all",
    "upsert",
    "window_counts",
]
