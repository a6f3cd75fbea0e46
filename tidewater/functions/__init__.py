"""Column-level building blocks: mark predicates, mark aggregates, type map."""

from tidewater.functions.marks import (
    Mark,
    composite_mark_frame,
    day_mark_frame,
    read_composite_mark,
    read_day_mark,
    to_mark_day,
)
from tidewater.functions.predicates import (
    drop_day,
    drop_today,
    drop_window,
    in_window,
    mark_sql,
    newer_than,
    newer_than_composite,
    newer_than_day,
)
from tidewater.functions.typemap import SourceColumn, map_type, typed_projection

__all__ = [
    "Mark",
    "SourceColumn",
    "composite_mark_frame",
    "day_mark_frame",
    "drop_day",
    "drop_today",
    "drop_window",
    "in_window",
    "map_type",
    "mark_sql",
    "newer_than",
    "newer_than_composite",
    "newer_than_day",
    "read_composite_mark",
    "read_day_mark",
    "to_mark_day",
    "typed_projection",
]
