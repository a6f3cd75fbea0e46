"""How a raw table is partitioned."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET_COL, DAY_COL = "_bucket", "_period"


@dataclass
class Layout:
    """How a raw table is partitioned.

    ``bucket``: ``_bucket = pmod(xxhash64(keys), buckets)`` for keyed loads.
    ``day``: ``_period`` = the day (``grain="day"``) or the first day of the
    month (``grain="month"``) of ``day_col``, for day / window / snapshot
    loads. Monthly periods keep the partition count low for tables that
    span years; daily periods suit snapshots, where one day is a whole copy.
    ``none``: not partitioned.
    """

    kind: str = "none"
    keys: list[str] = field(default_factory=list)
    buckets: int = 64
    day_col: str | None = None
    grain: str = "day"

    @property
    def column(self) -> str | None:
        return {"bucket": BUCKET_COL, "day": DAY_COL}.get(self.kind)

    def period(self, d: date) -> date:
        """Partition value of a day."""
        return d.replace(day=1) if self.grain == "month" else d

    def value(self, schema: T.StructType) -> Column | None:
        """The partition of a row with the columns of ``schema``."""
        if self.kind == "bucket":
            return F.pmod(F.xxhash64(*(F.col(k).cast(schema[k].dataType) for k in self.keys)), F.lit(self.buckets)).cast("int")
        day = F.to_date(F.col(self.day_col)) if self.kind == "day" else None
        return F.trunc(day, "MM") if self.grain == "month" and day is not None else day
