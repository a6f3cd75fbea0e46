"""The audit table: append-only load events and the monitoring views.

The log is partitioned by the day on which a run began, so the newest run is
found in the newest partition alone, however long the log is.
"""

from __future__ import annotations

import re
import threading
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import audit as A

RUN_DAY = "run_day"


class AuditLog:
    """Events in a Parquet directory; every call swallows its own failure, so
    logging never breaks a load. Log a run through one object: its first event
    decides the run's day. Events of tables that load side by side are
    appended one after another."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.failures: list[str] = []
        self._days: dict[str, date] = {}
        self._lock = threading.Lock()

    def _log(self, run_id, table, strategy, frequency, status, rows=None, message=None, at=None) -> None:
        try:
            at = at or datetime.now()
            ev = A.audit_event(
                self.spark, str(run_id), table, strategy, frequency, status, at, rows,
                None if message is None else message[: A.MESSAGE_MAX],
            )
            with self._lock:
                day = self._days.setdefault(str(run_id), at.date())
                ev.withColumn(RUN_DAY, F.lit(day)).coalesce(1).write.mode("append").partitionBy(RUN_DAY).parquet(self.path)
        except Exception as exc:  # noqa: BLE001 - audit must not break the load
            self.failures.append(f"{table}/{status}: {exc}")

    def start(self, run_id, table, strategy, frequency, at=None) -> None:
        self._log(run_id, table, strategy, frequency, A.RUNNING, at=at)

    def success(self, run_id, table, strategy, frequency, rows: int, at=None) -> None:
        self._log(run_id, table, strategy, frequency, A.SUCCESS, rows=rows, at=at)

    def error(self, run_id, table, strategy, frequency, message: str, at=None) -> None:
        self._log(run_id, table, strategy, frequency, A.ERROR, message=message, at=at)

    def compact(self, files: int | None = None) -> None:
        """Rewrite the log into few files (events are appended one small file
        each), ``files`` for each day of runs. Spark puts the days in place one by
        one when all are written; the log is never absent."""
        ev = self._stored()
        ev = ev.repartition(files, RUN_DAY) if files else ev.hint("rebalance", RUN_DAY)
        with self._lock:
            ev.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RUN_DAY).parquet(self.path)

    def create_views(self, prefix: str = "audit") -> None:
        """Temp views ``{prefix}_events`` and ``{prefix}_state`` so the
        monitoring queries can also be written as plain Spark SQL."""
        self.events().createOrReplaceTempView(f"{prefix}_events")
        self.state().createOrReplaceTempView(f"{prefix}_state")

    def _stored(self) -> DataFrame:
        return self.spark.read.schema(f"{A.EVENT_SCHEMA}, {RUN_DAY} date").parquet(self.path)

    def events(self) -> DataFrame:
        return self._stored().drop(RUN_DAY)

    def newest_events(self) -> DataFrame:
        """Events of the runs that began on the newest day: one partition of the log, found by listing it."""
        log = self._stored()
        days = {m[1] for m in (re.search(rf"/{RUN_DAY}=([0-9-]+)/", f) for f in log.inputFiles()) if m}
        return log.where(F.col(RUN_DAY) == F.lit(max(days, default="1970-01-01")).cast("date")).drop(RUN_DAY)

    def state(self, messages: bool = True) -> DataFrame:
        return A.audit_state(self.events(), messages)

    def last_run(self) -> DataFrame:
        return A.last_run(self.newest_events())

    def history(self) -> DataFrame:
        return A.run_history(self.state(messages=False))

    def errors(self) -> DataFrame:
        return A.error_list(self.state())

    def summary(self) -> DataFrame:
        return A.run_summary(self.state(messages=False))
