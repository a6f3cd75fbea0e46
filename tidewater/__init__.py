"""tidewater: keep a raw (landing) layer in step with source tables, on Spark.

Every load strategy is a pure ``DataFrame -> DataFrame`` plan built from Spark's
own scans, filters, semi/anti joins, aggregates and unions; a thin sink
(:mod:`tidewater.sources.sink`) publishes the result.
"""

from tidewater.session import ensure_checkpoint_dir, get_session

__all__ = ["ensure_checkpoint_dir", "get_session"]
