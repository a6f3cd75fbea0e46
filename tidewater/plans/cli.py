"""Command line for the two runs (R1 initial, R2 incremental).

    python -m tidewater.plans.cli initial     --settings tables.yaml --parquet-source DIR --root DIR
    python -m tidewater.plans.cli incremental --settings tables.yaml --parquet-source DIR --root DIR \
        [--frequency daily|weekly]

Settings are YAML in the reference's vocabulary (``--english-settings`` for
ours). The source is a folder of Parquet tables or a JDBC URL. The exit code
is 1 when any table failed, and the failures are printed (the audit log has
them too).
"""

from __future__ import annotations

import argparse
import sys

from tidewater.plans.runs import incremental_load, initial_load
from tidewater.plans.settings import specs_from_yaml
from tidewater.session import get_session
from tidewater.sources.audit_log import AuditLog
from tidewater.sources.readers import JdbcSplit, jdbc_source, parquet_source


def _args(argv):
    p = argparse.ArgumentParser(prog="tidewater")
    p.add_argument("run", choices=["initial", "incremental"])
    p.add_argument("--settings", required=True, help="YAML table settings")
    p.add_argument("--english-settings", action="store_true", help="settings use this library's key names")
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--parquet-source", help="folder holding <table>.parquet")
    src.add_argument("--jdbc-url", help="JDBC URL of the source database")
    p.add_argument("--jdbc-schema", default=None)
    p.add_argument("--jdbc-option", action="append", default=[], help="key=value, repeatable")
    p.add_argument("--jdbc-columns-query", default=None,
                   help="SELECT of table, column, type, length, scale, position over the source catalog")
    p.add_argument("--root", required=True, help="raw layer root folder")
    p.add_argument("--audit", default=None, help="audit log folder (default: <root>/_audit)")
    p.add_argument("--frequency", choices=["daily", "weekly"], default=None)
    return p.parse_args(argv)


def main(argv=None, spark=None) -> int:
    a = _args(argv)
    spark = spark or get_session()
    with open(a.settings, encoding="utf-8") as f:
        specs = specs_from_yaml(f.read(), reference_vocabulary=not a.english_settings)
    if a.parquet_source:
        read = parquet_source(spark, a.parquet_source)
    else:
        opts = dict(kv.split("=", 1) for kv in a.jdbc_option)
        splits = {s.name: JdbcSplit(*s.split) for s in specs if s.split}
        read = jdbc_source(spark, a.jdbc_url, a.jdbc_schema, opts, splits, columns_query=a.jdbc_columns_query)
    audit = AuditLog(spark, a.audit or f"{a.root.rstrip('/')}/_audit")
    if a.run == "initial":
        res = initial_load(spark, specs, read, a.root, audit=audit)
    else:
        res = incremental_load(spark, specs, read, a.root, audit=audit, frequency=a.frequency)
    done = len(res.rows)
    print(f"{done}/{done + len(res.failures)} tables loaded, {sum(res.rows.values())} rows, run {res.run_id}")
    for name, msg in res.failures.items():
        print(f"  {name}: {msg}")
    return 1 if res.failures else 0


if __name__ == "__main__":
    sys.exit(main())
