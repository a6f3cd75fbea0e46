"""Names of raw layers and tables in the session catalog."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import SparkSession


def quoted(text: str) -> str:
    return "`" + text.replace("`", "``") + "`"


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _plain(text: str, stem: str) -> str:
    """``text`` if a catalog takes it as a name, else ``stem`` and a hash of it."""
    return text if re.fullmatch(r"[A-Za-z0-9_]+", text) else f"{stem}_{hashlib.sha256(text.encode()).hexdigest()[:16]}"


def schema_name(root: str) -> str:
    """The catalog schema of a raw layer: ``root`` itself, or a name that stands for the folder ``root``."""
    return _plain(root, "raw")


def table_name(name: str) -> str:
    """The catalog name of a raw table: the source's name in lower case, or one that stands for it if it has other characters."""
    return _plain(name, re.sub(r"\W+", "_", name)).lower()


def ensure_schema(spark: SparkSession, root: str) -> str:
    """Create the raw layer's schema if absent (idempotent)."""
    root = root.rstrip("/")
    name = schema_name(root)
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(name)}" + ("" if name == root else f" LOCATION {literal(root)}"))
    return name
