"""Source readers (S1, S2): name -> DataFrame, so the run drivers stay
independent of where the source lives.

Column pruning and the mark predicate are added later by the load plan and
reach the scan on their own (Parquet ``PushedFilters``, JDBC ``WHERE``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.typemap import SourceColumn
from tidewater.operators.windows import Window

# The reference moves 10,000 rows per fetch and per insert.
FETCH_SIZE = 10000
BATCH_SIZE = 10000

SourceReader = Callable[[str], DataFrame]


def parquet_source(spark: SparkSession, base: str, suffix: str = ".parquet") -> SourceReader:
    """Tables stored as ``{base}/{name}{suffix}`` (files or directories)."""
    base = base.rstrip("/")
    return lambda name: spark.read.parquet(f"{base}/{name}{suffix}")


def catalog_source(spark: SparkSession, database: str | None = None) -> SourceReader:
    """Tables or views of the session catalog; a view is read the same way."""
    return lambda name: spark.table(f"{database}.{name}" if database else name)


@dataclass(frozen=True)
class JdbcSplit:
    """A numeric column that splits one JDBC read into parallel range reads."""

    column: str
    lower: int
    upper: int
    partitions: int


class JdbcSource:
    """S1/S2 over JDBC: one relation per name, fetched ``FETCH_SIZE`` rows at a
    time. A table listed in ``splits`` is read by ``partitions`` tasks in
    parallel ranges of its split column instead of one cursor.

    ``lines_in`` pushes a header-driven semi-join into the source database as
    ``doc IN (SELECT key FROM header WHERE <mark predicate>)``: Spark does not
    push a join into a JDBC scan, so without it every line would cross the
    network on every run.
    """

    def __init__(self, spark: SparkSession, url: str, schema: str | None = None,
                 options: dict[str, str] | None = None, splits: dict[str, JdbcSplit] | None = None,
                 quote: str = '"', columns_query: str | None = None):
        self.columns_query = columns_query
        self.spark, self.url, self.schema, self.quote = spark, url, schema, quote
        self.options = dict(options or {})
        self.splits = dict(splits or {})

    def ident(self, name: str) -> str:
        q = self.quote
        return f"{q}{name.replace(q, q + q)}{q}"

    def relation(self, name: str) -> str:
        return f"{self.ident(self.schema)}.{self.ident(name)}" if self.schema else self.ident(name)

    def _reader(self, dbtable: str, split: JdbcSplit | None):
        r = (self.spark.read.format("jdbc").option("url", self.url)
             .option("dbtable", dbtable).option("fetchsize", FETCH_SIZE))
        for k, v in self.options.items():
            r = r.option(k, v)
        if split is not None:
            r = (r.option("partitionColumn", split.column).option("lowerBound", split.lower)
                 .option("upperBound", split.upper).option("numPartitions", split.partitions))
        return r

    def __call__(self, name: str) -> DataFrame:
        return self._reader(self.relation(name), self.splits.get(name)).load()

    def columns_of(self, name: str) -> list[SourceColumn]:
        """A table's rows of the source catalog, for the type map; none without a ``columns_query``.

        The query gives table, column, type, length, scale and position, in
        that order, under any names. A table has few columns, so the rows are
        bounded.
        """
        if not self.columns_query:
            return []
        rows = self._reader(f"({self.columns_query}) columns_of", None).load().toDF("t", "name", "type", "length", "scale", "position")
        number = lambda v: None if v is None else int(v)
        found = rows.where(F.upper("t") == name.upper()).collect()
        return [SourceColumn(r["name"], r["type"], number(r["length"]), number(r["scale"]), number(r["position"])) for r in found]

    def read_windows(self, name: str, col: str, windows: list[Window]) -> DataFrame:
        """A history read split one task per window (JDBC ``predicates``): all
        windows are fetched in parallel in one job."""
        props = {"fetchsize": str(FETCH_SIZE), **{k: str(v) for k, v in self.options.items()}}
        preds = window_predicates(col, windows, self.quote)
        return self.spark.read.jdbc(self.url, self.relation(name), predicates=preds, properties=props)

    def read_split(self, name: str, column: str, parts: int) -> DataFrame:
        """A whole read in parts of like size: the source's own percentiles of ``column`` decide the predicates."""
        props = {"fetchsize": str(FETCH_SIZE), **{k: str(v) for k, v in self.options.items()}}
        preds = split_predicates(self._reader(self.relation(name), None).load().select(column), column, parts, self.quote)
        return self.spark.read.jdbc(self.url, self.relation(name), predicates=preds, properties=props)

    def lines_in(self, name: str, doc_key: str, header: str, header_key: str, header_where: str) -> DataFrame:
        """Lines whose document id is among the headers matching ``header_where``."""
        sub = (
            f"SELECT * FROM {self.relation(name)} WHERE {self.ident(doc_key)} IN "
            f"(SELECT {self.ident(header_key)} FROM {self.relation(header)} WHERE {header_where})"
        )
        return self._reader(f"({sub}) lines_in", self.splits.get(name)).load()


def jdbc_source(
    spark: SparkSession,
    url: str,
    schema: str | None = None,
    options: dict[str, str] | None = None,
    splits: dict[str, JdbcSplit] | None = None,
    quote: str = '"',
    columns_query: str | None = None,
) -> JdbcSource:
    """A :class:`JdbcSource` (callable as ``name -> DataFrame``)."""
    return JdbcSource(spark, url, schema, options, splits, quote, columns_query)


def window_predicates(col: str, windows: list[Window], quote: str = '"') -> list[str]:
    """One JDBC predicate per history window, for
    ``spark.read.jdbc(url, table, predicates=...)``: every window becomes its
    own task, all windows read in parallel in one job."""
    c = f"{quote}{col}{quote}"
    return [f"{c} >= '{w.start.isoformat()}' AND {c} <= '{w.end.isoformat()}'" for w in windows]


def split_predicates(df: DataFrame, column: str, parts: int, quote: str = '"', accuracy: int = 10_000) -> list[str]:
    """Predicates that split a read by ``column`` into up to ``parts`` parts of like size.

    The bounds are percentiles of the column (one aggregate, a bounded sketch per
    task), so a skewed column gives narrow ranges where its rows are. Every
    row satisfies exactly one predicate: NULL and what is below the first bound
    the first, what is at or above the last bound the last. A value with more
    rows than a part has is a part of its own. Bounds are numbers, days or
    timestamps, written as SQL literals.
    """
    kind = next(f.dataType for f in df.schema.fields if f.name.upper() == column.upper())
    shares = [i / parts for i in range(1, parts)]
    sketch = F.percentile_approx(F.col(column), shares, accuracy)
    found = df.agg(F.transform(sketch, lambda v: v.cast("string")).alias("b")).first()["b"] or []
    prefix = {"DateType": "DATE ", "TimestampType": "TIMESTAMP ", "TimestampNTZType": "TIMESTAMP "}.get(type(kind).__name__)
    text = (lambda v: f"{prefix}'{v}'") if prefix else str
    c, bounds = f"{quote}{column}{quote}", list(dict.fromkeys(found))
    if not bounds:
        return ["1 = 1"]
    inner = [f"{c} >= {text(a)} AND {c} < {text(b)}" for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return [f"({c} IS NULL OR {c} < {text(bounds[0])})", *(f"({p})" for p in inner), f"({c} >= {text(bounds[-1])})"]


def jdbc_append(df: DataFrame, url: str, table: str, options: dict[str, str] | None = None) -> None:
    """Append into a JDBC target in ``BATCH_SIZE``-row batches (S3 over JDBC)."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", BATCH_SIZE)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.mode("append").save()
