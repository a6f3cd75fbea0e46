"""The raw table: a Parquet table of the session catalog, published by Spark's own writer.

A raw layer is a schema of the catalog, a raw table one of its tables,
partitioned so that a load rewrites only what it touches:

* ``append``     -> ``INSERT INTO``;
* ``overwrite``  -> ``INSERT OVERWRITE`` of the whole table;
* ``keyed``      -> the batch is staged once under the shared
                    ``spark.checkpoint.dir``; the hash buckets it touches are
                    read and overwritten, the keyed delete being an anti-join
                    against the staged keys, broadcast when their measured
                    bytes allow;
* ``predicate``  -> the periods that the delete can reach are overwritten; the
                    catalog lists them, nothing is scanned or staged for it.

Partitions are overwritten dynamically (an option of the table, whatever the
session says): Spark writes all files to a staging folder and puts the
partitions in place when the job commits. A job that fails before changes
nothing. The commit itself goes partition by partition: a driver lost during
it leaves some partitions new and some old, and the load is to be run again.
A table without partitions is emptied before it is overwritten. One writer per
table at a time.

The catalog should outlive the session (a metastore). Where it does not, a layer
that is named by its folder finds its tables again: ``create_if_missing``
and ``adopt`` register a table over the files that are there.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.predicates import INGEST_COL
from tidewater.operators.common import WINDOW_COL, LoadPlan, delete_by_key
from tidewater.operators.schema import align_to, missing_columns
from tidewater.session import ensure_checkpoint_dir
from tidewater.sources.layout import BUCKET_COL, DAY_COL, Layout
from tidewater.sources.names import ensure_schema, literal, quoted, schema_name, table_name

LAYOUT = "tidewater.layout"  # the table property that holds it
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024
_NEW = "__new"


class RawTable:
    """The raw table ``name`` of the layer ``root`` (a schema's name or a folder)."""

    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark, self.root, self.name = spark, root.rstrip("/"), name
        self.table = f"{quoted(schema_name(self.root))}.{quoted(table_name(name))}"
        self.broadcast_bytes = DEFAULT_BROADCAST_BYTES
        self.last_write: DataFrame | None = None  # for plan inspection (explain)
        self.window_rows: dict[int, int] = {}  # rows per history window of the last publish
        self._staged: list[str] = []
        self._layout: Layout | None = None

    # -- catalog ------------------------------------------------------------
    def exists(self) -> bool:
        return self.spark.catalog.databaseExists(schema_name(self.root)) and self.spark.catalog.tableExists(self.table)

    def create_if_missing(self, data_schema: T.StructType, layout: Layout | None = None) -> bool:
        """Create with every column nullable plus ``_ingested_at``; leave an
        existing table alone. Returns True when created."""
        layout = layout or Layout()
        if self.exists() or self.adopt(layout):
            return False
        fields = [f for f in data_schema.fields if f.name != INGEST_COL]
        self._create([*fields, T.StructField(INGEST_COL, T.TimestampNTZType())], layout)
        return True

    def adopt(self, layout: Layout) -> bool:
        """Register the files of a layer named by its folder, which a catalog of this session does not know yet."""
        if self.exists() or schema_name(self.root) == self.root:
            return False
        path = f"{self.root}/{table_name(self.name)}"
        try:
            found = self.spark.read.option("mergeSchema", "true").parquet(path).schema
        except AnalysisException:  # no folder, or no file in it
            return False
        self._create([f for f in found.fields if f.name != layout.column], layout, path)
        if layout.column:
            self.spark.sql(f"ALTER TABLE {self.table} RECOVER PARTITIONS")
        return True

    def _create(self, fields: list[T.StructField], layout: Layout, path: str | None = None) -> None:
        ensure_schema(self.spark, self.root)
        kind = {BUCKET_COL: "INT", DAY_COL: "DATE"}
        columns = [f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fields]
        columns += [f"{c} {kind[c]}" for c in [layout.column] if c]
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({', '.join(columns)}) USING parquet OPTIONS (partitionOverwriteMode 'dynamic')"
            + (f" PARTITIONED BY ({layout.column})" if layout.column else "")
            + (f" LOCATION {literal(path)}" if path else "")
            + f" TBLPROPERTIES ('{LAYOUT}' = {literal(json.dumps(asdict(layout)))})"
        )

    def add_missing_columns(self, source_schema: T.StructType) -> list[str]:
        """Add source columns missing here (case-insensitive); old rows read
        them as NULL. No data file is rewritten."""
        extra = missing_columns(self.schema, source_schema)
        if extra:
            columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in extra)
            self.spark.sql(f"ALTER TABLE {self.table} ADD COLUMNS ({columns})")
        return [f.name for f in extra]

    @property
    def layout(self) -> Layout:
        if self._layout is None:
            row = self.spark.sql(f"SHOW TBLPROPERTIES {self.table} ('{LAYOUT}')").first()
            self._layout = Layout(**json.loads(row["value"]))
        return self._layout

    @property
    def schema(self) -> T.StructType:
        """Data columns, ``_ingested_at`` last, without the partition column."""
        fields = [f for f in self.spark.table(self.table).schema.fields if f.name not in (BUCKET_COL, DAY_COL)]
        return T.StructType(sorted(fields, key=lambda f: f.name == INGEST_COL))

    def described(self, key: str) -> str:
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.table}").where(F.col("col_name") == key)
        return rows.collect()[-1]["data_type"]  # columns of that name come first

    def partitions(self) -> list:
        """Partition values that the catalog lists, ordered; None is the period of rows without a day."""
        col = self.layout.column
        if not col:
            return []
        texts = (r["partition"].split("=", 1)[1] for r in self.spark.sql(f"SHOW PARTITIONS {self.table}").collect())
        value = int if col == BUCKET_COL else date.fromisoformat
        found = [None if t in ("__HIVE_DEFAULT_PARTITION__", "null") else value(t) for t in texts]
        return sorted(found, key=lambda v: (v is not None, v))

    # -- reading ------------------------------------------------------------
    def read(self, with_partition: bool = False) -> DataFrame:
        """The table as it is now, also where another session wrote it; filters on its partition column prune folders."""
        col = self.layout.column
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table).select(*self.schema.names, *([col] if with_partition and col else []))

    def by_footers(self, partition: int | date | None = None) -> DataFrame:
        """The rows (of one partition) by Spark's V2 Parquet reader, which answers MIN, MAX and COUNT from the files' footers."""
        base = self.described("Location")
        path = base if partition is None else f"{base}/{self.layout.column}={partition}"  # no other folder is listed
        session = self.spark.newSession()
        session.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
        session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        return session.read.schema(self.spark.table(self.table).schema).option("basePath", base).parquet(path)

    # -- writing ------------------------------------------------------------
    def publish(self, plan: LoadPlan) -> int:
        """Apply a load plan to the table; return the rows inserted."""
        layout, schema = self.layout, self.schema
        col, self.window_rows = layout.column, dict.fromkeys(plan.windows, 0)
        batch = self._conform(plan.batch, schema)
        batch = batch.withColumn(col, layout.value(schema)) if col else batch
        counts = self._counts(plan)
        try:
            got = self._apply(plan, batch, layout, counts)
        finally:
            for path in self._staged:
                self._delete(path)
            self._staged.clear()
        self.window_rows = {w: int(got.get(f"w{w}") or 0) for w in plan.windows}
        return int(got.get("rows") or 0)

    def _apply(self, plan: LoadPlan, batch: DataFrame, layout: Layout, counts: list[Column]) -> dict:
        col, there = layout.column, self.partitions()
        if plan.kind == "append" or plan.kind != "overwrite" and not (there if col else self.read().take(1)):
            return self._insert(batch, counts)
        if plan.kind == "overwrite":
            return self._insert(batch, counts, there)
        same_keys = [k.upper() for k in plan.delete_keys] == [k.upper() for k in layout.keys]
        if plan.kind == "keyed" and layout.kind == "bucket" and same_keys:
            return self._replace_keys(plan, batch, layout, counts)
        current = self.read(with_partition=True)
        reach = there
        if plan.kind == "predicate" and layout.kind == "day" and plan.delete_days and plan.delete_days[0].upper() == layout.day_col.upper():
            lo, hi = map(layout.period, plan.delete_days[1:])
            reach = [p for p in there if p is not None and lo <= p <= hi]
            current = current.where(F.col(DAY_COL).isin(reach))
        if plan.kind == "predicate":
            kept = current.where(~plan.delete_pred)
        else:
            kept = delete_by_key(current, align_to(self.schema, plan.delete_ids if plan.delete_ids is not None else plan.batch), plan.delete_keys)
        if WINDOW_COL in batch.columns:
            kept = kept.withColumn(WINDOW_COL, F.lit(None).cast("int"))
        new = kept.withColumn(_NEW, F.lit(False)).unionByName(batch.withColumn(_NEW, F.lit(True)))
        if not col:  # the table is emptied before it is written, so its rows must not be read from it
            new = self.staged(new)
        return self._insert(new, self._counts(plan, F.col(_NEW)), reach)

    def _replace_keys(self, plan: LoadPlan, batch: DataFrame, layout: Layout, counts: list[Column]) -> dict:
        """Overwrite the buckets that the batch's or the deleted keys touch."""
        key_bytes = sum((F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in layout.keys), F.lit(32))
        facts = [F.collect_set(BUCKET_COL).alias("parts"), F.sum(key_bytes.cast("long")).alias("key_bytes")]  # a value per bucket at most
        staged, got = self._stage(batch, [*counts, *facts])
        ids, seen = staged, got
        if plan.delete_ids is not None:  # other keys than the batch's, or keys that repeat in it: once each
            ids = staged if plan.delete_ids is plan.batch else align_to(self.schema, plan.delete_ids)
            ids, seen = self._stage(ids.select(*layout.keys).distinct().withColumn(BUCKET_COL, layout.value(self.schema)), facts)
        touched = sorted({*(got.get("parts") or []), *(seen.get("parts") or [])})
        scope = self.read(with_partition=True).where(F.col(BUCKET_COL).isin(touched))
        small = int(seen.get("key_bytes") or 0) <= self.broadcast_bytes
        kept = delete_by_key(scope, ids, layout.keys, broadcast=small or None)
        self._insert(kept.unionByName(staged.drop(WINDOW_COL)), [], touched)
        return got

    def _counts(self, plan: LoadPlan, new: Column | None = None) -> list[Column]:
        """A2: rows of the batch (those that are ``new``, where others go along), and of each of its history windows."""
        rows = F.lit(1) if new is None else F.when(new, 1)
        return [F.count(rows).alias("rows"), *(F.count(F.when(F.col(WINDOW_COL) == w, 1)).alias(f"w{w}") for w in plan.windows)]

    def _insert(self, df: DataFrame, counts: list[Column], replaced: list | None = None) -> dict:
        """S3: insert ``df``, counted on the way; with ``replaced`` over the partitions named there.

        Rows are rebalanced by partition: AQE cuts the output into few files a
        partition and splits a hot one.
        """
        col = self.layout.column
        parts = [F.collect_set(col).alias("parts"), F.count(F.when(F.col(col).isNull(), 1)).alias("nulls")] if col and replaced else []
        metrics = [*counts, *parts]
        observed = Observation(f"write_{uuid.uuid4().hex[:8]}")
        out = df.hint("rebalance", col) if col else df
        out = out.observe(observed, *metrics) if metrics else out
        self.last_write = out.select(*self.spark.table(self.table).columns)
        self.last_write.write.insertInto(self.table, overwrite=replaced is not None)
        got = dict(observed.get) if metrics else {}
        if parts:
            written = {*(got.get("parts") or []), *([None] if got.get("nulls") else [])}
            self._drop([p for p in replaced if p not in written])
        return got

    def _drop(self, values: list) -> None:
        """Remove partitions that a load left without a row."""
        if not values:
            return
        col, columns = self.layout.column, self.spark.table(self.table).schema.fields
        spec = [f"PARTITION ({col} = {'NULL' if v is None else v if col == BUCKET_COL else f'DATE {literal(v.isoformat())}'})" for v in values]
        if self.described("Type") != "MANAGED":  # dropping would leave the files
            nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {quoted(f.name)}" for f in columns if f.name != col)
            for part in spec:
                self.spark.sql(f"INSERT OVERWRITE TABLE {self.table} {part} SELECT {nothing} WHERE false")
        self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS {', '.join(spec)}")

    def truncate(self) -> None:
        """Empty the table."""
        if self.layout.column:
            self._drop(self.partitions())
        else:
            self.spark.createDataFrame([], self.spark.table(self.table).schema).write.insertInto(self.table, overwrite=True)

    @staticmethod
    def _conform(df: DataFrame, schema: T.StructType) -> DataFrame:
        """Batch columns in the table's spelling and types, and the window number if there is one."""
        df = align_to(schema, df)
        cells = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
        return df.select(*cells, *(c for c in df.columns if c == WINDOW_COL))

    def staged(self, df: DataFrame) -> DataFrame:
        """``df`` written to the shared checkpoint folder and read again, until the next publish ends."""
        path = f"{ensure_checkpoint_dir(self.spark)}/tidewater-stage/{table_name(self.name)}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        self._staged.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _stage(self, df: DataFrame, metrics: list[Column]) -> tuple[DataFrame, dict]:
        """``df`` staged once, and what was observed on the way."""
        observed = Observation(f"stage_{uuid.uuid4().hex[:8]}")
        return self.staged(df.observe(observed, *metrics)), dict(observed.get)

    def _delete(self, path: str) -> None:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
