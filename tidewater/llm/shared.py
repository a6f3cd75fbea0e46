"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import ensure_checkpoint_dir

SPACES = "\x20\t\n\x0b\x0c\r"  # what ends a word: 0x20 and 0x09-0x0D
SPACE_RUN = r"[\x20\x09-\x0D]+"


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage: what follows restarts from the written files when an
    executor is lost, and a result used twice is computed once. The folder
    belongs to the session's checkpoint folder and goes with it.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    """The cluster's own partition count, which its owner sizes to the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def within(df: DataFrame, rows: int) -> DataFrame:
    """Mark ``df`` for broadcast only if it was counted to have at most ``rows`` rows.

    Callers keep rows narrow (a few numbers), so the bound on rows is a bound
    on bytes; a larger table is left to a shuffle join.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def text_parts(batches: Iterable[pa.RecordBatch], most: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slice Arrow batches to about ``most`` bytes of their ``text`` column.

    Yields (rows, text bytes, row offsets). A null text counts as empty. A
    text larger than ``most`` makes a slice of its own.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        text = batch.column("text").cast(pa.large_string())
        offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        data = text.buffers()[2]
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        if text.null_count:
            lens = np.where(text.is_null().to_numpy(zero_copy_only=False), 0, np.diff(offsets))
            if lens.sum() != offsets[-1] - offsets[0]:  # nulls may hide bytes; make the texts dense
                text = text.fill_null("")
                text = pa.concat_arrays([text])
                offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
                data = text.buffers()[2]
                data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        i = 0
        while i < len(text):
            j = int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1
            j = min(max(j, i + 1), len(text))
            yield batch.slice(i, j - i), data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            i = j


def binary_column(rows: list[np.ndarray | bytes]) -> pa.Array:
    return pa.array([r if isinstance(r, bytes) else r.tobytes() for r in rows], pa.binary())


def starts_of(groups: np.ndarray) -> np.ndarray:
    """Start of each run of equal values, and the end of the last one."""
    if not len(groups):
        return np.zeros(1, np.int64)
    return np.concatenate(([0], np.flatnonzero(groups[1:] != groups[:-1]) + 1, [len(groups)]))
