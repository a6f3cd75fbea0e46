"""Benchmark items inside documents: MinHash containment search by size classes (operator 5).

An item's set is its distinct shingles of five lower-cased words; an item of
fewer words is one shingle, and documents are probed with windows of that
length too. Items are partitioned by set size into classes (powers of two). An item's sketch is its
k smallest hash values, with k set by its own size: a document that holds at
least ``percent`` of n shingles lacks at most n - ceil(n * percent / 100), so
one more minimum than that is sure to include a shared one. Short items thus
keep a larger share of their values than a fixed-size sketch would, and a
long document needs no sketch, as only its values that some sketch holds leave
the scan. Candidates are then confirmed on the words themselves.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.shared import binary_column, staged, text_parts, within
from tidewater.llm.words import shingle_sets, windows, word_hashes

FILTER_BITS = 1 << 22  # at least; sixteen bits per sketch value, up to MOST_BITS
MOST_BITS = 1 << 29


def _sketches(items: DataFrame, percent: int, words: int) -> DataFrame:
    """item_id, n (set size), size_class, v (one sketch value per row)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_parts(batches):
            sets = shingle_sets(*word_hashes(data, offsets, lower=True), words)
            depth = [len(s) - (len(s) * percent + 99) // 100 + 1 if len(s) else 0 for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(rows.column("item_id").to_numpy(zero_copy_only=False), depth), pa.int64()),
                    pa.array(np.repeat([len(s) for s in sets], depth), pa.int64()),
                    pa.array(np.concatenate([np.zeros(0, np.uint64), *(s[:k] for s, k in zip(sets, depth, strict=True))]).view(np.int64)),
                ],
                ["item_id", "n", "v"],
            )

    out = items.select("item_id", "text").where("item_id is not null").mapInArrow(run, "item_id long, n long, v long")
    return out.withColumn("size_class", F.floor(F.log2("n")).cast("int")).dropDuplicates(["item_id", "n", "v"])


def _bit_filter(values: DataFrame) -> tuple[np.ndarray, int]:
    """A bit per sketch value, by its top bits. Its size is bounded by MOST_BITS (64 MB), whatever the benchmark's."""
    n = values.count()
    bits = min(MOST_BITS, max(FILTER_BITS, 1 << (16 * n).bit_length()))
    shift = 64 - (bits.bit_length() - 1)
    slot = F.expr(f"shiftrightunsigned(v, {shift})")
    cells = values.groupBy((slot / 63).cast("long").alias("cell")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(v, {shift}) % 63 as int))")).alias("set"))
    out = np.zeros(bits // 63 + 1, np.int64)
    for row in cells.toLocalIterator():
        out[row["cell"]] = row["set"]
    return out, shift


def leaks(docs: DataFrame, items: DataFrame, percent: int = 80, words: int = 5) -> DataFrame:
    """Pairs (doc_id, item_id) with 100 * |item and document| >= percent * |item|.

    Columns: doc_id, item_id, n_item (shingles of the item), n_shared. A null
    or empty text, and a null id, match nothing. An item of fewer than ``words``
    words is one shingle, its whole sequence, which is looked for anywhere in a
    document. Rows that repeat an id count once per pair, with the text that
    shares most. Other columns are not read. Without documents or items the result
    is empty.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    sketches = staged(_sketches(items, percent, words))
    bits, shift = _bit_filter(sketches)
    cast = docs.sparkSession.sparkContext.broadcast(bits)  # bounded by MOST_BITS
    exact = staged(_exact_shingles(items.where("item_id is not null"), "item_id", words))
    lengths = [words, *sorted(r["length"] for r in exact.where(F.col("length") < words).select("length").distinct().collect())]  # ``words`` at most

    def probe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_parts(batches):
            keys, at, sizes = _probe_sets(*word_hashes(data, offsets, lower=True), lengths)
            slot = (keys >> np.uint64(shift)).astype(np.int64)
            own = (cast.value[slot // 63] >> (slot % 63)) & 1 == 1
            ids = rows.column("doc_id").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(ids[at[own]]), pa.array(sizes[at[own]]), pa.array(keys[own].view(np.int64))], ["doc_id", "n_windows", "v"])

    hits = docs.mapInArrow(probe, "doc_id long, n_windows long, v long")
    # a class's items need at least that share of its smallest size from the document
    fits = F.col("n_windows") * 100 >= F.pow(F.lit(2), "size_class") * percent
    pairs = staged(hits.join(sketches, "v").where(fits).select("doc_id", "item_id").distinct())

    # exact shingle containment on the words: rows (document, item, shingle), counted per pair
    found = docs.join(within(pairs.select("doc_id").distinct(), 2_000_000), "doc_id", "left_semi")
    have = _document_shingles(found.withColumn("row", F.monotonically_increasing_id()), lengths)
    sizes = exact.groupBy("item_id").agg(F.count("*").alias("n_item"))
    wanted = pairs.join(exact.select("item_id", "shingle"), "item_id")
    shared = staged(have).join(wanted, ["doc_id", "shingle"]).groupBy("row", "doc_id", "item_id").agg(F.count("*").alias("n_shared"))
    out = shared.join(sizes, "item_id").where(F.col("n_shared") * 100 >= F.col("n_item") * percent)
    return out.groupBy("doc_id", "item_id").agg(F.max("n_item").alias("n_item"), F.max("n_shared").alias("n_shared"))


def _probe_sets(hashes: np.ndarray, counts: np.ndarray, lengths: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row) of every shingle of each of ``lengths`` words, and each row's number of those of the first, the longest, one at least.

    Short shingles repeat often in a text and are given once a row.
    """
    keys, rows, _ = windows(hashes, counts, lengths[0])
    for n in lengths[1:]:
        k, r, _ = windows(hashes, counts, n)
        order = np.lexsort((k, r))
        k, r = k[order], r[order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (r[1:] != r[:-1])
        keys, rows = np.concatenate((keys, k[new])), np.concatenate((rows, r[new]))
    return keys, rows, np.maximum(counts - lengths[0] + 1, 1)


_LOWER = bytes(range(256)).lower()


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_LOWER).split()  # A-Z to a-z; split() at 0x20 and 0x09-0x0D


def _shingles(w: list[bytes], length: int) -> set[bytes]:
    return {b" ".join(w[i : i + length]) for i in range(len(w) - length + 1)}


def _document_shingles(rows: DataFrame, lengths: list[int]) -> DataFrame:
    """row, doc_id and each distinct shingle of the text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                sets = [set().union(*(_shingles(w, n) for n in lengths)) for w in map(_words, part.column("text").to_pylist())]
                at = pa.array(np.repeat(np.arange(len(sets)), [len(s) for s in sets]))
                yield pa.RecordBatch.from_arrays([part.column("row").take(at), part.column("doc_id").take(at), binary_column([x for s in sets for x in s])], ["row", "doc_id", "shingle"])

    return rows.select("row", "doc_id", "text").mapInArrow(run, "row long, doc_id long, shingle binary")


def _exact_shingles(items: DataFrame, key: str, words: int) -> DataFrame:
    """The key, each distinct shingle of its texts and the words in it: ``words``, or all of a shorter text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_words(t) for t in batch.column("text").to_pylist()]
            lengths = [min(words, len(w)) for w in texts]
            sets = [_shingles(w, n) if n else set() for w, n in zip(texts, lengths, strict=True)]
            sizes = [len(s) for s in sets]
            ids = np.repeat(batch.column(key).to_numpy(), sizes)
            cols = [pa.array(ids, pa.int64()), binary_column([x for s in sets for x in s]), pa.array(np.repeat(lengths, sizes), pa.int32())]
            yield pa.RecordBatch.from_arrays(cols, [key, "shingle", "length"])

    return items.select(key, "text").mapInArrow(run, f"{key} long, shingle binary, length int").dropDuplicates()
