"""Repeated word windows across documents, by difference-cover anchors (operator 9).

Positions whose number modulo ``PERIOD`` lies in ``COVER`` carry an anchor, the
hash of the next ``size - PERIOD + 1`` words. COVER is a difference cover: any
two positions have a common shift below PERIOD that takes both into it. So two
equal windows of ``size`` words share an anchor, wherever they start in their
texts, while only 3 of 7 positions are hashed for the search.

Work goes by chunks, sets of documents chosen by a hash of doc_id; the texts are
shuffled once and every step reads that one exchange.

1. A chunk sends its distinct anchors, packed by hash bucket.
2. A bucket returns to each chunk the anchors that other chunks hold too.
3. A chunk extends each shared anchor to the windows around it and sends their
   distinct hashes with the smallest doc_id it has for each.
4. A bucket returns the smallest doc_id of all chunks for each window.
5. A chunk marks the words of windows that start in a smaller doc_id.

A hash that fills a third of all rows leaves a chunk once, so a bucket gets it
at most once per chunk. There are four chunks and one bucket to each of the
cluster's shuffle partitions, so packed rows are few and large: as many as a
shuffle has blocks, times four. Window hashes have 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.shared import binary_column, shuffle_partitions, text_parts
from tidewater.llm.words import windows, word_hashes

PERIOD, COVER = 7, (0, 1, 3)  # fixed values: differences of 0, 1, 3 modulo 7 give every residue
NO_DOC = np.iinfo(np.int64).max


def _load(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, words per row, doc_id per row) of a chunk; a null doc_id is larger than all others."""
    hashes, counts = [], []
    for _, data, offsets in text_parts(rows.select(["text"]).to_batches()):
        h, c = word_hashes(data, offsets)
        hashes.append(h)
        counts.append(c)
    ids = rows.column("doc_id").to_numpy(zero_copy_only=False) if not rows.column("doc_id").null_count else rows.column("doc_id").fill_null(NO_DOC).to_numpy()
    return np.concatenate([np.zeros(0, np.uint64), *hashes]), np.concatenate([np.zeros(0, np.int64), *counts]), ids.astype(np.int64)


def _anchors(hashes: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, word) of the anchors at cover positions of each row."""
    keys, rows, at = windows(hashes, counts, size - PERIOD + 1)
    first = np.concatenate(([0], np.cumsum(counts)))[rows]
    own = np.isin((at - first) % PERIOD, COVER)
    return keys[own], rows[own], at[own]


def _several(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys with their smallest and largest doc_id."""
    if not len(keys):
        return keys, ids, ids
    order = np.argsort(keys, kind="stable")
    k, d = keys[order], ids[order]
    at = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    return k[at], np.minimum.reduceat(d, at), np.maximum.reduceat(d, at)


def _by_bucket(chunk: int, buckets: int, keys: np.ndarray, *others: np.ndarray) -> pa.Table:
    """A row per bucket: the keys in it (and their companions) as packed bytes."""
    b = (keys >> np.uint64(33)) % np.uint64(buckets)
    order = np.argsort(b, kind="stable")
    bounds = np.searchsorted(b[order], np.arange(buckets + 1, dtype=np.uint64))
    full = np.flatnonzero(np.diff(bounds))
    cols = [[x[order[bounds[i] : bounds[i + 1]]] for i in full] for x in (keys, *others)]
    return pa.table(
        [pa.array(np.full(len(full), chunk, np.int32)), pa.array(full.astype(np.int32)), *(binary_column(c) for c in cols)],
        ["chunk", "bucket", *(f"v{i}" for i in range(len(cols)))],
    )


def _unpack(rows: pa.Table, name: str, kind) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *(np.frombuffer(x.as_buffer(), kind) for x in rows.column(name))])


def _unpack_by_chunk(rows: pa.Table, *cols: tuple[str, type]) -> tuple[np.ndarray, list[np.ndarray]]:
    out = [_unpack(rows, c, kind) for c, kind in cols]
    lens = [len(x.as_buffer()) // 8 for x in rows.column(cols[0][0])]
    return np.repeat(rows.column("chunk").to_numpy(), lens), out


def _candidates(hashes, counts, ids, shared: np.ndarray, size: int):
    """(hash, row, word) of the windows around an anchor that stands in two documents."""
    keys, rows, at = _anchors(hashes, counts, size)
    own, lo, hi = _several(keys, ids[rows])
    flagged = at[np.isin(keys, np.union1d(shared, own[lo != hi]))]
    near = np.zeros(len(hashes) + 1, np.int64)  # running count of the windows that an anchor opens
    np.add.at(near, np.maximum(flagged - (PERIOD - 1), 0), 1)
    np.add.at(near, flagged + 1, -1)
    wk, wr, wa = windows(hashes, counts, size)
    sel = np.cumsum(near)[wa] > 0
    return wk[sel], wr[sel], wa[sel]


def remove_repeats(docs: DataFrame, size: int = 13) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, kept_text.

    A word goes if a window of ``size`` words over it also starts, word for
    word, in a document with a smaller doc_id; windows are those of the input.
    kept_text joins the kept words by one space. A null or empty text has no
    words. Rows that share a doc_id do not count against each other; a row
    with a null doc_id counts as larger than all others. Other columns are not
    read. An empty table gives an empty result.
    """
    if size < PERIOD:
        raise ValueError(f"size must be at least {PERIOD}")
    n = shuffle_partitions(docs.sparkSession)
    chunks, buckets = 4 * n, n
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    docs = docs.withColumn("chunk", F.pmod(F.xxhash64(F.col("doc_id"), F.when(F.col("doc_id").isNull(), F.xxhash64("text"))), F.lit(chunks)).cast("int"))
    docs = docs.repartition(n, "chunk")

    def send_anchors(rows: pa.Table) -> pa.Table:
        hashes, counts, _ = _load(rows)
        return _by_bucket(rows.column("chunk")[0].as_py(), buckets, np.unique(_anchors(hashes, counts, size)[0]))

    def shared_anchors(rows: pa.Table) -> pa.Table:
        chunk, (keys,) = _unpack_by_chunk(rows, ("v0", np.uint64))
        order = np.argsort(keys, kind="stable")
        k = keys[order]
        again = np.zeros(len(k), bool)
        again[1:] = k[1:] == k[:-1]
        again[:-1] |= again[1:]
        order = order[again]
        return _by_chunk(chunk[order], keys[order])

    def send_windows(rows: pa.Table, shared: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return _by_bucket(0, buckets, *(np.zeros(0, kind) for kind in (np.uint64, np.int64, np.int64)))
        hashes, counts, ids = _load(rows)
        keys, r, _ = _candidates(hashes, counts, ids, _unpack(shared, "v0", np.uint64), size)
        # the largest doc_id says whether the chunk itself has a later document for the window
        return _by_bucket(rows.column("chunk")[0].as_py(), buckets, *_several(keys, ids[r]))

    def first_docs(rows: pa.Table) -> pa.Table:
        chunk, (keys, low, high) = _unpack_by_chunk(rows, ("v0", np.uint64), ("v1", np.int64), ("v2", np.int64))
        order = np.argsort(keys, kind="stable")
        k = keys[order]
        at = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
        first = np.repeat(np.minimum.reduceat(low[order], at), np.diff(np.append(at, len(k))))
        later = high[order] > first
        return _by_chunk(chunk[order][later], k[later], first[later])

    def clean(rows: pa.Table, firsts: pa.Table) -> pa.Table:
        n_words, n_removed, kept, doc_ids = [], [], [], []
        if rows.num_rows:
            hashes, counts, ids = _load(rows)
            keys, first = _unpack(firsts, "v0", np.uint64), _unpack(firsts, "v1", np.int64)
            order = np.argsort(keys)
            keys, first = keys[order], first[order]
            wk, wr, wa = windows(hashes, counts, size)
            i = np.searchsorted(keys, wk)
            hit = np.zeros(len(wk), bool)
            if len(keys):
                i[i == len(keys)] = 0
                hit = (keys[i] == wk) & (first[i] < ids[wr])
            gone = np.zeros(len(hashes) + 1, np.int64)
            np.add.at(gone, wa[hit], 1)
            np.add.at(gone, wa[hit] + size, -1)
            gone = np.cumsum(gone)[:-1] > 0
            bounds = np.concatenate(([0], np.cumsum(counts)))
            removed = np.add.reduceat(np.append(gone, False).astype(np.int64), bounds[:-1]) * (counts > 0)
            doc_ids, n_words, n_removed = rows.column("doc_id").combine_chunks(), counts, removed
            for text, a, b, cut in zip(rows.column("text"), bounds[:-1], bounds[1:], removed, strict=True):
                words = (text.as_py() or "").encode().split()  # bytes.split() splits at 0x20 and 0x09-0x0D
                if cut:
                    words = [w for w, g in zip(words, gone[a:b].tolist(), strict=True) if not g]
                kept.append(b" ".join(words).decode())
        return pa.table([pa.array(doc_ids, pa.int64()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept_text"])

    anchors = docs.groupBy("chunk").applyInArrow(send_anchors, "chunk int, bucket int, v0 binary")
    shared = anchors.repartition(n, "bucket").groupBy("bucket").applyInArrow(shared_anchors, "chunk int, v0 binary")
    wins = docs.groupBy("chunk").cogroup(shared.repartition(n, "chunk").groupBy("chunk")).applyInArrow(send_windows, "chunk int, bucket int, v0 binary, v1 binary, v2 binary")
    firsts = wins.repartition(n, "bucket").groupBy("bucket").applyInArrow(first_docs, "chunk int, v0 binary, v1 binary")
    return docs.groupBy("chunk").cogroup(firsts.repartition(n, "chunk").groupBy("chunk")).applyInArrow(clean, "doc_id long, n_words long, n_removed long, kept_text string")


def _by_chunk(chunk: np.ndarray, *values: np.ndarray) -> pa.Table:
    order = np.argsort(chunk, kind="stable")
    c = chunk[order]
    at = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1]))) if len(c) else np.zeros(0, np.int64)
    parts = [np.split(v[order], at[1:]) if len(c) else [] for v in values]
    return pa.table([pa.array(c[at].astype(np.int32)), *(binary_column(p) for p in parts)], ["chunk", *(f"v{i}" for i in range(len(values)))])


