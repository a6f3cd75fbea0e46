"""Near-duplicate classes by MinHash and an LSH forest (operator 3).

A document's set is its distinct shingles of five lower-cased words. Its
signature is read in several rotated orders; each order, sorted, is one tree
of the forest. Two texts whose signatures agree on the first ``DEPTH`` values
of an order stand in the same region of that tree; the depth is fixed, so a
large region is not split by further values.

1. Texts with equal sets are one class (one aggregate on a set fingerprint).
2. Neighbours in a few sorted orders are compared first. Where texts are dense
   their neighbours share a long prefix, where they are sparse a short one. Each
   region's members are also compared with its pivot, the text nearest to all.
   The links are joined to components.
3. In every region of every tree that still holds two components, texts of
   different components are compared. A region that one component fills (a
   large group of near copies) costs one aggregate and no pair. The texts of
   a region's main component are dealt into blocks, so no task holds a region.
   Pairs whose whole signatures differ too much for the bound are left out.
4. Every candidate is confirmed on the full sets.

Steps 2 and 3 leave out only pairs that already share a component, so the
components equal those of all pairs that share a region in some tree. At
similarity 0.85 a pair shares none with probability (1 - 0.85**4)**20 = 4e-7,
and its signatures differ too much with at most MISS.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.components import components
from tidewater.llm.shared import binary_column, shuffle_partitions, staged, starts_of, text_parts, within
from tidewater.llm.words import mix, shingle_sets, word_hashes

TREES, DEPTH, SEED_TREES = 20, 4, 3
BLOCK_ROWS, LOT_ROWS = 512, 4096  # rows of a region that a task holds and compares with them, about
_WIDTH = 2  # bytes kept of a minimum in the forest
MISS = 1e-5
MINIMA = 320  # of which one byte each is kept to compare whole signatures
_MULTIPLIERS = np.random.default_rng(7).integers(1, 1 << 63, MINIMA, np.uint64) * np.uint64(2) + np.uint64(1)


def _signature(keys: np.ndarray) -> tuple[bytes, bytes]:
    """(the forest's values, one byte of every minimum)."""
    least = np.full(MINIMA, np.iinfo(np.uint64).max)
    for i in range(0, len(keys), 512):
        np.minimum(least, (keys[i : i + 512, None] * _MULTIPLIERS).min(0), out=least)
    mixed = mix(least)
    return (mixed[: TREES * DEPTH] & np.uint64(0xFFFF)).astype(">u2").tobytes(), (mixed >> np.uint64(56)).astype(np.uint8).tobytes()


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, set fingerprint (f1, f2) and signatures (sig, fine) of every row of ``docs`` (doc_id, text)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_parts(batches):
            sets = shingle_sets(*word_hashes(data, offsets, lower=True), words)
            signed = [_signature(s) if len(s) else (b"", b"") for s in sets]
            prints = [(int(s.sum(dtype=np.uint64)), int(np.bitwise_xor.reduce(mix(s)) if len(s) else 0)) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    *(pa.array(np.array([p[k] for p in prints], np.uint64).view(np.int64)) for k in (0, 1)),
                    *(binary_column([s[k] for s in signed]) for k in (0, 1)),
                ],
                ["doc_id", "n_shingles", "f1", "f2", "sig", "fine"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, f1 long, f2 long, sig binary, fine binary")


def _orders(classes: DataFrame, trees: int) -> DataFrame:
    """A row per class and tree: region (the first DEPTH values) and label (twice as many)."""
    width = DEPTH * _WIDTH
    twice = F.concat("sig", "sig")
    rows = classes.select("id", "n_shingles", twice.alias("twice"), F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    label = F.col("twice").substr(F.col("tree") * width + 1, F.lit(2 * width))
    return rows.select("id", "n_shingles", "tree", label.alias("label"), F.xxhash64("tree", label.substr(1, width)).alias("region"))


def _neighbours(orders: DataFrame, percent: int) -> DataFrame:
    """Each class and the next one in the same region of a sorted order."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            ids, sizes, regions = (batch.column(c).to_numpy() for c in ("id", "n_shingles", "region"))
            if not len(ids):
                continue
            if last is not None:
                ids, sizes, regions = (np.concatenate((x, y)) for x, y in zip(last, (ids, sizes, regions), strict=True))
            last = [x[-1:].copy() for x in (ids, sizes, regions)]
            low, high = np.minimum(sizes[1:], sizes[:-1]), np.maximum(sizes[1:], sizes[:-1])
            at = np.flatnonzero((regions[1:] == regions[:-1]) & (low * 100 >= high * percent))
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(ids[at], ids[at + 1])), pa.array(np.maximum(ids[at], ids[at + 1]))], ["a", "b"])

    n = shuffle_partitions(orders.sparkSession)
    ranged = orders.repartitionByRange(n, "tree", "label", "id").sortWithinPartitions("tree", "label", "id")
    return ranged.select("id", "n_shingles", "region").mapInArrow(run, "a long, b long")


def _pivots(classes: DataFrame, percent: int) -> DataFrame:
    """Each class of a region and the region's pivot, the one most like all others, where their sizes fit.

    Copies that were each altered on their own are nearer to their origin than
    to each other, so one pass over the pivots joins most of a large group.
    Every block names its nearest to its most frequent values; the region's best of
    these is the pivot. A region is found by one aggregate and never gathered.
    """
    orders = _orders(classes, SEED_TREES)
    sizes = orders.groupBy("region").agg(F.count("*").alias("n")).where("n > 2")
    rows = staged(orders.join(sizes, "region").select("region", "id", "n_shingles", "n"))
    blocks = F.ceil(F.col("n") / BLOCK_ROWS).cast("int")
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int")).join(classes.select("id", "fine"), "id")

    def nearest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for region, ids, sizes, sig in _whole_groups(batches, ["region", "block"], ["region", "id", "n_shingles", "fine"]):
            sig = np.frombuffer(b"".join(sig.tolist()), np.uint8).reshape(len(ids), MINIMA)
            cells = sig.astype(np.int64) + 256 * np.arange(MINIMA)
            counts = np.bincount(cells.ravel(), minlength=256 * MINIMA).reshape(MINIMA, 256)
            likeness = (sig == counts.argmax(1)).mean(1)
            k = int(np.lexsort((-ids, likeness))[-1])
            yield pa.RecordBatch.from_arrays([pa.array(x[k : k + 1]) for x in (region, ids, sizes, likeness)], ["region", "pivot", "size", "likeness"])

    n = shuffle_partitions(classes.sparkSession)
    dealt = dealt.select("region", "block", "id", "n_shingles", "fine").repartition(n, "region", "block").sortWithinPartitions("region", "block")
    best = dealt.mapInArrow(nearest, "region long, pivot long, size long, likeness double")
    best = best.groupBy("region").agg(F.max(F.struct("likeness", -F.col("pivot"), "pivot", "size")).alias("p")).select("region", "p.pivot", "p.size")
    fits = F.least("n_shingles", "size") * 100 >= F.greatest("n_shingles", "size") * percent
    pairs = rows.join(best, "region").where(fits & (F.col("id") != F.col("pivot")))
    return pairs.select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b"))


def _across(classes: DataFrame, comps: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes of different components that share a region, whose sizes fit and whose signatures are alike enough."""
    orders = _orders(classes, TREES)
    least = _least_equal(percent)
    own = orders.select("id", "n_shingles", "tree", "region").join(comps, F.col("id") == F.col("node"), "left")
    own = own.select("id", "n_shingles", "tree", "region", F.coalesce("component", "id").alias("comp"))
    mixed = own.groupBy("region").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("region")
    rows = staged(own.join(mixed, "region"))
    # all texts are dealt into blocks; those outside the region's main component are, lot by lot, compared with every block
    parts = rows.groupBy("region", "comp").agg(F.count("*").alias("n"))
    main = parts.groupBy("region").agg(F.max_by("comp", F.struct("n", "comp")).alias("main"), F.sum("n").alias("n"), F.max("n").alias("n_main"))
    rows = rows.join(main, "region").join(classes.select("id", "sig", "fine"), "id").withColumn("blocks", F.ceil(F.col("n") / BLOCK_ROWS).cast("int"))
    rows = rows.withColumn("lots", F.greatest(F.lit(1), F.ceil((F.col("n") - F.col("n_main")) / LOT_ROWS)).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    lot = F.pmod(F.xxhash64("id", F.lit(1)), F.col("lots")).cast("int")
    dealt = rows.select("*", F.col("own").alias("block"), every("lots").alias("lot"), F.lit(True).alias("home")).unionByName(
        rows.where("comp <> main and blocks > 1")
        .select("*", every("blocks").alias("block"), lot.alias("lot"), F.lit(False).alias("home"))
        .where("block <> own")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sizes, comp, is_main, is_home, lot, tree, sig, fine in _whole_groups(batches, keys, cols):
            sig = np.frombuffer(b"".join(sig.tolist()), np.uint16).reshape(len(ids), TREES, DEPTH)
            fine = np.frombuffer(b"".join(fine.tolist()), np.uint8).reshape(len(ids), MINIMA)
            for i in range(0, len(ids), 256):
                x = slice(i, i + 256)
                # each pair once: in the block of the main component's text, or of the text with the larger id;
                # texts of one block meet in its first lot
                below = ids[x, None] < ids[None, :]
                other = (comp[x, None] != comp[None, :]) & is_home[None, :]
                other &= np.where(is_home[x, None], below & (lot[0] == 0), below | is_main[None, :])
                other &= np.minimum(sizes[x, None], sizes[None, :]) * 100 >= np.maximum(sizes[x, None], sizes[None, :]) * percent
                p, q = np.nonzero(other)
                keep = [np.zeros(0, bool)]
                for k in range(0, len(p), 4096):
                    a, b = i + p[k : k + 4096], q[k : k + 4096]
                    alike = (fine[a] == fine[b]).sum(1) >= least
                    first = (sig[a] == sig[b]).all(2).argmax(1)  # the pair is left to the first tree where it shares a region
                    keep.append(alike & (first == tree[0]))
                keep = np.concatenate(keep)
                a, b = ids[x][p[keep]], ids[q[keep]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    n = shuffle_partitions(orders.sparkSession)
    keys, cols = ["region", "block", "lot"], ["id", "n_shingles", "comp", "is_main", "home", "lot", "tree", "sig", "fine"]
    dealt = dealt.withColumn("is_main", F.col("comp") == F.col("main")).select("region", "block", *cols).repartition(n, *keys)
    return dealt.sortWithinPartitions(*keys).mapInArrow(run, "a long, b long")


def _least_equal(percent: int) -> int:
    """Equal minima that a signature pair must have to be checked on the full sets.

    The most that a pair at the bound reaches with probability 1 - MISS by the
    binomial tail; pairs above the bound reach it more surely.
    """
    n, p = MINIMA, percent / 100
    tail, k = 0.0, 0
    while k < n and (tail := tail + math.comb(n, k) * p**k * (1 - p) ** (n - k)) <= MISS:
        k += 1
    return k


def _whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str], cols: list[str]) -> Iterator[list[np.ndarray]]:
    """The columns of each run of equal keys, also of runs that go over batches."""
    kept = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = [batch.column(c).to_numpy(zero_copy_only=False) for c in [*keys, *cols]]
        if kept is not None:
            t = [np.concatenate(x) for x in zip(kept, t, strict=True)]
        key = np.zeros(len(t[0]), np.uint64)
        for part in t[: len(keys)]:
            key = mix(key + part.astype(np.int64).view(np.uint64))
        bounds = starts_of(key)
        for a, b in zip(bounds[:-2], bounds[1:-1], strict=True):
            yield [x[a:b] for x in t[len(keys) :]]
        kept = [x[bounds[-2] :] for x in t]
    if kept is not None:
        yield kept[len(keys) :]


def _confirmed(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= percent * union."""
    pairs = staged(pairs)
    need = pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct()

    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_parts(batches):
            keys = shingle_sets(*word_hashes(data, offsets, lower=True), words)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), binary_column(keys)], ["doc_id", "keys"])

    full = docs.select("doc_id", "text").join(within(need, 2_000_000), "doc_id", "left_semi")
    full = staged(full.mapInArrow(sets, "doc_id long, keys binary").dropDuplicates(["doc_id"]))

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("ka"), batch.column("kb"), strict=True):
                x, y = (np.frombuffer(k.as_buffer(), np.uint64) for k in (x, y))
                both = np.concatenate((x, y))
                both.sort(kind="stable")  # two sorted runs: a merge
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = pairs.join(full.select(F.col("doc_id").alias("a"), F.col("keys").alias("ka")), "a")
    two = one.join(full.select(F.col("doc_id").alias("b"), F.col("keys").alias("kb")), "b")
    return two.select("a", "b", "ka", "kb").mapInArrow(check, "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = 85, words: int = 5) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Two documents are linked if 100 * |A and B| >= percent * |A or B| on their
    shingle sets; component_id is the smallest doc_id reachable by links.
    Columns other than doc_id and text are not read. A null or empty text has
    no shingles and no link; fewer words than ``words`` are one shingle. Rows
    that repeat a doc_id share one answer. A null doc_id gets a null component
    and is kept. An empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sigs = staged(signatures(docs, words))
    full = sigs.where("n_shingles > 0 and doc_id is not null")
    classes = staged(full.groupBy("f1", "f2", "n_shingles", "sig", "fine").agg(F.min("doc_id").alias("id")))
    class_of = classes.select("f1", "f2", "n_shingles", "id")

    near = _neighbours(_orders(classes, SEED_TREES), percent).unionByName(_pivots(classes, percent)).distinct()
    seeds = _confirmed(near, docs, words, percent)
    first = components(seeds)
    rest = _confirmed(_across(classes, first, percent), docs, words, percent)
    links = rest.unionByName(first.select(F.col("node").alias("a"), F.col("component").alias("b")))
    comps = components(links)

    of_class = class_of.join(comps, F.col("id") == F.col("node"), "left").select(
        "f1", "f2", "n_shingles", F.coalesce("component", "id").alias("component_id")
    )
    out = sigs.join(of_class, ["f1", "f2", "n_shingles"], "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
