"""Hard negatives of anchors by a multiway hyperplane tree with sibling ranges (operator 13).

Scores are integer inner products. With one more component, which brings every
row to the same length, a score is a distance: rows whose scores lie in a
window are the rows of an annulus around the anchor. So the rows stand in a
metric tree of the GNAT kind.

1. Split points of every node are chosen, each far from those before, from a
   bounded sample of ``FIT_ROWS`` rows. A row goes to the child of its nearest
   split point, that is, the bisecting hyperplanes cut the node.
2. Every row is put into a leaf, and each split point stores the least and the
   greatest distance to the rows of each sibling subtree (one aggregate over
   all rows; the ranges are as many as the tree's nodes times its arity
   squared). Leaves are packed into chunks of ``CHUNK_ROWS`` rows, so a leaf
   that many equal vectors fill is many chunks.
3. An anchor's annulus goes down the tree. A child is passed over if for any
   split point no distance of its range can reach the annulus. The rows of the
   sample are real rows, so the scores among them bound the annulus first.
4. In the leaves that stay, anchors meet chunks, and scores are exact integers.
   Positives come from one such search, their windows of negatives from the next.

Nothing is approximate: the sample only decides how much is passed over.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.near_dedup import _whole_groups
from tidewater.llm.shared import shuffle_partitions, staged

FIT_ROWS = 20_000  # rows of the sample that split points and first bounds come from
ARITY, LEAF_ROWS = 8, 2048  # children of a node; rows of a leaf, about, that decide the depth
CHUNK_ROWS, LOT_ANCHORS = 512, 128  # rows and anchors that one step of a leaf's work compares
_SLACK = 1e-9  # relative; distances are floats, scores are not
_NONE = np.iinfo(np.int64).min


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component, as longs; null if the vector or a component is null or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(F.coalesce(finite, F.lit(False)), F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column; shorter ones end in zeros."""
    flat, sizes = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy()
    if len(sizes) and (sizes == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(sizes), dim), np.int64)
    ends = np.cumsum(sizes)
    for i, (n, e) in enumerate(zip(sizes, ends, strict=True)):
        out[i, :n] = flat[e - n : e]
    return out


def scores(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products of integer rows. ``exact``: the sums fit a float's 53 bits, else Python integers are used, at most those of 64 bits."""
    if exact:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    wide = a.astype(object) @ b.astype(object).T
    return np.clip(wide, -(2**63) + 1, 2**63 - 1).astype(np.int64)


@dataclass
class Tree:
    """Split points of the inner nodes, their children (a node, or ~leaf), and ranges[node, point, child]."""

    points: np.ndarray  # nodes x arity x (dim + 1)
    children: np.ndarray  # nodes x arity
    leaves: int
    top: float  # the squared length that every row is brought to
    ranges: np.ndarray | None = None

    def lifted(self, rows: np.ndarray) -> np.ndarray:
        rows = rows.astype(np.float64)
        return np.column_stack((rows, np.sqrt(np.maximum(self.top - (rows * rows).sum(1), 0))))

    def paths(self, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(node, rows in it, their distances to its split points, child of each) from the root down."""
        todo = [(0, np.arange(len(rows)))] if len(self.children) else []
        while todo:
            node, at = todo.pop()
            d = _distances(rows[at], self.points[node])
            child = d.argmin(1)
            yield node, at, d, child
            for j, below in enumerate(self.children[node]):
                own = at[child == j]
                if below >= 0 and len(own):
                    todo.append((int(below), own))

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows), np.int32)
        for node, at, _, child in self.paths(rows):
            below = self.children[node][child]
            out[at[below < 0]] = ~below[below < 0]
        return out

    def reached(self, anchors: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
        """anchors x leaves: whether a row of the leaf can be at a distance in any of the anchor's annuli [near, far] (anchors x annuli)."""
        out = np.zeros((len(anchors), self.leaves), bool)
        if not len(self.children):
            out[:] = (near <= far).any(1)[:, None]
            return out
        todo = [(0, np.flatnonzero((near <= far).any(1)))]
        while todo:
            node, at = todo.pop()
            d = _distances(anchors[at], self.points[node])
            lo, hi = self.ranges[node, :, :, 0], self.ranges[node, :, :, 1]
            for j, below in enumerate(self.children[node]):
                # rows of child j are at least |d - range| and at most d + range from the anchor, by each split point's range
                least = np.maximum(lo[:, j] - d, d - hi[:, j]).max(1)
                most = (d + hi[:, j]).min(1)
                pad = _SLACK * (1 + np.abs(most)) + 1e-6
                some = ((near[at] <= (most + pad)[:, None]) & (far[at] >= (least - pad)[:, None]) & (near[at] <= far[at])).any(1)
                some &= lo[0, j] <= hi[0, j]  # a child without rows has no range
                if below < 0:
                    out[at[some], ~below] = True
                elif some.any():
                    todo.append((int(below), at[some]))
        return out


def _distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    square = (rows * rows).sum(1)[:, None] + (points * points).sum(1)[None, :] - 2 * rows @ points.T
    return np.sqrt(np.maximum(square, 0))


def plant(sample: np.ndarray, n_rows: int, top: float) -> Tree:
    """A tree for ``n_rows`` rows of which ``sample`` are some; its depth grows with the rows as far as the sample can fill it."""
    tree = Tree(np.zeros((0, ARITY, sample.shape[1] + 1)), np.zeros((0, ARITY), np.int64), 1, top)
    rng, lifted, points, children, leaves = np.random.default_rng(13), tree.lifted(sample), [], [], 0
    depth = 0
    while LEAF_ROWS * ARITY**depth < n_rows:
        depth += 1

    def grow(at: np.ndarray, level: int) -> int:
        nonlocal leaves
        if level == depth or len(at) < 4 * ARITY:
            leaves += 1
            return ~(leaves - 1)
        some = rng.choice(at, min(len(at), 4 * ARITY), replace=False)
        chosen, least = [some[0]], _distances(lifted[some], lifted[some[:1]])[:, 0]
        while len(chosen) < ARITY:
            chosen.append(some[int(least.argmax())])
            least = np.minimum(least, _distances(lifted[some], lifted[chosen[-1:]])[:, 0])
        node = len(points)
        points.append(lifted[chosen])
        children.append([0] * ARITY)
        child = _distances(lifted[at], points[node]).argmin(1)
        children[node] = [grow(at[child == j], level + 1) for j in range(ARITY)]
        return node

    if grow(np.arange(len(sample)), 0) < 0:
        return tree
    return Tree(np.array(points), np.array(children), leaves, top)


def _ranges_of(placed: DataFrame, tree: Tree, dim: int, kind: str) -> np.ndarray:
    """The least and greatest distance from each split point to the rows of each child, over all rows."""
    out = np.empty((len(tree.children), ARITY, ARITY, 2))
    out[..., 0], out[..., 1] = np.inf, -np.inf

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = out.copy()
        for batch in batches:
            for node, _, d, child in tree.paths(tree.lifted(_unpacked(batch.column("q").to_pylist(), dim, kind))):
                for j in np.unique(child):
                    near = d[child == j]
                    own[node, :, j, 0] = np.minimum(own[node, :, j, 0], near.min(0))
                    own[node, :, j, 1] = np.maximum(own[node, :, j, 1], near.max(0))
        at = np.flatnonzero(own[..., 0] <= own[..., 1])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(own[..., 0].ravel()[at]), pa.array(own[..., 1].ravel()[at])], ["cell", "lo", "hi"])

    if len(tree.children):
        cells = placed.select("q").mapInArrow(run, "cell long, lo double, hi double")
        for r in cells.groupBy("cell").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect():
            out.reshape(-1, 2)[r.cell] = r.lo, r.hi
    return out


def _unpacked(cells: list[bytes], width: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(cells), kind).reshape(-1, width) if width else np.zeros((len(cells), 0), kind)


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _packed(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """One row per value of ``keys``: the columns of its rows, in the order of id, as bytes end to end."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _whole_groups(batches, keys, [*keys, *columns]):
            cells = [pa.array(c[:1].astype(np.int32)) for c in group[: len(keys)]]
            cells += [pa.array([b"".join(c.tolist()) if c.dtype == object else c.astype(np.int64).tobytes()], pa.binary()) for c in group[len(keys) :]]
            yield pa.RecordBatch.from_arrays(cells, [*keys, *columns])

    dealt = rows.select(*keys, *columns).repartition(shuffle_partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys, "id")
    return staged(dealt.mapInArrow(run, ", ".join([f"{k} int" for k in keys] + [f"{c} binary" for c in columns])))


def first_fitting(ids: np.ndarray, labels: np.ndarray, s: np.ndarray, own: np.ndarray, label: np.ndarray, w: np.ndarray, same: bool, most: int) -> np.ndarray:
    """anchors x windows x ``most``: places of the first rows in each window, -1 where there are fewer.

    ``s`` are the scores of anchors (own ids, label) and rows (ids ascending,
    labels), ``w`` anchors x windows x (lo, hi, ...).
    """
    fits = (label[:, None] == labels[None, :]) == same
    fits &= own[:, None] != ids[None, :]
    out, each = np.full((len(own), w.shape[1], most), -1), np.arange(len(own))
    for k in range(w.shape[1] if len(ids) else 0):
        left = np.where(fits & (s >= w[:, k, :1]) & (s <= w[:, k, 1:2]), s, _NONE)
        for m in range(most):
            at = left.argmax(1)  # the first of equals, so the smallest id
            out[:, k, m] = np.where(left[each, at] > _NONE, at, -1)
            if (out[:, k, m] < 0).all():
                break
            left[each, at] = _NONE
    return out


@dataclass
class Index:
    """The tree, the chunks of its leaves, and the sample that gives first bounds."""

    tree: Tree
    chunks: DataFrame  # leaf, chunk, id, label, q
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    dim: int
    kind: str
    exact: bool

    def search(self, anchors: DataFrame, windows: int, same: bool, most: int) -> DataFrame:
        """The first ``most`` rows of each anchor's windows: row, anchor, k (of the window), a, b (what the window carries), other, score, rank.

        ``anchors``: row, id, label, q and w, the bytes of ``windows`` times
        (lo, hi, a, b). A window holds the rows with lo <= score <= hi whose
        label is the anchor's (``same``) or another, and whose id is not its own.
        """
        dim, kind = self.dim, self.kind
        tree, ids, labels, vectors, exact = self.tree, self.ids, self.labels, self.vectors, self.exact
        lots = max(1, -(-anchors.count() // LOT_ANCHORS))

        def visits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for big in batches:
                for i in range(0, big.num_rows, LOT_ANCHORS):
                    batch = big.slice(i, LOT_ANCHORS)
                    q, w = _unpacked(batch.column("q").to_pylist(), dim, kind), _unpacked(batch.column("w").to_pylist(), 4 * windows, "<i8")
                    w = w.reshape(-1, windows, 4).copy()
                    s = scores(q, vectors, exact)
                    last = first_fitting(ids, labels, s, batch.column("id").to_numpy(), batch.column("label").to_numpy(), w, same, most)[:, :, -1]
                    w[:, :, 0] = np.where(last >= 0, np.take_along_axis(s, np.maximum(last, 0), 1), w[:, :, 0])
                    length = (q.astype(np.float64) ** 2).sum(1)[:, None] + tree.top
                    distance = lambda score: np.sqrt(np.maximum(length - 2 * score.astype(np.float64), 0))  # noqa: E731,B023
                    some = w[:, :, 0] <= w[:, :, 1]
                    near, far = distance(w[:, :, 1]), np.where(some, distance(w[:, :, 0]), -1)
                    lifted = np.column_stack((q.astype(np.float64), np.zeros(len(q))))
                    a, leaf = np.nonzero(tree.reached(lifted, near, far))
                    own = batch.take(pa.array(a))
                    cols = [pa.array(leaf, pa.int32()), *(own.column(c) for c in ("row", "id", "label", "q")), _binary(w.reshape(-1, 4 * windows)[a])]
                    yield pa.RecordBatch.from_arrays(cols, ["leaf", "row", "id", "label", "q", "w"])

        gone = anchors.mapInArrow(visits, "leaf int, row long, id long, label long, q binary, w binary")
        gone = gone.withColumn("lot", F.pmod(F.xxhash64("row"), F.lit(lots)).cast("int"))
        asked = _packed(gone, ["leaf", "lot"], ["row", "id", "label", "q", "w"])
        met = self.chunks.join(asked.select("leaf", "row", *(F.col(c).alias(f"a_{c}") for c in ("id", "label", "q")), "w"), "leaf").drop("leaf", "chunk")

        def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            longs = lambda x: np.frombuffer(x.as_buffer(), "<i8")
            for batch in batches:
                for r in range(batch.num_rows):
                    c = {name: batch.column(k)[r] for k, name in enumerate(batch.schema.names)}
                    row, own, w = longs(c["row"]), longs(c["a_id"]), longs(c["w"]).reshape(-1, windows, 4)
                    q = np.frombuffer(c["a_q"].as_buffer(), kind).reshape(len(row), dim)
                    rows = longs(c["id"])
                    s = scores(q, np.frombuffer(c["q"].as_buffer(), kind).reshape(len(rows), dim), exact)
                    places = first_fitting(rows, longs(c["label"]), s, own, longs(c["a_label"]), w, same, most)
                    a, k, m = np.nonzero(places >= 0)
                    at = places[a, k, m]
                    cols = [row[a], own[a], k, w[a, k, 2], w[a, k, 3], rows[at], s[a, at]]
                    yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in cols], ["row", "anchor", "k", "a", "b", "other", "score"])

        found = met.mapInArrow(meet, "row long, anchor long, k long, a long, b long, other long, score long")
        first = Window.partitionBy("row", "k").orderBy(F.desc("score"), "other")
        return staged(found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= most))


def build(rows: DataFrame, scale: int) -> tuple[Index, DataFrame] | None:
    """The index over ``rows`` (id, label, vector, anchor) and its rows (row, id, label, anchor, q, leaf); None without rows."""
    rows = rows.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), "anchor", quantised(F.col("vector"), scale).alias("q"))
    rows = rows.where("id is not null and label is not null and q is not null")
    square = F.aggregate("q", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    widest = F.greatest(F.array_max("q").cast("double"), -F.array_min("q").cast("double"))
    n, dim, most, top = rows.agg(F.count("*"), F.max(F.size("q")), F.max(widest), F.max(square)).first()
    if not n:
        return None
    kind = next(k for k, bits in (("<i2", 15), ("<i4", 31), ("<i8", 64)) if (most or 0) < 2**bits)
    exact = top < 2.0**52
    size = max(1, min(FIT_ROWS, (32 << 20) // (8 * max(dim, 1))))
    few = rows.orderBy(F.xxhash64("id", F.lit(13)), "id").limit(size).toArrow().combine_chunks().sort_by("id").combine_chunks().to_batches()[0]
    sample = _matrix(few.column("q"), dim)
    tree = plant(sample, n, top * (1 + 1e-9) + 1)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = _matrix(batch.column("q"), dim)
            cols = [*(batch.column(c) for c in ("row", "id", "label", "anchor")), _binary(q.astype(kind)), pa.array(tree.leaf_of(tree.lifted(q)), pa.int32())]
            yield pa.RecordBatch.from_arrays(cols, ["row", "id", "label", "anchor", "q", "leaf"])

    keyed = rows.withColumn("row", F.monotonically_increasing_id())
    placed = staged(keyed.mapInArrow(place, "row long, id long, label long, anchor boolean, q binary, leaf int"))
    tree.ranges = _ranges_of(placed, tree, dim, kind)
    sizes = placed.groupBy("leaf").count().select("leaf", F.ceil(F.col("count") / CHUNK_ROWS).cast("int").alias("n"))
    dealt = placed.join(F.broadcast(sizes), "leaf")  # a row per leaf of the tree, which the sample bounds
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("row"), F.col("n")).cast("int"))
    chunks = _packed(dealt, ["leaf", "chunk"], ["id", "label", "q"])
    return Index(tree, chunks, few.column("id").to_numpy(), few.column("label").to_numpy(), sample, dim, kind, exact), placed


_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(
    rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256
) -> DataFrame:
    """Per anchor and positive of ``rows`` (id, label, vector), its hard negatives: anchor_id, positive_id, rank, negative_id and both scores.

    Scores are inner products of floor(``scale`` * x). Higher ones come first,
    ties by the smaller id. Anchors are the rows where ``anchors`` holds. The
    positives of an anchor are the first ``positives`` rows of its label, the
    negatives of a pair the first ``negatives`` rows of another label with
    low * positive_score <= 100 * negative_score <= high * positive_score; all,
    if there are fewer. Rows with a null id, label, vector or component, or a
    component that is not finite, take no part. Shorter vectors end in zeros.
    Rows that repeat an id are rows of their own, but no partners of each
    other. Components and scores beyond 64 bits are held at the bound. Other
    columns are not read; an empty table gives an empty result.
    """
    rows = rows.select("id", "label", "vector", F.coalesce(anchors, F.lit(False)).alias("anchor"))
    made = build(rows, scale)
    if made is None:
        return rows.sparkSession.createDataFrame([], _RESULT)
    index, placed = made
    asked = placed.where("anchor").select("row", "id", "label", "q")
    any_score = np.array([_NONE + 1, 2**63 - 1, 0, 0], "<i8").tobytes()
    near = index.search(asked.withColumn("w", F.lit(any_score)), 1, True, positives)

    found = near.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("rank", "other", "score"))).alias("p"))  # ``positives`` at most

    def windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = np.zeros((batch.num_rows, positives, 4), np.int64)
            w[:, :, 0], w[:, :, 1] = 1, 0  # an empty window
            for i, found in enumerate(batch.column("p").to_pylist()):
                for k, p in enumerate(found):
                    w[i, k] = -(-low * p["score"] // 100), high * p["score"] // 100, p["other"], p["score"]
            cols = [batch.column(c) for c in ("row", "id", "label", "q")]
            yield pa.RecordBatch.from_arrays([*cols, _binary(w.astype("<i8").reshape(len(w), -1))], ["row", "id", "label", "q", "w"])

    paired = asked.join(found, "row").mapInArrow(windows, "row long, id long, label long, q binary, w binary")
    far = index.search(staged(paired), positives, False, negatives)
    return far.select(
        F.col("anchor").alias("anchor_id"), F.col("a").alias("positive_id"), "rank", F.col("other").alias("negative_id"),
        F.col("b").alias("positive_score"), F.col("score").alias("negative_score"),
    )
