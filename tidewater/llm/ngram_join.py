"""Jaccard join of word n-gram sets by prefix trees (operator 11).

A set x that is linked holds at most k = |x| * (100 - percent) / 100 grams that
its partner lacks. In any one order of all grams, the first grams common to
two linked sets therefore stand among the first k + c of both, c at a time.

1. Texts with equal sets are one class (one aggregate on a set fingerprint).
2. Each set gives its 2k + 1 least gram hashes. Grams that only one class gave
   are counted per class; a class with too many of them has no partner. This is
   exact, takes two aggregates and leaves few classes in most corpora.
3. Of the classes left, all grams are counted the same way; a class with more
   than k grams that no other holds goes.
4. Linked classes share k + 1 of their 2k + 1 least hashes, so they share one of
   the rarest of these, by (frequency, hash) over all classes left. What such
   ties connect is a neighbourhood, outside of which no link goes.
5. A neighbourhood's sets, in one order of their grams, the most frequent first,
   are stored in prefix trees of bounded size. A set goes down a tree once for
   all sets that share a path, with the overlap so far; a subtree is passed over
   when the grams that remain on either side cannot reach the bound, or when
   all its sets are in the set's own component already.
6. A larger neighbourhood is dealt over several trees, each with the set that
   holds the most frequent grams. Where that leaves more than one component, the
   sets outside the largest one, lot by lot, go down every other tree.

No link is lost, but one inside a component that is already connected is not
looked for. Grams are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.components import components
from tidewater.llm.near_dedup import _whole_groups
from tidewater.llm.shared import shuffle_partitions, staged, text_parts, within
from tidewater.llm.words import mix, shingle_sets, word_hashes

TREE_SETS, TREE_GRAMS = 512, 500_000  # sets and grams of a tree, about
LOT_SETS = 2048  # sets that go down a tree of another block in one task
BROADCAST_ROWS = 500_000  # rows of a few numbers that are broadcast at most


def missing(n, percent: int):
    """Grams that a set of n may hold and its partner lack, at most."""
    return n * (100 - percent) // 100


def least_shared(n, percent: int):
    """How many of the 2k + 1 first grams of a set of n stand among those of every partner: k + 1 of the smallest partner."""
    return missing(-(-n * percent // 100), percent) + 1


def _lists(rows: list[np.ndarray]) -> pa.Array:
    bounds = np.concatenate(([0], np.cumsum([*map(len, rows)]))).astype(np.int32)
    flat = np.concatenate(rows).view(np.int64) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))


def _fingerprints(sets: list[np.ndarray]) -> list[pa.Array]:
    prints = [(int(s.sum(dtype=np.uint64)), int(np.bitwise_xor.reduce(mix(s)) if len(s) else 0)) for s in sets]
    return [pa.array(np.array([p[k] for p in prints], np.uint64).view(np.int64)) for k in (0, 1)]


def gram_sets(docs: DataFrame, words: int, percent: int | None = None) -> DataFrame:
    """doc_id, n_shingles, a fingerprint of the set (f1, f2) and its hashes in order; with ``percent`` only the 2k + 1 least."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_parts(batches):
            sets = shingle_sets(*word_hashes(data, offsets, lower=True), words)
            kept = sets if percent is None else [s[: 2 * missing(len(s), percent) + 1] for s in sets]
            cols = [rows.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), *_fingerprints(sets), _lists(kept)]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_shingles", "f1", "f2", "grams"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, f1 long, f2 long, grams array<long>")


def _candidates(sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(classes: f1, f2, n_shingles, c, id), and those of them that can have a partner."""
    rows = sets.where("n_shingles > 0 and doc_id is not null")
    classes = rows.groupBy("f1", "f2", "n_shingles").agg(F.min("doc_id").alias("id"))
    classes = staged(classes.withColumn("c", F.monotonically_increasing_id()))
    own = F.xxhash64("f1", "f2")
    given = rows.select(own.alias("f"), F.explode("grams").alias("g")).groupBy("g").agg(F.min("f").alias("f"), F.max("f").alias("last"))
    alone = given.where("f = last").groupBy("f").agg(F.count("*").alias("alone"))
    n = F.col("n_shingles")
    spare = _spare(n, percent) * 2 + 1 - _need(n, percent)
    some = classes.withColumn("f", own).join(staged(alone), "f", "left").where(F.coalesce("alone", F.lit(0)) <= spare)
    return classes, staged(some.drop("f", "alone"))


def _div(a: Column, b: int) -> Column:
    return F.floor(a / b).cast("long")


def _spare(n: Column, percent: int) -> Column:
    """``missing`` of a column of sizes."""
    return _div(n * (100 - percent), 100)


def _need(n: Column, percent: int) -> Column:
    """``least_shared`` of a column of sizes."""
    return _spare(_div(n * percent + 99, 100), percent) + 1


def _whole_sets(docs: DataFrame, alive: DataFrame, words: int, percent: int) -> DataFrame:
    """c, n and all grams, by hash, of the classes that lack no more than k of them in all other classes together."""
    need = alive.select(F.col("id").alias("doc_id")).distinct()
    full = gram_sets(docs.join(within(need, BROADCAST_ROWS), "doc_id", "left_semi"), words).drop("doc_id")
    full = full.join(within(alive.drop("id"), BROADCAST_ROWS), ["f1", "f2", "n_shingles"]).select("c", F.col("n_shingles").alias("n"), "grams")
    full = staged(full)
    given = full.select("c", F.explode("grams").alias("g")).groupBy("g").agg(F.min("c").alias("c"), F.max("c").alias("last"))
    alone = given.where("c = last").groupBy("c").agg(F.count("*").alias("alone"))
    some = full.select("c", "n").distinct().join(alone, "c", "left").where(F.coalesce("alone", F.lit(0)) <= _spare(F.col("n"), percent))
    return staged(full.join(within(staged(some.select("c")), BROADCAST_ROWS), "c").dropDuplicates(["c"]))


def _neighbourhoods(sets: DataFrame, percent: int) -> DataFrame:
    """(c, hood, common): classes connected by their rarest grams, and how frequent a class's grams are in the mean."""
    n = F.col("n")
    first = staged(sets.select("c", "n", F.explode(F.slice("grams", F.lit(1), (_spare(n, percent) * 2 + 1).cast("int"))).alias("g")))
    often = staged(first.groupBy("g").agg(F.count("*").alias("often")).where("often > 1"))
    met = first.join(within(often, BROADCAST_ROWS), "g").groupBy("c", "n")
    met = met.agg(F.sort_array(F.collect_list(F.struct("often", "g"))).alias("s"))  # some of a text's own grams
    rarest = F.slice("s", F.lit(1), (F.size("s") - _need(n, percent) + 1).cast("int"))
    mean = F.aggregate("s", F.lit(0).cast("long"), lambda acc, x: acc + x["often"]) / n
    met = staged(met.where(F.size("s") >= _need(n, percent)).select("c", mean.alias("common"), rarest.alias("s")))
    rare = staged(met.select("c", F.explode("s.g").alias("g")))
    least = staged(rare.groupBy("g").agg(F.min("c").alias("m"), F.count("*").alias("rows")).where("rows > 1").drop("rows"))
    ties = rare.join(within(least, BROADCAST_ROWS), "g").where("c <> m").select(F.col("c").alias("a"), F.col("m").alias("b"))
    hoods = components(ties.distinct()).select(F.col("node").alias("c"), F.col("component").alias("hood"))
    return staged(hoods.join(met.select("c", "common"), "c"))


class _Node:
    """A path of grams; ``lo`` and ``hi`` bound the sizes of the sets below, ``one`` is one of them if they are known to be one component."""

    __slots__ = ("path", "below", "lo", "hi", "ends", "one")

    def __init__(self, path: list[int], lo: int, hi: int, one: int):
        self.path, self.lo, self.hi, self.one = path, lo, hi, one
        self.below: dict[int, _Node] = {}
        self.ends: list[int] = []


class Tree:
    """A prefix tree of sets whose grams are numbers in the global order, and the components found so far."""

    def __init__(self, sets: list[list[int]], sizes: list[int], components: list[int], percent: int):
        self.sets, self.sizes, self.percent = sets, sizes, percent
        first: dict[int, int] = {}
        self.up = [first.setdefault(c, i) for i, c in enumerate(components)]
        self.root = _Node([], 1 << 60, 0, -1)

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def store(self, i: int) -> None:
        grams, n, node, at = self.sets[i], self.sizes[i], self.root, 0
        while True:
            node.lo, node.hi = min(node.lo, n), max(node.hi, n)
            if at == len(grams):
                node.ends.append(i)
                node.one = i if len(node.ends) == 1 and not node.below else self._joint(node.one, i)
                return
            node.one = self._joint(node.one, i) if node.below or node.ends else i
            after = node.below.get(grams[at])
            if after is None:
                leaf = node.below[grams[at]] = _Node(grams[at:], n, n, i)
                leaf.ends.append(i)
                return
            path, same = after.path, 0
            end = min(len(path), len(grams) - at)
            if path[:end] == grams[at : at + end]:
                same = end
            else:
                while path[same] == grams[at + same]:
                    same += 1
            if same < len(path):  # the path forks, or ends inside
                fork = _Node(path[:same], after.lo, after.hi, after.one)
                after.path = path[same:]
                fork.below[after.path[0]] = after
                node.below[grams[at]] = after = fork
            node, at = after, at + same

    def _joint(self, one: int, i: int) -> int:
        return one if one >= 0 and self.find(one) == self.find(i) else -1

    def _now_one(self, node: _Node, i: int) -> bool:
        """Whether links found since have made all sets below one component, that of set i."""
        own = self.find(i)
        if any(b.one < 0 or self.find(b.one) != own for b in node.below.values()):
            return False
        node.one = i
        return True

    def links(self, i: int) -> list[tuple[int, int]]:
        """Goes down the tree with set i; links to other components, which become one with its own."""
        grams, n, percent = self.sets[i], self.sizes[i], self.percent
        size, most, found = len(grams), missing(self.sizes[i], percent), []
        todo = [(self.root, 0, n - size, 0)]  # node, grams of i passed, those that the path lacks, those that i lacks
        while todo:
            node, at, only, other = todo.pop()
            if node.one >= 0 and self.find(node.one) == self.find(i):
                continue
            path = node.path
            if grams[at : at + len(path)] == path:
                at += len(path)
            else:
                limit = missing(node.hi, percent)
                for g in path:
                    while at < size and grams[at] < g:
                        at += 1
                        only += 1
                    if at < size and grams[at] == g:
                        at += 1
                    else:
                        other += 1
                        if other > limit:
                            break
                    if only > most:
                        break
                if only > most or other > limit:
                    continue
            best = min(max(n - only + other, node.lo), node.hi)  # the size that could fit best
            if (100 + percent) * min(n - only, best - other) < percent * (n + best):
                continue
            shared = at - (only - (n - size))
            for j in node.ends:
                if self.find(i) != self.find(j) and (100 + percent) * shared >= percent * (n + self.sizes[j]):
                    found.append((i, j))
                    self.up[self.find(i)] = self.find(j)
            if node.one < 0 and node.below and not node.ends and self._now_one(node, i):
                continue
            following = node.below.get(grams[at]) if at < size else None
            todo += [(b, at, only, other) for b in node.below.values() if b is not following]
            if following is not None:  # the likeliest first
                todo.append((following, at, only, other))
        return found


def _numbered(grams: list[np.ndarray]) -> list[list[int]]:
    """The grams of each set as numbers, the most frequent in these sets first; without those of one set."""
    sizes = [*map(len, grams)]
    flat = np.concatenate([*grams, np.zeros(0, np.int64)])
    values, which, often = np.unique(flat, return_inverse=True, return_counts=True)
    number = np.empty(len(values), np.int64)
    number[np.lexsort((values, -often))] = np.arange(len(values))
    row, number = np.repeat(np.arange(len(sizes)), sizes), number[which]
    kept = often[which] > 1
    row, number = row[kept], number[kept]
    order = np.lexsort((number, row))
    return [x.tolist() for x in np.split(number[order], np.searchsorted(row, np.arange(1, len(sizes))))]


def _met(dealt: DataFrame, keys: list[str], percent: int, among: bool) -> DataFrame:
    """Links (a, b) of the sets of each group: those at home stand in a tree, and those away go down it; with ``among`` also those at home."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c, n, comp, home, grams in _whole_groups(batches, keys, cols):
            tree, own = Tree(_numbered(grams.tolist()), n.tolist(), comp.tolist(), percent), home.tolist()
            found = []
            for i in np.argsort(~home.astype(bool), kind="stable").tolist():
                if own[i] and among:
                    found += tree.links(i)
                if own[i]:
                    tree.store(i)
                else:
                    found += tree.links(i)
            yield pa.RecordBatch.from_arrays([pa.array(c[[f[k] for f in found]].astype(np.int64)) for k in (0, 1)], ["a", "b"])

    cols = ["c", "n", "comp", "home", "grams"]
    n = shuffle_partitions(dealt.sparkSession)
    return dealt.select(*keys, *cols).repartition(n, *keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long")


def _links(sets: DataFrame, hoods: DataFrame, percent: int) -> DataFrame:
    """Links that connect what is linked, (a, b), of classes inside each neighbourhood."""
    facts = hoods.join(sets.select("c", "n"), "c")
    hood = facts.groupBy("hood").agg(F.count("*").alias("m"), F.sum("n").alias("grams"), F.max(F.struct("common", -F.col("c"), "c")).alias("p"))
    blocks = F.ceil(F.greatest(F.col("m") / TREE_SETS, F.col("grams") / TREE_GRAMS)).cast("int")
    hood = staged(hood.select("hood", F.col("p.c").alias("pivot"), F.greatest(blocks, F.lit(1)).alias("blocks")))
    rows = staged(sets.join(within(hoods.drop("common"), BROADCAST_ROWS), "c").join(within(hood, BROADCAST_ROWS), "hood"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int"))
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    inside = rows.withColumn("comp", F.col("c")).withColumn("home", F.lit(True))
    pivots = inside.where("c = pivot and blocks > 1").withColumn("own", F.col("block")).withColumn("block", every("blocks")).where("block <> own")
    first = staged(_met(inside.unionByName(pivots.drop("own")), ["hood", "block"], percent, True))

    comps = components(first)
    wide = rows.where("blocks > 1").join(within(comps.withColumnRenamed("node", "c"), BROADCAST_ROWS), "c", "left")
    wide = staged(wide.withColumn("comp", F.coalesce("component", "c")).drop("component"))
    parts = wide.groupBy("hood", "comp").agg(F.count("*").alias("m"))
    main = parts.groupBy("hood").agg(F.max_by("comp", F.struct("m", "comp")).alias("main"), (F.sum("m") - F.max("m")).alias("others"))
    main = staged(main.where("others > 0").withColumn("lots", F.ceil(F.col("others") / LOT_SETS).cast("int")))
    wide = wide.join(within(main, BROADCAST_ROWS), "hood")
    lot = F.pmod(F.xxhash64("c", F.lit(1)), F.col("lots")).cast("int")
    home = wide.withColumn("lot", every("lots")).withColumn("home", F.lit(True))
    away = wide.where("comp <> main").withColumn("lot", lot).withColumn("own", F.col("block"))
    away = away.withColumn("block", every("blocks")).where("block <> own").drop("own").withColumn("home", F.lit(False))
    second = _met(home.unionByName(away), ["hood", "block", "lot"], percent, False)
    return staged(second).unionByName(comps.select(F.col("node").alias("a"), F.col("component").alias("b")))


def ngram_join(docs: DataFrame, percent: int = 90, words: int = 3) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    A text's set is its distinct shingles of ``words`` words, A-Z lower-cased;
    fewer words are one shingle. Texts link if 100 * |A and B| >= percent *
    |A or B|; component_id is the smallest doc_id reachable by links. A null or
    empty text has no shingles and no link. Each row is judged by its own text:
    rows that repeat a doc_id with other texts are texts of their own. A null
    doc_id takes no part and gets a null component. Other columns are not read.
    An empty table gives an empty result. ``percent`` must be over 50.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent must be over 50 and at most 100")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    least = staged(gram_sets(docs, words, percent))
    classes, alive = _candidates(least, percent)
    sets = _whole_sets(docs, alive, words, percent)
    comps = staged(components(_links(sets, _neighbourhoods(sets, percent), percent)))
    named = classes.join(within(comps.withColumnRenamed("node", "c"), BROADCAST_ROWS), "c", "left")
    named = named.withColumn("component", F.coalesce("component", "c"))
    smallest = named.groupBy("component").agg(F.min("id").alias("component_id"))
    named = staged(named.join(staged(smallest), "component").select("f1", "f2", "n_shingles", "component_id"))
    out = least.drop("grams").join(named, ["f1", "f2", "n_shingles"], "left")
    found = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", found.alias("component_id"))
