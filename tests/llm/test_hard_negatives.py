"""Hard negatives against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import hard_negatives as H

COLUMNS = "id long, label int, vector array<float>, row string, leaf string, anchor string, q string"


def brute(rows, is_anchor, positives=5, negatives=3, low=50, high=95, scale=256):
    """Python integers over all rows (id, label, vector)."""
    dim = max((len(v) for _, _, v in rows if v is not None), default=0)
    kept = []
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [max(-(2**63), min(2**63 - 1, math.floor(float(np.float32(x)) * scale))) for x in v]
        kept.append((i, label, q + [0] * (dim - len(q))))
    out = []
    for i, label, q in kept:
        if not is_anchor(i):
            continue
        score = lambda r: max(-(2**63) + 1, min(2**63 - 1, sum(a * b for a, b in zip(q, r[2], strict=True))))  # noqa: E731,B023
        ranked = sorted(((-score(r), r[0], r[1]) for r in kept if r[0] != i))
        for ps, p, _ in [r for r in ranked if r[2] == label][:positives]:
            near = [r for r in ranked if r[2] != label and low * -ps <= 100 * -r[0] <= high * -ps][:negatives]
            out += [(i, p, k, n, -ps, -ns) for k, (ns, n, _) in enumerate(near, 1)]
    return sorted(out)


def mined(spark, rows, **more):
    df = spark.createDataFrame([(*r, "x", None, "y", "z") for r in rows], COLUMNS).repartition(4)
    return sorted(map(tuple, H.hard_negatives(df, F.col("id") % 5 == 0, **more).collect()))


def clouds(n, dim=12, centres=9, spread=0.08, seed=3):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, dim))
    at = rng.integers(0, centres, n)
    v = c[at] + spread * rng.normal(size=(n, dim))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    labels = np.where(rng.random(n) < 0.7, at % 4, rng.integers(0, 4, n))
    return [(int(i), int(k), [float(np.float32(x)) for x in row]) for i, k, row in zip(rng.permutation(n), labels, v, strict=True)]


@pytest.fixture
def small_nodes(monkeypatch):
    for name, value in (("FIT_ROWS", 150), ("LEAF_ROWS", 20), ("CHUNK_ROWS", 16), ("LOT_ANCHORS", 8)):
        monkeypatch.setattr(H, name, value)


def test_equal_brute_force_in_a_deep_tree(spark, small_nodes):
    rows = clouds(600)
    assert mined(spark, rows) == brute(rows, lambda i: i % 5 == 0)


def test_lengths_that_differ(spark, small_nodes):
    """Rows of very different lengths: the added component makes scores distances."""
    rows = [(i, k, [x * (1 + i % 7) for x in v]) for i, k, v in clouds(300)]
    assert mined(spark, rows, positives=3, negatives=4, low=20, high=90) == brute(rows, lambda i: i % 5 == 0, 3, 4, 20, 90)


def test_one_vector_that_fills_a_leaf(spark, small_nodes):
    """A third of the rows are one vector, under two labels; ties go to the smaller id."""
    rows = clouds(240) + [(1000 + i, i % 2, [0.5] * 12) for i in range(120)] + [(2000 + i, 3, [0.4] * 12) for i in range(30)]
    got = mined(spark, rows)
    assert got == brute(rows, lambda i: i % 5 == 0)
    assert any(a >= 1000 for a, *_ in got)


def test_odd_rows(spark, small_nodes):
    nan, inf = float("nan"), float("inf")
    rows = clouds(80) + [
        (None, 1, [0.1] * 12), (500, None, [0.2] * 12), (505, 1, None), (510, 1, [nan] * 12), (515, 1, [inf] + [0.0] * 11),
        (520, 1, [None] + [0.1] * 11), (525, 1, [0.3] * 5), (530, 1, []), (535, 2, [0.0] * 12), (540, 0, [-0.3] * 12),
    ]
    rows += [rows[3]]  # a row that repeats
    assert mined(spark, rows) == brute(rows, lambda i: i % 5 == 0)
    assert mined(spark, []) == []
    assert mined(spark, [(5, 1, [1.0])]) == []


def test_components_beyond_what_floats_hold(spark, small_nodes):
    rng = random.Random(4)
    rows = [(i, i % 3, [rng.choice([-1, 1]) * rng.random() * 1e7 for _ in range(4)]) for i in range(60)]
    assert mined(spark, rows) == brute(rows, lambda i: i % 5 == 0)
    rows += [(100, 1, [1e30, 0.0, 0.0, 1.0]), (105, 1, [1e30, 1e30, 0.0, 1.0])]
    assert mined(spark, rows) == brute(rows, lambda i: i % 5 == 0)


def test_the_tree_passes_over_leaves():
    rng = np.random.default_rng(1)
    centres = rng.integers(-200, 200, (30, 16))
    rows = centres[rng.integers(0, 30, 40_000)] + rng.integers(-8, 9, (40_000, 16))
    top = float((rows * rows).sum(1).max()) + 1
    tree = H.plant(rows[:5000], len(rows), top)
    assert tree.leaves > 20
    tree.ranges = np.empty((len(tree.children), H.ARITY, H.ARITY, 2))
    tree.ranges[..., 0], tree.ranges[..., 1] = np.inf, -np.inf
    for node, _, d, child in tree.paths(tree.lifted(rows)):
        for j in np.unique(child):
            tree.ranges[node, :, j, 0], tree.ranges[node, :, j, 1] = d[child == j].min(0), d[child == j].max(0)
    leaf, asked = tree.leaf_of(tree.lifted(rows)), rows[:50].astype(float)
    s = asked @ rows.T.astype(float)
    lo = np.sort(s, 1)[:, -20]
    far = np.sqrt(np.maximum((asked**2).sum(1) + top - 2 * lo, 0))
    reached = tree.reached(np.column_stack((asked, np.zeros(50))), np.zeros((50, 1)), far[:, None])
    for i in range(50):
        assert reached[i, leaf[s[i] >= lo[i]]].all()
    assert reached.mean() < 0.5
