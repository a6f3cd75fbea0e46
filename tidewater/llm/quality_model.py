"""Quality scores by a sparse rule ensemble (operator 8).

Statistics of a text are Spark expressions. Shallow boosted trees are fitted to
them on labelled rows; each path from a tree's root is a rule, a conjunction
of bounds on statistics. A lasso logistic regression keeps few of the rules.
The kept rules are compiled to one Spark expression, so scoring a table is a
single scan without Python.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm import columns as C
from tidewater.llm.columns import let

TRAIN_ROWS = 20_000  # labelled rows used at most, those of the smallest hash of doc_id
TREES, LEVELS, BINS, STEP = 24, 3, 32, 0.3
FEATURES = ("log_words", "word_length", "symbols", "upper", "repeated_lines", "repeated_words", "distinct", "digits", "marks", "line_words", "short")


def statistics(text: Column) -> Column:
    """array<double> of FEATURES; all defined for an empty text."""

    def of(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("double").alias("n"),
            F.size(F.array_distinct(w)).cast("double").alias("distinct"),
            F.size(F.filter(w, lambda x: F.length(x) <= 3)).cast("double").alias("short"),
            C.repeat_words(w).cast("double").alias("repeated"),
        )

    def shares(t: Column) -> Column:
        lines = F.size(F.split(t, "\n", -1)).cast("double")
        chars = F.greatest(C.word_chars(t), F.lit(1)).cast("double")
        rest = F.struct(
            chars.alias("chars"), lines.alias("lines"), C.n_dup_lines(t).alias("dup"), C.count_of(t, "#*$%&|<>").alias("symbols"),
            C.count_of(t, "0123456789").alias("digits"), C.count_of(t, "!?").alias("marks"),
            F.length(F.regexp_replace(t, r"\P{Lu}+", "")).alias("upper"),
        )

        def join(s: Column) -> Column:
            w, r = s["w"], s["r"]
            n = F.greatest(w["n"], F.lit(1.0))
            values = (
                F.log1p(w["n"]), r["chars"] / n, r["symbols"] / n, r["upper"] / r["chars"], r["dup"] / r["lines"], w["repeated"] / n,
                w["distinct"] / n, r["digits"] / r["chars"], r["marks"] / n, w["n"] / r["lines"], w["short"] / n,
            )
            return F.array(*(v.cast("double") for v in values))

        return let(F.struct(let(C.words(t), of).alias("w"), rest.alias("r")), join)

    return let(text, shares)


@dataclass(frozen=True)
class Rule:
    """All of (feature, is_above, bound) must hold: value > bound if is_above, else value <= bound."""

    terms: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for f, above, bound in self.terms:
            out &= (x[:, f] > bound) == above
        return out

    def column(self, stats: Column) -> Column:
        out = None
        for f, above, bound in self.terms:
            term = stats[f] > F.lit(bound) if above else stats[f] <= F.lit(bound)
            out = term if out is None else out & term
        return out


@dataclass(frozen=True)
class Ensemble:
    bias: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self, stats: Column) -> Column:
        z = F.lit(self.bias)
        for rule, weight in self.rules:
            z = z + F.when(rule.column(stats), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _tree(x: np.ndarray, bins: list[np.ndarray], codes: np.ndarray, grad: np.ndarray, hess: np.ndarray, step: np.ndarray) -> list[Rule]:
    """Grows one tree of LEVELS levels, adds its leaf values to ``step`` and returns the path of every node."""
    rules: list[Rule] = []

    def grow(rows: np.ndarray, terms: tuple, level: int) -> None:
        g, h = grad[rows].sum(), hess[rows].sum()
        best = (1e-3, None)
        for f in range(x.shape[1]) if level < LEVELS and len(rows) >= 20 else ():
            gs, hs, ns = (np.bincount(codes[rows, f], w, len(bins[f]) + 1).cumsum()[:-1] for w in (grad[rows], hess[rows], None))
            gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
            gain[(ns < 10) | (len(rows) - ns < 10)] = 0
            k = int(gain.argmax()) if len(gain) else 0
            if len(gain) and gain[k] > best[0]:
                best = (gain[k], (f, k))
        if best[1] is None:
            step[rows] += STEP * g / (h + 1)
            return
        f, k = best[1]
        high = codes[rows, f] > k
        for above, part in ((False, rows[~high]), (True, rows[high])):
            path = (*terms, (f, above, float(bins[f][k])))
            rules.append(Rule(path))
            grow(part, path, level + 1)

    grow(np.arange(len(x)), (), 0)
    return rules


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 0.002, steps: int = 300) -> Ensemble:
    """Rules of boosted trees, thinned by lasso logistic regression. One class, or no rows, gives a constant score."""
    rate = (y.sum() + 1) / (len(y) + 2)
    bias = float(np.log(rate / (1 - rate)))
    if len(y) < 40 or y.min() == y.max():
        return Ensemble(bias, ())
    bins = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    codes = np.stack([np.searchsorted(b, x[:, f], "left") for f, b in enumerate(bins)], 1)
    z, rules = np.full(len(y), bias), {}
    for _ in range(TREES):
        p = _sigmoid(z)
        rules.update(dict.fromkeys(_tree(x, bins, codes, y - p, p * (1 - p), z)))
    kept = list(rules)
    m = np.stack([r.holds(x) for r in kept], 1).astype(np.float64)
    _, first = np.unique(m, axis=1, return_index=True)  # rules that hold for the same rows are one
    kept, m = [kept[i] for i in sorted(first)], m[:, sorted(first)]
    w = v = np.zeros(m.shape[1])
    b, t, rate = bias, 1.0, 4 / max(1.0, float((m * m).sum(1).mean()))
    for _ in range(steps):
        e = _sigmoid(m @ v + b) - y
        new = v - rate * (m.T @ e) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0)
        t1 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + (t - 1) / t1 * (new - w), new, t1
        b -= rate * float(e.mean())
    return Ensemble(float(b), tuple((r, float(c)) for r, c in zip(kept, w, strict=True) if c))


def held_out() -> Column:
    """crc32 of doc_id as text, modulo 5, is 0; false for a null doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Ensemble:
    """Fits to at most ``rows`` labelled rows that are not held out. Null ids and labels are left out."""
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    chosen = labels.where(~held_out() & F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    found = chosen.count()
    if found > 2 * rows:  # of many labels only the smallest hashes need sorting: twice as many as wanted, on average
        chosen = chosen.where(F.xxhash64("doc_id") < int(2 * rows / found * 2**64) - 2**63)
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), C.text_of().alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id")  # at most ``rows`` narrow rows
    data = found.select("quality", statistics(F.col("text")).alias("x"), "doc_id").orderBy("doc_id", "x").limit(rows).collect()
    x = np.array([r["x"] for r in data], np.float64).reshape(len(data), len(FEATURES))
    return fit(x, np.array([r["quality"] for r in data], np.float64))


def score_quality(docs: DataFrame, model: Ensemble, least: float = 0.3) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted (1 if score >= ``least``).

    Only the text enters a score. A null text counts as empty and has a score
    as any other. doc_id may be null (not held out) or repeated. Other columns
    are not read. An empty table gives an empty result.
    """
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), statistics(C.text_of()).alias("x"))
    out = out.withColumn("score", let(F.col("x"), model.score))
    return out.select("doc_id", "held_out", "score", (F.col("score") >= least).cast("int").alias("predicted"))
