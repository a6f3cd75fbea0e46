"""Licence families of paragraphs by a trained classifier (operator 4); texts are scanned by Spark expressions only.

A sparse multinomial logistic regression over word n-grams (one to three
words) is trained here on the notices of ``TEMPLATES``, on altered copies of
them and on paragraphs that name no licence of the list. The class "unknown"
stands for licence-like text of other terms. Probabilities are calibrated by
one temperature fitted on notices held out. A paragraph is confirmed if its
words also match a template of its family.

A paragraph without any n-gram of the model is no licence text: the model is
checked to give such a paragraph the class "none". So only paragraphs with
one of the model's words are scored. Their distinct texts are scored once.
"""

from __future__ import annotations

import functools
import re

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.columns import let
from tidewater.llm.shared import staged

# fixed values: usual notices of each family
TEMPLATES = {
    "apache": (
        "licensed under the apache license, version 2.0",
        "licensed under the apache license, version 2.0 (the license); you may not use this file except in compliance with the license",
        "released under the apache 2.0 license",
        "spdx-license-identifier: apache-2.0",
    ),
    "bsd": (
        "licensed under the bsd 3-clause license",
        "released under the bsd license",
        "redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "spdx-license-identifier: bsd-3-clause",
    ),
    "cc-by": (
        "licensed under cc by 4.0",
        "this work is licensed under a creative commons attribution 4.0 international license",
        "spdx-license-identifier: cc-by-4.0",
    ),
    "cc-by-nc": (
        "licensed under cc by-nc 4.0",
        "this work is licensed under a creative commons attribution-noncommercial 4.0 international license",
        "licensed for non-commercial use only under cc by-nc 4.0",
    ),
    "cc-by-sa": (
        "licensed under cc by-sa 4.0",
        "this work is licensed under a creative commons attribution-sharealike 4.0 international license",
    ),
    "cc0": (
        "this work is dedicated to the public domain under cc0 1.0",
        "to the extent possible under law, the author has waived all copyright and related rights to this work (cc0 1.0 universal)",
    ),
    "gpl": (
        "this work is licensed under the gnu general public license, version 3",
        "this program is free software: you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation",
        "spdx-license-identifier: gpl-3.0-or-later",
        "released under the gpl v2",
    ),
    "lgpl": (
        "licensed under the gnu lesser general public license, version 2.1",
        "this library is free software; you can redistribute it and/or modify it under the terms of the gnu lesser general public license",
    ),
    "mit": (
        "released under the mit license",
        "licensed under the mit license",
        "permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the software without restriction",
        "spdx-license-identifier: mit",
    ),
    "mpl": (
        "this source code form is subject to the terms of the mozilla public license, v. 2.0",
        "licensed under the mozilla public license 2.0",
    ),
    "proprietary": ("all rights reserved", "copyright 2020 the authors. all rights reserved", "proprietary and confidential. all rights reserved"),
}
# licence-like text of no family above, for the class "unknown"
OTHERS = (
    "licensed under the terms of the agreement",
    "released under an open license",
    "licensed under the community license, version 1.1",
    "this work is licensed under a special license",
    "use is subject to the license terms",
    "released under the terms of our license",
    "copyright by the publisher",
    "permission is needed to copy this work",
    "the license may be changed by the owner",
    "this file is distributed under the artistic license",
)
# plain text with words of the notices, for the class "none"
PLAIN = (
    "the work is free of charge to any person",
    "this is the version of the following conditions",
    "you can use it in any form and without restriction",
    "the general public is free to use the library",
    "the software is the work of the authors and of the owner",
    "she has a driving license and may use the file",
    "the following terms are met by the public",
    "all the rest is under the rest of the source",
    "it is the property of the public and of the state",
    "with or without the general the people are free",
    "er kam mit der bahn und mit dem rad",
    "mit freundlichen worten und mit wein",
    "sie ging mit ihm nach hause",
    "mit und ohne hut, mit der zeit",
    "the mit and the gnu stood in the zoo",
    "a reserved man with a special agreement",
)
FAMILIES = (*TEMPLATES, "unknown", "none")
WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")
CONFIRM = 0.6
STRETCH = 2 * max(len(WORD.findall(n)) for notices in TEMPLATES.values() for n in notices)  # words
_COMMON = frozenset("a all an and any are as by can code except extent following for form forms free has have in is it may met not of on or our possible provided source that the this to use v with without work you file any person be subject our general public".split())


def _grams(words: list[str]) -> set[str]:
    """N-grams of one to three words; those of common words alone are left out."""
    out = set()
    for n in (1, 2, 3):
        for i in range(len(words) - n + 1):
            g = words[i : i + n]
            if not _COMMON.issuperset(g):
                out.add(" ".join(g))
    return out


def _altered(text: str, rng: np.random.Generator, filler: list[str]) -> str:
    words = [w for w in text.split() if rng.random() > 0.06]
    pad = lambda: [filler[i] for i in rng.integers(0, len(filler), rng.integers(0, 5))]
    return " ".join([*pad(), *words, *pad()])


@functools.lru_cache(1)
def train() -> tuple[dict[str, np.ndarray], np.ndarray]:
    """(weights of each n-gram by class, bias), calibrated. Deterministic; about 1,500 training paragraphs."""
    rng = np.random.default_rng(11)
    filler = sorted({w for t in PLAIN for w in t.split()} | {"lorem", "ipsum", "12", "2021"})
    texts, labels = [], []
    for family, notices in (*TEMPLATES.items(), ("unknown", OTHERS), ("none", PLAIN)):
        for k in range(120):
            notice = notices[k % len(notices)]
            texts.append(notice if k < len(notices) else _altered(notice, rng, filler))
            labels.append(FAMILIES.index(family))
    for _ in range(400):
        texts.append(" ".join(filler[i] for i in rng.integers(0, len(filler), rng.integers(0, 12))))
        labels.append(FAMILIES.index("none"))
    labels = np.array(labels)
    vocabulary = sorted(set().union(*(_grams(WORD.findall(n)) for notices in (*TEMPLATES.values(), OTHERS) for n in notices)))
    place = {g: i for i, g in enumerate(vocabulary)}
    x = np.zeros((len(texts), len(vocabulary)))
    for r, t in enumerate(texts):
        for g in _grams(WORD.findall(t)):
            if g in place:
                x[r, place[g]] = 1
    held = np.arange(len(texts)) % 5 == 0
    w, b = _fit_sparse(x[~held], labels[~held], len(FAMILIES))
    z = x[held] @ w + b
    best = min(np.linspace(0.3, 4, 75), key=lambda t: _loss(z * t, labels[held]))  # the temperature
    w, b = w * best, b * best
    if int(np.argmax(b)) != FAMILIES.index("none"):
        raise ValueError("a paragraph without n-grams must be no licence")
    used = np.flatnonzero(np.abs(w).sum(1) > 0)
    return {vocabulary[i]: w[i] for i in used}, b


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _loss(z: np.ndarray, labels: np.ndarray) -> float:
    return float(-np.log(_softmax(z)[np.arange(len(z)), labels] + 1e-12).mean())


def _fit_sparse(x: np.ndarray, labels: np.ndarray, classes: int, penalty: float = 0.0008, steps: int = 250) -> tuple[np.ndarray, np.ndarray]:
    """Lasso logistic regression by proximal gradient steps with momentum."""
    y = np.eye(classes)[labels]
    w, b = np.zeros((x.shape[1], classes)), np.zeros(classes)
    w0, rate, t = w, 4 / max(1.0, (x * x).sum(1).mean()), 1.0
    for _ in range(steps):
        t1 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v = w + (t - 1) / t1 * (w - w0)
        g = _softmax(x @ v + b) - y
        w0, t = w, t1
        w = v - rate * (x.T @ g) / len(x)
        w = np.sign(w) * np.maximum(np.abs(w) - rate * penalty, 0)
        b = b - rate * g.mean(0)
    return w, b


def _words(line: Column) -> Column:
    return F.regexp_extract_all(F.lower(line), F.lit(r"[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*"), F.lit(0))


def _pairs(words: Column) -> Column:
    """Neighbouring words, each pair once."""
    return F.when(F.size(words) > 1, F.array_distinct(F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1), lambda a, b: F.concat_ws(" ", a, b)))).otherwise(
        F.array().cast("array<string>")
    )


def _notice_pairs(notice: str) -> list[str]:
    w = WORD.findall(notice)
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:], strict=False)})


def _pair_shares(pairs: Column) -> dict[str, Column]:
    """The largest share of a template's word pairs in ``pairs``, for each family."""
    share = lambda n: F.size(F.array_intersect(pairs, F.array(*map(F.lit, _notice_pairs(n))))) / len(_notice_pairs(n))
    return {family: F.array_max(F.array(*map(share, notices))) for family, notices in TEMPLATES.items()}


def _template_pairs(words: Column) -> Column:
    """The word pairs of any template that stand in ``words``."""
    every = sorted({p for notices in TEMPLATES.values() for n in notices for p in _notice_pairs(n)})
    return F.array_intersect(_pairs(words), F.array(*map(F.lit, every)))


def _borne_out(words: Column) -> Column:
    """Whether a template has CONFIRM of its word pairs in ``words``. What holds for a stretch of a text holds for the text."""
    return let(_template_pairs(words), lambda pairs: F.greatest(*_pair_shares(pairs).values()) >= CONFIRM)


def _scored(distinct: DataFrame) -> DataFrame:
    """line, family, probability and share (of a template's words) of each of the distinct ``line`` that is not "none"."""
    weights, bias = train()
    grams = distinct.select("line", _words(F.col("line")).alias("w"))
    runs = lambda n: F.when(F.size("w") >= n, F.transform(F.sequence(F.lit(1), F.size("w") - (n - 1)), lambda i: F.array_join(F.slice("w", i, n), " "))).otherwise(F.array().cast("array<string>"))
    grams = grams.select("line", F.explode(F.array_distinct(F.concat(runs(1), runs(2), runs(3)))).alias("gram"))
    schema = "gram string, " + ", ".join(f"z{k} double" for k in range(len(FAMILIES)))
    model = distinct.sparkSession.createDataFrame([(g, *map(float, w)) for g, w in weights.items()], schema)
    scored = grams.join(F.broadcast(model), "gram").groupBy("line").agg(*(F.sum(f"z{k}").alias(f"z{k}") for k in range(len(FAMILIES))))
    z = F.array(*(F.col(f"z{k}") + float(bias[k]) for k in range(len(FAMILIES))))
    scored = scored.select("line", z.alias("z")).withColumn("top", F.array_max("z"))
    total = F.aggregate("z", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
    scored = scored.withColumn("probability", 1 / total).withColumn("k", F.array_position("z", F.col("top")).cast("int"))
    scored = scored.withColumn("family", F.get(F.array(*map(F.lit, FAMILIES)), F.col("k") - 1)).where("family <> 'none'")

    # a template of the family whose words are in the line
    shares = F.lit(0.0)
    have = F.array_distinct(_words(F.col("line")))
    for family, notices in TEMPLATES.items():
        likeness = [F.size(F.array_intersect(have, F.array(*map(F.lit, sorted(set(WORD.findall(n))))))) / len(set(WORD.findall(n))) for n in notices]
        shares = F.when(F.col("family") == family, F.greatest(*likeness) if len(likeness) > 1 else likeness[0]).otherwise(shares)
    return scored.withColumn("share", shares).select("line", "family", "probability", "share")


def _wrapped_notices(lines: DataFrame, judged: DataFrame) -> DataFrame:
    """Notices that run over several lines: row, doc_id, paragraph (their first line), last (line), family, probability.

    ``lines`` has all lines of texts that a template bears out. A run of lines
    ends at a line without a word, as of comment marks alone, and at a line
    that is confirmed by itself. From the last words of each line (STRETCH at
    most, twice the longest template) on, the STRETCH words that follow in the
    run are joined and judged like a line, but by the template's word pairs:
    a stretch of many words has the single ones by chance.
    """
    alone = judged.where("confirmed").select("row", "paragraph", F.lit(True).alias("alone"))
    lines = lines.select("row", "doc_id", "paragraph", _words(F.col("line")).alias("w")).join(alone, ["row", "paragraph"], "left")
    ends = F.coalesce("alone", F.lit(False)) | (F.size("w") == 0)
    lines = lines.withColumn("block", F.sum(ends.cast("long")).over(Window.partitionBy("row").orderBy("paragraph"))).where(~ends)
    lines = lines.select("row", "doc_id", "paragraph", "block", F.slice("w", 1, STRETCH).alias("head"), F.slice("w", F.greatest(F.size("w") - (STRETCH - 1), F.lit(1)), STRETCH).alias("tail"))
    # a line of the run has a word or more, so that many lines hold the words that follow
    following = Window.partitionBy("row", "block").orderBy("paragraph").rowsBetween(1, STRETCH)
    lines = lines.withColumn("next", F.collect_list("head").over(following)).where(F.size("next") > 0)
    lines = lines.withColumn("w", F.concat("tail", F.slice(F.flatten("next"), 1, STRETCH)))

    def step(acc: Column, head: Column) -> Column:
        more = F.struct((acc["words"] + F.size(head)).alias("words"), (acc["lines"] + 1).alias("lines"))
        return F.when(acc["words"] < STRETCH // 2, more).otherwise(acc)

    start = F.struct(F.lit(0).alias("words"), F.lit(0).alias("lines"))  # the notice may begin at the line's last word
    last = F.col("paragraph") + F.aggregate("next", start, step, lambda acc: acc["lines"])
    stretches = staged(lines.where(_borne_out(F.col("w"))).select("row", "doc_id", "paragraph", "block", last.alias("last"), F.array_join("w", " ").alias("line")))
    scored = _scored(stretches.select("line").distinct()).where("probability >= 0.5").drop("share").withColumn("pairs", _template_pairs(_words(F.col("line"))))
    share = F.lit(0.0)
    for family, found in _pair_shares(F.col("pairs")).items():
        share = F.when(F.col("family") == family, found).otherwise(share)
    found = stretches.join(scored.withColumn("share", share).where(F.col("share") >= CONFIRM).drop("pairs"), "line")
    # of the stretches that hold a notice, the last that holds all that is there
    best = found.groupBy("row", "block", "family").agg(F.max(F.struct("share", "paragraph", "last", "probability", "doc_id")).alias("b"))
    return best.select("row", "b.doc_id", "b.paragraph", "b.last", "family", "b.probability")


def find_licenses(docs: DataFrame) -> DataFrame:
    """A row per licence paragraph of ``docs`` (doc_id, text): doc_id, paragraph, family, probability, confirmed.

    A paragraph is a line, or a notice that runs over several lines without a
    blank one between; ``paragraph`` counts lines from 0 and is the first of
    the notice's. Rows are those whose class is not "none"; family "unknown" is
    licence text of other terms, or of too little likeness to tell. confirmed
    says that the words of a template of the family are found there (a share of
    CONFIRM or more; of the neighbouring pairs of words if over several lines).
    A notice over several lines has one row a family and run of lines; its
    lines, as many as hold the longest template, have no unconfirmed rows. A null or empty text has no
    rows. Rows that repeat a doc_id each give their own. Other columns are not
    read. An empty table gives an empty result.
    """
    weights, _ = train()
    keys = sorted({w for g in weights for w in g.split() if w not in _COMMON})
    known = F.array(*map(F.lit, keys))
    has_key = lambda line: F.arrays_overlap(_words(line), known)
    some = docs.select("doc_id", "text").where(has_key(F.col("text"))).withColumn("row", F.monotonically_increasing_id())
    some = some.withColumn("whole", F.col("text").contains("\n") & _borne_out(_words(F.col("text"))))
    lines = some.select("row", "doc_id", "whole", F.posexplode(F.split("text", "\n", -1)).alias("paragraph", "line")).withColumn("keyed", has_key(F.col("line")))
    lines = staged(lines.where("whole or keyed"))

    # distinct lines are scored once; the model's tables are bounded by the templates
    keyed = lines.where("keyed").select("row", "doc_id", "paragraph", "line")
    scored = _scored(keyed.select("line").distinct())
    # what no template bears out is licence text of unknown terms
    scored = scored.withColumn("confirmed", F.col("share") >= CONFIRM).withColumn("family", F.when((F.col("probability") < 0.5) | (F.col("share") < CONFIRM / 2), F.lit("unknown")).otherwise(F.col("family")))
    scored = scored.withColumn("confirmed", F.col("confirmed") & (F.col("family") != "unknown"))
    judged = staged(keyed.join(scored, "line").select("row", "doc_id", "paragraph", "family", "probability", "confirmed"))

    notices = staged(_wrapped_notices(lines.where("whole"), judged))
    inside = notices.select(F.col("row").alias("_row"), F.col("paragraph").alias("_first"), F.col("last").alias("_last"))
    alone = judged.join(inside, (F.col("row") == F.col("_row")) & F.col("paragraph").between(F.col("_first"), F.col("_last")) & ~F.col("confirmed"), "left_anti")
    out = alone.unionByName(notices.drop("last").withColumn("confirmed", F.lit(True)))
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("paragraph").cast("long").alias("paragraph"), "family", F.round("probability", 4).alias("probability"), "confirmed")
