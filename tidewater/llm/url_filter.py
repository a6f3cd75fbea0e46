"""URL filters by host word segmentation and naive Bayes (operator 6).

Rules on host and path decide first. For the other URLs the host's labels and
the path are split into words: a unigram Viterbi finds the most likely words
of a concatenated name, by word counts taken over a whole text column. A
multinomial naive Bayes over these words then tells unwanted sites. Its counts
come from all URLs, labelled by a short list of words that mark such sites; a
word that keeps their company (the "cheap" of "cheappills") gains weight.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.shared import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# words that mark unwanted sites, the seed of the labels
BLOCK_WORDS = frozenset("ads adserver adult bets betting casino cialis malware phishing pills poker porn sex spam tracker track viagra warez xxx".split())
# words of site names that texts may lack, so that names made of them come apart
NAME_WORDS = frozenset("best bet blog buy cdn cheap farm free game games home mail mobile news online play shop site store video web win wiki www".split())
BROADCAST_BYTES = 24 << 20  # words, names and URLs are broadcast up to this many bytes as measured, else joined by a shuffle


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): empty for null or without "://"."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"\A([^?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest of ``rules`` that fits, null if none; a rule is "domain/path" with block or allow."""
    rule = verdict = None
    for name, what in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        domain, _, prefix = name.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + prefix)
        rule = F.when(fits, name) if rule is None else rule.when(fits, name)
        verdict = F.when(fits, what) if verdict is None else verdict.when(fits, what)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def _small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast only if its rows, measured as text and 16 bytes a column, have at most BROADCAST_BYTES."""
    size = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in df.columns), F.lit(16))
    return F.broadcast(df) if (df.agg(F.sum(size.cast("long"))).first()[0] or 0) <= BROADCAST_BYTES else df


def word_counts(texts: DataFrame, column: str) -> DataFrame:
    """(w, n): how often each word stands in a text column, over all its rows. No word is dropped."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(F.col(column)), r"(?s)<(script|style)\b.*?</\1>", " "), "<[^>]*>", " ")
    words = texts.select(F.explode(F.regexp_extract_all(plain, F.lit(r"[a-z]+"), F.lit(0))).alias("w"))
    return staged(words.groupBy("w").agg(F.count("*").alias("n")))


def unigrams(texts: DataFrame, column: str) -> dict[str, int]:
    """``word_counts`` on the driver, for small tables."""
    return {r["w"]: r["n"] for r in word_counts(texts, column).collect()}


class Segmenter:
    """The most likely words of a name, by unigram counts (Viterbi).

    ``counts`` are all words of the model, to which the listed words are added;
    or, if ``total`` is given, those that a name can hold, with ``total`` the
    sum of the counts of the whole model, listed words included.
    """

    def __init__(self, counts: dict[str, int], total: int | None = None):
        if total is None:
            extra = listed_count(sum(counts.values()))
            counts = {**counts, **{w: max(counts.get(w, 0), extra) for w in BLOCK_WORDS | NAME_WORDS}}
            total = sum(counts.values())
        self.cost = {w: -math.log(n / total) for w, n in counts.items()}
        self.lengths = sorted({len(w) for w in counts}, reverse=True)
        self.total = math.log(total)

    def split(self, name: str) -> tuple[str, ...]:
        # an unknown stretch is cheaper whole than in parts, but dearer than known words: it costs
        # a start and 2.5 a letter, so the best start of one that ends here is kept as i moves on
        best: list[tuple[float, int]] = [(0.0, 0)]
        start = (0.0, 0)  # least best[j] - 2.5 * j
        for i in range(1, len(name) + 1):
            start = min(start, (best[i - 1][0] - 2.5 * (i - 1), -(i - 1)))
            found = [(start[0] + 2.5 * i + self.total, start[1])]
            for n in self.lengths:
                if n <= i and (cost := self.cost.get(name[i - n : i])) is not None:
                    found.append((best[i - n][0] + cost, n - i))
            best.append(min(found))
        out, i = [], len(name)
        while i:
            j = -best[i][1]
            out.append(name[j:i])
            i = j
        return tuple(out[::-1])


def listed_count(total: int) -> int:
    """What a listed word counts at least, in a model of ``total`` words."""
    return max(10, (total or 1) // 10_000)


def _splits(names: DataFrame, counts: DataFrame) -> DataFrame:
    """(run, words): the words of each distinct ``run`` of letters; words without a count are "<other>".

    Of the model only the words that occur inside a name are looked up, so it
    may be of any size.
    """
    extra = listed_count(counts.agg(F.sum("n")).first()[0] or 0)
    listed = names.sparkSession.createDataFrame([(w, extra) for w in sorted(BLOCK_WORDS | NAME_WORDS)], "w string, n long")
    model = counts.unionByName(listed).groupBy("w").agg(F.max("n").alias("n"))
    total = model.agg(F.sum("n")).first()[0]
    # of a name only the stretches of a length that some word has are looked up
    lengths = sorted(r[0] for r in model.select(F.length("w")).distinct().collect())
    places = "transform(sequence(1, greatest(length(run) - l + 1, 1)), i -> substring(run, i, l))"
    inside = f"flatten(transform(filter(array({', '.join(map(str, lengths))}), l -> l <= length(run)), l -> {places}))"
    parts = names.select("run", F.explode(F.array_distinct(F.expr(inside))).alias("w"))
    needed = staged(parts.select("w").distinct().join(model, "w"))
    known = parts.join(_small(needed), "w").select("run", F.struct("w", "n").alias("known"))
    known = known.unionByName(names.select("run", F.lit(None).cast("struct<w:string,n:bigint>").alias("known")))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name, words in zip(*(batch.column(c).to_pylist() for c in ("run", "known")), strict=True):
                have = {x["w"]: x["n"] for x in words}
                out.append([w if w in have else "<other>" for w in Segmenter(have, total).split(name)])
            yield pa.RecordBatch.from_arrays([batch.column("run"), pa.array(out, pa.list_(pa.string()))], ["run", "words"])

    return staged(known.groupBy("run").agg(F.collect_list("known").alias("known")).mapInArrow(run, "run string, words array<string>"))


def _tokens(pairs: DataFrame, counts: DataFrame) -> DataFrame:
    """``pairs`` (host, path, n) plus tokens: the words of host and path. Path words are marked; numbers are one token, words without a count another."""
    runs = lambda c, mark: F.transform(F.regexp_extract_all(F.lower(c), F.lit("[a-z]+|[0-9]+"), F.lit(0)), lambda r: F.struct(F.lit(mark).alias("mark"), r.alias("run")))
    parts = pairs.select("host", "path", "n", F.posexplode_outer(F.concat(runs("host", ""), runs("path", "/"))).alias("at", "part")).select("host", "path", "n", "at", "part.mark", "part.run")
    number = F.col("run").rlike("^[0-9]")
    names = staged(parts.where(~number).select("run").distinct())
    words = F.when(number, F.array(F.lit("<number>"))).otherwise(F.col("words"))
    parts = parts.join(_small(_splits(names, counts)), "run", "left").select("host", "path", "n", "at", F.transform(words, lambda w: F.concat("mark", w)).alias("t"))
    lists = parts.groupBy("host", "path", "n").agg(F.sort_array(F.collect_list(F.when(F.col("t").isNotNull(), F.struct("at", "t")))).alias("l"))
    return staged(lists.select("host", "path", "n", F.flatten(F.col("l.t")).alias("tokens")))


def _odds(urls: DataFrame) -> DataFrame:
    """(host, path, odds) of ``urls`` (host, path, n, tokens): multinomial naive Bayes with add-one smoothing, its counts over all of them."""
    urls = urls.withColumn("bad", F.arrays_overlap("tokens", F.array(*map(F.lit, sorted(BLOCK_WORDS)))))
    sums = [F.coalesce(F.sum(F.when(side, F.col("n"))), F.lit(0)).alias(name) for name, side in (("good", ~F.col("bad")), ("marked", F.col("bad")))]
    docs = urls.agg(*sums).first()
    counts = staged(urls.select("n", "bad", F.explode("tokens").alias("token")).groupBy("token").agg(*sums))
    total = counts.agg(F.count("*").alias("k"), F.sum("good").alias("good"), F.sum("marked").alias("marked")).first()
    good, marked = ((total[c] or 0) + total["k"] + 1 for c in ("good", "marked"))
    weight = F.log((F.col("marked") + 1) / float(marked)) - F.log((F.col("good") + 1) / float(good))
    weights = _small(counts.select("token", weight.alias("weight")))
    prior = math.log((docs["marked"] + 1) / (docs["good"] + 1))
    parts = urls.where("host <> '' or path <> ''").select("host", "path", F.posexplode_outer("tokens").alias("at", "token")).join(weights, "token", "left")
    # added in the order of the tokens, so that a URL always has the same odds
    lists = parts.groupBy("host", "path").agg(F.sort_array(F.collect_list(F.when(F.col("token").isNotNull(), F.struct("at", "weight")))).alias("l"))
    return staged(lists.select("host", "path", F.aggregate("l", F.lit(prior), lambda a, x: a + x["weight"]).alias("odds")))


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]], counts: dict[str, int] | DataFrame) -> DataFrame:
    """Per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict (block or allow), odds.

    ``rules`` are ("domain/path", verdict): a rule fits its domain and all
    subdomains if the path starts with the rule's; the longest wins, and its
    verdict holds. Otherwise naive Bayes decides, and odds has its log odds of
    block, also for a path without a host. ``counts`` is the unigram model: a table
    (w, n), or a dict of a small one. A null url, or one without "://",
    has an empty host and path, fits no rule and is allowed. Rows that repeat
    a page_id are judged each. Other columns are not read. An empty table gives
    an empty result.
    """
    host, path = url_parts(F.col("url"))
    urls = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    if isinstance(counts, dict):
        counts = pages.sparkSession.createDataFrame([*counts.items()], "w string, n long")
    pairs = staged(urls.groupBy("host", "path").agg(F.count("*").alias("n")))
    scored = urls.join(_small(_odds(_tokens(pairs, counts))), ["host", "path"], "left")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("odds") > 0, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, learned).alias("verdict"), "odds")
