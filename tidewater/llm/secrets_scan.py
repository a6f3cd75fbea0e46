"""Secrets in texts (operator 7), in Spark expressions only.

Three kinds follow fixed patterns. A fourth, ``random``, comes from a battery
of randomness tests on long runs of code characters that hold a digit:

- The encoding (hex, base32, base64) is inferred from the characters.
- A chi-squared statistic compares the symbol counts with a uniform alphabet.
  Written text repeats symbols; its statistic is a noncentral chi-squared value
  that grows with length. The p-value is the chance that such text looks as
  even as this run does, so it falls with length for random runs.
- A runs test above and below the middle of the alphabet, and the serial
  correlation of neighbouring symbols, reject patterned runs such as counters.
- False discoveries are held to a rate by the Benjamini-Hochberg rule within
  classes of length, over all runs of all texts, so that the many short runs
  do not loosen the threshold of the long ones or the other way round.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.columns import let, text_of

KINDS = ("assign", "access", "hex", "random")
# fixed values: the patterns of the base kinds
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"

# a run of at least 20 code characters, one of them a digit
RUN = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{20,}={0,2}"
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
# per encoding: the alphabet, and how often two symbols of written text are equal, times the alphabet's size
ENCODINGS = {"hex": ("0123456789abcdef", 2.0), "base32": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 2.5), "base64": (BASE64, 3.0)}
LENGTHS = (20, 32, 48, 80)  # classes of length begin here
BINS = 400
RATE = 0.05
PATTERNED = 3.0  # standard deviations of the runs test and the serial correlation


def _spans(text: Column, pattern: str, kind: int, least: int, group: int = 0) -> Column:
    """array<struct<start, kind, end>> of the matches whose ``group`` has ``least`` characters, in code points.

    Matches and what stands between them alternate, so the lengths of the parts add up to places.
    """

    def places(parts: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            start = acc["at"] + F.length(F.get(parts["gaps"], i))
            end = start + F.length(F.get(parts["all"], i))
            found = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
            ok = F.length(F.get(parts["values"], i)) >= least
            return F.struct(end.alias("at"), F.when(ok, F.concat(acc["out"], F.array(found))).otherwise(acc["out"]).alias("out"))

        empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,kind:int,end:int>>").alias("out"))
        # a match is kept to be measured if it is long enough for the span or may stand before one
        return F.aggregate(F.sequence(F.lit(0), F.size(parts["all"]) - 1), empty, step, lambda acc: acc["out"])

    parts = F.struct(
        F.split(text, pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("all"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("values"),
    )
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return F.when(text.rlike(pattern), let(parts, places)).otherwise(none)


def base_spans(text: Column) -> dict[str, Column]:
    """Spans of each base kind. Runs of hex and access characters are maximal, so a least length in the
    pattern drops the same matches as dropping them afterwards; an assignment's short values are dropped
    afterwards, as they use up their text."""
    return {
        "assign": _spans(text, ASSIGN, 0, 8, group=2),
        "access": _spans(text, ACCESS.replace("+", "{12,}"), 1, 16),
        "hex": _spans(text, HEX.replace("+", "{32,}"), 2, 32),
    }


def _normal_cdf(z: Column) -> Column:
    """A logistic approximation, within 0.0002 of the normal distribution."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(z * -1.5976 - z * z * z * 0.07056))


def _tested(run: Column) -> Column:
    """struct<size, p> of a run: p is null if the run is patterned."""

    def of_symbols(run: Column) -> Column:
        body = F.regexp_replace(run, "=+$", "")
        hex_run = body.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")
        base32 = body.rlike("^[A-Z2-7]+$")
        plain = F.when(hex_run, F.lower(body)).otherwise(F.translate(body, "-_", "+/"))
        pick = lambda k: F.when(hex_run, F.lit(ENCODINGS["hex"][k])).when(base32, F.lit(ENCODINGS["base32"][k])).otherwise(F.lit(ENCODINGS["base64"][k]))
        chars = F.array_remove(F.split(plain, "", -1), "")
        return F.struct(chars.alias("chars"), pick(0).alias("alphabet"), pick(1).alias("repeats"), F.length(body).alias("n"))

    def of_places(s: Column) -> Column:
        m = F.length(s["alphabet"])
        x = F.transform(s["chars"], lambda c: F.instr(s["alphabet"], c) - 1)
        squares = F.aggregate(
            F.array_distinct(s["chars"]), F.lit(0.0), lambda a, c: a + F.pow(F.size(F.filter(s["chars"], lambda y: y == c)).cast("double"), F.lit(2.0))
        )
        return F.struct(x.alias("x"), m.alias("m"), s["n"].alias("n"), s["repeats"].alias("repeats"), squares.alias("squares"))

    def of_sums(t: Column) -> Column:
        n = t["n"].cast("double")
        sums = lambda values: F.aggregate(values, F.lit(0.0), lambda a, v: a + v)
        at = lambda i: F.get(t["x"], i)
        high = lambda v: (v * 2 >= t["m"]).cast("double")
        steps = F.sequence(F.lit(1), t["n"] - 1)
        return F.struct(
            t["n"].alias("size"), n.alias("n"), t["m"].cast("double").alias("m"), t["repeats"].alias("repeats"), t["squares"].alias("squares"),
            sums(F.transform(t["x"], lambda v: v.cast("double"))).alias("sx"),
            sums(F.transform(t["x"], lambda v: (v * v).cast("double"))).alias("sxx"),
            sums(F.transform(t["x"], lambda v, i: (v * at((i + 1) % t["n"])).cast("double"))).alias("sxy"),
            sums(F.transform(t["x"], high)).alias("n1"),
            sums(F.transform(steps, lambda i: F.abs(high(at(i)) - high(at(i - 1))))).alias("turns"),
        )

    def verdict(t: Column) -> Column:
        n, m = t["n"], t["m"]
        chi = m / n * t["squares"] - n
        far = n * (t["repeats"] - 1)  # the noncentrality of written text
        p = _normal_cdf((chi - (m - 1 + far)) / F.sqrt((m - 1 + far * 2) * 2))
        both = t["n1"] * (n - t["n1"]) * 2
        runs_var = both * (both - n) / (n * n * (n - 1))
        runs_z = F.when(runs_var > 0, (t["turns"] - both / n) / F.sqrt(runs_var)).otherwise(F.lit(99.0))
        spread = n * t["sxx"] - t["sx"] * t["sx"]
        serial_z = F.when(spread > 0, ((n * t["sxy"] - t["sx"] * t["sx"]) / spread + 1 / (n - 1)) * F.sqrt(n)).otherwise(F.lit(99.0))
        even = (F.abs(runs_z) <= PATTERNED) & (F.abs(serial_z) <= PATTERNED)
        return F.struct(t["size"].alias("size"), F.when(even, F.greatest(p, F.lit(1e-12))).otherwise(F.lit(1.0)).alias("p"))

    return let(let(let(let(run, of_symbols), of_places), of_sums), verdict)


def _candidates(text: Column) -> Column:
    """array<struct<start, kind, end, size, p>> of the code runs of a text."""

    def tested(s: Column) -> Column:
        return let(_tested(F.substring(text, s["start"] + 1, s["end"] - s["start"])), lambda t: F.struct(s["start"], s["kind"], s["end"], t["size"].alias("size"), t["p"].alias("p")))

    return F.transform(_spans(text, RUN, 3, 20), tested)


def _length_class(size: Column) -> Column:
    out = F.lit(0)
    for k, least in enumerate(LENGTHS[1:], 1):
        out = F.when(size >= least, k).otherwise(out)
    return out


def _thresholds(runs: DataFrame) -> dict[int, float]:
    """The largest p-value to accept in each class of length, from counts in BINS bins of its logarithm (a bounded table)."""
    width = 12.0 / BINS
    counts = runs.groupBy(
        _length_class(F.col("r.size")).alias("k"), F.least(F.floor(-F.log10("r.p") / width), F.lit(BINS - 1)).cast("int").alias("bin")
    ).agg(F.count("*").alias("n"))
    by_class: dict[int, dict[int, int]] = {}
    for row in counts.collect():  # at most len(LENGTHS) * BINS rows
        by_class.setdefault(row["k"], {})[row["bin"]] = row["n"]
    out = {}
    for k, bins in by_class.items():
        all_runs, below, accepted = sum(bins.values()), 0, 0.0
        for b in sorted(bins, reverse=True):  # from the smallest p-values
            below += bins[b]
            top = math.pow(10, -b * width)  # the bin's largest
            if top <= RATE * below / all_runs:
                accepted = top
        out[k] = accepted
    return out


def find_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` (with a column text) plus ``base`` and ``spans``.

    Both are arrays of (start, kind, end) by start, then kind, in code points,
    end exclusive; kind is a place in KINDS. ``base`` holds the kinds with a
    pattern, ``spans`` also random runs that no base span touches. A null text
    counts as empty: no spans. Columns named base or spans are replaced, others
    pass through. An empty table gives an empty result.
    """
    text = text_of()
    runs = docs.where(F.col("text").rlike(RUN)).select(F.explode(_candidates(text)).alias("r"))
    accepted = _thresholds(runs)
    limit = F.lit(0.0)
    kinds = base_spans(text)
    out = docs.withColumn("base", F.sort_array(F.concat(*kinds.values())))

    def added(base: Column) -> Column:
        def clear(r: Column) -> Column:
            bar = limit
            for k, p in accepted.items():
                bar = F.when(_length_class(r["size"]) == k, F.lit(p)).otherwise(bar)
            return (r["p"] <= bar) & ~F.exists(base, lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"]))

        return F.transform(F.filter(_candidates(text), clear), lambda r: F.struct(r["start"].alias("start"), r["kind"].alias("kind"), r["end"].alias("end")))

    some = F.when(text.rlike(RUN), F.sort_array(F.concat("base", added(F.col("base"))))).otherwise(F.col("base"))
    return out.withColumn("spans", some)


def described(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with each stretch that spans cover replaced by ``mark``."""

    def cut(t: Column) -> Column:
        def step(acc: Column, s: Column) -> Column:
            more = F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.substring(t, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))).otherwise(acc["out"])
            return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), more.alias("out"))

        start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
        return F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(t, acc["at"] + 1, F.length(t))))

    return F.when(F.size(spans) > 0, let(text, cut)).otherwise(text)
