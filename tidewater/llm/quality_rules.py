"""Quality rules as a short-circuit cascade (operator 1), in Spark expressions only.

Each rule is a condition on a text that rejects it. Their cost and rejection
rate are measured on a sample, and the rules are ordered by rejection per
cost. One CASE then tries them in that order and stops at the first that
rejects, so a costly rule only runs on texts that the cheap ones let pass. The
order changes the time taken and which rule is named, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm import columns as C
from tidewater.llm.columns import let
from tidewater.llm.shared import staged

SYMBOLS = "#*$%&|<>"
SAMPLE_ROWS = 500


@dataclass(frozen=True)
class Rule:
    """``rejects`` maps the text (never null) to a boolean that is true for texts to drop."""

    name: str
    rejects: Callable[[Column], Column]


def _shouts(text: Column) -> Column:
    letters = F.length(F.regexp_replace(text, r"\P{L}+", ""))
    return F.length(F.regexp_replace(text, r"\P{Lu}+", "")) * 100 > letters * 30


def _odd_length(text: Column) -> Column:
    return let(F.struct(C.word_chars(text).alias("c"), C.n_words(text).alias("n")), lambda x: (x["c"] > x["n"] * 15) | (x["c"] < x["n"] * 2))


# the rules whose counts the word statistics hold as well
COUNTED_RULES = (
    Rule("few_words", lambda t: C.n_words(t) < 10),
    Rule("repeated_words", lambda t: let(C.words(t), lambda w: C.repeat_words(w) * 100 > F.size(w) * 20)),
)
SHAPE_RULES = (
    Rule("symbols", lambda t: let(t, lambda x: C.count_of(x, SYMBOLS) * 100 > C.n_words(x) * 10)),
    Rule("upper_case", _shouts),
    Rule("word_length", _odd_length),
    Rule("repeated_lines", lambda t: let(t, lambda x: C.n_dup_lines(x) * 100 > F.size(F.split(x, "\n", -1)) * 50)),
)
DEFAULT_RULES = COUNTED_RULES + SHAPE_RULES


@dataclass(frozen=True)
class Measured:
    rule: Rule
    seconds: float
    rejected: float

    @property
    def worth(self) -> float:
        return self.rejected / self.seconds


def order_rules(docs: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES, sample_rows: int = SAMPLE_ROWS) -> list[Measured]:
    """The rules with cost and rejection rate on up to ``sample_rows`` rows of ``docs``, best first.

    On an empty table no rule rejects anything and they keep their order.
    """
    sample = staged(docs.select(C.text_of().alias("text")).limit(sample_rows))

    def seconds(value: Column) -> tuple[float, float]:
        best, got = float("inf"), 0.0
        for _ in range(2):  # the first run also compiles
            began = time.perf_counter()
            got = sample.agg(F.avg(value.cast("double"))).first()[0] or 0.0
            best = min(best, time.perf_counter() - began)
        return best, got

    idle, _ = seconds(F.length("text") < 0)
    out = []
    for rule in rules:
        took, rejected = seconds(rule.rejects(F.col("text")))
        out.append(Measured(rule, max(took - idle, 0.001), rejected))
    return sorted(out, key=lambda m: -m.worth)


def failed_rule(text: Column, rules: Sequence[Rule]) -> Column:
    """The first of ``rules`` that rejects the text, null if none does; later rules are not evaluated."""
    out = None
    for rule in rules:
        case = rule.rejects(text), F.lit(rule.name)
        out = F.when(*case) if out is None else out.when(*case)
    return F.lit(None).cast("string") if out is None else out


def judge(docs: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` (with a column text) plus failed_rule (null if kept) and kept.

    A null text counts as empty, and a text without words is rejected by the
    default rules. Other columns pass through, whatever their nulls; a column
    already named failed_rule or kept is replaced. Each row is judged alone.
    """
    order = [m.rule for m in order_rules(docs, rules, sample_rows)]
    return docs.withColumn("failed_rule", failed_rule(C.text_of(), order)).withColumn("kept", F.col("failed_rule").isNull())


def word_statistics(text: Column) -> Column:
    """struct<n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words>; the words are split once."""
    of_words = let(C.words(text), lambda w: F.struct(F.size(w).cast("long").alias("n"), C.repeat_words(w).alias("r")))
    return let(
        of_words,
        lambda w: F.struct(
            w["n"].alias("n_words"),
            C.word_chars(text).alias("word_chars"),
            C.count_of(text, SYMBOLS).alias("n_symbols"),
            C.n_dup_lines(text).alias("n_dup_lines"),
            w["r"].alias("n_repeat_words"),
        ),
    )
