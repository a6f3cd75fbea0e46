"""Column expressions over whole texts, all evaluated inside Spark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.llm.shared import SPACE_RUN, SPACES


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with ``value`` evaluated once per row, however often f names it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def text_of(column: str = "text") -> Column:
    """The text, empty if null."""
    return F.coalesce(F.col(column), F.lit(""))


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE_RUN, -1), "")


def without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def count_of(text: Column, characters: str) -> Column:
    """How many characters of ``text`` are among ``characters``."""
    return let(text, lambda t: (F.length(t) - F.length(without(t, characters))).cast("long"))


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def word_chars(text: Column) -> Column:
    return F.length(without(text, SPACES)).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def repeat_words(w: Column, size: int = 5) -> Column:
    """Of an array of words, those inside windows of ``size`` words that stand there twice or more, the first included.

    Windows are compared by 64-bit hashes. Words without a repeated window are
    settled by one distinct; otherwise the windows are sorted to find equals
    next to each other, so the work stays near linear in long texts.
    """

    def covered(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def repeated(s: Column) -> Column:
            def own(x: Column, k: Column) -> Column:
                before, after = F.get(s, k - 1), F.get(s, k + 1)
                same = F.coalesce(before["h"] == x["h"], F.lit(False)) | F.coalesce(after["h"] == x["h"], F.lit(False))
                return F.when(same, x["i"])

            places = F.sort_array(F.filter(F.transform(s, own), lambda x: x.isNotNull()))
            return let(places, lambda p: total(F.transform(p, lambda x, k: F.least(F.lit(size), F.coalesce(F.get(p, k + 1) - x, F.lit(size))))))

        return let(pairs, repeated)

    hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (size - 1)), lambda i: F.xxhash64(F.slice(w, i, size)))
    some = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0).cast("long")))
    return F.when(F.size(w) > size, some).otherwise(F.lit(0).cast("long"))


def n_repeat_words(text: Column, size: int = 5) -> Column:
    return let(words(text), lambda w: repeat_words(w, size))
