import random
import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "doc_id long, text string, lang string, source string, kept string, spans string, n_words string, chunk string, label string, base string"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def shingles(text, size=5):
    w = WORD.findall(lowered(text))
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" + rng.choice(["", "", "", ".", ","]) for _ in range(n))


def odd_texts():
    """Nulls, empty and white texts, copies, near copies, shared passages, a very long text, odd characters."""
    rng = random.Random(5)
    base = prose(rng, 120)
    passage = prose(rng, 30, 5000)
    texts = [None, "", " \t\n\r\x0b\x0c ", "one", "one two three", "ONE two Three"]
    texts += [base, base, base.upper(), base + " tail", "head " + base]
    words = base.split()
    for k in range(12):  # near copies, each with some words changed
        w = list(words)
        for i in rng.sample(range(len(w)), 1 + k % 3):
            w[i] = f"new{k}"
        texts.append(" ".join(w))
    for _ in range(10):
        texts.append(prose(rng, 60) + "\n" + passage + "\n" + prose(rng, 10))
    texts += [prose(rng, 20_000, 3000), "a" * 70_000, "x y " * 3000, "é\xa0ü　字 word🙂 word"]
    texts += ["same line\nsame line\n\nsame line\nother\n", "no\x1cbreak here\x85either one two three four five six"]
    return texts


@pytest.fixture(scope="session")
def odd_docs(spark):
    """The odd texts with nulls in the other columns, extra columns of clashing names, a repeated row and a null id."""
    rows = [(i, t, None, None, "x", None, "n", None, "l", "b") for i, t in enumerate(odd_texts())]
    rows.append(rows[6])
    rows.append((None, rows[6][1], *rows[6][2:]))
    return spark.createDataFrame(rows, COLUMNS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)
