"""Near copies, repeated windows and leaks against brute force."""

from collections import Counter, defaultdict


import pytest

from tests.llm.conftest import WORD, lowered, odd_texts, shingles
from tidewater.llm import near_dedup
from tidewater.llm.components import components
from tidewater.llm.leaks import leaks
from tidewater.llm.near_dedup import near_duplicates
from tidewater.llm.substrings import remove_repeats


def brute_components(texts, percent=85):
    sets = {i: shingles(t) for i, t in texts.items()}
    at = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            at[x].append(i)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in sets.items():
        for j, n in Counter(j for x in s for j in at[x] if j < i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def test_near_duplicates_equal_brute_force(odd_docs):
    rows = near_duplicates(odd_docs).collect()
    want = brute_components(dict(enumerate(odd_texts())))
    assert len(rows) == odd_docs.count()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows if r.doc_id is not None} == want
    (null,) = [r for r in rows if r.doc_id is None]
    assert null.component_id is None and null.kept


@pytest.mark.parametrize("block,lot", [(512, 4096), (16, 8)])
def test_near_duplicates_of_a_large_group(spark, monkeypatch, block, lot):
    """More near copies than a block holds, a few stragglers that reach them by one member, and a group of look-alikes below the bound."""
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", block)
    monkeypatch.setattr(near_dedup, "LOT_ROWS", lot)
    base = [f"b{i}" for i in range(100)]
    texts = {}
    for k in range(700):
        w = list(base)
        w[k % 100] = f"x{k}"
        texts[k] = " ".join(w)
    for k in range(3):  # each near one member only
        w = texts[k * 50].split()
        w[(k * 50 + 40) % 100] = f"y{k}"
        texts[1000 + k] = " ".join(w)
    for k in range(60):  # share two thirds of their shingles
        texts[2000 + k] = " ".join(base[:70] + [f"z{k}_{i}" for i in range(20)])
    docs = spark.createDataFrame([*texts.items()], "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs).collect()}
    assert got == brute_components(texts)


def test_near_duplicates_empty(no_docs):
    assert near_duplicates(no_docs).collect() == []


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (300, 301), (301, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(50)} | {300: 300, 301: 300}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_repeats(texts, size=13):
    words = {i: WORD.findall(t or "") for i, t in texts.items()}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - size + 1):
            first.setdefault(tuple(words[i][k : k + size]), i)
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if first[tuple(w[k : k + size])] < i:
                gone[k : k + size] = [True] * size
        out[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g))
    return out


def test_repeats_equal_brute_force(odd_docs):
    rows = remove_repeats(odd_docs).collect()
    want = brute_repeats(dict(enumerate(odd_texts())))
    assert len(rows) == odd_docs.count()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in rows if r.doc_id is not None} == want
    (null,) = [r for r in rows if r.doc_id is None]  # larger than all others: its copy is removed whole
    assert null.n_removed == null.n_words == want[6][0]


def test_repeats_at_every_shift(spark):
    """A passage of exactly 13 words is found wherever it starts; 12 words are not."""
    passage = [f"p{i}" for i in range(13)]
    texts = {k: " ".join([f"d{k}_{i}" for i in range(k % 9)] + (passage if k < 80 else passage[:12]) + [f"e{k}_{i}" for i in range(k // 9)]) for k in range(90)}
    docs = spark.createDataFrame([*texts.items()], "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in remove_repeats(docs).collect()}
    assert got == brute_repeats(texts)


def test_repeats_empty(no_docs):
    assert remove_repeats(no_docs).collect() == []


ITEMS = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (2, "Only three words"), (3, None), (4, ""), (None, "alpha beta gamma delta epsilon"), (5, "a b c d e f g h i j k l m n o p q r s t")]
ITEMS += [(6, "w29999 V0"), (7, "R2"), (8, "one two three four"), (9, "never there"), (10, "w1 w3")]


def leak_texts():
    item = ITEMS[5][1]
    return {
        0: "before it " + ITEMS[0][1].upper() + " after it",
        1: "only THREE words",
        2: "there are only three words",
        3: " ".join(f"w{i}" for i in range(30_000)) + " " + item + " " + " ".join(f"v{i}" for i in range(30_000)),
        4: item.replace("j", "J2"),  # 11 of 16 shingles
        5: item.replace(" r s t", " R2 s t"),  # 13 of 16
        6: None,
        7: "",
        8: "ONE two three four",
        9: "four three two one two three four r2 five one two three four",
        10: "one two three",
    }


def grams(text, size):
    w = WORD.findall(lowered(text))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def test_leaks_equal_brute_force(spark):
    texts = leak_texts()
    docs = spark.createDataFrame([(i, t, "x", i) for i, t in texts.items()] + [(0, texts[0], "x", 0), (None, texts[0], "x", 0)], "doc_id long, text string, n_windows string, v long")
    items = spark.createDataFrame([(i, t, 1) for i, t in [*ITEMS, ITEMS[0]]], "item_id long, text string, n int")
    got = sorted(tuple(r) for r in leaks(docs, items).collect())
    want = []
    for i, t in texts.items():
        for k, item in ITEMS:
            s = shingles(item)  # an item of fewer than five words is one shingle
            shared = len(s & grams(t, min(5, len(WORD.findall(item or "")) or 5)))
            if k is not None and s and 100 * shared >= 80 * len(s):
                want.append((i, k, len(s), shared))
    assert got == sorted(want)
    assert {w[:2] for w in want} == {(0, 1), (1, 2), (2, 2), (3, 5), (5, 5), (5, 7), (8, 8), (9, 7), (9, 8)}


def test_leaks_without_rows(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert leaks(odd_docs, none).collect() == []
    assert leaks(no_docs, spark.createDataFrame(ITEMS, "item_id long, text string")).collect() == []


