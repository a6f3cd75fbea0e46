"""The n-gram join against brute force."""

import random
from collections import Counter, defaultdict

import pytest

from tests.llm.conftest import odd_texts, prose, shingles
from tidewater.llm import ngram_join as N

PERCENT = 90


def brute_links(sets, percent=PERCENT):
    at, links = defaultdict(list), []
    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in at[x])
        links += [(i, j) for j, n in shared.items() if 100 * n >= percent * (len(s) + len(sets[j]) - n)]
        for x in s:
            at[x].append(i)
    return links


def brute(texts, ids=None, percent=PERCENT, words=3):
    """(n_shingles, component) of each text; component is the smallest id reached."""
    ids = ids or list(range(len(texts)))
    sets = [shingles(t, words) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in brute_links(sets, percent):
        root[find(i)] = find(j)
    least = {}
    for i, own in enumerate(ids):
        least[find(i)] = min(own, least.get(find(i), own))
    return [(len(s), least[find(i)]) for i, s in enumerate(sets)]


def joined(spark, texts, ids=None, **more):
    ids = ids or list(range(len(texts)))
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in zip(ids, texts, strict=True)], "doc_id long, text string, c string, hood long").repartition(4)
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in N.ngram_join(df, **more).collect())


def wanted(texts, ids=None, **more):
    ids = ids or list(range(len(texts)))
    return sorted((i, *w) for i, w in zip(ids, brute(texts, ids, **more), strict=True))


def edited(rng, text, changes):
    w = text.split()
    for i in rng.sample(range(len(w)), changes):
        w[i] = rng.choice(["new", "other", f"z{rng.randrange(40)}"])
    return " ".join(w)


def corpus(seed, n=150):
    """Near copies at and around the bound, chains of them, templates whose copies stay below it, short texts."""
    rng = random.Random(seed)
    out = []
    for _ in range(n // 10):
        text = prose(rng, rng.choice([4, 12, 40, 130]), 60)
        for _ in range(8):
            out.append(text)
            k = rng.randrange(0, 3)
            text = edited(rng, out[-1] if rng.random() < 0.5 else out[0], min(k, len(out[-1].split()), len(out[0].split())))
    return out + [" ".join(rng.choice("abc") for _ in range(rng.randrange(5))) for _ in range(30)]


def test_odd_rows_equal_brute_force(spark, odd_docs, no_docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.ngram_join(odd_docs).collect()}
    null = got.pop(None)
    assert got == dict(enumerate(brute(odd_texts())))
    assert null == (len(shingles(odd_texts()[6], 3)), None)
    assert N.ngram_join(odd_docs).count() == odd_docs.count()
    assert N.ngram_join(no_docs).collect() == []


@pytest.mark.parametrize("seed,percent,words", [(1, 90, 3), (4, 51, 2)])
def test_random_near_copies(spark, seed, percent, words):
    texts = corpus(seed)
    assert joined(spark, texts, percent=percent, words=words) == wanted(texts, percent=percent, words=words)


def test_large_neighbourhoods(spark, monkeypatch, sets=9, lot=5):
    """More near copies than a tree holds, most of them linked by one original only, and look-alikes below the bound; nothing is broadcast."""
    for name, value in (("TREE_SETS", sets), ("LOT_SETS", lot), ("BROADCAST_ROWS", 0)):
        monkeypatch.setattr(N, name, value)
    rng = random.Random(5)
    base = [f"b{i}" for i in range(100)]
    texts = [" ".join(base)]
    for k in range(90):  # two changed words: linked with the original, seldom with each other
        w = list(base)
        w[k], w[(k + 37) % 100] = f"x{k % 7}", f"y{k % 5}"
        texts.append(" ".join(w))
    for k in range(60):  # look-alikes that share two thirds
        texts.append(" ".join(base[:60] + [f"q{rng.randrange(50)}" for _ in range(30)]))
    chain = [f"c{i}" for i in range(120)]
    for k in range(60):  # each near the one before
        chain[(k * 7) % 120] = f"d{k % 4}"
        texts.append(" ".join(chain))
    rng.shuffle(texts)
    want = wanted(texts)
    assert joined(spark, texts) == want
    assert len({c for _, _, c in want}) > 10


def test_rows_that_repeat_an_id(spark):
    rng = random.Random(6)
    one, two = prose(rng, 100), prose(rng, 100)
    texts = [one, edited(rng, one, 1), two, edited(rng, two, 1), two, one]
    ids = [5, 7, 5, 3, 5, 5]
    assert joined(spark, texts, ids) == wanted(texts, ids)


@pytest.mark.parametrize("seed", range(6))
def test_trees_find_what_is_linked(seed):
    """One tree, in Python only: components of random sets over few grams, at several bounds."""
    rng = random.Random(seed)
    sets = []
    for _ in range(80):
        s = set(rng.sample(range(60), rng.randrange(1, 40)))
        for _ in range(4):
            sets.append(frozenset(s))
            s = set(s) ^ set(rng.sample(range(60), rng.randrange(3)))
            s = s or {1}
    sets = list(dict.fromkeys(sets))
    for percent in (51, 80, 90):
        tree = N.Tree([sorted(s) for s in sets], [*map(len, sets)], list(range(len(sets))), percent)
        found = []
        for i in range(len(sets)):
            found += tree.links(i)
            tree.store(i)
        links = brute_links(sets, percent)
        assert set(found) <= set(links)
        for i, j in links:
            assert tree.find(i) == tree.find(j)
        assert len({tree.find(i) for i in range(len(sets))}) == len(sets) - len(found)


def test_bounds():
    for percent in (51, 75, 90, 100):
        for n in range(1, 300):
            k = N.missing(n, percent)
            for m in range(-(-n * percent // 100), n + 1):  # partners
                assert N.least_shared(n, percent) <= min(k, N.missing(m, percent)) + 1
