"""Token alignment against the public libraries and brute force."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.conftest import odd_texts
from tests.llm.test_tokens import fuzz
from tidewater.llm import token_alignment as T

JSON, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(JSON)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=MODEL)


def token_bytes(libraries):
    a, b = libraries
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in own} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in own)}
    bytes_a = {i: bytes(letters.get(c, 0) for c in t) for t, i in a.get_vocab().items()}
    piece = lambda p: bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode()
    return bytes_a, {i: piece(b.id_to_piece(i)) for i in range(b.get_piece_size())}


def brute(texts, libraries):
    """Rows in the order of ``texts``: n_a, n_b, n_groups, n_links, n_best, count_sum, groups."""
    a, b = libraries
    bytes_a, bytes_b = token_bytes(libraries)
    cut = []
    for text in texts:
        raw = (" " + text).encode() if text else b""
        ids_a, ids_b = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        if not text or b"".join(bytes_a[i] for i in ids_a) != raw or b"".join(bytes_b[i] for i in ids_b) != raw:
            cut.append([])
            continue
        ends = [[], []]
        for k, (ids, own) in enumerate(((ids_a, bytes_a), (ids_b, bytes_b))):
            at = 0
            for i in ids:
                ends[k].append(at := at + len(own[i]))
        groups, ia, ib = [], 0, 0
        for e in sorted({*ends[0]} & {*ends[1]}):
            ja, jb = ends[0].index(e, ia) + 1, ends[1].index(e, ib) + 1
            groups.append((ids_a[ia:ja], ids_b[ib:jb]))
            ia, ib = ja, jb
        cut.append(groups)
    links = [Counter((x, y) for ga, gb in groups for x in ga for y in gb) for groups in cut]
    counts = Counter(p for own in links for p in own)
    most = {}
    for (x, _), n in counts.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for groups, own in zip(cut, links, strict=True):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((
            sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(own.values()),
            sum(n for p, n in own.items() if counts[p] == most[p[0]]), sum(n * counts[p] for p, n in own.items()), text,
        ))
    return out


SPECIAL = ["a<|endoftext|> b", "<s> x </s>", "<unk>", "<0x41>", "a▁b", "▁", " ▁ x", "two  spaces   and more ", "  lead", "tail  ", " ", "\n", "\0nul\0",
           "é ﬁ ℌ ﻿bom", "don't I'LL 12345 1 2", "日本語 中文字 한국어", "🙂🙃 👩‍👩‍👧", " x　y z"]


def plain(texts):
    return [t for t in texts if t is None or len(t) < 50_000]


@pytest.mark.parametrize("windows", [100_000, 40])
def test_equals_brute_force(spark, libraries, monkeypatch, windows):
    monkeypatch.setattr(T, "WINDOWS", windows)
    texts = [*plain(odd_texts()), *SPECIAL, *fuzz(300, 7)]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, pairs string, row string").repartition(3)
    got = {r.doc_id: tuple(r)[1:] for r in T.align_tokens(df, JSON, public_tokenizers.PATTERN, MODEL, groups=True).collect()}
    for i, w in enumerate(brute(texts, libraries)):
        sha = hashlib.sha256(w[6].encode()).hexdigest() if w[6] else ""
        assert got[i] == (*w[:6], sha, w[6]), texts[i]
    assert len(got) == len(texts)


def test_joined_by_a_shuffle(spark, libraries, monkeypatch):
    monkeypatch.setattr(T, "BROADCAST_PAIRS", 0)
    texts = fuzz(60, 9)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_best, r.count_sum) for r in T.align_tokens(df, JSON, public_tokenizers.PATTERN, MODEL).collect()}
    assert got == {i: w[4:6] for i, w in enumerate(brute(texts, libraries))}


def test_rows_without_tokens_repeated_rows_and_null_ids(spark, libraries):
    texts = ["one two", "one two", None, "", "a▁b", "three"]
    ids = [1, 1, None, 4, 5, None]
    df = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")
    got = sorted((tuple(r)[:7] for r in T.align_tokens(df, JSON, public_tokenizers.PATTERN, MODEL).collect()), key=repr)
    assert got == sorted(((i, *w[:6]) for i, w in zip(ids, brute(texts, libraries), strict=True)), key=repr)
    assert T.align_tokens(df.limit(0), JSON, public_tokenizers.PATTERN, MODEL).collect() == []


def test_windows_are_cut_at_space_marked_tokens():
    """Every window is found once and remembered under its ids."""
    import numpy as np

    aligner, rng = T.Aligner(JSON, public_tokenizers.PATTERN, MODEL), random.Random(1)
    words = ["hello", "unbelievable", "x1y2", "naïve", "word,"]
    text = " ".join(rng.choice(words) for _ in range(400)).encode()
    got = aligner.batch(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert len(aligner.memory.keys) == len(words)
    assert got["groups"][0].count(";") + 1 == got["n_groups"][0]
    again = aligner.batch(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert again["groups"] == got["groups"] and len(aligner.memory.keys) == len(words)


def test_two_windows_of_one_hash(monkeypatch):
    """A hash that two windows share is seen by the groups' ends, and the batch is aligned without the memory."""
    import numpy as np

    text = "one unbelievable two naïve x1y2 three".encode()
    data, offsets = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    want = T.Aligner(JSON, public_tokenizers.PATTERN, MODEL).batch(data, offsets)["groups"]
    monkeypatch.setattr(T, "_run_hashes", lambda ids, start, end: np.zeros(len(start), np.uint64))
    assert T.Aligner(JSON, public_tokenizers.PATTERN, MODEL).batch(data, offsets)["groups"] == want


def test_a_very_long_word(libraries):
    import numpy as np

    data = np.frombuffer(("ab" * 35_000).encode(), np.uint8)
    got = T.Aligner(JSON, public_tokenizers.PATTERN, MODEL).batch(data, np.array([0, len(data)]))
    assert got["n_b"][0] == len(libraries[1].encode("ab" * 35_000))
    assert got["n_links"][0] == got["times"].sum()
