"""Encoding and counting against the public libraries, and exact round trips."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tests.llm.conftest import odd_texts
from tidewater.llm import tokens as T

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = "ab é \n\t \r'sSt1²٣½_-#中文字🙂​ \x1c\x85\xa0 　ñ́Ⅷ "


@pytest.fixture(scope="module")
def encoder():
    return T.Encoder(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=T.read_ranks(RANKS), special_tokens={})


def fuzz(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_ids_are_the_librarys(encoder, library):
    for text in [*fuzz(3000), *(t for t in odd_texts() if t is not None and len(t) < 50_000), "I'll don't we've 's", "-" * 500, "1234567 89"]:
        ids = encoder.encode(text)
        assert ids == library.encode_ordinary(text)
        assert encoder.decode(ids) == text.encode()


def test_tables_of_appends_and_edits(encoder):
    rng, coder = random.Random(2), encoder.coder
    some = lambda n: bytes(rng.choice(b"abcde  \n\xc3\xa9thein") for _ in range(rng.randint(0, n)))
    for _ in range(500):
        data, more = some(60), some(9)
        table = coder.table(data)
        assert coder.append(data, table, more) == coder.table(data + more)
        i = rng.randint(0, len(data))
        j = rng.randint(i, len(data))
        assert coder.edit(data, table, i, j, more) == coder.table(data[:i] + more + data[j:])


def test_memory_forgets_but_stays_right(library):
    small = T.Encoder(RANKS, public_tokenizers.PATTERN)
    small.memory = T.Memory(50)
    for text in fuzz(400, 3):
        assert small.encode(text) == library.encode_ordinary(text)
        assert len(small.memory.keys) <= 50 + 200


def test_encode_texts(odd_docs, no_docs, library):
    rows = T.encode_texts(odd_docs, RANKS, public_tokenizers.PATTERN, arrays=True).collect()
    texts = dict(enumerate(odd_texts()))
    assert len(rows) == odd_docs.count()
    for r in rows:
        text = texts[6 if r.doc_id is None else r.doc_id] or ""
        ids = library.encode_ordinary(text) if len(text) != 70_000 else list(r.ids)  # the library is slow on one huge piece
        assert (r.n_tokens, r.ids) == (len(ids), ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert T.encode_texts(no_docs, RANKS, public_tokenizers.PATTERN).collect() == []


def test_counts_are_the_librarys(odd_docs, no_docs):
    tokenizer = Tokenizer.from_file(JSON)
    counter = T.Counter(JSON, public_tokenizers.PATTERN)
    for text in [*fuzz(3000, 4), "a<|endoftext|> b", "<|endoftext|><|endoftext|>", " <|endoftext|>\n\n x"]:
        assert counter.count(text) == len(tokenizer.encode(text, add_special_tokens=False).ids)
    texts = dict(enumerate(odd_texts()))
    rows = T.count_tokens(odd_docs, JSON, public_tokenizers.PATTERN, limit=100).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        text = texts[6 if r.doc_id is None else r.doc_id] or ""
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 100)
    assert T.count_tokens(no_docs, JSON, public_tokenizers.PATTERN).collect() == []


def test_special_strings_in_a_table(spark):
    docs = spark.createDataFrame([(1, "a<|endoftext|> b"), (2, "<|endoftext|>"), (3, None)], "doc_id long, text string")
    tokenizer = Tokenizer.from_file(JSON)
    got = {r.doc_id: r.n_tokens for r in T.count_tokens(docs, JSON, public_tokenizers.PATTERN).collect()}
    assert got == {1: len(tokenizer.encode("a<|endoftext|> b").ids), 2: 1, 3: 0}


def test_the_memory_of_token_pairs_is_bounded(library):
    """A worker lives on after its task, so what it remembers must stay small; forgetting changes no id."""
    coder, rng = T.PrefixCoder(T.read_ranks(RANKS)), random.Random(5)
    coder.apart = dict.fromkeys(range(-200_000, 0), True)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5_000))
    assert coder.encode(text.encode()) == library.encode_ordinary(text)
    assert len(coder.apart) <= 100_000
