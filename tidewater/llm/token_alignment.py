"""Alignment of two tokenizers' tokens over whole texts (operator 12).

A byte-level BPE (A) and a sentencepiece model (B) each encode a whole text
behind one space. Byte offsets where tokens of both end cut the tokens into
groups.

1. Both encode whole texts. Their pieces never run over the space before a
   word, so the words of a batch are encoded once each and looked up in a
   bounded memory.
2. Where an A and a B token that open with a space start at the same byte, a
   shared end stands before them. These anchors split a text into windows.
3. A window is a tuple of A ids and one of B ids. The sizes of its groups are
   found once and remembered, by a hash of both tuples, in a bounded memory;
   that every group ends at a shared byte is checked on each use.
4. Each text gives its distinct linked pairs. Spark counts the texts of every
   pair, marks the pairs that are their A id's most frequent, and sums both
   over the links of each text. The table of pairs is broadcast if it was
   counted to be small, else joined by a shuffle whose hot pairs can be split.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.shared import staged, text_parts, within
from tidewater.llm.tokens import Encoder, Memory, PrefixCoder, Splitter, _byte_letters, _once, _ranges
from tidewater.llm.words import mix, span_hashes

WINDOWS = 300_000  # window alignments kept by a worker
LONG_PIECE = 200  # characters
BROADCAST_PAIRS = 1_000_000  # rows of the pair table (two numbers and a mark) that are broadcast at most
_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def byte_level_ranks(path: str) -> dict[bytes, int]:
    """bytes -> id of a byte-level BPE file of the tokenizers library whose ids follow its merges, without added tokens."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocabulary, letters = spec["model"]["vocab"], {c: b for b, c in _byte_letters().items()}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
    if any(vocabulary[a + b] != len(letters) + k for k, (a, b) in enumerate(merges)):
        raise ValueError("ids do not follow the merges")
    added = {t["content"] for t in spec.get("added_tokens", [])}
    return {bytes(letters[c] for c in token): i for token, i in vocabulary.items() if token not in added}


class ByteEncoder(Encoder):
    """Encodes by a byte-level BPE file; special strings inside texts are plain text."""

    def __init__(self, path: str, pattern: str):
        ranks = byte_level_ranks(path)
        self.coder, self.split, self.memory = PrefixCoder(ranks), Splitter(pattern), Memory()
        self.library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes = self.coder.bytes

    def encode_batch(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per row) of a batch of texts. The library makes the ids of a piece, but its time grows with the square of a long one's length."""

        def of_pieces(pieces: Iterable[str]) -> dict[str, list[int]]:
            return {p: self.library.encode_ordinary(p) if len(p) < LONG_PIECE else self.coder.encode(p.encode()) for p in pieces}

        flat, sizes, which, per_row = self.split.results(data, offsets, self.memory, of_pieces)
        n = sizes[which]
        rows = np.concatenate(([0], np.cumsum(n)))[np.concatenate(([0], np.cumsum(per_row)))]
        return flat[_ranges((np.cumsum(sizes) - sizes)[which], n)], np.diff(rows)


class PieceEncoder:
    """Encodes by a sentencepiece model, texts given behind the space that the model adds."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece runs over the space before a word")
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.memory = Memory()

    def encode_batch(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per row) of texts that each open with a space; -1 stands for a word whose tokens do not hold its bytes."""
        space = data == 0x20
        opens = space.copy()
        opens[1:] &= ~space[:-1]  # a word opens with all spaces before it
        opens[offsets[:-1]] = True
        starts = np.flatnonzero(opens)
        ends = np.append(starts[1:], len(data))
        keys, first, which = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)

        def compute(new: np.ndarray) -> list[list[int]]:
            units = [data[a:b].tobytes() for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)]
            made = self.model.encode([u[1:].decode() for u in units], num_threads=1)
            made = [ids or [self.model.piece_to_id("▁")] for ids in made]  # a last space; the model adds none to no text
            return [ids if b"".join([self.bytes[i] for i in ids]) == u else [-1] for u, ids in zip(units, made, strict=True)]

        flat, sizes = self.memory.results(keys, compute)
        n = sizes[which]
        rows = np.concatenate(([0], np.cumsum(n)))[np.searchsorted(starts, offsets, "left")]
        return flat[_ranges((np.cumsum(sizes) - sizes)[which], n)], np.diff(rows)


def shared_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in both of the byte offsets at which tokens of both end; offsets ascend."""
    at = np.searchsorted(ends_b, ends_a)
    same = np.flatnonzero(ends_b[np.minimum(at, len(ends_b) - 1)] == ends_a) if len(ends_b) else np.zeros(0, np.int64)
    return same, at[same]


def _run_hashes(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ids[start:end] of each run, the runs end to end."""
    n = len(ids) + 1
    up, down = np.full(n, _P, np.uint64), np.full(n, np.uint64(pow(int(_P), -1, 1 << 64)), np.uint64)
    up[0] = down[0] = 1
    up, down = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(ids.astype(np.uint64) + _Q) * up[:-1], dtype=np.uint64)))
    return mix((sums[ends] - sums[starts]) * down[starts] ^ ((ends - starts).astype(np.uint64) * _Q))


class Aligner:
    """Aligns batches of texts; remembers the windows met before."""

    def __init__(self, path_a: str, pattern: str, path_b: str):
        self.coders = (ByteEncoder(path_a, pattern), PieceEncoder(path_b))
        self.lens = [np.array([*map(len, e.bytes)], np.int64) for e in self.coders]
        self.space = [np.array([t[:1] == b" " for t in e.bytes]) for e in self.coders]
        self.width = len(self.coders[1].bytes)
        # a token's id in the text of the groups: before another one of its group, and at the end of its side
        self.text = [np.array([f"{i}{mark}" for mark in marks for i in range(len(n))], object) for n, marks in zip(self.lens, (",|", ",;"), strict=True)]
        self.memory = Memory(WINDOWS)

    def batch(self, data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray | list]:
        """Per row: n_a, n_b, n_groups, n_links, text of the groups, and (pairs, times, bounds) of the rows' distinct pairs."""
        full = np.diff(offsets) > 0
        data, offsets = np.insert(data, offsets[:-1], 0x20), offsets + np.arange(len(offsets))
        ids, counts = zip(*(e.encode_batch(data, offsets) for e in self.coders), strict=True)
        row = [np.repeat(np.arange(len(full)), n) for n in counts]
        full[row[1][ids[1] < 0]] = False
        ids, row = ([x[full[r]] for x, r in zip(part, row, strict=True)] for part in (ids, row))  # rows without tokens go
        counts = [np.where(full, n, 0) for n in counts]
        ends = [np.cumsum(n[i]) for n, i in zip(self.lens, ids, strict=True)]

        n_a, n_b = self._groups(ids, ends)
        to_a, to_b = np.cumsum(n_a), np.cumsum(n_b)
        from_a, from_b = to_a - n_a, to_b - n_b
        bounds = np.searchsorted(to_a, np.concatenate(([0], np.cumsum(counts[0]))), "right")  # first group of each row
        links = n_a * n_b
        within = _ranges(np.zeros(len(links), np.int64), links)
        x, y = ids[0][np.repeat(from_a, links) + within // np.repeat(n_b, links)], ids[1][np.repeat(from_b, links) + within % np.repeat(n_b, links)]
        span = len(self.lens[0]) * self.width
        of_row = np.repeat(np.arange(len(full)), np.diff(bounds))
        keys, times = np.unique(np.repeat(of_row, links) * span + (x.astype(np.int64) * self.width + y), return_counts=True)

        cells = np.empty(len(ids[0]) + len(ids[1]), object)  # A and B tokens in the order of the groups' text
        for k, (own, last, before) in enumerate(((n_a, to_a - 1, from_b), (n_b, to_b - 1, to_a))):
            closes = np.zeros(len(ids[k]), np.int64)
            closes[last] = len(self.lens[k])
            cells[np.arange(len(ids[k])) + np.repeat(before, own)] = self.text[k][ids[k] + closes]
        cuts = np.concatenate(([0], np.cumsum(counts[0] + counts[1])))
        return {
            "n_a": counts[0], "n_b": counts[1], "n_groups": np.diff(bounds),
            "n_links": np.diff(np.concatenate(([0], np.cumsum(links)))[bounds]),
            "groups": ["".join(cells[i:j].tolist())[:-1] for i, j in zip(cuts[:-1], cuts[1:], strict=True)],
            "pairs": keys % span, "times": times, "bounds": np.searchsorted(keys // span, np.arange(len(full) + 1)),
        }

    def _groups(self, ids: list[np.ndarray], ends: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """A and B tokens of every group, in order, window by window."""
        if not len(ids[0]):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        # anchors: tokens of both that open with a space at the same byte; every row opens with one
        marked = [np.flatnonzero(space[i]) for space, i in zip(self.space, ids, strict=True)]
        places = [e[m] - n[i[m]] for e, m, n, i in zip(ends, marked, self.lens, ids, strict=True)]
        start = [m[s] for m, s in zip(marked, shared_ends(*places), strict=True)]
        sizes = [np.diff(np.append(s, len(i))) for s, i in zip(start, ids, strict=True)]
        hashes = mix(_run_hashes(ids[0], start[0], start[0] + sizes[0]) + _Q * _run_hashes(ids[1], start[1], start[1] + sizes[1]))
        keys, first, which = np.unique(hashes, return_index=True, return_inverse=True)

        def compute(new: np.ndarray) -> list[list[int]]:
            return self._aligned(ends, *(x[first[new]] for x in (*start, *sizes)))

        flat, n = self.memory.results(keys, compute)
        found = flat[_ranges((np.cumsum(n) - n)[which], n[which])].astype(np.int64)
        n_a, n_b = found[::2], found[1::2]
        # a window's answer is one of its own ids only if its groups end at shared bytes; else two tuples have one hash
        to_a, to_b = np.cumsum(n_a), np.cumsum(n_b)
        if to_a[-1] != len(ids[0]) or to_b[-1] != len(ids[1]) or (ends[0][to_a - 1] != ends[1][to_b - 1]).any():
            a, b = shared_ends(*ends)
            n_a, n_b = np.diff(a, prepend=-1), np.diff(b, prepend=-1)
        return n_a, n_b

    @staticmethod
    def _aligned(ends: list[np.ndarray], from_a: np.ndarray, from_b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> list[list[int]]:
        """Tokens of A and of B in each group, in turn, of each of some windows."""
        order = np.argsort(from_a, kind="stable")
        own = [ends[k][_ranges(at[order], n[order])] for k, (at, n) in enumerate(((from_a, size_a), (from_b, size_b)))]
        a, b = shared_ends(*own)
        groups = np.column_stack((np.diff(a, prepend=-1), np.diff(b, prepend=-1))).ravel().tolist()
        each = 2 * np.bincount(np.repeat(np.arange(len(order)), size_a[order])[a], minlength=len(order))
        out: list[list[int]] = [[]] * len(order)
        end = 0
        for k, n in zip(order.tolist(), each.tolist(), strict=True):
            out[k] = groups[end : end + n]
            end += n
        return out


def align_tokens(docs: DataFrame, path_a: str, pattern: str, path_b: str, groups: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, and ``groups`` if asked for.

    A is the byte-level BPE file at ``path_a`` with its split ``pattern``, B the
    sentencepiece model at ``path_b``, both without special tokens; their bytes
    are those of a space and the text. Groups run between the byte offsets where
    tokens of both end, written ``a1,a2|b1;a3|b2``. Every A and B token of a
    group are a link. The count of an id pair is the number of rows that hold
    it linked; n_best are the links whose count is the highest of their A id
    (ties included), count_sum is the sum of the counts over the links. A text
    that is null, empty or whose tokens of either kind do not hold its bytes has
    no tokens: zeros and ''. Other columns are not read; doc_id may be null or
    repeated, each row counts as a text. An empty table gives an empty result.
    The files must stand on every machine.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _once(Aligner, path_a, pattern, path_b)
        for part, data, offsets in text_parts(batches, 1 << 20):
            got = aligner.batch(data, offsets)
            sha = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in got["groups"]]
            lists = [pa.ListArray.from_arrays(pa.array(got["bounds"], pa.int32()), pa.array(got[c], pa.int64())) for c in ("pairs", "times")]
            cols = [part.column("row"), part.column("doc_id"), *(pa.array(got[c], pa.int64()) for c in names[2:6]), pa.array(sha, pa.string())]
            yield pa.RecordBatch.from_arrays([*cols, *lists, *([pa.array(got["groups"], pa.string())] if groups else [])], names)

    names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times", *(["groups"] if groups else [])]
    kinds = ["long"] * 6 + ["string", "array<long>", "array<long>", "string"]
    docs = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    made = staged(docs.mapInArrow(run, ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=False))))

    with_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    counts = staged(made.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")))
    a_id = F.floor(F.col("pair") / with_b)
    highest = staged(counts.groupBy(a_id.alias("a")).agg(F.max("n").alias("most")))
    scored = counts.withColumn("a", a_id).join(within(highest, BROADCAST_PAIRS), "a")
    scored = staged(scored.select("pair", "n", (F.col("n") == F.col("most")).alias("best")))

    links = made.select("row", "times", F.posexplode("pairs").alias("k", "pair")).select("row", "pair", F.get("times", F.col("k")).alias("t"))
    sums = links.join(within(scored, BROADCAST_PAIRS), "pair").groupBy("row")
    sums = sums.agg(F.sum(F.when(F.col("best"), F.col("t")).otherwise(0)).alias("best"), F.sum(F.col("t") * F.col("n")).alias("count_sum"))
    out = made.drop("pairs", "times").join(sums, "row", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", zero("best").alias("n_best"), zero("count_sum").alias("count_sum"), "groups_sha256"]
    return out.select(*kept, *(["groups"] if groups else []))
