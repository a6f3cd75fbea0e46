"""Byte-level BPE: encoding by prefix dynamic programming (operator 2), counting by heap merges (operator 10).

Both split texts as the tokenizer's pattern does, a batch at a time, work on
the distinct words of a batch and look each piece up in a bounded memory of
pieces met before, since words repeat.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import re
from collections.abc import Callable, Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.shared import text_parts
from tidewater.llm.words import span_hashes, spans

# fixed values: Unicode White_Space, which \s means in the tokenizers' patterns
_WHITE = "\t-\r \x85\xa0  -     　"
_RARE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")  # the same, beyond ASCII
_MARKS = frozenset(".,;:!?()-")
MEMORY = 500_000  # units kept
PAIRS = 100_000  # token pairs kept; a worker holds them for as long as it lives


class Memory:
    """Results (a few integers each) of the units met before, under their 64-bit hashes.

    Kept as sorted arrays, about 30 bytes a unit. When it holds more than
    ``most`` units, those not met in the latest batches go.
    """

    def __init__(self, most: int = MEMORY):
        self.most, self.batch = most, 0
        self.keys = np.zeros(0, np.uint64)
        self.sizes, self.met = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.flat = np.zeros(0, np.int32)

    def results(self, keys: np.ndarray, compute: Callable[[np.ndarray], list[list[int]]]) -> tuple[np.ndarray, np.ndarray]:
        """(results end to end, size of each) for sorted distinct ``keys``; compute() gets the places of the unknown ones."""
        self.batch += 1
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        if len(self.keys):
            known = self.keys[np.minimum(at, len(self.keys) - 1)] == keys
        self.met[at[known]] = self.batch
        new = np.flatnonzero(~known)
        if len(new):
            made = compute(new)
            self._insert(keys[new], at[new], np.array([*map(len, made)], np.int32), np.array([x for m in made for x in m], np.int32))
            at = np.searchsorted(self.keys, keys)
        sizes = self.sizes[at].astype(np.int64)
        out = self.flat[_ranges((np.cumsum(self.sizes, dtype=np.int64) - self.sizes)[at], sizes)]
        if len(self.keys) > self.most:
            stay = self.met > np.partition(self.met, len(self.met) // 2)[len(self.met) // 2]
            self._keep(stay if stay.any() else np.zeros(len(stay), bool))
        return out, sizes

    def _insert(self, keys, at, sizes, flat) -> None:
        cuts = np.repeat(np.concatenate(([0], np.cumsum(self.sizes, dtype=np.int64)))[at], sizes)
        self.flat = np.insert(self.flat, cuts, flat)
        self.keys, self.sizes = np.insert(self.keys, at, keys), np.insert(self.sizes, at, sizes)
        self.met = np.insert(self.met, at, self.batch)

    def _keep(self, stay: np.ndarray) -> None:
        self.flat = self.flat[np.repeat(stay, self.sizes)]
        self.keys, self.sizes, self.met = self.keys[stay], self.sizes[stay], self.met[stay]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for each size, end to end."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class Splitter:
    """Pieces of texts by ``pattern``, found in two steps.

    White space only ever joins a word as one leading space. So texts are first
    cut into words with that space and runs of white space, a batch of texts at
    a time, and the full pattern only runs inside distinct words.
    """

    def __init__(self, pattern: str):
        self.units = re.compile(rf" ?[^{_WHITE}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+")
        self.inner = regex.compile(pattern.replace(r"[^\s", rf"[^{_WHITE}").replace(r"\s", f"[{_WHITE}]").replace(r"\S", f"[^{_WHITE}]"))
        self.white = re.compile(rf"[{_WHITE}]+\Z")

    def pieces(self, unit: str) -> list[str]:
        word = unit[1:] if unit[0] == " " else unit
        if word.isalpha():
            return [unit]
        if word[-1:] in _MARKS and word[:-1].isalpha():
            return [unit[:-1], word[-1]]
        return [unit] if self.white.match(unit) else self.inner.findall(unit)

    def results(self, data: np.ndarray, offsets: np.ndarray, memory: Memory, of_pieces: Callable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Results of the distinct units of a batch, end to end, the size of each, and (unit numbers in order, units per row).

        ``of_pieces`` makes a dict of results from the distinct pieces of the units that ``memory`` lacks.
        """
        starts = self._starts(data, offsets)
        ends = np.append(starts[1:], len(data))
        keys, first, which = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)

        def compute(new: np.ndarray) -> list[list[int]]:
            parts = [self.pieces(data[a:b].tobytes().decode()) for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)]
            found = of_pieces({p for ps in parts for p in ps})
            return [found[ps[0]] if len(ps) == 1 else [x for p in ps for x in found[p]] for ps in parts]

        flat, sizes = memory.results(keys, compute)
        return flat, sizes, which, np.diff(np.searchsorted(starts, offsets, "left"))

    def _starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where units begin: a run of white space, its last byte before a word, a word without a space before it."""
        n = len(data)
        if not n:
            return np.zeros(0, np.int64)
        words, word_ends = spans(data, offsets)
        opens = np.zeros(n + 1, bool)
        opens[offsets] = True  # a row opens with a word or with white space
        opens[word_ends] = True  # so does what follows a word
        before = words[~opens[words]] - 1  # the last byte of the white space before a word
        opens[before] = True
        opens[before[data[before] != 0x20] + 1] = True
        out = np.flatnonzero(opens[:n])
        lead = np.isin(data, (0xC2, 0xE1, 0xE2, 0xE3))
        if lead.any():  # other white space is rare; rows with it are cut by the expression
            for r in np.unique(np.searchsorted(offsets, np.flatnonzero(lead), "right") - 1):
                a, b = int(offsets[r]), int(offsets[r + 1])
                text = data[a:b].tobytes().decode()
                if _RARE.search(text):
                    sizes = [len(u.encode()) for u in self.units.findall(text)]
                    own = a + np.cumsum([0, *sizes[:-1]])
                    i, j = np.searchsorted(out, (a, b))
                    out = np.concatenate((out[:i], own, out[j:]))
        return out


def read_ranks(path: str) -> dict[bytes, int]:
    """A tiktoken rank file: base64 bytes and rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class PrefixCoder:
    """Exact BPE by the last token of every prefix.

    The encoding of a byte string is the one token sequence whose neighbours
    all stay apart when merged on their own. So each prefix has one valid last
    token: the token t that ends there and stays apart from the last token of
    the prefix before t. ``table`` holds that token's id for every prefix, and
    ``tokens`` walks back from the end. A table can be extended at its end,
    and after an edit only prefixes from the edit on are recomputed, up to
    where the old table holds again. An automaton finds the tokens that end at
    each byte.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = [b for b, _ in sorted(ranks.items(), key=lambda x: x[1])]
        if [*ranks.values()] and sorted(ranks.values()) != list(range(len(ranks))):
            raise ValueError("ranks must run from 0 without gaps")
        self.lens = [*map(len, self.bytes)]
        self.longest = max(self.lens)
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.apart: dict[int, bool] = {}
        self.ends = ahocorasick.Automaton()
        for b, r in ranks.items():
            self.ends.add_word(b.decode("latin-1"), (len(b), r))
        self.ends.make_automaton()

    def _split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; None for a byte, and for a token that no merges reach."""
        if token not in self.halves:
            data, ranks = self.bytes[token], self.ranks
            parts = [ranks[data[i : i + 1]] for i in range(len(data))]
            while len(parts) > 2:
                merges = [r if (r := ranks.get(self.bytes[x] + self.bytes[y])) is not None else token for x, y in zip(parts[:-1], parts[1:], strict=True)]
                low = min(merges)
                if low >= token:
                    break
                at = merges.index(low)
                parts[at : at + 2] = [low]
            self.halves[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self.halves[token]

    def _reached(self, token: int) -> bool:
        return self.lens[token] == 1 or self._split(token) is not None

    def stay_apart(self, x: int, y: int) -> bool:
        """Whether tokens x and y remain neighbours when their bytes are merged together.

        Goes back in time along the seam. The later made of the two tokens at
        the seam is undone, and each pair that met there must have had no merge
        that comes before the merges which consumed its sides. Of equal merges
        the left one comes first.
        """
        key = x << 32 | y
        known = self.apart.get(key)
        if known is not None:
            return known
        get, made = self.ranks.get, self.bytes
        x_until = y_until = len(made)
        while True:
            cross = get(made[x] + made[y])
            if cross is not None and cross < x_until and cross <= y_until:
                out = False
                break
            fixed_x, fixed_y = self.lens[x] == 1, self.lens[y] == 1
            if fixed_x and fixed_y:
                out = True
                break
            if not fixed_x and (fixed_y or x > y):
                x_until, x = x, self._split(x)[1]
            else:
                y_until, y = y, self._split(y)[0]
        if len(self.apart) >= PAIRS:
            self.apart.clear()
        self.apart[key] = out
        return out

    def table(self, data: bytes, last: list[int] | None = None, stop: Callable[[int, list], bool] | None = None) -> list[int]:
        """last[i] is the id of the last token of the first i bytes (last[0] is -1); ``last`` may hold the table's start already."""
        last = [-1] if last is None else last
        known, apart, done = self.apart.get, self.stay_apart, len(last) - 1
        reach = max(0, done - self.longest)
        for end, (size, token) in self.ends.iter(data[reach:].decode("latin-1")):
            end += reach + 1
            if end != done + 1:  # its last token is found
                continue
            start = end - size
            if start < 0:
                continue
            if start:
                ok = known(last[start] << 32 | token)
                if ok is None:
                    ok = self._reached(token) and apart(last[start], token)
            else:
                ok = self._reached(token)
            if ok:
                last.append(token)
                done = end
                if stop and stop(end, last):
                    return last
        if done < len(data):
            raise ValueError("the ranks lack a byte")
        return last

    def tokens(self, last: list[int]) -> list[int]:
        out, i = [], len(last) - 1
        while i:
            out.append(last[i])
            i -= self.lens[last[i]]
        return out[::-1]

    def append(self, data: bytes, last: list[int], more: bytes) -> list[int]:
        """The table of ``data + more`` from that of ``data``."""
        return self.table(data + more, list(last))

    def edit(self, data: bytes, last: list[int], start: int, end: int, new: bytes) -> list[int]:
        """The table after data[start:end] became ``new``.

        Behind the edit a prefix's token hangs on the ``longest`` prefixes
        before it only; once that many agree with the old table, the rest does.
        """
        after, shift, same = data[:start] + new + data[end:], len(new) - (end - start), 0

        def agrees(i: int, table: list) -> bool:
            nonlocal same
            # a token that reaches back over the edit is no agreement
            ok = i - self.lens[table[i]] >= start + len(new) and table[i] == last[i - shift]
            same = same + 1 if ok else 0
            return same >= self.longest

        out = self.table(after, last[: start + 1], agrees)
        return out + last[len(out) - shift :]

    def encode(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None and self._reached(whole):
            return [whole]
        return self.tokens(self.table(data))

    def encode_many(self, pieces: Iterable[str]) -> dict[str, list[int]]:
        """The ids of each piece. In sorted order a piece continues the table of what it shares with the one before."""
        out, before, last = {}, b"", [-1]
        for p in sorted(pieces):
            data = p.encode()
            same = 0
            for same, (x, y) in enumerate(zip(data, before)):  # noqa: B007,B905
                if x != y:
                    break
            else:
                same = min(len(data), len(before))
            last = self.table(data, last[: same + 1])
            out[p], before = self.tokens(last), data
        return out


class Encoder:
    """Encodes and decodes texts by a rank file and a split pattern."""

    def __init__(self, path: str, pattern: str):
        self.coder, self.split = PrefixCoder(read_ranks(path)), Splitter(pattern)
        self.memory = Memory()

    def encode_batch(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per row) of a batch of texts."""
        flat, sizes, which, per_row = self.split.results(data, offsets, self.memory, self.coder.encode_many)
        n = sizes[which]
        ids = flat[_ranges((np.cumsum(sizes) - sizes)[which], n)]
        rows = np.concatenate(([0], np.cumsum(n)))[np.concatenate(([0], np.cumsum(per_row)))]
        return ids, np.diff(rows)

    def encode(self, text: str) -> list[int]:
        data = np.frombuffer(text.encode(), np.uint8)
        return self.encode_batch(data, np.array([0, len(data)]))[0].tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.coder.bytes.__getitem__, ids))


_MADE: dict[tuple, object] = {}


def _once(kind: type, *args):
    """One coder per worker process."""
    if (kind, *args) not in _MADE:
        _MADE[kind, *args] = kind(*args)
    return _MADE[kind, *args]


def encode_texts(docs: DataFrame, path: str, pattern: str, arrays: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_tokens, ids_sha256, decoded_sha256, and ``ids`` if ``arrays``.

    The ids are those of byte-level BPE by the rank file at ``path``, each match
    of ``pattern`` on its own, without special tokens; ids_sha256 is of their
    decimals joined by commas, decoded_sha256 of the bytes they decode to. A
    null text counts as empty (no ids). Other columns are not read; doc_id may
    be null or repeated. An empty table gives an empty result. The file at
    ``path`` must stand on every machine.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _once(Encoder, path, pattern)
        decimal = [str(i) for i in range(len(coder.coder.bytes))]
        for part, data, offsets in text_parts(batches, 2 << 20):
            ids, n = coder.encode_batch(data, offsets)
            enc, dec, bounds = [], [], np.concatenate(([0], np.cumsum(n)))
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                own = ids[a:b].tolist()
                enc.append(hashlib.sha256(",".join(map(decimal.__getitem__, own)).encode()).hexdigest())
                dec.append(hashlib.sha256(coder.decode(own)).hexdigest())
            cols = [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(enc, pa.string()), pa.array(dec, pa.string())]
            if arrays:
                cols.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * arrays)

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * arrays)


def _byte_letters() -> dict[int, str]:
    """The printable stand-in that byte-level vocabularies write for each byte: itself if printable, else the next from U+0100."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


class MergeCounter:
    """Counts the tokens of a piece by heap merges over a linked list; no ids are made.

    The symbols of a piece stand in a linked list. A heap holds its adjacent
    pairs by (rank, position). The lowest pair is popped; if both sides are
    still what they were it is merged, and the two new neighbours are pushed.
    The count is the number of symbols less the number of merges.
    """

    def __init__(self, merges: list[tuple[str, str]]):
        symbols: dict[str, int] = {}
        number = lambda s: symbols.setdefault(s, len(symbols))
        self.first = [number(c) for _, c in sorted(_byte_letters().items())]
        self.rank = {}
        for k, (a, b) in enumerate(merges):
            self.rank[number(a), number(b)] = (k, number(a + b))

    def count(self, data: bytes) -> int:
        sym = [self.first[b] for b in data]
        n, merge = len(sym), self.rank.get
        now = [merge(p) for p in zip(sym, sym[1:])] + [None]  # noqa: B905  the merge of the pair that begins at each symbol
        heap = [m[0] * n + i for i, m in enumerate(now) if m]
        heapq.heapify(heap)
        after, before, merges = list(range(1, n + 1)), list(range(-1, n - 1)), 0
        while heap:
            low, i = divmod(heapq.heappop(heap), n)
            m = now[i]
            if m is None or m[0] != low:
                continue  # the pair is gone
            j = after[i]
            now[j] = None
            sym[i] = made = m[1]
            after[i] = k = after[j]
            merges += 1
            if k < n:
                before[k] = i
                now[i] = m = merge((made, sym[k]))
                if m:
                    heapq.heappush(heap, m[0] * n + i)
            else:
                now[i] = None
            h = before[i]
            if h >= 0:
                now[h] = m = merge((sym[h], made))
                if m:
                    heapq.heappush(heap, m[0] * n + h)
        return n - merges


class Counter:
    """Token counts of whole texts by a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.merges, self.split = MergeCounter(merges), Splitter(pattern)
        self.memory = Memory()
        special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None

    def count_batch(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each row, no special strings looked for."""
        flat, sizes, which, per_row = self.split.results(data, offsets, self.memory, lambda pieces: {p: [self.merges.count(p.encode())] for p in pieces})
        unit = np.add.reduceat(flat, np.cumsum(sizes) - sizes, dtype=np.int64) if len(flat) else flat.astype(np.int64)
        sums = np.concatenate(([0], np.cumsum(unit[which])))
        return np.diff(sums[np.concatenate(([0], np.cumsum(per_row)))])

    def count(self, text: str) -> int:
        """A special string inside a text is one token and cuts the text, as is the library's default."""
        parts = [p.encode() for p in (self.special.split(text) if self.special else [text])]
        offsets = np.concatenate(([0], np.cumsum([*map(len, parts)])))
        return len(parts) - 1 + int(self.count_batch(np.frombuffer(b"".join(parts), np.uint8), offsets).sum())


def count_tokens(docs: DataFrame, path: str, pattern: str, limit: int = 512) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > ``limit``).

    Counts are those of the byte-level BPE file at ``path`` without begin, end
    or added special tokens. A null text counts as empty (0). Other columns are
    not read; doc_id may be null or repeated. An empty table gives an empty
    result. The file at ``path`` must stand on every machine.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _once(Counter, path, pattern)
        for part, data, offsets in text_parts(batches, 2 << 20):
            n = counter.count_batch(data, offsets)
            if counter.special:
                for i, text in enumerate(part.column("text")):
                    if text.is_valid and counter.special.search(text := text.as_py()):
                        n[i] = counter.count(text)
            cols = [part.column("doc_id"), pa.array(np.diff(offsets)), pa.array(n, pa.int64()), pa.array(n > limit)]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
