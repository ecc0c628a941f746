"""Byte-level BPE encoding and decoding in padded numpy matrices.

Texts are cut into pre-tokens; each distinct segment between spaces is learnt once and kept in a
bounded memory (:mod:`.segments`), each distinct pre-token of the new ones is merged once. Pre-tokens are bucketed by length, a bucket is a matrix of ids with one pre-token per row, and in each
round every row merges its leftmost pair of least rank. Ranks of pairs come from an
open-addressing hash table over id pairs; finished rows leave the matrix, merged
columns are compacted. A pre-token beyond the longest bucket is merged with a heap in the
same order, as its rounds would cost the square of its length. Decoding gathers the
bytes of all ids of a batch at once.

Results for odd input: a null text counts as empty (no ids); null ids and repeated rows
keep their rows; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import map_batches, picked, worker_state
from .segments import Memory, before_words

BUCKETS = (4, 6, 8, 10, 12, 16, 24, 32, 64, 128, 256)
NONE = np.int32(2**31 - 1)
#: Rows of one matrix, which bounds its memory.
ROWS = 1 << 15


class PairTable:
    """Hash table ``(left id, right id) -> rank of the joined token``, probed for whole arrays at a time."""

    def __init__(self, left: list[int], right: list[int], joined: list[int]):
        keys = (np.array(left, np.uint64) << np.uint64(32)) | np.array(right, np.uint64)
        values = np.array(joined, np.int32)
        self.bits = max(4, int(2 * max(len(keys), 1)).bit_length())
        self.keys = np.full(1 << self.bits, np.uint64(2**64 - 1))
        self.values = np.full(1 << self.bits, NONE, np.int32)
        slot = self._slot(keys)
        todo = np.arange(len(keys))
        while len(todo):  # every free slot takes one of the keys that want it; the others move on
            free = self.keys[slot[todo]] == np.uint64(2**64 - 1)
            want = todo[free]
            _, first = np.unique(slot[want], return_index=True)
            put = want[first]
            self.keys[slot[put]] = keys[put]
            self.values[slot[put]] = values[put]
            todo = np.setdiff1d(todo, put, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs, ``NONE`` where they don't merge (or a side is padding)."""
        keys = (left.astype(np.int64).astype(np.uint64) << np.uint64(32)) | right.astype(np.int64).astype(np.uint64)
        out = np.full(len(keys), NONE, np.int32)
        open_ = np.flatnonzero((left >= 0) & (right >= 0))
        slot = self._slot(keys[open_])
        while len(open_):
            at = self.keys[slot]
            hit = at == keys[open_]
            out[open_[hit]] = self.values[slot[hit]]
            on = ~hit & (at != np.uint64(2**64 - 1))
            open_, slot = open_[on], (slot[on] + 1) & ((1 << self.bits) - 1)
        return out


def byte_pairs(ranks: dict[bytes, int]) -> PairTable:
    """The pairs of tokens that join to a token."""
    left, right, joined = [], [], []
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            a, b = ranks.get(token[:i]), ranks.get(token[i:])
            if a is not None and b is not None:
                left.append(a)
                right.append(b)
                joined.append(rank)
    return PairTable(left, right, joined)


class BytePairs:
    """Encoder and decoder for a file of base64 tokens and ranks."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.pattern = regex.compile(pattern)
        self.pairs = byte_pairs(self.ranks)
        self.byte_id = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        top = max(self.ranks.values()) + 1
        tokens = [b""] * top
        for t, r in self.ranks.items():
            tokens[r] = t
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        written = [f"{i} ".encode() for i in range(top)]
        self.n_digits = np.fromiter(map(len, written), np.int64, top)
        wide = int(self.n_digits.max())
        self.digits = np.frombuffer(b"".join(w.ljust(wide, b"\0") for w in written), np.uint8).reshape(top, wide)
        #: The bucket of each length; beyond the longest: 0.
        self.bucket = [next(b for b in BUCKETS if n <= b) for n in range(BUCKETS[-1] + 1)] + [0]
        kinds = pattern.split("|")
        letters = kinds.index(r" ?\p{L}+") if r" ?\p{L}+" in kinds else 0
        #: Tells ASCII letters behind at most one space: one pre-token, if only contractions come before in the pattern.
        self.plain = re.compile(rb" ?[A-Za-z]+").fullmatch if letters and all(k.startswith("'") for k in kinds[:letters]) else None
        self.memory = Memory(self._learn, before_words)

    # --- merging ---------------------------------------------------------------

    def _matrix(self, words: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pre-tokens one after the other, and how many each has."""
        n = len(words)
        sizes = np.fromiter(map(len, words), np.int64, n)
        m = np.full((n, width), -1, np.int32)
        m[np.arange(width) < sizes[:, None]] = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        final = np.full((n, width), -1, np.int32)
        rank = self.pairs.rank(m[:, :-1].ravel(), m[:, 1:].ravel()).reshape(n, width - 1)
        rows = np.arange(n)
        while len(rows):
            j = rank.argmin(axis=1)  # the leftmost of the least
            at = np.arange(len(rows))
            done = rank[at, j] == NONE
            if done.any():
                final[rows[done], : m.shape[1]] = m[done]
                m, rank, rows, j = m[~done], rank[~done], rows[~done], j[~done]
                at = np.arange(len(rows))
                if not len(rows):
                    break
            m[at, j] = rank[at, j]
            # compaction: the columns right of the merged pair move one to the left
            cols = np.arange(m.shape[1] - 1)
            m = np.take_along_axis(m, cols + (cols > j[:, None]), axis=1)
            if m.shape[1] < 2:
                rank = np.full((len(rows), 1), NONE, np.int32)
                continue
            cols = np.arange(rank.shape[1] - 1)
            rank = np.take_along_axis(rank, cols + (cols >= j[:, None]), axis=1)
            for side in (j - 1, j):  # the two pairs that the merged token is now part of
                ok = (side >= 0) & (side < rank.shape[1])
                r, c = at[ok], side[ok]
                rank[r, c] = self.pairs.rank(m[r, c], m[r, c + 1])
        held = final >= 0
        return final[held], held.sum(axis=1)

    def _heap(self, word: bytes) -> np.ndarray:
        ids = self.byte_id[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self.pairs.rank(np.array(ids[:-1], np.int32), np.array(ids[1:], np.int32)).tolist()
        alive = [True] * n
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != NONE]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            k = after[i] if alive[i] else n
            if k >= n or ids[i] != a or ids[k] != b:
                continue
            ids[i] = r
            alive[k] = False
            after[i] = after[k]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n:
                    q = int(self.pairs.rank(np.array([ids[x]], np.int32), np.array([ids[y]], np.int32))[0])
                    if q != NONE:
                        heapq.heappush(heap, (q, x, ids[x], ids[y]))
        return np.array([x for x, ok in zip(ids, alive) if ok], np.int32)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pre-tokens one after the other, and where each one's end."""
        known = list(map(self.ranks.get, words))
        by: dict[int, list[int]] = {}
        for i, (w, whole) in enumerate(zip(words, known)):
            if whole is None:
                by.setdefault(self.bucket[min(len(w), len(self.bucket) - 1)], []).append(i)
        size = np.ones(len(words), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for width, every in by.items():
            for s in range(0, len(every), ROWS):
                at = np.array(every[s : s + ROWS])
                if width:
                    ids, size[at] = self._matrix([words[i] for i in at.tolist()], width)
                else:
                    each = [self._heap(words[i]) for i in at.tolist()]
                    ids, size[at] = np.concatenate(each), list(map(len, each))
                parts.append((at, ids))
        ends = np.cumsum(size)
        start = ends - size
        flat = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
        flat[start] = [-1 if x is None else x for x in known]
        for at, ids in parts:
            n = size[at]
            flat[np.repeat(start[at] - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
        return flat, ends

    # --- texts -----------------------------------------------------------------

    def _learn(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new segments one after the other, and where each one's end."""
        cut = [[s] if self.plain is not None and self.plain(s) else [w.encode() for w in self.pattern.findall(s.decode())] for s in segments]
        words = list({w for c in cut for w in c})
        number = {w: i for i, w in enumerate(words)}
        flat, ends = self.merge(words)
        start, size = np.r_[0, ends[:-1]], np.diff(ends, prepend=0)
        at = np.fromiter((number[w] for c in cut for w in c), np.int64)
        count = size[at]
        stop = np.cumsum(count)
        ids = flat[np.repeat(start[at] - (stop - count), count) + np.arange(stop[-1] if len(stop) else 0)]
        return ids, np.r_[0, stop][np.cumsum(list(map(len, cut)))]

    def encode_column(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of the texts of a column and where each one's end, some texts at a time."""
        return self.memory.encode(column)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [x for ids, ends in self.encode_column(pa.array(texts, pa.string())) for x in np.split(ids, ends[:-1])]

    def written(self, ids: np.ndarray, ends: np.ndarray) -> list[memoryview]:
        """The ids of each text in decimal, joined by a space."""
        digits = self.digits[ids]
        flat = memoryview(digits[digits > 0].tobytes())
        stop = np.r_[0, np.cumsum(self.n_digits[ids])][np.r_[0, ends]].tolist()
        return [flat[a : max(a, b - 1)] for a, b in zip(stop, stop[1:])]

    def decoded(self, ids: np.ndarray, ends: np.ndarray) -> list[memoryview]:
        """The bytes of each text; those of all ids are gathered at once."""
        size = self.size[ids]
        stop = np.cumsum(size)
        flat = memoryview(self.flat[np.repeat(self.start[ids] - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)].tobytes())
        cuts = np.r_[0, stop][np.r_[0, ends]].tolist()
        return [flat[a:b] for a, b in zip(cuts, cuts[1:])]

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """Bytes of each id array."""
        every = np.concatenate(ids).astype(np.int64) if ids else np.zeros(0, np.int64)
        return [bytes(b) for b in self.decoded(every, np.cumsum(list(map(len, ids)), dtype=np.int64))]


def _coder(path: str, pattern: str) -> BytePairs:
    return worker_state(f"bpe:{path}", lambda: BytePairs(path, pattern))


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids)``: the token ids of each text."""
    d = picked(docs, id=id_col, text=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path, pattern)
        for b in batches:
            ids = [x.astype(np.int32) for flat, ends in coder.encode_column(b.column("text")) for x in np.split(flat, ends[:-1])]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(ids, pa.list_(pa.int32()))], [id_col, "ids"])

    return map_batches(d, run, T.StructType([T.StructField(id_col, d.schema["id"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def decode(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id, data)``: the bytes of each id array; a null array gives null."""
    d = picked(encoded, id=id_col, ids=ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path, pattern)
        for b in batches:
            ids = b.column("ids").to_pylist()
            data = coder.decode([np.array(x or [], np.int64) for x in ids])
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([None if x is None else y for x, y in zip(ids, data)], pa.binary())], [id_col, "data"])

    return map_batches(d, run, T.StructType([T.StructField(id_col, d.schema["id"].dataType), T.StructField("data", T.BinaryType())]))


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, number of ids, digest of the ids in decimal, digest of the bytes decoded from them."""
    d = picked(docs, id=id_col, text=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path, pattern)
        for b in batches:
            n, written, decoded = [], [], []
            for ids, ends in coder.encode_column(b.column("text")):
                n += np.diff(ends, prepend=0).tolist()
                written += [hashlib.sha256(x).hexdigest() for x in coder.written(ids, ends)]
                decoded += [hashlib.sha256(x).hexdigest() for x in coder.decoded(ids, ends)]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(n, pa.int64()), pa.array(written, pa.string()), pa.array(decoded, pa.string())], [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    fields = [T.StructField(id_col, d.schema["id"].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    return map_batches(d, run, T.StructType(fields))
