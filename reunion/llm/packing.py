"""Hierarchical packing of documents into training sequences of several lengths.

Each input partition tokenises and packs its own documents in one pass, so no text or id
is shuffled and no group depends on a key. Whole windows of the longest tier are cut off a
document; the rest is routed to the shortest tier that holds it. Tiers are packed from the
longest down: the largest rest opens a window, its gap is filled with the best fitting rests
of shorter tiers, and the last rest is cut to fill the window to the token. What no window
could close stays for the next round of the partition; at its end that tail is cut into
sequences whose lengths are powers of two. So every sequence is a power of two long, the
padding is nil, and only documents that close a window are cut. Sequences of one tier form
step groups of equal token count (the last of a tier in a partition may be smaller).

A sequence's id is its partition's number and a counter; a recomputed partition reads the
same rows and gives the same ids. To fix both ids and pieces for several reads, write the result.

Results for odd input: a null text counts as empty, and an empty document is its end token
alone; null ids and repeated rows are packed as they come; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import map_batches, picked, worker_state
from .segments import Memory, before_words

TIERS = (2048, 1024, 512, 256)
#: Tokens gathered before a round of packing; bounds a task's memory.
ROUND_TOKENS = 4_000_000
#: Tokens of one step group.
STEP_TOKENS = 16 * 2048
END = 1


class Encoder:
    """Ids by the tokenizer file, with a memory of distinct segments (:mod:`.segments`).

    A space after a character that is no white space always starts a new pre-token, so texts are cut there.
    New segments are encoded together, as one text, and its ids are dealt back by their byte lengths;
    segments that end in white space, heads of texts and segments that hold a special token are encoded on their own.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.model._resize_cache(0)  # the memory gives it each segment once
        self.n_bytes = np.zeros(self.tok.get_vocab_size(), np.int64)
        for token, i in self.tok.get_vocab().items():  # byte-level: a character stands for a byte
            self.n_bytes[i] = len(token)
        added = self.tok.get_added_tokens_decoder().values()
        if any(t.lstrip or t.rstrip or t.single_word or " " in t.content for t in added):
            raise ValueError("special tokens that take in their surroundings")
        self.special = re.compile("|".join(re.escape(t.content) for t in added).encode()) if added else re.compile(b"(?!)")
        self.memory = Memory(self._learn, before_words)

    def _learn(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new segments one after the other, and where each one's end."""
        n, whole = len(segments), b"".join(segments)
        length = np.fromiter(map(len, segments), np.int64, n)
        data, stop = np.frombuffer(whole, np.uint8), np.cumsum(length)
        first, last = data[stop - length], data[stop - 1]
        joined = (first == 32) & (last > 32) & (last < 128)
        for k in np.flatnonzero((first == 32) & ~joined).tolist():  # a control character or one of several bytes at the end
            joined[k] = not segments[k].decode()[-1].isspace()
        if self.special.search(whole):
            joined &= [self.special.search(s) is None for s in segments]
        size = np.zeros(n, np.int64)
        together, alone = np.flatnonzero(joined), np.flatnonzero(~joined).tolist()
        each = [np.array(e.ids, np.uint32) for e in self.tok.encode_batch_fast([segments[k].decode() for k in alone], add_special_tokens=False)]
        size[alone] = list(map(len, each))
        text = (b"".join([segments[k] for k in together.tolist()]) if alone else whole).decode()
        ids = np.array(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        cuts = np.searchsorted(np.cumsum(self.n_bytes[ids]), np.cumsum(length[together])) + 1
        size[together] = np.diff(cuts, prepend=0)
        ends = np.cumsum(size)
        flat = np.empty(int(ends[-1]), np.uint32)
        flat[np.repeat(joined, size)] = ids
        flat[np.repeat(~joined, size)] = np.concatenate(each) if each else []
        return flat, ends

    def encode_column(self, column: pa.Array) -> Iterator[list[np.ndarray]]:
        """Ids of each text of a column and the end id, some texts at a time."""
        for ids, ends in self.memory.encode(column):
            yield np.split(np.insert(ids, ends, END), (ends + np.arange(1, len(ends) + 1))[:-1]) if len(ends) else []

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """uint32 ids of each text, without the end id."""
        return [x[:-1] for part in self.encode_column(pa.array(texts, pa.string())) for x in part]


class Packer:
    """Packs rests of documents; ``emit(tier, pieces)`` takes each sequence, a piece being ``(document, start, length)``."""

    def __init__(self, emit, tiers: tuple[int, ...] = TIERS):
        self.emit, self.tiers = emit, tuple(sorted(tiers, reverse=True))
        self.pool: list[tuple[int, int, int]] = []  # (length, document, start), sorted: the rests of all tiers
        self.left = 0  # tokens in the pool

    def add(self, doc: int, n: int) -> None:
        """Cut whole windows of the longest tier off a document; its rest goes to the pool."""
        top, start = self.tiers[0], 0
        while n - start >= top:
            self.emit(top, [(doc, start, top)])
            start += top
        if n > start:
            self.pool.append((n - start, doc, start))
            self.left += n - start

    def _fill(self, tier: int, first: tuple[int, int, int]) -> list[tuple[int, int, int]]:
        """Pieces of a full window; the pool must hold enough tokens."""
        pieces, gap = [(first[1], first[2], first[0])], tier - first[0]
        self.left -= tier
        while gap:
            i = bisect.bisect_right(self.pool, (gap, 1 << 62, 0)) - 1
            if i >= 0:  # the longest rest that fits
                n, doc, start = self.pool.pop(i)
                pieces.append((doc, start, n))
                gap -= n
            else:  # all are longer: cut the shortest to fit
                n, doc, start = self.pool.pop(0)
                pieces.append((doc, start, gap))
                bisect.insort(self.pool, (n - gap, doc, start + gap))
                gap = 0
        return pieces

    def pack(self) -> None:
        """Close every window that the pool can close, longest tier first; the rest stays in the pool."""
        self.pool.sort()
        for place, tier in enumerate(self.tiers):
            shorter = self.tiers[place + 1] if place + 1 < len(self.tiers) else 0
            while self.pool and self.pool[-1][0] > shorter:
                if self.left < tier:
                    return
                self.emit(tier, self._fill(tier, self.pool.pop()))

    def finish(self) -> None:
        """Cut what is left into sequences as long as powers of two."""
        self.pack()
        while self.left:
            size = min(self.tiers[0], 1 << (self.left.bit_length() - 1))
            pieces, gap = [], size
            while gap:
                n, doc, start = self.pool.pop()
                take = min(n, gap)
                pieces.append((doc, start, take))
                gap -= take
                if take < n:
                    self.pool.append((n - take, doc, start + take))
            self.left -= size
            self.emit(size, pieces)


_FIELDS = [
    ("start", T.LongType(), pa.int64()),
    ("length", T.LongType(), pa.int64()),
    ("ids_crc32", T.LongType(), pa.int64()),
    ("doc_tokens", T.LongType(), pa.int64()),
    ("sequence_id", T.LongType(), pa.int64()),
    ("offset", T.LongType(), pa.int64()),
    ("tier", T.IntegerType(), pa.int32()),
    ("step_group", T.LongType(), pa.int64()),
]


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    tiers: tuple[int, ...] = TIERS,
    step_tokens: int = STEP_TOKENS,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece of a document in a sequence; ``with_ids`` adds the piece's ids as an array.

    ``tiers`` are powers of two. ``tokenizer`` is the path of a tokenizer file on every machine.
    """
    if any(t & (t - 1) or t < 1 for t in tiers):
        raise ValueError("tiers must be powers of two")
    d = picked(docs, id=id_col, text=text_col)
    id_type = d.schema["id"].dataType
    fields = [T.StructField(id_col, id_type), *[T.StructField(n, t) for n, t, _ in _FIELDS]]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        enc = worker_state("pack:" + tokenizer, lambda: Encoder(tokenizer))
        held: dict[int, tuple[object, np.ndarray]] = {}  # documents with tokens not yet packed
        rows: list[tuple] = []
        pieces_ids: list[np.ndarray] = []
        counter = groups = 0
        open_group: dict[int, list[int]] = {}  # tier -> [group, tokens in it]

        def emit(size: int, pieces: list[tuple[int, int, int]]) -> None:
            nonlocal counter, groups
            g = open_group.get(size)
            if g is None or g[1] + size > max(step_tokens, size):
                g = open_group[size] = [groups, 0]
                groups += 1
            g[1] += size
            at = 0
            for doc, start, n in pieces:
                key, ids = held[doc]
                cut = ids[start : start + n]
                rows.append((key, start, n, zlib.crc32(cut), len(ids), base + counter, at, size, base + g[0]))
                if with_ids:
                    pieces_ids.append(cut)
                at += n
            counter += 1

        def out() -> pa.RecordBatch:
            cols = list(zip(*rows)) if rows else [()] * (1 + len(_FIELDS))
            arrays = [pa.array(cols[0], id_arrow), *[pa.array(c, t) for c, (_, _, t) in zip(cols[1:], _FIELDS)]]
            names = [id_col, *[n for n, _, _ in _FIELDS]]
            if with_ids:
                arrays.append(pa.array([p.astype(np.int32) for p in pieces_ids], pa.list_(pa.int32())))
                names.append("ids")
            rows.clear()
            pieces_ids.clear()
            return pa.RecordBatch.from_arrays(arrays, names)

        packer, number, waiting, id_arrow = Packer(emit, tiers), 0, 0, pa.int64()
        for batch in batches:
            id_arrow = batch.schema.field("id").type
            keys = iter(batch.column("id").to_pylist())
            for part in enc.encode_column(batch.column("text")):
                for ids in part:
                    held[number] = (next(keys), ids)
                    packer.add(number, len(ids))
                    number += 1
                    waiting += len(ids)
                if waiting >= ROUND_TOKENS:
                    packer.pack()
                    held = {doc: (held[doc][0], held[doc][1].copy()) for _, doc, _ in packer.pool}  # copies let go of the other texts' ids
                    waiting = 0
                if len(rows) >= 20_000:
                    yield out()
        packer.finish()
        if rows:
            yield out()

    return map_batches(d, run, T.StructType(fields))
