"""Substring deduplication by content-defined chunks.

A gear hash rolls over the UTF-8 bytes of a text; it depends on the last 32 bytes only, so cuts
move with the content and an insertion changes the chunks around it alone. A chunk ends
before white space where the hash is divisible by ``WORD_DIVISOR``, and at any character where its
upper bits are divisible by ``ANY_DIVISOR``, or by ``BARE_DIVISOR`` if the last 32 bytes hold no
white space (Chinese, Japanese, Thai, base64); chunks vary in length.
Chunks are deduplicated by 128-bit digests: the text of the smallest id that holds a chunk
keeps its first occurrence, all others are duplicates. Runs of neighbouring duplicate chunks
of at least ``MIN_WORDS`` words, or ``MIN_CHARS`` characters in stretches of 32 or more bytes without
white space, are cut out of the text; shorter ones (a common phrase, a licence line) stay.

Documents are dealt into groups of bounded size (in documents and in bytes) by a hash of id and text. A
group asks for each distinct digest once, in one packed array per digest bucket, and learns in one byte
each whether it holds the owner. So a passage that a third of all texts share is one entry per group. Question
and answer are matched by the order of the digests themselves, never by that of the rows, which a
shuffle may bring in another order each time it is read. The deal of the documents serves both.

Results for odd input: null texts stay null, empty ones empty; ids must be integers (others raise
``ValueError``), a null id comes last in the order; rows of one id are one document: what they share with each other is kept
in each; a text that is all duplicate becomes empty, its row stays; an empty table gives an
empty result; extra columns are passed on, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import picked, small_batches

WINDOW = 32
WORD_DIVISOR = 5
ANY_DIVISOR = 256
BARE_DIVISOR = 16
MIN_WORDS = 15
#: Characters that count as much as ``MIN_WORDS`` words, in stretches that white space does not part.
MIN_CHARS = 100
#: Documents and text bytes of a group, and text bytes of which a digest bucket gets the chunks.
GROUP_DOCS = 2_000
GROUP_BYTES = 6 << 20
BUCKET_BYTES = 24 << 20
_LAST = np.int64(2**63 - 1)


def gear_table(seed: int = 7) -> np.ndarray:
    """A random 64-bit value per byte, from a fixed rule."""
    return np.random.default_rng(seed).integers(0, 1 << 64, 256, np.uint64)


GEAR = gear_table()


def gear_hashes(a: np.ndarray, gear: np.ndarray = GEAR) -> np.ndarray:
    """The rolling hash after each byte: sum of gear values shifted by their age, over the last 32 bytes.

    Doubling: the hash over 2w bytes is that over w plus the one w bytes before, shifted by w.
    Shifts are two bits a byte, so 32 bytes fill the hash.
    """
    h = gear[a]
    w = 1
    while w < WINDOW:
        h[w:] = h[w:] + (h[:-w] << np.uint64(2 * w))  # the right side is evaluated before it is stored
        w *= 2
    return h


def cut_points(data: bytes) -> np.ndarray:
    """Ends of the chunks of a text, the last being its length."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64)
    a = np.frombuffer(data, np.uint8)
    h = gear_hashes(a)[:-1] >> np.uint64(16)
    white = (a == 32) | ((a >= 9) & (a <= 13))
    after, space = a[1:], white[1:]
    letter = (after & 0xC0) != 0x80  # never inside a character
    upper = h >> np.uint64(8)
    cut = (space & (h % np.uint64(WORD_DIVISOR) == 0)) | (letter & (upper % np.uint64(ANY_DIVISOR) == 0))
    if n > WINDOW:
        spaces = np.r_[0, np.cumsum(white)]
        bare = np.flatnonzero(spaces[WINDOW:n] == spaces[: n - WINDOW]) + WINDOW - 1  # the last byte of windows without white space
        cut[bare] |= letter[bare] & (upper[bare] % np.uint64(BARE_DIVISOR) == 0)
    return np.r_[np.flatnonzero(cut) + 1, n]


def word_starts(a: np.ndarray) -> np.ndarray:
    """Running count of words begun in the bytes before each place."""
    space = (a == 32) | ((a >= 9) & (a <= 13))
    starts = ~space
    starts[1:] &= space[:-1]
    return np.r_[0, np.cumsum(starts)]


def bare_chars(a: np.ndarray) -> np.ndarray:
    """Running count of characters, in the bytes before each place, that are in stretches of ``WINDOW`` or more bytes without white space."""
    white = (a == 32) | ((a >= 9) & (a <= 13))
    edges = np.r_[-1, np.flatnonzero(white), len(a)]
    size = np.diff(edges) - 1
    long = size >= WINDOW
    if not long.any():
        return np.zeros(len(a) + 1, np.int64)
    mark = np.zeros(len(a) + 1, np.int64)
    mark[edges[:-1][long] + 1] += 1
    mark[edges[1:][long]] -= 1
    return np.r_[0, np.cumsum((np.cumsum(mark)[:-1] > 0) & ((a & 0xC0) != 0x80))]


class Chunked:
    """The chunks of the texts of one group, as codes of its distinct digests."""

    def __init__(self, texts: list[bytes]):
        import xxhash

        index: dict[bytes, int] = {}
        digest = xxhash.xxh3_128_digest
        self.ends: list[np.ndarray] = []
        self.codes: list[np.ndarray] = []
        for t in texts:
            ends = cut_points(t)
            at = ends.tolist()
            self.ends.append(ends)
            self.codes.append(np.fromiter((index.setdefault(digest(t[x:y]), len(index)) for x, y in zip([0, *at], at)), np.int64, len(at)))
        d = np.frombuffer(b"".join(index), "<u8").reshape(-1, 2)
        self.high, self.low = d[:, 0].copy(), d[:, 1].copy()

    def owners(self, ids: np.ndarray) -> np.ndarray:
        """The smallest id of the group that holds each digest."""
        own = np.full(len(self.low), _LAST)
        for i, c in zip(ids, self.codes):
            own[c] = np.minimum(own[c], i)
        return own

    def order(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Digests by bucket and value: their order, and the bucket of each place in it.

        It depends on the set of digests alone: another order of the rows gives the same sequence.
        """
        b = (self.low % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((self.low, self.high, b))
        return order, b[order]


def duplicate_spans(text: bytes, ends: np.ndarray, dup: np.ndarray, min_words: int, min_chars: int) -> list[tuple[int, int]]:
    """Byte spans of runs of duplicate chunks with at least ``min_words`` words or ``min_chars`` characters in long stretches without white space."""
    if not dup.any():
        return []
    a = np.frombuffer(text, np.uint8)
    words, chars = word_starts(a), bare_chars(a)
    starts = np.r_[0, ends[:-1]]
    edge = np.flatnonzero(np.diff(np.r_[0, dup.astype(np.int8), 0]))
    out = []
    for x, y in zip(edge[::2].tolist(), edge[1::2].tolist()):
        s, e = int(starts[x]), int(ends[y - 1])
        if words[e] - words[s] >= min_words or chars[e] - chars[s] >= min_chars:
            out.append((s, e))
    return out


def _ids(table: pa.Table) -> np.ndarray:
    return np.array([_LAST if i is None else i for i in table["_id"].to_pylist()], np.int64)


def _texts(table: pa.Table) -> list[bytes]:
    return [b if b is not None else b"" for b in table["_text"].cast(pa.binary()).to_pylist()]


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, report: bool = True, min_chars: int = MIN_CHARS, group_docs: int = GROUP_DOCS, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """The rows of ``docs`` with duplicate passages cut out of the text.

    ``report`` adds ``n_chunks``, ``n_duplicate_chunks``, ``removed_chars`` and ``removed``, the spans
    ``start:end`` in code points of the original text, comma-joined; else the columns are as they were.
    """
    cols = list(docs.columns)
    for c in (id_col, text_col):
        if cols.count(c) != 1:
            raise ValueError(f"column {c!r} must be there once, found {cols.count(c)} in {cols}")
    small_batches(docs.sparkSession)
    at_id, at_text = cols.index(id_col), cols.index(text_col)
    if not isinstance(docs.schema.fields[at_id].dataType, T.IntegralType):
        raise ValueError(f"column {id_col!r} must hold integers, found {docs.schema.fields[at_id].dataType.simpleString()}")
    d = docs.toDF(*[f"_c{i}" for i in range(len(cols))])
    n, size = d.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(f"_c{at_text}")), F.lit(0))).first()
    groups, buckets = max(1, n // group_docs, size // group_bytes), max(32, size // BUCKET_BYTES)
    d = d.withColumn("_g", F.pmod(F.xxhash64(F.col(f"_c{at_id}").cast("long"), F.col(f"_c{at_text}")), F.lit(groups))).withColumn("_id", F.col(f"_c{at_id}").cast("long")).withColumn("_text", F.col(f"_c{at_text}"))
    d = d.drop(f"_c{at_text}")

    kept_fields = [f for f in d.schema.fields if f.name.startswith("_c")]
    text_type = docs.schema.fields[at_text].dataType
    extra = [T.StructField("n_chunks", T.LongType()), T.StructField("n_duplicate_chunks", T.LongType()), T.StructField("removed_chars", T.LongType()), T.StructField("removed", T.StringType())]
    schema = T.StructType([*kept_fields, T.StructField("_text", text_type), *extra])
    ask, answer, cut_out = steps([f.name for f in kept_fields], buckets, min_words, min_chars)

    dealt = d.groupBy("_g")
    # the same grouping as below, so that one shuffle serves both
    asked = dealt.applyInArrow(ask, "_g long, bucket long, high binary, low binary, own binary")
    replies = asked.groupBy("bucket").applyInArrow(answer, "_g long, bucket long, mine binary")
    result = dealt.cogroup(replies.groupBy("_g")).applyInArrow(cut_out, schema)
    names = [F.col("_text" if i == at_text else f"_c{i}").alias(c) for i, c in enumerate(cols)]
    return result.select(*names, *([f.name for f in extra] if report else []))


def steps(passed: list[str], buckets: int, min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS):
    """The three steps: what a group asks of the digest buckets, a bucket's answer, and the group's texts with the answers.

    ``passed`` are the columns of the rows that go through unchanged.
    """

    def ask(key: tuple, rows: pa.Table) -> pa.Table:
        c = Chunked(_texts(rows))
        own = c.owners(_ids(rows))
        order, bucket = c.order(buckets)
        high, low, own = c.high[order], c.low[order], own[order]
        b, first = np.unique(bucket, return_index=True)
        ends = np.r_[first[1:], len(bucket)]
        cut = lambda x: pa.array([x[s:e].tobytes() for s, e in zip(first, ends)], pa.binary())
        return pa.table({"_g": pa.array([key[0].as_py()] * len(b), pa.int64()), "bucket": pa.array(b, pa.int64()), "high": cut(high), "low": cut(low), "own": cut(own)})

    def answer(_: tuple, asked: pa.Table) -> pa.Table:
        parts = {k: [np.frombuffer(x, t) for x in asked[k].to_pylist()] for k, t in (("high", "<u8"), ("low", "<u8"), ("own", "<i8"))}
        high, low, own = (np.concatenate(parts[k]) for k in ("high", "low", "own"))
        order = np.lexsort((own, high, low))
        h, w, o = high[order], low[order], own[order]
        first = np.r_[True, (h[1:] != h[:-1]) | (w[1:] != w[:-1])] if len(h) else np.zeros(0, bool)
        least = o[np.flatnonzero(first)][np.cumsum(first) - 1]
        mine = np.empty(len(h), np.uint8)
        mine[order] = o == least
        cuts = np.cumsum([0, *map(len, parts["low"])])
        return pa.table({"_g": asked["_g"], "bucket": asked["bucket"], "mine": pa.array([mine[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())})

    def cut_out(key: tuple, rows: pa.Table, replies: pa.Table) -> pa.Table:
        texts, ids = _texts(rows), _ids(rows)
        c = Chunked(texts)
        own = c.owners(ids)
        mine = np.zeros(len(own), bool)
        if replies.num_rows:
            order, _ = c.order(buckets)
            mine[order] = np.frombuffer(b"".join(replies.sort_by("bucket")["mine"].to_pylist()), np.uint8).astype(bool)
        out, n_chunks, n_dup, n_removed, spans = [], [], [], [], []
        for t, i, codes, ends, was_null in zip(texts, ids, c.codes, c.ends, rows["_text"].is_null().to_pylist()):
            dup = ~(mine[codes] & (own[codes] == i))
            seen = np.ones(len(codes), bool)
            seen[np.unique(codes, return_index=True)[1]] = False  # later occurrences in the same text
            found = duplicate_spans(t, ends, dup | seen, min_words, min_chars)
            removed, at, kept, text_spans = 0, 0, [], []
            chars = 0
            for a, b in found:
                before, cut = t[at:a], t[a:b].decode()
                chars += len(before.decode())
                text_spans.append(f"{chars}:{chars + len(cut)}")
                chars += len(cut)
                removed += len(cut)
                kept.append(before)
                at = b
            kept.append(t[at:])
            out.append(None if was_null else b"".join(kept).decode())
            n_chunks.append(len(codes))
            n_dup.append(int((dup | seen).sum()))
            n_removed.append(removed)
            spans.append(",".join(text_spans))
        table = rows.select(passed)
        for name, values, kind in (("_text", out, pa.string()), ("n_chunks", n_chunks, pa.int64()), ("n_duplicate_chunks", n_dup, pa.int64()), ("removed_chars", n_removed, pa.int64()), ("removed", spans, pa.string())):
            table = table.append_column(name, pa.array(values, kind))
        return table

    return ask, answer, cut_out


def substring_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, chunk counts, removed characters and spans, and the text that is left."""
    return deduplicated(picked(docs, **{id_col: id_col, text_col: text_col}), id_col, text_col)
