"""Spelling variants grouped around their commonest form by a bit-sliced position index.

Words are counted over the whole corpus: a task counts in its memory and hands on one row per word now and
then, so a frequent word never floods a shuffle. Two words are near if they differ by exactly one
inserted, deleted or replaced code point. Such a pair agrees in the first or in the last half of
the shorter word, so words are dealt into shards by a hash of the code points of either half (of their own length
and of one code point less): near words meet in a shard, and each pair is
counted in the one shard of the half that it agrees in.

In a shard the vocabulary is an index of bit sets: one per (position, letter), with a bit for each word
that has the letter there. A query word runs down its letters and moves four sets of the vocabulary
along, 64 words an operation: ``exact`` (no error so far), ``replaced`` (one code point replaced: positions
in line), ``longer`` (the other word has one more: its positions shifted by one) and ``shorter`` (one
less: shifted back by one). All query words of one length move at the same time, as a matrix of
bits. What ``replaced``, ``longer`` and ``shorter`` hold at the end, with the right length, are the near words.

A shard of more than ``SHARD`` words is split into tiles of index blocks and query blocks, so no task's
share grows with the vocabulary; every pair lies in exactly one tile. A word sends on its number of near
words in a tile and the best of them, never the pairs.

Roots: a form is at least twice as frequent as the word, so chains end; pointers are doubled
until none moves, which takes the logarithm of the longest chain.

Results for odd input: null texts hold no words; a null id is written as empty text in the rule that
deletes code points; repeated rows count as often as they come; ties go to the word first in code-point order; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, map_batches, partitions_for, picked, utf8

#: Runs ``[A-Za-zÀ-ÿ]+`` in the UTF-8 bytes of a text in which A-Z are lower case.
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: One run in this many loses a code point.
DELETED = 97
MIN_LETTERS = 5
MIN_COUNT = 3
#: A form is this many times as frequent as the word.
RATIO = 2
#: Words of a shard, which bounds a tile's bit sets.
SHARD = 8192
#: Distinct words a task counts before it hands them on.
MEMORY = 400_000
#: 64-bit words of one matrix of bits.
MATRIX = 1 << 19


def counted(text: bytes, doc_id: object, every: int, least: int) -> Iterator[tuple[bytes, int]]:
    """The words of a text and how often they come, after the rule that deletes a code point of some runs."""
    base = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    base = zlib.crc32(b":", base)
    for run, n in Counter(RUN.findall(text.translate(LOWER))).items():
        if len(run) < least:  # bytes are at least code points
            continue
        h = zlib.crc32(run, base)
        if h % every == 0:
            letters = run.decode()
            k = h % len(letters)
            run = (letters[:k] + letters[k + 1 :]).encode()
        if len(run) >= least and (run.isascii() or len(run.decode()) >= least):
            yield run, n


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = DELETED, least: int = MIN_LETTERS) -> DataFrame:
    """``(word, n)``: words of at least ``least`` code points over all texts."""
    d = picked(docs, id=id_col, text=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}

        def out() -> pa.RecordBatch:
            words = pa.array(list(seen), pa.binary()).cast(pa.string())
            batch = pa.RecordBatch.from_arrays([words, pa.array(list(seen.values()), pa.int64())], ["word", "n"])
            seen.clear()
            return batch

        for b in batches:
            for i, t in zip(b.column("id").to_pylist(), utf8(b.column("text"))):
                for w, n in counted(t, i, every, least):
                    seen[w] = seen.get(w, 0) + n
                if len(seen) > MEMORY:
                    yield out()
        if seen:
            yield out()

    return map_batches(d, run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class PositionIndex:
    """Bit sets of a vocabulary by (position, letter)."""

    def __init__(self, words: list[str]):
        n = len(words)
        self.words = -(-n // 64)
        size = np.fromiter(map(len, words), np.int64, n)
        self.top = int(size.max(initial=0))
        flat = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        self.letters, code = np.unique(flat, return_inverse=True)
        row = np.repeat(np.arange(n), size)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
        # one more position and one more letter stay empty, for what lies beyond the vocabulary
        bits = np.zeros((self.top + 1, len(self.letters) + 1, self.words * 64), bool)
        bits[place, code, row] = True
        self.at = np.packbits(bits, axis=2, bitorder="little").view("<u8")
        length = np.zeros((self.top + 2, self.words * 64), bool)
        length[size, np.arange(n)] = True
        self.length = np.packbits(length, axis=1, bitorder="little").view("<u8")

    def near(self, queries: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Query and vocabulary numbers of all pairs that differ by exactly one code point; the queries have one length."""
        size = len(queries[0])
        if size > self.top + 1:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        flat = np.frombuffer("".join(queries).encode("utf-32-le"), "<u4").reshape(-1, size)
        code = np.searchsorted(self.letters, flat)
        code[(code == len(self.letters)) | (self.letters[np.minimum(code, len(self.letters) - 1)] != flat)] = len(self.letters)
        beyond = np.zeros((len(queries), self.words), "<u8")
        sets = lambda position, letter: self.at[position, letter] if position < self.top else beyond
        exact = np.full((len(queries), self.words), ~np.uint64(0), "<u8")
        replaced, longer, shorter = np.zeros_like(exact), np.zeros_like(exact), np.zeros_like(exact)
        for i in range(size):
            here = sets(i, code[:, i])
            longer = (longer | exact) & sets(i + 1, code[:, i])
            shorter = (shorter & sets(i - 1, code[:, i]) | exact) if i else exact.copy()
            replaced = replaced & here | exact & ~here
            exact &= here
        longer |= exact  # one more at the end
        found = replaced & self.length[size] | shorter & self.length[size - 1]
        if size < self.top:
            found |= longer & self.length[size + 1]
        row, col = np.nonzero(found)
        bit = np.unpackbits(found[row, col].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        k, b = np.nonzero(bit)
        return row[k], col[k] * 64 + b


def _halves(word: str, least: int) -> tuple[str, str, str, str]:
    """First and last halves, of the word's own length and of one less; the half counts code points of the shorter word of a pair."""
    a, b = len(word) // 2, max(len(word) - 1, least) // 2
    return word[:a], word[len(word) - a :], word[:b], word[len(word) - b :]


def _code(side: str, half: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(f"{side}{half}")


def keyed(words: DataFrame, shards: int, least: int) -> DataFrame:
    """``(shard, word, n)``: each word once in every shard of one of its halves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            take, shard = [], []
            for k, w in enumerate(b.column("word").to_pylist()):
                p, s, q, t = _halves(w, least)
                for at in {_code("<", p) % shards, _code(">", s) % shards, _code("<", q) % shards, _code(">", t) % shards}:
                    take.append(k)
                    shard.append(at)
            rows = b.take(pa.array(take, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), rows.column("word"), rows.column("n")], ["shard", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "shard long, word string, n long")


def tile_near(queries: pa.Table, vocabulary: pa.Table, shard: int, shards: int, least: int) -> pa.Table:
    """Per query word of a tile with near words in it that count in this shard: how many, and the best."""
    ours, theirs = queries["word"].to_pylist(), vocabulary["word"].to_pylist()
    index, counts = PositionIndex(theirs), vocabulary["n"].to_numpy()
    order = np.array(sorted(range(len(theirs)), key=theirs.__getitem__), np.int64)  # code-point order
    place = np.empty(len(theirs), np.int64)
    place[order] = np.arange(len(theirs))

    def codes(words: list[str]) -> np.ndarray:
        return np.array([[_code(side, h) for side, h in zip("<><>", _halves(w, least))] for w in words], np.uint64).reshape(-1, 4)

    qc, vc = codes(ours), codes(theirs)
    vsize = np.fromiter(map(len, theirs), np.int64, len(theirs))
    by: dict[int, list[int]] = {}
    for k, w in enumerate(ours):
        by.setdefault(len(w), []).append(k)
    word, number, best_n, best = [], [], [], []
    step = max(1, MATRIX // max(1, index.words))
    for size, members in by.items():
        for s in range(0, len(members), step):
            part = np.array(members[s : s + step])
            q, v = index.near([ours[k] for k in part])
            q = part[q]
            # the half is that of the shorter word: of the own length, or of one less
            a = np.where(vsize[v] < size, 2, 0)
            b = np.where(vsize[v] > size, 2, 0)
            first, other = qc[q, a] == vc[v, b], qc[q, a + 1]
            home = np.where(first, qc[q, a], other) % np.uint64(shards)
            mine = home == np.uint64(shard)
            q, v = q[mine], v[mine]
            rank = np.lexsort((place[v], -counts[v], q))
            q, v = q[rank], v[rank]
            start = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, np.int64)
            word += [ours[k] for k in q[start]]
            number.append(np.diff(np.r_[start, len(q)]))
            best_n.append(counts[v[start]])
            best += [theirs[k] for k in v[start]]
    flat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return pa.table({"word": pa.array(word, pa.string()), "n_near": pa.array(flat(number), pa.int64()), "form_n": pa.array(flat(best_n), pa.int64()), "form": pa.array(best, pa.string())})


def near_words(scratch: Scratch, words: DataFrame, n_words: int, least: int = MIN_LETTERS, shard_words: int = SHARD) -> DataFrame:
    """``(word, n_near, form, form_n)``: per word with near words, how many and the most frequent, ties to the first in code-point order."""
    shards = partitions_for(4 * n_words, shard_words / 2)
    rows = scratch.write(keyed(words, shards, least), "spelling-shards")
    sizes = rows.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / F.lit(shard_words)).cast("long").alias("tiles"))
    rows = rows.join(sizes, "shard").withColumn("block", F.pmod(F.xxhash64("word"), F.col("tiles")))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))
    asked = rows.select("shard", F.col("block").alias("i"), each.alias("j"), "word", "n")
    index = rows.select(F.col("shard").alias("s"), each.alias("x"), F.col("block").alias("y"), F.col("word").alias("word"), F.col("n").alias("n"))

    def tile(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return tile_near(left, right, key[0].as_py(), shards, least)

    found = asked.groupBy("shard", "i", "j").cogroup(index.groupBy("s", "x", "y")).applyInArrow(tile, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form"))).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def rooted(scratch: Scratch, forms: DataFrame) -> DataFrame:
    """``forms(word, form, ...)`` with ``root``: the last word of the chain of forms, the word itself if it has none."""
    jumps = scratch.write(forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "spelling-jumps")
    while True:
        nxt = jumps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = jumps.join(nxt, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        jumps = scratch.write(moved, "spelling-jumps")
        if jumps.where("moved").isEmpty():
            break
    return forms.join(jumps.select("word", "root"), "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    every: int = DELETED,
    min_letters: int = MIN_LETTERS,
    min_count: int = MIN_COUNT,
    ratio: int = RATIO,
    shard_words: int = SHARD,
) -> DataFrame:
    """Per word: ``(word, form, root, n, n_near, form_n)``; a form is null where no near word is ``ratio`` times as frequent."""
    scratch = Scratch(docs.sparkSession)
    words = scratch.write(word_counts(docs, id_col, text_col, every, min_letters).where(F.col("n") >= min_count), "spelling-words")
    near = near_words(scratch, words, words.count(), min_letters, shard_words)
    common = F.col("form_n") >= ratio * F.col("n")
    forms = words.join(near, "word", "left").select(
        "word", F.when(common, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(common, F.col("form_n")).alias("form_n")
    )
    forms = scratch.write(forms, "spelling-forms")
    return rooted(scratch, forms).select("word", "form", "root", "n", "n_near", "form_n")
