"""SentencePiece encoding and decoding of merge-type vocabularies by an agenda of adjacent symbol pairs.

White space is written as ``▁`` and a text starts with one. No piece of a merge vocabulary holds a ``▁`` behind another
character, so no merge crosses the start of a ``▁`` run: a text is cut there, and each distinct segment
is merged once and kept in a bounded memory of the worker (:mod:`.segments`). A segment starts as its characters. Its agenda
holds the adjacent pairs whose joined text is a piece, best score first and leftmost among
equals; the first pair is joined, and the two pairs that the new symbol makes go on the agenda. The agendas of
the new segments of some texts lie in one flat array and give up their first pair at the same time, so a
round is a few numpy operations; a segment of over ``LONG`` characters has a heap of its own, as
rounds over it would cost the square of its length. Characters that are no piece become their UTF-8 bytes.

The agendas are checked against the sentencepiece library in Arrow batches: the new segments of each batch are
encoded by both, and a difference is an error, never a silent result. Decoding is the library's.

Results for odd input: a null text counts as empty, and an empty text is the begin and end ids alone;
null ids and repeated rows keep their rows; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .bpe import NONE, PairTable
from .common import map_batches, picked, worker_state
from .segments import Memory, before_spaces

SPACE = "▁"
#: Segments of more characters have a heap.
LONG = 64
#: Ids of characters that are no piece start here, by code point.
OTHER = 1 << 24
#: Bits of a place in a text in an agenda entry; the rank of the score stands above them.
PLACE = 40


class Pieces:
    """Encoder and decoder for a model file; ``check`` holds new segments against the library."""

    def __init__(self, path: str, check: bool = True):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        rules, trained = spec.normalizer_spec, spec.trainer_spec
        kinds = {p.type for p in spec.pieces}
        kind = type(spec.pieces[0])
        if trained.model_type != trained.BPE or trained.treat_whitespace_as_suffix or kinds & {kind.USER_DEFINED, kind.UNUSED}:
            raise ValueError("only merge-type vocabularies without user-defined or unused pieces")
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not (rules.add_dummy_prefix and rules.escape_whitespaces):
            raise ValueError("only models that leave texts as they are, but for the white space mark")
        if any(SPACE in p.piece.lstrip(SPACE) for p in spec.pieces):
            raise ValueError("a piece holds white space behind another character")
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.begin, self.end = self.library.bos_id(), self.library.eos_id()
        normal = [(i, p) for i, p in enumerate(spec.pieces) if p.type == kind.NORMAL]
        self.ids = {p.piece: i for i, p in normal}
        place = {s: k for k, s in enumerate(sorted({p.score for _, p in normal}, reverse=True))}
        self.rank = {p.piece: place[p.score] for _, p in normal}
        unknown = self.library.unk_id()
        written = {int(p.piece[3:5], 16): i for i, p in enumerate(spec.pieces) if p.type == kind.BYTE}
        self.bytes = [written.get(b, unknown) for b in range(256)] if written else None
        self.unknown, self.check = unknown, check
        self.letter = np.arange(OTHER, OTHER + 0x110000, dtype=np.int64)  # id of each code point
        for p, i in self.ids.items():
            if len(p) == 1:
                self.letter[ord(p)] = i
        symbol = lambda x: self.ids.get(x, OTHER + ord(x) if len(x) == 1 else None)
        joins = [(symbol(p[:k]), symbol(p[k:]), i) for p, i in self.ids.items() for k in range(1, len(p))]
        self.pairs = PairTable(*map(list, zip(*[x for x in joins if x[0] is not None and x[1] is not None])))
        self.order = np.full(len(spec.pieces) + 1, NONE, np.int32)  # rank of a piece's score; the last for no piece
        for p, i in self.ids.items():
            self.order[i] = self.rank[p]
        self.memory = Memory(self._learn, before_spaces)

    def merged(self, segment: str) -> list[str]:
        """The symbols of a segment when its agenda is empty."""
        symbol, rank = list(segment), self.rank.get
        n = len(symbol)
        agenda = [r << PLACE | i for i, (a, b) in enumerate(zip(symbol, symbol[1:])) if (r := rank(a + b)) is not None]
        if not agenda:
            return symbol
        heapq.heapify(agenda)
        after, before, mask = list(range(1, n + 1)), list(range(-1, n - 1)), (1 << PLACE) - 1
        while agenda:
            entry = heapq.heappop(agenda)
            i = entry & mask
            j = after[i]
            if j >= n or not symbol[i]:
                continue
            joined = symbol[i] + symbol[j]
            if rank(joined) != entry >> PLACE:  # one of the two has changed since
                continue
            symbol[i], symbol[j] = joined, ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                r = rank(joined + symbol[k])
                if r is not None:
                    heapq.heappush(agenda, r << PLACE | i)
            k = before[i]
            if k >= 0:
                r = rank(symbol[k] + joined)
                if r is not None:
                    heapq.heappush(agenda, r << PLACE | k)
        return [s for s in symbol if s]

    def _numbers(self, symbols: list[str]) -> list[int]:
        out = list(map(self.ids.get, symbols))
        if None not in out:
            return out
        out = []
        for s in symbols:
            i = self.ids.get(s)
            if i is not None:
                out.append(i)
            elif self.bytes is None:
                if not out or out[-1] != self.unknown:  # neighbouring unknown characters are one piece
                    out.append(self.unknown)
            else:
                out += [self.bytes[b] for b in s.encode()]
        return out

    def _agendas(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of short segments one after the other, and where each ends: all agendas move on together."""
        size = np.fromiter(map(len, segments), np.int64, len(segments))
        symbol = self.letter[np.frombuffer("".join(segments).encode("utf-32-le"), "<u4")]
        owner = np.repeat(np.arange(len(segments)), size)

        def pairs(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """What the pairs at these places join to, and the rank of its score."""
            joined = self.pairs.rank(symbol[at], symbol[at + 1])
            return joined, self.order[np.where(joined == NONE, len(self.order) - 1, joined)]

        joined, rank = np.full(len(symbol), NONE, np.int32), np.full(len(symbol), NONE, np.int32)
        at = np.flatnonzero(owner[1:] == owner[:-1])
        joined[at], rank[at] = pairs(at)
        done: list[np.ndarray] = []
        whose: list[np.ndarray] = []
        while len(symbol):
            start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            best = np.repeat(np.minimum.reduceat(rank, start), np.diff(np.r_[start, len(owner)]))
            keep = best != NONE
            if not keep.all():  # empty agendas
                done.append(symbol[~keep])
                whose.append(owner[~keep])
                symbol, owner, joined, rank, best = symbol[keep], owner[keep], joined[keep], rank[keep], best[keep]
                if not len(symbol):
                    break
            at = np.flatnonzero(rank == best)
            at = at[np.r_[True, owner[at[1:]] != owner[at[:-1]]]]  # the leftmost of each segment
            symbol[at] = joined[at]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            symbol, owner, joined, rank = symbol[keep], owner[keep], joined[keep], rank[keep]
            at -= np.arange(len(at))  # one symbol went for each segment before
            joined[at] = rank[at] = NONE
            right = at[(at + 1 < len(owner))]
            right = right[owner[right + 1] == owner[right]]
            left = at[at > 0] - 1
            left = left[owner[left] == owner[left + 1]]
            new = np.concatenate([left, right])
            joined[new], rank[new] = pairs(new)
        symbol, owner = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (done, whose))
        order = np.argsort(owner, kind="stable")
        symbol, owner = symbol[order], owner[order]
        other = np.flatnonzero(symbol >= OTHER)
        if len(other):
            width = np.ones(len(symbol), np.int64)
            code = symbol[other] - OTHER
            width[other] = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
            start = np.cumsum(width) - width
            symbol, owner = np.repeat(symbol, width), np.repeat(owner, width)
            for c in np.unique(code).tolist():
                ids = [self.bytes[b] for b in chr(c).encode()]
                symbol[start[other[code == c]][:, None] + np.arange(len(ids))] = ids
        return symbol.astype(np.uint32), np.searchsorted(owner, np.arange(len(segments)), side="right")

    def _learn(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new segments one after the other, and where each one's end."""
        marked = [s.decode().replace(" ", SPACE) for s in segments]
        flat, ends = self._agendas([m if len(m) <= LONG and self.bytes is not None else "" for m in marked])
        long = [(k, m) for k, m in enumerate(marked) if len(m) > LONG or self.bytes is None]
        if long:
            parts = np.split(flat, ends[:-1])
            for k, m in long:
                parts[k] = np.array(self._numbers(self.merged(m)), np.uint32)
            flat, ends = np.concatenate(parts), np.cumsum(list(map(len, parts)))
        if self.check:
            self._checked(marked, flat, ends)
        return flat, ends

    def _checked(self, marked: list[str], flat: np.ndarray, ends: np.ndarray) -> None:
        """Raise if the library gives these segments other ids: at once, as a text of them all, then one by one to name it."""
        ours = np.split(flat, ends[:-1])
        alone = [(m, x) for m, x in zip(marked, ours) if not m.strip(SPACE)]  # these would run into the next segment
        if alone:
            both = [(m, x) for m, x in zip(marked, ours) if m.strip(SPACE)]
            marked, ours = [m for m, _ in both], [x for _, x in both]
            flat = np.concatenate(ours) if ours else flat[:0]
        if not np.array_equal(np.array(self.library.encode("".join(marked)[1:]) if marked else [], np.uint32), flat):
            alone += zip(marked, ours)
        for m, x in alone:
            theirs = self.library.encode(m[1:])
            if x.tolist() != theirs and m != SPACE:  # the library gives an empty text no mark
                raise RuntimeError(f"the agenda gives {x.tolist()} for {m!r}, the library {theirs}")

    def encode_column(self, column: pa.Array) -> Iterator[list[np.ndarray]]:
        """Begin id, ids and end id of each text of a column, some texts at a time."""
        for ids, ends in self.memory.encode(column, b" "):
            ids = np.insert(ids, np.r_[0, np.repeat(ends, 2)[:-1]], np.tile(np.array([self.begin, self.end], np.uint32), len(ends))) if len(ends) else ids
            yield np.split(ids, (ends + 2 * np.arange(1, len(ends) + 1))[:-1])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [x for part in self.encode_column(pa.array(texts, pa.string())) for x in part]

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        """The library's text of each id array."""
        return self.library.decode([x.tolist() for x in ids], num_threads=1) if ids else []


def _coder(path: str) -> Pieces:
    return worker_state("pieces:" + path, lambda: Pieces(path))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids)``: the ids of each text, begin and end included."""
    d = picked(docs, id=id_col, text=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path)
        for b in batches:
            ids = [x.astype(np.int32) for part in coder.encode_column(b.column("text")) for x in part]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(ids, pa.list_(pa.int32()))], [id_col, "ids"])

    return map_batches(d, run, T.StructType([T.StructField(id_col, d.schema["id"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id, text)``: the text of each id array; a null array gives null."""
    d = picked(encoded, id=id_col, ids=ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path)
        for b in batches:
            ids = b.column("ids").to_pylist()
            out = coder.decode([np.array(x or [], np.int64) for x in ids])
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([None if x is None else t for x, t in zip(ids, out)], pa.string())], [id_col, "text"])

    return map_batches(d, run, T.StructType([T.StructField(id_col, d.schema["id"].dataType), T.StructField("text", T.StringType())]))


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, number of ids, digest of the ids, digest of the text decoded from them."""
    d = picked(docs, id=id_col, text=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path)
        for b in batches:
            n, digests, decoded = [], [], []
            for ids in coder.encode_column(b.column("text")):
                n += map(len, ids)
                digests += [hashlib.sha256(x.astype("<u4", copy=False)).hexdigest() for x in ids]
                decoded += [hashlib.sha256(x.encode()).hexdigest() for x in coder.decode(ids)]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(n, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())], [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    fields = [T.StructField(id_col, d.schema["id"].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    return map_batches(d, run, T.StructType(fields))
