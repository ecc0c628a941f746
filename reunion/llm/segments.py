"""Token ids of whole batches of texts through a memory of distinct segments.

Encoders cut a text where no token can cross: before a space. A batch of texts is one array of bytes here;
its cuts, two 64-bit hashes of every segment and its distinct segments are found by numpy operations over all
texts together. Python sees only segments that are new; their ids lie in one flat array, and the ids of all texts are
gathered from it at once. Segments are told apart by both hashes (longer ones by a 128-bit digest).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Distinct segments kept before a memory starts anew.
MEMORY = 500_000
#: Bytes of text taken together; a longer text is taken alone.
STRIP = 1 << 20
#: Segments of more bytes have a digest instead of the two hashes.
LONG = 256

_rng = np.random.default_rng(11)
_BYTE = _rng.integers(0, 1 << 64, (2, 256), np.uint64)
_PLACE = _rng.integers(0, 1 << 64, (2, LONG), np.uint64) | np.uint64(1)


def before_words(a: np.ndarray) -> np.ndarray:
    """Spaces behind a character that is surely no white space."""
    cut = a == 32
    behind = np.empty(len(a), bool)
    behind[:1] = False
    prev = a[:-1]
    behind[1:] = (prev > 32) & (prev < 128)
    far = np.flatnonzero(cut[1:] & (prev >= 128)) + 1  # a character of several bytes: which ones can be white space is known by their first
    lead2, lead3 = a[np.maximum(far - 2, 0)], a[np.maximum(far - 3, 0)]
    behind[far] = (lead2 != 0xC2) & ((lead3 < 0xE1) | (lead3 > 0xE3))
    return cut & behind


def before_spaces(a: np.ndarray) -> np.ndarray:
    """Spaces behind anything but a space or the mark for one."""
    cut = a == 32
    cut[1:] &= a[:-1] != 32
    marks = np.flatnonzero(cut[3:] & (a[2:-1] == 0x81) & (a[1:-2] == 0x96) & (a[:-3] == 0xE2)) + 3
    cut[marks] = False
    return cut


def text_bytes(column: pa.Array, prefix: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of bytes, and their bounds; null counts as empty, ``prefix`` goes before texts that are not."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if prefix:
        column = pc.if_else(pc.greater(pc.binary_length(column), 0), pc.binary_join_element_wise(pa.scalar(prefix, pa.large_binary()), column, pa.scalar(b"", pa.large_binary())), column)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), bounds


class Memory:
    """Ids of segments by their hashes. ``learn`` gives the ids of new segments, one after the other, and where each one's end."""

    def __init__(self, learn: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], cuts: Callable[[np.ndarray], np.ndarray], limit: int = MEMORY):
        self.learn, self.cuts, self.limit = learn, cuts, limit
        self._empty()

    def _empty(self) -> None:
        self.place: dict[bytes, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.start, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _add(self, keys: list[bytes], segments: list[bytes]) -> None:
        flat, ends = self.learn(segments)
        n, m = len(self.place), len(keys)
        while len(self.flat) < self.used + len(flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while len(self.start) < n + m:
            self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
        self.flat[self.used : self.used + len(flat)] = flat
        sizes = np.diff(ends, prepend=0)
        self.start[n : n + m], self.size[n : n + m] = self.used + ends - sizes, sizes
        self.used += len(flat)
        self.place.update(zip(keys, range(n, n + m)))

    def _hashed(self, a: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        import xxhash

        at = np.arange(len(a), dtype=np.int64) - np.repeat(start, size)
        long = np.flatnonzero(size > LONG)
        if len(long):
            at %= LONG
        first, second = (np.add.reduceat(_BYTE[k][a] * _PLACE[k][at], start) for k in (0, 1))
        for i in long.tolist():
            d = xxhash.xxh3_128_intdigest(a[start[i] : start[i] + size[i]])
            first[i], second[i] = d & (2**64 - 1), d >> 64
        return first + size.astype(np.uint64), second

    def _strip(self, a: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some texts, and where each one's end."""
        n = len(bounds) - 1
        if not len(a):
            return np.zeros(0, np.uint32), np.zeros(n, np.int64)
        begins = self.cuts(a)
        begins[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
        start = np.flatnonzero(begins)
        size = np.diff(start, append=len(a))
        one, two = self._hashed(a, start, size)
        _, first, same = np.unique(one, return_index=True, return_inverse=True)
        if (two[first][same] != two).any():  # equal first hashes of different segments
            _, first, same = np.unique(np.c_[one, two], axis=0, return_index=True, return_inverse=True)
            same = same.ravel()
        if len(self.place) + len(first) > self.limit:
            self._empty()
        packed = np.c_[one[first], two[first]].tobytes()
        keys = [packed[i : i + 16] for i in range(0, len(packed), 16)]
        new = [i for i, k in enumerate(keys) if k not in self.place]
        if new:
            whole, s, e = a.tobytes(), start[first], start[first] + size[first]
            self._add([keys[i] for i in new], [whole[x:y] for x, y in zip(s[new].tolist(), e[new].tolist())])
        entry = np.fromiter(map(self.place.__getitem__, keys), np.int64, len(keys))[same]
        count = self.size[entry]
        ends = np.cumsum(count)
        ids = self.flat[np.repeat(self.start[entry] - (ends - count), count) + np.arange(ends[-1])]
        return ids, np.r_[0, ends][np.searchsorted(start, bounds[1:])]

    def encode(self, column: pa.Array, prefix: bytes = b"") -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of the texts of a column and where each one's end, some texts at a time and in order."""
        data, bounds = text_bytes(column, prefix)
        at, n = 0, len(bounds) - 1
        while at < n:
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + STRIP, side="right")) - 1)
            part = bounds[at : to + 1]
            yield self._strip(data[part[0] : part[-1]], part - part[0])
            at = to
