"""Language-model scores by a probabilistic suffix tree over words.

A text is its words (A-Z lowered, cut at ASCII white space) and one end symbol. A context is the word
before a symbol, or the two words before it; a start mark stands before the first word. The longest retained
suffix of what precedes a symbol is the state that scores it.

A context seen at least ``LEAST`` times in the training texts is considered; this is a fixed count and no share, so
the tree grows with the corpus. It is retained when its next-symbol distribution diverges from its parent's
(the context without its oldest word): count times Kullback-Leibler divergence is at least ``DIVERGENCE`` nats
for each distinct next symbol (sparse counts alone make a divergence of about half a nat for each). The tree is grown from the
root, so a context of two words is considered only below a retained one. A node's distribution is smoothed
towards its parent's with the weight of its distinct symbols; the root's adds one to each word and to one
symbol for all unknown words, as the base score does.

Nothing of the tree is sent to all tasks or to the driver. Texts are read in chunks of bounded size. A chunk asks
for its distinct words, pairs and triples of words only, packed in one array per bucket of the key's hash; a bucket adds
up what the chunks hold of each key and answers in the order asked. So a hot word or context is one
entry per chunk. There are three rounds: counts of words and pairs; counts of triples under contexts seen often
enough, and distinct symbols and divergences of one-word contexts; the same of two-word contexts. Distinct symbols and divergence
are sums over positions (1/n and a log ratio for each of the n times that a symbol follows), so no task ever
holds all the symbols of a context. Words are told apart by 64-bit hashes, pairs and triples by 64-bit hashes of these.

Results for odd input: a null text counts as empty (its end symbol is its only token); a null id
counts as the empty string for the split; repeated rows each count and keep their row; without
training texts the only probability is that of an unknown word, 1, so all scores are zero; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, map_batches, partitions_for, picked, utf8

LEAST = 8
DIVERGENCE = 1.0
#: The end symbol: a byte that no word holds.
END = b"\n"
#: Bytes of text of one chunk.
CHUNK = 12_000_000
#: Entries of one bucket, about.
ENTRIES = 2_000_000

#: What is asked: counts of words, of pairs and of triples, and sums over the positions after one and two words.
WORDS, PAIRS, TRIPLES, AFTER_ONE, AFTER_TWO = range(5)
_ASKED = "chunk long, kind int, bucket int, keys binary, vals binary"
_REPLY = "chunk long, kind int, bucket int, sums binary, known long, total long"
_ROWS = "chunk long, pos long, held boolean, seq binary, words binary"


def _packed(a: np.ndarray) -> bytes:
    """An array as bytes, all first bytes first: small numbers then compress well."""
    return np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes()


def _unpacked(x: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _sent(kind: int) -> type:
    """The type of the numbers that a chunk sends: counts, or a chunk's part of the sums after a context."""
    return np.float32 if kind in (AFTER_ONE, AFTER_TWO) else np.int64


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit hashes of pairs of 64-bit hashes."""
    with np.errstate(over="ignore"):
        x = (a ^ (a >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + b
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def held_out(id_col: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 7."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def _read_chunks(docs: DataFrame) -> DataFrame:
    """A row per text, its words as numbers, and a row per chunk (``pos`` null) with the hash of each number's word."""
    id_type = docs.schema["id"].dataType
    schema = T.StructType([T.StructField("id", id_type), *T._parse_datatype_string(_ROWS).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        names = [f.name for f in schema.fields]
        base, number, pos, size = TaskContext.get().partitionId() << 32, 0, 0, 0
        index: dict[bytes, int] = {}
        id_arrow = None

        def close() -> pa.RecordBatch:
            h = np.fromiter((xxhash.xxh64_intdigest(w) for w in index), np.uint64, len(index))
            none = lambda kind: pa.nulls(1, kind)
            return pa.RecordBatch.from_arrays([none(id_arrow), pa.array([base + number], pa.int64()), none(pa.int64()), none(pa.bool_()), none(pa.binary()), pa.array([h.tobytes()], pa.binary())], names)

        for b in batches:
            id_arrow = b.schema.field("id").type
            every, n = utf8(b.column("text")), b.num_rows
            at = 0
            while at < n:
                seqs, first = [], at
                while at < n and size < CHUNK:
                    words = every[at].lower().split()
                    words.append(END)
                    seqs.append(_packed(np.fromiter((index.setdefault(w, len(index)) for w in words), np.uint32, len(words))))
                    size += len(every[at]) + 1
                    at += 1
                m = at - first
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").slice(first, m), pa.array([base + number] * m, pa.int64()), pa.array(range(pos, pos + m), pa.int64()), b.column("held").slice(first, m).cast(pa.bool_()), pa.array(seqs, pa.binary()), pa.nulls(m, pa.binary())],
                    names,
                )
                pos += m
                if size >= CHUNK:
                    yield close()
                    index, size, pos, number = {}, 0, 0, number + 1
        if size:
            yield close()

    return map_batches(docs, run, schema)


class Chunk:
    """The positions of a chunk's texts: symbol, pair and triple of each, and what the replies so far tell."""

    def __init__(self, rows: pa.Table, buckets: int):
        texts = rows.filter(pc.is_valid(rows["pos"])).sort_by("pos")
        self.chunk, self.buckets = texts["chunk"][0].as_py(), buckets
        self.texts = texts
        seqs = [_unpacked(x.as_buffer(), np.uint32) for x in texts["seq"]]
        self.sizes = np.array([len(x) for x in seqs])
        self.sym = np.concatenate(seqs).astype(np.int64)
        given = rows.filter(pc.is_valid(rows["words"]))
        h = np.frombuffer(given["words"][0].as_py(), np.uint64)
        self.hashes = np.r_[h, np.uint64(0)]  # the last number is the start mark
        self.start = len(h)
        firsts = np.cumsum(np.r_[0, self.sizes[:-1]])
        self.before = np.r_[0, self.sym[:-1]]
        self.before[firsts] = self.start
        self.train = np.repeat(~np.array(texts["held"].to_pylist(), bool), self.sizes)
        self.first = np.zeros(len(self.sym), bool)
        self.first[firsts] = True
        wide = np.int64(len(self.hashes))
        cells, self.pair = np.unique(self.before * wide + self.sym, return_inverse=True)
        self.pair_before, self.pair_sym = cells // wide, cells % wide
        self.pair_keys = _mixed(self.hashes[self.pair_before], self.hashes[self.pair_sym])
        answers = rows.filter(pc.is_valid(rows["bucket"])).sort_by([("kind", "ascending"), ("bucket", "ascending")])
        kinds = np.array(answers["kind"].to_pylist(), np.int64)
        self.sums = {int(k): np.concatenate([_unpacked(x.as_buffer(), np.int64) for x in answers["sums"].filter(pa.array(kinds == k))]) for k in np.unique(kinds)}

    # a bucket is a range of keys; both ways they are sorted, so that their high bytes compress

    def ask(self, kind: int, keys: np.ndarray, *vals: np.ndarray) -> list[tuple]:
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        bucket = ((keys >> np.uint64(32)) * np.uint64(self.buckets)) >> np.uint64(32)
        vals = [v[order].astype(_sent(kind)) for v in vals]
        b, first = np.unique(bucket, return_index=True)
        return [(self.chunk, kind, int(k), _packed(keys[x:y]), b"".join(_packed(v[x:y]) for v in vals)) for k, x, y in zip(b, first, np.r_[first[1:], len(bucket)])]

    def told(self, kind: int, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys))
        if len(keys):
            out[np.argsort(keys, kind="stable")] = self.sums[kind]
        return out

    # the three rounds

    def counts(self) -> list[tuple]:
        words = np.bincount(self.sym, weights=self.train, minlength=self.start)
        return self.ask(WORDS, self.hashes[:-1], words) + self.ask(PAIRS, self.pair_keys, np.bincount(self.pair, weights=self.train, minlength=len(self.pair_keys)))

    def read_counts(self, model: dict) -> None:
        """Counts of words, pairs and contexts, and the triples whose context is seen often enough."""
        self.model = model
        self.n1 = self.told(WORDS, self.hashes[:-1])
        self.n2 = self.told(PAIRS, self.pair_keys)
        # a word is followed once each time it is seen, the start mark once a text, so once an end symbol
        self.seen = np.r_[self.n1, self.n1[self.sym[-1]]]
        self.one = np.flatnonzero(self.seen >= model["least"])
        context = np.r_[0, self.pair[:-1]]
        self.at = np.flatnonzero(~self.first & (self.n2[context] >= model["least"]))
        context = context[self.at]
        self.two, self.context = np.unique(context, return_inverse=True)  # pairs that are contexts here
        wide = np.int64(len(self.hashes))
        cells, self.triple = np.unique(self.context * wide + self.sym[self.at], return_inverse=True)
        self.triple_context, triple_sym = cells // wide, cells % wide
        self.triple_keys = _mixed(~self.pair_keys[self.two[self.triple_context]], self.hashes[triple_sym])
        self.triple_pair = np.zeros(len(cells), np.int64)
        self.triple_pair[self.triple] = self.pair[self.at]

    def after_one(self) -> list[tuple]:
        t = np.bincount(self.pair, weights=self.train, minlength=len(self.pair_keys))
        on = np.flatnonzero((t > 0) & (self.seen[self.pair_before] >= self.model["least"]))
        t, n, y, s = t[on], self.n2[on], self.pair_before[on], self.pair_sym[on]
        gain = np.log(n / self.seen[y]) - np.log(self.n1[s] / self.model["total"])
        sums = [np.bincount(y, weights=t * w, minlength=len(self.seen))[self.one] for w in (1 / n, gain)]
        return self.ask(AFTER_ONE, self.hashes[self.one], *sums) + self.ask(TRIPLES, self.triple_keys, np.bincount(self.triple, weights=self.train[self.at], minlength=len(self.triple_keys)))

    def read_after_one(self) -> None:
        self.n3 = self.told(TRIPLES, self.triple_keys)
        self.distinct = np.zeros(len(self.seen))  # 0 for a context that is not retained
        self.distinct[self.one] = self.told(AFTER_ONE, self.hashes[self.one])
        self.below = np.flatnonzero(self.distinct[self.pair_sym[self.two]])  # two-word contexts whose parent is retained

    def after_two(self) -> list[tuple]:
        t = np.bincount(self.triple, weights=self.train[self.at], minlength=len(self.triple_keys))
        on = np.flatnonzero(t > 0)
        t, n, c, p = t[on], self.n3[on], self.triple_context[on], self.triple_pair[on]
        gain = np.log(n / self.n2[self.two[c]]) - np.log(self.n2[p] / self.seen[self.pair_before[p]])
        sums = [np.bincount(c, weights=t * w, minlength=len(self.two))[self.below] for w in (1 / n, gain)]
        return self.ask(AFTER_TWO, self.pair_keys[self.two[self.below]], *sums)

    def scores(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: known tokens, base score and the tree's score."""
        distinct = np.zeros(len(self.two))
        distinct[self.below] = self.told(AFTER_TWO, self.pair_keys[self.two[self.below]])
        root = (self.n1 + 1) / (self.model["total"] + self.model["known"] + 1)
        y, s = self.pair_before, self.pair_sym
        pairs = np.where(self.distinct[y] > 0, (self.n2 + self.distinct[y] * root[s]) / np.maximum(self.seen[y] + self.distinct[y], 1), root[s])
        c, p = self.triple_context, self.triple_pair
        triples = np.where(distinct[c] > 0, (self.n3 + distinct[c] * pairs[p]) / np.maximum(self.n2[self.two[c]] + distinct[c], 1), pairs[p])
        out = np.log10(pairs)[self.pair]
        out[self.at] = np.log10(triples)[self.triple]
        firsts = np.cumsum(np.r_[0, self.sizes[:-1]])
        add = lambda x: np.add.reduceat(x, firsts)
        return add((self.n1 > 0)[self.sym].astype(np.int64)), add(np.log10(root)[self.sym]), add(out)


def _summed(asked: pa.Table, divergence: float) -> pa.Table:
    """What the chunks hold of each key, added up, in the order in which each chunk asked.

    After contexts the answer is the number of distinct symbols, 0 for a context that is not retained.
    """
    asked = asked.sort_by("chunk")  # sums of fractions shouldn't depend on the order of arrival
    keys = [_unpacked(x.as_buffer(), np.uint64) for x in asked["keys"]]
    kind = asked["kind"][0].as_py()
    found, at = np.unique(np.concatenate(keys), return_inverse=True)
    vals, n = [x.as_py() for x in asked["vals"]], len(keys)
    total = lambda parts: np.bincount(at, weights=np.concatenate([_unpacked(x, _sent(kind)) for x in parts]), minlength=len(found))
    if kind in (AFTER_ONE, AFTER_TWO):
        distinct, gain = np.rint(total([v[: len(v) // 2] for v in vals])), total([v[len(v) // 2 :] for v in vals])
        sums = np.where(gain >= divergence * distinct, distinct, 0).astype(np.int64)
    else:
        sums = total(vals).astype(np.int64)
    cuts = np.cumsum([0, *map(len, keys)])
    reply = sums[at]
    return pa.table({
        "chunk": asked["chunk"], "kind": asked["kind"], "bucket": asked["bucket"],
        "sums": pa.array([_packed(reply[a:b]) for a, b in zip(cuts, cuts[1:])], pa.binary()),
        "known": pa.array([int((sums > 0).sum()), *[0] * (n - 1)], pa.int64()), "total": pa.array([int(sums.sum()), *[0] * (n - 1)], pa.int64()),
    })


def _by_chunk(rows: DataFrame, replies: list[DataFrame], fn: Callable[[pa.Table], pa.Table], schema: T.StructType | str) -> DataFrame:
    """``fn`` over each chunk's rows and the replies to it."""
    for r in replies:
        rows = rows.unionByName(r.select("chunk", "kind", "bucket", "sums"), allowMissingColumns=True)
    if not replies:
        rows = rows.select("*", F.lit(None).cast("int").alias("kind"), F.lit(None).cast("int").alias("bucket"), F.lit(None).cast("binary").alias("sums"))
    return rows.groupBy("chunk").applyInArrow(fn, schema)


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, divergence: float = DIVERGENCE) -> DataFrame:
    """Per row: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``."""
    if least < 1:
        raise ValueError("a context must be seen at least once")
    scratch = Scratch(docs.sparkSession)
    d = picked(docs, id=id_col, text=text_col).withColumn("held", held_out(F.col("id")))
    id_type = d.schema["id"].dataType
    rows = scratch.write(_read_chunks(d), "chunks")
    tokens = rows.agg(F.coalesce(F.sum(F.length("seq")), F.lit(0))).collect()[0][0] // 4
    buckets = max(32, partitions_for(tokens, ENTRIES))

    def asks(step: Callable[[Chunk], list[tuple]]) -> Callable[[pa.Table], pa.Table]:
        def run(group: pa.Table) -> pa.Table:
            out = step(Chunk(group, buckets))
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            return pa.table([pa.array(x, k) for x, k in zip(zip(*out) if out else [[]] * 5, kinds)], names=["chunk", "kind", "bucket", "keys", "vals"])

        return run

    def answered(replies: list[DataFrame], step: Callable[[Chunk], list[tuple]], label: str) -> DataFrame:
        return scratch.write_and_clear(_by_chunk(rows, replies, asks(step), _ASKED).groupBy("kind", "bucket").applyInArrow(lambda asked: _summed(asked, divergence), _REPLY), label)

    counts = answered([], Chunk.counts, "counts")
    known, total = counts.where(F.col("kind") == WORDS).agg(F.coalesce(F.sum("known"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).collect()[0]
    model = {"least": least, "divergence": divergence, "known": known, "total": total}

    def second(c: Chunk) -> list[tuple]:
        c.read_counts(model)
        return c.after_one()

    def third(c: Chunk) -> list[tuple]:
        c.read_counts(model)
        c.read_after_one()
        return c.after_two()

    one = answered([counts], second, "after-one")
    two = answered([counts, one], third, "after-two")

    def scored(group: pa.Table) -> pa.Table:
        c = Chunk(group, buckets)
        c.read_counts(model)
        c.read_after_one()
        n_known, base, score = c.scores()
        return pa.table({
            id_col: c.texts["id"], "held_out": c.texts["held"], "n_tokens": pa.array(c.sizes, pa.int64()), "n_known": pa.array(n_known, pa.int64()),
            "train_tokens": pa.array([int(total)] * len(c.sizes), pa.int64()), "base_score": pa.array(base, pa.float64()), "score": pa.array(score, pa.float64()),
        })

    fields = [T.StructField(id_col, id_type), *T._parse_datatype_string("held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double").fields]
    return _by_chunk(rows, [counts, one, two], scored, T.StructType(fields))
