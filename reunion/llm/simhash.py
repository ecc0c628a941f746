"""SimHash fingerprints of word shingles, and exact near-duplicate groups by vantage-point trees.

Fingerprints: 64 bits over all shingles, repeats included; a bit is set when it is set in
over half of the shingles' XXH64 hashes (seed 42).

Search: two fingerprints within ``radius`` bits of 64 agree to ``radius // BLOCKS`` bits in one
of ``BLOCKS`` bit blocks (pigeonhole). Each block has a vantage-point tree over the Hamming
distance of that block, whose small radius lets triangle bounds prune. The top of a tree is
built from a bounded sample, is sent to all tasks and cuts the fingerprints into shards: at
a node with vantage point v and threshold t, d(x, v) <= t goes left, else right. Every
fingerprint has one home shard and also visits each shard that its ball overlaps, that is
where d(x, v) lies within the radius of t. A shard grows a tree of its own over its
members, queries it with members and visitors and compares the found pairs in all 64 bits, so
all links are found and none is approximate. Where a block cannot cut any more (many
fingerprints equal in it) the tree goes on with the distance in all 64 bits, so a dense group of near
copies spreads over many shards too.

A shard answers with a spanning forest of its links, never with all pairs of a group. The
forests are joined by connected components over distinct fingerprints; copies of one
fingerprint are one node.

Results for odd input: a null text counts as empty and has fingerprint zero, which links like any other;
rows with a null id keep their row and get the class of their fingerprint, but no class is named
after them (null if a class has no other id); repeated rows each keep their row; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.components import connected_components
from .common import Scratch, map_batches, picked, utf8

SHINGLE = 4
MAX_BITS = 4
BLOCKS = 3
SEED = 42
#: Fingerprints that the top of the trees is fitted on, at most; every fingerprint is indexed.
SAMPLE = 20_000
#: Fingerprints of a shard that the number of shards is chosen for.
SHARD = 8_000
#: Found pairs of a shard that are joined at a time.
PAIRS = 1 << 20
#: Members of a leaf of a shard's own tree.
LEAF = 64


# --- fingerprints -----------------------------------------------------------------


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a text; A-Z are lowered, words are cut at ASCII white space."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    else:
        flat = b" ".join(words)
        ends = list(accumulate(map(len, words), lambda at, n: at + 1 + n))
        starts = [0, *[e + 1 for e in ends]]
        h = xxhash.xxh64_intdigest
        hashes = np.array([h(flat[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :])], np.uint64)
    ones = np.zeros(64, np.int64)
    for s in range(0, len(hashes), 65536):
        part = hashes[s : s + 65536]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = ones * 2 > len(hashes)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(id, fp)``: the fingerprint's 64 bits as a signed long."""
    d = picked(docs, id=id_col, text=text_col)
    schema = T.StructType([T.StructField("id", d.schema["id"].dataType), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in utf8(b.column("text"))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(fps, pa.int64())], ["id", "fp"])

    return map_batches(d, run, schema)


# --- vantage-point trees ------------------------------------------------------------


def block_masks(blocks: int = BLOCKS) -> list[int]:
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]


FULL = (1 << 64) - 1


class Tree:
    """A vantage-point tree as flat arrays: node -> (mask, vantage, threshold, radius, left, right); a leaf has left = -1 - number."""

    def __init__(self) -> None:
        self.mask: list[int] = []
        self.vantage: list[int] = []
        self.threshold: list[int] = []
        self.radius: list[int] = []
        self.left: list[int] = []
        self.right: list[int] = []
        self.leaves = 0

    def _node(self, mask: int, vantage: int, threshold: int, radius: int) -> int:
        for a, x in zip((self.mask, self.vantage, self.threshold, self.radius, self.left, self.right), (mask, vantage, threshold, radius, 0, 0)):
            a.append(x)
        return len(self.mask) - 1

    def _leaf(self) -> int:
        self.leaves += 1
        return -self.leaves

    @classmethod
    def grow(cls, fps: np.ndarray, mask: int, radius: int, full_radius: int, leaf: int, seed: int = 1) -> Tree:
        """Split at the median distance to the vantage point that spreads the members most, down to ``leaf`` members."""
        tree, rng = cls(), np.random.default_rng(seed)

        def best(part: np.ndarray, m: int) -> tuple[int, int, float]:
            found = (0, 0, 0.0)
            some = part if len(part) <= 512 else part[rng.integers(0, len(part), 512)]
            for v in some[rng.integers(0, len(some), 6)]:
                d = np.bitwise_count((some ^ v) & np.uint64(m))
                t = int(np.median(d))
                for cut in (t - 1, t):
                    low = float((d <= cut).mean())
                    gain = min(low, 1 - low)
                    if gain > found[2]:
                        found = (int(v), cut, gain)
            return found

        def build(part: np.ndarray) -> int:
            if len(part) <= leaf:
                return tree._leaf()
            for m, r in ((mask, radius), (FULL, full_radius)):
                v, t, gain = best(part, m)
                if gain >= 0.1:
                    node = tree._node(m, v, t, r)
                    near = np.bitwise_count((part ^ np.uint64(v)) & np.uint64(m)) <= t
                    tree.left[node] = build(part[near])
                    tree.right[node] = build(part[~near])
                    return node
            return tree._leaf()

        tree.root = build(fps)
        return tree

    def route(self, fps: np.ndarray, visits: bool) -> tuple[np.ndarray, np.ndarray]:
        """``(index, leaf)``: the home leaf of each fingerprint, or with ``visits`` every leaf that its ball overlaps."""
        index, leaf = [], []
        stack = [(self.root, np.arange(len(fps)))]
        while stack:
            node, at = stack.pop()
            if not len(at):
                continue
            if node < 0:
                index.append(at)
                leaf.append(np.full(len(at), -1 - node, np.int64))
                continue
            d = np.bitwise_count((fps[at] ^ np.uint64(self.vantage[node])) & np.uint64(self.mask[node])).astype(np.int64)
            r = self.radius[node] if visits else 0
            # d(x, v) - r <= t: something within r of x can lie left; d(x, v) + r > t: right
            stack.append((self.left[node], at[d - r <= self.threshold[node]]))
            stack.append((self.right[node], at[d + r > self.threshold[node]]))
        if not index:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(index), np.concatenate(leaf)


def _merge(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union the pairs (a, b) in the parent array, whole arrays at a time; every entry points at its root afterwards."""
    while len(a):
        ra, rb = parent[a], parent[b]
        open_ = ra != rb
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent[:] = up


def shard_forest(home: np.ndarray, visitors: np.ndarray, mask: int, radius: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of all links between members, and between visitors and members, of a shard."""
    every = np.concatenate([home, visitors])
    parent = np.arange(len(every))
    tree = Tree.grow(home, mask, radius, max_bits, LEAF)
    at_home, leaf_home = tree.route(home, False)
    order = np.argsort(leaf_home, kind="stable")
    at_home, leaf_home = at_home[order], leaf_home[order]
    bounds = np.searchsorted(leaf_home, np.arange(tree.leaves + 1))
    q_at, q_leaf = tree.route(every, True)
    order = np.argsort(q_leaf, kind="stable")
    q_at, q_leaf = q_at[order], q_leaf[order]
    q_bounds = np.searchsorted(q_leaf, np.arange(tree.leaves + 1))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    waiting = 0
    for k in range(tree.leaves):
        members, queries = at_home[bounds[k] : bounds[k + 1]], q_at[q_bounds[k] : q_bounds[k + 1]]
        if not len(members):
            continue
        step = max(1, (1 << 20) // len(members))  # bounds the comparison's memory
        for s in range(0, len(queries), step):
            qs = queries[s : s + step]
            i, j = np.nonzero(np.bitwise_count(every[qs][:, None] ^ every[members][None, :]) <= max_bits)
            a, b = qs[i], members[j]
            # a member is met by itself and by the other member again; one way is enough
            keep = a > b
            found.append((a[keep], b[keep]))
            waiting += len(found[-1][0])
            if waiting > PAIRS:
                _merge(parent, *map(np.concatenate, zip(*found)))
                found, waiting = [], 0
    if found:
        _merge(parent, *map(np.concatenate, zip(*found)))
    linked = np.flatnonzero(parent != np.arange(len(every)))
    return every[linked], every[parent[linked]]


def links(fps: DataFrame, n: int, max_bits: int = MAX_BITS, blocks: int = BLOCKS, sample: int = SAMPLE, shard: int = SHARD) -> DataFrame:
    """``(a, b)``: spanning links of distinct fingerprints ``fp`` (n of them) at ``max_bits`` or fewer differing bits."""
    spark = fps.sparkSession
    radius = max_bits // blocks
    share = min(1.0, 2 * sample / max(n, 1))
    picked_fps = fps.where(F.pmod(F.xxhash64(F.lit(7), "fp"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).limit(sample)
    some = np.array([r["fp"] for r in picked_fps.collect()], np.int64).view(np.uint64)
    some.sort()
    per_leaf = max(8, int(len(some) * shard / max(n, 1)))
    masks = block_masks(blocks)
    trees = [(m, Tree.grow(some, m, radius, max_bits, per_leaf)) for m in masks]
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(trees))  # bounded by the sample

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = cloudpickle.loads(shared.value)
        for b in batches:
            x = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for k, (_, tree) in enumerate(own):
                home = np.empty(len(x), np.int64)
                at, leaf = tree.route(x, False)
                home[at] = leaf
                at, leaf = tree.route(x, True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), k, np.int32)), pa.array(leaf.astype(np.int32)), pa.array(home[at] == leaf), pa.array(x[at].view(np.int64))],
                    ["block", "shard", "home", "fp"],
                )

    dealt = fps.select("fp").mapInArrow(deal, "block int, shard int, home boolean, fp long")

    def search(key: tuple, rows: pa.Table) -> pa.Table:
        block = key[0].as_py()
        home = rows["home"].to_numpy()
        x = rows["fp"].to_numpy().view(np.uint64)
        mask = masks[block]
        a, b = shard_forest(np.sort(x[home]), np.sort(x[~home]), mask, radius, max_bits)
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    return dealt.groupBy("block", "shard").applyInArrow(search, "a long, b long")


def classes(docs: DataFrame, scratch: Scratch, id_col: str, text_col: str, shingle: int, max_bits: int, blocks: int) -> tuple[DataFrame, DataFrame]:
    """``(id, fp)`` per row of ``docs``, and ``(fp, class, name)``: the class of each distinct fingerprint and its smallest id."""
    fps = scratch.write(fingerprints(docs, id_col, text_col, shingle), "fps")
    nodes = scratch.write(fps.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    edges = scratch.write(links(nodes, nodes.count(), max_bits, blocks), "links")
    roots = connected_components(edges, "a", "b")
    placed = scratch.write(nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("class")), "roots")
    names = placed.groupBy("class").agg(F.min("least").alias("name"))
    return fps, scratch.write(placed.join(names, "class").select("fp", "class", "name"), "classes")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """Per row: id, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id of its class."""
    fps, named = classes(docs, Scratch(docs.sparkSession), id_col, text_col, shingle, max_bits, blocks)
    out = fps.join(named.withColumnRenamed("fp", "fp_"), F.col("fp") == F.col("fp_"))
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("name").alias("component_id"))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """One row of ``docs`` for each class: that of the smallest id (null ids last); columns stay as they are.

    Of rows that repeat an id and a fingerprint one is kept.
    """
    scratch = Scratch(docs.sparkSession)
    cols = list(docs.columns)
    d = docs.toDF(*[f"_c{i}" for i in range(len(cols))])
    key, text = f"_c{cols.index(id_col)}", f"_c{cols.index(text_col)}"
    d = d.withColumn("_h", F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.length(F.coalesce(F.col(text), F.lit("")))))
    # the fingerprint is found again by id and text hash
    rows = picked(d, id=key, text=text, h="_h")
    fps, named = classes(rows.withColumn("id", F.struct("id", "h")), scratch, "id", "text", shingle, max_bits, blocks)
    # min of (null?, id, h): the least struct has a null id first, so nulls are put last explicitly
    flat = fps.select(F.col("id.id").alias("id"), F.col("id.h").alias("h"), "fp").join(named.select(F.col("fp").alias("fp_"), "class"), F.col("fp") == F.col("fp_"))
    first = flat.groupBy("class").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h")).alias("w")).select(F.col("w.id").alias("_id"), F.col("w.h").alias("_wh"))
    first = scratch.write(first, "kept")
    kept = d.join(first, d[key].eqNullSafe(first["_id"]) & (d["_h"] == first["_wh"]), "left_semi")
    if not flat.groupBy("id", "h").count().where("count > 1").isEmpty():  # repeated rows
        kept = kept.dropDuplicates([key, "_h"])
    return kept.select(*[f"_c{i}" for i in range(len(cols))]).toDF(*cols)
