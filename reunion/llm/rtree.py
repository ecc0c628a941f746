"""Hard negatives by inner product over STR-packed R-trees.

Components are quantised to ``floor(scale * x)``, so scores are exact integers. Rows are dealt into shards of
bounded bytes, anchors into blocks, and each block meets each shard in one tile. A tile packs its shard
into an R-tree by sort-tile-recursion: rows are sorted by the coordinate of the widest spread and
cut into slabs, each slab by the next coordinate, down to leaves of ``LEAF`` rows; runs of ``FANOUT`` boxes make the
boxes of the level above. A minimum bounding box gives an interval for every product ``q[i] * x[i]``, their sums an
interval for the score. Each search keeps a queue of boxes, best upper bound first: boxes outside the score window
never enter it, and the search ends when the first box is strictly below the k-th score found. The
searches of a tile take their next leaf together, so that a leaf is multiplied once a round for all of them.

Two passes: the positives (first rows of the anchor's label), then for each positive's score the window of its
negatives. What tiles find is merged by (score, smaller id); the bounds make the answer exact.

Copies: of equal vectors with one label only as many smallest ids as a search can return, and one more for the anchor
itself, can be among the first, so larger ids go before the tiles; a vector that a third of all rows share is few rows.

Results for odd input: rows with a null id or label, or whose vector is null, empty or holds null or non-finite
components, take no part; vectors of different lengths are never compared; a row repeated with the same id, label and
vector counts once, rows of one id never pair with each other; an anchor without positives, and a positive without
negatives in its window, give no row; scores that 64 bits can't hold raise an error; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, partitions_for, picked

LEAF = 128
FANOUT = 8
#: Bytes of the vectors of a shard, and of a block of anchors.
SHARD_BYTES = 32 << 20
BLOCK_BYTES = 8 << 20
#: Searches that run together, which bounds the matrix of box bounds.
STRIP = 512
#: Scores below this are exact in double precision, also when multiplied by a percentage.
EXACT = 2**53 // 100

_FOUND = "akey long, top long, id long, score long"


def usable(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``(id, label, vec, dim)``: rows that take part, each once."""
    d = picked(df, id=id_col, vec=vector_col, label=label_col)
    d = d.select(F.col("id").cast("long").alias("id"), F.col("label").cast("string").alias("label"), F.col("vec").cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    d = d.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0)).where(finite)
    return d.select("id", "label", F.transform("vec", lambda x: x + F.lit(0.0)).alias("vec"), F.size("vec").alias("dim")).dropDuplicates(["id", "label", "vec"])


def quantised(column: pa.ChunkedArray, dim: int, scale: float) -> np.ndarray:
    """Rows of ``floor(scale * x)`` as whole doubles."""
    flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]).reshape(-1, dim)
    with np.errstate(over="ignore"):
        out = np.floor(scale * flat)
    if not np.isfinite(out).all():
        raise OverflowError("a component is too large")
    return out


def exact_kind(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both sides as doubles if their products are exact so, else as Python integers."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < EXACT:
        return a, b
    whole = np.frompyfunc(int, 1, 1)
    return whole(a), whole(b)


class PackedTree:
    """An R-tree of rows packed by sort-tile-recursion.

    ``order`` are the rows by leaf; node ``k`` holds nodes ``child[k] : child[k + 1]``, leaves come first and the root last.
    """

    def __init__(self, m: np.ndarray, leaf: int = LEAF, fanout: int = FANOUT):
        n, dim = m.shape
        leaves = -(-n // leaf)
        spread = np.argsort(-m.astype(float).std(axis=0), kind="stable")
        deep = max(1, min(dim, int(np.log2(max(leaves, 2)))))
        parts: list[np.ndarray] = []

        def cut(rows: np.ndarray, level: int) -> None:
            if len(rows) <= leaf:
                parts.append(rows)
                return
            rows = rows[np.argsort(m[rows, spread[level]], kind="stable")]
            if level == deep - 1:
                parts.extend(rows[s : s + leaf] for s in range(0, len(rows), leaf))
                return
            pages = -(-len(rows) // leaf)
            slabs = max(2, int(np.ceil(pages ** (1.0 / (deep - level)))))
            size = -(-pages // slabs) * leaf  # whole leaves a slab
            for s in range(0, len(rows), size):
                cut(rows[s : s + size], level + 1)

        cut(np.arange(n), 0)
        self.order = np.concatenate(parts)
        self.cuts = np.cumsum([0, *map(len, parts)])
        rows = m[self.order]
        low, high = np.minimum.reduceat(rows, self.cuts[:-1]), np.maximum.reduceat(rows, self.cuts[:-1])
        self.leaves = len(parts)
        lows, highs, first, children = [low], [high], 0, [np.zeros((self.leaves, 2), np.int64)]
        while len(low) > 1:  # a level of boxes over runs of boxes
            at = np.arange(0, len(low), fanout)
            children.append(np.c_[at, np.minimum(at + fanout, len(low))] + first)
            first += len(low)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            lows.append(low)
            highs.append(high)
        self.low, self.high, self.child = np.concatenate(lows), np.concatenate(highs), np.concatenate(children)

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest inner product of each row of ``q`` with any point of each box."""
        plus, minus = np.maximum(q, 0), np.minimum(q, 0)
        return plus @ self.low.T + minus @ self.high.T, plus @ self.high.T + minus @ self.low.T


def search(tree: PackedTree, rows: np.ndarray, ids: np.ndarray, codes: np.ndarray, q: np.ndarray, qid: np.ndarray, qcode: np.ndarray, same: bool, low: np.ndarray, high: np.ndarray, k: int) -> list[list[tuple]]:
    """Per search its k best ``(score, -id)`` among rows of the same label (or of others), other ids, and scores in its window.

    ``rows``, ``ids`` and ``codes`` are in the tree's order.
    """
    least, most = tree.bounds(q)
    fits = (most >= low[:, None]) & (least <= high[:, None])
    root = len(tree.child) - 1
    queues = [[(-most[i, root], root)] if fits[i, root] else [] for i in range(len(q))]
    found: list[list[tuple]] = [[] for _ in queues]
    live = [i for i, x in enumerate(queues) if x]
    while live:
        taken: dict[int, list[int]] = {}
        still = []
        for i in live:  # each search takes its best leaf
            queue, best = queues[i], found[i]
            floor = best[0][0] if len(best) == k else None
            while queue:
                bound, node = heapq.heappop(queue)
                if floor is not None and -bound < floor:
                    queue.clear()
                elif node < tree.leaves:
                    taken.setdefault(node, []).append(i)
                    still.append(i)
                    break
                else:
                    a, b = tree.child[node].tolist()
                    for c in range(a, b):
                        if fits[i, c] and (floor is None or most[i, c] >= floor):
                            heapq.heappush(queue, (-most[i, c], c))
        for leaf, searches in taken.items():
            at = slice(tree.cuts[leaf], tree.cuts[leaf + 1])
            who = np.array(searches)
            score = q[who] @ rows[at].T
            good = (codes[at][None, :] == qcode[who, None]) == same
            good &= (ids[at][None, :] != qid[who, None]) & (score >= low[who, None]) & (score <= high[who, None])
            floors = np.array([found[i][0][0] if len(found[i]) == k else -np.inf for i in searches])
            x, y = np.nonzero(good & (score >= floors[:, None]))
            for i, s, v in zip(who[x].tolist(), score[x, y].tolist(), (-ids[at][y]).tolist()):
                best = found[i]
                if len(best) < k:
                    heapq.heappush(best, (s, v))
                elif (s, v) > best[0]:
                    heapq.heapreplace(best, (s, v))
        live = [i for i in still if queues[i]]
    return found


def tile_search(anchors: pa.Table, shard: pa.Table, k: int, scale: float, percent: int, leaf: int, fanout: int) -> pa.Table:
    """What one shard has for one block: per anchor its best rows of the same label, or for each score in ``tops`` the best of other labels in its window."""
    out: list[tuple[int, int | None, int, int]] = []
    if anchors.num_rows and shard.num_rows:
        dim = anchors["dim"][0].as_py()
        q, m = exact_kind(quantised(anchors["vec"], dim, scale), quantised(shard["vec"], dim, scale))
        _, codes = np.unique(anchors["label"].to_pylist() + shard["label"].to_pylist(), return_inverse=True)
        tree = PackedTree(m, leaf, fanout)
        rows, ids, theirs = m[tree.order], shard["id"].to_numpy()[tree.order], codes[anchors.num_rows :][tree.order]
        tops = anchors["tops"].to_pylist()
        probes = [(i, t) for i, each in enumerate(tops) for t in ([None] if each is None else each)]
        key, aid = anchors["akey"].to_pylist(), anchors["id"].to_numpy()
        for s in range(0, len(probes), STRIP):
            part = probes[s : s + STRIP]
            at = np.array([i for i, _ in part])
            same = part[0][1] is None
            if same:
                low, high = np.full(len(part), -np.inf), np.full(len(part), np.inf)
            else:  # percent * top <= 100 * score <= 100 * top, in whole numbers
                low, high = (np.array(x, m.dtype) for x in ([-(-percent * t // 100) for _, t in part], [t for _, t in part]))
            for (i, t), best in zip(part, search(tree, rows, ids, theirs, q[at], aid[at], codes[at], same, low, high, k)):
                out += [(key[i], t, -v, int(score)) for score, v in best]
    a, t, v, s = zip(*out) if out else ((), (), (), ())
    return pa.table({"akey": pa.array(a, pa.int64()), "top": pa.array(t, pa.int64()), "id": pa.array(v, pa.int64()), "score": pa.array(s, pa.int64())})


def hard_negatives(
    anchors: DataFrame,
    rows: DataFrame,
    positives: int = 5,
    negatives: int = 5,
    percent: int = 80,
    scale: float = 256.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    shard_bytes: int = SHARD_BYTES,
    leaf: int = LEAF,
    fanout: int = FANOUT,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Positives are an anchor's first ``positives`` rows of its label. Negatives are the first rows of other labels with
    ``percent * positive_score <= 100 * negative_score <= 100 * positive_score``.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark)
    copies = Window.partitionBy("label", "vec").orderBy("id")
    most = max(positives, negatives) + 1
    c = usable(rows, id_col, vector_col, label_col).withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= most).drop("copy")
    c = scratch.write(c, "rtree-rows")
    a = usable(anchors, id_col, vector_col, label_col).withColumn("akey", F.xxhash64("id", "label", "vec"))
    a = scratch.write(a, "rtree-anchors")
    n_a = a.count()
    cells = c.agg(F.coalesce(F.sum(F.col("dim").cast("long")), F.lit(0))).first()[0]
    cols = partitions_for(cells * 8, shard_bytes)
    widest = a.agg(F.coalesce(F.max("dim"), F.lit(1))).first()[0]
    blocks = max(partitions_for(n_a * widest * 8, BLOCK_BYTES), min(n_a // 64, spark.sparkContext.defaultParallelism // cols), 1)
    deal = lambda n, seed, key: F.pmod(F.xxhash64(F.lit(seed), key), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def found(asked: DataFrame, k: int) -> DataFrame:
        left = asked.withColumn("r", deal(blocks, 1, "akey")).withColumn("c", every(cols))
        right = c.withColumn("c", deal(cols, 2, "id")).withColumn("r", every(blocks))

        def tile(x: pa.Table, y: pa.Table) -> pa.Table:
            return tile_search(x, y, k, scale, percent, leaf, fanout)

        hits = left.groupBy("dim", "r", "c").cogroup(right.groupBy("dim", "r", "c")).applyInArrow(tile, _FOUND)
        best = Window.partitionBy("akey", "top").orderBy(F.desc("score"), "id")
        return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    pos = found(a.withColumn("tops", F.lit(None).cast("array<long>")), positives).select("akey", F.col("id").alias("positive_id"), F.col("score").alias("top"))
    pos = scratch.write(pos, "rtree-positives")
    tops = pos.groupBy("akey").agg(F.collect_set("top").alias("tops"))  # at most `positives` scores
    neg = found(a.join(tops, "akey"), negatives).select("akey", "top", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return (
        pos.join(neg, ["akey", "top"])
        .join(a.select("akey", F.col("id").alias("anchor_id")), "akey")
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", F.col("top").alias("positive_score"), "negative_score")
    )
