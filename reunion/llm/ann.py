"""Nearest neighbours by inner product as a block matrix join.

Queries and candidates are dealt into blocks by a hash of their id; a tile is one query
block against one candidate block, and tiles are joined by their block numbers. In a tile
both sides are quantised to int8 and multiplied; the product plus a bound on the
quantisation error brackets every inner product. A pair survives when its upper bound
reaches the k-th largest lower bound of its query. Survivors are recomputed in double
precision from the original vectors, kept in a heap per query, and the heaps of all tiles
are merged. The bound makes the answer exact; nothing is dropped that could belong to it.

Copies: of equal vectors only the k + 1 smallest ids can be among k nearest with ties to the
smaller id (one of them may be the query), so larger ids go before the tiles; that is exact
and keeps a vector that a third of all rows share from flooding them.

Results for odd input: vectors that are null, empty, zero or hold null or non-finite
components take no part, nor do rows with a null id; vectors of different lengths are never
compared; a row repeated with the same id and vector counts once; a query with no candidate
gives no row; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions_for, picked

QUERY_BLOCK = 4096
CANDIDATE_BLOCK = 4096
#: Queries multiplied at a time inside a tile, which bounds the product's memory.
STRIP = 256

_OUT = "query_id long, vec_id long, score double"


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, vec, dim)``: rows that take part, each once."""
    d = picked(df, id=id_col, vec=vector_col).select(F.col("id").cast("long").alias("id"), F.col("vec").cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    d = d.where(F.col("id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0)).where(finite & F.exists("vec", lambda x: x != 0.0))
    return d.select("id", F.transform("vec", lambda x: x + F.lit(0.0)).alias("vec"), F.size("vec").alias("dim"))


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.flatten() if isinstance(flat, pa.ListArray) else pa.concat_arrays([c.flatten() for c in flat.chunks])
    return flat.to_numpy(zero_copy_only=False).reshape(-1, dim)


def quantise(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales, and the norms of the quantised row and of what rounding lost."""
    scale = np.abs(m).max(axis=1) / 127.0
    small = scale == 0.0  # the largest component underflows: keep it by a scale of one step
    scale[small] = np.abs(m[small]).max(axis=1)
    with np.errstate(all="ignore"):
        codes = np.clip(np.rint(m / scale[:, None]), -127, 127).astype(np.int8)
    approx = codes * scale[:, None]
    return codes, scale, _norms(approx), _norms(m - approx)


def _norms(m: np.ndarray) -> np.ndarray:
    """Euclidean norms, safe from overflow and underflow, never too small."""
    top = np.abs(m).max(axis=1)
    safe = np.where(top > 0, top, 1.0)
    return top * np.sqrt(((m / safe[:, None]) ** 2).sum(axis=1)) * (1 + 1e-9)


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, added from the first component to the last."""
    return np.cumsum(a * b, axis=1)[:, -1]


def tile_search(qid: np.ndarray, qm: np.ndarray, cid: np.ndarray, cm: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """The k best candidates of this tile for each query, by (score, smaller id)."""
    order = np.argsort(cid, kind="stable")
    cid, cm = cid[order], cm[order]
    qc, qs, qn, qe = quantise(qm)
    cc, cs, cn, ce = quantise(cm)
    # Products of int8 values summed in float32 are exact up to 1,040 components, in float64 beyond.
    kind = np.float32 if cm.shape[1] <= 1040 else np.float64
    cf = cc.astype(kind).T
    out: list[tuple[int, int, float]] = []
    for at in range(0, len(qid), STRIP):
        to = min(at + STRIP, len(qid))
        near = (qc[at:to].astype(kind) @ cf).astype(np.float64) * qs[at:to, None] * cs[None, :]
        # |q.c - q'.c'| <= |q - q'| |c'| + |q'| |c - c'| + |q - q'| |c - c'|, and a little for rounding.
        slack = qe[at:to, None] * (cn + ce)[None, :] + qn[at:to, None] * ce[None, :]
        slack += 1e-9 * (qn + qe)[at:to, None] * (cn + ce)[None, :]
        low = near - slack
        own = qid[at:to, None] == cid[None, :]
        low[own] = -np.inf
        if low.shape[1] > k:
            floor = np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k]
        else:
            floor = np.full(to - at, -np.inf)
        rows, cols = np.nonzero((near + slack >= floor[:, None]) & ~own)
        exact = np.empty(len(rows))
        for s in range(0, len(rows), 1 << 16):  # in pieces: one heap of pairs never holds all vectors twice
            e = slice(s, s + (1 << 16))
            exact[e] = inner(qm[at + rows[e]], cm[cols[e]])
        ends = np.searchsorted(rows, np.arange(to - at + 1))
        for i in range(to - at):
            a, b = ends[i], ends[i + 1]
            heap: list[tuple[float, int]] = []
            for score, vid in zip(exact[a:b].tolist(), (-cid[cols[a:b]]).tolist()):
                if len(heap) < k:
                    heapq.heappush(heap, (score, vid))
                elif (score, vid) > heap[0]:
                    heapq.heapreplace(heap, (score, vid))
            out += [(int(qid[at + i]), -vid, score) for score, vid in heap]
    return out


def nearest(
    queries: DataFrame,
    candidates: DataFrame,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    query_block: int = QUERY_BLOCK,
    candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each query its k nearest rows of ``candidates`` other than itself."""
    qv = usable(queries, id_col, vector_col).dropDuplicates(["id", "vec"])
    copies = Window.partitionBy("vec").orderBy("id")
    cv = usable(candidates, id_col, vector_col).dropDuplicates(["id", "vec"]).withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).drop("copy")
    n_q, n_c = queries.count(), candidates.count()
    rows, cols = partitions_for(n_q, query_block), partitions_for(n_c, candidate_block)
    deal = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(n)).cast("int")
    q = qv.withColumn("r", deal(rows, 1)).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(cols - 1))))
    c = cv.withColumn("c", deal(cols, 2)).withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(rows - 1))))

    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[int, int, float]] = []
        if left.num_rows and right.num_rows:
            dim = left["dim"][0].as_py()
            found = tile_search(left["id"].to_numpy(), _matrix(left["vec"], dim), right["id"].to_numpy(), _matrix(right["vec"], dim), k)
        a, b, s = zip(*found) if found else ((), (), ())
        return pa.table({"query_id": pa.array(a, pa.int64()), "vec_id": pa.array(b, pa.int64()), "score": pa.array(s, pa.float64())})

    heaps = q.groupBy("dim", "r", "c").cogroup(c.groupBy("dim", "r", "c")).applyInArrow(tile, _OUT)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return heaps.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
