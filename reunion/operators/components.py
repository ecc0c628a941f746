"""Connected components of the match graph, as DataFrame rounds.

Alternating large-star and small-star (Kiveris, Lattanzi, Mirrokni, Rastogi, Vassilvitskii:
"Connected Components in MapReduce and Beyond", SoCC 2014), with a contraction before each round:
the edges are dealt into partitions of bounded size by a hash of both ends, and each
partition replaces its edges by the stars of their components. A task contracts several small partitions one after
the other. Edges that fit one partition are done with that.

A round writes its two tables of least neighbours (one row per node) and joins the edges with them.
Both sides of these joins are plain shuffles of written tables, so AQE splits the partition of a
hub node (an aggregate between shuffle and join would prevent that); the aggregates combine
map-side. The loop ends by itself: when a round leaves the edge set as it was (compared by count and
checksum, observed while it is written), the edges are stars centred on each component's
smallest node. Superseded tables are deleted.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import release, write_table

# The contraction runs in Python workers, which need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Edges that one partition contracts.
PARTITION_EDGES = 250_000


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(node, root)`` of the nodes of the edges that are not their component's smallest."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    parent = np.arange(len(nodes))
    while len(x):
        rx, ry = parent[x], parent[y]
        open_ = rx != ry
        x, y, rx, ry = x[open_], y[open_], rx[open_], ry[open_]
        np.minimum.at(parent, np.maximum(rx, ry), np.minimum(rx, ry))
        while not np.array_equal(up := parent[parent], parent):
            parent = up
    child = np.flatnonzero(parent != np.arange(len(nodes)))
    return nodes[child], nodes[parent[child]]


def contracted(edges: DataFrame, count: int, partition_edges: int = PARTITION_EDGES) -> DataFrame:
    """Edges ``(a, b)`` with a > b (long): each partition's edges replaced by the stars of their components."""

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)] for batch in batches]
        if parts:
            a, b, deal = (np.concatenate(p) for p in zip(*parts))
            order = np.argsort(deal, kind="stable")
            a, b, deal = a[order], b[order], deal[order]
            # the partitions dealt to this task, one after the other
            ends = [*np.flatnonzero(deal[1:] != deal[:-1]) + 1, len(deal)]
            found = [_stars(a[s:e], b[s:e]) for s, e in zip([0, *ends], ends) if e > s]
            x, y = (np.concatenate(f) for f in zip(*found)) if found else (a, b)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["a", "b"])

    n = max(1, -(-count // partition_edges))
    dealt = edges.selectExpr("a", "b", f"pmod(xxhash64(a, b), {n}L) AS deal")
    tasks = min(n, max(int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-count // PARTITION_EDGES)))
    return dealt.repartition(tasks, "deal").mapInArrow(contract, "a long, b long")


def _neighbours(e: DataFrame) -> DataFrame:
    return e.selectExpr("a AS u", "b AS v").unionByName(e.selectExpr("b AS u", "a AS v"))


def large_star(e: DataFrame, low: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour (or itself); ``low`` is ``(n, m)``."""
    return _neighbours(e).join(low, F.col("u") == F.col("n")).where("v > u").selectExpr("v AS a", "m AS b")


def small_star(e: DataFrame, low: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the least of them; ``low`` is ``(n, m)``."""
    moved = e.join(low, F.col("a") == F.col("n")).where("b <> m").selectExpr("b AS a", "m AS b")
    return moved.unionByName(low.selectExpr("n AS a", "m AS b")).distinct()


def star_round(e: DataFrame) -> tuple[DataFrame, list[str]]:
    """One large-star and one small-star over written tables; returns the edges and the folders they read."""
    low, f1 = write_table(_neighbours(e).groupBy("u").agg(F.min("v").alias("m")).selectExpr("u AS n", "least(u, m) AS m"), "cc-low")
    large, f2 = write_table(large_star(e, low).distinct(), "cc-large")
    low2, f3 = write_table(large.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a AS n", "m"), "cc-low")
    return small_star(large, low2), [f1, f2, f3]


def connected_components(
    edges: DataFrame, src: str = "uid_l", dst: str = "uid_r", *, partition_edges: int = PARTITION_EDGES, count: int | None = None
) -> DataFrame:
    """``(node, root)`` for every node on an edge; root = the smallest node of its component.

    Nodes that are on no edge are not listed: they are their own component. ``count`` is the number of edges of a
    table that is already written; without it the edges are written first.
    """
    ends = edges.select(F.least(src, dst).alias("b"), F.greatest(src, dst).alias("a")).where("a <> b")
    if dict(ends.dtypes)["a"] in ("tinyint", "smallint", "int", "bigint"):
        kind = dict(ends.dtypes)["a"]
        names, folder = None, None
        e = ends.selectExpr("CAST(a AS BIGINT) AS a", "CAST(b AS BIGINT) AS b")
    else:
        # other orderable ids: number the nodes in their order first
        from .clusters import dense_ids

        raw, folder = write_table(ends, "cc-ends")
        names = dense_ids(raw.selectExpr("a AS k").unionByName(raw.selectExpr("b AS k")), "k", "i").selectExpr("k", "CAST(i AS BIGINT) AS i")
        e = raw.join(names.selectExpr("k AS a", "i AS ia"), "a").join(names.selectExpr("k AS b", "i AS ib"), "b").selectExpr("ia AS a", "ib AS b")
    stars = _star_forest(e, partition_edges, None if names is not None else count)
    found = stars.selectExpr("a AS node", "b AS root").unionByName(stars.selectExpr("b AS node", "b AS root").distinct())
    if names is not None:
        by = names.selectExpr("k AS kn", "i AS node"), names.selectExpr("k AS kr", "i AS root")
        return found.join(by[0], "node").join(by[1], "root").selectExpr("kn AS node", "kr AS root")
    return found.selectExpr(f"CAST(node AS {kind}) AS node", f"CAST(root AS {kind}) AS root")


def _star_forest(e: DataFrame, partition_edges: int, count: int | None) -> DataFrame:
    folders: list[str] = []
    if count is None:
        seen = Observation()
        e, folder = write_table(e.observe(seen, F.count(F.lit(1)).alias("n")), "cc-edges")
        count, folders = int(seen.get["n"]), [folder]
    state = None
    while True:
        # n and sum identify the edge set from round to round
        seen = Observation()
        single = count <= partition_edges
        nxt = contracted(e, count, partition_edges)
        nxt = nxt if single else nxt.distinct()  # partitions may find the same star
        nxt, new = write_table(nxt.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.expr("cast(xxhash64(a, b) AS decimal(38, 0))")).alias("h")), "cc-edges")
        release(e.sparkSession, folders)
        e, folders = nxt, [new]
        now = (int(seen.get["n"]), seen.get["h"])
        if single or now == state:
            return e
        count, state = now[0], now
        e, read = star_round(e)
        folders += read


def extend_components(kept: DataFrame, links: DataFrame, src: str = "uid_l", dst: str = "uid_r", *, partition_edges: int = PARTITION_EDGES) -> DataFrame:
    """``(node, root)`` of kept components after new links: what ``connected_components`` of all links would give.

    ``kept`` lists every node that was ever on a link, with the smallest node of its component. New links are moved to the roots
    of their ends, and only these are connected: the old links are not read again, and a batch costs what it brings plus
    one pass over the kept nodes.
    """
    by = kept.select("node", "root")
    ends = links.select(F.col(src).alias("x"), F.col(dst).alias("y"))
    ends = ends.join(by.selectExpr("node AS x", "root AS rx"), "x", "left").join(by.selectExpr("node AS y", "root AS ry"), "y", "left")
    moved = ends.selectExpr("coalesce(rx, x) AS uid_l", "coalesce(ry, y) AS uid_r")
    merged, _ = write_table(connected_components(moved, partition_edges=partition_edges), "cc-merged")
    old = by.join(merged.selectExpr("node AS root", "root AS top"), "root", "left").selectExpr("node", "coalesce(top, root) AS root")
    return old.unionByName(merged.join(by.select("node"), "node", "left_anti").select("node", "root"))
