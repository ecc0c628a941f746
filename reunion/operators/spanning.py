"""Maximum spanning forest of the match graph: the clusters at every threshold from one linkage.

Edges are ordered strictly, by probability (highest first), then by their ends. The forest of that order is
unique, and its edges at or above a threshold connect exactly what all links at or above it connect.
So a threshold costs one pass over the forest (fewer edges than records), not a linkage of its own.

Boruvka rounds over written tables. A round first deals the edges into partitions of bounded size by a hash of their
ends, and each partition drops those outside the forest of its own edges (they close a cycle of better
ones, so they are outside the whole forest too). Then every component takes its best edge, the taken edges are contracted
and parallel edges fall to the best one: at least half of the components go in a round. Edges that fit one
partition are finished there.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..constants import PROB_COL
from ..session import release, write_table
from .components import PARTITION_EDGES, connected_components

# The forests of partitions are found in Python workers, which need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_INTEGERS = ("tinyint", "smallint", "int", "bigint")


def forest_edges(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Which of the edges, given best first, are in the spanning forest (as a mask)."""
    m = len(u)
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    x, y = ends[:m], ends[m:]
    label, live, keep = np.arange(len(nodes)), np.arange(m), np.zeros(m, bool)
    while True:
        live = live[label[x[live]] != label[y[live]]]
        if not len(live):
            return keep
        best = np.full(len(nodes), m)
        np.minimum.at(best, label[x[live]], live)
        np.minimum.at(best, label[y[live]], live)
        own = np.flatnonzero(best < m)
        taken = best[own]
        keep[taken] = True
        up = np.arange(len(nodes))
        up[own] = label[x[taken]] + label[y[taken]] - own  # the edge's other component
        mutual = own[(up[up[own]] == own) & (own < up[own])]
        up[mutual] = mutual
        while not np.array_equal(higher := up[up], up):
            up = higher
        label = up[label]


def _partition_forests(edges: DataFrame, count: int, partition_edges: int) -> DataFrame:
    """The edges ``(u, v, a, b, p)`` that are in the forest of their partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            t = pa.Table.from_batches(held).combine_chunks()
            u, v, a, b, p = (t.column(i).to_numpy() for i in range(5))
            order = np.lexsort((b, a, -p))
            yield from t.take(pa.array(order[forest_edges(u[order], v[order])])).to_batches()

    n = max(1, -(-count // partition_edges))
    return edges.select("u", "v", "a", "b", "p").repartition(n, "u", "v").mapInArrow(run, "u long, v long, a long, b long, p double")


def _written(df: DataFrame, label: str) -> tuple[DataFrame, str, int]:
    seen = Observation()
    out, folder = write_table(df.observe(seen, F.count(F.lit(1)).alias("n")), label)
    return out, folder, int(seen.get["n"])


def _best_first(df: DataFrame, *by: str) -> DataFrame:
    """The best edge for each value of ``by``, as struct ``e``; aggregates combine map-side."""
    return df.groupBy(*by).agg(F.min(F.struct((-F.col("p")).alias("np"), "a", "b", *[c for c in ("u", "v") if c not in by])).alias("e"))


def _long_forest(edges: DataFrame, partition_edges: int) -> DataFrame:
    """``(a, b, p)`` of the forest of edges ``(a, b, p)`` with long ends, a < b."""
    spark = edges.sparkSession
    once = edges.groupBy("a", "b").agg(F.max("p").alias("p")).selectExpr("a AS u", "b AS v", "a", "b", "p")
    e, folder, count = _written(once, "sf-edges")
    folders, found = [folder], []
    while True:
        local, new, n = _written(_partition_forests(e, count, partition_edges), "sf-local")
        release(spark, folders)
        if count <= partition_edges:
            found.append(local.select("a", "b", "p"))
            break
        ends = local.withColumn("c", F.explode(F.array("u", "v")))
        best = _best_first(ends, "c").selectExpr("e.u AS u", "e.v AS v", "e.a AS a", "e.b AS b", "-e.np AS p").distinct()
        taken, _, _ = _written(best, "sf-taken")
        found.append(taken.select("a", "b", "p"))
        to, to_folder = write_table(connected_components(taken, "u", "v", partition_edges=partition_edges), "sf-roots")
        # every end of an edge is on a taken edge, so both joins are inner
        moved = local.join(to.selectExpr("node AS u", "root AS x"), "u").join(to.selectExpr("node AS v", "root AS y"), "v").where("x <> y")
        moved = moved.selectExpr("least(x, y) AS u", "greatest(x, y) AS v", "a", "b", "p")
        parallel = _best_first(moved, "u", "v").selectExpr("u", "v", "e.a AS a", "e.b AS b", "-e.np AS p")
        e, folder, count = _written(parallel, "sf-edges")
        release(spark, [new, to_folder])
        folders = [folder]
        if not count:
            break
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def maximum_spanning_forest(links: DataFrame, src: str = "uid_l", dst: str = "uid_r", weight: str = PROB_COL, *, partition_edges: int = PARTITION_EDGES) -> DataFrame:
    """The links ``(src, dst, weight)`` of the forest, src < dst; ids of any orderable type.

    Repeated links count once, with their highest weight; links of a record to itself and links without a weight are left out.
    """
    raw = links.select(F.least(src, dst).alias("a"), F.greatest(src, dst).alias("b"), F.col(weight).cast("double").alias("p")).where("a <> b AND p IS NOT NULL")
    kind = dict(raw.dtypes)["a"]
    if kind in _INTEGERS:
        out = _long_forest(raw.selectExpr("CAST(a AS BIGINT) AS a", "CAST(b AS BIGINT) AS b", "p"), partition_edges)
        return out.selectExpr(f"CAST(a AS {kind}) AS `{src}`", f"CAST(b AS {kind}) AS `{dst}`", f"p AS `{weight}`")
    from .clusters import dense_ids

    raw, _ = write_table(raw, "sf-ends")
    names = dense_ids(raw.selectExpr("a AS k").unionByName(raw.selectExpr("b AS k")), "k", "i").selectExpr("k", "CAST(i AS BIGINT) AS i")
    numbered = raw.join(names.selectExpr("k AS a", "i AS ia"), "a").join(names.selectExpr("k AS b", "i AS ib"), "b").selectExpr("ia AS a", "ib AS b", "p")
    out = _long_forest(numbered, partition_edges)
    out = out.join(names.selectExpr("k AS ka", "i AS a"), "a").join(names.selectExpr("k AS kb", "i AS b"), "b")
    return out.selectExpr(f"ka AS `{src}`", f"kb AS `{dst}`", f"p AS `{weight}`")


def entity_counts(forest: DataFrame, records: DataFrame, thresholds: Sequence[float], weight: str = PROB_COL) -> DataFrame:
    """``(threshold, entities)``: records less the forest's edges at or above the threshold, in one aggregate over the forest.

    Thresholds below the lowest weight that the links were kept from give the counts at that weight.
    """
    if not thresholds:
        raise ValueError("thresholds must not be empty")
    rows = records.select(F.lit(1).cast("bigint").alias("r"), F.lit(None).cast("double").alias("p"))
    edges = forest.select(F.lit(0).cast("bigint").alias("r"), F.col(weight).alias("p"))
    joins = [F.coalesce(F.sum((F.col("p") >= F.lit(float(t))).cast("bigint")), F.lit(0)).alias(f"j{i}") for i, t in enumerate(thresholds)]
    both = rows.unionByName(edges).agg(F.coalesce(F.sum("r"), F.lit(0)).alias("r"), *joins)
    each = ", ".join(f"named_struct('threshold', CAST('{float(t)!r}' AS DOUBLE), 'entities', r - j{i})" for i, t in enumerate(thresholds))
    return both.selectExpr(f"inline(array({each}))")
