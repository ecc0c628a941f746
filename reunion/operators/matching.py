"""One-to-one matching of two relations: the greedy matching of their links, as DataFrame rounds.

Links are ordered strictly: highest probability first, then by left and right id. Greedy takes the first link, leaves out
all others of its two records, and goes on. The same links come out of rounds of mutual choice: in each,
a link that is the first one of both its records is taken, and the links of matched records go. The first link of all is always
mutual, so every round makes progress; most links go in the first few. What is left is finished in order by one task
as soon as it fits a partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..constants import PROB_COL
from ..session import release, write_table

#: Links that one task finishes.
TASK_LINKS = 250_000


def _greedy(links: DataFrame) -> DataFrame:
    """The greedy matching of few links, by one task over the sorted links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = set(), set()
        for batch in batches:
            take = []
            for i, (x, y) in enumerate(zip(batch.column("l").to_pylist(), batch.column("r").to_pylist())):
                if x not in left and y not in right:
                    left.add(x)
                    right.add(y)
                    take.append(i)
            yield batch.take(pa.array(take, pa.int64()))

    ordered = links.repartition(1).sortWithinPartitions(F.desc("p"), "l", "r")
    return ordered.mapInArrow(run, links.schema)


def _written(df: DataFrame) -> tuple[DataFrame, str, int]:
    seen = Observation()
    out, folder = write_table(df.observe(seen, F.count(F.lit(1)).alias("n")), "matching")
    return out, folder, int(seen.get["n"])


def one_to_one(links: DataFrame, left: str = "uid_l", right: str = "uid_r", weight: str = PROB_COL, *, task_links: int = TASK_LINKS) -> DataFrame:
    """The links ``(left, right, weight)`` of the greedy matching: every id of either side at most once.

    Left and right ids are of two relations and may be equal by chance. Repeated links count once, with their
    highest weight; links with a null id or weight are left out.
    """
    spark = links.sparkSession
    once = links.select(F.col(left).alias("l"), F.col(right).alias("r"), F.col(weight).alias("p")).where("l IS NOT NULL AND r IS NOT NULL AND p IS NOT NULL")
    open_, folder, count = _written(once.groupBy("l", "r").agg(F.max("p").alias("p")))
    found: list[DataFrame] = []
    while count > task_links:
        of_left = open_.groupBy("l").agg(F.min(F.struct((-F.col("p")).alias("np"), "r")).alias("x")).selectExpr("l", "x.r AS r", "-x.np AS p")
        of_right = open_.groupBy("r").agg(F.min(F.struct((-F.col("p")).alias("np"), "l")).alias("y")).selectExpr("r", "y.l AS l")
        taken, _, _ = _written(of_left.join(of_right, ["l", "r"]).select("l", "r", "p"))
        found.append(taken)
        rest = open_.join(taken.select("l"), "l", "left_anti").join(taken.select("r"), "r", "left_anti").select("l", "r", "p")
        rest, new, count = _written(rest)
        release(spark, [folder])
        open_, folder = rest, new
    out = _greedy(open_)
    for part in found:
        out = out.unionByName(part)
    return out.selectExpr(f"l AS `{left}`", f"r AS `{right}`", f"p AS `{weight}`")
