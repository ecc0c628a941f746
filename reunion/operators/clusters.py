"""Cluster-level stages: copies as one profile, best probability per record and stable cluster ids."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import PROB_COL
from ..functions.levels import q
from ..session import ensure_checkpoint_dir, materialize

_ROW_BITS = 33  # monotonically_increasing_id keeps the record number in the low 33 bits


def best_match_probability(links: DataFrame, src: str = "uid_l", dst: str = "uid_r") -> DataFrame:
    """``(uid, best)``: the strongest kept pair touching each record, over both ends of a pair."""
    ends = links.select(F.col(src).alias("uid"), F.col(PROB_COL).alias("p")).unionByName(
        links.select(F.col(dst).alias("uid"), F.col(PROB_COL).alias("p"))
    )
    return ends.groupBy("uid").agg(F.max("p").alias("best"))


def copy_profiles(slim: DataFrame, keys: Sequence[str], id_col: str = "uid") -> tuple[DataFrame, DataFrame]:
    """Records of equal values as one profile: ``(pid, lo, hi, <keys...>)`` with the least and the largest id of its records, and the
    members ``(uid, pid, lo, hi)``. Ids may repeat; records without one are left out."""
    # 128 bits tell the values apart, so that members move without them
    digest = f"unhex(md5(concat({', '.join(f"coalesce(md5(CAST({q(c)} AS STRING)), '-')" for c in keys)})))"
    rows = slim.where(F.col(q(id_col)).isNotNull()).selectExpr(f"{q(id_col)} AS uid", f"{digest} AS digest", *[q(c) for c in keys])
    grouped = rows.groupBy("digest", *[q(c) for c in keys]).agg(F.min("uid").alias("lo"), F.max("uid").alias("hi"))
    profiles = materialize(grouped.withColumn("pid", F.monotonically_increasing_id()), "profiles")
    members = rows.select("uid", "digest").join(profiles.select("digest", "pid", "lo", "hi"), "digest").select("uid", "pid", "lo", "hi")
    return profiles.drop("digest"), members


def member_links(links: DataFrame, profiles: DataFrame, members: DataFrame, self_probability: Column, threshold: float) -> DataFrame:
    """Links of records that give the components and the best probabilities that all links of the records would give.

    Of a link of two profiles every member gets the one to the other's first record (to its last, where that is the member itself), and
    every member of a profile whose copies are linked the one to its own first: as many as members, not as pairs of them.
    """
    ends = links.selectExpr("uid_l AS pid", "uid_r AS other", PROB_COL).unionByName(links.selectExpr("uid_r AS pid", "uid_l AS other", PROB_COL))
    to = ends.join(profiles.selectExpr("pid AS other", "lo", "hi"), "other").select("pid", "lo", "hi", PROB_COL)
    own = profiles.withColumn(PROB_COL, self_probability).where((F.col("lo") < F.col("hi")) & (F.col(PROB_COL) >= F.lit(float(threshold))))
    to = to.unionByName(own.select("pid", "lo", "hi", PROB_COL))
    met = members.select("uid", "pid").join(to, "pid").selectExpr("uid", "IF(uid = lo, hi, lo) AS met", PROB_COL).where("uid <> met")
    return met.selectExpr("least(uid, met) AS uid_l", "greatest(uid, met) AS uid_r", PROB_COL)


#: Records of a profile that stand in one row when pairs of profiles become pairs of records.
MEMBER_RUN = 1024


def member_pairs(pairs: DataFrame, members: DataFrame, often: str = "c", run: int = MEMBER_RUN) -> DataFrame:
    """Pairs of profiles ``(uid_l, uid_r, <more...>)`` as all pairs ``uid_l < uid_r`` of their members, with the other columns.

    A pair of a profile with itself gives those of its own members. Members move as runs of ids, every two runs of a pair as a row dealt
    over all shuffle partitions, which Spark explodes: neither the values nor a row per pair are shuffled. ``often`` is how many
    times a record that comes ``c`` times in a profile is met (SQL, of the pairs' columns too).
    """
    more = [c for c in pairs.columns if c not in ("uid_l", "uid_r")]
    records = members.groupBy("pid", "uid").agg(F.count(F.lit(1)).alias("c"))
    sizes = records.groupBy("pid").agg(F.ceil(F.count(F.lit(1)) / F.lit(run)).alias("runs"))
    dealt = records.join(sizes, "pid").withColumn("run", F.pmod(F.xxhash64("uid"), "runs"))
    runs = materialize(dealt.groupBy("pid", "run").agg(F.collect_list(F.struct("uid", "c")).alias("ids")), "members")
    left, right = (runs.selectExpr(f"pid AS uid_{s}", f"run AS run_{s}", f"ids AS ids_{s}") for s in ("l", "r"))
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = pairs.join(left, "uid_l").join(right, "uid_r").repartition(tasks, "uid_l", "uid_r", "run_l", "run_r")
    times = re.sub(r"\bc\b", "e.c", often)
    ids = [f"flatten(transform(ids_{s}, e -> array_repeat(e.uid, CAST({times} AS INT)))) AS ids_{s}" for s in ("l", "r")]
    kept = [q(c) for c in more]
    each = met.selectExpr("uid_l = uid_r AS own", *ids, *kept).selectExpr("own", "explode(ids_l) AS x", "ids_r", *kept)
    each = each.selectExpr("own", "x", "explode(ids_r) AS y", *kept).where("x < y OR (x > y AND NOT own)")
    return each.selectExpr("least(x, y) AS uid_l", "greatest(x, y) AS uid_r", *kept)


def dense_ids(keys: DataFrame, col: str, out: str = "cluster_id", *, num_partitions: int | None = None) -> DataFrame:
    """``(col, out)``: ``out`` is the 0-based dense rank of ``col`` as a string ("0", "1", ...).

    Two passes instead of a global single-partition window: distinct values are range-
    partitioned and sorted, each partition numbers its rows locally, and the driver turns
    the per-partition counts (one row per partition) into offsets that are broadcast back.
    """
    spark = keys.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        keys.select(col)
        .distinct()
        .repartitionByRange(n, col)
        .sortWithinPartitions(col)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    ranged = materialize(ranged, "ids")
    pid = F.shiftright(F.col("_mid"), _ROW_BITS)
    counts = ranged.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n")).collect()
    offsets, acc = [], 0
    for r in sorted(counts, key=lambda r: r["_pid"]):
        offsets.append((int(r["_pid"]), acc))
        acc += int(r["_n"])
    if not offsets:
        offsets = [(0, 0)]
    off = spark.createDataFrame(offsets, "_pid long, _off long")
    local = F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        ranged.join(F.broadcast(off), pid == F.col("_pid"))
        .select(col, (F.col("_off") + local).cast("string").alias(out))
    )
