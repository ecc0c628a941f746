"""Session helpers: the shared scratch folder, written intermediates, and a session for tests and the bench."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Setting under which a query's shuffle files go when it has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Sub-folder of the warehouse used where no checkpoint folder is set.
FALLBACK = "_reunion_scratch"

_written: dict[str, list[str]] = {}  # session -> folders that it wrote and that are still there


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's shared scratch folder: ``spark.checkpoint.dir``, else a sub-folder of its warehouse.

    Both must be folders that all executors share: on a cluster (a master that isn't local) a warehouse in
    the driver's own file system raises, unless the checkpoint folder is set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        if not sc.master.startswith("local") and warehouse.split(":", 1)[0] in ("file", warehouse):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share; the warehouse {warehouse} may be the driver's own")
        base = f"{warehouse.rstrip('/')}/{FALLBACK}"
    sc.setCheckpointDir(base)
    return sc.getCheckpointDir() or base


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _session_key(spark: SparkSession) -> str:
    return str(spark._jsparkSession.sessionUUID())


def written_folders(spark: SparkSession) -> list[str]:
    """Folders of intermediate tables of this session that are still there."""
    return list(_written.get(_session_key(spark), []))


def release(spark: SparkSession, folders: list[str] | None = None) -> None:
    """Delete intermediate tables of this session (all, or the given folders).

    Results that still read them can't be computed afterwards, so call this once results are written or collected.
    """
    own = _written.get(_session_key(spark), [])
    for path in list(own if folders is None else folders):
        _delete(spark, path)
        if path in own:
            own.remove(path)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "reunion") -> SparkSession:
    """A local session configured like the tests and the bench (UI off, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def scratch_folder(spark: SparkSession, label: str) -> str:
    """The path of a new folder in the shared scratch folder, deleted by :func:`release`."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/reunion-{label}-{uuid.uuid4().hex}"
    _written.setdefault(_session_key(spark), []).append(path)
    return path


def write_table(df: DataFrame, label: str = "stage", codec: str = "snappy", clear: bool = False) -> tuple[DataFrame, str]:
    """Write ``df`` as parquet into the shared scratch folder: the table read back, and its folder.

    One pass, the lineage is cut, the files survive lost executors, and AQE plans the
    readers from real sizes. With ``clear`` the shuffle files behind the table go as soon as it is written, not when the
    driver collects garbage.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, label)
    before = spark.conf.get(SHUFFLE_CLEANUP)
    if clear:
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        with traced(label):
            df.write.mode("error").option("compression", codec).parquet(path)
    finally:
        if clear:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """:func:`write_table` without the folder, which stays until :func:`release`."""
    return write_table(df, label)[0]


class traced:
    """Context manager printing the time of a step when REUNION_TRACE is set."""

    def __init__(self, label: str):
        self.label = label

    def __enter__(self):
        import time

        from pyspark import SparkContext

        self.sc = SparkContext._active_spark_context
        if self.sc is not None:
            self.sc.setLocalProperty("spark.job.description", f"reunion:{self.label}")
        self.t0 = time.time()
        return self

    def __exit__(self, *exc):
        if self.sc is not None:
            self.sc.setLocalProperty("spark.job.description", None)
        _trace(self.label, self.t0)
        return False


def _trace(label: str, t0: float) -> None:
    import os
    import sys
    import time

    if os.environ.get("REUNION_TRACE"):
        print(f"[reunion] {label}: {time.time() - t0:.2f}s", file=sys.stderr)

