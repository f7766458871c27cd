"""Session settings, shared storage and the two join helpers every operator uses."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows a side may have before it is broadcast. Rows here are narrow (a term and a
# weight, a key and a rank), so this stays far below a tenth of an executor's memory.
BROADCAST_ROWS = 500_000
# Bytes it may have by the optimizer's estimate (file size for a written table), so that wide
# rows are not sent around because they are few.
BROADCAST_BYTES = 64 << 20
# Bytes that could be read in the time a small file takes to be opened.
OPEN_COST = 64 << 10


def build_session(master: str | None = None, app: str = "clinisift", **conf) -> SparkSession:
    """A session with the settings the library is tuned for; a cluster may pass its own."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        b = b.master(master)
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Only where that is unset on a local master (tests, a laptop) a temporary folder stands in
    for it; on a cluster every machine would write to its own disk, so that is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        path = tempfile.mkdtemp(prefix="clinisift-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder this library has written."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def make_folder(spark: SparkSession, path: str) -> None:
    """An empty folder."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(where)


@contextmanager
def listing_by_cores(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark lists many paths in four tasks per core; its default is one task per path up
    to 10,000, again for each batch of a stream. A setting other than the default is kept."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    if before == "10000":
        spark.conf.set(name, str(4 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def small_files(spark: SparkSession) -> Iterator[None]:
    """Inside, streams are started that read small files: listed as in :func:`listing_by_cores`, hundreds of
    them in a task. Spark counts 4 MB for opening a file by default, so a task gets a few only, and a batch of
    10,000 files thousands of tasks. A setting other than the default is kept."""
    name = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(name)
    if before in ("4194304", "4194304b", "4MB"):
        spark.conf.set(name, str(OPEN_COST))
    try:
        with listing_by_cores(spark):
            yield
    finally:
        spark.conf.set(name, before)


def materialize(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once as Parquet and go on from the written table.

    The table outlives lost executors, cuts the lineage, and keeps column pruning and
    filter pushdown for every reader (a persisted or checkpointed frame loses both).
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of the size of ``df``."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the estimated size of ``df`` is below the session's broadcast limit."""
    spark = df.sparkSession
    return plan_bytes(df) <= int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint when a bounded count and the estimated bytes prove the side small; else
    the plain frame, which the optimizer then joins by shuffling."""
    if plan_bytes(df) <= BROADCAST_BYTES and df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


def join_hot_split(
    left: DataFrame, right: DataFrame, keys: list[str], weight: str, hot_keys: int = 1000
) -> DataFrame:
    """Inner join with a unique-key ``right`` whose ``weight`` counts the rows of ``left``.

    A key holding more than 1/hot_keys of all rows is hot. There can be at most
    ``hot_keys`` of those, so their side is broadcast with a proven bound and hot rows
    of ``left`` never move; the remaining keys are light enough to shuffle. A ``right``
    that is small as a whole is broadcast at once.
    """
    stats = right.agg(F.sum(weight).alias("total"), F.count(F.lit(1)).alias("n")).first()
    if stats["n"] <= BROADCAST_ROWS and plan_bytes(right) <= BROADCAST_BYTES:
        return left.join(F.broadcast(right), keys)
    limit = max(1, (stats["total"] or 0) // hot_keys)
    hot = right.filter(F.col(weight) > limit)
    cold = right.filter(F.col(weight) <= limit)
    hot_side = left.join(F.broadcast(hot), keys)
    cold_left = left.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return hot_side.unionByName(cold_left.join(cold, keys))
