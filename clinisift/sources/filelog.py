"""The log of landed files and the append-only ledger of processed ones.

Parquet tables take no UPDATE, so "processed" is never a flag on the log: a run appends
the ids of exactly the rows it handled to the ledger, and status is a join. A file that
lands while a run is under way therefore stays pending.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize


def route_modality(path: Column) -> Column:
    """File type from the landing folder; recordings are MP3 by suffix, else WAV."""
    return (
        F.when(path.startswith("pdfs/"), "PDF").when(path.startswith("txt/"), "TXT")
        .when(path.ilike("%.mp3"), "MP3").otherwise("WAV")
    )


def file_count_by_modality(files: DataFrame) -> DataFrame:
    """Files per location, one grouped pass."""
    return files.groupBy(F.split_part("file_path", F.lit("/"), F.lit(1)).alias("location")).agg(
        F.count(F.lit(1)).alias("file_count"))


def append_files_log(new: DataFrame, log: DataFrame | None = None) -> DataFrame:
    """New log rows with gap-free ids in (event_time, file_path) order, after the ids of ``log``.

    A range-partitioned sort gives every row its place inside its partition; the table is
    written once, so partitions stay as they are while the per-partition counts (one row
    each) turn places into ids. No partition ever holds more than its range.
    """
    keys = ["event_time", "file_path"]
    pid = F.spark_partition_id()
    placed = materialize(
        new.withColumn("file_type", route_modality(F.col("file_path")))
        .repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("pid", pid)
        .withColumn("place", F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)),
        "files-log",
    )
    start = 0
    if log is not None:
        start = log.agg(F.max("file_id")).first()[0] or 0
    counts = placed.groupBy("pid").agg(F.count(F.lit(1)).alias("n"))
    # One row per partition: a running sum over that handful of rows gives the offsets.
    offsets = counts.select("pid", (F.sum("n").over(W.orderBy("pid")) - F.col("n")).alias("offset"))
    return placed.join(F.broadcast(offsets), "pid").select(
        (F.lit(start + 1) + F.col("offset") + F.col("place")).alias("file_id"),
        "file_name", "file_path", "file_type", "event_time")


def pending_files(log: DataFrame, ledger: DataFrame, modalities: list[str]) -> DataFrame:
    """Log rows of the given types without a ledger entry."""
    return log.filter(F.col("file_type").isin(modalities)).join(ledger.select("file_id"), "file_id", "left_anti")


def ledger_rows(batch: DataFrame, batch_id: int, processed_at: Column) -> DataFrame:
    """Ledger rows for exactly the files of a batch."""
    return batch.select("file_id", F.lit(batch_id).cast("long").alias("batch_id"),
                        processed_at.cast("timestamp_ntz").alias("processed_at"))


def file_status(log: DataFrame, ledger: DataFrame) -> DataFrame:
    """The log with its flag and processing time; a replayed batch counts once."""
    done = ledger.groupBy("file_id").agg(F.min("processed_at").alias("processed_at"), F.min("batch_id").alias("batch_id"))
    return log.join(done, "file_id", "left").withColumn("is_processed", F.col("batch_id").isNotNull())


def ingest_status(status: DataFrame) -> DataFrame:
    done = F.col("is_processed")
    return status.groupBy("file_type").agg(
        F.count(F.lit(1)).alias("total_files"),
        F.sum(F.when(done, 1).otherwise(0)).alias("processed"),
        F.sum(F.when(done, 0).otherwise(1)).alias("pending"),
    ).orderBy("file_type")


def has_new_data(log: DataFrame, ledger: DataFrame, modalities: list[str]) -> DataFrame:
    """One boolean row; stops at the first pending file."""
    return (pending_files(log, ledger, modalities).limit(1)
            .agg((F.count(F.lit(1)) > 0).alias("has_unprocessed_files")))


def backfill_refresh(scanned: DataFrame, log: DataFrame) -> DataFrame:
    """Files on storage that never reached the log, with the ids they get."""
    missed = scanned.dropDuplicates(["file_path"]).join(log.select("file_path"), "file_path", "left_anti")
    return append_files_log(missed.select("file_name", "file_path", "event_time"), log)


def load_history(audit: DataFrame, as_of: Column, hours: int = 24, n: int = 20) -> DataFrame:
    """Newest load attempts of the last hours before ``as_of``."""
    since = as_of - F.expr(f"INTERVAL {int(hours)} HOURS")
    return audit.filter(F.col("ts") >= since).orderBy(F.desc("ts"), "file_name").limit(n)


def dedup_arrivals(files: DataFrame, content: Column, id_col: str) -> DataFrame:
    """First file of every distinct content and how many copies arrived.

    Groups by digest and length, so copies collapse before the shuffle and a content that
    makes up a third of all files costs one row per task.
    """
    return files.groupBy(F.sha2(content, 256).alias("digest"), F.length(content).cast("long").alias("n_chars")).agg(
        F.min(id_col).alias(id_col), F.count(F.lit(1)).alias("n_copies"))


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of every table, one job."""
    parts = [t.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("row_count")) for n, t in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def preview_first(files: dict[str, tuple[DataFrame, int]]) -> DataFrame:
    """The first text of each modality, cut to its length; ``files`` maps a modality to
    (id, file_name, text) rows and the number of characters."""
    parts = [
        df.orderBy("id").limit(1).select(F.lit(m).alias("modality"), "file_name", F.left("text", F.lit(n)).alias("preview"))
        for m, (df, n) in files.items()
    ]
    return reduce(DataFrame.unionByName, parts)
