"""Streams of arriving files and their per-minute counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import listing_by_cores, small_files
from ..sources.landing import FILE_SCHEMA, base_name


def arrivals_stream(spark: SparkSession, roots: dict[str, str], content: bool = False, max_files: int = 10_000) -> DataFrame:
    """Append-only stream of new files of all locations, at most ``max_files`` of a location in
    one batch (the others come in the next). What was read is kept in the checkpoint of the
    query that consumes it."""
    cols = [F.col("path").alias("file_path"), "length", F.col("modificationTime").alias("event_time")]

    def one(location, root):
        s = (spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("recursiveFileLookup", "true")
             .option("maxFilesPerTrigger", max_files).load(root))
        return s.select(F.lit(location).alias("location"), base_name(F.col("path")).alias("file_name"), *cols, *(["content"] if content else []))

    with listing_by_cores(spark):
        return reduce(DataFrame.unionByName, [one(m, r) for m, r in roots.items()])


def dedup_stream(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """First notice of every (path, time). State is kept for ``delay`` only; the log's
    anti-join on the path stays the final word."""
    return stream.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["file_path", "event_time"])


def run_to_end(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Takes in everything that is there and stops."""
    with small_files(stream.sparkSession):  # its files are listed again for each batch
        q = (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
        q.awaitTermination()


def windowed_counts(events: DataFrame, key: str, ts: str = "event_time", window: str = "1 minute") -> DataFrame:
    """Arrivals per time window and key (batch or stream)."""
    return (events.groupBy(F.window(ts, window).alias("w"), key).agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), key, "n"))


def arrivals_windowed(stream: DataFrame, key: str, out: str, checkpoint: str, ts: str = "event_time", window: str = "1 minute",
                      delay: str = "1 hour", audit: str | None = None) -> DataFrame:
    """Per-window counts kept up to date: each batch appends the windows it changed, and a
    reader takes the newest count of every window. Returns that table. How many rows came
    behind the watermark, and so are in no window, is appended to ``audit`` (run_id, late_rows)."""
    counts = windowed_counts(stream.withWatermark(ts, delay), key, ts, window)

    def append(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out))

    q = (counts.writeStream.outputMode("update").foreachBatch(append).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if audit:
        stream.sparkSession.createDataFrame([(str(q.runId), late_rows(q))], "run_id string, late_rows long").write.mode("append").parquet(audit)
    rows = stream.sparkSession.read.schema(counts.schema.add("batch_id", "long")).parquet(out)
    newest = W.partitionBy("window_start", key).orderBy(F.desc("batch_id"))
    return rows.withColumn("rk", F.row_number().over(newest)).filter(F.col("rk") == 1).select("window_start", key, "n")


def late_rows(query) -> int:
    """Rows a finished query dropped behind its watermark, from its progress reports."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in p["stateOperators"])
