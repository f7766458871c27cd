"""Search index kept within a freshness target: a segment per batch, small ones merged.

A segment is two tables below ``path``, written once and never changed: postings (term, id,
tf, doc_len, batch_id), sorted by term and id, and documents (id, batch_id, deleted). The
newest batch that has an id says what the document is now; one that is deleted, or was taken
in again, leaves dead postings in older segments, which readers leave out and merges drop.
The manifest of a batch lists the segments in use. It is written last, so a crash before it
leaves the index as it was, and the same batch again writes the same manifest.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import retrieval as R
from ..session import broadcast_if_small, materialize

POSTINGS = "term string, id long, tf long, doc_len long, batch_id long"
DOCUMENTS = "id long, batch_id long, deleted boolean"
MANIFEST = "segment string, level int, first_batch long, batch_id long, version long"
# Segments of one level that are merged into one of the next.
FAN = 4


def segments(spark: SparkSession, path: str, before: int | None = None) -> list:
    """Segments in use, oldest first; those before batch ``before`` was taken in, if given. There are at most
    FAN - 1 of each level and a level holds FAN times the batches of the one below, so the list is short."""
    try:
        m = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":  # no batch has been taken in yet
            return []
        raise
    m = m if before is None else m.filter(F.col("version") < before)
    last = m.agg(F.max("version")).first()[0]
    return [] if last is None else sorted(m.filter((F.col("version") == last) & F.col("segment").isNotNull()).collect(), key=lambda r: r["first_batch"])


def _read(spark: SparkSession, path: str, found: list, kind: str, schema: str) -> DataFrame:
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{r['segment']}/{kind}" for r in found])


def live(postings: DataFrame, documents: DataFrame) -> DataFrame:
    """``postings`` without those of documents that a later batch replaces or deletes."""
    newest = documents.groupBy("id").agg(F.max("batch_id").alias("newest"), F.count(F.lit(1)).alias("times"))
    changed = newest.filter("times > 1").select("id", "newest")  # ids that only one batch has are alive: a deletion has no postings
    dead = documents.join(changed, "id").filter(F.col("batch_id") < F.col("newest")).select("id", "batch_id")
    return postings.join(broadcast_if_small(materialize(dead, "dead")), ["id", "batch_id"], "left_anti")


def write_segment(path: str, name: str, postings: DataFrame, documents: DataFrame) -> None:
    """A segment whose postings are sorted by (term, id)."""
    sorted_ = postings.select("term", "id", "tf", "doc_len", "batch_id").repartitionByRange("term", "id").sortWithinPartitions("term", "id")
    sorted_.write.mode("overwrite").parquet(f"{path}/{name}/postings")
    documents.select("id", "batch_id", "deleted").write.mode("overwrite").parquet(f"{path}/{name}/documents")


def append_postings(batch: DataFrame, batch_id: int, path: str) -> None:
    """Takes a batch of (id, text) in, with a column ``deleted`` if documents may go; then merges.

    A null ``deleted`` is false. If a batch both writes and deletes an id, it is deleted; rows of
    one id in one batch are one document. Rows with a null id are left out, a null text is empty.
    """
    spark = batch.sparkSession
    gone = F.coalesce("deleted", F.lit(False)) if "deleted" in batch.columns else F.lit(False)
    rows = materialize(batch.filter("id IS NOT NULL").select(F.col("id").cast("long").alias("id"), "text", gone.alias("deleted")), "drop")
    documents = rows.groupBy("id").agg(F.max("deleted").alias("deleted")).withColumn("batch_id", F.lit(batch_id).cast("long"))
    deleted = documents.filter("deleted").select("id")
    postings = R.postings_of(rows.join(deleted, "id", "left_anti"), "id", "text").withColumn("batch_id", F.lit(batch_id).cast("long"))
    write_segment(path, f"segment-{batch_id}-0", postings, documents)
    known = [tuple(r)[:4] for r in segments(spark, path, batch_id)]
    merge(spark, path, [*known, (f"segment-{batch_id}-0", 0, batch_id, batch_id)], batch_id)


def merge(spark: SparkSession, path: str, found: list[tuple], batch_id: int) -> None:
    """Merges FAN segments of one level into one of the next until no level has that many, then writes the manifest."""
    found = sorted(found, key=lambda r: r[2])
    while len(tail := [r for r in found if r[1] == found[-1][1]]) >= FAN:
        level = tail[0][1] + 1
        rows = [{"segment": r[0]} for r in tail]
        postings, documents = _read(spark, path, rows, "postings", POSTINGS), _read(spark, path, rows, "documents", DOCUMENTS)
        newest = documents.groupBy("id").agg(F.max_by("deleted", "batch_id").alias("deleted"), F.max("batch_id").alias("batch_id"))
        rest = [r for r in found if r not in tail]
        # A deletion is kept as long as older segments may hold what it deletes.
        kept = newest if rest else newest.filter("NOT deleted")
        name = f"segment-{batch_id}-{level}"
        write_segment(path, name, live(postings, documents), kept)
        found = [*rest, (name, level, tail[0][2], batch_id)]
    m = spark.createDataFrame([(*r, batch_id) for r in found], MANIFEST)
    m.coalesce(1).drop("version").write.mode("overwrite").parquet(f"{path}/manifest/version={batch_id}")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Postings of the documents as they are now."""
    found = segments(spark, path)
    postings, documents = _read(spark, path, found, "postings", POSTINGS), _read(spark, path, found, "documents", DOCUMENTS)
    return live(postings, documents).select("term", "id", "tf", "doc_len")


def refresh_index(stream: DataFrame, path: str, checkpoint: str, every: str | None = None) -> DataFrame:
    """Feeds a stream of (id, text[, deleted]) to the index at ``path``: everything there is,
    or for good at an interval ("1 hour"). Returns the postings."""
    w = stream.writeStream.foreachBatch(lambda b, i: append_postings(b, i, path)).option("checkpointLocation", checkpoint)
    q = (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()
    if not every:
        q.awaitTermination()
    return read_index(stream.sparkSession, path)


def refreshed_index(postings: DataFrame, with_vectors: bool = False) -> R.Index:
    """Index over all batches so far: term and corpus counts are sums over the postings, and
    vectors are weighted with them."""
    return R.index_of(postings, with_vectors=with_vectors)
