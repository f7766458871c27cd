"""New files to intelligence rows, batch by batch, safe to replay.

Every output of a batch goes to its own ``batch_id`` partition and is overwritten when the
batch runs again, so a crash at any point neither loses nor doubles rows. The ledger is
written last, with the ids the batch handled. A file handled again later has rows of two
batches; :func:`read_intelligence` gives the newest.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import enrich as E
from ..session import fresh_path, listing_by_cores, materialize, remove, small_files
from ..sources import filelog as L

LOG = "file_id long, file_name string, file_path string, file_type string, event_time timestamp_ntz, landed_at timestamp_ntz, batch_id long"
LEDGER = "file_id long, processed_at timestamp_ntz, batch_id long"
AUDIT = "file_id long, file_name string, modality string, status string, row_count long, error string, own_fault boolean, ts timestamp_ntz, batch_id long"
SEGMENT = "turn long, role string, text string, malformed string"
IDS = {"PDF": "doc_id", "TXT": "txt_id", "AUDIO": "audio_id"}


def write_intelligence(df: DataFrame, path: str, batch_id: int) -> None:
    """Rows of one batch into their partition; the same batch again replaces them."""
    (df.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The table, empty before its first batch (if its schema is given)."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as e:
        if schema and e.getCondition() == "PATH_NOT_FOUND":  # no batch has been written yet
            return spark.createDataFrame([], schema)
        raise


def newest(rows: DataFrame, key: str) -> DataFrame:
    """Of rows with one key those of the latest batch."""
    # Only keys and batch numbers are grouped; whole rows (texts, vectors) are not sorted.
    last = rows.groupBy(key).agg(F.max("batch_id").alias("batch_id"))
    return rows.join(last, [key, "batch_id"], "left_semi").select(*rows.columns)


def read_intelligence(ws: Workspace, spark: SparkSession, modality: str) -> DataFrame:
    """One current row per file, however often it was handled."""
    return newest(read_table(spark, ws.table(f"intelligence-{modality.lower()}")), IDS[modality])


def segments_of(text: Column) -> Column:
    """The timed segments of a recording, one JSON line each; blank lines are passed over. What
    does not parse, or has no turn, is in ``malformed``."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.trim(F.translate(line, "\r\t", "  ")) != "")
    parsed = F.transform(lines, lambda line: F.struct(F.from_json(line, SEGMENT, {"columnNameOfCorruptRecord": "malformed"}).alias("s"), line.alias("line")))
    return F.transform(parsed, lambda x: F.struct(
        x["s"]["turn"].alias("turn"), x["s"]["role"].alias("role"), x["s"]["text"].alias("text"),
        F.when(x["s"]["malformed"].isNotNull() | x["s"]["turn"].isNull(), x["line"]).alias("malformed")))


def fault_of(content: Column, modality: str) -> Column:
    """Why a file cannot be loaded whatever else is in its batch; null if nothing is known against it."""
    text = content.cast("string")
    fault = F.when(content.isNull(), "the file is gone").when(~F.is_valid_utf8(text), "the content is not UTF-8 text")
    if modality == "AUDIO":
        wrong = F.filter(segments_of(text), lambda s: s["malformed"].isNotNull())
        fault = fault.when(F.size(wrong) > 0, F.concat(F.lit("lines that are no segments: "), F.size(wrong).cast("string")))
    return fault


def parse_content(files: DataFrame, modality: str) -> DataFrame:
    """Contents of landed files in the shape the enrichment of their modality takes.
    Recordings arrive as one JSON line per timed segment; one without any has one empty segment."""
    text = F.make_valid_utf8(F.col("content").cast("string"))
    text = F.when(text.endswith("\n"), F.substr(text, F.lit(1), F.length(text) - 1)).otherwise(text)
    if modality == "AUDIO":
        rows = files.select(F.col("file_id").alias("id"), "file_name", F.explode_outer(segments_of(text)).alias("s"))
        return rows.select("id", "file_name", "s.turn", "s.role", "s.text")
    return files.select(F.col("file_id").alias("id"), "file_name", text.alias("html" if modality == "PDF" else "text"))


@dataclass
class Workspace:
    """Folders of the tables and the word lists of a running intake."""

    root: str
    vocabularies: dict[str, E.Vocabulary] = field(default_factory=lambda: {
        "PDF": E.DOCUMENT_VOCABULARY, "TXT": E.TEXT_VOCABULARY, "AUDIO": E.CONSULTATION_VOCABULARY})
    processed_at: Callable = F.current_timestamp
    embeddings: bool = True
    # A file that failed this often is left alone until it is reprocessed by hand.
    max_attempts: int = 5
    # Failed files of earlier batches that one batch takes up again, oldest first.
    retry_files: int = 1000

    def table(self, name: str) -> str:
        return f"{self.root}/{name}"


TYPES = {"PDF": ["PDF"], "TXT": ["TXT"], "AUDIO": ["WAV", "MP3"]}


def process_new_files(ws: Workspace, batch: DataFrame, batch_id: int) -> DataFrame:
    """Logs the files of a batch (location, file_name, file_path, event_time, content), enriches
    each modality, then enters the handled ids in the ledger. Returns the audit rows, one per file.

    Files that failed before are taken up again, ``max_attempts`` times at most. A file that is
    no UTF-8 text, or a recording with a line that is no segment, fails by itself, and so does
    one that makes its batch fail: see :func:`load_apart`. Where a modality cannot be loaded
    whatever its files hold, they stay pending and none uses up an attempt.
    """
    spark = batch.sparkSession
    with ThreadPoolExecutor(1) as pool:  # what earlier batches have left is looked up beside the work on the new files
        again = pool.submit(inheritable_thread_target(spark)(retries), ws, spark, batch_id)
        content, log, arrived = log_files(ws, batch, batch_id)
        again = again.result()
    paths = [r["file_path"] for r in again.select("file_path").collect()]
    if paths:
        with listing_by_cores(spark):
            content = content.unionByName(spark.read.format("binaryFile").load(paths).select(F.col("path").alias("file_path"), "content"))
        log = log.unionByName(again)
    handle(ws, spark, log, content.dropDuplicates(["file_path"]), batch_id)
    remove(spark, arrived)
    return read_table(spark, ws.table("audit"), AUDIT).filter(F.col("batch_id") == batch_id)


def log_files(ws: Workspace, batch: DataFrame, batch_id: int) -> tuple[DataFrame, DataFrame, str]:
    """Writes the files of a batch and enters new ones in the log: (file_path and content, log rows of the batch, the
    folder of the written files)."""
    spark = batch.sparkSession
    arrived = fresh_path(spark, "arrived")
    batch.write.parquet(arrived)
    files = spark.read.schema(batch.schema).parquet(arrived)
    known = read_table(spark, ws.table("log"), LOG).filter(F.col("batch_id") != batch_id)
    folder = F.create_map(*[F.lit(x) for x in ("PDF", "pdfs/", "TXT", "txt/", "AUDIO", "audio/")])
    meta = files.dropDuplicates(["file_path"]).join(known.select("file_path"), "file_path", "left_anti").select(
        "file_name", F.concat(F.element_at(folder, F.col("location")), "file_name").alias("route"), "file_path",
        F.col("event_time").cast("timestamp_ntz").alias("event_time"))
    # The log is numbered by time and place; the place carries the routing folder along.
    routed = meta.select("file_name", F.concat("route", F.lit("\n"), "file_path").alias("file_path"), "event_time")
    log = L.append_files_log(routed, known).select(
        "file_id", "file_name", F.substring_index("file_path", "\n", -1).alias("file_path"),
        L.route_modality(F.substring_index("file_path", "\n", 1)).alias("file_type"), "event_time", ws.processed_at().cast("timestamp_ntz").alias("landed_at"))
    write_intelligence(log, ws.table("log"), batch_id)
    log = spark.read.schema(LOG).parquet(ws.table("log")).filter(F.col("batch_id") == batch_id).drop("batch_id")
    return files.select("file_path", "content"), log, arrived


def retries(ws: Workspace, spark: SparkSession, batch_id: int) -> DataFrame:
    """Pending files of earlier batches that have attempts left."""
    log = read_table(spark, ws.table("log"), LOG).filter(F.col("batch_id") < batch_id).drop("batch_id")
    ledger = read_table(spark, ws.table("ledger"), LEDGER).filter(F.col("batch_id") != batch_id)
    failed = read_table(spark, ws.table("audit"), AUDIT).filter(F.col("own_fault") & (F.col("batch_id") != batch_id))
    spent = failed.groupBy("file_id").agg(F.count(F.lit(1)).alias("attempts")).filter(F.col("attempts") >= ws.max_attempts)
    todo = L.pending_files(log, ledger, [t for types in TYPES.values() for t in types]).join(spent.select("file_id"), "file_id", "left_anti")
    return materialize(todo.orderBy("event_time", "file_id").limit(ws.retry_files), "retries")


def load_apart(load: Callable[[DataFrame], DataFrame], files: DataFrame) -> tuple[list[DataFrame], list[tuple[int, str]]]:
    """What ``load`` makes of ``files``, without those that make it fail: (written parts, [(file_id, error)]).

    Files that fail together are halved by their numbers until a file that fails stands alone,
    so k such files among n cost about k * log2(n) jobs. Raises if ``load`` fails without any
    file, for then no file is to blame.
    """
    files = materialize(files, "apart")
    materialize(load(files.limit(0)), "no-files")
    parts, blamed, todo = [], [], [(0, 2), (1, 2)]
    while todo:
        rest, modulus = todo.pop()
        some = files.filter(F.pmod("file_id", F.lit(modulus)) == rest)
        ids = [r["file_id"] for r in some.select("file_id").limit(2).collect()]
        if not ids:
            continue
        try:
            parts.append(materialize(load(some), "part"))
        except Exception as e:  # noqa: BLE001 - whatever a file causes is entered in the audit
            if len(ids) == 1:
                blamed.append((ids[0], str(e)))
            else:
                todo += [(rest, 2 * modulus), (rest + modulus, 2 * modulus)]
    return parts, blamed


def handle(ws: Workspace, spark: SparkSession, log: DataFrame, content: DataFrame, batch_id: int, modalities: list[str] | None = None) -> None:
    """Enriches logged files with their content; writes rows, audit and ledger of the batch."""
    modality = F.coalesce(*[F.when(F.col("file_type").isin(types), m) for m, types in TYPES.items() if m in (modalities or TYPES)])
    fault = F.when(F.col("modality") == "AUDIO", fault_of(F.col("content"), "AUDIO")).otherwise(fault_of(F.col("content"), ""))
    # Contents meet the log and are looked through once; enrichment, audit and ledger go on from what is written.
    read = log.withColumn("modality", modality).filter("modality IS NOT NULL").join(content, "file_path", "left").withColumn("fault", fault)
    # Small files are little data but long work: a stated number of tasks is not made fewer for that.
    read = read.select("file_id", "file_name", "content", "fault", "modality").repartition(2 * spark.sparkContext.defaultParallelism, "file_id")
    read = materialize(read, "handled", ("modality",))
    good = {r["modality"] for r in read.filter("fault IS NULL").select("modality").distinct().collect()}

    def load_files(modality: str) -> tuple[list[tuple[int, str]], str | None]:
        """The files to blame for themselves, and a fault that is none of the files'."""
        mine = read.filter((F.col("modality") == modality) & F.col("fault").isNull())
        path = ws.table(f"intelligence-{modality.lower()}")

        def load(files: DataFrame) -> DataFrame:
            return E.enrich_document(parse_content(files, modality), modality, ws.vocabularies[modality], ws.processed_at(), ws.embeddings)

        try:
            try:
                write_intelligence(load(mine), path, batch_id)
                return [], None
            except Exception:  # noqa: BLE001 - one file must not stop the others
                parts, blamed = load_apart(load, mine)
                if parts:
                    write_intelligence(reduce(DataFrame.unionByName, parts), path, batch_id)
                return blamed, None
        except Exception as e:  # noqa: BLE001 - one modality must not stop the others
            return [], str(e)

    # Their jobs run side by side: stages of few files leave cores idle.
    with ThreadPoolExecutor(len(TYPES)) as pool:
        results = {m: pool.submit(inheritable_thread_target(spark)(load_files), m) for m in TYPES if m in good}
    blamed, outside = [], F.lit(None).cast("string")
    for m, result in results.items():
        own, other = result.result()
        blamed += own
        if other is not None:
            outside = F.when(F.col("modality") == m, F.lit(other)).otherwise(outside)
    read = read.drop("content")
    if blamed:
        alone = F.broadcast(spark.createDataFrame(blamed, "file_id long, own string"))
        read = read.join(alone, "file_id", "left").withColumn("fault", F.coalesce("fault", "own"))
    error = F.coalesce("fault", outside)
    write_intelligence(read.select(
        "file_id", "file_name", "modality", F.when(error.isNull(), "LOADED").otherwise("LOAD_FAILED").alias("status"),
        F.when(error.isNull(), 1).otherwise(0).cast("long").alias("row_count"), error.alias("error"), F.col("fault").isNotNull().alias("own_fault"),
        ws.processed_at().cast("timestamp_ntz").alias("ts")), ws.table("audit"), batch_id)
    write_intelligence(L.ledger_rows(read.filter(error.isNull()), batch_id, ws.processed_at()).drop("batch_id"), ws.table("ledger"), batch_id)


def run_intake(ws: Workspace, arrivals: DataFrame, checkpoint: str, every: str | None = None):
    """Feeds the arrival stream to :func:`process_new_files`: everything there is, or for good
    at an interval ("1 minute"). A trigger without new files starts no batch."""
    w = arrivals.writeStream.foreachBatch(lambda b, i: process_new_files(ws, b, i)).option("checkpointLocation", checkpoint)
    with small_files(arrivals.sparkSession):
        q = (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()
        if not every:
            q.awaitTermination()
    return q


def reprocess_modality(ws: Workspace, spark: SparkSession, modality: str, root: str, batch_id: int, force: bool = False) -> DataFrame:
    """Enriches one modality by hand: its pending files, or all with ``force``.
    Returns the intelligence rows of the batch; readers see them instead of older ones."""
    log = read_table(spark, ws.table("log"), LOG).drop("batch_id")
    if force:
        todo = log.filter(F.col("file_type").isin(TYPES[modality]))
    else:
        todo = L.pending_files(log, read_table(spark, ws.table("ledger"), LEDGER), TYPES[modality])
    todo = materialize(todo, "reprocess")
    with listing_by_cores(spark):
        content = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select(F.col("path").alias("file_path"), "content")
    handle(ws, spark, todo, content, batch_id, [modality])
    return read_table(spark, ws.table(f"intelligence-{modality.lower()}")).filter(F.col("batch_id") == batch_id)
