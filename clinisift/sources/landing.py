"""Landing folders: file listings, whole texts, typed reference tables."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from functools import reduce
from itertools import groupby, islice

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import OPEN_COST, listing_by_cores, make_folder, materialize, remove

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
# Characters that Spark escapes in the folder name of a partition, and its name for a missing value.
ESCAPED = re.compile(r"[\x01-\x1f\x7f\"#%'*/:=?\\{\[\]^]")
NO_NAME = "__HIVE_DEFAULT_PARTITION__"
# Files that a task hands on together, bytes of contents it hands on together, and bytes it is meant to read.
LISTED_AT_ONCE, CONTENT_BYTES, READ_BYTES = 10_000, 8 << 20, 128 << 20


def base_name(path: Column) -> Column:
    """Last part of a path; a part file that :func:`export_files` has written into a folder
    ``file_name=<name>`` bears that name."""
    folder = F.regexp_extract(path, r"/file_name=([^/]+)/part-[0-9]{5}-[^/]*$", 1)
    return F.when(folder != "", folder).otherwise(F.element_at(F.split(path, "/"), -1))


def _hidden(name: str) -> bool:
    """Names that Spark's listings pass over."""
    if name.startswith(("_common_metadata", "_metadata")):
        return False
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _entries(files: fs.FileSystem, folder: str) -> Iterator[tuple[str, bool, int, int]]:
    """(name, whether it is a folder, bytes, time in ms) of what lies in a folder; sizes and times of files only."""
    if isinstance(files, fs.LocalFileSystem):
        with os.scandir(folder) as found:  # one entry at a time, however many there are
            for e in found:
                if _hidden(e.name):
                    continue
                if e.is_dir():
                    yield e.name, True, 0, 0
                else:
                    try:
                        about = e.stat()
                    except FileNotFoundError:  # it has gone meanwhile
                        continue
                    yield e.name, False, about.st_size, about.st_mtime_ns // 1_000_000
        return
    for e in files.get_file_info(fs.FileSelector(folder)):
        if not _hidden(e.base_name):
            yield e.base_name, e.type == fs.FileType.Directory, e.size or 0, (e.mtime_ns or 0) // 1_000_000


LISTED = pa.schema([("location", pa.string()), ("path", pa.string()), ("folder", pa.string()), ("length", pa.int64()), ("modificationTime", pa.timestamp("us", "UTC"))])
LISTED_ROWS = "location string, path string, folder string, length long, modificationTime timestamp"


def _listed(rows: Iterator[tuple[str, str, str | None, int, int]]) -> Iterator[pa.RecordBatch]:
    while some := list(islice(rows, LISTED_AT_ONCE)):
        location, path, folder, length, ms = zip(*some, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(location, pa.string()), pa.array(path, pa.string()), pa.array(folder, pa.string()), pa.array(length, pa.int64()),
                                          pa.array([1000 * t for t in ms], pa.int64()).cast(pa.timestamp("us", "UTC"))], schema=LISTED)


def list_files(spark: SparkSession, roots: dict[str, str]) -> DataFrame | None:
    """(location, path, length, modificationTime) of all files of all locations, written; none where only Spark
    can list them.

    One task per location goes through its root and writes the names of the folders in it; the folders are dealt
    to all tasks. Neither the driver nor a task holds a listing. As by Spark's readers, hidden and empty files have no row.
    """
    at = {}
    for location, root in roots.items():
        if _file_system(root) is None or re.search(r"[*?\[\]{}\\]", root):
            return None
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not store.exists(where) or not store.getFileStatus(where).isDirectory():
            return None
        at[location] = (root, store.makeQualified(where).toString())

    def inside(location: str, path: str, folder: str, deep: bool) -> Iterator[tuple[str, str, str | None, int, int]]:
        for name, is_folder, length, ms in _entries(_file_system(at[location][0])[0], folder):
            if is_folder and deep:
                yield from inside(location, f"{path}/{name}", f"{folder}/{name}", True)
            elif is_folder:
                yield location, f"{path}/{name}", f"{folder}/{name}", 0, 0
            elif length > 0:
                yield location, f"{path}/{name}", None, length, ms

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = (x for b in batches for x in b.column(0).to_pylist())
        return _listed(r for x in names for r in inside(x, at[x][1], _file_system(at[x][0])[1], False))

    def below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pc.is_null(b.column(2)))  # files that lie in the root
            folders = zip(*(c.to_pylist() for c in b.filter(pc.is_valid(b.column(2))).columns[:3]), strict=True)
            yield from _listed(r for x, path, folder in folders for r in inside(x, path, folder, True))

    names = spark.createDataFrame([(x,) for x in at], "location string").repartition(len(at), "location")
    first = materialize(names.mapInArrow(top, LISTED_ROWS), "listed-roots")
    # Names are little data but long work: a stated number of tasks is not made fewer for that.
    files = first.repartition(4 * spark.sparkContext.defaultParallelism).mapInArrow(below, LISTED_ROWS)
    return materialize(files.drop("folder"), "listed-files")


def scan_landing_files(spark: SparkSession, roots: dict[str, str]) -> DataFrame:
    """One row per file of every location: metadata only, contents are never opened."""
    columns = [base_name(F.col("path")).alias("file_name"), F.col("path").alias("file_path"), "length", F.col("modificationTime").cast("timestamp_ntz").alias("event_time")]

    def one(location, root):
        return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
                .select(F.lit(location).alias("location"), *columns))

    listed = list_files(spark, roots)
    if listed is not None:
        return listed.select("location", *columns)
    with listing_by_cores(spark):
        return reduce(DataFrame.unionByName, [one(m, r) for m, r in roots.items()])


def list_directory(spark: SparkSession, roots: dict[str, str]) -> DataFrame:
    """Listing of every location with paths relative to it."""
    start = F.lit(None).cast("int")
    for location, root in roots.items():
        folder = re.sub(r"^[a-z0-9]+:(//[^/]*)?", "", root).rstrip("/") + "/"
        start = F.when(F.col("location") == location, F.instr("file_path", F.lit(folder)) + len(folder)).otherwise(start)
    return scan_landing_files(spark, roots).select(
        "location", "file_name", F.col("file_path").substr(start, F.length("file_path")).alias("relative_path"), "length")


def read_whole_text(spark: SparkSession, roots: dict[str, str]) -> DataFrame:
    """Every text file as one row."""
    def one(location, root):
        return (spark.read.option("recursiveFileLookup", "true").text(root, wholetext=True)
                .select(F.lit(location).alias("location"), base_name(F.col("_metadata.file_path")).alias("file_name"), F.col("value").alias("text")))

    listed = list_files(spark, roots)
    if listed is not None:
        # Names of files are as in the URIs that Spark's text reader gives.
        return _contents(listed, roots).select("location", base_name(_quoted(F.col("path"))).alias("file_name"), F.col("content").cast("string").alias("text"))
    with listing_by_cores(spark):
        return reduce(DataFrame.unionByName, [one(m, r) for m, r in roots.items()])


def _quoted(path: Column) -> Column:
    """A path as its URI has it."""
    for c in "%", " ", *'"#<>?[\\]^`{|}':
        path = F.replace(path, F.lit(c), F.lit(f"%{ord(c):02X}"))
    return path


def _contents(listed: DataFrame, roots: dict[str, str]) -> DataFrame:
    """(location, path, content) of the files in a written listing, about READ_BYTES of them to a task."""
    spark = listed.sparkSession
    total = listed.agg(F.sum(F.col("length") + OPEN_COST)).first()[0] or 0
    tasks = max(4 * spark.sparkContext.defaultParallelism, -(-total // READ_BYTES))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*held, strict=True), (pa.string(), pa.string(), pa.binary()), strict=True)],
                                              ["location", "path", "content"])

        for b in batches:
            for location, path in zip(*(b.column(c).to_pylist() for c in range(2)), strict=True):
                files, top = _file_system(roots[location])
                if isinstance(files, fs.LocalFileSystem):
                    path_there = re.sub(r"^file:(//)?", "", path)
                else:
                    path_there = top.rstrip("/") + path[path.index(top.rstrip("/")) + len(top.rstrip("/")):]
                with files.open_input_stream(path_there) as stream:  # packed files are known by their suffix
                    held.append((location, path, stream.read()))
                size += len(held[-1][2]) + 1024
                if size >= CONTENT_BYTES:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    return listed.select("location", "path").repartition(tasks).mapInArrow(read, "location string, path string, content binary")


def load_reference_table(spark: SparkSession, path: str, schema: T.StructType, defaults: dict[str, object] | None = None,
                         fmt: str = "csv") -> tuple[DataFrame, DataFrame]:
    """(good rows with defaults filled in, rejected raw lines) of a typed bulk load."""
    if fmt != "csv":
        df = spark.read.schema(schema).format(fmt).load(path)
        return (df.fillna(defaults) if defaults else df), spark.createDataFrame([], "raw string")
    with_bad = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    raw = (spark.read.schema(with_bad).option("header", "true").option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "_corrupt_record").csv(path))
    raw = materialize(raw, "reference-load")  # a raw file cannot be asked for its bad lines alone
    good = raw.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
    bad = raw.filter(F.col("_corrupt_record").isNotNull()).select(F.col("_corrupt_record").alias("raw"))
    return (good.fillna(defaults) if defaults else good), bad


def _file_system(root: str) -> tuple[fs.FileSystem, str] | None:
    """The file system of ``root`` as tasks open it and the path in it, none for a scheme only Hadoop knows."""
    try:
        return fs.FileSystem.from_uri(root)
    except pa.ArrowException:
        return None


def export_files(rows: DataFrame, root: str, order: tuple[str, ...] = ()) -> None:
    """Writes (file_name, value) rows as one text file per name, in folders as Spark's partitioned
    sink makes them: the rows of a name are the lines of its file, sorted by ``order``; a null value
    is an empty line, rows without a name share the file of Hive's default partition.

    That sink moves each of its folders on the driver when it commits, and on local disks starts a process per file
    to set its mode. Here tasks write the files and move them into place, so a repeated task replaces what it wrote.
    """
    spark = rows.sparkSession
    if _file_system(root) is None:
        parts = rows.repartition("file_name").sortWithinPartitions("file_name", *order).select("file_name", "value")
        parts.write.mode("overwrite").option("mapreduce.fileoutputcommitter.algorithm.version", 2).partitionBy("file_name").text(root)
        return
    remove(spark, root)
    make_folder(spark, root)
    run = uuid.uuid4().hex

    def write(part: Iterator[Row]) -> None:
        files, top = _file_system(root)
        for name, lines in groupby(part, lambda r: r["file_name"] or NO_NAME):
            folder = f"{top}/file_name=" + (name if name == NO_NAME else ESCAPED.sub(lambda c: f"%{ord(c[0]):02X}", name))
            files.create_dir(folder)
            draft = f"{folder}/.{uuid.uuid4().hex}"
            with files.open_output_stream(draft, compression=None) as out:
                for r in lines:
                    out.write((r["value"] or "").encode() + b"\n")
            files.move(draft, f"{folder}/part-00000-{run}.txt")

    named = rows.withColumn("file_name", F.nullif("file_name", F.lit("")))
    # Many small files are little data: a stated number of tasks is not made fewer for that.
    n = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    named.repartition(n, "file_name").sortWithinPartitions("file_name", *order).select("file_name", "value").foreachPartition(write)
