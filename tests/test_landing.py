"""Landing folders: one whole file per name, listings that take a few tasks."""

import gzip

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from clinisift.session import listing_by_cores
from clinisift.sources import landing as LD
from clinisift.streaming import arrivals as A

PARALLELISM = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def tasks_of(spark, group, run):
    """Most tasks of a stage that ``run`` starts."""
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        run()
        tracker = sc.statusTracker()
        stages = [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
        return max(i.numTasks for i in map(tracker.getStageInfo, stages) if i)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_rows_of_a_name_in_many_partitions_are_one_file(spark, tmp_path):
    rows = spark.range(60).select(F.concat(F.lit("f"), F.col("id") % 3, F.lit(".txt")).alias("file_name"), "id",
                                  F.when(F.col("id") != 30, F.concat(F.lit("line é "), "id")).alias("value")).repartition(7)
    LD.export_files(rows, f"file://{tmp_path}/in", ("id",))
    got = {r["file_name"]: r["text"] for r in LD.read_whole_text(spark, {"TXT": f"{tmp_path}/in"}).collect()}
    want = {f"f{k}.txt": "".join(("" if i == 30 else f"line é {i}") + "\n" for i in range(k, 60, 3)) for k in range(3)}
    assert got == want
    listed = LD.scan_landing_files(spark, {"TXT": f"{tmp_path}/in"}).collect()
    assert sorted((r["file_name"], r["length"]) for r in listed) == sorted((n, len(t.encode())) for n, t in want.items())


def test_folders_are_named_as_by_the_partitioned_sink(spark, tmp_path):
    rows = spark.createDataFrame([(n, "x") for n in ("a b:c.txt", "50%/é", "[q]^{z}~|")], "file_name string, value string")
    rows.write.partitionBy("file_name").text(f"{tmp_path}/sink")
    LD.export_files(rows, f"{tmp_path}/in")
    sink, ours = (sorted(p.name for p in (tmp_path / x).iterdir() if p.is_dir()) for x in ("sink", "in"))
    assert ours == sink


def test_names_that_are_missing_and_empty_tables(spark, tmp_path):
    rows = spark.createDataFrame([(None, "a"), ("", "b"), ("x", None)], "file_name string, value string")
    for _ in range(2):  # the second time replaces the first
        LD.export_files(rows, f"{tmp_path}/in", ("value",))
    got = sorted((r["file_name"], r["text"]) for r in LD.read_whole_text(spark, {"TXT": f"{tmp_path}/in"}).collect())
    assert got == [(LD.NO_NAME, "a\nb\n"), ("x", "\n")]
    LD.export_files(rows.limit(0), f"{tmp_path}/none")
    assert LD.scan_landing_files(spark, {"TXT": f"{tmp_path}/none"}).count() == 0


def test_listing_takes_few_tasks(spark, tmp_path):
    LD.export_files(spark.range(150).select(F.col("id").cast("string").alias("file_name"), F.lit("x").alias("value")), f"{tmp_path}/in")
    most = 4 * spark.sparkContext.defaultParallelism
    assert tasks_of(spark, "listing", lambda: LD.scan_landing_files(spark, {"TXT": f"{tmp_path}/in"})) <= most < 150
    assert spark.conf.get(PARALLELISM) == "10000"


def test_a_chosen_listing_setting_is_kept(spark):
    spark.conf.set(PARALLELISM, "77")
    try:
        with pytest.raises(KeyError), listing_by_cores(spark):
            assert spark.conf.get(PARALLELISM) == "77"
            raise KeyError
        assert spark.conf.get(PARALLELISM) == "77"
    finally:
        spark.conf.unset(PARALLELISM)


def test_listings_and_texts_as_by_sparks_readers(spark, tmp_path):
    """Nested folders, hidden, empty and packed files, odd names; the listing is a written table, not held by the driver."""
    root = tmp_path / "in"
    for name, text in (("a b%.txt", "1"), ("x/y/z é#.txt", "22\n"), ("x/_hidden", "3"), ("x/_k=1/f.txt", "4"), (".no/f.txt", "5"), ("x/empty.txt", ""), ("q/w.txt._COPYING_", "6")):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(text)
    (root / "x/raw.txt").write_bytes(b"\xff\x00")
    with gzip.open(root / "x/p.txt.gz", "wt") as f:
        f.write("packed")
    for k in range(60):
        (root / f"file_name=f{k}").mkdir()
        (root / f"file_name=f{k}" / "part-00000-1.txt").write_text("x" * (k + 1))
    where = f"file://{root}"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(where)
    want = files.select(F.lit("T").alias("location"), LD.base_name(F.col("path")).alias("file_name"), F.col("path").alias("file_path"), "length",
                        F.col("modificationTime").cast("timestamp_ntz").alias("event_time"))
    got = LD.scan_landing_files(spark, {"T": where})
    assert sorted(got.collect()) == sorted(want.collect()) and got.columns == want.columns and want.count() == 65
    assert len(got.inputFiles()) <= 4 * spark.sparkContext.defaultParallelism < 60
    texts = spark.read.option("recursiveFileLookup", "true").text(where, wholetext=True).select(
        LD.base_name(F.col("_metadata.file_path")).alias("n"), F.hex(F.col("value").cast("binary")).alias("t"))
    read = LD.read_whole_text(spark, {"T": where}).select(F.col("file_name").alias("n"), F.hex(F.col("text").cast("binary")).alias("t"))
    assert sorted(read.collect()) == sorted(texts.collect())


def test_a_folder_that_is_missing_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        LD.scan_landing_files(spark, {"T": f"{tmp_path}/none"})


def test_a_stream_reads_many_small_files_in_a_task(spark, tmp_path):
    for k in range(120):
        (tmp_path / f"in{k}.txt").write_text("x")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16m")
    try:
        A.run_to_end(A.arrivals_stream(spark, {"T": f"file://{tmp_path}"}), f"{tmp_path}/.out", f"{tmp_path}/.ck")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    out = spark.read.parquet(f"{tmp_path}/.out")
    assert out.count() == 120 and len(out.inputFiles()) <= spark.sparkContext.defaultParallelism + 1
    assert spark.conf.get("spark.sql.files.openCostInBytes") in ("4194304", "4194304b", "4MB")
