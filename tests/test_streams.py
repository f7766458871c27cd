"""Streams equal batches, replays change nothing, late files stay pending."""

import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from clinisift.operators import retrieval as R
from clinisift.session import fresh_path
from clinisift.sources import filelog as L
from clinisift.sources import landing as LD
from clinisift.streaming import arrivals as A
from clinisift.streaming import index_refresh as IR
from clinisift.streaming import processing as PR


@pytest.fixture
def roots(tmp_path):
    r = {m: str(tmp_path / m.lower()) for m in ("PDF", "TXT", "AUDIO")}
    for p in r.values():
        os.makedirs(p)
    return r


def drop(roots, n, day):
    for i in range(n):
        with open(f"{roots['TXT']}/d{day}_{i}.txt", "w") as f:
            f.write(f"Patient Name: P{i}\nThe nurse saw the vitals on day {day}.\n")
        with open(f"{roots['PDF']}/d{day}_{i}.pdf", "w") as f:
            f.write(f"<h1>Report</h1><p>Patient Name: P{i}<p>severe pain\n")
        with open(f"{roots['AUDIO']}/d{day}_{i}.{'Mp3' if i % 2 else 'ogg'}", "w") as f:
            for t in range(3):
                f.write(json.dumps({"turn": t, "role": "user", "text": f"hello {t}"}) + "\n")


def space(tmp_path):
    return PR.Workspace(str(tmp_path / "ws"), processed_at=lambda: F.lit("2024-01-01").cast("timestamp"))


def test_intake_over_three_drops(spark, roots, tmp_path):
    ws, ck = space(tmp_path), str(tmp_path / "ck")
    for day in (1, 2, 3):
        drop(roots, 2, day)
        PR.run_intake(ws, A.arrivals_stream(spark, roots, content=True), ck)
    PR.run_intake(ws, A.arrivals_stream(spark, roots, content=True), ck)
    log = PR.read_table(spark, ws.table("log"), PR.LOG)
    assert sorted(r["file_id"] for r in log.collect()) == list(range(1, 19))
    types = {r["file_type"]: r["count"] for r in log.groupBy("file_type").count().collect()}
    assert types == {"PDF": 6, "TXT": 6, "MP3": 3, "WAV": 3}
    ledger = PR.read_table(spark, ws.table("ledger"), PR.LEDGER)
    assert L.pending_files(log, ledger, ["PDF", "TXT", "WAV", "MP3"]).count() == 0
    txt = spark.read.parquet(ws.table("intelligence-txt"))
    assert txt.count() == 6 and {r[0] for r in txt.select("doc_category").collect()} == {"Nursing Notes"}
    assert spark.read.parquet(ws.table("intelligence-audio")).filter("n_segments = 3").count() == 6


def batch_of(spark, roots):
    parts = [spark.read.format("binaryFile").load(r).select(
        F.lit(m).alias("location"), LD.base_name(F.col("path")).alias("file_name"), F.col("path").alias("file_path"),
        F.col("modificationTime").alias("event_time"), "content") for m, r in roots.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def test_replay_after_a_crash_changes_nothing(spark, roots, tmp_path):
    ws = space(tmp_path)
    drop(roots, 2, 1)
    b = batch_of(spark, roots)
    PR.process_new_files(ws, b, 0)
    before = sorted(map(tuple, PR.read_table(spark, ws.table("log"), PR.LOG).collect()))
    PR.process_new_files(ws, b, 0)
    assert sorted(map(tuple, PR.read_table(spark, ws.table("log"), PR.LOG).collect())) == before
    assert spark.read.parquet(ws.table("intelligence-pdf")).count() == 2
    assert PR.read_table(spark, ws.table("ledger"), PR.LEDGER).count() == 6


def test_failing_modality_stays_pending_and_can_be_redone(spark, roots, tmp_path):
    ws = space(tmp_path)
    drop(roots, 2, 1)
    good = ws.vocabularies.pop("PDF")
    rows = PR.process_new_files(ws, batch_of(spark, roots), 0).collect()
    audit = {r["modality"]: r["status"] for r in rows}
    assert len(rows) == 6 and {r["error"] is None for r in rows if r["modality"] == "PDF"} == {False}
    assert audit == {"PDF": "LOAD_FAILED", "TXT": "LOADED", "AUDIO": "LOADED"}
    log, ledger = PR.read_table(spark, ws.table("log"), PR.LOG), PR.read_table(spark, ws.table("ledger"), PR.LEDGER)
    assert {r["file_type"] for r in L.pending_files(log, ledger, ["PDF", "TXT", "WAV", "MP3"]).collect()} == {"PDF"}
    ws.vocabularies["PDF"] = good
    assert PR.reprocess_modality(ws, spark, "PDF", roots["PDF"], 1).count() == 2
    assert PR.reprocess_modality(ws, spark, "PDF", roots["PDF"], 2).count() == 0


def test_a_bad_file_fails_alone_and_is_retried(spark, roots, tmp_path):
    ws = space(tmp_path)
    ws.max_attempts = 3
    drop(roots, 2, 1)
    bad = os.path.join(roots["TXT"], "latin.txt")
    with open(bad, "wb") as f:
        f.write("caf\u00e9 nurse\n".encode("latin-1"))
    status = {r["file_name"]: r["status"] for r in PR.process_new_files(ws, batch_of(spark, roots), 0).collect()}
    assert {f for f, s in status.items() if s == "LOAD_FAILED"} == {"latin.txt"}
    nothing = batch_of(spark, roots).limit(0)
    assert [r["status"] for r in PR.process_new_files(ws, nothing, 1).collect()] == ["LOAD_FAILED"]
    with open(bad, "w") as f:
        f.write("caf\u00e9 nurse\n")
    assert [(r["file_name"], r["status"]) for r in PR.process_new_files(ws, nothing, 2).collect()] == [("latin.txt", "LOADED")]
    assert PR.process_new_files(ws, nothing, 3).count() == 0
    assert {r["raw_text"] for r in PR.read_intelligence(ws, spark, "TXT").collect() if r["file_name"] == "latin.txt"} == {"caf\u00e9 nurse"}
    audit = PR.read_table(spark, ws.table("audit"), PR.AUDIT)
    history = L.load_history(audit, F.lit("2024-01-01 06:00:00").cast("timestamp_ntz"), n=3).collect()
    assert audit.count() == 9 and [r["file_name"] for r in history] == ["d1_0.ogg", "d1_0.pdf", "d1_0.txt"]


def test_a_file_that_fails_too_often_is_left_alone(spark, roots, tmp_path):
    ws = space(tmp_path)
    ws.max_attempts = 2
    with open(os.path.join(roots["TXT"], "bad.txt"), "wb") as f:
        f.write(b"\xff\xfe\xff")
    batch = batch_of(spark, roots)
    PR.process_new_files(ws, batch, 0)
    assert PR.process_new_files(ws, batch.limit(0), 1).count() == 1
    assert PR.process_new_files(ws, batch.limit(0), 2).count() == 0


def test_failing_files_are_found_by_halves(spark):
    files = spark.range(200).select((F.col("id") * 3 + 5).alias("file_id"))

    def load(some):
        return some.withColumn("x", F.when(F.col("file_id").isin(8, 11, 305), F.raise_error(F.lit("poison"))).otherwise("ok"))

    parts, blamed = PR.load_apart(load, files)
    assert sorted(i for i, _ in blamed) == [8, 11, 305] and all("poison" in e for _, e in blamed)
    got = [r["file_id"] for p in parts for r in p.collect()]
    assert len(got) == len(set(got)) == 197 and len(parts) < 40
    with pytest.raises(KeyError):
        PR.load_apart(lambda some: {}["nothing"], files)


def test_poison_and_malformed_files_fail_alone(spark, roots, tmp_path, monkeypatch):
    """A file that makes every job over it fail, and recordings that are no segments, among others."""
    ws = space(tmp_path)
    ws.embeddings = False
    for i in range(4):
        with open(f"{roots['TXT']}/t{i}.txt", "w") as f:
            f.write("POISON here\n" if i == 2 else f"The nurse saw the vitals of {i}.\n")
    for name, text in {"a.wav": json.dumps({"turn": 0, "role": "user", "text": "hello"}) + "\n\n", "b.wav": "no json\n", "c.wav": '{"turn": "x", "role": "user", "text": "t"}\n',
                       "d.wav": "\n", "e.wav": '{"role": "user", "text": "no turn"}\n'}.items():
        with open(f"{roots['AUDIO']}/{name}", "w") as f:
            f.write(text)
    enrich = PR.E.enrich_document

    def poisoned(docs, modality, *rest):
        if modality == "TXT":
            docs = docs.withColumn("text", F.when(F.contains("text", F.lit("POISON")), F.raise_error(F.lit("poison"))).otherwise(F.col("text")))
        return enrich(docs, modality, *rest)

    monkeypatch.setattr(PR.E, "enrich_document", poisoned)
    batch = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([roots["TXT"], roots["AUDIO"]]).select(
        F.when(F.endswith("path", F.lit(".txt")), "TXT").otherwise("AUDIO").alias("location"), LD.base_name(F.col("path")).alias("file_name"),
        F.col("path").alias("file_path"), F.col("modificationTime").alias("event_time"), "content")
    rows = PR.process_new_files(ws, batch, 0).collect()
    failed = {r["file_name"]: r for r in rows if r["status"] == "LOAD_FAILED"}
    assert set(failed) == {"t2.txt", "b.wav", "c.wav", "e.wav"} and all(r["own_fault"] and r["error"] for r in failed.values())
    assert len(rows) == 9 and "poison" in failed["t2.txt"]["error"] and failed["b.wav"]["error"].endswith(": 1")
    texts = PR.read_intelligence(ws, spark, "TXT")
    assert texts.count() == 3 and texts.filter(F.contains("raw_text", F.lit("POISON"))).count() == 0
    assert {r["file_name"]: r["n_segments"] for r in PR.read_intelligence(ws, spark, "AUDIO").collect()} == {"a.wav": 1, "d.wav": 1}
    monkeypatch.setattr(PR.E, "enrich_document", enrich)
    again = {r["file_name"]: r["status"] for r in PR.process_new_files(ws, batch.limit(0), 1).collect()}
    assert set(again) == set(failed) and {f for f, s in again.items() if s == "LOADED"} == {"t2.txt"} and PR.read_intelligence(ws, spark, "TXT").count() == 4


def test_a_fault_outside_the_files_uses_up_no_attempt(spark, roots, tmp_path):
    ws = space(tmp_path)
    ws.max_attempts = 1
    drop(roots, 2, 1)
    good = ws.vocabularies.pop("PDF")
    rows = PR.process_new_files(ws, batch_of(spark, roots), 0).collect()
    assert {r["own_fault"] for r in rows if r["status"] == "LOAD_FAILED"} == {False}
    ws.vocabularies["PDF"] = good
    assert [r["status"] for r in PR.process_new_files(ws, batch_of(spark, roots).limit(0), 1).collect()] == ["LOADED", "LOADED"]


def test_contents_are_read_once_and_modalities_run_side_by_side(spark, roots, tmp_path, monkeypatch):
    ws = space(tmp_path)
    drop(roots, 2, 1)
    files = batch_of(spark, roots).withColumn("file_id", F.xxhash64("file_path"))
    log = files.select("file_id", "file_name", "file_path", F.when(F.col("location") == "AUDIO", "WAV").otherwise(F.col("location")).alias("file_type"))
    reads, meet, enrich = spark.sparkContext.accumulator(0), threading.Barrier(3, timeout=60), PR.E.enrich_document

    @F.udf("binary")
    def counted(content):
        reads.add(1)
        return bytes(content)

    def together(*args):
        meet.wait()
        return enrich(*args)

    monkeypatch.setattr(PR.E, "enrich_document", together)
    PR.handle(ws, spark, log, files.select("file_path", counted("content").alias("content")), 0)
    audit = PR.read_table(spark, ws.table("audit"), PR.AUDIT)
    assert reads.value == 6 and audit.filter("status = 'LOADED' AND error IS NULL").count() == 6
    assert PR.read_table(spark, ws.table("ledger"), PR.LEDGER).count() == 6


def test_forced_rerun_leaves_one_current_row(spark, roots, tmp_path):
    ws = space(tmp_path)
    drop(roots, 3, 1)
    PR.process_new_files(ws, batch_of(spark, roots), 0)
    assert PR.reprocess_modality(ws, spark, "TXT", roots["TXT"], 7, force=True).count() == 3
    now = PR.read_intelligence(ws, spark, "TXT")
    assert now.count() == 3 and {r["batch_id"] for r in now.collect()} == {7}


def test_vectors_do_not_depend_on_the_batch(spark, roots, tmp_path):
    one, two = PR.Workspace(str(tmp_path / "a")), PR.Workspace(str(tmp_path / "b"))
    drop(roots, 4, 1)
    batch = batch_of(spark, roots)
    PR.process_new_files(one, batch, 0)
    first = F.col("file_name").rlike("_[01]\\.")
    PR.process_new_files(two, batch.filter(first), 0)
    PR.process_new_files(two, batch.filter(~first), 1)
    a, b = ({r["file_name"]: r["embedding"] for r in PR.read_intelligence(w, spark, "TXT").collect()} for w in (one, two))
    assert a == b and len(a) == 4 and all(len(v) == 768 for v in a.values())


def test_only_a_missing_table_counts_as_empty(spark, tmp_path):
    from pyspark.errors import AnalysisException
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "x.parquet").write_text("no parquet")
    assert PR.read_table(spark, str(tmp_path / "none"), PR.LOG).count() == 0
    with pytest.raises(Exception) as e:
        PR.read_table(spark, str(tmp_path / "broken")).count()
    assert not isinstance(e.value, AnalysisException) or e.value.getCondition() != "PATH_NOT_FOUND"


def test_windows_over_drops_equal_batch_and_late_rows_are_counted(spark, tmp_path):
    src, ck, out = str(tmp_path / "in"), str(tmp_path / "ck"), str(tmp_path / "out")
    ev = spark.range(600).select(F.timestamp_seconds(1704067200 + F.col("id") * 13).alias("event_time"), (F.col("id") % 3).alias("kind"))
    for i in range(3):
        ev.filter(F.floor(F.unix_timestamp("event_time") / 3000) % 3 == i).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)
    got = A.arrivals_windowed(stream, "kind", out, ck, delay="1 day", audit=str(tmp_path / "late"))
    assert [r["late_rows"] for r in spark.read.parquet(str(tmp_path / "late")).collect()] == [0]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, A.windowed_counts(ev, "kind").collect()))


def test_index_refresh_equals_rebuild(spark, tmp_path):
    d = spark.createDataFrame([(i, f"heart pain w{i % 9} x{i}") for i in range(60)], "id long, text string")
    src = str(tmp_path / "docs")
    d.repartition(3).write.parquet(src)
    stream = spark.readStream.schema(d.schema).option("maxFilesPerTrigger", 1).parquet(src)
    for _ in range(2):
        p = IR.refresh_index(stream, str(tmp_path / "post"), str(tmp_path / "ck"))
    a, b = IR.refreshed_index(p, with_vectors=True), R.build_index(d, with_vectors=True)
    ask = R.one_query(spark, "heart w3 x7")
    for search in (R.search_vector, R.search_hybrid):
        assert [sorted(map(tuple, search(i, ask, 60).collect())) for i in (a, b)][0] == sorted(map(tuple, search(b, ask, 60).collect()))
    assert sorted(map(tuple, a.postings.collect())) == sorted(map(tuple, b.postings.select("term", "id", "tf", "doc_len").collect()))
    assert (a.n_docs, a.total_len) == (b.n_docs, b.total_len)


def test_changed_and_deleted_documents_equal_a_rebuild(spark, tmp_path):
    """Thirteen batches: new texts, changed ones, deletions, ids that come back, a replay."""
    path, now = str(tmp_path / "index"), {}
    for b in range(13):
        rows = [(i, f"heart w{i % 5} b{b}", False) for i in range(b * 3, b * 3 + 6)] + [(1, None if b == 9 else f"pain in batch {b}", None), (b, "x", True)]
        if b % 4 == 2:
            rows = [r for r in rows if r[0] != b] + [(b, f"back again {b}", False)]
        df = spark.createDataFrame(rows, "id long, text string, deleted boolean")
        for _ in range(2 if b in (3, 7) else 1):  # these two are taken in twice, as after a crash
            IR.append_postings(df, b, path)
        gone = {r[0] for r in rows if r[2]}
        for i in {r[0] for r in rows}:
            now.pop(i, None)
            if i not in gone:
                now[i] = " ".join(r[1] or "" for r in rows if r[0] == i)
    levels = [r["level"] for r in IR.segments(spark, path)]
    assert levels == [1, 1, 1, 0]  # 13 batches in four segments
    rebuilt = R.postings_of(spark.createDataFrame(sorted(now.items()), "id long, text string"))
    got = IR.read_index(spark, path)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rebuilt.collect()))
    a, b = IR.refreshed_index(got), R.index_of(rebuilt)
    assert (a.n_docs, a.total_len) == (b.n_docs, b.total_len)
    for k in range(13, 16):
        IR.append_postings(spark.createDataFrame([(i, None, True) for i in range(0, 60)], "id long, text string, deleted boolean"), k, path)
    assert [r["level"] for r in IR.segments(spark, path)] == [2] and IR.read_index(spark, path).count() == 0
    assert spark.read.parquet(f"{path}/segment-15-2/documents").count() == 0  # nothing older is left that these deletions could meet


def test_reference_load_splits_bad_rows(spark, tmp_path):
    from pyspark.sql import types as T
    (tmp_path / "p.csv").write_text("id,name,active\n1,A,true\n2,B,\nx,C,true\n")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("active", T.BooleanType())])
    good, bad = LD.load_reference_table(spark, str(tmp_path / "p.csv"), schema, {"active": True})
    assert [tuple(r) for r in good.orderBy("id").collect()] == [(1, "A", True), (2, "B", True)]
    assert [r["raw"] for r in bad.collect()] == ["x,C,true"]


def test_cluster_folder_is_used(spark):
    assert fresh_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_rows_behind_the_watermark_are_counted(spark, tmp_path):
    src = str(tmp_path / "in")
    schema = "event_time timestamp, kind long"
    for hour in (1, 10, 11, 2):
        rows = spark.range(3).select(F.timestamp_seconds(1704067200 + hour * 3600 + F.col("id")).alias("event_time"), F.col("id").alias("kind"))
        rows.coalesce(1).write.mode("append").parquet(src)
    # Files are taken in the order they were written, one per batch.
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    counts = A.windowed_counts(stream.withWatermark("event_time", "1 hour"), "kind")
    q = (counts.writeStream.outputMode("update").format("noop").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert A.late_rows(q) == 3
