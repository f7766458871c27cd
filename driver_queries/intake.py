"""Landing folders and streams, fed with files Spark writes from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinisift.session import fresh_path
from clinisift.sources import bindings as B
from clinisift.sources import filelog as L
from clinisift.sources import landing as LD
from clinisift.streaming import arrivals as A
from clinisift.streaming import index_refresh as IR
from clinisift.streaming import processing as PR

from . import shared
from .enrichment import DOCS, TOK, TXT_FILES
from .insights import AUDIO_SEGMENTS, PDF_FILES, intel
from .sql_parts import star, with_

QUERIES, SQL = {}, {}


def add(name, fn, sql=None):
    QUERIES[name] = fn
    if sql:
        SQL[name] = sql


_ROOTS: dict[tuple, dict[str, str]] = {}


def landing(s, d) -> dict[str, str]:
    """Landing folders holding every text, page and conversation as a file."""
    key = (s.sparkContext.applicationId, d)
    if key not in _ROOTS:
        root = fresh_path(s, "landing")
        roots = {"PDF": f"{root}/pdfs", "TXT": f"{root}/txt", "AUDIO": f"{root}/audio"}
        LD.export_files(B.pdf_files(s, d).withColumnRenamed("html", "value"), roots["PDF"])
        LD.export_files(B.txt_files(s, d).withColumnRenamed("text", "value"), roots["TXT"])
        seg = B.audio_segments(s, d).select("file_name", "turn", F.to_json(F.struct("turn", "role", "text")).alias("value"))
        LD.export_files(seg, roots["AUDIO"], ("turn",))
        _ROOTS[key] = roots
    return _ROOTS[key]


# Every line of a text file ends in a line feed; recordings are one JSON line per segment.
LANDED = with_(TXT_FILES, PDF_FILES, AUDIO_SEGMENTS, """landed AS (
  SELECT 'TXT' AS location, file_name, octet_length(encode(text)) + 1 AS length FROM txt_files
  UNION ALL SELECT 'PDF', file_name, octet_length(encode(html)) + 1 FROM pdf_files
  UNION ALL SELECT 'AUDIO', file_name, CAST(sum(octet_length(encode(to_json({'turn': turn, 'role': role, 'text': text}))) + 1) AS BIGINT)
  FROM audio_segments GROUP BY 1, 2)""", q="{q}")


def landed(q: str) -> str:
    return LANDED.replace("{q}", q)


add("scan_landing_files", lambda s, d: LD.scan_landing_files(s, landing(s, d)).select("location", "file_name", "length"),
    landed("SELECT location, file_name, length FROM landed"))
add("list_directory",
    lambda s, d: LD.list_directory(s, landing(s, d)).select(
        "location", "length", F.split_part("relative_path", F.lit("/"), F.lit(1)).alias("relative_folder")),
    landed("SELECT location, length, 'file_name=' || file_name AS relative_folder FROM landed"))


def _whole(s, d):
    roots = landing(s, d)
    t = LD.read_whole_text(s, {"TXT": roots["TXT"], "PDF": roots["PDF"]})
    return t.select("location", "file_name", F.md5("text").alias("text_md5"))


add("read_whole_text", _whole,
    with_(TXT_FILES, PDF_FILES, q="""SELECT 'TXT' AS location, file_name, md5(text || chr(10)) AS text_md5 FROM txt_files
      UNION ALL SELECT 'PDF', file_name, md5(html || chr(10)) FROM pdf_files"""))


def _arrivals(s, d):
    """Runs the arrival stream twice on one checkpoint: the second run finds nothing new."""
    out, ck = fresh_path(s, "arrived"), fresh_path(s, "ck")
    stream = A.arrivals_stream(s, landing(s, d))  # each run lists the folders anew
    for _ in range(2):
        A.run_to_end(stream, out, ck)
    return s.read.parquet(out).select("location", "file_name", "length")


add("arrivals_stream", _arrivals, landed("SELECT location, file_name, length FROM landed"))


def _dedup_stream(s, d):
    """The same files announced twice give one row each."""
    out, ck = fresh_path(s, "arrived"), fresh_path(s, "ck")
    roots = landing(s, d)
    twice = A.arrivals_stream(s, roots).unionByName(A.arrivals_stream(s, roots))
    A.run_to_end(A.dedup_stream(twice), out, ck)
    return s.read.parquet(out).select("location", "file_name", "length")


add("dedup_arrivals_stream", _dedup_stream, landed("SELECT location, file_name, length FROM landed"))


def _windowed(s, d):
    ev = B.table(s, d, "events")
    stream = s.readStream.schema(ev.schema).option("pathGlobFilter", "events.parquet").parquet(d)
    stream = stream.select(F.col("ts").cast("timestamp").alias("event_time"), "event_type")
    t = A.arrivals_windowed(stream, "event_type", fresh_path(s, "windows"), fresh_path(s, "ck"))
    return t.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n")


add("arrivals_windowed", _windowed,
    "SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")

_WS: dict[tuple, PR.Workspace] = {}


def workspace(s, d) -> PR.Workspace:
    """Tables of an intake that has taken in all landed files."""
    key = (s.sparkContext.applicationId, d)
    if key not in _WS:
        ws = PR.Workspace(fresh_path(s, "intake"), {m: shared.vocabulary(m) for m in PR.TYPES},
                          lambda: F.lit(shared.PROCESSED_AT).cast("timestamp"))
        PR.run_intake(ws, A.arrivals_stream(s, landing(s, d), content=True), fresh_path(s, "ck"))
        _WS[key] = ws
    return _WS[key]


def _processed(s, d):
    return PR.read_table(s, workspace(s, d).table("audit"), PR.AUDIT).filter("batch_id < 1000000").groupBy("modality", "status").agg(F.sum("row_count").alias("row_count"))


add("process_new_files", _processed, landed("SELECT location AS modality, 'LOADED' AS status, count(*) AS row_count FROM landed GROUP BY 1"))


def _written(s, d):
    """Rows the intake wrote, by file."""
    t = PR.read_intelligence(workspace(s, d), s, "TXT")
    return t.select("file_name", F.md5("raw_text").alias("text_md5"), "doc_category", "summary", "detected_language", "redacted_text")


add("write_intelligence", _written,
    with_(*intel("TXT"), q="""SELECT file_name, md5(text) AS text_md5, category AS doc_category, summary, language AS detected_language, redacted_text FROM intel_txt"""))


def _reprocess(s, d):
    """The recordings once more: the rows of the new batch are the ones readers see, once each."""
    PR.reprocess_modality(workspace(s, d), s, "AUDIO", landing(s, d)["AUDIO"], 1_000_000, force=True)
    return PR.read_intelligence(workspace(s, d), s, "AUDIO").select("file_name", "summary", F.md5("transcript_text").alias("text_md5"), "batch_id")


add("reprocess_modality", _reprocess,
    with_(*intel("AUDIO"), q="SELECT file_name, summary, md5(text) AS text_md5, CAST(1000000 AS BIGINT) AS batch_id FROM intel_audio"))


def _history(s, d):
    """The newest attempts in the audit of the intake."""
    a = PR.read_table(s, workspace(s, d).table("audit"), PR.AUDIT).filter("batch_id < 1000000")
    h = L.load_history(a, F.lit("2024-02-01 12:00:00").cast("timestamp_ntz"), 24, 20)
    return h.select("file_name", "modality", "status", "row_count", "error")


add("load_history_of_intake", _history,
    landed("""SELECT file_name, location AS modality, 'LOADED' AS status, CAST(1 AS BIGINT) AS row_count, CAST(NULL AS VARCHAR) AS error
      FROM landed ORDER BY file_name LIMIT 20"""))


def _refresh(s, d):
    """The documents arrive in four drops; the index grows by each."""
    drops = fresh_path(s, "drops")
    docs = B.table(s, d, "documents").select(F.col("doc_id").alias("id"), "text")
    docs.repartition(4).write.parquet(drops)
    stream = s.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(drops)
    return IR.refresh_index(stream, fresh_path(s, "postings"), fresh_path(s, "ck"))


add("refresh_index", _refresh,
    with_(DOCS, TOK, q="""SELECT term, id, tf, CAST(sum(tf) OVER (PARTITION BY id) AS BIGINT) AS doc_len FROM (
      SELECT term, id, count(*) AS tf FROM docs_tok WHERE term <> '' GROUP BY 1, 2)"""))


def _reference(s, d):
    """Customers through a typed CSV load; an empty segment takes the default."""
    src = B.table(s, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal",
                                           F.when(F.col("c_mktsegment") == "MACHINERY", None).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    path = fresh_path(s, "customers-csv")
    src.write.option("header", "true").csv(path)
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
                           T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
                           T.StructField("c_mktsegment", T.StringType())])
    good, _ = LD.load_reference_table(s, path, schema, {"c_mktsegment": "UNKNOWN"})
    return good


add("load_reference_tables", _reference,
    """SELECT c_custkey, c_name, c_nationkey, c_acctbal, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'UNKNOWN' ELSE c_mktsegment END AS c_mktsegment FROM customer""")


# Per reference table: the column whose empty cells take a default, the key, the default.
DEFAULTS = {
    "patients": ("registered_date", "patient_id", None),
    "providers": ("is_active", "provider_id", True),
    "appointments": ("has_audio_recording", "appointment_id", False),
    "claims": ("denial_reason", "claim_id", None),
}


def _load(name):
    def run(s, d):
        """The table through typed CSV files in which every seventh row leaves a column to its default."""
        src = {"patients": B.patients, "providers": B.providers, "appointments": B.appointments,
               "claims": lambda s, d: B.claims(s, d, diagnosis=True)}[name](s, d)
        column, key, default = DEFAULTS[name]
        path = fresh_path(s, f"{name}-csv")
        if default is not None:
            src = src.withColumn(column, F.when(F.col(key) % 7 == 0, None).otherwise(F.col(column)))
        src.write.option("header", "true").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)
        good, _ = LD.load_reference_table(s, path, src.schema, {column: default} if default is not None else None)
        return good
    return run


for _name, (_column, _key, _default) in DEFAULTS.items():
    _pick = f"* REPLACE (CASE WHEN {_key} % 7 = 0 THEN {_default} ELSE {_column} END AS {_column})" if _default is not None else "*"
    if _name == "providers":  # the star schema calls the place of a provider by longer names
        _pick = _pick.replace("*", "* EXCLUDE (provider_city, provider_state)", 1) + ", provider_city AS city, provider_state AS state"
    add(f"load_reference_{_name}", _load(_name), star(f"SELECT {_pick} FROM {_name}"))
