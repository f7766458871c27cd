"""Log, ledger, constraints and counts, bound to the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from clinisift.functions import text as X
from clinisift.operators import parse as P
from clinisift.plans import checks as C
from clinisift.sources import bindings as B
from clinisift.sources import filelog as L

from . import shared
from . import text_sql as T
from .insights import AUDIO_SEGMENTS
from .sql_parts import with_

QUERIES, SQL = {}, {}


def add(name, fn, sql=None):
    QUERIES[name] = fn
    if sql:
        SQL[name] = sql


FILES = """files AS (
  SELECT file_name, 'txt/' || file_name AS file_path, TIMESTAMP '2024-01-01' + to_seconds(id*60) AS event_time
  FROM (SELECT doc_id AS id, 'doc_' || doc_id || '.txt' AS file_name FROM documents)
  UNION ALL SELECT file_name, 'pdfs/' || file_name, TIMESTAMP '2024-01-01' + to_seconds(id*60)
  FROM (SELECT page_id AS id, 'page_' || page_id || '.pdf' AS file_name FROM pages)
  UNION ALL SELECT file_name, 'audio/' || file_name, TIMESTAMP '2024-01-01' + to_seconds(id*60)
  FROM (SELECT DISTINCT conv_id AS id, 'conv_' || conv_id || CASE WHEN conv_id % 5 < 2 THEN '.MP3' ELSE '.wav' END AS file_name
        FROM conversations))"""
TYPE = """CASE WHEN file_path LIKE 'pdfs/%' THEN 'PDF' WHEN file_path LIKE 'txt/%' THEN 'TXT'
  WHEN file_path ILIKE '%.mp3' THEN 'MP3' ELSE 'WAV' END"""
LOG = f"""log AS (SELECT row_number() OVER (ORDER BY event_time, file_path) AS file_id, file_name, file_path,
  {TYPE} AS file_type, event_time FROM files)"""
STATUS = """status AS (SELECT *, event_time < TIMESTAMP '2024-01-01 02:00:00' AS is_processed FROM log)"""


def log_sql(q):
    return with_(FILES, LOG, STATUS, q=q)


add("file_count_by_modality", lambda s, d: L.file_count_by_modality(B.landed_files(s, d)),
    log_sql("SELECT split_part(file_path,'/',1) AS location, count(*) AS file_count FROM files GROUP BY 1"))
add("route_modality",
    lambda s, d: B.landed_files(s, d).select("file_path", L.route_modality(F.col("file_path")).alias("file_type")),
    log_sql("SELECT file_path, file_type FROM log"))
add("append_files_log", lambda s, d: L.append_files_log(B.landed_files(s, d)), log_sql("SELECT * FROM log"))


def _with_ledger(fn):
    def run(s, d):
        log = shared.files_log(s, d)
        return fn(log, shared.first_ledger(log))
    return run


add("pending_files", _with_ledger(lambda log, led: L.pending_files(log, led, ["WAV", "MP3", "PDF"])),
    log_sql("SELECT * EXCLUDE (is_processed) FROM status WHERE NOT is_processed AND file_type <> 'TXT'"))
add("mark_processed", _with_ledger(lambda log, led: L.file_status(log, led)),
    log_sql("""SELECT *, CASE WHEN is_processed THEN CAST(1 AS BIGINT) END AS batch_id,
      CASE WHEN is_processed THEN TIMESTAMP '2024-01-01 02:00:00' END AS processed_at FROM status"""))
add("ingest_status", _with_ledger(lambda log, led: L.ingest_status(L.file_status(log, led))),
    log_sql("""SELECT file_type, count(*) AS total_files, CAST(sum(CASE WHEN is_processed THEN 1 ELSE 0 END) AS BIGINT) AS processed,
      CAST(sum(CASE WHEN is_processed THEN 0 ELSE 1 END) AS BIGINT) AS pending FROM status GROUP BY 1"""))
add("has_new_data", _with_ledger(lambda log, led: L.has_new_data(log, led, ["PDF", "TXT", "WAV", "MP3"])),
    log_sql("SELECT count(*) > 0 AS has_unprocessed_files FROM status WHERE NOT is_processed"))


def _backfill(s, d):
    """The log knows the text files only; the scan finds all files."""
    known = shared.files_log(s, d).filter(F.col("file_type") == "TXT")
    return L.backfill_refresh(B.landed_files(s, d), known)


add("backfill_refresh", _backfill,
    log_sql("""SELECT (SELECT max(file_id) FROM log WHERE file_type = 'TXT') + row_number() OVER (ORDER BY event_time, file_path) AS file_id,
      file_name, file_path, file_type, event_time FROM log WHERE file_type <> 'TXT'"""))


def _history(s, d):
    ev = B.table(s, d, "events")
    audit = ev.select(
        F.col("event_id").alias("batch_id"), F.col("event_type").alias("modality"),
        F.concat(F.lit("file_"), F.col("event_id")).alias("file_name"),
        F.when(F.col("event_type") == "error", "LOAD_FAILED").otherwise("LOADED").alias("status"),
        F.get_json_object("props", "$.k").cast("long").alias("row_count"), "ts")
    as_of = ev.agg(F.max("ts")).first()[0]
    return L.load_history(audit, F.lit(as_of))


add("load_history", _history,
    """SELECT event_id AS batch_id, event_type AS modality, 'file_' || event_id AS file_name,
      CASE WHEN event_type = 'error' THEN 'LOAD_FAILED' ELSE 'LOADED' END AS status,
      CAST(json_extract_string(props, '$.k') AS BIGINT) AS row_count, ts
      FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 24 HOURS ORDER BY ts DESC, file_name LIMIT 20""")
add("dedup_arrivals", lambda s, d: L.dedup_arrivals(B.texts(s, d, "documents"), F.col("text"), "doc_id"),
    """SELECT sha256(text) AS digest, CAST(length(text) AS BIGINT) AS n_chars, min(doc_id) AS doc_id, count(*) AS n_copies
      FROM documents GROUP BY text""")

COUNTED = ["customer", "supplier", "orders", "lineitem", "events", "documents", "pages", "conversations"]
add("table_row_counts", lambda s, d: L.table_row_counts({t: B.table(s, d, t) for t in COUNTED}),
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in COUNTED))


def _preview(s, d):
    """The first text as it is, the first page and recording as their parsed texts."""
    docs = B.table(s, d, "documents").select(F.col("doc_id").alias("id"), F.concat(F.lit("documents_"), "doc_id").alias("file_name"), "text")
    pages = B.table(s, d, "pages").select(F.col("page_id").alias("id"), F.concat(F.lit("pages_"), "page_id").alias("file_name"),
                                          X.markup_to_text(F.col("html")).alias("text"))
    talks = B.audio_segments(s, d)
    first = talks.join(talks.agg(F.min("id").alias("id")), "id")
    calls = P.assemble_transcript(first).select("id", "file_name", F.col("transcript_text").alias("text"))
    return L.preview_first({"TXT": (docs, 500), "PDF": (pages, 300), "AUDIO": (calls, 500)})


add("preview_first", _preview,
    with_(AUDIO_SEGMENTS, q=f"""(SELECT 'TXT' AS modality, 'documents_' || doc_id AS file_name, left(text, 500) AS preview FROM documents ORDER BY doc_id LIMIT 1)
      UNION ALL (SELECT 'PDF', 'pages_' || page_id, left({T.plain('html')}, 300) FROM pages ORDER BY page_id LIMIT 1)
      UNION ALL (SELECT 'AUDIO', file_name, left(string_agg(role || ': ' || text, chr(10) || chr(10) ORDER BY turn, role, text), 500)
        FROM audio_segments WHERE id = (SELECT min(id) FROM audio_segments) GROUP BY 2)"""))

RULES = {
    "region": {"primary_key": ["r_regionkey"], "not_null": ["r_name"]},
    "nation": {"primary_key": ["n_nationkey"], "foreign_keys": {"n_regionkey": ("region", "r_regionkey")}},
    "customer": {"primary_key": ["c_custkey"], "not_null": ["c_name", "c_mktsegment"], "max_length": {"c_name": 100},
                 "foreign_keys": {"c_nationkey": ("nation", "n_nationkey")}},
    "supplier": {"primary_key": ["s_suppkey"], "not_null": ["s_name"], "foreign_keys": {"s_nationkey": ("nation", "n_nationkey")}},
    "orders": {"primary_key": ["o_orderkey"], "domain": {"o_orderstatus": ["F", "O"]},
               "foreign_keys": {"o_custkey": ("customer", "c_custkey")}},
    "lineitem": {"primary_key": ["l_orderkey", "l_linenumber"], "not_null": ["l_shipdate", "l_suppkey"],
                 "foreign_keys": {"l_orderkey": ("orders", "o_orderkey"), "l_suppkey": ("supplier", "s_suppkey"),
                                  "l_partkey": ("part", "p_partkey")}},
    "part": {"primary_key": ["p_partkey"], "not_null": ["p_name"]},
    "events": {"primary_key": ["event_id"], "not_null": ["ts"], "domain": {"event_type": ["click", "view", "purchase", "signup"]},
               "foreign_keys": {"user_id": ("customer", "c_custkey")}},
    "documents": {"primary_key": ["doc_id"], "not_null": ["text"], "max_length": {"text": 10000}},
    "labels": {"foreign_keys": {"doc_id": ("documents", "doc_id")}},
}


def _rules_sql():
    out = []
    for t, r in RULES.items():
        row = lambda rule, q: out.append(f"SELECT '{t}' AS table_name, '{rule}' AS rule, ({q}) AS n_violations")
        for c in r.get("not_null", []):
            row(f"not_null({c})", f"SELECT count(*) FROM {t} WHERE {c} IS NULL")
        for c, n in r.get("max_length", {}).items():
            row(f"max_length({c},{n})", f"SELECT count(*) FROM {t} WHERE length({c}) > {n}")
        for c, v in r.get("domain", {}).items():
            row(f"domain({c})", f"SELECT count(*) FROM {t} WHERE {c} NOT IN ({', '.join(repr(x) for x in v)})")
        if "primary_key" in r:
            k = ", ".join(r["primary_key"])
            row(f"primary_key({','.join(r['primary_key'])})",
                f"SELECT count(*) FROM (SELECT {k} FROM {t} GROUP BY {k} HAVING count(*) > 1)")
        for c, (p, pc) in r.get("foreign_keys", {}).items():
            row(f"foreign_key({c}->{p}.{pc})", f"SELECT count(*) FROM {t} WHERE {c} NOT IN (SELECT {pc} FROM {p})")
    return " UNION ALL ".join(out)


add("check_constraints",
    lambda s, d: C.check_constraints({t: B.table(s, d, t) for t in RULES}, RULES), _rules_sql())
add("check_embedding", lambda s, d: C.check_embedding(B.table(s, d, "embeddings"), "vec_id", "embedding"),
    """SELECT vec_id, embedding IS NOT NULL AS has_embedding, CAST(len(embedding) AS BIGINT) AS dim,
      floor(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) * 10000 + 0.5) / 10000 AS norm
      FROM embeddings""")
add("path_extract",
    lambda s, d: B.table(s, d, "events").select(
        "event_id", F.get_json_object("props", "$.k").cast("long").alias("k"),
        F.get_json_object("props", "$.missing").cast("double").alias("missing"),
        F.try_variant_get(F.parse_json("props"), "$.k", "long").alias("k_variant")),
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
      CAST(json_extract_string(props, '$.missing') AS DOUBLE) AS missing,
      CAST(json_extract_string(props, '$.k') AS BIGINT) AS k_variant FROM events""")
