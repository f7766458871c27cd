"""Enriched tables, the views and corpora over them, questions across modalities, checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinisift.functions import lexicons as LX
from clinisift.functions import redaction as RD
from clinisift.functions.numbers import rounded
from clinisift.operators import linking as K
from clinisift.operators import parse as P
from clinisift.operators import retrieval as R
from clinisift.operators import summary as S
from clinisift.plans import checks as C
from clinisift.plans import questions as Q
from clinisift.plans import views as VW
from clinisift.sources import bindings as B

from . import shared
from . import text_sql as T
from . import vocabulary as V
from .enrichment import TXT_FILES, soap_sql
from .search import lexical_ctes, ranked
from .sql_parts import STAR, rnd, values, with_

QUERIES, SQL = {}, {}
MODALITIES = ["PDF", "TXT", "AUDIO"]


def add(name, fn, sql=None):
    QUERIES[name] = fn
    if sql:
        SQL[name] = sql


# ---------------------------------------------------------------- SQL of the enriched tables

_COND = "(['hypertension','diabetes','asthma','migraine','fracture'])"
_HEAD = "'Customer#' || lpad(CAST({i} % 150 AS VARCHAR), 9, '0')"
PDF_FILES = f"""pdf_files AS (SELECT page_id AS id, 'page_' || page_id || '.pdf' AS file_name,
  '<p>Patient Name: ' || {_HEAD.format(i='page_id')} || '</p><p>Provider: Supplier#' || lpad(CAST(page_id % 10 AS VARCHAR), 9, '0')
  || '</p><p>Diagnosis: ' || {_COND}[page_id % 5 + 1] || '</p><p></p>' || html AS html FROM pages)"""
AUDIO_SEGMENTS = f"""audio_segments AS (SELECT conv_id AS id, 'conv_' || conv_id || CASE WHEN conv_id % 5 < 2 THEN '.MP3' ELSE '.wav' END AS file_name,
  turn, role, CASE WHEN turn = 0 THEN 'Patient Name: ' || {_HEAD.format(i='conv_id')} || chr(10) || 'Chief Complaint: '
  || {_COND}[conv_id % 5 + 1] || chr(10) || text ELSE text END AS text FROM conversations)"""


def intel(m: str) -> list[str]:
    """CTEs ending in intel_<m>(id, file_name, text, fields, labels, scores, summary, notes, ...)."""
    p = m.lower()
    audio = m == "AUDIO"
    if m == "PDF":
        src = [PDF_FILES, f"src_pdf AS MATERIALIZED (SELECT id, file_name, {T.plain('html')} AS text, true AS has_layout FROM pdf_files)"]
    elif m == "TXT":
        src = [TXT_FILES, "src_txt AS MATERIALIZED (SELECT id, file_name, text, false AS has_layout FROM txt_files)"]
    else:
        src = [AUDIO_SEGMENTS, f"""src_audio AS MATERIALIZED (SELECT id, file_name, false AS has_layout,
          string_agg(role || ': ' || text, chr(10) || chr(10) ORDER BY turn, role, text) AS text, count(DISTINCT role) AS speaker_count,
          {rnd(f"CAST(sum({T.n_tokens('text')}) AS DOUBLE) / CAST(2.5 AS DOUBLE)", 3)} AS audio_duration_secs FROM audio_segments GROUP BY 1, 2)"""]
    dims = LX.CONSULTATION_DIMENSIONS if audio else LX.DOCUMENT_DIMENSIONS
    fields = T.fields("x.text", P.CONSULTATION_FIELDS if audio else P.DOCUMENT_FIELDS)
    extra = ", x.speaker_count, x.audio_duration_secs, nt.consultation_notes AS notes, CAST(NULL AS VARCHAR) AS redacted_text" if audio else (
        f", {T.insights('sm.summary', 'x.text', V.URGENT, V.FOLLOW_UP)} AS notes, {T.redacted('x.text')} AS redacted_text")
    s = f"src_{p}"
    return [
        *src, T.tok(s),
        *T.best_label(s, f"{p}_c", V.CONSULTATION_TERMS if audio else V.DOCUMENT_TERMS),
        *T.balances(s, f"{p}_b", {"sentiment_score": (V.POLARITY[1], V.POLARITY[-1]), **{k: V.ASPECTS[k] for k in dims}}),
        *T.language(s, f"{p}_g"), *T.top_sentences(s, f"{p}_m"),
        *([x.replace("soap_", "asoap_") for x in soap_sql("audio_segments")] if audio else []),
        f"""intel_{p} AS MATERIALIZED (SELECT x.id, x.file_name, x.text, x.has_layout, {', '.join(f'{e} AS {n}' for n, e in fields.items())},
          c.category, coalesce(c.confidence, 0.0::DOUBLE) AS confidence, sentiment_score, {', '.join(dims)}, sm.summary, g.language,
          {T.translated('x.text', 'g.language')} AS translated_text {extra}
          FROM {s} x LEFT JOIN {p}_c c ON x.id = c.id LEFT JOIN {p}_b b ON x.id = b.id LEFT JOIN {p}_g g ON x.id = g.id
          LEFT JOIN {p}_m sm ON x.id = sm.id {'LEFT JOIN soap nt ON x.id = nt.id' if audio else ''})""",
    ]


ALL_INTEL = [*intel("PDF"), *intel("TXT"), *intel("AUDIO")]
AT = "TIMESTAMP '2024-02-01 00:00:00'"


def views_sql() -> list[str]:
    out = []
    for p, rec in (("pdf", "doc_id"), ("txt", "txt_id")):
        out.append(f"""{p}_metrics AS (SELECT id AS {rec}, id AS file_id, file_name, {AT} AS processed_at, category AS doc_category, confidence AS doc_category_confidence,
          sentiment_score, urgency AS urgency_score, clinical_concern AS clinical_concern_score, patient_satisfaction AS patient_satisfaction_score,
          patient_name, provider_name, facility_name, document_date, diagnosis, insurance_id, total_amount AS billed_amount,
          len(medications) AS medication_count, len(procedures) AS procedure_count, len(follow_up_actions) AS follow_up_count,
          language AS detected_language, translated_text IS NOT NULL AS was_translated, summary, notes AS key_insights FROM intel_{p})""")
    out.append(f"""audio_metrics AS (SELECT id AS audio_id, id AS file_id, file_name, {AT} AS processed_at, audio_duration_secs,
      {rnd('audio_duration_secs / 60.0::DOUBLE', 1)} AS duration_minutes, speaker_count, category AS call_category, confidence AS call_category_confidence,
      sentiment_score, empathy AS empathy_score, clinical_clarity AS clinical_clarity_score, patient_anxiety AS patient_anxiety_score,
      resolution AS resolution_score, patient_name, provider_name, chief_complaint, diagnosis_discussed,
      len(medications_discussed) AS medications_mentioned, len(follow_up_actions) AS action_item_count, next_appointment,
      language AS detected_language, translated_text IS NOT NULL AS was_translated, summary, notes AS consultation_notes FROM intel_audio)""")
    docs = " UNION ALL ".join(
        f"""SELECT '{p.upper()}' AS source_type, {rec} AS record_id, file_name, processed_at, doc_category AS category, sentiment_score, patient_name, provider_name,
        diagnosis AS primary_finding, detected_language, was_translated, summary, medication_count, follow_up_count AS action_item_count,
        CAST(NULL AS DOUBLE) AS duration_minutes, CAST(NULL AS BIGINT) AS speaker_count FROM {p}_metrics"""
        for p, rec in (("pdf", "doc_id"), ("txt", "txt_id")))
    out.append(f"""insights AS MATERIALIZED ({docs} UNION ALL SELECT 'AUDIO', audio_id, file_name, processed_at, call_category, sentiment_score, patient_name, provider_name,
        chief_complaint, detected_language, was_translated, summary, medications_mentioned, action_item_count, duration_minutes, speaker_count FROM audio_metrics)""")
    return out


VIEWS = views_sql()


def isql(q, *extra):
    return with_(*ALL_INTEL, *VIEWS, *extra, q=q)


# ---------------------------------------------------------------- Spark side


def pdf_m(s, d):
    return VW.document_metrics(shared.intelligence(s, d, "PDF"), "doc_id")


def txt_m(s, d):
    return VW.document_metrics(shared.intelligence(s, d, "TXT"), "txt_id")


def audio_m(s, d):
    return VW.audio_metrics(shared.intelligence(s, d, "AUDIO"))


def insights(s, d):
    return VW.combined_insights(pdf_m(s, d), txt_m(s, d), audio_m(s, d))


def quality(s, d, modalities=MODALITIES):
    parts = [VW.quality_rows(shared.intelligence(s, d, m), m) for m in modalities]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


FLAT = ["id", "file_name", "category", "confidence", "sentiment_score", "summary", "language", "translated_text", "notes", "patient_name", "provider_name"]


def _flat(m):
    def run(s, d):
        q = VW.quality_rows(shared.intelligence(s, d, m), m).withColumnRenamed("record_id", "id")
        dims = LX.CONSULTATION_DIMENSIONS if m == "AUDIO" else LX.DOCUMENT_DIMENSIONS
        v = F.col("embedding")
        return q.select(*FLAT, *dims, "redacted_text", F.md5("text").alias("text_md5"),
                        F.size(F.filter(v, lambda x: x > 0)).cast("long").alias("n_buckets"), rounded(F.array_max(v).cast("double"), 4).alias("largest"))
    return run


for _m in MODALITIES:
    _dims = LX.CONSULTATION_DIMENSIONS if _m == "AUDIO" else LX.DOCUMENT_DIMENSIONS
    add(f"enrich_document_{_m.lower()}", _flat(_m),
        with_(*intel(_m), f"""bk AS (SELECT id, bucket, sum(n) AS n FROM (SELECT id, CAST(('0x' || left(md5(term), 8)) AS BIGINT) % 768 AS bucket, count(*) AS n
            FROM src_{_m.lower()}_tok WHERE term <> '' GROUP BY 1, 2) GROUP BY 1, 2)""",
              f"vec AS (SELECT id, count(*) AS n_buckets, {rnd('CAST(CAST(max(n) / sqrt(sum(n * n)) AS FLOAT) AS DOUBLE)', 4)} AS largest FROM bk GROUP BY 1)",
              q=f"SELECT {', '.join(FLAT + _dims)}, redacted_text, md5(text) AS text_md5, coalesce(n_buckets, -1) AS n_buckets, largest FROM intel_{_m.lower()} LEFT JOIN vec USING (id)"))

add("pdf_metrics", pdf_m, isql("SELECT * FROM pdf_metrics"))
add("txt_metrics", txt_m, isql("SELECT * FROM txt_metrics"))
add("audio_metrics", audio_m, isql("SELECT * FROM audio_metrics"))
add("combined_insights", insights, isql("SELECT * FROM insights"))
add("presence_flags",
    lambda s, d: insights(s, d).groupBy("source_type").agg(
        *[F.count(F.when(VW.presence_flag(c), 1)).alias(f"has_{c}") for c in ("summary", "primary_finding", "medication_count", "duration_minutes")]),
    isql("""SELECT source_type, count(summary) AS has_summary, count(primary_finding) AS has_primary_finding,
      count(medication_count) AS has_medication_count, count(duration_minutes) AS has_duration_minutes FROM insights GROUP BY 1"""))


def _array_counts(s, d):
    """Sizes of the arrays of extracted fields, NULL where nothing was found."""
    from .enrichment import RAW_FIELDS, docs
    out = P.extract_fields(docs(s, d), RAW_FIELDS)
    return out.select("id", VW.array_count("ip_addresses").alias("n_ips"), VW.array_count("license_lines").alias("n_license_lines"))


def _array_sql():
    from .enrichment import RAW_FIELDS
    e = {n: T.all_fields("text", p, 0) for n, _, p, _ in RAW_FIELDS}
    return f"SELECT doc_id AS id, len({e['ip_addresses']}) AS n_ips, len({e['license_lines']}) AS n_license_lines FROM documents"


add("array_count", _array_counts, _array_sql())

# ---------------------------------------------------------------- corpora and federated search


def corpus(s, d, m):
    return VW.search_corpus(shared.intelligence(s, d, m), m)


def corpus_sql(m: str) -> str:
    p = m.lower()
    tail = ("'CONSULTATION NOTES: ' || coalesce(notes, '') || chr(10) || chr(10) || 'CHIEF COMPLAINT: ' || coalesce(chief_complaint, '')" if m == "AUDIO"
            else "'INSIGHTS: ' || coalesce(notes, '') || chr(10) || chr(10) || 'DIAGNOSIS: ' || coalesce(diagnosis, '')")
    return f"""corpus_{p} AS MATERIALIZED (SELECT id, file_name, coalesce(text, '') || chr(10) || chr(10) || 'SUMMARY: ' || coalesce(summary, '') || chr(10) || chr(10)
      || {tail} AS search_text, category AS {CATEGORY[m]}, coalesce(patient_name, 'Unknown') AS patient_name, coalesce(provider_name, 'Unknown') AS provider_name,
      coalesce({FINDING[m]}, '') AS {FINDING[m]}, {"audio_duration_secs AS duration_secs, speaker_count," if m == "AUDIO" else ""}
      language AS detected_language, sentiment_score, {AT} AS processed_at FROM intel_{p})"""


CATEGORY = {"PDF": "doc_category", "TXT": "doc_category", "AUDIO": "call_category"}
FINDING = {"PDF": "diagnosis", "TXT": "diagnosis", "AUDIO": "chief_complaint"}
for _m in MODALITIES:
    add(f"search_corpus_{_m.lower()}",
        lambda s, d, m=_m: corpus(s, d, m).withColumn("text_md5", F.md5("search_text")).drop("search_text"),
        with_(*intel(_m), corpus_sql(_m), q=f"SELECT * EXCLUDE (search_text), md5(search_text) AS text_md5 FROM corpus_{_m.lower()}"))

QUESTION = "diabetes hypertension " + V.QUESTION
_INDEXES: dict[tuple, dict] = {}


def indexes(s, d):
    key = (s.sparkContext.applicationId, d)
    if key not in _INDEXES:
        _INDEXES[key] = {m: R.build_index(corpus(s, d, m), "id", "search_text", with_vectors=True) for m in MODALITIES}
    return _INDEXES[key]


_FED = [x for m in MODALITIES for x in (
    f"ct_{m.lower()}_tok AS (SELECT id, unnest({T.tokens('search_text')}) AS term FROM corpus_{m.lower()})",
    *lexical_ctes(f"ct_{m.lower()}", f"fx_{m.lower()}", "qs"))]
add("search_federated", lambda s, d: R.search_federated(indexes(s, d), R.one_query(s, QUESTION), 5),
    with_(*ALL_INTEL, *[corpus_sql(m) for m in MODALITIES], values([(0, QUESTION)], "query_id, query", "qs"), *_FED,
          q="SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, source_type, id) AS overall_rank FROM ("
            + " UNION ALL ".join(f"SELECT '{m}' AS source_type, * FROM ({ranked('fx_' + m.lower(), 5)})" for m in MODALITIES) + ")"))

TOOLS = {"analyst": "the of and to", "pdf_search": "der die und das", "txt_search": "le la et les", "audio_search": "el los del y"}


def _route(s, d):
    """Routes every benchmark text; the tool words are function words of the given texts."""
    q = B.table(s, d, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    return R.route_question(q, TOOLS)


add("route_question", _route, with_(
    values([(t, w) for t, ws in TOOLS.items() for w in ws.split()], "tool, term", "tools"),
    f"qt AS (SELECT item_id AS query_id, unnest({T.tokens('text')}) AS term FROM benchmark)",
    "h AS (SELECT query_id, tool, count(*) AS n FROM qt JOIN tools USING (term) GROUP BY 1, 2)",
    q="""SELECT query_id, tool FROM (SELECT *, n / sum(n) OVER (PARTITION BY query_id) AS share FROM h) WHERE share >= 0.25
      UNION ALL SELECT item_id, t FROM benchmark, (SELECT unnest(['pdf_search','txt_search','audio_search']) AS t)
      WHERE item_id NOT IN (SELECT query_id FROM h)"""))

# ---------------------------------------------------------------- reports and questions

add("enrichment_overview", lambda s, d: VW.enrichment_overview(insights(s, d)),
    isql("SELECT source_type, record_id, file_name, category, detected_language, processed_at FROM insights"))


def _coverage(s, d):
    return VW.function_coverage({"PDF": pdf_m(s, d), "TXT": txt_m(s, d), "AUDIO": audio_m(s, d)})


def _coverage_sql():
    sample = {"pdf": "doc_id doc_category doc_category_confidence sentiment_score urgency_score clinical_concern_score patient_satisfaction_score patient_name provider_name facility_name document_date diagnosis insurance_id billed_amount medication_count procedure_count follow_up_count detected_language was_translated summary key_insights",
              "audio": "audio_id audio_duration_secs duration_minutes speaker_count call_category call_category_confidence sentiment_score empathy_score clinical_clarity_score patient_anxiety_score resolution_score patient_name provider_name chief_complaint diagnosis_discussed medications_mentioned action_item_count next_appointment detected_language was_translated summary consultation_notes"}
    sample["txt"] = sample["pdf"].replace("doc_id", "txt_id")
    return " UNION ALL ".join(f"SELECT '{p.upper()}' AS modality, '{c}' AS measure, count(*) AS n_rows, count({c}) AS n_filled FROM {p}_metrics"
                              for p, cs in sample.items() for c in cs.split())


add("function_coverage", _coverage, isql(_coverage_sql()))
add("common_findings", lambda s, d: Q.common_findings(insights(s, d)),
    isql("""SELECT primary_finding, count(*) AS n_records FROM insights WHERE primary_finding IS NOT NULL GROUP BY 1
      ORDER BY n_records DESC, primary_finding LIMIT 10"""))
def has(text, terms):
    return f"regexp_matches(' ' || {T.toktext(text)} || ' ', ' ({'|'.join(terms)}) ')"


ANY = ["diabetes", "hypertension"]
add("docs_mentioning_any", lambda s, d: Q.docs_mentioning_any(corpus(s, d, "PDF"), ANY),
    with_(*intel("PDF"), corpus_sql("PDF"), q=f"SELECT id, file_name, doc_category, patient_name, diagnosis FROM corpus_pdf WHERE {has('search_text', ANY)}"))
ABNORMAL = ["ononst", "thatin", "inoran", "fracture"]
DOCUMENTS = ["PDF", "TXT"]
add("category_with_abnormal",
    lambda s, d: reduce(DataFrame.unionByName, [
        Q.category_with_terms(corpus(s, d, m), "Radiology Report", ABNORMAL).withColumn("source_type", F.lit(m)) for m in DOCUMENTS]),
    with_(*intel("PDF"), *intel("TXT"), *[corpus_sql(m) for m in DOCUMENTS], q=" UNION ALL ".join(
        f"""SELECT id, file_name, doc_category, patient_name, diagnosis, '{m}' AS source_type FROM corpus_{m.lower()}
        WHERE doc_category = 'Radiology Report' AND {has('search_text', ABNORMAL)}""" for m in DOCUMENTS)))
add("mentions_in_audio", lambda s, d: Q.mentions_in_audio(B.audio_segments(s, d), ["thatin", "hehely", "orantion", "asthma"]),
    with_(AUDIO_SEGMENTS, q=f"SELECT id AS audio_id, file_name, turn, role, text FROM audio_segments WHERE {has('text', ['thatin', 'hehely', 'orantion', 'asthma'])}"))
add("insights_by_category",
    lambda s, d: reduce(DataFrame.unionByName, [
        Q.insights_by_category(v(s, d), "Discharge Summary", i).withColumnRenamed(i, "record_id").withColumn("source_type", F.lit(m))
        for m, v, i in (("PDF", pdf_m, "doc_id"), ("TXT", txt_m, "txt_id"))]),
    with_(*intel("PDF"), *intel("TXT"), q=" UNION ALL ".join(
        f"SELECT id AS record_id, file_name, patient_name, notes AS key_insights, '{m}' AS source_type FROM intel_{m.lower()} WHERE category = 'Discharge Summary'"
        for m in DOCUMENTS)))
add("cohort_topic_visits", lambda s, d: Q.cohort_topic_visits(audio_m(s, d), ["hypertension", "migraine"]),
    with_(*intel("AUDIO"), q=f"""SELECT id AS audio_id, file_name, patient_name, chief_complaint, {rnd('audio_duration_secs / 60.0::DOUBLE', 1)} AS duration_minutes
      FROM intel_audio WHERE {has("concat_ws(' ', chief_complaint, diagnosis_discussed, summary)", ['hypertension', 'migraine'])}"""))


def _notes_for_category(s, d):
    """One summary over the notes of every consultation category."""
    a = shared.intelligence(s, d, "AUDIO").select(F.col("audio_id").alias("id"), F.col("call_category").alias("category"),
                                                 F.col("consultation_notes").alias("text"))
    return S.summarize_agg(a.filter(F.col("category") == "Follow-Up Visit"), "category")


def _notes_sql():
    from .enrichment import group_summary_sql
    q = group_summary_sql("src AS (SELECT id, category, notes AS text FROM intel_audio WHERE category = 'Follow-Up Visit')", "category")
    return "WITH " + ",\n".join(intel("AUDIO")) + ",\n" + q[len("WITH "):]


add("notes_for_category", _notes_for_category, _notes_sql())

# ---------------------------------------------------------------- linking


def _records(s, d):
    """Extracted names of all records; every seventh file name lost a letter in extraction, some the first one."""
    ins = insights(s, d).select(F.concat_ws("-", "source_type", "record_id").alias("record_id"), "patient_name", F.col("record_id").alias("n"))
    return ins.select("record_id", F.when(F.col("n") % 7 == 0, F.replace("patient_name", F.lit("Customer"), F.when(F.col("n") % 2 == 0, "Kustmer").otherwise("Custmer")))
                      .otherwise(F.concat(F.lit("Mr. "), "patient_name")).alias("name"))


def master(s, d):
    return B.table(s, d, "customer").select(F.col("c_name").alias("name"), F.col("c_custkey").alias("patient_id"))


def _people(s, d):
    """The customers, one name of them borne by two."""
    m = master(s, d)
    return m.unionByName(m.filter(F.col("patient_id") == 9).select("name", F.lit(9_000_009).cast("long").alias("patient_id")))


add("resolve_patient", lambda s, d: K.resolve_patient(_records(s, d), _people(s, d)),
    isql("""SELECT record_id, CASE WHEN count(patient_id) FILTER (distance = best) = 1 THEN min(patient_id) FILTER (distance = best) END AS patient_id,
        best AS distance, count(patient_id) FILTER (distance = best) AS n_candidates
      FROM (SELECT r.record_id, c.patient_id, c.distance, min(c.distance) OVER (PARTITION BY r.record_id) AS best
        FROM rec r LEFT JOIN near c ON r.nm = c.nm) GROUP BY record_id, best""",
         """rec AS (SELECT source_type || '-' || record_id AS record_id,
           replace(lower(CASE WHEN record_id % 7 = 0 THEN replace(patient_name, 'Customer', CASE WHEN record_id % 2 = 0 THEN 'Kustmer' ELSE 'Custmer' END) ELSE patient_name END), '#', ' ') AS nm FROM insights)""",
         """people AS (SELECT c_custkey AS patient_id, replace(lower(c_name), '#', ' ') AS m FROM customer
           UNION ALL SELECT 9000009, replace(lower(c_name), '#', ' ') FROM customer WHERE c_custkey = 9)""",
         """hit AS (SELECT DISTINCT nm FROM rec JOIN people ON nm = m)""",
         """near AS (SELECT nm, patient_id, CAST(0 AS BIGINT) AS distance FROM hit JOIN people ON nm = m
           UNION ALL SELECT nm, patient_id, levenshtein(nm, m) FROM (SELECT DISTINCT nm FROM rec WHERE nm NOT IN (SELECT nm FROM hit)) JOIN people ON levenshtein(nm, m) <= 2)"""))


def _recordings(s, d):
    c = F.col("conv_id")
    return B.table(s, d, "conversations").select(c).distinct().select(
        c.alias("recording_id"), F.when(c % 37 != 5, c % 150).alias("patient_id"), (c % 10).alias("provider_id"),
        F.timestamp_seconds(F.lit(1704067200 + 43200) + (c % 30) * 86400).cast("timestamp_ntz").alias("recorded_at"))


add("visit_recording_link", lambda s, d: K.visit_recording_link(_recordings(s, d), B.appointments(s, d)),
    """WITH r AS (SELECT DISTINCT conv_id AS recording_id, CASE WHEN conv_id % 37 <> 5 THEN conv_id % 150 END AS patient_id, conv_id % 10 AS provider_id,
        TIMESTAMP '2024-01-01 12:00:00' + to_days(CAST(conv_id % 30 AS INTEGER)) AS recorded_at FROM conversations)
      SELECT recording_id, patient_id, provider_id, recorded_at, (SELECT event_id FROM events e WHERE e.user_id = r.patient_id
        AND e.event_id % 10 = r.provider_id AND e.ts <= r.recorded_at ORDER BY ts DESC, event_id DESC LIMIT 1) AS appointment_id FROM r""")


LINKED = "linked AS (SELECT c_custkey AS patient_id, insights.* FROM insights JOIN customer ON patient_name = c_name)"


def links(s, d):
    """(source_type, record_id, patient_id) of all records with a resolved patient."""
    recs = insights(s, d).select(F.concat_ws("-", "source_type", "record_id").alias("record_id"), F.col("patient_name").alias("name"))
    linked = K.resolve_patient(recs, master(s, d)).filter(F.col("patient_id").isNotNull())
    return linked.select(F.split_part("record_id", F.lit("-"), F.lit(1)).alias("source_type"),
                         F.split_part("record_id", F.lit("-"), F.lit(2)).cast("long").alias("record_id"), "patient_id")


add("patients_in_all_modalities", lambda s, d: Q.patients_in_all_modalities(insights(s, d), links(s, d)),
    isql("""SELECT patient_id, count(*) FILTER (source_type='PDF') AS n_pdf, count(*) FILTER (source_type='TXT') AS n_txt,
      count(*) FILTER (source_type='AUDIO') AS n_audio FROM linked GROUP BY 1
      HAVING count(DISTINCT source_type) = 3""", LINKED))
add("compare_modalities", lambda s, d: Q.compare_modalities(insights(s, d), links(s, d)),
    isql("""SELECT a.patient_id, a.n AS n_pdf, b.n AS n_txt, len(list_intersect(a.f, b.f)) AS n_shared_findings,
      len(list_filter(a.f, lambda x: NOT list_contains(b.f, x))) AS n_pdf_only, len(list_filter(b.f, lambda x: NOT list_contains(a.f, x))) AS n_txt_only,
      a.m AS pdf_max_sentiment, b.m AS txt_max_sentiment,
      len(list_filter(a.f, lambda x: NOT list_contains(b.f, x))) + len(list_filter(b.f, lambda x: NOT list_contains(a.f, x))) > 0 AS differs
      FROM (SELECT patient_id, count(*) AS n, list(DISTINCT primary_finding) FILTER (primary_finding IS NOT NULL) AS f, max(sentiment_score) AS m
            FROM linked WHERE source_type='PDF' GROUP BY 1) a
      JOIN (SELECT patient_id, count(*) AS n, list(DISTINCT primary_finding) FILTER (primary_finding IS NOT NULL) AS f, max(sentiment_score) AS m
            FROM linked WHERE source_type='TXT' GROUP BY 1) b ON a.patient_id = b.patient_id""", LINKED))


def _p360(s, d):
    return Q.patient_360(insights(s, d), links(s, d), B.claims(s, d), B.appointments(s, d))


add("patient_360", _p360,
    with_(*ALL_INTEL, *VIEWS, *STAR,
          "rc AS (SELECT c_custkey AS patient_id, source_type FROM insights JOIN customer ON patient_name = c_name)",
          q="""SELECT patient_id, coalesce(max(n_pdf), 0) AS n_pdf, coalesce(max(n_txt), 0) AS n_txt, coalesce(max(n_audio), 0) AS n_audio,
          coalesce(max(n_claims), 0) AS n_claims, coalesce(max(n_appointments), 0) AS n_appointments, max(total_billed) AS total_billed, max(last_visit) AS last_visit
          FROM (SELECT patient_id, count(*) FILTER (source_type='PDF') AS n_pdf, count(*) FILTER (source_type='TXT') AS n_txt,
              count(*) FILTER (source_type='AUDIO') AS n_audio FROM rc GROUP BY 1)
          FULL JOIN (SELECT patient_id, count(*) AS n_claims, round(CAST(sum(billed_amount) AS DOUBLE), 2) AS total_billed FROM claims GROUP BY 1) USING (patient_id)
          FULL JOIN (SELECT patient_id, count(*) AS n_appointments, max(appointment_date) AS last_visit FROM appointments GROUP BY 1) USING (patient_id)
          GROUP BY 1"""))

# ---------------------------------------------------------------- quality checks


def quality_sql(cols: str, mods=MODALITIES, **by) -> str:
    return " UNION ALL ".join(f"SELECT '{m}' AS modality, id AS record_id, file_name, {cols.replace('{diag}', 'chief_complaint' if m == 'AUDIO' else 'diagnosis').replace('{amount}', 'CAST(NULL AS DOUBLE)' if m == 'AUDIO' else 'total_amount')} FROM intel_{m.lower()}"
                              for m in mods)


add("check_text_length", lambda s, d: C.check_text_length(quality(s, d)),
    isql(quality_sql("CAST(length(text) AS BIGINT) AS text_length, has_layout")))
add("check_extracted", lambda s, d: C.check_extracted(quality(s, d)),
    isql(quality_sql("patient_name, provider_name, {diag} AS diagnosis, {amount} AS total_amount")))
add("check_classification", lambda s, d: C.check_classification(quality(s, d)), isql(quality_sql("category, confidence")))
add("check_sentiment",
    lambda s, d: C.check_sentiment(quality(s, d), LX.DOCUMENT_DIMENSIONS + LX.CONSULTATION_DIMENSIONS),
    isql(" UNION ALL ".join(
        f"""SELECT '{m}' AS modality, '{x}' AS measure, count(*) AS n_rows, count({e}) AS n_scored,
        count(*) FILTER ({e} < -1 OR {e} > 1) AS n_out_of_range FROM intel_{m.lower()}"""
        for m in MODALITIES for x in ["sentiment_score", *LX.DOCUMENT_DIMENSIONS, *LX.CONSULTATION_DIMENSIONS]
        for e in [x if x == "sentiment_score" or (x in LX.CONSULTATION_DIMENSIONS) == (m == "AUDIO") else "CAST(NULL AS DOUBLE)"])))
add("check_summaries", lambda s, d: C.check_summaries(quality(s, d)),
    isql(" UNION ALL ".join(f"""SELECT '{m}' AS modality, count(*) AS n_rows, count(summary) AS n_summary, count(*) FILTER (length(summary) > 10000) AS n_summary_too_long,
      count(notes) AS n_notes, count(*) FILTER (length(notes) > 10000) AS n_notes_too_long FROM intel_{m.lower()}""" for m in MODALITIES)))
add("check_language", lambda s, d: C.check_language(quality(s, d)),
    isql(quality_sql("language, CASE WHEN translated_text IS NOT NULL THEN 'Yes' ELSE 'No' END AS was_translated")))
add("check_redaction", lambda s, d: C.check_redaction(quality(s, d, ["PDF", "TXT"]), RD.PATTERNS),
    isql(quality_sql("left(text, 200) AS original_snippet, left(redacted_text, 200) AS redacted_snippet, "
                     + " OR ".join(f"regexp_matches(redacted_text, {T.q(p)})" for p in RD.PATTERNS) + " AS residual_pii", ["PDF", "TXT"])))
add("check_document_embedding",
    lambda s, d: C.check_embedding(quality(s, d).withColumn("key", F.concat_ws("-", "modality", "record_id")), "key", "embedding"),
    with_(*ALL_INTEL, f"k AS ({quality_sql('text')})",
                        q=f"""SELECT modality || '-' || record_id AS key, {T.toktext('text')} <> '' AS has_embedding,
      CASE WHEN {T.toktext('text')} <> '' THEN CAST(768 AS BIGINT) END AS dim, CASE WHEN {T.toktext('text')} <> '' THEN 1.0::DOUBLE END AS norm FROM k"""))
