"""Document operators one by one, bound to the given texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from clinisift.functions import lexicons as LX
from clinisift.functions import redaction as RD
from clinisift.functions import text as X
from clinisift.operators import lexical as L
from clinisift.operators import parse as P
from clinisift.operators import summary as S
from clinisift.sources import bindings as B

from . import text_sql as T
from . import vocabulary as V
from .sql_parts import rnd, with_

QUERIES, SQL = {}, {}


def add(name, fn, sql=None):
    QUERIES[name] = fn
    if sql:
        SQL[name] = sql


def docs(s, d):
    return B.texts(s, d, "documents").select(F.col("doc_id").alias("id"), "text")


def pages(s, d):
    return B.texts(s, d, "pages").select(F.col("page_id").alias("id"), "html")


def segments(s, d):
    c = F.col("conv_id")
    return B.texts(s, d, "conversations").select(c.alias("id"), B.audio_name(c).alias("file_name"), "turn", "role", "text")


DOCS = "docs AS (SELECT doc_id AS id, text FROM documents)"
TOK = T.tok("docs")
SEGMENTS = """segs AS (SELECT conv_id AS id, 'conv_' || conv_id || CASE WHEN conv_id % 5 < 2 THEN '.MP3' ELSE '.wav' END AS file_name,
  turn, role, text FROM conversations)"""

add("parse_text", lambda s, d: P.parse_text(pages(s, d)),
    f"SELECT page_id AS id, {T.plain('html')} AS parsed_text FROM pages")

_tags = "|".join(P.LAYOUT_KINDS)
_kind = "CASE lower(tag) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in P.LAYOUT_KINDS.items()) + " END"
_wrap = "(?is)</?(br|article|section|nav|ul|ol|div|body|head|html|table)[^>]*>"
LAYOUT = [
    f"""pieces AS (SELECT page_id AS id, string_split(regexp_replace({T.visible('html')}, '(?i)<({_tags})(\\s[^>]*)?>',
      chr(1) || '\\1' || chr(2), 'g'), chr(1)) AS a FROM pages)""",
    "blocks AS (SELECT id, unnest(a) AS piece, generate_subscripts(a, 1) - 1 AS ord FROM pieces)",
    f"""parts AS (SELECT id, ord, lower(split_part(piece, chr(2), 1)) AS tag,
      {T.inline(f"regexp_replace(split_part(piece, chr(2), 2), '{_wrap}', ' ', 'g')")} AS text FROM blocks WHERE ord > 0)""",
    f"""layout AS (SELECT id, ord, CASE WHEN tag = 'p' AND regexp_matches(text, '{P.FIELD_LINE}') THEN 'field' ELSE {_kind} END AS kind,
      CASE WHEN regexp_matches(tag, '^h[1-6]$') THEN CAST(substr(tag, 2, 1) AS BIGINT) ELSE 0 END AS level, text FROM parts WHERE text <> '')""",
]
add("parse_layout", lambda s, d: P.parse_layout(pages(s, d)), with_(*LAYOUT, q="SELECT * FROM layout"))
add("layout_block_counts",
    lambda s, d: P.layout_of_text(docs(s, d)).groupBy("kind").agg(
        F.count(F.lit(1)).alias("n_blocks"), F.countDistinct("id").alias("n_documents")),
    f"""SELECT CASE WHEN regexp_matches(t, '^(- |\\* |\\[[ X]\\]|[0-9]+\\. )') THEN 'list_item' WHEN regexp_matches(t, '{P.FIELD_LINE}') THEN 'field'
      WHEN regexp_matches(t, '^[A-Z][A-Z0-9 /&-]+:?$') THEN 'heading' ELSE 'paragraph' END AS kind, count(*) AS n_blocks,
      count(DISTINCT doc_id) AS n_documents FROM (SELECT doc_id, trim(unnest(string_split(text, chr(10)))) AS t FROM documents)
      WHERE t <> '' GROUP BY 1""")

add("assemble_transcript",
    lambda s, d: P.assemble_transcript(segments(s, d)).withColumn("segments_md5", F.md5(F.array_join(
        F.transform("transcript_segments", lambda x: F.concat(x["turn"].cast("string"), F.lit("|"), x["text"])), "\n"))).drop("transcript_segments"),
    with_(SEGMENTS, q=f"""SELECT id, file_name, string_agg(role || ': ' || text, chr(10) || chr(10) ORDER BY turn, role, text) AS transcript_text,
      md5(string_agg(turn || '|' || text, chr(10) ORDER BY turn, role, text)) AS segments_md5, count(*) AS n_segments, {rnd(f"CAST(sum({T.n_tokens('text')}) AS DOUBLE) / CAST(2.5 AS DOUBLE)", 3)} AS audio_duration_secs,
      count(DISTINCT role) AS speaker_count FROM segs GROUP BY 1, 2"""))

# Fields that do occur in the given texts.
RAW_FIELDS = [
    ("email", "string", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", 0),
    ("ip_addresses", "array", r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b", 0),
    ("card_number", "number", r"\b[0-9]{16}\b", 0),
    ("license_lines", "array", r"(?i)licen[sc]e[^\n]*", 0),
]


def _raw_fields(s, d):
    out = P.extract_fields(docs(s, d), RAW_FIELDS)
    return out.select("id", "email", F.array_join("ip_addresses", "|").alias("ip_addresses"), "card_number",
                      F.array_join("license_lines", "|").alias("license_lines"))


def _raw_sql(i):
    n, k, p, _ = RAW_FIELDS[i]
    if k == "array":
        return f"array_to_string({T.all_fields('text', p, 0)}, '|') AS {n}"
    e = f"nullif(regexp_extract(text, {T.q(p)}, 0), '')"
    return (f"TRY_CAST({e} AS DOUBLE) AS {n}" if k == "number" else f"{e} AS {n}")


add("extract_fields", _raw_fields, with_(DOCS, q="SELECT id, " + ", ".join(_raw_sql(i) for i in range(4)) + " FROM docs"))

add("classify", lambda s, d: L.classify(docs(s, d), V.DOCUMENT_TERMS),
    with_(DOCS, TOK, *T.best_label("docs", "c", V.DOCUMENT_TERMS),
          q="SELECT id, category, coalesce(confidence, 0.0::DOUBLE) AS confidence FROM docs LEFT JOIN c USING (id)"))
add("sentiment_score", lambda s, d: L.sentiment_score(docs(s, d), V.POLARITY),
    with_(DOCS, TOK, *T.balances("docs", "b", {"sentiment_score": (V.POLARITY[1], V.POLARITY[-1])}), q="SELECT * FROM b"))
add("sentiment_dimensions", lambda s, d: L.sentiment_dimensions(docs(s, d), V.ASPECTS, LX.DOCUMENT_DIMENSIONS),
    with_(DOCS, TOK, *T.balances("docs", "b", {k: V.ASPECTS[k] for k in LX.DOCUMENT_DIMENSIONS}), q="SELECT * FROM b"))
add("detect_language", lambda s, d: L.detect_language(docs(s, d)),
    with_(DOCS, TOK, *T.language("docs", "l"), q="SELECT * FROM l"))


def _language_quality(s, d):
    """Documents by true and by detected language."""
    names = F.create_map(*[F.lit(x) for x in ("en", "English", "fr", "French", "de", "German", "es", "Spanish")])
    truth = B.texts(s, d, "documents").select(F.col("doc_id").alias("id"), F.element_at(names, F.col("lang")).alias("expected"))
    return truth.join(L.detect_language(docs(s, d)), "id").groupBy("expected", "language").agg(F.count(F.lit(1)).alias("n"))


add("language_quality", _language_quality,
    with_(DOCS, TOK, *T.language("docs", "l"),
          q="""SELECT CASE lang WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French' WHEN 'de' THEN 'German' WHEN 'es' THEN 'Spanish' END AS expected,
          language, count(*) AS n FROM documents JOIN l ON doc_id = id GROUP BY 1, 2"""))


def _with_lang(s, d):
    names = F.create_map(*[F.lit(x) for x in ("en", "English", "fr", "French", "de", "German", "es", "Spanish")])
    return B.texts(s, d, "documents").select(F.col("doc_id").alias("id"), "text", F.element_at(names, F.col("lang")).alias("language"))


LANGS = """dl AS (SELECT doc_id AS id, text, CASE lang WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French' WHEN 'de' THEN 'German'
  WHEN 'es' THEN 'Spanish' END AS language FROM documents)"""
TRANSLATED = with_(LANGS, q=f"SELECT id, {T.translated('text', 'language')} AS translated_text FROM dl")
add("translate_if_needed", lambda s, d: L.translate_if_needed(_with_lang(s, d), LX.GLOSSARY), TRANSLATED)


def _by_table(s, d):
    rows = [(lang, a, b) for lang, m in LX.GLOSSARY.items() for a, b in m.items()]
    return L.translate_by_table(_with_lang(s, d), s.createDataFrame(rows, "lang string, src string, dst string"))


add("translate_by_table", _by_table, TRANSLATED)

add("redact", lambda s, d: P.redact(docs(s, d)),
    with_(DOCS, q=f"SELECT id, {T.redacted('text')} AS redacted_text FROM docs"))


def _report_sql():
    e, cols = "text", []
    for kind, pattern, placeholder in RD.RULES:
        cols.append(f"len(regexp_extract_all(t_{kind}, {T.q(pattern)})) AS {kind}")
    # Every rule sees what the rules before it left.
    layers, prev = "docs", "text"
    for kind, pattern, placeholder in RD.RULES:
        layers = f"(SELECT *, {prev} AS t_{kind} FROM {layers})"
        prev = f"regexp_replace(t_{kind}, {T.q(pattern)}, {T.q(placeholder)}, 'g')"
    one = f"r AS (SELECT {', '.join(cols)} FROM {layers})"
    q = " UNION ALL ".join(f"SELECT '{k}' AS pii_type, CAST(coalesce(sum({k}), 0) AS BIGINT) AS n_matches, count(*) FILTER ({k} > 0) AS n_documents FROM r"
                           for k, _, _ in RD.RULES)
    return with_(DOCS, one, q=q)


add("redaction_report", lambda s, d: P.redaction_report(docs(s, d)), _report_sql())


def _names(s, d):
    master = B.table(s, d, "customer").select(F.col("c_name").alias("name"))
    return P.redact_names(B.txt_files(s, d), master, r"[A-Z][a-z]+#[0-9]{9}")


TXT_FILES = """txt_files AS (SELECT doc_id AS id, 'doc_' || doc_id || '.txt' AS file_name,
  'Patient Name: Customer#' || lpad(CAST(doc_id % 150 AS VARCHAR), 9, '0') || chr(10) || 'Provider: Supplier#' || lpad(CAST(doc_id % 10 AS VARCHAR), 9, '0')
  || chr(10) || 'Diagnosis: ' || (['hypertension','diabetes','asthma','migraine','fracture'])[doc_id % 5 + 1] || chr(10) || text AS text FROM documents)"""
add("redact_names", _names,
    with_(TXT_FILES, q="""SELECT id, CASE WHEN c.c_name IS NULL THEN text ELSE replace(text, c.c_name, '[NAME]') END AS redacted_text
      FROM txt_files LEFT JOIN customer c ON c.c_name = regexp_extract(text, '[A-Z][a-z]+#[0-9]{9}', 0)"""))

add("summarize", lambda s, d: S.summarize(docs(s, d)),
    with_(DOCS, *T.top_sentences("docs", "s"), q="SELECT id, summary FROM docs LEFT JOIN s USING (id)"))
add("key_insights", lambda s, d: S.key_insights(docs(s, d), V.URGENT, V.FOLLOW_UP),
    with_(DOCS, *T.top_sentences("docs", "s"),
          q=f"SELECT d.id, {T.insights('summary', 'text', V.URGENT, V.FOLLOW_UP)} AS key_insights FROM docs d LEFT JOIN s ON d.id = s.id"))


def group_summary_sql(src: str, group: str) -> str:
    return with_(
        src,
        f"gs AS (SELECT {group}, id, unnest({T.sentences('text')}) AS sentence, generate_subscripts({T.sentences('text')}, 1) - 1 AS pos FROM src)",
        f"gt AS (SELECT * FROM (SELECT {group}, id, pos, unnest({T.tokens('sentence')}) AS term FROM gs) WHERE length(term) >= 3)",
        f"gf AS (SELECT {group}, term, count(*) AS tf FROM gt GROUP BY 1, 2)",
        f"""gb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY score DESC, id, pos) AS rk FROM (
          SELECT {group}, id, pos, {rnd('CAST(sum(tf) AS DOUBLE) / count(*)', 9)} AS score FROM gt JOIN gf USING ({group}, term) GROUP BY 1, 2, 3))
          WHERE rk <= 3)""",
        q=f"""SELECT {group}, string_agg(trim(sentence), ' ' ORDER BY id, pos) AS summary
          FROM gb JOIN gs USING ({group}, id, pos) GROUP BY 1""")


add("summarize_agg",
    lambda s, d: S.summarize_agg(B.texts(s, d, "documents").select(F.col("doc_id").alias("id"), "source", "text"), "source"),
    group_summary_sql("src AS (SELECT doc_id AS id, source, text FROM documents)", "source"))


def soap_sql(src: str) -> list[str]:
    pad = f"replace(' ' || {T.toktext('text')} || ' ', ' ', '  ')"
    n = {k: f"len(regexp_extract_all({pad}, ' ({'|'.join(t.split())}) '))" for k, t in V.SECTIONS.items()}
    cnt = ", ".join(f"{e} AS n_{k}" for k, e in n.items())
    whens = " ".join(f"WHEN n_{k} = m AND m > 0 THEN '{k}'" for k in n)
    return [
        f"soap_n AS (SELECT id, turn, role, text, {cnt} FROM {src})",
        f"""soap_s AS (SELECT id, turn, text, CASE {whens} WHEN role = 'assistant' THEN 'Assessment' ELSE 'Subjective' END AS section
          FROM (SELECT *, greatest({', '.join('n_' + k for k in n)}) AS m FROM soap_n))""",
        "soap_j AS (SELECT id, section, string_agg(text, ' ' ORDER BY turn, text) AS note FROM soap_s GROUP BY 1, 2)",
        "soap AS (SELECT id, concat_ws(chr(10), " + ", ".join(
            f"'{k}: ' || max(note) FILTER (section = '{k}')" for k in V.SECTIONS) + ") AS consultation_notes FROM soap_j GROUP BY 1)",
    ]


add("soap_notes", lambda s, d: S.soap_notes(segments(s, d), V.SECTIONS),
    with_(SEGMENTS, *soap_sql("segs"), q="SELECT * FROM soap"))
