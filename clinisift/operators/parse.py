"""Text and layout of documents, transcripts of recordings, extracted fields, redaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import redaction as R
from ..functions import text as X
from ..functions.numbers import rounded

CHUNK = 256


def parse_text(df: DataFrame, id_col: str = "id", col: str = "html") -> DataFrame:
    """Laid-out document to plain text."""
    return df.select(id_col, X.markup_to_text(F.col(col)).alias("parsed_text"))


# Markup block and the kind of layout element it is.
LAYOUT_KINDS = {"title": "title", "h1": "heading", "h2": "heading", "h3": "heading", "h4": "heading",
                "h5": "heading", "h6": "heading", "li": "list_item", "tr": "table_row", "p": "paragraph"}
FIELD_LINE = r"^[A-Z][A-Za-z .]{1,40}: \S"


def layout_blocks(html: Column) -> Column:
    """Ordered layout blocks (ord, kind, level, text) of a laid-out document as one array.

    A block reaches from its opening tag to the next block tag, so unclosed tags lose
    nothing. Everything is an expression over one row; no shuffle.
    """
    tags = "|".join(LAYOUT_KINDS)
    pieces = F.split(F.regexp_replace(X.strip_invisible(html), rf"(?i)<({tags})(\s[^>]*)?>", X.MARK + "$1" + "\u0002"), X.MARK)
    kinds = F.create_map(*[F.lit(x) for kv in LAYOUT_KINDS.items() for x in kv])

    def block(piece: Column, i: Column) -> Column:
        tag = F.lower(F.split_part(piece, F.lit("\u0002"), F.lit(1)))
        body = X.inline_text(F.regexp_replace(
            F.split_part(piece, F.lit("\u0002"), F.lit(2)), r"(?is)</?(br|article|section|nav|ul|ol|div|body|head|html|table)[^>]*>", " "))
        kind = F.element_at(kinds, tag)
        return F.struct(
            i.cast("long").alias("ord"), F.when((kind == "paragraph") & body.rlike(FIELD_LINE), "field").otherwise(kind).alias("kind"),
            F.when(tag.rlike("^h[1-6]$"), F.substring(tag, 2, 1).cast("long")).otherwise(F.lit(0)).alias("level"), body.alias("text"))

    blocks = F.transform(pieces, block)
    return F.filter(blocks, lambda b: (b["ord"] > 0) & (b["text"] != ""))


def parse_layout(df: DataFrame, id_col: str = "id", col: str = "html") -> DataFrame:
    """Layout blocks as rows (id, ord, kind, level, text)."""
    return df.select(id_col, F.explode(layout_blocks(F.col(col))).alias("b")).select(id_col, "b.*")


def layout_of_text(df: DataFrame, id_col: str = "id", col: str = "text") -> DataFrame:
    """Layout blocks of a plain text: one per line, told by its shape."""
    lines = df.select(id_col, F.posexplode(F.split(F.col(col), "\n")).alias("ord", "text"))
    t = F.trim("text")
    kind = (
        F.when(t.rlike(r"^(- |\* |\[[ X]\]|[0-9]+\. )"), "list_item").when(t.rlike(FIELD_LINE), "field")
        .when(t.rlike(r"^[A-Z][A-Z0-9 /&-]+:?$"), "heading").otherwise("paragraph")
    )
    return lines.filter(t != "").select(id_col, F.col("ord").cast("long").alias("ord"), kind.alias("kind"),
                                        F.lit(0).alias("level").cast("long"), t.alias("text"))


def assemble_transcript(segments: DataFrame, words_per_second: float = 2.5) -> DataFrame:
    """Transcript, segments, duration, speakers and segment count per recording.

    Segments are first joined in chunks of consecutive turns and the chunks then in order,
    so the rows of a long recording are sorted and joined by many tasks; the last step
    handles one row per chunk. Counts are plain sums with map-side combine.
    """
    seg = segments.select(
        "id", "file_name", "turn", "role", "text", F.floor(F.col("turn") / CHUNK).alias("chunk"),
        X.count_tokens(F.col("text")).alias("words"))
    # One sort per chunk; turns are the order, role only breaks ties of equal turns.
    listed = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    chunks = seg.groupBy("id", "file_name", "chunk").agg(
        F.array_join(F.transform(listed, lambda s: F.concat(s["role"], F.lit(": "), s["text"])), "\n\n").alias("part"), listed.alias("listed"),
        F.count(F.lit(1)).alias("segments"), F.sum("words").alias("words"),
        F.collect_set("role").alias("roles"))
    return chunks.groupBy("id", "file_name").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "part"))), lambda s: s["part"]),
                     "\n\n").alias("transcript_text"),
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "listed"))), lambda s: s["listed"])).alias("transcript_segments"),
        F.sum("segments").alias("n_segments"),
        rounded(F.sum("words") / F.lit(float(words_per_second)), 3).alias("audio_duration_secs"),
        F.size(F.array_distinct(F.flatten(F.collect_set("roles")))).cast("long").alias("speaker_count"))


# ---------------------------------------------------------------- fields

# Fixed values: (field, type, pattern, group) for documents and for consultations. A label
# opens the line, the value is the rest of it.
DOCUMENT_FIELDS = [
    ("patient_name", "string", r"(?m)^(?:Patient Name|Patient): *(\S[^\n]*)", 1),
    ("date_of_birth", "string", r"(?m)^(?:DOB|Date of Birth): *(\S[^\n]*)", 1),
    ("provider_name", "string", r"(?m)^(?:Provider|Physician): *(\S[^\n]*)", 1),
    ("facility_name", "string", r"(?m)^(?:Facility|Hospital|Clinic): *(\S[^\n]*)", 1),
    ("document_date", "string", r"(?m)^(?:Date|Report Date): *(\S[^\n]*)", 1),
    ("diagnosis", "string", r"(?m)^(?:Diagnosis|Impression): *(\S[^\n]*)", 1),
    ("medications", "array", r"(?m)^(?:Medication|Rx): *(\S[^\n]*)", 1),
    ("procedures", "array", r"(?m)^(?:Procedure|Test): *(\S[^\n]*)", 1),
    ("follow_up_actions", "array", r"(?m)^(?:Follow-Up|Follow-up): *(\S[^\n]*)", 1),
    ("insurance_id", "string", r"(?m)^(?:Insurance ID|Policy Number): *(\S[^\n]*)", 1),
    ("total_amount", "number", r"(?m)^(?:Total|Total Amount|Amount Due): *(\$?[0-9][0-9,.]*)", 1),
]
CONSULTATION_FIELDS = [
    ("patient_name", "string", r"(?m)^(?:[a-z]+: )?Patient Name: *(\S[^\n]*)", 1),
    ("provider_name", "string", r"(?m)^(?:[a-z]+: )?Provider: *(\S[^\n]*)", 1),
    ("chief_complaint", "string", r"(?m)^(?:[a-z]+: )?Chief Complaint: *(\S[^\n]*)", 1),
    ("diagnosis_discussed", "string", r"(?m)^(?:[a-z]+: )?Diagnosis: *(\S[^\n]*)", 1),
    ("medications_discussed", "array", r"(?m)^(?:[a-z]+: )?Medication: *(\S[^\n]*)", 1),
    ("follow_up_actions", "array", r"(?m)^(?:[a-z]+: )?Follow-Up: *(\S[^\n]*)", 1),
    ("next_appointment", "string", r"(?m)^(?:[a-z]+: )?Next Appointment: *(\S[^\n]*)", 1),
]


def field_columns(text, schema: list[tuple]) -> list:
    """One column per field of the schema; no match gives NULL for every type."""
    cols = []
    for name, kind, pattern, group in schema:
        if kind == "array":
            found = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
            cols.append(F.when(F.size(found) > 0, found).alias(name))
            continue
        first = F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))
        if kind == "number":
            cols.append(F.regexp_replace(first, r"[$,]", "").try_cast("double").alias(name))
        else:
            cols.append(first.alias(name))
    return cols


def extract_fields(df: DataFrame, schema: list[tuple], id_col: str = "id", col: str = "text") -> DataFrame:
    """Typed fields of every document by a list of (field, type, pattern, group)."""
    return df.select(id_col, *field_columns(F.col(col), schema))


# ---------------------------------------------------------------- redaction


def redact(df: DataFrame, id_col: str = "id", col: str = "text") -> DataFrame:
    return df.select(id_col, R.redact(F.col(col)).alias("redacted_text"))


def redaction_report(df: DataFrame, col: str = "text") -> DataFrame:
    """Matches and documents with a match per type, one pass."""
    counts = R.match_counts(F.col(col))
    per = df.select(*[c.cast("long").alias(k) for k, c in counts.items()])
    one = per.agg(*[F.struct(F.coalesce(F.sum(k), F.lit(0)).alias("m"), F.count(F.when(F.col(k) > 0, 1)).alias("d")).alias(k)
                    for k in counts])
    return (one.unpivot([], list(counts), "pii_type", "v")
            .select("pii_type", F.col("v.m").alias("n_matches"), F.col("v.d").alias("n_documents")))


def redact_names(df: DataFrame, names: DataFrame, shape: str, id_col: str = "id", col: str = "text") -> DataFrame:
    """Known names replaced by [NAME].

    ``shape`` is a pattern that proposes name candidates; only those found in the master
    list are replaced. Distinct candidates are joined by equality, so neither the list
    nor the texts travel whole.
    """
    cands = df.select(id_col, F.explode(F.array_distinct(F.regexp_extract_all(F.col(col), F.lit(shape), F.lit(0)))).alias("name"))
    wanted = cands.select("name").distinct().join(names.select("name").distinct(), "name", "left_semi")
    hits = (cands.join(wanted, "name").groupBy(id_col)
            .agg(F.array_sort(F.collect_set("name"), lambda a, b: F.length(b) - F.length(a)).alias("names")))
    swapped = F.aggregate(F.coalesce("names", F.array().cast("array<string>")), F.col(col),
                          lambda acc, n: F.replace(acc, n, F.lit("[NAME]")))
    return df.join(hits, id_col, "left").select(id_col, swapped.alias("redacted_text"))
