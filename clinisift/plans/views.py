"""Flat views over the intelligence tables and the three search corpora."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicons as LX
from ..functions.numbers import rounded


def array_count(col) -> Column:
    """Elements of an array, NULL where it is missing."""
    return F.array_size(col).cast("long")


def presence_flag(col: str) -> Column:
    return F.col(col).isNotNull()


_DIM_NAMES = {"urgency": "urgency_score", "clinical_concern": "clinical_concern_score", "patient_satisfaction": "patient_satisfaction_score",
              "empathy": "empathy_score", "clinical_clarity": "clinical_clarity_score", "patient_anxiety": "patient_anxiety_score",
              "resolution": "resolution_score"}


def _dims(names: list[str]) -> list[Column]:
    return [F.col(f"sentiment_dimensions.{d}").alias(_DIM_NAMES[d]) for d in names]


def _f(name: str, alias: str | None = None) -> Column:
    return F.col(f"extracted_fields.{name}").alias(alias or name)


def document_metrics(df: DataFrame, id_col: str) -> DataFrame:
    """Flat rows of document intelligence; ``id_col`` tells PDF (doc_id) from TXT (txt_id)."""
    return df.select(
        id_col, "file_id", "file_name", "processed_at", "doc_category", "doc_category_confidence", "sentiment_score",
        *_dims(LX.DOCUMENT_DIMENSIONS),
        _f("patient_name"), _f("provider_name"), _f("facility_name"), _f("document_date"), _f("diagnosis"), _f("insurance_id"),
        _f("total_amount", "billed_amount"),
        array_count("extracted_fields.medications").alias("medication_count"),
        array_count("extracted_fields.procedures").alias("procedure_count"),
        array_count("extracted_fields.follow_up_actions").alias("follow_up_count"),
        "detected_language", presence_flag("translated_text").alias("was_translated"), "summary", "key_insights")


def audio_metrics(df: DataFrame) -> DataFrame:
    return df.select(
        "audio_id", "file_id", "file_name", "processed_at", "audio_duration_secs",
        rounded(F.col("audio_duration_secs") / F.lit(60.0), 1).alias("duration_minutes"), "speaker_count",
        "call_category", "call_category_confidence", "sentiment_score", *_dims(LX.CONSULTATION_DIMENSIONS),
        _f("patient_name"), _f("provider_name"), _f("chief_complaint"), _f("diagnosis_discussed"),
        array_count("extracted_fields.medications_discussed").alias("medications_mentioned"),
        array_count("extracted_fields.follow_up_actions").alias("action_item_count"),
        _f("next_appointment"), "detected_language", presence_flag("translated_transcript").alias("was_translated"),
        "summary", "consultation_notes")


def combined_insights(pdf: DataFrame, txt: DataFrame, audio: DataFrame) -> DataFrame:
    """The three metric views under 16 common columns; what a modality lacks is NULL."""
    def of(df, kind, rec, cat, finding, meds, actions, minutes, speakers):
        return df.select(
            F.lit(kind).alias("source_type"), F.col(rec).alias("record_id"), "file_name", "processed_at", F.col(cat).alias("category"),
            "sentiment_score", "patient_name", "provider_name", F.col(finding).alias("primary_finding"), "detected_language",
            "was_translated", "summary", F.col(meds).alias("medication_count"), F.col(actions).alias("action_item_count"),
            minutes.cast("double").alias("duration_minutes"), speakers.cast("long").alias("speaker_count"))

    none = F.lit(None)
    return (
        of(pdf, "PDF", "doc_id", "doc_category", "diagnosis", "medication_count", "follow_up_count", none, none)
        .unionAll(of(txt, "TXT", "txt_id", "doc_category", "diagnosis", "medication_count", "follow_up_count", none, none))
        .unionAll(of(audio, "AUDIO", "audio_id", "call_category", "chief_complaint", "medications_mentioned", "action_item_count",
                     F.col("duration_minutes"), F.col("speaker_count"))))


def search_corpus(df: DataFrame, modality: str) -> DataFrame:
    """Search text and attributes of one modality."""
    e = lambda c: F.coalesce(c, F.lit(""))
    unknown = lambda n: F.coalesce(_f(n), F.lit("Unknown")).alias(n)
    if modality == "AUDIO":
        text = F.concat(e(F.col("transcript_text")), F.lit("\n\nSUMMARY: "), e(F.col("summary")), F.lit("\n\nCONSULTATION NOTES: "),
                        e(F.col("consultation_notes")), F.lit("\n\nCHIEF COMPLAINT: "), e(_f("chief_complaint")))
        return df.select(F.col("audio_id").alias("id"), "file_name", text.alias("search_text"), "call_category",
                         unknown("patient_name"), unknown("provider_name"), e(_f("chief_complaint")).alias("chief_complaint"),
                         F.col("audio_duration_secs").alias("duration_secs"), "speaker_count", "detected_language", "sentiment_score", "processed_at")
    body, rec = ("parsed_text", "doc_id") if modality == "PDF" else ("raw_text", "txt_id")
    text = F.concat(e(F.col(body)), F.lit("\n\nSUMMARY: "), e(F.col("summary")), F.lit("\n\nINSIGHTS: "), e(F.col("key_insights")),
                    F.lit("\n\nDIAGNOSIS: "), e(_f("diagnosis")))
    return df.select(F.col(rec).alias("id"), "file_name", text.alias("search_text"), "doc_category",
                     unknown("patient_name"), unknown("provider_name"), e(_f("diagnosis")).alias("diagnosis"), "detected_language",
                     "sentiment_score", "processed_at")


def enrichment_overview(insights: DataFrame) -> DataFrame:
    """Key columns of all modalities, newest first."""
    return insights.select("source_type", "record_id", "file_name", "category", "detected_language", "processed_at").orderBy(
        F.desc("processed_at"), "source_type", "record_id")


def function_coverage(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and filled rows per enrichment column and modality."""
    out = None
    for m, df in tables.items():
        cols = [c for c in df.columns if c not in ("file_id", "file_name", "processed_at")]
        one = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(c).alias(c) for c in cols])
        part = one.unpivot(["n_rows"], cols, "measure", "n_filled").withColumn("modality", F.lit(m))
        out = part if out is None else out.unionByName(part)
    return out.select("modality", "measure", "n_rows", "n_filled")


def quality_rows(df: DataFrame, modality: str) -> DataFrame:
    """Intelligence rows under the names the quality checks use."""
    if modality == "AUDIO":
        return df.select(
            F.lit("AUDIO").alias("modality"), F.col("audio_id").alias("record_id"), "file_name", F.col("transcript_text").alias("text"),
            F.lit(False).alias("has_layout"), _f("patient_name"), _f("provider_name"), _f("chief_complaint", "diagnosis"),
            F.lit(None).cast("double").alias("total_amount"), F.col("call_category").alias("category"),
            F.col("call_category_confidence").alias("confidence"), "sentiment_score", "sentiment_dimensions.*", "summary",
            F.col("consultation_notes").alias("notes"), F.col("detected_language").alias("language"),
            F.col("translated_transcript").alias("translated_text"), F.lit(None).cast("string").alias("redacted_text"), "embedding")
    rec, body = ("doc_id", "parsed_text") if modality == "PDF" else ("txt_id", "raw_text")
    layout = F.col("has_layout") if modality == "PDF" else F.lit(False)
    return df.select(
        F.lit(modality).alias("modality"), F.col(rec).alias("record_id"), "file_name", F.col(body).alias("text"),
        layout.alias("has_layout"), _f("patient_name"), _f("provider_name"), _f("diagnosis"), _f("total_amount"),
        F.col("doc_category").alias("category"), F.col("doc_category_confidence").alias("confidence"), "sentiment_score",
        "sentiment_dimensions.*", "summary", F.col("key_insights").alias("notes"), F.col("detected_language").alias("language"),
        "translated_text", "redacted_text", "embedding")
