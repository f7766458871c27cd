"""Questions that reach across modalities, answered from the combined view and the corpora."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X


def mentions(text: Column, terms: list[str]) -> Column:
    """Whether any of the terms occurs as a word."""
    return F.concat(F.lit(" "), X.token_text(text), F.lit(" ")).rlike(" (" + "|".join(terms) + ") ")


def common_findings(insights: DataFrame, k: int = 10) -> DataFrame:
    """Most frequent findings over all modalities."""
    return (insights.filter(F.col("primary_finding").isNotNull()).groupBy("primary_finding").agg(F.count(F.lit(1)).alias("n_records"))
            .orderBy(F.desc("n_records"), "primary_finding").limit(k))


def of_patients(insights: DataFrame, links: DataFrame) -> DataFrame:
    """Insights of resolved patients; ``links`` maps (source_type, record_id) to a patient_id."""
    known = links.filter(F.col("patient_id").isNotNull()).select("source_type", "record_id", "patient_id")
    return insights.join(known, ["source_type", "record_id"])


def patients_in_all_modalities(insights: DataFrame, links: DataFrame) -> DataFrame:
    """Patients with documents, text files and recordings, and how many of each."""
    s = F.col("source_type")
    per = of_patients(insights, links).groupBy("patient_id").agg(
        *[F.count(F.when(s == m, 1)).alias(f"n_{m.lower()}") for m in ("PDF", "TXT", "AUDIO")])
    return per.filter((F.col("n_pdf") > 0) & (F.col("n_txt") > 0) & (F.col("n_audio") > 0))


def compare_modalities(insights: DataFrame, links: DataFrame) -> DataFrame:
    """PDF and TXT findings of each patient side by side: how many they share and how many
    only one side has. Counted per (patient, finding) first, so no patient's documents are
    paired with each other or gathered in a list."""
    s, score = F.col("source_type"), F.col("sentiment_score")
    per_finding = (
        of_patients(insights, links).filter(s.isin("PDF", "TXT")).groupBy("patient_id", "primary_finding")
        .agg(F.count(F.when(s == "PDF", 1)).alias("p"), F.count(F.when(s == "TXT", 1)).alias("t"),
             F.max(F.when(s == "PDF", score)).alias("ps"), F.max(F.when(s == "TXT", score)).alias("ts"))
    )
    p, t = F.col("p") > 0, F.col("t") > 0
    known = F.col("primary_finding").isNotNull()
    per = per_finding.groupBy("patient_id").agg(
        F.sum("p").alias("n_pdf"), F.sum("t").alias("n_txt"),
        F.count(F.when(known & p & t, 1)).alias("n_shared_findings"), F.count(F.when(known & p & ~t, 1)).alias("n_pdf_only"),
        F.count(F.when(known & t & ~p, 1)).alias("n_txt_only"),
        F.max("ps").alias("pdf_max_sentiment"), F.max("ts").alias("txt_max_sentiment"))
    return per.filter((F.col("n_pdf") > 0) & (F.col("n_txt") > 0)).withColumn(
        "differs", (F.col("n_pdf_only") > 0) | (F.col("n_txt_only") > 0))


def docs_mentioning_any(corpus: DataFrame, terms: list[str]) -> DataFrame:
    return corpus.filter(mentions(F.col("search_text"), terms)).select("id", "file_name", "doc_category", "patient_name", "diagnosis")


def category_with_terms(corpus: DataFrame, category: str, terms: list[str]) -> DataFrame:
    """Documents of a category that mention any of the terms."""
    return docs_mentioning_any(corpus.filter(F.col("doc_category") == category), terms)


def mentions_in_audio(segments: DataFrame, terms: list[str]) -> DataFrame:
    """Segments of recordings that mention any of the terms, with their turn."""
    return segments.filter(mentions(F.col("text"), terms)).select(F.col("id").alias("audio_id"), "file_name", "turn", "role", "text")


def insights_by_category(docs: DataFrame, category: str, id_col: str) -> DataFrame:
    return docs.filter(F.col("doc_category") == category).select(id_col, "file_name", "patient_name", "key_insights")


def cohort_topic_visits(audio: DataFrame, terms: list[str]) -> DataFrame:
    """Recordings whose complaint or summary is about a topic."""
    hay = F.concat_ws(" ", "chief_complaint", "diagnosis_discussed", "summary")
    return audio.filter(mentions(hay, terms)).select("audio_id", "file_name", "patient_name", "chief_complaint", "duration_minutes")


def patient_360(insights: DataFrame, links: DataFrame, claims: DataFrame, appointments: DataFrame) -> DataFrame:
    """One row per patient: records per modality, claims and appointments.

    ``links`` maps (source_type, record_id) to a patient. All three sides are counted per
    patient on their own and stacked, so none multiplies another.
    """
    s = F.col("source_type")
    recs = of_patients(insights, links).groupBy("patient_id").agg(
        *[F.count(F.when(s == m, 1)).alias(f"n_{m.lower()}") for m in ("PDF", "TXT", "AUDIO")])
    cl = claims.groupBy("patient_id").agg(F.count(F.lit(1)).alias("n_claims"), F.round(F.sum("billed_amount").cast("double"), 2).alias("total_billed"))
    ap = appointments.groupBy("patient_id").agg(F.count(F.lit(1)).alias("n_appointments"), F.max("appointment_date").alias("last_visit"))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [recs, cl, ap])
    counts = ["n_pdf", "n_txt", "n_audio", "n_claims", "n_appointments"]
    return stacked.filter(F.col("patient_id").isNotNull()).groupBy("patient_id").agg(
        *[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in counts], F.max("total_billed").alias("total_billed"), F.max("last_visit").alias("last_visit"))
