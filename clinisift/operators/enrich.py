"""The whole enrichment of new files: one row per file, each text moved once.

The text is parsed once, shuffled by file and read from that one exchange by the word-list
sums, the sentence scores and the final row; everything else is a projection.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicons as LX
from ..functions import redaction as R
from ..functions import text as X
from ..session import materialize
from . import lexical as L
from . import parse as P
from . import summary as S
from . import vectors as V


@dataclass
class Vocabulary:
    """Word lists of one kind of file."""

    labels: dict[str, str]
    dims: list[str]
    polarity: dict[int, str] = field(default_factory=lambda: LX.POLARITY)
    aspects: dict[str, tuple[str, str]] = field(default_factory=lambda: LX.ASPECTS)
    urgent: list[str] = field(default_factory=lambda: LX.URGENT_TERMS)
    follow_up: list[str] = field(default_factory=lambda: LX.FOLLOW_UP_TERMS)
    sections: dict[str, str] = field(default_factory=lambda: LX.NOTE_SECTIONS)
    glossary: dict[str, dict[str, str]] = field(default_factory=lambda: LX.GLOSSARY)


DOCUMENT_VOCABULARY = Vocabulary({k: LX.DOCUMENT_TERMS[k] for k in LX.DOCUMENT_LABELS}, LX.DOCUMENT_DIMENSIONS)
TEXT_VOCABULARY = Vocabulary({k: LX.DOCUMENT_TERMS[k] for k in LX.TEXT_LABELS}, LX.DOCUMENT_DIMENSIONS)
CONSULTATION_VOCABULARY = Vocabulary({k: LX.CONSULTATION_TERMS[k] for k in LX.CONSULTATION_LABELS}, LX.CONSULTATION_DIMENSIONS)


def _texts(files: DataFrame, modality: str) -> DataFrame:
    if modality == "PDF":
        return files.select("id", "file_name", X.markup_to_text(F.col("html")).alias("text"),
                            P.layout_blocks(F.col("html")).alias("parsed_layout"))
    if modality == "TXT":
        return files.select("id", "file_name", "text")
    return P.assemble_transcript(files).withColumnRenamed("transcript_text", "text")


def enrich_document(files: DataFrame, modality: str, vocab: Vocabulary, processed_at: Column, embeddings: bool = True) -> DataFrame:
    """Intelligence rows of PDF (id, file_name, html), TXT (id, file_name, text) or AUDIO
    (id, file_name, turn, role, text) files."""
    base = _texts(files, modality)
    if modality == "AUDIO":
        # Long transcripts are put together once; every branch below reads the result.
        base = materialize(base, "transcripts")
    # Texts are little data but long work: a stated number of tasks is not made fewer for that.
    spark = files.sparkSession
    tasks = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    base = base.filter(F.col("id").isNotNull()).repartition(tasks, "id")
    text = F.col("text")

    rows = [*LX.label_rows(vocab.labels, "class"), *LX.polarity_rows(vocab.polarity),
            *LX.aspect_rows(vocab.aspects, vocab.dims), *LX.label_rows(LX.STOP_WORDS, "language")]
    category, confidence = L.best_label("class", list(vocab.labels))
    lang, _ = L.best_label("language", list(LX.STOP_WORDS))
    scored = L.lexicon_sums(base, rows, "id", "text").select(
        "id", category.alias("category"), confidence.alias("confidence"), L.balance("polarity", "overall").alias("sentiment_score"),
        F.struct(*[L.balance("aspect", d).alias(d) for d in vocab.dims]).alias("sentiment_dimensions"), lang.alias("_lang"))
    base = base.withColumn("positions", S.top_positions(text, 3))

    schema = P.CONSULTATION_FIELDS if modality == "AUDIO" else P.DOCUMENT_FIELDS
    full = base.join(scored, "id", "left").select(
        *[c for c in base.columns if c != "positions"], F.struct(*P.field_columns(text, schema)).alias("extracted_fields"),
        "category", "confidence", "sentiment_score", "sentiment_dimensions",
        S.pick_sentences(X.sentence_array(text), F.col("positions")).alias("summary"),
        F.coalesce(F.col("_lang"), L.script_language(text)).alias("detected_language"))
    out = full.withColumn("translated_text", L.translated(text, F.col("detected_language"), vocab.glossary))
    if modality == "AUDIO":
        notes = S.soap_notes(files, vocab.sections)
        out = out.join(notes, "id", "left")
        names = {"id": "audio_id", "text": "transcript_text", "category": "call_category", "confidence": "call_category_confidence",
                 "translated_text": "translated_transcript"}
    else:
        out = out.withColumn("redacted_text", R.redact(text)).withColumn(
            "key_insights", S.insight_text(F.col("summary"), text, vocab.urgent, vocab.follow_up))
        names = {"id": "doc_id" if modality == "PDF" else "txt_id", "text": "parsed_text" if modality == "PDF" else "raw_text",
                 "category": "doc_category", "confidence": "doc_category_confidence"}
        if modality == "PDF":
            out = out.withColumn("has_layout", F.size("parsed_layout") > 0)
    if embeddings:
        out = out.withColumn("embedding", V.text_vector(text))
    out = out.withColumn("file_id", F.col("id"))
    return out.withColumnsRenamed(names).withColumn("processed_at", processed_at.cast("timestamp_ntz"))
