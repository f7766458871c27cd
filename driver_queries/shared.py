"""Tables several queries read, written once per application and scale."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinisift.session import materialize
from clinisift.sources import bindings as B
from clinisift.sources import filelog as L

_TABLES: dict[tuple, DataFrame] = {}


def once(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """The table ``name``, built and written at its first use in this application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _TABLES:
        _TABLES[key] = materialize(build(), name)
    return _TABLES[key]


def files_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return once(spark, sf_dir, "log", lambda: L.append_files_log(B.landed_files(spark, sf_dir)))


def first_ledger(log: DataFrame) -> DataFrame:
    """Ledger after one run over everything that landed in the first two hours."""
    early = log.filter(F.col("event_time") < F.lit("2024-01-01 02:00:00").cast("timestamp_ntz"))
    return L.ledger_rows(early, 1, F.lit("2024-01-01 02:00:00"))


def vocabulary(modality: str):
    from clinisift.functions import lexicons as LX
    from clinisift.operators.enrich import Vocabulary

    from . import vocabulary as V

    audio = modality == "AUDIO"
    return Vocabulary(
        V.CONSULTATION_TERMS if audio else V.DOCUMENT_TERMS, LX.CONSULTATION_DIMENSIONS if audio else LX.DOCUMENT_DIMENSIONS,
        V.POLARITY, V.ASPECTS, V.URGENT, V.FOLLOW_UP, V.SECTIONS)


FILES = {"PDF": B.pdf_files, "TXT": B.txt_files, "AUDIO": B.audio_segments}
PROCESSED_AT = "2024-02-01 00:00:00"


def enriched(spark: SparkSession, sf_dir: str, modality: str) -> DataFrame:
    """The enrichment of one modality, not yet written."""
    from clinisift.operators.enrich import enrich_document

    return enrich_document(FILES[modality](spark, sf_dir), modality, vocabulary(modality), F.lit(PROCESSED_AT))


def intelligence(spark: SparkSession, sf_dir: str, modality: str) -> DataFrame:
    """The intelligence table of one modality."""
    return once(spark, sf_dir, f"intelligence-{modality.lower()}", lambda: enriched(spark, sf_dir, modality))
