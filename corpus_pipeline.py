"""From raw documents to token ids: each stage calls one operator and works on all that its predecessor kept."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinisift.llm import exact_dedup, mixing, near_dedup, queries, toxicity
from clinisift.llm.common import bounded_broadcast, lower_ascii, without
from clinisift.session import materialize, shared_dir


def any_names(stage: Callable) -> Callable:
    """``stage`` on documents whose further columns may have any names: inside it they are numbered."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        inside = [c if c in ("doc_id", "text", "source") else f"other_{k}" for k, c in enumerate(docs.columns)]
        return stage(spark, docs.toDF(*inside), sf_dir).toDF(*docs.columns)

    return run


@any_names
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model does not reject.

    Rows go one by one: equal ids and null ids are scored by their own text. Null and empty texts
    have no features and stay; without labels of both kinds every row is scored alike.
    """
    labels = queries.table(spark, sf_dir, "labels")
    return toxicity.score(docs, toxicity.fit(docs, labels)).filter("NOT toxicity.toxic").drop("toxicity")


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a row_key: the doc_id, or beyond 2^62 a hash of the row where the id is null or of several rows."""
    shared = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id", F.lit(True).alias("shared_"))
    rows = docs.join(bounded_broadcast(materialize(shared, "shared-ids")), "doc_id", "left")
    own = F.lit(1 << 62).bitwiseOR(F.shiftrightunsigned(F.xxhash64(*docs.columns), 2))
    return rows.select(*docs.columns, F.when(F.col("doc_id").isNull() | F.col("shared_").isNotNull(), own).otherwise(F.col("doc_id").cast("long")).alias("row_key"))


@any_names
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id.

    Rows go one by one, by a hash of id and text: another text of the same id stays, and a
    null id goes if an equal text has an id. Rows with the winning id and an equal text all
    stay, as do those of a text that has null ids only.
    """
    gone = exact_dedup.exact_dedup(docs).filter("NOT kept").select(F.xxhash64("doc_id", "text_sha256").alias("row_key"))
    rows = docs.withColumn("row_key", F.xxhash64("doc_id", F.lower(F.hex(exact_dedup.sha256(lower_ascii(F.col("text")))))))
    return without(rows, materialize(gone, "copies"), "row_key").drop("row_key")


@any_names
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links connect the one with the smallest doc_id.

    Rows with a null id or one that several rows have are documents of their own, behind all
    others; rows equal in all columns are one document.
    """
    rows = keyed(docs)
    gone = near_dedup.near_dedup(rows, "row_key").filter("component_id <> doc_id").select(F.col("doc_id").alias("row_key"))
    return without(rows, materialize(gone, "near-copies"), "row_key").drop("row_key")


@any_names
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, each row by itself.

    Rows of a source have equal chances. A null source is one of its own; rows without words are
    taken as often as others of their source and bring none; rows of a null id or a shared one
    count by themselves, those equal in all columns alike.
    """
    rows = keyed(docs).withColumnsRenamed({"doc_id": "given_id", "row_key": "doc_id"})
    return mixing.mixed_rows(rows, mixing.mix(rows)).drop("doc_id").withColumnRenamed("given_id", "doc_id").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded text of each row, repeated ones too; a null text
    is the empty one, further columns are left out."""
    return queries.bpe_digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources", mix_sources),
    ("BPE encoding and decoding", encode),
]

#: No stage but the second can be said in SQL (fitted weights, hashed random numbers, merges).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again."""
    docs = queries.table(spark, sf_dir, "documents")
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex[:12]}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
    return docs
