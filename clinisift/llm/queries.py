"""The operators bound to the given tables, with the SQL that computes the same rows."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from public_tokenizers import path as vocabulary
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinisift.session import fresh_path

from . import alignment, bpe, exact_dedup, html_text, minhash, mixing, near_dedup, phrases, repeats, revisits, token_files, topk, toxicity

#: Where the public tokenizer file lies; a parameter of the operators.
WORD_BPE = vocabulary("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))


def bpe_digests(docs: DataFrame, vocab_path: str = WORD_BPE) -> DataFrame:
    coded = bpe.encode(docs, vocab_path, decoded=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, written as flat token files by Spark, counted from the files alone."""
    path = fresh_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), WORD_BPE, path)
    return token_files.token_counts(spark, path)


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revisits among the records that a crawler of all pages would leave."""
    found = revisits.resolve_revisits(revisits.captures_of_pages(table(spark, sf_dir, "pages")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return found.select("record_id", "canonical_url", "resolved_id", "outcome", F.array_join(lines, "|").alias("headers"), "digest")


def op7_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(table(spark, sf_dir, "documents"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(topk.pivot_table(table(spark, sf_dir, "embeddings")), F.col("id") % 50 == 0)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long documents are likelier than short ones of their source, by the square root of their words."""
    return mixing.mix(table(spark, sf_dir, "documents"), row_weight=mixing.by_length(F.col("text")))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.alignment(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"), sha256)
    return found.withColumnRenamed("groups", "groups_sha256")


def sha256(text: bytes) -> str:
    return hashlib.sha256(text).hexdigest()


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.minhash(table(spark, sf_dir, "documents"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_html_text": op4_html_text,
    "op5_toxicity": op5_toxicity,
    "op6_revisits": op6_revisits,
    "op7_suffix_repeats": op7_suffix_repeats,
    "op8_ngram_jaccard": op8_ngram_jaccard,
    "op9_topk": op9_topk,
    "op10_mixing": op10_mixing,
    "op11_alignment": op11_alignment,
    "op12_minhash": op12_minhash,
    "op13_phrases": op13_phrases,
}
SQL: dict[str, str] = {
    "op2_exact_dedup": exact_dedup.SQL,
    "op6_revisits": revisits.SQL,
    "op9_topk": topk.SQL,
    "op12_minhash": minhash.SQL,
    "op13_phrases": phrases.SQL,
}
