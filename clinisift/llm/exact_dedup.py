"""Exact deduplication with skew-safe combining, DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinisift.session import materialize

from .common import lower_ascii, partitions


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int | None = None,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Rows are equal when their texts are, A-Z compared without case; null counts as the
    empty text. Of equal rows the largest id stays.

    1. Each map task folds its equal texts to one row per salt (partial aggregation).
    2. (digest, text, salt) groups are merged: a text that a third of all rows hold is
       spread over ``salts`` groups.
    3. The winners of the salts, at most ``salts`` rows for a text, are combined.
    4. Every row finds its winner through (digest, salt), without moving its text again.

    The text itself is a grouping key at 2 and 3, so a digest alone never makes two texts
    equal. If texts share a digest, step 4 compares the texts too.

    ``salts`` grows with the shuffle partitions, which keeps the largest share of a hot
    text near three times the mean partition at any size.

    Defined cases: a null id never beats another one; a group of null ids only has a null
    keep_id and its rows are all kept, as are repeated rows of the winning id. An empty
    table gives no rows. Further columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    salts = salts or max(32, partitions(spark) // 8)
    rows = docs.select(
        F.col(id_col).alias("id"),
        lower_ascii(F.col(text_col)).alias("norm"),
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(salts)).cast("int").alias("salt"),
    ).select("id", "norm", "salt", digest(F.col("norm")).alias("digest"))

    salted = rows.groupBy("digest", "norm", "salt").agg(F.max("id").alias("best"), F.count(F.lit(1)).alias("n"))
    same_text = Window.partitionBy("digest", "norm")
    same_digest = Window.partitionBy("digest")
    winners = salted.repartition("digest").select(
        "digest", "salt", "norm",
        F.max("best").over(same_text).alias("keep_id"),
        F.sum("n").over(same_text).alias("group_size"),
        (F.min("norm").over(same_digest) != F.max("norm").over(same_digest)).alias("clash"),
    ).select("digest", "salt", "keep_id", "group_size", "clash", F.when(F.col("clash"), F.col("norm")).alias("only"))
    winners = materialize(winners, "exact-winners")

    out = ["id", "digest", "keep_id", "group_size"]
    found = rows.select("id", "digest", "salt").join(winners.drop("clash", "only"), ["digest", "salt"])
    if winners.filter("clash").limit(1).count():
        plain = rows.select("id", "digest", "salt").join(winners.filter("NOT clash").drop("clash", "only"), ["digest", "salt"])
        mixed = winners.filter("clash").withColumnRenamed("only", "norm")
        found = plain.select(*out).unionByName(rows.join(mixed, ["digest", "salt", "norm"]).select(*out))
    return found.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
WINDOW w AS (PARTITION BY norm)
"""
