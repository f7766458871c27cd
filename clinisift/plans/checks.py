"""Declared constraints and the quality checks over enriched tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import redaction as R
from ..functions.numbers import rounded


def check_constraints(tables: dict[str, DataFrame], spec: dict[str, dict]) -> DataFrame:
    """Violations per declared rule: (table_name, rule, n_violations).

    ``spec`` maps a table to ``not_null`` columns, ``max_length`` and ``domain`` per column,
    a ``primary_key`` and ``foreign_keys`` {column: (table, column)}. Row rules of a table
    share one pass; a key is counted before it is joined, so a key in a third of the rows
    crosses the network once per task.
    """
    parts = []
    for name, rules in spec.items():
        df, exprs = tables[name], []
        for c in rules.get("not_null", []):
            exprs.append((f"not_null({c})", F.col(c).isNull()))
        for c, n in rules.get("max_length", {}).items():
            exprs.append((f"max_length({c},{n})", F.length(c) > n))
        for c, vals in rules.get("domain", {}).items():
            exprs.append((f"domain({c})", ~F.col(c).isin(vals)))
        if exprs:
            names = [r for r, _ in exprs]
            one = df.agg(*[F.coalesce(F.sum(F.when(e, 1).otherwise(0)), F.lit(0)).cast("long").alias(r) for r, e in exprs])
            parts.append(one.unpivot([], [F.col(f"`{r}`") for r in names], "rule", "n_violations")
                         .withColumn("table_name", F.lit(name)))
        if "primary_key" in rules:
            pk = rules["primary_key"]
            per = df.groupBy(*pk).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
            parts.append(per.agg(F.lit(f"primary_key({','.join(pk)})").alias("rule"),
                                 F.count(F.lit(1)).alias("n_violations")).withColumn("table_name", F.lit(name)))
        for c, (parent, pc) in rules.get("foreign_keys", {}).items():
            per = df.filter(F.col(c).isNotNull()).groupBy(F.col(c).alias("_k")).agg(F.count(F.lit(1)).alias("n"))
            orphans = per.join(tables[parent].select(F.col(pc).alias("_k")), "_k", "left_anti")
            parts.append(orphans.agg(F.lit(f"foreign_key({c}->{parent}.{pc})").alias("rule"),
                                     F.coalesce(F.sum("n"), F.lit(0)).alias("n_violations"))
                         .withColumn("table_name", F.lit(name)))
    return reduce(DataFrame.unionByName, [p.select("table_name", "rule", "n_violations") for p in parts])


def check_embedding(df: DataFrame, id_col: str, col: str) -> DataFrame:
    """Embedding present, its length and its norm."""
    sq = F.aggregate(F.transform(col, lambda x: x.cast("double") * x.cast("double")), F.lit(0.0), lambda a, x: a + x)
    return df.select(id_col, F.col(col).isNotNull().alias("has_embedding"),
                     F.size(col).cast("long").alias("dim"), rounded(F.sqrt(sq), 4).alias("norm"))


# ------------------------------------------------------------ checks over enriched rows


def check_text_length(df: DataFrame) -> DataFrame:
    """Length of the text and whether a layout was found."""
    return df.select("modality", "record_id", "file_name", F.length("text").cast("long").alias("text_length"),
                     F.col("has_layout"))


def check_extracted(df: DataFrame) -> DataFrame:
    """The extracted fields people look at first."""
    return df.select("modality", "record_id", "file_name", "patient_name", "provider_name", "diagnosis",
                     "total_amount")


def check_classification(df: DataFrame) -> DataFrame:
    """Label and confidence, most confident first, rows without one last."""
    return df.select("modality", "record_id", "file_name", "category", "confidence").orderBy(
        F.desc_nulls_last("confidence"), "modality", "record_id")


def check_sentiment(df: DataFrame, dims: list[str]) -> DataFrame:
    """Rows, mean score and values outside [-1, 1], per modality and measure."""
    measures = ["sentiment_score", *dims]
    long = df.unpivot(["modality"], measures, "measure", "score")
    s = F.col("score")
    return long.groupBy("modality", "measure").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(s).alias("n_scored"),
        F.count(F.when((s < -1) | (s > 1), 1)).alias("n_out_of_range"))


def check_summaries(df: DataFrame, limit: int = 10_000) -> DataFrame:
    """Summaries and notes present and within the column length."""
    exprs = [F.count(F.lit(1)).alias("n_rows")]
    for c in ("summary", "notes"):
        exprs += [F.count(c).alias(f"n_{c}"), F.count(F.when(F.length(c) > limit, 1)).alias(f"n_{c}_too_long")]
    return df.groupBy("modality").agg(*exprs)


def check_language(df: DataFrame) -> DataFrame:
    return df.select("modality", "record_id", "file_name", "language",
                     F.when(F.col("translated_text").isNotNull(), "Yes").otherwise("No").alias("was_translated"))


def check_redaction(df: DataFrame, patterns: list[str], n: int = 200) -> DataFrame:
    """Snippets before and after, and whether any pattern still matches the redacted text."""
    return df.select("modality", "record_id", "file_name", F.left("text", F.lit(n)).alias("original_snippet"),
                     F.left("redacted_text", F.lit(n)).alias("redacted_snippet"), R.left_over(F.col("redacted_text"), patterns).alias("residual_pii"))
