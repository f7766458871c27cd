"""Extractive summaries and notes.

Sentences, words, counts and the choice of the best sentences are made where the text lies:
nothing is exploded or moved for them.
"""

from __future__ import annotations

from collections import Counter
from itertools import chain

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import lexicons as LX
from ..functions import text as X
from ..functions.numbers import rounded
from ..session import join_hot_split, materialize

MIN_LEN = 3


def top_positions(text: Column, n: int) -> Column:
    """Positions, in order, of the ``n`` sentences whose words are most frequent in the text; ties go
    to the earlier one, NULL without words. The words of a text are counted where it lies."""

    @F.pandas_udf("array<struct<tf: bigint, words: bigint>>")
    def sentence_counts(texts: pd.Series) -> pd.Series:
        """Of every sentence the counts of its words in the whole document, summed, and how many words
        it has; ``texts`` are arrays of sentences, one blank between words."""
        out = []
        for sentences in texts:
            if sentences is None:
                out.append(None)
                continue
            words = [[w for w in s.split(" ") if len(w) >= MIN_LEN] for s in sentences]
            tf = Counter(chain.from_iterable(words))
            out.append([{"tf": sum(tf[w] for w in ws), "words": len(ws)} for ws in words])
        return pd.Series(out, dtype="object")

    counts = sentence_counts(F.transform(X.sentence_array(text), X.token_text))
    scored = F.transform(counts, lambda c, i: F.struct(
        F.when(c["words"] > 0, -rounded(c["tf"] / c["words"], 9)).alias("order"), i.alias("pos")))
    best = F.slice(F.array_sort(F.filter(scored, lambda s: s["order"].isNotNull())), 1, n)
    return F.when(F.size(best) > 0, F.array_sort(F.transform(best, lambda s: s["pos"])))


def pick_sentences(sentences: Column, positions: Column) -> Column:
    """Sentences at the positions, in order. One walk over the sentences: looked up inside a
    function of the positions, the text would be split again for each of them."""
    picked = F.filter(sentences, lambda s, i: F.array_contains(positions, i))
    return F.array_join(F.transform(picked, lambda s: F.trim(s)), " ")


def summarize(df: DataFrame, n: int = 3, id_col: str = "id", col: str = "text") -> DataFrame:
    """The ``n`` sentences whose words are most frequent in the document, in text order."""
    return df.filter(F.col(id_col).isNotNull()).withColumn("positions", top_positions(F.col(col), n)).select(
        id_col, pick_sentences(X.sentence_array(F.col(col)), F.col("positions")).alias("summary"))


def marked_sentences(said: Column, terms: list[str]) -> Column:
    """Sentences holding any of the terms, in text order, joined by blanks; ``said`` has each sentence as
    (s, words), with a blank before and after each word."""
    pattern = " (" + "|".join(terms) + ") "
    return F.array_join(F.transform(F.filter(said, lambda s: s["words"].rlike(pattern)), lambda s: F.trim(s["s"])), " ")


def insight_text(summary: Column, text: Column, urgent: list[str], follow_up: list[str]) -> Column:
    # The text is split and its words are told apart once for both lists.
    said = F.transform(X.sentence_array(text), lambda s: F.struct(s.alias("s"), F.concat(F.lit(" "), X.token_text(s), F.lit(" ")).alias("words")))
    return X.bound(said, lambda x: F.concat(
        F.lit("INSIGHTS: "), F.coalesce(summary, F.lit("")),
        F.lit("\nURGENT: "), F.coalesce(marked_sentences(x, urgent), F.lit("")),
        F.lit("\nFOLLOW-UP: "), F.coalesce(marked_sentences(x, follow_up), F.lit(""))))


def key_insights(df: DataFrame, urgent=LX.URGENT_TERMS, follow_up=LX.FOLLOW_UP_TERMS,
                 id_col: str = "id", col: str = "text") -> DataFrame:
    """Top sentences, urgent items and follow-ups of every document as one note."""
    summary = pick_sentences(X.sentence_array(F.col(col)), F.col("positions"))
    return df.filter(F.col(id_col).isNotNull()).withColumn("positions", top_positions(F.col(col), 3)).select(
        id_col, insight_text(summary, F.col(col), urgent, follow_up).alias("key_insights"))


def summarize_agg(df: DataFrame, group: str, n: int = 3, id_col: str = "id", col: str = "text") -> DataFrame:
    """Top sentences of a whole group of documents, in document order.

    A group may hold a third of all text, so nothing is ever gathered per group: word counts
    combine on the map side, frequent (group, word) pairs are looked up by broadcast and the
    rest by shuffle, and each task passes on at most ``n`` sentences per group.
    """
    docs = df.select(id_col, group, col)
    sent = docs.select(group, id_col, F.posexplode(X.sentence_array(F.col(col))).alias("pos", "sentence"))
    tok = (sent.select(group, id_col, "pos", F.explode(X.token_array(F.col("sentence"))).alias("term"))
           .filter(F.length("term") >= MIN_LEN)
           .groupBy(group, id_col, "pos", "term").agg(F.count(F.lit(1)).alias("c")))
    tok = materialize(tok, "group-terms")
    tf = materialize(tok.groupBy(group, "term").agg(F.sum("c").alias("tf"), F.count(F.lit(1)).alias("rows")), "group-tf")
    scored = join_hot_split(tok, tf, [group, "term"], "rows").groupBy(group, id_col, "pos").agg(
        rounded(F.sum(F.col("c") * F.col("tf")) / F.sum("c"), 9).alias("score"))
    order = W.partitionBy(group).orderBy(F.desc("score"), id_col, "pos")
    best = scored.withColumn("rk", F.row_number().over(order)).filter(F.col("rk") <= n).drop("rk")
    # At most n rows per group: their texts come from a second look at those documents only.
    chosen = docs.join(best.select(id_col, "pos"), id_col).select(
        group, id_col, "pos", F.trim(F.element_at(X.sentence_array(F.col(col)), F.col("pos") + 1)).alias("sentence"))
    picked = F.array_sort(F.collect_list(F.struct(id_col, "pos", "sentence")))
    return chosen.groupBy(group).agg(
        F.array_join(F.transform(picked, lambda s: s["sentence"]), " ").alias("summary"))


def soap_notes(segments: DataFrame, sections: dict[str, str] = LX.NOTE_SECTIONS, clinician: str = "assistant",
               chunk: int = 256) -> DataFrame:
    """Subjective, objective, assessment and plan notes per consultation.

    Each segment goes to the section most of its words speak for; without any, what the
    clinician said is assessment and all else subjective. Section choice is one
    projection per segment; notes are joined in chunks of turns first, then in order.
    """
    padded = F.concat(F.lit(" "), X.token_text(F.col("text")), F.lit(" "))
    # Each blank is doubled, so neighbouring words are counted one by one.
    words = F.replace(padded, F.lit(" "), F.lit("  "))
    counts = [F.struct(F.regexp_count(words, F.lit(" (" + "|".join(t.split()) + ") ")).alias("n"), F.lit(-i).alias("i"),
                       F.lit(name).alias("s")) for i, (name, t) in enumerate(sections.items())]
    best = F.array_max(F.array(*counts))
    section = F.when(best["n"] > 0, best["s"]).when(F.col("role") == clinician, "Assessment").otherwise("Subjective")
    seg = segments.select("id", "turn", "text", section.alias("section"), F.floor(F.col("turn") / chunk).alias("chunk"))
    part = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda s: s["text"]), " ")
    parts = seg.groupBy("id", "section", "chunk").agg(part.alias("part"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "part"))), lambda s: s["part"]), " ")
    notes = parts.groupBy("id", "section").agg(joined.alias("note"))
    one = notes.groupBy("id").agg(*[F.max(F.when(F.col("section") == s, F.col("note"))).alias(s.lower()) for s in sections])
    text = F.concat_ws("\n", *[F.concat(F.lit(f"{s}: "), F.col(s.lower())) for s in sections])
    return one.select("id", text.alias("consultation_notes"))
