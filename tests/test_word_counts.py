"""Words of a text are counted where it lies: results against plain Python, nothing exploded."""

import contextlib
import io
import re
from collections import Counter

from pyspark.sql import functions as F

from clinisift.operators import lexical as L
from clinisift.operators import summary as S

TEXTS = ["The fever rose. A cold day! The fever fell and the fever rose?\nNo words of it", "a. b. c", "", None, "same same. same same. other", "Größe der Größe. Maß. 東京都 東京都"]


def top(text, n):
    if text is None:
        return None
    pieces = [[w for w in re.findall(r"[^\W_]+", s.lower()) if len(w) >= 3] for s in re.split(r"(?<=[.!?])\s+|\n", text)]
    tf = Counter(w for p in pieces for w in p)
    order = sorted((-sum(tf[w] for w in p) / len(p), i) for i, p in enumerate(pieces) if p)
    return sorted(i for _, i in order[:n]) or None


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_top_positions(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")
    for n in (1, 3):
        got = {r["id"]: r["p"] for r in df.select("id", S.top_positions(F.col("text"), n).alias("p")).collect()}
        assert got == {i: top(t, n) for i, t in enumerate(TEXTS)}


def test_sums_of_segments_nulls_and_words_of_two_lists(spark):
    df = spark.createDataFrame([(1, "Good good bad"), (1, "bad both"), (2, None), (3, "nothing"), (None, "good")], "id long, text string")
    rows = [("p", "x", "good", 1.0), ("p", "x", "bad", -2.0), ("p", "x", "both", 0.5), ("q", "y", "both", 3.0)]
    got = {r["id"]: tuple(r)[1:] for r in L.lexicon_sums(df, rows).select("id", "`p|x|pos`", "`p|x|neg`", "`q|y|pos`", "`q|y|neg`").collect()}
    assert got == {1: (2.5, 4.0, 3.0, 0.0), 2: (0.0,) * 4, 3: (0.0,) * 4, None: (1.0, 0.0, 0.0, 0.0)}


def test_words_are_neither_exploded_nor_sorted(spark):
    df = spark.createDataFrame([(1, "a text")], "id long, text string")
    for out in (S.summarize(df), S.key_insights(df), L.lexicon_sums(df, [("p", "x", "good", 1.0)])):
        assert not re.search("Generate|Window|Join", plan(out))
    assert "Exchange" not in plan(S.summarize(df))
