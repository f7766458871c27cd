"""Word-list operators: classification, sentiment, language, translation.

Every word list goes along with the tasks. Words are summed to a handful of numbers where the
text lies, so what is shuffled is one small row per text.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicons as LX
from ..functions import text as X
from ..functions.numbers import rounded
from ..session import broadcast_if_small


def _slot(family: str, label: str) -> str:
    return f"{family}|{label}"


def lexicon_sums(df: DataFrame, rows: list[tuple], id_col: str = "id", col: str = "text") -> DataFrame:
    """Sum of positive and of negative weights per (family, label), one row per document.

    All word lists are scored in the same pass over the words of a text, where it lies; only
    the few sums of a text are grouped. Several rows with the same id (segments) add up.
    """
    slots = sorted({(f, lab) for f, lab, _, _ in rows})
    number = {s: 2 * i for i, s in enumerate(slots)}
    # Even slots take positive weights, odd ones negative.
    entries: dict[str, list[tuple[int, float]]] = {}
    for f, lab, term, w in rows:
        entries.setdefault(term, []).append((number[(f, lab)] + (w < 0), float(abs(w))))

    @F.pandas_udf("array<double>")
    def weigh(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            sums = [0.0] * (2 * len(slots))
            for term in (text or "").split(" "):
                for slot, w in entries.get(term, ()):
                    sums[slot] += w
            out.append(sums)
        return pd.Series(out)

    weighed = df.select(id_col, weigh(X.token_text(F.col(col))).alias("_sums"))
    sums = [
        F.sum(F.col("_sums")[number[k] + neg]).alias(_slot(*k) + ("|neg" if neg else "|pos"))
        for k in slots for neg in (0, 1)
    ]
    return weighed.groupBy(id_col).agg(*sums)


def best_label(family: str, labels: list[str]) -> tuple[Column, Column]:
    """Label with the largest sum and its share of all sums; ties go to the earlier label,
    no hit gives NULL and 0."""
    pos = {lab: F.col(f"`{_slot(family, lab)}|pos`") for lab in labels}
    total = sum(pos.values(), F.lit(0.0))
    best = F.array_max(F.array(*[F.struct(c.alias("s"), F.lit(-i).alias("i"), F.lit(lab).alias("l"))
                                 for i, (lab, c) in enumerate(pos.items())]))
    label = F.when(total > 0, best["l"])
    conf = F.when(total > 0, rounded(best["s"] / total, 6)).otherwise(F.lit(0.0))
    return label, conf


def balance(family: str, label: str) -> Column:
    """(positive - negative) / (positive + negative), 0 without a hit."""
    p, n = F.col(f"`{_slot(family, label)}|pos`"), F.col(f"`{_slot(family, label)}|neg`")
    return F.when(p + n > 0, rounded((p - n) / (p + n), 6)).otherwise(F.lit(0.0))


def classify(df: DataFrame, terms: dict[str, str], id_col: str = "id", col: str = "text") -> DataFrame:
    """One label of a closed list and its confidence."""
    label, conf = best_label("class", list(terms))
    return lexicon_sums(df, LX.label_rows(terms, "class"), id_col, col).select(
        id_col, label.alias("category"), conf.alias("confidence"))


def sentiment_score(df: DataFrame, polarity: dict[int, str] = LX.POLARITY, id_col: str = "id", col: str = "text") -> DataFrame:
    return lexicon_sums(df, LX.polarity_rows(polarity), id_col, col).select(
        id_col, balance("polarity", "overall").alias("sentiment_score"))


def sentiment_dimensions(df: DataFrame, aspects: dict, dims: list[str], id_col: str = "id", col: str = "text") -> DataFrame:
    """One score per requested dimension."""
    return lexicon_sums(df, LX.aspect_rows(aspects, dims), id_col, col).select(
        id_col, *[balance("aspect", d).alias(d) for d in dims])


def script_language(text: Column) -> Column:
    """Language told by script alone, NULL for Latin text."""
    c = F.lit(None).cast("string")
    for lang, pattern in reversed(LX.SCRIPTS):
        c = F.when(text.rlike(pattern), lang).otherwise(c)
    return c


def language_columns(family: str = "language", script: str = "script") -> tuple[Column, Column]:
    label, conf = best_label(family, list(LX.STOP_WORDS))
    return (F.coalesce(label, F.col(script)),
            F.when(label.isNull() & F.col(script).isNotNull(), F.lit(1.0)).otherwise(conf))


def detect_language(df: DataFrame, id_col: str = "id", col: str = "text") -> DataFrame:
    """Closed-set language by function words, by script where no word hits."""
    rows = LX.label_rows(LX.STOP_WORDS, "language")
    sums = lexicon_sums(df, rows, id_col, col)
    scripts = df.select(id_col, script_language(F.col(col)).alias("script")).filter(F.col("script").isNotNull())
    lang, conf = language_columns()
    return sums.join(scripts, id_col, "left").select(id_col, lang.alias("language"), conf.alias("confidence"))


def _through(text: Column, lookup: Column) -> Column:
    """Words of the text, each replaced by its entry in the map if it has one."""
    return F.array_join(F.transform(X.token_array(text), lambda t: F.coalesce(F.try_element_at(lookup, t), t)), " ")


def translated(text: Column, lang: Column, glossary: dict[str, dict[str, str]], target: str = "English") -> Column:
    """Text word by word through the glossary; NULL where it already is in the target
    language or its language is unknown. One projection: nothing is shuffled."""
    out = F.lit(None).cast("string")
    for src, words in glossary.items():
        lookup = F.create_map(*[F.lit(x) for kv in words.items() for x in kv])
        out = F.when(lang == src, _through(text, lookup)).otherwise(out)
    known = F.when(lang.isin(list(glossary)), out).otherwise(X.token_text(text))
    return F.when(lang != target, known)


def translate_if_needed(df: DataFrame, glossary: dict[str, dict[str, str]], target: str = "English",
                        id_col: str = "id", col: str = "text", lang_col: str = "language") -> DataFrame:
    return df.select(id_col, translated(F.col(col), F.col(lang_col), glossary, target).alias("translated_text"))


def translate_by_table(df: DataFrame, glossary: DataFrame, target: str = "English",
                       id_col: str = "id", col: str = "text", lang_col: str = "language") -> DataFrame:
    """The same for a glossary kept as a table (lang, src, dst) of any size.

    Distinct words are looked up, not occurrences: a frequent word is one row in the join,
    and the words of a document come back as one map.
    """
    need = df.filter(F.col(lang_col) != target).select(id_col, col, F.col(lang_col).alias("lang"))
    words = need.select(id_col, "lang", F.explode(F.array_distinct(X.token_array(F.col(col)))).alias("src"))
    known = words.select("lang", "src").distinct().join(glossary, ["lang", "src"])
    maps = (words.join(broadcast_if_small(known), ["lang", "src"]).groupBy(id_col)
            .agg(F.map_from_entries(F.collect_list(F.struct("src", "dst"))).alias("m")))
    moved = _through(F.col(col), F.col("m"))
    out = need.join(maps, id_col, "left").select(
        id_col, F.when(F.col("m").isNull(), X.token_text(F.col(col))).otherwise(moved).alias("translated_text"))
    return df.select(id_col).join(out, id_col, "left")
