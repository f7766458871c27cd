"""Prompted inference through a pluggable function, each distinct prompt answered once."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import join_hot_split, materialize

# Instruction texts for documents and for consultations.
INSIGHT_PROMPT = ("Read the medical document below. List its three most important findings, then anything that needs "
                  "action at once, then what should be followed up.\n\n")
NOTES_PROMPT = ("Turn the consultation below into notes under four headings: subjective, objective, assessment, plan.\n\n")


def build_prompts(df: DataFrame, id_col: str, instruction: str, text: Column) -> DataFrame:
    prompt = F.concat(F.lit(instruction), text)
    return df.select(id_col, prompt.alias("prompt"), F.sha2(prompt, 256).alias("prompt_hash"))


def batch_infer(df: DataFrame, id_col: str, instruction: str, text: Column,
                fn: Callable[[list[str]], list[str]], cache: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(answers per row, the enlarged answer cache).

    ``fn`` maps a list of prompts to answers; it runs once per distinct prompt that the
    cache (prompt_hash, response) does not hold. Answers are written before they are
    joined back, so no re-planned stage asks a model twice. A prompt shared by a third of
    all rows is looked up by broadcast, the others by shuffle.
    """
    prompts = build_prompts(df, id_col, instruction, text)
    # Only digest and id are carried through; the prompt text is kept once per digest.
    distinct = prompts.groupBy("prompt_hash").agg(F.first("prompt").alias("prompt"), F.count(F.lit(1)).alias("n_rows"))
    todo = distinct if cache is None else distinct.join(cache.select("prompt_hash"), "prompt_hash", "left_anti")

    def answer(batches):
        for pdf in batches:
            yield pd.DataFrame({"prompt_hash": pdf["prompt_hash"], "response": pd.Series(fn(list(pdf["prompt"])), dtype="object")})

    fresh = materialize(todo.select("prompt_hash", "prompt").mapInPandas(answer, "prompt_hash string, response string"), "responses")
    grown = fresh if cache is None else cache.select("prompt_hash", "response").unionByName(fresh)
    counts = prompts.groupBy("prompt_hash").agg(F.count(F.lit(1)).alias("n_rows"))
    answers = materialize(grown.join(counts, "prompt_hash"), "responses-used")
    out = join_hot_split(prompts.select(id_col, "prompt_hash"), answers, ["prompt_hash"], "n_rows")
    return out.select(id_col, "prompt_hash", "response"), grown
