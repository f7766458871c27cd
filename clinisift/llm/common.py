"""Expressions and helpers several operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = "[^\\x20\\x09-\\x0D]+"
#: Ids (8 bytes each) that may be broadcast; more of them are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def give_back() -> None:
    """Returns freed memory of this Python worker to the system: a worker waits for its next
    task beside the executor, which may then work without Python for long."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy_batches(run: Callable) -> Callable:
    """``run`` over an iterator of batches, giving memory back at the end of the task."""

    def tidy(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidy


def tidy_group(run: Callable) -> Callable:
    """``run`` over the tables of one group, giving memory back after it."""

    def tidy(*tables):
        out = run(*tables)
        give_back()
        return out

    # Spark tells the forms of such functions by their number of arguments.
    return (lambda a: tidy(a)) if run.__code__.co_argcount == 1 else (lambda a, b: tidy(a, b))


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z (and nothing else) in lower case; null is the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bounded_broadcast(ids: DataFrame, max_rows: int = BROADCAST_IDS) -> DataFrame:
    """Broadcast hint if a bounded count proves that a written table of narrow rows is small."""
    return F.broadcast(ids) if ids.limit(max_rows + 1).count() <= max_rows else ids


def without(docs: DataFrame, ids: DataFrame, name: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose id is not in the written one-column table ``ids``; null ids stay."""
    return docs.join(bounded_broadcast(ids), name, "left_anti")
