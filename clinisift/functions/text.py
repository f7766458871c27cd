"""Token, sentence and markup expressions. All of them are built-in column functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

MARK = "\u0001"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it is named there."""
    return F.element_at(F.transform(F.array(value), lambda v: use(v)), 1)


def token_text(text: Column) -> Column:
    """Lower-cased text with one blank between runs of letters and digits."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def token_array(text: Column) -> Column:
    """Tokens in order; a text without any gives one empty string, dropped after explode."""
    return F.split(token_text(text), " ")


def sentence_array(text: Column) -> Column:
    """Raw sentence pieces in order: split after . ! ? and at line ends."""
    ended = F.regexp_replace(text, r"([.!?])[ \t\n\r\f]+", "$1" + MARK)
    return F.split(F.regexp_replace(ended, "\n", MARK), MARK)


def count_tokens(text: Column) -> Column:
    t = token_text(text)
    return F.when(t == "", 0).otherwise(F.size(F.split(t, " "))).cast("long")


# Markup that ends a line of text, and the entities that are resolved.
BLOCK_TAGS = "p|div|br|li|h[1-6]|tr|article|section|nav|ul|ol|title"
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def _resolve_entities(c: Column) -> Column:
    for entity, char in ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def strip_invisible(html: Column) -> Column:
    """Markup without scripts, styles and comments."""
    for tag in ("script", "style"):
        html = F.regexp_replace(html, rf"(?is)<{tag}[^>]*>.*?</{tag}>", "")
    return F.regexp_replace(html, r"(?s)<!--.*?-->", "")


def markup_to_text(html: Column) -> Column:
    """Plain text of a laid-out document, one line per block."""
    c = strip_invisible(html)
    c = F.regexp_replace(c, rf"(?i)</?({BLOCK_TAGS})[^>]*>", "\n")
    c = _resolve_entities(F.regexp_replace(c, r"<[^>]+>", ""))
    c = F.regexp_replace(F.regexp_replace(c, r"[ \t]+", " "), r"[ \t\r\f]*\n[ \t\n\r\f]*", "\n")
    return F.regexp_replace(c, r"^[ \n]+|[ \n]+$", "")


def inline_text(html: Column) -> Column:
    """Text of one block: tags dropped, entities resolved, blanks collapsed."""
    c = _resolve_entities(F.regexp_replace(html, r"<[^>]+>", ""))
    return F.trim(F.regexp_replace(c, r"[ \t\n\r\f]+", " "))
