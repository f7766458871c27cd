"""Personal-data rules. Each rule sees the text the rules before it left."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bound

# Fixed values: (type, pattern, replacement), in the order they apply. Patterns stay in the
# subset that Java and RE2 read alike.
RULES = [
    ("SECRET", r'(?i)\b(token|password|secret|api_key)[ \t]*[:=][ \t]*"[^"\n]*"', "[SECRET]"),
    ("EMAIL", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "[EMAIL]"),
    ("CARD", r"\b([0-9]{16}|([0-9]{4}[ -]){3}[0-9]{4})\b", "[CARD]"),
    ("SSN", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", "[SSN]"),
    ("PHONE", r"\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}|\b[0-9]{3}-[0-9]{3}-[0-9]{4}\b", "[PHONE]"),
    ("IP", r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b", "[IP]"),
    ("MRN", r"\bMRN-[0-9]{8}-[A-Z]{2}\b", "[MRN]"),
    ("DOB", r"(?i)\b(DOB|Date of Birth):[ \t]*([0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{4}-[0-9]{2}-[0-9]{2})", "[DOB]"),
    ("NAME", r"(Patient Name|Patient|Provider|Physician):[ \t]*[^\n]+", "[NAME]"),
    ("ADDRESS", r"(?i)\baddress:[ \t]*[^\n]+", "[ADDRESS]"),
]
PATTERNS = [p for _, p, _ in RULES]
# Per pattern, strings of which every match holds one: a text without any is not searched.
HELD = {p: {"SECRET": ['"'], "EMAIL": ["@"], "SSN": ["-"], "PHONE": ["-"], "IP": ["."], "MRN": ["MRN-"], "DOB": [":"],
            "NAME": ["Patient", "Provider", "Physician"], "ADDRESS": [":"]}.get(kind) for kind, p, _ in RULES}


def _may_match(text: Column, pattern: str) -> Column | None:
    held = [F.contains(text, F.lit(x)) for x in HELD.get(pattern) or []]
    return reduce(Column.__or__, held) if held else None


def _replaced(text: Column, pattern: str, placeholder: str) -> Column:
    if not HELD.get(pattern):
        return F.regexp_replace(text, pattern, placeholder)
    return bound(text, lambda t: F.when(_may_match(t, pattern), F.regexp_replace(t, pattern, placeholder)).otherwise(t))


def left_over(text: Column, patterns: list[str] = PATTERNS) -> Column:
    """Whether any pattern matches."""
    found = [text.rlike(p) if (may := _may_match(text, p)) is None else may & text.rlike(p) for p in patterns]
    return reduce(Column.__or__, found)


def redact(text: Column, rules=RULES) -> Column:
    """The text with every match replaced by the name of its type."""
    for _, pattern, placeholder in rules:
        text = _replaced(text, pattern, placeholder)
    return text


def match_counts(text: Column, rules=RULES) -> dict[str, Column]:
    """Matches per type, each counted on the text as its rule sees it."""
    out = {}
    for kind, pattern, placeholder in rules:
        out[kind] = F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0))
        text = F.regexp_replace(text, pattern, placeholder)
    return out
