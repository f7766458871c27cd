"""SQL for the text operators: each function gives CTE text over a table (id, text)."""

from __future__ import annotations

from clinisift.functions import lexicons as LX
from clinisift.functions import redaction as R
from clinisift.functions import text as X

from .sql_parts import rnd, values


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def toktext(e: str) -> str:
    return f"trim(regexp_replace(lower({e}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"


def tokens(e: str) -> str:
    return f"string_split({toktext(e)}, ' ')"


def sentences(e: str) -> str:
    return (f"string_split(replace(regexp_replace({e}, '([.!?])[ \\t\\n\\r\\f]+', '\\1' || chr(1), 'g'), chr(10), chr(1)), chr(1))")


def n_tokens(e: str) -> str:
    return f"CASE WHEN {toktext(e)} = '' THEN 0 ELSE len({tokens(e)}) END"


def entities(e: str) -> str:
    for a, b in X.ENTITIES:
        e = f"replace({e}, {q(a)}, {q(b)})"
    return e


def visible(e: str) -> str:
    for tag in ("script", "style"):
        e = f"regexp_replace({e}, '(?is)<{tag}[^>]*>.*?</{tag}>', '', 'g')"
    return f"regexp_replace({e}, '(?s)<!--.*?-->', '', 'g')"


def plain(e: str) -> str:
    e = f"regexp_replace({visible(e)}, '(?i)</?({X.BLOCK_TAGS})[^>]*>', chr(10), 'g')"
    e = entities(f"regexp_replace({e}, '<[^>]+>', '', 'g')")
    e = f"regexp_replace({e}, '[ \\t]+', ' ', 'g')"
    e = f"regexp_replace({e}, '[ \\t\\r\\f]*\\n[ \\t\\n\\r\\f]*', chr(10), 'g')"
    return f"regexp_replace({e}, '^[ \\n]+|[ \\n]+$', '', 'g')"


def inline(e: str) -> str:
    e = entities(f"regexp_replace({e}, '<[^>]+>', '', 'g')")
    return f"trim(regexp_replace({e}, '[ \\t\\n\\r\\f]+', ' ', 'g'))"


def redacted(e: str) -> str:
    for _, pattern, placeholder in R.RULES:
        e = f"regexp_replace({e}, {q(pattern)}, {q(placeholder)}, 'g')"
    return e


# ------------------------------------------------------------------ CTE builders


def tok(src: str) -> str:
    return f"{src}_tok AS MATERIALIZED (SELECT id, unnest({tokens('text')}) AS term FROM {src})"


def best_label(src: str, out: str, terms: dict[str, str], label: str = "category") -> list[str]:
    rows = [(lab, i, t) for i, (lab, ws) in enumerate(terms.items()) for t in ws.split()]
    return [
        values(rows, "label, ord, term", f"{out}_lex"),
        f"""{out} AS (SELECT id, label AS {label}, {rnd('n / total', 6)} AS confidence FROM (
          SELECT id, label, CAST(n AS DOUBLE) AS n, CAST(sum(n) OVER (PARTITION BY id) AS DOUBLE) AS total,
            row_number() OVER (PARTITION BY id ORDER BY n DESC, ord) AS rk
          FROM (SELECT id, label, ord, count(*) AS n FROM {src}_tok JOIN {out}_lex USING (term) GROUP BY 1, 2, 3)) WHERE rk = 1)""",
    ]


def balances(src: str, out: str, lists: dict[str, tuple[str, str]]) -> list[str]:
    """One column per name in ``lists``: (positive words, negative words)."""
    rows = [(n, t, w) for n, (p, m) in lists.items() for ws, w in ((p, 1), (m, -1)) for t in ws.split()]
    cols = []
    for n in lists:
        p, m = (f"CAST(count(*) FILTER (name = '{n}' AND w = {w}) AS DOUBLE)" for w in (1, -1))
        cols.append(f"CASE WHEN {p} + {m} > 0 THEN {rnd(f'({p} - {m}) / ({p} + {m})', 6)} ELSE 0.0::DOUBLE END AS {n}")
    return [values(rows, "name, term, w", f"{out}_lex"),
            f"{out} AS (SELECT id, {', '.join(cols)} FROM {src}_tok LEFT JOIN {out}_lex USING (term) GROUP BY 1)"]


def language(src: str, out: str) -> list[str]:
    script = "CASE " + " ".join(f"WHEN regexp_matches(text, {q(p)}) THEN '{n}'" for n, p in LX.SCRIPTS) + " END"
    return [*best_label(src, f"{out}_w", LX.STOP_WORDS, "language"),
            f"""{out} AS (SELECT s.id, coalesce(w.language, {script}) AS language,
              CASE WHEN w.language IS NULL AND {script} IS NOT NULL THEN 1.0::DOUBLE ELSE coalesce(w.confidence, 0.0::DOUBLE) END AS confidence
              FROM {src} s LEFT JOIN {out}_w w ON s.id = w.id)"""]


def translated(text: str, lang: str) -> str:
    whens = []
    for src, words in LX.GLOSSARY.items():
        m = "MAP {" + ", ".join(f"{q(k)}: {q(v)}" for k, v in words.items()) + "}"
        whens.append(f"WHEN {lang} = '{src}' THEN array_to_string(list_transform({tokens(text)}, lambda t: coalesce({m}[t], t)), ' ')")
    return (f"CASE WHEN {lang} = 'English' OR {lang} IS NULL THEN NULL {' '.join(whens)} ELSE {toktext(text)} END")


def top_sentences(src: str, out: str, n: int = 3) -> list[str]:
    return [
        f"""{out}_s AS (SELECT id, unnest({sentences('text')}) AS sentence,
          generate_subscripts({sentences('text')}, 1) - 1 AS pos FROM {src})""",
        f"""{out}_t AS (SELECT * FROM (SELECT id, pos, unnest({tokens('sentence')}) AS term FROM {out}_s) WHERE length(term) >= 3)""",
        f"{out}_f AS (SELECT id, term, count(*) AS tf FROM {out}_t GROUP BY 1, 2)",
        f"""{out}_b AS (SELECT id, pos FROM (SELECT id, pos, row_number() OVER (PARTITION BY id ORDER BY score DESC, pos) AS rk FROM (
          SELECT id, pos, {rnd('CAST(sum(tf) AS DOUBLE) / count(*)', 9)} AS score FROM {out}_t JOIN {out}_f USING (id, term) GROUP BY 1, 2))
          WHERE rk <= {n})""",
        f"""{out} AS (SELECT id, string_agg(trim(sentence), ' ' ORDER BY pos) AS summary
          FROM {out}_b JOIN {out}_s USING (id, pos) GROUP BY 1)""",
    ]


def marked(text: str, terms: list[str]) -> str:
    pat = " (" + "|".join(terms) + ") "
    return (f"array_to_string(list_transform(list_filter({sentences(text)}, lambda s: regexp_matches(' ' || "
            f"{toktext('s')} || ' ', {q(pat)})), lambda s: trim(s)), ' ')")


def insights(summary: str, text: str, urgent, follow) -> str:
    return (f"('INSIGHTS: ' || coalesce({summary}, '') || chr(10) || 'URGENT: ' || coalesce({marked(text, urgent)}, '') || chr(10) || "
            f"'FOLLOW-UP: ' || coalesce({marked(text, follow)}, ''))")


def first_field(text: str, pattern: str) -> str:
    return f"nullif(regexp_extract({text}, {q(pattern)}, 1), '')"


def all_fields(text: str, pattern: str, group: int = 1) -> str:
    e = f"regexp_extract_all({text}, {q(pattern)}, {group})"
    return f"CASE WHEN len({e}) > 0 THEN {e} END"


def fields(text: str, schema) -> dict[str, str]:
    out = {}
    for name, kind, pattern, group in schema:
        if kind == "array":
            out[name] = all_fields(text, pattern, group)
        elif kind == "number":
            out[name] = f"TRY_CAST(regexp_replace({first_field(text, pattern)}, '[$,]', '', 'g') AS DOUBLE)"
        else:
            out[name] = first_field(text, pattern)
    return out
