"""Index tables and search over the given texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from clinisift.operators import retrieval as R
from clinisift.operators import vectors as V
from clinisift.sources import bindings as B

from . import shared
from . import text_sql as T
from . import vocabulary as VO
from .enrichment import DOCS, TOK, docs
from .similarity import vector_ctes
from .sql_parts import rnd, values, with_

QUERIES, SQL = {}, {}
_INDEX: dict[tuple, R.Index] = {}


def add(name, fn, sql=None):
    QUERIES[name] = fn
    if sql:
        SQL[name] = sql


def doc_index(s, d) -> R.Index:
    """Index of the documents, built at its first use."""
    key = (s.sparkContext.applicationId, d)
    if key not in _INDEX:
        _INDEX[key] = R.build_index(docs(s, d), with_vectors=True)
    return _INDEX[key]


def lexical_ctes(src: str, out: str, qsrc: str) -> list[str]:
    """BM25 of the queries (query_id, query) over a tokenized source."""
    return [
        f"{out}_p AS MATERIALIZED (SELECT id, term, count(*) AS tf FROM {src}_tok WHERE term <> '' GROUP BY 1, 2)",
        f"{out}_l AS (SELECT id, CAST(sum(tf) AS DOUBLE) AS dl FROM {out}_p GROUP BY 1)",
        f"{out}_m AS (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(dl) AS DOUBLE) / count(*) AS avgdl FROM {out}_l)",
        f"{out}_q AS (SELECT query_id, term, count(*) AS qtf FROM (SELECT query_id, unnest({T.tokens('query')}) AS term FROM {qsrc}) WHERE term <> '' GROUP BY 1, 2)",
        f"{out}_d AS (SELECT term, count(*) AS df FROM {out}_p GROUP BY 1)",
        f"""{out} AS (SELECT query_id, id, {rnd(f'''sum(qtf * ln(1.0::DOUBLE + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE))
          * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avgdl)))''', 6)} AS score
          FROM {out}_q JOIN {out}_d USING (term) JOIN {out}_p USING (term) JOIN {out}_l USING (id), {out}_m GROUP BY 1, 2)""",
    ]


def ranked(src: str, k: int | None = None, cols: str = "query_id, id, score") -> str:
    rows = f"SELECT {cols}, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM {src}"
    return f"SELECT * FROM ({rows}) WHERE rank <= {k}" if k else rows


ONE = values([(0, VO.QUESTION)], "query_id, query", "qs")
MANY = "qs AS (SELECT item_id AS query_id, text AS query FROM benchmark)"


def one(s):
    return R.one_query(s, VO.QUESTION)


add("build_index", lambda s, d: doc_index(s, d).postings.select("term", "id", "tf", "doc_len"),
    with_(DOCS, TOK, q="""SELECT term, id, tf, CAST(sum(tf) OVER (PARTITION BY id) AS BIGINT) AS doc_len FROM (
      SELECT term, id, count(*) AS tf FROM docs_tok WHERE term <> '' GROUP BY 1, 2)"""))
add("index_terms", lambda s, d: doc_index(s, d).terms,
    with_(DOCS, TOK, q="SELECT term, count(DISTINCT id) AS df FROM docs_tok WHERE term <> '' GROUP BY 1"))
add("search_lexical", lambda s, d: R.search_lexical(doc_index(s, d), one(s), 10),
    with_(DOCS, TOK, ONE, *lexical_ctes("docs", "x", "qs"), q=ranked("x", 10)))
add("search_batch", lambda s, d: R.search_lexical(
        doc_index(s, d), B.table(s, d, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query")), 5),
    with_(DOCS, TOK, MANY, *lexical_ctes("docs", "x", "qs"), q=ranked("x", 5)))


def qvec_ctes(out: str, vec: str, qsrc: str) -> list[str]:
    return [
        f"{out}_t AS (SELECT query_id, term, count(*) AS qtf FROM (SELECT query_id, unnest({T.tokens('query')}) AS term FROM {qsrc}) WHERE term <> '' GROUP BY 1, 2)",
        f"""{out}_r AS (SELECT query_id, CAST(('0x' || left(md5(term), 8)) AS BIGINT) % 768 AS bucket,
          sum(qtf * (1.0::DOUBLE + ln((1.0::DOUBLE + n) / (1.0::DOUBLE + coalesce(df, 0))))) AS w
          FROM {out}_t LEFT JOIN {vec}_d USING (term), {vec}_n GROUP BY 1, 2)""",
        f"{out}_u AS (SELECT query_id, bucket, w / sqrt(sum(w * w) OVER (PARTITION BY query_id)) AS qw FROM {out}_r)",
        f"{out} AS (SELECT query_id, id, {rnd('sum(w * qw)', 6)} AS score FROM {vec} JOIN {out}_u USING (bucket) GROUP BY 1, 2)",
    ]


add("search_vector", lambda s, d: R.search_vector(doc_index(s, d), one(s), 10),
    with_(DOCS, TOK, ONE, *vector_ctes("docs", "v"), *qvec_ctes("y", "v", "qs"), q=ranked("y", 10)))
add("search_hybrid", lambda s, d: R.search_hybrid(doc_index(s, d), one(s), 10),
    with_(DOCS, TOK, ONE, *vector_ctes("docs", "v"), *qvec_ctes("y", "v", "qs"), *lexical_ctes("docs", "x", "qs"),
          f"lists AS ({ranked('x')} UNION ALL {ranked('y')})",
          f"fused AS (SELECT query_id, id, {rnd('sum(1.0::DOUBLE / (60 + rank))', 6)} AS score FROM lists GROUP BY 1, 2)",
          q=ranked("fused", 10)))


def _filtered(s, d):
    corpus = B.table(s, d, "documents").select(F.col("doc_id").alias("id"), "lang", "source", "n_chars")
    return R.search_filtered(doc_index(s, d), corpus, one(s), {"lang": ["en", "fr"], "source": ["src1", "src2", "src5", "src7"]},
                             ["lang", "source", "n_chars"], 5)


def _filtered_hybrid(s, d):
    corpus = B.table(s, d, "documents").select(F.col("doc_id").alias("id"), "lang", "source", "n_chars")
    return R.search_filtered(doc_index(s, d), corpus, one(s), {"lang": ["de", "es"]}, ["lang"], 20, hybrid=True)


add("search_filtered_hybrid", _filtered_hybrid,
    with_(DOCS, TOK, ONE, *vector_ctes("docs", "v"), *qvec_ctes("y", "v", "qs"), *lexical_ctes("docs", "x", "qs"),
          "ok AS (SELECT doc_id AS id, lang FROM documents WHERE lang IN ('de', 'es'))",
          "xf AS (SELECT x.* FROM x JOIN ok USING (id))", "yf AS (SELECT y.* FROM y JOIN ok USING (id))",
          f"lists AS ({ranked('xf')} UNION ALL {ranked('yf')})",
          f"fused AS (SELECT query_id, id, {rnd('sum(1.0::DOUBLE / (60 + rank))', 6)} AS score FROM lists GROUP BY 1, 2)",
          q=f"SELECT r.*, lang FROM ({ranked('fused', 20)}) r JOIN ok USING (id)"))
add("search_filtered", _filtered,
    with_(DOCS, TOK, ONE, *lexical_ctes("docs", "x", "qs"),
          """f AS (SELECT x.* FROM x JOIN documents ON doc_id = id WHERE lang IN ('en', 'fr') AND source IN ('src1', 'src2', 'src5', 'src7'))""",
          q=f"SELECT r.*, lang, source, n_chars FROM ({ranked('f', 5)}) r JOIN documents ON doc_id = id"))
