"""Hashed word vectors and similarity over the stored embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from clinisift.operators import hashing as H
from clinisift.operators import inference as I
from clinisift.operators import vectors as V
from clinisift.session import materialize
from clinisift.sources import bindings as B

from . import text_sql as T
from .enrichment import DOCS, TOK, docs
from .sql_parts import rnd, with_

QUERIES, SQL = {}, {}


def add(name, fn, sql=None):
    QUERIES[name] = fn
    if sql:
        SQL[name] = sql


def vector_ctes(src: str, out: str) -> list[str]:
    """Sparse unit vectors of a tokenized source."""
    return [
        f"{out}_c AS MATERIALIZED (SELECT id, term, count(*) AS tf FROM {src}_tok WHERE term <> '' GROUP BY 1, 2)",
        f"{out}_d AS (SELECT term, count(*) AS df FROM {out}_c GROUP BY 1)",
        f"{out}_n AS (SELECT count(DISTINCT id) AS n FROM {out}_c)",
        f"""{out}_r AS (SELECT id, CAST(('0x' || left(md5(term), 8)) AS BIGINT) % 768 AS bucket,
          sum(tf * (1.0::DOUBLE + ln((1.0::DOUBLE + n) / (1.0::DOUBLE + df)))) AS w FROM {out}_c JOIN {out}_d USING (term), {out}_n GROUP BY 1, 2)""",
        f"{out} AS MATERIALIZED (SELECT id, bucket, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM {out}_r)",
    ]


add("embed", lambda s, d: V.embed(docs(s, d)).select("id", "bucket", F.round("w", 6).alias("w")),
    with_(DOCS, TOK, *vector_ctes("docs", "v"), q="SELECT id, bucket, round(w, 6) AS w FROM v"))

COS = "list_cosine_similarity(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[]))"


def vecs(s, d):
    return B.table(s, d, "embeddings").select("vec_id", "embedding")


def _pairs(s, d):
    """Every vector with the one that follows it."""
    v = B.table(s, d, "embeddings").select("vec_id")
    pairs = v.select(F.col("vec_id").alias("id_a"), (F.col("vec_id") + 1).alias("id_b"))
    return V.score_pairs(pairs, vecs(s, d))


add("score_pairs", _pairs,
    f"""SELECT a.vec_id AS id_a, b.vec_id AS id_b, {rnd(COS.format(a='a.embedding', b='b.embedding'), 6)} AS similarity
      FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
add("similarity_pairs", lambda s, d: V.similarity_pairs(vecs(s, d), 25),
    f"""SELECT a.vec_id AS id_a, b.vec_id AS id_b, {rnd(COS.format(a='a.embedding', b='b.embedding'), 6)} AS similarity
      FROM embeddings a, embeddings b WHERE a.vec_id < b.vec_id ORDER BY similarity DESC, id_a, id_b LIMIT 25""")
add("similarity_candidates", lambda s, d: V.similarity_join(vecs(s, d), 0.4),
    f"""WITH g AS (SELECT min(vec_id) AS rep, count(*) AS n, embedding FROM embeddings GROUP BY embedding)
      SELECT a.rep AS id_a, b.rep AS id_b, {rnd(COS.format(a='a.embedding', b='b.embedding'), 6)} AS similarity, a.n AS copies_a, b.n AS copies_b
      FROM g a, g b WHERE a.rep < b.rep AND {rnd(COS.format(a='a.embedding', b='b.embedding'), 6)} >= 0.4""")


def _neighbors(s, d):
    """Neighbours of the first vector of every label."""
    e = B.table(s, d, "embeddings")
    q = e.groupBy("label").agg(F.min("vec_id").alias("vec_id")).select("vec_id")
    return V.nearest_neighbors(vecs(s, d), vecs(s, d).join(q, "vec_id"), 5)


add("nearest_neighbors", _neighbors,
    f"""SELECT query_id, rank, neighbor_id, similarity FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, neighbor_id) AS rank
      FROM (SELECT q.vec_id AS query_id, e.vec_id AS neighbor_id, {rnd(COS.format(a='q.embedding', b='e.embedding'), 6)} AS similarity
        FROM (SELECT * FROM embeddings WHERE vec_id IN (SELECT min(vec_id) FROM embeddings GROUP BY label)) q, embeddings e WHERE e.vec_id <> q.vec_id))
      WHERE rank <= 5""")


def _neighbors_by_id(s, d):
    """Neighbours of every vector whose id is divisible by 100, so that the queries grow with the table."""
    v = vecs(s, d)
    return V.nearest_neighbors(v, v.filter(F.col("vec_id") % 100 == 0), 5)


add("nearest_neighbors_by_id", _neighbors_by_id,
    f"""SELECT query_id, rank, neighbor_id, similarity FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, neighbor_id) AS rank
      FROM (SELECT q.vec_id AS query_id, e.vec_id AS neighbor_id, {rnd(COS.format(a='q.embedding', b='e.embedding'), 6)} AS similarity
        FROM embeddings q, embeddings e WHERE q.vec_id % 100 = 0 AND e.vec_id <> q.vec_id))
      WHERE rank <= 5""")


def _documents_by_hash(s, d):
    """Documents whose own word vectors point the same way."""
    v = B.table(s, d, "documents").select("doc_id", V.text_vector(F.col("text")).alias("embedding"))
    return H.similarity_join_by_hash(materialize(v, "text-vectors"), 0.95, id_col="doc_id")


# Hashed candidates: no SQL, as a few pairs at the threshold may be missed; recall is tested.
add("similarity_by_hash", lambda s, d: H.similarity_join_by_hash(vecs(s, d), 0.4))
add("document_similarity", _documents_by_hash)


def _echo(prompts):
    """Stand-in for a model: the length of the prompt."""
    return [f"answer:{len(p)}" for p in prompts]


def _infer(s, d):
    rows, _ = I.batch_infer(docs(s, d), "id", I.INSIGHT_PROMPT, F.col("text"), _echo)
    return rows


add("batch_infer", _infer,
    with_(DOCS, q=f"""SELECT id, sha256({T.q(I.INSIGHT_PROMPT)} || text) AS prompt_hash,
      'answer:' || length({T.q(I.INSIGHT_PROMPT)} || text) AS response FROM docs"""))


def _prompts(s, d):
    """Prompts to be answered: distinct ones and rows they serve."""
    p = I.build_prompts(docs(s, d), "id", I.INSIGHT_PROMPT, F.col("text"))
    return p.groupBy("prompt_hash").agg(F.count(F.lit(1)).alias("n_rows"))


add("distinct_prompts", _prompts,
    with_(DOCS, q=f"SELECT sha256({T.q(I.INSIGHT_PROMPT)} || text) AS prompt_hash, count(*) AS n_rows FROM docs GROUP BY 1"))
