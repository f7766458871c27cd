"""Keyword, vector and fused search over written index tables.

The index is three tables: postings (term, id, tf, doc_len), term statistics and the
corpus size. Postings are range-partitioned by (term, id), and the words of a question are
pushed into the scan as literals: it reads the row groups that can hold them, and a word
found in a third of all documents is spread over many files. Vectors are laid out by
bucket in the same way. Query terms are broadcast after a size check; beyond it the join
shuffles.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.numbers import rounded
from ..session import broadcast_if_small, fresh_path, materialize
from . import vectors as V

K1, B = 1.2, 0.75
# Distinct words of a set of questions that are pushed into the scan as literals.
PUSHED_KEYS = 1000


@dataclass
class Index:
    postings: DataFrame  # term, id, tf, doc_len
    terms: DataFrame  # term, df
    n_docs: int
    total_len: int
    vectors: DataFrame | None = None  # id, bucket, w


def postings_of(corpus: DataFrame, id_col: str = "id", col: str = "text") -> DataFrame:
    return V.term_counts(corpus, id_col, col).select("term", id_col, "tf", "doc_len")


def write_sorted(df: DataFrame, name: str, *keys: str) -> DataFrame:
    """A written table whose files and row groups are sorted by the keys."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sorted_postings(words: DataFrame, id_col: str = "id") -> DataFrame:
    """Postings of (id, doc_len, term, tf) rows: rows of one id and length add up behind the one exchange that sorts."""
    n = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = words.repartitionByRange(n, "term", id_col).groupBy("term", id_col, "doc_len").agg(F.sum("tf").alias("tf"))
    return dealt.select("term", id_col, "tf", "doc_len").sortWithinPartitions("term", id_col)


def write_postings(words: DataFrame, id_col: str = "id") -> DataFrame:
    return materialize(sorted_postings(words, id_col), "postings")


def index_of(postings: DataFrame, id_col: str = "id", with_vectors: bool = False, lengths: DataFrame | None = None) -> Index:
    """Statistics of a postings table; (id, doc_len) of its documents spares reading them off the postings."""
    terms = materialize(postings.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "terms")
    docs = (postings if lengths is None else lengths).groupBy(id_col).agg(F.max("doc_len").alias("n"))
    r = docs.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("t"), F.count(id_col).alias("ids")).first()
    # Written before they are sorted, as the range exchange would work them out a second time to draw its bounds.
    vecs = write_sorted(materialize(V.embed_counts(postings, id_col, r["ids"], terms), "unit-vectors"), "vectors", "bucket", id_col) if with_vectors else None
    return Index(postings, terms, r["n"], r["t"] or 0, vecs)


def build_index(corpus: DataFrame, id_col: str = "id", col: str = "text", with_vectors: bool = False) -> Index:
    # Written once, as the range exchange reads its input a second time to draw its bounds.
    counts = materialize(V.counted(corpus, id_col, col), "counted-words")
    lengths = counts.filter(F.size("words") > 0).select(id_col, "doc_len")
    return index_of(write_postings(V.word_rows(counts, id_col), id_col), id_col, with_vectors, lengths)


def query_terms(queries: DataFrame) -> DataFrame:
    """(query_id, term, qtf) of (query_id, query)."""
    return (queries.select("query_id", F.explode(X.token_array(F.col("query"))).alias("term")).filter(F.col("term") != "")
            .groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("qtf")))


def one_query(spark, text: str) -> DataFrame:
    return spark.createDataFrame([(0, text)], "query_id long, query string")


def _top(scored: DataFrame, k: int, id_col: str, part: list[str] = ["query_id"]) -> DataFrame:
    """k best per query; every task first cuts its own share to k."""
    w = W.partitionBy(*part).orderBy(F.desc("score"), id_col)
    return scored.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= k)


def _only(table: DataFrame, queries: DataFrame, key: str) -> DataFrame:
    """``table`` with the keys of the queries as literals, so that the scan skips all row groups
    and files (they are sorted by the key) without one. Too many keys are left to the join."""
    keys = [r[0] for r in queries.select(key).distinct().limit(PUSHED_KEYS + 1).collect()]
    return table.filter(F.col(key).isin(keys)) if len(keys) <= PUSHED_KEYS else table


def score_lexical(index: Index, queries: DataFrame, id_col: str = "id", allowed: DataFrame | None = None) -> DataFrame:
    """BM25 score of every document that shares a term with a query: (query_id, id, score)."""
    avg = index.total_len / max(index.n_docs, 1)
    idf = F.log(F.lit(1.0) + (F.lit(float(index.n_docs)) - F.col("df") + 0.5) / (F.col("df") + F.lit(0.5)))
    q = query_terms(queries).join(index.terms, "term").select("query_id", "term", (F.col("qtf") * idf).alias("qw"))
    q = materialize(q, "query-terms")
    p = _only(index.postings, q, "term")
    tf = F.col("tf").cast("double")
    part = F.col("qw") * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("doc_len") / F.lit(float(avg))))
    scored = (p.join(broadcast_if_small(q), "term").groupBy("query_id", id_col).agg(F.sum(part).alias("s"))
              .select("query_id", id_col, rounded(F.col("s"), 6).alias("score")))
    # The attribute filter meets scored documents, not all postings.
    return scored if allowed is None else scored.join(allowed.select(id_col), id_col, "left_semi")


def search_lexical(index: Index, queries: DataFrame, k: int = 10, id_col: str = "id", allowed: DataFrame | None = None) -> DataFrame:
    return _top(score_lexical(index, queries, id_col, allowed), k, id_col)


def query_vectors(index: Index, queries: DataFrame) -> DataFrame:
    """Sparse unit vectors of the queries, weighted with the corpus statistics."""
    n = float(index.n_docs)
    idf = F.lit(1.0) + F.log((F.lit(1.0) + F.lit(n)) / (F.lit(1.0) + F.coalesce("df", F.lit(0))))
    raw = (query_terms(queries).join(index.terms, "term", "left")
           .select("query_id", V.bucket(F.col("term")).alias("bucket"), (F.col("qtf") * idf).alias("w"))
           .groupBy("query_id", "bucket").agg(F.sum("w").alias("w")))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(W.partitionBy("query_id")))
    return raw.select("query_id", "bucket", (F.col("w") / norm).alias("qw"))


def score_vector(index: Index, queries: DataFrame, id_col: str = "id", allowed: DataFrame | None = None) -> DataFrame:
    """Cosine of hashed word vectors with every document that shares a bucket: (query_id, id, score)."""
    q = materialize(query_vectors(index, queries), "query-vectors")
    v = _only(index.vectors, q, "bucket")
    scored = v.join(broadcast_if_small(q), "bucket").groupBy("query_id", id_col).agg(F.sum(F.col("w") * F.col("qw")).alias("s"))
    scored = scored.select("query_id", id_col, rounded(F.col("s"), 6).alias("score"))
    return scored if allowed is None else scored.join(allowed.select(id_col), id_col, "left_semi")


def search_vector(index: Index, queries: DataFrame, k: int = 10, id_col: str = "id", allowed: DataFrame | None = None) -> DataFrame:
    """k best by cosine of hashed word vectors."""
    return _top(score_vector(index, queries, id_col, allowed), k, id_col)


def ranked_all(scored: DataFrame, id_col: str = "id") -> DataFrame:
    """``scored`` with the rank of every row of its query.

    A query may hit a third of all documents, so its list is not sorted in one task: rows are
    range-partitioned by (query, score), ranked inside their partition, and the counts of the
    partitions before, a handful of rows, are added.
    """
    n = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["query_id", F.desc("score"), F.col(id_col)]
    parts = materialize(scored.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()), "ranked")
    counts = parts.groupBy("query_id", "part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("query_id", "part", (F.sum("n").over(W.partitionBy("query_id").orderBy("part")) - F.col("n")).alias("before"))
    inside = F.row_number().over(W.partitionBy("query_id", "part").orderBy(F.desc("score"), id_col))
    return parts.withColumn("inside", inside).join(before, ["query_id", "part"]).select(
        "query_id", id_col, "score", (F.col("inside") + F.col("before")).alias("rank"))


def search_hybrid(index: Index, queries: DataFrame, k: int = 10, rrf: int = 60, id_col: str = "id", allowed: DataFrame | None = None) -> DataFrame:
    """Reciprocal-rank fusion of the two whole ranked lists; ``allowed`` ids only, if given."""
    a = ranked_all(score_lexical(index, queries, id_col, allowed), id_col).select("query_id", id_col, (F.lit(1.0) / (rrf + F.col("rank"))).alias("r"))
    b = ranked_all(score_vector(index, queries, id_col, allowed), id_col).select("query_id", id_col, (F.lit(1.0) / (rrf + F.col("rank"))).alias("r"))
    fused = a.unionByName(b).groupBy("query_id", id_col).agg(F.sum("r").alias("s"))
    return _top(fused.select("query_id", id_col, rounded(F.col("s"), 6).alias("score")), k, id_col)


def search_filtered(index: Index, corpus: DataFrame, queries: DataFrame, filters: dict[str, list], columns: list[str],
                    k: int = 5, id_col: str = "id", hybrid: bool = False) -> DataFrame:
    """Best k among the documents with the wanted attributes, with chosen columns."""
    allowed = corpus
    for c, vals in filters.items():
        allowed = allowed.filter(F.col(c).isin(vals))
    search = search_hybrid if hybrid else search_lexical
    best = search(index, queries, k, id_col=id_col, allowed=allowed.select(id_col))
    return best.join(corpus.select(id_col, *columns), id_col)


def search_federated(indexes: dict[str, Index], queries: DataFrame, k: int = 5, id_col: str = "id", hybrid: bool = False) -> DataFrame:
    """The same questions over several corpora: k best per corpus and the overall rank."""
    out = None
    for source, ix in indexes.items():
        search = search_hybrid if hybrid else search_lexical
        part = search(ix, queries, k, id_col=id_col).withColumn("source_type", F.lit(source))
        out = part if out is None else out.unionByName(part)
    w = W.partitionBy("query_id").orderBy(F.desc("score"), "source_type", id_col)
    return out.withColumn("overall_rank", F.row_number().over(w).cast("long"))


def route_question(questions: DataFrame, tools: dict[str, str], min_share: float = 0.25) -> DataFrame:
    """Tools for each question (query_id, query): every tool whose words make up at least
    ``min_share`` of all hits. Questions without a hit go to all tools but the first."""
    spark = questions.sparkSession
    rows = [(t, w) for t, ws in tools.items() for w in ws.split()]
    lex = F.broadcast(spark.createDataFrame(rows, "tool string, term string"))
    hits = query_terms(questions).join(lex, "term").groupBy("query_id", "tool").agg(F.sum("qtf").alias("n"))
    total = F.sum("n").over(W.partitionBy("query_id"))
    chosen = hits.withColumn("share", F.col("n") / total).filter(F.col("share") >= min_share).select("query_id", "tool")
    rest = questions.join(hits.select("query_id").distinct(), "query_id", "left_anti").select(
        "query_id", F.explode(F.array(*[F.lit(t) for t in list(tools)[1:]])).alias("tool"))
    return chosen.unionByName(rest)
