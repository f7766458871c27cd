"""Hashed word vectors, and exact similarity over stored embeddings.

Copies are collapsed first, then blocks of distinct vectors meet block by block: numpy
multiplies two blocks inside a task, Spark decides which meet where, and only hits leave.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.numbers import rounded
from ..session import join_hot_split, materialize

DIM = 768
# Bytes of text whose words are counted together.
SLICE_BYTES = 4 << 20


def bucket(term) -> "F.Column":
    """Bucket of a word: first 32 bits of its MD5, modulo the dimension."""
    return (F.conv(F.left(F.md5(term), F.lit(8)), 16, 10).cast("long") % DIM).cast("long")


def counted(df: DataFrame, id_col: str = "id", col: str = "text") -> DataFrame:
    """(id, doc_len, words), one row per row: the distinct words of the text with their counts, as
    (term, tf). They are counted where the text lies; no row per occurrence is made."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), pc.fill_null(batch.column(1), "")
            sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
            # Slices of about SLICE_BYTES of text; a longer text is one of its own.
            edges = np.r_[0, np.flatnonzero(np.diff(sizes // SLICE_BYTES)) + 1, len(sizes)]
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                lists = pc.split_pattern(texts.slice(lo, hi - lo), " ")
                lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
                codes = lists.flatten().dictionary_encode()
                width = max(1, len(codes.dictionary))
                key = np.repeat(np.arange(hi - lo, dtype=np.int64), lengths) * width + codes.indices.to_numpy(zero_copy_only=False)
                key, tf = np.unique(key, return_counts=True)
                terms = codes.dictionary.take(pa.array(key % width))
                real = pc.not_equal(terms, "").to_numpy(zero_copy_only=False)  # a text without words is one empty string
                words = pa.StructArray.from_arrays([terms.filter(pa.array(real)), pa.array(tf[real].astype(np.int64))], ["term", "tf"])
                starts = np.searchsorted(key[real] // width, np.arange(hi - lo + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), pa.array(lengths), pa.ListArray.from_arrays(pa.array(starts), words)], ["id", "doc_len", "words"])

    rows = df.select(F.col(id_col).alias("id"), X.token_text(F.col(col)).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, doc_len long, words array<struct<term: string, tf: bigint>>").withColumnRenamed("id", id_col)


def word_rows(counts: DataFrame, id_col: str = "id") -> DataFrame:
    """(id, doc_len, term, tf) of :func:`counted`; ids that several rows have are not added up."""
    return counts.select(id_col, "doc_len", F.explode("words").alias("w")).select(id_col, "doc_len", "w.term", "w.tf")


def term_counts(df: DataFrame, id_col: str = "id", col: str = "text") -> DataFrame:
    """(id, term, tf) with the document length on every row."""
    return word_rows(counted(df, id_col, col), id_col).groupBy(id_col, "doc_len", "term").agg(F.sum("tf").alias("tf"))


def embed(df: DataFrame, id_col: str = "id", col: str = "text") -> DataFrame:
    """Sparse unit vectors (id, bucket, w): tf * (1 + ln((1+N)/(1+df))) summed per bucket."""
    counts = materialize(term_counts(df, id_col, col), "embed-terms")
    return embed_counts(counts, id_col)


def embed_counts(counts: DataFrame, id_col: str = "id", n: int | None = None, terms: DataFrame | None = None) -> DataFrame:
    """The same from a written (id, doc_len, term, tf) table; the number of its ids and (term, df)
    are worked out from it unless they are given."""
    n = counts.agg(F.count_distinct(id_col)).first()[0] if n is None else n
    idf = F.lit(1.0) + F.log((F.lit(1.0) + F.lit(float(n))) / (F.lit(1.0) + F.col("df")))
    # Weight and bucket are worked out once per word, not once per occurrence.
    words = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df")) if terms is None else terms
    words = materialize(words.select("term", "df", idf.alias("idf"), bucket(F.col("term")).alias("bucket")), "embed-words")
    raw = (
        join_hot_split(counts.select(id_col, "term", "tf"), words, ["term"], "df")
        .select(id_col, "bucket", (F.col("tf") * F.col("idf")).alias("w"))
        # Words of one document seldom share a bucket: one exchange by document serves the
        # bucket sums and the norm.
        .repartition(id_col)
        .groupBy(id_col, "bucket").agg(F.sum("w").alias("w"))
    )
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(W.partitionBy(id_col)))
    return raw.select(id_col, "bucket", (F.col("w") / norm).alias("w"))


def text_vector(text: Column) -> Column:
    """Unit vector of a text's word counts in hashed buckets, NULL without words.

    It depends on the text alone, so vectors of different batches can be compared; corpus
    weights belong to a search index (:func:`embed_counts`), where they are known.
    """

    @F.arrow_udf("array<float>")
    def spread(texts: pa.Array) -> pa.Array:
        return word_vectors(texts)

    return spread(X.token_text(text))


def word_vectors(texts: pa.StringArray) -> pa.ListArray:
    """The vectors of texts of words with single spaces between them; a distinct word of a slice is hashed once."""
    texts, out, none = pc.fill_null(texts, ""), [], []
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(texts):
        # Slices of about SLICE_BYTES of text and BLOCK rows at most; a longer text is one of its own.
        done = sizes[lo - 1] if lo else 0
        hi = min(lo + BLOCK, max(lo + 1, int(np.searchsorted(sizes, done + SLICE_BYTES, side="right"))))
        lists = pc.split_pattern(texts.slice(lo, hi - lo), " ")
        row = np.repeat(np.arange(hi - lo, dtype=np.int64), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        codes = lists.flatten().dictionary_encode()
        words = codes.dictionary.cast(pa.binary()).to_pylist()
        place = np.fromiter((int(hashlib.md5(w).hexdigest()[:8], 16) % DIM if w else -1 for w in words), np.int64, len(words))
        place = place[codes.indices.to_numpy(zero_copy_only=False)]
        real = place >= 0
        v = np.bincount(row[real] * DIM + place[real], minlength=(hi - lo) * DIM).reshape(hi - lo, DIM).astype(np.float64)
        norm = np.sqrt(np.einsum("ij,ij->i", v, v))
        out.append((v / np.where(norm == 0, 1.0, norm)[:, None]).astype(np.float32).ravel())
        none.append(norm == 0)
        lo = hi
    values = pa.array(np.concatenate([np.empty(0, np.float32), *out]))
    starts = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * DIM)
    return pa.ListArray.from_arrays(starts, values, mask=pa.array(np.concatenate([np.empty(0, bool), *none])))


def dense(sparse: DataFrame, id_col: str = "id", dim: int = DIM) -> DataFrame:
    """One array<float> per document; at most ``dim`` rows make one."""

    @F.pandas_udf("array<float>")
    def spread(b: pd.Series, w: pd.Series) -> pd.Series:
        out = []
        for i, x in zip(b, w):
            v = np.zeros(dim, dtype=np.float32)
            v[np.asarray(i, dtype=np.int64)] = np.asarray(x, dtype=np.float32)
            out.append(v)
        return pd.Series(out)

    rows = sparse.groupBy(id_col).agg(F.collect_list(F.struct("bucket", "w")).alias("s"))
    return rows.select(id_col, spread(F.col("s.bucket"), F.col("s.w")).alias("embedding"))


def dot(a, b) -> "F.Column":
    """Dot product of two arrays, summed in order as doubles."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def score_pairs(pairs: DataFrame, vectors: DataFrame, id_col: str = "vec_id", col: str = "embedding") -> DataFrame:
    """Cosine similarity of given pairs (id_a, id_b)."""
    a = vectors.select(F.col(id_col).alias("id_a"), F.col(col).alias("va"))
    b = vectors.select(F.col(id_col).alias("id_b"), F.col(col).alias("vb"))
    j = pairs.join(a, "id_a").join(b, "id_b")
    cos = dot(F.col("va"), F.col("vb")) / F.sqrt(dot(F.col("va"), F.col("va")) * dot(F.col("vb"), F.col("vb")))
    return j.select("id_a", "id_b", rounded(cos, 6).alias("similarity"))


# ---------------------------------------------------------------- similarity join

BLOCK = 1024
SLACK = 1e-6
# Centres that vectors are grouped around, at most, ranges of angles around each, and queries that
# meet a block together.
CENTRES, SHELLS, QUERIES = 1024, 16, 4096


def _unit(m: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(n == 0, 1.0, n)


def _round6(x):
    return np.floor(x * 1e6 + 0.5) / 1e6


def distinct_vectors(df: DataFrame, k: int, id_col: str = "vec_id", col: str = "embedding") -> DataFrame:
    """Groups of equal vectors: (rep, n_copies, first_ids, vec).

    ``first_ids`` holds the k + 1 smallest ids; no ranking of k pairs by (score, id, id)
    can need more of one group. They are cut per task before they meet.
    """
    v = df.select(F.col(id_col).alias("vid"), F.col(col).alias("vec")).withColumn("digest", F.sha2(F.to_json(F.struct("vec")), 256))
    salted = v.withColumn("salt", F.pmod(F.hash("vid"), F.lit(64)))
    top = W.partitionBy("digest", "salt").orderBy("vid")
    some = (salted.withColumn("rk", F.row_number().over(top)).filter(F.col("rk") <= k + 1)
            .groupBy("digest").agg(F.slice(F.array_sort(F.collect_list("vid")), 1, k + 1).alias("first_ids")))
    # The vector itself is read again for one id per group only.
    counts = v.groupBy("digest").agg(F.count(F.lit(1)).alias("n_copies"), F.min("vid").alias("rep"))
    reps = counts.join(some, "digest").drop("digest")
    return reps.join(v.select(F.col("vid").alias("rep"), "vec"), "rep")


def _pairs_in(vectors: DataFrame, min_cos: float, k: int | None) -> DataFrame:
    """Pairs of (rep, vec) rows scoring at least ``min_cos``; with ``k`` a task passes on its k best only.

    Rows are dealt into blocks by hash and every two blocks meet in one task, so each vector
    is sent once per block and nothing is held beyond two blocks. An exact answer over
    vectors without structure costs the square of their number in arithmetic; it never
    costs more than that in rows.
    """
    nb = max(1, -(-vectors.count() // BLOCK))
    blocked = vectors.select("rep", "vec", F.pmod(F.xxhash64("rep"), F.lit(nb)).cast("int").alias("b"))
    left = blocked.select(F.col("b").alias("i"), F.explode(F.sequence(F.col("b"), F.lit(nb - 1))).alias("j"), "rep", "vec", F.lit(True).alias("left"))
    right = blocked.select(F.explode(F.sequence(F.lit(0), F.col("b"))).alias("i"), F.col("b").alias("j"), "rep", "vec", F.lit(False).alias("left"))

    def multiply(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y = pdf[pdf["left"]], pdf[~pdf["left"]]
        if not len(x) or not len(y):
            return pd.DataFrame({"id_a": pd.Series(dtype="int64"), "id_b": pd.Series(dtype="int64"), "similarity": pd.Series(dtype="float64")})
        s = _unit(np.array(x["vec"].tolist(), dtype=np.float64)) @ _unit(np.array(y["vec"].tolist(), dtype=np.float64)).T
        xi, yi = x["rep"].to_numpy(), y["rep"].to_numpy()
        hit = s >= min_cos - SLACK
        if pdf["i"].iloc[0] == pdf["j"].iloc[0]:
            hit &= xi[:, None] < yi[None, :]
        if k is not None and hit.sum() > k:
            hit &= s >= np.partition(s[hit], -k)[-k] - SLACK
        i, j = np.nonzero(hit)
        out = pd.DataFrame({"id_a": np.minimum(xi[i], yi[j]), "id_b": np.maximum(xi[i], yi[j]), "similarity": _round6(s[i, j])})
        if k is not None:
            out = out.sort_values(["similarity", "id_a", "id_b"], ascending=[False, True, True]).head(k)
        return out

    return left.unionByName(right).groupBy("i", "j").applyInPandas(multiply, "id_a long, id_b long, similarity double")


def similarity_join(df: DataFrame, threshold: float, id_col: str = "vec_id", col: str = "embedding") -> DataFrame:
    """All pairs of distinct vectors with cosine >= threshold, and how often each occurs.

    Exact. Copies appear as one vector with a count, so a vector that makes up a third of
    the table adds one row per partner, not one per copy.
    """
    v = materialize(distinct_vectors(df, 0, id_col, col), "distinct-vectors")
    hits = _pairs_in(v, threshold, None).filter(F.col("similarity") >= F.lit(float(_round6(np.float64(threshold)))))
    n = v.select("rep", "n_copies")
    return (hits.join(n.select(F.col("rep").alias("id_a"), F.col("n_copies").alias("copies_a")), "id_a")
            .join(n.select(F.col("rep").alias("id_b"), F.col("n_copies").alias("copies_b")), "id_b")
            .select("id_a", "id_b", "similarity", "copies_a", "copies_b"))


def similarity_pairs(df: DataFrame, k: int = 20, id_col: str = "vec_id", col: str = "embedding") -> DataFrame:
    """The k most similar unordered pairs of the table, by (similarity, id_a, id_b)."""
    v = materialize(distinct_vectors(df, k, id_col, col), "distinct-vectors")
    order = [F.desc("similarity"), "id_a", "id_b"]
    best = _pairs_in(v, -1.0, k).orderBy(*order).limit(k)
    ids = v.select(F.col("rep"), "first_ids")
    # Ids behind the chosen vectors: up to k + 1 on either side of at most k pairs.
    spread = (
        best.join(ids.select(F.col("rep").alias("id_a"), F.col("first_ids").alias("fa")), "id_a")
        .join(ids.select(F.col("rep").alias("id_b"), F.col("first_ids").alias("fb")), "id_b")
        .select("similarity", F.explode("fa").alias("x"), "fb").select("similarity", "x", F.explode("fb").alias("y"))
        .select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"), "similarity")
    )
    # Equal vectors: the smallest id with the next k ids covers the first k pairs of a group.
    same = (
        v.filter(F.col("n_copies") > 1).select(F.explode("first_ids").alias("id_a"), "first_ids")
        .select("id_a", F.explode("first_ids").alias("id_b")).filter(F.col("id_a") < F.col("id_b"))
        .select("id_a", "id_b", F.lit(1.0).alias("similarity"))
    )
    return spread.unionByName(same).orderBy(*order).limit(k)


def shells(vectors: DataFrame, id_col: str = "vec_id", col: str = "embedding") -> tuple[DataFrame, np.ndarray, pd.DataFrame]:
    """(rows, centres, table): vectors grouped around centres, and what bounds their groups.

    Centres are at most CENTRES vectors, those with the smallest hashes of their ids. A shell holds
    the vectors that are nearest to one centre and lie within one of SHELLS ranges of angles
    from it; ``table`` has its smallest and largest angle, size and number of blocks, so that
    it has CENTRES * SHELLS rows at most. ``rows`` (id, vec, shell, block) is written once.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(col).alias("vec"))
    n = rows.count()
    chosen = rows.orderBy(F.xxhash64("id"), "id").limit(min(CENTRES, max(1, -(-n // BLOCK)))).toPandas()
    if not len(chosen):
        return rows.withColumns({"shell": F.lit(0), "block": F.lit(0)}), np.zeros((0, 0)), pd.DataFrame({"shell": [], "low": [], "high": [], "n": [], "blocks": []})
    centres = _unit(np.array(chosen["vec"].tolist(), dtype=np.float64))
    kind = rows.schema["vec"].dataType.simpleString()

    def place(parts):
        for p in parts:
            if len(p):
                s = _unit(np.array(p["vec"].tolist(), dtype=np.float64)) @ centres.T
                near = s.argmax(axis=1)
                angle = np.arccos(np.clip(s[np.arange(len(s)), near], -1, 1))
                yield p.assign(angle=angle, shell=near * SHELLS + np.minimum((angle / np.pi * SHELLS).astype(int), SHELLS - 1))

    placed = materialize(rows.mapInPandas(place, f"id {rows.schema['id'].dataType.simpleString()}, vec {kind}, angle double, shell int"), "shells")
    table = placed.groupBy("shell").agg(
        F.min("angle").alias("low"), F.max("angle").alias("high"), F.count(F.lit(1)).alias("n"), F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    table = materialize(table, "shell-bounds")
    dealt = placed.join(F.broadcast(table.select("shell", "blocks")), "shell")
    return dealt.select("id", "vec", "shell", F.pmod(F.xxhash64("id"), "blocks").cast("int").alias("block")), centres, table.orderBy("shell").toPandas()


def upper_bounds(s: np.ndarray, table: pd.DataFrame) -> np.ndarray:
    """Highest cosine that each query can have with any vector of each shell, from its cosines ``s`` with the
    centres: angles obey the triangle inequality."""
    angle = np.arccos(np.clip(s[:, table["shell"].to_numpy() // SHELLS], -1, 1))
    apart = np.maximum(0, np.maximum(angle - table["high"].to_numpy(), table["low"].to_numpy() - angle))
    return np.cos(apart)


def nearest_neighbors(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", col: str = "embedding") -> DataFrame:
    """The k nearest other vectors of every query vector, exactly.

    Vectors lie in shells around centres. A query first meets the shells that may hold its nearest
    vectors; their k-th score then rules out every shell whose bound is below it, before
    anything is shuffled. Vectors stay in their blocks: a block is sent once for each slice of
    QUERIES queries that ask it, never once for each other block. Without structure in the
    vectors no shell is ruled out and the answer takes all products.
    """
    rows, centres, table = shells(vectors, id_col, col)
    rows = materialize(rows, "shell-rows")
    asking = queries.select(F.col(id_col).alias("id"), F.col(col).alias("vec"))
    slices = max(1, -(-asking.count() // QUERIES))
    asking = asking.withColumn("slice", F.pmod(F.xxhash64("id"), F.lit(slices)).cast("int"))
    kind = ", ".join(f"{c} {asking.schema[c].dataType.simpleString()}" for c in ("id", "vec", "slice"))

    def best(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        found = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
        if len(x) and len(y):
            ids, asks = y["id"].to_numpy(), x["id"].to_numpy()
            s = _round6(_unit(np.array(x["vec"].tolist(), dtype=np.float64)) @ _unit(np.array(y["vec"].tolist(), dtype=np.float64)).T)
            s[asks[:, None] == ids[None, :]] = -np.inf
            kth = -np.partition(-s, min(k, len(ids)) - 1, axis=1)[:, min(k, len(ids)) - 1]
            i, j = np.nonzero((s >= kth[:, None]) & np.isfinite(s))
            order = np.lexsort((ids[j], -s[i, j], i))
            i, j = i[order], j[order]
            place = np.arange(len(i)) - np.searchsorted(i, i)
            i, j = i[place < k], j[place < k]
            found = [asks[i], ids[j], s[i, j]]
        return pd.DataFrame(dict(zip(("query_id", "neighbor_id", "similarity"), found, strict=True)))

    def ask(requests: DataFrame) -> DataFrame:
        """Best of the blocks of the shells that (id, vec, slice, shell) ask."""
        of = F.broadcast(blocks)
        asked = requests.join(of, "shell").select("id", "vec", "slice", "shell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        wanted = asked.select(F.col("shell").alias("to_shell"), F.col("block").alias("to_block"), F.col("slice").alias("to_slice")).distinct()
        sent = rows.join(wanted, (F.col("shell") == F.col("to_shell")) & (F.col("block") == F.col("to_block"))).drop("shell", "block")
        return asked.groupBy("shell", "block", "slice").cogroup(sent.groupBy("to_shell", "to_block", "to_slice")).applyInPandas(
            best, "query_id long, neighbor_id long, similarity double")

    blocks = rows.sparkSession.createDataFrame(table[["shell", "blocks"]].astype("int32") if len(table) else pd.DataFrame({"shell": [0], "blocks": [1]}), "shell int, blocks int")

    def plan(parts, later: bool):
        for p in parts:
            if not len(p) or not len(table):
                continue
            bound = upper_bounds(_unit(np.array(p["vec"].tolist(), dtype=np.float64)) @ centres.T, table)
            order = np.argsort(-bound, axis=1, kind="stable")
            before = np.cumsum(table["n"].to_numpy()[order], axis=1) - table["n"].to_numpy()[order]
            first = np.zeros(bound.shape, bool)
            np.put_along_axis(first, order, before < k + 1, axis=1)  # the query itself may be among them
            use = ~first & (bound >= p["kth"].to_numpy()[:, None] - SLACK) if later else first
            i, j = np.nonzero(use)
            yield p.iloc[i].drop(columns=["kth"] if later else []).assign(shell=table["shell"].to_numpy()[j].astype("int32"))

    one = materialize(ask(asking.mapInPandas(lambda parts: plan(parts, False), f"{kind}, shell int")), "neighbors-first")
    w = W.partitionBy("query_id").orderBy(F.desc("similarity"), "neighbor_id")
    kth = one.withColumn("place", F.row_number().over(w)).filter(F.col("place") == k).select(F.col("query_id").alias("id"), F.col("similarity").alias("kth"))
    known = asking.join(kth, "id", "left").fillna({"kth": -2.0}).select("id", "vec", "slice", "kth")
    two = ask(known.mapInPandas(lambda parts: plan(parts, True), f"{kind}, shell int"))
    return one.unionByName(two).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("long").alias("rank"), "neighbor_id", "similarity")
