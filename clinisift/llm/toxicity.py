"""Toxicity by cumulative-link ordinal regression over sparse word features."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinisift.session import materialize

from .common import tidy_batches
from .words import row_words

#: Labelled rows the model is fitted on, at most: those with the smallest hashes of their ids.
SAMPLE_ROWS = 12_000
#: Words must stand out this much (standard errors of the log odds) in toxic rows to be a feature.
STAND_OUT = 3.5
#: Severity grades, 0 among them.
GRADES = 4


@dataclass(frozen=True)
class SeverityModel:
    """Shared weights over sorted word hashes and ordered thresholds, one per grade above 0."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray
    reject: float = 0.5

    def at_least(self, eta: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ... by row."""
        return 1 / (1 + np.exp(-np.clip(eta[:, None] - self.thresholds[None, :], -60, 60)))


def _present(features: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Numbers of the features that occur among the word hashes."""
    if not len(features) or not len(words):
        return np.empty(0, np.int64)
    at = np.minimum(np.searchsorted(features, words), len(features) - 1)
    return np.unique(at[features[at] == words])


def _distinct_words(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(doc_id, label, words): the distinct word hashes of one row for each id of the small table
    ``chosen`` (doc_id, label), written once.

    No text is shuffled: first the hash of the row that stands for an id is found (of several
    texts the one with the smallest hash), then the tasks that hold that row count its words.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("mark"))
    picked = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("mark").alias("mark"))
    rows = texts.join(F.broadcast(materialize(picked, "labelled-rows")), ["doc_id", "mark"]).select("doc_id", "label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()  # repeated rows of an id: one from each task is enough
        for b in batches:
            new = np.zeros(b.num_rows, bool)
            for k, i in enumerate(b.column(0).to_pylist()):
                new[k] = i not in seen
                seen.add(i)
            b = b.filter(pa.array(new))
            words = [np.unique(w).view(np.int64) for _, w in row_words(b.column(2), letters=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(words, pa.list_(pa.int64()))], ["doc_id", "label", "words"])

    words = rows.mapInArrow(tidy_batches(run), f"doc_id {kind}, label int, words array<bigint>")
    return materialize(words.dropDuplicates(["doc_id"]), "labelled-words")


def _standing_out(words: DataFrame, stand_out: float) -> DataFrame:
    """(doc_id, label, words) with those words only that may pass the test of ``fit_rows``, which decides."""
    n = words.agg(F.count(F.when(F.col("label") > 0, 1)).alias("n1"), F.count(F.when(F.col("label") <= 0, 1)).alias("n0")).first()
    each = words.select("doc_id", "label", F.explode("words").alias("word"))
    in1, in0 = F.col("in1"), F.col("in0")
    odds = F.log((in1 + 0.5) / (F.lit(n.n1) - in1 + 0.5)) - F.log((in0 + 0.5) / (F.lit(n.n0) - in0 + 0.5))
    error = F.sqrt(1 / (in1 + 0.5) + 1 / (in0 + 0.5))
    # Spark's logarithms may differ from numpy's in the last digit.
    passing = (
        each.groupBy("word").agg(F.count(F.when(F.col("label") > 0, 1)).alias("in1"), F.count(F.when(F.col("label") <= 0, 1)).alias("in0"))
        .filter((in1 >= 3) & (odds / error >= stand_out - 1e-6) & (odds > 2 - 1e-6)).select("word"))
    found = each.join(passing, "word").groupBy("doc_id").agg(F.sort_array(F.collect_list("word")).alias("found"))
    return words.select("doc_id", "label").join(found, "doc_id", "left").select(
        "doc_id", "label", F.coalesce("found", F.array().cast("array<bigint>")).alias("words"))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, grades: int = GRADES, stand_out: float = STAND_OUT) -> SeverityModel:
    """Model fitted on at most ``sample_rows`` rows of ``labels`` (doc_id, toxic) joined to ``docs``,
    one for each id: of rows that share one, the text with the smallest hash. Only features reach the driver.

    The labels say only whether a row is toxic. Words that stand out in toxic rows are the
    features. A toxic row's grade is 1 with up to two of them, 2 with three to six, 3 (the
    last) with more; rows that are not toxic have grade 0.
    P(grade >= k) = 1 / (1 + exp(threshold_k - weights . presence)): one vector of weights
    for all grades, thresholds ordered by construction, found by gradient steps on the
    penalised likelihood.
    """
    chosen = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("label")).filter("doc_id IS NOT NULL AND label IS NOT NULL")
        .groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    table = _standing_out(_distinct_words(docs, materialize(chosen, "labelled-ids")), stand_out).toArrow().sort_by("doc_id")
    labels_ = table.column("label").to_numpy()
    lists = table.column("words").combine_chunks()
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    row = np.repeat(np.arange(len(labels_)), lists.value_lengths().to_numpy(zero_copy_only=False))
    word = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    return fit_rows(labels_, row, word, grades, stand_out)


def fit_rows(labels: np.ndarray, row: np.ndarray, word: np.ndarray, grades: int = GRADES, stand_out: float = STAND_OUT) -> SeverityModel:
    """``fit`` for labels by row and distinct (row, word) pairs."""
    toxic = labels > 0
    n1, n0 = int(toxic.sum()), int((~toxic).sum())
    if not n1 or not n0:  # nothing to learn: no row is toxic, or every one
        return SeverityModel(np.empty(0, np.uint64), np.empty(0), np.full(grades - 1, -50.0 if n1 else 50.0))
    names, number = np.unique(word, return_inverse=True)
    in1 = np.bincount(number, weights=toxic[row], minlength=len(names))
    in0 = np.bincount(number, minlength=len(names)) - in1
    odds = np.log((in1 + 0.5) / (n1 - in1 + 0.5)) - np.log((in0 + 0.5) / (n0 - in0 + 0.5))
    error = np.sqrt(1 / (in1 + 0.5) + 1 / (in0 + 0.5))
    keep = (odds / error >= stand_out) & (in1 >= 3) & (odds > 2)
    place = np.cumsum(keep) - 1
    used = keep[number]
    r, c = row[used], place[number[used]]
    hits = np.bincount(r, minlength=len(labels))
    grade = np.where(toxic, np.clip(np.floor(np.log2(hits + 1)), 1, grades - 1), 0).astype(int)
    weights, thresholds = _cumulative_link(r, c, int(keep.sum()), grade, grades)
    model = SeverityModel(names[keep], weights, thresholds)
    p = model.at_least(np.bincount(r, weights=weights[c], minlength=len(labels)))[:, 0]
    return replace(model, reject=_cutoff(p, toxic))


def _cutoff(p: np.ndarray, toxic: np.ndarray, alarm: float = 2.0) -> float:
    """The probability that parts the rows with the fewest misses plus ``alarm`` times the false alarms."""
    order = np.argsort(p, kind="stable")
    q = p[order]
    cost = np.r_[0, np.cumsum(toxic[order])] + alarm * ((~toxic).sum() - np.r_[0, np.cumsum(~toxic[order])])
    edge = np.r_[True, q[1:] > q[:-1], True]  # cuts between different values only
    k = np.flatnonzero(edge & (cost == cost[edge].min()))[-1]
    return float((q[k - 1] + q[k]) / 2) if 0 < k < len(q) else float(q[-1] + 1e-9) if k else float(q[0])


def _cumulative_link(
    row: np.ndarray, feature: np.ndarray, f: int, grade: np.ndarray, grades: int,
    steps: int = 1500, rate: float = 0.1, penalty: float = 0.1,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of the proportional-odds model by Adam on the mean penalised
    likelihood; (row, feature) lists the features that are present."""
    n = len(grade)
    w, base, gaps = np.full(f, 1.0), 2.0, np.zeros(grades - 2)
    p = np.r_[w, base, gaps]
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, steps + 1):
        w, base, gaps = p[:f], p[f], p[f + 1:]
        wide = np.exp(np.clip(gaps, -20, 5))
        theta = np.r_[-np.inf, base, base + np.cumsum(wide), np.inf]
        eta = np.bincount(row, weights=w[feature], minlength=n)
        low, high = theta[grade] - eta, theta[grade + 1] - eta
        s_low, s_high = (1 / (1 + np.exp(-np.clip(z, -60, 60))) for z in (low, high))
        s_low, s_high = np.where(grade == 0, 0.0, s_low), np.where(grade == grades - 1, 1.0, s_high)
        like = np.maximum(s_high - s_low, 1e-12)
        d_low, d_high = s_low * (1 - s_low) / like, s_high * (1 - s_high) / like
        g_eta = (d_high - d_low) / n  # of minus the mean log likelihood
        g_theta = np.array([(d_low[grade == k].sum() - d_high[grade == k - 1].sum()) / n for k in range(1, grades)])
        g_w = np.bincount(feature, weights=g_eta[row], minlength=f)
        g = np.r_[g_w + penalty / n * w, g_theta.sum(), np.cumsum(g_theta[::-1])[::-1][1:] * wide]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - rate * (1 - step / (steps + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return p[:f], np.r_[p[f], p[f] + np.cumsum(np.exp(np.clip(p[f + 1:], -20, 5)))]


def score(docs: DataFrame, model: SeverityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with all its columns, then severity, p_toxic and grade in a struct ``toxicity``.

    severity is the expected grade, the sum of P(grade >= k); grade is the most probable one.
    Map side only, whole texts. Null and empty texts have no features.
    """
    kind = "toxicity struct<severity: double, p_toxic: double, grade: int, toxic: boolean>"
    at = docs.columns.index(text_col)
    fields = ", ".join(f"`c{i}` {f.dataType.simpleString()}" for i, f in enumerate(docs.schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            eta = np.zeros(b.num_rows)
            for k, words in row_words(b.column(at), letters=True):
                eta[k] = model.weights[_present(model.features, words)].sum()
            p = model.at_least(eta)
            each = -np.diff(np.c_[np.ones(len(p)), p, np.zeros(len(p))], axis=1)
            result = pa.StructArray.from_arrays(
                [pa.array(p.sum(axis=1)), pa.array(p[:, 0]), pa.array(each.argmax(axis=1).astype(np.int32)), pa.array(p[:, 0] >= model.reject)],
                ["severity", "p_toxic", "grade", "toxic"])
            yield pa.RecordBatch.from_arrays([*b.columns, result], [*b.schema.names, "toxicity"])

    rows = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    names = [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)]
    return rows.mapInArrow(tidy_batches(run), f"{fields}, {kind}").select(*names, "toxicity")


def toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per row of ``docs``: doc_id, severity, p_toxic, grade, toxic (rejected: P(grade > 0) is above the
    cutoff that parts the labelled rows best, a false alarm counting as two misses). Words are
    runs of letters, so that symbols stuck to a word do not hide it.

    Defined cases: null and empty texts score as texts without any feature; labels of null
    ids, null labels and labels without a row are left out; without labels of both kinds no
    row is toxic (or, if all labels are, every row is); equal ids are scored row by row; an
    empty table gives no rows; further columns are ignored.
    """
    scored = score(docs.select("doc_id", "text"), fit(docs, labels, sample_rows))
    return scored.select("doc_id", "toxicity.*")
