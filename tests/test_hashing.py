"""Similar vectors by hash, against all products."""

import hashlib
import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from clinisift.operators import hashing as H
from clinisift.operators import vectors as V


def frame(spark, m, ids=None):
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids or range(len(m)), m)], "vec_id long, embedding array<float>")


def clustered(seed, n, dim, per=5, spread=0.35):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // per, dim))
    return (np.repeat(centres, per, axis=0) + spread * rng.normal(size=(n, dim))).astype(np.float32)


def exact(m, threshold):
    u = m.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    s = np.floor(u @ u.T * 1e6 + 0.5) / 1e6
    return {(i, j): s[i, j] for i, j in zip(*np.nonzero(np.triu(s >= threshold, 1)))}


@pytest.mark.parametrize("hot", [2048, 16])
def test_recall_and_exact_scores(spark, monkeypatch, hot):
    monkeypatch.setattr(H, "BUCKET", 64)
    monkeypatch.setattr(H, "HOT", hot)  # with 16 every bucket is split, and most parts are dealt into blocks
    m = clustered(5, 2000 if hot > 16 else 400, 32)
    want = exact(m, 0.8)
    got = {(r.id_a, r.id_b): r.similarity for r in H.similarity_join_by_hash(frame(spark, m), 0.8).collect()}
    assert len(want) > len(m) and set(got) <= set(want) and len(got) >= 0.9 * len(want)
    assert all(abs(got[p] - want[p]) < 2e-6 for p in got)


def test_one_direction_holds_a_third(spark, monkeypatch):
    monkeypatch.setattr(H, "BUCKET", 32)
    monkeypatch.setattr(H, "HOT", 32)
    m = clustered(6, 600, 16)
    m[:200] = m[0] + 0.01 * np.random.default_rng(1).normal(size=(200, 16))  # no hyperplane parts these
    m[200:260] = m[200]  # copies are one row
    got = H.similarity_join_by_hash(frame(spark, m), 0.9).collect()
    pairs = {(r.id_a, r.id_b) for r in got}
    assert {(i, j) for i in range(200) for j in range(i + 1, 200)} <= pairs
    assert {r.copies_a for r in got if r.id_a == 200} <= {60} and not any(200 < i < 260 for p in pairs for i in p)


def test_fewer_bands_where_pairs_are_closer():
    assert H.plan_bands(10**6, 0.95).n < H.plan_bands(10**6, 0.8).n <= H.MAX_BANDS
    assert all(H.plan_bands(n, t).n <= H.MAX_BANDS for n in (0, 1, 10**9) for t in (0.4, 0.9, 1.0))
    b = H.plan_bands(10**7, 0.9)
    assert 1 - (1 - H.chance(b.bits, 0.9)) ** b.n >= 0.95


def test_vectors_without_direction_and_empty_table(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [None, 1.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert [tuple(r) for r in H.similarity_join_by_hash(df, 0.9).collect()] == [(1, 2, 1.0, 1, 1)]
    assert H.similarity_join_by_hash(df.limit(0), 0.9).count() == 0


def test_given_vectors_recall(spark):
    e = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding")
    want = {(r.id_a, r.id_b) for r in V.similarity_join(e, 0.4).collect()}
    got = {(r.id_a, r.id_b) for r in H.similarity_join_by_hash(e, 0.4).collect()}
    assert got <= want and len(got) >= 0.9 * len(want)


def test_sketches_are_sent_once_per_block_and_vectors_only_for_candidates(spark, monkeypatch):
    """Cells and blocks of a few rows, hot buckets: every pair is a candidate once, and what is sent for a vector does not grow with the bands."""
    m = clustered(7, 600, 24)
    v = frame(spark, m).selectExpr("vec_id AS rep", "embedding AS vec")
    bands = H.Bands(12, 3, 1)
    sent = H.in_cells(H.sketch_rows(v, bands), 4).groupBy("rep").agg({"sketch": "count"}).collect()
    assert len(sent) == 600 and {r[1] for r in sent} == {4}
    monkeypatch.setattr(H, "HOT", 64)
    rows = H.sketch_rows(v, bands).toPandas()
    x, y = H.Sketches(rows.iloc[:300], bands), H.Sketches(rows.iloc[300:], bands)
    hot = {0: np.array([1, 2]), 5: np.arange(8)}
    for a, b, same in ((x, y, False), (x, x, True)):
        got = list(zip(*(z.tolist() for z in H.candidates(a, b, bands, hot, 300, same)), strict=True))
        want = set()
        for i in range(300):
            for j in range(300):
                agree = bands.width - int(np.bitwise_count(a.words[i] ^ b.words[j]).sum())
                meets = any(a.bucket[i, k] == b.bucket[j, k] and (a.bucket[i, k] not in hot.get(k, []) or int(a.part[i, k] ^ b.part[j, k]).bit_count() <= 2)
                            for k in range(bands.n))
                if agree >= 300 and meets and a.rep[i] < b.rep[j]:
                    want.add((a.rep[i], b.rep[j]))
        assert len(got) == len(set(got)) and set(got) == want and len(want) > 20


def peak_of(run):
    tracemalloc.start()
    try:
        kept = run()
        return kept, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_sketches_are_taken_apart_in_slices():
    bands = H.Bands(40, 9, 1)
    rng = np.random.default_rng(3)
    rows = pd.DataFrame({"rep": np.arange(16384), "sketch": [r.tobytes() for r in rng.integers(0, 256, (16384, bands.width // 8), dtype=np.uint8)]})
    x, most = peak_of(lambda: H.Sketches(rows, bands))
    assert most < 4 * (x.words.nbytes + x.bucket.nbytes + x.part.nbytes)


@pytest.mark.parametrize("bits", [2, 8])
def test_short_vectors_are_scored_where_they_meet(bits):
    """As candidates by sketches that are scored after, in whole blocks (few bits) and by buckets; parts stay small."""
    m = clustered(11, 700, 16, per=20)
    bands = H.Bands(6, bits, 1)
    parts = [H.Vectors(pa.table({"rep": np.arange(at, 700, 2), "vec": pa.array(m[at::2].tolist(), pa.list_(pa.float32()))}), bands) for at in (0, 1)]
    hot = {0: np.array([1, 2]), 3: np.arange(4)}
    want = exact(m, 0.8)
    for x, y in ((parts[0], parts[1]), (parts[1], parts[1])):
        a, b = H.candidates(x, y, bands, hot, 300, x is y)
        expected = {p: want[p] for p in zip(a.tolist(), b.tolist(), strict=True) if p in want}
        got = [list(zip(*(c.tolist() for c in part), strict=True)) for part in H.near_parts(x, y, bands, hot, 300, 0.8, x is y)]
        flat = [r for part in got for r in part]
        assert len(flat) == len({r[:2] for r in flat}) and len(expected) > 20
        assert {r[:2] for r in flat} == set(expected) and all(abs(r[2] - expected[r[:2]]) < 2e-6 for r in flat)


def test_tasks_hand_on_what_they_find(monkeypatch):
    """A crowd in which all are near each other: neither candidates nor hits are held together."""
    monkeypatch.setattr(H, "CELL", 1 << 12)
    monkeypatch.setattr(H, "ROWS", 1 << 12)
    m = np.ones((400, 16)) + 0.01 * np.random.default_rng(2).normal(size=(400, 16))
    bands = H.Bands(3, 2, 1)
    x = H.Vectors(pa.table({"rep": np.arange(400), "vec": pa.array(m.tolist())}), bands)
    for parts, names in ((H.candidate_parts(x, x, bands, {}, 0, True), ("a", "b")), (H.near_parts(x, x, bands, {}, 0, 0.9, True), H.HITS)):
        sizes = [b.num_rows for b in H.handed_on(parts, names)]
        assert sum(sizes) == 400 * 399 // 2 and max(sizes) <= 2 << 12


def test_only_the_vectors_of_one_cell_are_held():
    vec = pa.list_(pa.float64())
    unit = [[1.0, 0.0], [0.6, 0.8], [0.0, 1.0], [2.0, 0.0]]
    rows = [(0, 0, 1, None, unit[0]), (0, 0, 2, None, unit[1]), (0, 0, 2, None, unit[3]), (0, 0, 1, 2, None), (0, 1, 3, None, unit[2]), (0, 1, 2, None, unit[1]),
            (0, 1, 2, 3, None), (0, 1, 2, 3, None)]
    kind = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("vec", vec)])
    table = pa.Table.from_pylist([dict(zip(kind.names, r, strict=True)) for r in rows], kind)
    for size in (1, 3, 100):
        got = [r for part in H.scored_pairs(iter(table.to_batches(max_chunksize=size)), 0.5) for r in zip(*(c.tolist() for c in part), strict=True)]
        assert sorted(got) == [(1, 2, 0.6), (1, 2, 1.0), (2, 3, 0.8), (2, 3, 0.8)]


def test_vectors_of_words_as_by_hand(monkeypatch):
    monkeypatch.setattr(V, "SLICE_BYTES", 8)
    texts = ["a b a", "", None, "é", "a  b", "one two three four five six seven"]
    got = V.word_vectors(pa.array(texts)).to_pylist()
    for text, vector in zip(texts, got, strict=True):
        n = np.zeros(V.DIM)
        for w in (text or "").split():
            n[int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % V.DIM] += 1
        assert vector is None if not n.any() else vector == (n / np.sqrt(n @ n)).astype(np.float32).tolist()
    assert V.word_vectors(pa.array([], pa.string())).to_pylist() == []
