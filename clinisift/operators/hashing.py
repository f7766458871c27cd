"""Similar vectors by locality-sensitive hashing: random hyperplanes, bands of buckets, exact scores.

A vector's signature in a band is the side of each of the band's hyperplanes it lies on. Vectors
that share a bucket are candidates if their sketches, the sides of all hyperplanes, agree in enough bits,
and are scored exactly: what is returned is right, what is missed is bounded by the number of bands, which
follows from the wanted recall. :func:`clinisift.operators.vectors.similarity_join` is the exact form.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from . import vectors as V

# Vectors that a bucket should hold, and beyond which it is hot and split by a second signature.
BUCKET, HOT = 512, 2048
# Vectors that are hashed together.
SLICE = 1024
# Bits of the second signature, and how many of them may differ where vectors meet in a hot bucket.
SPLIT_BITS, APART = 3, 2
# Hyperplanes of a sketch, at least, and standard deviations of agreement that candidates may lie below the mean.
SKETCH, DEVIATIONS = 512, 4.0
# Sketches of a block, pairs compared at a time, bytes of a block of vectors.
SKETCHES, CELL, BLOCK_BYTES = 1 << 16, 1 << 20, 16 << 20
# Vectors of so many times the bytes of a sketch, or fewer, are sent in its place.
SHORT = 8
# Rows that a task hands on together.
ROWS = 1 << 16
# Bands, at most: bits per band are taken away until the recall needs no more.
MAX_BANDS = 64


@dataclass(frozen=True)
class Bands:
    """How vectors are hashed: ``n`` bands of ``bits`` hyperplanes, and SPLIT_BITS more for hot buckets."""

    n: int
    bits: int
    seed: int

    @property
    def width(self) -> int:
        """Hyperplanes of a sketch: those of all bands, and more up to SKETCH."""
        return max(SKETCH, self.n * (self.bits + SPLIT_BITS))

    def planes(self, dim: int) -> np.ndarray:
        return np.random.default_rng(self.seed).standard_normal((dim, self.n * (self.bits + SPLIT_BITS)))

    def sides(self, unit: np.ndarray) -> np.ndarray:
        """The side of each hyperplane that every row lies on, those of the bands first."""
        planes = self.planes(unit.shape[1])
        more = np.random.default_rng([self.seed, 1]).standard_normal((unit.shape[1], self.width - planes.shape[1]))
        return np.concatenate([unit @ planes >= 0, unit @ more >= 0], axis=1)

    def signatures(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bucket and part of every row in every band."""
        side = (unit @ self.planes(unit.shape[1]) >= 0).reshape(len(unit), self.n, -1)
        return side[..., :self.bits] @ (1 << np.arange(self.bits)), side[..., self.bits:] @ (1 << np.arange(SPLIT_BITS))


def chance(bits: int, cosine: float) -> float:
    """Least probability that two vectors of this cosine meet in one band, also in a split bucket:
    they agree in all bits of the bucket and differ in one bit of the part at most (those that differ
    in two meet as well)."""
    p = 1 - math.acos(max(-1.0, min(1.0, cosine))) / math.pi
    return p**bits * (p**SPLIT_BITS + SPLIT_BITS * p**(SPLIT_BITS - 1) * (1 - p))


def least_agreement(width: int, threshold: float) -> int:
    """Sides that two vectors at the threshold agree in, at least: DEVIATIONS standard deviations below the mean
    (3e-5 of such pairs agree in fewer)."""
    p = 1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi
    return math.floor(width * p - DEVIATIONS * math.sqrt(width * p * (1 - p)) - 1e-6)


def plan_bands(n: int, threshold: float, recall: float = 0.95, seed: int = 42) -> Bands:
    """Bits from the number of vectors, bands from the recall at the threshold; with fewer bits
    buckets are larger and more of them are split, nothing is lost."""
    bits = max(1, int(math.log2(max(2, n / BUCKET))))

    def bands(b: int) -> int:
        p = chance(b, threshold)
        return 1 if p >= recall else math.ceil(math.log(1 - recall) / math.log(1 - p))

    while bits > 1 and bands(bits) > MAX_BANDS:
        bits -= 1
    return Bands(bands(bits), bits, seed)


def band_sizes(vectors: DataFrame, bands: Bands) -> DataFrame:
    """(band, bucket, n) over the rows (rep, vec); a task passes on counts."""
    def count(parts):
        for p in parts:
            for lo in range(0, len(p), SLICE):
                bucket, _ = bands.signatures(V._unit(np.array(p["vec"].iloc[lo:lo + SLICE].tolist(), dtype=np.float64)))
                key, n = np.unique(bucket.astype(np.int64) * bands.n + np.arange(bands.n), return_counts=True)
                yield pd.DataFrame({"band": (key % bands.n).astype(np.int32), "bucket": key // bands.n, "n": n})

    return vectors.select("vec").mapInPandas(count, "band int, bucket long, n long").groupBy("band", "bucket").agg(F.sum("n").alias("n"))


def sketch_rows(vectors: DataFrame, bands: Bands) -> DataFrame:
    """(rep, sketch) of (rep, vec): the sides of all hyperplanes, a bit each."""
    def sketch(parts):
        for p in parts:
            for lo in range(0, len(p), SLICE):
                some = p.iloc[lo:lo + SLICE]
                side = bands.sides(V._unit(np.array(some["vec"].tolist(), dtype=np.float64)))
                yield pd.DataFrame({"rep": some["rep"].to_numpy(), "sketch": [r.tobytes() for r in np.packbits(side, axis=1)]})

    return vectors.select("rep", "vec").mapInPandas(sketch, f"rep {vectors.schema['rep'].dataType.simpleString()}, sketch binary")


def blocks_of(spark: SparkSession, n: int, rows: int) -> int:
    """Blocks of ``rows`` rows or fewer, and so many that their pairs occupy all cores where that is worth it."""
    cells = 2 * spark.sparkContext.defaultParallelism
    return max(1, -(-n // rows), min(-(-n // SLICE), math.isqrt(2 * cells) + 1))


def in_cells(rows: DataFrame, blocks: int) -> DataFrame:
    """Every row in each cell (i, j), i <= j, of two blocks that its own block ``mine`` is one of."""
    mine = F.pmod(F.xxhash64("rep"), F.lit(blocks)).cast("int")
    meet = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda o: F.struct(F.least(o, F.col("mine")).alias("i"), F.greatest(o, F.col("mine")).alias("j")))
    return rows.withColumn("mine", mine).withColumn("meet", F.explode(meet)).select(*rows.columns, "mine", "meet.i", "meet.j")


class Sketches:
    """Sketches of some vectors, taken apart: words of 64 bits, buckets and parts in every band."""

    def __init__(self, rows: pd.DataFrame, bands: Bands):
        self._take(np.frombuffer(b"".join(rows["sketch"]), np.uint8).reshape(len(rows), -1), rows["rep"].to_numpy(), bands)

    def _take(self, raw: np.ndarray, rep: np.ndarray, bands: Bands) -> None:
        self.rep, self.words = rep, np.pad(raw, ((0, 0), (0, -raw.shape[1] % 8))).view(np.uint64)
        self.bucket, self.part = np.empty((len(raw), bands.n), np.int32), np.empty((len(raw), bands.n), np.uint8)
        bit, more = (1 << np.arange(bands.bits)).astype(np.int32), (1 << np.arange(SPLIT_BITS)).astype(np.uint8)
        for lo in range(0, len(raw), SLICE):  # a bit takes four bytes here
            side = np.unpackbits(raw[lo:lo + SLICE], axis=1)[:, :bands.n * (bands.bits + SPLIT_BITS)].reshape(-1, bands.n, bands.bits + SPLIT_BITS)
            self.bucket[lo:lo + SLICE] = side[..., :bands.bits] @ bit
            self.part[lo:lo + SLICE] = side[..., bands.bits:] @ more


class Vectors(Sketches):
    """Some vectors with the sketches they have: ``unit`` holds them in length one."""

    def __init__(self, rows: pa.Table, bands: Bands):
        self.unit = unit_rows(rows.column("vec").combine_chunks())
        side = [np.packbits(bands.sides(self.unit[lo:lo + SLICE]), axis=1) for lo in range(0, len(self.unit), SLICE)]
        self._take(np.concatenate(side), rows.column("rep").to_numpy(), bands)


def unit_rows(vectors: pa.ListArray) -> np.ndarray:
    """Rows of length one of an array of vectors that have one length; there is at least one."""
    return V._unit(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1))


def alike(x: Sketches, y: Sketches, i: np.ndarray, j: np.ndarray, k: int, hot: dict[int, np.ndarray]) -> np.ndarray:
    """Whether rows ``i`` of ``x`` and ``j`` of ``y`` meet in band ``k``."""
    found = x.bucket[i, k] == y.bucket[j, k]
    if k in hot:
        found &= ~np.isin(x.bucket[i, k], hot[k]) | (np.bitwise_count(x.part[i, k] ^ y.part[j, k]) <= APART)
    return found


def meeting(x: Sketches, y: Sketches, k: int, hot: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of ``x`` and of ``y`` that meet in band ``k``: groups of both. ``hot`` are its hot buckets, there parts
    meet that differ in APART bits at most."""
    ox, oy = np.argsort(x.bucket[:, k], kind="stable"), np.argsort(y.bucket[:, k], kind="stable")
    bx, by = x.bucket[ox, k], y.bucket[oy, k]
    for bucket in np.intersect1d(bx, by):
        some = ox[np.searchsorted(bx, bucket):np.searchsorted(bx, bucket, "right")]
        others = oy[np.searchsorted(by, bucket):np.searchsorted(by, bucket, "right")]
        if bucket not in hot:
            yield some, others
            continue
        for part in range(1 << SPLIT_BITS):
            near = np.bitwise_count(y.part[others, k] ^ np.uint8(part)) <= APART
            yield some[x.part[some, k] == part], others[near]


def candidate_parts(x: Sketches, y: Sketches, bands: Bands, hot: dict[int, np.ndarray], least: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (a < b) that meet in a band and agree in ``least`` sides of hyperplanes, each from the first band they meet in; at
    most CELL pairs are looked at for one part."""
    none = np.empty(0, np.int32)
    for k in range(bands.n):
        for some, others in meeting(x, y, k, hot.get(k, none)):
            step = max(1, CELL // max(1, len(others)))
            for lo in range(0, len(some), step):
                u = some[lo:lo + step]
                unlike = np.zeros((len(u), len(others)), np.uint16)
                for w in range(x.words.shape[1]):
                    unlike += np.bitwise_count(x.words[u, w][:, None] ^ y.words[others, w][None, :])
                i, j = np.nonzero(unlike <= bands.width - least)
                i, j = u[i], others[j]
                keep = x.rep[i] < y.rep[j] if same else x.rep[i] != y.rep[j]
                for e in range(k):  # a pair is handed on once, however many bands it meets in
                    keep &= ~alike(x, y, i, j, e, hot)
                a, b = x.rep[i[keep]], y.rep[j[keep]]
                yield np.minimum(a, b), np.maximum(a, b)


def candidates(x: Sketches, y: Sketches, bands: Bands, hot: dict[int, np.ndarray], least: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """All of :func:`candidate_parts`."""
    found = [(np.empty(0, np.int64), np.empty(0, np.int64)), *candidate_parts(x, y, bands, hot, least, same)]
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def near_parts(x: Vectors, y: Vectors, bands: Bands, hot: dict[int, np.ndarray], least: int, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, ...]]:
    """Candidates that score at least the threshold, with their scores: (a, b, similarity).

    Where buckets are so crowded that their pairs outnumber those of the two blocks, the blocks are multiplied as a
    whole and the bands are asked for the pairs that score enough; the pairs are the same.
    """
    none = np.empty(0, np.int32)
    met = sum(len(some) * len(others) for k in range(bands.n) for some, others in meeting(x, y, k, hot.get(k, none)))
    whole = met > len(x.rep) * len(y.rep)
    groups = [(None, np.arange(len(x.rep)), np.arange(len(y.rep)))] if whole else ((k, *g) for k in range(bands.n) for g in meeting(x, y, k, hot.get(k, none)))
    lowest = V._round6(np.float64(threshold))
    for k, some, others in groups:
        of_others = y.unit[others].T
        step = max(1, CELL // max(1, len(others)))
        for lo in range(0, len(some), step):
            u = some[lo:lo + step]
            i, j = np.nonzero(x.unit[u] @ of_others >= lowest - V.SLACK)
            i, j = u[i], others[j]
            keep = x.rep[i] < y.rep[j] if same else x.rep[i] != y.rep[j]
            keep &= np.bitwise_count(x.words[i] ^ y.words[j]).sum(axis=1) <= bands.width - least
            if whole:
                keep &= np.logical_or.reduce([alike(x, y, i, j, e, hot) for e in range(bands.n)])
            else:
                for e in range(k):
                    keep &= ~alike(x, y, i, j, e, hot)
            i, j = i[keep], j[keep]
            a, b, s = x.rep[i], y.rep[j], V._round6(np.einsum("ij,ij->i", x.unit[i], y.unit[j]))
            hit = s >= lowest
            yield np.minimum(a, b)[hit], np.maximum(a, b)[hit], s[hit]


def handed_on(parts: Iterator[tuple[np.ndarray, ...]], names: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """Batches of about ROWS rows of the columns in ``parts``, so that a task holds no more of its results."""
    held, n = [], 0
    for part in parts:
        if len(part[0]):
            held, n = [*held, part], n + len(part[0])
        if n >= ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], list(names))
            held, n = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], list(names))


def scored_pairs(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[tuple[np.ndarray, ...]]:
    """Hits (a, b, similarity) among rows (i, j, a, b, vec) in the order of i, j, b: of each cell (i, j) first the
    vectors of its ids ``a`` (b is null), then pairs of them. Only the vectors of one cell are held."""
    cell, reps, parts, unit, place = None, [], [], None, None
    for batch in batches:
        i, j = (batch.column(c).to_numpy() for c in (0, 1))
        edges = np.r_[0, np.flatnonzero((np.diff(i) != 0) | (np.diff(j) != 0)) + 1, len(i)]
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if lo == hi:
                continue
            if cell != (i[lo], j[lo]):
                cell, reps, parts, unit = (i[lo], j[lo]), [], [], None
            run = batch.slice(lo, hi - lo)
            first = run.column(3).null_count
            if first:
                reps.append(run.column(2).slice(0, first).to_numpy())
                parts.append(unit_rows(run.column(4).slice(0, first)))
            if first == hi - lo:
                continue
            if unit is None:
                unit = np.concatenate(parts)
                place, parts = pd.DataFrame({"rep": np.concatenate(reps), "at": np.arange(len(unit))}), []
            pairs = pd.DataFrame({name: run.column(c).slice(first).to_numpy() for name, c in (("a", 2), ("b", 3))})
            step = max(1, BLOCK_BYTES // (8 * unit.shape[1]))
            for at in range(0, len(pairs), step):
                some = pairs.iloc[at:at + step].merge(place, left_on="a", right_on="rep").merge(place, left_on="b", right_on="rep", suffixes=("_a", "_b"))
                s = V._round6(np.einsum("ij,ij->i", unit[some["at_a"].to_numpy()], unit[some["at_b"].to_numpy()]))
                hit = s >= V._round6(np.float64(threshold))
                yield some["a"].to_numpy()[hit], some["b"].to_numpy()[hit], s[hit]


HITS = ("id_a", "id_b", "similarity")


def pairs_by_hash(vectors: DataFrame, threshold: float, bands: Bands, n: int) -> DataFrame:
    """Pairs (id_a, id_b, similarity) of the written ``n`` rows (rep, vec) that share a bucket and score at least the threshold.

    Rows are sent once to each pair of blocks, where the bands are gone through in a task, not once to each band. In a hot
    bucket parts of the second signature meet that differ in APART bits at most. Of long vectors only sketches (a bit
    for each hyperplane) are sent to find candidates; the vectors follow once to each pair of blocks in which they have a
    candidate, and are scored exactly there. Short vectors are sent and scored at once. Candidates and hits leave
    a task as they are found, so it holds two blocks however many there are.
    """
    spark = vectors.sparkSession
    sizes = band_sizes(vectors, bands).filter(F.col("n") > HOT).toPandas()  # bands * n / HOT rows at most
    hot = {int(k): g["bucket"].to_numpy(np.int32) for k, g in sizes.groupby("band")}
    least = least_agreement(bands.width, threshold)
    dim = vectors.agg(F.max(F.size("vec"))).first()[0] or 1
    blocks = blocks_of(spark, n, max(1, BLOCK_BYTES // (8 * dim)))
    schema = "id_a long, id_b long, similarity double"

    def sides(batches: Iterator[pa.RecordBatch]) -> tuple[int, int, pa.Table, pa.Table]:
        rows = pa.Table.from_batches(list(batches))
        i, j, mine = rows.column("i")[0].as_py(), rows.column("j")[0].as_py(), rows.column("mine").to_numpy()
        return i, j, rows.filter(pa.array(mine == i)), rows.filter(pa.array(mine == j))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        i, j, one, two = sides(batches)
        if one.num_rows and two.num_rows:
            x = Vectors(one, bands)
            yield from handed_on(near_parts(x, x if i == j else Vectors(two, bands), bands, hot, least, threshold, i == j), HITS)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        i, j, one, two = sides(batches)
        if one.num_rows and two.num_rows:
            x = Sketches(one.to_pandas(), bands)
            yield from handed_on(candidate_parts(x, x if i == j else Sketches(two.to_pandas(), bands), bands, hot, least, i == j), ("a", "b"))

    if 4 * dim <= SHORT * bands.width // 8:
        hits = in_cells(vectors.select("rep", "vec"), blocks).groupBy("i", "j").applyInArrow(meet, schema)
        return hits.groupBy("id_a", "id_b").agg(F.max("similarity").alias("similarity"))

    rows = in_cells(sketch_rows(vectors, bands), blocks_of(spark, n, SKETCHES))
    pairs = materialize(rows.groupBy("i", "j").applyInArrow(find, "a long, b long"), "hash-candidates")
    block = {x: F.pmod(F.xxhash64(x), F.lit(blocks)).cast("int") for x in "ab"}
    dealt = pairs.select("a", "b", F.least(block["a"], block["b"]).alias("i"), F.greatest(block["a"], block["b"]).alias("j"))
    wanted = dealt.select(F.explode(F.array("a", "b")).alias("rep"), "i", "j").distinct()
    sent = wanted.join(vectors.select("rep", "vec"), "rep").select("i", "j", F.col("rep").alias("a"), F.lit(None).cast("long").alias("b"), "vec")
    met = sent.unionByName(dealt.select("i", "j", "a", "b", F.lit(None).cast(vectors.schema["vec"].dataType).alias("vec")))
    met = met.repartition("i", "j").sortWithinPartitions("i", "j", F.asc_nulls_first("b")).select("i", "j", "a", "b", "vec")
    hits = met.mapInArrow(lambda batches: handed_on(scored_pairs(batches, threshold), HITS), schema)
    # An id may have several vectors.
    return hits.groupBy("id_a", "id_b").agg(F.max("similarity").alias("similarity"))


def usable(df: DataFrame, col: str = "embedding") -> DataFrame:
    """Rows whose vector has a direction: not null, no null or non-finite component, not all zero."""
    x = F.col(col)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return df.filter(x.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(x, lambda v: v != 0))


def similarity_join_by_hash(df: DataFrame, threshold: float, recall: float = 0.95, id_col: str = "vec_id", col: str = "embedding", seed: int = 42) -> DataFrame:
    """As :func:`vectors.similarity_join`, by hash: (id_a, id_b, similarity, copies_a, copies_b).

    Every returned pair is right; a pair at the threshold is found with probability ``recall``,
    pairs above it with a higher one. Equal vectors are one row with a count. Rows without a
    direction (see :func:`usable`) take no part; an empty table gives no rows; vectors must have one length.
    """
    v = materialize(V.distinct_vectors(usable(df, col), 0, id_col, col).select("rep", "n_copies", "vec"), "distinct-vectors")
    count = v.count()
    hits = pairs_by_hash(v, threshold, plan_bands(count, threshold, recall, seed), count)
    n = v.select("rep", "n_copies")
    return (hits.join(n.select(F.col("rep").alias("id_a"), F.col("n_copies").alias("copies_a")), "id_a")
            .join(n.select(F.col("rep").alias("id_b"), F.col("n_copies").alias("copies_b")), "id_b")
            .select("id_a", "id_b", "similarity", "copies_a", "copies_b"))
