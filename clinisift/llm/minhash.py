"""MinHash near-duplicates: SuperMinHash signatures, banding, verification on full sets, union-find grouping."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinisift.session import broadcast_if_small, join_hot_split, materialize

from .common import bounded_broadcast, tidy_batches
from .near_dedup import components, shingles
from .words import mixed, row_words

#: Words in a shingle; shingles two documents must share, in hundredths of their union.
WORDS, PERCENT = 4, 80
#: Bands of a signature and components in each. Two documents that share 80 % of their union miss
#: each other in every band with probability (1 - 0.8^7)^72 = 4e-8, more similar ones less often;
#: documents that share 30 %, such as those with one long passage in common, meet in 2 of 100 cases.
BANDS, ROWS = 72, 7
#: Components of a signature: the first prime that has room for all bands.
SIZE = 509
#: Components are compared by two bits each before sets are. Pairs that agree in less than what a pair at
#: 80 % has on average minus so many standard deviations (a probability of 1e-10) are left out.
DEVIATIONS = 6.4
_WORDS = -(-SIZE // 32)
#: Elements that take their steps together.
CHUNK_ITEMS = 1 << 17
#: Pairs that one copy of a set is compared in; sets of hubs with more of them are copied per slice.
SLICE = 512
#: Star rounds, each over one of the parts of the bands, go on while more than so many pairs per posting are
#: left to test; in a round a document is tested against the centres of its so many largest buckets.
PAIRS_PER_POSTING, STAR_ROUNDS, PARTS, CENTRES = 4, 5, 4, 3
#: A bucket with more pairs of different labels than so many per member is crowded.
CROWDED = 4
#: Edges that one local union-find holds.
FOREST_EDGES = 1 << 19
_NONE = np.iinfo(np.uint64).max
_RANK = np.uint64(48)


def super_minhash(items: np.ndarray, owner: np.ndarray, sets: int, size: int = SIZE) -> np.ndarray:
    """Signatures (sets x size) of the sets whose element hashes are ``items``, ``owner`` naming the set of each.

    Every element ranks all components by a random permutation and, with step j, offers the
    component of rank j the value j + r (r uniform in [0, 1), kept as an integer). A component
    takes the least value offered. The ranks of one element differ in all components, which
    lowers the variance below that of independent hashes. All elements take step j together,
    so a component that has a value after it is final, and a set whose components all have
    one stops.

    The permutation of an element is j -> (first + j * pace) mod ``size`` (a prime), first and
    pace drawn from its hash: of these, two components have any two ranks equally often, and
    the variance of the estimate depends on pairs of components only.
    """
    out = np.full((sets, size), _NONE, np.uint64)
    owner = owner.astype(np.int64)
    draw = mixed(items + np.uint64(0x2545F4914F6CDD1D))
    low = draw & np.uint64(0xFFFFFFFF)
    at = (low * np.uint64(size) >> np.uint64(32)).astype(np.int64)
    pace = 1 + ((draw >> np.uint64(32)) * np.uint64(size - 1) >> np.uint64(32)).astype(np.int64)
    flat = out.ravel()
    for j in range(size):
        if not len(items):
            break
        cell = owner * size + at
        new = np.flatnonzero(flat[cell] == _NONE)
        r = mixed(items[new] + np.uint64((0x9E3779B97F4A7C15 * (j + 1)) % 2**64)) >> (np.uint64(64) - _RANK)
        np.minimum.at(flat, cell[new], np.uint64(j) << _RANK | r)
        heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        going = (out[owner[heads]] == _NONE).any(axis=1)
        if not going.all():
            keep = np.repeat(going, np.diff(np.r_[heads, len(owner)]))
            items, owner, at, pace = items[keep], owner[keep], at[keep], pace[keep]
        at = at + pace
        at -= size * (at >= size)
    return out


def bands_of(signatures: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key for each band of each signature; the band's number is part of it."""
    parts = signatures[:, :bands * rows].reshape(len(signatures), bands, rows)
    key = np.broadcast_to(np.arange(1, parts.shape[1] + 1, dtype=np.uint64), parts.shape[:2])
    for k in range(rows):
        key = mixed(key * np.uint64(0x100000001B3) + mixed(parts[:, :, k]))
    return key


def bits_of(signatures: np.ndarray) -> np.ndarray:
    """Two bits of each component, 32 components in a 64-bit number."""
    two = np.zeros((len(signatures), _WORDS * 32), np.uint64)
    two[:, :SIZE] = mixed(signatures) & np.uint64(3)
    two = two.reshape(len(signatures), _WORDS, 32)
    return np.bitwise_or.reduce(two << (np.arange(32, dtype=np.uint64) * np.uint64(2)), axis=2)


def sketch_table(ids: list, sets: list[np.ndarray]) -> pa.RecordBatch:
    """doc_id, n, digests of the set, band keys and bits of some documents."""
    n = np.array([len(s) for s in sets], np.int64)
    full = np.flatnonzero(n)
    bands, bits = np.zeros((len(sets), BANDS), np.uint64), np.zeros((len(sets), _WORDS), np.uint64)
    da, db = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
    if len(full):
        items = np.concatenate([sets[k] for k in full])
        heads = np.r_[0, np.cumsum(n[full])[:-1]]
        signatures = super_minhash(items, np.repeat(np.arange(len(full)), n[full]), len(full))
        bands[full], bits[full] = bands_of(signatures), bits_of(signatures)
        da[full] = np.bitwise_xor.reduceat(mixed(items), heads)
        db[full] = np.add.reduceat(mixed(items ^ np.uint64(0x5DEECE66D1234567)), heads)
    return pa.RecordBatch.from_arrays([
        pa.array(ids, pa.int64()), pa.array(n), pa.array(da.view(np.int64)), pa.array(db.view(np.int64)),
        pa.FixedSizeListArray.from_arrays(pa.array(bands.view(np.int64).ravel()), BANDS).cast(pa.list_(pa.int64())),
        pa.FixedSizeListArray.from_arrays(pa.array(bits.view(np.int64).ravel()), _WORDS).cast(pa.list_(pa.int64()))],
        ["doc_id", "n", "da", "db", "bands", "bits"])


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``sketch_table`` of every row, map side, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, start, held, size = b.column(0).to_pylist(), 0, [], 0
            for _, words in row_words(b.column(1)):
                held.append(shingles(words, WORDS))
                size += len(held[-1])
                if size >= CHUNK_ITEMS:
                    yield sketch_table(ids[start:start + len(held)], held)
                    start, held, size = start + len(held), [], 0
            if held:
                yield sketch_table(ids[start:], held)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return materialize(rows.mapInArrow(
        tidy_batches(run), "doc_id bigint, n bigint, da bigint, db bigint, bands array<bigint>, bits array<bigint>"), "minhash-sketches")


def full_sets(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rep, da, n, tokens): the whole set of every row whose id is in the written table ``ids`` (rep), written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, start, held, size = b.column(0), 0, [], 0

            def table(start, held):
                n = np.array([len(s) for s in held], np.int64)
                items = np.concatenate(held)
                digest = [np.bitwise_xor.reduce(mixed(s)) if len(s) else np.uint64(0) for s in held]
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)), pa.array(items.view(np.int64)))
                return pa.RecordBatch.from_arrays([ids.slice(start, len(held)), pa.array(np.array(digest, np.uint64).view(np.int64)), pa.array(n), lists], ["rep", "da", "n", "tokens"])

            for _, words in row_words(b.column(1)):
                held.append(shingles(words, WORDS))
                size += len(held[-1])
                if size >= CHUNK_ITEMS:
                    yield table(start, held)
                    start, held, size = start + len(held), [], 0
            if held:
                yield table(start, held)

    rows = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).alias("text")).join(bounded_broadcast(ids), "rep", "left_semi")
    return rows.mapInArrow(tidy_batches(run), "rep bigint, da bigint, n bigint, tokens array<bigint>")


def variance_factor(union: int, size: int = SIZE) -> float:
    """Variance of the estimate, in units of independent hashes, for two sets with ``union`` elements together."""
    step = np.arange(1, size, dtype=np.float64)
    rising = ((step + 1) / size) ** union + ((step - 1) / size) ** union - 2 * (step / size) ** union
    return 1 - float(((step / (size - 1)) ** union * rising).sum()) * (size - 1) / (union - 1) if union > 1 else 1.0


def least_agreement(n: int) -> int:
    """Components that a pair at 80 % agrees in, at least, if its larger set has ``n`` shingles or fewer."""
    j = PERCENT / 100
    spread = SIZE * (0.75**2 * j * (1 - j) * max(variance_factor(u) for u in (max(2, n), 5 * n // 4 + 2)) + (1 - j) * 0.25 * 0.75)
    return math.floor(SIZE * (j + (1 - j) / 4) - DEVIATIONS * math.sqrt(spread))


def _agree(na: Column, nb: Column, bits_a: Column, bits_b: Column) -> Column:
    """Whether two signatures agree in enough components for sets of these sizes."""
    most, least = F.greatest(na, nb), F.lit(least_agreement(1 << 30))
    for bits in range(12, 5, -1):
        least = F.when(most <= 1 << bits, least_agreement(1 << bits)).otherwise(least)
    return _alike(bits_a, bits_b) >= least


def _alike(bits_a: Column, bits_b: Column) -> Column:
    """Components of two signatures that agree in their two bits."""
    pairs = F.lit(0x5555555555555555)
    same = None
    for k in range(_WORDS):
        x = bits_a[k].bitwiseXOR(bits_b[k])
        unlike = F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(pairs))
        same = unlike if same is None else same + unlike
    return F.lit(SIZE) - same


def _may() -> Column:
    """Sizes close enough for a link, and signatures not too different."""
    na, nb = F.col("na"), F.col("nb")
    return (100 * F.least(na, nb) >= PERCENT * F.greatest(na, nb)) & _agree(na, nb, F.col("bits_a"), F.col("bits_b"))


def _with_set(pairs: DataFrame, sets: DataFrame, x: str, other: str) -> DataFrame:
    """``pairs`` with the set of ``x``: those of a hub are dealt out by the other side, to copies of its set."""
    hot = pairs.groupBy(x).agg(F.count(F.lit(1)).alias("uses")).filter(F.col("uses") > SLICE)
    hot = broadcast_if_small(materialize(hot.select(x, (1 + F.col("uses") / SLICE).cast("int").alias("slices")), "minhash-hubs"))
    used = bounded_broadcast(pairs.select(F.col(x).alias("rep")).distinct())
    sets = sets.join(used, "rep", "left_semi")
    dealt = pairs.join(hot, x, "left").withColumn("slice", F.pmod(F.xxhash64(other), F.coalesce("slices", F.lit(1))).cast("int")).drop("slices")
    copies = sets.select(F.col("rep").alias(x), F.col("n").alias(f"n_{x}"), F.col("tokens").alias(f"t_{x}")).join(hot, x, "left").withColumn(
        "slice", F.explode(F.sequence(F.lit(0), F.coalesce("slices", F.lit(1)) - 1))).drop("slices")
    return dealt.join(copies, [x, "slice"]).drop("slice")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the written (a, b) ``pairs`` whose whole sets share enough."""
    both = _with_set(_with_set(pairs, sets, "a", "b"), sets, "b", "a").withColumn("common", F.size(F.array_intersect("t_a", "t_b")))
    return both.filter(100 * F.col("common") >= PERCENT * (F.col("n_a") + F.col("n_b") - F.col("common"))).select("a", "b").distinct()


def rare_first(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(token, rep, label, n, pos), written once: the prefixes of the sets of the written ``members`` (rep, label).

    Shingles are ordered by how many of these sets hold them, those of one set only first. Sets that may be
    linked share one of their first n - 0.8 n + 1; ``pos`` counts from 0 and ``n - pos`` bounds what is shared
    from there on. A shingle of one set only has a place, but no row."""
    each = sets.join(bounded_broadcast(members), "rep").select("rep", "label", "n", "da", F.explode("tokens").alias("token"))
    often = materialize(each.groupBy("token").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1"), "minhash-often")
    known = join_hot_split(each, often, ["token"], "sets").groupBy("rep", "label", "n", "da").agg(
        F.sort_array(F.collect_list(F.struct("sets", "token"))).alias("known")).withColumn("alone", F.col("n") - F.size("known"))
    length = F.floor((100 - PERCENT) * F.col("n") / 100) + 1 - F.col("alone")
    first = known.filter(length > 0).select("rep", "label", "n", "alone", F.posexplode(F.slice("known.token", 1, length.cast("int"))).alias("i", "token"))
    return materialize(first.select("token", "rep", "label", "n", (F.col("alone") + F.col("i")).alias("pos")), "minhash-prefixes")


def rare_pairs(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) of ``members`` (rep, label) with different labels that may be linked by size and first common shingle.

    Sets of one size with a shingle at one place meet others as one spot, and only spots that leave room
    list their labels, only different labels their members."""
    prefixes = rare_first(members, sets)
    spot = ["token", "n", "pos"]
    spots = materialize(prefixes.groupBy(*spot).agg(F.min("label").alias("low"), F.max("label").alias("high")), "minhash-spots")
    one, two = (spots.toDF("token", f"n{x}", f"pos_{x}", f"low_{x}", f"high_{x}") for x in "ab")
    room = F.expr(
        "struct(na, pos_a) <= struct(nb, pos_b) AND least(low_a, low_b) < greatest(high_a, high_b) "
        f"AND 100 * least(na, nb) >= {PERCENT} * greatest(na, nb) AND {100 + PERCENT} * least(na - pos_a, nb - pos_b) >= {PERCENT} * (na + nb)")
    near = one.join(two, (one["token"] == two["token"]) & room).select(one["token"], "na", "pos_a", "nb", "pos_b")
    labels = materialize(prefixes.groupBy(*spot, "label").agg(F.count(F.lit(1)).alias("members")), "minhash-spot-labels").drop("members")
    for x in "ab":
        near = near.join(labels.toDF("token", f"n{x}", f"pos_{x}", f"label_{x}"), ["token", f"n{x}", f"pos_{x}"])
    near = near.filter("label_a <> label_b AND (na <> nb OR pos_a <> pos_b OR label_a < label_b)")
    for x in "ab":
        side = prefixes.select("token", F.col("n").alias(f"n{x}"), F.col("pos").alias(f"pos_{x}"), F.col("label").alias(f"label_{x}"), F.col("rep").alias(x))
        near = near.join(side, ["token", f"n{x}", f"pos_{x}", f"label_{x}"])
    return near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def forest(edges: DataFrame) -> DataFrame:
    """(a, b) that connect what ``edges`` (a, b) connect: each task joins its edges by union-find and
    returns one edge for each node, to the least node it has found for it."""

    def union(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        nodes, number = np.unique(np.r_[a, b], return_inverse=True)
        parent = list(range(len(nodes)))

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for x, y in zip(number[:len(a)].tolist(), number[len(a):].tolist(), strict=True):
            x, y = find(x), find(y)
            parent[max(x, y)] = min(x, y)
        root = np.array([find(x) for x in range(len(nodes))], np.int64)
        keep = root != np.arange(len(nodes))
        return pa.RecordBatch.from_arrays([pa.array(nodes[root[keep]]), pa.array(nodes[keep])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            held.append(b)
            size += b.num_rows
            if size >= FOREST_EDGES:
                joined = pa.Table.from_batches(held)
                held = [union(joined.column("a").to_numpy(), joined.column("b").to_numpy())]
                size = held[0].num_rows
                if size >= FOREST_EDGES:
                    yield held.pop()
                    size = 0
        if held:
            joined = pa.Table.from_batches(held)
            yield union(joined.column("a").to_numpy(), joined.column("b").to_numpy())

    return edges.mapInArrow(run, "a bigint, b bigint")


def grouped(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes of the written ``edges`` (a, b); nodes that are their own component may
    be missing. Few edges are joined by one union-find, more by rounds over all tasks."""
    if edges.limit(FOREST_EDGES).count() < FOREST_EDGES:
        return forest(edges.coalesce(1)).select(F.col("b").alias("node"), F.col("a").alias("component"))
    return components(edges)


def apart(labelled: DataFrame) -> DataFrame:
    """(token, m, left): members of each bucket, and its pairs with different labels."""
    spread = labelled.groupBy("token", "label").count().groupBy("token").agg(
        F.sum("count").alias("m"), F.sum(F.col("count") * F.col("count")).alias("same"))
    return spread.select("token", "m", ((F.col("m") * F.col("m") - F.col("same")) / 2).alias("left"))


def links(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(classes, links): the classes of equal sets (da, db, n, rep, copies), and verified links (a, b) between
    representatives that connect all that the candidate pairs connect.

    Representatives that share a band are candidates. In a star round each bucket has a centre,
    the same for as many buckets as possible; documents are tested against the centres of their
    largest buckets, and all that links connect take one label (union-find). Then all members of a bucket meet
    wherever their labels still differ. Where that is more than ``CROWDED`` pairs a member, as in a large group
    of texts just too different to be linked, only those meet whose rarest shingles leave room for a link
    (``rare_pairs``, which loses none): no candidate pair that may be linked is left untested, and a large
    group of near copies is never paired with itself.
    """
    key = ["da", "db", "n"]
    near = found.filter("n > 0 AND doc_id IS NOT NULL")
    classes = materialize(near.groupBy(*key).agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "minhash-classes")
    firsts = near.withColumn("rep", F.col("doc_id")).join(classes.drop("copies"), [*key, "rep"], "left_semi").dropDuplicates(["rep", *key])
    firsts = materialize(firsts.select("rep", "n", "bands", "bits"), "minhash-firsts")
    each = firsts.select("rep", "n", "bits", F.posexplode("bands").alias("band", "token"))
    shared = each.groupBy("token").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    postings = materialize(join_hot_split(each, materialize(shared, "minhash-buckets"), ["token"], "members"), "minhash-postings")
    # How often others share a document's buckets: most for the text that the others vary.
    ids = materialize(postings.groupBy("rep").agg(F.sum("members").alias("company")), "minhash-candidates")
    sets = full_sets(docs, ids.select("rep"), id_col, text_col).dropDuplicates(["rep", "da", "n"])
    sets = materialize(sets.select("rep", "da", "n", "tokens"), "minhash-sets")

    label = ids.withColumn("label", F.col("rep"))
    edges = None
    for round_ in range(STAR_ROUNDS):
        labelled = materialize(postings.drop("members").join(label, "rep"), "minhash-labelled")
        left = apart(labelled).agg(F.sum("left"), F.sum("m")).first()
        if round_ and (left[0] or 0) <= PAIRS_PER_POSTING * (left[1] or 0):
            break
        some = labelled.filter(F.col("band") % PARTS == round_ % PARTS)
        rank = F.struct(-F.col("company"), F.col("rep")) if not round_ else F.struct(F.xxhash64(F.lit(round_), "rep"), F.col("rep"))
        pivot = some.groupBy("token").agg(
            F.min(F.struct(rank.alias("rank"), "rep", "n", "bits", "label")).alias("p"),
            F.count(F.lit(1)).alias("members"), F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high")
        pivot = materialize(pivot.select(
            "token", "members", F.col("p.rep").alias("a"), F.col("p.n").alias("na"), F.col("p.bits").alias("bits_a"), F.col("p.label").alias("label_a")), "minhash-pivots")
        sides = some.select("token", F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bits_b"), F.col("label").alias("label_b"))
        near_by = join_hot_split(sides, pivot, ["token"], "members").filter("label_a <> label_b").filter(_may())
        chosen = near_by.groupBy("b", "a").agg(F.max("members").alias("members")).groupBy("b").agg(
            F.slice(F.sort_array(F.collect_list(F.struct("members", "a")), False), 1, CENTRES).alias("of"))
        pairs = chosen.select(F.explode("of.a").alias("a"), "b")
        hit = verified(materialize(pairs, "minhash-pairs"), sets)
        edges = materialize(forest(hit if edges is None else edges.unionByName(hit)), "minhash-forest")
        parts = grouped(edges).withColumnRenamed("node", "rep")
        label = materialize(ids.join(parts, "rep", "left").withColumn("label", F.coalesce("component", "rep")).drop("component"), "minhash-labels")
    else:
        labelled = materialize(postings.drop("members").join(label, "rep"), "minhash-labelled")

    crowds = materialize(apart(labelled).filter(F.col("left") > CROWDED * F.col("m")).select("token"), "minhash-crowds")
    crowded = labelled.join(crowds, "token", "left_semi").select("rep", "label").distinct()
    labelled = labelled.join(crowds, "token", "left_anti")
    # Labels of a bucket meet only if their sizes leave room for a link, and those of one member each
    # only if these may be linked.
    several = labelled.groupBy("token", "label").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.count(F.lit(1)).alias("members"), F.min("bits").alias("bits"))
    one, two = (several.select("token", *(F.col(c).alias(f"{c}_{x}") for c in ("label", "least", "most", "members", "bits"))) for x in "ab")
    # The smaller label of a bucket comes first: only its members are listed before sets of both sides are compared.
    room = F.expr("struct(members_a, label_a) < struct(members_b, label_b) AND "
                  f"100 * most_a >= {PERCENT} * least_b AND 100 * most_b >= {PERCENT} * least_a")
    alike = F.expr("members_a > 1 OR members_b > 1") | _agree(F.col("most_a"), F.col("most_b"), F.col("bits_a"), F.col("bits_b"))
    meet = one.join(two, (one["token"] == two["token"]) & room & alike).select(one["token"], "label_a", "label_b")
    side_a, side_b = (labelled.select(
        "token", F.col("label").alias(f"label_{x}"), F.col("rep").alias(x), F.col("n").alias(f"n{x}"), F.col("bits").alias(f"bits_{x}")) for x in "ab")
    pairs = meet.join(side_a, ["token", "label_a"]).join(side_b, ["token", "label_b"]).filter(_may()).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    if not crowds.isEmpty():
        pairs = pairs.unionByName(rare_pairs(materialize(crowded, "minhash-crowded"), sets)).distinct()
    last = verified(materialize(pairs, "minhash-pairs"), sets)
    return classes, materialize(edges.unionByName(last), "minhash-links")


def minhash(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text with A-Z in lower case, compared by
    64-bit hashes; a set holds the distinct shingles of four words. Documents with
    100 * common >= 80 * union are linked; component_id is the smallest doc_id that links
    reach, kept says that it is the row's own. A candidate pair is linked only after its whole
    sets were compared; a pair at 80 % fails to become a candidate with probability 1e-7.
    Pairs a little below 80 % are candidates as well: of a large group of texts that are just
    too different to be linked, each pair that neither signatures nor rare shingles can tell is compared.

    Defined cases: null, empty and wordless texts have no shingles and no links; a text of
    fewer than four words is one shingle; a null id takes part in no link, has a null
    component and is kept; rows with one id are one document for the links; an empty table
    gives no rows; further columns are ignored.
    """
    found = sketches(docs, id_col, text_col)
    classes, edges = links(docs, found, id_col, text_col)
    parts = grouped(materialize(forest(edges), "minhash-forest"))
    named = materialize(classes.join(parts, classes["rep"] == parts["node"], "left").select(
        "da", "db", "n", "copies", F.coalesce("component", "rep").alias("component_id")), "minhash-named")
    taking = "n > 0 AND doc_id IS NOT NULL"
    near = join_hot_split(found.filter(taking).select("doc_id", "da", "db", "n"), named, ["da", "db", "n"], "copies")
    rest = found.filter(f"NOT ({taking})").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return near.select("doc_id", "n", "component_id").unionByName(rest).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


#: DuckDB has no MinHash; exact sets and links over the small tables give the same rows.
SQL = r"""
WITH RECURSIVE word AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) BETWEEN 1 AND 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM word),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
pair AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
link AS (
  SELECT a, b FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT d.doc_id, coalesce(any_value(size.n), 0) AS n_shingles, min(reach.b) AS component_id, d.doc_id = min(reach.b) AS kept
FROM documents d JOIN reach ON reach.a = d.doc_id LEFT JOIN size ON size.doc_id = d.doc_id GROUP BY d.doc_id
"""
