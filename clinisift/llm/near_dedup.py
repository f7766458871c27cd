"""N-gram Jaccard self-join: grouped prefix join, and the components of its links.

Document frequencies order the shingles, so that a passage of many documents comes last
and rarely enters a prefix. They are counted and handed back in packed blocks, not as one
row per shingle.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinisift.session import join_hot_split, materialize

from .common import partitions, tidy_group
from .words import mixed, row_words

#: Words in a shingle; shingles two documents must share, in hundredths of their union.
WORDS, PERCENT = 5, 80
#: UTF-8 bytes of text in one block, at most on average.
BLOCK_BYTES = 8 << 20
#: Frequencies are counted under so many bits of a shingle's hash: it only orders shingles.
SHORT = np.uint64(16)
#: Star rounds go on while more than so many pairs per posting are left to test.
PAIRS_PER_POSTING, STAR_ROUNDS = 8, 4


def shingles(words: np.ndarray, k: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of a document's shingles: k words in a row, or all if there are fewer."""
    if not len(words):
        return words
    if len(words) < k:
        words, k = np.r_[words, np.full(k - len(words), np.uint64(len(words)))], k
    h = np.zeros(len(words) - k + 1, np.uint64)
    for i in range(k):
        h = mixed(h * np.uint64(0x100000001B3) + words[i:len(words) - k + 1 + i])
    return np.unique(h)


def needed(n: int) -> int:
    """Shingles that any partner of a set of n must share with it."""
    return -(-PERCENT * n // 100)


def pack(sorted_values: np.ndarray, extra: np.ndarray) -> bytes:
    """Sorted numbers as compressed differences, with one more byte for each."""
    if not len(sorted_values):
        return b""
    gaps = np.diff(sorted_values, prepend=np.uint64(0))
    planes = gaps.view(np.uint8).reshape(-1, 8).T
    raw = np.ascontiguousarray(np.vstack([planes, extra.astype(np.uint8)[None, :]])).tobytes()
    return len(sorted_values).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(raw, asbytes=True)


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    if not data:
        return np.empty(0, np.uint64), np.empty(0, np.uint8)
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.Codec("zstd").decompress(data[8:], decompressed_size=9 * n, asbytes=True), np.uint8).reshape(9, n)
    gaps = np.ascontiguousarray(planes[:8].T).view(np.uint64).ravel()
    return np.cumsum(gaps, dtype=np.uint64), planes[8].copy()


def count_block(texts: pa.Table, blocks: int) -> pa.Table:
    """Of one block of documents: for each bucket of hashes, the hashes and in how many documents (255 at most) they are."""
    block = texts.column("block")[0].as_py()
    each = [shingles(w) >> SHORT for part in texts.column("text").chunks for _, w in row_words(part)]
    values, counts = np.unique(np.concatenate(each), return_counts=True) if each else (np.empty(0, np.uint64), np.empty(0))
    counts = np.minimum(counts, 255).astype(np.uint8)
    limits = [(b << 48) // blocks for b in range(1, blocks)]
    cuts = np.searchsorted(values, np.array(limits, np.uint64))
    rows = [(b, pack(v, c)) for b, (v, c) in enumerate(zip(np.split(values, cuts), np.split(counts, cuts), strict=True)) if len(v)]
    return pa.table({
        "bucket": pa.array([b for b, _ in rows], pa.int32()), "block": pa.array([block] * len(rows), pa.int32()),
        "hashes": pa.array([h for _, h in rows], pa.binary())})


def shared_of_bucket(parts: pa.Table) -> pa.Table:
    """Of one bucket of hashes: for each block its hashes that are in two or more documents, with their frequency class."""
    blocks = parts.column("block").to_pylist()
    lists = [unpack(h) for h in parts.column("hashes").to_pylist()]
    values = np.concatenate([v for v, _ in lists])
    counts = np.concatenate([c for _, c in lists])
    names, number = np.unique(values, return_inverse=True)
    df = np.bincount(number, weights=counts, minlength=len(names))
    rank = np.minimum(255, 6 * np.log2(np.maximum(df, 1))).astype(np.uint8)
    out, at = [], 0
    for v, _ in lists:
        of = number[at:at + len(v)]
        at += len(v)
        keep = df[of] >= 2
        out.append(pack(v[keep], rank[of[keep]]))
    rows = [(b, o) for b, o in zip(blocks, out, strict=True) if o]
    return pa.table({"block": pa.array([b for b, _ in rows], pa.int32()), "shared": pa.array([o for _, o in rows], pa.binary())})


def prefixes_of_block(texts: pa.Table, shared: pa.Table) -> pa.Table:
    """Per document: set size n; if its prefix holds a shared shingle, also the number ``alone`` of
    shingles that no other document has (they come first), the shared part of the prefix, all
    shared shingles (once for equal sets of the block) and a digest of the set."""
    lists = [unpack(s) for s in shared.column("shared").to_pylist()]
    keys = np.concatenate([v for v, _ in lists]) if lists else np.empty(0, np.uint64)
    rank = np.concatenate([r for _, r in lists]) if lists else np.empty(0, np.uint8)
    order = np.argsort(keys, kind="stable")
    keys, rank = keys[order], rank[order]
    ids = texts.column("doc_id").to_pylist()
    rows, seen, at = [], {}, 0
    for part in texts.column("text").chunks:
        for k, words in row_words(part):
            doc, own = ids[at + k], shingles(words)
            n = len(own)
            row = [doc, n, None, None, None, None, None]
            rows.append(row)
            if not n or doc is None or not len(keys):
                continue
            short = own >> SHORT
            place = np.minimum(np.searchsorted(keys, short), len(keys) - 1)
            known = keys[place] == short
            tokens, alone = own[known], n - int(known.sum())
            length = n - needed(n) + 1
            if alone >= length:
                continue
            first = np.lexsort((tokens, rank[place[known]]))[:length - alone]
            digest = [int(np.bitwise_xor.reduce(mixed(own))), int(mixed(np.cumsum(own, dtype=np.uint64)[-1:] * np.uint64(2 * n + 1))[0])]
            row[2:] = [alone, tokens[first].view(np.int64), None, *(d - (1 << 64) if d >> 63 else d for d in digest)]
            best = seen.get(tuple(digest))
            if best is None or doc < best[0][0]:
                if best is not None:
                    best[0][4] = None
                row[4] = tokens.view(np.int64)
                seen[tuple(digest)] = (row,)
        at += len(part)
    column = [list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in range(7)]
    numbers = pa.list_(pa.int64())
    return pa.table({
        "doc_id": pa.array(column[0], pa.int64()), "n": pa.array(column[1], pa.int64()), "alone": pa.array(column[2], pa.int32()),
        "prefix": pa.array(column[3], numbers), "tokens": pa.array(column[4], numbers),
        "da": pa.array(column[5], pa.int64()), "db": pa.array(column[6], pa.int64())})


def prefixes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``prefixes_of_block`` for all rows, written once. The texts are shuffled once, into blocks."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(partitions(spark), math.ceil(size / BLOCK_BYTES))
    texts = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(blocks)).cast("int")).repartition(blocks, "block")
    counted = texts.groupBy("block").applyInArrow(tidy_group(lambda t: count_block(t, blocks)), "bucket int, block int, hashes binary")
    shared = counted.groupBy("bucket").applyInArrow(tidy_group(shared_of_bucket), "block int, shared binary")
    found = texts.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(
        tidy_group(prefixes_of_block), "doc_id bigint, n bigint, alone int, prefix array<bigint>, tokens array<bigint>, da bigint, db bigint")
    return materialize(found, "near-prefixes")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the (a, b) ``pairs`` whose sets share enough; only shared shingles can be common."""
    a, b = (sets.select(F.col("rep").alias(x), F.col("n").alias(f"n_{x}"), F.col("tokens").alias(f"t_{x}")) for x in "ab")
    both = pairs.join(a, "a").join(b, "b").withColumn("common", F.size(F.array_intersect("t_a", "t_b")))
    return both.filter(100 * F.col("common") >= PERCENT * (F.col("n_a") + F.col("n_b") - F.col("common"))).select("a", "b")


def _may(na, pa_, nb, pb):
    """Sizes close enough, and enough shingles left from the common one on if it is the first."""
    na, pa_, nb, pb = map(F.col, (na, pa_, nb, pb))
    return (
        (100 * F.least(na, nb) >= PERCENT * F.greatest(na, nb))
        & ((100 + PERCENT) * F.least(na - pa_, nb - pb) >= PERCENT * (na + nb)))


def inside(groups: DataFrame) -> DataFrame:
    """Groups of several members that may be linked with each other: they can share all but the ``alone`` ones."""
    return groups.filter("members > 1").filter(_may("n", "alone", "n", "alone"))


def links(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(classes, links): the classes of equal sets (da, db, n, rep, copies), and links (a, b) between
    representatives that connect all that the join connects.

    Representatives with equal size and prefix are one group; only groups meet. A star round
    tests, for each shingle, its groups against the one with the fewest unshared shingles
    (nearest to the text that the others vary) and gives linked ones a common label. Then
    groups meet wherever a shingle has groups of different labels: within a label all is
    connected already, so a large group of near copies is never paired with itself.
    """
    key = ["da", "db", "n"]
    near = found.filter("prefix IS NOT NULL")
    classes = materialize(near.groupBy(*key).agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "near-classes")
    sets = near.filter("tokens IS NOT NULL").join(classes.drop("copies"), key).filter("doc_id = rep").dropDuplicates(["rep", *key])
    sets = materialize(sets.select("rep", "n", "alone", "prefix", "tokens"), "near-sets")
    groups = materialize(sets.groupBy("n", "alone", "prefix").agg(F.min("rep").alias("gid"), F.count(F.lit(1)).alias("members")), "near-groups")
    member = materialize(sets.select("rep", "n", "alone", "prefix").join(groups.drop("members"), ["n", "alone", "prefix"]).select("rep", "gid"), "near-members")
    postings = groups.select("gid", "n", "alone", F.posexplode("prefix").alias("i", "token")).select(
        "token", "gid", "n", "alone", (F.col("alone") + F.col("i")).alias("pos"))
    postings = materialize(postings, "near-postings")

    label = member.withColumn("label", F.col("rep"))
    edges = None
    for round_ in range(STAR_ROUNDS):
        by_group = label.groupBy("gid").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        by_group = by_group.select("gid", F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(-F.col("gid") - 1).alias("lab"))
        labelled = materialize(postings.join(by_group, "gid"), "near-labelled")
        spread = labelled.groupBy("token", "lab").count().groupBy("token").agg(
            F.sum("count").alias("m"), F.sum(F.col("count") * F.col("count")).alias("same"), F.count(F.lit(1)).alias("labels"))
        left = spread.agg(F.sum((F.col("m") * F.col("m") - F.col("same")) / 2), F.sum("m")).first()
        if round_ and (left[0] or 0) <= PAIRS_PER_POSTING * (left[1] or 0):
            break
        rank = F.struct("alone", "gid") if not round_ else F.struct(F.xxhash64(F.lit(round_), "gid"), F.col("gid"))
        pivot = labelled.groupBy("token").agg(
            F.min(F.struct(rank.alias("rank"), F.col("gid"), F.col("n"), F.col("pos"))).alias("p"),
            F.count_distinct("lab").alias("labels")).filter("labels > 1").select(
            "token", F.col("p.gid").alias("a"), F.col("p.n").alias("na"), F.col("p.pos").alias("pa"))
        stars = labelled.join(pivot, "token").filter(_may("na", "pa", "n", "pos")).select("a", F.col("gid").alias("g")).distinct()
        inner = inside(groups).select(F.col("gid").alias("a"), F.col("gid").alias("g"))
        pairs = stars.unionByName(inner).distinct().join(member.withColumnRenamed("gid", "g"), "g").select("a", F.col("rep").alias("b")).filter("a <> b")
        hit = materialize(verified(pairs, sets), "near-stars")
        edges = hit if edges is None else edges.unionByName(hit)
        hubs = hit.groupBy("a").agg(F.count(F.lit(1)).alias("leaves"))
        best = hit.join(hubs, "a").groupBy("b").agg(F.max(F.struct("leaves", "a")).alias("hub")).select(F.col("b").alias("rep"), F.col("hub.a").alias("to"))
        # A leaf takes its hub's label only while it has none of its own, and a hub keeps its own.
        old = label.select(F.col("rep").alias("to"), F.col("label").alias("theirs"))
        label = label.join(best.join(old, "to"), "rep", "left").select(
            "rep", "gid", F.when((F.col("label") == F.col("rep")) & F.col("theirs").isNotNull() & (F.col("theirs") != F.col("rep")), F.col("theirs"))
            .otherwise(F.col("label")).alias("label"))
        label = materialize(label, "near-labels")

    # Labels of a shingle meet only if their sizes and places leave room for a link.
    several = labelled.groupBy("token", "lab").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.max(F.col("n") - F.col("pos")).alias("rest"))
    one, two = (several.toDF("token", *(f"{c}_{x}" for c in ("lab", "least", "most", "rest"))) for x in "ab")
    room = (
        "lab_a < lab_b AND 100 * most_a >= {p} * least_b AND 100 * most_b >= {p} * least_a "
        "AND (100 + {p}) * least(rest_a, rest_b) >= {p} * (least_a + least_b)").format(p=PERCENT)
    meet = one.join(two, "token").filter(room).select("token", "lab_a", "lab_b")
    side_a, side_b = (labelled.select("token", F.col("lab").alias(f"lab_{x}"), F.col("gid").alias(f"g{x}"), F.col("n").alias(f"n{x}"), F.col("pos").alias(f"p{x}")) for x in "ab")
    cross = meet.join(side_a, ["token", "lab_a"]).join(side_b, ["token", "lab_b"]).filter(_may("na", "pa", "nb", "pb")).select("ga", "gb").distinct()
    inner = inside(groups).select(F.col("gid").alias("ga"), F.col("gid").alias("gb"))
    ma, mb = (label.select(F.col("gid").alias(f"g{x}"), F.col("rep").alias(x), F.col("label").alias(f"l{x}")) for x in "ab")
    pairs = cross.unionByName(inner).join(ma, "ga").join(mb, "gb").filter("la <> lb AND a <> b AND (ga <> gb OR a < b)").select("a", "b")
    return classes, materialize(edges.unionByName(verified(pairs, sets)), "near-links")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the links (a, b): alternating large and small stars, each round written."""
    now = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "near-edges")
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        now = materialize(small.select("u", F.col("m").alias("v")).unionByName(
            small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct(), "near-edges")
        was, mark = mark, tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if was == mark:
            return now.toDF("node", "component").unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text with A-Z in lower case, compared by
    64-bit hashes. Documents with 100 * common >= 80 * union are linked; component_id is the
    smallest doc_id that links reach.

    Defined cases: null, empty and wordless texts have no shingles and no links; a text of
    fewer than five words is one shingle; a null id has a null component; rows with one id
    are one document for the links; an empty table gives no rows; further columns are ignored.
    """
    found = prefixes(docs, id_col, text_col)
    classes, edges = links(found)
    parts = components(edges)
    named = materialize(classes.join(parts, classes["rep"] == parts["node"], "left").select(
        "da", "db", "n", "copies", F.coalesce("component", "rep").alias("component_id")), "near-named")
    near = join_hot_split(found.filter("prefix IS NOT NULL").select("doc_id", "da", "db", "n"), named, ["da", "db", "n"], "copies")
    alone = found.filter("prefix IS NULL").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return near.select("doc_id", "n", "component_id").unionByName(alone).withColumnRenamed("n", "n_shingles")
