"""Phrase collocations: multikey quicksort of suffix pointers, routed by leading words, and exact scores."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clinisift.session import broadcast_if_small, join_hot_split, materialize

from .common import give_back, partitions, tidy_batches
from .words import CHUNK_BYTES, word_hashes

#: Words in a phrase, at most; occurrences it needs; phrases reported for each language.
DEPTH, LEAST, TOP = 5, 100, 2000
#: A candidate goes if a longer one that holds it has so many hundredths of its occurrences.
COVERED = 100
#: UTF-8 bytes of text in a block, and suffixes that one task sorts, on average.
BLOCK_BYTES, BUCKET_ROWS = 8 << 20, 1 << 19
_PIECE, _BLANK = 2, 1
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _PIECE
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_SPACED = np.where(_KIND > 0, np.uint8(0x20), _LOWER)


def packed(columns: np.ndarray) -> bytes:
    """A matrix of 64-bit numbers (columns x rows), byte planes compressed."""
    planes = np.ascontiguousarray(columns.view(np.uint8).reshape(*columns.shape, 8).transpose(0, 2, 1))
    return columns.shape[1].to_bytes(8, "little") + pa.Codec("zstd", 1).compress(planes.tobytes(), asbytes=True)


def unpacked(data: bytes, columns: int) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    raw = pa.Codec("zstd").decompress(data[8:], decompressed_size=8 * n * columns, asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(columns, 8, n).transpose(0, 2, 1)
    return np.ascontiguousarray(planes).view(np.int64).reshape(columns, n)


def cut_text(text: bytes, size: int = BLOCK_BYTES) -> Iterator[bytes]:
    """``text`` in parts of about ``size`` bytes that end between pieces: no phrase is cut."""
    at = 0
    while len(text) - at > size:
        window = np.frombuffer(text, np.uint8, count=size, offset=at)
        ends = np.flatnonzero(_KIND[window] == _PIECE)
        end = at + int(ends[-1]) + 1 if len(ends) else 0
        if not end:  # a piece longer than a block stays whole
            later = np.flatnonzero(_KIND[np.frombuffer(text, np.uint8, offset=at + size)] == _PIECE)
            end = at + size + int(later[0]) + 1 if len(later) else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def hashed_words(spaced: np.ndarray, size: int = CHUNK_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word between blanks, ``size`` bytes at a time."""
    at, found = 0, [(np.empty(0, np.uint64), np.empty(0, np.int64))]
    while at < len(spaced):
        end = min(len(spaced), at + size)
        while end < len(spaced) and spaced[end - 1] != 0x20:
            blanks = np.flatnonzero(spaced[at:end] == 0x20)
            end = at + int(blanks[-1]) + 1 if len(blanks) else min(len(spaced), end + size)
        hashes, starts = word_hashes(spaced[at:end], np.empty(0, np.int64))
        found.append((hashes, starts + at))
        at = end
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def block_of(number: int, lang: str, texts: list[bytes]) -> pa.RecordBatch:
    """One block: its distinct words (hash, spelling, occurrences) and the sequence of its words, each as
    its number among them, the first of a piece with bit 32 set."""
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    kind = _KIND[data]
    spaced = _SPACED[data]
    hashes, starts = hashed_words(spaced)
    piece = np.cumsum(kind == _PIECE)[starts] if len(starts) else starts
    names, first, local, times = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
    outside = np.r_[np.flatnonzero(kind), len(data)]
    begin = starts[first]
    size = outside[np.searchsorted(outside, begin)] - begin
    limits = np.r_[0, np.cumsum(size)]
    letters = spaced[np.arange(limits[-1]) - np.repeat(limits[:-1] - begin, size)] if len(begin) else spaced[:0]
    spelled = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(limits.astype(np.int64)), pa.py_buffer(letters.tobytes()))
    sequence = local.astype(np.int64) | np.r_[True, piece[1:] != piece[:-1]][:len(local)].astype(np.int64) << 32
    words = pa.StructArray.from_arrays([pa.array(names.view(np.int64)), spelled.cast(pa.string()), pa.array(times.astype(np.int64))], ["word", "text", "times"])
    return pa.RecordBatch.from_arrays([
        pa.array([number]), pa.array([lang]), pa.array([len(local)], pa.int64()),
        pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), words), pa.array([packed(sequence[None, :])], pa.binary())],
        ["block", "lang", "n", "words", "sequence"])


def word_blocks(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, lang, n, words, sequence): the texts of each language in blocks, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held, size = defaultdict(list), defaultdict(int)
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.large_binary()).to_pylist(), strict=True):
                for part in cut_text(text or b"", block_bytes):
                    held[lang].append(part)
                    size[lang] += len(part) + 1
                    if size[lang] >= block_bytes:
                        yield block_of(number, lang, held.pop(lang))
                        del size[lang]
                        number += 1
        for lang, texts in held.items():
            yield block_of(number, lang, texts)
            number += 1

    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    return materialize(rows.mapInArrow(
        tidy_batches(run), "block bigint, lang string, n bigint, words array<struct<word: bigint, text: string, times: bigint>>, sequence binary"), "phrase-blocks")


def frequent_words(blocks: DataFrame, least: int = LEAST) -> DataFrame:
    """(id, lang, word, text, f) of the words with at least ``least`` occurrences in their language,
    written once; the most frequent have the smallest ids, which start at 1."""
    each = blocks.select("lang", F.explode("words").alias("w")).select("lang", "w.*")
    words = each.groupBy("lang", "word", "text").agg(F.sum("times").alias("f")).filter(F.col("f") >= least)
    ordered = materialize(words.repartitionByRange(F.desc("f"), "lang", "text").sortWithinPartitions(F.desc("f"), "lang", "text")
                          .withColumn("id", F.monotonically_increasing_id() + 1), "phrase-words")
    return ordered


def suffixes_of(sequence: np.ndarray, ids: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """(depth + 1) x suffixes: at each place with two frequent words or more before its piece ends or a
    rare word comes, the ids of up to ``depth`` of them (0 behind the last) and, last, how often
    the same suffix is in the sequence."""
    word = ids[sequence & 0xFFFFFFFF]
    n = len(word)
    stop = np.r_[(sequence[1:] >> 32 != 0) | (word[1:] == 0), True][:n] | (word == 0)
    last = np.flatnonzero(stop)
    left = last[np.searchsorted(last, np.arange(n))] - np.arange(n) + 1
    at = np.flatnonzero((left >= 2) & (word > 0))
    if not len(at):
        return np.empty((depth + 1, 0), np.int64)
    columns = np.zeros((depth + 1, len(at)), np.int64)
    mark = np.zeros(len(at), np.uint64)
    for d in range(depth):
        more = left[at] > d
        columns[d, more] = word[at[more] + d]
        mark = (mark ^ columns[d].view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mark ^= mark >> np.uint64(29)
    _, first, same, times = np.unique(mark, return_index=True, return_inverse=True, return_counts=True)
    if not all((columns[d] == columns[d, first[same]]).all() for d in range(depth)):  # two suffixes have one hash
        _, first, times = np.unique(columns[:depth], axis=1, return_index=True, return_counts=True)
    columns = columns[:, first]
    columns[depth] = times
    return columns


def buckets_of(columns: np.ndarray, hot: int, buckets: int, depth: int = DEPTH) -> np.ndarray:
    """The bucket of each suffix, by its leading words: those up to the first with an id above ``hot``,
    so that no bucket gets more of them than that word occurs; all words if there is none."""
    key = np.zeros(columns.shape[1], np.uint64)
    going = np.ones(columns.shape[1], bool)
    for d in range(depth):
        part = columns[d].view(np.uint64)
        key = np.where(going, (key ^ part) * np.uint64(0xFF51AFD7ED558CCD), key)
        key ^= key >> np.uint64(31)
        going &= (columns[d] > 0) & (columns[d] <= hot)
    return (key % np.uint64(buckets)).astype(np.int64)


def count_phrases(columns: np.ndarray, times: np.ndarray, least: int, hot: int) -> Iterator[tuple[list[int], int]]:
    """(ids, occurrences) of the phrases of two words or more among the suffixes: multikey three-way quicksort.

    A partition of suffix pointers is split by the word at its depth into less, equal and
    greater; the equal part has one more word in common, and its occurrences are the phrase's
    count. Partitions with fewer than ``least`` occurrences are left, except that phrases of
    hot words only (ids up to ``hot``) lie in several buckets: their parts are returned at any count.
    """
    depth = len(columns)
    stack = [(np.arange(columns.shape[1]), 0, True)]
    while stack:
        pointers, d, all_hot = stack.pop()
        weight = times[pointers].sum()
        keys = columns[d][pointers]
        if weight < least:
            if not all_hot:
                continue
            some = (keys > 0) & (keys <= hot)
            pointers, keys = pointers[some], keys[some]
            if not len(keys):
                continue
        pivot = sorted((int(keys[0]), int(keys[len(keys) // 2]), int(keys[-1])))[1]
        less, equal = keys < pivot, keys == pivot
        if less.any():
            stack.append((pointers[less], d, all_hot))
        greater = ~(less | equal)
        if greater.any():
            stack.append((pointers[greater], d, all_hot))
        if not pivot:
            continue
        same = pointers[equal]
        count = int(times[same].sum())
        still_hot = all_hot and pivot <= hot
        if count >= least or still_hot:
            if d:
                yield columns[:d + 1, same[0]].tolist(), count
            if d + 1 < depth:
                stack.append((same, d + 1, still_hot))


def phrase_counts(blocks: DataFrame, words: DataFrame, least: int = LEAST, depth: int = DEPTH, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(ids, a): every phrase of 2 to ``depth`` words with at least ``least`` occurrences, as word ids, written once."""
    total = blocks.agg(F.sum("n")).first()[0] or 0
    buckets = max(partitions(blocks.sparkSession), math.ceil(total / bucket_rows))
    # A word that alone would fill a bucket does not decide by itself where its suffixes go.
    hot = words.filter(F.col("f") > max(least, total // buckets)).agg(F.max("id")).first()[0] or 0
    asked = blocks.select(F.col("block").alias("of"), "lang", F.explode("words.word").alias("word"))
    # Every word gets an answer, a rare one 0, so that what travels grows with the blocks alone.
    answers = asked.join(broadcast_if_small(words.select("lang", "word", "id")), ["lang", "word"], "left").select("of", "word", F.coalesce("id", F.lit(0)).alias("id"))

    def route(block: pa.Table, found: pa.Table) -> pa.Table:
        names = block.column("names").combine_chunks().flatten().to_numpy()
        sequence = unpacked(block.column("sequence")[0].as_py(), 1)[0]
        ids = np.zeros(len(names), np.int64)
        word = found.column("word").to_numpy()
        ids[np.searchsorted(names.view(np.uint64), word.view(np.uint64))] = found.column("id").to_numpy()
        columns = suffixes_of(sequence, ids, depth) if len(sequence) else np.empty((depth + 1, 0), np.int64)
        to = buckets_of(columns, hot, buckets, depth)
        order = np.lexsort((columns[0], to))
        to, columns = to[order], columns[:, order]
        cuts = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]) if len(to) else to
        parts = [packed(np.ascontiguousarray(columns[:, s:e])) for s, e in zip(cuts.tolist(), [*cuts[1:].tolist(), len(to)], strict=True)] if len(to) else []
        return pa.table({"bucket": pa.array(to[cuts], pa.int64()), "suffixes": pa.array(parts, pa.binary())})

    def count(parts: pa.Table) -> pa.Table:
        columns = np.concatenate([unpacked(p, depth + 1) for p in parts.column("suffixes").to_pylist()], axis=1)
        found = list(count_phrases(columns[:depth], columns[depth], least, hot))
        return pa.table({"ids": pa.array([ids for ids, _ in found], pa.list_(pa.int64())), "a": pa.array([a for _, a in found], pa.int64())})

    def tidy(f):
        def one(x: pa.Table) -> pa.Table:
            out = f(x)
            give_back()
            return out

        def two(x: pa.Table, y: pa.Table) -> pa.Table:
            out = f(x, y)
            give_back()
            return out

        return one if f.__code__.co_argcount == 1 else two

    lean = blocks.select("block", F.col("words.word").alias("names"), "sequence")
    routed = lean.groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(tidy(route), "bucket bigint, suffixes binary")
    counted = routed.groupBy("bucket").applyInArrow(tidy(count), "ids array<bigint>, a bigint")
    return materialize(counted.groupBy("ids").agg(F.sum("a").alias("a")).filter(F.col("a") >= least), "phrase-counts")


def _attach(cuts: DataFrame, counts: DataFrame, side: str, name: str) -> DataFrame:
    """``cuts`` with the count ``name`` of the phrase in column ``side``; hot phrases do not move."""
    uses = cuts.groupBy(side).agg(F.count(F.lit(1)).alias("uses"))
    known = materialize(counts.select(F.col("ids").alias(side), F.col("a").alias(name)).join(uses, side), "phrase-uses")
    return join_hot_split(cuts, known, [side], "uses").drop("uses")


def collocations(docs: DataFrame, least: int = LEAST, depth: int = DEPTH, top: int = TOP, text_col: str = "text", lang_col: str = "lang",
                 block_bytes: int = BLOCK_BYTES, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language.

    Texts in lower case (A-Z) are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those into
    words ``[^\\x20\\x09]+``. n counts the words of the language, a a phrase's occurrences
    inside pieces. Phrases of 2 to ``depth`` words with a >= ``least`` are candidates; a cut
    after word k has score floor(1000 * a * n / (l * r)), l and r counting both parts, and the
    least score counts (the smallest k of ties). Candidates inside a longer candidate with
    100 * a >= COVERED * a of their own are dropped.

    1. Words are counted by language. Phrases of candidates hold frequent words only, so each
       block gets ids of just those back.
    2. Suffixes of up to ``depth`` frequent words, equal ones of a block made one, are routed
       by their leading words: one word if it is rare enough, more where it is hot.
    3. Every bucket is sorted by multikey quicksort, leaving infrequent partitions.
    4. Scores, in exact decimals, and the test for longer candidates are joins of phrases.

    Defined cases: null texts are empty, a null language is ``und``; ties of score and a are in
    order of the phrase's UTF-8 bytes; an empty table gives no rows; repeated rows count as
    often as they come; ids and further columns are ignored. Words are compared by their
    spelling, inside a block by 64-bit hashes.
    """
    blocks = word_blocks(docs, text_col, lang_col, block_bytes)
    words = frequent_words(blocks, least)
    phrases = phrase_counts(blocks, words, least, depth, bucket_rows)
    sizes = materialize(blocks.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-sizes")

    counts = phrases.unionByName(words.select(F.array("id").alias("ids"), F.col("f").alias("a")))
    parts = F.explode(F.sequence(F.lit(1), F.size("ids") - 1))
    cuts = phrases.select("ids", "a", parts.alias("k")).selectExpr(
        "ids", "a", "k", "slice(ids, 1, k) AS front", "slice(ids, k + 1, size(ids) - k) AS back")
    cuts = _attach(_attach(materialize(cuts, "phrase-cuts"), counts, "front", "l"), counts, "back", "r")
    langs = broadcast_if_small(sizes)
    first = words.select(F.col("id").alias("first"), "lang")
    big = "CAST({} AS DECIMAL(19, 0))"
    score = f"(({big.format('a')} * 1000) * {big.format('n')}) DIV ({big.format('l')} * {big.format('r')})"
    named = phrases.withColumn("first", F.col("ids")[0]).select("first").groupBy("first").agg(F.count(F.lit(1)).alias("uses"))
    named = materialize(first.join(named, "first").join(langs, "lang"), "phrase-first")
    scored = join_hot_split(cuts.withColumn("first", F.col("ids")[0]), named, ["first"], "uses").selectExpr("ids", "a", "lang", "n", "k", "l", "r", f"{score} AS score")
    best = scored.groupBy("ids", "a", "lang", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    longer = phrases.filter(F.size("ids") > 2).selectExpr("a", "explode(array(slice(ids, 1, size(ids) - 1), slice(ids, 2, size(ids) - 1))) AS ids")
    longer = longer.groupBy("ids").agg(F.max("a").alias("longest"))
    # f only falls with more words: if any longer candidate covers a phrase, one with a single word more does.
    kept = best.join(longer, "ids", "left").filter(F.col("longest").isNull() | (100 * F.col("longest") < COVERED * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    near = kept.select("ids", "a", "lang", "n", "cut.*").withColumn("place", F.rank().over(order)).filter(F.col("place") <= top)
    near = materialize(near, "phrase-top")
    letters = near.select("ids", F.posexplode("ids").alias("at", "id")).join(words.select("id", "text"), "id")
    spelled = letters.groupBy("ids").agg(F.array_sort(F.collect_list(F.struct("at", "text"))).alias("w")).select("ids", F.array_join("w.text", " ").alias("phrase"))
    last = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return near.join(spelled, "ids").withColumn("rank", F.row_number().over(last).cast("long")).filter(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
word AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece),
total AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM word GROUP BY lang),
phrase AS (
  SELECT lang, p, count(*)::HUGEINT AS f FROM (
    SELECT lang, unnest(list_transform(range(1, len(w) - size + 2), lambda i: w[i:i + size - 1])) AS p
    FROM word, range(1, 6) AS s(size) WHERE len(w) >= size) GROUP BY lang, p),
candidate AS (SELECT lang, p, f, len(p) AS size FROM phrase WHERE f >= 100 AND len(p) >= 2),
cut AS (
  SELECT c.lang, c.p, c.f, k, x.f AS l, y.f AS r, (1000 * c.f * n) // (x.f * y.f) AS score
  FROM candidate c JOIN range(1, 5) AS t(k) ON k < c.size JOIN total USING (lang)
  JOIN phrase x ON x.lang = c.lang AND x.p = c.p[1:k] JOIN phrase y ON y.lang = c.lang AND y.p = c.p[k + 1:c.size]),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
covered AS (
  SELECT DISTINCT lang, q AS p, part FROM (
    SELECT lang, f AS part, unnest(flatten(list_transform(range(2, size), lambda s: list_transform(range(1, size - s + 2), lambda i: p[i:i + s - 1])))) AS q FROM candidate)),
kept AS (SELECT * FROM best b WHERE NOT EXISTS (SELECT 1 FROM covered c WHERE c.lang = b.lang AND c.p = b.p AND 100 * c.part >= 100 * b.f))
SELECT lang, rank, phrase, f::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM (
  SELECT k.*, t.n, array_to_string(p, ' ') AS phrase,
    row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, array_to_string(p, ' ')) AS rank
  FROM kept k JOIN total t USING (lang)) WHERE rank <= 2000
"""
