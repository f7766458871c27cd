"""Repeated passages: bytes covered by a long string that starts elsewhere too.

A suffix array of all texts is built in independent parts. Equal strings of ``length``
bytes hold the same smallest 32-byte window (their anchor) at the same place, so suffixes
only need to be compared within an anchor; runs of starts with one anchor travel together.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinisift.session import join_hot_split, materialize

from .common import partitions, tidy_batches, tidy_group
from .words import CHUNK_BYTES, chunks, mixed, powers, texts_of

#: Bytes that a repeated string has at least.
LENGTH = 400
#: Bytes of an anchor.
ANCHOR = 32
#: An anchor with more different surroundings than this has its strings compared one by one, spread by their hashes.
CROWD = 256
#: Bytes of surroundings whose suffixes one task sorts together.
PART_BYTES = 3 << 20
_rng = np.random.default_rng(7)
_ONE, _TWO = _rng.integers(1, 2**64, 256, dtype=np.uint64), _rng.integers(1, 2**64, 256, dtype=np.uint64)


class Hashes:
    """Hashes of any substring of some bytes."""

    def __init__(self, data: np.ndarray, letters: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.sums = np.r_[np.uint64(0), np.cumsum(letters[data] * up[:len(data)], dtype=np.uint64)]

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` values in a row."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.ascontiguousarray(np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1]).ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def runs_of(data: np.ndarray, limits: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(row, first start, last start, anchor, surroundings) of the runs of starts with one anchor.

    Places count from the beginning of ``data``. ``surroundings`` is a hash of all bytes from the
    first start to the end of the last string, and of where the anchor lies in them.
    """
    none = tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    if len(data) < length:
        return none
    one, two = Hashes(data, _ONE), Hashes(data, _TWO)
    places = np.arange(len(data) - ANCHOR + 1)
    anchors = one.of(places, places + ANCHOR)
    bits = np.uint64(max(1, int(len(places)).bit_length()))
    keyed = (anchors >> bits << bits) | places.astype(np.uint64)  # of equal anchors the left one
    least = (sliding_least(keyed, length - ANCHOR + 1) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    row = np.searchsorted(limits, np.arange(len(least)), side="right") - 1
    good = np.arange(len(least)) + length <= limits[row + 1]
    change = np.r_[True, (least[1:] != least[:-1]) | (row[1:] != row[:-1]) | ~good[:-1]] & good
    first = np.flatnonzero(change)
    if not len(first):
        return none
    stop = np.r_[True, (least[1:] != least[:-1]) | (row[1:] != row[:-1]) | ~good[1:]]
    stop = np.r_[stop[1:], True] & good
    last = np.flatnonzero(stop)
    at = least[first]
    around = mixed(two.of(first, last + length) ^ mixed((at - first).astype(np.uint64) << np.uint64(32) | (last - first).astype(np.uint64)))
    return row[first], first, last, anchors[at], around


def windows(texts: pa.Array, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, their limits, number of the first row, place of the bytes in that row): rows of about
    CHUNK_BYTES, long texts in overlapping pieces."""
    data, limits = texts_of(texts)
    for start, end in chunks(limits):
        at, stop = int(limits[start]), int(limits[end])
        if end == start + 1 and stop - at > CHUNK_BYTES:
            for p in range(0, stop - at - length + 1, CHUNK_BYTES):
                piece = data[at + p:min(stop, at + p + CHUNK_BYTES + length - 1)]
                yield piece, np.array([0, len(piece)]), start, p
        else:
            yield data[at:stop], limits[start:end + 1] - at, start, 0


def runs(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(key, start, stop, anchor, around, times) for the texts of ``docs`` (key, text); ``times`` counts
    equal runs of one text, of which only the first has a row of its own that stands for the others;
    those follow with times = 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(0).to_numpy()
            for data, limits, row0, shift in windows(b.column(1), length):
                row, first, last, anchor, around = runs_of(data, limits, length)
                if not len(first):
                    continue
                order = np.lexsort((first, around, anchor, row))
                same = np.r_[False, (row[order][1:] == row[order][:-1]) & (anchor[order][1:] == anchor[order][:-1]) & (around[order][1:] == around[order][:-1])]
                head = np.flatnonzero(~same)
                times = np.zeros(len(order), np.int64)
                times[head] = np.diff(np.r_[head, len(order)])
                row, first, last, anchor, around = (x[order] for x in (row, first, last, anchor, around))
                base = limits[row]
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys[row0 + row]), pa.array((first - base + shift).astype(np.int32)), pa.array((last - base + shift).astype(np.int32)),
                    pa.array(anchor.view(np.int64)), pa.array(around.view(np.int64)), pa.array(times)],
                    ["key", "start", "stop", "anchor", "around", "times"])

    return docs.mapInArrow(tidy_batches(run), "key bigint, start int, stop int, anchor bigint, around bigint, times bigint")


def equal_classes(texts: list[bytes], starts: list[int], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, places, classes): places with equal strings of ``length`` bytes have the same class, in
    order of the strings. Text k offers its first ``starts[k]`` places. Prefix doubling; a place whose
    prefix is unique drops out, and with it every place that would continue into it."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    limits = np.cumsum([0, *map(len, texts)])
    left = np.repeat(limits[1:], np.diff(limits)) - np.arange(len(data))
    rank = np.full(len(data), -1, np.int64)

    def settle(places: np.ndarray, values: np.ndarray) -> np.ndarray:
        _, number, counts = np.unique(values, return_inverse=True, return_counts=True)
        rank[:] = -1
        shared = counts[number] > 1
        rank[places[shared]] = number[shared]
        return places[shared]

    depth = 8
    alive = np.flatnonzero(left >= depth)
    word = np.zeros(len(alive), np.uint64)
    for k in range(depth):
        word = word << np.uint64(8) | data[alive + k].astype(np.uint64)
    alive = settle(alive, word)
    while depth < length and len(alive):
        step = min(depth, length - depth)  # the last step overlaps
        alive = alive[left[alive] >= depth + step]
        alive = alive[rank[alive + step] >= 0]
        alive = settle(alive, rank[alive] * np.int64(len(data) + 1) + rank[alive + step])
        depth += step
    offered = np.zeros(len(data), bool)
    for at, n in zip(limits[:-1].tolist(), starts, strict=True):
        offered[at:at + n] = True
    alive = alive[offered[alive]]
    _, number, counts = np.unique(rank[alive], return_inverse=True, return_counts=True)
    keep = counts[number] > 1
    alive, number = alive[keep], number[keep]
    order = np.argsort(number, kind="stable")
    return data, alive[order], number[order]


def maximal_repeats(texts: list[bytes], starts: list[int], length: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """(length, occurrences as (text, place)) of each maximal repeat of at least ``length`` bytes.

    The suffixes that share ``length`` bytes are sorted (an enhanced suffix array of just
    those), and a scan with a stack walks the tree of their common-prefix intervals. An
    interval is a maximal repeat if its occurrences differ in the byte to their left; an
    occurrence at the beginning of a text differs from all. Every occurrence is listed,
    not only neighbours in the array.
    """
    data, places, classes = equal_classes(texts, starts, length)
    if not len(places):
        return
    limits = np.cumsum([0, *map(len, texts)])
    text = np.searchsorted(limits, places, side="right") - 1
    before = np.where(places > limits[text], data[places - 1].astype(np.int64), -1 - places)
    cut = np.flatnonzero(np.r_[True, classes[1:] != classes[:-1], True])
    low, high = np.minimum.reduceat(before, cut[:-1]), np.maximum.reduceat(before, cut[:-1])
    raw = data.tobytes()
    for k in np.flatnonzero((low != high) | (low < 0)).tolist():
        members = range(cut[k], cut[k + 1])
        suffix = {m: raw[places[m]:limits[text[m] + 1]] for m in members}
        order = sorted(members, key=suffix.__getitem__)
        stack: list[list] = []  # open intervals: common prefix, first place in order, bytes to the left
        for i, m in enumerate(order):
            shared = _common(suffix[order[i - 1]], suffix[m], length) if i else 0
            lefts, first = {int(before[order[i - 1]])} if i else set(), i - 1
            while stack and stack[-1][0] > shared:
                depth, first, inside = stack.pop()
                if len(inside) > 1:
                    yield depth, [(int(text[o]), int(places[o] - limits[text[o]])) for o in order[first:i]]
                lefts |= inside
            if i:
                if stack and stack[-1][0] == shared:
                    stack[-1][2] |= lefts
                else:
                    stack.append([shared, first, lefts])
                stack[-1][2].add(int(before[m]))
                for outer in stack[:-1]:
                    if len(outer[2]) < 2:
                        outer[2].add(int(before[m]))
        n = len(order)
        while stack:
            depth, first, inside = stack.pop()
            if len(inside) > 1:
                yield depth, [(int(text[o]), int(places[o] - limits[text[o]])) for o in order[first:n]]
            if stack:
                stack[-1][2] |= inside


def _common(a: bytes, b: bytes, known: int) -> int:
    n = min(len(a), len(b))
    x = np.frombuffer(a, np.uint8, n)[known:] != np.frombuffer(b, np.uint8, n)[known:]
    return known + int(x.argmax()) if x.any() else n


def spans_of_part(rows: pa.Table, length: int) -> pa.Table:
    """(key, from, upto) that maximal repeats of one part cover, or that its equal string hashes do."""
    keys, first, bodies = rows.column("key").to_pylist(), rows.column("start").to_pylist(), rows.column("body").to_pylist()
    crowd = rows.column("crowd").to_pylist()
    out: set[tuple[int, int, int]] = set()
    near = [k for k, c in enumerate(crowd) if not c]
    texts = [bodies[k] for k in near]
    for n, places in maximal_repeats(texts, [len(t) - length + 1 for t in texts], length):
        out.update((keys[near[t]], first[near[t]] + p, first[near[t]] + p + n) for t, p in places)
    packed = [np.frombuffer(bodies[k], np.int64).reshape(-1, 4) for k, c in enumerate(crowd) if c]
    table = [np.array(sorted(out), np.int64).reshape(-1, 3)]
    if packed:
        all_ = np.concatenate(packed)
        all_ = all_[np.lexsort((all_[:, 1], all_[:, 0]))]
        same = (all_[1:, :2] == all_[:-1, :2]).all(axis=1)
        hit = all_[np.r_[same, False] | np.r_[False, same]]
        table.append(np.c_[hit[:, 2], hit[:, 3], hit[:, 3] + length])
    merged = join_spans(np.concatenate(table))
    return pa.table({n: pa.array(merged[:, k]) for k, n in enumerate(("key", "from", "upto"))})


def join_spans(spans: np.ndarray) -> np.ndarray:
    """(key, from, upto) rows with overlapping and touching spans of a key made one."""
    if not len(spans):
        return spans
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    group = np.cumsum(np.r_[0, spans[1:, 0] != spans[:-1, 0]])
    wide = int(spans[:, 2].max()) + 1
    reach = np.maximum.accumulate(spans[:, 2] + group * wide) - group * wide
    new = np.r_[True, (spans[1:, 0] != spans[:-1, 0]) | (spans[1:, 1] > reach[:-1])]
    head = np.flatnonzero(new)
    return np.c_[spans[head, :2], reach[np.r_[head[1:], len(spans)] - 1]]


def bodies(docs: DataFrame, wanted: DataFrame, parts: int, length: int) -> DataFrame:
    """(part, key, start, crowd, body) for the wanted runs of each text.

    ``body`` holds the bytes around the anchor; for a crowded anchor, packed (two hashes,
    key, start) of each of its strings, dealt out by the hash.
    """
    per_text = wanted.groupBy("key").agg(F.collect_list(F.struct("start", "stop", "anchor", "crowd")).alias("runs"))
    rows = docs.join(per_text, "key").select("key", "text", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(out):
            cols = list(zip(*out, strict=True)) if out else [[]] * 5
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["part", "key", "start", "crowd", "body"])

        crowds: list[np.ndarray] = []
        size = 0

        def dealt():
            all_ = np.concatenate(crowds)
            to = (all_[:, 0].view(np.uint64) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            names, at = np.unique(to[order], return_index=True)
            return [(int(p), None, None, True, x.tobytes()) for p, x in zip(names, np.split(all_[order], at[1:]), strict=True)]

        for b in batches:
            out, waiting = [], 0
            for key, text, wants in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                raw = (text or "").encode("utf-8")
                for r in wants:
                    body = raw[r["start"]:r["stop"] + length]
                    if not r["crowd"]:
                        out.append((r["anchor"] % parts, key, r["start"], False, body))
                        waiting += len(body)
                        continue
                    data = np.frombuffer(body, np.uint8)
                    s = np.arange(len(data) - length + 1)
                    one, two = (Hashes(data, t).of(s, s + length).view(np.int64) for t in (_ONE, _TWO))
                    crowds.append(np.c_[one, two, np.full(len(s), key), s + r["start"]])
                    size += len(s)
                if size > 1 << 18:
                    out += dealt()
                    crowds, size = [], 0
                if waiting > 8 << 20:
                    yield table(out)
                    out, waiting = [], 0
            yield table(out)
        if crowds:
            yield table(dealt())

    return rows.mapInArrow(tidy_batches(run), "part int, key bigint, start bigint, crowd boolean, body binary")


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(key, from, upto): spans of the texts of ``docs`` (key, text) covered by repeated strings, written once."""
    spark = docs.sparkSession
    found = materialize(runs(docs, length), "repeat-runs")
    classes = found.groupBy("anchor", "around").agg(
        F.sum("times").alias("times"), F.min(F.struct("key", "start", "stop")).alias("one"))
    classes = materialize(classes, "repeat-classes")
    around = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    shared = classes.join(around, "anchor", "left").filter("times > 1 OR kinds > 1")
    shared = materialize(shared.select("anchor", "around", "times", "one", (F.coalesce("kinds", F.lit(0)) > 1).alias("compare"),
                                       (F.coalesce("kinds", F.lit(0)) > CROWD).alias("crowd")), "repeat-shared")
    # ``times`` counts the rows of a class, so the classes of a passage that many texts hold do not move.
    rows = found.select("key", "start", "stop", "anchor", "around")
    whole = join_hot_split(rows, shared.filter("times > 1").select("anchor", "around", "times"), ["anchor", "around"], "times").select(
        "key", F.col("start").cast("long").alias("from"), (F.col("stop") + length).cast("long").alias("upto"))
    wanted = materialize(shared.filter("compare").select("one.*", "anchor", "crowd"), "repeat-wanted")
    parts = max(partitions(spark), math.ceil(wanted.count() * (length * 3 // 2) / PART_BYTES))
    part = bodies(docs, wanted, parts, length).groupBy("part").applyInArrow(
        tidy_group(lambda t: spans_of_part(t, length)), "key bigint, from bigint, upto bigint")
    return materialize(whole.unionByName(part), "repeat-spans")


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, spans, kept.

    Every byte of the UTF-8 text that lies in a string of ``length`` bytes which also starts
    anywhere else (in this text or another) is removed; ``spans`` lists the removed places,
    ``kept`` holds the remaining bytes.

    1. Map side, each text is cut into runs of starts that have one anchor. Runs are counted
       by anchor and surroundings: equal ones, such as those of copies or inside a common
       passage, are repeated as a whole and need no further look.
    2. Where an anchor has different surroundings, one text of each kind is fetched and the
       parts' suffixes are sorted (``maximal_repeats``). Crowded anchors, such as the edges of
       a passage that a third of all texts hold, compare their strings by 128-bit hashes,
       spread over all tasks, instead of meeting in one.
    3. The spans of each text are joined and cut out.

    Defined cases: null is the empty text; texts under ``length`` bytes lose nothing; equal
    rows repeat each other whatever their ids, null ids included; an empty table gives no
    rows; further columns are ignored. A long text is worked on in overlapping pieces.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("key", F.xxhash64("doc_id", "text"))
    spans = repeated_spans(rows.select("key", "text"), length)
    per_text = spans.groupBy("key").agg(F.collect_set(F.struct("from", "upto")).alias("spans"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, found in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                raw = text.encode("utf-8")
                cut = join_spans(np.array([(0, s["from"], s["upto"]) for s in found or []], np.int64).reshape(-1, 3))[:, 1:].tolist()
                at, kept = 0, []
                for start, end in cut:
                    kept.append(raw[at:start])
                    at = end
                kept.append(raw[at:])
                kept = b"".join(kept)
                out.append((len(raw), len(raw) - len(kept), len(cut), [{"from": s, "upto": e} for s, e in cut], kept))
            cols = list(zip(*out, strict=True)) if out else [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), b.column(2).type, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])

    joined = rows.join(per_text, "key", "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(tidy_batches(run), f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, spans array<struct<from: bigint, upto: bigint>>, kept binary")
