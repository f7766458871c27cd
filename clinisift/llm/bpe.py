"""BPE encoding and decoding over a pair occurrence index."""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from .common import give_back, tidy_batches

#: UTF-8 bytes of text whose words share one index. What a block leaves is given back before the next one.
BLOCK_BYTES = 2 << 20
#: Words whose encoding a task remembers before it starts afresh.
KNOWN_WORDS = 100_000
#: Long texts are read in pieces of about so many characters, cut before white space.
PIECE_CHARS = 1 << 20


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in plain}
    for b in range(256):
        letters.setdefault(b, chr(256 + b if b < 0x21 else 256 + 0x21 + b - 0x7F if b < 0xA1 else 256 + 0x21 + 0x22))
    return [letters[b] for b in range(256)]


class Vocabulary:
    """Ids, merges and splitting rules of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        ids = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in ids.items()} | {i: t for t, i in self.special.items()}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        pairs = np.array([(ids[a], ids[b], ids[a + b]) for a, b in merges], dtype=np.int64)
        self.left, self.right, self.made = pairs[:, 0], pairs[:, 1], pairs[:, 2].astype(np.int32)
        keys = self.left << 32 | self.right
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        letters = byte_letters()
        self.inner = np.array([ids[c] for c in letters], dtype=np.int32)
        self.last = np.array([ids[c + self.suffix] for c in letters], dtype=np.int32)
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # White space as the file's regular expressions know it: no information separators.
        pattern = split["pattern"]["Regex"].replace("\\s", "\\p{White_Space}")
        self.words = regex.compile(pattern)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, -1 for pairs that never merge."""
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], -1)

    def parts(self, text: str) -> Iterator[str | int]:
        """Words of ``text`` in normal form; special tokens come as their ids."""
        for piece in pieces(text):
            for k, run in enumerate(self.marks.split(piece) if self.marks else [piece]):
                if k % 2:
                    yield self.special[run]
                elif run:
                    # Lower case letter by letter: a final sigma has no rule of its own.
                    yield from self.words.findall(unicodedata.normalize("NFC", run).replace("Σ", "σ").lower())


def pieces(text: str) -> Iterator[str]:
    """``text`` cut before spaces or line ends, so that no word, mark or composed letter is split."""
    at = 0
    while len(text) - at > PIECE_CHARS:
        cut = max(text.rfind(" ", at + 1, at + PIECE_CHARS), text.rfind("\n", at + 1, at + PIECE_CHARS))
        if cut < 0:
            later = [p for p in (text.find(" ", at + PIECE_CHARS), text.find("\n", at + PIECE_CHARS)) if p > 0]
            if not later:
                break
            cut = min(later)
        yield text[at:cut]
        at = cut
    yield text[at:]


def encode_words(vocab: Vocabulary, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in a row, and how many each word (none is empty) has.

    All words lie in one array of symbols with links to their neighbours. The index maps
    each mergeable pair to all its positions. Ranks are applied in ascending order, each
    at all its positions at once; the pairs that a merge creates join their lists. A
    position stays in a list that it has left and is tested when the list's turn comes.
    """
    raw = [w.encode("utf-8") for w in words]
    lengths = np.array([len(r) for r in raw], dtype=np.int64)
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    n = len(data)
    if not n:
        return np.empty(0, np.int32), np.empty(0, np.int32)
    ends = np.cumsum(lengths) - 1
    sym = vocab.inner[data]
    sym[ends] = vocab.last[data[ends]]
    nxt = np.arange(1, n + 1, dtype=np.int32)
    nxt[ends] = -1
    prv = np.arange(-1, n - 1, dtype=np.int32)
    prv[ends[:-1] + 1] = -1
    prv[0] = -1
    index: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def enter(at: np.ndarray) -> None:
        rank = vocab.ranks(sym[at], sym[nxt[at]])
        at, rank = at[rank >= 0], rank[rank >= 0]
        if not len(at):
            return
        by = np.argsort(rank, kind="stable")
        at, rank = at[by], rank[by]
        cut = np.flatnonzero(np.diff(rank)) + 1
        for r, positions in zip(rank[np.r_[0, cut]].tolist(), np.split(at, cut), strict=True):
            if r in index:
                index[r].append(positions)
            else:
                index[r] = [positions]
                heapq.heappush(active, r)

    enter(np.flatnonzero(nxt >= 0).astype(np.int32))
    while active:
        r = heapq.heappop(active)
        lists = index.pop(r)
        at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
        a, b = vocab.left[r], vocab.right[r]
        follow = nxt[at]
        at = at[(sym[at] == a) & (follow >= 0) & (sym[follow] == b)]
        if a == b and len(at) > 1:  # of overlapping pairs the left one wins
            at, taken, kept = np.sort(at), -1, []
            for p in at.tolist():
                if p != taken:
                    kept.append(p)
                    taken = nxt[p]
            at = np.array(kept, dtype=np.int32)
        if not len(at):
            continue
        gone = nxt[at]
        after = nxt[gone]
        sym[at] = vocab.made[r]
        sym[gone] = -1
        nxt[at] = after
        prv[after[after >= 0]] = at[after >= 0]
        before = prv[at]
        enter(np.unique(np.concatenate([before[before >= 0], at[nxt[at] >= 0]])))
    left = sym >= 0
    counts = np.add.reduceat(left.astype(np.int32), np.r_[0, ends[:-1] + 1])
    return sym[left], counts


class _Known(dict):
    """Numbers words in the order of their first use."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


class Coder:
    """Encodes texts block by block; a task remembers the words it has met."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self._forget()

    def _forget(self) -> None:
        self.known, self.n = _Known(), 0
        self.flat, self.counts = np.empty(0, np.int32), np.empty(0, np.int32)

    def _learn(self) -> None:
        fresh = list(self.known)[self.n:]
        self.n = len(self.known)
        words = [w for w in fresh if isinstance(w, str)]
        flat, counts = encode_words(self.vocab, words)
        if len(words) < len(fresh):  # special tokens stand for themselves
            lists = iter(np.split(flat, np.cumsum(counts)[:-1]))
            each = [next(lists) if isinstance(w, str) else np.array([w], np.int32) for w in fresh]
            flat, counts = np.concatenate(each), np.array([len(e) for e in each], np.int32)
        self.flat, self.counts = np.concatenate([self.flat, flat]), np.concatenate([self.counts, counts])
        self.starts = np.cumsum(self.counts, dtype=np.int64) - self.counts

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each text has; null is the empty text."""
        if len(self.known) > KNOWN_WORDS:
            self._forget()
        words = [np.fromiter(map(self.known.__getitem__, self.vocab.parts(t)), np.int32) if t else np.empty(0, np.int32) for t in texts]
        self._learn()
        flat, counts = [], []
        for w in words:  # one text at a time bounds the index arrays
            n = self.counts[w]
            total = int(n.sum())
            shift = np.repeat(self.starts[w] - (np.cumsum(n, dtype=np.int64) - n), n)
            flat.append(self.flat[shift + np.arange(total)])
            counts.append(total)
        return np.concatenate([np.empty(0, np.int32), *flat]), np.array(counts, np.int64)


def _blocks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about BLOCK_BYTES of text; a longer text is a range of its own."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(sizes):
        before = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, before + BLOCK_BYTES, side="right")))
        yield start, end
        start = end


def coded_batches(batches: Iterator[pa.RecordBatch], vocab_path: str, decoded: bool = False) -> Iterator[pa.RecordBatch]:
    """Batches of (id, text) as (doc_id, ids[, decoded]), block by block; memory is given back after each block."""
    names = ["doc_id", "ids", *["decoded"] * decoded]
    vocab = Vocabulary(vocab_path)
    coder, tokens = Coder(vocab), token_strings(vocab) if decoded else None
    give_back()  # what reading the file took
    for batch in batches:
        keys, texts = batch.column(0), batch.column(1)
        for start, end in _blocks(texts):
            flat, counts = coder.encode(texts.slice(start, end - start).to_pylist())
            offsets = np.r_[0, np.cumsum(counts)]
            ids = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))
            said = [joined(tokens, ids.values, offsets)] if decoded else []
            yield pa.RecordBatch.from_arrays([keys.slice(start, end - start), ids, *said], names)
            del flat, counts, offsets, ids, said
            give_back()


def encode(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id and ids, the token ids of the whole text; with
    ``decoded`` also what :func:`decode` makes of the ids, in the same pass.

    Map side only. The distinct words of a block of rows are encoded together through one
    pair occurrence index (``encode_words``); texts are then put together from their words.

    Defined cases: a null or empty text has no ids; a null id stays null; repeated rows give
    repeated rows; very long texts are read in pieces; an empty table gives no rows; further
    columns are ignored. The tokenizer file is read by its path in every task.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return coded_batches(batches, vocab_path, decoded)

    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(tidy_batches(run), f"doc_id {kind}, ids array<int>" + ", decoded string" * decoded)


def token_strings(vocab: Vocabulary) -> pa.Array:
    return pa.array([vocab.token.get(i) for i in range(max(vocab.token) + 1)], pa.large_string())


def joined(tokens: pa.Array, ids: pa.Array, offsets: np.ndarray) -> pa.Array:
    """The tokens of each list of ids with one space between them."""
    lists = pa.LargeListArray.from_arrays(pa.array(offsets.astype(np.int64)), tokens.take(ids))
    return pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())


def decode(encoded: DataFrame, vocab_path: str) -> DataFrame:
    """``doc_id, ids`` with ``decoded``: the tokens of the ids with one space between them.

    The tokenizer file names no decoder, so tokens keep their letters and word ends.
    Null ids decode to the empty text; an id outside the vocabulary is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = token_strings(Vocabulary(vocab_path))
        give_back()
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                ids = part.column(1)
                lengths = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
                text = joined(tokens, ids.flatten(), np.r_[0, np.cumsum(lengths)])
                yield pa.RecordBatch.from_arrays([*part.columns, text], ["doc_id", "ids", "decoded"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(tidy_batches(run), f"doc_id {kind}, ids array<int>, decoded string")
