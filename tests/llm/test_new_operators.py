"""Alignment, MinHash and phrases against brute force on small tables with every awkward row."""

import collections
import hashlib
import json
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from clinisift.llm import alignment, minhash, phrases, queries, repeats

P = pytest.importorskip("public_tokenizers")
A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, label long, token string, n long, block long, score double"
BASE = " ".join(f"w{i}" for i in range(120))
TEXTS = [
    None, "", "   ", "one", "One", "ONE two", "two one", "É é", "é É", "tab\tand\nline", BASE, BASE, BASE.upper(), BASE.replace("w60", "x60"), BASE.replace("w10", "y10"),
    "<|endoftext|> it's I'LL <s> <0x41> 12 ½ ?!", "日本語 のテキスト 日本語 " * 4, "é     x  ", "▁ and ▁▁", "a\x00b", "🙂 emoji 👩‍👩‍👧 " * 3, "ﬁne ligature ① Ⅳ", "long word " * 4000, None, ""]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, [None, "en", "de", "und"][i % 4], 1, "x", 2, 3, 0.5) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows + [(3, "one", "en", 1, "x", 2, 3, 0.5), (None, BASE, None, None, None, None, None, None)], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(docs):
    return [(r.doc_id, r.text or "", r.lang or "und") for r in docs.collect()]


# -- alignment -------------------------------------------------------------------

def brute_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(A)
    whole.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = alignment.byte_letters()
    found, count = [], collections.Counter()
    for i, text, _ in rows:
        a = whole.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        spelled = [[bytes(letters[c] for c in whole.id_to_token(k)) for k in a],
                   [bytes([int(pieces.id_to_piece(k)[3:5], 16)]) if pieces.is_byte(k) else pieces.id_to_piece(k).replace("▁", " ").encode() for k in b]]
        if any(b"".join(s) != (" " + text).encode() for s in spelled):
            a, b, spelled = [], [], [[], []]
        ends = [{e: k for k, e in enumerate(np.cumsum([len(x) for x in s]).tolist())} for s in spelled]
        links = [(ends[0][e], ends[1][e]) for e in sorted(ends[0]) if e in ends[1]]
        count.update((a[x], b[y]) for x, y in links)
        found.append((i, a, b, links))
    best = collections.Counter()
    for (_, y), c in count.items():
        best[y] = max(best[y], c)
    out = []
    for i, a, b, links in found:
        cut = [(0, 0), *((x + 1, y + 1) for x, y in links)]
        text = ";".join(f"{','.join(map(str, a[p:x]))}|{','.join(map(str, b[q:y]))}" for (p, q), (x, y) in zip(cut, cut[1:], strict=False))
        pairs = [(a[x], b[y]) for x, y in links]
        out.append((i, len(a), len(b), len(links), len(links), sum(count[p] == best[p[1]] for p in pairs), sum(count[p] for p in pairs),
                    hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return out


def test_alignment_as_brute_force(docs, none, monkeypatch):
    for block in (alignment.BLOCK_BYTES, 1):
        monkeypatch.setattr(alignment, "BLOCK_BYTES", block)
        got = alignment.alignment(docs, A, B, queries.sha256).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(brute_alignment(rows_of(docs)), key=repr)
    assert alignment.alignment(none, A, B).count() == 0


def test_blocks_of_aligned_texts_are_small(spark):
    rows = spark.range(40).select(F.col("id").alias("doc_id"), F.repeat(F.lit(BASE + " "), 320).alias("text")).coalesce(1)
    blocks = alignment.link_blocks(rows, A, B, queries.sha256).select(F.explode("docs.n_links").alias("n"), "block").groupBy("block").agg(F.sum("n").alias("n"))
    links = [r["n"] for r in blocks.collect()]
    assert len(links) > 1 and max(links) < 2_000_000


def test_aligned_rows_spell_the_text(docs):
    import sentencepiece

    pair = alignment.tokenizer_pair(A, B)
    for r in alignment.align(docs, A, B).join(docs.select("doc_id", "text").dropDuplicates(["doc_id"]), "doc_id").collect():
        if r.a_ids:
            assert b"".join(pair.bytes_a[k] for k in r.a_ids) == b"".join(pair.bytes_b[k] for k in r.b_ids) == (" " + r.text).encode()
            for x, y in zip(r.a_end, r.b_end, strict=True):
                assert sum(len(pair.bytes_a[k]) for k in r.a_ids[:x + 1]) == sum(len(pair.bytes_b[k]) for k in r.b_ids[:y + 1])
    assert sentencepiece and len(pair.bytes_b) == 32000


def test_overlaps_are_all_pairs_that_share_bytes():
    rng = np.random.default_rng(5)
    for _ in range(20):
        a, b = (np.unique(np.r_[0, rng.integers(0, 60, 12)]) for _ in range(2))
        i, j = alignment.overlaps(a, b)
        ends = [np.r_[x[1:], 70] for x in (a, b)]
        want = [(x, y) for x in range(len(a)) for y in range(len(b)) if max(a[x], b[y]) < min(ends[0][x], ends[1][y])]
        assert list(zip(i.tolist(), j.tolist(), strict=True)) == want


def test_both_engines_split_settled_letters_alike():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(A)
    whole.encode_special_tokens = True
    pair = alignment.tokenizer_pair(A, B)
    rng = random.Random(3)
    letters = [chr(c) for c in range(0x250)]
    texts = [f"a{c}b {c} 1{c}{c}'{c}s" for c in letters] + ["".join(rng.choices(letters + list("  \n'stvrelmd19"), k=60)) for _ in range(3000)]
    assert pair.encode_a(texts) == [whole.encode(" " + t, add_special_tokens=False).ids for t in texts]
    with open(A, encoding="utf-8") as f:
        assert json.load(f)["model"]["type"] == "BPE"


# -- MinHash ---------------------------------------------------------------------

def brute_near(rows, k=4):
    sets, parent = {}, {}
    for i, t, _ in rows:
        w = WORD.findall(t.translate(LOWER))
        sets.setdefault(i, []).append({tuple(w[x:x + k]) for x in range(max(1, len(w) - k + 1))} if w else set())
    parent = {i: i for i in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = list(parent)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            if any(s and 100 * len(s & t) >= 80 * len(s | t) for s in sets[a] for t in sets[b]):
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return sorted(((i, len(s), find(i) if i is not None else None, i is None or find(i) == i) for i in sets for s in sets[i]), key=repr)


def test_minhash_as_brute_force(docs, none):
    assert sorted(map(tuple, minhash.minhash(docs).collect()), key=repr) == brute_near(rows_of(docs))
    assert minhash.minhash(none).count() == 0


def test_minhash_groups_of_copies_and_common_passages(spark):
    rng = random.Random(9)
    words = [f"v{k}" for k in range(4000)]
    passage = rng.choices(words, k=60)
    rows = []
    for g in range(12):  # families whose members differ by a few words, some of them short
        base = rng.choices(words, k=rng.choice([5, 12, 80, 300]))
        for _ in range(rng.choice([1, 3, 25])):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append(" ".join(text))
    rows += [" ".join(rng.choices(words, k=40) + passage) for _ in range(150)]  # a passage in documents that are no copies
    rows += [rows[0]] * 40
    rng.shuffle(rows)
    docs = spark.createDataFrame([(k * 3, t, None) for k, t in enumerate(rows)], "doc_id long, text string, lang string").repartition(4)
    assert sorted(map(tuple, minhash.minhash(docs).collect()), key=repr) == brute_near(rows_of(docs))


def test_minhash_group_of_texts_just_too_different(spark, monkeypatch):
    rng = random.Random(21)
    base = [f"b{k}" for k in range(150)]
    rows = []
    for k in range(500):  # some are linked with a few in the middle, most are too far from all others
        text = list(base)
        for at in rng.sample(range(150), rng.choice([1, 2, 3, 5, 5, 6, 6])):
            text[at] = f"x{k}_{at}" if rng.random() < 0.95 else f"x{at}"
        rows.append((k if k % 50 else None if k else 7, " ".join(text), None))  # a null id, one id twice
    tested, verified = [], minhash.verified
    monkeypatch.setattr(minhash, "verified", lambda pairs, sets: tested.append(pairs.count()) or verified(pairs, sets))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    found = sorted(map(tuple, minhash.minhash(docs).collect()), key=repr)
    assert found == brute_near(rows_of(docs))
    assert 30 < len({r[2] for r in found}) < 450
    assert tested[-1] < 10 * len(rows), tested


def test_signatures_estimate_similarity_with_lower_variance():
    rng = np.random.default_rng(1)
    for n in (1, 30, 600):
        common = rng.integers(1, 2**63, (200, n), dtype=np.uint64)
        own = [rng.integers(1, 2**63, (200, max(1, n // 8)), dtype=np.uint64) for _ in range(2)]
        sets = [np.hstack([common, o]) for o in own]
        size = sets[0].shape[1]
        s = minhash.super_minhash(np.concatenate([x.ravel() for x in sets]), np.repeat(np.arange(400), size), 400)
        j = n / (2 * size - n)
        same = (s[:200] == s[200:]).mean(axis=1)
        assert abs(same.mean() - j) < 0.01 and same.var() < 1.25 * j * (1 - j) / minhash.SIZE
        assert (s < 2**64 - 1).all()


def test_variance_factor_and_least_agreement():
    rng = np.random.default_rng(7)
    for n in (20, 150, 1000):
        size = 9 * n // 8
        common = rng.integers(1, 2**63, (600, n), dtype=np.uint64)
        sets = [np.hstack([common, rng.integers(1, 2**63, (600, size - n), dtype=np.uint64)]) for _ in range(2)]
        s = minhash.super_minhash(np.concatenate([x.ravel() for x in sets]), np.repeat(np.arange(1200), size), 1200)
        j = n / (2 * size - n)
        measured = (s[:600] == s[600:]).mean(axis=1).var() / (j * (1 - j) / minhash.SIZE)
        assert abs(measured / minhash.variance_factor(2 * size - n) - 1) < 0.25
        x = minhash.bits_of(s[:600]) ^ minhash.bits_of(s[600:])
        unlike = np.bitwise_count((x | x >> np.uint64(1)) & np.uint64(0x5555555555555555)).sum(axis=1)
        assert (minhash.SIZE - unlike >= minhash.least_agreement(size)).all()
    assert 380 <= minhash.least_agreement(1 << 30) < minhash.least_agreement(128) < 400


def test_forest_keeps_what_edges_connect(spark, monkeypatch):
    monkeypatch.setattr(minhash, "FOREST_EDGES", 5)
    rng = random.Random(2)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)]
    got = [tuple(r) for r in minhash.forest(spark.createDataFrame(edges, "a long, b long").repartition(3)).collect()]

    def parts(pairs):
        parent = list(range(60))
        for _ in range(60):
            for a, b in pairs:
                parent[a] = parent[b] = min(parent[a], parent[b])
        return parent

    assert parts(got) == parts(edges) and all(a < b for a, b in got)


# -- phrases ---------------------------------------------------------------------

def brute_phrases(rows, least, top):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for _, t, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", t.translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 6):
                f[lang].update(tuple(w[x:x + k]) for x in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        good = [p for p, a in c.items() if len(p) > 1 and a >= least]
        cover = collections.Counter()
        for p in good:
            for k in range(2, len(p)):
                for x in range(len(p) - k + 1):
                    cover[p[x:x + k]] = max(cover[p[x:x + k]], c[p])
        found = []
        for p in good:
            if cover[p] < c[p]:
                score, _, l, r = min((1000 * c[p] * n[lang] // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
                found.append((-score, -c[p], " ".join(p).encode(), l, r))
        out += [(lang, k + 1, p.decode(), -a, l, r, n[lang], -s) for k, (s, a, p, l, r) in enumerate(sorted(found)[:top])]
    return sorted(out)


@pytest.fixture(scope="module")
def prose(spark):
    rng = random.Random(4)
    common, rare = ["the", "of", "And", "ÉTÉ", "a"], [f"r{k}" for k in range(300)]
    rows = []
    for k in range(160):
        w = []
        for _ in range(rng.randint(0, 90)):
            w += rng.choices([[rng.choice(common)], [rng.choice(rare)], ["new", "york", "city"], ["as", "well", "as", "the"], ["Of."], ["x\ty"], ["end;"], [" ", "\x0b"]], [5, 4, 1, 1, 1, 1, 1, 1])[0]
        rows.append((k, " ".join(w), rng.choice(["en", "de", None])))
    rows += [(0, None, "en"), (1, "", None), (2, "the the the the the the of " * 3000, "en"), (None, "only und, lang", "und")] + [rows[5]] * 30
    return spark.createDataFrame([r + (1, "x") for r in rows], "doc_id long, text string, lang string, n long, word string").repartition(3)


@pytest.mark.parametrize("bucket_rows, block_bytes", [(1 << 19, 8 << 20), (50, 2000)])
def test_phrases_as_brute_force(prose, none, bucket_rows, block_bytes):
    for least, top in ((8, 2000), (3, 7)):
        got = phrases.collocations(prose, least, top=top, bucket_rows=bucket_rows, block_bytes=block_bytes).collect()
        assert sorted(map(tuple, got)) == brute_phrases(rows_of(prose), least, top)
    assert phrases.collocations(none).count() == 0


def test_quicksort_counts_every_prefix():
    rng = np.random.default_rng(6)
    columns = rng.integers(1, 6, (5, 3000))
    columns[3:, :700] = 0
    times = rng.integers(1, 4, 3000)
    want = collections.Counter()
    for row, t in zip(columns.T.tolist(), times.tolist(), strict=True):
        for d in range(2, 6):
            if all(row[:d]):
                want[tuple(row[:d])] += t
    for hot in (0, 2):
        got = {tuple(ids): a for ids, a in phrases.count_phrases(columns, times, 20, hot)}
        assert got == {p: a for p, a in want.items() if a >= 20 or all(x <= hot for x in p)}


def test_long_texts_are_cut_between_pieces():
    text = b"alpha beta. " * 400 + b"x" * 900 + b". end"
    parts = list(phrases.cut_text(text, 300))
    assert b"".join(parts) == text and all(p.rstrip()[-1:] == b"." for p in parts[:-1])


# -- repeated passages of varied length -----------------------------------------

def test_passages_around_the_least_length(spark):
    """Passages of 380 to 900 bytes, with letters of several bytes, that meet at both ends of texts."""
    rng = random.Random(8)
    alphabet = "abcdefghij é日"
    say = lambda n: "".join(rng.choices(alphabet, k=n))
    passages = []
    for size in (380, 399, 400, 401, 450, 900):
        p = say(1000).encode()[:size].decode(errors="ignore")
        passages.append(p + "z" * (size - len(p.encode())))
    texts = [say(rng.randint(0, 300)) + a + (say(rng.randint(0, 200)) if k % 3 else "") + b + say(rng.randint(0, 300))
             for k in range(24) for a, b in [rng.sample(passages, 2)]] + [passages[0], passages[2], passages[3] + passages[2], say(2000)]
    raw = [t.encode() for t in texts]
    seen = collections.Counter(r[x:x + 400] for r in raw for x in range(len(r) - 399))
    got = {r.doc_id: r for r in repeats.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)).collect()}
    for i, r in enumerate(raw):
        gone = np.zeros(len(r) + 1, bool)
        for x in range(len(r) - 399):
            if seen[r[x:x + 400]] > 1:
                gone[x:x + 400] = True
        assert (got[i].n_removed, bytes(got[i].kept)) == (int(gone.sum()), bytes(np.frombuffer(r, np.uint8)[~gone[:-1]]))
