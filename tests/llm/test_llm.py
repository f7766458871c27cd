"""The text-preparation operators against brute force on small tables with every awkward row."""

import collections
import hashlib
import html
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from clinisift.llm import (
    bpe, exact_dedup, html_text, mixing, near_dedup, queries, repeats, revisits, token_files, topk, toxicity, words)

VOCAB = queries.WORD_BPE
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, salt int, keep_id long, bucket int, size long"


def rows_of(texts, start=0):
    return [(start + i, t, "en", None if i % 7 == 6 else f"s{i % 4}", 0, "x", 1, 2, 3, 4) for i, t in enumerate(texts)]


PASSAGE = " ".join(f"common{i} passage" for i in range(40))
BASE = " ".join(f"w{i}" for i in range(120))
TEXTS = [
    None, "", "   ", "one", "One", "ONE two", "É é", "é É", "tab\tand\nline", BASE, BASE, BASE.upper(), BASE.replace("w60", "x60"),
    BASE.replace("w10", "y10"), PASSAGE + " a b c d e f", "z " + PASSAGE, PASSAGE, "aaaa" * 300, "ab" * 1000, "long " * 30000, "x" * 3000,
    "<|endoftext|> it's I'LL 12 ½ ?!", "日本語 のテキスト 日本語", "é     x", None, "",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = rows_of(TEXTS) + [(3, "one", "en", "s3", 0, "x", 1, 2, 3, 4), (None, "a null id", None, None, None, None, None, None, None, None), (None, BASE, *[None] * 8)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def collected(df):
    return [tuple(r) for r in df.collect()]


def texts_by_row(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


# -- exact dedup -----------------------------------------------------------------

def brute_exact(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[t.translate(LOWER)].append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return out


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup(docs, weak):
    """Also with a digest that most texts share: the texts decide."""
    digest = (lambda c: F.substring(c, 1, 1).cast("binary")) if weak else exact_dedup.sha256
    got = collected(exact_dedup.exact_dedup(docs, salts=5, digest=digest).drop("text_sha256" if weak else "none"))
    want = [r[:4] if weak else r for r in brute_exact(texts_by_row(docs))]
    assert collections.Counter(got) == collections.Counter(want)


def test_exact_dedup_is_native(docs):
    plan = exact_dedup.exact_dedup(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# -- mixing ----------------------------------------------------------------------

def brute_targets(sizes, cap=3):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    total, open_, target = sum(sizes.values()), set(order), {}
    left = total
    while open_:
        w = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / w >= cap * sizes[s]}
        if not over:
            target |= {s: left * weight[s] / w for s in open_}
            break
        for s in over:
            target[s] = float(cap * sizes[s])
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def test_mixing(docs, monkeypatch):
    got = mixing.mix(docs).collect()
    assert len(got) == docs.count()
    sizes = collections.defaultdict(int)
    for r in docs.collect():
        sizes[r.source] += len(WORD.findall(r.text or ""))
    target = brute_targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
    assert collections.Counter(got) == collections.Counter(mixing.mix(docs.repartition(5)).collect())
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)  # sources spread over salts give the same mix
    assert collections.Counter(got) == collections.Counter(mixing.mix(docs).collect())


def test_mixing_comes_near_the_targets(spark):
    rng = np.random.default_rng(5)
    rows = [(i, "w " * int(rng.integers(1, 200)), f"s{i % 5 if i % 3 else 0}") for i in range(4000)]
    rows = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for bucket_rows in (8192, 50):
        got = mixing.mix(rows, bucket_rows=bucket_rows)
        for r in got.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect():
            assert abs(r.taken - r.target) <= 0.01 * r.target
    # Rows of a source are drawn alike: the share of long ones among them is that of the source.
    mixed = got.join(rows.groupBy("source").count(), "source").filter("target < source_size")
    share = mixed.agg(F.avg(F.when(F.col("taken") > 0, F.col("size"))), F.avg("size")).first()
    assert share[0] == pytest.approx(share[1], rel=0.1)


def brute_times(rows, target, cap=3):
    """Expected copies of (weight, size): level * weight up to the cap, by bisection."""
    low, high = 0.0, 1e6
    for _ in range(200):
        level = (low + high) / 2
        low, high = (level, high) if sum(min(cap, level * w) * n for w, n in rows) < target else (low, level)
    return [min(cap, low * w) for w, _ in rows]


def test_mixing_by_row_weights(spark):
    rng = np.random.default_rng(8)
    rows = [(i, "w " * int(rng.integers(1, 40)), f"s{min(i % 9, 3)}", float([1, 2, 8][i % 7 % 3])) for i in range(9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, worth double").cache()
    of = {r[0]: (r[2], r[3]) for r in rows}
    taken, seeds = collections.Counter(), 8
    for seed in range(seeds):
        got = mixing.mix(docs, row_weight=F.col("worth"), seed=seed).collect()
        for s in {r.source for r in got}:
            some = [r for r in got if r.source == s]
            assert abs(sum(r.taken for r in some) - some[0].target) <= max(r.size for r in some)
        assert max(r.copies for r in got) <= 3
        taken.update({r.doc_id: r.copies for r in got})
    for s in {r.source for r in got}:
        some = [r for r in got if r.source == s]
        times = brute_times([(of[r.doc_id][1], r.size) for r in some], some[0].target)
        for w in (1, 2, 8):  # copies of each weight follow its expected number
            mine = [(taken[r.doc_id], t) for r, t in zip(some, times) if of[r.doc_id][1] == w]
            mean, want = np.mean([n for n, _ in mine]) / seeds, mine[0][1]
            assert mean == pytest.approx(want, abs=0.03), (s, w)
            assert all(seeds * int(want - 1e-6) <= n <= seeds * math.ceil(want + 1e-6) for n, _ in mine)  # the whole part is certain
    assert any(0 < t % 1 < 1 for t in times)


def test_row_weights_that_are_no_weights(spark):
    rows = [(1, "a b", "s", None), (2, "a b c", "s", float("nan")), (3, None, "s", -1.0), (4, "x", None, 0.0), (5, "", "t", float("inf"))]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string, worth double"), row_weight=F.col("worth")).collect()
    assert len(got) == 5 and all(0 <= r.taken <= 3 * r.size for r in got)


def test_mixing_with_many_sources(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.concat(F.lit("s"), F.col("id") % 900).alias("source"))
    got = mixing.mix(rows).collect()
    order = sorted({r.source for r in got})
    target = brute_targets({s: 3 * sum(1 for r in got if r.source == s) for s in order})
    assert all(r.target == pytest.approx(target[r.source]) for r in got)


def test_mixed_rows(docs):
    mixed = mixing.mix(docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]))
    rows = docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    out = mixing.mixed_rows(rows, mixed)
    assert out.columns == docs.columns
    copies = {r.doc_id: r.copies for r in mixed.collect() if r.copies}
    assert collections.Counter(r.doc_id for r in out.collect()) == collections.Counter(copies)


# -- byte pair encoding ----------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    return pytest.importorskip("tokenizers").Tokenizer.from_file(VOCAB)


def test_bpe(docs, library):
    got = collections.Counter(collected(queries.bpe_digests(docs)))
    want = []
    for i, t in texts_by_row(docs):
        ids = library.encode(t, add_special_tokens=False).ids
        said = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(said.encode()).hexdigest()))
    assert got == collections.Counter(want)
    coded = bpe.decode(bpe.encode(docs, VOCAB), VOCAB)
    assert collections.Counter((r.doc_id, r.decoded) for r in coded.collect()) == collections.Counter(
        (i, library.decode(library.encode(t, add_special_tokens=False).ids, skip_special_tokens=False)) for i, t in texts_by_row(docs))
    assert [r.decoded for r in bpe.decode(coded.limit(1).selectExpr("doc_id", "cast(null as array<int>) as ids"), VOCAB).collect()] == [""]


def test_bpe_pieces_and_blocks(library, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE_CHARS", 7)
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 3)
    coder = bpe.Coder(bpe.Vocabulary(VOCAB))
    for t in [t for t in TEXTS if t and len(t) < 5000] * 2:
        flat, counts = coder.encode([t])
        assert flat.tolist() == library.encode(t, add_special_tokens=False).ids and counts.tolist() == [len(flat)]


def test_bpe_gives_memory_back_after_each_block(library, monkeypatch):
    import pyarrow as pa

    given = []
    monkeypatch.setattr(bpe, "give_back", lambda: given.append(1))
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 50)
    some = [t for t in TEXTS if t and len(t) < 5000]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(some))), pa.array(some)], ["doc_id", "text"])
    blocks = list(bpe.coded_batches(iter([batch]), VOCAB, True))
    assert len(blocks) > 1 and len(given) == len(blocks) + 1
    assert [i for b in blocks for i in b["ids"].to_pylist()] == [library.encode(t, add_special_tokens=False).ids for t in some]


def test_bpe_merges_like_one_pair_at_a_time():
    vocab = bpe.Vocabulary(VOCAB)
    rank = {(int(a), int(b)): r for r, (a, b) in enumerate(zip(vocab.left, vocab.right, strict=True))}
    rng = np.random.default_rng(1)
    found = ["".join(rng.choice(list("aeinthrs"), rng.integers(1, 40))) for _ in range(300)] + ["a" * n for n in range(1, 30)]
    flat, counts = bpe.encode_words(vocab, found)
    for word, ids in zip(found, np.split(flat, np.cumsum(counts)[:-1]), strict=True):
        raw = word.encode()
        now = [*vocab.inner[list(raw[:-1])].tolist(), int(vocab.last[raw[-1]])]
        while pairs := [(rank[p], k) for k, p in enumerate(zip(now, now[1:], strict=False)) if p in rank]:
            r, k = min(pairs)
            now[k:k + 2] = [int(vocab.made[r])]
        assert ids.tolist() == now


# -- token files -----------------------------------------------------------------

@pytest.mark.parametrize("block", [1 << 18, 16, 250])
def test_token_counts(spark, docs, library, tmp_path, block):
    token_files.write_token_files(docs, VOCAB, str(tmp_path / "t"), block)
    got = token_files.token_counts(spark, str(tmp_path / "t"), block).collect()
    want = collections.Counter(len(library.encode(t, add_special_tokens=False).ids) for _, t in texts_by_row(docs))
    assert collections.Counter(r.n_tokens for r in got) == want
    files = sorted((tmp_path / "t").glob("part-*"))
    for k, f in enumerate(files):
        ids, starts = np.frombuffer(f.read_bytes(), ">u2"), {r.start: r.n_tokens for r in got if r.file_no == k}
        ends = np.flatnonzero(ids == token_files.END)
        begin = np.r_[0, ends[:-1] + 1]
        want = {int(s): int(e - s) for s, e in zip(begin, ends, strict=True) if not (e > s and (ids[s:e] == token_files.PAD).all())}
        assert starts == want


# -- html ------------------------------------------------------------------------

def test_html_tree_fits_its_table():
    x, y = html_text.labelled_table()
    assert (html_text.grow(x, y).predict(x) == y).mean() > 0.98


def test_html(spark):
    page = ('<html><head><title>t</title><style>p{}</style><script>var a="</p>";</script></head><body><nav><a href="/">menu</a></nav><div class="ad">buy now it is '
            'cheap and good for all of you</div><article><h1>Title &amp; more</h1><p><b>Bold  and\n plain<br>text &lt;x&gt;<p>Short.</p><p>1 &lt; 2</p></article>'
            '<section id="comments"><p>I think that this is a very long comment of a reader who had much time to write it</p></section><footer>&copy; me</footer>')
    rows = [(1, "u", page, "x"), (2, None, None, "x"), (None, "v", "", "x"), (3, "u", "no markup at all, only one line of text that runs on and on for more than twenty words to be "
            "sure that it counts as main text", "x"), (1, "u", page, "x"), (4, "w", "<p" * 2000, "x"), (5, "w", "<nav>" + "<p>deep" * 3000, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in html_text.extract(df).collect()}
    want = "Title & more\n\nBold and plain text <x>\n\nShort.\n\n1 < 2"
    assert got[1].text == want and got[1].n_chars == len(want) and got[2].text == "" and got[None].text == "" and got[5].text == ""
    assert got[3].text.startswith("no markup") and len(got) == 6 and html_text.extract(df).count() == 7
    assert html_text.extract(df.limit(0)).count() == 0


def test_html_in_wrappers():
    tree = html_text.grow(*html_text.labelled_table())
    body = "<h1>Storm on the coast</h1>" + "".join(
        f"<p>In part {i} the harbour master told the crews that the boats were to stay in until the wind had turned and the sea was calm.</p>" for i in "abcd")
    want = "\n\n".join(re.findall(r">([^<]+)</", body))
    rest = '<div class="footer"><p>all rights reserved by the owners of this site and its many writers</p></div>'
    talk = f'<div id="comments"><article class="talk"><p>{"i saw it too and it was every bit as bad as they say " * 2}</p></article></div>'
    for inner in (f"<article>{body}</article>", f"<main>{body}</main>", f"<main><div class='page has-comments'><article>{body}</article></div></main>"):
        for wrap in ("<form>", '<div class="layout has-sidebar">', '<form><div class="no-sidebar">'):
            page = f'<html><body><nav><a href="/">home</a></nav>{wrap}{inner}{rest}'
            assert html_text.main_text(page, tree) == want, (wrap, inner)
    assert html_text.main_text(f"<body><form><article>{body}</article>{talk}{rest}</form></body>", tree) == want
    assert html_text.main_text(f"<body><div class='has-sidebar'>{body}</div></body>", tree) == want
    assert html_text.main_text(f"<body><article>{body}</article><aside><article>{body}</article></aside>{talk}</body>", tree) == want


def test_html_on_given_pages(spark):
    df = queries.table(spark, "/root/testdata/sf0.01", "pages")
    got = {r.page_id: r.text for r in html_text.extract(df).collect()}
    for r in df.collect():
        body = re.search(r"(?s)<article>(.*)</article>", r.html)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?p>|</?h1>", body)]
        assert got[r.page_id] == "\n\n".join(p for p in parts if p)


# -- toxicity --------------------------------------------------------------------

def test_toxicity_on_held_out_rows(spark):
    rng = np.random.default_rng(3)
    plain, bad = [f"plain{i}" for i in range(300)], ["nasty", "Vile", "awful", "rude"]
    rows, labels = [], []
    for i in range(1200):
        toxic = i % 8 == 0
        text = list(rng.choice(plain, 40)) + list(rng.choice(bad, 1 + i % 5) if toxic else [])
        rows.append((i, " ".join(rng.permutation(text)), 0.5))
        if i < 600:
            labels.append((i, 1, int(toxic)))
    rows += [(None, "nasty vile", 0.1), (5000, None, 0.1), (5001, "", 0.1), (5002, "nasty " * 20000, 0.1), (0, rows[0][1], 0.5)]
    labels += [(None, 1, 1), (3, 1, None), (99999, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, severity double")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r.doc_id is not None and 600 <= r.doc_id < 1200]
    assert all(r.toxic == (r.doc_id % 8 == 0) for r in held)
    by_id = {r.doc_id: r for r in got}
    assert by_id[None].toxic and by_id[5002].toxic and not by_id[5000].toxic and by_id[5000].severity == by_id[5001].severity
    assert all(0 <= r.severity <= toxicity.GRADES - 1 for r in got)
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0
    assert not any(r.toxic for r in toxicity.toxicity(docs, labels.limit(0)).collect())


def test_toxicity_takes_one_row_of_an_id_and_features_only(spark, monkeypatch):
    texts = [(i, f"plain words here w{i} " + ("vile nasty" if i % 4 == 0 else "kind mild")) for i in range(80)]
    labels = spark.createDataFrame([(i, i % 4 == 0) for i in range(80)], "doc_id long, toxic boolean")
    seen = []
    plain = toxicity.fit_rows
    monkeypatch.setattr(toxicity, "fit_rows", lambda label, row, word, *a: seen.append((len(label), len(np.unique(word)))) or plain(label, row, word, *a))
    one, many = (
        toxicity.fit(spark.createDataFrame(t, "doc_id long, text string"), labels) for t in (texts, texts + [texts[4]] * 300 + [(5, "z no other text")]))
    assert seen == [(80, 2)] * 2
    assert (one.features == many.features).all() and (one.weights == many.weights).all() and (one.thresholds == many.thresholds).all()


def test_cumulative_link_orders_thresholds():
    rng = np.random.default_rng(0)
    n, f = 4000, 5
    x = rng.random((n, f)) < 0.3
    eta = x @ np.array([2.0, 1.5, 1.0, 0.5, 0.0])
    theta = np.array([1.0, 2.5, 4.0])
    grade = (rng.logistic(size=n)[:, None] + eta[:, None] > theta).sum(axis=1)
    row, feature = np.nonzero(x)
    w, t = toxicity._cumulative_link(row, feature, f, grade, 4)
    assert np.all(np.diff(t) > 0) and np.allclose(w, [2, 1.5, 1, 0.5, 0], atol=0.3) and np.allclose(t, theta, atol=0.3)


# -- revisits --------------------------------------------------------------------

def test_canonical_url(spark):
    urls = {
        "http://www.Example.org:80/A/?b=2&a=1#x": "example.org/a?a=1&b=2", "https://example.org/a/": "example.org/a", "example.org?utm_source=x&ref=y": "example.org",
        "HTTPS://example.org:8080/x": "example.org:8080/x", "http://m.example.org/q?": "m.example.org/q", "": ""}
    df = spark.createDataFrame([(u,) for u in urls], "u string").select("u", revisits.canonical_url(F.col("u")).alias("c"))
    assert {r.u: r.c for r in df.collect()} == urls


@pytest.mark.parametrize("slice_seconds", [3600, 1])
def test_revisits(spark, slice_seconds):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(600):
        hot = i % 3 == 0
        url = None if i % 50 == 7 else "http://hot.org/" if hot else f"https://www.site{int(rng.integers(8))}.org/p#f{i}"
        date = None if i % 60 == 11 else f"2024-01-01 0{int(rng.integers(3))}:{int(rng.integers(60)):02d}:{int(rng.integers(60)):02d}"
        kind = ["response", "revisit", "request"][int(rng.choice(3, p=[0.3, 0.65, 0.05]))]
        headers = {k: v for k, v in [("ETag", f'"{int(rng.integers(2))}"'), ("Last-Modified", f"d{int(rng.integers(2))}"), ("content-type", kind), ("DATE", str(i))] if rng.random() < 0.7}
        rows.append((i, kind, url, date, 200 if rng.random() < 0.9 else 404, headers if i % 40 else None, f"p{i}", "extra"))
    rows.append(rows[1])
    df = spark.createDataFrame(rows, "record_id long, kind string, url string, date string, status int, headers map<string,string>, digest string, found string")
    got = revisits.resolve_revisits(df, slice_seconds).collect()
    canon = {u: (None if u is None else re.sub(r"#.*$", "", u).split("//")[1].removeprefix("www.").rstrip("/")) for u in {r[2] for r in rows}}
    full = [r for r in rows if r[1] == "response" and r[4] == 200 and r[2] and r[3]]
    want = []
    for r in [r for r in rows if r[1] == "revisit"]:
        own = {k.lower(): v for k, v in (r[5] or {}).items()}
        near = [f for f in full if r[2] and r[3] and canon[f[2]] == canon[r[2]] and f[3] < r[3]]
        best = max(near, key=lambda f: (f[3], f[0]), default=None)
        theirs = {k.lower(): v for k, v in (best[5] or {}).items()} if best else {}
        if not best:
            outcome = "no response"
        elif "etag" in own and "etag" in theirs:
            outcome = "resolved" if own["etag"] == theirs["etag"] else "mismatch"
        elif "last-modified" in own and "last-modified" in theirs:
            outcome = "resolved" if own["last-modified"] == theirs["last-modified"] else "mismatch"
        else:
            outcome = "unverified"
        ok = outcome == "resolved"
        headers = theirs | {k: v for k, v in own.items() if k in revisits.PERMITTED} if ok else own
        want.append((r[0], canon[r[2]], best[0] if ok else None, outcome, frozenset(headers.items()), best[6] if ok else r[6]))
    assert collections.Counter((g.record_id, g.canonical_url, g.resolved_id, g.outcome, frozenset(g.headers.items()), g.digest) for g in got) == collections.Counter(want)
    assert {w[3] for w in want} == {"resolved", "mismatch", "unverified", "no response"}
    assert revisits.resolve_revisits(df.limit(0)).count() == 0


# -- repeats ---------------------------------------------------------------------

def covered(texts, length):
    seen = collections.Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        m = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                m[i:i + length] = True
        out.append(m)
    return out


def test_maximal_repeats():
    rng = np.random.default_rng(1)
    for trial in range(150):
        length = int(rng.choice([8, 9, 12, 20]))
        base = bytes(rng.choice(list(b"ab"), 60).tolist())
        texts = []
        for _ in range(int(rng.integers(1, 6))):
            t = bytes(rng.choice(list(b"abc"), int(rng.integers(0, 40))).tolist())
            a = int(rng.integers(0, 30))
            texts.append(t + base[a:a + int(rng.integers(5, 40))] + bytes(rng.choice(list(b"abc"), int(rng.integers(0, 20))).tolist()))
        got = [np.zeros(len(t), bool) for t in texts]
        for n, places in repeats.maximal_repeats(texts, [max(0, len(t) - length + 1) for t in texts], length):
            same = {texts[t][p:p + n] for t, p in places}
            assert n >= length and len(same) == 1 and len(places) > 1
            repeat = same.pop()  # all occurrences, and none can be longer on either side
            assert len(places) == sum(t[i:i + n] == repeat for t in texts for i in range(len(t) - n + 1))
            assert len({texts[t][p - 1] if p else (t, p) for t, p in places}) > 1
            assert len({texts[t][p + n] if p + n < len(texts[t]) else (t, p) for t, p in places}) > 1
            for t, p in places:
                got[t][p:p + n] = True
        assert all((a == b).all() for a, b in zip(covered(texts, length), got, strict=True)), trial


@pytest.mark.parametrize("crowd, chunk", [(256, 1 << 22), (1, 1 << 22), (256, 1500)])
def test_remove_repeats(docs, monkeypatch, crowd, chunk):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    monkeypatch.setattr(repeats, "CHUNK_BYTES", chunk)
    rows = texts_by_row(docs.filter("length(text) < 10000 OR text IS NULL"))
    got = repeats.remove_repeats(docs.filter("length(text) < 10000 OR text IS NULL")).collect()
    texts = [t.encode() for _, t in rows]
    want = []
    for (i, _), t, m in zip(rows, texts, covered(texts, 400), strict=True):
        want.append((i, len(t), int(m.sum()), int((np.diff(np.r_[0, m.astype(int)]) == 1).sum()), np.frombuffer(t, np.uint8)[~m].tobytes()))
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == collections.Counter(want)
    assert sum(w[2] for w in want) > 1000


# -- near duplicates -------------------------------------------------------------

def shingle_set(t):
    w = WORD.findall(t.translate(LOWER))
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute_near(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {(i, len(sets[i]), find(i)) for i in ids}


def test_near_dedup(docs):
    got = near_dedup.near_dedup(docs).collect()
    rows = [(i, t) for i, t in texts_by_row(docs) if i is not None]
    assert {tuple(r) for r in got if r.doc_id is not None} == brute_near(dict(rows).items())
    assert len(got) == docs.count() and all(r.component_id is None for r in got if r.doc_id is None)


def test_near_dedup_of_a_large_group(spark):
    """Copies with edits, chains that only neighbours link, and a passage that most rows hold."""
    rng = np.random.default_rng(4)
    base, texts = [f"b{i}" for i in range(60)], []
    for i in range(120):
        t = list(base)
        for k in rng.integers(0, 60, int(rng.integers(0, 3))):
            t[k] = f"e{rng.integers(1000)}"
        texts.append(" ".join(t))
    chain = [f"c{i}" for i in range(100)]
    texts += [" ".join(chain[4 * k:] + [f"n{i}" for i in range(4 * k)]) for k in range(12)]
    texts += [" ".join(base[:45]) + " " + " ".join(f"own{i}_{k}" for k in range(20)) for i in range(60)]
    rows = [(i + 5, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert {tuple(r) for r in near_dedup.near_dedup(df).collect()} == brute_near(rows)


def test_near_dedup_pairs_no_group_that_cannot_link(spark):
    groups = spark.createDataFrame([(1, 100, 11, 5), (2, 100, 12, 5), (3, 100, 11, 1)], "gid long, n long, alone int, members long")
    assert [r.gid for r in near_dedup.inside(groups).collect()] == [1]


def test_components_of_a_path(spark):
    rng = np.random.default_rng(6)
    name = rng.permutation(200)
    edges = [(int(name[i]), int(name[i + 1])) for i in range(99)] + [(int(name[i]), int(name[i + 1])) for i in range(120, 180)]
    got = dict(collected(near_dedup.components(spark.createDataFrame(edges, "a long, b long"))))
    assert got == {int(n): int(min(part)) for part in (name[:100], name[120:181]) for n in part}


def test_packing():
    rng = np.random.default_rng(8)
    v = np.unique(rng.integers(0, 2**63, 1000, dtype=np.uint64))
    e = rng.integers(0, 256, len(v)).astype(np.uint8)
    a, b = near_dedup.unpack(near_dedup.pack(v, e))
    assert (a == v).all() and (b == e).all() and len(near_dedup.unpack(near_dedup.pack(v[:0], e[:0]))[0]) == 0


def test_words_do_not_depend_on_blocks(monkeypatch):
    import pyarrow as pa

    column = pa.array(TEXTS)
    whole = {k: w.tolist() for k, w in words.row_words(column)}
    monkeypatch.setattr(words, "CHUNK_BYTES", 50)
    assert {k: w.tolist() for k, w in words.row_words(column)} == whole
    for k, t in enumerate(TEXTS):
        assert len(whole[k]) == len(WORD.findall(t or ""))
    assert whole[9] == whole[11] and whole[6][0] != whole[6][1]


# -- top-k -----------------------------------------------------------------------

def test_topk(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 8) / 4]) for i in range(400)]
    rows += [(400, None), (450, [None] * 8), (500, [float("nan")] * 8), (550, [float("inf")] + [0.0] * 7), (600, [1.0, 2.0]), (601, [1.0, 2.0]), (None, [0.0] * 8), (51, rows[51][1]), (650, [])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, block int, dim int")
    good = [(i, np.floor(256 * np.array(v, float)).astype(int)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = collections.Counter()
    for q, v in good:
        if q % 50 == 0:
            best = sorted(((-int(v @ w), i) for i, w in good if i != q and len(w) == len(v)))[:5]
            want.update((q, s, i) for s, i in best)
    for blocks in (8192, 60):
        table = topk.pivot_table(df, block_rows=blocks)
        got = topk.top_k(table, F.col("id") % 50 == 0, block_queries=4).collect()
        once = {(r.query_id, -r.score, r.vec_id) for r in got}
        assert once == set(want)
        assert all(1 <= r["rank"] <= 5 for r in got)
    assert topk.top_k(topk.pivot_table(df.limit(0)), F.col("id") % 50 == 0).count() == 0


# -- all of them -----------------------------------------------------------------

def test_empty_tables(none):
    assert exact_dedup.exact_dedup(none).count() == 0
    assert mixing.mix(none).count() == 0 and mixing.mixed_rows(none, mixing.mix(none)).count() == 0
    assert queries.bpe_digests(none).count() == 0
    assert repeats.remove_repeats(none).count() == 0
    assert near_dedup.near_dedup(none).count() == 0


def test_repeated_and_shuffled_runs_agree(docs):
    rows = docs.filter("doc_id IS NOT NULL AND length(text) < 10000").dropDuplicates(["doc_id"])
    for run in (near_dedup.near_dedup, repeats.remove_repeats, exact_dedup.exact_dedup):
        assert collections.Counter(map(str, run(rows).collect())) == collections.Counter(map(str, run(rows.repartition(5)).collect()))
