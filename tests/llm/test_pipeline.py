"""The pipeline stage by stage on the smallest tables, each against what its operator must leave."""

import collections
import hashlib

import pytest

import corpus_pipeline
from clinisift.llm import mixing, queries, toxicity
from clinisift.session import materialize
from test_llm import LOWER, brute_near

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = queries.table(spark, SF, "documents"), []
    out.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), "stage")
        out.append(docs)
    return out


def test_all_but_the_last_keep_the_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_toxic_rows_go_and_no_others(spark, stages):
    scored = toxicity.toxicity(stages[0], queries.table(spark, SF, "labels"))
    assert {r.doc_id for r in stages[1].collect()} == {r.doc_id for r in scored.collect() if not r.toxic}


def test_one_of_equal_texts_stays(stages):
    last = {}
    for r in stages[1].collect():
        key = (r.text or "").translate(LOWER)
        last[key] = max(last.get(key, -1), r.doc_id)
    assert {r.doc_id for r in stages[2].collect()} == set(last.values())


def test_one_of_linked_texts_stays(stages):
    rows = {r.doc_id: r.text or "" for r in stages[2].collect()}
    assert {r.doc_id for r in stages[3].collect()} == {c for _, _, c in brute_near(rows.items())}


def test_rows_come_as_often_as_the_mix_takes_them(stages):
    copies = {r.doc_id: r.copies for r in mixing.mix(stages[3]).collect() if r.copies}
    assert collections.Counter(r.doc_id for r in stages[4].collect()) == collections.Counter(copies)


def test_ids_are_those_of_the_library(stages):
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(queries.WORD_BPE)
    want = collections.Counter()
    for r in stages[4].collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want[(r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
              hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())] += 1
    assert collections.Counter(map(tuple, stages[5].collect())) == want


def test_run_equals_its_stages(spark, stages):
    assert collections.Counter(map(tuple, corpus_pipeline.run(spark, SF).collect())) == collections.Counter(map(tuple, stages[5].collect()))


def test_nulls_empty_tables_and_more_columns(spark):
    rows = [(1, None, "en", "a", 0), (2, "", "en", None, 0), (None, "w " * 50, None, "b", 5), (4, "One text of its own", "en", "b", 5), (5, "one text of its own", "en", "b", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for table in (docs, docs.limit(0)):
        now = table
        for _, stage in corpus_pipeline.STAGES:
            now = materialize(stage(spark, now, SF), "stage")
        assert now.count() > 0 if table is docs else now.count() == 0


def test_null_ids_and_one_id_with_two_texts(spark):
    def text(name):
        return " ".join(f"{name}{i}" for i in range(60))

    kind = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, text("a")), (2, text("a")), (None, text("a").upper()), (1, text("b")), (None, text("c")),  # copies of 2; other texts
            (3, text("d")), (7, text("d") + " end"), (7, text("e")), (None, text("d") + " stop"), (None, text("f")), (8, text("g"))]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], kind)
    once = corpus_pipeline.drop_copies(spark, docs, SF)
    assert collections.Counter((r.doc_id, r.text) for r in once.collect()) == collections.Counter(rows[1:2] + rows[3:])
    near = materialize(corpus_pipeline.drop_near_copies(spark, once, SF), "stage")
    left = [r for r in rows[1:2] + rows[3:] if not r[1].endswith(("end", "stop"))]
    assert collections.Counter((r.doc_id, r.text) for r in near.collect()) == collections.Counter(left) and near.columns == docs.columns
    # Every text by itself: null ids are taken as often as rows with an id of their own would be.
    keys = {(r.doc_id, r.text): r.row_key for r in corpus_pipeline.keyed(near).collect()}
    assert len(set(keys.values())) == len(left) and keys[(3, text("d"))] == 3
    named = spark.createDataFrame([(k, t, "en", "s", 1) for (_, t), k in keys.items()], kind)
    times = {r.doc_id: r.copies for r in mixing.mix(named).collect() if r.copies}
    assert collections.Counter(keys[(r.doc_id, r.text)] for r in corpus_pipeline.mix_sources(spark, near, SF).collect()) == times


def test_columns_of_any_name(spark):
    names = ["toxicity", "row_key", "given_id", "shared_", "id_", "copies_", "copy_", "id", "size", "u", "c0", "a.b", "other_1"]
    rows = [(i, t, "en", "s", *[k * 100 + i for k in range(len(names))]) for i, t in enumerate(["a b c", "A b c", " ".join(f"w{i}" for i in range(70)), None])]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "lang", "source", *names])
    now = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = materialize(stage(spark, now, SF), "stage")
        assert now.columns == docs.columns and now.schema == docs.schema
    assert {tuple(r) for r in now.collect()} <= set(rows) and now.count() > 0
    assert corpus_pipeline.encode(spark, now, SF).count() == now.count()
