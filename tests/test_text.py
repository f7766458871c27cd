"""Text operators on small documents in the shapes a clinic writes, with edge rows."""

import functools
import re

import pytest

from clinisift.functions import lexicons as LX
from clinisift.functions import redaction as RD
from clinisift.operators import enrich as E
from clinisift.operators import lexical as L
from clinisift.operators import parse as P
from clinisift.operators import summary as S
from pyspark.sql import functions as F

NOTE = """RIVERSIDE WARD
Patient Name: Ada Example
Date of Birth: 03/04/1950
Provider: Dr. Bo Sample
Diagnosis: Type 2 diabetes
Medication: metformin 500 mg
Medication: insulin glargine
Total Amount: $1,250.50

VITALS:
- BP 128/80
- Temp 37.0
The nurse noted severe pain overnight. Urgent review of vitals was requested!
Call (555) 010-0199 or mail ada@example.org. MRN-12345678-AB. Follow up with the nursing team."""


def docs(spark, rows):
    return spark.createDataFrame(rows, "id long, text string")


EDGE = [(1, NOTE), (2, ""), (3, None), (4, "word"), (5, "Der Hund und die Katze von nebenan sind mit dem Ball nicht im Haus.")]


def test_fields_and_missing_paths(spark):
    r = {x["id"]: x for x in P.extract_fields(docs(spark, EDGE), P.DOCUMENT_FIELDS).collect()}
    assert r[1]["patient_name"] == "Ada Example" and r[1]["date_of_birth"] == "03/04/1950"
    assert r[1]["medications"] == ["metformin 500 mg", "insulin glargine"]
    assert r[1]["total_amount"] == 1250.5 and r[1]["insurance_id"] is None
    assert all(r[i][c] is None for i in (2, 3, 4) for c in ("patient_name", "medications", "total_amount"))


def test_amount_that_is_no_number(spark):
    r = P.extract_fields(docs(spark, [(1, "Total: 1.2.3")]), P.DOCUMENT_FIELDS).first()
    assert r["total_amount"] is None


def test_classify_ties_and_no_hit(spark):
    r = {x["id"]: x for x in L.classify(docs(spark, EDGE), {k: LX.DOCUMENT_TERMS[k] for k in LX.TEXT_LABELS}).collect()}
    assert r[1]["category"] == "Nursing Notes" and 0 < r[1]["confidence"] <= 1
    assert r[2]["category"] is None and r[3]["category"] is None and r[4]["confidence"] == 0.0
    tie = L.classify(docs(spark, [(1, "a b")]), {"first": "b", "second": "a"}).first()
    assert tie["category"] == "first" and tie["confidence"] == 0.5


def test_language_and_script(spark):
    rows = EDGE + [(6, "これは日本語です"), (7, "건강 기록"), (8, "医疗记录"), (9, "سجل طبي")]
    r = {x["id"]: x["language"] for x in L.detect_language(docs(spark, rows)).collect()}
    assert (r[1], r[5], r[6], r[7], r[8], r[9]) == ("English", "German", "Japanese", "Korean", "Chinese", "Arabic")
    assert r[2] is None and r[3] is None


def test_translation_both_ways_agree(spark):
    d = docs(spark, EDGE).withColumn("language", F.when(F.col("id") == 5, "German").otherwise("English"))
    g = spark.createDataFrame([(k, a, b) for k, m in LX.GLOSSARY.items() for a, b in m.items()], "lang string, src string, dst string")
    a = {x["id"]: x["translated_text"] for x in L.translate_if_needed(d, LX.GLOSSARY).collect()}
    b = {x["id"]: x["translated_text"] for x in L.translate_by_table(d, g).collect()}
    assert a == b and a[1] is None and a[5].startswith("the hund and the katze of")


def test_redaction_leaves_nothing_and_is_idempotent(spark):
    once = P.redact(docs(spark, EDGE)).withColumnRenamed("redacted_text", "text")
    twice = {x["id"]: x["redacted_text"] for x in P.redact(once).collect()}
    for x in once.collect():
        assert twice[x["id"]] == x["text"]
        for _, p, _ in RD.RULES:
            assert not x["text"] or not re.search(p, x["text"])
    t = {x["id"]: x["text"] for x in once.collect()}[1]
    assert all(k in t for k in ("[PHONE]", "[EMAIL]", "[MRN]", "[DOB]", "[NAME]")) and "Ada" not in t


def test_known_names_are_redacted(spark):
    names = spark.createDataFrame([("Ann Lee",), ("Ann Lee Park",)], "name string")
    d = docs(spark, [(1, "Ann Lee Park met Ann Lee and Joe Doe."), (2, "Nobody here."), (3, None)])
    r = {x["id"]: x["redacted_text"] for x in P.redact_names(d, names, r"[A-Z][a-z]+ [A-Z][a-z]+( [A-Z][a-z]+)?").collect()}
    assert r[1] == "[NAME] met [NAME] and Joe Doe." and r[2] == "Nobody here." and r[3] is None


def test_layout_of_markup_and_text(spark):
    html = "<title>T</title><h2>Results</h2><p>Patient Name: Ada<p>Plain <b>words</b><ul><li>one<li>two</ul><script>var a='<p>';</script>"
    rows = P.parse_layout(spark.createDataFrame([(1, html)], "id long, html string")).orderBy("ord").collect()
    assert [(x["kind"], x["text"]) for x in rows] == [("title", "T"), ("heading", "Results"), ("field", "Patient Name: Ada"),
                                                      ("paragraph", "Plain words"), ("list_item", "one"), ("list_item", "two")]
    kinds = {x["text"]: x["kind"] for x in P.layout_of_text(docs(spark, [(1, NOTE)])).collect()}
    assert kinds["VITALS:"] == "heading" and kinds["- BP 128/80"] == "list_item" and kinds["Provider: Dr. Bo Sample"] == "field"


def test_summary_picks_and_orders(spark):
    t = "Alpha beta. Heart heart rate heart. Gamma delta. Heart rate normal heart. Zeta."
    r = {x["id"]: x["summary"] for x in S.summarize(docs(spark, [(1, t), (2, ""), (3, None)]), n=2).collect()}
    assert r[1] == "Heart heart rate heart. Heart rate normal heart."
    assert r[2] is None or r[2] == ""


def test_long_recording_is_assembled_in_order(spark):
    n = 1000
    seg = spark.createDataFrame([(1, "a.wav", i, "user" if i % 2 else "assistant", f"w{i}") for i in range(n)],
                                "id long, file_name string, turn long, role string, text string").repartition(7)
    r = P.assemble_transcript(seg).first()
    assert r["transcript_text"].split("\n\n") == [f"{'user' if i % 2 else 'assistant'}: w{i}" for i in range(n)]
    assert r["speaker_count"] == 2 and r["n_segments"] == n and r["audio_duration_secs"] == 400.0


def test_soap_sections(spark):
    rows = [(1, 0, "user", "I feel pain and pain"), (1, 1, "assistant", "Your blood pressure results"), (1, 2, "assistant", "Hm."),
            (1, 3, "assistant", "We will schedule and start")]
    t = S.soap_notes(spark.createDataFrame(rows, "id long, turn long, role string, text string")).first()["consultation_notes"]
    assert t == "Subjective: I feel pain and pain\nObjective: Your blood pressure results\nAssessment: Hm.\nPlan: We will schedule and start"


@pytest.mark.parametrize("modality", ["TXT", "PDF", "AUDIO"])
def test_enrichment_keeps_every_file(spark, modality):
    at = F.lit("2024-01-01")
    if modality == "AUDIO":
        f = spark.createDataFrame([(1, "a.MP3", 0, "user", "Patient Name: Ada\nI feel worried"), (1, "a.MP3", 1, "assistant", "Please schedule"),
                                   (2, "b.wav", 0, "user", None)], "id long, file_name string, turn long, role string, text string")
        r = E.enrich_document(f, "AUDIO", E.CONSULTATION_VOCABULARY, at).collect()
        assert {x["audio_id"] for x in r} == {1, 2}
        return
    f = docs(spark, EDGE).withColumn("file_name", F.concat(F.lit("f"), "id"))
    f = f.withColumnRenamed("text", "html") if modality == "PDF" else f
    v = E.DOCUMENT_VOCABULARY if modality == "PDF" else E.TEXT_VOCABULARY
    r = {x[0]: x for x in E.enrich_document(f, modality, v, at).collect()}
    assert set(r) == {1, 2, 3, 4, 5}
    assert r[1]["extracted_fields"]["patient_name"] == "Ada Example" and len(r[1]["embedding"]) == 768
    assert r[1]["sentiment_dimensions"]["urgency"] == 1.0 and "Urgent review" in r[1]["key_insights"]
    assert r[5]["detected_language"] == "German" and r[5]["translated_text"] and r[1]["translated_text"] is None


def test_sentences_keep_their_digits(spark):
    """The position of a sentence must not be taken for characters to trim."""
    t = "Case 100. 0 urgent 0. Follow 11."
    r = S.key_insights(docs(spark, [(1, t)])).first()["key_insights"]
    assert r == "INSIGHTS: Case 100. 0 urgent 0. Follow 11.\nURGENT: 0 urgent 0.\nFOLLOW-UP: Follow 11."


def test_rules_skip_only_texts_without_a_match(spark):
    """As the rules one after the other over every text, also where one rule makes or breaks what another looks for."""
    texts = [None, "", "plain", "a@b.co", "x.y+z@mail-1.example.org 10.0.0.1", 'token = "a@b.co"', 'Secret:"x" and 1234567812345678', "1234-5678-1234-5678", "1234 5678 1234 5678",
             "123-45-6789 (555) 123-4567 555-123-4567", "MRN-12345678-AB", "DOB: 1/2/1980 date of birth: 1980-02-01", "Patient Name: A B\nProvider: C", "Physician: D", "Patient: E-F",
             "Address: 1 Road\naddress: 2", "1.2.3", "é1234567812345678", "[SECRET] api_key:\"\""]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    plain = F.col("text")
    for _, pattern, placeholder in RD.RULES:
        plain = F.regexp_replace(plain, pattern, placeholder)
    left = functools.reduce(lambda a, b: a | b, [F.col("text").rlike(p) for p in RD.PATTERNS])
    for r in rows.select("text", plain.alias("want"), RD.redact(F.col("text")).alias("got"), left.alias("left"), RD.left_over(F.col("text")).alias("left_got")).collect():
        assert r["got"] == r["want"] and r["left_got"] == r["left"], r["text"]
    assert RD.HELD[RD.PATTERNS[1]] == ["@"] and set(RD.HELD) == set(RD.PATTERNS)


def test_texts_are_enriched_in_many_tasks(spark):
    """Little data, long work: the exchange by file is not coalesced."""
    files = spark.range(50).select("id", F.lit("f").alias("file_name"), F.lit("One word. Two words.").alias("text"))
    rows = E.enrich_document(files, "TXT", E.TEXT_VOCABULARY, F.current_timestamp(), embeddings=False).select("txt_id", "redacted_text")
    assert rows.rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism
