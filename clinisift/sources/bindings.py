"""Binds the given Parquet tables to the entities the operators work on.

Claims come from line items and orders, patients from customers, providers from
suppliers, appointments from events; documents, pages and conversations are the text
files, laid-out documents and recordings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Conditions named in the header line of the bound documents.
CONDITIONS = ["hypertension", "diabetes", "asthma", "migraine", "fracture"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_TEXT_KEYS = {"documents": ["doc_id"], "pages": ["page_id"], "conversations": ["conv_id", "turn"]}


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of texts, spread over all cores.

    A few files of one row group each would keep whole texts in a few tasks; only then are
    rows moved. A table with at least one split per core is read as it is.
    """
    df = table(spark, sf_dir, name)
    cores = spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *_TEXT_KEYS[name])


def claims(spark: SparkSession, sf_dir: str, diagnosis: bool = False) -> DataFrame:
    """One row per line item. ``diagnosis`` adds the part join only where it is needed."""
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    df = li.join(o, li.l_orderkey == o.o_orderkey)
    billed = F.col("l_extendedprice").cast("decimal(18,2)")
    allowed = (billed * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(18,2)")
    paid = (allowed * F.lit("0.8").cast("decimal(2,1)")).cast("decimal(18,2)")
    denied = F.col("l_returnflag") == "R"
    cols = [
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("claim_id"),
        F.col("o_custkey").alias("patient_id"),
        F.col("l_suppkey").alias("provider_id"),
        F.col("l_shipdate").cast("date").alias("service_date"),
        F.col("o_orderdate").cast("date").alias("claim_date"),
        F.concat(F.lit("PR-"), F.col("l_linenumber")).alias("procedure_code"),
        F.concat(F.lit("Procedure "), F.col("l_linenumber")).alias("procedure_desc"),
        billed.alias("billed_amount"),
        allowed.alias("allowed_amount"),
        paid.alias("paid_amount"),
        (allowed - paid).cast("decimal(18,2)").alias("patient_responsibility"),
        F.when(denied, "Denied")
        .when(F.col("o_orderstatus") == "F", "Approved")
        .when(F.col("o_orderstatus") == "P", "Pending")
        .otherwise("Under Review")
        .alias("claim_status"),
        F.when(denied & (F.col("o_orderpriority") != "4-NOT SPECIFIED"), F.col("o_orderpriority"))
        .alias("denial_reason"),
    ]
    if diagnosis:
        p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
        df = df.join(p, df.l_partkey == p.p_partkey)
        cols[7:7] = [F.col("p_brand").alias("diagnosis_code"), F.col("p_type").alias("diagnosis_desc")]
    return df.select(*cols)


def _geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, g = table(spark, sf_dir, "customer"), _geography(spark, sf_dir)
    k = F.col("c_custkey")
    return c.join(g, c.c_nationkey == g.n_nationkey).select(
        k.alias("patient_id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.date_add(F.lit("1940-01-01").cast("date"), (k % 20000).cast("int")).alias("date_of_birth"),
        F.when(k % 2 == 0, "Female").otherwise("Male").alias("gender"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.lpad((k % 100000).cast("string"), 5, "0").alias("zip_code"),
        F.col("c_mktsegment").alias("insurance_plan"),
        (k % 10).alias("primary_provider_id"),
        F.date_add(F.lit("2020-01-01").cast("date"), (k % 365).cast("int")).alias("registered_date"),
    )


def providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, g = table(spark, sf_dir, "supplier"), _geography(spark, sf_dir)
    return s.join(g, s.s_nationkey == g.n_nationkey).select(
        F.col("s_suppkey").alias("provider_id"),
        F.col("s_name").alias("provider_name"),
        F.col("n_name").alias("specialty"),
        F.col("r_name").alias("facility_name"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.lpad(F.col("s_suppkey").cast("string"), 10, "0").alias("npi_number"),
        (F.col("s_acctbal") >= 0).alias("is_active"),
    )


def appointments(spark: SparkSession, sf_dir: str) -> DataFrame:
    et = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("appointment_id"),
        F.col("user_id").alias("patient_id"),
        (F.col("event_id") % 10).alias("provider_id"),
        F.col("ts").alias("appointment_date"),
        et.alias("appointment_type"),
        F.get_json_object("props", "$.k").alias("visit_reason"),
        F.col("value").cast("decimal(10,2)").alias("duration_minutes"),
        F.when(et == "signup", "Scheduled").when(et == "error", "No-Show").otherwise("Completed")
        .alias("status"),
        (et == "click").alias("has_audio_recording"),
        (et == "purchase").alias("has_document"),
    )


def entities(spark: SparkSession, sf_dir: str, diagnosis: bool = False) -> dict[str, DataFrame]:
    return {
        "patients": patients(spark, sf_dir),
        "providers": providers(spark, sf_dir),
        "claims": claims(spark, sf_dir, diagnosis),
        "appointments": appointments(spark, sf_dir),
    }


# ---------------------------------------------------------------- files


def _log_rows(ids: DataFrame, folder: str, name) -> DataFrame:
    return ids.select(
        name.alias("file_name"),
        F.concat(F.lit(folder + "/"), name).alias("file_path"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 60).cast("timestamp_ntz").alias("event_time"),
    )


def audio_name(col):
    """Two of five recordings are MP3 files, the others wave files."""
    return F.concat(F.lit("conv_"), col, F.when(col % 5 < 2, ".MP3").otherwise(".wav"))


def landed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of all files the three tables stand for: (file_name, file_path, event_time)."""
    c = F.col("id")
    txt = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    pdf = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"))
    aud = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("id")).distinct()
    return (
        _log_rows(txt, "txt", F.concat(F.lit("doc_"), c, F.lit(".txt")))
        .unionByName(_log_rows(pdf, "pdfs", F.concat(F.lit("page_"), c, F.lit(".pdf"))))
        .unionByName(_log_rows(aud, "audio", audio_name(c)))
    )


def _header(col, patient_label: str = "Patient Name"):
    """Header lines naming patient, provider and diagnosis of a bound document."""
    return F.concat(
        F.lit(patient_label + ": Customer#"), F.lpad((col % 150).cast("string"), 9, "0"),
        F.lit("\nProvider: Supplier#"), F.lpad((col % 10).cast("string"), 9, "0"),
        F.lit("\nDiagnosis: "),
        F.element_at(F.array(*[F.lit(x) for x in CONDITIONS]), (col % 5 + 1).cast("int")),
        F.lit("\n"),
    )


def txt_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text files with their header lines: (id, file_name, text)."""
    d = F.col("doc_id")
    return texts(spark, sf_dir, "documents").select(
        d.alias("id"), F.concat(F.lit("doc_"), d, F.lit(".txt")).alias("file_name"),
        F.concat(_header(d), F.col("text")).alias("text"),
    )


def pdf_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Laid-out documents, header as paragraphs before the page markup: (id, file_name, html)."""
    d = F.col("page_id")
    head = F.concat(F.lit("<p>"), F.regexp_replace(_header(d), "\n", "</p><p>"), F.lit("</p>"))
    return texts(spark, sf_dir, "pages").select(
        d.alias("id"), F.concat(F.lit("page_"), d, F.lit(".pdf")).alias("file_name"),
        F.concat(head, F.col("html")).alias("html"),
    )


def audio_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timed segments of recordings: (id, file_name, turn, role, text)."""
    c = F.col("conv_id")
    head = F.concat(F.lit("Patient Name: Customer#"), F.lpad((c % 150).cast("string"), 9, "0"),
                    F.lit("\nChief Complaint: "),
                    F.element_at(F.array(*[F.lit(x) for x in CONDITIONS]), (c % 5 + 1).cast("int")),
                    F.lit("\n"))
    return texts(spark, sf_dir, "conversations").select(
        c.alias("id"), audio_name(c).alias("file_name"), "turn", "role",
        F.when(F.col("turn") == 0, F.concat(head, F.col("text"))).otherwise(F.col("text")).alias("text"),
    )
