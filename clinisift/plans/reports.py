"""Relational reports over claims, appointments, patients and providers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import rounded


def billed_by_specialty(claims: DataFrame, providers: DataFrame) -> DataFrame:
    """Claims, total billed and mean paid per specialty, largest total first."""
    per_provider = claims.groupBy("provider_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("billed_amount").alias("billed"),
        F.sum("paid_amount").alias("paid"), F.count("paid_amount").alias("n_paid"))
    return (
        per_provider.join(providers.select("provider_id", "specialty"), "provider_id")
        .groupBy("specialty")
        .agg(F.sum("n").alias("claim_count"),
             F.round(F.sum("billed").cast("double"), 2).alias("total_billed"),
             rounded(F.sum("paid").cast("double") / F.sum("n_paid"), 4).alias("avg_paid"))
        .orderBy(F.desc("total_billed"), "specialty")
    )


def claims_by_status(claims: DataFrame) -> DataFrame:
    return claims.groupBy("claim_status").agg(
        F.count(F.lit(1)).alias("cnt"), F.round(F.sum("billed_amount").cast("double"), 2).alias("total"))


def patients_most_appointments(appointments: DataFrame, patients: DataFrame) -> DataFrame:
    """Completed visits and minutes per patient; grouped by id, so homonyms stay apart."""
    per = appointments.filter(F.col("status") == "Completed").groupBy("patient_id").agg(
        F.count(F.lit(1)).alias("appointments"),
        F.round(F.sum("duration_minutes").cast("double"), 2).alias("total_minutes"))
    name = F.concat("first_name", F.lit(" "), "last_name").alias("patient")
    return (
        per.join(patients.select("patient_id", name), "patient_id")
        .select("patient_id", "patient", "appointments", "total_minutes")
        .orderBy(F.desc("appointments"), "patient_id")
    )


def insurance_distribution(patients: DataFrame) -> DataFrame:
    return (patients.groupBy("insurance_plan").agg(F.count(F.lit(1)).alias("patient_count"))
            .orderBy(F.desc("patient_count"), "insurance_plan"))


def visit_type_stats(appointments: DataFrame) -> DataFrame:
    d = F.col("duration_minutes")
    return appointments.filter(F.col("status") == "Completed").groupBy("appointment_type").agg(
        F.count(F.lit(1)).alias("cnt"),
        rounded(F.sum(d).cast("double") / F.count(d), 4).alias("avg_duration"))


def claims_summary(claims: DataFrame, patients: DataFrame, providers: DataFrame) -> DataFrame:
    """Claims with patient and provider attributes, 21 columns."""
    p = patients.select(
        "patient_id", F.concat("first_name", F.lit(" "), "last_name").alias("patient_name"),
        F.col("date_of_birth").alias("patient_dob"), F.col("gender").alias("patient_gender"),
        F.col("city").alias("patient_city"), "insurance_plan")
    pr = providers.select("provider_id", "provider_name",
                          F.col("specialty").alias("provider_specialty"), "facility_name")
    return claims.join(p, "patient_id").join(pr, "provider_id").select(
        "claim_id", "service_date", "claim_date", "procedure_code", "procedure_desc", "diagnosis_code",
        "diagnosis_desc", "billed_amount", "allowed_amount", "paid_amount", "patient_responsibility",
        "claim_status", "denial_reason", "patient_name", "patient_dob", "patient_gender", "patient_city",
        "insurance_plan", "provider_name", "provider_specialty", "facility_name")


# ------------------------------------------------------------ questions over claims


def top_providers_by_billed(claims: DataFrame, providers: DataFrame, k: int = 10) -> DataFrame:
    per = claims.groupBy("provider_id").agg(F.sum("billed_amount").alias("_t"), F.count(F.lit(1)).alias("claim_count"))
    return (
        per.join(providers.select("provider_id", "provider_name"), "provider_id")
        .select("provider_id", "provider_name", "claim_count", F.round(F.col("_t").cast("double"), 2).alias("total_billed"))
        .orderBy(F.desc("total_billed"), "provider_id").limit(k)
    )


def denied_with_reasons(claims: DataFrame) -> DataFrame:
    """Denied claims per reason; claims without a reason keep their own NULL row."""
    return claims.filter(F.col("claim_status") == "Denied").groupBy("denial_reason").agg(
        F.count(F.lit(1)).alias("denied_count"),
        F.round(F.sum("billed_amount").cast("double"), 2).alias("denied_amount"))


def plan_specialty_patients(appointments: DataFrame, patients: DataFrame, providers: DataFrame,
                            plan: str, specialty: str) -> DataFrame:
    """Patients on a plan who have a visit in a specialty, each once."""
    visits = (
        appointments.select("patient_id", "provider_id").distinct()
        .join(providers.filter(F.col("specialty") == specialty), "provider_id", "left_semi")
    )
    return (
        patients.filter(F.col("insurance_plan") == plan).join(visits, "patient_id", "left_semi")
        .select("patient_id", F.concat("first_name", F.lit(" "), "last_name").alias("patient"), "insurance_plan")
    )


def pending_vs_approved(claims: DataFrame) -> DataFrame:
    """Count and total of two statuses side by side, one pass."""
    s, b = F.col("claim_status"), F.col("billed_amount")
    aggs = []
    for st in ("Pending", "Approved"):
        aggs += [F.count(F.when(s == st, 1)).alias(f"{st.lower()}_count"),
                 F.round(F.sum(F.when(s == st, b)).cast("double"), 2).alias(f"{st.lower()}_total")]
    return claims.filter(s.isin("Pending", "Approved")).agg(*aggs)


def approval_rate_by_provider(claims: DataFrame, providers: DataFrame, min_claims: int = 5) -> DataFrame:
    per = (
        claims.groupBy("provider_id")
        .agg(F.count(F.lit(1)).alias("claim_count"),
             F.count(F.when(F.col("claim_status") == "Approved", 1)).alias("approved_count"))
        .filter(F.col("claim_count") >= min_claims)
    )
    return (
        per.join(providers.select("provider_id", "provider_name"), "provider_id")
        .select("provider_id", "provider_name", "claim_count", "approved_count",
                rounded(F.col("approved_count") / F.col("claim_count"), 6).alias("approval_rate"))
        .orderBy(F.desc("approval_rate"), "provider_id")
    )


def avg_claim_by_plan(claims: DataFrame, patients: DataFrame) -> DataFrame:
    per = claims.groupBy("patient_id").agg(F.sum("billed_amount").alias("s"), F.count("billed_amount").alias("n"))
    return per.join(patients.select("patient_id", "insurance_plan"), "patient_id").groupBy("insurance_plan").agg(
        F.sum("n").alias("claim_count"),
        rounded(F.sum("s").cast("double") / F.sum("n"), 4).alias("avg_billed"))


def common_diagnoses(claims: DataFrame, k: int = 10) -> DataFrame:
    return (claims.groupBy("diagnosis_desc").agg(F.count(F.lit(1)).alias("claim_count"))
            .orderBy(F.desc("claim_count"), "diagnosis_desc").limit(k))


def appointment_trends(appointments: DataFrame) -> DataFrame:
    """Visits per day and type with the change from the day before. The window runs over
    the daily counts of one type, at most one row per calendar day."""
    from pyspark.sql import Window as W

    day = F.col("appointment_date").cast("date").alias("day")
    per = appointments.groupBy("appointment_type", day).agg(
        F.count(F.lit(1)).alias("cnt"), F.round(F.sum("duration_minutes").cast("double"), 2).alias("minutes"))
    w = W.partitionBy("appointment_type").orderBy("day")
    return per.withColumn("change", F.col("cnt") - F.lag("cnt").over(w))
