"""Reports, questions over claims and the metric layer, bound to the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinisift.plans import metrics as M
from clinisift.plans import reports as R
from clinisift.sources import bindings as B

from .sql_parts import mean, money, rnd, star

QUERIES, SQL = {}, {}


def add(name, fn, sql=None):
    QUERIES[name] = fn
    if sql:
        SQL[name] = sql


add("billed_by_specialty",
    lambda s, d: R.billed_by_specialty(B.claims(s, d), B.providers(s, d)),
    star(f"""SELECT specialty, count(*) AS claim_count, {money('billed_amount')} AS total_billed,
      {mean('paid_amount')} AS avg_paid FROM claims JOIN providers USING (provider_id) GROUP BY specialty"""))

add("claims_by_status", lambda s, d: R.claims_by_status(B.claims(s, d)),
    star(f"SELECT claim_status, count(*) AS cnt, {money('billed_amount')} AS total FROM claims GROUP BY 1"))

add("patients_most_appointments",
    lambda s, d: R.patients_most_appointments(B.appointments(s, d), B.patients(s, d)),
    star(f"""SELECT patient_id, first_name || ' ' || last_name AS patient, count(*) AS appointments,
      {money('duration_minutes')} AS total_minutes FROM appointments JOIN patients USING (patient_id)
      WHERE status = 'Completed' GROUP BY 1, 2"""))

add("insurance_distribution", lambda s, d: R.insurance_distribution(B.patients(s, d)),
    star("SELECT insurance_plan, count(*) AS patient_count FROM patients GROUP BY 1"))

add("visit_type_stats", lambda s, d: R.visit_type_stats(B.appointments(s, d)),
    star(f"""SELECT appointment_type, count(*) AS cnt, {mean('duration_minutes')} AS avg_duration
      FROM appointments WHERE status = 'Completed' GROUP BY 1"""))


def _money_cols(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so both engines hand over the same Python type."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal"
                       else F.col(f.name) for f in df.schema.fields])


add("claims_summary",
    lambda s, d: _money_cols(R.claims_summary(B.claims(s, d, True), B.patients(s, d), B.providers(s, d))),
    star("""SELECT claim_id, service_date, claim_date, procedure_code, procedure_desc, diagnosis_code, diagnosis_desc,
      CAST(billed_amount AS DOUBLE) AS billed_amount, CAST(allowed_amount AS DOUBLE) AS allowed_amount,
      CAST(paid_amount AS DOUBLE) AS paid_amount, CAST(patient_responsibility AS DOUBLE) AS patient_responsibility,
      claim_status, denial_reason, first_name || ' ' || last_name AS patient_name, date_of_birth AS patient_dob,
      gender AS patient_gender, city AS patient_city, insurance_plan, provider_name,
      specialty AS provider_specialty, facility_name
      FROM claims JOIN patients USING (patient_id) JOIN providers USING (provider_id)"""))

# ---------------------------------------------------------------- questions

add("top_providers_by_billed", lambda s, d: R.top_providers_by_billed(B.claims(s, d), B.providers(s, d)),
    star(f"""SELECT provider_id, provider_name, count(*) AS claim_count, {money('billed_amount')} AS total_billed
      FROM claims JOIN providers USING (provider_id) GROUP BY 1, 2 ORDER BY total_billed DESC, provider_id LIMIT 10"""))

add("denied_with_reasons", lambda s, d: R.denied_with_reasons(B.claims(s, d)),
    star(f"""SELECT denial_reason, count(*) AS denied_count, {money('billed_amount')} AS denied_amount
      FROM claims WHERE claim_status = 'Denied' GROUP BY 1"""))

add("plan_specialty_patients",
    lambda s, d: R.plan_specialty_patients(B.appointments(s, d), B.patients(s, d), B.providers(s, d),
                                           "BUILDING", "NATION_15"),
    star("""SELECT patient_id, first_name || ' ' || last_name AS patient, insurance_plan FROM patients
      WHERE insurance_plan = 'BUILDING' AND patient_id IN (SELECT a.patient_id FROM appointments a
        JOIN providers p ON a.provider_id = p.provider_id WHERE specialty = 'NATION_15')"""))

add("pending_vs_approved", lambda s, d: R.pending_vs_approved(B.claims(s, d)),
    star("""SELECT count(*) FILTER (claim_status='Pending') AS pending_count,
      round(CAST(sum(billed_amount) FILTER (claim_status='Pending') AS DOUBLE),2) AS pending_total,
      count(*) FILTER (claim_status='Approved') AS approved_count,
      round(CAST(sum(billed_amount) FILTER (claim_status='Approved') AS DOUBLE),2) AS approved_total FROM claims"""))

add("approval_rate_by_provider", lambda s, d: R.approval_rate_by_provider(B.claims(s, d), B.providers(s, d)),
    star(f"""SELECT provider_id, provider_name, count(*) AS claim_count,
      count(*) FILTER (claim_status='Approved') AS approved_count,
      {rnd("count(*) FILTER (claim_status='Approved') / count(*)", 6)} AS approval_rate
      FROM claims JOIN providers USING (provider_id) GROUP BY 1, 2 HAVING count(*) >= 5"""))

add("avg_claim_by_plan", lambda s, d: R.avg_claim_by_plan(B.claims(s, d), B.patients(s, d)),
    star(f"""SELECT insurance_plan, count(*) AS claim_count, {mean('billed_amount')} AS avg_billed
      FROM claims JOIN patients USING (patient_id) GROUP BY 1"""))

add("avg_claim_by_specialty",
    lambda s, d: M.semantic_query(B.entities(s, d), ["specialty"], ["avg_billed_amount", "claim_count"]),
    star(f"""SELECT specialty, {mean('billed_amount')} AS avg_billed_amount, count(claim_id) AS claim_count
      FROM claims LEFT JOIN providers USING (provider_id) GROUP BY 1"""))

add("common_diagnoses", lambda s, d: R.common_diagnoses(B.claims(s, d, True)),
    star("""SELECT diagnosis_desc, count(*) AS claim_count FROM claims GROUP BY 1
      ORDER BY claim_count DESC, diagnosis_desc LIMIT 10"""))

add("appointment_trends", lambda s, d: R.appointment_trends(B.appointments(s, d)),
    star(f"""SELECT *, cnt - lag(cnt) OVER (PARTITION BY appointment_type ORDER BY day) AS change FROM (
      SELECT appointment_type, CAST(appointment_date AS DATE) AS day, count(*) AS cnt,
        {money('duration_minutes')} AS minutes FROM appointments GROUP BY 1, 2)"""))

# ---------------------------------------------------------------- metric layer

ENTITY_SQL = " UNION ALL ".join(
    f"""SELECT '{e}' AS entity, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys,
    CAST(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_repeated_keys
    FROM (SELECT {k}, count(*) AS n FROM {e} GROUP BY 1)""" for e, k in M.KEYS.items())

add("entity",
    lambda s, d: reduce(DataFrame.unionByName, [M.entity_report(t, e) for e, t in B.entities(s, d).items()]),
    star(ENTITY_SQL))


def _links(s, d):
    """Rows and linked rows along each of the five links."""
    t = B.entities(s, d)
    out = []
    for (a, b) in M.LINKS:
        j = M.join_entities(t, a, b)
        out.append(j.agg(F.lit(f"{a}->{b}").alias("link"), F.count(F.lit(1)).alias("n_rows"),
                         F.count(f"{b}_{M.KEYS[b]}").alias("n_linked")))
    return reduce(DataFrame.unionByName, out)


add("join_entities", _links, star(" UNION ALL ".join(
    f"""SELECT '{a}->{b}' AS link, count(*) AS n_rows, count(y.{M.KEYS[b]}) AS n_linked
    FROM {a} x LEFT JOIN {b} y ON x.{fk} = y.{M.KEYS[b]}""" for (a, b), fk in M.LINKS.items())))

add("dimension_frame",
    lambda s, d: M.dimension_frame(B.entities(s, d), "providers", M._DIMS["providers"]),
    star("SELECT provider_id, " + ", ".join(M._DIMS["providers"]) + " FROM providers"))


def _metric_sql(m):
    e, fn, c = M.METRICS[m]
    return {"sum": money(c), "avg": mean(c), "count": f"count({c})"}[fn] + f" AS {m}"


def _all_metrics(s, d):
    """All 14 metrics over everything: one row."""
    t = B.entities(s, d)
    facts = list(dict.fromkeys(e for e, _, _ in M.METRICS.values()))
    parts = [M.semantic_query(t, [], [m for m, (e, _, _) in M.METRICS.items() if e == f]) for f in facts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).agg(
        *[F.max(m).alias(m) for m in M.METRICS])


add("fact_metrics", _all_metrics, star("SELECT * FROM " + ", ".join(
    "(SELECT " + ", ".join(_metric_sql(m) for m, (x, _, _) in M.METRICS.items() if x == e) + f" FROM {e})"
    for e in ["claims", "appointments", "patients", "providers"])))

CLAIM_STAR = """claims c LEFT JOIN patients p ON c.patient_id = p.patient_id
  LEFT JOIN providers r ON c.provider_id = r.provider_id"""

add("semantic_query",
    lambda s, d: M.semantic_query(B.entities(s, d), ["insurance_plan", "specialty", "claim_status"],
                                  ["total_billed_amount", "avg_paid_amount", "claim_count"]),
    star(f"""SELECT insurance_plan, specialty, claim_status, {money('billed_amount')} AS total_billed_amount,
      {mean('paid_amount')} AS avg_paid_amount, count(claim_id) AS claim_count FROM {CLAIM_STAR} GROUP BY 1, 2, 3"""))

add("semantic_query_filtered",
    lambda s, d: M.semantic_query(B.entities(s, d), ["specialty"], ["total_allowed_amount", "avg_patient_responsibility"],
                                  filters={"claim_status": ["Approved", "Denied"], "gender": ["Female"]},
                                  order=[F.desc("total_allowed_amount"), "specialty"], limit=5),
    star(f"""SELECT specialty, {money('allowed_amount')} AS total_allowed_amount,
      {mean('patient_responsibility')} AS avg_patient_responsibility FROM {CLAIM_STAR}
      WHERE claim_status IN ('Approved','Denied') AND gender = 'Female' GROUP BY 1
      ORDER BY total_allowed_amount DESC, specialty LIMIT 5"""))

add("semantic_query_appointments",
    lambda s, d: M.semantic_query(B.entities(s, d), ["appointment_type", "city", "has_document"],
                                  ["appointment_count", "avg_duration_minutes", "total_duration_minutes"]),
    star(f"""SELECT appointment_type, city, has_document, count(appointment_id) AS appointment_count,
      {mean('duration_minutes')} AS avg_duration_minutes, {money('duration_minutes')} AS total_duration_minutes
      FROM appointments a LEFT JOIN patients p ON a.patient_id = p.patient_id GROUP BY 1, 2, 3"""))

add("semantic_query_patients",
    lambda s, d: M.semantic_query(B.entities(s, d), ["gender", "specialty"], ["patient_count"]),
    star("""SELECT gender, specialty, count(patient_id) AS patient_count FROM patients p
      LEFT JOIN providers r ON p.primary_provider_id = r.provider_id GROUP BY 1, 2"""))

add("semantic_query_providers",
    lambda s, d: M.semantic_query(B.entities(s, d), ["provider_state", "is_active"], ["provider_count"]),
    star("SELECT provider_state, is_active, count(provider_id) AS provider_count FROM providers GROUP BY 1, 2"))

add("semantic_query_diagnosis",
    lambda s, d: M.semantic_query(B.entities(s, d, True), ["diagnosis_code", "diagnosis_desc", "state"],
                                  ["claim_count", "total_patient_responsibility"]),
    star(f"""SELECT diagnosis_code, diagnosis_desc, state, count(claim_id) AS claim_count,
      {money('patient_responsibility')} AS total_patient_responsibility FROM {CLAIM_STAR} GROUP BY 1, 2, 3"""))

MULTI = ["claim_count", "total_billed_amount", "appointment_count", "total_duration_minutes"]
add("semantic_query_multi",
    lambda s, d: M.semantic_query_multi(B.entities(s, d), ["specialty", "insurance_plan"], MULTI),
    star(f"""SELECT coalesce(x.specialty, y.specialty) AS specialty, coalesce(x.insurance_plan, y.insurance_plan) AS insurance_plan,
      claim_count, total_billed_amount, appointment_count, total_duration_minutes FROM
      (SELECT specialty, insurance_plan, count(claim_id) AS claim_count, {money('billed_amount')} AS total_billed_amount
       FROM {CLAIM_STAR} GROUP BY 1, 2) x FULL OUTER JOIN
      (SELECT specialty, insurance_plan, count(appointment_id) AS appointment_count, {money('duration_minutes')} AS total_duration_minutes
       FROM appointments a LEFT JOIN patients p ON a.patient_id = p.patient_id
       LEFT JOIN providers r ON a.provider_id = r.provider_id GROUP BY 1, 2) y
      ON x.specialty IS NOT DISTINCT FROM y.specialty AND x.insurance_plan IS NOT DISTINCT FROM y.insurance_plan"""))

add("semantic_query_via",
    lambda s, d: M.semantic_query(B.entities(s, d), ["specialty"], ["claim_count", "total_billed_amount"], via="patients"),
    star(f"""SELECT specialty, count(claim_id) AS claim_count, {money('billed_amount')} AS total_billed_amount
      FROM claims c LEFT JOIN patients p ON c.patient_id = p.patient_id
      LEFT JOIN providers r ON p.primary_provider_id = r.provider_id GROUP BY 1"""))


def _profile_sql():
    parts = []
    for e, ds in M._DIMS.items():
        for x in ds:
            col = f"CAST({x} AS VARCHAR)"
            parts.append(f"SELECT '{e}' AS entity, '{x}' AS dimension, {col} AS value, count(*) AS n FROM {e} GROUP BY 3")
    return " UNION ALL ".join(parts)


add("profile_dimensions", lambda s, d: M.profile_dimensions(B.entities(s, d, True)),
    star("""SELECT c.entity, c.dimension, CAST(sum(n) AS BIGINT) AS n_rows,
      CAST(coalesce(sum(n) FILTER (value IS NULL), 0) AS BIGINT) AS n_null, count(value) AS n_distinct,
      any_value(t.top_values) AS top_values
      FROM counted c LEFT JOIN (SELECT dimension, string_agg(value, '|' ORDER BY rk) AS top_values FROM (
        SELECT dimension, value, row_number() OVER (PARTITION BY dimension ORDER BY n DESC, value) AS rk
        FROM counted WHERE value IS NOT NULL) WHERE rk <= 3 GROUP BY 1) t ON c.dimension = t.dimension
      GROUP BY 1, 2""", f"counted AS ({_profile_sql()})"))
