"""SQL text shared by the reference queries that DuckDB runs next to the Spark queries."""

from __future__ import annotations


def values(rows, cols: str, name: str) -> str:
    """A CTE holding fixed rows."""
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return repr(v)

    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"{name}({cols}) AS (VALUES {body})"


def with_(*ctes: str, q: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + q


CLAIMS = """claims AS (
  SELECT *, CAST(allowed_amount * 0.8 AS DECIMAL(18,2)) AS paid_amount,
         CAST(allowed_amount - CAST(allowed_amount * 0.8 AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS patient_responsibility
  FROM (SELECT l_orderkey*10 + l_linenumber AS claim_id, o_custkey AS patient_id, l_suppkey AS provider_id,
    CAST(l_shipdate AS DATE) AS service_date, CAST(o_orderdate AS DATE) AS claim_date,
    'PR-' || l_linenumber AS procedure_code, 'Procedure ' || l_linenumber AS procedure_desc,
    p_brand AS diagnosis_code, p_type AS diagnosis_desc,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS billed_amount,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS allowed_amount,
    CASE WHEN l_returnflag = 'R' THEN 'Denied' WHEN o_orderstatus = 'F' THEN 'Approved'
         WHEN o_orderstatus = 'P' THEN 'Pending' ELSE 'Under Review' END AS claim_status,
    CASE WHEN l_returnflag = 'R' AND o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS denial_reason
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey))"""

GEO = "geo AS (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey)"

PATIENTS = """patients AS (
  SELECT c_custkey AS patient_id, split_part(c_name,'#',1) AS first_name, split_part(c_name,'#',2) AS last_name,
    CAST(DATE '1940-01-01' + CAST(c_custkey % 20000 AS INTEGER) AS DATE) AS date_of_birth,
    CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender, n_name AS city, r_name AS state,
    lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS zip_code, c_mktsegment AS insurance_plan,
    c_custkey % 10 AS primary_provider_id,
    CAST(DATE '2020-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DATE) AS registered_date
  FROM customer JOIN geo ON c_nationkey = n_nationkey)"""

PROVIDERS = """providers AS (
  SELECT s_suppkey AS provider_id, s_name AS provider_name, n_name AS specialty, r_name AS facility_name,
    n_name AS provider_city, r_name AS provider_state, lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS npi_number,
    s_acctbal >= 0 AS is_active
  FROM supplier JOIN geo ON s_nationkey = n_nationkey)"""

APPOINTMENTS = """appointments AS (
  SELECT event_id AS appointment_id, user_id AS patient_id, event_id % 10 AS provider_id, ts AS appointment_date,
    event_type AS appointment_type, json_extract_string(props, '$.k') AS visit_reason,
    CAST(value AS DECIMAL(10,2)) AS duration_minutes,
    CASE event_type WHEN 'signup' THEN 'Scheduled' WHEN 'error' THEN 'No-Show' ELSE 'Completed' END AS status,
    event_type = 'click' AS has_audio_recording, event_type = 'purchase' AS has_document
  FROM events)"""

STAR = [GEO, CLAIMS, PATIENTS, PROVIDERS, APPOINTMENTS]


def star(q: str, *extra: str) -> str:
    return with_(*STAR, *extra, q=q)


def rnd(expr: str, digits: int) -> str:
    """Half-up rounding by double arithmetic, as the library defines it."""
    p = f"CAST(1e{digits} AS DOUBLE)"
    return f"(floor(({expr}) * {p} + CAST(0.5 AS DOUBLE)) / {p})"


def money(expr: str) -> str:
    return f"round(CAST(sum({expr}) AS DOUBLE), 2)"


def mean(expr: str) -> str:
    return rnd(f"CAST(sum({expr}) AS DOUBLE) / count({expr})", 4)
