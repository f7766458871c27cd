"""Metric layer: named dimensions and metrics over four entities and five many-to-one links.

Every link is many to one, so no join can fan out. Dimensions small enough to broadcast are
joined where the fact is read; before larger ones a fact is reduced to its keys, so that a
provider with a third of all claims becomes one row on the map side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import rounded
from ..session import fits_broadcast, materialize

KEYS = {"patients": "patient_id", "providers": "provider_id",
        "claims": "claim_id", "appointments": "appointment_id"}

# (from, to) -> foreign key column of ``from``
LINKS = {
    ("patients", "providers"): "primary_provider_id",
    ("claims", "patients"): "patient_id",
    ("claims", "providers"): "provider_id",
    ("appointments", "patients"): "patient_id",
    ("appointments", "providers"): "provider_id",
}

_DIMS = {
    "patients": ["first_name", "last_name", "date_of_birth", "gender", "city", "state",
                 "zip_code", "insurance_plan", "registered_date"],
    "providers": ["provider_name", "specialty", "facility_name", "provider_city",
                  "provider_state", "npi_number", "is_active"],
    "claims": ["service_date", "claim_date", "procedure_code", "procedure_desc",
               "diagnosis_code", "diagnosis_desc", "claim_status", "denial_reason"],
    "appointments": ["appointment_date", "appointment_type", "visit_reason", "status",
                     "has_audio_recording", "has_document"],
}
_RENAMED = {"provider_city": "city", "provider_state": "state"}
# dimension name -> (entity, column)
DIMENSIONS = {d: (e, _RENAMED.get(d, d)) for e, ds in _DIMS.items() for d in ds}

# metric name -> (entity, function, column)
METRICS = {
    "total_billed_amount": ("claims", "sum", "billed_amount"),
    "avg_billed_amount": ("claims", "avg", "billed_amount"),
    "total_allowed_amount": ("claims", "sum", "allowed_amount"),
    "avg_allowed_amount": ("claims", "avg", "allowed_amount"),
    "total_paid_amount": ("claims", "sum", "paid_amount"),
    "avg_paid_amount": ("claims", "avg", "paid_amount"),
    "total_patient_responsibility": ("claims", "sum", "patient_responsibility"),
    "avg_patient_responsibility": ("claims", "avg", "patient_responsibility"),
    "claim_count": ("claims", "count", "claim_id"),
    "total_duration_minutes": ("appointments", "sum", "duration_minutes"),
    "avg_duration_minutes": ("appointments", "avg", "duration_minutes"),
    "appointment_count": ("appointments", "count", "appointment_id"),
    "patient_count": ("patients", "count", "patient_id"),
    "provider_count": ("providers", "count", "provider_id"),
}


def entity_report(df: DataFrame, name: str) -> DataFrame:
    """Rows, distinct keys and repeated keys of an entity: the proof needed before it
    may be the *one* side of a link."""
    per_key = df.groupBy(KEYS[name]).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.lit(name).alias("entity"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.coalesce(F.sum((F.col("n") > 1).cast("long")), F.lit(0)).alias("n_repeated_keys"),
    )


def join_entities(tables: dict[str, DataFrame], src: str, dst: str, via: str | None = None) -> DataFrame:
    """Left many-to-one join along a link; ``via`` takes the way through another entity."""
    if via:
        mid_key, mid_fk = KEYS[via], LINKS[(via, dst)]
        mid = tables[via].select(F.col(mid_key).alias("_mid"), F.col(mid_fk).alias("_dst"))
        left = tables[src].join(mid, F.col(LINKS[(src, via)]) == F.col("_mid"), "left").drop("_mid")
    else:
        left = tables[src].withColumn("_dst", F.col(LINKS[(src, dst)]))
    right = tables[dst]
    right = right.select(*[F.col(c).alias(f"{dst}_{c}") for c in right.columns])
    return left.join(right, F.col("_dst") == F.col(f"{dst}_{KEYS[dst]}"), "left").drop("_dst")


def dimension_frame(tables: dict[str, DataFrame], entity: str, dims: list[str]) -> DataFrame:
    """The named dimensions of one entity with its key."""
    cols = [F.col(DIMENSIONS[d][1]).alias(d) for d in dims]
    return tables[entity].select(KEYS[entity], *cols)


def _parts(metrics: list[str], merge: bool) -> list:
    """Additive parts (sum and count) of the metrics, first taken, later merged."""
    out, seen = [], set()
    for m in metrics:
        _, fn, col = METRICS[m]
        for part in {"sum": ["s"], "avg": ["s", "n"], "count": ["n"]}[fn]:
            name = f"_{part}_{col}"
            if name in seen:
                continue
            seen.add(name)
            if merge:
                out.append(F.sum(name).alias(name))
            else:
                out.append((F.sum(col) if part == "s" else F.count(col)).alias(name))
    return out


def _final(m: str):
    _, fn, col = METRICS[m]
    s, n = F.col(f"_s_{col}").cast("double"), F.col(f"_n_{col}")
    if fn == "sum":
        return F.round(s, 2).alias(m)
    if fn == "avg":
        return rounded(F.when(n > 0, s / n), 4).alias(m)
    return F.coalesce(n, F.lit(0)).cast("long").alias(m)


def semantic_query(
    tables: dict[str, DataFrame],
    dims: list[str],
    metrics: list[str],
    filters: dict[str, list] | None = None,
    order: list | None = None,
    limit: int | None = None,
    via: str | None = None,
) -> DataFrame:
    """Metrics of one fact grouped by any dimensions it reaches.

    The direct link wins; ``via`` asks for the way through another entity (claims reach
    providers directly and through the patient's primary provider). ``filters`` maps a
    dimension to its admitted values.
    """
    owners = {METRICS[m][0] for m in metrics}
    if len(owners) != 1:
        raise ValueError("metrics of several facts: use semantic_query_multi")
    fact = owners.pop()
    filters = filters or {}
    used = list(dict.fromkeys([*dims, *filters]))
    own = [d for d in used if DIMENSIONS[d][0] == fact]
    far = sorted({DIMENSIONS[d][0] for d in used} - {fact})

    df = tables[fact]
    for d in own:
        if d in filters:
            df = df.filter(F.col(DIMENSIONS[d][1]).isin(filters[d]))
    first_hop = {e: (via if via and e != via and (via, e) in LINKS else e) for e in far}
    hops = sorted(set(first_hop.values()))
    # Two links never share a key column here, so the pre-aggregate is keyed by name.
    keys = [F.col(LINKS[(fact, h)]).alias(f"_fk_{h}") for h in hops]
    own_cols = [F.col(DIMENSIONS[d][1]).alias(d) for d in own]
    # Where every dimension can be broadcast, facts meet them where they are read and the only
    # exchange is that of the result; else a fact is first reduced to its keys.
    small = all(fits_broadcast(tables[e]) for e in {*far, *hops})
    if small:
        columns = [METRICS[m][2] for m in metrics]
        df = df.select(*own_cols, *keys, *dict.fromkeys(columns))
    else:
        df = df.groupBy(*own_cols, *keys).agg(*_parts(metrics, merge=False))

    for e in far:
        e_dims = [d for d in used if DIMENSIONS[d][0] == e]
        dim = dimension_frame(tables, e, e_dims).withColumnRenamed(KEYS[e], f"_pk_{e}")
        hop = first_hop[e]
        key = f"_fk_{hop}"
        if hop != e:
            mid = tables[hop].select(F.col(KEYS[hop]).alias("_mid"), F.col(LINKS[(hop, e)]).alias(f"_far_{e}"))
            df = df.join(mid, F.col(key) == F.col("_mid"), "left").drop("_mid")
            key = f"_far_{e}"
        df = df.join(dim, F.col(key) == F.col(f"_pk_{e}"), "left")
        for d in e_dims:
            if d in filters:
                df = df.filter(F.col(d).isin(filters[d]))
    df = df.groupBy(*dims).agg(*_parts(metrics, merge=not small)).select(*dims, *[_final(m) for m in metrics])
    if order:
        df = df.orderBy(*order)
    return df.limit(limit) if limit else df


def semantic_query_multi(tables: dict[str, DataFrame], dims: list[str], metrics: list[str],
                         filters: dict[str, list] | None = None) -> DataFrame:
    """Metrics of several facts by shared dimensions.

    Each fact is aggregated alone, so no row of one can multiply rows of another; the
    small results are stacked and folded on the dimensions, NULL matching NULL.
    """
    facts = list(dict.fromkeys(METRICS[m][0] for m in metrics))
    parts = [semantic_query(tables, dims, [m for m in metrics if METRICS[m][0] == f], filters) for f in facts]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.groupBy(*dims).agg(*[F.max(m).alias(m) for m in metrics])


def profile_dimensions(tables: dict[str, DataFrame], top: int = 3) -> DataFrame:
    """NULL count, distinct count and most frequent values of every dimension."""
    from pyspark.sql import Window as W

    counted = []
    for e, ds in _DIMS.items():
        wide = dimension_frame(tables, e, ds).select(*[F.col(d).cast("string").alias(d) for d in ds])
        counted.append(
            wide.unpivot([], ds, "dimension", "value")
            .groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("entity", F.lit(e))
        )
    c = materialize(reduce(DataFrame.unionByName, counted), "dimension-values")
    stats = c.groupBy("entity", "dimension").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
        F.count("value").alias("n_distinct"),
    )
    w = W.partitionBy("dimension").orderBy(F.col("n").desc(), F.col("value"))
    best = (
        c.filter(F.col("value").isNotNull()).withColumn("rk", F.row_number().over(w)).filter(F.col("rk") <= top)
        .groupBy("dimension")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rk", "value"))),
                                      lambda s: s["value"]), "|").alias("top_values"))
    )
    return stats.join(best, "dimension", "left").select(
        "entity", "dimension", "n_rows", "n_null", "n_distinct", "top_values")
