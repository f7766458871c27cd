"""Linking extracted names to master records, and recordings to visits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import broadcast_if_small, join_hot_split, materialize


def normal_name(name: Column) -> Column:
    """Lower case, titles and punctuation dropped, single blanks."""
    c = F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}]+", " ")
    return F.trim(F.regexp_replace(F.trim(c), r"^(dr|mr|mrs|ms|prof) ", ""))


# Deletions grow with the square of the length: longer names meet by their thirds instead.
MAX_NAME = 64


def deletions(name: Column) -> Column:
    """The name with any zero, one or two characters left out."""
    n = F.length(name)

    def without(text: Column, i: Column) -> Column:
        return F.concat(F.substr(text, F.lit(1), i - 1), F.substr(text, i + 1))

    places = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    one = F.transform(places, lambda i: without(name, i))
    # The second cut is at or after the first, where the characters have moved up by one.
    two = F.flatten(F.transform(places, lambda i: F.transform(F.filter(places, lambda j: (j >= i) & (j < n)), lambda j: without(without(name, i), j))))
    return F.array_distinct(F.concat(F.array(name), one, two))


def third(name: Column, of: Column, i: int, shift: int = 0) -> Column:
    """What a name holds, moved by ``shift``, where third ``i`` of a name of length ``of`` stands, with both."""
    start, end = (F.floor(of * k / 3).cast("int") for k in (i, i + 1))
    return F.struct(of.alias("of"), F.lit(i).alias("i"), F.substr(name, start + shift + 1, end - start).alias("piece"))


def thirds_within_two(name: Column) -> Column:
    """All thirds that a name at most two edits away can have in common with this one.

    Two edits leave one third intact. Those before it move it, those after it make up the
    rest of the difference in length, and they are two in all.
    """
    n = F.length(name)
    moves = [(more, shift) for more in range(-2, 3) for shift in range(-2, 3) if abs(shift) + abs(more - shift) <= 2]
    return F.array_distinct(F.array(*[third(name, n - more, i, shift) for more, shift in moves for i in range(3)]))


def resolve_patient(records: DataFrame, master: DataFrame) -> DataFrame:
    """Master record for every (record_id, name): (record_id, patient_id, distance, n_candidates).

    Equal normal names win. Only distinct names without one go on, and find near names
    (edit distance at most 2) through shared deletions: two strings that close have a common
    string left after two deletions each, so candidates meet by equality and no block of
    similar names is ever paired with itself. Names of more than MAX_NAME characters meet
    the master names that have a third in common with them. Master names are distinct too.

    A name that several patients bear at the best distance is not given to one of them:
    patient_id is NULL and n_candidates says how many there are.
    """
    m = materialize(
        master.filter(F.col("patient_id").isNotNull()).select(normal_name(F.col("name")).alias("m_name"), "patient_id").distinct().groupBy("m_name")
        .agg(F.min("patient_id").alias("patient_id"), F.count(F.lit(1)).alias("n")), "master-names")
    r = records.select("record_id", normal_name(F.col("name")).alias("r_name"))
    # Distinct names keep a frequent name from being looked up once per record.
    names = materialize(r.filter(F.col("r_name") != "").groupBy("r_name").agg(F.count(F.lit(1)).alias("records")), "record-names")
    exact = names.join(m, F.col("r_name") == F.col("m_name")).select("r_name", "patient_id", F.lit(0).alias("distance"), "n")
    missing = materialize(names.join(m, F.col("r_name") == F.col("m_name"), "left_anti").select("r_name"), "missing-names")
    short = missing.filter(F.length("r_name") <= MAX_NAME)
    a = materialize(short.select("r_name", F.explode(deletions(F.col("r_name"))).alias("form")), "record-forms")
    b = m.filter(F.length("m_name") <= MAX_NAME + 2).select("m_name", "patient_id", "n", F.explode(deletions(F.col("m_name"))).alias("form"))
    long_a = materialize(
        missing.filter(F.length("r_name") > MAX_NAME).select("r_name", F.explode(thirds_within_two(F.col("r_name"))).alias("form")), "record-thirds")
    parts = F.array(*[third(F.col("m_name"), F.length("m_name"), i) for i in range(3)])
    long_b = m.filter(F.length("m_name") >= MAX_NAME - 1).select("m_name", "patient_id", "n", F.explode(parts).alias("form"))
    # Names left unresolved are usually few: then the forms of the master list stay put.
    met = b.join(broadcast_if_small(a), "form").drop("form").unionByName(long_b.join(broadcast_if_small(long_a), "form").drop("form"))
    close = (
        met.select("r_name", "m_name", "patient_id", "n").distinct()
        .withColumn("distance", F.levenshtein("r_name", "m_name", 2)).filter(F.col("distance").between(0, 2))
        .groupBy("r_name", "distance").agg(F.min("patient_id").alias("patient_id"), F.sum("n").alias("n"))
        .groupBy("r_name").agg(F.min(F.struct("distance", "patient_id", "n")).alias("best"))
        .select("r_name", F.col("best.patient_id").alias("patient_id"), F.col("best.distance").alias("distance"), F.col("best.n").alias("n"))
    )
    found = exact.unionByName(close).select(
        "r_name", F.when(F.col("n") == 1, F.col("patient_id")).alias("patient_id"), F.col("distance").cast("long").alias("distance"), F.col("n").alias("n_candidates"))
    found = materialize(names.join(found, "r_name"), "resolved-names")
    # A frequent name is looked up by broadcast, the others by a shuffle; records without a match keep their row.
    named = join_hot_split(r, found, ["r_name"], "records").drop("records", "r_name")
    rest = r.join(broadcast_if_small(found.select("r_name")), "r_name", "left_anti").select(
        "record_id", *[F.lit(None).cast("long").alias(c) for c in ("patient_id", "distance")], F.lit(0).cast("long").alias("n_candidates"))
    return named.select("record_id", F.col("patient_id").cast("long").alias("patient_id"), "distance", "n_candidates").unionByName(rest)


def visit_recording_link(recordings: DataFrame, visits: DataFrame) -> DataFrame:
    """Latest visit of the same patient and provider not after each recording.

    Rows of both sides are sorted by time inside (patient, provider, day) and carry the last
    visit forward; what a day starts with comes from a second pass over one row per day.
    A patient with a third of all rows is thus split by day, and no range join is needed.
    A recording without patient, provider or time keeps its row, without a visit.
    """
    keys = ["patient_id", "provider_id"]
    whole = F.col("patient_id").isNotNull() & F.col("provider_id").isNotNull() & F.col("recorded_at").isNotNull()
    unknown = recordings.filter(~whole).select("recording_id", *keys, "recorded_at", F.lit(None).cast(visits.schema["appointment_id"].dataType).alias("appointment_id"))
    recordings = recordings.filter(whole)
    visits = visits.dropna(subset=[*keys, "appointment_date"])
    v = visits.select(*keys, F.col("appointment_date").alias("at"), F.lit(0).alias("kind"), "appointment_id", F.lit(None).cast("long").alias("recording_id"))
    r = recordings.select(*keys, F.col("recorded_at").alias("at"), F.lit(1).alias("kind"), F.lit(None).cast("long").alias("appointment_id"), "recording_id")
    rows = v.unionByName(r).withColumn("day", F.col("at").cast("date"))
    in_day = W.partitionBy(*keys, "day").orderBy("at", "kind", "appointment_id").rowsBetween(W.unboundedPreceding, W.currentRow)
    same_day = rows.withColumn("hit", F.last("appointment_id", ignorenulls=True).over(in_day)).filter(F.col("kind") == 1)
    daily = rows.groupBy(*keys, "day").agg(
        F.max(F.when(F.col("kind") == 0, F.struct("at", "appointment_id"))).alias("last"))
    before = W.partitionBy(*keys).orderBy("day").rowsBetween(W.unboundedPreceding, -1)
    carried = daily.select(*keys, "day", F.last("last", ignorenulls=True).over(before)["appointment_id"].alias("earlier"))
    return same_day.join(carried, [*keys, "day"]).select(
        "recording_id", *keys, F.col("at").alias("recorded_at"), F.coalesce("hit", "earlier").alias("appointment_id")).unionByName(unknown)
