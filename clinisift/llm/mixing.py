"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinisift.session import materialize

from .common import WORD, bounded_broadcast, partitions

#: Repeats of a source that the mix never exceeds.
MAX_REPEATS = 3
#: Rows of a source that share one bucket of the order, on average.
BUCKET_ROWS = 8192
#: Sources whose table may be broadcast; of more, each source is spread over salts.
BROADCAST_SOURCES = 100_000
#: Row weights are rounded to classes, this many to a doubling, so that a source has a short table of
#: them; weights beyond 2^-10 and 2^10 count as these.
CLASSES_PER_DOUBLING, DOUBLINGS = 4, 10
#: Times the last bucket is gone through for rows that still fit.
FILL_ROUNDS = 4


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def numbered(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank`` (from 0) in order of code points, null last; no task sees all of them."""
    last = F.col("source").isNull()
    parts = materialize(
        sources.repartitionByRange(partitions(sources.sparkSession), last, F.col("source"))
        .withColumn("part", F.spark_partition_id()), "mix-sources")
    before = parts.groupBy("part").count().select(
        "part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(last, "source"))
    return parts.withColumn("inside", inside).join(before, "part").withColumn(
        "rank", F.col("inside") - 1 + F.col("before")).drop("part", "inside", "before")


def source_targets(sizes: DataFrame, max_repeats: float = MAX_REPEATS, weights: tuple[float, ...] = (1, 2, 3)) -> DataFrame:
    """Per source: source_size, n_docs, weight, target.

    Targets share the sum of all sizes by weight. A target above ``max_repeats`` times its
    source stops there and the rest is shared again by weight until none is above: each
    round is one aggregate over the sources that returns two numbers.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    table = numbered(by_source).withColumn("weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int")))
    table = materialize(table, "mix-weights")
    all_, total_weight = table.agg(F.sum("source_size"), F.sum("weight")).first()
    level = all_ / total_weight if all_ else 0.0
    while all_:
        full = F.col("source_size") * max_repeats <= F.lit(level) * F.col("weight")
        capped, free = table.agg(
            F.sum(F.when(full, F.col("source_size") * max_repeats)), F.sum(F.when(~full, F.col("weight")))).first()
        fresh = (all_ - (capped or 0)) / free if free else level
        if fresh <= level:
            break
        level = fresh
    return table.withColumn("target", F.least(
        (F.col("source_size") * max_repeats).cast("double"), F.lit(float(level)) * F.col("weight"))).drop("rank")


def by_length(text: Column) -> Column:
    """Row weight that prefers long texts: the square root of the number of words and one."""
    return F.sqrt(1.0 + n_words(text))


def weight_class(weight: Column | None) -> Column:
    """Class of a row weight; none, null and NaN weigh 1, weights of 0 or less the least there is."""
    if weight is None:
        return F.lit(0)
    w = F.coalesce(F.nanvl(weight.cast("double"), F.lit(1.0)), F.lit(1.0))
    w = F.greatest(F.least(w, F.lit(2.0**DOUBLINGS)), F.lit(2.0**-DOUBLINGS))
    return F.round(F.log2(w) * CLASSES_PER_DOUBLING).cast("int")


def inclusion(sizes: DataFrame, targets: DataFrame, max_repeats: float = MAX_REPEATS) -> DataFrame:
    """(source, need, classes): for each weight class of a source how often a row of it is taken for
    certain and the probability of one copy more, and the words that all those are to bring.

    A row is expected min(max_repeats, level * weight) times, with the level at which the
    expected words of the source are its target. Classes from the heaviest on may stand at
    max_repeats; the level belongs to the heaviest one that stays below it.
    """
    by_class = sizes.groupBy("source", "class").agg(F.sum("size").alias("words"))
    table = targets.withColumnRenamed("source", "source_").join(by_class, F.col("source").eqNullSafe(F.col("source_"))).drop("source_")
    table = table.withColumn("w", F.pow(F.lit(2.0), F.col("class") / CLASSES_PER_DOUBLING))
    lighter = Window.partitionBy("source").orderBy("class").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    heavier = Window.partitionBy("source").orderBy(F.desc("class")).rowsBetween(Window.unboundedPreceding, -1)
    rest = F.sum(F.col("w") * F.col("words")).over(lighter)
    above = F.coalesce(F.sum("words").over(heavier), F.lit(0))
    table = table.withColumn("rest", rest).withColumn("level", F.when(F.col("rest") > 0, (F.col("target") - max_repeats * above) / F.col("rest")))
    below = F.col("level") * F.col("w") <= max_repeats * (1 + 1e-9)
    table = table.withColumn("level", F.max_by(F.when(below, F.col("level")), F.when(below, F.col("class"))).over(Window.partitionBy("source")))
    times = F.least(F.lit(float(max_repeats)), F.coalesce(F.col("level") * F.col("w"), F.lit(float(max_repeats))))
    table = table.withColumn("times", F.when(F.col("source_size") > 0, times).otherwise(0.0)).withColumn("certain", F.floor("times"))
    cell = F.struct("class", F.struct("certain", (F.col("times") - F.col("certain")).alias("p")))
    return table.groupBy("source").agg(
        F.greatest(F.lit(0.0), F.first("target") - F.sum(F.col("certain") * F.col("words"))).alias("need"),
        F.map_from_entries(F.collect_list(cell)).alias("classes"))


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[float, ...] = (1, 2, 3), max_repeats: float = MAX_REPEATS, seed: int = 42, bucket_rows: int = BUCKET_ROWS,
    row_weight: Column | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken, copies, source.

    A row is expected level * ``row_weight`` times, ``max_repeats`` at most; the level of its source
    makes the expected words its target (see :func:`inclusion`; without weights all rows of a source
    are expected target / source_size times). The whole part of that is certain. The rest p is
    the probability of one copy more: rows are ranked by Pareto order, their random odds
    u / (1 - u) over the odds p / (1 - p) of their inclusion, and taken in that order while
    they fit the words still needed. Within the bucket of the order in which the sample ends,
    rows too long for what is still short are passed over, and the last place goes to the
    row that comes closest. The random number is a hash of id, size and seed: reruns agree.

    The order is never sorted whole. Rows are counted per (source, bucket of the order);
    running sums over the buckets name the one bucket per source in which the sample ends,
    and only the rows of that bucket are sorted.

    Defined cases: a null text has size 0; null is a source of its own, the last one; rows of
    size 0 take 0 words; weights that are null count 1, those of 0 or less 2^-10; a source without words has target 0; equal ids are ranked by size,
    rows equal in both are interchangeable; an empty table gives no rows; further columns
    are ignored, whatever their names.
    """
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("id"), F.col("size")), 12).cast("double") + 0.5) / F.lit(2.0**52)
    sizes = materialize(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"),
        weight_class(row_weight).alias("class")).withColumn("u", u), "mix-sizes")
    targets = source_targets(sizes, max_repeats, weights)
    targets = materialize(targets.withColumn("buckets", F.ceil(F.col("n_docs") / bucket_rows)), "mix-targets")
    drawn = materialize(inclusion(sizes, targets.select("source", "source_size", "target"), max_repeats), "mix-inclusion")
    rows = _with_source(sizes, targets.select("source", "source_size", "target", "buckets"))
    rows = _with_source(rows, drawn).withColumn("drawn", F.element_at("classes", F.col("class")))
    rows = rows.withColumns({"certain": F.col("drawn.certain"), "p": F.col("drawn.p")}).drop("classes", "drawn")
    q = F.col("u") / (1 - F.col("u")) * (1 - F.col("p")) / F.col("p")
    rows = rows.withColumn("order", F.when(F.col("p") > 0, q / (1 + q)).otherwise(1.0)).withColumn(
        "bucket", F.least(F.floor(F.col("order") * F.col("buckets")), F.col("buckets") - 1))

    run = Window.partitionBy("source").orderBy("bucket")
    sums = rows.groupBy("source", "bucket", "need").agg(F.sum(F.when(F.col("p") > 0, F.col("size")).otherwise(0)).alias("words"))
    ends = sums.withColumn("upto", F.sum("words").over(run)).filter("upto >= need").groupBy("source").agg(
        F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("before"))).alias("end"))
    ends = materialize(ends.select("source", F.col("end.bucket").alias("end"), F.col("end.before").alias("before")), "mix-ends")
    placed = _with_source(rows, ends, "left")

    out = ["id", "source", "size", "source_size", "target", "certain", "extra"]
    clear = placed.filter("end IS NULL OR bucket <> end").withColumn(
        "extra", (F.col("p") > 0) & (F.col("need") > 0) & (F.col("end").isNull() | (F.col("bucket") < F.col("end"))))
    edge = placed.filter("bucket = end").withColumn("extra", F.lit(False)).withColumn("short", F.col("need") - F.col("before"))
    for _ in range(FILL_ROUNDS):
        edge = _fill(edge)
    near = Window.partitionBy("source").orderBy("miss", "order", "id", "size")
    edge = edge.withColumn("miss", F.when(F.col("extra") | (F.col("p") <= 0), F.lit(float("inf"))).otherwise(F.abs(F.col("size") - F.col("short"))))
    edge = edge.withColumn("extra", F.col("extra") | (
        (F.row_number().over(near) == 1) & (F.col("need") > 0) & (F.col("miss") < F.col("short"))))
    copies = (F.col("certain") + F.col("extra").cast("int")).cast("long")
    return clear.select(*out).unionByName(edge.select(*out)).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target",
        (copies * F.col("size")).alias("taken"), copies.alias("copies"), "source")


def _fill(edge: DataFrame) -> DataFrame:
    """Take, in order, rows that fit the words still short, up to the first that does not."""
    source = Window.partitionBy("source")
    upto = source.orderBy("order", "id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    may = ~F.col("extra") & (F.col("p") > 0) & (F.col("need") > 0) & (F.col("size") <= F.col("short"))
    edge = edge.withColumn("may", may).withColumn("words", F.sum(F.when(F.col("may"), F.col("size")).otherwise(0)).over(upto))
    edge = edge.withColumn("now", F.col("may") & (F.col("words") <= F.col("short")))
    return edge.withColumn("extra", F.col("extra") | F.col("now")).withColumn(
        "short", F.col("short") - F.sum(F.when(F.col("now"), F.col("size")).otherwise(0)).over(source)).drop("may", "words", "now")


def _with_source(rows: DataFrame, table: DataFrame, how: str = "inner") -> DataFrame:
    """Join on the source, null included: broadcast while the table of sources is provably
    small, else with each source spread over salts so that a hot one meets many tasks."""
    spark = rows.sparkSession
    right = table.withColumnRenamed("source", "source_")
    same = F.col("source").eqNullSafe(F.col("source_"))
    if table.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        return rows.join(F.broadcast(right), same, how).drop("source_")
    salts = max(8, partitions(spark) // 8)
    right = right.withColumn("salt_", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    left = rows.withColumn("salt", F.pmod(F.xxhash64("id", "u"), F.lit(salts)).cast("int"))
    return left.join(right, same & (F.col("salt") == F.col("salt_")), how).drop("source_", "salt", "salt_")


def mixed_rows(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """``docs`` with each row as often as the mix takes it; equal ids count alike, null ids by themselves."""
    times = mixed.groupBy("doc_id").agg(F.max("copies").alias("copies_")).withColumnRenamed("doc_id", "id_")
    times = materialize(times, "mix-copies")
    cols = [docs[c] for c in docs.columns]
    return (
        docs.join(bounded_broadcast(times), docs["doc_id"].eqNullSafe(F.col("id_"))).filter("copies_ > 0")
        .select(*cols, F.explode(F.sequence(F.lit(1), F.col("copies_").cast("int"))).alias("copy_")).drop("copy_"))
