"""Global order without a single task: numbers, running sums and medians over range partitions.

Rows are dealt to range partitions (as many as ``spark.sql.shuffle.partitions`` says, or more where the input's bytes ask for
them), sorted there and written; only one row a partition is ever ordered as a whole. Medians need no order: histograms close in on the middle value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import input_bytes, release, written

#: Bytes of input for each range partition.
PART_BYTES = 128 << 20


def _placed(df: DataFrame, order: list[str | Column]) -> DataFrame:
    """``df`` with _part, rising with the order, and _at, rising with the order inside it from 0."""
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes(df) // PART_BYTES))
    ids = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    split = {"_part": F.shiftright("_id", 33), "_at": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))}
    return written(ids, "ordered").withColumns(split).drop("_id")


def _before(per_part: DataFrame, value: str, name: str) -> DataFrame:
    """(_part, name): the sum of ``value`` of the partitions before; one row a partition."""
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return per_part.select("_part", F.coalesce(F.sum(value).over(earlier), F.lit(0)).alias(name))


def numbered(df: DataFrame, order: list[str | Column], name: str = "id", first: int = 0) -> DataFrame:
    """Add ``name``: first, first + 1, ... in the given order, which should be one of all rows."""
    placed = _placed(df, order)
    before = _before(placed.groupBy("_part").agg(F.count("*").alias("_n")), "_n", "_before")
    out = placed.join(F.broadcast(before), "_part")  # one row a partition
    return out.withColumn(name, (F.col("_before") + F.col("_at") + first).cast("bigint")).drop("_part", "_at", "_before")


def running_total(df: DataFrame, order: list[str | Column], value: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows up to this one in the given order, which should be one of all rows."""
    placed = _placed(df, order)
    before = _before(placed.groupBy("_part").agg(F.sum(value).alias("_n")), "_n", "_before")
    upto = F.sum(value).over(Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0))
    return placed.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + upto).drop("_part", "_at", "_before")  # one row a partition


def carried(df: DataFrame, order: list[str | Column], value: str, last: str, following: str) -> DataFrame:
    """Add the last ``value`` that is not null up to a row, and the first from it on, in the given order of all rows.

    Two passes over each range partition, one up and one down, and the ends of the partitions carried over: linear however
    the rows crowd together.
    """
    placed = _placed(df, order)
    up, down = (Window.partitionBy("_part").orderBy(o).rowsBetween(Window.unboundedPreceding, 0) for o in (F.col("_at"), F.desc("_at")))
    held = F.when(F.col(value).isNotNull(), F.col("_at"))
    ends = placed.groupBy("_part").agg(F.min_by(value, held).alias("_lo"), F.max_by(value, held).alias("_hi"))
    before, after = (Window.orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in (F.col("_part"), F.desc("_part")))  # one row a partition
    ends = ends.select("_part", F.last("_hi", ignorenulls=True).over(before).alias("_before"), F.last("_lo", ignorenulls=True).over(after).alias("_after"))
    told = placed.withColumns({last: F.last(value, ignorenulls=True).over(up), following: F.last(value, ignorenulls=True).over(down)}).join(F.broadcast(ends), "_part")
    return told.withColumns({last: F.coalesce(last, "_before"), following: F.coalesce(following, "_after")}).drop("_part", "_at", "_before", "_after")


def unwrapped(df: DataFrame, order: str, hours: str) -> DataFrame:
    """W7 over all rows: add ``unwrapped``: 24 h added or taken off at each step of more than 12 h."""
    placed = _placed(df, [order])
    inside = Window.partitionBy("_part").orderBy("_at")
    ends = placed.groupBy("_part").agg(F.max_by(hours, "_at").alias("_end"))
    ends = ends.select("_part", F.lag("_end").over(Window.orderBy("_part")).alias("_end"))  # one row a partition
    step = F.col(hours) - F.coalesce(F.lag(hours).over(inside), F.col("_end"))
    turns = placed.join(F.broadcast(ends), "_part").withColumn("_step", step).withColumn("_t", F.when(F.col("_step") < -12, 24.0).when(F.col("_step") > 12, -24.0).otherwise(0.0))
    before = _before(turns.groupBy("_part").agg(F.sum("_t").alias("_t")), "_t", "_before")
    out = turns.join(F.broadcast(before), "_part")
    return out.withColumn("unwrapped", F.col(hours) + F.col("_before") + F.sum("_t").over(inside)).drop("_part", "_at", "_end", "_step", "_t", "_before")


#: Values of a group that one task may hold; accuracy of the sketches that choose ranges, and ranges of later rounds.
HELD, ACCURACY, RANGES = 1 << 18, 2000, 32


def _ranges(edges: str) -> Column:
    """The range of ``_v``: odd numbers for the edges themselves, even ones for what lies between."""
    e = F.col(edges)
    return (2 * F.size(F.filter(e, lambda x: x < F.col("_v"))) + F.array_contains(e, F.col("_v")).cast("int")).alias("_bin")


def largest_group(df: DataFrame, by: list[str]) -> int:
    """The number of rows of the largest group."""
    return df.groupBy(*by).count().agg(F.max("count")).first()[0] or 0


def medians(df: DataFrame, by: list[str], value: Column, name: str, held: int = HELD, most: int | None = None) -> DataFrame:
    """(*by, name): the exact median of each group's values, nulls and NaN left out; groups without values have no row (one
    row with null where ``by`` is empty).

    Groups of at most ``held`` values are aggregated at once. For larger ones histograms close in on the middle: a sketch
    chooses edges near it, counts, smallest and largest values of the ranges between are partial sums, and only the range that
    holds the middle goes on, until it is settled or ``held`` values are left. An edge is a range of its own, so repeated
    values settle at once, and each round leaves a fixed share at most. No task ever holds a large group. ``most`` bounds the
    sizes of the groups where the caller knows it, which saves counting them.
    """
    values = df.select(*by, value.cast("double").alias("_v")).where("_v is not null and not isnan(_v)")
    one = [] if by else [F.lit(0).alias("_g")]
    keys = by or ["_g"]
    values = values.select(*one, "*")
    sizes = None
    if most is None or most > held:
        sizes = written(values.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")), "sizes")
        most = sizes.agg(F.max("_n")).first()[0] or 0
    if most <= held:
        release(*([sizes] if sizes is not None else []))
        return values.groupBy(*by).agg(F.median("_v").alias(name))
    same = lambda a, b: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys]
    kept = written(values, "values")  # read once a round
    low, high = F.expr("(_n - 1) div 2"), F.expr("_n div 2")  # the places of the middle values
    now = sizes.select(*keys, "_lo", "_hi", low.alias("_r1"), high.alias("_r2"), F.col("_n").alias("_in"), F.lit(None).cast("double").alias("_m1"), F.lit(None).cast("double").alias("_m2"))
    out, near = None, 4 / ACCURACY
    edges = [0.5 - near, 0.5 + near]
    while True:
        open_ = now.where(F.col("_in") > held)
        small = now.where(F.col("_in") <= held)
        inside = lambda state: kept.alias("v").join(state.alias("s"), same("v", "s")).where("_v between _lo and _hi")  # noqa: E731, B023
        listed = inside(small).groupBy(*(F.col(f"s.{k}") for k in keys), "_r1", "_r2").agg(F.array_sort(F.collect_list("_v")).alias("_all"))
        ends = [F.element_at("_all", (F.col(r) + 1).cast("int")) for r in ("_r1", "_r2")]
        done = listed.select(*keys, ((ends[0] + ends[1]) / 2).alias(name))
        out = done if out is None else out.unionByName(done)
        if open_.isEmpty():
            break
        cuts = inside(open_).groupBy(*(F.col(f"s.{k}") for k in keys)).agg(F.array_distinct(F.percentile_approx("_v", edges, ACCURACY)).alias("_edges"))
        ranged = open_.alias("o").join(cuts.alias("c"), same("o", "c")).select("o.*", "_edges")
        hist = inside(ranged).groupBy(*(F.col(f"s.{k}") for k in keys), "_r1", "_r2", _ranges("_edges")).agg(F.count("*").alias("_c"), F.min("_v").alias("_a"), F.max("_v").alias("_b"))
        before = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)  # some tens of rows
        hist = hist.withColumn("_k", F.coalesce(F.sum("_c").over(before), F.lit(0)))
        holds = lambda r: (F.col("_k") <= F.col(r)) & (F.col(r) < F.col("_k") + F.col("_c"))
        at = lambda r: F.when(F.col("_a") == F.col("_b"), F.col("_a")).when(F.col(r) == F.col("_k"), F.col("_a")).when(F.col(r) == F.col("_k") + F.col("_c") - 1, F.col("_b"))
        hit = hist.where(holds("_r1") | holds("_r2"))
        found = hit.groupBy(*keys).agg(
            F.max(F.when(holds("_r1"), at("_r1"))).alias("_m1"), F.max(F.when(holds("_r2"), at("_r2"))).alias("_m2"), F.min("_a").alias("_lo"), F.max("_b").alias("_hi"),
            (F.min("_r1") - F.min("_k")).alias("_r1"), (F.min("_r2") - F.min("_k")).alias("_r2"), F.sum("_c").alias("_in"),
        )
        new = written(found, "middle")
        settled = new.where("_m1 is not null and _m2 is not null").select(*keys, ((F.col("_m1") + F.col("_m2")) / 2).alias(name))
        out = out.unionByName(settled)
        now, edges = new.where("_m1 is null or _m2 is null"), [k / RANGES for k in range(1, RANGES)]
    out = written(out, "medians")
    release(kept, sizes)
    if by:
        return out
    return df.sparkSession.range(1).join(F.broadcast(out.select(name)), how="left").select(name)  # one row


def median_of_all(df: DataFrame, value: Column, name: str) -> DataFrame:
    """One row with the exact median of ``value``, nulls and NaN left out; null if there is none."""
    return medians(df, [], value, name)
