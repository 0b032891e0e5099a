"""Timelines, chunks, lookups by time and pairing (P4-P8, P10, P11, J9, J10, J17, J18, J20, J24, W*, T*, U2, U4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import carried, numbered
from .ordering import unwrapped as unwrapped_whole


def antenna_numbers(df: DataFrame, names: DataFrame, prefix: int) -> DataFrame:
    """Add ``number``, the digits of the antenna's name after ``prefix`` characters, or else its own number."""
    named = df.join(names.select("ant", "name"), "ant", "left")
    digits = F.col("name").substr(F.lit(prefix + 1), F.length("name"))
    return named.withColumn("number", F.coalesce(digits.try_cast("int"), F.col("ant").cast("int"))).drop("name")


def delay_differences(new: DataFrame, reference: DataFrame) -> DataFrame:
    """(ant, pol, difference); raises where only one table has an antenna and polarisation."""
    both = new.select("ant", "pol", F.col("delay_ns").alias("n")).join(reference.select("ant", "pol", F.col("delay_ns").alias("r")), ["ant", "pol"], "full")
    lost = F.col("n").isNull() | F.col("r").isNull()
    return both.select("ant", "pol", F.when(lost, F.raise_error(F.lit("the delay tables hold different antennas")).cast("double")).otherwise(F.col("n") - F.col("r")).alias("difference"))


def within(df: DataFrame, ts: str, start: str, end: str) -> DataFrame:
    """The half-open range [start, end); equal ends select that time."""
    s, e = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    return df.where((F.col(ts) >= s) & ((F.col(ts) < e) | ((s == e) & (F.col(ts) == s))))


def routed_by_hour(df: DataFrame, ts: str, first: int, last: int) -> DataFrame:
    """Add ``processed``: whether the UTC hour lies in first..last."""
    return df.withColumn("processed", F.hour(ts).between(first, last))


def circular_hours(a: Column, b: Column) -> Column:
    """Distance of two hours of the day."""
    return F.abs(F.pmod(a - b + 12, F.lit(24.0)) - 12)


def in_transit(df: DataFrame, sources: DataFrame, lst: str, window_minutes: float) -> DataFrame:
    """Every row with each source (label, ra in degrees) whose transit is within half a window.

    The day is cut into slots of half a window or more; a source meets the rows of its slot and the two beside it.
    """
    reach = window_minutes / 120.0
    n = max(1, int(24.0 // reach)) if reach > 0 else 24
    slot = lambda hours: F.floor(F.pmod(hours, F.lit(24.0)) * n / 24.0).cast("bigint")
    beside = F.array_distinct(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda k: F.pmod(slot(F.col("_ra") / 15.0) + k, F.lit(n))))
    named = sources.select("label", F.col("ra").alias("_ra")).withColumn("_slot", F.explode(beside))
    both = df.withColumn("_slot", slot(F.col(lst))).join(named, "_slot")
    return both.where(circular_hours(F.col(lst), F.col("_ra") / 15.0) <= reach).drop("_ra", "_slot")


def above_horizon(df: DataFrame, horizon: DataFrame, least: float) -> DataFrame:
    """Add ``horizon`` of the whole degree ``az_i`` (a table of 361 rows), and ``visible``: ``el`` above it and above ``least``."""
    out = df.join(F.broadcast(horizon.select("az_i", "horizon")), "az_i", "left")  # one row a degree
    return out.withColumn("visible", F.col("el") > F.greatest(F.lit(least), F.coalesce("horizon", F.lit(least))))


def not_done(wanted: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key has no output yet."""
    return wanted.join(done.select(*keys).distinct(), keys, "left_anti")


def nearest_in_time(pivots: DataFrame, times: DataFrame) -> DataFrame:
    """For each pivot (pid, ts) the nearest of ``times`` (ts, value) at any distance, the earlier on ties and the smallest
    value of equal times; null if there are no times or the pivot has none.

    Both sides are laid in one order of time over range partitions, and every pivot takes the last time before it and the
    first after it, carried along in both directions. No pairs are made, and a crowded day lies in many partitions.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    one = times.where("ts is not null").groupBy("ts").agg(F.min("value").alias("value")).select("ts", F.struct("ts", "value").alias("at"))
    both = pivots.where("ts is not null").select("ts", "pid", F.lit(None).cast(one.schema["at"].dataType).alias("at"), F.lit(True).alias("asks"))
    both = both.unionByName(one.select("ts", F.lit(None).cast(pivots.schema["pid"].dataType).alias("pid"), "at", F.lit(False).alias("asks")))
    told = carried(both, ["ts", "asks", "pid"], "at", "_last", "_next").where("asks")
    gap = lambda c: F.abs(micros(f"{c}.ts") - micros("ts"))
    best = F.when(F.col("_next").isNull() | (gap("_last") <= gap("_next")), F.col("_last")).otherwise(F.col("_next"))
    found = told.select("pid", "ts", best.alias("best")).select("pid", "ts", F.col("best.ts").alias("near_ts"), F.col("best.value").alias("value"))
    return found.unionByName(pivots.where("ts is null").select("pid", "ts"), allowMissingColumns=True)


def bad_antennas_on(flags: DataFrame, date: str, sources: list[str], date_map: dict[str, str] | None = None) -> DataFrame:
    """The antennas that ``sources`` flag on a date; the date goes through ``date_map`` and is held within the list's."""
    wanted = F.lit((date_map or {}).get(date, date)).cast("date")
    ends = flags.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    chosen = flags.where(F.col("source").isin(*sources)).join(F.broadcast(ends))  # one row
    return chosen.where(F.col("date") == F.least(F.greatest(wanted, F.col("lo")), F.col("hi"))).select("corr_num").distinct()


def sidereal_pairs(scans: DataFrame, interval: str = "INTERVAL '0 23:56:04' DAY TO SECOND", tolerance_s: float = 0.0) -> DataFrame:
    """Each scan (ts, scan_id, spw) with that of the same band one interval later, within a tolerance."""
    early = scans.select("spw", F.col("ts").alias("early"), F.col("scan_id").alias("early_id"), (F.col("ts") + F.expr(interval)).alias("due"))
    late = scans.select("spw", F.col("ts").alias("late"), F.col("scan_id").alias("late_id"))
    if not tolerance_s:
        return early.join(late.withColumnRenamed("late", "due"), ["spw", "due"]).select("spw", "early", F.col("due").alias("late"), "early_id", "late_id")
    slot = lambda c: F.floor(F.unix_micros(F.col(c).cast("timestamp")) / F.lit(2e6 * tolerance_s)).cast("bigint")
    early = early.withColumn("_b", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda k: slot("due") + k)))
    both = early.join(late.withColumn("_b", slot("late")), ["spw", "_b"])
    apart = F.abs(F.unix_micros(F.col("late").cast("timestamp")) - F.unix_micros(F.col("due").cast("timestamp")))
    return both.where(apart <= tolerance_s * 1e6).select("spw", "early", "late", "early_id", "late_id")


def with_calibration(scans: DataFrame, tables: DataFrame) -> DataFrame:
    """Scans with the gain table of their band and date; scans without one have null."""
    return scans.withColumn("date", F.to_date("ts")).join(tables, ["spw", "date"], "left")


def with_effective_calibration(scans: DataFrame, tables: DataFrame) -> DataFrame:
    """J24, as of: add ``gain_id``, that of the band's latest of ``tables`` (spw, date, gain_id) not after the scan's date (of
    equal dates the greatest id); null where there is none.

    A table holds from its date to the day before the next of its band, or to the last scan; the days of the tables are a
    dimension of one row a band and day, which scans meet by equality.
    """
    last = scans.agg(F.max(F.to_date("ts")).alias("_last"))
    order = Window.partitionBy("spw").orderBy("date")  # a row a table
    until = F.coalesce(F.date_sub(F.lead("date").over(order), 1), F.greatest("date", "_last"))
    held = tables.groupBy("spw", "date").agg(F.max("gain_id").alias("gain_id")).join(F.broadcast(last)).withColumn("_until", until)  # one row
    days = held.select("spw", F.explode(F.sequence("date", "_until")).alias("date"), "gain_id")
    return scans.withColumn("date", F.to_date("ts")).join(days, ["spw", "date"], "left")


def overlapping_pairs(df: DataFrame, by: list[str], order: str, key: str) -> DataFrame:
    """(by, pair, key): items i and i + 1 of each group as pair i."""
    w = Window.partitionBy(*by).orderBy(order)
    both = df.withColumn("pair", (F.row_number().over(w) - 1).cast("bigint")).withColumn("_next", F.lead(key).over(w)).where("_next is not null")
    return both.select(*by, "pair", F.explode(F.array(F.col(key), F.col("_next"))).alias(key))


def chunks(df: DataFrame, order: list[str], size: int, by: list[str] = ()) -> DataFrame:
    """Add ``chunk``: consecutive rows by ``size``, the last short."""
    if not by:
        return numbered(df, order, "chunk").withColumn("chunk", F.floor(F.col("chunk") / float(size)))
    return df.withColumn("chunk", F.floor((F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1) / float(size)))


def chunks_of_time(df: DataFrame, ts: str, seconds: float, by: list[str] = ()) -> DataFrame:
    """Add ``chunk``: spans of ``seconds`` from the first time on."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    if by:
        first = F.min(micros).over(Window.partitionBy(*by))
    else:
        df, first = df.join(F.broadcast(df.agg(F.min(micros).alias("_first")))), F.col("_first")  # one row
    return df.withColumn("chunk", F.floor((micros - first) / F.lit(seconds * 1e6)).cast("bigint")).drop("_first")


def gaps(df: DataFrame, ts: str, by: list[str] = ()) -> DataFrame:
    """Add ``gap``, seconds since the row before."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    return df.withColumn("gap", (micros - F.lag(micros).over(Window.partitionBy(*by).orderBy(ts))) / 1e6)


def unwrapped(df: DataFrame, by: list[str], order: str, hours: str) -> DataFrame:
    """Add ``unwrapped``: 24 h added or taken off at each step of more than 12 h."""
    if not by:
        return unwrapped_whole(df, order, hours)
    w = Window.partitionBy(*by).orderBy(order)
    step = F.col(hours) - F.lag(hours).over(w)
    turn = df.withColumn("_t", F.when(step < -12, 24.0).when(step > 12, -24.0).otherwise(0.0))
    return turn.withColumn("unwrapped", F.col(hours) + F.sum("_t").over(w)).drop("_t")


def first_crossing(df: DataFrame, by: list[str], ts: str, value: str, bound: float, after_s: float = 10.0) -> DataFrame:
    """For each group the first time at which the value reaches the bound, or ``after_s`` after the last."""
    last = F.max(ts) + F.make_dt_interval(secs=F.lit(after_s))
    return df.groupBy(*by).agg(F.coalesce(F.min(F.when(F.col(value) >= bound, F.col(ts))), last).alias("crossing"))


def full_blocks(df: DataFrame, ts: str, size: int = 24) -> DataFrame:
    """(hour, hours): blocks of exactly ``size`` records, from one hour or from one of fewer and the next there is.

    Runs of hours are used from the first on: an hour that completes the one before begins no block of its own.
    """
    hours = df.groupBy(F.date_trunc("hour", ts).alias("hour")).agg(F.count("*").alias("n"))
    w = Window.orderBy("hour")
    hours = hours.withColumn("_next", F.lead("n").over(w))
    pairs = hours.withColumn("joins", (F.col("n") < size) & F.coalesce(F.col("n") + F.col("_next") == size, F.lit(False)))
    run = pairs.withColumn("_run", F.sum((~F.coalesce(F.lag("joins").over(w), F.lit(False))).cast("int")).over(w))
    place = run.withColumn("_place", F.row_number().over(Window.partitionBy("_run").orderBy("hour")) - 1)
    taken = place.where((F.col("n") == size) | (F.col("joins") & (F.col("_place") % 2 == 0)))
    return taken.select("hour", F.when(F.col("n") == size, 1).otherwise(2).alias("hours"))


def head_and_tail(df: DataFrame, by: list[str], order: str, n: int, fewer_than: int, when: Column) -> DataFrame:
    """The first and last n rows of the groups in which fewer than ``fewer_than`` rows satisfy ``when``; those rows
    elsewhere."""
    up, down, every = Window.partitionBy(*by).orderBy(order), Window.partitionBy(*by).orderBy(F.desc(order)), Window.partitionBy(*by)
    told = df.withColumns({"_up": F.row_number().over(up), "_down": F.row_number().over(down), "_good": F.count_if(when).over(every)})
    return told.where(F.when(F.col("_good") < fewer_than, (F.col("_up") <= n) | (F.col("_down") <= n)).otherwise(when)).drop("_up", "_down", "_good")


def middle_rows(df: DataFrame, by: list[str], order: str) -> DataFrame:
    """The row at index n // 2 of each group."""
    w = Window.partitionBy(*by)
    told = df.withColumns({"_i": F.row_number().over(w.orderBy(order)) - 1, "_n": F.count("*").over(w)})
    return told.where("_i = _n div 2").drop("_i", "_n")


def padded(df: DataFrame, by: list[str], axis: str, first: int, last: int) -> DataFrame:
    """Every group with all places first..last of the axis, missing ones with nulls."""
    kind = df.schema[axis].dataType
    every = df.select(*by).distinct().withColumn(axis, F.explode(F.sequence(F.lit(first).cast(kind), F.lit(last).cast(kind))))
    return every.join(df, [*by, axis], "left")


def full_sidereal_hours(df: DataFrame, base: str, order: str, lst: str) -> DataFrame:
    """(start, end) of the whole sidereal hours that the rows with ``base`` cover, found on the unwrapped hours."""
    turned = unwrapped(df, [], order, lst)
    ends = turned.where(base).agg(F.min_by("unwrapped", order).alias("a"), F.max_by("unwrapped", order).alias("b"))
    limits = ends.select(F.floor("a").cast("double").alias("a"), F.ceil("b").cast("double").alias("b"))
    both = turned.join(F.broadcast(limits))  # one row
    late = F.max(order) + F.expr("INTERVAL '10' SECOND")
    first = lambda c: F.coalesce(F.min(F.when(F.col("unwrapped") >= F.col(c), F.col(order))), late)
    return both.agg(first("a").alias("start"), first("b").alias("end"))


def best_per_group(df: DataFrame, by: list[str], distance: Column, tolerance: float | None = None, tie: str | None = None) -> DataFrame:
    """The row of the smallest distance in each group, if it is within the tolerance."""
    order = [F.asc("_d"), *([F.asc(tie)] if tie else [])]
    told = df.withColumn("_d", distance).withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("_r = 1")
    return (told if tolerance is None else told.where(F.col("_d") <= tolerance)).drop("_r").withColumnRenamed("_d", "distance")
