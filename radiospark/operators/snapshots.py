"""What is done to each snapshot as it comes in (K2, Z3): flag, pack the flags, route, average; and the co-add of the results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sky import julian_date, sidereal_hours
from ..session import few, written
from . import calibrate, flags, rfi, timeline

CELL = ["scan", "ant1", "ant2", "chan", "corr"]
Flagger = Callable[[DataFrame], DataFrame]


def by_channel(level: float) -> Flagger:
    """Flags by the rms of channels inside each snapshot."""
    return lambda vis: rfi.rms_threshold(vis, "chan", level, [*rfi.PLANE, "scan"])


def by_schedule(span: int) -> Flagger:
    """Flags by the whole schedule (R8), on planes of ``span`` scans."""

    def run(vis: DataFrame) -> DataFrame:
        spanned = vis.withColumn("span", F.floor(F.col("scan") / float(span)))
        return rfi.flagged(spanned, plane=[*rfi.PLANE, "span"]).drop("span")

    return run


def routes(scans: DataFrame, sources: DataFrame, hours: tuple[int, int] = (1, 14), lst: tuple[float, float] = (11, 14), transit_minutes: float = 4.0) -> DataFrame:
    """(scan, processed): snapshots (scan, ts) to be averaged, by UTC hour (P6), sidereal time (P7) or a transit of one of the
    ``sources`` (P8); the others are archived."""
    told = timeline.routed_by_hour(scans, "ts", *hours).withColumn("lst", sidereal_hours(julian_date("ts")))
    seen = timeline.in_transit(told.select("scan", "lst"), sources, "lst", transit_minutes).select("scan").distinct().withColumn("_seen", F.lit(True))
    return told.join(seen, "scan", "left").select("scan", (F.col("processed") | F.col("lst").between(*lst) | F.coalesce("_seen", F.lit(False))).alias("processed"))


def chain(vis: DataFrame, antennas: DataFrame, sources: DataFrame, flagger: Flagger, n_ant: int, n_chan: int, width: int = 4, transit_minutes: float = 4.0) -> dict[str, DataFrame]:
    """K2: snapshots (scan, ts, ant1, ant2, chan, corr, re, im, amp, flag) to their products, ``flags`` (scan, byte_idx, byte) and
    ``data`` (scan, route, ant1, ant2, chan, corr, re, flag), averaged over ``width`` channels or archived as they are.

    Listed antennas (J7) and missing samples (R6) are flagged first, then what ``flagger`` finds. Every product has its scan as
    a column, and depends on the snapshots of its own plane alone. The flagged samples are written once to the shared folder,
    where all products read them; routes have one row a snapshot and go to the samples, which stay where they are.
    """
    found = written(flagger(flags.flag_antennas(rfi.with_missing_flagged(vis), antennas)), "flagged")
    packed = flags.pack_flags(found.withColumn("pos", flags.place_of(n_ant, n_chan)), "scan")
    told = found.join(few(routes(found.select("scan", "ts").distinct(), sources, transit_minutes=transit_minutes), "routes"), "scan")
    columns = ["scan", "ant1", "ant2", "chan", "corr", "re", "flag"]
    averaged = calibrate.bin_channels(told.where("processed"), width).select(F.lit("averaged").alias("route"), *columns)
    return {"flags": packed, "data": averaged.unionByName(told.where("not processed").select(F.lit("archived").alias("route"), *columns))}


def co_added(data: DataFrame) -> DataFrame:
    """(ant1, ant2, chan, corr, re, n): the mean of the averaged snapshots' unflagged samples, and their number."""
    return data.where("route = 'averaged' and not flag").groupBy("ant1", "ant2", "chan", "corr").agg(F.avg("re").alias("re"), F.count("*").alias("n"))
