"""Dynamic spectra."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import amp
from ..session import few, written
from . import calibrate, timeline
from .ordering import numbered

#: Frequency axis of a cube in MHz (first, step) and seconds a scan.
FIRST_MHZ, STEP_MHZ, SCAN_S = 13.398, 0.023926, 10.031


def incoherent_sum(vis: DataFrame, gains: DataFrame | None, flag_mode: str = "exclude", use_flags: bool = True) -> DataFrame:
    """(scan, chan, corr, amp, n): mean amplitude over cross baselines.

    'exclude' leaves flagged samples and flagged or missing gains out; 'zero' lets flagged gains enter as zeros, and
    ignores the data's flags.
    """
    if flag_mode == "exclude":
        done = calibrate.apply_bandpass_flagged(vis, gains, use_flags)
        value = amp()
    else:
        done = calibrate.with_gains(calibrate.apply_bandpass(vis, gains, cross_only=True), gains.select("ant", "chan", "pol", "flag"), ("flag",))
        value = F.when(F.coalesce("g1_flag", F.lit(False)) | F.coalesce("g2_flag", F.lit(False)), 0.0).otherwise(amp())
    return done.groupBy("scan", "chan", "corr").agg(F.avg(value).alias("amp"), F.count(value).alias("n"))


def baseline_spectra(vis: DataFrame, baselines: DataFrame) -> DataFrame:
    """Amplitudes of the listed baselines (ant1, ant2)."""
    return vis.join(baselines, ["ant1", "ant2"], "left_semi").withColumn("amp", amp())


def numbered_scans(df: DataFrame, ts: str = "ts") -> DataFrame:
    """``df`` with ``scan``, the place of its time among all distinct times."""
    return df.join(numbered(df.select(ts).distinct(), [ts], "scan"), ts)


def filled_cube(spectrum: DataFrame, kind: str = "sum") -> DataFrame:
    """(type, corr, scan, freq_idx, amp, present): every cell of the cube, 0 where nothing was written; ``spectrum`` can have
    types of its own in a column ``type``."""
    if "type" not in spectrum.columns:
        spectrum = spectrum.withColumn("type", F.lit(kind))
    spectrum = written(spectrum, "spectrum")  # read five times
    kinds, scans, chans, corrs = (spectrum.select(c).distinct() for c in ("type", "scan", "chan", "corr"))
    cells = scans.join(F.broadcast(chans)).join(F.broadcast(corrs)).join(F.broadcast(kinds))  # the axes of the cube: bounded by the instrument and the list of baselines
    out = cells.join(spectrum, ["type", "scan", "chan", "corr"], "left")
    return out.select("type", "corr", "scan", F.col("chan").alias("freq_idx"), F.coalesce("amp", F.lit(0.0)).alias("amp"), F.col("amp").isNotNull().alias("present"))


def with_axes(cube: DataFrame, start_hour: float = 0.0, averaged: int = 1) -> DataFrame:
    """The cube with its frequency (MHz) and time (hours) axes."""
    return cube.withColumn("mhz", FIRST_MHZ + F.col("freq_idx") * (STEP_MHZ * averaged)).withColumn("hours", start_hour + F.col("scan") * SCAN_S / 3600.0)


def write_cube(cube: DataFrame, path: str) -> None:
    """One folder for each type and correlation."""
    cube.write.mode("overwrite").partitionBy("type", "corr").parquet(path)


def dynamic_spectrum(vis: DataFrame, gains: DataFrame, flag_mode: str = "exclude", use_flags: bool = True) -> DataFrame:
    """K1: calibrated, averaged over baselines, and filled to a cube."""
    return filled_cube(incoherent_sum(vis, gains, flag_mode, use_flags))


def dated_spectra(vis: DataFrame, scans: DataFrame, tables: DataFrame, gains: DataFrame, baselines: DataFrame, n_chan: int) -> tuple[DataFrame, DataFrame]:
    """K1 over many dates and sub-bands: the cube, and (spw, date, n) of the scans left out because no table was made yet.

    ``vis`` has the ``scans`` (scan, spw, ts) of its rows; each is calibrated with the gains (gain_id, ant, chan, pol, ...) of the
    latest of ``tables`` (spw, date, gain_id) not after its date. Times are numbered over all sub-bands, and a sub-band's
    channels begin at spw * n_chan. Types are the mean over baselines ('sum') and each of the listed ``baselines`` ('a-b').
    """
    told = written(numbered_scans(timeline.with_effective_calibration(scans.withColumnRenamed("scan", "_scan"), tables)), "scans")
    skipped = told.where("gain_id is null").groupBy("spw", "date").agg(F.count("*").alias("n"))
    own = few(told.where("gain_id is not null").select(F.col("_scan").alias("_id"), "spw", "gain_id", F.col("scan").alias("number")), "own")
    rows = vis.withColumnRenamed("scan", "_id").join(own, "_id").withColumnsRenamed({"_id": "scan"})
    done = calibrate.apply_bandpass_flagged(rows, gains, by=("gain_id",)).withColumn("amp", amp())
    axes = [F.col("number").alias("scan"), (F.col("spw") * n_chan + F.col("chan")).alias("chan"), "corr"]
    mean = done.groupBy("number", "spw", "chan", "corr").agg(F.avg("amp").alias("amp")).select(F.lit("sum").alias("type"), *axes, "amp")
    listed = done.join(baselines, ["ant1", "ant2"], "left_semi").select(F.concat_ws("-", "ant1", "ant2").alias("type"), *axes, "amp")
    return filled_cube(mean.unionByName(listed)), skipped
