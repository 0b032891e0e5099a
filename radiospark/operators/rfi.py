"""Interference flagging of time x channel planes.

Planes are keyed by baseline and correlation; ``plane`` names those columns. Statistics, rank operator and mask algebra are
plain aggregations and windows; SumThreshold and the high-pass filter work on one plane at a time in numpy. Long
observations have a span of scans among the columns of ``plane``, so that a plane is of bounded size (scans of a span x
channels).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import importable

PLANE = ["ant1", "ant2", "corr"]


def _matrix(rows: pd.DataFrame, value: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, place of each row in time, place in channel) of a plane; absent samples are NaN."""
    t, ti = np.unique(rows["scan"].to_numpy(), return_inverse=True)
    c, ci = np.unique(rows["chan"].to_numpy(), return_inverse=True)
    out = np.full((len(t), len(c)), np.nan)
    out[ti, ci] = rows[value].to_numpy(dtype=float)
    return out, ti, ci


def sum_threshold(values: np.ndarray, mask: np.ndarray, level: float, factor: float = 1.5, longest: int = 64) -> np.ndarray:
    """SumThreshold along the last axis: windows of 1, 2, 4, ... samples whose mean of unflagged samples is above
    level * factor**-log2(n) are flagged."""
    flags, n = mask.copy(), 1
    while n <= min(longest, values.shape[-1]):
        limit = level * factor ** -np.log2(n)
        good = np.where(flags, 0.0, values)
        total = np.cumsum(np.pad(good, ((0, 0), (1, 0))), axis=1)
        count = np.cumsum(np.pad((~flags).astype(float), ((0, 0), (1, 0))), axis=1)
        s, k = total[:, n:] - total[:, :-n], count[:, n:] - count[:, :-n]
        hit = (k > 0) & (np.abs(s) > limit * k)
        for shift in range(n):
            flags[:, shift : shift + hit.shape[1]] |= hit
        n *= 2
    return flags


def sum_thresholded(df: DataFrame, level: float, plane: list[str] = PLANE, value: str = "amp") -> DataFrame:
    """OR ``flag`` with SumThreshold hits in time and channel; the level counts standard deviations (by the median
    absolute deviation) from the plane's median, flagged samples being left out."""
    importable(df.sparkSession)

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        values, ti, ci = _matrix(rows, value)
        mask, _, _ = _matrix(rows.assign(_f=rows["flag"].astype(float)), "_f")
        bad = ~np.isfinite(values) | (mask > 0) | np.isnan(mask)
        if (~bad).any():
            middle = np.median(values[~bad])
            spread = 1.4826 * np.median(np.abs(values[~bad] - middle)) or 1.0
            scaled = np.where(bad, 0.0, (values - middle) / spread)
            hits = sum_threshold(scaled, bad, level) | sum_threshold(scaled.T, bad.T, level).T
            rows = rows.assign(flag=rows["flag"].to_numpy() | hits[ti, ci])
        return rows

    return df.groupBy(*plane).applyInPandas(work, df.schema)


def high_passed(df: DataFrame, sigma_time: float = 2.5, sigma_chan: float = 5.0, plane: list[str] = PLANE, value: str = "amp") -> DataFrame:
    """Add ``residual``: the value minus the plane smoothed by Gaussian weights over unflagged samples."""
    importable(df.sparkSession)

    def kernel(n: int, sigma: float) -> np.ndarray:
        d = np.subtract.outer(np.arange(n), np.arange(n))
        return np.exp(-(d**2) / (2 * sigma**2))

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        values, ti, ci = _matrix(rows, value)
        mask, _, _ = _matrix(rows.assign(_f=rows["flag"].astype(float)), "_f")
        good = np.isfinite(values) & (mask == 0)
        a, b = kernel(values.shape[0], sigma_time), kernel(values.shape[1], sigma_chan)
        weight = a @ good @ b
        smooth = np.where(weight > 1e-12, (a @ np.where(good, values, 0.0) @ b) / np.maximum(weight, 1e-12), 0.0)
        return rows.assign(residual=(values - smooth)[ti, ci])

    from pyspark.sql import types as T

    return df.groupBy(*plane).applyInPandas(work, T.StructType([*df.schema.fields, T.StructField("residual", T.DoubleType())]))


def rms_threshold(df: DataFrame, axis: str, level: float, plane: list[str] = PLANE, value: str = "amp") -> DataFrame:
    """R2 (axis scan), R3 (axis chan): flag the times or channels whose rms leaves mean +- level * std of all of the plane.

    Mean and deviation are added in the order of the axis, so that flags do not change with the partitions where all have about
    one rms. A plane's task holds a row for each of its times or channels.
    """
    good = df.where(~F.col("flag"))
    rms = good.groupBy(*plane, axis).agg(F.sqrt(F.avg(F.col(value) * F.col(value))).alias("_rms"))
    whole = Window.partitionBy(*plane).orderBy(axis).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    far = rms.withColumns({"_m": F.avg("_rms").over(whole), "_s": F.stddev_pop("_rms").over(whole)})
    hits = far.where(F.abs(F.col("_rms") - F.col("_m")) > level * F.col("_s")).select(*plane, axis, F.lit(True).alias("_hit"))
    return df.join(hits, [*plane, axis], "left").withColumn("flag", F.col("flag") | F.coalesce("_hit", F.lit(False))).select(*df.columns)


def rank_operator(df: DataFrame, axis: str, level: float = 0.2, plane: list[str] = PLANE) -> DataFrame:
    """Scale-invariant rank operator along an axis: a sample is flagged if it lies in an interval of which at least
    1 - level is flagged.

    With w = flag - (1 - level) and its running sums, the best interval around a sample ends at the largest sum from there
    on and begins after the smallest before.
    """
    other = "chan" if axis == "scan" else "scan"
    w = Window.partitionBy(*plane, other).orderBy(axis)
    weight = F.when(F.col("flag"), F.lit(float(level))).otherwise(F.lit(float(level) - 1.0))
    upto = df.withColumn("_w", weight).withColumn("_c", F.round(F.sum("_w").over(w.rowsBetween(Window.unboundedPreceding, 0)), 9))
    before = F.least(F.lit(0.0), F.coalesce(F.min("_c").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    down = Window.partitionBy(*plane, other).orderBy(F.desc(axis)).rowsBetween(Window.unboundedPreceding, 0)  # from the other end, so linear
    after = F.max("_c").over(down)
    return upto.withColumn("flag", after - before >= 0).drop("_w", "_c")


def with_missing_flagged(df: DataFrame, value: str = "amp") -> DataFrame:
    """Flag samples that are null or not a number."""
    return df.withColumn("flag", F.col("flag") | F.col(value).isNull() | F.coalesce(F.isnan(value), F.lit(False)))


def flag_statistics(df: DataFrame) -> DataFrame:
    """Flagged and all samples by time, by channel and by baseline, in one pass."""
    keys = ("scan", "chan", "ant1", "ant2")
    sets = df.groupingSets([["scan"], ["chan"], ["ant1", "ant2"]], *keys)
    return sets.agg(F.count_if("flag").alias("flagged"), F.count("*").alias("total"))


def flagged(df: DataFrame, base: float = 4.0, step: float = 4.0, rounds: int = 2, rank: float = 0.2, plane: list[str] = PLANE) -> DataFrame:
    """The whole schedule on amplitudes ``amp``: rounds of SumThreshold, rms thresholds and high-pass filter at falling
    levels, a last SumThreshold, then the rank operator in both directions. Flags of the input stay."""
    now = with_missing_flagged(df).withColumn("_value", F.col("amp"))
    for k in range(rounds - 1, 0, -1):
        factor = step**k
        now = sum_thresholded(now, base * factor, plane, "_value")
        now = rms_threshold(rms_threshold(now, "scan", 3.5, plane, "_value"), "chan", 3.0 * factor, plane, "_value")
        now = high_passed(now.drop("residual"), plane=plane, value="amp").withColumn("_value", F.col("residual"))
    now = sum_thresholded(now, base, plane, "_value")
    now = rank_operator(rank_operator(now, "scan", rank, plane), "chan", rank, plane)
    return rms_threshold(now, "scan", 4.0, plane, "amp").select(*df.columns)
