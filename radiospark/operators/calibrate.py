"""Gains and their application, averaging and differencing of visibilities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import amp, conj, inverse, over, times
from ..functions.sky import C_M_S, direction_cosines

CELL = ["scan", "ant1", "ant2", "chan"]


def pol_of(corr: Column | str = "corr") -> tuple[Column, Column]:
    """Polarisations (first, second antenna) of a correlation 0..3."""
    return F.expr(f"cast({corr} as int) div 2"), F.expr(f"cast({corr} as int) % 2")


def inverse_gains(gains: DataFrame) -> DataFrame:
    """Every gain g replaced by 1/g; null for zero."""
    re, im = inverse((F.col("gr"), F.col("gi")))
    return gains.withColumns({"gr": re, "gi": im})


def inverse_delays(delays: DataFrame) -> DataFrame:
    return delays.withColumn("delay_ns", -F.col("delay_ns"))


def with_gains(vis: DataFrame, gains: DataFrame, columns: tuple[str, ...] = ("gr", "gi", "flag"), by: tuple[str, ...] = ()) -> DataFrame:
    """``vis`` with the gains of both antennas (of equal ``by``) as g1_* and g2_*; null where there is none."""
    out = vis.withColumn("_p", F.expr("cast(corr as int) div 2")).withColumn("_q", F.expr("cast(corr as int) % 2"))
    for k, ant, pol in ((1, "ant1", "_p"), (2, "ant2", "_q")):
        side = gains.select(*by, F.col("ant").alias(ant), "chan", F.col("pol").alias(pol), *(F.col(c).alias(f"g{k}_{c}") for c in columns))
        out = out.join(side, [*by, ant, "chan", pol], "left")
    return out.drop("_p", "_q")


def apply_bandpass(vis: DataFrame, gains: DataFrame, cross_only: bool = False, by: tuple[str, ...] = ()) -> DataFrame:
    """V / (g1 * conj(g2)) for each element, with the gains of equal ``by``; null where a gain is missing or zero. Flags are
    ignored."""
    vis = vis.where("ant1 != ant2") if cross_only else vis
    both = with_gains(vis, gains, ("gr", "gi"), by)
    product = times((F.col("g1_gr"), F.col("g1_gi")), conj((F.col("g2_gr"), F.col("g2_gi"))))
    re, im = over((F.col("re"), F.col("im")), product)
    return both.withColumns({"re": re, "im": im}).select(*vis.columns)


def any_corr_flagged(vis: DataFrame) -> Column:
    """Whether any correlation of the sample's baseline and channel is flagged."""
    return F.max("flag").over(Window.partitionBy(*CELL))


def apply_bandpass_flagged(vis: DataFrame, gains: DataFrame | None = None, use_flags: bool = True, by: tuple[str, ...] = ()) -> DataFrame:
    """Cross baselines with all correlations of a cell null if one is flagged, and null where a gain is flagged or missing.

    Without gains the data stay as they are but for the flags.
    """
    vis = vis.where("ant1 != ant2")
    out = vis.withColumn("_bad", any_corr_flagged(vis)) if use_flags else vis.withColumn("_bad", F.lit(False))
    out = out.withColumns({c: F.when(~F.col("_bad"), F.col(c)) for c in ("re", "im")}).drop("_bad")
    if gains is None:
        return out
    usable = gains.withColumns({c: F.when(~F.coalesce("flag", F.lit(False)), F.col(c)) for c in ("gr", "gi")})
    return apply_bandpass(out, usable, by=by)


def solve_gain_scale(target: DataFrame, to_scale: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, ant, chan, pol, scale): sqrt(target / to_scale) of the autocorrelations XX and YY; 1 where either is flagged."""
    side = lambda df, name: df.where("ant1 = ant2 and corr in (0, 3)").select(*by, F.col("ant1").alias("ant"), "chan", F.expr("cast(corr as int) div 2").cast("int").alias("pol"), F.col("re").alias(name), F.col("flag").alias(f"{name}_flag"))
    both = side(target, "t").join(side(to_scale, "s"), [*by, "ant", "chan", "pol"])
    return both.select(*by, "ant", "chan", "pol", F.when(F.col("t_flag") | F.col("s_flag"), 1.0).otherwise(F.sqrt(F.abs(F.try_divide("t", "s")))).alias("scale"))


def apply_gain_scale(vis: DataFrame, scale: DataFrame, by: tuple[str, ...] = (), lenient: bool = False) -> DataFrame:
    """V * s1 * s2; where an antenna of the data has no scale it raises, or leaves the data as they are if ``lenient``."""
    both = with_gains(vis, scale, ("scale",), by)
    known = F.col("g1_scale").isNotNull() & F.col("g2_scale").isNotNull()
    factor = F.when(known, F.col("g1_scale") * F.col("g2_scale")).otherwise(F.lit(1.0) if lenient else F.raise_error(F.lit("the scales do not cover the data")).cast("double"))
    return both.withColumns({c: F.col(c) * factor for c in ("re", "im")}).select(*vis.columns)


def difference(late: DataFrame, early: DataFrame) -> DataFrame:
    """late - early of samples with equal baseline, channel and correlation; flags are joined by OR."""
    keys = ["ant1", "ant2", "chan", "corr"]
    a, b = (df.select(*keys, F.col("re").alias(f"{n}_re"), F.col("im").alias(f"{n}_im"), F.col("flag").alias(f"{n}_flag")) for df, n in ((late, "l"), (early, "e")))
    return a.join(b, keys).select(*keys, (F.col("l_re") - F.col("e_re")).alias("re"), (F.col("l_im") - F.col("e_im")).alias("im"), (F.col("l_flag") | F.col("e_flag")).alias("flag"))


def average_sets(vis: DataFrame, denominator: str = "all") -> DataFrame:
    """Mean over scans of each sample; 'all' divides by the number of scans whether or not they hold the sample."""
    keys = ["ant1", "ant2", "chan", "corr"]
    summed = vis.groupBy(*keys).agg(F.sum("re").alias("re"), F.sum("im").alias("im"), F.count("*").alias("n"))
    if denominator == "all":
        every = vis.agg(F.count_distinct("scan").alias("of"))
        summed = summed.join(F.broadcast(every), how="inner")  # one row
    else:
        summed = summed.withColumn("of", F.col("n"))
    return summed.select(*keys, (F.col("re") / F.col("of")).alias("re"), (F.col("im") / F.col("of")).alias("im"), "n")


def bin_channels(vis: DataFrame, width: int = 4) -> DataFrame:
    """Mean of the unflagged samples of ``width`` channels; flagged (and null) if all are."""
    good = ~F.col("flag")
    return vis.groupBy("scan", "ant1", "ant2", F.expr(f"chan div {width}").alias("chan"), "corr").agg(
        F.avg(F.when(good, F.col("re"))).alias("re"), F.avg(F.when(good, F.col("im"))).alias("im"), F.bool_and("flag").alias("flag")
    )


def bin_gains(gains: DataFrame, width: int = 4) -> DataFrame:
    """Mean of the unflagged gains of ``width`` channels."""
    good = ~F.col("flag")
    return gains.groupBy("ant", F.expr(f"chan div {width}").alias("chan"), "pol").agg(F.avg(F.when(good, F.col("gr"))).alias("gr"), F.avg(F.when(good, F.col("gi"))).alias("gi"))


def phase_shift(vis: DataFrame, uvw: DataFrame, freqs: DataFrame, ra0: float, dec0: float, ra: float, dec: float) -> DataFrame:
    """Turn the phase centre from (ra0, dec0) to (ra, dec): V * exp(i * theta)."""
    l, m, n = direction_cosines(*(F.lit(float(x)) for x in (ra, dec, ra0, dec0)))  # noqa: E741
    both = vis.join(uvw, ["ant1", "ant2"]).join(freqs, "chan")
    theta = -2 * F.pi() * (F.col("u") * l + F.col("v") * m + F.col("w") * n) * F.col("f_hz") / C_M_S
    re, im = times((F.col("re"), F.col("im")), (F.cos(theta), F.sin(theta)))
    return both.withColumns({"re": re, "im": im}).select(*vis.columns)


def integrated(sets: list[DataFrame], keys: tuple[str, ...] = ("ant1", "ant2", "chan", "corr")) -> DataFrame:
    """The mean of each sample over all (re-phased) ``sets``, as one field."""
    every = sets[0].select(*keys, "re", "im")
    for more in sets[1:]:
        every = every.unionByName(more.select(*keys, "re", "im"))
    done = every.groupBy(*keys).agg(F.count("*").alias("n"), F.avg("re").alias("re"), F.avg("im").alias("im"))
    return done.select(F.lit(0).alias("field_id"), *keys, "n", "re", "im")


def stokes(vis: DataFrame, keys: tuple[str, ...] = ("scan", "chan")) -> DataFrame:
    """Unflagged means over cross baselines, then I = Re(XX + YY) / 2 and V = Im(XY - YX) / 2."""
    good = vis.where("ant1 != ant2 and not flag")
    part = lambda corr, c: F.avg(F.when(F.col("corr") == corr, F.col(c)))
    return good.groupBy(*keys).agg(((part(0, "re") + part(3, "re")) / 2).alias("i"), ((part(1, "im") - part(2, "im")) / 2).alias("v"))


def subtract_model(vis: DataFrame, model: DataFrame, gain: float = 1.0, add: bool = False, keys: tuple[str, ...] = (*CELL, "corr")) -> DataFrame:
    """V -/+ gain * model on equal ``keys``; a sample without model stays. Several models of a sample add up."""
    total = model.groupBy(*keys).agg(F.sum("re").alias("m_re"), F.sum("im").alias("m_im"))
    sign = gain if add else -gain
    out = vis.join(total, list(keys), "left")
    return out.withColumns({c: F.col(c) + sign * F.coalesce(f"m_{c}", F.lit(0.0)) for c in ("re", "im")}).select(*vis.columns)


def rearrange_model(vis: DataFrame, model: DataFrame, corr: int = 0) -> DataFrame:
    """The model scaled by (model / data) of one correlation of the same cell; null where the data are 0."""
    ratio = vis.where(F.col("corr") == corr).select(*CELL, F.col("re").alias("d_re"), F.col("im").alias("d_im"))
    base = model.where(F.col("corr") == corr).select(*CELL, F.col("re").alias("b_re"), F.col("im").alias("b_im"))
    both = vis.join(base, CELL).join(ratio, CELL)
    factor = over((F.col("b_re"), F.col("b_im")), (F.col("d_re"), F.col("d_im")))
    re, im = times((F.col("re"), F.col("im")), factor)
    return both.withColumns({"re": F.when(F.col("corr") == corr, F.col("b_re")).otherwise(re), "im": F.when(F.col("corr") == corr, F.col("b_im")).otherwise(im)}).select(*vis.columns)


def amplitude_correction(vis: DataFrame, ts: Column, n_ant: int, applied: Column | None = None) -> DataFrame:
    """Amplitudes / 4 before 2023-12-18 23h, / 16 until 2024-02-15 23h, none after; small arrays (48 antennas at most)
    alone, and once alone (``applied``)."""
    factor = F.when(ts < F.lit("2023-12-18 23:00:00").cast("timestamp_ntz"), 4.0).when(ts < F.lit("2024-02-15 23:00:00").cast("timestamp_ntz"), 16.0).otherwise(1.0)
    factor = F.when(F.lit(n_ant <= 48) & ~(applied if applied is not None else F.lit(False)), factor).otherwise(1.0)
    return vis.withColumns({c: F.col(c) / factor for c in ("re", "im")})


def swap_cross_hands(vis: DataFrame, swap: Column) -> DataFrame:
    """Correlations 2 and 3 exchanged where ``swap`` holds."""
    return vis.withColumn("corr", F.when(swap & F.col("corr").isin(2, 3), 5 - F.col("corr")).otherwise(F.col("corr")))


def amplitudes(vis: DataFrame) -> DataFrame:
    return vis.withColumn("amp", amp())
