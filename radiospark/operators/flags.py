"""Flag algebra and data quality of visibilities and gains (P*, J6-J8, S7-S11, A18-A28, A38)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import amp, decibel
from ..session import few
from .ordering import median_of_all

SAMPLE = ["scan", "ant1", "ant2", "chan", "corr"]


def merged_over(df: DataFrame, group: list[str]) -> DataFrame:
    """The OR of ``flag`` over all members of a group, written to each."""
    return df.withColumn("flag", F.max("flag").over(Window.partitionBy(*group)))


def merged_pair(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """The OR of two tables' flags on equal keys; a missing side counts as not flagged."""
    both = a.select(*keys, F.col("flag").alias("_a")).join(b.select(*keys, F.col("flag").alias("_b")), keys, "full")
    return both.select(*keys, (F.coalesce("_a", F.lit(False)) | F.coalesce("_b", F.lit(False))).alias("flag"))


def flag_antennas(vis: DataFrame, antennas: DataFrame) -> DataFrame:
    """Flag all samples of the antennas in ``antennas`` (ant); an empty list changes nothing."""
    out = vis
    for k in ("ant1", "ant2"):
        listed = antennas.select(F.col("ant").alias(k), F.lit(True).alias(f"_{k}")).distinct()
        out = out.join(listed, k, "left")
    return out.withColumn("flag", F.col("flag") | F.coalesce("_ant1", F.lit(False)) | F.coalesce("_ant2", F.lit(False))).select(*vis.columns)


def flag_baselines(vis: DataFrame, baselines: DataFrame) -> DataFrame:
    """Flag all samples of the baselines in ``baselines`` (ant1, ant2)."""
    listed = baselines.select("ant1", "ant2", F.lit(True).alias("_hit")).distinct()
    return vis.join(listed, ["ant1", "ant2"], "left").withColumn("flag", F.col("flag") | F.coalesce("_hit", F.lit(False))).select(*vis.columns)


def antenna_list(*lists: DataFrame) -> DataFrame:
    """One row with the sorted union of antennas, comma-joined."""
    every = lists[0].select("ant")
    for more in lists[1:]:
        every = every.union(more.select("ant"))
    return every.agg(F.concat_ws(",", F.transform(F.array_sort(F.collect_set("ant")), lambda a: a.cast("string"))).alias("antennas"))


def baseline_lines(baselines: DataFrame) -> DataFrame:
    """S8: 'a&b' for each baseline."""
    return baselines.select(F.concat_ws("&", F.col("ant1").cast("string"), F.col("ant2").cast("string")).alias("line"))


def parse_baselines(lines: DataFrame) -> DataFrame:
    part = F.split("line", "&")
    return lines.select(part[0].cast("bigint").alias("ant1"), part[1].cast("bigint").alias("ant2"))


def channel_lines(channels: DataFrame, band: int) -> DataFrame:
    """S9: 'bb:ccc' for each channel."""
    return channels.select(F.format_string("%02d:%03d", F.lit(band), F.col("chan").cast("int")).alias("line"))


def place_of(n_ant: int, n_chan: int, n_corr: int = 4) -> Column:
    """The place of a sample (ant1 <= ant2, chan, corr) in the packed flags of an array: baselines row by row of the upper
    triangle, then channels, then correlations. A closed form, so no samples are ordered."""
    baseline = F.expr(f"ant1 * {n_ant} - (ant1 * (ant1 - 1)) div 2 + (ant2 - ant1)")
    return ((baseline * n_chan + F.col("chan")) * n_corr + F.col("corr")).cast("bigint")


def places(n_ant: int, n_chan: int, n_corr: int = 4) -> int:
    """The number of flags of a scan."""
    return n_ant * (n_ant + 1) // 2 * n_chan * n_corr


def pack_flags(df: DataFrame, obs: str, position: str = "pos", flag: str = "flag") -> DataFrame:
    """(obs, byte_idx, byte): eight flags a byte, the first in the highest bit; places without a sample are not flagged.

    A byte is a partial aggregate of its own samples.
    """
    bit = F.when(F.col(flag), F.expr(f"shiftleft(1, cast(7 - {position} % 8 as int))")).otherwise(0)
    return df.groupBy(obs, F.expr(f"{position} div 8").alias("byte_idx")).agg(F.bit_or(bit).cast("bigint").alias("byte"))


def unpack_flags(packed: DataFrame, obs: str, length: int | DataFrame | None = None) -> DataFrame:
    """(obs, pos, flag) of packed flags, cut to ``length``, or to each observation's own (obs, n); too few bytes raise."""
    out = packed.select(obs, "byte_idx", "byte", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("k"))
    out = out.select(obs, (F.col("byte_idx") * 8 + F.col("k")).alias("pos"), (F.expr("shiftright(byte, cast(7 - k as int)) & 1") == 1).alias("flag"))
    if length is None:
        return out
    held = packed.groupBy(obs).agg(((F.max("byte_idx") + 1) * 8).alias("_held"))
    sizes = length.select(obs, F.col("n").alias("_n")) if isinstance(length, DataFrame) else held.select(obs, F.lit(length).alias("_n"))
    if not sizes.join(held, obs, "left").where("coalesce(_held, 0) < _n").isEmpty():
        raise ValueError("there are fewer flags than asked for")
    return out.join(sizes, obs).where("pos < _n").drop("_n")


def restored_flags(samples: DataFrame, packed: DataFrame, obs: str, position: str = "pos") -> DataFrame:
    """``samples`` with the ``flag`` of their place in the packed flags; a byte that is absent raises.

    Samples meet their byte by its number; nothing is unpacked but what they ask for.
    """
    bytes_ = packed.select(obs, "byte_idx", F.col("byte").alias("_byte"))
    both = samples.drop("flag").withColumn("byte_idx", F.expr(f"{position} div 8")).join(bytes_, [obs, "byte_idx"], "left")
    bit = F.expr(f"shiftright(_byte, cast(7 - {position} % 8 as int)) & 1") == 1
    lost = F.raise_error(F.lit("there are fewer flags than samples")).cast("boolean")
    return both.withColumn("flag", F.when(F.col("_byte").isNull(), lost).otherwise(bit)).drop("byte_idx", "_byte")


def occupancy(vis: DataFrame) -> DataFrame:
    """Flagged samples and all samples by channel and correlation."""
    return vis.groupBy("chan", "corr").agg(F.count_if("flag").alias("flagged"), F.count("*").alias("total"))


def zero_fraction(vis: DataFrame, keys: list[str], scale: int = 100) -> DataFrame:
    """Whole per cent (or per mille) of samples that are exactly zero."""
    zeros = F.count_if((F.col("re") == 0) & (F.col("im") == 0))
    return vis.groupBy(*keys).agg(F.floor(zeros * float(scale) / F.count("*")).cast("bigint").alias("zero_share"), zeros.alias("zeros"))


def flagged_solutions(gains: DataFrame) -> DataFrame:
    """Flagged and all solutions by channel."""
    return gains.groupBy("chan").agg(F.count_if("flag").alias("flagged"), F.count("*").alias("total"))


def flag_bad_solutions(gains: DataFrame, share: float = 0.01) -> DataFrame:
    """Flag gains whose amplitude is below a share of the median amplitude of all."""
    middle = median_of_all(gains, amp("gr", "gi"), "_middle")
    out = gains.join(F.broadcast(middle))  # one row
    return out.withColumn("flag", F.col("flag") | (amp("gr", "gi") < share * F.col("_middle"))).drop("_middle")


def bad_baselines(vis: DataFrame, k: float = 3.0, share: float = 0.25, n_chan: int = 109) -> DataFrame:
    """(scan, ant1, ant2, hits): baselines of which many channels exceed mean + k std in XY or YX."""
    good = vis.where("ant1 != ant2 and not flag and corr in (1, 2)").withColumn("amp", amp())
    cut = good.groupBy("scan").agg((F.avg("amp") + k * F.stddev_pop("amp")).alias("cut"))
    hits = good.join(few(cut, "cuts"), "scan").groupBy("scan", "ant1", "ant2").agg(F.count_distinct(F.when(F.col("amp") > F.col("cut"), F.col("chan"))).alias("hits"))
    return hits.where(F.col("hits") / float(n_chan) > share)


def template_scores(vis: DataFrame, thresh: float = 7.0) -> DataFrame:
    """(scan, corr, ant1, score, bad): deviation of each autocorrelation spectrum from the scan's median template.

    Flagged channels count as no deviation; templates include flagged data; zero templates say nothing.
    """
    autos = vis.where("ant1 = ant2").withColumn("amp", amp())
    template = autos.groupBy("scan", "chan", "corr").agg(F.median("amp").alias("t"))
    off = F.when(F.col("flag"), 0.0).otherwise(F.abs(F.try_divide(F.col("amp") - F.col("t"), F.nullif("t", F.lit(0.0)))))
    mean = autos.join(template, ["scan", "chan", "corr"]).groupBy("scan", "corr", "ant1").agg(F.avg(off).alias("off"))
    middle = mean.groupBy("scan", "corr").agg(F.median("off").alias("middle"))
    out = mean.join(middle, ["scan", "corr"]).withColumn("score", F.try_divide("off", "middle"))
    return out.select("scan", "corr", "ant1", "score", (F.col("score") > thresh).alias("bad"))


def dead_antennas(vis: DataFrame, outriggers: tuple[int, ...], share: float = 0.1, value: Column | None = None) -> DataFrame:
    """Antennas whose autocorrelation power is below a share of their group's mean, in XX or YY."""
    value = F.col("re") if value is None else value
    power = vis.where("ant1 = ant2 and corr in (0, 3)").groupBy("scan", "corr", F.col("ant1").alias("ant")).agg(F.sum(value).alias("power"))
    power = power.withColumn("outer", F.col("ant").isin(*outriggers))
    means = power.groupBy("scan", "corr", "outer").agg(F.avg("power").alias("mean"))
    low = power.join(means, ["scan", "corr", "outer"]).withColumn("low", F.col("power") < share * F.col("mean"))
    return low.groupBy("scan", "ant").agg(F.bool_or("low").alias("dead")).where("dead").select("scan", "ant")


def heavily_flagged_rows(vis: DataFrame, times: float = 10.0, most: float = 0.1) -> DataFrame:
    """Rows (scan, ant1, corr) with many more flagged channels than the scan's median row; scans whose median is
    ``most`` of the channels or more have none."""
    rows = vis.where("ant1 = ant2").groupBy("scan", "ant1", "corr").agg(F.count_if("flag").alias("flagged"), F.count("*").alias("n"))
    middle = rows.groupBy("scan").agg(F.median("flagged").alias("middle"), F.max("n").alias("n_chan"))
    out = rows.join(middle, "scan")
    return out.where((F.col("middle") < F.floor(F.col("n_chan") * most)) & (F.col("flagged") > times * F.col("middle"))).select("scan", "ant1", "corr", "flagged")


def gain_quality(gains: DataFrame, k_amp: float = 4.0, k_snr: float = 3.0) -> DataFrame:
    """(kind, id): antennas whose median amplitude lies outside median +- k std of all antennas, and channels whose
    median signal-to-noise lies below median - k std of all channels, in either polarisation."""

    def outside(key: str, value: Column, k: float, both: bool) -> DataFrame:
        by = gains.groupBy("pol", F.col(key).alias("id")).agg(F.median(value).alias("m"))
        every = by.groupBy("pol").agg(F.median("m").alias("mid"), F.stddev_pop("m").alias("s"))
        far = F.col("m") < F.col("mid") - k * F.col("s")
        if both:
            far = far | (F.col("m") > F.col("mid") + k * F.col("s"))
        return by.join(every, "pol").where(far).select(F.lit(key).alias("kind"), "id").distinct()

    return outside("ant", amp("gr", "gi"), k_amp, True).union(outside("chan", F.col("snr"), k_snr, False))


def quality_lines(bad: DataFrame) -> DataFrame:
    """One report line for each kind: 'bad <kind>: 1,2,3'."""
    ids = F.concat_ws(",", F.transform(F.array_sort(F.collect_list("id")), lambda x: x.cast("string")))
    return bad.groupBy("kind").agg(ids.alias("ids")).select(F.concat(F.lit("bad "), "kind", F.lit(": "), "ids").alias("line"))


def parse_quality_lines(lines: DataFrame, kind: str) -> DataFrame:
    """The ids of a report line."""
    own = lines.where(F.col("line").startswith(f"bad {kind}: ")).select(F.regexp_extract("line", ": (.*)$", 1).alias("ids"))
    return own.select(F.explode(F.split("ids", ",")).alias("id")).select(F.trim("id").cast("bigint").alias("id"))


def mirrored(df: DataFrame, by: list[str], axis: str, half: int) -> DataFrame:
    """``df`` with its edges mirrored (half-sample) by ``half`` places, ``_real`` telling the rows that were there."""
    last = F.max(axis).over(Window.partitionBy(*by))
    at, there = F.col(axis), lambda place, real: F.struct(place.alias("place"), F.lit(real).alias("real"))
    places = F.array(there(at, True), F.when(at < half, there(-at - 1, False)), F.when(at > F.col("_n") - half, there(2 * F.col("_n") - at + 1, False)))
    sent = df.withColumn("_n", last).withColumn("_at", F.explode(F.filter(places, lambda p: p.isNotNull())))
    return sent.withColumns({axis: F.col("_at.place"), "_real": F.col("_at.real")}).drop("_n", "_at")


def running(df: DataFrame, by: list[str], axis: str, value: str, half: int, kind: str) -> DataFrame:
    """Add ``value_kind``: running median or population std over 2 * half + 1 places, edges mirrored."""
    frame = Window.partitionBy(*by).orderBy(axis).rowsBetween(-half, half)
    if kind == "std":
        made = F.stddev_pop(value).over(frame)
    else:
        held = F.array_sort(F.collect_list(value).over(frame))
        made = F.when(F.size(held) > 0, (F.get(held, F.floor((F.size(held) - 1) / 2.0).cast("int")) + F.get(held, F.floor(F.size(held) / 2.0).cast("int"))) / 2)
    return mirrored(df, by, axis, half).withColumn(f"{value}_{kind}", made).where("_real").drop("_real")


def bad_channels(vis: DataFrame, half: int = 12, levels: tuple[float, ...] = (10.0, 6.0, 6.0, 10.0), crosshand: bool = False, mean_times: float = 100.0) -> DataFrame:
    """(scan, chan) whose largest amplitude leaves the running median, or whose mean is far above the median."""
    good = vis.where("ant1 != ant2 and not flag").withColumn("amp", amp())
    by = ["scan", "corr"]
    stat = good.groupBy(*by, "chan").agg(F.max("amp").alias("top"), F.avg("amp").alias("mean"))
    stat = stat.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy("chan")) - 1)
    stat = running(stat, by, "place", "top", half, "median").withColumn("norm", F.try_divide("top", F.nullif("top_median", F.lit(0.0))))
    stat = running(running(stat, by, "place", "norm", half, "std"), by, "place", "mean", half, "std")
    whole = stat.groupBy(*by).agg(F.min("norm_std").alias("least"), F.median("mean").alias("middle"), F.min("mean_std").alias("least_mean"))
    level = F.element_at(F.array(*map(F.lit, levels)), F.col("corr").cast("int") + 1)
    far = (F.abs(F.col("norm") - 1) > level * F.col("least")) | (F.col("mean") > F.col("middle") + mean_times * F.col("least_mean"))
    out = stat.join(whole, by).where(far)
    return (out if crosshand else out.where("corr in (0, 3)")).select("scan", "chan").distinct()


def bad_antennas_calibrated(vis: DataFrame, outriggers: tuple[int, ...], thresh: float = 4.0, mode: str = "std") -> DataFrame:
    """Antennas whose autocorrelations stand out of their group (core or outlying) in XX or YY.

    'std' takes the scatter over scans of the ratio to the antennas' median series, 'mean' the mean over scans.
    Outliers of 3 std are left out before median and std are taken again.
    """
    autos = vis.where("ant1 = ant2 and not flag and corr in (0, 3)").withColumn("amp", amp())
    series = autos.groupBy("scan", F.col("ant1").alias("ant"), "corr").agg(F.avg("amp").alias("x"))
    if mode == "std":
        middle = series.groupBy("scan", "corr").agg(F.median("x").alias("m"))
        stat = series.join(middle, ["scan", "corr"]).groupBy("ant", "corr").agg(F.stddev_pop(F.try_divide("x", "m")).alias("s"))
    else:
        stat = series.groupBy("ant", "corr").agg(F.avg("x").alias("s"))
    stat = stat.withColumn("outer", F.col("ant").isin(*outriggers))
    group = ["outer", "corr"]
    first = stat.groupBy(*group).agg(F.median("s").alias("m"), F.stddev_pop("s").alias("d"))
    near = stat.join(first, group).groupBy("ant").agg(F.bool_or(F.col("s") < F.col("m") + 3 * F.col("d")).alias("near")).where("near")
    again = stat.join(near.select("ant"), "ant", "left_semi").groupBy(*group).agg(F.median("s").alias("m"), F.stddev_pop("s").alias("d"))
    again = again.join(again.groupBy("outer").agg(F.min("d").alias("least")), "outer")
    return stat.join(again, group).where(F.col("s") > F.col("m") + thresh * F.col("least")).select("ant").distinct()


def bad_antennas_raw(vis: DataFrame, reference: float = 100.0, thresh: float | None = None) -> DataFrame:
    """Antennas whose median level (dB) lies outside [median - 2 std, median + std] of all, or whose spectrum scatters
    around the median spectrum of the others, in XX or YY."""
    autos = vis.where("ant1 = ant2 and corr in (0, 3)").withColumn("db", decibel(amp(), reference))
    auto = autos.groupBy(F.col("ant1").alias("ant"), "scan", "chan", "corr").agg(F.avg("db").alias("db"))
    mid = auto.groupBy("ant", "corr").agg(F.median("db").alias("m"))
    every = mid.groupBy("corr").agg(F.median("m").alias("mm"), F.stddev_pop("m").alias("s"))
    first = mid.join(every, "corr").where((F.col("m") > F.col("mm") + F.col("s")) | (F.col("m") < F.col("mm") - 2 * F.col("s")) | F.col("m").isNull()).select("ant").distinct()
    rest = auto.join(first, "ant", "left_anti")
    spectrum = rest.groupBy("scan", "chan", "corr").agg(F.median("db").alias("t"))
    if thresh is None:
        thresh = 1.0 if auto.select("ant").distinct().count() > 256 else 0.02
    scatter = rest.join(spectrum, ["scan", "chan", "corr"]).groupBy("ant", "corr").agg(F.stddev_pop(F.try_divide("db", F.nullif("t", F.lit(0.0)))).alias("s"))
    return first.union(scatter.where(F.col("s") > thresh).select("ant")).distinct()
