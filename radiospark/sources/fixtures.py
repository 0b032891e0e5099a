"""The canonical tables as projections of the driver tables: visibilities, gains, images, timelines, catalogues.

Every projection is an ordinary DataFrame over the whole driver table; keys are explicit and unique.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import exact_mean
from ..session import table

N_CHAN, N_ANT = 24, 16
#: Antennas of the outlying group of the fixture array.
OUTRIGGERS = (12, 13, 14, 15)
FLAGGED_ANTENNAS = (3, 7, 12)
FLAGGED_BASELINES = ((0, 1), (2, 5), (4, 4))
#: Calibrator name, right ascension, declination (degrees), flux (Jy) and spectral index at 80 MHz.
CALIBRATORS = (
    ("CasA", 350.85, 58.815, 16530.0, -0.72),
    ("CygA", 299.868152625, 40.7339158333, 16300.0, -0.58),
    ("TauA", 83.6330833333, 22.0145, 1770.0, -0.27),
    ("VirA", 187.7059307500, 12.3911233056, 2400.0, -0.86),
)


def vis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(scan, ant1, ant2, chan, corr, re, im, flag), ant1 <= ant2."""
    a, b = F.col("l_suppkey") % N_ANT, F.col("l_partkey") % N_ANT
    keys = {
        "scan": (F.year("l_shipdate") - 1995).cast("bigint"), "ant1": F.least(a, b), "ant2": F.greatest(a, b), "chan": F.col("l_orderkey") % N_CHAN, "corr": F.col("l_linenumber") % 4,
    }
    return (
        table(spark, sf_dir, "lineitem").groupBy(*(c.alias(k) for k, c in keys.items()))
        .agg(exact_mean(F.col("l_quantity") - 25).alias("re"), exact_mean(100 * F.col("l_discount") - 5).alias("im"), (F.max(F.when(F.col("l_tax") >= 0.07, 1).otherwise(0)) == 1).alias("flag"))
    )


def gains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ant, chan, pol, gr, gi, snr, flag); some cells are absent."""
    keys = {"ant": F.col("p_partkey") % N_ANT, "chan": F.floor(F.col("p_partkey") / 16.0).cast("bigint") % N_CHAN, "pol": F.col("p_size") % 2}
    return (
        table(spark, sf_dir, "part").groupBy(*(c.alias(k) for k, c in keys.items()))
        .agg(F.avg(1 + F.col("p_retailprice") / 1000.0).alias("gr"), F.avg(F.col("p_size") / 50.0).alias("gi"), F.avg(F.col("p_retailprice") / 100.0).alias("snr"), (F.max(F.when(F.col("p_size") == 50, 1).otherwise(0)) == 1).alias("flag"))
    )


def delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ant, pol, epoch, delay_ns)."""
    keys = {"ant": F.floor(F.col("s_suppkey") / 2.0).cast("bigint") % 8, "pol": F.col("s_nationkey") % 2, "epoch": F.col("s_suppkey") % 2}
    return table(spark, sf_dir, "supplier").groupBy(*(c.alias(k) for k, c in keys.items())).agg(F.avg("s_acctbal").alias("delay_ns"))


def uvw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ant1, ant2, u, v, w): a synthetic geometry of the antennas in use."""
    ids = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % N_ANT).alias("id")).distinct()
    a, b = ids.select(F.col("id").alias("ant1")), F.broadcast(ids.select(F.col("id").alias("ant2")))  # N_ANT rows at most
    i, j = F.col("ant1"), F.col("ant2")
    return a.join(b, i <= j).select("ant1", "ant2", ((j - i) * 7.0).alias("u"), ((j * j - i * i) * 0.5).alias("v"), ((j % 3 - i % 3) * 1.5).alias("w"))


def freqs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(chan, f_hz)."""
    return table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") % N_CHAN).alias("chan")).distinct().select("chan", (55.0e6 + F.col("chan") * 23926.0).alias("f_hz"))


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(image_id, x, y, val): 8 x 8 planes."""
    flat = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("image_id"), F.posexplode("embedding").alias("p", "v"))
    return flat.select("image_id", (F.col("p") % 8).alias("x"), F.expr("cast(p div 8 as int)").alias("y"), F.col("v").cast("double").alias("val"))


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(image_id, band, seq): the place of each image in the time order of its band."""
    from pyspark.sql import Window

    by = Window.partitionBy("label").orderBy("vec_id")
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("image_id"), F.col("label").alias("band"), (F.row_number().over(by) - 1).cast("bigint").alias("seq"))


def scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ts, spw, scan_id)."""
    return table(spark, sf_dir, "events").groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"), (F.col("user_id") % 16).alias("spw")).agg(F.min("event_id").alias("scan_id"))


def tasklog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(task_id, state, name, runtime, finished, payload)."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("task_id"), F.col("event_type").alias("state"), F.col("user_id").alias("name"), F.col("value").alias("runtime"), F.col("ts").alias("finished"), F.col("props").alias("payload")
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, ra, dec, peak_flux, local_rms): candidates."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("id"), ((key * 7919) % 3600 / 10.0).alias("ra"), ((key * 104729) % 1700 / 10.0 - 85.0).alias("dec"),
        (F.abs("c_acctbal") + 1.0).alias("peak_flux"), (50.0 + F.col("c_nationkey") * 20.0).alias("local_rms"),
    )


def persist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pid, ra, dec, flux): known sources."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        key.alias("pid"), ((key * 7919) % 3600 / 10.0).alias("ra"), ((key * 104729) % 1700 / 10.0 - 85.0).alias("dec"), (F.abs("s_acctbal") + 1.0).alias("flux")
    )


def flaglist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(date, corr_num, source): dated antenna flags."""
    return table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date"), (F.col("o_custkey") % 16).alias("corr_num"), F.col("o_orderpriority").alias("source"))


def calibrators(spark: SparkSession) -> DataFrame:
    """(label, ra, dec, flux, alpha): the four bright calibrators."""
    return spark.createDataFrame(list(CALIBRATORS), "label string, ra double, dec double, flux double, alpha double")


def horizon(spark: SparkSession) -> DataFrame:
    """(az_i, horizon): the altitude of the mountains for each whole degree of azimuth, 0 to 360."""
    return spark.range(361).select(F.col("id").cast("int").alias("az_i"), (5 + 5 * F.sin(F.radians("id"))).alias("horizon"))


def antennas(spark: SparkSession) -> DataFrame:
    """(ant, name, outrigger): the antenna of each input of the correlator."""
    name = F.format_string("LWA-%03d", F.col("id") + 1)
    return spark.range(N_ANT).select(F.col("id").alias("ant"), name.alias("name"), F.col("id").isin(*OUTRIGGERS).alias("outrigger"))
