"""Means that do not depend on the order of rows: the visibilities' own, and what hangs on their being zero or equal."""

import datetime
import math
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from radiospark.functions.numbers import exact_mean
from radiospark.operators import rfi
from radiospark.plans import registry
from radiospark.session import scratch_path

COLUMNS = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double, l_shipdate timestamp_ntz"
#: The same discounts twice. 100 * 0.07 - 5 is 2 + 2^-50, which is lost where it meets 20, and kept beside small sums.
LOSSY = [0.1] * 4 + [0.07] + [0.0] * 4 + [0.03]
KEPT = [0.07, 0.03] + [0.1, 0.0] * 4


def sample(ant1, ant2, chan, discounts, quantity=25.0, corr=0):
    day = datetime.datetime(1995, 6, 1)
    return [(chan, ant2, ant1, corr, quantity, x, 0.0, day) for x in discounts]


def query(spark, name, rows):
    base = scratch_path(spark, "lineitem")
    spark.createDataFrame(rows, COLUMNS).coalesce(1).write.parquet(f"{base}/lineitem.parquet")
    return registry.queries()[name](spark, base).collect()


def exact(discounts):
    return sum(Fraction(100 * x - 5) for x in discounts) / len(discounts)


def test_exact_mean_against_fractions(spark):
    values = [m * s for k in range(400) for m in [(k * 7919 % 1013 + 1) * 2.0 ** -(k % 25)] for s in (1, -1)] + [2.0**-50, 0.1, -0.3]
    want = float(sum(map(Fraction, values)) / len(values))
    for parts, order in ((1, values), (1, values[::-1]), (7, sorted(values))):
        got = spark.createDataFrame([(v,) for v in order], "v double").repartition(parts).agg(exact_mean("v").alias("m")).first()["m"]
        assert math.isclose(got, want, rel_tol=1e-15) and want != 0
    cancelled = spark.createDataFrame([(v,) for v in values + [-v for v in values]], "v double").repartition(5)
    assert cancelled.agg(exact_mean("v").alias("m")).first()["m"] == 0


def test_exact_mean_of_odd_values(spark):
    cases = {"null": [None, None], "some": [None, 3.0, 4.0], "huge": [1e300, 2e300], "inf": [math.inf, 1.0], "nan": [math.nan, 1.0], "both": [math.inf, -math.inf], "large": [2.0**40, 1.0]}
    df = spark.createDataFrame([(k, v) for k, vs in cases.items() for v in vs], "k string, v double")
    got = {r["k"]: (r["a"], r["b"]) for r in df.groupBy("k").agg(exact_mean("v").alias("a"), F.avg("v").alias("b")).collect()}
    assert all(a == b or math.isnan(a) and math.isnan(b) for a, b in got.values()), got


@pytest.mark.parametrize("discounts", [LOSSY, KEPT, LOSSY[::-1]])
def test_zeros_are_counted_whatever_the_order(spark, discounts):
    assert exact(discounts) != 0 and exact([0.1, 0.0]) == 0
    got = query(spark, "a18_zero_fraction", sample(0, 1, 0, discounts) + sample(0, 1, 1, [0.1, 0.0]) + sample(0, 1, 2, [0.1]))
    assert [(r["scan"], r["zero_share"], r["zeros"]) for r in got] == [(0, 333, 1)]


@pytest.mark.parametrize("discounts", [LOSSY, KEPT, LOSSY[::-1]])
def test_raw_antennas_whatever_the_order(spark, discounts):
    """Five equal antennas, but one sample of the last is all but zero: its spectrum scatters, and has no gap there."""
    rows = [r for ant in range(5) for chan in range(4) for r in sample(ant, ant, chan, *((discounts,) if (ant, chan) == (4, 3) else ([0.05], 26.0)))]
    assert [r["ant"] for r in query(spark, "a25_bad_antennas_raw", rows)] == [4]


@pytest.mark.parametrize("discounts", [LOSSY, KEPT, LOSSY[::-1]])
def test_decibels_whatever_the_order(spark, discounts):
    """A sample that is all but zero counts in the mean of its channel; one that is zero does not."""
    rows = sample(2, 2, 0, discounts) + sample(2, 2, 0, [0.05], 26.0, 3) + sample(2, 2, 1, [0.1, 0.0]) + sample(2, 2, 1, [0.05], 26.0, 3) + sample(2, 2, 2, [0.05])
    got = {r["chan"]: r["db"] for r in query(spark, "a31_auto_decibels", rows)}
    faint = 10 * math.log10(abs(float(exact(discounts))) / 100)
    assert got == {0: pytest.approx((faint - 20) / 2, abs=2e-6), 1: -20.0, 2: None} and faint < -170


def test_snapshots_of_equal_channels_are_not_flagged(spark):
    """Four channels with the same discounts in other orders have one amplitude, which none of them leaves."""
    order = {0: KEPT, 1: KEPT, 2: KEPT, 3: LOSSY}
    got = query(spark, "k2_snapshot_chain", [r for chan, x in order.items() for r in sample(0, 1, chan, [*x, 0.06])])
    assert got and all(not r["flag"] and r["packed"] == 0 for r in got), got


def test_rms_threshold_whatever_the_partitions(spark):
    """Planes of equal channels hang on how their mean rounds: as SQL's window does, value by value."""
    planes = {(a, n): math.sqrt(a * 37 + n) for a in range(60) for n in (3, 6, 7, 8, 12)}
    want = set()
    for (a, n), r in planes.items():
        total = 0.0
        for _ in range(n):
            total += math.sqrt(r * r)
        if total / n != math.sqrt(r * r):
            want |= {(a, n, chan) for chan in range(n)}
    df = spark.createDataFrame([(a, n, 0, chan, r, False) for (a, n), r in planes.items() for chan in range(n)], "ant1 long, ant2 long, corr int, chan long, amp double, flag boolean")
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        for parts in (1, 3, 8):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            assert {(r["ant1"], r["ant2"], r["chan"]) for r in rfi.rms_threshold(df, "chan", 1.7).where("flag").collect()} == want
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
