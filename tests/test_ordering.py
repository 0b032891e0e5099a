"""Values carried in order, totals and medians of large groups, against plain loops."""

import bisect
import datetime
import random

import pytest
from pyspark.sql import functions as F

from radiospark.operators import images, ordering, rfi, timeline
from radiospark.session import input_bytes


def test_medians_of_large_groups(spark):
    rng = random.Random(1)
    inf = float("inf")
    draws = {
        "even": (900, lambda: rng.gauss(0, 1)), "ties": (801, lambda: 0.0 if rng.random() < 0.7 else rng.gauss(0, 1e-300)), "one": (1, lambda: 5.0),
        "far": (500, lambda: rng.choice([inf, -inf, 1.7e308, -1.7e308, 3.0, 4.0])), "few": (400, lambda: rng.choice([1.0, 2.0])), "wide": (701, lambda: 10 ** rng.uniform(-300, 300)), None: (300, rng.random),
    }
    rows = [(g, f()) for g, (n, f) in draws.items() for _ in range(n)] + [("even", None), ("even", float("nan")), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    held = {}
    for g, v in rows:
        if v is not None and v == v:
            held.setdefault(g, []).append(v)
    middle = lambda x: (sorted(x)[(len(x) - 1) // 2] + sorted(x)[len(x) // 2]) / 2
    for most in (1 << 18, 20):
        assert {r["g"]: r["m"] for r in ordering.medians(df, ["g"], F.col("v"), "m", most).collect()} == {g: middle(v) for g, v in held.items()}
    whole = [v for x in held.values() for v in x]
    assert [r["m"] for r in ordering.medians(df, [], F.col("v"), "m", 10).collect()] == [middle(whole)] == [r["m"] for r in ordering.median_of_all(df, F.col("v"), "m").collect()]
    assert [r["m"] for r in ordering.median_of_all(df.where("false"), F.col("v"), "m").collect()] == [None]


def test_noise_does_not_depend_on_what_a_task_may_hold(spark):
    rng = random.Random(2)
    rows = [(i, x, y, round(rng.gauss(0, 1), 1)) for i in range(3) for x in range(18) for y in range(18)]
    pixels = spark.createDataFrame(rows, "image_id long, x int, y int, val double")
    for work in (lambda held: images.mad_noise(pixels, ["image_id"], held=held), lambda held: images.clipped_rms(pixels, ["image_id"], 2.0, 2, held=held)):
        assert sorted(map(tuple, work(50).collect())) == sorted(map(tuple, work(1 << 18).collect()))


def test_values_are_carried_in_both_directions(spark):
    rng = random.Random(3)
    rows = [(k, rng.choice([None, None, None, k])) for k in rng.sample(range(500), 300)]
    got = ordering.carried(spark.createDataFrame(rows, "at long, v long"), ["at"], "v", "before", "after").collect()
    held = sorted(v for _, v in rows if v is not None)
    for r in got:
        i = bisect.bisect_right(held, r["at"])
        j = bisect.bisect_left(held, r["at"])
        assert (r["before"], r["after"]) == (held[i - 1] if i else None, held[j] if j < len(held) else None)
    assert len(got) == len(rows)
    total = ordering.running_total(spark.createDataFrame(rows, "at long, v long"), ["at"], "at", "upto").collect()
    assert all(r["upto"] == sum(k for k, _ in rows if k <= r["at"]) for r in total)


@pytest.fixture(scope="module")
def crowd(spark):
    day = datetime.datetime(2024, 1, 1)
    rng = random.Random(4)
    pivots = [(k, day + datetime.timedelta(seconds=rng.randrange(86400))) for k in range(500)] + [(1000, day + datetime.timedelta(days=60)), (1001, day - datetime.timedelta(days=60)), (1002, None), (3, day), (3, day)]
    times = [(day + datetime.timedelta(seconds=10 * k), k) for k in range(2000)] + [(day + datetime.timedelta(days=39), 5000), (day, 4), (None, 9)]
    return spark.createDataFrame(pivots, "pid long, ts timestamp_ntz"), spark.createDataFrame(times, "ts timestamp_ntz, value long"), pivots, times


def test_nearest_time_of_a_crowded_day(spark, crowd):
    pivots, times, p, t = crowd
    got = sorted(((r["pid"], r["ts"], r["value"]) for r in timeline.nearest_in_time(pivots, times).collect()), key=str)
    want = [(i, ts, None if ts is None else min((abs(at - ts), at, v) for at, v in t if at is not None)[2]) for i, ts in p]
    assert got == sorted(want, key=str)
    assert all(r["value"] is None for r in timeline.nearest_in_time(pivots, times.where("false")).collect())


def test_no_frame_runs_to_the_end(spark, crowd):
    """A frame from the current row to the end is computed anew for every row."""
    plane = spark.createDataFrame([(0, 0, 1, 0, 0, 1.0, False)], "scan long, ant1 long, ant2 long, chan long, corr long, amp double, flag boolean")
    for df in (timeline.nearest_in_time(*crowd[:2]), rfi.rank_operator(plane, "chan"), rfi.rank_operator(plane, "scan")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "currentrow$(), unboundedfollowing$()" not in plan.lower()
        assert "indow" in plan


def test_rank_operator_of_a_long_plane(spark):
    rng = random.Random(5)
    line = [rng.random() < 0.3 for _ in range(400)]
    rows = [(k, 0, 1, 0, 0, 1.0, f) for k, f in enumerate(line)]
    got = {r["scan"]: r["flag"] for r in rfi.rank_operator(spark.createDataFrame(rows, "scan long, ant1 long, ant2 long, chan long, corr long, amp double, flag boolean"), "scan", 0.3).collect()}
    sums = [0.0]
    for f in line:
        sums.append(round(sums[-1] + (0.3 if f else -0.7), 9))
    for k in range(len(line)):
        assert got[k] == (max(sums[k + 1 :]) - min(sums[: k + 1]) >= 0)


def test_range_partitions_grow_with_the_input(spark, sf_dir, monkeypatch):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber")
    order = ["l_orderkey", "l_linenumber"]
    few = ordering._placed(lines, order).agg(F.max("_part")).first()[0] + 1
    want = sorted(map(tuple, ordering.numbered(lines, order).collect()))
    monkeypatch.setattr(ordering, "PART_BYTES", 2000)
    assert few <= 8 < ordering._placed(lines, order).agg(F.max("_part")).first()[0] + 1
    assert sorted(map(tuple, ordering.numbered(lines, order).collect())) == want


def test_bytes_that_a_table_comes_from(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    whole = input_bytes(lines)
    assert 0 < input_bytes(lines.select("l_orderkey")) < whole
    assert input_bytes(lines.alias("a").join(lines.alias("b"), F.expr("a.l_orderkey = b.l_partkey"))) <= 2 * whole
    assert input_bytes(spark.createDataFrame(spark.sparkContext.parallelize([(1,)]), "a int")) == 0
