"""The chain of each snapshot: against plain loops, in a stream, and repeated."""

import datetime
import math
import os

import pytest
from pyspark.sql import functions as F

from radiospark import session
from radiospark.operators import snapshots
from radiospark.plans import registry, timing
from radiospark.session import scratch_path
from radiospark.sources import fixtures as fx
from radiospark.streaming import ingest

from test_interference import Plane, samples, schedule  # noqa: F401  a fixture


def test_schedule_chain_against_plain_loops(spark, sf_dir, samples):  # noqa: F811
    """Flags by the schedule with the listed antennas, packed, routed and averaged, over the whole table."""
    flags = {}
    for (a, b, corr), rows in samples.items():
        listed = a in fx.FLAGGED_ANTENNAS or b in fx.FLAGGED_ANTENNAS
        plane = Plane([r.asDict() | {"flag": r["flag"] or listed} for r in rows])
        schedule(plane)
        for i, j in plane.cells():
            flags[plane.times[i], a, b, plane.chans[j], corr] = bool(plane.flag[i][j])
    values = {(r["scan"], a, b, r["chan"], corr): r["re"] for (a, b, corr), rows in samples.items() for r in rows}
    packed, want, start = {}, {}, datetime.datetime(2024, 1, 1)
    for (scan, a, b, chan, corr), flag in flags.items():
        place = ((a * 16 - a * (a - 1) // 2 + b - a) * 24 + chan) * 4 + corr
        own = packed.setdefault(scan, {})
        own[place // 8] = own.get(place // 8, 0) | (flag << (7 - place % 8))
        ts = start + datetime.timedelta(hours=5 * scan)
        jd = (ts - datetime.datetime(1970, 1, 1)).total_seconds() / 86400 + 2440587.5
        lst = (18.697374558 + 24.06570982441908 * (jd - 2451545.0) - 118.281667 * 24 / 360) % 24
        transit = any(abs((lst - c[1] / 15 + 12) % 24 - 12) <= 0.5 for c in fx.CALIBRATORS)
        averaged = 1 <= ts.hour <= 14 or 11 <= lst <= 14 or transit
        key = (scan, "averaged", a, b, chan // 4, corr) if averaged else (scan, "archived", a, b, chan, corr)
        want.setdefault(key, []).append((values[scan, a, b, chan, corr], flag))
    got = registry.queries()["k2_schedule_chain"](spark, sf_dir).collect()
    assert len(got) == len(want)
    for r in got:
        rows = want[r["scan"], r["route"], r["ant1"], r["ant2"], r["chan"], r["corr"]]
        good = [v for v, f in rows if not f] if r["route"] == "averaged" else [v for v, _ in rows]
        assert r["flag"] == all(f for _, f in rows)
        assert (r["re"] is None) == (not good) and (not good or math.isclose(r["re"], sum(good) / len(good), abs_tol=2e-6))
        assert (r["packed"], r["bytes"]) == (sum(packed[r["scan"]].values()), len(packed[r["scan"]]))
    assert {r["route"] for r in got} == {"averaged", "archived"}


def test_flag_and_average_takes_every_scan_and_baseline(spark, sf_dir):
    """Samples of every scan, and of antennas with themselves, are flagged, packed and averaged or archived."""
    every = fx.vis(spark, sf_dir).collect()
    got = registry.queries()["k2_flag_and_average"](spark, sf_dir).collect()
    route = {r["scan"]: r["route"] for r in got}
    want = {(r["scan"], r["ant1"], r["ant2"], r["chan"] // 4 if route.get(r["scan"]) == "averaged" else r["chan"], r["corr"]) for r in every}
    assert sorted((r["scan"], r["ant1"], r["ant2"], r["chan"], r["corr"]) for r in got) == sorted(want)
    assert any(r["scan"] % 4 == 3 for r in every) and any(r["ant1"] == r["ant2"] for r in every)
    places: dict[int, set[int]] = {}
    for r in every:
        a, b = r["ant1"], r["ant2"]
        places.setdefault(r["scan"], set()).add((((a * 16 - a * (a - 1) // 2 + b - a) * 24 + r["chan"]) * 4 + r["corr"]) // 8)
    assert {r["scan"]: r["bytes"] for r in got} == {scan: len(own) for scan, own in places.items()}


@pytest.fixture
def incoming(spark, sf_dir):
    """A folder of snapshots, one file each."""
    base = scratch_path(spark, "incoming")
    timing.timed_snapshots(spark, sf_dir).where("ant1 < 6").repartition("scan").write.partitionBy("scan").parquet(f"{base}/in")
    return base


def stream_of(spark, base, files):
    return ingest.file_stream(spark, f"{base}/in", files=files).withColumn("scan", F.col("scan").cast("bigint"))


def rows_of(spark, path):
    return sorted(map(str, spark.read.parquet(path).collect()))


def test_stream_equals_batch_and_repeats_change_nothing(spark, incoming):
    work = timing.snapshot_products(spark, snapshots.by_channel(1.7))
    ingest.snapshot_chain(stream_of(spark, incoming, 2), work, f"{incoming}/out", f"{incoming}/state")
    whole = work(spark.read.parquet(f"{incoming}/in").withColumn("scan", F.col("scan").cast("bigint")))
    first = {}
    for name, df in whole.items():
        columns = sorted(df.columns)
        held = lambda x: sorted(tuple(str(round(v, 9) if isinstance(v, float) else v) for v in r) for r in x.select(*columns).collect())  # noqa: E731, B023
        first[name] = rows_of(spark, f"{incoming}/out/version=1/{name}")
        assert held(spark.read.parquet(f"{incoming}/out/version=1/{name}")) == held(df)
    stamps = {p: os.stat(p).st_mtime_ns for p in spark.read.parquet(f"{incoming}/out/version=1/data").inputFiles() for p in [p.removeprefix("file://")]}
    # every snapshot comes again, in other batches: the state of the stream is lost
    ingest.snapshot_chain(stream_of(spark, incoming, 3), work, f"{incoming}/out", f"{incoming}/state2")
    assert {n: rows_of(spark, f"{incoming}/out/version=1/{n}") for n in whole} == first
    assert all(os.stat(p).st_mtime_ns == t for p, t in stamps.items())
    # a new version stands beside the old one
    ingest.snapshot_chain(stream_of(spark, incoming, 9), work, f"{incoming}/out", f"{incoming}/state3", version=2)
    assert {n: rows_of(spark, f"{incoming}/out/version=2/{n}") for n in whole} == first


def test_a_batch_that_failed_half_way_is_made_again(spark, incoming):
    work, calls = timing.snapshot_products(spark, snapshots.by_channel(1.7)), []

    def fails_once(vis):
        made = work(vis)
        calls.append(1)
        if len(calls) == 2:
            made["data"] = made["data"].withColumn("re", F.raise_error(F.lit("lost")).cast("double"))
        return made

    with pytest.raises(Exception, match="lost"):
        ingest.snapshot_chain(stream_of(spark, incoming, 2), fails_once, f"{incoming}/out", f"{incoming}/state")
    ingest.snapshot_chain(stream_of(spark, incoming, 2), fails_once, f"{incoming}/out", f"{incoming}/state")
    ingest.snapshot_chain(stream_of(spark, incoming, 9), work, f"{incoming}/clean", f"{incoming}/state4")
    for name in ("flags", "data"):
        assert rows_of(spark, f"{incoming}/out/version=1/{name}") == rows_of(spark, f"{incoming}/clean/version=1/{name}")


def test_tables_of_a_row_a_scan_go_to_the_samples_up_to_a_size(spark, sf_dir, monkeypatch):
    def rows(df):
        return sorted(map(str, df.collect()))

    def plan(df):
        return df._jdf.queryExecution().sparkPlan().toString()

    work = timing.snapshot_products(spark, snapshots.by_channel(1.7))
    small = work(timing.timed_snapshots(spark, sf_dir))["data"]
    assert "BroadcastHashJoin" in plan(small) and "SortMergeJoin" not in plan(small)
    monkeypatch.setattr(session, "FEW_ROWS", 0)
    large = work(timing.timed_snapshots(spark, sf_dir))["data"]
    assert "ResolvedHint" not in large._jdf.queryExecution().analyzed().toString()
    assert rows(small) == rows(large)


def test_flags_are_packed_without_an_order(spark, sf_dir):
    for name in ("s10_pack_flags", "k2_snapshot_chain"):
        plan = registry.queries()[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        assert "row_number" not in plan
    vis = spark.createDataFrame([(0, 0, 1, 0, 0, True)], "scan long, ant1 long, ant2 long, chan long, corr long, flag boolean").selectExpr("*", "99 as pos")
    from radiospark.operators import flags

    with pytest.raises(Exception, match="fewer flags"):
        flags.restored_flags(vis, flags.pack_flags(vis.withColumn("pos", F.lit(3)), "scan"), "scan").collect()
    places = [((a * 5 - a * (a - 1) // 2 + b - a) * 3 + c) * 4 + k for a in range(5) for b in range(a, 5) for c in range(3) for k in range(4)]
    assert places == list(range(flags.places(5, 3)))
    every = spark.createDataFrame([(a, b, c, k) for a in range(5) for b in range(a, 5) for c in range(3) for k in range(4)], "ant1 long, ant2 long, chan long, corr long")
    assert [r[0] for r in every.select(flags.place_of(5, 3)).collect()] == places
