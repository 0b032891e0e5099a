"""Golden values, identities and edge cases of the operators."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from radiospark.functions import sky
from radiospark.operators import beam, calibrate, flags, images, rfi, sources, spectra, timeline
from radiospark.operators.components import connected_components
from radiospark.sources import tables

VIS = "scan int, ant1 int, ant2 int, chan int, corr int, re double, im double, flag boolean"
GAINS = "ant int, chan int, pol int, gr double, gi double, snr double, flag boolean"


def one(df, *columns):
    return df.select(*columns).first()


def test_bandpass_golden(spark):
    vis = [(0, a, b, 0, c, 1.0, 0.0, False) for a, b in ((0, 0), (0, 1), (1, 1)) for c in range(4)]
    gains = [(0, 0, 0, 1.0, 0.0, 1.0, False), (0, 0, 1, 0.5, 0.0, 1.0, False), (1, 0, 0, 1 / 3, 0.0, 1.0, False), (1, 0, 1, 0.25, 0.0, 1.0, False)]
    got = calibrate.apply_bandpass(spark.createDataFrame(vis, VIS), spark.createDataFrame(gains, GAINS)).orderBy("ant1", "ant2", "corr").collect()
    assert [round(r["re"], 9) for r in got] == [1, 2, 2, 4, 3, 4, 6, 8, 9, 12, 12, 16]
    bad = spark.createDataFrame([(*g[:6], k == 0) for k, g in enumerate(gains)], GAINS)
    flagged = calibrate.apply_bandpass_flagged(spark.createDataFrame(vis, VIS), bad).orderBy("corr").collect()
    assert [r["re"] is None for r in flagged] == [True, True, False, False] and len(flagged) == 4
    zero = spark.createDataFrame([(a, 0, p, 0.0, 0.0, 1.0, False) for a in (0, 1) for p in (0, 1)], GAINS)
    assert all(r["re"] is None for r in calibrate.apply_bandpass(spark.createDataFrame(vis, VIS), zero).collect())


def test_gain_scale(spark):
    rng = random.Random(1)
    rows = [(0, a, b, c, k, rng.uniform(1, 2), 0.0, False) for a, b in itertools.combinations_with_replacement(range(5), 2) for c in range(3) for k in range(4)]
    scale = {(a, c, p): rng.uniform(1, 2) for a in range(5) for c in range(3) for p in (0, 1)}
    frame = spark.createDataFrame([(*k, v) for k, v in scale.items()], "ant int, chan int, pol int, scale double")
    got = {(r["ant1"], r["ant2"], r["chan"], r["corr"]): r["re"] for r in calibrate.apply_gain_scale(spark.createDataFrame(rows, VIS), frame).collect()}
    assert len(got) == len(rows)
    for _, a, b, c, k, re, _, _ in rows:
        assert abs(got[a, b, c, k] - re * scale[a, c, k // 2] * scale[b, c, k % 2]) < 1e-12
    with pytest.raises(Exception, match="do not cover"):
        calibrate.apply_gain_scale(spark.createDataFrame(rows, VIS), frame.where("ant > 0")).collect()
    target = spark.createDataFrame([(*r[:5], r[5] * 0.09, 0.0, r[1] == 1) for r in rows], VIS)
    solved = {(r["ant"], r["pol"]): r["scale"] for r in calibrate.solve_gain_scale(target, spark.createDataFrame(rows, VIS)).collect()}
    assert all(abs(v - (1.0 if a == 1 else 0.3)) < 1e-12 for (a, _), v in solved.items())


def test_identities(spark):
    rows = [(s, 0, 1, c, k, float(c + k), 1.0, (s + c) % 3 == 0) for s in (0, 1) for c in range(8) for k in range(4)]
    vis = spark.createDataFrame(rows, VIS)
    merged = flags.merged_over(vis, ["ant1", "ant2", "chan", "corr"]).collect()
    by = {}
    for r in merged:
        by.setdefault((r["chan"], r["corr"]), set()).add(r["flag"])
    assert all(len(v) == 1 for v in by.values())
    uvw = spark.createDataFrame([(0, 1, 0.0, 0.0, 0.0)], "ant1 int, ant2 int, u double, v double, w double")
    freqs = spark.createDataFrame([(c, 5e7) for c in range(8)], "chan int, f_hz double")
    same = calibrate.phase_shift(vis, uvw, freqs, 10.0, 20.0, 11.0, 21.0)
    assert same.exceptAll(vis).count() == 0
    assert calibrate.difference(vis.where("scan = 1"), vis.where("scan = 1")).where("re != 0 or im != 0").count() == 0
    assert calibrate.swap_cross_hands(calibrate.swap_cross_hands(vis, F.lit(True)), F.lit(True)).exceptAll(vis).count() == 0
    packed = flags.pack_flags(vis.where("scan = 0").select("scan", (F.col("chan") * 4 + F.col("corr")).alias("pos"), "flag"), "scan")
    back = {r["pos"]: r["flag"] for r in flags.unpack_flags(packed, "scan", 32).collect()}
    assert back == {c * 4 + k: c % 3 == 0 for c in range(8) for k in range(4)}
    with pytest.raises(ValueError):
        flags.unpack_flags(packed, "scan", 33)
    cube = spectra.filled_cube(spectra.incoherent_sum(vis, None).where("scan = 0 or chan < 4"))
    assert cube.count() == 64 and cube.where("not present").count() > 0
    assert flags.flag_antennas(vis, spark.createDataFrame([], "ant int")).exceptAll(vis).count() == 0


def test_images(spark):
    flat = [(i, x, y, v) for i, v in ((1, 2.0), (2, 3.0), (3, 100.0)) for x in range(4) for y in range(4)]
    pix = spark.createDataFrame(flat, "image_id int, x int, y int, val double").withColumn("band", F.lit(0))
    assert {r["val"] for r in images.co_added(pix, ["band"]).collect()} == {35.0}
    noisy = pix.withColumn("val", F.when((F.col("x") == 1) & (F.col("y") == 1), F.col("val") + F.when(F.col("image_id") == 3, 400.0).otherwise(1.0)).otherwise(F.col("val")))
    gated = images.gated_co_add(noisy, ["band"], F.lit(True), 2.0).where("x = 0 and y = 0").first()
    assert gated["val"] == 2.5 and gated["n_images"] == 2
    spot = spark.createDataFrame([(9, x, y, 6.0 if (x, y) == (2, 1) else 0.0) for x in range(4) for y in range(4)], "image_id int, x int, y int, val double")
    assert tuple(images.peaks(spot).first()) == (9, 2, 1, 6.0)
    boxes = spark.createDataFrame([(10, 7, 3), (30, 30, 21)], "x0 int, y0 int, width int")
    grid = spark.range(60).withColumnRenamed("id", "x").crossJoin(spark.range(60).withColumnRenamed("id", "y")).withColumns({"image_id": F.lit(1), "val": F.lit(0.0)})
    assert images.masked_boxes(grid, boxes).agg(F.sum("mask")).first()[0] == 9 + 441
    assert images.resampled(spot, spot.select("x", "y", F.col("x").cast("double").alias("sx"), F.col("y").cast("double").alias("sy")), ["image_id"]).exceptAll(spot.select("image_id", "x", "y", "val")).count() == 0
    rng = np.random.default_rng(0)
    values = np.concatenate([rng.normal(0, 1, 400), [50.0] * 5])
    rows = spark.createDataFrame([(1, float(v)) for v in values], "image_id int, val double")
    assert abs(images.clipped_rms(rows, ["image_id"]).first()["rms"] - values[:400].std()) < 0.05


def test_sky(spark):
    df = spark.createDataFrame([(350.8575, 58.148167)], "ra double, dec double")
    x, y = sky.sky_to_pixel("ra", "dec", 350.0, 57.0, 0.03125, 2049)
    back = df.withColumns({"x": x, "y": y}).select(*sky.pixel_to_sky("x", "y", 350.0, 57.0, 0.03125, 2049)).first()
    assert abs(back[0] - 350.8575) < 1e-9 and abs(back[1] - 58.148167) < 1e-9
    centre = one(spark.createDataFrame([(92.95164, 37.06079)], "ra double, dec double"), *sky.sky_to_pixel("ra", "dec", 92.95164, 37.06079, 0.03125, 2049))
    assert abs(centre[0] - 2048) < 1e-9 and abs(centre[1] - 2048) < 1e-9
    assert one(df, *sky.sky_to_pixel("ra", "dec", 170.0, -57.0, 0.03125, 2049))[0] is None
    times = spark.sql("select timestamp_ntz '2024-01-01 12:00:00' as ts")
    assert one(times, sky.julian_date("ts"))[0] == 2460311.0
    assert one(spark.sql("select 2460311.25D as jd"), sky.utc_of_julian("jd"))[0] == "2024-01-01 18:00:00"
    assert one(spark.sql("select 'x.ms' as n"), sky.parse_scan_name("n"))[0] is None
    assert one(spark.sql("select 23.9999D as h"), sky.hours_minutes("h"))[0] == "00:00"
    assert one(spark.sql("select 10D as a, 0D as b, 20D as c"), sky.separation("b", "a", "b", "c"))[0] == pytest.approx(10)


def test_timeline(spark, tmp_path):
    lines = [f"2019-10-28 23:0{2 + k * 13 // 60}:{(47 + k * 13) % 60:02d} f{k}" for k in range(3)]
    (tmp_path / "t.txt").write_text("\n".join(lines) + "\n\n")
    assert tables.timeline(spark, f"file://{tmp_path}/t.txt").count() == 3
    assert tables.dated_flags(spark, f"file://{tmp_path}/none.csv").count() == 0
    scans = spark.sql("select timestamp_ntz '2019-10-28 23:02:47' + make_dt_interval(0, 0, 0, 13 * id) as ts, id as scan_id, 1 as spw from range(10)")
    assert timeline.within(scans, "ts", "2019-10-28 23:03:00", "2019-10-28 23:04:00").count() == 5
    assert timeline.within(scans, "ts", "2019-10-28 23:03:00", "2019-10-28 23:03:00").count() == 1
    late = scans.withColumn("ts", F.col("ts") + F.expr("INTERVAL '0 23:56:04' DAY TO SECOND"))
    assert timeline.sidereal_pairs(scans.unionByName(late)).count() == 10
    blocks = [(h, n) for h, n in enumerate([24, 10, 14, 10, 14, 24, 3, 21, 3])]
    rows = spark.sql("select timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, cast(h as int), 0, s) as ts from (select h, explode(sequence(1, n)) as s from values " + ",".join(f"({h},{n})" for h, n in blocks) + " t(h, n))")
    got = [(r["hour"].hour, r["hours"]) for r in timeline.full_blocks(rows, "ts").orderBy("hour").collect()]
    assert got == [(0, 1), (1, 2), (3, 2), (5, 1), (6, 2)]
    two = spark.createDataFrame([(1, 0, 5.0)], "ant int, pol int, delay_ns double")
    with pytest.raises(Exception, match="different antennas"):
        timeline.delay_differences(two, two.withColumn("ant", F.lit(2))).collect()


def test_sources(spark):
    hits = spark.createDataFrame([(1, x, y, 1.0 + x) for x, y in ((0, 0), (1, 1), (2, 2), (9, 9), (9, 10), (30, 0))], "image_id bigint, x int, y int, val double")
    for parts in (1, 7):
        got = sources.clusters(hits.repartition(parts), 1.5)
        assert sorted(r["n"] for r in sources.cluster_summary(got, 1, 40).collect()) == [1, 2, 3]
    rng = random.Random(4)
    sky_ = lambda n: [(k, rng.uniform(0, 360), rng.uniform(-89, 89)) for k in range(n)]
    left, right = sky_(60), sky_(7)
    near = sources.nearest_on_sky(spark.createDataFrame(left, "id int, ra double, dec double"), spark.createDataFrame(right, "pid int, ra double, dec double")).collect()

    def unit(ra, dec):
        a, d = np.radians([ra, dec])
        return np.array([np.cos(d) * np.cos(a), np.cos(d) * np.sin(a), np.sin(d)])

    assert len(near) == 60
    for r in near:
        want = max(right, key=lambda p: unit(r["ra"], r["dec"]) @ unit(p[1], p[2]))
        assert r["near"]["pid"] == want[0]
    assert connected_components(spark.createDataFrame([(1, 2), (2, 3), (9, 8), (4, 4)], "a long, b long")).count() == 3


def test_interference(spark):
    rng = np.random.default_rng(2)
    plane = rng.normal(10, 1, (20, 30))
    plane[:, 7] += 6
    plane[3, :] += 6
    rows = [(int(t), 0, 1, int(c), 0, float(plane[t, c]), False) for t in range(20) for c in range(30)]
    df = spark.createDataFrame(rows, "scan int, ant1 int, ant2 int, chan int, corr int, amp double, flag boolean")
    hit = {(r["scan"], r["chan"]) for r in rfi.sum_thresholded(df, 6.0).where("flag").collect()}
    assert all((t, 7) in hit for t in range(20)) and all((3, c) in hit for c in range(30)) and len(hit) < 70
    assert {r["chan"] for r in rfi.rms_threshold(df.where("scan != 3"), "chan", 4.0).where("flag").collect()} == {7}
    line = [True, True, False, True, True, False, False, False, False, True]
    seq = spark.createDataFrame([(0, 0, 1, k, 0, 1.0, f) for k, f in enumerate(line)], df.schema)
    got = [r["flag"] for r in rfi.rank_operator(seq, "chan", 0.3).orderBy("chan").collect()]

    def brute(flag, level):
        out = []
        for i in range(len(flag)):
            out.append(any(sum(flag[a : b + 1]) >= (1 - level) * (b + 1 - a) - 1e-9 for a in range(i + 1) for b in range(i, len(flag))))
        return out

    assert got == brute(line, 0.3)
    assert rfi.flagged(df).where("flag").count() >= 40
    assert rfi.high_passed(df).agg(F.avg("residual")).first()[0] == pytest.approx(0, abs=0.5)


def test_beam(spark):
    grid = spark.sql("select i as a_i, j as b_i, cast(2 * i + 3 * j as double) as gain from (select explode(sequence(0L, 4L)) as i), (select explode(sequence(0L, 4L)) as j)")
    at = spark.createDataFrame([(1, 1.25, 3.5), (2, 4.0, 4.0), (3, 4.5, 0.0)], "id int, a double, b double")
    got = {r["id"]: r["gain"] for r in beam.trilinear(at, grid, {"a": (0.0, 1.0), "b": (0.0, 1.0)}, "gain", "id").collect()}
    assert got == {1: 13.0, 2: 20.0, 3: None}


def test_empty_tables(spark):
    vis = spark.createDataFrame([], VIS)
    for df in (calibrate.bin_channels(vis), calibrate.stokes(vis), flags.bad_baselines(vis), flags.template_scores(vis), flags.bad_channels(vis), flags.occupancy(vis)):
        assert df.count() == 0


def test_nearest_time_at_any_distance(spark):
    stamp = lambda df: df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    pivots = [(1, "2024-05-10 23:59:00"), (2, "2024-08-01 00:00:00"), (3, "1950-01-01 00:00:00"), (4, "2024-05-10 00:30:00"), (5, None)]
    times = [("2024-05-09 00:00:00", "a"), ("2024-05-12 00:01:00", "b"), ("2024-05-09 23:59:00", "c"), ("2024-05-10 01:01:00", "d")]
    times += [("2024-06-01 00:00:00", "e")]
    p, t = stamp(spark.createDataFrame(pivots, "pid int, ts string")), stamp(spark.createDataFrame(times, "ts string, value string"))
    got = lambda t: {r["pid"]: r["value"] for r in timeline.nearest_in_time(p, t).collect()}
    assert got(t.where("value in ('a', 'b')")) == {1: "b", 2: "b", 3: "a", 4: "a", 5: None}
    assert got(t) == {1: "d", 2: "e", 3: "a", 4: "c", 5: None}
    assert got(t.where("false")) == dict.fromkeys(range(1, 6))


def test_mueller_is_the_product_of_matrices(spark):
    rng = np.random.default_rng(4)
    jones = rng.normal(size=(20, 4)) + 1j * rng.normal(size=(20, 4))
    rows = [(k, *map(float, np.stack([j.real, j.imag], 1).ravel())) for k, j in enumerate(jones)]
    df = spark.createDataFrame(rows, "k int, " + ", ".join(f"{p}{q} double" for p in "abcd" for q in "ri"))
    got = df.select("k", *(c.alias(n) for n, c in beam.mueller([(F.col(f"{p}r"), F.col(f"{p}i")) for p in "abcd"]).items())).collect()
    for r in got:
        j = jones[r["k"]].reshape(2, 2)
        whole = np.array(beam.TO_STOKES) @ np.kron(j, j.conj()) @ np.array(beam.FROM_STOKES)
        assert np.allclose(whole.imag, 0) and np.allclose([[r[f"m{i}{k}"] for k in range(4)] for i in range(4)], whole.real)


def test_leakage_and_empty_beams(spark):
    factors = spark.createDataFrame([(0, *[float(10 * i + j + 1) for i in range(4) for j in range(4)]), (1, *[0.0] * 16)], "chan int, " + ", ".join(f"m{i}{j} double" for i in range(4) for j in range(4)))
    rows = [(t, c, s, 0, 0, 10.0 + s) for t, c in ((0, 0), (1, 1)) for s in range(4)] + [(2, 0, 1, 0, 0, 24.0), (3, 0, 1, 0, 0, None)]
    frame = spark.createDataFrame(rows, "t int, chan int, stokes int, x int, y int, val double")
    got = {(r["t"], r["stokes"]): r["val"] for r in beam.without_leakage(frame, factors, ["t"], ["chan"]).collect()}
    assert got[0, 0] == 10.0 and got[2, 1] == 2.0 and got[3, 1] is None  # no I image: nothing leaks
    assert all(abs(got[0, s] - (10.0 + s - 10.0 * (10 * s + 1)) / (11 * s + 1)) < 1e-12 for s in (1, 2, 3))
    assert all(got[1, s] is None for s in range(4))


def test_fields_are_one_at_the_zenith(spark):
    axes = {"freq": (10.0, 5.0), "theta": (0.0, 30.0), "phi": (0.0, 90.0)}
    cells = [(f, t, p) for f in range(3) for t in range(3) for p in range(3)]
    grid = spark.createDataFrame([(*c, *[float((c[0] + 2) * (k in (0, 6)) * (3 - c[1])) for k in range(8)]) for c in cells], "freq_i bigint, theta_i bigint, phi_i bigint, " + ", ".join(f"{n} double" for n in beam.FIELDS))
    at = spark.createDataFrame([(0, 12.5, 0.0, 0.0), (1, 17.0, 45.0, 100.0), (2, 12.5, 61.0, 0.0), (3, None, 0.0, 0.0)], "id int, freq double, theta double, phi double")
    got = {r["id"]: (r["x_theta_re"], r["y_phi_re"], r["x_phi_re"]) for r in beam.jones(at, grid, axes, "id").collect()}
    assert np.allclose(got[0], (1, 1, 0)) and np.allclose(got[1], (0.5, 0.5, 0))
    assert got[2] == got[3] == (None, None, None)  # off the grid


@pytest.mark.parametrize("minutes", [1.0, 60.0, 700.0, 3000.0])
def test_transits_against_all_pairs(spark, minutes):
    rng = random.Random(2)
    rows, named = [(k, rng.uniform(0, 24)) for k in range(60)] + [(60, 0.0), (61, None)], [(f"s{k}", rng.uniform(0, 360)) for k in range(9)] + [("edge", 359.999), ("none", None)]
    df = timeline.in_transit(spark.createDataFrame(rows, "k int, lst double"), spark.createDataFrame(named, "label string, ra double"), "lst", minutes)
    apart = lambda a, b: abs((a - b + 12) % 24 - 12)
    want = {(k, n) for k, t in rows for n, ra in named if t is not None and ra is not None and apart(t, ra / 15) <= minutes / 120}
    got = [(r["k"], r["label"]) for r in df.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_boxes_of_the_mask(spark):
    pixels = spark.createDataFrame([(0, x, y) for x in range(9) for y in range(9)], "image_id int, x int, y int")
    boxes = [(2, 2, 3), (3, 2, 3), (8, 8, 5), (5, 5, 0)]
    got = {(r["x"], r["y"]): r["mask"] for r in images.masked_boxes(pixels, spark.createDataFrame(boxes, "x0 int, y0 int, width int")).collect()}
    assert got == {(x, y): int(any(w > 0 and abs(x - a) <= w // 2 and abs(y - b) <= w // 2 for a, b, w in boxes)) for x in range(9) for y in range(9)}


def test_delay_tables_of_other_antennas_raise(spark):
    new, old = (spark.createDataFrame(rows, "ant int, pol int, delay_ns double") for rows in ([(0, 0, 3.0), (1, 0, 5.0)], [(0, 0, 1.0)]))
    assert [r["difference"] for r in timeline.delay_differences(new.where("ant = 0"), old).collect()] == [2.0]
    for a, b in ((new, old), (old, new)):
        with pytest.raises(Exception, match="different antennas"):
            timeline.delay_differences(a, b).collect()
