"""Scan files in folders: what is read, and tables effective from a date; images between two skies."""

import datetime
import math

from pyspark.sql import functions as F

from radiospark.operators import images, timeline
from radiospark.session import scratch_path
from radiospark.sources import tables

FILES = "name string, ts timestamp_ntz, mhz int"


def layout(spark):
    start = datetime.datetime(2024, 4, 1, 20)
    rows = [(f"{start + datetime.timedelta(minutes=20 * k):%Y%m%d_%H%M%S}_{m}MHz.ms", start + datetime.timedelta(minutes=20 * k), m) for k in range(40) for m in (13, 82)]
    path = scratch_path(spark, "layout")
    tables.write_scan_layout(spark.createDataFrame([*rows, ("bad", None, 13)], FILES), path)
    return path, rows


def files_read(df):
    return df._jdf.queryExecution().executedPlan().collectLeaves().head().selectedPartitions().totalNumberOfFiles()


def test_folders_outside_the_range_are_not_opened(spark):
    path, rows = layout(spark)
    found = tables.discovered(spark, path, "2024-04-01 22:10:00", "2024-04-02 03:00:00", [82])
    want = sorted(n for n, ts, m in rows if m == 82 and datetime.datetime(2024, 4, 1, 22, 10) <= ts <= datetime.datetime(2024, 4, 2, 3))
    assert sorted(r["name"] for r in found.collect()) == want and want
    scan = found._jdf.queryExecution().executedPlan().collectLeaves().head()
    folders = scan.partitionFilters().mkString(" ")
    assert all(c in folders for c in ("spw", "date", "hour")), folders
    assert files_read(found) == 6  # one sub-band, 22 h to 3 h
    assert files_read(tables.discovered(spark, path, "2024-04-01 00:00:00", "2024-04-09 00:00:00")) == 28
    assert tables.discovered(spark, path, "2024-05-01 00:00:00", "2024-05-02 00:00:00").count() == 0


def test_a_scan_list_prunes_folders_as_the_query_runs(spark):
    path, rows = layout(spark)
    wanted = spark.createDataFrame([(13, datetime.date(2024, 4, 2), 5, "keep"), (82, datetime.date(2024, 4, 2), 6, "not")], "spw int, date date, hour int, why string")
    listed = scratch_path(spark, "wanted")
    wanted.write.parquet(listed)
    found = tables.discovered_for(spark, path, spark.read.parquet(listed).where("why = 'keep'"))
    assert sorted(r["name"] for r in found.collect()) == sorted(n for n, ts, m in rows if m == 13 and ts.day == 2 and ts.hour == 5)
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()


def test_tables_hold_until_the_next(spark):
    day = lambda d: datetime.date(2024, 1, d)
    tables_ = spark.createDataFrame([(0, day(3), 1), (0, day(9), 2), (0, day(9), 3), (1, day(28), 4)], "spw int, date date, gain_id int")
    scans = spark.createDataFrame([(s, datetime.datetime(2024, 1, d, 5), d) for s in (0, 1, 2) for d in range(1, 20)], "spw int, ts timestamp_ntz, k int")
    got = {(r["spw"], r["k"]): r["gain_id"] for r in timeline.with_effective_calibration(scans, tables_).collect()}
    assert got == {(s, d): None if s else (None if d < 3 else 1 if d < 9 else 3) for s in (0, 1, 2) for d in range(1, 20)}
    assert all(r["gain_id"] is None for r in timeline.with_effective_calibration(scans, tables_.where("false")).collect())


def test_reprojection(spark):
    rows = [(i, x, y, float(i + x * x + 3 * y)) for i in (1, 2) for x in range(12) for y in range(12) if (i, x, y) != (2, 4, 4)]
    source = spark.createDataFrame(rows, "image_id long, x int, y int, val double")
    plane, other = (180.0, 40.0, 2.0, 6.5), (181.5, 41.0, 2.6, 6.5)
    same = {(r["image_id"], r["x"], r["y"]): r["val"] for r in images.reprojected(source, ["image_id"], 12, plane, plane).collect()}
    assert len(same) == 288 and all(math.isclose(same[i, x, y], v, rel_tol=1e-9, abs_tol=1e-9) for i, x, y, v in rows) and same[2, 4, 4] is None
    values = {(i, x, y): v for i, x, y, v in rows}
    places = {(r["x"], r["y"]): (r["sx"], r["sy"]) for r in images.pixel_map(spark, 12, other, plane).collect()}
    got = {(r["image_id"], r["x"], r["y"]): r["val"] for r in images.reprojected(source, ["image_id"], 12, other, plane).collect()}
    for (i, x, y), v in got.items():
        sx, sy = places[x, y]
        bx, by = math.floor(sx), math.floor(sy)
        parts = [((sx - bx if a else 1 - (sx - bx)) * (sy - by if b else 1 - (sy - by)), values.get((i, bx + a, by + b))) for a in (0, 1) for b in (0, 1)]
        want = None if any(w > 0 and p is None for w, p in parts) else sum(w * p for w, p in parts if w > 0)
        assert (v is None) == (want is None) and (v is None or math.isclose(v, want, rel_tol=1e-9))
    assert 0 < sum(v is None for v in got.values()) < len(got)
    wide = images.pixel_map(spark, 12, (180.0, 40.0, 20.0, 6.5), plane)
    assert 0 < wide.where("sx is null").count() < 144  # the corners of a wide plane are off the sky
    empty = images.reprojected(source.where("false"), ["image_id"], 12, other, plane)
    assert empty.count() == 0


def test_band_groups(spark):
    got = spark.range(12).select("id", images.band_group(F.col("id")).alias("g")).collect()
    assert [r["g"] for r in got] == [None, 1, 1, 1, 2, 2, 2, 2, 2, 3, 3, 3]
