"""Images as pixel tables: cutouts, masks, co-adds, noise, peaks, differences, reprojection (P12-P15, P20, P21, A7-A17,
A33, J19, J23, W6)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.sky import pixel_to_sky, sky_to_pixel
from ..session import importable, release, written
from .ordering import HELD, largest_group, medians, numbered

SIGMA = 1.4826
IMAGE = ["image_id"]


def box(x0: float, y0: float, r: float) -> Column:
    """Inside [x0 - r, x0 + r) x [y0 - r, y0 + r)."""
    x, y = F.col("x"), F.col("y")
    return (x >= x0 - r) & (x < x0 + r) & (y >= y0 - r) & (y < y0 + r)


def masked_boxes(pixels: DataFrame, boxes: DataFrame) -> DataFrame:
    """Add ``mask``, 1 inside any of the ``boxes`` (x0, y0, width; odd widths, none or less masks nothing)."""
    half = F.floor(F.col("width") / 2.0)
    side = lambda c: F.explode(F.sequence(F.ceil(F.col(c) - half), F.floor(F.col(c) + half)))
    flat = boxes.where("width > 0").select("*", side("x0").alias("x")).select("x", side("y0").alias("y")).distinct().withColumn("mask", F.lit(1))
    return pixels.join(flat, ["x", "y"], "left").withColumn("mask", F.coalesce("mask", F.lit(0)))


def outside_circle(value: Column, x0: float, y0: float, r: float) -> Column:
    """The value, null beyond the radius."""
    dx, dy = F.col("x") - x0, F.col("y") - y0
    return F.when(dx * dx + dy * dy <= r * r, value)


def untiled(cells: DataFrame, size: int) -> DataFrame:
    """P20, the way back: pixels (x, y) from cell numbers and places in the cell."""
    return cells.withColumns({a: F.col(f"c{a}") * size + F.col(f"i{a}") for a in "xy"}).drop("cx", "cy", "ix", "iy")


def write_planes(pixels: DataFrame, path: str) -> None:
    """Planes as Parquet, each image's pixels together and in order."""
    pixels.repartitionByRange("image_id").sortWithinPartitions("image_id", "y", "x").write.parquet(path)


def tiled(pixels: DataFrame, size: int) -> DataFrame:
    """P20: add cell numbers (cx, cy) and places in the cell (ix, iy)."""
    return pixels.withColumns({f"c{a}": F.floor(F.col(a) / float(size)).cast("int") for a in "xy"} | {f"i{a}": F.col(a) % size for a in "xy"})


def sound_images(pixels: DataFrame, k: float = 1.5) -> DataFrame:
    """Ids of images that are not corrupt, which is -min * k > max."""
    return pixels.groupBy(*IMAGE).agg(F.min("val").alias("lo"), F.max("val").alias("hi")).where(-F.col("lo") * k <= F.col("hi")).select("image_id")


def co_added(pixels: DataFrame, by: list[str], least: int = 1) -> DataFrame:
    """Sum / n of the images of each group that has ``least`` images or more."""
    n = pixels.groupBy(*by).agg(F.count_distinct("image_id").alias("n_images")).where(F.col("n_images") >= least)
    total = pixels.groupBy(*by, "x", "y").agg(F.sum("val").alias("val"))
    return total.join(n, by).select(*by, "x", "y", (F.col("val") / F.col("n_images")).alias("val"), "n_images")


def box_statistics(pixels: DataFrame, where: Column) -> DataFrame:
    """Rms (population std), median, largest value of each image in a region."""
    return pixels.where(where).groupBy(*IMAGE).agg(F.stddev_pop("val").alias("rms"), F.median("val").alias("middle"), F.max("val").alias("top"))


def gated_co_add(pixels: DataFrame, by: list[str], where: Column, k: float) -> DataFrame:
    """Co-add of the images whose rms in a region is at most k times the median rms (of those above 0)."""
    groups = pixels.select(*by, "image_id").distinct()
    rms = box_statistics(pixels, where).join(groups, "image_id")
    cut = rms.where("rms > 0").groupBy(*by).agg((k * F.median("rms")).alias("cut"))
    kept = rms.join(cut, by).where("rms <= cut").select("image_id")
    return co_added(pixels.join(kept, "image_id", "left_semi"), by)


def mad_noise(df: DataFrame, by: list[str], value: str = "val", held: int = HELD) -> DataFrame:
    """1.4826 * median(|v - median|) of each group, or of all rows; groups of more than ``held`` values never lie in
    one task."""
    most = largest_group(df, by) if by else None
    middle = medians(df, by, F.col(value), "middle", held, most)
    both = df.join(middle, by) if by else df.join(F.broadcast(middle))  # one row
    return medians(both, by, SIGMA * F.abs(F.col(value) - F.col("middle")), "noise", held, most)


def clipped_rms(pixels: DataFrame, by: list[str], k: float = 5.0, rounds: int = 5, held: int = HELD) -> DataFrame:
    """Std of the values within k sigma of the median, sigma from the MAD, repeated until sigma is steady."""
    good = pixels.where(F.col("val").isNotNull() & ~F.isnan("val")).select(*by, "val")
    most = largest_group(good, by)

    def state(rows: DataFrame) -> DataFrame:
        middle = medians(rows, by, F.col("val"), "m", held, most)
        return medians(rows.join(middle, by), [*by, "m"], SIGMA * F.abs(F.col("val") - F.col("m")), "s", held, most)

    def inside(now: DataFrame) -> DataFrame:
        return good.join(now, by).where(F.col("val").between(F.col("lo"), F.col("hi"))).select(*by, "val")

    every = F.lit(float("inf"))
    now = written(state(good).select("*", (-every).alias("lo"), every.alias("hi"), (F.col("s") == 0).alias("done")), "clip")
    for _ in range(rounds):  # what is kept of an image lies between two bounds, so a round reads the pixels once
        reach = k * F.col("s")
        bounds = now.withColumns({"lo": F.when(F.col("done"), F.col("lo")).otherwise(F.greatest("lo", F.col("m") - reach)), "hi": F.when(F.col("done"), F.col("hi")).otherwise(F.least("hi", F.col("m") + reach))})
        new = state(inside(bounds)).select(*by, F.col("m").alias("m2"), F.col("s").alias("s2"))
        steady = (F.col("s2") == 0) | (F.abs(F.col("s2") - F.col("s")) <= 1e-8 + 1e-3 * F.abs("s"))
        stays = lambda c: F.when(F.col("done"), F.col(c)).otherwise(F.col(f"{c}2")).alias(c)
        after = written(bounds.join(new, by).select(*by, stays("m"), stays("s"), "lo", "hi", (F.col("done") | steady).alias("done")), "clip")
        release(now)
        now = after
    return inside(now).groupBy(*by).agg(F.stddev_pop("val").alias("rms"), F.count("*").alias("n"))


def two_pass_rms(pixels: DataFrame, k: float = 7.0) -> DataFrame:
    """Std of the values with |v| < k * std of all."""
    first = pixels.groupBy(*IMAGE).agg(F.stddev_pop("val").alias("_s"))
    return pixels.join(first, IMAGE).where(F.abs("val") < k * F.col("_s")).groupBy(*IMAGE).agg(F.stddev_pop("val").alias("rms"))


def peaks(pixels: DataFrame, where: Column | None = None, absolute: bool = True) -> DataFrame:
    """(image_id, px, py, peak): the value of the largest (absolute) value; on ties the first in row-major order."""
    size = F.abs("val") if absolute else F.col("val")
    rows = pixels if where is None else pixels.where(where)
    best = rows.groupBy(*IMAGE).agg(F.min(F.struct((-size).alias("o"), "y", "x", "val")).alias("b"))
    return best.select("image_id", F.col("b.x").alias("px"), F.col("b.y").alias("py"), F.col("b.val").alias("peak"))


def dynamic_range(pixels: DataFrame, reach: int = 100) -> DataFrame:
    """(image_id, top, low, dr): the largest value, the smallest within ``reach`` pixels of it, and their ratio."""
    at = peaks(pixels, absolute=False)
    near = pixels.join(at, IMAGE).where((F.col("x") >= F.col("px") - reach) & (F.col("x") < F.col("px") + reach) & (F.col("y") >= F.col("py") - reach) & (F.col("y") < F.col("py") + reach))
    low = near.groupBy(*IMAGE).agg(F.max("peak").alias("top"), F.min("val").alias("low"))
    return low.withColumn("dr", F.try_divide("top", F.abs("low")))


def worsened(before: DataFrame, after: DataFrame, key: str, share: float = 0.2) -> DataFrame:
    """Keys whose dynamic range fell by more than a share while the new minimum is negative."""
    both = before.select(key, F.col("dr").alias("dr1")).join(after.select(key, F.col("dr").alias("dr2"), "low"), key)
    return both.select(key, ((F.try_divide(F.col("dr1") - F.col("dr2"), "dr2") > share) & (F.col("low") < 0)).alias("worse"))


def subtracted(late: DataFrame, early: DataFrame, keys: list[str]) -> DataFrame:
    """Late - early on equal pixels."""
    return late.select(*keys, F.col("val").alias("l")).join(early.select(*keys, F.col("val").alias("e")), keys).select(*keys, (F.col("l") - F.col("e")).alias("val"))


def plane_consistency(a: DataFrame, b: DataFrame, keys: list[str], by: list[str], tolerance: float = 1e-3) -> DataFrame:
    """Mean |a - b| over max |a| of each plane, and whether it is above the tolerance."""
    both = a.select(*keys, F.col("val").alias("va")).join(b.select(*keys, F.col("val").alias("vb")), keys)
    ratio = F.try_divide(F.avg(F.abs(F.col("va") - F.col("vb"))), F.max(F.abs("va")))
    return both.groupBy(*by).agg(ratio.alias("ratio")).withColumn("inconsistent", F.col("ratio") > tolerance)


def resampled(source: DataFrame, targets: DataFrame, by: list[str]) -> DataFrame:
    """Bilinear values of ``source`` at the places (sx, sy) of ``targets`` (x, y, sx, sy); null off its edge."""
    out = targets
    for a in "xy":
        out = out.withColumn(f"_{a}", F.floor(f"s{a}").cast("int")).withColumn(f"_{a}f", F.col(f"s{a}") - F.floor(f"s{a}"))
    sides = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)))
    out = out.withColumn("_c", F.explode(sides))
    weight = F.when(F.col("_c.i") == 1, F.col("_xf")).otherwise(1 - F.col("_xf")) * F.when(F.col("_c.j") == 1, F.col("_yf")).otherwise(1 - F.col("_yf"))
    out = out.select("x", "y", (F.col("_x") + F.col("_c.i")).alias("_sx"), (F.col("_y") + F.col("_c.j")).alias("_sy"), weight.alias("_w")).where("_w > 0")
    total = out.groupBy("x", "y").agg(F.sum("_w").alias("_all"))
    named = source.select(*by, F.col("x").alias("_sx"), F.col("y").alias("_sy"), "val")
    got = out.join(named, ["_sx", "_sy"]).groupBy(*by, "x", "y").agg(F.sum(F.col("_w") * F.col("val")).alias("val"), F.sum("_w").alias("_got"))
    return got.join(total, ["x", "y"]).where(F.col("_got") > F.col("_all") - 1e-9).select(*by, "x", "y", "val")


Plane = tuple[float, float, float, float]


def pixel_map(spark: SparkSession, size: int, onto: Plane, origin: Plane) -> DataFrame:
    """(x, y, sx, sy): where each pixel of a plane of ``size`` x ``size`` lies on another, both SIN planes (ra0, dec0, scale,
    centre); null for pixels off the sky or below the other's horizon. Places are rounded to 1e-9 pixels."""
    side = F.sequence(F.lit(0), F.lit(size - 1))
    grid = spark.range(1).select(F.explode(side).alias("y")).select(F.explode(side).alias("x"), "y")
    ra, dec = pixel_to_sky("x", "y", *onto)
    sx, sy = sky_to_pixel("_ra", "_dec", *origin)
    return grid.withColumns({"_ra": ra, "_dec": dec}).select("x", "y", F.round(sx, 9).alias("sx"), F.round(sy, 9).alias("sy"))


def reprojected(source: DataFrame, by: list[str], size: int, onto: Plane, origin: Plane) -> DataFrame:
    """(*by, x, y, val): the images of ``source`` (*by, x, y, val), which lie on the plane ``origin``, on the plane ``onto``;
    bilinear, and null where a pixel is off the sky or lacks a neighbour on the source that it needs.

    Each source pixel goes to the four squares that it is a corner of; a square meets the target pixels that fall into it. One
    shuffle of the source by squares serves the gathering of corners and the join; the map is one row a target pixel.
    """
    spark = source.sparkSession
    sides = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)))
    sent = source.select(*by, "x", "y", F.col("val").cast("double").alias("val"), F.explode(sides).alias("_c"))
    sent = sent.select(*by, (F.col("x") - F.col("_c.i")).cast("int").alias("_x"), (F.col("y") - F.col("_c.j")).cast("int").alias("_y"), "_c", "val").repartition("_x", "_y")
    corner = lambda i, j: F.max(F.when((F.col("_c.i") == i) & (F.col("_c.j") == j), F.col("val"))).alias(f"_v{i}{j}")
    squares = sent.groupBy(*by, "_x", "_y").agg(*(corner(i, j) for i in (0, 1) for j in (0, 1)))
    placed = pixel_map(spark, size, onto, origin).where("sx is not null and sy is not null")
    placed = placed.select("x", "y", F.floor("sx").cast("int").alias("_x"), F.floor("sy").cast("int").alias("_y"), (F.col("sx") - F.floor("sx")).alias("_fx"), (F.col("sy") - F.floor("sy")).alias("_fy"))
    share = {(i, j): (F.col("_fx") if i else 1 - F.col("_fx")) * (F.col("_fy") if j else 1 - F.col("_fy")) for i in (0, 1) for j in (0, 1)}
    parts = [F.when(w > 0, w * F.col(f"_v{i}{j}")).otherwise(0.0) for (i, j), w in share.items()]
    found = squares.join(placed, ["_x", "_y"]).select(*by, "x", "y", sum(parts[1:], parts[0]).alias("val"))
    side = F.sequence(F.lit(0), F.lit(size - 1))
    every = source.select(*by).distinct().select(*by, F.explode(side).alias("x")).select(*by, "x", F.explode(side).alias("y"))
    return every.join(found, [*by, "x", "y"], "left")


def stacked(images: DataFrame, by: list[str]) -> DataFrame:
    """A10: (*by, x, y, val, n_images): the mean of the images (image_id, x, y, val) of each group, null where one has no value."""
    total = images.groupBy(*by, "x", "y").agg(F.when(F.count("val") == F.count("*"), F.sum("val") / F.count("*")).alias("val"), F.count("*").alias("n_images"))
    return total


def band_group(band: Column, first: tuple[int, ...] = (1, 4, 9)) -> Column:
    """The group of a sub-band, counted from 1, groups beginning at the numbers ``first``; null before the first group."""
    out = F.lit(None).cast("int")
    for n, edge in enumerate(first, 1):
        out = F.when(band >= edge, F.lit(n)).otherwise(out)
    return out


def median_residual(pixels: DataFrame, half: int, tile: int = 256) -> DataFrame:
    """Value minus the median of its (2 half + 1)^2 neighbourhood, padded with zeros.

    Pixels go to their square of side ``tile``, and to the neighbours whose rim of ``half`` pixels they lie in; a task takes
    the medians of a square with its rim at once.
    """
    importable(pixels.sparkSession)
    reach = range(-1 - half // tile, 2 + half // tile)
    steps = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in reach for j in reach))
    sent = pixels.select("image_id", "x", "y", F.col("val").cast("double").alias("val"), F.explode(steps).alias("s"))
    sent = sent.withColumns({f"_{a}": F.floor(F.col(a) / float(tile)).cast("int") + F.col(f"s.{k}") for a, k in (("x", "i"), ("y", "j"))})
    near = [F.col(a).between(F.col(f"_{a}") * tile - half, (F.col(f"_{a}") + 1) * tile - 1 + half) for a in "xy"]

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        x0, y0 = int(rows["_x"].iloc[0]) * tile, int(rows["_y"].iloc[0]) * tile
        x, y = rows["x"].to_numpy(np.int64), rows["y"].to_numpy(np.int64)
        own = (x >= x0) & (x < x0 + tile) & (y >= y0) & (y < y0 + tile)
        if not own.any():
            return pd.DataFrame({"image_id": rows["image_id"][:0], "x": x[:0], "y": y[:0], "val": np.zeros(0)})
        wide, high = x[own].max() - x0 + 1, y[own].max() - y0 + 1
        plane = np.zeros((high + 2 * half, wide + 2 * half))
        fits = (x < x0 + wide + half) & (y < y0 + high + half)
        plane[y[fits] - y0 + half, x[fits] - x0 + half] = rows["val"].to_numpy()[fits]
        around = np.lib.stride_tricks.sliding_window_view(plane, (2 * half + 1, 2 * half + 1))
        middle = np.concatenate([np.median(line.reshape(wide, -1), axis=1)[None] for line in around])
        return pd.DataFrame({"image_id": rows["image_id"].to_numpy()[own], "x": x[own], "y": y[own], "val": rows["val"].to_numpy()[own] - middle[y[own] - y0, x[own] - x0]})

    kinds = {f.name: f.dataType.simpleString() for f in pixels.schema.fields}
    return sent.where(near[0] & near[1]).drop("s").groupBy("image_id", "_x", "_y").applyInPandas(work, f"image_id {kinds['image_id']}, x {kinds['x']}, y {kinds['y']}, val double")


def moving_pairs(images: DataFrame) -> DataFrame:
    """(band, pair, image_id): overlapping pairs in the time order of each band."""
    from .timeline import overlapping_pairs

    return overlapping_pairs(images, ["band"], "seq", "image_id")


def light_curve(pixels: DataFrame, noise_by: list[str], threshold: float = 6.0) -> DataFrame:
    """|peak| / MAD noise of each image and whether it is a detection."""
    noise = mad_noise(pixels, noise_by)
    both = peaks(pixels).join(noise, "image_id").withColumn("snr", F.try_divide(F.abs("peak"), F.nullif("noise", F.lit(0.0))))
    return both.select("image_id", "peak", "noise", "snr", (F.col("snr") > threshold).alias("detected"))


def ranked(df: DataFrame, by: list[str], order: list) -> DataFrame:
    """Add ``rank`` 1, 2, ... in each group, or over all rows by range partitions."""
    if not by:
        return numbered(df, order, "rank", 1)
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("bigint"))
