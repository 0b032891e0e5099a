"""Source detection, clustering, matching and sifting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sky import pixel_to_sky, separation
from ..session import written
from .components import connected_components
from .ordering import numbered
from .spanning import linkage, neighbours

CELL = ["image_id", "cx", "cy"]
#: Classes of reviewed candidates; 0 is that of candidates that nobody looked at yet.
CLASSES = {0: "NA", 1: "CANDIDATE", 2: "AIRPLANE", 3: "METEOR", 6: "SCINT", 7: "OTHER", 8: "REFRACTION", 9: "STATIONARY", 10: "SUN", 11: "ATEAM"}
NOT_CLASSIFIED = 0


def detections(cells: DataFrame, nsigma: float = 5.0) -> DataFrame:
    """Pixels with |v| of nsigma rms or more of their cell, the rms being taken again without the first hits; the
    first hits where the second pass finds none."""
    first = cells.join(cells.groupBy(*CELL).agg(F.stddev_pop("val").alias("_r1")), CELL)
    first = first.withColumn("_h1", F.abs("val") >= nsigma * F.col("_r1"))
    second = first.groupBy(*CELL).agg(F.stddev_pop(F.when(~F.col("_h1"), F.col("val"))).alias("_r2"))
    both = first.join(second, CELL).withColumn("_h2", F.abs("val") >= nsigma * F.col("_r2"))
    told = both.join(both.groupBy(*CELL).agg(F.bool_or("_h2").alias("_any")), CELL)
    return told.where(F.when(F.col("_any"), F.col("_h2")).otherwise(F.col("_h1"))).select(*cells.columns)


def _named(hits: DataFrame, links: DataFrame, by: list[str]) -> DataFrame:
    """``hits`` with ``cluster``: the first place, y * 2^20 + x, of the component of ``links`` (a, b) that a hit belongs to."""
    parts = connected_components(links)
    found = hits.withColumn("node", F.struct(*by, "y", "x")).join(parts, "node", "left")
    first = lambda c: (F.coalesce(F.col(f"component.{c}"), F.col(c))).cast("bigint")
    return found.withColumn("cluster", first("y") * (1 << 20) + first("x")).drop("node", "component")


def clusters(hits: DataFrame, reach: float, by: tuple[str, ...] = ("image_id",)) -> DataFrame:
    """Add ``cluster``: hits of an image that are linked by steps of at most ``reach`` pixels.

    Neighbours meet by squares of side ``reach``; a cluster is named by the place of its first hit in row-major order,
    within its image.
    """
    node = F.struct(*by, "y", "x")
    own = written(hits, "hits")
    named = own.select(*by, "x", "y").distinct().withColumns({"node": node, "root": node})
    return _named(own, neighbours(named, list(by), reach).select("a", "b"), list(by))


def cut_heights(heights: DataFrame, by: list[str], apart: float = 14.0, near: float = 1.0) -> DataFrame:
    """(*by, cut): the height at which the dendrogram of a group is cut, from its merges (*by, w).

    Two hits are one source if they touch (``near``). Else the cut is at ``apart`` if the last merge stands out by more than
    that, and above all merges otherwise. It is moved to twice ``apart`` where the step of the dendrogram at the cut is below
    that, the step above it below ``apart``, and there are more than three merges that are neither all of length ``near`` nor
    as many as clusters: a bright source is not broken up because a distinct one lies elsewhere.
    """
    gathered = heights.groupBy(*by).agg(F.array_sort(F.collect_list("w")).alias("z"))  # the hits of a cell at most
    z, m = F.col("z"), F.size("z")
    at = lambda k: F.get(z, k)
    last, before = at(m - 1), at(m - 2)
    told = gathered.withColumn("cut", F.when(m == 1, F.lit(near)).when(last - before > apart, F.lit(apart)).otherwise(last))
    told = told.withColumn("k", F.size(F.filter(z, lambda w: w > F.col("cut"))))  # merges above the cut: one less than clusters
    step = F.when(F.col("k") == 0, last - before).otherwise(at(m - F.col("k")) - at(m - F.col("k") - 1))
    above = F.when(F.col("k") < 2, F.lit(0.0)).otherwise(at(m - F.col("k") + 1) - at(m - F.col("k")))
    settled = (m <= 3) | (last == near) | (m == F.col("k") + 1)
    moved = ~settled & F.coalesce((step < 2 * apart) & (above < apart), F.lit(False))
    return told.select(*by, F.when(moved, F.lit(2 * apart)).otherwise(F.col("cut")).alias("cut"))


def adaptive_clusters(hits: DataFrame, by: list[str], across: float, apart: float = 14.0, near: float = 1.0) -> DataFrame:
    """X2, adaptive: add ``cluster`` by single linkage, each group of ``by`` (a cell of an image, ``across`` pixels at most from
    corner to corner) being cut at its own height of the dendrogram."""
    own = written(hits, "hits")
    merges = written(linkage(own, by, across), "merges")
    cuts = cut_heights(merges, by, apart, near)
    links = merges.join(cuts, by).where("w <= cut").select("a", "b")
    return _named(own, links, by)


def cluster_summary(found: DataFrame, margin: int, size: int) -> DataFrame:
    """(image_id, cluster, n, x, y, peak, x1, x2, y1, y2): peak of the largest |v| and the box around, clipped."""
    best = found.groupBy("image_id", "cluster").agg(
        F.min(F.struct((-F.abs("val")).alias("o"), "y", "x", "val")).alias("b"), F.count("*").alias("n"),
        *(f(c).alias(f"{c}{k}") for c in "xy" for f, k in ((F.min, 1), (F.max, 2))),
    )
    clip = lambda c: F.greatest(F.lit(0), F.least(F.lit(size - 1), c))
    return best.select("image_id", "cluster", "n", F.col("b.x").alias("x"), F.col("b.y").alias("y"), F.col("b.val").alias("peak"), *(clip(F.col(f"{c}{k}") + (margin if k == 2 else -margin)).alias(f"{c}{k}") for c in "xy" for k in (1, 2)))


def with_sky(found: DataFrame, ra0: float, dec0: float, scale: float, centre: float) -> DataFrame:
    """Add ra and dec of the pixel (x, y)."""
    ra, dec = pixel_to_sky("x", "y", ra0, dec0, scale, centre)
    return found.withColumns({"ra": ra, "dec": dec})


__all__ = ["adaptive_clusters", "class_names", "cluster_summary", "clusters", "cut_heights", "detections", "nearest_on_sky", "numbered", "reviewed", "sifted", "vetoed", "with_sky"]


#: Square degrees of the sky, and sources in a cell of the first search at most, about.
SKY_DEG2, CROWD = 41252.96, 16


def _celled(df: DataFrame, height: float) -> DataFrame:
    """Add the zone of declination _z and the cell of right ascension _c, _n of them in the zone."""
    # Points within a height differ by asin(sin(height) / cos(dec)) in right ascension at most, which 1.6 times the quotient of
    # both bounds; dec is that of the zone's edge next to the pole, or of a neighbour's.
    edge = F.least(F.lit(90.0), F.greatest(F.abs(F.col("_z") * height - 90.0), F.abs((F.col("_z") + 1) * height - 90.0)) + height)
    cells = F.greatest(F.lit(1), F.floor(360.0 * F.cos(F.radians(edge)) / (1.6 * height)).cast("int"))
    placed = df.withColumn("_n", cells)
    return placed.withColumn("_c", F.pmod(F.floor(F.pmod("ra", F.lit(360.0)) / 360.0 * F.col("_n")).cast("int"), F.col("_n")))


def _zone(height: float) -> Column:
    return F.floor((F.col("dec") + 90.0) / height).cast("int")


def sky_candidates(left: DataFrame, right: DataFrame, height: float) -> DataFrame:
    """(id, near): each of ``left`` (id, ra, dec) with every one of ``right`` in its cell and the cells around, cells being
    ``height`` degrees high and no narrower; all within that distance are among them."""
    extra = [c for c in right.columns if c not in ("ra", "dec")]
    sent = _celled(left.select("id", "ra", "dec", F.explode(F.array(*((_zone(height) + k) for k in (-1, 0, 1)))).alias("_z")), height)
    sent = sent.withColumn("_c", F.explode(F.array_distinct(F.array(*(F.pmod(F.col("_c") + k, F.col("_n")) for k in (-1, 0, 1)))))).drop("_n")
    known = _celled(right.withColumn("_z", _zone(height)), height).select(*extra, F.col("ra").alias("ra2"), F.col("dec").alias("dec2"), "_z", "_c")
    return sent.join(known, ["_z", "_c"]).select("id", F.struct(separation("dec", "ra", "dec2", "ra2").alias("sep"), *extra).alias("near"))


def first_height(right: DataFrame) -> float:
    """The height of the first cells: the mean distance of the sources, and less where a cell of that height is crowded."""
    n = right.count()
    height = min(45.0, (SKY_DEG2 / max(1, n)) ** 0.5)
    most = _celled(right.withColumn("_z", _zone(height)), height).groupBy("_z", "_c").count().agg(F.max("count")).first()[0] or 0
    return max(1e-5, height * min(1.0, (CROWD / max(1, most)) ** 0.5))


def nearest_on_sky(left: DataFrame, right: DataFrame, first_deg: float | None = None) -> DataFrame:
    """Each of ``left`` (id, ra, dec) with the nearest of ``right`` (pid, ra, dec, ...) as sep and near.

    Both meet by zones of declination, cut into cells of right ascension that are no narrower than a zone is high; rows
    whose nearest is further than that go on with cells four times as large, until one holds the whole sky. The first cells
    are as large as the density of ``right`` asks for, so a row meets a fixed number of sources however large the catalogues
    are, and the result is exact.
    """
    rest, out, height = left.select("id", "ra", "dec"), None, first_deg or first_height(right)
    while True:
        best = sky_candidates(rest, right, height).groupBy("id").agg(F.min("near").alias("near"))
        both = rest.join(best, "id", "left")
        if height >= 180:
            found = both.where("near is not null")
            return found if out is None else out.unionByName(found)
        both = written(both, "nearest")
        sure = F.col("near").isNotNull() & (F.col("near.sep") <= height)
        out = both.where(sure) if out is None else out.unionByName(both.where(sure))
        left_over = both.where(~sure).select("id", "ra", "dec")
        if left_over.isEmpty():
            return out
        rest, height = left_over, height * 4


def vetoed(matched: DataFrame, radius_deg: float = 20 / 60, amplification: float = 5.0) -> DataFrame:
    """Add ``veto``: near a known source and not much brighter than it. Needs near.sep, near.flux and peak_flux."""
    keep = (F.col("near.sep") > radius_deg) | (F.try_divide("peak_flux", F.col("near.flux")) > amplification)
    return matched.withColumn("veto", ~F.coalesce(keep, F.lit(True)))


def sifted(candidates: DataFrame, snr: float = 6.5, max_dec: float | None = None, min_alt: float | None = None) -> DataFrame:
    """Drop candidates without place, with peak / rms at most ``snr``, too far north or too low (column alt)."""
    out = candidates.where(F.col("ra").isNotNull() & F.col("dec").isNotNull() & ~F.isnan("ra") & ~F.isnan("dec"))
    out = out.where(F.try_divide("peak_flux", "local_rms") > snr)
    out = out if max_dec is None else out.where(F.col("dec") < max_dec)
    return out if min_alt is None else out.where(F.col("alt") > min_alt)


def reviewed(candidates: DataFrame, decisions: DataFrame) -> DataFrame:
    """The class that a reviewer gave (id, class); NOT_CLASSIFIED where there is none."""
    return candidates.join(decisions.select("id", F.col("class").alias("_c")), "id", "left").withColumn("class", F.coalesce("_c", F.lit(NOT_CLASSIFIED))).drop("_c")


def class_names(df: DataFrame) -> DataFrame:
    """Add ``class_name``; null for a number that is no class."""
    names = df.sparkSession.createDataFrame(list(CLASSES.items()), "class int, class_name string")
    return df.join(F.broadcast(names), "class", "left")  # ten rows
