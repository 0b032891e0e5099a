"""Registered queries on images and source catalogues, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sky
from ..functions.numbers import rounded
from ..operators import beam, images, ordering, sources
from ..session import scratch_path, written
from ..sources import fixtures as fx
from .oracle import again, define, sql
from .registry import register
from .visibility import ENTRIES, mueller_of_gains

BOX = "x>=2 and x<6 and y>=2 and y<6"
#: The sky of the fixture images: SIN plane around (180, 40), 2 degrees a pixel, reference pixel 4.5.
PLANE = (180.0, 40.0, 2.0, 4.5)

define("banded", "select pixels.*, band, seq from pixels join images using (image_id)", "pixels", "images")


def banded(spark, d):
    return fx.pixels(spark, d).join(fx.images(spark, d), "image_id")


def r6(df, *names, digits=6):
    return df.withColumns({n: rounded(n, digits) for n in names})


def middle_box():
    return images.box(4, 4, 2)


@register("s4_image_scan", sql("select image_id, count(*) as n, round(sum(val),6)+0.0 as total from pixels group by 1", "pixels"))
def s4(spark, d):
    path = scratch_path(spark, "planes")
    images.write_planes(fx.pixels(spark, d), path)
    return spark.read.parquet(path).groupBy("image_id").agg(F.count("*").alias("n"), rounded(F.sum("val")).alias("total"))


@register("p12_cutout", sql(f"select image_id, x, y, round(val,6)+0.0 as val from pixels where {BOX}", "pixels"))
def p12(spark, d):
    return r6(fx.pixels(spark, d).where(middle_box()), "val")


@register("p13_box_mask", sql("select image_id, x, y, case when (abs(x-2)<=1 and abs(y-2)<=1) or (abs(x-6)<=0 and abs(y-5)<=0) then 1 else 0 end as mask from pixels", "pixels"))
def p13(spark, d):
    boxes = spark.createDataFrame([(2, 2, 3), (6, 5, 1)], "x0 int, y0 int, width int")
    return images.masked_boxes(fx.pixels(spark, d), boxes).select("image_id", "x", "y", "mask")


@register("p14_ellipse", sql("select image_id, count(*) as n, round(sum(val),6)+0.0 as total from (select *, ((x-3.5)*cos(radians(30.0::double))+(y-3.5)*sin(radians(30.0::double)))**2/9+((y-3.5)*cos(radians(30.0::double))-(x-3.5)*sin(radians(30.0::double)))**2/4 as e from pixels) where e<=1 group by 1", "pixels"))
def p14(spark, d):
    inside = sky.in_ellipse(F.col("x"), F.col("y"), 3.5, 3.5, 3.0, 2.0, 30.0) <= 1
    return fx.pixels(spark, d).where(inside).groupBy("image_id").agg(F.count("*").alias("n"), rounded(F.sum("val")).alias("total"))


@register("p15_circular_mask", sql("select image_id, count(v) as n, round(avg(v),6)+0.0 as mean from (select *, case when (x-3.5)**2+(y-3.5)**2<=9 then val end as v from pixels) group by 1", "pixels"))
def p15(spark, d):
    return fx.pixels(spark, d).withColumn("v", images.outside_circle(F.col("val"), 3.5, 3.5, 3.0)).groupBy("image_id").agg(F.count("v").alias("n"), rounded(F.avg("v")).alias("mean"))


@register("p20_tiles", sql("select image_id, (x//4)::int as cx, (y//4)::int as cy, count(*) as n, round(sum(val*(x%4)+y%4),6)+0.0 as total from pixels group by 1,2,3", "pixels"))
def p20(spark, d):
    return images.tiled(fx.pixels(spark, d), 4).groupBy("image_id", "cx", "cy").agg(F.count("*").alias("n"), rounded(F.sum(F.col("val") * F.col("ix") + F.col("iy"))).alias("total"))


@register("p20_untiled", sql("select image_id, x, y, round(val,6)+0.0 as val from pixels", "pixels"))
def p20u(spark, d):
    return r6(images.untiled(images.tiled(fx.pixels(spark, d), 3), 3), "val")


@register("p21_sound_images", sql("select image_id from pixels group by 1 having -min(val)*1.0 <= max(val)", "pixels"))
def p21(spark, d):
    return images.sound_images(fx.pixels(spark, d), 1.0)


@register("a7_co_add", sql("select band, x, y, round(sum(val)/count(*),6)+0.0 as val, count(distinct image_id) as n_images from banded group by 1,2,3", "banded"))
def a7(spark, d):
    return r6(images.co_added(banded(spark, d), ["band"]), "val")


define("boxrms", f"select band, image_id, stddev_pop(val) as rms from banded where {BOX} group by 1,2", "banded")
define("gated", "select image_id from (select *, 1.1*median(rms) filter (where rms>0) over (partition by band) as cut from boxrms) where rms<=cut", "boxrms")


@register("a8_gated_co_add", sql("select band, x, y, round(sum(val)/count(*),6)+0.0 as val, count(distinct image_id) as n_images from banded where image_id in (select image_id from gated) group by 1,2,3", "gated"))
def a8(spark, d):
    return r6(images.gated_co_add(banded(spark, d), ["band"], middle_box(), 1.1), "val")


@register("a9_time_co_add", sql("select band, seq//5 as slot, x, y, round(sum(val)/count(*),6)+0.0 as val, count(distinct image_id) as n_images from banded group by 1,2,3,4 having count(distinct image_id)>=3", "banded"))
def a9(spark, d):
    return r6(images.co_added(banded(spark, d).withColumn("slot", F.expr("seq div 5")), ["band", "slot"], 3), "val")


@register("a9_band_co_add", sql("select case when band>=9 then 3 when band>=4 then 2 else 1 end as part, seq, x, y, round(sum(val)/count(*),6)+0.0 as val, count(distinct image_id) as n_images from banded where band>=1 group by 1,2,3,4", "banded"))
def a9_bands(spark, d):
    """The images of a time by groups of sub-bands."""
    grouped = banded(spark, d).withColumn("part", images.band_group(F.col("band"))).where("part is not null")
    return r6(images.co_added(grouped, ["part", "seq"]), "val")


define("k4_freq", "select seq as image_id, seq//5 as slot, x, y, sum(val)/count(distinct image_id) as val from banded group by 1,2,3,4", "banded")
define("k4_rms", f"select slot, image_id, stddev_pop(val) as rms from k4_freq where {BOX} group by 1,2", "k4_freq")
define("k4_kept", "select image_id from (select *, 1.1*median(rms) filter (where rms>0) over (partition by slot) as cut from k4_rms) where rms<=cut", "k4_rms")


@register("k4_co_add_ladder", sql("select slot, x, y, round(sum(val)/count(*),6)+0.0 as val, count(distinct image_id) as n_images from k4_freq where image_id in (select image_id from k4_kept) group by 1,2,3", "k4_kept"))
def k4(spark, d):
    """All bands of a time into one image, then the quiet images of each time slot."""
    every = images.co_added(banded(spark, d), ["seq"]).select(F.col("seq").alias("image_id"), F.expr("seq div 5").alias("slot"), "x", "y", "val")
    return r6(images.gated_co_add(every, ["slot"], middle_box(), 1.1), "val")


@register("w1_overlapping_pairs", sql("select a.band, a.seq as pair, unnest([a.image_id, b.image_id]) as image_id from images a join images b on a.band=b.band and b.seq=a.seq+1", "images"))
def w1(spark, d):
    return images.moving_pairs(fx.images(spark, d))


@register("a11_mad_noise", sql("select image_id, round(1.4826*median(abs(val-m)),6) as noise from pixels join (select image_id, median(val) as m from pixels group by 1) using (image_id) group by 1", "pixels"))
def a11(spark, d):
    return r6(images.mad_noise(fx.pixels(spark, d), ["image_id"]), "noise")


def _clip_sql(source: str = "pixels", p: str = "", end: str = "select image_id, round(stddev_pop(val),6) as rms, count(*) as n from {p}r5 group by 1") -> str:
    parts = [f"{p}r0 as (select image_id, x, y, val from {source})"]
    state = "select image_id, any_value(m) as m, 1.4826*median(abs(val-m)) as s from (select *, median(val) over (partition by image_id) as m from {}) group by 1"
    parts.append(f"{p}n0 as (select *, s=0 as done from (" + state.format(f"{p}r0") + "))")
    for k in range(1, 6):
        parts.append(f"{p}r{k} as (select r.* from {p}r{k - 1} r join {p}n{k - 1} n using (image_id) where done or abs(val-m)<=2.0*s)")
        parts.append(f"{p}t{k} as ({state.format(f'{p}r{k}')})")
        parts.append(f"{p}n{k} as (select image_id, case when o.done then o.m else t.m end as m, case when o.done then o.s else t.s end as s, o.done or t.s=0 or abs(t.s-o.s)<=1e-8+1e-3*abs(o.s) as done from {p}n{k - 1} o join {p}t{k} t using (image_id))")
    return ",\n" + ",\n".join(parts) + ("\n" + end.format(p=p) if end else "")


@register("a12_clipped_rms", sql(_clip_sql(), "pixels"))
def a12(spark, d):
    return r6(images.clipped_rms(fx.pixels(spark, d), ["image_id"], 2.0), "rms")


@register("a13_two_pass_rms", sql("select image_id, round(stddev_pop(val),6) as rms from (select *, stddev_pop(val) over (partition by image_id) as s from pixels) where abs(val)<2*s group by 1", "pixels"))
def a13(spark, d):
    return r6(images.two_pass_rms(fx.pixels(spark, d), 2.0), "rms")


@register("a14_box_statistics", sql(f"select image_id, round(stddev_pop(val),6) as rms, round(median(val),6)+0.0 as middle, round(max(val),6) as top from pixels where {BOX} group by 1", "pixels"))
def a14(spark, d):
    return r6(images.box_statistics(fx.pixels(spark, d), middle_box()), "rms", "middle", "top")


@register("a15_source_statistics", sql("select image_id, round(stddev_pop(val),6) as rms, round(median(val),6)+0.0 as middle, round(max(val),6) as top from pixels where x>=3 and x<7 and y>=1 and y<5 group by 1", "pixels"))
def a15(spark, d):
    return r6(images.box_statistics(fx.pixels(spark, d), images.box(5, 3, 2)), "rms", "middle", "top")


define("peak", "select image_id, x as px, y as py, val as peak from (select *, row_number() over (partition by image_id order by abs(val) desc, y, x) as r from pixels) where r=1", "pixels")


@register("a16_peaks", sql("select image_id, px, py, round(peak,6) as peak from peak", "peak"))
def a16(spark, d):
    return r6(images.peaks(fx.pixels(spark, d)), "peak")


define("dyn", "select t.image_id, max(t.peak) as top, min(p.val) as low, max(t.peak)/nullif(abs(min(p.val)),0) as dr from (select image_id, x as px, y as py, val as peak from (select *, row_number() over (partition by image_id order by val desc, y, x) as r from pixels) where r=1) t join pixels p on p.image_id=t.image_id and p.x>=px-3 and p.x<px+3 and p.y>=py-3 and p.y<py+3 group by 1", "pixels")


@register("a17_dynamic_range", sql("select a.image_id, coalesce((a.dr-b.dr)/nullif(b.dr,0)>0.2, null) and b.low<0 as worse from dyn a join (select image_id-1 as image_id, dr, low from dyn) b using (image_id)", "dyn"))
def a17(spark, d):
    dyn = images.dynamic_range(fx.pixels(spark, d), 3)
    return images.worsened(dyn, dyn.withColumn("image_id", F.col("image_id") - 1), "image_id")


@register("a32_light_curve", sql("select image_id, round(peak,6) as peak, round(noise,6) as noise, round(abs(peak)/nullif(noise,0),5) as snr, abs(peak)/nullif(noise,0)>3.5 as detected from peak join (select image_id, 1.4826*median(abs(val-m)) as noise from (select *, median(val) over (partition by image_id) as m from pixels) group by 1) using (image_id)", "peak"))
def a32(spark, d):
    return r6(r6(images.light_curve(fx.pixels(spark, d), ["image_id"], 3.5), "peak", "noise"), "snr", digits=5)


@register("a33_plane_consistency", sql("select a.image_id, round(avg(abs(a.val-b.val))/nullif(max(abs(a.val)),0),6) as ratio, avg(abs(a.val-b.val))/nullif(max(abs(a.val)),0)>0.5 as inconsistent from pixels a join (select image_id-1 as image_id, x, y, val from pixels) b using (image_id,x,y) group by 1", "pixels"))
def a33(spark, d):
    one = fx.pixels(spark, d)
    return r6(images.plane_consistency(one, one.withColumn("image_id", F.col("image_id") - 1), ["image_id", "x", "y"], ["image_id"], 0.5), "ratio")


@register("j19_image_difference", sql("select b.image_id, x, y, round(b.val-a.val,6)+0.0 as val from pixels a join (select image_id-1 as image_id, x, y, val from pixels) b using (image_id,x,y)", "pixels"))
def j19(spark, d):
    one = fx.pixels(spark, d)
    return r6(images.subtracted(one.withColumn("image_id", F.col("image_id") - 1), one, ["image_id", "x", "y"]), "val")


def _targets(spark, d):
    """Places half a pixel and a quarter beside those of the plane."""
    return fx.pixels(spark, d).select("x", "y").distinct().withColumns({"sx": F.col("x") + 0.5, "sy": F.col("y") + 0.25})


define("shifted", "select a.image_id, a.x, a.y, 0.375*a.val+0.375*b.val+0.125*c.val+0.125*e.val as val from pixels a join pixels b on b.image_id=a.image_id and b.x=a.x+1 and b.y=a.y join pixels c on c.image_id=a.image_id and c.x=a.x and c.y=a.y+1 join pixels e on e.image_id=a.image_id and e.x=a.x+1 and e.y=a.y+1", "pixels")


@register("j23_reprojection", sql("select image_id, x, y, round(val,6)+0.0 as val from shifted", "shifted"))
def j23(spark, d):
    return r6(images.resampled(fx.pixels(spark, d), _targets(spark, d), ["image_id"]), "val")


@register("a10_stack", sql("select band, x, y, round(sum(val)/count(*),6)+0.0 as val, count(distinct image_id) as n_images from shifted join images using (image_id) group by 1,2,3", "shifted", "images"))
def a10(spark, d):
    moved = images.resampled(fx.pixels(spark, d), _targets(spark, d), ["image_id"])
    return r6(images.co_added(moved.join(fx.images(spark, d), "image_id"), ["band"], 2), "val")


#: A second sky beside PLANE: another centre and scale.
OTHER = (184.0, 41.5, 1.6, 4.5)
_UP = "sqrt(1-{0}.e*{0}.e-{0}.n*{0}.n)"
define("moved_sky", f"select x, y, radians(-(x-{OTHER[3] - 1})*{OTHER[2]}::double) as e, radians((y-{OTHER[3] - 1})*{OTHER[2]}::double) as n from (select unnest(range(8))::int as x) a, (select unnest(range(8))::int as y) b")
define("moved_at", f"select x, y, {OTHER[0]}::double+degrees(atan2(e, {_UP.format('m')}*cos(radians({OTHER[1]}::double))-n*sin(radians({OTHER[1]}::double))))-{PLANE[0]} as h, asin({_UP.format('m')}*sin(radians({OTHER[1]}::double))+n*cos(radians({OTHER[1]}::double))) as dec from moved_sky m", "moved_sky")
define("moved_map", f"select x, y, round(-degrees(cos(dec)*sin(radians(h)))/{PLANE[2]}+{PLANE[3] - 1},9) as sx, round(degrees(sin(dec)*cos(radians({PLANE[1]}::double))-cos(dec)*sin(radians({PLANE[1]}::double))*cos(radians(h)))/{PLANE[2]}+{PLANE[3] - 1},9) as sy from moved_at", "moved_at")
define("moved", """select i.image_id, m.x, m.y, case when w00>0 then w00*a.val else 0 end + case when w01>0 then w01*c.val else 0 end + case when w10>0 then w10*b.val else 0 end + case when w11>0 then w11*f.val else 0 end as val
 from (select distinct image_id from pixels) i, (select *, floor(sx) as bx, floor(sy) as by_, (1-(sx-floor(sx)))*(1-(sy-floor(sy))) as w00, (sx-floor(sx))*(1-(sy-floor(sy))) as w10, (1-(sx-floor(sx)))*(sy-floor(sy)) as w01, (sx-floor(sx))*(sy-floor(sy)) as w11 from moved_map) m
 left join pixels a on a.image_id=i.image_id and a.x=bx and a.y=by_ left join pixels b on b.image_id=i.image_id and b.x=bx+1 and b.y=by_
 left join pixels c on c.image_id=i.image_id and c.x=bx and c.y=by_+1 left join pixels f on f.image_id=i.image_id and f.x=bx+1 and f.y=by_+1""", "pixels", "moved_map")


@register("j23_two_skies", sql("select image_id, x, y, round(val,6)+0.0 as val from moved", "moved"))
def j23_two_skies(spark, d):
    """The images of one sky on the plane of another with its own centre and scale."""
    return r6(images.reprojected(fx.pixels(spark, d), ["image_id"], 8, OTHER, PLANE), "val")


@register("a10_stack_two_skies", sql("select band, x, y, case when count(val)=count(*) then round(sum(val)/count(*),6)+0.0 end as val, count(*) as n_images from (select image_id, x, y, val from moved where image_id%2=1 union all select image_id, x, y, val from pixels where image_id%2=0) join images using (image_id) group by 1,2,3", "moved", "images"))
def a10_two_skies(spark, d):
    """Images of odd numbers, which lie on another sky, are brought to the plane of the others and stacked with them by band."""
    one = fx.pixels(spark, d)
    brought = images.reprojected(one.where("image_id % 2 = 1"), ["image_id"], 8, OTHER, PLANE)
    both = one.where("image_id % 2 = 0").unionByName(brought)
    return r6(images.stacked(both.join(fx.images(spark, d), "image_id"), ["band"]), "val")


@register("w6_median_residual", sql("select p.image_id, p.x, p.y, round(p.val-median(coalesce(q.val,0)),6)+0.0 as val from pixels p cross join (select i.i as i, j.j as j from (select unnest(range(-10,11)) as i) i, (select unnest(range(-10,11)) as j) j) o left join pixels q on q.image_id=p.image_id and q.x=p.x+o.i and q.y=p.y+o.j group by p.image_id,p.x,p.y,p.val", "pixels"))
def w6(spark, d):
    return r6(images.median_residual(fx.pixels(spark, d), 10), "val")


define("cells", "select *, (x//4)::int as cx, (y//4)::int as cy from pixels", "pixels")
define("hits1", "select *, abs(val)>=3*stddev_pop(val) over (partition by image_id,cx,cy) as h1 from cells", "cells")
define("hits2", "select *, abs(val)>=3*stddev_pop(case when not h1 then val end) over (partition by image_id,cx,cy) as h2 from hits1", "hits1")
define("hits", "select image_id,x,y,val,cx,cy from (select *, max(case when h2 then 1 else 0 end) over (partition by image_id,cx,cy)=1 as a from hits2) where case when a then h2 else h1 end", "hits2")
define("loose", "select image_id,x,y,val,y*(1::bigint<<20)+x as hit from (select *, stddev_pop(val) over (partition by image_id) as s from pixels) where abs(val)>=2*s", "pixels")


def _hits(spark, d):
    return sources.detections(images.tiled(fx.pixels(spark, d), 4).drop("ix", "iy"), 3.0)


def _loose(spark, d):
    pix = fx.pixels(spark, d)
    return pix.join(pix.groupBy("image_id").agg(F.stddev_pop("val").alias("s")), "image_id").where(F.abs("val") >= 2 * F.col("s")).drop("s")


@register("x1_detections", sql("select image_id, cx, cy, x, y, round(val,6) as val from hits", "hits"))
def x1(spark, d):
    return r6(_hits(spark, d), "val")


define("fof", "select image_id, hit, min(root) as cluster from (with recursive r(image_id, hit, root) as (select image_id, hit, hit from loose union select r.image_id, b.hit, r.root from r join loose a on a.image_id=r.image_id and a.hit=r.hit join loose b on b.image_id=a.image_id and (a.x-b.x)**2+(a.y-b.y)**2<=2.25) select * from r) group by 1,2", "loose")


@register("x2_clusters", sql("select image_id, x, y, cluster from loose join fof using (image_id, hit)", "fof"))
def x2(spark, d):
    return sources.clusters(_loose(spark, d), 1.5).select("image_id", "x", "y", "cluster")


define("x2_pairs", "select image_id, a.hit as a, b.hit as b, sqrt(((a.x-b.x)**2+(a.y-b.y)**2)::double) as w from loose a join loose b using (image_id) where a.hit<>b.hit", "loose")
define("x2_joined", "select image_id, t, hit, min(root) as root from (with recursive r(image_id, t, hit, root) as (select image_id, t, hit, hit from loose join (select distinct image_id, w as t from x2_pairs) using (image_id) union select r.image_id, r.t, p.b, r.root from r join x2_pairs p on p.image_id=r.image_id and p.a=r.hit and p.w<=r.t) select * from r) group by 1,2,3", "x2_pairs")
define("x2_parts", "select image_id, t, count(distinct root) as parts, lag(count(distinct root)) over (partition by image_id order by t) as more from x2_joined group by 1,2", "x2_joined")
define("x2_merges", "select image_id, t as w, unnest(range(coalesce(more, (select count(*) from loose l where l.image_id=p.image_id))-parts)) as i from x2_parts p", "x2_parts")
define("x2_steps", "select image_id, w, row_number() over (partition by image_id order by w desc) as r, w-lead(w) over (partition by image_id order by w desc) as step, count(*) over (partition by image_id) as m from x2_merges", "x2_merges")
define("x2_first", "select image_id, m, max(w) as top, case when m=1 then 1.0::double when max(step) filter (where r=1)>2 then 2.0::double else max(w) end as cut from x2_steps group by 1,2", "x2_steps")
define("x2_above", "select f.image_id, f.m, f.top, f.cut, count(*) filter (where s.w>f.cut) as k from x2_first f join x2_steps s on s.image_id=f.image_id group by all", "x2_first")
define("x2_cut", "select a.image_id, case when a.m>3 and a.top<>1 and a.m<>a.k+1 and max(step) filter (where r=greatest(a.k,1))<4 and coalesce(max(step) filter (where r=a.k-1),0)<2 then 4.0::double else a.cut end as cut from x2_above a join x2_steps s on s.image_id=a.image_id group by a.image_id, a.m, a.top, a.cut, a.k", "x2_above")


@register("x2_adaptive_clusters", sql("""
select l.image_id, l.x, l.y, coalesce(j.root, l.hit) as cluster from loose l left join (select c.image_id, max(p.t) as t from x2_cut c join x2_parts p on p.image_id=c.image_id and p.t<=c.cut group by 1) c on c.image_id=l.image_id
 left join x2_joined j on j.image_id=l.image_id and j.t=c.t and j.hit=l.hit""", "x2_cut"))
def x2_adaptive(spark, d):
    """Single linkage of the hits of each image; sources are 2 pixels apart in place of 14."""
    return sources.adaptive_clusters(_loose(spark, d), ["image_id"], 10.0, 2.0).select("image_id", "x", "y", "cluster")


define("summary", """select image_id, cluster, count(*) as n, max(x) filter (where r=1) as x, max(y) filter (where r=1) as y, max(val) filter (where r=1) as peak,
  greatest(0,min(x)-1) as x1, least(7,max(x)+1) as x2, greatest(0,min(y)-1) as y1, least(7,max(y)+1) as y2
  from (select *, row_number() over (partition by image_id,cluster order by abs(val) desc,y,x) as r from loose join fof using (image_id,hit)) group by 1,2""", "fof")


def _summary(spark, d):
    return sources.cluster_summary(sources.clusters(_loose(spark, d), 1.5), 1, 8)


@register("x3_cluster_summary", sql("select image_id, cluster, n, x, y, round(peak,6) as peak, x1, x2, y1, y2 from summary", "summary"))
def x3(spark, d):
    return r6(_summary(spark, d), "peak")


RA0, DEC0, SCALE, CENTRE = PLANE
define(
    "skied",
    f"""select *, (({RA0}::double+degrees(atan2(e, u*cos(d0)-n0*sin(d0))))%360+360)%360 as ra, degrees(asin(u*sin(d0)+n0*cos(d0))) as dec from (
  select *, sqrt(1-e*e-n0*n0) as u, radians({DEC0}::double) as d0 from (select *, radians(-(x-{CENTRE - 1})*{SCALE}::double) as e, radians((y-{CENTRE - 1})*{SCALE}::double) as n0 from summary))""",
    "summary",
)


@register("x4_sky_coordinates", sql("select image_id, cluster, round(ra,6) as ra, round(dec,6) as dec from skied", "skied"))
def x4(spark, d):
    return r6(sources.with_sky(_summary(spark, d), *PLANE).select("image_id", "cluster", "ra", "dec"), "ra", "dec")


@register("x5_catalogue", sql("select row_number() over (order by image_id, cluster)-1 as id, image_id, round(ra,6) as ra, round(dec,6) as dec, round(peak,6) as peak_flux from skied", "skied"))
def x5(spark, d):
    made = sources.with_sky(_summary(spark, d), *PLANE)
    return r6(sources.numbered(made, ["image_id", "cluster"]).select("id", "image_id", "ra", "dec", F.col("peak").alias("peak_flux")), "ra", "dec", "peak_flux")


def _sep(d1, r1, d2, r2):
    return (
        f"degrees(atan2(sqrt((cos(radians({d2}))*sin(radians(abs({r2}-{r1}))))**2+(cos(radians({d1}))*sin(radians({d2}))-sin(radians({d1}))*cos(radians({d2}))*cos(radians(abs({r2}-{r1}))))**2),"
        f"sin(radians({d1}))*sin(radians({d2}))+cos(radians({d1}))*cos(radians({d2}))*cos(radians(abs({r2}-{r1})))))"
    )


define("near", f"select * from (select c.*, p.pid, p.flux, {_sep('c.dec', 'c.ra', 'p.dec', 'p.ra')} as sep, row_number() over (partition by c.id order by {_sep('c.dec', 'c.ra', 'p.dec', 'p.ra')}, p.pid) as r from catalog c, persist p) where r=1", "catalog", "persist")


define("k3_diff", "select b.image_id, x, y, b.val-a.val as val from pixels a join (select image_id-1 as image_id, x, y, val from pixels) b using (image_id,x,y)", "pixels")
define("k3_cells", "select *, (x//4)::int as cx, (y//4)::int as cy from k3_diff", "k3_diff")
define("k3_loose", "select image_id,x,y,val,y*(1::bigint<<20)+x as hit from k3_hits", "k3_hits")
again("k3_", ["cells", "hits1", "hits2", "hits", "loose", "fof", "summary", "skied"], ["hits1", "hits2", "hits", "fof", "summary", "skied"])
define("k3_noise", "select image_id, stddev_pop(val) as local_rms from k3_diff group by 1", "k3_diff")
define("k3_catalog", "select row_number() over (order by image_id, cluster)-1 as id, image_id, ra, dec, abs(peak) as peak_flux, local_rms from k3_skied join k3_noise using (image_id)", "k3_skied", "k3_noise")
define("k3_near", f"select * from (select c.*, p.pid, p.flux, {_sep('c.dec', 'c.ra', 'p.dec', 'p.ra')} as sep, row_number() over (partition by c.id order by {_sep('c.dec', 'c.ra', 'p.dec', 'p.ra')}, p.pid) as r from k3_catalog c, persist p) where r=1", "k3_catalog", "persist")


@register("k3_transient_search", sql("select id, image_id, round(ra,5) as ra, round(dec,5) as dec, pid, round(sep,5) as sep, 0 as class, 'NA' as class_name from k3_near where peak_flux/local_rms>2.5 and dec<44 and (sep>3.0 or peak_flux/nullif(flux,0)>1.5)", "k3_near"))
def k3(spark, d):
    """Difference of following images, detections, clusters, catalogue, cuts, veto of known sources, class to be reviewed."""
    one = fx.pixels(spark, d)
    diff = written(images.subtracted(one.withColumn("image_id", F.col("image_id") - 1), one, ["image_id", "x", "y"]), "difference")
    found = sources.detections(images.tiled(diff, 4).drop("ix", "iy"), 3.0)
    made = sources.with_sky(sources.cluster_summary(sources.clusters(found, 1.5), 1, 8), *PLANE)
    noise = diff.groupBy("image_id").agg(F.stddev_pop("val").alias("local_rms"))
    cat = sources.numbered(made, ["image_id", "cluster"]).withColumn("peak_flux", F.abs("peak")).join(noise, "image_id")
    cat = sources.sifted(cat, 2.5, 44.0)
    near = sources.nearest_on_sky(cat, fx.persist(spark, d)).select("id", "near")
    kept = sources.vetoed(cat.join(near, "id"), 3.0, 1.5).where("not veto").withColumn("class", F.lit(sources.NOT_CLASSIFIED))
    out = sources.class_names(kept).select("id", "image_id", "ra", "dec", F.col("near.pid").alias("pid"), F.col("near.sep").alias("sep"), "class", "class_name")
    return r6(out, "ra", "dec", "sep", digits=5)


@register("j11_nearest_source", sql("select id, pid, round(sep,6) as sep from near", "near"))
def j11(spark, d):
    return r6(sources.nearest_on_sky(fx.catalog(spark, d), fx.persist(spark, d)).select("id", F.col("near.pid").alias("pid"), F.col("near.sep").alias("sep")), "sep")


def _matched(spark, d):
    cat = fx.catalog(spark, d)
    near = sources.nearest_on_sky(cat, fx.persist(spark, d)).select("id", "near")
    return sources.vetoed(cat.join(near, "id"), 3.0, 1.5)


@register("j12_known_source_veto", sql("select id, not (sep>3.0 or peak_flux/nullif(flux,0)>1.5) as veto from near", "near"))
def j12(spark, d):
    return _matched(spark, d).select("id", "veto")


@register("p9_candidate_cuts", sql("select id, round(peak_flux/local_rms,6) as snr from catalog where peak_flux/local_rms>6.5 and dec<50", "catalog"))
def p9(spark, d):
    return sources.sifted(fx.catalog(spark, d), 6.5, 50.0).select("id", rounded(F.col("peak_flux") / F.col("local_rms")).alias("snr"))


@register("x6_sifting", sql("select id, 0 as class, (select count(*) from near where peak_flux/local_rms>6.5 and dec<50 and not (sep>3.0 or peak_flux/nullif(flux,0)>1.5)) as coincidences from near where peak_flux/local_rms>6.5 and dec<50 and (sep>3.0 or peak_flux/nullif(flux,0)>1.5)", "near"))
def x6(spark, d):
    told = sources.sifted(_matched(spark, d), 6.5, 50.0)
    n = told.agg(F.count_if("veto").alias("coincidences"))
    return told.where("not veto").join(F.broadcast(n)).select("id", F.lit(sources.NOT_CLASSIFIED).alias("class"), "coincidences")  # one row


@register("x7_reviewed_classes", sql("select id, case when id%10=3 then 6 else 0 end as class, case when id%10=3 then 'SCINT' else 'NA' end as class_name from catalog", "catalog"))
def x7(spark, d):
    cat = fx.catalog(spark, d)
    told = sources.reviewed(cat, cat.where("id % 10 = 3").select("id", F.lit(6).alias("class")))
    return sources.class_names(told).select("id", "class", "class_name")


define("shifted_catalog", "select id, ra, dec+0.4 as dec, peak_flux, local_rms from catalog", "catalog")
define("near_shifted", f"select id, min({_sep('c.dec', 'c.ra', 'p.dec', 'p.ra')}) as sep from shifted_catalog c, persist p group by 1", "shifted_catalog", "persist")


@register("a34_match_statistics", sql("select round(median(a.sep),6) as before, round(median(b.sep),6) as after, round(median(a.sep)-median(b.sep),6)+0.0 as score from near a join near_shifted b using (id)", "near", "near_shifted"))
def a34(spark, d):
    """The median separation of matches before and after the catalogue is moved by 0.4 degrees in declination."""
    cat, known = fx.catalog(spark, d), fx.persist(spark, d)
    middle = lambda df, name: ordering.median_of_all(sources.nearest_on_sky(df, known), F.col("near.sep"), name)
    both = middle(cat, "a").join(F.broadcast(middle(cat.withColumn("dec", F.col("dec") + 0.4), "b")))  # one row each
    return both.select(rounded("a").alias("before"), rounded("b").alias("after"), rounded(F.col("a") - F.col("b")).alias("score"))


@register("a35_typical_noise", sql("select median(r) as noise, count(*) as n from (select distinct local_rms as r from catalog)", "catalog"))
def a35(spark, d):
    return fx.catalog(spark, d).select("local_rms").distinct().agg(F.median("local_rms").alias("noise"), F.count("*").alias("n"))


@register("s14_catalogue_columns", sql("select id, ra, dec, round(peak_flux,6) as peak_flux, null::bigint as x, local_rms, '2024-01-01' as date_obs, 2460310.5::double as jd_obs from catalog", "catalog"))
def s14(spark, d):
    from ..sources.tables import catalogue

    cat = fx.catalog(spark, d).withColumns({c: F.lit(1.0) for c in ("a", "b", "pa")})
    path = scratch_path(spark, "catalogue")
    catalogue(cat, "2024-01-01", 2460310.5, "id").write.parquet(path)
    return spark.read.parquet(path).select("id", "ra", "dec", rounded("peak_flux").alias("peak_flux"), "x", "local_rms", "date_obs", "jd_obs")


@register("w13_sequential_id", sql("select row_number() over (order by ra, dec, id)-1 as seq, id from catalog", "catalog"))
def w13(spark, d):
    return sources.numbered(fx.catalog(spark, d).withColumnRenamed("id", "key"), ["ra", "dec", "key"]).select(F.col("id").alias("seq"), F.col("key").alias("id"))


@register("f1_separation", sql(f"select id, round({_sep('c.dec', 'c.ra', 'p.dec', 'p.ra')},6) as sep from catalog c join persist p on p.pid=c.id%10+1", "catalog", "persist"))
def f1(spark, d):
    p = fx.persist(spark, d).select("pid", F.col("ra").alias("ra2"), F.col("dec").alias("dec2"))
    return fx.catalog(spark, d).join(p, F.col("pid") == F.col("id") % 10 + 1).select("id", rounded(sky.separation("dec", "ra", "dec2", "ra2")).alias("sep"))


_EL = "degrees(asin(greatest(-1,least(1,sin(radians(dec))*sin(radians({lat}::double))+cos(radians(dec))*cos(radians({lat}::double))*cos(radians(ra-{lst}))))))"
_AZ = "(degrees(atan2(-cos(radians(dec))*sin(radians({lst}-ra)),sin(radians(dec))*cos(radians({lat}::double))-cos(radians(dec))*sin(radians({lat}::double))*cos(radians({lst}-ra))))+360)%360"


@register("f2_altaz", sql(f"select id, round({_EL.format(lat=37.2, lst='100.0')},6) as el, round({_AZ.format(lat=37.2, lst='100.0')},6) as az from catalog", "catalog"))
def f2(spark, d):
    at = (F.lit(100.0), F.lit(37.2))
    return fx.catalog(spark, d).select("id", rounded(sky.elevation("ra", "dec", *at)).alias("el"), rounded(sky.azimuth("ra", "dec", *at)).alias("az"))


@register("f7_power_law", sql("select id, round(peak_flux*10**(-0.7*log10(60.0/80.0)),5) as flux from catalog", "catalog"))
def f7(spark, d):
    return fx.catalog(spark, d).select("id", rounded(sky.power_law("peak_flux", F.lit(-0.7), 60.0, 80.0), 5).alias("flux"))


define("proj", "select id, ra, dec, sin(radians(dec))*sin(radians(40.0::double))+cos(radians(dec))*cos(radians(40.0::double))*cos(radians(ra-180)) as up, degrees(cos(radians(dec))*sin(radians(ra-180))) as east, degrees(sin(radians(dec))*cos(radians(40.0::double))-cos(radians(dec))*sin(radians(40.0::double))*cos(radians(ra-180))) as north from catalog", "catalog")


@register("f9_sky_to_pixel", sql("select id, round(case when up>0 then -east/2.0+3.5 end,6) as px, round(case when up>0 then north/2.0+3.5 end,6) as py from proj", "proj"))
def f9(spark, d):
    x, y = sky.sky_to_pixel("ra", "dec", *PLANE)
    return fx.catalog(spark, d).select("id", rounded(x).alias("px"), rounded(y).alias("py"))


@register("f10_pixel_to_sky", sql("select id, case when up>0 then round(ra,5) end as ra, case when up>0 then round(dec,5) end as dec from proj", "proj"))
def f10(spark, d):
    x, y = sky.sky_to_pixel("ra", "dec", *PLANE)
    cat = fx.catalog(spark, d).withColumns({"px": x, "py": y})
    ra, dec = sky.pixel_to_sky("px", "py", *PLANE)
    return cat.select("id", rounded(ra, 5).alias("ra"), rounded(dec, 5).alias("dec"))


@register("f11_beam_correction", sql(f"select id, case when el>1 then round(peak_flux/sin(radians(el))**1.6,4) end as flux, case when el>0 then round(log10(peak_flux/sin(radians(el))**1.6),6)+0.0 end as log_flux from (select *, {_EL.format(lat=37.2, lst='100.0')} as el from catalog)", "catalog"))
def f11(spark, d):
    """Every source above the horizon; those within a degree of it, whose flux grows without bound, by the logarithm alone."""
    cat = fx.catalog(spark, d).withColumn("el", sky.elevation("ra", "dec", F.lit(100.0), F.lit(37.2)))
    flux = F.try_divide("peak_flux", sky.beam_gain("el"))
    return cat.select("id", F.when(F.col("el") > 1, rounded(flux, 4)).alias("flux"), rounded(F.log10(flux)).alias("log_flux"))


define("beams", "select chan, " + ", ".join(f"avg(m{i}{j}) as m{i}{j}" for i in range(4) for j in {0, i}) + " from mueller group by 1", "mueller")


@register("f11_leakage", sql("""
select p.image_id, p.x, p.y, round((p.val-case p.stokes when 0 then 0 when 1 then m10*coalesce(i.val,0) when 2 then m20*coalesce(i.val,0) else m30*coalesce(i.val,0) end)/nullif(case p.stokes when 0 then m00 when 1 then m11 when 2 then m22 else m33 end,0),6)+0.0 as val
from (select *, band%4 as stokes, band//4 as part from banded) p join beams on chan=seq%24 left join (select band//4 as part, seq, x, y, val from banded where band%4=0) i using (part,seq,x,y)""", "banded", "beams"))
def f11_leakage(spark, d):
    """Four bands as the Stokes images of a time, under the mean Mueller matrix of a channel."""
    rows = banded(spark, d).withColumns({"stokes": F.col("band") % 4, "part": F.expr("band div 4"), "chan": F.col("seq") % fx.N_CHAN})
    means = mueller_of_gains(spark, d).groupBy("chan").agg(*(F.avg(m).alias(m) for m in ENTRIES))
    return r6(beam.without_leakage(rows, means, ["part", "seq"], ["chan"]).select("image_id", "x", "y", "val"), "val")


@register("f13_gaussian", sql("select image_id, round(sum(val*(0.1+2*exp(-(a*(x-3)**2+2*b*(x-3)*(y-4)+c*(y-4)**2)))),6)+0.0 as weighted from pixels, (select cos(t)**2/(2*sx**2)+sin(t)**2/(2*sy**2) as a, sin(2*t)/(4*sy**2)-sin(2*t)/(4*sx**2) as b, sin(t)**2/(2*sx**2)+cos(t)**2/(2*sy**2) as c from (select radians(25.0::double) as t, 5.0::double/2.35482 as sx, 3.0::double/2.35482 as sy)) group by 1", "pixels"))
def f13(spark, d):
    g = sky.gaussian(F.col("x"), F.col("y"), 2.0, 3.0, 4.0, 5.0, 3.0, 25.0, 0.1)
    return fx.pixels(spark, d).groupBy("image_id").agg(rounded(F.sum(F.col("val") * g)).alias("weighted"))


@register("f14_downsize_ratio", sql("select chan, round(greatest(1.0::double, greatest(300.0::double, degrees(3e8::double/f_hz/3000.0)*3600)/3.0/60.0),6) as ratio from freqs", "freqs"))
def f14(spark, d):
    theoretical = F.degrees(3e8 / F.col("f_hz") / 3000.0) * 3600
    return fx.freqs(spark, d).select("chan", rounded(F.greatest(F.lit(1.0), F.greatest(F.lit(300.0), theoretical) / 3.0 / 60.0)).alias("ratio"))


@register("j13_nearest_beam_cell", sql("select c.id, round(g.gain,6) as gain from catalog c left join (select ra_i, dec_i, cos(radians(dec_i*5.0::double))+ra_i/100.0::double as gain from (select distinct cast(round_even(ra/10,0) as bigint) as ra_i, cast(round_even((dec+90)/5,0) as bigint) as dec_i from persist)) g on g.ra_i=cast(round_even(c.ra/10,0) as bigint) and g.dec_i=cast(round_even((c.dec+90)/5,0) as bigint)", "catalog", "persist"))
def j13(spark, d):
    cell = lambda c, o, s: F.rint((F.col(c) - o) / s).cast("bigint")
    grid = fx.persist(spark, d).select(cell("ra", 0, 10.0).alias("ra_i"), cell("dec", -90, 5.0).alias("dec_i")).distinct()
    grid = grid.withColumn("gain", F.cos(F.radians(F.col("dec_i") * 5.0)) + F.col("ra_i") / 100.0)
    return r6(beam.nearest_cell(fx.catalog(spark, d), grid, {"ra": (0.0, 10.0), "dec": (-90.0, 5.0)}, ["gain"]).select("id", "gain"), "gain")


@register("j14_trilinear_beam", sql("select id, round(2*(ra/10.0::double)+3*((dec+90)/5.0::double)-(local_rms-50)/20.0::double,5)+0.0 as gain from catalog", "catalog"))
def j14(spark, d):
    cat = fx.catalog(spark, d).withColumn("rms", F.col("local_rms"))
    axes = {"ra": (0.0, 10.0), "dec": (-90.0, 5.0), "rms": (50.0, 20.0)}
    spans = {"ra": 37, "dec": 37, "rms": 27}
    grid = spark.range(1)  # a beam model is linear on its own grid: the interpolation must give it back
    for a, n in spans.items():
        grid = grid.withColumn(f"{a}_i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n).cast("bigint"))))
    grid = grid.withColumn("gain", 2.0 * F.col("ra_i") + 3.0 * F.col("dec_i") - F.col("rms_i"))
    return r6(beam.trilinear(cat, grid, axes, "gain", "id"), "gain", digits=5)


@register("j14_jones", sql("""
select id, round(1-0.0217391*t,5)+0.0 as x_theta_re, round(0.00141421356*t*p/(f+1),5)+0.0 as x_phi_im, round(-0.5315792*t/(f+1),5)+0.0 as y_theta_re, round(1+0.0113137*p*t,5)+0.0 as y_phi_re
from (select id, (local_rms-50)/20.0::double as f, (dec+90)/5.0::double as t, ra/10.0::double as p from catalog)""", "catalog"))
def j14_jones(spark, d):
    """Fields that are linear along each axis of the grid, so that interpolation gives them back, with a zenith that grows with frequency."""
    at = fx.catalog(spark, d).select("id", F.col("local_rms").alias("freq"), F.col("dec").alias("theta"), F.col("ra").alias("phi"))
    axes, spans = {"freq": (50.0, 20.0), "theta": (-90.0, 5.0), "phi": (0.0, 10.0)}, {"freq": 27, "theta": 37, "phi": 37}
    grid = spark.range(1)
    for a, n in spans.items():
        grid = grid.withColumn(f"{a}_i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n).cast("bigint"))))
    f, t, p = F.col("freq_i") + 1, F.col("theta_i"), F.col("phi_i")
    fields = {"x_theta_re": f * (1 - 0.0217391 * t), "x_phi_im": 0.00141421356 * t * p, "y_theta_re": -0.5315792 * t, "y_phi_re": f * (1 + 0.0113137 * p * t)}
    grid = grid.withColumns({name: fields.get(name, F.lit(0.0)) for name in beam.FIELDS})
    return r6(beam.jones(at, grid, axes, "id").select("id", *fields), *fields, digits=5)


@register("j15_horizon", sql(f"select id, round(5+5*sin(radians(round_even({_AZ.format(lat=37.2, lst='100.0')},0)::double)),6)+0.0 as horizon from catalog", "catalog"))
def j15(spark, d):
    cat = fx.catalog(spark, d).withColumn("az_i", F.rint(sky.azimuth("ra", "dec", F.lit(100.0), F.lit(37.2))).cast("bigint"))
    horizon = spark.range(361).select(F.col("id").alias("az_i"), (5 + 5 * F.sin(F.radians("id"))).alias("horizon"))
    return r6(cat.join(F.broadcast(horizon), "az_i").select("id", "horizon"), "horizon")  # 361 rows


@register("g3_spectral_components", sql("select id, round(peak_flux*10**(0.5*(-0.1)),5) as flux from catalog union all select id, round(0.25*peak_flux*10**(-0.2*(-0.1)),5) from catalog", "catalog"))
def g3(spark, d):
    part = lambda share, index: F.struct((share * F.col("peak_flux")).alias("flux"), F.array(F.lit(index)).alias("index"))
    model = fx.catalog(spark, d).select("id", F.array(part(1.0, 0.5), part(0.25, -0.2)).alias("components"))
    flat = model.select("id", F.explode("components").alias("c"))
    return flat.select("id", rounded(F.col("c.flux") * F.pow(F.lit(10.0), F.element_at("c.index", 1) * -0.1), 5).alias("flux"))


@register("t3_sources_by_flux", sql("select row_number() over (order by peak_flux desc, id) as rank, id from catalog", "catalog"))
def t3(spark, d):
    return images.ranked(fx.catalog(spark, d), [], [F.desc("peak_flux"), "id"]).select("rank", "id")


define("central", "select * from pixels where (x-3.5)**2+(y-3.5)**2<=9", "pixels")
define("emptied", "select r.* from central r anti join hits h on h.image_id=r.image_id and h.x=r.x and h.y=r.y", "central", "hits")


@register("k8_stage_rms", sql(_clip_sql("central", "a", "") + _clip_sql("emptied", "b", "select image_id, round(u.rms,6) as before, round(w.rms,6) as after from (select image_id, stddev_pop(val) as rms from ar5 group by 1) u left join (select image_id, stddev_pop(val) as rms from br5 group by 1) w using (image_id)"), "emptied"))
def k8(spark, d):
    """The clipped rms of the middle of each image before and after its detections are taken out."""
    before = fx.pixels(spark, d)
    after = before.join(_hits(spark, d), ["image_id", "x", "y"], "left_anti")
    stages = before.withColumn("stage", F.lit("before")).unionByName(after.withColumn("stage", F.lit("after")))
    kept = stages.withColumn("val", images.outside_circle(F.col("val"), 3.5, 3.5, 3.0)).where("val is not null")
    rms = images.clipped_rms(kept, ["stage", "image_id"], 2.0)
    pivoted = rms.groupBy("image_id").agg(*(F.max(F.when(F.col("stage") == k, F.col("rms"))).alias(k) for k in ("before", "after")))
    return r6(pivoted, "before", "after")
