"""Registered queries on visibilities, gains and flags, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import amp, phase_deg, rounded
from ..operators import calibrate, flags, spectra
from ..session import scratch_path
from ..sources import fixtures as fx
from ..sources import tables
from ..sources.fixtures import FLAGGED_ANTENNAS, FLAGGED_BASELINES, OUTRIGGERS
from .oracle import define, sql
from .registry import register

SAMPLE = ["scan", "ant1", "ant2", "chan", "corr"]
OUT = f"({', '.join(map(str, OUTRIGGERS))})"
PHASE = (180.0, 37.0, 181.0, 37.5)

define("autos", "select *, sqrt(re*re+im*im) as amp from vis where ant1=ant2", "vis")
define("crosses", "select *, sqrt(re*re+im*im) as amp from vis where ant1<>ant2", "vis")
define(
    "paired",
    """select v.*, a.gr as ar, a.gi as ai, a.flag as af, b.gr as br, b.gi as bi, b.flag as bf from vis v
  left join gains a on a.ant=v.ant1 and a.chan=v.chan and a.pol=v.corr//2 left join gains b on b.ant=v.ant2 and b.chan=v.chan and b.pol=v.corr%2""",
    "vis", "gains",
)
define("product", "select *, ar*br+ai*bi as pr, ai*br-ar*bi as pi, max(case when flag then 1 else 0 end) over (partition by scan,ant1,ant2,chan)=1 as bad from paired", "paired")
define(
    "calibrated",
    """select scan,ant1,ant2,chan,corr,flag,af,bf,bad,(re*pr+im*pi)/nullif(pr*pr+pi*pi,0) as cr,(im*pr-re*pi)/nullif(pr*pr+pi*pi,0) as ci from product""",
    "product",
)
define("flagged", "select *, case when bad or coalesce(af,true) or coalesce(bf,true) then null else cr end as fr, case when bad or coalesce(af,true) or coalesce(bf,true) then null else ci end as fi from calibrated where ant1<>ant2", "calibrated")
define("spectrum", "select scan,chan,corr,avg(sqrt(fr*fr+fi*fi)) as amp, count(fr) as n from flagged group by 1,2,3", "flagged")
define("autodb", "select ant1 as ant,scan,chan,corr,10*log10(nullif(amp,0)/100.0) as db from autos where corr in (0,3)", "autos")


def ants(spark):
    return spark.createDataFrame([(a,) for a in FLAGGED_ANTENNAS], "ant bigint")


def bls(spark):
    return spark.createDataFrame(list(FLAGGED_BASELINES), "ant1 bigint, ant2 bigint")


def r6(df, *names, digits=6):
    return df.withColumns({n: rounded(n, digits) for n in names})


@register("p1_auto_selection", sql("select ant1, scan, count(*) as n, count(*) filter (where flag) as flagged from autos group by 1,2", "autos"))
def p1(spark, d):
    return fx.vis(spark, d).where("ant1 = ant2").groupBy("ant1", "scan").agg(F.count("*").alias("n"), F.count_if("flag").alias("flagged"))


@register("p2_uv_cut", sql("select v.scan, v.corr, count(*) as n, round(max(sqrt(u*u+v.v*v.v)),6) as longest from (select vis.*, u, uvw.v from vis join uvw using (ant1,ant2)) v where sqrt(u*u+v.v*v.v) > 50 group by 1,2", "vis", "uvw"))
def p2(spark, d):
    dist = F.sqrt(F.col("u") * F.col("u") + F.col("v") * F.col("v"))
    both = fx.vis(spark, d).join(fx.uvw(spark, d), ["ant1", "ant2"]).where(dist > 50)
    return both.groupBy("scan", "corr").agg(F.count("*").alias("n"), rounded(F.max(dist)).alias("longest"))


@register("p3_corr_split", sql("select scan, ant1, ant2, chan, corr, round(re,6) as re, round(im,6)+0.0 as im from vis where corr in (0,3)", "vis"))
def p3(spark, d):
    return r6(fx.vis(spark, d).where("corr in (0, 3)").select(*SAMPLE, "re", "im"), "re", "im")


@register("p16_id_normalised", sql("select scan, 0 as field_id, 0 as observation_id, count(*) as n from vis group by 1", "vis"))
def p16(spark, d):
    return fx.vis(spark, d).withColumns({"field_id": F.lit(0), "observation_id": F.lit(0)}).groupBy("scan", "field_id", "observation_id").agg(F.count("*").alias("n"))


@register("p17_column_promotion", sql("select scan,ant1,ant2,chan,corr, round(coalesce(cr, re),6) as data_re from calibrated join vis using (scan,ant1,ant2,chan,corr)", "calibrated"))
def p17(spark, d):
    raw = fx.vis(spark, d)
    done = calibrate.apply_bandpass(raw, fx.gains(spark, d)).select(*SAMPLE, F.col("re").alias("corrected"))
    return raw.join(done, SAMPLE).select(*SAMPLE, rounded(F.coalesce("corrected", "re")).alias("data_re"))


@register(
    "p18_amplitude_scale",
    sql("select scan, round(avg(re / case when ts < timestamp '2023-12-18 23:00:00' then 4 when ts < timestamp '2024-02-15 23:00:00' then 16 else 1 end),6) as re from (select *, timestamp '2023-06-01' + to_months((scan+2)::int*2) as ts from vis) group by 1", "vis"),
)
def p18(spark, d):
    ts = F.expr("timestamp_ntz '2023-06-01 00:00:00' + make_ym_interval(0, cast((scan + 2) * 2 as int))")
    return calibrate.amplitude_correction(fx.vis(spark, d), ts, 16).groupBy("scan").agg(rounded(F.avg("re")).alias("re"))


@register("p19_corr_swap", sql("select scan, case when scan<1 and corr in (2,3) then 5-corr else corr end as corr, round(sum(re),5) as re from vis group by 1,2", "vis"))
def p19(spark, d):
    return calibrate.swap_cross_hands(fx.vis(spark, d), F.col("scan") < 1).groupBy("scan", "corr").agg(rounded(F.sum("re"), 5).alias("re"))


@register("s3_gain_scan", sql("select ant, chan, pol, round(snr,6) as snr, coalesce(flag,false) as flag from gains", "gains"))
def s3(spark, d):
    return fx.gains(spark, d).select("ant", "chan", "pol", rounded("snr").alias("snr"), F.coalesce("flag", F.lit(False)).alias("flag"))


@register("s1_strided_scan", "select l_orderkey, l_linenumber, l_quantity from lineitem where l_orderkey >= 100 and (l_orderkey - 100) % 7 = 0")
def s1(spark, d):
    from ..sources.tables import strided

    return strided(spark, f"{d}/lineitem.parquet", ["l_orderkey", "l_linenumber", "l_quantity"], "l_orderkey", 100, 7)


@register("s2_channel_frequencies", sql("select vis.corr, vis.chan, round(max(f_hz),3) as f_hz, count(*) as n from vis join freqs using (chan) group by 1,2", "vis", "freqs"))
def s2(spark, d):
    return fx.vis(spark, d).join(fx.freqs(spark, d), "chan").groupBy("corr", "chan").agg(rounded(F.max("f_hz"), 3).alias("f_hz"), F.count("*").alias("n"))


@register("s16_column_write_back", sql("select scan, ant1, ant2, chan, corr, round(2*re,6) as re, flag from vis where ant1<>ant2 union all select scan, ant1, ant2, chan, corr, round(re,6), true from vis where ant1=ant2", "vis"))
def s16(spark, d):
    auto = F.col("ant1") == F.col("ant2")
    out = fx.vis(spark, d).withColumns({"re": F.when(auto, F.col("re")).otherwise(2 * F.col("re")), "flag": auto | F.col("flag")})
    path = scratch_path(spark, "vis")
    tables.write_version(out, path, 2, "scan")
    return r6(tables.read_version(spark, path, 2).select(*SAMPLE, "re", "flag"), "re")


@register("j1_apply_bandpass", sql("select scan,ant1,ant2,chan,corr,round(cr,6)+0.0 as re,round(ci,6)+0.0 as im from calibrated", "calibrated"))
def j1(spark, d):
    return r6(calibrate.apply_bandpass(fx.vis(spark, d), fx.gains(spark, d)).select(*SAMPLE, "re", "im"), "re", "im")


@register("j2_apply_bandpass_flagged", sql("select scan,ant1,ant2,chan,corr,round(fr,6)+0.0 as re,round(fi,6)+0.0 as im from flagged", "flagged"))
def j2(spark, d):
    return r6(calibrate.apply_bandpass_flagged(fx.vis(spark, d), fx.gains(spark, d)).select(*SAMPLE, "re", "im"), "re", "im")


define("scale", "select t.ant1 as ant, t.chan, t.corr//2 as pol, case when t.flag or s.flag then 1.0 else sqrt(abs(t.re/nullif(s.re,0))) end as scale from (select * from autos where scan=1 and corr in (0,3)) t join (select * from autos where scan=0 and corr in (0,3)) s using (ant1,chan,corr)", "autos")


def _scale(spark, d):
    vis = fx.vis(spark, d)
    return calibrate.solve_gain_scale(vis.where("scan = 1"), vis.where("scan = 0"))


@register("j3_gain_scale_solve", sql("select ant, chan, pol, round(scale,6) as scale from scale", "scale"))
def j3(spark, d):
    return r6(_scale(spark, d), "scale")


@register("j4_gain_scale_apply", sql("select scan,ant1,v.ant2,v.chan,corr,round(re*a.scale*b.scale,6)+0.0 as re, round(im*a.scale*b.scale,6)+0.0 as im from vis v join scale a on a.ant=v.ant1 and a.chan=v.chan and a.pol=v.corr//2 join scale b on b.ant=v.ant2 and b.chan=v.chan and b.pol=v.corr%2", "scale"))
def j4(spark, d):
    scale, vis = _scale(spark, d), fx.vis(spark, d)
    known = scale.select("ant", "chan", "pol")
    covered = vis.join(known.select(F.col("ant").alias("ant1"), "chan", F.col("pol").alias("p")), ["ant1", "chan"]).where(F.expr("cast(corr as int) div 2 = p")).drop("p")
    covered = covered.join(known.select(F.col("ant").alias("ant2"), "chan", F.col("pol").alias("q")), ["ant2", "chan"]).where(F.expr("cast(corr as int) % 2 = q")).select(*vis.columns)
    return r6(calibrate.apply_gain_scale(covered, scale).select(*SAMPLE, "re", "im"), "re", "im")


@register("j5_vis_difference", sql("select a.ant1,a.ant2,a.chan,a.corr,round(a.re-b.re,6)+0.0 as re,round(a.im-b.im,6)+0.0 as im,a.flag or b.flag as flag from vis a join vis b using (ant1,ant2,chan,corr) where a.scan=2 and b.scan=1", "vis"))
def j5(spark, d):
    vis = fx.vis(spark, d)
    return r6(calibrate.difference(vis.where("scan = 2"), vis.where("scan = 1")), "re", "im")


@register("j6_flag_merge_group", sql("select scan,ant1,ant2,chan,corr,max(case when flag then 1 else 0 end) over (partition by ant1,ant2,chan,corr)=1 as flag from vis", "vis"))
def j6(spark, d):
    return flags.merged_over(fx.vis(spark, d), ["ant1", "ant2", "chan", "corr"]).select(*SAMPLE, "flag")


@register("j6_flag_merge_pair", sql("select ant1,ant2,chan,corr,bool_or(flag) as flag from vis where scan in (1,2) group by 1,2,3,4", "vis"))
def j6p(spark, d):
    vis = fx.vis(spark, d)
    return flags.merged_pair(vis.where("scan = 1"), vis.where("scan = 2"), ["ant1", "ant2", "chan", "corr"])


@register("j7_flag_antennas", sql(f"select scan,ant1,ant2,chan,corr,flag or ant1 in {FLAGGED_ANTENNAS} or ant2 in {FLAGGED_ANTENNAS} as flag from vis", "vis"))
def j7(spark, d):
    return flags.flag_antennas(fx.vis(spark, d), ants(spark)).select(*SAMPLE, "flag")


@register("j8_flag_baselines", sql(f"select scan,ant1,ant2,chan,corr,flag or (ant1,ant2) in {FLAGGED_BASELINES} as flag from vis", "vis"))
def j8(spark, d):
    return flags.flag_baselines(fx.vis(spark, d), bls(spark)).select(*SAMPLE, "flag")


define("dead", "select distinct scan, ant from (select *, power < 0.4*avg(power) over (partition by scan,corr,outrig) as low from (select scan, corr, ant1 as ant, ant1 in " + OUT + " as outrig, sum(abs(re)) as power from autos where corr in (0,3) group by all)) where low", "autos")


@register("a27_dead_antennas", sql("select scan, ant from dead", "dead"))
def a27(spark, d):
    return flags.dead_antennas(fx.vis(spark, d), OUTRIGGERS, 0.4, F.abs("re"))


@register("s7_antenna_list", sql(f"select string_agg(ant::varchar, ',' order by ant) as antennas from (select ant from dead union select unnest({list(FLAGGED_ANTENNAS)}))", "dead"))
def s7(spark, d):
    return flags.antenna_list(a27(spark, d), ants(spark))


@register("u3_flag_list_union", sql(f"select ant from dead union select unnest({list(FLAGGED_ANTENNAS)})", "dead"))
def u3(spark, d):
    return a27(spark, d).select("ant").union(ants(spark)).distinct()


define("badbls", "select scan,ant1,ant2,count(distinct chan) filter (where amp>cut) as hits from (select * from crosses where not flag and corr in (1,2)) join (select scan, avg(amp)+1.0*stddev_pop(amp) as cut from crosses where not flag and corr in (1,2) group by 1) using (scan) group by 1,2,3 having hits/24.0>0.25", "crosses")


@register("a23_bad_baselines", sql("select * from badbls", "badbls"))
def a23(spark, d):
    return flags.bad_baselines(fx.vis(spark, d), 1.0, 0.25, fx.N_CHAN)


@register("s8_baseline_lines", sql("select distinct concat(ant1,'&',ant2) as line, ant1, ant2 from badbls", "badbls"))
def s8(spark, d):
    lines = flags.baseline_lines(a23(spark, d).select("ant1", "ant2").distinct())
    return flags.parse_baselines(lines).withColumn("line", F.concat_ws("&", "ant1", "ant2")).select("line", "ant1", "ant2")


@register("s9_channel_lines", sql("select distinct printf('%02d:%03d', 7, chan::int) as line from vis where flag and ant1=ant2 and corr=0", "vis"))
def s9(spark, d):
    return flags.channel_lines(fx.vis(spark, d).where("flag and ant1 = ant2 and corr = 0").select("chan").distinct(), 7)


define("flagpos", "select *, ((ant1*16-(ant1*(ant1-1))//2+ant2-ant1)*24+chan)*4+corr as pos from vis", "vis")
define("packed", "select scan, pos//8 as byte_idx, sum(case when flag then 1<<(7-(pos%8))::int else 0 end)::bigint as byte from flagpos group by 1,2", "flagpos")


def with_places(vis):
    return vis.withColumn("pos", flags.place_of(fx.N_ANT, fx.N_CHAN))


@register("s10_pack_flags", sql("select * from packed", "packed"))
def s10(spark, d):
    return flags.pack_flags(with_places(fx.vis(spark, d)), "scan")


@register("s11_unpack_flags", sql("select scan, byte_idx*8+k as pos, (byte>>(7-k))&1=1 as flag from packed, (select unnest(range(8)) as k)", "packed"))
def s11(spark, d):
    return flags.unpack_flags(flags.pack_flags(with_places(fx.vis(spark, d)), "scan"), "scan")


@register("s11_restored_flags", sql("select scan, ant1, ant2, chan, corr, flag from vis", "vis"))
def s11_restored(spark, d):
    """Packed, written, read again and given back to the samples."""
    own, path = with_places(fx.vis(spark, d)), scratch_path(spark, "flags")
    flags.pack_flags(own, "scan").write.partitionBy("scan").parquet(path)
    packed = spark.read.parquet(path).withColumn("scan", F.col("scan").cast("bigint"))
    return flags.restored_flags(own, packed, "scan").select(*SAMPLE, "flag")


@register("a1_incoherent_sum", sql("select scan,chan,corr,round(amp,6) as amp,n from spectrum", "spectrum"))
def a1(spark, d):
    return r6(spectra.incoherent_sum(fx.vis(spark, d), fx.gains(spark, d)), "amp")


@register("a1_incoherent_sum_zero", sql("select scan,chan,corr,round(avg(case when coalesce(af,false) or coalesce(bf,false) then 0.0 else sqrt(cr*cr+ci*ci) end),6) as amp, count(case when coalesce(af,false) or coalesce(bf,false) then 0.0 else sqrt(cr*cr+ci*ci) end) as n from calibrated where ant1<>ant2 group by 1,2,3", "calibrated"))
def a1z(spark, d):
    return r6(spectra.incoherent_sum(fx.vis(spark, d), fx.gains(spark, d), "zero"), "amp")


@register("a2_baseline_spectra", sql(f"select scan,ant1,ant2,chan,corr,round(sqrt(re*re+im*im),6) as amp from vis where (ant1,ant2) in {FLAGGED_BASELINES}", "vis"))
def a2(spark, d):
    return r6(spectra.baseline_spectra(fx.vis(spark, d), bls(spark)).select(*SAMPLE, "amp"), "amp")


@register("a3_stokes_spectrum", sql("select scan, chan, round((avg(re) filter (where corr=0)+avg(re) filter (where corr=3))/2,6)+0.0 as i, round((avg(im) filter (where corr=1)-avg(im) filter (where corr=2))/2,6)+0.0 as v from crosses where not flag group by 1,2", "crosses"))
def a3(spark, d):
    return r6(calibrate.stokes(fx.vis(spark, d)), "i", "v")


@register("a4_average_sets", sql("select ant1,ant2,chan,corr,round(sum(re)/(select count(distinct scan) from vis),6)+0.0 as re,round(sum(im)/(select count(distinct scan) from vis),6)+0.0 as im,count(*) as n from vis group by 1,2,3,4", "vis"))
def a4(spark, d):
    return r6(calibrate.average_sets(fx.vis(spark, d)), "re", "im")


@register("a5_bin_channels", sql("select scan,ant1,ant2,chan//4 as chan,corr,round(avg(re) filter (where not flag),6)+0.0 as re,round(avg(im) filter (where not flag),6)+0.0 as im,bool_and(flag) as flag from vis group by 1,2,3,4,5", "vis"))
def a5(spark, d):
    return r6(calibrate.bin_channels(fx.vis(spark, d)), "re", "im")


@register("a6_bin_gains", sql("select ant,chan//4 as chan,pol,round(avg(gr) filter (where not flag),6) as gr,round(avg(gi) filter (where not flag),6) as gi from gains group by 1,2,3", "gains"))
def a6(spark, d):
    return r6(calibrate.bin_gains(fx.gains(spark, d)), "gr", "gi")


@register("a18_zero_fraction", sql("select scan, floor(1000.0*count(*) filter (where re=0 and im=0)/count(*))::bigint as zero_share, count(*) filter (where re=0 and im=0) as zeros from vis group by 1", "vis"))
def a18(spark, d):
    return flags.zero_fraction(fx.vis(spark, d), ["scan"], 1000)


define(
    "gainbad",
    """select distinct 'ant' as kind, id from (select *, median(m) over (partition by pol) as mid, stddev_pop(m) over (partition by pol) as s from
  (select pol, ant as id, median(sqrt(gr*gr+gi*gi)) as m from gains group by 1,2)) where m<mid-0.5*s or m>mid+0.5*s
  union all select distinct 'chan', id from (select *, median(m) over (partition by pol) as mid, stddev_pop(m) over (partition by pol) as s from
  (select pol, chan as id, median(snr) as m from gains group by 1,2)) where m<mid-0.5*s""",
    "gains",
)


@register("a19_gain_quality", sql("select * from gainbad", "gainbad"))
def a19(spark, d):
    return flags.gain_quality(fx.gains(spark, d), 0.5, 0.5)


@register("s17_quality_report", sql("select concat('bad ',kind,': ',string_agg(id::varchar, ',' order by id)) as line from gainbad group by kind", "gainbad"))
def s17(spark, d):
    return flags.quality_lines(a19(spark, d))


@register("g6_parse_report", sql("select id from gainbad where kind='ant'", "gainbad"))
def g6(spark, d):
    return flags.parse_quality_lines(s17(spark, d), "ant")


@register("a20_flagged_solutions", sql("select chan, count(*) filter (where flag) as flagged, count(*) as total from gains group by 1", "gains"))
def a20(spark, d):
    return flags.flagged_solutions(fx.gains(spark, d))


@register("a21_bad_solutions", sql("select ant,chan,pol,flag or sqrt(gr*gr+gi*gi) < 0.96*(select median(sqrt(gr*gr+gi*gi)) from gains) as flag from gains", "gains"))
def a21(spark, d):
    return flags.flag_bad_solutions(fx.gains(spark, d), 0.96).select("ant", "chan", "pol", "flag")


define("template", "select scan,chan,corr,median(amp) as t from autos group by 1,2,3", "autos")
define("offs", "select scan,corr,ant1,avg(case when flag then 0.0 else abs((amp-t)/nullif(t,0)) end) as off from autos join template using (scan,chan,corr) group by 1,2,3", "template")


@register("a26_template_score", sql("select scan,corr,ant1,round(score,6) as score,score>2.0 as bad from (select *, off/nullif(median(off) over (partition by scan,corr),0) as score from offs)", "offs"))
def a26(spark, d):
    return r6(flags.template_scores(fx.vis(spark, d), 2.0), "score")


@register("a28_heavily_flagged", sql("select scan,ant1,corr,flagged from (select *, median(flagged) over (partition by scan) as middle, max(n) over (partition by scan) as n_chan from (select scan,ant1,corr,count(*) filter (where flag) as flagged,count(*) as n from autos group by 1,2,3)) where middle < floor(n_chan*5.0) and flagged > 1.5*middle", "autos"))
def a28(spark, d):
    return flags.heavily_flagged_rows(fx.vis(spark, d), 1.5, 5.0)


@register("a38_flag_occupancy", sql("select chan,corr,count(*) filter (where flag) as flagged,count(*) as total from vis group by 1,2", "vis"))
def a38(spark, d):
    return flags.occupancy(fx.vis(spark, d))


@register("a29_auto_power_track", sql("select scan, list(p order by ant1) as power from (select scan, ant1, round(case when bool_or(flag) then 0.0 else max(case when corr=0 then amp end) end,6) as p from autos where chan=5 and corr in (0,3) group by 1,2 having count(case when corr=0 then 1 end)>0) group by 1", "autos"))
def a29(spark, d):
    one = fx.vis(spark, d).where("ant1 = ant2 and chan = 5 and corr in (0, 3)").withColumn("amp", amp())
    one = one.groupBy("scan", "ant1").agg(F.bool_or("flag").alias("bad"), F.max(F.when(F.col("corr") == 0, F.col("amp"))).alias("xx")).where("xx is not null")
    one = one.select("scan", "ant1", rounded(F.when(F.col("bad"), 0.0).otherwise(F.col("xx"))).alias("p"))
    return one.groupBy("scan").agg(F.transform(F.array_sort(F.collect_list(F.struct("ant1", "p"))), lambda x: x["p"]).alias("power"))


@register("a31_auto_decibels", sql("select a.ant, a.chan, a.ant//8 as grp, round(avg(db),6)+0.0 as db from (select * from (select distinct ant1 as ant from autos) cross join (select distinct chan from vis)) a left join autodb using (ant,chan) group by 1,2,3", "autodb"))
def a31(spark, d):
    from ..functions.numbers import decibel

    vis = fx.vis(spark, d)
    auto = vis.where("ant1 = ant2 and corr in (0, 3)").select(F.col("ant1").alias("ant"), "chan", decibel(F.nullif(amp(), F.lit(0.0)), 100.0).alias("db"))
    chans = vis.select("chan").distinct()
    every = vis.where("ant1 = ant2").select(F.col("ant1").alias("ant")).distinct().join(F.broadcast(chans))  # the band's channels
    return every.join(auto, ["ant", "chan"], "left").groupBy("ant", "chan", F.expr("ant div 8").alias("grp")).agg(rounded(F.avg("db")).alias("db"))


define("chan_st", "select scan,corr,chan,max(amp) as top,avg(amp) as mean,row_number() over (partition by scan,corr order by chan)-1 as place,count(*) over (partition by scan,corr) as n from crosses where not flag group by 1,2,3", "crosses")
define("chan_m", "select scan,corr,place,top,mean from chan_st union all select scan,corr,-place-1,top,mean from chan_st where place<2 union all select scan,corr,2*n-place-1,top,mean from chan_st where place>=n-2", "chan_st")
define("chan_md", "select a.scan,a.corr,a.chan,a.place,a.n,a.mean,a.top/nullif(median(b.top),0) as norm,stddev_pop(b.mean) as mean_std from chan_st a join chan_m b on a.scan=b.scan and a.corr=b.corr and b.place between a.place-2 and a.place+2 group by a.scan,a.corr,a.chan,a.place,a.n,a.mean,a.top", "chan_m")
define("chan_m2", "select scan,corr,place,norm from chan_md union all select scan,corr,-place-1,norm from chan_md where place<2 union all select scan,corr,2*n-place-1,norm from chan_md where place>=n-2", "chan_md")
define("chan_ns", "select a.scan,a.corr,a.chan,a.norm,a.mean,a.mean_std,stddev_pop(b.norm) as norm_std from chan_md a join chan_m2 b on a.scan=b.scan and a.corr=b.corr and b.place between a.place-2 and a.place+2 group by all", "chan_m2")
define("chan_w", "select *, min(norm_std) over p as least, median(mean) over p as middle, min(mean_std) over p as least_mean from chan_ns window p as (partition by scan,corr)", "chan_ns")


@register("a22_bad_channels", sql("select distinct scan, chan from chan_w where corr in (0,3) and (abs(norm-1) > 3.0*least or mean > middle+100*least_mean)", "chan_w"))
def a22(spark, d):
    return flags.bad_channels(fx.vis(spark, d), 2, (3.0, 3.0, 3.0, 3.0))


define("ser", "select scan,ant1 as ant,corr,avg(amp) as x from autos where not flag and corr in (0,3) group by 1,2,3", "autos")
define("ant_s", "select ant,corr,ant in " + OUT + " as outrig,stddev_pop(x/m) as s from ser join (select scan,corr,median(x) as m from ser group by 1,2) using (scan,corr) group by 1,2,3", "ser")
define("ant_near", "select ant from ant_s join (select outrig,corr,median(s) as m,stddev_pop(s) as d from ant_s group by 1,2) using (outrig,corr) group by 1 having bool_or(s<m+3*d)", "ant_s")
define("ant_again", "select *, min(d) over (partition by outrig) as least from (select outrig,corr,median(s) as m,stddev_pop(s) as d from ant_s where ant in (select ant from ant_near) group by 1,2)", "ant_near")


@register("a24_bad_antennas_calibrated", sql("select distinct ant from ant_s join ant_again using (outrig,corr) where s > m+1.5*least", "ant_again"))
def a24(spark, d):
    return flags.bad_antennas_calibrated(fx.vis(spark, d), OUTRIGGERS, 1.5)


define("raw_mid", "select ant,corr,median(db) as m from autodb group by 1,2", "autodb")
define("raw_first", "select distinct ant from (select *, median(m) over (partition by corr) as mm, stddev_pop(m) over (partition by corr) as s from raw_mid) where m>mm+s or m<mm-2*s or m is null", "raw_mid")
define("raw_rest", "select *, median(db) over (partition by scan,chan,corr) as t from autodb where ant not in (select ant from raw_first)", "raw_first")


@register("a25_bad_antennas_raw", sql("select ant from raw_first union select ant from (select ant,corr,stddev_pop(db/nullif(t,0)) as s from raw_rest group by 1,2) where s>0.6", "raw_rest"))
def a25(spark, d):
    return flags.bad_antennas_raw(fx.vis(spark, d), 100.0, 0.6)


@register("f3_complex_algebra", sql("select ant,chan,pol,round(sqrt(gr*gr+gi*gi),6) as amp,round(degrees(atan2(gi,gr)),6)+0.0 as phase,round(gr/(gr*gr+gi*gi),6)+0.0 as ir,round(-gi/(gr*gr+gi*gi),6)+0.0 as ii from gains", "gains"))
def f3(spark, d):
    gains = fx.gains(spark, d)
    inv = calibrate.inverse_gains(gains).select("ant", "chan", "pol", rounded("gr").alias("ir"), rounded("gi").alias("ii"))
    return gains.select("ant", "chan", "pol", rounded(amp("gr", "gi")).alias("amp"), rounded(phase_deg("gr", "gi")).alias("phase")).join(inv, ["ant", "chan", "pol"])


@register("f4_inverse_tables", sql("select ant,pol,epoch,round(-delay_ns,6) as delay_ns from delays", "delays"))
def f4(spark, d):
    return r6(calibrate.inverse_delays(fx.delays(spark, d)), "delay_ns")


@register("f8_phase_shift", sql("""
select scan,ant1,ant2,chan,corr,round(re*cos(t)-im*sin(t),6)+0.0 as re,round(re*sin(t)+im*cos(t),6)+0.0 as im from (
  select vis.*, -2*pi()*(u*cos(d)*sin(dr)+v*(sin(d)*cos(d0)-cos(d)*sin(d0)*cos(dr))+w*(sin(d)*sin(d0)+cos(d)*cos(d0)*cos(dr)-1))*f_hz/299792458.0::double as t
  from vis join uvw using (ant1,ant2) join freqs using (chan), (select radians(37.5::double) as d, radians(37.0::double) as d0, radians(1.0::double) as dr))""", "vis", "uvw", "freqs"))
def f8(spark, d):
    done = calibrate.phase_shift(fx.vis(spark, d), fx.uvw(spark, d), fx.freqs(spark, d), *PHASE)
    return r6(done.select(*SAMPLE, "re", "im"), "re", "im")


@register("f12_uv_wavelengths", sql("select ant1,ant2,chan,round(u*f_hz/299792458.0::double,6) as u,round(v*f_hz/299792458.0::double,6) as v from uvw, freqs", "uvw", "freqs"))
def f12(spark, d):
    chans = F.broadcast(fx.freqs(spark, d))  # the band's channels
    return fx.uvw(spark, d).join(chans).select("ant1", "ant2", "chan", *(rounded(F.col(c) * F.col("f_hz") / 299792458.0).alias(c) for c in ("u", "v")))


@register("f15_decibels", sql("select ant,scan,chan,corr,round(db,6)+0.0 as db, ant in " + OUT + " as outrigger from autodb", "autodb"))
def f15(spark, d):
    from ..functions.numbers import decibel

    auto = fx.vis(spark, d).where("ant1 = ant2 and corr in (0, 3)")
    return auto.select(F.col("ant1").alias("ant"), "scan", "chan", "corr", rounded(decibel(F.nullif(amp(), F.lit(0.0)), 100.0)).alias("db"), F.col("ant1").isin(*OUTRIGGERS).alias("outrigger"))


define("jones", "select x.ant,x.chan,x.gr as ar,x.gi as ai,0.1*x.gi as br,0.05*y.gr as bi,-0.05*x.gr as cr,0.1*y.gi as ci,y.gr as dr,y.gi as di from gains x join gains y using (ant,chan) where x.pol=0 and y.pol=1", "gains")
define("mueller", """select ant, chan,
  (aa+bb+cc+dd)/2 as m00, (aa-bb+cc-dd)/2 as m01, abr+cdr as m02, -(abi+cdi) as m03, (aa+bb-cc-dd)/2 as m10, (aa-bb-cc+dd)/2 as m11, abr-cdr as m12, -(abi-cdi) as m13,
  acr+bdr as m20, acr-bdr as m21, adr+bcr as m22, -(adi-bci) as m23, aci+bdi as m30, aci-bdi as m31, adi+bci as m32, adr-bcr as m33 from (
 select ant, chan, ar*ar+ai*ai as aa, br*br+bi*bi as bb, cr*cr+ci*ci as cc, dr*dr+di*di as dd, ar*br+ai*bi as abr, ai*br-ar*bi as abi, cr*dr+ci*di as cdr, ci*dr-cr*di as cdi,
  ar*cr+ai*ci as acr, ai*cr-ar*ci as aci, br*dr+bi*di as bdr, bi*dr-br*di as bdi, ar*dr+ai*di as adr, ai*dr-ar*di as adi, br*cr+bi*ci as bcr, bi*cr-br*ci as bci from jones)""", "jones")  # fmt: skip
ENTRIES = [f"m{i}{j}" for i in range(4) for j in range(4)]


def mueller_of_gains(spark, d):
    """(ant, chan, m00 to m33) of Jones matrices with the gains on the diagonal and a share of them beside it."""
    from ..operators import beam

    one = lambda pol, names: fx.gains(spark, d).where(F.col("pol") == pol).select("ant", "chan", *(F.col(a).alias(b) for a, b in zip(("gr", "gi"), names)))
    both = one(0, ("ar", "ai")).join(one(1, ("dr", "di")), ["ant", "chan"])
    entries = [(F.col("ar"), F.col("ai")), (0.1 * F.col("ai"), 0.05 * F.col("dr")), (-0.05 * F.col("ar"), 0.1 * F.col("di")), (F.col("dr"), F.col("di"))]
    return both.select("ant", "chan", *(c.alias(n) for n, c in beam.mueller(entries).items()))


@register("f5_mueller", sql(f"select ant, chan, {', '.join(f'round({m},6)+0.0 as {m}' for m in ENTRIES)} from mueller", "mueller"))
def f5(spark, d):
    return r6(mueller_of_gains(spark, d), *ENTRIES)


@register("j17_antenna_names", sql("select ant, chan, pol, coalesce(try_cast(substring(n_name, 8) as int), ant::int) as number from gains left join nation on n_nationkey=ant", "gains"))
def j17(spark, d):
    from ..operators.timeline import antenna_numbers
    from ..session import table

    names = table(spark, d, "nation").select(F.col("n_nationkey").alias("ant"), F.col("n_name").alias("name"))
    return antenna_numbers(fx.gains(spark, d), names, 7).select("ant", "chan", "pol", "number")


@register("j18_delay_difference", sql("select ant,pol,round(n.delay_ns-r.delay_ns,6)+0.0 as difference from (select * from delays where epoch=1) n join (select * from delays where epoch=0) r using (ant,pol)", "delays"))
def j18(spark, d):
    from ..operators.timeline import delay_differences

    delays = fx.delays(spark, d)
    new, old = delays.where("epoch = 1"), delays.where("epoch = 0")
    keys = ["ant", "pol"]
    return r6(delay_differences(new.join(old, keys, "left_semi"), old.join(new, keys, "left_semi")), "difference")


@register("j21_model_subtraction", sql("select v.scan,ant1,ant2,chan,corr,round(v.re-0.5*coalesce(m.re,0),6)+0.0 as re from vis v left join (select ant1,ant2,chan,corr,sum(re) as re from vis where scan<=1 group by all) m using (ant1,ant2,chan,corr)", "vis"))
def j21(spark, d):
    vis = fx.vis(spark, d)
    model = vis.where("scan <= 1")  # the first scans are the model of all
    return r6(calibrate.subtract_model(vis, model, 0.5, keys=("ant1", "ant2", "chan", "corr")).select(*SAMPLE, "re"), "re")


@register("j22_model_rearrange", sql("""
select m.scan,m.ant1,m.ant2,m.chan,v.corr,case when v.corr=0 then round(m.re,6) else round((v.re*(m.re*d.re+m.im*d.im)-v.im*(m.im*d.re-m.re*d.im))/nullif(d.re*d.re+d.im*d.im,0),6)+0.0 end as re
from vis v join vis d on d.corr=0 and v.scan=d.scan and v.ant1=d.ant1 and v.ant2=d.ant2 and v.chan=d.chan
join (select scan,ant1,ant2,chan,corr,re+1 as re,im from vis) m on m.corr=0 and v.scan=m.scan and v.ant1=m.ant1 and v.ant2=m.ant2 and v.chan=m.chan""", "vis"))
def j22(spark, d):
    vis = fx.vis(spark, d)
    return r6(calibrate.rearrange_model(vis, vis.withColumn("re", F.col("re") + 1)).select(*SAMPLE, "re"), "re")


@register("s15_cube", sql("select 'sum' as type, corr, scan, chan as freq_idx, coalesce(round(amp,6),0) as amp, round((13.398+chan*0.023926)::double,6) as mhz, round((2.0+scan*10.031/3600.0)::double,6) as hours from (select distinct scan from spectrum) cross join (select distinct chan from spectrum) cross join (select distinct corr from spectrum) left join spectrum using (scan,chan,corr)", "spectrum"))
def s15(spark, d):
    path = scratch_path(spark, "cube")
    spectra.write_cube(spectra.with_axes(spectra.dynamic_spectrum(fx.vis(spark, d), fx.gains(spark, d)), 2.0), path)
    cube = spark.read.parquet(path).withColumn("corr", F.col("corr").cast("bigint"))
    return r6(cube.drop("present"), "amp", "mhz", "hours")


@register("k1_dynspec", sql("select 'sum' as type, corr, scan, chan as freq_idx, coalesce(round(amp,6),0) as amp, amp is not null as present from (select distinct scan from spectrum) cross join (select distinct chan from spectrum) cross join (select distinct corr from spectrum) left join spectrum using (scan,chan,corr)", "spectrum"))
def k1(spark, d):
    return r6(spectra.dynamic_spectrum(fx.vis(spark, d), fx.gains(spark, d)), "amp")


#: Gain tables of two sub-bands: (spw, date, gain_id).
TABLES = [(0, "2024-01-01", 1), (0, "2024-01-03", 2), (1, "2024-01-02", 3)]
define("k1_scans", "select scan, scan%2 as spw, timestamp '2024-01-01' + to_hours((20*(scan//2))::int) as ts from (select distinct scan from vis)", "vis")
define("k1_tables", "select * from (values " + ", ".join(f"({a}, date '{b}', {c})" for a, b, c in TABLES) + ") t(spw, made, gain_id)")
define("k1_told", "select s.*, dense_rank() over (order by ts)-1 as number, (select arg_max(gain_id, made) from k1_tables t where t.spw=s.spw and t.made<=s.ts::date) as gain_id from k1_scans s", "k1_scans", "k1_tables")
define("k1_paired", """select v.*, number, spw, a.gr*(1+t.gain_id/10.0::double) as ar, a.gi as ai, a.flag as af, b.gr*(1+t.gain_id/10.0::double) as br, b.gi as bi, b.flag as bf,
  max(case when v.flag then 1 else 0 end) over (partition by v.scan,v.ant1,v.ant2,v.chan)=1 as bad from vis v join k1_told t on t.scan=v.scan and gain_id is not null
  left join gains a on a.ant=v.ant1 and a.chan=v.chan and a.pol=v.corr//2 left join gains b on b.ant=v.ant2 and b.chan=v.chan and b.pol=v.corr%2 where ant1<>ant2""", "k1_told", "gains")  # fmt: skip
define("k1_amp", "select number as scan, spw*24+chan as chan, corr, ant1, ant2, case when not bad and not af and not bf then sqrt(((re*pr+im*pi)**2+(im*pr-re*pi)**2))/nullif(pr*pr+pi*pi,0) end as amp from (select *, ar*br+ai*bi as pr, ai*br-ar*bi as pi from k1_paired)", "k1_paired")
define("k1_spectra", f"select 'sum' as type, scan, chan, corr, avg(amp) as amp from k1_amp group by all union all select concat(ant1,'-',ant2), scan, chan, corr, amp from k1_amp where (ant1,ant2) in {FLAGGED_BASELINES}", "k1_amp")


def _dated(spark, d):
    vis = fx.vis(spark, d)
    when = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(hours=(20 * F.floor(F.col("scan") / 2.0)).cast("int"))
    scans = vis.select("scan").distinct().select("scan", (F.col("scan") % 2).cast("int").alias("spw"), when.alias("ts"))
    made = spark.createDataFrame(TABLES, "spw int, date string, gain_id int").withColumn("date", F.col("date").cast("date"))
    gains = fx.gains(spark, d).join(made.select("gain_id")).withColumn("gr", F.col("gr") * (1 + F.col("gain_id") / 10.0))  # three tables
    return spectra.dated_spectra(vis, scans, made, gains, bls(spark), fx.N_CHAN)


@register("k1_dated_gains", sql("select type, corr, scan, chan as freq_idx, coalesce(round(amp,6),0) as amp, amp is not null as present from (select distinct type from k1_spectra) cross join (select distinct scan from k1_spectra) cross join (select distinct chan from k1_spectra) cross join (select distinct corr from k1_spectra) left join k1_spectra using (type,scan,chan,corr)", "k1_spectra"))
def k1_dated(spark, d):
    """Two sub-bands over three days under the gain table of each date; the mean over baselines and three baselines."""
    return r6(_dated(spark, d)[0], "amp")


@register("k1_skipped_scans", sql("select spw::int as spw, ts::date as \"date\", count(*) as n from k1_told where gain_id is null group by 1,2", "k1_told"))
def k1_skipped(spark, d):
    return _dated(spark, d)[1]


@register("g2_unpack_rows", sql("select scan, ant1, ant2, chan, corr, round(re,6)+0.0 as re from vis", "vis"))
def g2(spark, d):
    row = ["scan", "ant1", "ant2"]  # a row of the table holds the band's channels and four correlations
    packed = fx.vis(spark, d).groupBy(*row).agg(F.array_sort(F.collect_list(F.struct("chan", "corr", "re"))).alias("data"))
    return r6(packed.select(*row, F.explode("data").alias("s")).select(*row, "s.chan", "s.corr", "s.re"), "re")


@register("g4_json_payload", sql("select ant, chan, pol, round(gr,4) as gr from gains", "gains"))
def g4(spark, d):
    text = fx.gains(spark, d).select(F.to_json(F.struct("ant", "chan", "pol", rounded("gr", 4).alias("gr"))).alias("payload"))
    return text.select(F.from_json("payload", "ant bigint, chan bigint, pol int, gr double").alias("p")).select("p.*")


define("rephased", """
select scan,ant1,ant2,chan,corr,re*cos(t)-im*sin(t) as re,re*sin(t)+im*cos(t) as im from (
  select vis.*, -2*pi()*(u*cos(d)*sin(dr)+v*(sin(d)*cos(d0)-cos(d)*sin(d0)*cos(dr))+w*(sin(d)*sin(d0)+cos(d)*cos(d0)*cos(dr)-1))*f_hz/299792458.0::double as t
  from vis join uvw using (ant1,ant2) join freqs using (chan), (select radians(37.5::double) as d, radians(37.0::double) as d0, radians(1.0::double) as dr))""", "vis", "uvw", "freqs")


@register("u1_integrate", sql("select 0 as field_id, ant1, ant2, chan, corr, count(*) as n, round(avg(re),5)+0.0 as re, round(avg(im),5)+0.0 as im from rephased group by 2,3,4,5", "rephased"))
def u1(spark, d):
    done = calibrate.phase_shift(fx.vis(spark, d), fx.uvw(spark, d), fx.freqs(spark, d), *PHASE)
    return r6(calibrate.integrated([done]), "re", "im", digits=5)


@register("u5_combine_windows", sql("select ant, pol, (pol*24+chan) as chan, round(gr,6) as gr from gains", "gains"))
def u5(spark, d):
    return fx.gains(spark, d).select("ant", "pol", (F.col("pol") * fx.N_CHAN + F.col("chan")).alias("chan"), rounded("gr").alias("gr"))


@register("p22_complete_sets", sql("select scan, count(distinct corr) = 4 as complete from vis group by 1", "vis"))
def p22(spark, d):
    return fx.vis(spark, d).groupBy("scan").agg((F.count_distinct("corr") == 4).alias("complete"))
