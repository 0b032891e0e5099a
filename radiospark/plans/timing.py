"""Registered queries on timelines, names, task logs, interference and streams, with their oracles."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import sky
from ..functions.numbers import amp, rounded
from ..operators import calibrate, flags, images, rfi, snapshots, spectra, timeline
from ..session import few, scratch_path, table, written
from ..sources import fixtures as fx
from ..sources import tables
from ..streaming import ingest
from . import visibility
from .oracle import define, sql
from .registry import register

define("jd", "select *, epoch(ts)/86400.0::double+2440587.5 as jd from scans", "scans")
define("lst", "select *, ((18.697374558+24.06570982441908*(jd-2451545.0)-118.281667*24/360)%24+24)%24 as lst from jd", "jd")
define("hourly", "select ts, min(scan_id) as scan_id, avg(lst) as lst from lst group by 1", "lst")
define("wrapped", "select *, lst+sum(t) over (order by ts) as unwrapped from (select *, case when lst-lag(lst) over (order by ts)<-12 then 24.0 when lst-lag(lst) over (order by ts)>12 then -24.0 else 0.0 end as t from hourly)", "hourly")
define("names", "select scan_id, concat(strftime(ts,'%Y%m%d_%H%M%S'),'_',spw,'MHz.ms') as name from scans", "scans")
define("vamp", "select *, sqrt(re*re+im*im) as amp from vis where ant1<>ant2", "vis")


def r6(df, *names, digits=6):
    return df.withColumns({n: rounded(n, digits) for n in names})


def with_lst(spark, d):
    return fx.scans(spark, d).withColumn("lst", sky.sidereal_hours(sky.julian_date("ts")))


def hourly(spark, d):
    return with_lst(spark, d).groupBy("ts").agg(F.min("scan_id").alias("scan_id"), F.avg("lst").alias("lst"))


def names(spark, d):
    return fx.scans(spark, d).select("scan_id", F.concat(F.date_format("ts", "yyyyMMdd_HHmmss"), F.lit("_"), F.col("spw").cast("string"), F.lit("MHz.ms")).alias("name"))


@register("p4_half_open_range", sql("select ts, spw, scan_id from scans where ts>=timestamp '2024-01-05' and ts<timestamp '2024-01-08'", "scans"))
def p4(spark, d):
    return timeline.within(fx.scans(spark, d), "ts", "2024-01-05 00:00:00", "2024-01-08 00:00:00")


@register("p5_closed_range", sql("select ts, spw, scan_id from scans where ts between timestamp '2024-01-05' and timestamp '2024-01-08'", "scans"))
def p5(spark, d):
    return fx.scans(spark, d).where("ts between timestamp_ntz '2024-01-05 00:00:00' and timestamp_ntz '2024-01-08 00:00:00'")


@register("p6_hour_gate", sql("select ts, spw, scan_id, hour(ts) between 1 and 14 as processed from scans", "scans"))
def p6(spark, d):
    return timeline.routed_by_hour(fx.scans(spark, d), "ts", 1, 14)


@register("p7_lst_gate", sql("select ts, spw, round(lst,5) as lst from lst where lst>=11 and lst<=14", "lst"))
def p7(spark, d):
    return r6(with_lst(spark, d).where("lst >= 11 and lst <= 14").select("ts", "spw", "lst"), "lst", digits=5)


@register("p8_transit_gate", sql("select ts, spw, label from lst, calibrators where abs(((lst-ra/15+12)%24+24)%24-12)<=60/120.0", "lst", "calibrators"))
def p8(spark, d):
    return timeline.in_transit(with_lst(spark, d), fx.calibrators(spark), "lst", 60.0).select("ts", "spw", "label")


@register("p10_band_filter", sql("select scan_id, name from names where regexp_extract(name,'(\\d+)MHz',1)::int>=10", "names"))
def p10(spark, d):
    return names(spark, d).where(sky.frequency_tag("name") >= 10)


@register("p11_not_done", sql("select ts, spw, scan_id from scans where not (spw%3=0 and hour(ts)<12)", "scans"))
def p11(spark, d):
    scans = fx.scans(spark, d)
    return timeline.not_done(scans, scans.where((F.col("spw") % 3 == 0) & (F.hour("ts") < 12)), ["ts", "spw"]).select("ts", "spw", "scan_id")


@register("j9_nearest_time", sql("select pid, near_ts, value from (select e.event_id as pid, s.ts as near_ts, s.scan_id as value, row_number() over (partition by e.event_id order by abs(epoch_us(s.ts)-epoch_us(e.ts)), s.ts) as r from events e, (select ts, min(scan_id) as scan_id from scans group by 1) s) where r=1", "scans"))
def j9(spark, d):
    pivots = table(spark, d, "events").select(F.col("event_id").alias("pid"), F.col("ts"))
    return timeline.nearest_in_time(pivots, fx.scans(spark, d).select("ts", F.col("scan_id").alias("value"))).select("pid", "near_ts", "value")


@register("j10_bad_antennas_on_date", sql("select distinct corr_num from flaglist where source in ('1-URGENT','2-HIGH') and \"date\"=(select least(greatest(date '1997-03-04', min(\"date\")), max(\"date\")) from flaglist)", "flaglist"))
def j10(spark, d):
    return timeline.bad_antennas_on(fx.flaglist(spark, d), "1997-03-04", ["1-URGENT", "2-HIGH"])


define("placed", """select *, 5+5*sin(radians(round_even(az,0))) as horizon from (select ts, label, degrees(asin(sin(radians(dec))*sin(radians(37.2::double))+cos(radians(dec))*cos(radians(37.2::double))*cos(radians(ra-lst*15)))) as el,
  (degrees(atan2(-cos(radians(dec))*sin(radians(lst*15-ra)),sin(radians(dec))*cos(radians(37.2::double))-cos(radians(dec))*sin(radians(37.2::double))*cos(radians(lst*15-ra))))+720)%360 as az
  from (select ts, avg(lst) as lst from lst group by 1), calibrators)""", "lst", "calibrators")


@register("j16_source_visibility", sql("select ts, label, el>greatest(8, horizon) as visible, round(horizon,5) as horizon from placed", "placed"))
def j16(spark, d):
    both = hourly(spark, d).join(F.broadcast(fx.calibrators(spark)))  # four calibrators
    at = (F.col("lst") * 15, F.lit(37.2))
    placed = both.withColumns({"el": sky.elevation("ra", "dec", *at), "az_i": F.rint(sky.azimuth("ra", "dec", *at)).cast("int")})
    seen = timeline.above_horizon(placed, fx.horizon(spark), 8.0)
    return r6(seen.select("ts", "label", "visible", "horizon"), "horizon", digits=5)


@register("s20_static_tables", sql("select ant, name, outrigger, count(*) as n, count(*) filter (where flag) as flagged from gains join (select unnest(range(16)) as a, concat('LWA-', lpad((unnest(range(16))+1)::varchar,3,'0')) as name, unnest(range(16))>=12 as outrigger) on a=ant group by 1,2,3", "gains"))
def s20(spark, d):
    named = fx.gains(spark, d).join(F.broadcast(fx.antennas(spark)), "ant")  # the array's antennas
    return named.groupBy("ant", "name", "outrigger").agg(F.count("*").alias("n"), F.count_if("flag").alias("flagged"))


_PAIR = "select spw, a.ts as early, b.ts as late, a.scan_id as early_id, b.scan_id as late_id from scans a join scans b using (spw) where abs(epoch_us(b.ts)-epoch_us(a.ts)-86164000000)<=300000000"


@register("j20_sidereal_pairs", sql(_PAIR, "scans"))
def j20(spark, d):
    return timeline.sidereal_pairs(fx.scans(spark, d), tolerance_s=300.0)


@register("x8_aligned_products", sql(f"select early, late, spw, concat('diff/', strftime(early,'%Y%m%d_%H%M%S'), '_', spw, '.fits') as diff from ({_PAIR})", "scans"))
def x8(spark, d):
    pairs = timeline.sidereal_pairs(fx.scans(spark, d), tolerance_s=300.0)
    return pairs.select("early", "late", "spw", F.concat(F.lit("diff/"), F.date_format("early", "yyyyMMdd_HHmmss"), F.lit("_"), F.col("spw").cast("string"), F.lit(".fits")).alias("diff"))


@register("j24_calibration_selection", sql("select s.ts, s.spw, t.gain_id from scans s left join (select spw, ts::date as d, min(scan_id) as gain_id from scans where hour(ts)=4 group by 1,2) t on s.spw=t.spw and s.ts::date=t.d", "scans"))
def j24(spark, d):
    scans = fx.scans(spark, d)
    made = scans.where(F.hour("ts") == 4).groupBy("spw", F.to_date("ts").alias("date")).agg(F.min("scan_id").alias("gain_id"))
    return timeline.with_calibration(scans, made).select("ts", "spw", "gain_id")


@register("w2_chunks", sql("select scan_id, (row_number() over (order by ts, spw)-1)//24 as chunk from scans", "scans"))
def w2(spark, d):
    return timeline.chunks(fx.scans(spark, d), ["ts", "spw"], 24).select("scan_id", "chunk")


@register("w3_time_chunks", sql("select scan_id, cast(floor((epoch_us(ts)-(select min(epoch_us(ts)) from scans))/36000e6) as bigint) as chunk from scans", "scans"))
def w3(spark, d):
    return timeline.chunks_of_time(fx.scans(spark, d), "ts", 36000.0).select("scan_id", "chunk")


@register("w4_gaps", "select event_id, user_id, round((epoch_us(ts)-lag(epoch_us(ts)) over (partition by user_id order by ts))/1e6,6) as gap from events")
def w4(spark, d):
    return timeline.gaps(table(spark, d, "events").select("event_id", "user_id", "ts"), "ts", ["user_id"]).select("event_id", "user_id", rounded("gap").alias("gap"))


@register("w7_unwrap_lst", sql("select ts, round(unwrapped,5) as unwrapped from wrapped", "wrapped"))
def w7(spark, d):
    turned = timeline.unwrapped(hourly(spark, d), [], "ts", "lst")
    return r6(turned.select("ts", "unwrapped"), "unwrapped", digits=5)


@register("w8_first_crossing", sql("select spw, coalesce(min(ts) filter (where lst>=23.5), max(ts)+interval 10 seconds) as crossing from lst group by 1", "lst"))
def w8(spark, d):
    return timeline.first_crossing(with_lst(spark, d), ["spw"], "ts", "lst", 23.5)


@register("w9_scan_numbers", sql("select ts, spw, dense_rank() over (order by ts)-1 as scan from scans", "scans"))
def w9(spark, d):
    return spectra.numbered_scans(fx.scans(spark, d)).select("ts", "spw", "scan")


_W10 = """
select hour, hours from (with recursive h as (select date_trunc('hour',ts) as hour, count(*) as n, row_number() over (order by date_trunc('hour',ts)) as i from scans where scan_id>=0 group by 1),
g(i, hour, hours) as (select 1::bigint, null::timestamp, null::int union all
 select case when h.n=14 then g.i+1 when h.n<14 and h2.n+h.n=14 then g.i+2 else g.i+1 end,
        case when h.n=14 or (h.n<14 and h2.n+h.n=14) then h.hour end, case when h.n=14 then 1 when h.n<14 and h2.n+h.n=14 then 2 end
 from g join h on h.i=g.i left join h h2 on h2.i=g.i+1) select hour, hours from g where hour is not null)"""


@register("w10_full_blocks", sql(_W10, "scans"))
def w10(spark, d):
    return timeline.full_blocks(fx.scans(spark, d), "ts", 14)


@register("w11_head_tail", sql("select spw, scan_id from (select *, row_number() over (partition by spw order by ts) as u, row_number() over (partition by spw order by ts desc) as w, count(*) filter (where hour(ts)>=12) over (partition by spw) as g from scans) where case when g<215 then u<=9 or w<=9 else hour(ts)>=12 end", "scans"))
def w11(spark, d):
    return timeline.head_and_tail(fx.scans(spark, d), ["spw"], "ts", 9, 215, F.hour("ts") >= 12).select("spw", "scan_id")


@register("w12_middle_scan", sql("select spw, ts from (select *, row_number() over (partition by spw order by ts)-1 as i, count(*) over (partition by spw) as n from scans) where i=n//2", "scans"))
def w12(spark, d):
    return timeline.middle_rows(fx.scans(spark, d), ["spw"], "ts").select("spw", "ts")


@register("w14_band_padding", sql("select t.ts, t.spw, s.scan_id from (select ts, unnest(range(16))::bigint as spw from (select distinct ts from scans)) t left join scans s using (ts,spw)", "scans"))
def w14(spark, d):
    return timeline.padded(fx.scans(spark, d), ["ts"], "spw", 0, 15).select("ts", "spw", "scan_id")


define("limits", "select floor(arg_min(unwrapped,ts)) as a, ceil(arg_max(unwrapped,ts)) as b from wrapped where ts between timestamp '2024-01-10' and timestamp '2024-01-12'", "wrapped")


@register("w15_full_lst_window", sql("select coalesce(min(ts) filter (where unwrapped>=a), max(ts)+interval 10 seconds) as start, coalesce(min(ts) filter (where unwrapped>=b), max(ts)+interval 10 seconds) as \"end\" from wrapped, limits", "limits"))
def w15(spark, d):
    base = "ts between timestamp_ntz '2024-01-10 00:00:00' and timestamp_ntz '2024-01-12 00:00:00'"
    return timeline.full_sidereal_hours(hourly(spark, d), base, "ts", "lst")


@register("t1_sorted_concatenation", sql("select row_number() over (order by ts, spw) as place, scan_id from scans", "scans"))
def t1(spark, d):
    scans = fx.scans(spark, d)
    both = scans.where("spw < 8").unionByName(scans.where("spw >= 8"))
    return images.ranked(both, [], ["ts", "spw"]).select(F.col("rank").alias("place"), "scan_id")


@register("t2_closest_lst", sql("select spw, ts from (select *, abs(lst-10.0) as dist, row_number() over (partition by spw order by round(abs(lst-10.0),9), ts) as r from lst) where r=1 and dist<=0.5", "lst"))
def t2(spark, d):
    return timeline.best_per_group(with_lst(spark, d), ["spw"], F.round(F.abs(F.col("lst") - 10.0), 9), 0.5, "ts").select("spw", "ts")


@register("t5_closest_band", sql("select ts, spw from (select *, row_number() over (partition by ts order by abs(spw-7), spw) as r from scans) where r=1", "scans"))
def t5(spark, d):
    return timeline.best_per_group(fx.scans(spark, d), ["ts"], F.abs(F.col("spw") - 7), None, "spw").select("ts", "spw")


@register("u2_union_timeline", sql("select ts, count(*) as bands from scans group by 1", "scans"))
def u2(spark, d):
    return fx.scans(spark, d).groupBy("ts").agg(F.count("*").alias("bands"))


@register("u4_excluded_dates", sql("select distinct ts::date as \"date\" from scans except select distinct \"date\" from (select ts::date as \"date\" from scans where day(ts)%5=0)", "scans"))
def u4(spark, d):
    dates = fx.scans(spark, d).select(F.to_date("ts").alias("date"))
    return dates.distinct().exceptAll(dates.where(F.dayofmonth("date") % 5 == 0).distinct())


@register("c1_parse_names", sql("select scan_id, strptime(regexp_extract(name,'^(\\d{8}_\\d{6})_',1),'%Y%m%d_%H%M%S') as ts from names", "names"))
def c1(spark, d):
    return names(spark, d).select("scan_id", sky.parse_scan_name("name").alias("ts"))


@register("c2_frequency_tags", sql("select scan_id, regexp_extract(name,'(\\d+)MHz',1)::int as mhz from names", "names"))
def c2(spark, d):
    return names(spark, d).select("scan_id", sky.frequency_tag("name").alias("mhz"))


@register("c3_product_paths", sql("select scan_id, printf('%02d/%s/%02d/%s', (scan_id%16)::int, strftime(ts,'%Y-%m-%d'), hour(ts)::int, name) as path from scans join names using (scan_id)", "names", "scans"))
def c3(spark, d):
    both = fx.scans(spark, d).join(names(spark, d), "scan_id")
    return both.select("scan_id", F.format_string("%02d/%s/%02d/%s", (F.col("scan_id") % 16).cast("int"), F.date_format("ts", "yyyy-MM-dd"), F.hour("ts"), F.col("name")).alias("path"))


@register("c4_julian_dates", sql("select scan_id, round(jd,6) as jd, strftime(ts,'%Y-%m-%d %H:%M:%S') as utc from jd", "jd"))
def c4(spark, d):
    jd = fx.scans(spark, d).withColumn("jd", sky.julian_date("ts"))
    return jd.select("scan_id", rounded("jd").alias("jd"), sky.utc_of_julian("jd").alias("utc"))


@register("c5_sexagesimal", sql("select id, concat(case when dec<0 then '-' else '+' end, lpad((h//360000)::varchar,2,'0'), ':', lpad((h//6000%60)::varchar,2,'0'), ':', lpad((h//100%60)::varchar,2,'0'), '.', lpad((h%100)::varchar,2,'0')) as text, round(dec,4)+0.0 as dec from (select *, round_even(abs(dec)*360000,0)::bigint as h from catalog)", "catalog"))
def c5(spark, d):
    text = fx.catalog(spark, d).select("id", sky.sexagesimal("dec").alias("text"))
    return text.select("id", "text", rounded(sky.parse_sexagesimal("text"), 4).alias("dec"))


@register("c6_lst_text", sql("select scan_id, printf('%02d:%02d', (m//60)::int, (m%60)::int) as hhmm from (select *, round_even(lst*60,0)::bigint%1440 as m from lst)", "lst"))
def c6(spark, d):
    return with_lst(spark, d).select("scan_id", sky.hours_minutes("lst").alias("hhmm"))


@register("f6_sidereal_time", sql("select scan_id, round(lst,5) as lst from lst", "lst"))
def f6(spark, d):
    return r6(with_lst(spark, d).select("scan_id", "lst"), "lst", digits=5)


@register("f16_calibration_window", sql("select ts, abs(((lst-299.868152625/15+12)%24+24)%24-12)<=20/120.0 as inside from hourly", "hourly"))
def f16(spark, d):
    return hourly(spark, d).select("ts", (timeline.circular_hours(F.col("lst"), F.lit(299.868152625 / 15)) <= 20 / 120.0).alias("inside"))


@register("a30_delay_scatter", sql("select round(1.4826*median(abs(delay_ns-m)),6) as noise from delays, (select median(delay_ns) as m from delays)", "delays"))
def a30(spark, d):
    return images.mad_noise(fx.delays(spark, d), [], "delay_ns").select(rounded("noise").alias("noise"))


@register("a36_throughput", sql("select name, count(*) as n, round(avg(gap),5) as mean, round(median(gap),5) as middle, round(max(gap),5) as top, round(stddev_pop(gap),5) as std from (select *, (epoch_us(finished)-lag(epoch_us(finished)) over (partition by name order by finished))/1e6 as gap from tasklog where state='purchase') group by 1", "tasklog"))
def a36(spark, d):
    done = timeline.gaps(fx.tasklog(spark, d).where("state = 'purchase'"), "finished", ["name"])
    stats = done.groupBy("name").agg(F.count("*").alias("n"), F.avg("gap").alias("mean"), F.median("gap").alias("middle"), F.max("gap").alias("top"), F.stddev_pop("gap").alias("std"))
    return r6(stats, "mean", "middle", "top", "std", digits=5)


@register("a37_median_histogram", sql("select least(9, floor((m-0.9*lo)/((1.1*hi-0.9*lo)/10)))::bigint as bin, count(*) as n from (select *, min(m) over () as lo, max(m) over () as hi from (select ant, pol, median(sqrt(gr*gr+gi*gi)) as m from gains group by 1,2)) group by 1", "gains"))
def a37(spark, d):
    m = fx.gains(spark, d).groupBy("ant", "pol").agg(F.median(amp("gr", "gi")).alias("m"))
    ends = m.agg(F.min("m").alias("lo"), F.max("m").alias("hi"))
    width = (1.1 * F.col("hi") - 0.9 * F.col("lo")) / 10
    bins = m.join(F.broadcast(ends)).withColumn("bin", F.least(F.lit(9), F.floor((F.col("m") - 0.9 * F.col("lo")) / width)))  # one row
    return bins.groupBy("bin").agg(F.count("*").alias("n"))


@register("s12_discovery", sql("select name, strptime(regexp_extract(name,'^(\\d{8}_\\d{6})_',1),'%Y%m%d_%H%M%S') as ts, regexp_extract(name,'(\\d+)MHz',1)::int as mhz from names join scans using (scan_id) where ts between timestamp '2024-01-05' and timestamp '2024-01-06'", "names", "scans"))
def s12(spark, d):
    return tables.scan_files(names(spark, d), "2024-01-05 00:00:00", "2024-01-06 00:00:00")


define("s12_found", "select name, ts, spw::int as spw, ts::date as \"date\", hour(ts)::int as hour from names join scans using (scan_id)", "names", "scans")


def _layout(spark, d):
    """Folders of dates and hours; an hour of the fixture has one scan a sub-band."""
    path = scratch_path(spark, "layout")
    tables.write_scan_layout(tables.scan_files(names(spark, d), "1970-01-01 00:00:00", "9999-12-31 00:00:00"), path, ("date", "hour"))
    return path


@register("s12_partitioned_discovery", sql("select * from s12_found where ts between timestamp '2024-01-05 07:00:00' and timestamp '2024-01-07 15:30:00' and spw in (2, 3, 11)", "s12_found"))
def s12_partitioned(spark, d):
    return tables.discovered(spark, _layout(spark, d), "2024-01-05 07:00:00", "2024-01-07 15:30:00", [2, 3, 11])


@register("s12_listed_discovery", sql("select f.* from s12_found f join (select distinct spw, ts::date as \"date\", hour(ts) as hour from scans where scan_id%50=7) w using (spw, \"date\", hour)", "s12_found"))
def s12_listed(spark, d):
    """The folders of some scans."""
    wanted = fx.scans(spark, d).where("scan_id % 50 = 7").select("spw", F.to_date("ts").alias("date"), F.hour("ts").alias("hour"))
    return tables.discovered_for(spark, _layout(spark, d), wanted)


@register("s13_quality_select", sql("select date_trunc('day', ts) as day, spw, share from (select ts, spw, cast(count(*) over (partition by ts) as bigint) as share from scans) where share>12 and month(ts)=1", "scans"))
def s13(spark, d):
    path = scratch_path(spark, "quality")
    fx.scans(spark, d).withColumn("share", F.count("*").over(Window.partitionBy("ts"))).write.parquet(path)
    rows = spark.read.parquet(path).where((F.col("share") > 12) & (F.month("ts") == 1))
    return rows.select(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"), "spw", "share")


@register("s19_task_log", sql("select task_id, state, json_extract(payload,'$.k')::bigint as k from tasklog", "tasklog"))
def s19(spark, d):
    return fx.tasklog(spark, d).select("task_id", "state", F.from_json("payload", "k bigint")["k"].alias("k"))


@register("s5_timeline_text", sql("select ts, name as file from names join scans using (scan_id)", "names", "scans"))
def s5(spark, d):
    both = fx.scans(spark, d).join(names(spark, d), "scan_id")
    path = scratch_path(spark, "timeline")
    both.select(F.concat_ws("  ", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), "name").alias("value")).write.text(path)
    return tables.timeline(spark, path)


@register("s6_flag_csv", sql("select \"date\", corr_num::int as corr_num, source from flaglist", "flaglist"))
def s6(spark, d):
    path = scratch_path(spark, "flags")
    fx.flaglist(spark, d).write.option("header", True).csv(path)
    return tables.dated_flags(spark, path)


@register("s18_visible_sources_json", sql("select ts, count(*) as n from (select ts, degrees(asin(sin(radians(dec))*sin(radians(37.2::double))+cos(radians(dec))*cos(radians(37.2::double))*cos(radians(ra-lst*15)))) as el from hourly, calibrators) where el>10 group by 1", "hourly", "calibrators"))
def s18(spark, d):
    both = hourly(spark, d).join(F.broadcast(fx.calibrators(spark))).where(sky.elevation("ra", "dec", F.col("lst") * 15, F.lit(37.2)) > 10)  # four calibrators
    text = both.groupBy("ts").agg(F.to_json(F.collect_list(F.struct("label", "flux"))).alias("sources"))
    return text.select("ts", F.size(F.from_json("sources", "array<struct<label: string, flux: double>>")).cast("bigint").alias("n"))


def _plane(spark, d):
    return fx.vis(spark, d).where("ant1 != ant2").withColumn("amp", amp())


#: Planes for sequence algorithms: a baseline, a correlation and a span of so many scans, whatever the observation's length.
_SPAN = 360
_SPANNED = [*rfi.PLANE, "span"]


def _spans(spark, d):
    return _plane(spark, d).withColumn("span", F.floor(F.col("scan") / float(_SPAN)))


_CELL = ["scan", "ant1", "ant2", "chan", "corr"]


@register("r1_sum_threshold")
def r1(spark, d):
    return rfi.sum_thresholded(_spans(spark, d), 3.0, _SPANNED).select(*_CELL, "flag")


def _rms_sql(axis: str, level: float, source: str = "vamp", more: str = "") -> str:
    return f"select v.scan,v.ant1,v.ant2,v.chan,v.corr, {more} flag or coalesce(hit,false) as flag from {source} v left join (select ant1,ant2,corr,{axis},true as hit from (select *, avg(r) over p as m, stddev_pop(r) over p as s from (select ant1,ant2,corr,{axis},sqrt(avg(amp*amp)) as r from {source} where not flag group by 1,2,3,4) window p as (partition by ant1,ant2,corr)) where abs(r-m)>{level}*s) h using (ant1,ant2,corr,{axis})"


@register("r2_timestep_rms", sql(_rms_sql("scan", 1.7), "vamp"))
def r2(spark, d):
    return rfi.rms_threshold(_plane(spark, d), "scan", 1.7).select(*_CELL, "flag")


@register("r3_channel_rms", sql(_rms_sql("chan", 2.1), "vamp"))
def r3(spark, d):
    return rfi.rms_threshold(_plane(spark, d), "chan", 2.1).select(*_CELL, "flag")


@register("r4_high_pass")
def r4(spark, d):
    return r6(rfi.high_passed(_spans(spark, d), plane=_SPANNED).select(*_CELL, "residual"), "residual")


@register("r5_rank_operator", sql("""
select a.scan,a.ant1,a.ant2,a.chan,a.corr, bool_or(total>=-1e-9) as flag from vamp a join (
 select s.ant1,s.ant2,s.corr,s.scan,s.chan as c1,e.chan as c2, (select sum(case when flag then 0.4 else -0.6 end) from vamp v where v.ant1=s.ant1 and v.ant2=s.ant2 and v.corr=s.corr and v.scan=s.scan and v.chan between s.chan and e.chan) as total
 from vamp s join vamp e on s.ant1=e.ant1 and s.ant2=e.ant2 and s.corr=e.corr and s.scan=e.scan and s.chan<=e.chan) i
on a.ant1=i.ant1 and a.ant2=i.ant2 and a.corr=i.corr and a.scan=i.scan and a.chan between c1 and c2 group by 1,2,3,4,5""", "vamp"))
def r5(spark, d):
    return rfi.rank_operator(_plane(spark, d), "chan", 0.4).select(*_CELL, "flag")


@register("r6_mask_join", sql("select scan,ant1,ant2,chan,corr, flag or amp is null or amp=0 as flag from vamp", "vamp"))
def r6_query(spark, d):
    own = _plane(spark, d).withColumn("amp", F.when(F.col("amp") != 0, F.col("amp")))
    return rfi.with_missing_flagged(own).select(*_CELL, "flag")


@register("r7_flag_statistics", sql("select scan, chan, ant1, ant2, count(*) filter (where flag) as flagged, count(*) as total from vis group by grouping sets ((scan),(chan),(ant1,ant2))", "vis"))
def r7(spark, d):
    return rfi.flag_statistics(fx.vis(spark, d))


@register("r8_flag_schedule")
def r8(spark, d):
    return rfi.flagged(_spans(spark, d), plane=_SPANNED).select(*_CELL, "flag")


define("k2_listed", "select scan,ant1,ant2,chan,corr,re,im,amp, flag or ant1 in (3,7,12) or ant2 in (3,7,12) as flag from vamp", "vamp")
define("k2_all", "select scan,ant1,ant2,chan,corr,re,im,sqrt(re*re+im*im) as amp, flag or ant1 in (3,7,12) or ant2 in (3,7,12) as flag from vis", "vis")
define("k2_flagged", _rms_sql("scan", 1.7, "k2_all", "v.re, v.im,"), "k2_all")
define("k2_timed", "select *, epoch(ts)/86400.0::double+2440587.5 as jd from (select *, timestamp '2024-01-01' + to_hours((scan*5)::int) as ts from k2_flagged)", "k2_flagged")
define("k2_routed", "select *, hour(ts) between 1 and 14 or (lst>=11 and lst<=14) as processed from (select *, ((18.697374558+24.06570982441908*(jd-2451545.0)-118.281667*24/360)%24+24)%24 as lst from k2_timed)", "k2_timed")
define("k2_packed", "select scan, sum(byte)::bigint as packed, count(*) as bytes from (select scan, pos//8, sum(case when flag then 1<<(7-(pos%8))::int else 0 end) as byte from (select scan, flag, ((ant1*16-(ant1*(ant1-1))//2+ant2-ant1)*24+chan)*4+corr as pos from k2_routed) group by 1,2) group by 1", "k2_routed")


@register("k2_flag_and_average", sql("""
select scan, route, ant1, ant2, chan, corr, round(re,6)+0.0 as re, flag, packed, bytes from (
 select scan, 'averaged' as route, ant1, ant2, chan//4 as chan, corr, avg(re) filter (where not flag) as re, bool_and(flag) as flag from k2_routed where processed group by all
 union all select scan, 'archived', ant1, ant2, chan, corr, re, flag from k2_routed where not processed) join k2_packed using (scan)""", "k2_packed", "k2_routed"))
def k2(spark, d):
    """Flag, pack the flags, then average by hour or sidereal time what is to be processed; the rest is archived as it is.

    Every scan and every baseline, an antenna's with itself as well.
    """
    listed = spark.createDataFrame([(a,) for a in fx.FLAGGED_ANTENNAS], "ant bigint")
    found = rfi.rms_threshold(flags.flag_antennas(rfi.with_missing_flagged(fx.vis(spark, d).withColumn("amp", amp())), listed), "scan", 1.7)
    timed = found.withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(hours=(F.col("scan") * 5).cast("int")))
    routed = timeline.routed_by_hour(timed, "ts", 1, 14).withColumn("lst", sky.sidereal_hours(sky.julian_date("ts")))
    routed = routed.withColumn("processed", F.col("processed") | F.col("lst").between(11, 14))
    routed = written(routed, "routed")
    packed = flags.pack_flags(visibility.with_places(routed), "scan")
    packed = packed.groupBy("scan").agg(F.sum("byte").alias("packed"), F.count("*").alias("bytes"))
    columns = ["scan", "ant1", "ant2", "chan", "corr", "re", "flag"]
    done = calibrate.bin_channels(routed.where("processed")).select(F.lit("averaged").alias("route"), *columns)
    kept = routed.where("not processed").select(F.lit("archived").alias("route"), *columns)
    return r6(done.unionByName(kept).join(few(packed, "packed"), "scan"), "re")


define("k5_pairs", "select a.scan as early, b.scan as late from (select distinct scan from vis) a join (select distinct scan from vis) b on b.scan=a.scan+1", "vis")
define("k5_scale", "select late, t.ant1 as ant, t.chan, t.corr//2 as pol, case when t.flag or s.flag then 1.0 else sqrt(abs(t.re/nullif(s.re,0))) end as scale from k5_pairs join vis t on t.scan=late join vis s on s.scan=early and s.ant1=t.ant1 and s.ant2=t.ant2 and s.chan=t.chan and s.corr=t.corr where t.ant1=t.ant2 and t.corr in (0,3)", "k5_pairs")


@register("k5_sidereal_cleaning", sql("""
select p.late, e.ant1, e.ant2, e.chan, e.corr, round((l.re+e.re*coalesce(a.scale*b.scale,1))/2,6)+0.0 as re, e.flag or l.flag as flag from k5_pairs p join vis e on e.scan=p.early
 join vis l on l.scan=p.late and l.ant1=e.ant1 and l.ant2=e.ant2 and l.chan=e.chan and l.corr=e.corr
 left join k5_scale a on a.late=p.late and a.ant=e.ant1 and a.chan=e.chan and a.pol=e.corr//2 left join k5_scale b on b.late=p.late and b.ant=e.ant2 and b.chan=e.chan and b.pol=e.corr%2""", "k5_scale"))
def k5(spark, d):
    """Scans one sidereal day apart: flags of both, the early one scaled to the late one, then their mean."""
    vis = fx.vis(spark, d)
    day = F.make_dt_interval(hours=F.lit(23), mins=F.lit(56), secs=F.lit(4.0))
    times = vis.select("scan").distinct().select(F.lit(0).alias("spw"), F.col("scan").alias("scan_id"), (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + day * F.col("scan")).alias("ts"))
    pairs = few(timeline.sidereal_pairs(times).select(F.col("early_id").alias("early"), F.col("late_id").alias("late")), "pairs")
    keys = ["late", "ant1", "ant2", "chan", "corr"]
    early = vis.join(pairs.withColumnRenamed("early", "scan"), "scan").drop("scan")
    late = vis.withColumnRenamed("scan", "late").join(pairs.select("late"), "late")
    flag = flags.merged_pair(early, late, keys)
    scale = calibrate.solve_gain_scale(late, early, ("late",))
    scaled = calibrate.apply_gain_scale(early, scale, ("late",), lenient=True)
    both = calibrate.integrated([scaled, late], tuple(keys)).where("n = 2").join(flag, keys)
    return r6(both.select(*keys, "re", "flag"), "re")


define("k6_zero", "select scan, floor(1000.0*count(*) filter (where re=0 and im=0)/count(*))::bigint as share, count(*) filter (where flag) as flagged, count(*) as n from vis group by 1", "vis")


@register("k6_quality_report", sql("""
select 'zeros' as section, concat(scan, ': ', share) as line from k6_zero union all select 'flags', concat(scan, ': ', flagged, '/', n) from k6_zero
union all select 'clean up', concat('scan ', scan) from k6_zero where share>1 union all select 'gains', concat('bad ',kind,': ',string_agg(id::varchar, ',' order by id)) from gainbad group by kind
union all select 'antennas', concat(scan, ': ', string_agg(ant::varchar, ',' order by ant)) from dead group by scan""", "k6_zero", "gainbad", "dead"))
def k6(spark, d):
    """The report: zeros and flags of each scan, scans to clean up, bad gains, dead antennas."""
    vis = fx.vis(spark, d)
    section = lambda df, name, line: df.select(F.lit(name).alias("section"), line.alias("line"))
    zero = flags.zero_fraction(vis, ["scan"], 1000)
    told = vis.groupBy("scan").agg(F.count_if("flag").alias("flagged"), F.count("*").alias("n"))
    dead = flags.dead_antennas(vis, fx.OUTRIGGERS, 0.4, F.abs("re")).groupBy("scan").agg(F.concat_ws(",", F.transform(F.array_sort(F.collect_set("ant")), lambda a: a.cast("string"))).alias("ants"))
    out = section(zero, "zeros", F.concat_ws(": ", "scan", "zero_share"))
    for more in (
        section(told, "flags", F.concat(F.col("scan"), F.lit(": "), F.col("flagged"), F.lit("/"), F.col("n"))),
        section(zero.where("zero_share > 1"), "clean up", F.concat(F.lit("scan "), F.col("scan"))),
        section(flags.quality_lines(flags.gain_quality(fx.gains(spark, d), 0.5, 0.5)), "gains", F.col("line")),
        section(dead, "antennas", F.concat_ws(": ", "scan", "ants")),
    ):
        out = out.unionByName(more)
    return out


@register("k7_calibrator_scans", sql(f"""
select spw, ts, mhz>=4 as used, hours from (select scan_id, spw, ts from (select *, abs(lst-10.0) as dist, row_number() over (partition by spw order by round(abs(lst-10.0),9), ts) as r from lst) where r=1 and dist<=0.5)
 join (select scan_id, regexp_extract(name,'(\\d+)MHz',1)::int as mhz from names) using (scan_id) left join ({_W10}) b on b.hour=date_trunc('hour', ts)""", "lst", "names"))
def k7(spark, d):
    """Of each band the scan closest to a sidereal time, whether the band is used, and the block of records it lies in."""
    tagged = names(spark, d).select("scan_id", sky.frequency_tag("name").alias("mhz"))
    chosen = timeline.best_per_group(with_lst(spark, d), ["spw"], F.round(F.abs(F.col("lst") - 10.0), 9), 0.5, "ts").join(tagged, "scan_id")
    blocks = timeline.full_blocks(fx.scans(spark, d), "ts", 14)
    both = chosen.withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz")).join(blocks.withColumn("hour", F.col("hour").cast("timestamp_ntz")), "hour", "left")
    return both.select("spw", "ts", (F.col("mhz") >= 4).alias("used"), "hours")


@register("z1_incremental_ingest", "select event_id, user_id, value from events")
def z1(spark, d):
    base = scratch_path(spark, "ingest")
    ingest.run_available(ingest.file_stream(spark, d, "events.parquet").select("event_id", "user_id", "value"), f"{base}/out", f"{base}/state")
    return spark.read.parquet(f"{base}/out")


@register("z2_watermarked_counts", "select date_trunc('hour', ts) as start, user_id%16 as spw, count(*) as n, round(sum(value),4) as total from events where date_trunc('hour', ts)+interval 1 hour <= (select max(ts) from events)-interval 2 hours group by 1,2")
def z2(spark, d):
    base = scratch_path(spark, "counts")
    stream = ingest.hourly_counts(ingest.file_stream(spark, d, "events.parquet"))
    ingest.run_available(stream, f"{base}/out", f"{base}/state")
    return spark.read.parquet(f"{base}/out").withColumn("total", rounded("total", 4))


@register("z3_batch_chain", "select user_id%16 as spw, count(*) as n, round(sum(value),4) as total from events group by 1")
def z3(spark, d):
    base = scratch_path(spark, "chain")
    work = lambda batch: batch.groupBy((F.col("user_id") % 16).alias("spw")).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    ingest.for_each_batch(ingest.file_stream(spark, d, "events.parquet"), work, f"{base}/out", f"{base}/state")
    return spark.read.parquet(f"{base}/out").groupBy("spw").agg(F.sum("n").alias("n"), rounded(F.sum("total"), 4).alias("total"))


define("z3_listed", "select *, timestamp '2024-01-01' + to_hours((scan*5)::int) as ts from k2_listed", "k2_listed")
define("z3_rms", "select *, sqrt(amp*amp) as r from z3_listed where not flag", "z3_listed")
define("z3_flagged", "select v.scan, v.ant1, v.ant2, v.chan, v.corr, v.re, v.ts, v.flag or coalesce(abs(r.r-r.m)>1.7*r.s, false) as flag from z3_listed v left join (select scan, ant1, ant2, corr, chan, r, avg(r) over p as m, stddev_pop(r) over p as s from z3_rms window p as (partition by scan, ant1, ant2, corr)) r using (scan, ant1, ant2, corr, chan)", "z3_rms")
define("z3_lst", "select *, ((18.697374558+24.06570982441908*(epoch(ts)/86400.0::double+2440587.5-2451545.0)-118.281667*24/360)%24+24)%24 as lst from z3_flagged", "z3_flagged")
define("z3_routed", "select *, hour(ts) between 1 and 14 or (lst>=11 and lst<=14) or exists (select 1 from calibrators c where abs(((z.lst-c.ra/15+12)%24+24)%24-12)<=60/120.0) as processed from z3_lst z", "z3_lst", "calibrators")
define("z3_packed", "select scan, sum(byte)::bigint as packed, count(*) as bytes from (select scan, pos//8, sum(case when flag then 1<<(7-(pos%8))::int else 0 end) as byte from (select scan, flag, ((ant1*16-(ant1*(ant1-1))//2+ant2-ant1)*24+chan)*4+corr as pos from z3_routed) group by 1,2) group by 1", "z3_routed")
define("z3_data", "select scan, 'averaged' as route, ant1, ant2, chan//4 as chan, corr, avg(re) filter (where not flag) as re, bool_and(flag) as flag from z3_routed where processed group by all union all select scan, 'archived', ant1, ant2, chan, corr, re, flag from z3_routed where not processed", "z3_routed")
_SNAPSHOTS = sql("select scan, route, ant1, ant2, chan, corr, round(re,6)+0.0 as re, flag, packed, bytes from z3_data join z3_packed using (scan)", "z3_data", "z3_packed")


def timed_snapshots(spark, d):
    """Cross baselines with the time of their scan, five hours apart."""
    return _plane(spark, d).withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(hours=(F.col("scan") * 5).cast("int")))


def snapshot_products(spark, flagger):
    listed = spark.createDataFrame([(a,) for a in fx.FLAGGED_ANTENNAS], "ant bigint")
    return lambda vis: snapshots.chain(vis, listed, fx.calibrators(spark), flagger, fx.N_ANT, fx.N_CHAN, transit_minutes=60.0)


def _told(products):
    packed = products["flags"].groupBy("scan").agg(F.sum("byte").alias("packed"), F.count("*").alias("bytes"))
    return r6(products["data"].join(few(packed, "packed"), "scan"), "re").select("scan", "route", "ant1", "ant2", "chan", "corr", "re", "flag", "packed", "bytes")


@register("k2_snapshot_chain", _SNAPSHOTS)
def k2_chain(spark, d):
    """Every snapshot by itself: flags by channel, packed flags, route by hour, sidereal time or transit, average."""
    return _told(snapshot_products(spark, snapshots.by_channel(1.7))(timed_snapshots(spark, d)))


@register("k2_schedule_chain")
def k2_schedule(spark, d):
    """The same with the whole flagging schedule on planes of many scans; no SQL, as R8 has none."""
    return _told(snapshot_products(spark, snapshots.by_schedule(_SPAN))(timed_snapshots(spark, d)))


def _streamed(spark, d):
    base = scratch_path(spark, "snapshots")
    timed_snapshots(spark, d).repartition("scan").write.partitionBy("scan").parquet(f"{base}/in")
    stream = ingest.file_stream(spark, f"{base}/in", files=3).withColumn("scan", F.col("scan").cast("bigint"))
    ingest.snapshot_chain(stream, snapshot_products(spark, snapshots.by_channel(1.7)), f"{base}/out", f"{base}/state")
    schemas = {"flags": "byte_idx bigint, byte bigint, scan bigint", "data": "route string, ant1 bigint, ant2 bigint, chan bigint, corr int, re double, flag boolean, scan bigint"}
    return {name: tables.read_or_empty(spark, f"{base}/out/version=1/{name}", schema) for name, schema in schemas.items()}


@register("z3_snapshot_chain", _SNAPSHOTS)
def z3_chain(spark, d):
    """The chain of ``k2_snapshot_chain`` as snapshots come in."""
    return _told(_streamed(spark, d))


@register("z3_snapshot_co_add", sql("select ant1, ant2, chan, corr, round(avg(re),6)+0.0 as re, count(*) as n from z3_data where route='averaged' and not flag group by 1,2,3,4", "z3_data"))
def z3_co_add(spark, d):
    """The co-add of the averaged snapshots that have come in."""
    return r6(snapshots.co_added(_streamed(spark, d)["data"]), "re")
