"""Scans of tables and files, layouts and versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sky import frequency_tag, parse_scan_name


def strided(spark: SparkSession, path: str, columns: list[str], key: str, start: int, step: int) -> DataFrame:
    """Some columns of the rows whose key is start, start + step, ...; the lower bound reaches the Parquet scan."""
    return spark.read.parquet(path).select(*columns).where((F.col(key) >= start) & (F.pmod(F.col(key) - start, F.lit(step)) == 0))


def timeline(spark: SparkSession, path: str) -> DataFrame:
    """(ts, file) of text lines 'date time file'."""
    part = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).where(F.trim("value") != "")
    return rows.select(F.try_to_timestamp(F.concat_ws(" ", part[0], part[1])).cast("timestamp_ntz").alias("ts"), part[2].alias("file"))


def dated_flags(spark: SparkSession, path: str) -> DataFrame:
    """(date, corr_num, source) of a CSV file with a header; no rows where there is no file."""
    schema = "date date, corr_num int, source string"
    try:
        return spark.read.schema(schema).csv(path, header=True)
    except Exception as problem:  # a missing path alone is an empty list
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        return spark.createDataFrame([], schema)


def scan_files(names: DataFrame, start: str, end: str) -> DataFrame:
    """(name, ts, mhz) of the scan files of the closed range [start, end], by name."""
    found = names.select("name", parse_scan_name("name").alias("ts"), frequency_tag("name").alias("mhz"))
    return found.where(F.col("ts").between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")))


LAYOUT = "name string, ts timestamp_ntz, spw int, date date, hour int"


def write_scan_layout(files: DataFrame, path: str, by: tuple[str, ...] = ("spw", "date", "hour")) -> None:
    """The records (name, ts, mhz) of scan files in folders, by sub-band, date and hour or some of them; one file a folder
    and write."""
    keyed = files.where("ts is not null and mhz is not null").select("name", "ts", F.col("mhz").alias("spw"), F.to_date("ts").alias("date"), F.hour("ts").alias("hour"))
    parts = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # folders are many and small: no joining of tasks
    keyed.repartition(parts, *by).sortWithinPartitions(*by, "ts").write.partitionBy(*by).parquet(path)


def discovered(spark: SparkSession, path: str, start: str, end: str, spws: list[int] | None = None) -> DataFrame:
    """(name, ts, spw, date, hour) of the closed range [start, end] and the sub-bands; folders outside are not opened.

    Dates and the hours of the first and last date are conditions on the folders, the times themselves on their records.
    """
    s, e = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    rows = spark.read.schema(LAYOUT).parquet(path)
    rows = rows.where(F.col("date").between(s.cast("date"), e.cast("date")))
    rows = rows.where(((F.col("date") > s.cast("date")) | (F.col("hour") >= F.hour(s))) & ((F.col("date") < e.cast("date")) | (F.col("hour") <= F.hour(e))))
    rows = rows if spws is None else rows.where(F.col("spw").isin(*spws))
    return rows.where(F.col("ts").between(s, e))


def discovered_for(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The records of the folders that ``wanted`` (spw, date, hour) lists; a selective list prunes folders as the query
    runs."""
    listed = wanted.select(F.col("spw").cast("int").alias("spw"), "date", F.col("hour").cast("int").alias("hour")).distinct()
    return spark.read.schema(LAYOUT).parquet(path).join(listed, ["spw", "date", "hour"]).select("name", "ts", "spw", "date", "hour")


def catalogue(df: DataFrame, date_obs: str, jd_obs: float, *keys: str) -> DataFrame:
    """The ``keys`` and the columns of a source catalogue; x, y and local_rms are null if absent; date and Julian date as columns."""
    doubles = ("ra", "dec", "peak_flux", "a", "b", "pa")
    columns = [F.col(c).cast("double").alias(c) for c in doubles]
    for c, kind in (("x", "bigint"), ("y", "bigint"), ("local_rms", "double")):
        columns.append((F.col(c) if c in df.columns else F.lit(None)).cast(kind).alias(c))
    return df.select(*keys, *columns, F.lit(date_obs).alias("date_obs"), F.lit(float(jd_obs)).alias("jd_obs"))


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table, or none of its rows where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as problem:  # a missing path alone is an empty table
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        return spark.createDataFrame([], schema)


def write_version(df: DataFrame, path: str, version: int, by: str) -> None:
    """A table with new columns as a new version beside those before; no version is written twice."""
    df.write.partitionBy(by).parquet(f"{path}/version={version}")


def read_version(spark: SparkSession, path: str, version: int) -> DataFrame:
    """A version of a table; partition columns come back as whole numbers."""
    out = spark.read.parquet(f"{path}/version={version}")
    return out.withColumns({c: F.col(c).cast("bigint") for c, kind in out.dtypes if kind == "int"})
