"""Incremental ingest of scan records (Z1-Z3) by Structured Streaming over a file source."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.timeline import not_done
from ..session import release, tracked
from ..sources.tables import read_or_empty


def file_stream(spark: SparkSession, path: str, glob: str = "*.parquet", files: int | None = None) -> DataFrame:
    """A stream of the Parquet files of a folder, with the schema of those that are there; ``files`` of them a batch at most."""
    schema = spark.read.option("pathGlobFilter", glob).parquet(path).schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    return (stream if files is None else stream.option("maxFilesPerTrigger", files)).parquet(path)


def run_available(stream: DataFrame, sink: str, state: str, mode: str = "append") -> None:
    """Take in what is there and not taken in yet, then stop."""
    stream.writeStream.format("parquet").outputMode(mode).option("path", sink).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()


def hourly_counts(events: DataFrame, ts: str = "ts", late: str = "2 hours") -> DataFrame:
    """(start, spw, n, total) of each hour, closed by a watermark: scans that are absent leave a gap, never a wait."""
    timed = events.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
    return timed.groupBy(F.window("_ts", "1 hour").alias("w"), (F.col("user_id") % 16).alias("spw")).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(
        F.col("w.start").cast("timestamp_ntz").alias("start"), "spw", "n", "total"
    )


def for_each_batch(stream: DataFrame, work: Callable[[DataFrame], DataFrame], sink: str, state: str) -> None:
    """Z3: run ``work`` on every micro-batch and write its rows under the batch's number, so that a repeated batch
    replaces itself."""

    def one(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    stream.writeStream.foreachBatch(one).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()


def snapshot_chain(stream: DataFrame, work: Callable[[DataFrame], dict[str, DataFrame]], sink: str, state: str, version: int = 1) -> None:
    """Z3: run ``work`` on the snapshots (column ``scan``) of every micro-batch that have no output yet, and write its products by
    scan below ``sink/version=.../``.

    Files hold whole snapshots. Snapshots are entered in the list of what is done (P11) after all their products are written,
    so those of a batch that failed half-way are made again and replace what is there, and those that come again, in a
    repeated batch or another one, are left alone. A new version starts from nothing beside the old. Scratch tables of
    ``work`` are deleted with each batch.
    """
    base = f"{sink}/version={version}"

    def put(df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("scan").parquet(f"{base}/{name}")

    def one(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        done = read_or_empty(spark, f"{base}/done", "at timestamp, scan bigint")
        fresh = not_done(batch, done, ["scan"])
        if fresh.isEmpty():
            return
        with tracked() as scratch:
            for name, product in work(fresh).items():
                put(product, name)
        release(*scratch)
        put(batch.select("scan").distinct().withColumn("at", F.current_timestamp()), "done")

    stream.writeStream.foreachBatch(one).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
