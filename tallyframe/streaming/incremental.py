"""Resumable increments: watermark tables, chunked backfill, and streams of files or events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WATERMARKS = "stage string, key string, value string, updated_at timestamp"


def set_watermark(marks: DataFrame, stage: str, key: str, value: Column, as_of: Column) -> DataFrame:
    """marks (stage, key, value, updated_at) with one value replaced."""
    one = marks.sparkSession.range(1).select(F.lit(stage).alias("stage"), F.lit(key).alias("key"), value.cast("string").alias("value"), as_of.cast("timestamp").alias("updated_at"))
    return marks.where(~((F.col("stage") == stage) & (F.col("key") == key))).unionByName(one)


def after_watermark(rows: DataFrame, column: str, marks: DataFrame, stage: str, key: str) -> DataFrame:
    """Rows beyond the mark in text order; all where there is none. The mark is one row, broadcast."""
    mark = marks.where((F.col("stage") == stage) & (F.col("key") == key)).agg(F.max("value").alias("mark"))
    return rows.crossJoin(F.broadcast(mark)).where(F.col("mark").isNull() | (F.col(column).cast("string") > F.col("mark"))).drop("mark")


def chunks(start: Column, end: Column, days: int) -> Column:
    """array<struct(first, last)> of date ranges of at most days days."""
    return F.transform(F.sequence(start, end, F.expr(f"INTERVAL {days} DAYS")), lambda d: F.struct(d.alias("first"), F.least(F.date_add(d, days - 1), end).alias("last")))


def open_chunks(start: Column, end: Column, days: int, done_to: Column) -> Column:
    """The chunks that end after done_to, the last day of the last chunk that went through; all where it is null."""
    return F.filter(chunks(start, end, days), lambda c: done_to.isNull() | (c["last"] > done_to))


def season_days(season: Column) -> Column:
    """Each date from October 1 to April 30."""
    year = F.substring(season, 1, 4).try_cast("int")
    return F.sequence(F.make_date(year, F.lit(10), F.lit(1)), F.make_date(year + 1, F.lit(4), F.lit(30)), F.expr("INTERVAL 1 DAY"))


def event_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def deduplicated(stream: DataFrame, at: str, keys: list[str], delay: str) -> DataFrame:
    """Without events seen before within the delay; state older than that is dropped."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)


def windowed_counts(stream: DataFrame, at: str, key: str, length: str = "1 day", delay: str = "1 day", value: str = "value") -> DataFrame:
    """Rows and sum of each key and tumbling window; late rows within the delay count."""
    w = stream.withWatermark(at, delay).groupBy(F.window(at, length).alias("w"), key).agg(F.count("*").alias("n_rows"), F.sum(value).alias("total"))
    return w.select(F.col("w.start").alias("window_start"), key, "n_rows", "total")


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> None:
    """Process what has come since the last run, batch by batch; a batch that fails is done again, and the mark does not pass it."""
    stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(each).start().awaitTermination()
