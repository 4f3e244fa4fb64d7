"""Tables in folders by value of some columns, written so that only the folders that a load touches change."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .places import delete


def append(df: DataFrame, path: str, by: list[str]) -> None:
    """Add rows. A folder's rows come from one task each, or a folder would get a file from every task; a third of all rows in one folder is split by AQE."""
    df.hint("rebalance", *by).write.mode("append").partitionBy(*by).parquet(path)


def quarantine(bad: DataFrame, path: str, stage: str, reason: Column, as_of: Column) -> None:
    """Append rejected rows of any shape to a table of (stage, as_of, reason, row as JSON), a folder for each stage."""
    append(bad.select(F.to_json(F.struct(*bad.columns)).alias("row"), reason.cast("string").alias("reason"), as_of.cast("timestamp").alias("as_of"), F.lit(stage).alias("stage")), path, ["stage"])


def files(spark: SparkSession, path: str, by: list[str]) -> DataFrame:
    """The folders' values and the names of their files."""
    return spark.read.parquet(path).select(*by, F.col("_metadata.file_name").alias("file")).distinct()


def _among(by: list[str], values: list[tuple]) -> Column:
    """A condition that prunes folders: by has one of the values."""
    if len(by) == 1:
        some = [v for (v,) in values if v is not None]
        there = F.col(by[0]).isin(some) if some else F.lit(False)
        return there | F.col(by[0]).isNull() if (None,) in values else there
    return reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(by, row, strict=True)]) for row in values], F.lit(False))


def overwrite_keys(spark: SparkSession, path: str, new: DataFrame, keys: list[str], by: list[str]) -> dict[str, int]:
    """The table at path with new rows in place of those that have their keys, which occur once in new; keys and by aren't null.

    Only folders that new rows go to, or that rows of their keys are in, are read as a whole and written; of the others only
    keys are read, to find those. Spark stages the new folders and puts them in place at the end of the job. Folders that lose
    their last row are removed after that; a run that breaks off in between may be repeated. Numbers of folders: touched and emptied.
    """
    old = spark.read.parquet(path)
    places = old.select(*keys, *by).join(new.select(*keys), keys, "left_semi").select(*by).union(new.select(*by)).distinct()
    # As many values as the table has folders at most.
    touched = [tuple(r) for r in places.collect()]
    if not touched:
        return {"touched": 0, "emptied": 0}
    stays = old.where(_among(by, touched)).join(new.select(*keys), keys, "left_anti")
    out = stays.unionByName(new.select(*old.columns))
    out.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    # What was written has new's folders and those in which rows stay. Others still have only rows whose keys moved on.
    now = spark.read.parquet(path).where(_among(by, touched)).withColumn("folder", F.regexp_replace("_metadata.file_path", "/[^/]*$", ""))
    left = now.join(new.select(*by).distinct(), by, "left_anti").join(new.select(*keys), keys, "left_semi")
    emptied = [r.folder for r in left.select("folder").distinct().collect()]
    for folder in emptied:
        delete(spark, folder)
    return {"touched": len(touched), "emptied": len(emptied)}
