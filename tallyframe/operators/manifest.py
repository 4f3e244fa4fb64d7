"""Harvest manifests: one row a game with a map of endpoints, merged, rolled up and reported."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import error_fingerprint

ENDPOINTS = "map<string,struct<ok:boolean,bytes:bigint>>"


def merge_manifest(old: DataFrame, new: DataFrame) -> DataFrame:
    """(game_id, endpoints, errors): the new record's endpoints win, errors are appended."""
    o, n = (d.select("game_id", F.col("endpoints").alias(f"{p}_e"), F.col("errors").alias(f"{p}_x")) for d, p in ((old, "o"), (new, "n")))
    none, empty = F.create_map().cast(ENDPOINTS), F.array().cast("array<string>")
    oe, ne = F.coalesce("o_e", none), F.coalesce("n_e", none)
    kept = F.map_filter(oe, lambda k, v: ~F.map_contains_key(ne, k))
    return o.join(n, "game_id", "full_outer").select("game_id", F.map_concat(kept, ne).alias("endpoints"), F.concat(F.coalesce("o_x", empty), F.coalesce("n_x", empty)).alias("errors"))


def n_ok() -> Column:
    return F.size(F.filter(F.map_values("endpoints"), lambda v: v["ok"]))


#: A harvest is good by one of three rules.
RULES = {"harvest": lambda: n_ok() >= 2, "report": lambda: (n_ok() >= 2) & (F.size("errors") == 0), "manifest": lambda: (n_ok() >= 1) & (F.size("errors") == 0)}


def rollup(manifest: DataFrame, rule: str = "report") -> DataFrame:
    """One row: games, good games, success_rate and bytes."""
    size = F.aggregate(F.map_values("endpoints"), F.lit(0).cast("bigint"), lambda a, v: a + F.coalesce(v["bytes"], F.lit(0)))
    return manifest.agg(F.count("*").alias("n_games"), F.count_if(RULES[rule]()).alias("n_good"), F.sum(size).alias("n_bytes")).withColumn("success_rate", F.coalesce(F.try_divide(F.col("n_good").cast("double"), F.col("n_games").cast("double")), F.lit(0.0)))


def by_endpoint(manifest: DataFrame) -> DataFrame:
    """Successes, failures and bytes of each endpoint."""
    e = manifest.select(F.explode("endpoints").alias("endpoint", "got"))
    return e.groupBy("endpoint").agg(F.count_if(F.col("got.ok")).alias("n_ok"), F.count_if(~F.col("got.ok")).alias("n_failed"), F.sum("got.bytes").alias("n_bytes"))


def top_errors(errors: DataFrame, column: str, n: int = 5) -> DataFrame:
    """The n most frequent messages, alike ones as one."""
    return errors.groupBy(error_fingerprint(F.col(column)).alias("error")).agg(F.count("*").alias("n_rows")).orderBy(F.desc("n_rows"), "error").limit(n)


def query_stats(log: DataFrame, slow_sec: float = 1.0) -> DataFrame:
    """Count, total, least, greatest and mean seconds by fingerprint of a query log (sql, seconds)."""
    from ..functions.text import sql_fingerprint

    return log.groupBy(sql_fingerprint(F.col("sql"))["hash"].alias("query_hash")).agg(
        F.count("*").alias("n_runs"), F.sum("seconds").alias("total_sec"), F.min("seconds").alias("min_sec"), F.max("seconds").alias("max_sec"), F.avg("seconds").alias("avg_sec"), F.count_if(F.col("seconds") > slow_sec).alias("n_slow")
    )


def top_queries(stats: DataFrame, metric: str = "total_sec", n: int = 10) -> DataFrame:
    """The n rows of query_stats() with the highest value of one of its columns, with their rank: a report."""
    if metric not in ("n_runs", "total_sec", "min_sec", "max_sec", "avg_sec", "n_slow"):
        raise ValueError(f"top_queries: no metric {metric}")
    best = stats.orderBy(F.desc(metric), "query_hash").limit(n)
    # At most n rows.
    return best.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.desc(metric), "query_hash")))
