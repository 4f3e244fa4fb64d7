"""Shared pieces of the training-data operators: table access, lineage cuts, bounded filters, components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space that separates words and that exact dedup ignores.
SPACE = r"[\x20\x09-\x0D]+"
#: A filter has FILTER_BUCKETS bitmaps of 4 KiB, 8 MiB in all, whatever the table's size.
FILTER_BUCKETS = 2048
BITS = 32768
#: A key of more than one in HOT_KEYS of all rows, and of HOT_ROWS at least, is hot.
HOT_KEYS, HOT_ROWS = 4096, 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; a temporary one of this machine only where that is unset (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        base = f"file://{tempfile.gettempdir()}/tallyframe-scratch"
    return f"{base.rstrip('/')}/tf-{uuid.uuid4().hex}"


def stash(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it back: later jobs restart from the files, not from the inputs."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept.stash_path = path
    return kept


def words(text: Column) -> Column:
    """Words between ASCII white space; empty array for null and blank texts."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE))


def keep_rows(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of docs whose doc_id is in ids (doc_id); null counts as an id."""
    ids = ids.select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["kept_id"]), "left_semi")


def key_filter(df: DataFrame, key: Column) -> DataFrame:
    """A one-hash filter of key as rows (bucket, bits): FILTER_BUCKETS rows of 4 KiB at most, so it may be broadcast."""
    at = F.pmod(F.xxhash64(key), F.lit(FILTER_BUCKETS * BITS))
    return df.select(at.alias("at")).groupBy(F.expr(f"int(at div {BITS})").alias("f_bucket")).agg(F.bitmap_construct_agg(F.expr(f"at % {BITS}")).alias("f_bits"))


def marked(df: DataFrame, key: Column, made: DataFrame, name: str) -> DataFrame:
    """df with a boolean column name: false where key is certainly not in the filter."""
    at = F.pmod(F.xxhash64(key), F.lit(FILTER_BUCKETS * BITS))
    held = df.withColumn("f_at", at).withColumn("f_bucket", F.expr(f"int(f_at div {BITS})")).join(F.broadcast(made), "f_bucket", "left")
    byte = F.expr(f"int(conv(hex(substring(f_bits, int(f_at % {BITS} div 8) + 1, 1)), 16, 10))")
    return held.withColumn(name, F.coalesce(F.getbit(byte, F.expr("int(f_at % 8)")) == 1, F.lit(False))).drop("f_at", "f_bucket", "f_bits")


def maybe_in(df: DataFrame, key: Column, made: DataFrame) -> DataFrame:
    """Rows of df whose key may be in the filter: none that is in it is lost, a few others pass."""
    return marked(df, key, made, "f_maybe").where("f_maybe").drop("f_maybe")


def join_counted(left: DataFrame, right: DataFrame, key: str, rows: str, total: int, how: str = "inner") -> DataFrame:
    """left with what right has for its key (how: inner or left). right has each key once; its column rows, which is dropped, says how
    many of left's total rows have that key.

    Keys of more than one row in HOT_KEYS of left, of which there can't be more than HOT_KEYS, are broadcast, so their rows
    stay where they are; no other key has more rows than that in one task. left is read twice.
    """
    most = max(HOT_ROWS, total // HOT_KEYS)
    hot, cold = right.where(F.col(rows) > most).drop(rows), right.where(F.col(rows) <= most).drop(rows)
    rest = left.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key, how)
    return rest.unionByName(left.join(F.broadcast(hot), key))


def forget(df: DataFrame) -> None:
    """Delete the files of a stash that no DataFrame reads any more."""
    delete(df.sparkSession, df.stash_path)


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, root) for every node of edges (a, b of one type): root is the smallest node that it can reach.

    Large-star and small-star steps in turn, each written to the shared folder, until the edges no longer change.
    Their number grows with the logarithm of the longest chain; each step moves one row for each edge. A hub's edges
    meet its smallest neighbour where they lie (join_counted). Raises where the rounds don't suffice.
    """
    now = stash(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = None
    for _ in range(rounds):
        mark = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("sum(cast(pmod(xxhash64(v, u), 1000003) as bigint))")).first()
        if mark == seen or not mark[0]:
            break
        seen, n = mark, mark[0]
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
        large = join_counted(both.where("v > u"), low, "u", "n", 2 * n)
        large = stash(large.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = join_counted(large, low, "u", "n", n).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        last, now = now, stash(small.where("u <> v").distinct())
        forget(last)
        forget(large)
    else:
        raise RuntimeError("components: the edges still change")
    return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
