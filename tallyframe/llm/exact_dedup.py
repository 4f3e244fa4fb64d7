"""Exact dedup by a log-structured merge index of text digests, in DataFrame operations only.

Memtables of documents flush sorted runs of digests, each with the digest's best row so far and its count. A level's runs
lie in one table, bucketed and sorted by digest, so that compaction, which merges FAN_OUT runs at a time and keeps the
smallest identifier among the longest originals, moves no row. The last run's digests with several rows are hits; a filter
of them, of bounded size, is what every document is looked up in: those that it lacks have no copy and stay where they
are, the others meet the run. The bytes of each hit are compared with those of the row that stays, salted so that a group
of any size spreads over tasks. Rows whose bytes differ though their digests agree are grouped again by the bytes.

Digests that many rows share meet the run where they lie (common.join_counted).

Defined cases: a null text is empty; empty texts are equal; a null doc_id comes after all others; rows that repeat a doc_id
and its text count as documents of their own and share its fate; other columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACE, delete, join_counted, key_filter, marked, maybe_in, scratch, stash, table

#: Rows of a memtable, runs that one compaction merges, and members that one copy of a kept text is compared with.
MEMTABLE_ROWS, FAN_OUT, SALT_ROWS = 250_000, 8, 256


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")


class MergeIndex:
    """Runs of (run, digest, best, rows) under one folder, a table for each level; bucketed by digest, so a bucket has its part of every run."""

    def __init__(self, spark: SparkSession, path: str | None = None, memtable_rows: int = MEMTABLE_ROWS, fan_out: int = FAN_OUT):
        self.spark, self.path, self.memtable_rows, self.fan_out = spark, path or scratch(spark), memtable_rows, fan_out
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name, self.level, self.runs, self.rows = f"merge_index_{uuid.uuid4().hex}", -1, 0, 0

    def _place(self, level: int) -> tuple[str, str]:
        return f"{self.name}_{level}", f"{self.path}/level={level}"

    def _write(self, df: DataFrame) -> None:
        name, path = self._place(self.level + 1)
        df.write.option("path", path).bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(name)
        self.level += 1

    def read(self) -> DataFrame:
        return self.spark.table(self._place(self.level)[0])

    def flush(self, keyed: DataFrame) -> None:
        """keyed: doc_id, n_chars, digest. Rows go to memtables by a hash of their id, each memtable to a run; what a memtable has several times is one entry before it moves."""
        self.rows = keyed.count()
        self.runs = max(1, -(-self.rows // self.memtable_rows))
        best = F.struct((-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("none"), F.col("doc_id"))
        entries = keyed.select(F.pmod(F.xxhash64("doc_id"), F.lit(self.runs)).alias("run"), "digest", best.alias("best"))
        entries = entries.groupBy("run", "digest").agg(F.min("best").alias("best"), F.count("*").alias("rows"))
        self._write(entries.repartition(self.buckets, "digest"))

    def compact(self) -> None:
        """Merge runs until one is left. Buckets hold all of a digest, so nothing is exchanged."""
        while self.runs > 1:
            merged = self.read().withColumn("run", F.expr(f"run div {self.fan_out}")).groupBy("run", "digest").agg(F.min("best").alias("best"), F.sum("rows").alias("rows"))
            self._write(merged)
            self.runs = -(-self.runs // self.fan_out)
            name, path = self._place(self.level - 1)
            self.spark.sql(f"DROP TABLE {name}")
            delete(self.spark, path)

    def hits(self) -> DataFrame:
        """digest, keep_id, group_size of each digest that several rows have."""
        return self.read().where("rows > 1").select("digest", F.col("best.doc_id").alias("keep_id"), F.col("rows").alias("group_size"))

    def close(self) -> None:
        """Remove what there is of the index, also after a failure; what was read from it must be stashed."""
        for level in range(self.level + 2):
            self.spark.sql(f"DROP TABLE IF EXISTS {self._place(level)[0]}")
        delete(self.spark, self.path)


def exact_dedup(docs: DataFrame, memtable_rows: int = MEMTABLE_ROWS, fan_out: int = FAN_OUT, digest=lambda text: F.sha2(text, 256)) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for each row of docs (doc_id, text). digest: of a normalised text."""
    spark = docs.sparkSession
    body = normalised(F.col("text"))
    keyed = stash(docs.select("doc_id", F.length(F.coalesce("text", F.lit(""))).alias("n_chars"), digest(body).alias("digest"), F.sha2(body, 256).alias("text_sha256")))
    index = MergeIndex(spark, memtable_rows=memtable_rows, fan_out=fan_out)
    try:
        index.flush(keyed)
        index.compact()
        hits = stash(index.hits())
    finally:
        index.close()
    looked_up = marked(keyed, F.col("digest"), key_filter(hits, F.col("digest")), "maybe")
    met = join_counted(looked_up.where("maybe").drop("maybe"), hits.withColumn("n", F.col("group_size")), "digest", "n", index.rows, "left")
    alone = looked_up.where("not maybe").drop("maybe").withColumn("keep_id", F.lit(None).cast(docs.schema["doc_id"].dataType)).withColumn("group_size", F.lit(None).cast("long"))
    odd = differing(docs, met.where("group_size is not null"), digest)
    if not odd.isEmpty():
        moved = odd.groupBy("digest").agg(F.sum("sub_size").alias("gone"))
        met = met.join(moved, "digest", "left").join(odd.drop("body"), ["digest", "text_sha256"], "left")
        met = met.withColumn("keep_id", F.coalesce("sub_keep", "keep_id")).withColumn("group_size", F.coalesce("sub_size", F.col("group_size") - F.coalesce("gone", F.lit(0)))).select(*alone.columns)
    placed = met.unionByName(alone)
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return placed.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), keep.eqNullSafe(F.col("doc_id")).alias("kept"), "text_sha256")


def differing(docs: DataFrame, copies: DataFrame, digest) -> DataFrame:
    """Groups of rows that share a digest with the row that stays but not its bytes: digest, body, text_sha256, sub_keep, sub_size. copies: rows of hits."""
    some = maybe_in(docs.select("doc_id", "text"), F.col("doc_id"), key_filter(copies, F.col("doc_id")))
    body = some.select("doc_id", F.length(F.coalesce("text", F.lit(""))).alias("n_chars"), normalised(F.col("text")).alias("body"))
    # Bytes meet their row by its id and digest, not by the digest alone, which a third of all rows may share.
    own = copies.select(F.col("doc_id").alias("h_id"), F.col("digest").alias("h_digest"), "keep_id", "group_size").distinct()
    body = body.withColumn("digest", digest(F.col("body")))
    members = stash(body.join(own, F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("digest") == F.col("h_digest"))).drop("h_id", "h_digest"))
    shares = F.expr(f"cast(ceil(group_size / {SALT_ROWS}) as int)")
    stays = members.where("doc_id <=> keep_id").dropDuplicates(["digest"])
    stays = stays.select("digest", F.col("body").alias("kept_body"), F.explode(F.sequence(F.lit(0), shares - 1)).alias("salt"))
    salted = members.withColumn("salt", F.pmod(F.xxhash64("doc_id", "n_chars"), shares).cast("int"))
    odd = salted.join(stays, ["digest", "salt"]).where("body <> kept_body")
    best = F.min(F.struct((-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("none"), F.col("doc_id")))
    odd = odd.groupBy("digest", "body").agg(best.alias("b"), F.count("*").alias("sub_size"))
    return stash(odd.select("digest", "body", F.sha2("body", 256).alias("text_sha256"), F.col("b.doc_id").alias("sub_keep"), "sub_size"))


def distinct(docs: DataFrame) -> DataFrame:
    """docs with one row of each group of equal texts: the one that stays; of rows that repeat its doc_id, one of the longest."""
    no_id = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    kept = exact_dedup(docs.select("doc_id", "text")).where("kept").select(no_id.alias("ed_id"), F.col("text_sha256").alias("ed_sha")).distinct()
    names = docs.columns
    keyed = docs.select(*[F.col(c).alias(f"d{i}") for i, c in enumerate(names)], no_id.alias("ed_id"), F.sha2(normalised(F.col("text")), 256).alias("ed_sha"), F.length("text").alias("ed_n"))
    first = Window.partitionBy("ed_id", "ed_sha").orderBy(F.desc("ed_n"))
    one = keyed.join(kept, ["ed_id", "ed_sha"], "left_semi").withColumn("ed_copy", F.row_number().over(first)).where("ed_copy = 1")
    return one.select(*[F.col(f"d{i}").alias(c) for i, c in enumerate(names)])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS body FROM documents),
k AS (SELECT doc_id, n, sha256(body) AS text_sha256 FROM d)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  first_value(doc_id) OVER w = doc_id AS kept, text_sha256
FROM k WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
"""
