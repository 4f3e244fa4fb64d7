"""Document fingerprints by one-permutation MinHash, in DataFrame operations only.

Each five-word shingle is hashed once; the hash's low bits choose one of BINS bins and the rest compete for its minimum.
An empty bin takes the value of a filled one by optimal densification: the filled bin of least hash(empty, filled), the
first that a random probe order of the empty bin's own would reach, the same for all documents. Four low-order bits of
each bin are kept, one hexadecimal digit a bin. Digits agree by chance once in sixteen, which likeness() takes off.

Defined cases: a null text is empty; a text without words has the empty fingerprint, likeness 1 to another such and 0 to
any other; under five words the whole sequence is one shingle; rows that repeat a doc_id come in order of a text hash, and
rows that repeat id and text have the same result; a lone document is its own next one; a null doc_id comes below all others, with -2^63, the least id; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stash, table, words

#: Bins, words of a shingle; a bin's minimum has VALUE_BITS bits, all set: empty.
BINS, SHINGLE, VALUE_BITS = 128, 5, 40
EMPTY = (1 << VALUE_BITS) - 1
#: Where a null doc_id comes in the order, so that it joins; a flag tells it from that id.
NO_ID = -(1 << 63)


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """df with the fingerprint of column text as a string of BINS hexadecimal digits. One projection for each step: each array is made once."""
    others = ", ".join(f"get(fp_w, i + {k})" for k in range(1, SHINGLE))
    mine = f"shiftleft(fp_s & {BINS - 1}, {VALUE_BITS})"
    df = df.withColumn("fp_w", words(F.lower(text)))
    df = df.withColumn("fp_w", F.transform("fp_w", lambda w: F.xxhash64(w)))
    df = df.withColumn("fp_h", F.expr(f"transform(slice(fp_w, 1, greatest(size(fp_w) - {SHINGLE - 1}, least(size(fp_w), 1))), (x, i) -> xxhash64(x, {others}))"))
    df = df.withColumn("fp_h", F.expr(f"sort_array(concat(transform(fp_h, fp_s -> {mine} | least(shiftrightunsigned(fp_s, 7) & {EMPTY}, {EMPTY - 1})), transform(sequence(0, {BINS - 1}), b -> shiftleft(cast(b as bigint), {VALUE_BITS}) | {EMPTY})))"))
    df = df.withColumn("fp_d", F.expr(f"filter(fp_h, (x, i) -> i = 0 or shiftright(x, {VALUE_BITS}) <> shiftright(get(fp_h, i - 1), {VALUE_BITS}))"))
    df = df.withColumn("fp_f", F.expr(f"transform(filter(fp_d, x -> (x & {EMPTY}) <> {EMPTY}), x -> int(shiftright(x, {VALUE_BITS})))"))
    filled = "array_min(transform(fp_f, c -> shiftleft(cast(hash(i, c) & 2147483647 as bigint), 8) | c)) & 255"
    digit = f"lower(hex((if((x & {EMPTY}) <> {EMPTY}, x, get(fp_d, cast({filled} as int)))) & 15))"
    df = df.withColumn(name, F.expr(f"if(size(fp_w) = 0, '', array_join(transform(fp_d, (x, i) -> {digit}), ''))"))
    return df.drop("fp_w", "fp_h", "fp_d", "fp_f")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two fingerprints' shingle sets, 0 to 1, free of the bias of chance agreement."""
    agree = F.size(F.filter(F.sequence(F.lit(1), F.lit(BINS)), lambda i: F.substr(a, i, F.lit(1)) == F.substr(b, i, F.lit(1))))
    value = F.greatest(F.lit(0.0), (agree / F.lit(float(BINS)) - 1 / 16) / (1 - 1 / 16))
    return F.when((a == "") | (b == ""), (a == b).cast("double")).otherwise(value)


def next_documents(base: DataFrame) -> DataFrame:
    """base (doc_id, rid, none, n_chars, fp, one row for each pair of doc_id and rid) with next_fp, of the document next in descending doc_id, and with
    to_id, to_rid and take: the document whose next one this is, and the code points of this one that it takes.

    Ids are dealt by range and windowed within each range; only the first and last row of each range, as many as there are
    partitions, meet in one task.
    """
    spark = base.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = stash(base.repartitionByRange(parts, "doc_id", "rid").withColumn("pid", F.spark_partition_id()))
    row = F.struct("doc_id", "rid", "n_chars", "fp")
    inner = Window.partitionBy("pid").orderBy("doc_id", "rid")
    ends = ranged.groupBy("pid").agg(F.min(row).alias("low"), F.max(row).alias("high"))
    over = Window.orderBy("pid")
    every = Window.partitionBy()
    ends = ends.select("pid", F.coalesce(F.lag("high").over(over), F.max("high").over(every)).alias("below"), F.coalesce(F.lead("low").over(over), F.min("low").over(every)).alias("above"))
    near = ranged.withColumn("down", F.lag(row).over(inner)).withColumn("up", F.lead(row).over(inner))
    near = near.join(F.broadcast(ends), "pid").withColumn("down", F.coalesce("down", "below")).withColumn("up", F.coalesce("up", "above"))
    return near.select("doc_id", "rid", "none", "n_chars", "fp", F.col("down.fp").alias("next_fp"), F.col("up.doc_id").alias("to_id"), F.col("up.rid").alias("to_rid"), F.expr("cast(up.n_chars div 2 as int)").alias("take"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for each row of docs (doc_id, text)."""
    docs = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), F.col("doc_id").isNull().alias("none"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.select("doc_id", F.when(F.col("none"), F.xxhash64("text", F.lit(1))).otherwise(F.xxhash64("text")).alias("rid"), "none", "text")
    base = with_fingerprint(docs.withColumn("n_chars", F.length("text")), "text", "fp").select("doc_id", "rid", "none", "n_chars", "fp")
    links = stash(next_documents(stash(base).dropDuplicates(["doc_id", "rid"])))
    # Both uses of whole take the same columns of docs, so that one exchange of the texts serves both.
    whole = docs.drop("none").join(links, ["doc_id", "rid"])
    heads = whole.withColumn("copy", F.row_number().over(Window.partitionBy("doc_id", "rid").orderBy("take"))).where("copy = 1").select(F.col("to_id").alias("doc_id"), F.col("to_rid").alias("rid"), F.expr("left(text, take)").alias("head"))
    edited = F.expr("concat(left(text, n_chars - n_chars div 2), head)")
    out = whole.join(heads, ["doc_id", "rid"]).select("doc_id", "none", "n_chars", "fp", "next_fp", edited.alias("edited"))
    out = with_fingerprint(out.withColumn("edited_sha256", F.sha2("edited", 256)), "edited", "edited_fingerprint")
    return out.select(
        F.when(~F.col("none"), F.col("doc_id")).alias("doc_id"), F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256", F.col("fp").alias("fingerprint"), "edited_fingerprint",
        likeness(F.col("fp"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
