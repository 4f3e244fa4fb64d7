"""The corpus pipeline: language, exact dedup, near-duplicate join, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each result as Parquet below
spark.checkpoint.dir and rereads it as the next stage's docs. All but the last return the columns of docs.

Defined cases: rows that share a doc_id are kept or dropped together by language and near-duplicate stages, since their
results carry the doc_id; of equal texts one row stays, also where the doc_id repeats; a null doc_id is an id of its own; a
text that only repeats others stays as a row with an empty text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import exact_dedup, jaccard, language, packing, suffix_dedup
from tallyframe.llm.common import keep_rows, scratch, table

#: Languages that stay (None: all that the labels of docs teach) and least score of a prediction.
LANGUAGES, LEAST_SCORE = None, language.LEAST
#: SQL can't express the language models, the removal of byte spans or the tokenizer.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs in one of LANGUAGES that language identification is sure enough of; without a letter, or unsure, they go."""
    return language.recognised(docs, LANGUAGES, LEAST_SCORE)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    return exact_dedup.distinct(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates, the one of smallest doc_id."""
    return keep_rows(docs, jaccard.join(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without passages that start earlier."""
    return suffix_dedup.cut(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences; see packing.SCHEMA."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language_id", identify_language), ("exact_dedup", drop_copies), ("ngram_jaccard", drop_near_copies), ("suffix_dedup", cut_repeats), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{scratch(spark)}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
