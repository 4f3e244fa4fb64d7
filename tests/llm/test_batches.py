"""Batches for Python workers: their bound is set, a lower one stays, and results don't depend on it."""

import pytest

from tallyframe.llm import arrow, jaccard, suffix_dedup

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def bound(spark):
    before = spark.conf.get(KEY)
    yield lambda x: spark.conf.set(KEY, x)
    spark.conf.set(KEY, before)


def test_bound(spark, bound):
    for was, then in (("64MB", arrow.BATCH), ("10KB", "10KB")):
        bound(was)
        arrow.in_small_batches(spark.range(1))
        assert spark.conf.get(KEY) == str(then)


def test_results_in_tiny_batches(spark, bound):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").coalesce(1)
    found = []
    for size in (str(arrow.BATCH), "2KB"):
        bound(size)
        found.append((sorted(suffix_dedup.report(docs).collect()), sorted(jaccard.join(docs).collect())))
    assert found[0] == found[1]
