"""The pipeline on planted rows, stage by stage, and as run() does it."""

import corpus_pipeline
from tests.llm.conftest import DOCS, prose


def test_stages(spark, tmp_path):
    base, passage = prose(1, 120), prose(2, 60)
    words = base.split()
    rows = [(1, base), (2, base), (2, base), (3, " ".join(words[:60] + ["other"] + words[61:])), (4, "12 34"), (5, None), (6, prose(5, 40) + passage), (7, prose(6, 40) + passage), (8, prose(8, 3000)), (None, prose(9, 30))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS).repartition(3)
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        path = str(tmp_path / name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = docs.collect()
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = lambda n: sorted((r.doc_id is None, r.doc_id or 0) for r in seen[n])
    assert ids("language_id") == sorted((i is None, i or 0) for i, _ in rows if i not in (4, 5))
    assert [i for _, i in ids("exact_dedup")] == [1, 3, 6, 7, 8, 0]
    assert [i for _, i in ids("ngram_jaccard")] == [1, 6, 7, 8, 0]
    text = {r.doc_id: r.text for r in seen["suffix_dedup"]}
    assert text[6] == rows[6][1] and text[7] == prose(6, 40) and all(r.n_chars == len(r.text) for r in seen["suffix_dedup"])
    assert {r.doc_id for r in seen["packing"]} == {1, 6, 7, 8, None}


def test_run(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert set(out.columns) >= {"doc_id", "start", "length", "sequence_id", "offset"} and out.count() > 100


def test_empty(spark, tmp_path):
    docs = spark.createDataFrame([], DOCS)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert docs.count() == 0
