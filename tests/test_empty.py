from ragtide.operators import bm25, dense, fusion, rerank
from ragtide.sources import files as src


def test_empty_inputs(spark, tmp_dir):
    corpus = spark.createDataFrame([("d1", "alpha beta"), ("d2", "beta gamma")], "doc_id string, text string")
    idx = bm25.build_bm25_index(corpus)
    no_q = spark.createDataFrame([], "query_id string, text string")
    assert bm25.bm25_topk(idx, no_q, k=3).count() == 0
    null_q = spark.createDataFrame([("q", None)], "query_id string, text string")
    got = bm25.bm25_topk(idx, null_q, k=3).orderBy("rank").collect()
    assert [r.doc_id for r in got] == ["d1", "d2"] and all(r.score == 0.0 for r in got)
    qv = spark.createDataFrame([("q", [1.0, 0.0])], "query_id string, embedding array<double>")
    no_d = spark.createDataFrame([], "doc_id string, embedding array<double>")
    assert dense.dense_topk(qv, no_d, k=3).count() == 0
    no_qv = spark.createDataFrame([], "query_id string, embedding array<double>")
    dv = spark.createDataFrame([("d1", [1.0, 0.0])], "doc_id string, embedding array<double>")
    assert dense.dense_topk(no_qv, dv, k=3).count() == 0
    empty_run = spark.createDataFrame([], "query_id string, doc_id string, score double")
    assert fusion.hybrid_fuse(empty_run, empty_run).count() == 0
    corpus_t = corpus.selectExpr("doc_id", "'' AS title", "text")
    assert rerank.rerank(empty_run, null_q, corpus_t, k=2).count() == 0
    assert src.scan_jsonl_corpus(spark, tmp_dir + "/nothing-here/*.jsonl").count() == 0
