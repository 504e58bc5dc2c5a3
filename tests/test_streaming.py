import os

from pyspark.sql import functions as F

from ragtide.operators import bm25
from ragtide.streaming.questions import answer_stream, retrieve_batch


def test_question_files_stream_matches_batch(spark, tmp_dir):
    d = tmp_dir[5:] if tmp_dir.startswith("file:") else tmp_dir
    qdir = os.path.join(d, "in")
    os.makedirs(qdir)
    with open(os.path.join(qdir, "a.csv"), "w") as f:
        f.write('ID,Question\nQ1,"quick fox"\nQ2,"lazy\ndog"\n')
    corpus = spark.createDataFrame([("d1", "the quick brown fox"), ("d2", "the lazy dog"), ("d3", "nothing")],
                                   "doc_id string, text string")
    idx = bm25.build_bm25_index(corpus)
    out = os.path.join(d, "out")
    q = answer_stream(spark, qdir, out, retrieve_batch(idx, k=2), checkpoint=os.path.join(d, "ck"))
    q.awaitTermination(120)
    got = {(r.query_id, r.rank): r.doc_id for r in spark.read.parquet(out).collect()}
    assert got[("Q1", 1)] == "d1" and got[("Q2", 1)] == "d2"


def test_question_stream_hybrid_mode(spark, tmp_dir):
    from ragtide.operators import encode
    d = tmp_dir[5:] if tmp_dir.startswith("file:") else tmp_dir
    qdir = os.path.join(d, "in")
    os.makedirs(qdir)
    with open(os.path.join(qdir, "a.csv"), "w") as f:
        f.write('ID,Question\nQ1,"quick fox"\n')
    corpus = spark.createDataFrame([("d1", "the quick brown fox"), ("d2", "the lazy dog"), ("d3", "nothing")],
                                   "doc_id string, text string")
    idx = bm25.build_bm25_index(corpus)
    vecs = encode.encode_corpus(corpus, title_col=None)
    out = os.path.join(d, "out")
    q = answer_stream(spark, qdir, out, retrieve_batch(idx, k=3, dense_corpus=vecs, final_k=2),
                      checkpoint=os.path.join(d, "ck"))
    q.awaitTermination(120)
    got = sorted((r.rank, r.doc_id) for r in spark.read.parquet(out).collect())
    assert got[0] == (1, "d1") and len(got) == 2
