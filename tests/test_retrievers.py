"""Retrievers behind one interface, relevance cells, and freed intermediates."""

import os
import random

import pytest
from pyspark.sql import functions as F

from ragtide.operators import bm25, dense_index, encode, ireval, prep, retrievers, search
from ragtide.session import ensure_checkpoint_dir, temporary, written
from ragtide.streaming.questions import answer_stream, retrieve_batch


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [("d1", "the quick brown fox"), ("d2", "the lazy dog sleeps"), ("d3", "nothing to see"), ("d4", "quick dog")]
    return spark.createDataFrame([(i, "", t) for i, t in rows], "doc_id string, title string, text string")


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame([("q1", "quick fox"), ("q2", "lazy dog")], "query_id string, text string")


def rows(run):
    return sorted((r.query_id, r["rank"], r.doc_id, round(r.score, 9)) for r in run.collect())


def test_search_by_parts_equals_the_wired_one(spark, corpus, queries):
    index, vectors = bm25.build_bm25_index(corpus, "doc_id", "text", "title"), encode.encode_corpus(corpus)
    want = rows(search.search(queries, corpus, index, vectors, dense_topk=3, sparse_topk=3, final_topk=3))
    for v in (vectors, dense_index.build_dense_index(vectors)):
        parts = [retrievers.Part(retrievers.Dense(v), 0.7, 3), retrievers.Part(retrievers.Sparse(index), 0.3, 3)]
        assert rows(retrievers.search(queries, parts, 3)) == want


def test_a_users_retriever_takes_part(spark, corpus, queries):
    def by_length(asked, k):  # short documents first, more rows than asked for
        return asked.select("query_id").join(corpus.select("doc_id", (-F.length("text")).cast("double").alias("score")))

    class Fixed:
        def retrieve(self, asked, k):
            return asked.select("query_id", F.lit("d3").alias("doc_id"), F.lit(1.0).alias("score"))

    own = retrievers.Scored(by_length)
    assert [r[2] for r in rows(retrievers.search(queries, [retrievers.Part(own, 1.0, 2)]))] == ["d4", "d3"] * 2
    run = rows(retrievers.search(queries, [retrievers.Part(own, 0.1, 2), retrievers.Part(Fixed(), 0.9)], 1))
    assert [r[2] for r in run] == ["d3", "d3"]
    seen = []

    def last(candidates, asked, texts, k):
        seen.append(candidates.count())
        return candidates.withColumn("rank", F.lit(1)).where("doc_id = 'd4'")

    assert len(rows(retrievers.search(queries, [retrievers.Part(own, 1.0, 2)], 1, corpus, last))) == 2 and seen == [4]
    with pytest.raises(ValueError):
        retrievers.search(queries, [])
    with pytest.raises(ValueError):
        retrievers.search(queries, [retrievers.Part(own)], reranker=last)
    with pytest.raises(TypeError):
        retrievers.search(queries, [retrievers.Part("no retriever")])
    with pytest.raises(ValueError):
        retrievers.Scored(lambda q, k: q).retrieve(queries, 2)


def test_relevance_cells_of_a_large_query(spark):
    hot = spark.range(200_000).selectExpr("'hot' AS query_id", "concat('d', id % 150000) AS corpus_id")
    few = spark.createDataFrame([("a", "d1"), ("a", "d1"), ("a", "d0"), (None, "x")], "query_id string, corpus_id string")
    chunks = written(prep.relevant_doc_chunks(hot.unionByName(few), chunk_rows=1000), "cells")
    got = chunks.where("query_id = 'hot'").orderBy("chunk").collect()
    ids = [i for r in got for i in r.corpus_ids]
    assert [r.chunk for r in got] == list(range(150)) and all(len(r.corpus_ids) == 1000 for r in got)
    assert ids == sorted(f"d{i}" for i in range(150_000))
    assert [tuple(r) for r in chunks.where("query_id = 'a'").collect()] == [("a", 0, ["d0", "d1"])]
    assert chunks.where("query_id IS NULL").count() == 1
    assert prep.relevant_doc_chunks(few.limit(0)).count() == 0

    pick = random.Random(5)
    run = [(q, f"d{pick.randrange(200_000)}", n) for q in ("hot", "a", "z") for n in range(1, 40)] + [("a", "d1", 40)]
    run = spark.createDataFrame(run, "query_id string, doc_id string, rank int").dropDuplicates(["query_id", "doc_id"])
    a, n = ireval.judged_from_chunks(run, chunks.where("query_id IS NOT NULL"))
    b, m = ireval.judged_from_qrels(run, hot.unionByName(few).where("query_id IS NOT NULL").withColumnRenamed("corpus_id", "doc_id"))
    cols = ["query_id", "doc_id", "rank", "rel"]
    assert sorted(a.select(cols).collect()) == sorted(b.select(cols).collect())
    assert sorted(map(tuple, n.collect())) == sorted(map(tuple, m.collect()))


def folders(spark):
    base = ensure_checkpoint_dir(spark)
    return {f for f in os.listdir(base[5:] if base.startswith("file:") else base) if not f.startswith("ragtide-test")}


def test_temporary_tables_are_removed(spark):
    before = folders(spark)
    with temporary(spark):
        kept = written(written(spark.range(5), "gone"), "kept", keep=True)
        with pytest.raises(RuntimeError), temporary(spark):
            written(spark.range(5), "inner")
            raise RuntimeError
        assert len(folders(spark) - before) == 2
    assert [f[:12] for f in folders(spark) - before] == ["ragtide-kept"] and kept.count() == 5
    outside = written(spark.range(2), "outside")
    assert outside.count() == 2


def test_a_stream_leaves_no_tables(spark, tmp_dir, corpus):
    d = tmp_dir[5:] if tmp_dir.startswith("file:") else tmp_dir
    os.makedirs(d + "/in")
    batch = retrieve_batch(bm25.build_bm25_index(corpus, "doc_id", "text", "title"), k=2)
    left = []
    for n in range(2):
        with open(f"{d}/in/{n}.csv", "w") as f:
            f.write(f"ID,Question\nQ{n},quick fox\n")
        answer_stream(spark, d + "/in", d + "/out", batch, checkpoint=d + "/ck").awaitTermination(120)
        left.append(len(folders(spark)))
    assert left[0] == left[1] and spark.read.parquet(d + "/out").select("query_id").distinct().count() == 2
