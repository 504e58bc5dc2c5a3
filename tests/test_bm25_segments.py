import random

import pytest
from pyspark.sql import functions as F

from ragtide.operators import bm25
from ragtide.operators import bm25_segments as seg

WORDS = [f"w{i}" for i in range(40)]
SCHEMA = "doc_id string, text string"


def texts(ids, seed):
    rng = random.Random(seed)
    return {i: " ".join(rng.choice(WORDS[:rng.randrange(2, 40)]) for _ in range(rng.randrange(0, 25))) for i in ids}


def rows(df):
    return sorted((r.query_id, r["rank"], r.doc_id, round(r.score, 9)) for r in df.collect())


def fresh(spark, docs, queries, k):
    return rows(bm25.bm25_topk(bm25.build_bm25_index(spark.createDataFrame(list(docs.items()), SCHEMA)), queries, k=k))


def test_changes_equal_a_fresh_index(spark, tmp_dir):
    queries = spark.createDataFrame([("a", "w1 w2 w3"), ("b", "w0 w0 w30"), ("c", "unknown"), ("d", "")],
                                    "query_id string, text string")
    docs = texts([f"d{i:02d}" for i in range(40)], 1)
    index = seg.upsert(seg.create_index(spark, tmp_dir), spark.createDataFrame(list(docs.items()), SCHEMA))
    assert rows(seg.segments_topk(index, queries, 7)) == fresh(spark, docs, queries, 7)

    changed = texts([f"d{i:02d}" for i in range(30, 60)], 2)  # ten new versions, twenty new documents
    docs |= changed
    index = seg.upsert(index, spark.createDataFrame(list(changed.items()), SCHEMA))
    assert [(s.n_docs, s.n_dead) for s in index.segments] == [(30, 10), (30, 0)]
    assert rows(seg.segments_topk(index, queries, 7)) == fresh(spark, docs, queries, 7)

    out = ["d00", "d05", "d33", "d59", "d59", "never"]
    index = seg.delete(index, spark.createDataFrame([(i,) for i in out] + [(None,)], "doc_id string"))
    for i in set(out):
        docs.pop(i, None)
    before = rows(seg.segments_topk(index, queries, 70))  # more than there are: padding
    assert before == fresh(spark, docs, queries, 70)
    again = seg.delete(index, spark.createDataFrame([("d00",), ("never",)], "doc_id string"))
    assert again.version == index.version

    back = texts(["d00"], 3)  # a deleted id comes back
    docs |= back
    old, index = index, seg.upsert(index, spark.createDataFrame(list(back.items()), SCHEMA))
    want = fresh(spark, docs, queries, 9)
    assert rows(seg.segments_topk(index, queries, 9)) == want
    part = seg.merge(index, [index.segments[0].seq, index.segments[2].seq])
    assert len(part.segments) == 2 and rows(seg.segments_topk(part, queries, 9)) == want
    whole = seg.merge(part, [s.seq for s in part.segments])
    assert len(whole.segments) == 1 and not whole.gone and whole.segments[0].n_docs == len(docs)
    assert rows(seg.segments_topk(whole, queries, 9)) == want
    assert rows(seg.segments_topk(old, queries, 70)) == before  # readers keep their version

    vocab = {r.term: (r.df, r.ctf) for r in whole.read(whole.vocab).collect()}
    built = bm25.build_bm25_index(spark.createDataFrame(list(docs.items()), SCHEMA))
    assert vocab == {r.term: (r.df, r.ctf) for r in built.vocab.collect()}
    assert (whole.n_docs, whole.tokens) == (built.n_docs, sum(c for _, c in vocab.values()))

    assert seg.vacuum(spark, tmp_dir) > 0
    reopened = seg.open_index(spark, tmp_dir)
    assert reopened.version == whole.version and rows(seg.segments_topk(reopened, queries, 9)) == want


def test_empty_changes_conflicts_and_merge_policy(spark, tmp_dir):
    queries = spark.createDataFrame([("a", "x")], "query_id string, text string")
    index = seg.create_index(spark, tmp_dir)
    assert seg.segments_topk(index, queries, 3).count() == 0
    none = spark.createDataFrame([], SCHEMA)
    assert seg.upsert(index, none).version == 0 and seg.delete(index, none).version == 0
    assert seg.merge(index).version == 0
    with pytest.raises(ValueError):
        seg.upsert(index, spark.createDataFrame([("a", "x"), ("a", "y")], SCHEMA))
    one = seg.upsert(index, spark.createDataFrame([("a", "x y"), (None, "x")], SCHEMA))
    assert one.n_docs == 1
    with pytest.raises(Exception):  # another writer made version 1 already
        seg.upsert(index, spark.createDataFrame([("b", "x")], SCHEMA))
    assert seg.open_index(spark, tmp_dir).n_docs == 1
    gone = seg.delete(one, spark.createDataFrame([("a",)], "doc_id string"))
    assert gone.n_docs == 0 and gone.read(gone.vocab).count() == 0
    assert seg.segments_topk(gone, queries, 3).count() == 0
    emptied = seg.merge(gone)  # a segment with more dead than living documents is due
    assert emptied.segments == () and seg.segments_topk(emptied, queries, 3).count() == 0

    small = [seg.Segment(i, "", 10 + i, 0, 0, 1, 1) for i in range(8)]
    sized = seg.SegmentedIndex(spark, "", 9, None, 0, 0, 0.0, 1.5, 0.75, 0.25, None,
                               (seg.Segment(20, "", 5000, 0, 0, 1, 1), *small), ())
    assert seg.due(sized) == list(range(8))
