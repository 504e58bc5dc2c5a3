import math
import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ragtide.operators import bm25
from ragtide.operators.topk import topk_per_group


def py_bm25(docs, queries, k1=1.5, b=0.75, eps=0.25):
    """Okapi BM25 written out directly (exhaustive scoring of every document)."""
    toks = {d: re.findall(r"\w+", t.lower()) for d, t in docs.items()}
    n = len(docs)
    avgdl = sum(len(v) for v in toks.values()) / n
    df = {}
    for v in toks.values():
        for w in set(v):
            df[w] = df.get(w, 0) + 1
    idf = {w: math.log(n - c + 0.5) - math.log(c + 0.5) for w, c in df.items()}
    mean = sum(idf.values()) / len(idf)
    idf = {w: (eps * mean if x < 0 else x) for w, x in idf.items()}
    out = {}
    for q, text in queries.items():
        scores = {}
        for d, v in toks.items():
            s = 0.0
            for w in re.findall(r"\w+", (text or "").lower()):
                tf = v.count(w)
                s += idf.get(w, 0.0) * (tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(v) / avgdl)))
            scores[d] = s
        out[q] = scores
    return out


def py_topk(scores, k):
    return [d for d, _ in sorted(scores.items(), key=lambda x: (-round(x[1], 9), x[0]))[:k]]


def run_case(spark, docs, queries, k):
    corpus = spark.createDataFrame(list(docs.items()), "doc_id string, text string")
    qs = spark.createDataFrame(list(queries.items()), "query_id string, text string")
    idx = bm25.build_bm25_index(corpus)
    run = bm25.bm25_topk(idx, qs, k=k).collect()
    got = {}
    for r in sorted(run, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.doc_id, r.score))
    return got


DOCS = {f"d{i:02d}": t for i, t in enumerate([
    "the quick brown fox", "the lazy dog", "quick quick fox jumps", "a dog and a fox", "",
    "lorem ipsum dolor", "the the the", "brown dog brown fox", "fox", "unrelated words here"])}
QUERIES = {"q1": "quick fox", "q2": "dog dog", "q3": "zzzq", "q4": "", "q5": "the brown"}


@pytest.mark.parametrize("k", [1, 3, 10, 20])
def test_bm25_matches_exhaustive_python(spark, k):
    want = py_bm25(DOCS, QUERIES)
    got = run_case(spark, DOCS, QUERIES, k)
    for q in QUERIES:
        assert [d for d, _ in got[q]] == py_topk(want[q], k), q
        for d, s in got[q]:
            assert s == pytest.approx(want[q][d], abs=1e-9)


def test_bm25_tiny_corpus_negative_idf_floor(spark):
    docs = {"a": "x y z", "b": "x y w"}  # mean idf <= 0: hits can score below 0
    queries = {"q": "x x w", "r": "nothing"}
    want = py_bm25(docs, queries)
    got = run_case(spark, docs, queries, 2)
    for q in queries:
        assert [d for d, _ in got[q]] == py_topk(want[q], 2)


def test_topk_equals_sorted_prefix_and_partition_invariant(spark):
    rows = [(q, d, float((q * 7 + d * 13) % 11)) for q in range(5) for d in range(40)]
    df = spark.createDataFrame(rows, "query_id int, doc_id int, score double")
    for parts in (1, 3, 16):
        got = topk_per_group(df.repartition(parts), "query_id", 5).collect()
        for q in range(5):
            mine = [r.doc_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)]
            want = [d for _, d, s in sorted((x for x in rows if x[0] == q), key=lambda x: (-x[2], x[1]))][:5]
            assert mine == want


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_index_build_and_lookup_plans(spark, tmp_dir):
    corpus = spark.createDataFrame(list(DOCS.items()), "doc_id string, text string")
    qs = spark.createDataFrame([("q", "quick fox")], "query_id string, text string")
    # no text is shuffled: counting terms is one stage
    assert "Exchange" not in plan_of(bm25.corpus_postings(corpus))
    idx = bm25.build_bm25_index(corpus, path=tmp_dir + "/idx", block_docs=1)
    # sums by document finish inside a range; only the best k of each are shuffled
    for k in (None, 2):
        scores = plan_of(bm25.bm25_scores(idx, qs, k=k))
        assert not re.findall(r"(?<!Broadcast)Exchange hashpartitioning\(range", scores)
        assert "doc_id" not in "".join(re.findall(r"Exchange hashpartitioning.*", scores))
    top = plan_of(bm25.bm25_topk(idx, qs, k=2, pad=False, prune=False))
    assert len(re.findall(r"(?<!Broadcast)Exchange", top)) == 1 and "WindowGroupLimit" in top
    bounds = re.findall(r"ReadSchema: (.*)", bm25.block_bounds(idx, bm25._weighted_terms(idx, qs, "query_id", "text")[0])
                        ._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode
                                                            .fromString("formatted")))
    assert bounds and not any("hits" in x for x in bounds)
    again = bm25.load_bm25_index(spark, tmp_dir + "/idx")
    assert sorted(map(tuple, bm25.bm25_topk(again, qs, k=4).collect())) == \
        sorted(map(tuple, bm25.bm25_topk(idx, qs, k=4).collect()))
    assert "Exchange hashpartitioning(range" not in plan_of(bm25.bm25_scores(again, qs))


def corpora(spark):
    rng = random.Random(7)
    zipf = [f"w{int(rng.paretovariate(0.7))}" for _ in range(60_000)]
    yield {f"d{i:04d}": " ".join(zipf[i * 30:i * 30 + rng.randrange(5, 60)]) for i in range(600)}
    # equal texts: many ties at the k-th place
    yield {f"d{i:04d}": ["fox den", "fox", "a b c fox", "none here"][i % 4] for i in range(400)}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    yield {f"d{r.doc_id:04d}": r.text[:1000] for r in docs}


@pytest.mark.parametrize("n", range(3))
def test_skipping_blocks_loses_nothing(spark, n):
    docs = list(corpora(spark))[n]
    words = sorted({w for t in docs.values() for w in re.findall(r"\w+", t.lower())})
    rng = random.Random(n)
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 6))) for _ in range(30)]
    texts += [" ".join(t.split()[:6]) for t in list(docs.values())[:20]]
    corpus = spark.createDataFrame(list(docs.items()), "doc_id string, text string")
    qs = spark.createDataFrame([(f"q{i}", t) for i, t in enumerate(texts)], "query_id string, text string")
    idx = bm25.build_bm25_index(corpus, block_docs=4)
    assert idx.mean_idf > 0
    for k in (5,):
        rows = [sorted((r.query_id, r.rank, r.doc_id, round(r.score, 9)) for r in
                       bm25.bm25_topk(idx, qs, k=k, prune=p).collect()) for p in (True, False)]
        assert rows[0] == rows[1]
    m = bm25.skipped_blocks(idx, qs, 1).agg(F.sum("n_blocks").alias("n"), F.sum("n_skipped").alias("s")).first()
    assert 0 < m.s < m.n if n != 1 else m.n


def test_terms_in_slices(spark):
    corpus = spark.createDataFrame(list(DOCS.items()), "doc_id string, text string")
    qs = spark.createDataFrame(list(QUERIES.items()), "query_id string, text string")
    idx = bm25.build_bm25_index(corpus)
    parts = bm25._weighted_terms(idx, qs, "query_id", "text", max_rows=2)
    assert len(parts) > 1
    seen = [{r.query_id for r in p.collect()} for p in parts]
    assert sum(map(len, seen)) == len(set().union(*seen))


def test_layout_follows_the_corpus(spark):
    corpus = spark.createDataFrame([(f"d{i}", "x" * 100) for i in range(1000)], "doc_id string, text string")
    n, ranges, blocks = bm25.layout(corpus, "text", None, range_bytes=1000, block_docs=5)
    assert (n, ranges, blocks) == (1000, 100, 2)


def test_index_of_texts_without_terms(spark):
    corpus = spark.createDataFrame([("a", ""), ("b", None)], "doc_id string, text string")
    qs = spark.createDataFrame([("q", "quick fox")], "query_id string, text string")
    run = bm25.bm25_topk(bm25.build_bm25_index(corpus), qs, k=3).collect()
    assert sorted((r.doc_id, r.score) for r in run) == [("a", 0.0), ("b", 0.0)]


def test_padding_steps_over_many_hits(spark):
    docs = {f"d{i:03d}": "x y" for i in range(120)} | {"e1": "z", "e2": "", "e3": "z"}
    queries = {"q": "x", "r": "z x", "s": "none"}
    corpus = spark.createDataFrame(list(docs.items()), "doc_id string, text string")
    qs = spark.createDataFrame(list(queries.items()), "query_id string, text string")
    idx = bm25.build_bm25_index(corpus)
    idx.mean_idf = min(idx.mean_idf, 0.0)
    scores = bm25.bm25_scores(idx, qs)
    pads = {}
    for r in bm25._padding(idx, qs, 3, "query_id", scores, chunk=7).collect():
        pads.setdefault(r.query_id, []).append(r.doc_id)
    hits = {("q", d) for d in docs if "x" in docs[d]} | {("r", d) for d in docs if docs[d]}
    for q in queries:
        free = sorted(d for d in docs if (q, d) not in hits)[:3]
        assert set(free) <= set(pads.get(q, [])) or not free


def test_no_cached_tables_are_left(spark):
    corpus = spark.createDataFrame(list(DOCS.items()), "doc_id string, text string")
    qs = spark.createDataFrame(list(QUERIES.items()), "query_id string, text string")
    idx = bm25.build_bm25_index(corpus)
    held = lambda: spark.sparkContext._jsc.getPersistentRDDs().size()
    before = held()
    for _ in range(3):
        bm25.bm25_topk(idx, qs, k=2).collect()
    assert held() == before


@pytest.mark.parametrize("max_rows,cells", [(1 << 20, 1 << 20), (3, 16)])
def test_queries_with_the_same_known_terms_are_scored_once(spark, max_rows, cells):
    queries = QUERIES | {"q6": "fox unknown quick", "q7": "quick fox other", "q8": "fox quick quick", "q9": "lorem"}
    corpus = spark.createDataFrame(list(DOCS.items()), "doc_id string, text string")
    qs = spark.createDataFrame(list(queries.items()), "query_id string, text string")
    idx = bm25.build_bm25_index(corpus)
    members, classes = bm25.query_classes(idx, qs)
    assert members.count() == 7 and classes.count() == 5  # q1, q6 and q7 are one class
    want = py_bm25(DOCS, queries)
    run = bm25.classes_back(bm25.classes_topk([(idx, None)], classes, 2, max_rows, cells), members).collect()
    for q, scores in want.items():
        got = [r.doc_id for r in sorted((r for r in run if r.query_id == q), key=lambda r: r.rank)]
        assert got == [d for d in py_topk(scores, 2) if scores[d] > 0]
    # an index row is joined to its term only, not to every query that asks for it
    assert "query_id" not in plan_of(bm25.classes_topk([(idx, None)], classes, 2))


def test_build_moves_each_text_once_and_keeps_every_posting(spark):
    docs = [*DOCS.items(), ("d01", "fox of the same id"), (None, "fox without an id"), (None, None), ("e", "É x² \u00df")]
    corpus = spark.createDataFrame(docs, "doc_id string, text string")
    moved = re.findall(r"Exchange.*", plan_of(bm25._dealt_texts(corpus, 3, 2, "doc_id", "text", None)))
    assert moved and not any("regexp" in x or "term" in x for x in moved)
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    spark.conf.set(batch, 2)
    try:
        idx = bm25.build_bm25_index(corpus, range_bytes=1, block_docs=1)
        want = bm25.corpus_postings(corpus).select("term", "doc_id", "dl", "tf")
        again = bm25.write_postings(want, bm25.scratch_path(spark, "again"), idx.n_ranges, idx.n_blocks)
    finally:
        spark.conf.set(batch, before)
    order = lambda df: sorted(map(str, df.collect()))
    for rows in (idx.postings, again):
        assert order(rows.select("term", F.inline("hits"))) == order(want)
        assert rows.count() == rows.select("range", "term", "block").distinct().count()
    assert order(idx.postings.drop("hits")) == order(again.drop("hits"))


def test_many_members_of_classes_are_not_broadcast(spark):
    members = spark.range(50).selectExpr("concat('q', id) AS query_id", "id % 3 AS class")
    run = spark.range(3).selectExpr("id AS class", "concat('d', id) AS doc_id", "1.0D AS score", "1L AS rank")
    few, many = (bm25.classes_back(run, members, n) for n in (50, 49))
    assert "rightHint=(strategy=broadcast)" in few._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in many._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(few.collect()) == sorted(many.collect()) and few.count() == 50
