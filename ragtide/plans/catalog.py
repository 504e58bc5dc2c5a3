"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Every query reads the given tables (or inputs Spark derives from them) whole;
column names and rounding match the SQL in ``oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import answers as ans
from ..functions import law as lawf
from ..functions import text

from ..operators import (bm25, bm25_segments, dense, dense_index, encode, fusion, generate, grading, ireval, law, parent, prep, qa,
                         rerank, retrievers, search)
from ..operators.topk import broadcast_if_small, materialize, round_out, topk_per_group
from ..session import scratch_path
from ..sources import files as src
from . import tables as T


_BUILT: dict = {}


def _version(spark, sf_dir, tables):
    """Files of the input tables with their sizes and times."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for t in tables:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{t}.parquet")
        fs = path.getFileSystem(conf)
        out += [(t, st.getPath().getName(), st.getLen(), st.getModificationTime()) for st in fs.listStatus(path)]
    return tuple(sorted(out))


def _once(spark, sf_dir, name, build, tables=("documents",)):
    """Build an index / vector table once per application and state of the input
    tables, then reuse it (the reference rebuilt its index on every search call)."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    version = _version(spark, sf_dir, tables)
    if key not in _BUILT or _BUILT[key][0] != version:
        _BUILT[key] = version, build()
    return _BUILT[key][1]


def _doc_index(spark, sf_dir):
    return _once(spark, sf_dir, "doc-bm25", lambda: bm25.build_bm25_index(
        T.doc_corpus(spark, sf_dir), "doc_id", "text", "title"))


def _doc_vectors(spark, sf_dir):
    return _once(spark, sf_dir, "doc-vec", lambda: materialize(
        encode.encode_corpus(T.doc_corpus(spark, sf_dir))))


def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    idx = _doc_index(spark, sf_dir)
    run = bm25.bm25_topk(idx, T.bench_queries(spark, sf_dir), k=10)
    return run.select("query_id", "doc_id", round_out("score"), "rank")


def bm25_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    idx = _doc_index(spark, sf_dir)
    return idx.vocab.select("term", "df", "ctf", round_out("idf"))


def _changed_index(spark, sf_dir):
    """All documents without a title; new versions with their source as title where the
    labels call the document good; those that they call bad taken out."""
    docs, labels = T.doc_corpus(spark, sf_dir), T.table(spark, sf_dir, "labels")
    good = labels.where("quality = 1").select("doc_id").distinct()
    index = bm25_segments.upsert(bm25_segments.create_index(spark), docs.select("doc_id", "text"))
    index = bm25_segments.upsert(index, docs.join(good, "doc_id", "left_semi"), title_col="title")
    return bm25_segments.delete(index, labels.where("quality = 0"))


def bm25_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 10 of a segmented index after additions, new versions and deletions."""
    index = _once(spark, sf_dir, "segments", lambda: _changed_index(spark, sf_dir), ("documents", "labels"))
    run = bm25_segments.segments_topk(index, T.bench_queries(spark, sf_dir), k=10)
    return run.select("query_id", "doc_id", round_out("score"), "rank")


def bm25_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``bm25_changes`` after its segments were merged into one."""
    index = _once(spark, sf_dir, "segments", lambda: _changed_index(spark, sf_dir), ("documents", "labels"))
    merged = _once(spark, sf_dir, "merged", lambda: bm25_segments.merge(index, [s.seq for s in index.segments]),
                   ("documents", "labels"))
    run = bm25_segments.segments_topk(merged, T.bench_queries(spark, sf_dir), k=10)
    return run.select("query_id", "doc_id", round_out("score"), "rank")


def _emb(spark, sf_dir):
    return T.table(spark, sf_dir, "embeddings")


def _emb_run(spark, sf_dir, score_function):
    e = _emb(spark, sf_dir)
    q = e.select(F.col("vec_id").alias("query_id"), "embedding")
    d = e.select(F.col("vec_id").alias("doc_id"), "embedding")
    return dense.dense_topk(q, d, k=10, score_function=score_function, exclude_self=True)


def dense_topk_cos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _emb_run(spark, sf_dir, "cos_sim").select("query_id", "doc_id", round_out("score"), "rank")


def dense_topk_dot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _emb_run(spark, sf_dir, "dot").select("query_id", "doc_id", round_out("score"), "rank")


def _pruned_run(spark, sf_dir, score_function):
    e = _emb(spark, sf_dir)
    index = _once(spark, sf_dir, "emb-index", lambda: dense_index.build_dense_index(
        e.withColumnRenamed("vec_id", "doc_id")), ("embeddings",))
    q = e.select(F.col("vec_id").alias("query_id"), "embedding")
    run = dense_index.dense_topk_pruned(index, q, k=10, score_function=score_function)
    return run.select("query_id", "doc_id", round_out("score"), "rank")


def dense_pruned_cos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dense_topk_cos`` over the index that leaves vectors out by angle."""
    return _pruned_run(spark, sf_dir, "cos_sim")


def dense_pruned_dot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dense_topk_dot`` over the index that leaves vectors out by angle."""
    return _pruned_run(spark, sf_dir, "dot")


def hash_embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    vecs = encode.encode_corpus(T.doc_corpus(spark, sf_dir))
    x = vecs.select("doc_id", F.posexplode("embedding").alias("bucket", "weight"))
    return x.filter(F.col("weight") > 0).select("doc_id", F.col("bucket").cast("bigint"), "weight")


def hash_embed_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``hash_embed`` with each partition sorted by text length before encoding."""
    vecs = encode.encode_corpus(T.doc_corpus(spark, sf_dir), sort_by_length=True)
    x = vecs.select("doc_id", F.posexplode("embedding").alias("bucket", "weight"))
    return x.filter(F.col("weight") > 0).select("doc_id", F.col("bucket").cast("bigint"), "weight")


def _hash_run(spark, sf_dir, k=10):
    corpus = _doc_vectors(spark, sf_dir)
    qv = encode.encode_queries(T.bench_queries(spark, sf_dir))
    return dense.dense_topk(qv, corpus, k=k, score_function="cos_sim", exclude_self=False)


def dense_topk_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hash_run(spark, sf_dir).select("query_id", "doc_id", round_out("score"), "rank")


def _sparse_run(spark, sf_dir, k=10):
    return bm25.bm25_topk(_doc_index(spark, sf_dir), T.bench_queries(spark, sf_dir), k=k)


def softmax_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    sm = fusion.softmax_normalize(_sparse_run(spark, sf_dir))
    return sm.select("query_id", "doc_id", round_out("score"))


def _fused(spark, sf_dir):
    return fusion.hybrid_fuse(_hash_run(spark, sf_dir, 10), _sparse_run(spark, sf_dir, 10), alpha=0.7)


def hybrid_fuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fused(spark, sf_dir).select("query_id", "doc_id", round_out("score"))


def hybrid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = search.search(T.bench_queries(spark, sf_dir), T.doc_corpus(spark, sf_dir), _doc_index(spark, sf_dir),
                        _doc_vectors(spark, sf_dir), dense_topk=10, sparse_topk=10, final_topk=5)
    return run.select("query_id", "doc_id", round_out("score"), "rank")


def rerank_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    cand = _sparse_run(spark, sf_dir, 100)
    run = rerank.rerank(cand, T.bench_queries(spark, sf_dir), T.doc_corpus(spark, sf_dir), k=10)
    return run.select("query_id", "doc_id", round_out("score"), "rank")


def hybrid_rerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: BM25 + dense -> softmax fusion -> pair rerank -> top 5."""
    run = search.search(T.bench_queries(spark, sf_dir), T.doc_corpus(spark, sf_dir), _doc_index(spark, sf_dir),
                        _doc_vectors(spark, sf_dir), dense_topk=10, sparse_topk=10, final_topk=5,
                        reranker=rerank.rerank)
    return run.select("query_id", "doc_id", round_out("score"), "rank")


# ---------------------------------------------------------------- text & law

def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = T.table(spark, sf_dir, "documents")
    toks = text.tokenize(F.col("text"))
    return d.select("doc_id", F.size(toks).cast("bigint").alias("n_tokens"),
                    F.array_join(toks, " ").alias("tokens"))


def digits_to_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = T.table(spark, sf_dir, "part")
    s = F.concat(F.lit("제"), F.col("p_size").cast("string"), F.lit("조 "), F.col("p_name"))
    return p.select(F.col("p_partkey").alias("id"), lawf.digits_to_int(s).alias("article"),
                    lawf.digits_to_int(F.col("p_type")).alias("none_found"))


def _extract(spark, sf_dir, mode):
    q = T.law_questions(spark, sf_dir)
    return law.extract_laws(q, mode)


def extract_law_loose(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extract(spark, sf_dir, "loose")


def extract_law_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extract(spark, sf_dir, "strict")


def law_corpus_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = law.normalize_law_corpus(T.law_corpus(spark, sf_dir))
    return c.select("doc_id", "law_name", "law_name_norm", "law_no_str", "law_no_int")


def law_match_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = law.law_match(T.law_questions(spark, sf_dir), T.law_corpus(spark, sf_dir), mode="strict",
                      columns=["doc_id"])
    return m.select("query_id", "doc_id")


def law_match_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = law.law_match(T.law_questions(spark, sf_dir), T.law_corpus(spark, sf_dir), mode="strict",
                      normalized=True, columns=["doc_id"])
    return m.select("query_id", "doc_id")


def law_match_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = law.law_match_summary(T.law_questions(spark, sf_dir), T.law_corpus(spark, sf_dir), mode="strict",
                              order="doc_id", n=5)
    return s.select("query_id", "n_matches",
                    F.array_join(F.transform("first_docs", lambda x: x.cast("string")), ",").alias("first_docs"))


def law_match_loose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loose names and articles, counted per question."""
    s = law.law_match_summary(T.law_loose_questions(spark, sf_dir), T.law_corpus(spark, sf_dir), mode="loose",
                              order="doc_id", n=5)
    return s.select("query_id", "n_matches",
                    F.array_join(F.transform("first_docs", lambda x: x.cast("string")), ",").alias("first_docs"))


def _law_run(spark, sf_dir, k=20, mode="strict"):
    corpus = T.law_corpus(spark, sf_dir)
    idx = _once(spark, sf_dir, "law-bm25", lambda: bm25.build_bm25_index(corpus, "doc_id", "text", "title"))
    qs = T.law_bench_queries(spark, sf_dir)
    run = bm25.bm25_topk(idx, qs, k=k)
    return law.prioritize_law(run, qs, corpus, mode=mode, qtext="text")


def prioritize_law_loose(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _law_run(spark, sf_dir, mode="loose").select("query_id", "doc_id", round_out("score"), "priority", "rank")


def prioritize_law(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _law_run(spark, sf_dir).select("query_id", "doc_id", round_out("score"), "priority", "rank")


def context_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = qa.ordered_texts(_law_run(spark, sf_dir, 5), T.law_corpus(spark, sf_dir))
    return texts.select("query_id", F.size("texts").cast("bigint").alias("n_docs"),
                        F.array_join("texts", "\n").alias("context"))


# ---------------------------------------------------------------- QA

def is_multiple_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = T.qa_questions(spark, sf_dir)
    return q.select("ID", ans.option_count(F.col("question")).cast("bigint").alias("n_options"),
                    ans.is_multiple_choice(F.col("question")).alias("is_mc"))


def split_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = T.qa_questions(spark, sf_dir)
    return q.select("ID", ans.question_stem(F.col("question")).alias("stem"),
                    F.array_join(ans.question_options(F.col("question")), "\n").alias("options"))


def extract_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = T.qa_questions(spark, sf_dir)
    return q.select("ID", ans.extract_answer(F.col("generated"), F.col("question")).alias("answer"))


def parse_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = T.verdicts(spark, sf_dir)
    def j(c):
        return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return v.select("id", j(ans.parse_verdict(F.col("verdict"), "tokens")).alias("by_tokens"),
                    j(ans.parse_verdict(F.col("verdict"), "chars")).alias("by_chars"),
                    j(ans.parse_verdict(F.col("verdict"), "chars", 2)).alias("by_chars_2"))


def parse_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, sub = T.key_and_submission(spark, sf_dir)
    p = ans.parse_answer(F.col("Answer"))
    return sub.select("ID", "ord", p["kind"].alias("kind"), F.array_join(p["vals"], ",").alias("vals"))


def _qa_contexts(spark, sf_dir, k=3):
    qs = T.qa_questions(spark, sf_dir).select(F.col("ID").alias("query_id"), F.col("question").alias("text"))
    run = bm25.bm25_topk(_doc_index(spark, sf_dir), qs, k=k)
    return qa.ordered_texts(run, T.doc_corpus(spark, sf_dir))


def prompt_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qa.prompt_table(T.qa_questions(spark, sf_dir), _qa_contexts(spark, sf_dir))


def selection_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = _qa_contexts(spark, sf_dir)
    q = T.qa_questions(spark, sf_dir).hint("merge").join(ctx.withColumnRenamed("query_id", "ID"), "ID")
    return q.select("ID", qa.selection_prompt(F.col("question"), F.col("texts")).alias("prompt"))


def generated_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts put to the generation hook (a local stand-in client), answers taken
    from what it returns."""
    prompts = prompt_table(spark, sf_dir)
    found = generate.generate(prompts, generate.LocalClient)
    answers = qa.answer_table(T.qa_questions(spark, sf_dir), found, skip_free_text=False)
    return answers.join(found.select("ID", "eval_count"), "ID")


def answer_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = T.qa_questions(spark, sf_dir)
    responses = q.filter(F.col("generated") != "").select("ID", "generated")
    return qa.answer_table(q, responses, skip_free_text=True)


def submission_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = T.qa_questions(spark, sf_dir)
    template = q.select("ID", F.lit(0).alias("Answer"))
    answers = qa.answer_table(q, q.filter(F.col("generated") != "").select("ID", "generated"),
                              skip_free_text=False).filter(F.col("Answer") != "미응답")
    return qa.submission_table(template, answers)


def gen_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = qa.gen_throughput(T.gen_log(spark, sf_dir), group="event_type")
    return g.select("event_type", "n", "n_measured", round_out("avg_tokps"), round_out("min_tokps"),
                    round_out("max_tokps"), "tokens")


# ---------------------------------------------------------------- grading

def dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, _ = T.key_and_submission(spark, sf_dir)
    return grading.dedupe_first(key, "ID", "ord")


def grade_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, sub = T.key_and_submission(spark, sf_dir)
    g = grading.grade_answers(key, sub)
    return g.select("ID", "answer_key", "answer_sub", "kind_key", "kind_sub",
                    F.array_join("vals_key", ",").alias("vals_key"),
                    F.array_join("vals_sub", ",").alias("vals_sub"), "correct")


def grade_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, sub = T.key_and_submission(spark, sf_dir)
    return grading.grade_summary(grading.grade_answers(key, sub))


# ---------------------------------------------------------------- parent / child

def pick_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = T.child_rows(spark, sf_dir)
    return c.select("law_key", "start", text.pick_text("prefixed_text", "text").alias("picked"))


def child_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = T.child_rows(spark, sf_dir)
    compat = F.when(F.col("start") == 0, F.lit(-1)).otherwise(F.col("start"))
    return c.select("law_key", "start", "end", text.child_id("law_key", "start", "end").alias("doc_id"),
                    text.child_id("law_key", compat, "end").alias("doc_id_compat"))


def _children(spark, sf_dir):
    return _once(spark, sf_dir, "children", lambda: materialize(parent.child_corpus(T.child_rows(spark, sf_dir))))


def _expansions(spark, sf_dir):
    def build():
        e = T.expanded_rows(spark, sf_dir).withColumn("ord", F.col("law_key").cast("bigint") * 1000 + F.col("start"))
        a = T.article_rows(spark, sf_dir).withColumn("ord", F.col("law_key").cast("bigint"))
        return parent.expansion_table(e), parent.article_table(a)
    return _once(spark, sf_dir, "expansions", build)


def child_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parent.child_corpus(T.child_rows(spark, sf_dir))


def child_corpus_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parent.child_corpus(T.child_rows(spark, sf_dir), compat=True)


def parent_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    exp, art = _expansions(spark, sf_dir)
    x = parent.with_parent_context(parent.child_corpus(T.child_rows(spark, sf_dir)), exp, art)
    return x.select("doc_id", "expanded_text", "parent_head")


def _child_index(spark, sf_dir):
    children = _children(spark, sf_dir)
    idx = _once(spark, sf_dir, "child-bm25", lambda: bm25.build_bm25_index(children, "doc_id", "text", "title"))
    return children, idx, _once(spark, sf_dir, "child-vec", lambda: materialize(encode.encode_corpus(children)))


def rerank_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    children, idx, vectors = _child_index(spark, sf_dir)
    exp, art = _expansions(spark, sf_dir)
    run = search.search(T.bench_queries(spark, sf_dir), children, idx, vectors, dense_topk=10, sparse_topk=10,
                        final_topk=5, reranker=lambda cand, qs, corpus, k: parent.rerank_parent(
                            cand, qs, corpus, exp, art, k=k))
    return run.select("query_id", "doc_id", round_out("score"), "rank")


def _packed(spark, sf_dir):
    children, idx, vectors = _child_index(spark, sf_dir)
    fused = search.hybrid_candidates(T.bench_queries(spark, sf_dir), idx, vectors, dense_topk=10, sparse_topk=10)
    exp, art = _expansions(spark, sf_dir)
    return parent.context_pack(fused, children, exp, art, top_n=5, preview_chars=900)


def context_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _packed(spark, sf_dir)
    return p.select("query_id", "rank", "doc_id", round_out("score"), "law_key", "law_name", "law_no",
                    "title", "child_text", "expanded_text", "parent_head")


def context_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = parent.context_render(_packed(spark, sf_dir))
    return r.select("query_id", "n_hits", F.array_join("docs", "\n").alias("rendered"))


# ---------------------------------------------------------------- training prep

def compose_question(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.final_question(T.exam_rows(spark, sf_dir)).select("no", "final_question")


def extract_doc_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = T.exam_rows(spark, sf_dir)
    return e.select("no", F.array_join(prep.extract_doc_ids("rag_data"), ",").alias("doc_ids"))


def _exploded(spark, sf_dir):
    return prep.explode_doc_ids(T.exam_rows(spark, sf_dir))


def explode_doc_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exploded(spark, sf_dir).select("no", "final_question", "doc_ids")


def relation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.relation_pairs(_exploded(spark, sf_dir), T.statutes(spark, sf_dir))


def qrels_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _exploded(spark, sf_dir)
    st = T.statutes(spark, sf_dir)
    return prep.relevance_grid(x, st, prep.relation_pairs(x, st))


def _std(spark, sf_dir):
    x = materialize(_exploded(spark, sf_dir).select("no", "final_question", "doc_ids"))
    st = T.statutes(spark, sf_dir)
    queries = x.select("no", "final_question").distinct()
    q_std = prep.std_queries(queries)
    c_std = prep.std_corpus(st, "id", "contents", None)
    qrels = prep.std_qrels(prep.relation_pairs(x, st))
    return q_std, c_std, qrels, prep.all_data(qrels, q_std, c_std)


def std_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _std(spark, sf_dir)[2]


def all_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _std(spark, sf_dir)[3]


def prep_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of the prepared tables, one row per table."""
    x = _exploded(spark, sf_dir)
    st = T.statutes(spark, sf_dir)
    grid = prep.relevance_grid(x, st, prep.relation_pairs(x, st))
    nq = x.select("no", "final_question").distinct().agg(F.count(F.lit(1)).alias("n_rows"))
    nc = st.agg(F.count(F.lit(1)).alias("n_rows"))
    nr = grid.agg(F.sum("n_cells").cast("bigint").alias("n_rows"))
    return (nq.select(F.lit("queries").alias("table"), "n_rows")
            .unionByName(nc.select(F.lit("corpus").alias("table"), "n_rows"))
            .unionByName(nr.select(F.lit("relations").alias("table"), "n_rows")))


def _split(spark, sf_dir):
    q_std, c_std, qrels, rows = _std(spark, sf_dir)
    return q_std, c_std, prep.train_val_split(qrels, rows, 0.2, 42)


def train_val_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, (_, _, train_rel, val_rel) = _split(spark, sf_dir)
    return train_rel.withColumn("split", F.lit("train")).unionByName(val_rel.withColumn("split", F.lit("val")))


def train_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, (train_data, _, _, _) = _split(spark, sf_dir)
    return prep.train_pairs(train_data)


def eval_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, c_std, (_, _, _, val_rel) = _split(spark, sf_dir)
    return prep.eval_corpus(c_std, val_rel, random_sample=30, seed=42)


def eval_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    q_std, _, _ = _split(spark, sf_dir)
    return prep.eval_queries(q_std)


def relevant_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, (_, _, _, val_rel) = _split(spark, sf_dir)
    r = prep.relevant_docs(val_rel)
    return r.select("query_id", F.array_join("corpus_ids", ",").alias("corpus_ids"))


def relevant_doc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relevance sets of the validation side in numbered cells of at most 4 ids."""
    _, _, (_, _, _, val_rel) = _split(spark, sf_dir)
    r = prep.relevant_doc_chunks(val_rel, chunk_rows=4)
    return r.select("query_id", "chunk", F.array_join("corpus_ids", ",").alias("corpus_ids"))


def ir_metrics_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ir_metrics_eval`` judged by relevance cells, through the retriever interface."""
    q_std, c_std, (_, _, _, val_rel) = _split(spark, sf_dir)
    corpus = prep.eval_corpus(c_std, val_rel, random_sample=30, seed=42)
    chunks = materialize(prep.relevant_doc_chunks(val_rel))
    asked = prep.eval_queries(q_std).join(chunks.select("query_id").distinct(), "query_id", "left_semi")
    index = dense_index.build_dense_index(encode.encode_corpus(corpus, "corpus_id", "text", None))
    run = retrievers.Dense(index).retrieve(asked, ireval.MAP_K)
    judged, n_rel = ireval.judged_from_chunks(run, chunks)
    return ireval.ir_metrics(judged, n_rel).select("metric", round_out("value"))


def retriever_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``hybrid_search`` by retrievers that share one interface."""
    parts = [retrievers.Part(retrievers.Dense(_doc_vectors(spark, sf_dir)), fusion.ALPHA),
             retrievers.Part(retrievers.Sparse(_doc_index(spark, sf_dir)), 1 - fusion.ALPHA)]
    run = retrievers.search(T.bench_queries(spark, sf_dir), parts, final_topk=5)
    return run.select("query_id", "doc_id", round_out("score"), "rank")


def nodup_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, (train_data, _, _, _) = _split(spark, sf_dir)
    b = prep.nodup_batches(prep.train_pairs(train_data), batch_size=16)
    return b.select("batch_id", "query_id", "corpus_id")


def nodup_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, (train_data, _, _, _) = _split(spark, sf_dir)
    pairs = materialize(prep.train_pairs(train_data))
    return prep.nodup_check(pairs, materialize(prep.nodup_batches(pairs, batch_size=16)), batch_size=16)


# ---------------------------------------------------------------- IR evaluation

def ir_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _emb(spark, sf_dir)
    q = e.select(F.col("vec_id").alias("query_id"), "embedding")
    d = e.select(F.col("vec_id").alias("doc_id"), "embedding")
    run = dense.dense_topk(q, d, k=ireval.MAP_K, score_function="cos_sim", exclude_self=True)
    judged, n_rel = ireval.judged_from_labels(run, e, "vec_id", "label", exclude_self=True)
    m = ireval.ir_metrics(judged, n_rel)
    return m.select("metric", round_out("value"))


def ir_metrics_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BM25 run over documents judged by containment of the benchmark passage."""
    docs = T.doc_corpus(spark, sf_dir)
    qs = T.bench_queries(spark, sf_dir)
    run = bm25.bm25_topk(_doc_index(spark, sf_dir), qs, k=ireval.MAP_K)
    qrels = ireval.containment_qrels(qs, docs, _doc_index(spark, sf_dir))
    judged, n_rel = ireval.judged_from_qrels(run, qrels)
    return ireval.ir_metrics(judged, n_rel).select("metric", round_out("value"))


def ir_metrics_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default encoder evaluated on the prepared inputs: evaluation corpus,
    evaluation queries and the validation side's relevant documents."""
    q_std, c_std, (_, _, _, val_rel) = _split(spark, sf_dir)
    corpus = prep.eval_corpus(c_std, val_rel, random_sample=30, seed=42)
    vectors = encode.encode_corpus(corpus, "corpus_id", "text", None)
    qrels = prep.relevant_docs(val_rel).select("query_id", F.explode("corpus_ids").alias("doc_id"))
    asked = prep.eval_queries(q_std).join(qrels.select("query_id").distinct(), "query_id", "left_semi")
    run = dense.dense_topk(encode.encode_queries(asked), vectors, k=ireval.MAP_K, exclude_self=False)
    judged, n_rel = ireval.judged_from_qrels(run, qrels)
    return ireval.ir_metrics(judged, n_rel).select("metric", round_out("value"))


# ---------------------------------------------------------------- sources (file round trips)

def _write_lines(df: DataFrame, key: str, name: str) -> str:
    """Write ``value`` lines in ``key`` order to the shared scratch folder."""
    path = scratch_path(df.sparkSession, name)
    df.orderBy(key).select("value").write.text(path)
    return path


def scan_jsonl_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law corpus written as JSON Lines (with blank lines), scanned back."""
    c = T.law_corpus(spark, sf_dir)
    js = c.select((F.col("doc_id") * 2).alias("k"),
                  F.to_json(F.struct("law_name", "law_no",
                                     F.element_at(F.split("title", " "), 2).alias("title"), "text")).alias("value"))
    blanks = c.filter(F.col("doc_id") % 10 == 9).select((F.col("doc_id") * 2 + 1).alias("k"), F.lit("  ").alias("value"))
    path = _write_lines(js.unionByName(blanks), "k", "corpus-jsonl")
    return src.scan_jsonl_corpus(spark, path).drop("ord")


def scan_child_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Child rows written as JSON Lines with malformed and blank lines, scanned
    back and built into the child corpus."""
    c = T.child_rows(spark, sf_dir)
    js = c.select((F.col("ord") * 3).alias("k"),
                  F.to_json(F.struct("law_key", "start", "end", "title", "prefixed_text", "text",
                                     "law_name", "law_no")).alias("value"))
    junk = c.filter(F.col("start") == 1).select((F.col("ord") * 3 + 1).alias("k"),
                                               F.concat(F.lit('{"law_key": '), F.col("text")).alias("value"))
    blank = c.filter(F.col("start") == 2).select((F.col("ord") * 3 + 2).alias("k"), F.lit("").alias("value"))
    path = _write_lines(js.unionByName(junk).unionByName(blank), "k", "child-jsonl")
    return parent.child_corpus(src.scan_child_chunks(spark, path + "/*.txt"))


def scan_child_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Child chunks whose text field has a name of the caller's own."""
    c = T.child_rows(spark, sf_dir)
    js = c.select(F.col("ord").alias("k"), F.to_json(F.struct(
        "law_key", "start", "end", "title", F.col("prefixed_text").alias("body"), "text", "law_name", "law_no")).alias("value"))
    fields = ("body", "text")
    rows = src.scan_child_chunks(spark, _write_lines(js, "k", "child-body"), text_fields=fields)
    return parent.child_corpus(rows, text_fields=fields)


def scan_expanded(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = T.expanded_rows(spark, sf_dir, gaps=False).withColumn("k", F.col("law_key").cast("bigint") * 1000 + F.col("start"))
    path = _write_lines(e.select("k", F.to_json(F.struct("law_key", "start", "end", "prefixed_text", "text"))
                                 .alias("value")), "k", "expanded-jsonl")
    return parent.expansion_table(src.scan_expanded(spark, path))


def scan_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = T.article_rows(spark, sf_dir, gaps=False).withColumn("k", F.col("law_key").cast("bigint"))
    path = _write_lines(a.select("k", F.to_json(F.struct("law_key", "head")).alias("value")), "k", "articles-jsonl")
    return parent.article_table(src.scan_articles(spark, path))


def scan_questions_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = T.qa_questions(spark, sf_dir).select("ID", F.col("question").alias("Question"))
    path = scratch_path(spark, "questions-csv")
    q.write.option("header", True).option("escape", '"').csv(path)
    return src.scan_questions_csv(spark, path).withColumnRenamed("Question", "question")


def scan_submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "submission-csv")
    rows = T.qa_questions(spark, sf_dir).select("ID", F.substring("ID", 6, 20).cast("bigint").alias("ord"))
    src.write_submission(submission_table(spark, sf_dir).join(rows, "ID"), path, order="ord")
    return src.scan_submission(spark, path)


def scan_queries_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark written as JSON Lines with id / qid / no id, text / query
    fields and malformed lines, scanned back."""
    b = T.table(spark, sf_dir, "benchmark")
    m3 = F.col("item_id") % 3
    rec = (F.when(m3 == 0, F.to_json(F.struct(F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("id"),
                                              F.col("text").alias("text"))))
           .when(m3 == 1, F.to_json(F.struct(F.concat(F.lit("c"), F.col("item_id").cast("string")).alias("qid"),
                                             F.col("text").alias("query"))))
           .otherwise(F.to_json(F.struct(F.col("text").alias("text")))))
    js = b.select((F.col("item_id") * 2).alias("k"), rec.alias("value"))
    junk = b.filter(F.col("item_id") % 7 == 3).select((F.col("item_id") * 2 + 1).alias("k"), F.lit("{oops").alias("value"))
    path = _write_lines(js.unionByName(junk), "k", "queries-jsonl")
    return src.scan_queries_any(spark, path + "/*.txt", fmt="jsonl")


def _write_groups(rows: DataFrame, value, name: str, group_rows: int = 10_000) -> str:
    """One JSON document of about ``group_rows`` rows in each file of a folder."""
    path = scratch_path(rows.sparkSession, name)
    n = max(1, -(-rows.count() // group_rows))
    group = F.pmod(F.xxhash64(*rows.columns), F.lit(n)).alias("group")
    rows.groupBy(group).agg(value.alias("value")).write.partitionBy("group").text(path)
    return path


def scan_queries_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark written as JSON objects ``{id: text}``, one in each file, whose
    number follows the rows; scanned back by member."""
    b = T.table(spark, sf_dir, "benchmark").select(F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("id"), "text")
    path = _write_groups(b, F.to_json(F.map_from_entries(F.collect_list(F.struct("id", "text")))), "queries-object")
    return src.scan_queries_any(spark, path, fmt="json")


def scan_queries_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark written as JSON lists of records, one in each file, whose number
    follows the rows; scanned back by member."""
    b = T.table(spark, sf_dir, "benchmark").select(F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("qid"),
                                                   F.col("text").alias("query"))
    path = _write_groups(b, F.to_json(F.collect_list(F.struct("qid", "query"))), "queries-list")
    return src.scan_queries_any(spark, path, fmt="json")


def scan_rag_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exam records written as JSON into three folders, read back as one
    dataset with a nested schema, doc ids extracted."""
    e = T.exam_rows(spark, sf_dir)
    base = scratch_path(spark, "rag-json")
    for i in range(3):
        e.filter(F.col("no") % 3 == i).write.json(f"{base}/part{i}")
    schema = e.schema
    r = src.scan_rag_json(spark, [f"{base}/part{i}/*.json" for i in range(3)], schema)
    return r.select("no", F.array_join(prep.extract_doc_ids("rag_data"), ",").alias("doc_ids"))


# ---------------------------------------------------------------- ranking helpers & templates

def run_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-query top-k of the (unpadded) BM25 hit scores."""
    scores = bm25.bm25_scores(_doc_index(spark, sf_dir), T.bench_queries(spark, sf_dir))
    top = topk_per_group(scores, "query_id", 5)
    return top.select("query_id", "doc_id", round_out("score"), "rank")


def dedupe_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, sub = T.key_and_submission(spark, sf_dir)
    return grading.dedupe_last(sub, "ID", "ord")


def format_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = T.table(spark, sf_dir, "documents")
    return d.select("doc_id", text.format_query(F.col("text")).alias("as_query"),
                    text.format_doc(F.col("source"), F.col("text")).alias("as_doc"))


def queries() -> dict:
    return {name: fn for name, fn in globals().items()
            if callable(fn) and getattr(fn, "__module__", None) == __name__
            and not name.startswith("_") and name != "queries"}
