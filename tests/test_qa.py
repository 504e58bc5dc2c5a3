import re

from pyspark.sql import functions as F

from ragtide.operators import bm25, qa
from ragtide.operators.topk import broadcast_if_small


def test_prompt_formats(spark):
    df = spark.createDataFrame([("A", "본문 질문\n1 가나\n2 다라", ["d1", "d2"]), ("B", "서술하시오", ["x"])],
                               "ID string, question string, texts array<string>")
    got = {r.ID: r.p for r in df.select("ID", qa.make_prompt(F.col("question"), F.col("texts")).alias("p")).collect()}
    assert got["A"] == (qa.MC_HEAD + "질문: 본문 질문\n참고 문서: d1\nd2\n선택지:\n1 가나\n2 다라\n\n답변:")
    assert got["B"] == (qa.FREE_HEAD + "질문: 서술하시오\n\n참고 문서: x\n답변:")
    assert qa.MC_HEAD.startswith("당신은 금융보안 전문가입니다.\n")


def test_selection_prompt(spark):
    df = spark.createDataFrame([("질의", ["문서A", "문서B"])], "q string, texts array<string>")
    p = df.select(qa.selection_prompt(F.col("q"), F.col("texts")).alias("p")).first().p
    head = qa.SELECT_HEAD.format(n=2, q="질의")
    assert p == head + "\n###문서_1\n문서A\n" + "\n###문서_2\n문서B\n"


def test_answer_submission_and_throughput(spark):
    qs = spark.createDataFrame([("T1", "질문\n1 a\n2 b"), ("T2", "서술"), ("T3", "질문\n1 a\n2 b")],
                               "ID string, question string")
    resp = spark.createDataFrame([("T1", "답변: 2"), ("T2", "답변: 설명")], "ID string, generated string")
    a = {r.ID: r.Answer for r in qa.answer_table(qs, resp).collect()}
    assert a == {"T1": "2", "T2": "0", "T3": "미응답"}
    b = {r.ID: r.Answer for r in qa.answer_table(qs, resp, skip_free_text=False).collect()}
    assert b["T2"] == "설명"
    template = spark.createDataFrame([("T1", "x"), ("T4", "y")], "ID string, Answer string")
    sub = {r.ID: r.Answer for r in qa.submission_table(template, qa.answer_table(qs, resp)).collect()}
    assert sub == {"T1": "2", "T4": None}
    log = spark.createDataFrame([(1, 10, 2.0), (2, 0, 1.0), (3, 5, 0.0), (4, None, 1.0)],
                                "query_id int, eval_count int, eval_duration double")
    t = qa.gen_throughput(log).first()
    assert (t.n, t.n_measured, t.avg_tokps, t.tokens) == (4, 1, 5.0, 10)


def joins(df):
    return set(re.findall(r"\w+Join", df._jdf.queryExecution().executedPlan().toString()))


def test_question_sized_frames_are_not_broadcast(spark, monkeypatch):
    """Files of repeated values are small, so that an estimate would broadcast them."""
    many = spark.range(3000).selectExpr("concat('q', id) AS query_id", "id % 3 AS doc_id", "1L AS rank")
    corpus = spark.range(3).selectExpr("id AS doc_id", "concat('t', id) AS text")
    assert joins(corpus.join(broadcast_if_small(many, 100), "doc_id")) == {"SortMergeJoin"}
    assert joins(corpus.join(broadcast_if_small(many), "doc_id")) == {"BroadcastHashJoin"}
    monkeypatch.setattr(qa, "RUN_ROWS", 100)
    texts = qa.ordered_texts(many, corpus)
    assert joins(texts) == {"SortMergeJoin"}
    prompts = qa.prompt_table(many.selectExpr("query_id AS ID", "query_id AS question"), texts)
    assert joins(prompts) == {"SortMergeJoin"} and prompts.where("prompt LIKE '%t_\n%'").count() == 3000


def test_terms_and_members_of_questions_are_not_broadcast(spark, monkeypatch):
    corpus = spark.createDataFrame([(1, "a b"), (2, "b c"), (3, "d")], "doc_id bigint, text string")
    index = bm25.build_bm25_index(corpus)
    seen, keep = [], bm25.materialize
    monkeypatch.setattr(bm25, "materialize", lambda df: (seen.append(joins(df)), keep(df))[1])
    members, _ = bm25.query_classes(index, corpus.withColumnRenamed("doc_id", "query_id"))
    assert members.count() == 3 and set().union(*seen) == {"SortMergeJoin"}
