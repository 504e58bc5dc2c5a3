"""Prompt tables, answer tables, submission and generation telemetry.

The language-model call itself is outside the engine: prompts go out as a
table, responses come back as a table keyed by ID (never by position or by
question text).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.answers import extract_answer, is_multiple_choice, question_options, question_stem
from ..functions.text import _c
from .topk import broadcast_if_small

# Prompt templates of the reference.
MC_HEAD = ("당신은 금융보안 전문가입니다.\n"
           "아래 질문에 대해 적절한 **정답 선택지 번호만 출력**하세요.\n\n")
FREE_HEAD = ("당신은 금융보안 전문가입니다.\n"
             "아래 주관식 질문에 대해 정확하고 간략한 설명을 작성하세요.\n"
             "콜론, 번호, 불릿으로 시작하는 것은 금지이며, 반드시 줄글으로 작성하세요.\n\n")
SELECT_HEAD = ("당신은 금융 분야의 전문가입니다. 아래에 주어진 질의(Query)와 문서(Corpus)를 보고, "
               "각 문서가 질의에 답하는 데 관련이 있는지를 판단하세요.\n"
               "        정답은 반드시 **'T' 또는 'F' {n}개 문자로만** 연속해서 작성하세요. (추가 설명 없이)\n"
               "        'T'는 관련 있음, 'F'는 관련 없음 을 의미합니다. "
               "전부 다 F인 경우 가장 관련성이 높은 문서에 T를 부여하세요.\n"
               "        질의(Query): {q}\n")
DOC_HEADER = "\n###문서_{i}\n{doc}\n"
#: Run rows, and their bytes, that go to the texts by broadcast; they follow the questions.
RUN_ROWS, RUN_BYTES = 200_000, 16 << 20


def ordered_texts(run: DataFrame, corpus: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``(query_id, texts)``: document texts in rank order per query (a run is
    top-k, so each group holds at most k rows). Many run rows are shuffled: the driver
    would hold them."""
    docs = corpus.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_t"))
    x = docs.join(broadcast_if_small(run.select("query_id", "doc_id", "rank"), RUN_ROWS, RUN_BYTES), "doc_id")
    g = x.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "_t"))).alias("_l"))
    return g.select("query_id", F.transform("_l", lambda s: s["_t"]).alias("texts"))


def rag_block(texts) -> Column:
    """Context block: texts joined by newlines, then a newline."""
    return F.concat(F.array_join(F.coalesce(_c(texts), F.array().cast("array<string>")), "\n"), F.lit("\n"))


def make_prompt(question, texts) -> Column:
    """Multiple-choice or free-text prompt for one question."""
    q = _c(question)
    rag = rag_block(texts)
    mc = F.concat(F.lit(MC_HEAD), F.lit("질문: "), question_stem(q), F.lit("\n"),
                  F.lit("참고 문서: "), rag, F.lit("선택지:\n"),
                  F.array_join(question_options(q), "\n"), F.lit("\n\n답변:"))
    free = F.concat(F.lit(FREE_HEAD), F.lit("질문: "), F.coalesce(q, F.lit("")), F.lit("\n\n"),
                    F.lit("참고 문서: "), rag, F.lit("답변:"))
    return F.when(is_multiple_choice(q), mc).otherwise(free)


def prompt_table(questions: DataFrame, contexts: DataFrame, id_col: str = "ID",
                 q_col: str = "question") -> DataFrame:
    """``(ID, is_mc, prompt)``; ``contexts(query_id, texts)`` keyed by ID. Neither side is
    broadcast, whatever its files seem to hold."""
    x = questions.hint("merge").join(contexts.withColumnRenamed("query_id", id_col), id_col, "left")
    return x.select(id_col, is_multiple_choice(F.col(q_col)).alias("is_mc"),
                    make_prompt(F.col(q_col), F.col("texts")).alias("prompt"))


def selection_prompt(query, texts) -> Column:
    """Relevance-selection prompt with documents numbered from 1."""
    t = F.coalesce(_c(texts), F.array().cast("array<string>"))
    head = F.concat(
        F.lit(SELECT_HEAD.split("{n}")[0]), F.size(t).cast("string"),
        F.lit(SELECT_HEAD.split("{n}")[1].split("{q}")[0]), F.coalesce(_c(query), F.lit("")),
        F.lit(SELECT_HEAD.split("{q}")[1]))
    pre, mid = DOC_HEADER.split("{i}")[0], DOC_HEADER.split("{i}")[1].split("{doc}")[0]
    post = DOC_HEADER.split("{doc}")[1]
    docs = F.transform(t, lambda d, i: F.concat(F.lit(pre), (i + 1).cast("string"), F.lit(mid), d, F.lit(post)))
    return F.concat(head, F.array_join(docs, ""))


def answer_table(questions: DataFrame, responses: DataFrame, skip_free_text: bool = True,
                 id_col: str = "ID", q_col: str = "question", gen_col: str = "generated") -> DataFrame:
    """``(ID, Answer)`` from generated responses joined by ID. With
    ``skip_free_text`` a free-text question answers "0" without a response."""
    x = questions.select(id_col, q_col).join(responses.select(id_col, gen_col), id_col, "left")
    ans = extract_answer(F.col(gen_col), F.col(q_col))
    if skip_free_text:
        ans = F.when(~is_multiple_choice(F.col(q_col)), F.lit("0")).otherwise(ans)
    return x.select(id_col, ans.alias("Answer"))


def submission_table(template: DataFrame, answers: DataFrame, id_col: str = "ID",
                     ans_col: str = "Answer") -> DataFrame:
    """Template rows with ``Answer`` taken from ``answers`` by ID (missing -> null)."""
    keep = [c for c in template.columns if c != ans_col]
    a = answers.select(id_col, F.col(ans_col).alias("_a"))
    return template.select(*keep).join(a, id_col, "left").withColumnRenamed("_a", ans_col)


def gen_throughput(log: DataFrame, group: str | None = None, unit: float = 1.0) -> DataFrame:
    """Tokens per second where both ``eval_count`` and ``eval_duration`` are
    present and non-zero: ``count / max(duration / unit, 1e-9)``."""
    ok = (F.col("eval_count").isNotNull() & (F.col("eval_count") != 0)
          & F.col("eval_duration").isNotNull() & (F.col("eval_duration") != 0))
    tokps = F.when(ok, F.col("eval_count") / F.greatest(F.col("eval_duration") / F.lit(unit), F.lit(1e-9)))
    x = log.withColumn("tokps", tokps)
    aggs = [F.count(F.lit(1)).alias("n"), F.count("tokps").alias("n_measured"),
            F.avg("tokps").alias("avg_tokps"), F.min("tokps").alias("min_tokps"),
            F.max("tokps").alias("max_tokps"), F.sum(F.when(ok, F.col("eval_count"))).alias("tokens")]
    return (x.groupBy(group) if group else x).agg(*aggs)
