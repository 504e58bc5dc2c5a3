"""Loading the given tables and the derived inputs the registered queries use.

Each derived input is defined twice with the same meaning: here as a Spark
DataFrame and in ``oracle.py`` as DuckDB SQL over the same parquet views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_parallel

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Law names and question endings used to build Korean questions.
LAW_NAMES = ("개인정보보호법", "전자금융거래법", "신용정보법")
NO_LAW_WORD = "안내"
ENDING_PROCESS = "처리 방법은?"
ENDING_DUTY = "의무는?"
CORPUS_LAW_NAMES = ("개인정보보호법", "전자금융거래법", "신용정보법", "정보통신망법")


def doc_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as a retrieval corpus: title = source."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.col("source").alias("title"), "text")


def bench_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "benchmark")
    return b.select(F.col("item_id").alias("query_id"), "text")


def law_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``law_fixture``: one Korean question per part row."""
    p = table(spark, sf_dir, "part")
    m4 = F.col("p_partkey") % 4
    name = (F.when(m4 == 0, LAW_NAMES[0]).when(m4 == 1, LAW_NAMES[1])
            .when(m4 == 2, LAW_NAMES[2]).otherwise(NO_LAW_WORD))
    ending = F.when(F.col("p_partkey") % 3 == 0, ENDING_PROCESS).otherwise(ENDING_DUTY)
    q = F.concat(F.lit("다음 중 "), name, F.lit(" 제"), F.col("p_size").cast("string"),
                 F.lit("조에 따른 "), ending)
    return p.select(F.col("p_partkey").alias("query_id"), q.alias("question"))


def law_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents carrying law columns: name from doc_id, article 1..50."""
    d = table(spark, sf_dir, "documents")
    m4 = F.col("doc_id") % 4
    name = (F.when(m4 == 0, CORPUS_LAW_NAMES[0]).when(m4 == 1, CORPUS_LAW_NAMES[1])
            .when(m4 == 2, CORPUS_LAW_NAMES[2]).otherwise(CORPUS_LAW_NAMES[3]))
    no = (F.col("doc_id") % 50 + 1).cast("string")
    return d.select("doc_id", F.concat(name, F.lit(" "), F.col("source")).alias("title"),
                    "text", name.alias("law_name"), no.alias("law_no"))


def law_loose_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions that open with a law name; the article has spaces or no prefix
    (loose forms), and every third asks for none."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    name = F.element_at(F.array(*[F.lit(n) for n in CORPUS_LAW_NAMES]), (k % 4 + 1).cast("int"))
    size = F.col("p_size").cast("string")
    article = (F.when(k % 3 == 0, "").when(k % 3 == 1, F.concat(F.lit(" 제 "), size, F.lit(" 조")))
               .otherwise(F.concat(F.lit(" "), size, F.lit("조"))))
    return p.select(k.alias("query_id"), F.concat(name, article, F.lit(" 설명")).alias("question"))


def law_bench_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages followed by a law reference built from the item id."""
    b = table(spark, sf_dir, "benchmark")
    m4 = F.col("item_id") % 4
    name = (F.when(m4 == 0, CORPUS_LAW_NAMES[0]).when(m4 == 1, CORPUS_LAW_NAMES[1])
            .when(m4 == 2, CORPUS_LAW_NAMES[2]).otherwise(NO_LAW_WORD))
    q = F.concat(F.col("text"), F.lit(" "), name, F.lit(" 제"),
                 (F.col("item_id") % 50 + 1).cast("string"), F.lit("조"))
    return b.select(F.col("item_id").alias("query_id"), q.alias("text"))


def qa_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``qa_fixture``: multiple-choice (4 of 5) and free-text questions with a
    generated response per question."""
    p = table(spark, sf_dir, "part")
    nl = F.lit("\n")
    q = F.when(F.col("p_partkey") % 5 != 0,
               F.concat(F.col("p_name"), nl, F.lit("1 "), F.col("p_brand"), nl, F.lit("2 "),
                        F.col("p_type"), nl, F.lit("3 none"))).otherwise(F.col("p_name"))
    m6 = F.col("p_partkey") % 6
    gen = (F.when(m6 == 0, "답변: 3").when(m6 == 1, "정답은 2번").when(m6 == 2, "")
           .when(m6 == 3, "설명 답변: 0 3").when(m6 == 4, "abc").otherwise("답변:12"))
    return p.select(F.concat(F.lit("TEST_"), F.col("p_partkey").cast("string")).alias("ID"),
                    q.alias("question"), gen.alias("generated"))


def key_and_submission(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``key_sub``: an answer key and a submission with every grading case.

    Both carry ``ord`` (their row order); every 10th order is listed twice.
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    dup = F.when(F.col("o_orderkey") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = o.select("o_orderkey", F.explode(dup).alias("copy"))
    ident = F.concat(F.lit("ID_"), F.col("o_orderkey").cast("string"))
    ordv = (F.col("o_orderkey") * 2 + F.col("copy")).cast("bigint")
    key_val = (F.col("o_orderkey") % 5 + 1).cast("string")
    key_ans = F.when(F.col("copy") == 1, F.lit("4")).otherwise(key_val)
    key = rows.select(ident.alias("ID"), key_ans.alias("Answer"), ordv.alias("ord"))
    m9 = F.col("o_orderkey") % 9
    sub_ans = (F.when(m9 == 0, key_val)
               .when(m9 == 1, ((F.col("o_orderkey") + 1) % 5 + 1).cast("string"))
               .when(m9 == 2, F.lit("1,3")).when(m9 == 3, F.lit(" 3 , 1 "))
               .when(m9 == 4, F.lit("3,3")).when(m9 == 5, F.lit("3.0"))
               .when(m9 == 6, F.lit("정답은 3번입니다")).when(m9 == 7, F.lit("")))
    sub = (rows.filter(m9 != 8)
           .select(ident.alias("ID"), F.when(F.col("copy") == 1, F.lit("2")).otherwise(sub_ans).alias("Answer"),
                   ordv.alias("ord")))
    return key, sub


def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    m4 = F.col("p_partkey") % 4
    v = (F.when(m4 == 0, "T F T").when(m4 == 1, "TFT").when(m4 == 2, " t f ").otherwise(""))
    return p.select(F.col("p_partkey").alias("id"), v.alias("verdict"))


def gen_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("query_id"), "event_type",
                    (F.col("event_id") % 200).alias("eval_count"),
                    F.col("value").alias("eval_duration"))


def child_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``child``: every line of every document is a child chunk."""
    d = table(spark, sf_dir, "documents")
    x = d.select("doc_id", "source", "lang", F.posexplode(F.split(F.col("text"), "\n", -1)).alias("i", "line"))
    prefixed = F.when(F.col("i") % 2 == 0, F.concat(F.col("source"), F.lit(" "), F.col("line"))).otherwise(F.lit(""))
    return x.select(F.col("doc_id").cast("string").alias("law_key"),
                    F.col("i").cast("int").alias("start"), (F.col("i") + 1).cast("int").alias("end"),
                    F.col("lang").alias("title"), prefixed.alias("prefixed_text"),
                    F.col("line").alias("text"), F.col("source").alias("law_name"),
                    (F.col("doc_id") % 50 + 1).cast("string").alias("law_no"),
                    ((F.col("doc_id") * 1000 + F.col("i")).cast("bigint")).alias("ord"))


def expanded_rows(spark: SparkSession, sf_dir: str, gaps: bool = True) -> DataFrame:
    """``expanded``: previous + own + next line; with ``gaps`` every 7th chunk has
    none, so that the lookups that read it meet their fallback."""
    d = table(spark, sf_dir, "documents")
    x = d.select("doc_id", F.posexplode(F.split(F.col("text"), "\n", -1)).alias("i", "line"))
    w = Window.partitionBy("doc_id").orderBy("i")
    txt = F.concat_ws("\n", F.lag("line").over(w), F.col("line"), F.lead("line").over(w))
    e = x.select("doc_id", "i", txt.alias("text"))
    if gaps:
        e = e.filter((F.col("doc_id") * 1000 + F.col("i")) % 7 != 0)
    return e.select(F.col("doc_id").cast("string").alias("law_key"), F.col("i").cast("int").alias("start"),
                    (F.col("i") + 1).cast("int").alias("end"), F.lit("").alias("prefixed_text"), "text")


def article_rows(spark: SparkSession, sf_dir: str, gaps: bool = True) -> DataFrame:
    """``articles``: the first line of a document is its head; with ``gaps`` every
    5th is absent, for the fallback of the lookups."""
    d = table(spark, sf_dir, "documents")
    return ((d.filter(F.col("doc_id") % 5 != 0) if gaps else d)
            .select(F.col("doc_id").cast("string").alias("law_key"),
                    F.element_at(F.split(F.col("text"), "\n", -1), 1).alias("head")))


def exam_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``exam``: multiple-choice items with nested retrieved doc ids, which go
    round all documents."""
    p = ensure_parallel(table(spark, sf_dir, "part"))
    k, n = F.col("p_partkey"), table(spark, sf_dir, "documents").count()
    ids = F.array(F.concat(F.lit("docid"), (k % n).cast("string")),
                  F.concat(F.lit("case"), F.col("p_size").cast("string")),
                  F.concat(F.lit("docid"), ((k * 7 + F.col("p_size")) % n).cast("string")))
    ids = F.when(k % 10 == 0, F.array().cast("array<string>")).otherwise(ids)
    results = F.transform(ids, lambda x: F.struct(x.alias("doc_id")))
    rag = F.struct(F.struct(F.struct(results.alias("results")).alias("retrieved_docs")).alias("question_only"))
    rag = F.when(k % 13 == 0, F.lit(None)).otherwise(rag)
    return p.select(k.alias("no"), F.col("p_name").alias("question"), F.col("p_brand").alias("A"),
                    F.col("p_type").alias("B"), F.col("p_size").cast("string").alias("C"),
                    F.col("p_retailprice").cast("string").alias("D"),
                    F.when(k % 11 == 0, F.lit(None)).otherwise(F.col("p_name")).alias("E"),
                    rag.alias("rag_data"))


def statutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(F.concat(F.lit("docid"), F.col("doc_id").cast("string")).alias("id"),
                    F.col("text").alias("contents"))

