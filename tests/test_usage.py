"""The README usage flow, end to end on files written from the small tables."""

import json
import os

import pandas as pd
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ragtide.operators import bm25, dense, encode, fusion, law, qa, rerank
from ragtide.sources import files as src


def test_readme_flow(spark, tmp_dir):
    d = tmp_dir[5:] if tmp_dir.startswith("file:") else tmp_dir
    os.makedirs(d, exist_ok=True)
    docs = pd.read_parquet(f"{SF_SMALL}/documents.parquet")
    names = ["개인정보보호법", "전자금융거래법", "신용정보법"]
    with open(os.path.join(d, "laws.jsonl"), "w", encoding="utf-8") as f:
        for r in docs.itertuples():
            f.write(json.dumps({"law_name": names[r.doc_id % 3], "law_no": int(r.doc_id % 30 + 1),
                                "title": r.source, "text": r.text}, ensure_ascii=False) + "\n")
    bench = pd.read_parquet(f"{SF_SMALL}/benchmark.parquet")
    qdf = pd.DataFrame({"ID": [f"TEST_{i:03d}" for i in bench.item_id],
                        "Question": [f"{names[i % 3]} 제{i % 30 + 1}조\n{t[:80]}\n1 가\n2 나" for i, t in
                                     zip(bench.item_id, bench.text)]})
    qdf.to_csv(os.path.join(d, "test.csv"), index=False, encoding="utf-8-sig")

    corpus = src.scan_jsonl_corpus(spark, os.path.join(d, "laws.jsonl"))
    questions = src.scan_questions_csv(spark, os.path.join(d, "test.csv"))
    qs = questions.selectExpr("ID AS query_id", "Question AS text")
    index = bm25.build_bm25_index(corpus, "doc_id", "text", "title")
    vectors = encode.encode_corpus(corpus)
    sparse = bm25.bm25_topk(index, qs, k=10)
    dense_run = dense.dense_topk(encode.encode_queries(qs), vectors, k=10)
    fused = fusion.hybrid_fuse(dense_run, sparse, alpha=0.7)
    run = rerank.rerank(fused, qs, corpus, k=5)
    run = law.prioritize_law(run, qs, corpus, mode="loose", qtext="text")
    contexts = qa.ordered_texts(run, corpus)
    qq = questions.withColumnRenamed("Question", "question")
    prompts = qa.prompt_table(qq, contexts).collect()
    assert len(prompts) == len(qdf) and all(p.is_mc for p in prompts)
    assert all("참고 문서: " in p.prompt and p.prompt.endswith("답변:") for p in prompts)
    responses = qq.select("ID", F.lit("답변: 2").alias("generated"))
    answers = qa.answer_table(qq, responses)
    template = qq.select("ID", F.lit(None).cast("string").alias("Answer"))
    out = os.path.join(d, "submission")
    src.write_submission(qa.submission_table(template, answers), out)
    sub = src.scan_submission(spark, out).collect()
    assert len(sub) == len(qdf) and {r.Answer for r in sub} == {"2"}
    # the loose pattern runs over the whole first line, so law priority only fires on exact names
    first = {r.query_id: r.priority for r in run.filter("rank = 1").collect()}
    assert set(first) == set(qdf.ID)
