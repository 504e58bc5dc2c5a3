import os

import pytest
from pyspark.sql import functions as F

from ragtide.operators import parent, prep
from ragtide.operators.topk import first_by_key, materialize, numbered
from ragtide.sources import files as src


def write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as f:
        f.write(text)
    return os.path.join(path, name)


def local(p):
    return p[5:] if p.startswith("file:") else p


def test_line_ordinals_blank_lines_and_failfast(spark, tmp_dir):
    d = local(tmp_dir)
    write(d, "a.jsonl", '{"law_name":"A법","title":"t1","text":"x","law_no":3}\n\n{"title":"t2","text":"y"}\n')
    write(d, "b.jsonl", '   \n{"law_name":"B법","title":"t3","text":"z"}\n')
    c = src.scan_jsonl_corpus(spark, d + "/*.jsonl").orderBy("ord").collect()
    assert [r.doc_id for r in c] == ["doc1", "doc3", "doc5"]
    assert [r.title for r in c] == ["A법 t1", " t2", "B법 t3"]
    assert c[0].law_no == "3"
    write(d + "/bad", "c.jsonl", '{"title": "ok"}\n{broken\n')
    with pytest.raises(Exception):
        src.scan_jsonl_corpus(spark, d + "/bad/c.jsonl").collect()


def test_child_scan_drops_malformed_missing_path_and_last_wins(spark, tmp_dir):
    d = local(tmp_dir)
    write(d, "c1.jsonl", '{"law_key":"k","start":0,"end":1,"text":"first"}\n{oops\n\n'
                         '{"law_key":"k","start":0,"end":1,"prefixed_text":"second"}\n'
                         '{"law_key":"a:b","start":"2","end":3,"text":"colon"}\n{"start":1,"end":2,"text":"nokey"}\n')
    rows = src.scan_child_chunks(spark, d + "/c*.jsonl")
    assert rows.count() == 4
    cc = {r.doc_id: r for r in parent.child_corpus(rows).collect()}
    assert cc["k:0:1"].text == "second"
    assert cc["a:b:2:3"].start == 2
    assert "None:1:2" in cc
    compat = {r.doc_id for r in parent.child_corpus(rows, compat=True).collect()}
    assert "k:-1:1" in compat
    assert src.scan_child_chunks(spark, d + "/missing*.jsonl").count() == 0
    assert src.scan_expanded(spark, None).count() == 0


def test_parent_context_fallbacks(spark):
    children = spark.createDataFrame([("k:0:1", "k", 0, 1, "own", "t"), ("n:0:1", None, 0, 1, "nokey", "t")],
                                     "doc_id string, law_key string, start int, end int, text string, title string")
    exp = spark.createDataFrame([("k", 0, 1, "")], "law_key string, start int, end int, expanded string")
    art = spark.createDataFrame([("k", "HEAD")], "law_key string, head string")
    got = {r.doc_id: (r.expanded_text, r.parent_head) for r in parent.with_parent_context(children, exp, art).collect()}
    assert got == {"k:0:1": ("own", "HEAD"), "n:0:1": ("nokey", "")}


def test_query_files_and_csv(spark, tmp_dir):
    d = local(tmp_dir)
    write(d, "q.json", '{"x1": "first", "x2": "second"}')
    write(d, "l.json", '[{"id": "a", "text": "one"}, {"qid": "b", "query": "two"}, {"text": "three"}]')
    write(d, "q.jsonl", '{"id":"a","text":"1"}\nnot json\n{"qid":"","query":"2"}\n{"id":"a","text":"3"}\n')
    assert {(r.query_id, r.text) for r in src.scan_queries_any(spark, d + "/q.json").collect()} == \
        {("x1", "first"), ("x2", "second")}
    assert {(r.query_id, r.text) for r in src.scan_queries_any(spark, d + "/l.json").collect()} == \
        {("a", "one"), ("b", "two"), ("q3", "three")}
    assert {(r.query_id, r.text) for r in src.scan_queries_any(spark, d + "/q.jsonl").collect()} == \
        {("a", "3"), ("q3", "2")}
    assert src.scan_queries_any(spark, query="hello").first().query_id == "q1"
    write(d, "t.csv", '﻿ID,Question\nTEST_000,"line one\n1 a\n2 b"\nTEST_001,"say ""hi"""\n')
    qs = src.scan_questions_csv(spark, d + "/t.csv").orderBy("ID").collect()
    assert qs[0].Question == "line one\n1 a\n2 b" and qs[1].Question == 'say "hi"'


def test_seeded_split_is_exact_with_duplicates(spark):
    rows = [("q1", "d1", 1)] * 300 + [(f"q{i}", f"d{i}", 1) for i in range(2, 600)]
    df = spark.createDataFrame(rows, "query_id string, corpus_id string, score int")
    s = prep.seeded_split(df, ["query_id", "corpus_id"], 0.2, 42, rank_rows=5)
    counts = {r.split: r["count"] for r in s.groupBy("split").count().collect()}
    n = len(rows)
    assert counts["val"] == math_ceil(0.2 * n) and counts["train"] == n - math_ceil(0.2 * n)
    again = prep.seeded_split(df, ["query_id", "corpus_id"], 0.2, 42, rank_rows=5)
    assert sorted(map(tuple, s.collect())) == sorted(map(tuple, again.collect()))


def test_split_with_a_third_of_the_rows_alike(spark):
    rows = [("hot", "d", 1)] * 4000 + [(f"q{i}", f"d{i}", 1) for i in range(8000)]
    df = spark.createDataFrame(rows, "query_id string, corpus_id string, score int")
    for share in (0.0, 0.1, 0.5, 1.0):
        s = prep.seeded_split(df, ["query_id", "corpus_id"], share, 7, rank_rows=50)
        counts = {r.split: r["count"] for r in s.groupBy("split").count().collect()}
        assert counts.get("val", 0) == math_ceil(share * 12000) and sum(counts.values()) == 12000


def math_ceil(x):
    import math
    return math.ceil(x)


def test_nodup_batches_invariant(spark):
    rows = [(f"q{i % 5}", f"d{i}", "same anchor" if i % 3 == 0 else f"a{i}", f"p{i % 7}") for i in range(200)]
    df = spark.createDataFrame(rows, "query_id string, corpus_id string, anchor string, positive string")
    b = prep.nodup_batches(df, batch_size=8, group_rows=60).collect()
    assert len(b) == len(rows)
    by = {}
    for r in b:
        by.setdefault(r.batch_id, []).append(r)
    for rs in by.values():
        assert len(rs) <= 8
        texts = [t for r in rs for t in {r.anchor, r.positive}]
        assert len(texts) == len(set(texts))


def test_nodup_batches_hot_text_and_rows(spark):
    rows = [("q", "d", "hot anchor", "hot positive")] * 1500 + [(f"q{i}", f"d{i}", f"a{i}", f"p{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "query_id string, corpus_id string, anchor string, positive string")
    b = prep.nodup_batches(df, batch_size=8, group_rows=2000)
    assert prep.nodup_check(df, b, batch_size=8).collect() == [(4500, 4500, 0, 0)]
    again = prep.nodup_batches(df.repartition(7), batch_size=8, group_rows=2000)
    assert sorted(map(str, again.collect())) == sorted(map(str, b.collect()))  # other places, same batches


def test_nodup_batches_are_full_and_hold_nulls(spark):
    df = spark.createDataFrame([(f"q{i % 1000}", f"d{i % 1500}") for i in range(3000)], "anchor string, positive string")
    b = materialize(prep.nodup_batches(df, batch_size=8, group_rows=500))
    assert prep.nodup_check(df, b, batch_size=8).collect() == [(3000, 3000, 0, 0)]
    assert b.select("batch_id").distinct().count() < 1.15 * 3000 / 8
    odd = spark.createDataFrame([(None, None), (None, "a"), ("a", "a"), ("a", None), ("b", "c"), ("b", "c")],
                                "anchor string, positive string")
    got = materialize(prep.nodup_batches(odd, batch_size=4))
    assert prep.nodup_check(odd, got, batch_size=4).collect() == [(6, 6, 0, 0)]
    assert prep.nodup_batches(odd.limit(0)).count() == 0


def test_numbered_over_ranges(spark):
    df = spark.createDataFrame([(["a", "b", None][i % 3] if i % 2 else "a", i) for i in range(500)], "g string, i int")
    got = numbered(df, ["g"], ["i"], "at").collect()
    for g in ("a", "b", None):
        mine = sorted(((r.i, r["at"]) for r in got if r.g == g))
        assert [x for _, x in mine] == list(range(len(mine)))
    assert len(got) == 500


def test_first_and_last_per_key(spark):
    """Ties, null keys, clashing orders and a key in a third of the rows; no payload is
    sorted, grouped or shuffled."""
    rows = [(["hot", f"k{i % 50}", None][i % 3], i % 7, "x" * 50 + str(i)) for i in range(600)]
    df = spark.createDataFrame(rows, "key string, ord int, body string")
    for last, best in ((False, min), (True, max)):
        one = first_by_key(df, "key", "ord", last)
        plan = one._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
        want = {k: best(o for x, o, _ in rows if x == k) for k, _, _ in rows}
        got = one.collect()
        assert {r.key: r.ord for r in got} == want and len(got) == len(want)
        assert all((r.key, r.ord, r.body) in rows for r in got)


def test_train_val_split_by_query(spark):
    rel = spark.createDataFrame([(f"q{i % 20}", f"d{i}", 1) for i in range(100)], "query_id string, corpus_id string, score int")
    data = rel.withColumn("text_queries", rel.query_id)
    train, val, train_rel, val_rel = prep.train_val_split(rel, data, 0.2, 42, by="query")
    a, b = ({r.query_id for r in x.collect()} for x in (train_rel, val_rel))
    assert not a & b and len(b) == 4 and len(a) == 16
    assert train.count() == 80 and val.count() == 20


def test_text_fields_nested_folders_and_broken_json(spark, tmp_dir):
    d = local(tmp_dir)
    write(d + "/p=1", "a.jsonl", '{"law_key": "k", "start": 1, "end": 2, "body": "from body"}\n')
    write(d + "/p=2/deep", "b.jsonl", '\n{"law_key": "m", "start": 1, "end": 2, "text": "from text"}\n')
    write(d + "/_hidden", "c.jsonl", '{"law_key": "no"}\n')
    rows = src.scan_child_chunks(spark, d, text_fields=("body", "text"))
    from ragtide.operators import parent
    got = {r.law_key: r.text for r in parent.child_corpus(rows, text_fields=("body", "text")).collect()}
    assert got == {"k": "from body", "m": "from text"}
    assert sorted(r.ord for r in rows.collect()) == [1, 3]
    for name, body in (("x.json", '{"a": "b"'), ("y.json", '[{"id": "a"'), ("z.json", "words")):
        write(d, name, body)
        with pytest.raises(Exception):
            src.scan_queries_any(spark, d + "/" + name).collect()


def test_rows_without_an_order(spark):
    from ragtide.operators.grading import dedupe_first, dedupe_last
    df = spark.createDataFrame([("A", "1", None), ("B", "2", None), ("B", "3", 5)], "ID string, Answer string, ord int")
    for pick in (dedupe_first, dedupe_last):
        assert {(r.ID, r.Answer) for r in pick(df, "ID").collect()} == {("A", "1"), ("B", "3")}


def test_null_ids_are_graded(spark):
    from ragtide.operators.grading import grade_answers
    df = spark.createDataFrame([(None, "3", 1), ("x", "2", 2)], "ID string, Answer string, ord int")
    assert all(r.correct for r in grade_answers(df, df).collect())


def test_submission_keeps_the_template_order(spark, tmp_dir):
    df = spark.createDataFrame([(f"T{i}", str(i), (i * 37) % 101) for i in range(101)], "ID string, Answer string, ord int")
    import glob
    for bom, code in ((True, "utf-8-sig"), (False, "utf-8")):
        src.write_submission(df, f"{tmp_dir}/{bom}", order="ord", bom=bom)
        names = sorted(glob.glob(f"{local(tmp_dir)}/{bom}/part-*"))
        assert all(open(f, "rb").read().startswith(b"\xef\xbb\xbf") == bom for f in names)
        lines = [x for f in names for x in open(f, encoding=code).read().splitlines()[1:]]
        assert [x.split(",")[0] for x in lines] == [f"T{i}" for i in sorted(range(101), key=lambda i: (i * 37) % 101)]


def test_marked_csv_reads_back(spark, tmp_dir):
    import os
    odd = ["", None, "a,b", 'say "x"', "two\nlines", "cr\rlf\r\n", " padded ", "\\back\\", "\ufeffmark", "답변", "'"]
    df = spark.createDataFrame([(f"k{i}", v) for i, v in enumerate(odd)], "ID string, Answer string")
    src.write_submission(df, tmp_dir)
    back = src.scan_submission(spark, tmp_dir)
    assert back.columns == ["ID", "Answer"]
    assert {r.ID: r.Answer for r in back.collect()} == {f"k{i}": v or None for i, v in enumerate(odd)}
    src.write_submission(df.limit(1), tmp_dir)  # replaces
    assert src.scan_submission(spark, tmp_dir).count() == 1
    src.write_submission(df.limit(0), tmp_dir)  # a header alone
    empty = src.scan_submission(spark, tmp_dir)
    assert empty.columns == ["ID", "Answer"] and empty.count() == 0
    assert sorted(n.split("-")[0] for n in os.listdir(local(tmp_dir))) == ["_SUCCESS", "part"]


def test_marked_csv_failed_job_changes_nothing(spark, tmp_dir):
    import os
    src.write_submission(spark.createDataFrame([("a", "1")], "ID string, Answer string"), tmp_dir)
    before = sorted(os.listdir(local(tmp_dir)))
    bad = spark.range(0, 40, 1, 4).selectExpr(
        "cast(id AS string) AS ID", "if(id = 35, cast(raise_error('stop') AS string), 'x') AS Answer")
    with pytest.raises(Exception):
        src.write_submission(bad, tmp_dir)
    assert sorted(os.listdir(local(tmp_dir))) == before
    assert [tuple(r) for r in src.scan_submission(spark, tmp_dir).collect()] == [("a", "1")]


def test_sparse_grid_counts(spark):
    qs = spark.createDataFrame([(1,), (2,), (3,)], "no int")
    st = spark.createDataFrame([("d1",), ("d2",), ("d3",), ("d4",)], "id string")
    pos = spark.createDataFrame([(1, "d1", 1), (1, "d1", 1), (2, "d3", 1)], "no int, doc_ids string, rel int")
    g = {r.no: (r.n_cells, r.n_pos, r.n_zero) for r in prep.relevance_grid(qs, st, pos).collect()}
    assert g == {1: (5, 2, 3), 2: (4, 1, 3), 3: (4, 0, 4)}


def test_rag_json_multiline_array(spark, tmp_dir):
    d = local(tmp_dir)
    recs = ('[{"no": 1, "question": "q", "rag_data": {"question_only": {"retrieved_docs": {"results": '
            '[{"doc_id": "docid7"}, {"doc_id": "case1"}]}}}},\n'
            ' {"no": 2, "question": "r", "rag_data": null}]')
    write(d + "/a", "x.json", recs)
    schema = ("no long, question string, rag_data struct<question_only: struct<retrieved_docs: "
              "struct<results: array<struct<doc_id: string>>>>>")
    df = src.scan_rag_json(spark, [d + "/a/*.json", d + "/missing/*.json"], schema, multi_line=True)
    got = {r.no: r.ids for r in df.select("no", prep.extract_doc_ids("rag_data").alias("ids")).collect()}
    assert got == {1: ["docid7"], 2: []}


def test_rows_without_repeated_keys_are_not_written(spark, monkeypatch):
    from ragtide.operators import topk

    def no_write(df):
        raise AssertionError("rows are written")

    monkeypatch.setattr(topk, "materialize", no_write)
    df = spark.createDataFrame([("a", 1, "x"), (None, 2, "y"), ("b", None, None)], "k string, ord int, v string")
    assert sorted(map(str, topk.first_by_key(df, "k", "ord").collect())) == sorted(map(str, df.collect()))
    with pytest.raises(AssertionError, match="rows are written"):
        topk.first_by_key(df.unionByName(df.where("k IS NULL")), "k", "ord")


def test_heads_are_joined_before_the_longer_expansions(spark):
    from ragtide.operators import parent

    children = spark.createDataFrame([("d", "own", "L", 0, 1), ("e", "alone", None, 0, 1)],
                                     "doc_id string, text string, law_key string, start int, end int")
    expanded = spark.createDataFrame([("L", 0, 1, "more")], "law_key string, start int, end int, expanded string")
    articles = spark.createDataFrame([("L", "head")], "law_key string, head string")
    x = parent.with_parent_context(children, expanded, articles)
    assert x.columns == ["law_key", "start", "end", "doc_id", "text", "expanded_text", "parent_head"]
    assert sorted(x.select("doc_id", "expanded_text", "parent_head").collect()) == [("d", "more", "head"), ("e", "alone", "")]
    plan = x._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("start") < plan.index("head#")  # the expansions meet the last join
    assert parent.with_parent_context(children, None, None).columns == [*children.columns, "expanded_text", "parent_head"]
