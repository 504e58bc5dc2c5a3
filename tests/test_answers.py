from pyspark.sql import functions as F

from ragtide.functions import answers as a
from ragtide.operators import grading

MC = "질문 본문\n1 하나\n2 둘\n 3 셋"
FREE = "설명하시오\n단답"


def test_multiple_choice_and_split(spark):
    df = spark.createDataFrame([(MC,), (FREE,), ("1 only one",)], "q string")
    out = df.select(a.is_multiple_choice("q").alias("mc"), a.question_stem("q").alias("s"),
                    a.question_options("q").alias("o")).collect()
    assert [r.mc for r in out] == [True, False, False]
    assert out[0].s == "질문 본문" and out[0].o == ["1 하나", "2 둘", "3 셋"]


def test_extract_answer(spark):
    cases = [("답변: 3", MC, "3"), ("정답은 2번", MC, "2"), ("", MC, "미응답"), ("설명 답변: 0 3", MC, "0"),
             ("abc", MC, "0"), ("답변:12", MC, "12"), ("답변: 03", MC, "0"), ("x 답변: a 답변:  7번", MC, "7"),
             ("답변: 자유 서술", FREE, "자유 서술"), (None, MC, "미응답")]
    df = spark.createDataFrame(cases, "g string, q string, want string")
    for r in df.select(a.extract_answer("g", "q").alias("got"), "want").collect():
        assert r.got == r.want


def test_parse_verdict(spark):
    df = spark.createDataFrame([("T F T",), ("TFT",), (" t f ",), ("",)], "v string")
    out = df.select(a.parse_verdict("v", "tokens").alias("t"), a.parse_verdict("v", "chars").alias("c"),
                    a.parse_verdict("v", "chars", 2).alias("c2")).collect()
    assert [r.t for r in out] == [[0, 2], [], [0], []]
    assert [r.c for r in out] == [[0, 2], [0, 2], [0], []]
    assert [r.c2 for r in out] == [[0], [0], [0], []]


def test_parse_answer(spark):
    cases = ["3", "1,3", " 3 , 1 ", "3,3", "3.0", "²", "", None, "1,,3", "10,2", "007"]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    out = [(r.p.kind, r.p.vals) for r in df.select(a.parse_answer("s").alias("p")).collect()]
    assert out == [("single", ["3"]), ("multi", ["1", "3"]), ("multi", ["1", "3"]), ("single", ["3"]),
                   ("str", None), ("str", None), ("str", None), ("str", None), ("str", None),
                   ("multi", ["2", "10"]), ("single", ["7"])]


def test_grading(spark):
    key = spark.createDataFrame([("A", "1", 0), ("B", "1,3", 1), ("C", "2", 2), ("D", "x", 3), ("A", "9", 4)],
                                "ID string, Answer string, ord long")
    sub = spark.createDataFrame([("A", "1", 0), ("B", "3,1", 1), ("C", "2.0", 2), ("D", "x", 3), ("A", "5", 5)],
                                "ID string, Answer string, ord long")
    g = {r.ID: r.correct for r in grading.grade_answers(key, sub).collect()}
    assert g == {"A": True, "B": True, "C": False, "D": False}
    s = grading.grade_summary(grading.grade_answers(key, sub)).first()
    assert (s.total, s.correct, s.str_count) == (4, 2, 2)
