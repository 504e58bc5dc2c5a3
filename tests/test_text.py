import re

from pyspark.sql import functions as F

from ragtide.functions import text as t

SAMPLES = [
    "①개인정보보호법 제28조, ½ a_b ² x‿y",
    "Élève déjà vu — Straße, ÇA VA? 12,5%",
    "  tabs\tand\nnewlines  ",
    "",
    None,
]


def py_tokens(s):
    return re.findall(r"\w+", (s or "").lower())


def test_tokenize_matches_python_word_class(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(SAMPLES)], "i int, s string")
    got = {r.i: list(r.t) for r in df.select("i", t.tokenize("s").alias("t")).collect()}
    for i, s in enumerate(SAMPLES):
        assert got[i] == py_tokens(s), s
    assert got[0] == ["①개인정보보호법", "제28조", "½", "a_b", "²", "x", "y"]


def test_py_strip_and_pick_text(spark):
    rows = [("\n\t a b  \n", "", "x"), ("", None, "y"), (None, None, None)]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    out = df.select(t.py_strip("a").alias("s"), t.pick_text("a", "b", "c").alias("p")).collect()
    assert out[0].s == "a b"
    assert out[1].p == "y"
    assert out[2].p == ""


def test_child_id_and_preview(spark):
    df = spark.createDataFrame([("k:1", 0, 1, "a\nb" * 500), (None, 2, 3, None)],
                               "law_key string, start int, end int, text string")
    out = df.select(t.child_id("law_key", "start", "end").alias("id"), t.preview("text", 900).alias("p")).collect()
    assert out[0].id == "k:1:0:1"
    assert out[1].id == "None:2:3"
    assert len(out[0].p) == 900 and "\n" not in out[0].p
    assert out[1].p == ""


def test_compose_question(spark):
    df = spark.createDataFrame([("Q?", "a", "b", "c", "d", None)], "question string, A string, B string, C string, D string, E string")
    got = df.select(t.compose_question("question").alias("q")).first().q
    assert got == "Q?\nA. a\nB. b\nC. c\nD. d\nE. None"
