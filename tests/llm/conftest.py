import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that the operators use inside.
CLASHES = ("_id", "_h", "_row", "_t", "_w", "_spans", "more", "fp", "block", "words", "bucket", "start", "_b")


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def documents(spark):
    """The small documents table with awkward rows added."""
    return spark.read.parquet(f"{SF}/documents.parquet").unionByName(odd_rows(spark)).cache()


def odd_rows(spark):
    long = " ".join(f"w{i % 977} x{i}" for i in range(30000))
    same = "one two three four five six seven eight nine ten " * 5
    rows = [(900, None), (901, ""), (902, " \t\r\n\x0b\x0c "), (903, "a"), (904, same), (905, same), (905, same),
            (906, long), (None, "row without an id and with some words of its own kind"),
            (None, None), (907, "\n\n\n"), (908, "ÀÉ ñandú über 日本語 😀 x y"), (909, same + "tail")]
    return spark.createDataFrame([(i, t, "en", "odd", None) for i, t in rows], DOCS)


@pytest.fixture(scope="session")
def with_clashes(spark):
    from pyspark.sql import functions as F

    def add(df):
        return df.select("*", *[F.lit(f"kept {c}").alias(c) for c in CLASHES])
    return add


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")
