"""Training-data pipeline over ``documents``.

Each stage takes ``(spark, docs, sf_dir)``, works on all that the stage before it
kept, and returns the columns of ``documents`` (the last one packed pieces).
Between stages the rows are written as Parquet to the shared folder and reread; a
stage's own intermediate tables are removed when its rows are written, and so are the
rows of the stage before it.

1. quality rules: documents that fail a rule or the likelihood ratio go;
2. SimHash near-duplicates: the smallest doc_id of each group stays;
3. benchmark decontamination: contaminated documents go;
4. personal data: spans are replaced by their kind, ``n_chars`` follows;
5. packing: token sequences along the curve.

Null or blank texts fail the quality rules; repeated rows survive stage 1 and
collapse in stage 2; an empty table passes through as an empty one; columns
other than those the operators read are carried along unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ragtide.llm import decontaminate, packing, pii, quality_rules, simhash
from ragtide.llm.common import table, written
from ragtide.session import remove_paths, temporary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = pii.redact(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.length("text").cast(kind))
    return clean.select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.piece_digests(packing.pack(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", pack),
]

#: Fingerprints and token ids have no SQL form; tests use brute force.
ORACLE_SQL = None


def folders(df: DataFrame) -> list[str]:
    """Folders of a written table."""
    return sorted({f.rsplit("/", 1)[0] for f in df.inputFiles()})


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with temporary(spark):
            docs = written(stage(spark, docs, sf_dir), name, keep=True)
        remove_paths(spark, before)
        before = folders(docs)
    return STAGES[-1][1](spark, docs, sf_dir)
