"""Answer grading: first row per ID on both sides, left join key -> submission,
parse both answers, exact set equality; a non-numeric answer on either side
is wrong, and every non-numeric submission is counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.answers import parse_answer
from .topk import first_by_key


def dedupe_first(df: DataFrame, key: str = "ID", order: str = "ord") -> DataFrame:
    """First row per key by ``order`` (map-side partial aggregate, skew-safe)."""
    return first_by_key(df, key, order)


def dedupe_last(df: DataFrame, key: str | list[str], order: str = "ord") -> DataFrame:
    """Last row per key by ``order`` (dict-overwrite semantics)."""
    return first_by_key(df, key, order, last=True)


def grade_answers(key: DataFrame, sub: DataFrame, id_col: str = "ID", ans_col: str = "Answer",
                  order: str = "ord") -> DataFrame:
    """Per key ID: both answers, their parsed kinds/values and ``correct``."""
    k = dedupe_first(key.select(id_col, ans_col, order), id_col, order) \
        .select(id_col, F.col(ans_col).alias("answer_key"))
    s = dedupe_first(sub.select(id_col, ans_col, order), id_col, order) \
        .select(id_col, F.col(ans_col).alias("answer_sub"))
    # null-safe: a row without an ID meets the other side's row without one
    j = k.join(s.withColumnRenamed(id_col, "_sid"), F.col(id_col).eqNullSafe(F.col("_sid")), "left").drop("_sid")
    j = j.withColumn("_pk", parse_answer(F.col("answer_key"))) \
         .withColumn("_ps", parse_answer(F.col("answer_sub")))
    correct = ((F.col("_pk.kind") != "str") & (F.col("_ps.kind") != "str")
               & (F.col("_pk.vals") == F.col("_ps.vals")))
    return j.select(id_col, "answer_key", "answer_sub",
                    F.col("_pk.kind").alias("kind_key"), F.col("_ps.kind").alias("kind_sub"),
                    F.col("_pk.vals").alias("vals_key"), F.col("_ps.vals").alias("vals_sub"),
                    F.coalesce(correct, F.lit(False)).alias("correct"))


def grade_summary(graded: DataFrame, id_col: str = "ID") -> DataFrame:
    """``total`` (distinct non-null IDs), ``correct``, ``str_count``."""
    return graded.agg(F.countDistinct(id_col).alias("total"),
                      F.count_if(F.col("correct")).alias("correct"),
                      F.count_if(F.col("kind_sub") == "str").alias("str_count"))
