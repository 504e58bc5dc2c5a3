"""Softmax normalisation and weighted hybrid fusion of runs.

A run is ``(query_id, doc_id, score[, rank])``. Softmax is per query over the
retained rows only (the runs are already top-k, so each window holds at most
k rows); fusion is one union + grouped sum, i.e. a single shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .topk import topk_per_group

ALPHA = 0.7


def softmax_normalize(run: DataFrame, group: str = "query_id", score: str = "score") -> DataFrame:
    """``exp(s - max) / sum(exp(s - max))`` within each query."""
    w = Window.partitionBy(group)
    shifted = F.exp(F.col(score) - F.max(score).over(w))
    out = run.withColumn("_e", shifted)
    return out.withColumn(score, F.col("_e") / F.sum("_e").over(w)).drop("_e")


def hybrid_fuse(dense_run: DataFrame, sparse_run: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """``alpha * softmax(dense) + (1 - alpha) * softmax(sparse)``; a document
    missing from one side gets 0 from it."""
    d = softmax_normalize(dense_run).select("query_id", "doc_id", (F.lit(alpha) * F.col("score")).alias("s"))
    s = softmax_normalize(sparse_run).select("query_id", "doc_id",
                                             (F.lit(1.0 - alpha) * F.col("score")).alias("s"))
    return d.unionByName(s).groupBy("query_id", "doc_id").agg(F.sum("s").alias("score"))


def hybrid_search(dense_run: DataFrame, sparse_run: DataFrame, alpha: float = ALPHA,
                  final_topk: int = 10) -> DataFrame:
    """Fuse, then keep the ``final_topk`` best per query."""
    return topk_per_group(hybrid_fuse(dense_run, sparse_run, alpha), "query_id", final_topk)
