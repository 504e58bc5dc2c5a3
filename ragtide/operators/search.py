"""The search pipeline as one call: BM25 and dense runs, softmax fusion, and an
optional reranker over the fused candidates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from . import bm25, dense, encode, fusion
from .topk import materialize

#: reranker(candidates, queries, corpus, k) -> run
Reranker = Callable[[DataFrame, DataFrame, DataFrame, int], DataFrame]


def hybrid_candidates(queries: DataFrame, index: bm25.BM25Index, vectors: DataFrame, alpha: float = fusion.ALPHA,
                      dense_topk: int = 200, sparse_topk: int = 1000, encoder: Callable | None = None,
                      score_function="cos_sim") -> DataFrame:
    """Fused ``(query_id, doc_id, score)`` of both runs; ``queries(query_id, text)``."""
    sparse = bm25.bm25_topk(index, queries, k=sparse_topk)
    found = dense.dense_topk(encode.encode_queries(queries, encoder=encoder), vectors, k=dense_topk,
                             score_function=score_function, exclude_self=False)
    return fusion.hybrid_fuse(found, sparse, alpha)


def search(queries: DataFrame, corpus: DataFrame, index: bm25.BM25Index, vectors: DataFrame,
           alpha: float = fusion.ALPHA, dense_topk: int = 200, sparse_topk: int = 1000, final_topk: int = 10,
           reranker: Reranker | None = None, encoder: Callable | None = None, score_function="cos_sim") -> DataFrame:
    """Run ``(query_id, doc_id, score, rank)``: the ``final_topk`` best fused
    documents of each query, or what ``reranker`` makes of all fused candidates."""
    fused = hybrid_candidates(queries, index, vectors, alpha, dense_topk, sparse_topk, encoder, score_function)
    if reranker is None:
        return fusion.topk_per_group(fused, "query_id", final_topk)
    return reranker(materialize(fused), queries, corpus, final_topk)
