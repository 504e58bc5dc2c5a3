"""Pair reranking of a candidate run.

Candidates are pre-limited per query to ``max(10 * k, 100)`` by their first
score, joined to the query text and the document text (``Title: …\\nText: …``),
scored, and cut to ``k``. The scorer is pluggable:

* ``None`` -> default SQL scorer: share of the query's distinct tokens that
  occur in the pair text (JVM-side, no Python worker);
* a callable ``f(list[(query, text)]) -> list[float]`` -> run in Arrow batches
  in an iterator pandas UDF (the cross-encoder slot of the reference).

The candidate side is bounded (queries x pre-limit), so it is the side that
gets broadcast into the corpus lookup.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import format_doc, tokenize
from ..session import ship_package
from .topk import broadcast_if_small, topk_per_group


def prelimit(k: int) -> int:
    return max(k * 10, 100)


def token_overlap(query: Column, text: Column) -> Column:
    """Default scorer: |distinct query tokens found in text| / |distinct query tokens|."""
    qt = F.array_distinct(tokenize(query))
    hit = F.size(F.array_intersect(qt, tokenize(text)))
    n = F.size(qt)
    return F.when(n > 0, hit.cast("double") / n).otherwise(F.lit(0.0))


def scorer_udf(fn: Callable[[list[tuple[str, str]]], list[float]], batch_size: int = 32):
    @F.pandas_udf(T.DoubleType())
    def _score(it: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for qs, ts in it:
            pairs = list(zip(qs.fillna("").tolist(), ts.fillna("").tolist()))
            out = []
            for i in range(0, len(pairs), batch_size):
                out.extend(float(x) for x in fn(pairs[i:i + batch_size]))
            yield pd.Series(np.asarray(out, dtype=np.float64))

    return _score


def pair_scores(pairs: DataFrame, scorer=None, batch_size: int = 32) -> DataFrame:
    """Add ``score`` from ``(qtext, ptext)`` columns."""
    ship_package(pairs.sparkSession)
    if scorer is None:
        s = token_overlap(F.col("qtext"), F.col("ptext"))
    else:
        s = scorer_udf(scorer, batch_size)(F.col("qtext"), F.col("ptext"))
    return pairs.withColumn("score", s)


def rerank(candidates: DataFrame, queries: DataFrame, corpus: DataFrame, k: int = 10,
           scorer=None, batch_size: int = 32, qid: str = "query_id", qtext: str = "text",
           id_col: str = "doc_id", title_col: str | None = "title", text_col: str = "text",
           pair_text: Callable[[DataFrame], Column] | None = None) -> DataFrame:
    """Run ``(query_id, doc_id, score, rank)`` after rescoring the pre-limited
    candidates. ``pair_text`` may build the right-hand text from the joined row
    (columns ``title``, ``text`` and any extra corpus columns)."""
    cand = topk_per_group(candidates.select("query_id", "doc_id", "score"), "query_id",
                          prelimit(k), rank_col="_pre").select("query_id", "doc_id")
    # bounded (queries x pre-limit): the side that is broadcast into the corpus scan
    cand = broadcast_if_small(cand)
    docs = corpus.select(F.col(id_col).alias("doc_id"),
                         (F.col(title_col) if title_col else F.lit("")).alias("title"),
                         F.col(text_col).alias("text"),
                         *[c for c in corpus.columns if c not in (id_col, title_col, text_col)])
    joined = docs.join(cand, "doc_id")
    q = broadcast_if_small(queries.select(F.col(qid).alias("query_id"), F.col(qtext).alias("qtext")))
    joined = joined.join(q, "query_id")
    right = pair_text(joined) if pair_text else format_doc(F.coalesce("title", F.lit("")),
                                                           F.coalesce("text", F.lit("")))
    pairs = joined.select("query_id", "doc_id", "qtext", right.alias("ptext"))
    scored = pair_scores(pairs, scorer, batch_size).select("query_id", "doc_id", "score")
    return topk_per_group(scored, "query_id", k)
