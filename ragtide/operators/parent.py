"""Parent-child retrieval: child corpus, expansion lookups, parent-aware
rerank, context packing and rendering.

Lookups join on the real key columns ``(law_key, start, end)`` /
``law_key``, never on a re-split composite id (a ``:`` inside ``law_key``
would break the split). When only candidates need context, the candidate
side (queries x k) is the bounded, broadcast side and the big expansion
tables are streamed once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import child_id, pick_text, preview
from .grading import dedupe_last
from .rerank import rerank
from .topk import broadcast_if_small, materialize, measure_small, topk_per_group

TEXT_FIELDS = ("prefixed_text", "text")


def _opt(df: DataFrame, name: str, default=None) -> Column:
    return F.col(name) if name in df.columns else F.lit(default).cast("string")


def _span(c: Column, compat: bool) -> Column:
    """``start``/``end`` as INT, missing -> -1. ``compat`` also maps 0 -> -1
    (the reference's ``int(x or -1)``)."""
    v = c.cast("string").try_cast("int")
    if compat:
        return F.when(v.isNull() | (v == 0), F.lit(-1)).otherwise(v)
    return F.coalesce(v, F.lit(-1))


def child_corpus(rows: DataFrame, text_fields=TEXT_FIELDS, compat: bool = False,
                 order: str = "ord") -> DataFrame:
    """``(doc_id, title, text, law_key, law_name, law_no, title_meta, start, end)``;
    the last row wins for a repeated composite id."""
    st, en = _span(_opt(rows, "start"), compat), _span(_opt(rows, "end"), compat)
    x = rows.select(
        child_id(_opt(rows, "law_key"), st, en).alias("doc_id"),
        F.coalesce(_opt(rows, "title"), F.lit("")).alias("title"),
        pick_text(*[_opt(rows, f) for f in text_fields]).alias("text"),
        _opt(rows, "law_key").alias("law_key"),
        F.coalesce(_opt(rows, "law_name"), F.lit("")).alias("law_name"),
        F.coalesce(_opt(rows, "law_no"), F.lit("")).alias("law_no"),
        F.coalesce(_opt(rows, "title"), F.lit("")).alias("title_meta"),
        st.alias("start"), en.alias("end"), F.col(order).alias("_ord"))
    return dedupe_last(x, "doc_id", "_ord").drop("_ord")


def expansion_table(rows: DataFrame, text_fields=TEXT_FIELDS, compat: bool = False,
                    order: str = "ord") -> DataFrame:
    """``(law_key, start, end, expanded)``, last row per key wins."""
    x = rows.select(_opt(rows, "law_key").alias("law_key"),
                    _span(_opt(rows, "start"), compat).alias("start"),
                    _span(_opt(rows, "end"), compat).alias("end"),
                    pick_text(*[_opt(rows, f) for f in text_fields]).alias("expanded"),
                    F.col(order).alias("_ord"))
    return dedupe_last(x, ["law_key", "start", "end"], "_ord").drop("_ord")


def article_table(rows: DataFrame, order: str = "ord") -> DataFrame:
    """``(law_key, head)``, last row per ``law_key`` wins."""
    x = rows.select(_opt(rows, "law_key").alias("law_key"), _opt(rows, "head").alias("head"),
                    F.col(order).alias("_ord"))
    return dedupe_last(x, "law_key", "_ord").drop("_ord")


def with_parent_context(children: DataFrame, expanded: DataFrame | None,
                        articles: DataFrame | None) -> DataFrame:
    """Add ``expanded_text`` (own text when no expansion) and ``parent_head``
    ("" when missing). A null ``law_key`` matches nothing."""
    keys = [c for c in ("law_key", "start", "end") if expanded is not None or articles is not None and c == "law_key"]
    order = [*keys, *[c for c in children.columns if c not in keys], "expanded_text", "parent_head"]
    # heads first: the expansions, which are longer than the children, move once
    x = children
    if articles is not None:
        x = x.join(articles, "law_key", "left")
    else:
        x = x.withColumn("head", F.lit(None).cast("string"))
    if expanded is not None:
        x = x.join(expanded, ["law_key", "start", "end"], "left")
    else:
        x = x.withColumn("expanded", F.lit(None).cast("string"))
    return (x.withColumn("expanded_text", F.coalesce(F.nullif("expanded", F.lit("")), F.col("text")))
             .withColumn("parent_head", F.coalesce(F.col("head"), F.lit("")))
             .select(*order))


def candidate_context(run: DataFrame, children: DataFrame, expanded: DataFrame | None,
                      articles: DataFrame | None) -> DataFrame:
    """Parent context for the documents of a run only. The run is the bounded
    side: it is broadcast into the child scan, and the hit keys are broadcast
    into the expansion and article scans, so none of the big tables is
    shuffled for a lookup."""
    ids, small = measure_small(run.select("doc_id").distinct())
    hit_children = materialize(children.join(F.broadcast(ids) if small else ids, "doc_id"))
    # doc_id is unique in the child corpus, so the hit keys are no more than the
    # measured ids: their bound is proven without another measuring job
    bc = F.broadcast if small else broadcast_if_small
    # the matched lookup rows hold texts of any length: how they are joined is left to
    # their real size at run time
    if expanded is not None:
        expanded = expanded.join(bc(hit_children.select("law_key", "start", "end").distinct()),
                                 ["law_key", "start", "end"])
    if articles is not None:
        articles = articles.join(bc(hit_children.select("law_key").distinct()), "law_key")
    return with_parent_context(hit_children, expanded, articles)


def parent_pair_text(row_df: DataFrame) -> Column:
    return F.concat(F.lit("Head: "), F.coalesce("parent_head", F.lit("")), F.lit("\nTitle: "),
                    F.coalesce("title", F.lit("")), F.lit("\nText: "),
                    F.coalesce("expanded_text", F.lit("")))


def rerank_parent(candidates: DataFrame, queries: DataFrame, children: DataFrame,
                  expanded: DataFrame | None, articles: DataFrame | None, k: int = 10,
                  scorer=None, batch_size: int = 32, qid: str = "query_id",
                  qtext: str = "text") -> DataFrame:
    """Rerank with ``Head: …\\nTitle: …\\nText: <expanded>`` as the pair text."""
    candidates = materialize(candidates.select("query_id", "doc_id", "score"))
    ctx = candidate_context(candidates, children, expanded, articles)
    corpus = ctx.select("doc_id", "title", "text", "expanded_text", "parent_head")
    return rerank(candidates, queries, corpus, k=k, scorer=scorer, batch_size=batch_size,
                  qid=qid, qtext=qtext, pair_text=parent_pair_text)


def context_pack(run: DataFrame, children: DataFrame, expanded: DataFrame | None,
                 articles: DataFrame | None, top_n: int = 10, preview_chars: int = 900) -> DataFrame:
    """Per hit: child text, expanded text and parent head, previews of
    ``preview_chars`` characters, for the ``top_n`` best hits of each query."""
    top = materialize(topk_per_group(run.select("query_id", "doc_id", "score"), "query_id", top_n))
    ctx = candidate_context(top, children, expanded, articles)
    x = top.join(ctx, "doc_id")
    return x.select("query_id", "rank", "doc_id", "score", "law_key", "law_name", "law_no",
                    F.col("title_meta").alias("title"),
                    preview(F.col("text"), preview_chars).alias("child_text"),
                    preview(F.col("expanded_text"), preview_chars).alias("expanded_text"),
                    "parent_head")


def context_render(packed: DataFrame) -> DataFrame:
    """``(query_id, n_hits, docs)``: ``[i] Head: …\\nChild: …\\nExpanded: …``
    per hit, in rank order (``docs`` is an array of strings)."""
    item = F.format_string("[%d] Head: %s\nChild: %s\nExpanded: %s", F.col("rank").cast("int"),
                           F.col("parent_head"), F.col("child_text"), F.col("expanded_text"))
    g = packed.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", item.alias("s")))).alias("_l"))
    return g.select("query_id", F.size("_l").cast("bigint").alias("n_hits"),
                    F.transform("_l", lambda x: x["s"]).alias("docs"))
