"""Training / evaluation data preparation for an embedding model.

The relevance grid (every question x every document, 0/1) is kept *sparse*:
only positive cells are rows, zero cells are a count. Downstream only the
positives are used (``score > 0``), so the questions x documents product is
never built.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import compose_question, format_doc, format_query
from .topk import broadcast_if_small, materialize, measure_small, numbered

DOC_ID_PREFIX = "docid"


def final_question(exam: DataFrame) -> DataFrame:
    """Add ``final_question``: question + ``A. …`` … ``E. …`` lines."""
    return exam.withColumn("final_question", compose_question("question"))


def extract_doc_ids(rag) -> "F.Column":
    """``rag.question_only.retrieved_docs.results[*].doc_id`` starting with
    ``docid``; a missing path gives an empty list."""
    col = F.col(rag) if isinstance(rag, str) else rag
    ids = F.transform(col["question_only"]["retrieved_docs"]["results"], lambda x: x["doc_id"])
    keep = F.filter(ids, lambda d: d.startswith(DOC_ID_PREFIX))
    return F.coalesce(keep, F.array().cast("array<string>"))


def explode_doc_ids(exam: DataFrame, rag_col: str = "rag_data") -> DataFrame:
    """One row per (question, doc id); empty lists vanish and rows with any
    null column are dropped (``dropna()``)."""
    x = final_question(exam).withColumn("doc_ids", extract_doc_ids(rag_col))
    x = x.withColumn("doc_ids", F.explode("doc_ids")).na.drop("any")
    return x


def relation_pairs(exploded: DataFrame, statutes: DataFrame, q_id: str = "no",
                   doc_col: str = "doc_ids", stat_id: str = "id") -> DataFrame:
    """Positive pairs ``(no, doc_ids, rel=1)`` that exist in the statutes."""
    s = statutes.select(F.col(stat_id).alias(doc_col))
    pairs = broadcast_if_small(exploded.select(q_id, doc_col))  # question-sized, not corpus-sized
    return s.join(pairs, doc_col).select(q_id, doc_col, F.lit(1).alias("rel"))


def relevance_grid(questions: DataFrame, statutes: DataFrame, positives: DataFrame,
                   q_id: str = "no", doc_col: str = "doc_ids", stat_id: str = "id") -> DataFrame:
    """Sparse form of the question x document 0/1 grid, one row per question:
    ``n_cells`` (grid rows of that question, duplicate positives included),
    ``n_pos`` (positive rows) and ``n_zero`` (zero cells)."""
    n_docs = statutes.select(stat_id).distinct().count()
    qs = questions.select(q_id).distinct()
    pos = positives.groupBy(q_id).agg(F.count(F.lit(1)).alias("n_pos"),
                                      F.countDistinct(doc_col).alias("_distinct"))
    g = qs.join(pos, q_id, "left").fillna(0, ["n_pos", "_distinct"])
    n_zero = F.lit(n_docs) - F.col("_distinct")
    return g.select(q_id, (n_zero + F.col("n_pos")).cast("bigint").alias("n_cells"),
                    F.col("n_pos").cast("bigint").alias("n_pos"), n_zero.cast("bigint").alias("n_zero"))


def std_queries(queries: DataFrame, id_col: str = "no", text_col: str = "final_question") -> DataFrame:
    return queries.select(F.col(id_col).cast("string").alias("_id"),
                          F.col(id_col).cast("string").alias("title"),
                          F.col(text_col).cast("string").alias("text"))


def std_corpus(corpus: DataFrame, id_col: str, text_col: str, title_col: str | None = None) -> DataFrame:
    title = F.col(title_col) if title_col else F.col(id_col)
    return corpus.select(F.col(id_col).cast("string").alias("_id"), title.cast("string").alias("title"),
                         F.col(text_col).cast("string").alias("text"))


def std_qrels(relations: DataFrame, q_id: str = "no", doc_col: str = "doc_ids", rel_col: str = "rel",
              threshold: float | None = None) -> DataFrame:
    """Positive qrels ``(query_id, corpus_id, score)``: ``score >= threshold``,
    or ``score > 0`` when ``threshold`` is None."""
    r = relations.select(F.col(q_id).cast("string").alias("query_id"),
                         F.col(doc_col).cast("string").alias("corpus_id"), F.col(rel_col).alias("score"))
    cond = F.col("score") > 0 if threshold is None else F.col("score") >= threshold
    return r.filter(cond)


def all_data(qrels: DataFrame, q_std: DataFrame, c_std: DataFrame) -> DataFrame:
    """qrels joined to query and corpus texts."""
    q = q_std.select(F.col("_id").alias("query_id"), F.col("title").alias("title_queries"),
                     F.col("text").alias("text_queries"))
    c = c_std.select(F.col("_id").alias("corpus_id"), F.col("title").alias("title_corpus"),
                     F.col("text").alias("text_corpus"))
    x = broadcast_if_small(qrels.join(q, "query_id"))  # question-sized side into the corpus scan
    return c.join(x, "corpus_id").select("corpus_id", "query_id", "score", "title_queries", "text_queries",
                                         "title_corpus", "text_corpus")


def _hash_key(cols: list[str], seed: int):
    return F.md5(F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in cols],
                             F.lit(str(seed))))


#: Distinct rows that are ranked in one task, and copies expanded in one cell.
RANK_ROWS, EXPAND_ROWS = 100_000, 1000


def _cut(g: DataFrame, want: int, rank_rows: int) -> tuple[str, int]:
    """``(prefix, before)``: the hash prefix under which the ``want``-th row lies,
    and the rows below that prefix. The prefix grows by three hex digits (a
    histogram of at most 4,096 rows each time) until few distinct rows share it."""
    prefix, before = "", 0
    while True:
        size = len(prefix) + 3
        hist = (g.where(F.startswith("_h", F.lit(prefix))).groupBy(F.substring("_h", 1, size).alias("p"))
                .agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("d")).orderBy("p").collect())
        for r in hist:
            if before + r["n"] >= want:
                break
            before += int(r["n"])
        prefix = r["p"]
        if r["d"] <= rank_rows or size >= 32:
            return prefix, before


def seeded_split(df: DataFrame, key_cols: list[str], fraction: float = 0.2, seed: int = 42,
                 rank_rows: int = RANK_ROWS) -> DataFrame:
    """Add ``split`` = 'val' for exactly ``ceil(fraction * n)`` rows, 'train'
    for the rest, in the order of a seeded hash of ``key_cols``.

    Exact without a global sort: identical rows are first collapsed with a
    count (map-side partial aggregate) and written once; histograms of hash
    prefixes locate the cut, and only the distinct rows under one prefix (at most
    ``rank_rows``) are ranked. Rows are then re-expanded from their counts, at
    most ``EXPAND_ROWS`` to a cell.
    """
    cols = df.columns
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    g = materialize(g.withColumn("_h", _hash_key(key_cols + [c for c in cols if c not in key_cols], seed)))
    total = g.agg(F.sum("_n")).first()[0] or 0
    want = math.ceil(fraction * total)
    if not want:
        taken = g.withColumn("_take", F.lit(0).cast("bigint"))
    else:
        prefix, before = _cut(g, want, rank_rows)
        under = F.startswith("_h", F.lit(prefix))
        w = Window.orderBy("_h", *cols).rowsBetween(Window.unboundedPreceding, -1)  # at most rank_rows rows
        cut = g.filter(under).withColumn("_cum", F.coalesce(F.sum("_n").over(w), F.lit(0)) + F.lit(before))
        cut = cut.withColumn("_take", F.greatest(F.lit(0), F.least(F.col("_n"), F.lit(want) - F.col("_cum"))))
        rest = g.filter(~under).withColumn(
            "_take", F.when(F.col("_h") < prefix, F.col("_n")).otherwise(F.lit(0)))
        taken = rest.unionByName(cut.drop("_cum"))

    def expanded(n, split: str) -> DataFrame:
        x = taken.withColumn("_c", n).where("_c > 0").select(
            *cols, "_c", F.explode(F.sequence(F.lit(0), F.floor((F.col("_c") - 1) / EXPAND_ROWS))).alias("_k"))
        size = F.least(F.lit(EXPAND_ROWS), F.col("_c") - F.col("_k") * EXPAND_ROWS)
        return x.select(*cols, F.lit(split).alias("split"), F.explode(F.sequence(F.lit(1), size)).alias("_i")).drop("_i")

    return expanded(F.col("_take"), "val").unionByName(expanded(F.col("_n") - F.col("_take"), "train"))


def train_val_split(qrels: DataFrame, all_rows: DataFrame, test_size: float = 0.2, seed: int = 42,
                    by: str = "row") -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """``(train_data, val_data, train_rel, val_rel)``.

    ``by='row'`` splits qrels rows (the reference: a query can land on both
    sides); ``by='query'`` splits distinct query ids (no leakage).
    """
    if by == "row":
        s = seeded_split(qrels, ["query_id", "corpus_id"], test_size, seed)
    elif by == "query":
        ids = seeded_split(qrels.select("query_id").distinct(), ["query_id"], test_size, seed)
        s = qrels.join(ids, "query_id")
    else:
        raise ValueError("by must be 'row' or 'query'")
    train_rel = s.filter(F.col("split") == "train").drop("split")
    val_rel = s.filter(F.col("split") == "val").drop("split")
    train_data = all_rows.join(train_rel.select("query_id").distinct(), "query_id", "left_semi")
    val_data = all_rows.join(val_rel.select("query_id").distinct(), "query_id", "left_semi")
    return train_data, val_data, train_rel, val_rel


def train_pairs(rows: DataFrame) -> DataFrame:
    """``(query_id, corpus_id, anchor, positive)`` texts for training."""
    return rows.select("query_id", "corpus_id", format_query(F.col("text_queries")).alias("anchor"),
                       format_doc(F.col("title_corpus"), F.col("text_corpus")).alias("positive"))


def sample_ids(ids: DataFrame, n: int, seed: int = 42, id_col: str = "_id") -> DataFrame:
    """A seeded sample of ``n`` ids: the first n by md5(id, seed). The limit is
    the feature (a sampling operator) and ``n`` is a bounded parameter."""
    key = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"|{seed}")))
    return ids.select(id_col).distinct().orderBy(key, F.col(id_col)).limit(n)


def eval_corpus(c_std: DataFrame, val_rel: DataFrame, random_sample: int = 3000,
                seed: int = 42) -> DataFrame:
    """Evaluation corpus: relevant documents of the validation qrels plus a
    seeded sample, texts as ``Title: …\\nText: …``."""
    required = val_rel.select(F.col("corpus_id").cast("string").alias("_id")).distinct()
    ids = required.unionByName(sample_ids(c_std, random_sample, seed)).distinct()
    ids = broadcast_if_small(ids)
    return c_std.join(ids, "_id").select(F.col("_id").alias("corpus_id"),
                                         format_doc(F.col("title"), F.col("text")).alias("text"))


def eval_queries(q_std: DataFrame) -> DataFrame:
    """Evaluation queries, templated twice as in the reference."""
    return q_std.select(F.col("_id").alias("query_id"),
                        format_query(format_doc(F.col("title"), F.col("text"))).alias("text"))


def relevant_docs(val_rel: DataFrame) -> DataFrame:
    """``(query_id, corpus_ids)``: sorted distinct relevant ids per query."""
    return val_rel.groupBy(F.col("query_id").cast("string").alias("query_id")).agg(
        F.array_sort(F.collect_set(F.col("corpus_id").cast("string"))).alias("corpus_ids"))


def relevant_doc_chunks(val_rel: DataFrame, chunk_rows: int = 10_000) -> DataFrame:
    """``(query_id, chunk, corpus_ids)``: the sorted distinct relevant ids of a query,
    cut into cells of ``chunk_rows`` that are numbered from 0 in id order.

    No group is larger than a partition or a cell: ids are range-sorted, counted by
    (query, range), and their place is the ids of the query in the ranges before plus
    the place inside the range.
    """
    ids = materialize(val_rel.select(F.col("query_id").cast("string").alias("query_id"),
                                     F.col("corpus_id").cast("string").alias("corpus_id")).distinct()
                      .repartitionByRange("query_id", "corpus_id").withColumn("_range", F.spark_partition_id()))
    earlier = Window.partitionBy("query_id").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = ids.groupBy("query_id", "_range").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("query_id").alias("_q"), F.col("_range").alias("_r"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_n"))
    inside = F.row_number().over(Window.partitionBy("query_id", "_range").orderBy("corpus_id")) - 1
    placed = ids.withColumn("_i", inside).join(
        before, F.col("query_id").eqNullSafe(F.col("_q")) & (F.col("_range") == F.col("_r")))
    cell = F.floor((F.col("_n") + F.col("_i")) / chunk_rows).cast("long")
    return placed.groupBy("query_id", cell.alias("chunk")).agg(
        F.array_sort(F.collect_list("corpus_id")).alias("corpus_ids"))


def nodup_batches(pairs: DataFrame, batch_size: int = 16, group_rows: int = 100_000,
                  text_cols: tuple[str, ...] = ("anchor", "positive"), seed: int = 42) -> DataFrame:
    """Assign ``batch_id`` so that no text occurs twice inside a batch (a null text is
    a text too).

    Rows are edges between their texts and get colours in rounds. In a round every row
    that is left draws one colour of a fresh palette; the row of smallest rank among
    those of a (text, colour) wins it, and a row that wins all its texts leaves with
    that colour. A palette has as many colours as the most frequent text has rows left,
    or up to four times that where batches still fill. Rows of one colour share no text
    and are cut into batches, in hashed groups of about ``group_rows``.

    Every step groups by (text, colour) or by row, so that a text in a third of all rows
    is held nowhere as one group. Ranks hash a row's content and its number among equal
    rows: the same pairs give the same batches. Only hashes take part in the rounds (two
    texts of one hash count as one, which parts more rows than it must).
    """
    rows = materialize(pairs.withColumn("_address", F.monotonically_increasing_id()))
    texts = F.array_distinct(F.array(*[F.xxhash64(c) for c in text_cols]))
    slim = numbered(rows.select("_address", F.xxhash64(*pairs.columns).alias("_row"), texts.alias("_texts")),
                    ["_row"], ["_address"], "_copy")
    rest = materialize(slim.select("_address", "_texts", F.xxhash64("_row", "_copy", F.lit(seed)).alias("_rank")))
    n, turn, placed = rest.count(), 0, []
    while n:
        claims = rest.select("_address", "_rank", F.explode("_texts").alias("_t"))
        most = claims.groupBy("_t").count().agg(F.max("count").alias("n")).first().n
        palette = max(most, min(4 * most, n // (4 * batch_size)))
        colour = F.pmod(F.xxhash64("_rank", F.lit(turn)), F.lit(palette)).alias("_colour")
        first = claims.groupBy("_t", colour).agg(F.min(F.struct("_rank", "_address")).alias("_w"))
        won = first.groupBy(F.col("_w._address").alias("_a")).agg(F.count(F.lit(1)).alias("_n"))
        tried = materialize(rest.join(won, F.col("_address") == F.col("_a"), "left").select(
            *rest.columns, colour, (F.coalesce("_n", F.lit(0)) == F.size("_texts")).alias("_won")))
        groups = math.ceil(n / (palette * group_rows))
        mine = tried.where("_won").withColumn("_group", F.pmod(F.xxhash64("_rank", F.lit(-1)), F.lit(groups)))
        at = F.row_number().over(Window.partitionBy("_colour", "_group").orderBy("_rank", "_address")) - 1
        batch = F.concat_ws("-", F.lit(turn), "_colour", "_group", F.floor(at / batch_size))
        placed.append(mine.select(F.col("_address").alias("_a"), batch.alias("batch_id")))
        rest = tried.where("NOT _won").select(rest.columns)
        n, turn = rest.count(), turn + 1
    if not placed:
        return rows.select(*pairs.columns, F.lit(None).cast("string").alias("batch_id"))
    found, small = measure_small(reduce(DataFrame.unionByName, placed))
    found = F.broadcast(found) if small else found.hint("shuffle_hash")
    return rows.join(found, F.col("_address") == F.col("_a")).select(*pairs.columns, "batch_id")


def nodup_check(pairs: DataFrame, batches: DataFrame, batch_size: int = 16,
                text_cols: tuple[str, ...] = ("anchor", "positive")) -> DataFrame:
    """One row: rows in, rows out, texts repeated inside a batch, batches too large."""
    texts = batches.select("batch_id", F.explode(F.array_distinct(F.array(*text_cols))).alias("t"))
    repeats = texts.groupBy("batch_id", "t").count().where("count > 1").agg(F.count("*").alias("n"))
    large = batches.groupBy("batch_id").count().where(F.col("count") > batch_size).agg(F.count("*").alias("n"))
    counts = {"rows_in": pairs.agg(F.count("*").alias("n")), "rows_out": batches.agg(F.count("*").alias("n")),
              "n_repeats": repeats, "n_too_large": large}
    stacked = None
    for name, c in counts.items():
        row = c.select(F.lit(name).alias("name"), "n")
        stacked = row if stacked is None else stacked.unionByName(row)
    return stacked.agg(*[F.max(F.when(F.col("name") == k, F.col("n"))).alias(k) for k in counts])
