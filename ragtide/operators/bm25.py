"""Okapi BM25 over an index cut by document range.

Index build (once, reusable): ``title + " " + text`` goes to the range of its document
once, which is about half of what its postings would take; the terms of a range are
counted, sorted and packed there as numbers in Arrow batches. Documents are dealt
into ranges by hash, ranges into blocks of about ``BLOCK_DOCS`` documents; a row
holds the postings of one term in one block, with their number, smallest length and
best posting (the largest frequency, of these the shortest document). Rows are written as a table bucketed by range and
sorted by term; the number of ranges follows the bytes of text. ``vocab(term, df,
ctf, idf)`` comes from one pass over the rows; three corpus scalars are frozen into
the index.

Retrieval: queries that hold the same known terms are one class and scored once.
The terms of the classes are broadcast (in slices of a bounded number, one slice after
the other) into the bucketed scan; a row of the index is read once, however many classes
ask for its term. A range's postings are added up in blocks of numpy cells, and the best
k finish inside the range, because the scan is already distributed by range: only k rows
for each class and range are shuffled. With ``prune``, bounds are read first: a block's bound is the sum of its
terms' largest possible contributions, and the k-th largest best posting of a query
is a score that k documents reach. Blocks whose bound lies below it are skipped,
which loses nothing. The score-0 documents the reference also ranks are added back
from a bounded pool (see ``_padding``).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.text import index_text, runs, tokenize
from ..session import scratch_path, ship_package
from .topk import RANK_DECIMALS, broadcast_if_small, materialize, topk_per_group

# The Okapi BM25 defaults the reference runs with.
K1 = 1.5
B = 0.75
EPSILON = 0.25
#: Text bytes of a document range and documents of a block; Spark takes at most
#: 100,000 buckets, so that ranges grow beyond ``MAX_RANGES`` of them.
RANGE_BYTES, MAX_RANGES, BLOCK_DOCS = 16 << 20, 50_000, 1024
BEST_BASE = 1 << 31
#: Query terms broadcast at once.
TERM_ROWS = 1_000_000
#: Members of query classes, and their bytes, that are broadcast.
MEMBER_ROWS, MEMBER_BYTES = 200_000, 16 << 20
#: Sums held at once by a task that scores a range.
CELLS = 1 << 20
#: Postings in a batch of packed rows.
OUT_POSTINGS = 1 << 18
#: Documents looked at in one step when scores can be negative.
PAD_CHUNK = 1000


@dataclass
class BM25Index:
    postings: DataFrame  # range (bucket), term, block, hits, df, ctf, min_dl, best
    vocab: DataFrame     # term, df, ctf, idf
    doc_ids: DataFrame   # doc_id of every document (empty ones too)
    n_docs: int
    avgdl: float
    mean_idf: float
    n_ranges: int
    n_blocks: int        # blocks of a range
    k1: float = K1
    b: float = B
    epsilon: float = EPSILON


META = ("n_docs bigint, avgdl double, mean_idf double, n_ranges int, n_blocks int, k1 double, b double, "
        "epsilon double")


def load_bm25_index(spark, path: str) -> BM25Index:
    m = spark.read.parquet(f"{path}/meta").first()
    return BM25Index(read_postings(spark, path, m.n_ranges), spark.read.parquet(f"{path}/vocab"),
                     spark.read.parquet(f"{path}/doc_ids"), *m)


def _table_name() -> str:
    return f"ragtide_bm25_{uuid.uuid4().hex[:12]}"


def read_postings(spark, path: str, n_ranges: int) -> DataFrame:
    """Written postings; the bucketing is known to the catalogue, not to the files."""
    rows = spark.read.parquet(f"{path}/postings")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    name = _table_name()
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (range) SORTED BY (term) "
              f"INTO {n_ranges} BUCKETS LOCATION '{path}/postings'")
    return spark.table(name)


def _range_of(n_ranges: int) -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(n_ranges)).cast("int")


def _block_of(n_blocks: int) -> Column:
    return F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(n_blocks)).cast("int")


def write_postings(hits: DataFrame, path: str, n_ranges: int, n_blocks: int) -> DataFrame:
    """Deal ``(term, doc_id, dl, tf)`` into ranges and blocks and write them."""
    # range and block follow from the id, so they are not shuffled
    at = _range_of(n_ranges)
    dealt = hits.repartitionById(n_ranges, at).select(
        at.alias("range"), _block_of(n_blocks).alias("block"), "term", "doc_id", "dl", "tf")
    return _write_rows(dealt, _by_posting, path, n_ranges, n_blocks)


def write_texts(corpus: DataFrame, path: str, n_ranges: int, n_blocks: int, id_col: str = "doc_id",
                text_col: str = "text", title_col: str | None = None) -> DataFrame:
    """``write_postings`` of the terms of texts. Each text goes to its range once and is
    cut into words there, so that no posting is shuffled or sorted as a row."""
    return _write_rows(_dealt_texts(corpus, n_ranges, n_blocks, id_col, text_col, title_col), _by_text, path, n_ranges,
                       n_blocks)


def _dealt_texts(corpus: DataFrame, n_ranges: int, n_blocks: int, id_col: str, text_col: str,
                 title_col: str | None) -> DataFrame:
    title = F.col(title_col) if title_col else F.lit("")
    docs = corpus.select(F.col(id_col).alias("doc_id"), index_text(title, F.col(text_col)).alias("_t"))
    return docs.repartitionById(n_ranges, _range_of(n_ranges)).select(
        _range_of(n_ranges).alias("range"), _block_of(n_blocks).alias("block"), "doc_id", tokenize("_t").alias("terms"))


def _write_rows(dealt: DataFrame, read, path: str, n_ranges: int, n_blocks: int) -> DataFrame:
    """Pack the rows of each range (a partition holds one) and write them."""
    ship_package(dealt.sparkSession)
    id_type = dealt.schema["doc_id"].dataType
    hit = T.StructType([T.StructField("doc_id", id_type), T.StructField("dl", T.IntegerType()),
                        T.StructField("tf", T.IntegerType())])
    schema = T.StructType([
        T.StructField("range", T.IntegerType()), T.StructField("term", T.StringType()),
        T.StructField("block", T.IntegerType()), T.StructField("hits", T.ArrayType(hit)),
        T.StructField("df", T.LongType()), T.StructField("ctf", T.LongType()),
        T.StructField("min_dl", T.IntegerType()), T.StructField("best", T.LongType())])
    arrow = to_arrow_schema(schema)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _packed(read, batches, n_blocks, arrow)

    blocks = dealt.mapInArrow(pack, schema)
    name = _table_name()
    blocks.write.bucketBy(n_ranges, "range").sortBy("term").option("path", f"{path}/postings").saveAsTable(name)
    return blocks.sparkSession.table(name)


def _by_text(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch of documents with all their words, for each (document, distinct word):
    the word in a dictionary, the document's place in the batch and the count; and the
    length of each document."""
    words = batch.column("terms")
    sizes = pc.list_value_length(words).to_numpy()
    coded = words.flatten().dictionary_encode()
    n = max(len(coded.dictionary), 1)
    key, tf = np.unique(np.repeat(np.arange(len(sizes)), sizes) * n + coded.indices.to_numpy(), return_counts=True)
    return (pa.DictionaryArray.from_arrays(pa.array((key % n).astype(np.int32)), coded.dictionary), key // n,
            tf.astype(np.int32), sizes.astype(np.int32))


def _by_posting(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """``_by_text`` of a batch that holds a posting in each row."""
    return (batch.column("term").dictionary_encode(), np.arange(batch.num_rows), batch.column("tf").to_numpy(),
            batch.column("dl").to_numpy())


def _packed(read, batches: Iterator[pa.RecordBatch], n_blocks: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows of the index, sorted by term and block, of the documents of one range."""
    terms, doc, tf, dl, ids, block, docs, at = [], [], [], [], [], [], 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.column("range")[0]
        t, d, n, length = read(batch)
        terms, doc, tf, dl = [*terms, t], [*doc, d + docs], [*tf, n], [*dl, length]
        ids, block, docs = [*ids, batch.column("doc_id")], [*block, batch.column("block").to_numpy()], docs + batch.num_rows
    if not sum(map(len, terms)):
        return
    one = pa.chunked_array(terms).unify_dictionaries()
    names = one.chunk(0).dictionary
    code = np.concatenate([c.indices.to_numpy() for c in one.chunks])
    order = pc.sort_indices(names).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    doc, tf, dl, block, ids = *(np.concatenate(x) for x in (doc, tf, dl, block)), pa.chunked_array(ids)
    key = place[code] * n_blocks + block[doc]
    by = np.argsort(key, kind="stable")
    key, doc, tf = key[by], doc[by], tf[by]
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    for lo, hi in _cuts(np.diff(np.r_[starts, len(key)]), OUT_POSTINGS):
        first, last = starts[lo], starts[hi] if hi < len(starts) else len(key)
        row, mine = starts[lo:hi] - first, slice(first, last)
        length, count = dl[doc[mine]], tf[mine].astype(np.int64)
        hits = pa.StructArray.from_arrays(
            [pa.concat_arrays(ids.take(pa.array(doc[mine])).chunks), pa.array(length), pa.array(tf[mine])], ["doc_id", "dl", "tf"])
        ends = np.append(row, last - first).astype(np.int32)
        # the largest frequency, and of its documents the shortest, in one number
        best = np.maximum.reduceat(count * BEST_BASE + (BEST_BASE - 1 - length), row)
        yield pa.RecordBatch.from_arrays([pa.array(x).cast(f.type) if not isinstance(x, pa.Array) else x.cast(f.type) for x, f in zip((
            np.full(hi - lo, at.as_py()), names.take(pa.array(order[key[starts[lo:hi]] // n_blocks])), key[starts[lo:hi]] % n_blocks,
            pa.ListArray.from_arrays(pa.array(ends), hits), np.diff(ends), np.add.reduceat(count, row),
            np.minimum.reduceat(length, row), best), schema)], schema=schema)


def write_vocab(counted: DataFrame, path: str, n_docs: int, epsilon: float) -> tuple[int, float]:
    """Write ``(term, df, ctf, idf)`` from counts; tokens in all and mean idf."""
    raw = counted.withColumn("idf_raw", idf_expr(n_docs))
    m = raw.agg(F.avg("idf_raw").alias("mean_idf"), F.sum("ctf").alias("total")).first()
    mean_idf = float(m.mean_idf) if m.mean_idf is not None else 0.0
    raw.select("term", "df", "ctf", F.when(F.col("idf_raw") < 0, F.lit(epsilon * mean_idf))
               .otherwise(F.col("idf_raw")).alias("idf")).write.parquet(path)
    return int(m.total or 0), mean_idf


def corpus_postings(corpus: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    title_col: str | None = None) -> DataFrame:
    """``(term, doc_id, dl, tf)`` for every (document, distinct term), without a
    shuffle: a document is one row and its tokens are counted there."""
    title = F.col(title_col) if title_col else F.lit("")
    toks = corpus.select(F.col(id_col).alias("doc_id"), tokenize(index_text(title, F.col(text_col))).alias("_k"))
    counted = toks.select("doc_id", F.size("_k").alias("dl"), F.explode(runs(F.col("_k"))).alias("_p"))
    return counted.select(F.col("_p.value").alias("term"), "doc_id", "dl", F.col("_p.n").alias("tf"))


def idf_expr(n_docs: int, df_col="df"):
    df = F.col(df_col)
    return F.log(F.lit(float(n_docs)) - df + F.lit(0.5)) - F.log(df + F.lit(0.5))


def shape(spark, n_docs: int, n_bytes: int, range_bytes: int = RANGE_BYTES,
          block_docs: int = BLOCK_DOCS) -> tuple[int, int]:
    """Ranges, and blocks of a range, for so many documents and bytes of text."""
    n_ranges = min(max(spark.sparkContext.defaultParallelism, -(-n_bytes // range_bytes)), MAX_RANGES)
    return n_ranges, max(1, -(-n_docs // (n_ranges * block_docs)))


def layout(corpus: DataFrame, text_col: str, title_col: str | None, range_bytes: int = RANGE_BYTES,
           block_docs: int = BLOCK_DOCS) -> tuple[int, int, int]:
    """Documents, ranges, and blocks of a range, from one look at the sizes."""
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("bigint")
    if title_col:
        size = size + F.coalesce(F.octet_length(title_col), F.lit(0))
    m = corpus.agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("b")).first()
    return m.n, *shape(corpus.sparkSession, m.n, m.b or 0, range_bytes, block_docs)


def build_bm25_index(corpus: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     title_col: str | None = None, k1: float = K1, b: float = B,
                     epsilon: float = EPSILON, path: str | None = None,
                     range_bytes: int = RANGE_BYTES, block_docs: int = BLOCK_DOCS) -> BM25Index:
    """Build the index under ``path`` (default: a new place in the shared folder)."""
    spark = corpus.sparkSession
    path = path or scratch_path(spark, "bm25")
    n_docs, n_ranges, n_blocks = layout(corpus, text_col, title_col, range_bytes, block_docs)
    postings = write_texts(corpus, path, n_ranges, n_blocks, id_col, text_col, title_col)
    corpus.select(F.col(id_col).alias("doc_id")).write.parquet(f"{path}/doc_ids")
    counted = materialize(postings.groupBy("term").agg(F.sum("df").alias("df"), F.sum("ctf").alias("ctf")))
    total, mean_idf = write_vocab(counted, f"{path}/vocab", n_docs, epsilon)
    avgdl = float(total) / n_docs if n_docs else 0.0
    meta = (n_docs, avgdl, mean_idf, n_ranges, n_blocks, k1, b, epsilon)
    spark.createDataFrame([meta], META).write.parquet(f"{path}/meta")
    return BM25Index(postings, spark.read.parquet(f"{path}/vocab"), spark.read.parquet(f"{path}/doc_ids"), *meta)


def query_terms(queries: DataFrame, qid: str = "query_id", qtext: str = "text") -> DataFrame:
    """``(query_id, term, qtf)``: query tokens with their multiplicity."""
    return (queries.select(F.col(qid).alias("query_id"),
                           F.explode(tokenize(F.col(qtext))).alias("term"))
            .groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("qtf")))


def _weighted_terms(index: BM25Index, queries: DataFrame, qid: str, qtext: str,
                    max_rows: int = TERM_ROWS) -> list[DataFrame]:
    """``(query_id, term, weight)`` of the terms that the index knows, in slices of
    about ``max_rows`` rows, each with all terms of its queries."""
    known = query_terms(queries, qid, qtext).join(index.vocab.select("term", "idf"), "term")
    terms = materialize(known.select("query_id", "term", (F.col("qtf") * F.col("idf")).alias("weight")))
    n = max(1, -(-terms.count() // max_rows))
    if n == 1:
        return [terms]
    return [terms.where(F.pmod(F.xxhash64("query_id"), F.lit(n)) == i) for i in range(n)]


def _saturation(index: BM25Index, tf: Column, dl: Column) -> Column:
    tf = tf.cast("double")
    norm = F.lit(index.k1) * (F.lit(1.0 - index.b) + F.lit(index.b) * dl / F.lit(index.avgdl))
    return tf * F.lit(index.k1 + 1.0) / (tf + norm)


def _met(index: BM25Index, terms: DataFrame) -> DataFrame:
    """Rows of the index for each query term, still distributed by range."""
    return index.postings.join(F.broadcast(terms), "term")


def _bounds(index: BM25Index) -> tuple[Column, Column]:
    """What no posting of a row exceeds, and what its best posting adds."""
    tf = F.floor(F.col("best") / F.lit(BEST_BASE))
    shortest = F.lit(BEST_BASE - 1) - F.pmod(F.col("best"), F.lit(BEST_BASE))
    return (F.col("weight") * _saturation(index, tf, F.col("min_dl")),
            F.col("weight") * _saturation(index, tf, shortest))


def block_bounds(index: BM25Index, terms: DataFrame) -> DataFrame:
    """``(range, query_id, block, bound, reached)``: no document of the block scores
    above ``bound``, one of them scores ``reached`` or more. Reads no postings."""
    most, one = _bounds(index)
    return _met(index, terms).groupBy("range", "query_id", "block").agg(
        F.sum(most).alias("bound"), F.max(one).alias("reached"))


def thresholds(index: BM25Index, terms: DataFrame, k: int) -> DataFrame:
    """``(query_id, floor)``: a score that k documents reach, less a rounding step."""
    best = topk_per_group(block_bounds(index, terms), "query_id", k, score="reached", tie=["range", "block"])
    return best.where(F.col("rank") == k).select(
        "query_id", (F.col("reached") - F.lit(10.0 ** (1 - RANK_DECIMALS))).alias("floor"))


def _scored_rows(index: BM25Index, terms: DataFrame, k: int | None) -> DataFrame:
    """``(range, query_id, weight, hits)``; with ``k``, without the rows of blocks
    whose bound lies below the query's floor."""
    if k is None:
        return _met(index, terms).select("range", "query_id", "weight", "hits")
    floors = F.broadcast(thresholds(index, terms, k))  # one row for a query at most
    most, _ = _bounds(index)
    gathered = _met(index, terms).groupBy("range", "query_id", "block").agg(
        F.sum(most).alias("bound"), F.collect_list(F.struct("weight", "hits")).alias("rows"))
    kept = gathered.join(floors, "query_id", "left").where(F.col("floor").isNull() | (F.col("bound") >= F.col("floor")))
    return kept.select("range", "query_id", F.explode("rows").alias("_r")).select(
        "range", "query_id", "_r.weight", "_r.hits")


def skipped_blocks(index: BM25Index, queries: DataFrame, k: int, qid: str = "query_id",
                   qtext: str = "text") -> DataFrame:
    """``(query_id, n_blocks, n_skipped)``: blocks that hold a query term, and those
    that the bounds rule out."""
    def one(terms):
        x = block_bounds(index, terms).join(F.broadcast(thresholds(index, terms, k)), "query_id", "left")
        return x.groupBy("query_id").agg(
            F.count(F.lit(1)).alias("n_blocks"), F.count_if(F.col("bound") < F.col("floor")).alias("n_skipped"))

    return reduce(DataFrame.unionByName, [one(t) for t in _weighted_terms(index, queries, qid, qtext)])


def index_hits(index: BM25Index, terms: DataFrame) -> DataFrame:
    """``terms`` (with a column ``term``) with ``doc_id``, ``dl``, ``tf`` of each posting."""
    return (index.postings.select("term", "hits").join(terms, "term")
            .select("*", F.inline("hits")).drop("hits"))


def _padding(index: BM25Index, queries: DataFrame, k: int, qid: str,
             scores: DataFrame | None, chunk: int = PAD_CHUNK) -> DataFrame:
    """Score-0 rows so queries with fewer than k hits still return k documents.

    The top k of all documents is contained in (top k of the hits) + (the first
    k non-hit documents by doc_id). With every idf >= 0 (mean idf > 0) hit scores
    are >= 0, so the first k documents suffice, hits or not. Otherwise hits can
    score below 0 and only non-hits count: documents are looked at in steps of
    ``chunk`` until every query has k of them, so the rows in flight are at most
    queries x chunk however many documents hit.
    """
    q = queries.select(F.col(qid).alias("query_id")).distinct()

    def slots(todo, pool, n):
        pool = pool.withColumn("_pos", F.row_number().over(Window.orderBy("doc_id")))  # n rows
        at = todo.select("query_id", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("_pos"))
        return at.join(broadcast_if_small(pool), "_pos").select("query_id", "doc_id", F.lit(0.0).alias("score"))

    if index.mean_idf > 0:
        return slots(q, index.doc_ids.orderBy("doc_id").limit(k), k)
    out, last, todo = None, None, materialize(q)
    need = materialize(todo.withColumn("_need", F.lit(k)))
    while True:
        rest = index.doc_ids if last is None else index.doc_ids.where(F.col("doc_id") > F.lit(last))
        pool = materialize(rest.orderBy("doc_id").limit(chunk))
        m = pool.agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("last")).first()
        if not m.n or not need.limit(1).count():
            break
        free = slots(need.select("query_id"), pool, m.n).join(
            scores.select("query_id", "doc_id"), ["query_id", "doc_id"], "left_anti")
        found = materialize(topk_per_group(free, "query_id", k).drop("rank"))
        out, last = found if out is None else out.unionByName(found), m.last
        got = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("_n"))
        need = materialize(need.join(got, "query_id", "left")
                           .withColumn("_need", F.col("_need") - F.coalesce("_n", F.lit(0)))
                           .where("_need > 0").drop("_n"))
    return out if out is not None else scores.limit(0).select("query_id", "doc_id", "score")


def bm25_scores(index: BM25Index, queries: DataFrame, qid: str = "query_id", qtext: str = "text",
                k: int | None = None, terms: list[DataFrame] | None = None) -> DataFrame:
    """``(query_id, doc_id, score)`` for every document containing a query term; with
    ``k``, at least for the k best of each query. Ends distributed by range."""
    def one(terms):
        c = F.col("weight") * _saturation(index, F.col("tf"), F.col("dl"))
        return (_scored_rows(index, terms, k).select("range", "query_id", "weight", F.inline("hits"))
                .groupBy("range", "query_id", "doc_id").agg(F.sum(c).alias("score"))
                .select("query_id", "doc_id", "score"))

    terms = _weighted_terms(index, queries, qid, qtext) if terms is None else terms
    return reduce(DataFrame.unionByName, [one(t) for t in terms])


def query_classes(index: BM25Index, queries: DataFrame, qid: str = "query_id",
                  qtext: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(query_id, class)`` of every query with a term that the index knows, and
    ``(class, terms)``: queries with the same known terms have the same scores. What follows
    the queries is shuffled, whatever its estimated size."""
    known = query_terms(queries, qid, qtext).hint("merge").join(index.vocab.select("term", "idf"), "term")
    terms = F.array_sort(F.collect_list(F.struct("term", (F.col("qtf") * F.col("idf")).alias("weight"))))
    asked = materialize(known.groupBy("query_id").agg(terms.alias("terms")).withColumn(
        "_key", F.sha2(F.to_json("terms"), 256)))
    classes = materialize(asked.select("_key", "terms").dropDuplicates(["_key"]).withColumn(
        "class", F.monotonically_increasing_id()))
    members = asked.select("query_id", "_key").hint("merge").join(classes.select("_key", "class"), "_key").drop("_key")
    return materialize(members), classes.drop("_key")


class _Asked:
    """The terms of a slice of classes, by class: its place, term code and weight."""

    def __init__(self, rows: pa.Table):
        rows = rows.sort_by("class").combine_chunks()
        names = rows.column("term").combine_chunks().dictionary_encode()
        self.terms = names.dictionary
        self.code = names.indices.to_numpy()
        self.weight = rows.column("weight").to_numpy()
        self.classes, self.place = np.unique(rows.column("class").to_numpy(), return_inverse=True)


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of the spans [start, start + size), one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


def _cuts(sizes: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Runs of entries whose sizes add up to about ``most``."""
    group = np.cumsum(sizes) // most
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(sizes) else np.zeros(0, int)
    return list(zip(starts, np.r_[starts[1:], len(sizes)]))


def _best_of(row: np.ndarray, doc: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each row: by rounded score, then by document."""
    order = np.lexsort((doc, -np.round(score, RANK_DECIMALS), row))
    r = row[order]
    starts = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
    place = np.arange(len(r)) - np.repeat(starts, np.diff(np.r_[starts, len(r)]))
    return order[place < k]


def _range_best(asked: _Asked, code: np.ndarray, sizes: np.ndarray, doc: np.ndarray, share: np.ndarray, n_docs: int,
                k: int, cells: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(class place, document, score)`` of the k best of each class in one range.
    ``code`` and ``sizes`` describe the index rows, whose postings lie in ``doc``
    (numbers in the order of the ids) and ``share`` (their saturation), by code."""
    found = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    total = np.zeros(len(asked.terms), np.int64)
    begin = np.zeros(len(asked.terms), np.int64)
    total[code[found]] = np.add.reduceat(sizes, found)
    begin[code[found]] = (np.cumsum(sizes) - sizes)[found]
    met = np.flatnonzero(total[asked.code] > 0)
    if not len(met):
        return
    place, n, at, weight = (x[met] for x in (asked.place, total[asked.code], begin[asked.code], asked.weight))
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    ends = np.r_[first[1:], len(place)]
    hits = np.add.reduceat(n, first)
    # where sums are rare, they are sorted out; where they are dense, each has its cell
    rare = hits * 16 < n_docs
    for these, dense in ((np.flatnonzero(rare), False), (np.flatnonzero(~rare), True)):
        cost = np.maximum(hits[these], n_docs) if dense else hits[these]
        for lo, hi in _cuts(cost, cells):
            rows = these[lo:hi]
            entries = _spans(first[rows], ends[rows] - first[rows])
            flat = _spans(at[entries], n[entries])
            row = np.repeat(np.repeat(np.arange(len(rows)), ends[rows] - first[rows]), n[entries])
            key = row * n_docs + doc[flat]
            add = share[flat] * np.repeat(weight[entries], n[entries])
            if dense:
                sums = np.bincount(key, add, len(rows) * n_docs)
                held = np.zeros(len(sums), bool)
                held[key] = True
                if n_docs > k:
                    s = np.where(held, np.round(sums, RANK_DECIMALS), -np.inf).reshape(len(rows), n_docs)
                    held &= (s >= np.partition(s, n_docs - k, axis=1)[:, n_docs - k, None]).ravel()
                key = np.flatnonzero(held)
                sums = sums[key]
            else:
                key, back = np.unique(key, return_inverse=True)
                sums = np.bincount(back, add, len(key))
            row, d = key // n_docs, key % n_docs
            kept = _best_of(row, d, sums, k)
            yield place[first[rows]][row[kept]], d[kept], sums[kept]


def _range_scorer(index: BM25Index, shared, k: int, schema: T.StructType, cells: int):
    """Functions of a range's index rows, and of these and the ids that no longer count,
    to its best."""
    arrow = to_arrow_schema(schema)
    k1, b, avgdl = index.k1, index.b, index.avgdl

    def alone(rows: pa.Table) -> pa.Table:
        return without(rows, None)

    def without(rows: pa.Table, gone: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return arrow.empty_table()
        asked = shared.value
        rows = rows.select(["code", "hits"]).take(pc.sort_indices(rows.column("code"))).combine_chunks()
        code, hits = rows.column("code").to_numpy(), rows.column("hits").chunk(0)
        sizes = pc.list_value_length(hits).to_numpy().astype(np.int64)
        flat = hits.flatten()
        ids, dl, tf = flat.field("doc_id"), flat.field("dl").to_numpy(), flat.field("tf").to_numpy().astype(np.float64)
        if gone is not None and gone.num_rows:
            alive = ~pc.is_in(ids, gone.column("doc_id")).to_numpy(zero_copy_only=False)
            sizes = np.add.reduceat(alive.astype(np.int64), np.cumsum(sizes) - sizes)
            ids, dl, tf = ids.filter(pa.array(alive)), dl[alive], tf[alive]
            code, sizes = code[sizes > 0], sizes[sizes > 0]
            if not len(code):
                return arrow.empty_table()
        coded = ids.dictionary_encode(null_encoding="encode")
        order = pc.array_sort_indices(coded.dictionary, null_placement="at_start").to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        names = coded.dictionary.take(pa.array(order))
        share = tf * (k1 + 1.0) / (tf + k1 * (1.0 - b + b * dl / avgdl))
        parts = [pa.table([pa.array(asked.classes[c]), names.take(pa.array(d)), pa.array(s)], schema=arrow)
                 for c, d, s in _range_best(asked, code, sizes, rank[coded.indices.to_numpy()], share, len(order), k, cells)]
        return pa.concat_tables(parts) if parts else arrow.empty_table()

    return alone, without


def classes_topk(parts: list[tuple[BM25Index, DataFrame | None]], classes: DataFrame, k: int,
                 max_rows: int = TERM_ROWS, cells: int = CELLS) -> DataFrame:
    """``(class, doc_id, score, rank)``: the k best documents of each class that hold one
    of its terms, over one index or several with the same statistics, each with the
    ``doc_id`` of documents that no longer count (or None). Slices of classes are
    broadcast and finished one after the other."""
    spark = classes.sparkSession
    ship_package(spark)
    n = max(1, -(-(classes.agg(F.sum(F.size("terms"))).first()[0] or 0) // max_rows))
    out = []
    for i in range(n):
        mine = classes if n == 1 else classes.where(F.pmod(F.xxhash64("class"), F.lit(n)) == i)
        asked = _Asked(mine.select("class", F.inline("terms")).toArrow())  # about max_rows rows
        shared = spark.sparkContext.broadcast(asked)
        codes = F.broadcast(spark.createDataFrame(pa.table(
            {"term": asked.terms, "code": pa.array(np.arange(len(asked.terms)), pa.int32())})))
        found = []
        for index, gone in parts:
            hit = index.postings.schema["hits"].dataType.elementType
            schema = T.StructType([T.StructField("class", T.LongType()), T.StructField("doc_id", hit["doc_id"].dataType),
                                   T.StructField("score", T.DoubleType())])
            alone, without = _range_scorer(index, shared, k, schema, cells)
            rows = index.postings.select("range", "term", "hits").join(codes, "term").select("range", "code", "hits")
            if gone is None:
                found.append(rows.groupBy("range").applyInArrow(alone, schema))
            else:
                at = F.pmod(F.xxhash64("doc_id"), F.lit(index.n_ranges)).cast("int").alias("range")
                found.append(rows.groupBy("range").cogroup(gone.select(at, "doc_id").groupBy("range"))
                             .applyInArrow(without, schema))
        best = topk_per_group(reduce(DataFrame.unionByName, found), "class", k)
        if n > 1:
            best = materialize(best)
            shared.destroy()
        out.append(best)
    return reduce(DataFrame.unionByName, out)


def classes_back(run: DataFrame, members: DataFrame, max_rows: int = MEMBER_ROWS) -> DataFrame:
    """``(query_id, doc_id, score, rank)`` of every query from the run of its class. Many
    members are shuffled: the driver would hold them, and a hash table of them, at once."""
    return run.join(broadcast_if_small(members, max_rows, MEMBER_BYTES), "class").select("query_id", "doc_id", "score", "rank")


def bm25_topk(index: BM25Index, queries: DataFrame, k: int = 1000, qid: str = "query_id", qtext: str = "text",
              pad: bool = True, prune: bool = False) -> DataFrame:
    """Run ``(query_id, doc_id, score, rank)``: the k best documents per query,
    score-0 documents included as in an exhaustive ranking.

    The top k of the hits (k rows for each query and range are shuffled) is merged
    with the padding pool; a document in both keeps its hit score. ``prune`` reads
    the block bounds first (off by default: a range is read once for all queries); it
    needs scores that no term lowers, so that it is off where idfs may be negative.
    """
    if k is None or k < 1:
        raise ValueError("bm25_topk needs a positive k (ranking every document emits all pairs)")
    if pad and index.mean_idf <= 0:  # the padding reads all scores once for each step
        scores = materialize(bm25_scores(index, queries, qid, qtext))
        return ranked(index, queries, k, qid, scores, pad)
    if prune and index.mean_idf > 0:
        return ranked(index, queries, k, qid, bm25_scores(index, queries, qid, qtext, k), pad)
    members, classes = query_classes(index, queries, qid, qtext)
    hits = classes_back(classes_topk([(index, None)], classes, k), members)
    return padded(index, queries, k, qid, hits) if pad else hits


def ranked(index: BM25Index, queries: DataFrame, k: int, qid: str, scores: DataFrame, pad: bool = True) -> DataFrame:
    """The k best of ``scores`` for each query, with the padding pool."""
    hits = topk_per_group(scores, "query_id", k)
    return padded(index, queries, k, qid, hits, scores) if pad else hits


def padded(index: BM25Index, queries: DataFrame, k: int, qid: str, hits: DataFrame,
           scores: DataFrame | None = None) -> DataFrame:
    """The k best of the ranked ``hits`` and the padding pool; all ``scores`` are needed
    where they may be negative."""
    both = (hits.select("query_id", "doc_id", "score", F.lit(1).alias("_hit"))
            .unionByName(_padding(index, queries, k, qid, scores).withColumn("_hit", F.lit(0))))
    merged = both.groupBy("query_id", "doc_id").agg(F.max_by("score", "_hit").alias("score"))
    return topk_per_group(merged, "query_id", k)
