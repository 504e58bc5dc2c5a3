"""BM25 index that takes changes: immutable segments under one folder.

``upsert`` adds documents or new versions of known ones as a new segment, ``delete``
takes documents out, ``merge`` puts segments together. No call rereads old texts:

* ``segments/*`` hold postings as in ``bm25.py`` and the ids of their documents;
* ``gone/*`` name documents that no longer count, with the segment they stand in;
* ``vocab/*`` is the merged vocabulary of a version. A change adds the counts of its
  own segment and takes off those of the documents that go, read from their postings.

A version is one row under ``versions/<number>``, written last: a change that fails
leaves the version before it in force, readers keep the version they opened, and of
two writers with the same number one fails. ``vacuum`` removes what no kept version
names.

Scores use the statistics of the documents that count, so that results equal those of
an index built anew. Ids must not repeat inside a change (``ValueError``); a null id
is no document. Ids to delete that are unknown, or gone already, change nothing.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove_paths, scratch_path
from .bm25 import (B, BLOCK_DOCS, EPSILON, K1, RANGE_BYTES, BM25Index, _weighted_terms, bm25_scores, classes_back,
                   classes_topk, layout, padded, query_classes, ranked, read_postings, shape, write_postings,
                   write_texts, write_vocab)
from .topk import broadcast_if_small, materialize

#: Segments of about the same size that are merged together.
MERGE_FACTOR = 8
#: Bytes of text a token stands for, where only tokens are known.
TOKEN_BYTES = 6

SEGMENT = "seq bigint, folder string, n_docs bigint, n_dead bigint, tokens bigint, n_ranges int, n_blocks int"
VERSION = (f"version bigint, vocab string, n_docs bigint, tokens bigint, mean_idf double, k1 double, b double, "
           f"epsilon double, id_type string, segments array<struct<{SEGMENT.replace(' ', ':').replace(',:', ',')}>>, "
           "gone array<string>")


@dataclass(frozen=True)
class Segment:
    seq: int
    folder: str
    n_docs: int      # documents that count
    n_dead: int      # documents that no longer do
    tokens: int      # as written, gone documents included
    n_ranges: int
    n_blocks: int


@dataclass(frozen=True)
class SegmentedIndex:
    spark: SparkSession
    path: str
    version: int
    vocab: str | None            # folder under path
    n_docs: int
    tokens: int
    mean_idf: float
    k1: float
    b: float
    epsilon: float
    id_type: str | None
    segments: tuple[Segment, ...]
    gone: tuple[str, ...]        # folders under path

    def read(self, folder: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{folder}")

    def dead(self) -> DataFrame:
        """``(doc_id, seq)`` of documents that no longer count."""
        if not self.gone:
            return self.spark.createDataFrame([], f"doc_id {self.id_type or 'string'}, seq bigint")
        return self.spark.read.parquet(*[f"{self.path}/{g}" for g in self.gone])

    def live(self) -> DataFrame:
        """``(doc_id, seq)`` of documents that count."""
        if not self.segments:
            return self.spark.createDataFrame([], f"doc_id {self.id_type or 'string'}, seq bigint")
        parts = [self.read(f"{s.folder}/doc_ids").withColumn("seq", F.lit(s.seq).cast("bigint")) for s in self.segments]
        return reduce(DataFrame.unionByName, parts).join(self.dead(), ["doc_id", "seq"], "left_anti")

    def part(self, s: Segment) -> BM25Index:
        """One segment under the statistics of all."""
        avgdl = self.tokens / self.n_docs if self.n_docs else 0.0
        return BM25Index(read_postings(self.spark, f"{self.path}/{s.folder}", s.n_ranges), self.read(self.vocab),
                         self.live().select("doc_id"), self.n_docs, avgdl, self.mean_idf, s.n_ranges, s.n_blocks,
                         self.k1, self.b, self.epsilon)


def _fs(spark: SparkSession, path: str):
    hp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hp


def _folders(spark: SparkSession, path: str) -> list[str]:
    fs, hp = _fs(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(hp)] if fs.exists(hp) else []


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Finished versions; one row and one folder each."""
    done = []
    for name in _folders(spark, f"{path}/versions"):
        fs, hp = _fs(spark, f"{path}/versions/{name}/_SUCCESS")
        if fs.exists(hp):
            done.append(int(name))
    return sorted(done)


def _commit(index: SegmentedIndex) -> SegmentedIndex:
    row = (index.version, index.vocab, index.n_docs, index.tokens, index.mean_idf, index.k1, index.b, index.epsilon,
           index.id_type, [tuple(vars(s).values()) for s in index.segments], list(index.gone))
    index.spark.createDataFrame([row], VERSION).coalesce(1).write.parquet(f"{index.path}/versions/{index.version:08d}")
    return index


def create_index(spark: SparkSession, path: str | None = None, k1: float = K1, b: float = B,
                 epsilon: float = EPSILON) -> SegmentedIndex:
    """An empty index under ``path`` (default: a new place in the shared folder)."""
    path = path or scratch_path(spark, "segments")
    return _commit(SegmentedIndex(spark, path, 0, None, 0, 0, 0.0, k1, b, epsilon, None, (), ()))


def open_index(spark: SparkSession, path: str, version: int | None = None) -> SegmentedIndex:
    """The newest version under ``path``, or the one asked for."""
    if version is None:
        version = max(_versions(spark, path))
    m = spark.read.schema(VERSION).parquet(f"{path}/versions/{version:08d}").first()
    return SegmentedIndex(spark, path, *m[:9], tuple(Segment(*s) for s in m.segments), tuple(m.gone))


def _new(index: SegmentedIndex, kind: str) -> str:
    return f"{kind}/{index.version + 1:08d}-{uuid.uuid4().hex[:8]}"


def _retire(index: SegmentedIndex, ids: DataFrame) -> tuple[SegmentedIndex, DataFrame | None]:
    """Take ``ids`` out: the index without them, and ``(term, df, ctf)`` of what they held."""
    if not index.segments:
        return index, None
    folder = _new(index, "gone")
    index.live().join(broadcast_if_small(ids), "doc_id", "left_semi").write.parquet(f"{index.path}/{folder}")
    gone = index.read(folder)
    n = {r.seq: r["count"] for r in gone.groupBy("seq").count().collect()}  # one row for a segment
    if not n:
        return index, None
    held = []
    for s in index.segments:
        if s.seq in n:
            mine = broadcast_if_small(gone.where(F.col("seq") == s.seq).select("doc_id"))
            hits = read_postings(index.spark, f"{index.path}/{s.folder}", s.n_ranges).select("term", F.inline("hits"))
            held.append(hits.join(mine, "doc_id", "left_semi").groupBy("term").agg(
                F.count(F.lit(1)).alias("df"), F.sum("tf").alias("ctf")))
    segments = tuple(replace(s, n_docs=s.n_docs - n.get(s.seq, 0), n_dead=s.n_dead + n.get(s.seq, 0))
                     for s in index.segments)
    left = replace(index, n_docs=index.n_docs - sum(n.values()), segments=segments, gone=(*index.gone, folder))
    return left, reduce(DataFrame.unionByName, held)


def _with_vocab(index: SegmentedIndex, more: DataFrame | None, less: DataFrame | None) -> SegmentedIndex:
    """Merge the counts of a change into the vocabulary and commit the next version."""
    parts = [index.read(index.vocab).select("term", "df", "ctf")] if index.vocab else []
    parts += [more] if more is not None else []
    parts += [less.select("term", (-F.col("df")).alias("df"), (-F.col("ctf")).alias("ctf"))] if less is not None else []
    folder = _new(index, "vocab")
    counted = materialize(reduce(DataFrame.unionByName, parts).groupBy("term").agg(
        F.sum("df").alias("df"), F.sum("ctf").alias("ctf")).where("df > 0"))
    tokens, mean_idf = write_vocab(counted, f"{index.path}/{folder}", index.n_docs, index.epsilon)
    return _commit(replace(index, version=index.version + 1, vocab=folder, tokens=tokens, mean_idf=mean_idf))


def upsert(index: SegmentedIndex, corpus: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           title_col: str | None = None, range_bytes: int = RANGE_BYTES, block_docs: int = BLOCK_DOCS) -> SegmentedIndex:
    """Add the documents of ``corpus``; those whose id is known replace the ones before."""
    corpus = corpus.where(F.col(id_col).isNotNull())
    folder = _new(index, "segments")
    corpus.select(F.col(id_col).alias("doc_id")).write.parquet(f"{index.path}/{folder}/doc_ids")
    ids = index.read(f"{folder}/doc_ids")
    if not ids.groupBy("doc_id").count().where("count > 1").isEmpty():
        raise ValueError("ids repeat inside a change")
    n_docs, n_ranges, n_blocks = layout(corpus, text_col, title_col, range_bytes, block_docs)
    if not n_docs:
        return index
    left, less = _retire(index, ids)
    rows = write_texts(corpus, f"{index.path}/{folder}", n_ranges, n_blocks, id_col, text_col, title_col)
    more = materialize(rows.groupBy("term").agg(F.sum("df").alias("df"), F.sum("ctf").alias("ctf")))
    tokens = more.agg(F.sum("ctf").alias("n")).first().n or 0
    new = Segment(index.version + 1, folder, n_docs, 0, tokens, n_ranges, n_blocks)
    left = replace(left, n_docs=left.n_docs + n_docs, segments=(*left.segments, new),
                   id_type=ids.schema["doc_id"].dataType.simpleString())
    return _with_vocab(left, more, less)


def delete(index: SegmentedIndex, ids: DataFrame, id_col: str = "doc_id") -> SegmentedIndex:
    """Take the documents with these ids out."""
    left, less = _retire(index, ids.select(F.col(id_col).alias("doc_id")).where("doc_id IS NOT NULL").distinct())
    return index if less is None else _with_vocab(left, None, less)


def due(index: SegmentedIndex, factor: int = MERGE_FACTOR) -> list[int]:
    """Segments to merge now: ``factor`` or more whose sizes have the same power of
    ``factor``, and those that hold more dead documents than others."""
    tiers: dict[int, list[int]] = {}
    for s in index.segments:
        tiers.setdefault(int(math.log(max(s.n_docs, 1), factor)), []).append(s.seq)
    full = {seq for seqs in tiers.values() if len(seqs) >= factor for seq in seqs}
    return sorted(full | {s.seq for s in index.segments if s.n_dead > s.n_docs})


def merge(index: SegmentedIndex, seqs: list[int] | None = None, range_bytes: int = RANGE_BYTES,
          block_docs: int = BLOCK_DOCS) -> SegmentedIndex:
    """Put these segments (default: ``due``) into one, without what is gone. Statistics
    stay as they are; readers of earlier versions are not disturbed."""
    seqs = due(index) if seqs is None else seqs
    old = [s for s in index.segments if s.seq in seqs]
    if not old:
        return index
    rest = tuple(s for s in index.segments if s.seq not in seqs)
    dead = index.dead()
    n_docs, tokens = sum(s.n_docs for s in old), sum(s.tokens for s in old)
    if n_docs:
        folder = _new(index, "segments")
        n_ranges, n_blocks = shape(index.spark, n_docs, tokens * TOKEN_BYTES, range_bytes, block_docs)
        index.live().where(F.col("seq").isin(seqs)).select("doc_id").write.parquet(f"{index.path}/{folder}/doc_ids")
        rows = write_postings(reduce(DataFrame.unionByName, [_live_hits(index, s, dead) for s in old]),
                              f"{index.path}/{folder}", n_ranges, n_blocks)
        tokens = rows.agg(F.sum("ctf").alias("n")).first().n or 0
        rest = (*rest, Segment(index.version + 1, folder, n_docs, 0, tokens, n_ranges, n_blocks))
    gone: tuple[str, ...] = ()
    if any(s.n_dead for s in rest):
        gone = (_new(index, "gone"),)
        dead.where(~F.col("seq").isin(seqs)).write.parquet(f"{index.path}/{gone[0]}")
    return _commit(replace(index, version=index.version + 1, segments=rest, gone=gone))


def _live_hits(index: SegmentedIndex, s: Segment, dead: DataFrame) -> DataFrame:
    hits = read_postings(index.spark, f"{index.path}/{s.folder}", s.n_ranges).select("term", F.inline("hits"))
    if s.n_dead:
        hits = hits.join(broadcast_if_small(dead.where(F.col("seq") == s.seq).select("doc_id")), "doc_id", "left_anti")
    return hits.select("term", "doc_id", "dl", "tf")


def segments_topk(index: SegmentedIndex, queries: DataFrame, k: int = 1000, qid: str = "query_id",
                  qtext: str = "text", pad: bool = True) -> DataFrame:
    """``(query_id, doc_id, score, rank)`` as ``bm25_topk`` over the documents that count.

    Sums by document finish inside a range of a segment; scores of documents that are
    gone are left out there, and k rows for each query and range are shuffled.
    """
    if k is None or k < 1:
        raise ValueError("segments_topk needs a positive k (ranking every document emits all pairs)")
    if not index.segments:
        asked = queries.select(F.col(qid).alias("query_id")).limit(0)
        return asked.select("query_id", F.lit(None).cast(index.id_type or "string").alias("doc_id"),
                            F.lit(0.0).alias("score"), F.lit(0).cast("bigint").alias("rank"))
    parts = [index.part(s) for s in index.segments]
    if not pad or index.mean_idf > 0:
        members, classes = query_classes(parts[0], queries, qid, qtext)
        dead = index.dead()
        gone = [dead.where(F.col("seq") == s.seq).select("doc_id") if s.n_dead else None for s in index.segments]
        hits = classes_back(classes_topk(list(zip(parts, gone)), classes, k), members)
        return padded(parts[0], queries, k, qid, hits) if pad else hits
    terms = _weighted_terms(parts[0], queries, qid, qtext)
    found, dead = [], index.dead()
    for s, part in zip(index.segments, parts):
        scores = bm25_scores(part, queries, qid, qtext, None, terms)
        if s.n_dead:
            gone = broadcast_if_small(dead.where(F.col("seq") == s.seq).select("doc_id"))
            scores = scores.join(gone, "doc_id", "left_anti").select("query_id", "doc_id", "score")
        found.append(scores)
    scores = reduce(DataFrame.unionByName, found)
    scores = materialize(scores)  # the padding reads them once for each step
    return ranked(parts[0], queries, k, qid, scores, pad)


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Remove versions but the ``keep`` newest, and all folders that no kept one names.
    Call it when no change is under way; the number of folders removed."""
    versions = _versions(spark, path)
    kept = [open_index(spark, path, v) for v in versions[-max(keep, 1):]]
    named = {f for i in kept for f in (i.vocab, *i.gone, *(s.folder for s in i.segments))}
    named |= {f"versions/{i.version:08d}" for i in kept}
    found = [f"{kind}/{name}" for kind in ("versions", "vocab", "gone", "segments")
             for name in _folders(spark, f"{path}/{kind}")]
    unused = [f for f in found if f not in named]
    remove_paths(spark, [f"{path}/{f}" for f in unused])
    return len(unused)
