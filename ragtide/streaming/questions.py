"""Questions arriving as files, answered by the batch retrieval operators.

The reference has no streaming operator: it reads one question file and ranks
it against a fixed corpus. This module only runs that same batch work per
micro-batch: ``readStream`` over a folder of question CSV files, and in
``foreachBatch`` the BM25 (and optionally dense + fusion) retrieval against an
index built once. There is no streaming state: every question is answered
from the static index, so the checkpoint holds only source offsets.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import bm25, dense, encode, fusion
from ..session import scratch_path, temporary

QUESTION_SCHEMA = "ID string, Question string"


def retrieve_batch(index: bm25.BM25Index, k: int, dense_corpus: DataFrame | None = None,
                   alpha: float = 0.7, final_k: int | None = None) -> Callable[[DataFrame], DataFrame]:
    """Batch function: questions ``(ID, Question)`` -> run ``(query_id, doc_id, score, rank)``."""

    def run(questions: DataFrame) -> DataFrame:
        qs = questions.select(F.col("ID").alias("query_id"), F.col("Question").alias("text"))
        sparse = bm25.bm25_topk(index, qs, k=k)
        if dense_corpus is None:
            return sparse
        d = dense.dense_topk(encode.encode_queries(qs), dense_corpus, k=k, exclude_self=False)
        return fusion.hybrid_search(d, sparse, alpha, final_k or k)

    return run


def answer_stream(spark: SparkSession, question_dir: str, out_dir: str,
                  batch_fn: Callable[[DataFrame], DataFrame], checkpoint: str | None = None,
                  available_now: bool = True) -> StreamingQuery:
    """Start the stream; each micro-batch's run is appended to ``out_dir`` (Parquet)."""
    src = (spark.readStream.schema(QUESTION_SCHEMA).option("header", True).option("multiLine", True)
           .option("escape", '"').csv(question_dir))

    def sink(batch: DataFrame, epoch: int) -> None:
        with temporary(spark):  # a long stream leaves no intermediate tables
            batch_fn(batch).withColumn("epoch", F.lit(epoch)).write.mode("append").parquet(out_dir)

    w = src.writeStream.foreachBatch(sink).option(
        "checkpointLocation", checkpoint or scratch_path(spark, "stream-ckpt"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
