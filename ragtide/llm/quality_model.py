"""Quality classifier: logistic regression over hashed word n-grams, trained with
follow-the-regularised-leader (FTRL-proximal) updates.

Features: hashed word 1- and 2-grams, and 1- to 3-grams of word shapes (case,
digits, punctuation runs, repeats of the word before), each group normalised by
its length. Training reads a bounded sample of labelled rows (``MAX_ROWS``,
chosen by a hash of the id; equal rows count once, and an id with many texts is
sampled by a hash of its texts) in ``SHARDS`` fixed groups; each group runs the
updates over its rows in hash order, and the groups' weights are averaged. The
weight vector has ``2**HASH_BITS`` entries whatever the corpus, so broadcasting
it is bounded. Scoring is a gather and a sum for each document, over whole texts.

Ids whose crc32 leaves 2 modulo 4 are held out of training. Labels, languages
and sources never enter a score.

Defined cases: null or empty texts score the bias alone; labels repeated for an
id average (0.5 and more is 1), null labels and ids are left out; without any
label every score is 0.5; repeated rows score alike; an empty table gives an
empty result; only ``doc_id``, ``text`` and ``quality`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ragtide.session import ship_package

from .common import written
from .wordhash import hash_spans, hash_windows, mix

HASH_BITS, SHARDS, EPOCHS = 18, 8, 2
#: About this many labelled rows are learned from at most.
MAX_ROWS = 16_000
ALPHA, BETA, L1, L2, SCALE = 0.5, 1.0, 0.02, 0.1, 20.0
THRESHOLD = 0.7
SLICE_BYTES = 1 << 20

_byte = np.arange(256)
WORD_BYTE = (((_byte >= 48) & (_byte <= 57)) | ((_byte >= 65) & (_byte <= 90))
             | ((_byte >= 97) & (_byte <= 122)) | (_byte >= 128) | (_byte == 39))
CLASS = np.where(WORD_BYTE, 1, np.where(_byte > 32, 2, 0)).astype(np.uint8)
#: (salt, n-gram length, over shapes)
GROUPS = ((1, 1, False), (2, 2, False), (3, 1, True), (4, 2, True), (5, 3, True))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def features(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each feature group: bucket of every n-gram, and the document it is of."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    begins = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    kind = CLASS[data]
    change = np.nonzero(kind[1:] != kind[:-1])[0] + 1
    starts = np.concatenate(([0], change))
    ends = np.append(change, len(data))
    real = kind[starts] > 0
    starts, ends = starts[real], ends[real]
    doc = np.searchsorted(begins, starts, side="right") - 1
    words = hash_spans(data, starts, ends)

    def count(mask):
        total = np.concatenate(([0], np.cumsum(mask)))
        return total[ends] - total[starts]

    upper = count((data >= 65) & (data <= 90))
    digit = count((data >= 48) & (data <= 57))
    first = (data[starts] >= 65) & (data[starts] <= 90)
    shape = np.select([digit > 0, (upper > 1) & (2 * upper >= ends - starts), first], [1, 2, 3], 4).astype(np.uint64)
    repeat = np.zeros(len(words), bool)
    repeat[1:] = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
    shape = mix(np.where(kind[starts] == 2, words, shape) * np.uint64(2) + repeat.astype(np.uint64))
    out = []
    for salt, n, shapes in GROUPS:
        h = hash_windows(shape if shapes else words, n, salt)
        inside = doc[:len(h)] == doc[len(doc) - len(h):]
        out.append(((h[inside] >> np.uint64(64 - HASH_BITS)).astype(np.int64), doc[:len(h)][inside]))
    return out


def slices(texts: list[bytes], size: int = SLICE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    at, held = 0, 0
    for i, t in enumerate(texts):
        if i > at and held + len(t) > size:
            yield at, texts[at:i]
            at, held = i, 0
        held += len(t)
    if texts:
        yield at, texts[at:]


def margins(texts: list[bytes], weights: np.ndarray, bias: float) -> np.ndarray:
    """Bias plus the sparse dot product of each text."""
    out = np.full(len(texts), bias)
    for at, part in slices(texts):
        for bucket, doc in features(part):
            n = np.bincount(doc, minlength=len(part))
            out[at:at + len(part)] += SCALE * np.bincount(
                doc, weights[bucket], minlength=len(part)) / np.maximum(n, 1)
    return out


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def ftrl(texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS) -> np.ndarray:
    """Weights (the last one is the bias) after FTRL-proximal passes in order."""
    size = (1 << HASH_BITS) + 1
    z, n = np.zeros(size), np.zeros(size)
    rows = []
    for _, part in slices(texts):
        groups = features(part)
        lists = [[] for _ in part]
        for bucket, doc in groups:
            ends = np.searchsorted(doc, np.arange(len(part) + 1))
            for i in range(len(part)):
                b, c = np.unique(bucket[ends[i]:ends[i + 1]], return_counts=True)
                if len(b):
                    lists[i].append((b, SCALE * c / c.sum()))
        for x in lists:
            x.append((np.array([size - 1]), np.ones(1)))
            i, inverse = np.unique(np.concatenate([b for b, _ in x]), return_inverse=True)
            rows.append((i, np.bincount(inverse, np.concatenate([v for _, v in x]))))

    def weight(zi, ni):
        return np.where(np.abs(zi) <= L1, 0.0,
                        -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))

    for _ in range(epochs):
        for (i, x), y in zip(rows, labels):
            zi, ni = z[i], n[i]
            w = weight(zi, ni)
            g = (sigmoid(w @ x) - y) * x
            z[i] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * w
            n[i] = ni + g * g
    return weight(z, n)


def _train(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["order", "doc_id", "text"])
    w = ftrl([t.encode() for t in pdf["text"]], pdf["label"].to_numpy(float))
    at = np.nonzero(w)[0]
    return pd.DataFrame({"at": [at.tolist()], "weight": [w[at].tolist()]})


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> np.ndarray:
    """Averaged weights from a bounded sample of the labelled, not held-out rows."""
    ship_package(docs.sparkSession)
    known = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
             .groupBy(F.col("doc_id").alias("_id")).agg((F.avg("quality") >= 0.5).cast("int").alias("label")))
    total = known.count()
    if total > max_rows:
        known = known.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < int(max_rows / total * (1 << 30)))
    # at most about max_rows ids: a bounded broadcast
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(known), F.col("doc_id") == F.col("_id"))
    # ids are bounded above, rows are not: one id may come with any number of them
    rows = written(rows.groupBy("doc_id", "text").agg(F.max("label").alias("label")), "labelled")
    if (n := rows.count()) > 2 * max_rows:
        rows = rows.where(F.pmod(F.xxhash64("doc_id", "text", F.lit(3)), F.lit(1 << 30)) < int(max_rows / n * (1 << 30)))
    order = F.xxhash64("doc_id", F.lit(1))
    parts = (rows.select("doc_id", "text", "label", order.alias("order"), F.pmod(order, F.lit(SHARDS)).alias("shard"))
             .groupBy("shard").applyInPandas(_train, "at array<int>, weight array<double>").collect())
    weights = np.zeros((1 << HASH_BITS) + 1)
    for p in parts:
        weights[p["at"]] += np.array(p["weight"]) / len(parts)
    return weights


def _score(weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        for b in batches:
            texts = [t.as_py() or b"" for t in b.column("text").cast(pa.large_binary())]
            s = sigmoid(margins(texts, w[:-1], w[-1]))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(s)],
                                             ["doc_id", "held_out", "score"])
    return run


def quality_scores(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS,
                   threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs``."""
    weights = docs.sparkSession.sparkContext.broadcast(train(docs, labels, max_rows))
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", held_out().alias("held_out"), F.col("text").cast("string").alias("text")).mapInArrow(
        _score(weights), f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
