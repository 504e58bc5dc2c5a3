"""Sequence packing along a space-filling curve.

Each document is tokenized once; its hashed token vector (log counts in hash
buckets, length 1) is projected to a few dimensions by a fixed random matrix and
mapped to its Hilbert key. A range shuffle on (key, doc_id) puts neighbouring
documents into the same partition in curve order, so that copies of one text,
which share a key, still spread over partitions. Each task then streams its
documents into sequences and cuts a document where a sequence is full. The rest
at a task's end becomes sequences of powers of two, which need no padding.

Tokenized texts are written before the range shuffle, which reads its input
twice. Memory in a task is bounded by an Arrow batch and the longest document.

Defined cases: a null or empty text is the end id alone; special strings inside
texts become what the tokenizer makes of them; repeated rows are packed each;
ties on the curve are ordered by doc_id; an empty table gives no pieces; only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragtide.session import ship_package

from .common import written

SEQUENCE, END_ID = 1024, 0
BUCKETS, DIMS, BITS = 256, 3, 16
SLICE = 512
FLUSH_BYTES = 8 << 20
#: The byte-level pre-tokenizer's pattern (fixed by the vocabulary file).
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Where the two regex engines could class a character differently, the
#: tokenizer itself splits the text.
UNUSUAL = f"[^\x00-\x1b\x20-\x84\x86-{chr(0x2ff)}{chr(0x2010)}-{chr(0x2027)}{chr(0x20ac)}]"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_of() -> dict[str, int]:
    """The byte-level alphabet: printable characters stand for their own byte,
    the rest are numbered from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteIds:
    """Token ids of whole texts as a numpy array of ``dtype``.

    The vocabulary file's tokens are its merge ranks, so plain texts go through a
    rank-based encoder built from the same file, which is several times faster;
    every other text goes through the tokenizer itself. Tests hold both against
    each other.
    """

    def __init__(self, spec: str):
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.unusual = regex.compile(UNUSUAL).search
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        alphabet = byte_of()
        ranks = {bytes(alphabet[c] for c in token): i for token, i in json.loads(spec)["model"]["vocab"].items()}
        self.ranked = Encoding("ranks", pat_str=PIECE, mergeable_ranks=ranks, special_tokens={})
        self.dtype = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"

    def plain(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype)

    def __call__(self, text: str) -> np.ndarray:
        if self.unusual(text) or any(s in text for s in self.special):
            return self.plain(text)
        return self.ranked.encode_to_numpy(text, disallowed_special=()).astype(self.dtype)


@lru_cache(maxsize=2)
def byte_ids(spec: str) -> ByteIds:
    """One for each Python worker, not for each task."""
    return ByteIds(spec)


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position on the Hilbert curve of integer points (n, dims) below 2**bits."""
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the rotations from the coarsest level on
        low = q - 1
        for i in range(dims):
            far = (x[i] & q) != 0
            swap = np.where(far, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(far, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where(x[-1] & q, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_points(vectors: np.ndarray, dims: int = DIMS, bits: int = BITS, seed: int = 7) -> np.ndarray:
    """Project count vectors (n, buckets) to the integer grid of the curve."""
    v = np.log1p(vectors)
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    flat = v @ np.random.default_rng(seed).standard_normal((vectors.shape[1], dims))
    return np.clip((flat + 4) * (2 ** bits / 8), 0, 2 ** bits - 1).astype(np.int64)


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Few rows at a time: Python objects of a whole batch would add up."""
    for b in batches:
        for at in range(0, b.num_rows, SLICE):
            yield b.slice(at, SLICE)


def _encode(spec, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = byte_ids(spec.value)
        for b in sliced(batches):
            texts, out, vectors = b.column("text"), [], np.zeros((b.num_rows, BUCKETS))
            for i in range(b.num_rows):
                ids = np.append(ids_of(texts[i].as_py() or ""), np.array(end_id, ids_of.dtype))
                out.append(ids.tobytes())
                hashed = ids.astype(np.uint32) * np.uint32(0x9E3779B1) >> np.uint32(24)
                vectors[i] = np.bincount(hashed, minlength=BUCKETS)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(hilbert_key(curve_points(vectors))), pa.array(out, pa.binary())],
                ["doc_id", "curve", "ids"])
    return run


def _pack(size: int, kind: pa.DataType, dtype: str):
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def batch(rows):
        cols = list(zip(*rows)) if rows else [[]] * 7
        types = [kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 40
        out, open_, fill, held = [], [], 0, 0
        for b in sliced(batches):
            for doc_id, ids in zip(b.column("doc_id").to_pylist(), b.column("ids").to_pylist()):
                ids = np.frombuffer(ids, dtype).astype("<u4").tobytes()
                total, at = len(ids) // 4, 0
                while at < total:
                    n = min(size - fill, total - at)
                    open_.append((doc_id, at, n, ids[4 * at:4 * (at + n)], total, sequence, fill))
                    at, fill, held = at + n, fill + n, held + 4 * n
                    if fill == size:
                        out += open_
                        open_, fill, sequence = [], 0, sequence + 1
                if held > FLUSH_BYTES:
                    yield batch(out)
                    out, held = [], 0
        # the rest: one sequence for each power of two in its length
        sizes = [1 << k for k in range(fill.bit_length() - 1, -1, -1) if fill >> k & 1]
        used = 0
        for doc_id, start, n, ids, total, _, _ in open_:
            at = 0
            while at < n:
                m = min(sizes[0] - used, n - at)
                out.append((doc_id, start + at, m, ids[4 * at:4 * (at + m)], total, sequence, used))
                at, used = at + m, used + m
                if used == sizes[0]:
                    sizes, used, sequence = sizes[1:], 0, sequence + 1
        yield batch(out)
    return run


def _spec(tokenizer: str | None) -> str:
    with open(tokenizer or default_tokenizer(), encoding="utf-8") as f:
        return f.read()


def encoded(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """(doc_id, curve, ids): end-terminated token ids (little-endian, two bytes
    each where the vocabulary allows, else four) and the key on the curve."""
    spark = docs.sparkSession
    ship_package(spark)
    spec = spark.sparkContext.broadcast(_spec(tokenizer))
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(_encode(spec, end_id), f"doc_id {kind}, curve bigint, ids binary")


def pack(docs: DataFrame, tokenizer: str | None = None, size: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """Pieces: doc_id, start, length, ids (binary), doc_tokens, sequence_id, offset."""
    from pyspark.sql.pandas.types import to_arrow_type

    dtype = ByteIds(_spec(tokenizer)).dtype
    rows = written(encoded(docs, tokenizer, end_id), "encoded")
    kind = rows.schema["doc_id"].dataType
    ordered = rows.repartitionByRange("curve", "doc_id").sortWithinPartitions("curve", "doc_id", F.xxhash64("ids"))
    return ordered.select("doc_id", "ids").mapInArrow(
        _pack(size, to_arrow_type(kind), dtype),
        f"doc_id {kind.simpleString()}, start bigint, length bigint, ids binary, doc_tokens bigint,"
        " sequence_id bigint, offset bigint")


def piece_digests(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")
