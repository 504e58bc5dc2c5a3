"""Token counts from distinct pre-tokens; no ids are kept anywhere.

1. Each batch of documents becomes one row: its distinct pre-tokens, and for
   every document sparse (pre-token number, frequency) pairs, all as compressed
   bytes. These rows are written once.
2. The batches' pre-tokens (token, batch, number) are shuffled once by token and
   sorted by it, and each distinct one of a run is put through the tokenizer once.
3. Numbers of pre-tokens with more than one piece return to their batch as packed
   bytes, where each document sums frequency x pieces.

A frequent pre-token appears once for each batch, so no key holds more rows than
there are batches. Memory in a task is bounded by a batch (``BATCH_TOKENS``
pre-tokens, or the longest document) and by ``HELD`` numbers on their way back.

The tokenizer's own normalizer and splitter decide for every text with unusual
characters; plain texts take an equal, faster path. A text that holds a special
string is encoded whole, as the library does by default.

Defined cases: a null or empty text has 0 bytes and 0 tokens; repeated rows are
counted each; an empty table gives an empty result; only ``doc_id`` and ``text``
are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ragtide.session import ship_package

from . import packed
from .common import written

LIMIT = 2048
BATCH_TOKENS, HELD, SLICE = 4_000_000, 500_000, 50_000
#: The vocabulary file's splitting pattern (fixed); it keeps no white space.
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Beyond these characters lower-casing, composition or classes may differ
#: between the libraries.
UNUSUAL = f"[^\x00-\x1b\x20-\x84\x86-{chr(0x2ff)}{chr(0x2010)}-{chr(0x2027)}{chr(0x20ac)}]"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Splitter:
    """Pre-tokens of a text, or its whole count where special strings occur."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.findall = regex.compile(PIECE).findall
        self.unusual = regex.compile(UNUSUAL).search
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def whole(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def __call__(self, text: str) -> list[str] | int:
        if any(s in text for s in self.special):
            return self.whole(text)
        if self.unusual(text):
            text = self.tokenizer.normalizer.normalize_str(text)
            if self.unusual(text):  # its own splitter gives the pieces' places
                return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
            return self.findall(text)
        return self.findall(text.lower())


@lru_cache(maxsize=2)
def splitter(spec: str) -> Splitter:
    """One for each Python worker, not for each task."""
    return Splitter(spec)


def _batches(spec, kind: pa.DataType, limit: int):
    schema = pa.schema([("batch", pa.int64()), ("n", pa.int64()), ("lengths", pa.binary()), ("tokens", pa.binary()),
                        ("doc_ids", pa.list_(kind)), ("n_bytes", pa.list_(pa.int64())), ("fixed", pa.list_(pa.int64())),
                        ("sizes", pa.list_(pa.int32())), ("numbers", pa.binary()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter(spec.value)
        number, held = TaskContext.get().partitionId() << 32, 0
        seen: dict[str, int] = {}
        ids, n_bytes, fixed, sizes, numbers, counts = [], [], [], [], [], []

        def row():
            def one(values):
                return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

            lengths, tokens = packed.pack_texts(list(seen))
            cols = [pa.array([number], pa.int64()), pa.array([len(seen)], pa.int64()), pa.array([lengths]),
                    pa.array([tokens]), one(pa.array(ids, kind)),
                    one(pa.array(n_bytes, pa.int64())), one(pa.array(fixed, pa.int64())),
                    one(pa.array(sizes, pa.int32())),
                    pa.array([packed.pack(np.concatenate(numbers))]), pa.array([packed.pack(np.concatenate(counts))])]
            return pa.RecordBatch.from_arrays(cols, schema=schema)

        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                text = text.as_py() or ""
                pieces = split(text)
                whole = isinstance(pieces, int)
                freq = Counter(() if whole else pieces)
                at = np.array([seen.setdefault(p, len(seen)) for p in freq], np.int64)
                order = np.argsort(at)
                # gaps of the sorted numbers; each document starts anew
                numbers.append(np.diff(at[order], prepend=0))
                counts.append(np.fromiter(freq.values(), np.int64, len(freq))[order])
                ids.append(doc_id)
                n_bytes.append(len(text.encode()))
                fixed.append(pieces if whole else 0)
                sizes.append(len(freq))
                held += 1 if whole else len(pieces)
                if held > limit:
                    yield row()
                    number, held, seen = number + 1, 0, {}
                    ids, n_bytes, fixed, sizes, numbers, counts = [], [], [], [], [], []
        if ids:
            yield row()
    return run


def _tokens(batches):
    """One row for each pre-token of a batch."""
    for b in batches:
        for i in range(b.num_rows):
            batch, n, lengths, tokens = (b.column(c)[i].as_py() for c in ("batch", "n", "lengths", "tokens"))
            texts = packed.unpack_texts(lengths, tokens, n)
            for at in range(0, n, SLICE):
                part = texts.slice(at, SLICE)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), batch)), pa.array(np.arange(at, at + len(part))), part],
                    ["batch", "at", "token"])


def _pieces(spec, limit: int):
    """Numbers of pieces other than one, packed by batch; rows come sorted by token."""
    def run(batches):
        split = splitter(spec.value)
        held, n = [], 0

        def rows():
            if not held:
                return
            batch, at, pieces = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((at, batch))
            batch, at, pieces = batch[order], at[order], pieces[order]
            cuts = np.nonzero(np.diff(batch))[0] + 1
            found = [(int(batch[a]), e - a, packed.pack(np.diff(at[a:e], prepend=0)), packed.pack(pieces[a:e]))
                     for a, e in zip([0, *cuts], [*cuts, len(batch)])]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*found)], ["batch", "n", "at", "pieces"])

        for b in batches:
            code = b.column("token").dictionary_encode()
            encoded = split.tokenizer.encode_batch_fast(code.dictionary.to_pylist(), add_special_tokens=False)
            pieces = np.fromiter((len(e.ids) for e in encoded), np.int64, len(encoded))[code.indices.to_numpy()]
            more = pieces != 1
            held.append([x[more] for x in (b.column("batch").to_numpy(), b.column("at").to_numpy(), pieces)])
            n += int(more.sum())
            if n > limit:
                yield from rows()
                held, n = [], 0
        if n:
            yield from rows()
    return run


def _sums(batches):
    for b in batches:
        for i in range(b.num_rows):
            ids, n_bytes, fixed, sizes = (b.column(n)[i].values for n in ("doc_ids", "n_bytes", "fixed", "sizes"))
            sizes = sizes.to_numpy()
            ends = np.cumsum(sizes)
            gaps, counts = (packed.unpack(b.column(n)[i].as_py(), int(ends[-1])).astype(np.int64)
                            for n in ("numbers", "counts"))
            run = np.cumsum(gaps)
            before = np.concatenate(([0], run))[ends - sizes]
            numbers = run - np.repeat(before, sizes)
            pieces = np.ones(int(numbers.max(initial=-1)) + 1, np.int64)
            for part in b.column("back")[i].as_py() or ():
                at = np.cumsum(packed.unpack(part["at"], part["n"]).astype(np.int64))
                pieces[at] = packed.unpack(part["pieces"], part["n"])
            sums = np.concatenate(([0], np.cumsum(pieces[numbers] * counts)))
            yield pa.RecordBatch.from_arrays(
                [ids, n_bytes, pa.array(sums[ends] - sums[ends - sizes] + fixed.to_numpy())],
                ["doc_id", "n_bytes", "n_tokens"])


def token_counts(docs: DataFrame, tokenizer: str | None = None, limit: int = LIMIT,
                 batch_tokens: int = BATCH_TOKENS, held: int = HELD) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row."""
    spark = docs.sparkSession
    ship_package(spark)
    with open(tokenizer or default_tokenizer(), encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    id_type = docs.schema["doc_id"].dataType
    kind, ddl = to_arrow_type(id_type), id_type.simpleString()
    rows = written(docs.mapInArrow(_batches(spec, kind, batch_tokens), (
        f"batch bigint, n bigint, lengths binary, tokens binary, doc_ids array<{ddl}>, n_bytes array<bigint>,"
        " fixed array<bigint>, sizes array<int>, numbers binary, counts binary")), "batches")
    tokens = rows.select("batch", "n", "lengths", "tokens").mapInArrow(_tokens, "batch bigint, at bigint, token string")
    back = (tokens.repartition("token").sortWithinPartitions("token")
            .mapInArrow(_pieces(spec, held), "batch bigint, n bigint, at binary, pieces binary")
            .groupBy("batch").agg(F.collect_list(F.struct("n", "at", "pieces")).alias("back")))
    sums = (rows.drop("n", "lengths", "tokens").join(back, "batch", "left")
            .mapInArrow(_sums, f"doc_id {ddl}, n_bytes bigint, n_tokens bigint"))
    return sums.withColumn("over_limit", F.col("n_tokens") > limit)
