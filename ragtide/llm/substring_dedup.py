"""Removal of repeated word windows, with a count-min prefilter.

1. Documents are packed into blocks (a few MB of normalised words each), written
   once; every later step reads the same blocks.
2. Each block is hashed into ``DEPTH`` rows of a count-min sketch whose width
   follows the counted windows. A block's sketch is sparse: its sorted cells, as
   compressed gaps. Sketches are merged shard by shard of the cell range, and
   each block gets back one bit for each of its cells: whether the merged count
   exceeds one. The estimate never falls below the true count, so that no
   repeated window is lost.
3. Only windows whose estimate exceeds one in every row are grouped exactly, by
   128-bit hashes, through the same exchange; blocks get back one bit for each.
4. Words covered by a repeated window are removed.

What moves is about a byte for each window and row plus one bit back. A window
repeated in any number of documents counts once for each block, so hot passages
do not gather anywhere. Memory in a task is bounded by a block (or the longest
document) and by the entries of a shard: blocks lie two in a row group, and go to Python
one by one, in Arrow batches of a block's size or as groups of their own with their bits. A row of the exchange is what one block has
for one shard, so both sizes follow the input (``layout``): rows keep
``VALUES_A_ROW`` values, and their number grows with the text, until both sizes reach
their bounds at about a terabyte; beyond, rows grow faster than the text.

Defined cases: a null or blank text has no words; texts shorter than a window
lose nothing; repeated rows (of any length beyond a window) remove each other;
an empty table gives an empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ragtide.session import arrow_bytes, ship_package

from . import packed
from .common import written
from .wordhash import hash_spans, hash_windows, mix

WINDOW, DEPTH = 35, 2
#: Bytes of a block and entries of a shard: least and most.
BLOCK_BYTES, SHARD_ENTRIES = (4 << 20, 16 << 20), (1 << 20, 4 << 20)
VALUES_A_ROW = 64
#: Blocks of a row group of the written blocks.
GROUP_BLOCKS = 2
#: Cells of a sketch row for each window (rounded up to a power of two).
CELLS_PER_WINDOW, MIN_SHARDS = 8, 64


def layout(text_bytes: int) -> tuple[int, int]:
    """Block bytes and shard entries for a corpus. A block has about
    ``block * entries / text_bytes`` values for a shard."""
    need = VALUES_A_ROW * text_bytes
    block = min(max(BLOCK_BYTES[0], need // SHARD_ENTRIES[0]), BLOCK_BYTES[1])
    return block, min(max(SHARD_ENTRIES[0], need // block), SHARD_ENTRIES[1])


def _blocks(size: int, kind: pa.DataType, window: int):
    schema = pa.schema([("block", pa.int64()), ("n_windows", pa.int64()),
                        ("doc_ids", pa.list_(kind)), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, parts, held, n = [], [], 0, 0

        def block():
            return pa.RecordBatch.from_pylist(
                [{"block": number, "n_windows": n, "doc_ids": ids, "data": b"".join(parts)}], schema)

        for b in batches:
            texts = b.column("text").cast(pa.large_binary())
            for doc_id, t in zip(b.column("doc_id").to_pylist(), texts):
                words = (t.as_py() or b"").split()
                part = b" ".join(words) + b"\n"
                if parts and held + len(part) > size:
                    yield block()
                    number, ids, parts, held, n = number + 1, [], [], 0, 0
                ids.append(doc_id)
                parts.append(part)
                held, n = held + len(part), n + max(0, len(words) - window + 1)
        if parts:
            yield block()
    return run


class Block:
    """Words of a block, and the windows that lie within one document."""

    def __init__(self, data: bytes, window: int):
        self.data, self.window = data, window
        b = np.frombuffer(data, np.uint8)
        ends = np.nonzero((b == 32) | (b == 10))[0]
        starts = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
        doc = np.cumsum(b[ends] == 10) - (b[ends] == 10)
        real = ends > starts
        self.starts, self.ends, self.doc = starts[real], ends[real], doc[real]
        hashes = hash_spans(b, self.starts, self.ends)
        n = max(0, len(hashes) - window + 1)
        self.inside = np.nonzero(self.doc[:n] == self.doc[window - 1:])[0] if n else np.empty(0, np.int64)
        self.keys = [hash_windows(hashes, window, k)[self.inside] for k in range(2)]

    def estimated(self, shards: int, bits: int, replies) -> np.ndarray:
        """Which windows have an estimate beyond one in every sketch row."""
        flagged = np.ones(len(self.inside), bool)
        for row in range(DEPTH):
            cells, where = np.unique(self.cells(row, bits), return_inverse=True)
            flagged &= unpack(replies, row * shards, shards, bits, cells)[where]
        return flagged

    def cells(self, row: int, bits: int) -> np.ndarray:
        return mix(self.keys[row], 7) >> np.uint64(64 - bits)


def split_shards(values: np.ndarray, shards: int, bits: int):
    """Bounds of each shard in sorted values below 2**bits."""
    step = np.uint64(bits - (shards.bit_length() - 1))
    return np.searchsorted(values >> step, np.arange(shards + 1, dtype=np.uint64))


def pack_values(values: np.ndarray) -> bytes:
    """Sorted integers as their gaps."""
    return packed.pack(np.diff(values, prepend=np.uint64(0)))


def unpack_values(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(packed.unpack(data, n), dtype=np.uint64)


def unpack(replies, first: int, shards: int, bits: int, values: np.ndarray) -> np.ndarray:
    """Reply bits of sorted unique ``values``, shard by shard."""
    out = np.zeros(len(values), bool)
    bounds = split_shards(values, shards, bits)
    for shard, reply in replies:
        if first <= shard < first + shards:
            a, b = bounds[shard - first], bounds[shard - first + 1]
            out[a:b] = np.unpackbits(np.frombuffer(reply, np.uint8), count=b - a).astype(bool)
    return out


def entries(block: int, first: int, shards: int, bits: int, values: np.ndarray, extra: np.ndarray | None = None):
    """Exchange rows of a block: its distinct values by shard, each with a flag
    for those that it holds more than once. With ``extra`` the values are pairs."""
    if extra is None:
        values, counts = np.unique(values, return_counts=True)
        repeated = counts > 1
    else:
        order = np.lexsort((extra, values))
        values, extra = values[order], extra[order]
        new = np.ones(len(values), bool)
        new[1:] = (values[1:] != values[:-1]) | (extra[1:] != extra[:-1])
        at = np.nonzero(new)[0]
        repeated = np.diff(at, append=len(values)) > 1
        values, extra = values[at], extra[at]
    bounds = split_shards(values, shards, bits)
    for s in range(shards):
        a, b = bounds[s], bounds[s + 1]
        if a < b:
            yield {"shard": first + s, "block": block, "n": int(b - a), "cells": pack_values(values[a:b]),
                   "extra": b"" if extra is None else extra[a:b].astype("<u8").tobytes(),
                   "repeated": np.packbits(repeated[a:b]).tobytes()}


ENTRY = pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("n", pa.int64()), ("cells", pa.binary()),
                   ("extra", pa.binary()), ("repeated", pa.binary())])
ENTRY_DDL = "shard bigint, block bigint, n bigint, cells binary, extra binary, repeated binary"


def merge(table: pa.Table) -> pa.Table:
    """Add the blocks' counts of one shard; a bit for each entry back: beyond one?"""
    rows = table.to_pylist()
    values = np.concatenate([unpack_values(r["cells"], r["n"]) for r in rows])
    extra = np.concatenate([np.frombuffer(r["extra"] or bytes(8 * r["n"]), "<u8") for r in rows])
    flag = np.concatenate([np.unpackbits(np.frombuffer(r["repeated"], np.uint8), count=r["n"]) for r in rows])
    order = np.lexsort((extra, values)) if extra.any() else np.argsort(values, kind="stable")
    v, x = values[order], extra[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (x[1:] != x[:-1])
    at = np.nonzero(new)[0]
    counts = np.add.reduceat(1 + flag[order].astype(np.int64), at)
    many = np.empty(len(v), bool)
    many[order] = np.repeat(counts > 1, np.diff(at, append=len(v)))
    ends = np.cumsum([r["n"] for r in rows])
    return pa.table({"block": pa.array([r["block"] for r in rows], pa.int64()),
                     "shard": pa.array([r["shard"] for r in rows], pa.int64()),
                     "bits": pa.array([np.packbits(many[e - r["n"]:e]).tobytes() for r, e in zip(rows, ends)],
                                      pa.binary())})


def _sketch(window: int, shards: int, bits: int):
    def run(batches):
        for b in batches:
            for number, data in zip(b.column("block").to_pylist(), b.column("data")):
                blk = Block(data.as_py(), window)
                for row in range(DEPTH):
                    yield pa.RecordBatch.from_pylist(
                        list(entries(number, row * shards, shards, bits, blk.cells(row, bits))), ENTRY)
    return run


def _pairs(replies: pa.Table) -> list[tuple[int, bytes]]:
    return list(zip(replies.column("shard").to_pylist(), replies.column("bits").to_pylist()))


def _exact(window: int, shards: int, bits: int, exact_shards: int):
    """A block and its replies to its entries; they are numbered behind the estimates."""
    def run(block: pa.Table, replies: pa.Table) -> pa.Table:
        rows = []
        for number, data in zip(block.column("block").to_pylist(), block.column("data")):
            blk = Block(data.as_py(), window)
            some = blk.estimated(shards, bits, _pairs(replies))
            rows += entries(number, DEPTH * shards, exact_shards, 64, blk.keys[0][some], blk.keys[1][some])
        return pa.Table.from_pylist(rows, ENTRY)
    return run


def _remove(window: int, shards: int, bits: int, exact_shards: int, kind: pa.DataType):
    schema = pa.schema([("doc_id", kind), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def repeated(blk: Block, pairs) -> np.ndarray:
        some = np.nonzero(blk.estimated(shards, bits, pairs))[0]
        a, b = blk.keys[0][some], blk.keys[1][some]
        order = np.lexsort((b, a))
        new = np.ones(len(some), bool)
        new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
        flags = unpack(pairs, DEPTH * shards, exact_shards, 64, a[order][new])
        out = np.zeros(len(some), bool)
        out[order] = flags[np.cumsum(new) - 1]
        return blk.inside[some[out]]

    def run(block: pa.Table, replies: pa.Table) -> pa.Table:
        pairs, out = _pairs(replies), []
        for ids, data in zip(block.column("doc_ids").to_pylist(), block.column("data")):
            raw = data.as_py()
            blk = Block(raw, window)
            change = np.zeros(len(blk.starts) + 1, np.int64)
            at = repeated(blk, pairs)
            np.add.at(change, at, 1)
            np.add.at(change, at + window, -1)
            covered = np.cumsum(change[:-1]) > 0
            n_words = np.bincount(blk.doc, minlength=len(ids))
            removed = np.bincount(blk.doc[covered], minlength=len(ids))
            kept = raw.split(b"\n")[:-1]
            first = np.concatenate(([0], np.cumsum(n_words)))
            for d in np.nonzero(removed)[0].tolist():
                stay = ~covered[first[d]:first[d + 1]]
                kept[d] = b" ".join(w for w, s in zip(kept[d].split(b" "), stay.tolist()) if s)
            out.append(pa.table([pa.array(ids, kind), pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()),
                                 pa.array(kept, pa.binary()).cast(pa.string())], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()
    return run


def power_of_two(n: float) -> int:
    return 1 << max(0, int(np.ceil(np.log2(max(n, 1)))))


def remove_repeats(docs: DataFrame, window: int = WINDOW, block_bytes: int | None = None,
                   shard_entries: int | None = None, min_shards: int = MIN_SHARDS,
                   cells_per_window: float = CELLS_PER_WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words (one space between) for each row.
    Sizes that are not given come from ``layout``; none changes the result."""
    ship_package(docs.sparkSession)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    if block_bytes is None or shard_entries is None:
        text_bytes = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
        sizes = layout(text_bytes)
        block_bytes, shard_entries = block_bytes or sizes[0], shard_entries or sizes[1]
    id_type = docs.schema["doc_id"].dataType
    kind, ddl = to_arrow_type(id_type), id_type.simpleString()
    spark = docs.sparkSession
    with arrow_bytes(spark, block_bytes):
        blocks = written(docs.mapInArrow(
            _blocks(block_bytes, kind, window),
            f"block bigint, n_windows bigint, doc_ids array<{ddl}>, data binary"), "blocks", group_rows=GROUP_BLOCKS)
    total = blocks.agg(F.sum("n_windows")).first()[0] or 0
    shards = power_of_two(max(min_shards, total / shard_entries))
    bits = max(int(cells_per_window * power_of_two(total)).bit_length() - 1, shards.bit_length() - 1, 1)

    def exchanged(rows: DataFrame, name: str) -> DataFrame:
        """Merged bits of each block and shard."""
        with arrow_bytes(spark, block_bytes):
            return written(rows.groupBy("shard").applyInArrow(merge, "block bigint, shard bigint, bits binary"), name)

    def with_replies(columns: list[str], replies: DataFrame, run, ddl: str) -> DataFrame:
        return blocks.select("block", *columns).groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(run, ddl)

    estimates = exchanged(blocks.select("block", "data").mapInArrow(
        _sketch(window, shards, bits), ENTRY_DDL), "estimates")
    exact = exchanged(with_replies(["data"], estimates, _exact(window, shards, bits, shards), ENTRY_DDL), "exact")
    return with_replies(["doc_ids", "data"], estimates.unionByName(exact), _remove(window, shards, bits, shards, kind),
                        f"doc_id {ddl}, n_words bigint, n_removed bigint, kept string")
