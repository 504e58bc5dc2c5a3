from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from ragtide import session
from ragtide.llm import substring_dedup


def brute(docs, n):
    seen = Counter()
    lists = [(i, (t or "").encode().split()) for i, t in docs]
    for _, w in lists:
        seen.update(tuple(w[k:k + n]) for k in range(len(w) - n + 1))
    out = []
    for i, w in lists:
        gone = set()
        for k in range(len(w) - n + 1):
            if seen[tuple(w[k:k + n])] > 1:
                gone.update(range(k, k + n))
        out.append((str(i), len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out)


@pytest.mark.parametrize("window, limits", [
    (35, {}),
    (35, {"block_bytes": 20_000, "cells_per_window": 0.5, "min_shards": 2, "shard_entries": 5000}),
    (3, {"block_bytes": 100_000, "min_shards": 4}),
])
def test_equals_brute_force(spark, documents, with_clashes, window, limits):
    odd = ["x " * 35, "x " * 36, "y " * 35 + "z", "y " * 36, " ".join(map(str, range(34))), "a" * 9000 + " b"]
    docs = documents.select("doc_id", "text").unionByName(
        spark.createDataFrame([(5000 + i, t) for i, t in enumerate(odd)], "doc_id bigint, text string"))
    rows = substring_dedup.remove_repeats(with_clashes(docs), window=window, **limits).collect()
    want = brute([tuple(r) for r in docs.collect()], window)
    assert sorted((str(r[0]), *r[1:]) for r in rows) == want


def test_exchange_rows_follow_the_text():
    sizes = [substring_dedup.layout(n) for n in (0, 1 << 30, 30 << 30, 256 << 30, 1 << 40, 100 << 40)]
    assert sizes[0] == sizes[1] == sizes[2] == (4 << 20, 1 << 20)
    assert sizes[-2] == sizes[-1] == (16 << 20, 4 << 20)
    for n, (block, entries) in zip((30 << 30, 256 << 30, 1 << 40), sizes[2:5]):
        assert block * entries >= substring_dedup.VALUES_A_ROW * n


def test_empty_and_wordless(spark, empty_docs):
    assert substring_dedup.remove_repeats(empty_docs).count() == 0
    blank = spark.createDataFrame([(1, None), (2, " "), (3, "")], "doc_id bigint, text string")
    assert sorted(map(tuple, substring_dedup.remove_repeats(blank).collect())) == [(i, 0, 0, "") for i in (1, 2, 3)]


def test_blocks_are_held_one_by_one(spark, documents, monkeypatch):
    """Row groups and Arrow batches hold few blocks, however many a partition has."""
    frames = {}

    def written(df, name, **options):
        frames[name] = session.written(df, name, **options)
        return frames[name]

    monkeypatch.setattr(substring_dedup, "written", written)
    docs = documents.select("doc_id", "text").coalesce(1)
    substring_dedup.remove_repeats(docs, block_bytes=10_000, shard_entries=5000, min_shards=2)
    sizes = []
    for f in frames["blocks"].inputFiles():
        meta = pq.ParquetFile(f.removeprefix("file://")).metadata
        sizes += [meta.row_group(i).num_rows for i in range(meta.num_row_groups)]
    assert len(sizes) > 10 and max(sizes) <= substring_dedup.GROUP_BLOCKS
    rows = spark.range(100, numPartitions=1).selectExpr("repeat('x', 1000) AS t")
    count = lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches)
    with session.arrow_bytes(spark, 4000):
        assert max(r.n for r in rows.mapInArrow(count, "n bigint").collect()) < 10
    assert rows.mapInArrow(count, "n bigint").first().n == 100
