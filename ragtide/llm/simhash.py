"""SimHash near-duplicates: links at ``max_bits`` differing bits, found through
vantage-point trees.

Steps, each a Spark job over a written table:

1. one 64-bit fingerprint per document (Arrow batches, numpy), then one row per
   distinct fingerprint: exact copies meet in a map-side aggregate, so a group
   of copies of any size is one point;
2. a vantage-point tree is built on the driver from a bounded sample of distinct
   fingerprints; it only routes. Every fingerprint goes to the shard on its side
   of each ball, and also outside when it lies within ``max_bits`` of the ball's
   surface: by the triangle inequality two points further apart than that in
   their distance to the vantage point cannot link, so every linked pair meets
   in a shard;
3. each shard repeats the split on its own points down to small blocks, compares
   those exactly, and returns a spanning forest, not the pairs;
4. forests are merged to components by minimum labels and pointer jumping.

A shard that outgrows ``hot_shard`` points (one dense cloud of near copies) is
linked by an exact detour without all pairs: two fingerprints differ in at most
two bits when some fingerprint differs from both in at most one, so each point
emits its 65 neighbours and points that share one are linked.

Defined cases: a null or blank text has fingerprint 0 and links like any other;
repeated rows come back as often as they came; a null ``doc_id`` is kept and
does not name a component unless the whole component has none; an empty table
gives an empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragtide.session import ship_package

from .common import join_on_key, keyed, row_key, rows_of, written

SHINGLE, MAX_BITS = 3, 2
#: Bound of the driver-side sample that the routing tree is built from.
SAMPLE, SAMPLE_SHARE = 1 << 16, 1 / 8
SHARD, BLOCK, HOT_SHARD = 2048, 512, 8192
SEED = 42


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the lower-cased word shingles of a UTF-8 text."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], SEED) for a, b in
                  zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())],
                 np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        part = h[i:i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << i for i in np.nonzero(2 * ones > len(h))[0].tolist())


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").cast(pa.binary())
            fps = np.array([fingerprint(t.as_py(), shingle) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("_h"), pa.array(fps.view(np.int64))], ["doc_id", "_h", "fp"])
    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, a hash of the text and ``fp`` (as a signed long) for each row."""
    ship_package(docs.sparkSession)
    docs = docs.select("doc_id", row_key()[1], F.col("text").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(_fingerprints(shingle), f"doc_id {kind}, _h bigint, fp bigint")


# -- vantage-point splits -----------------------------------------------------

def bits(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


def best_split(points: np.ndarray, max_bits: int, tries: int = 8):
    """(vantage point, radius) with the fewest copies, or None when no ball
    divides the points well enough to pay for the copies at its surface."""
    best = None
    for v in points[np.linspace(0, len(points) - 1, tries).astype(int)]:
        counts = np.bincount(bits(points, v), minlength=65)
        inside = np.cumsum(counts)
        # radius r: inside[r] points within, and from r - max_bits + 1 on outside
        for r in range(64):
            outside = len(points) - (inside[r - max_bits] if r >= max_bits else 0)
            worst = max(inside[r], outside)
            cost = inside[r] + outside - len(points)
            if worst <= 0.75 * len(points):
                key = (cost / len(points) + abs(int(inside[r]) - int(outside)) / len(points) / 2)
                if best is None or key < best[0]:
                    best = (key, np.uint64(v), r)
    return best and best[1:]


def sides(points: np.ndarray, v: np.uint64, r: int, max_bits: int):
    d = bits(points, v)
    return d <= r, d > r - max_bits


def build_tree(sample: np.ndarray, leaf: int, max_bits: int):
    """Nested (v, r, inside, outside); a leaf is None."""
    if len(sample) <= leaf or (split := best_split(sample, max_bits)) is None:
        return None
    a, b = sides(sample, *split, max_bits)
    return (*split, build_tree(sample[a], leaf, max_bits), build_tree(sample[b], leaf, max_bits))


def route(points: np.ndarray, tree, max_bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf number, its points); numbers follow the tree, whatever the points."""
    number = 0

    def visit(p, node):
        nonlocal number
        if node is None:
            number += 1
            if len(p):
                yield number - 1, p
            return
        v, r, inside, outside = node
        a, b = sides(p, v, r, max_bits)
        yield from visit(p[a], inside)
        yield from visit(p[b], outside)

    yield from visit(points, tree)


# -- exact links inside a shard -------------------------------------------------

def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n points over the links a-b."""
    parent = np.arange(n)
    while len(a):
        ra, rb = parent[a], parent[b]
        far = ra != rb
        if not far.any():
            break
        a, b, ra, rb = a[far], b[far], ra[far], rb[far]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while (up := parent[parent]).tolist() != parent.tolist():
            parent = up
    return parent


def ball_links(points: np.ndarray, limit: int = 1 << 22):
    """Links (at most 2 bits) between neighbours that share a point at one bit;
    passes over slices of the key space bound the memory."""
    flips = np.concatenate(([0], np.uint64(1) << np.arange(64, dtype=np.uint64))).astype(np.uint64)
    passes = max(1, -(-65 * len(points) // limit))
    for k in range(passes):
        keys, owner = [], []
        for f in flips:
            z = points ^ f
            mine = np.nonzero((z * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(passes) == k)[0]
            keys.append(z[mine])
            owner.append(mine)
        z, i = np.concatenate(keys), np.concatenate(owner)
        o = np.argsort(z, kind="stable")
        same = z[o][1:] == z[o][:-1]
        yield i[o][:-1][same], i[o][1:][same]


def forest(points: np.ndarray, max_bits: int = MAX_BITS, block: int = BLOCK):
    """(u, v) edges, u > v, that connect exactly what links within ``points``."""
    stack, us, vs = [points], [], []
    while stack:
        p = stack.pop()
        if len(p) > block and (split := best_split(p, max_bits)) is not None:
            a, b = sides(p, *split, max_bits)
            stack += [p[a], p[b]]
            continue
        p = np.sort(p)
        if len(p) <= block or max_bits != 2:
            links = []
            for i in range(0, len(p), block):
                x, y = np.nonzero(np.bitwise_count(p[i:i + block, None] ^ p[None, :]) <= max_bits)
                far = x + i < y
                links.append((x[far] + i, y[far]))
        else:
            links = list(ball_links(p))
        root = roots(len(p), *(np.concatenate(x) for x in zip(*links)))
        own = np.nonzero(root != np.arange(len(p)))[0]
        us.append(p[own])
        vs.append(p[root[own]])
    return np.concatenate(us), np.concatenate(vs)


# -- Spark steps --------------------------------------------------------------

def _edges(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    """Larger and smaller end as signed longs (their order is Spark's)."""
    u, v = u.view(np.int64), v.view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.maximum(u, v)), pa.array(np.minimum(u, v))], ["u", "v"])


def _route(tree, max_bits: int):
    def run(batches):
        for b in batches:
            p = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for k, members in route(p, tree, max_bits):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(members), k, np.int32)), pa.array(members.view(np.int64))], ["shard", "fp"])
    return run


def _shard_forest(max_bits: int, block: int):
    def run(table: pa.Table) -> pa.Table:
        p = np.unique(table.column("fp").to_numpy()).view(np.uint64)
        return pa.Table.from_batches([_edges(*forest(p, max_bits, block))])
    return run


def link_edges(points: DataFrame, max_bits: int = MAX_BITS, sample: int = SAMPLE, shard: int = SHARD,
               hot_shard: int = HOT_SHARD, block: int = BLOCK) -> DataFrame:
    """(u, v), u > v: edges that connect exactly the linked points (fp, distinct)."""
    ship_package(points.sparkSession)
    n = points.count()
    share = min(SAMPLE_SHARE, sample / max(n, 1))  # a fraction at every size
    picked = points.where(F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < int(share * (1 << 30))).select("fp")
    arr = np.array([r[0] for r in picked.collect()], np.int64)
    arr = np.sort(arr).view(np.uint64)
    tree = build_tree(arr, max(8, int(shard * share)), max_bits)
    routed = written(points.select("fp").mapInArrow(_route(tree, max_bits), "shard int, fp bigint"), "shards")
    # only the few shard numbers beyond the limit come to the driver
    hot = [r[0] for r in routed.groupBy("shard").count().where(F.col("count") > hot_shard).collect()]
    if max_bits != 2:
        hot = []
    edges = (routed.where(~F.col("shard").isin(hot)) if hot else routed).groupBy("shard").applyInArrow(
        _shard_forest(max_bits, block), "u bigint, v bigint")
    if hot:
        flips = F.concat(F.array(F.lit(0).cast("long")), F.transform(
            F.sequence(F.lit(0), F.lit(63)), lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i)))
        near = (routed.where(F.col("shard").isin(hot)).select("fp").distinct()
                .select("fp", F.explode(flips).alias("flip"))
                .select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("z")))
        # at most 65 fingerprints share a neighbour, so the lists are bounded
        edges = edges.unionByName(
            near.groupBy("z").agg(F.collect_set("fp").alias("m")).where(F.size("m") > 1)
            .select(F.array_min("m").alias("v"), F.explode("m").alias("u")).where("u > v").select("u", "v"))
    return edges.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v): v is the smallest point reachable from u; only for u that are not
    themselves the smallest. ``edges`` (u, v) has u > v."""
    e = written(edges, "edges")
    while True:
        least = e.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        if not least.where("n > 1").limit(1).count():
            break
        rest = e.join(least.where("n > 1"), "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = written(least.select("u", F.col("m").alias("v")).unionByName(rest).distinct(), "edges")
    while True:
        up = e.select(F.col("u").alias("v"), F.col("v").alias("top"))
        moved = written(e.join(up, "v", "left").select("u", F.coalesce("top", "v").alias("v"),
                                                       F.col("top").isNotNull().alias("moved")), "forest")
        e = moved.select("u", "v")
        if not moved.where("moved").limit(1).count():
            return e


def _grouped(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, **limits) -> DataFrame:
    fps = written(fingerprints(docs, shingle), "fingerprints")
    points = written(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "points")
    trees = components(link_edges(points, max_bits, **limits))
    members = written(points.join(trees, points.fp == trees.u, "left").select(
        "fp", "first", F.coalesce("v", "fp").alias("root")), "members")
    tops = written(members.groupBy("root").agg(F.min("first").alias("component_id")), "tops")
    return fps.join(members.join(tops, "root").select("fp", "root", "component_id"), "fp")


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, **limits) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id
    reachable over links of at most ``max_bits`` bits) for each row."""
    return _grouped(docs, shingle, max_bits, **limits).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, **limits) -> DataFrame:
    """``docs`` with one row of each group, that of the smallest doc_id (of
    several rows with this id in the group, the one with the smallest text hash; of
    rows in groups without any id, one for each fingerprint). An id that stands in
    several groups stays in each."""
    stay = (_grouped(docs, shingle, max_bits, **limits).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .groupBy("root", "component_id", F.when(F.col("doc_id").isNull(), F.col("fp")).alias("_lone"))
            .agg(F.min("_h").alias("_h")).select(F.col("component_id").alias("_id"), "_h").distinct())
    return rows_of(join_on_key(keyed(docs), stay, "left_semi").dropDuplicates(["_id", "_h"]))
