import numpy as np
import xxhash

from ragtide.llm import simhash


def slow_fingerprint(text):
    lowered = (text or "").translate({i: i + 32 for i in range(65, 91)})
    words = [w for w in lowered.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ")
             .replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    n = max(1, len(words) - 2)
    h = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_roots(points, bits=2):
    parent = list(range(len(points)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, p in enumerate(points):
        for j in range(i):
            if bin(p ^ points[j]).count("1") <= bits:
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    return [top(i) for i in range(len(points))]


def test_groups_equal_brute_force(spark, documents, with_clashes):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    fps = [slow_fingerprint(t) for _, t in rows]
    root = slow_roots(fps)
    first = {}
    for (i, _), r in zip(rows, root):
        if i is not None:
            first[r] = min(i, first.get(r, i))
    want = sorted((str(i), f"{f:016x}", str(first.get(r))) for (i, _), f, r in zip(rows, fps, root))
    for limits in ({}, {"shard": 16, "block": 4, "sample": 60}, {"shard": 16, "hot_shard": 10}):
        got = simhash.simhash_groups(with_clashes(documents), **limits).collect()
        assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want


def cloud(seed, n):
    """Clusters within few bits, far points, and chains of two-bit steps."""
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    out = list(rng.integers(0, 1 << 63, n, dtype=np.uint64))
    for c in centres:
        for _ in range(n):
            x = int(c)
            for b in rng.integers(0, 64, rng.integers(0, 5)).tolist():
                x ^= 1 << b
            out.append(np.uint64(x))
    chain = int(centres[0]) ^ 0xFF00FF
    for b in range(0, 60, 2):
        chain ^= 3 << b
        out.append(np.uint64(chain))
    return np.unique(np.array(out, np.uint64))


def partition(points, u, v):
    n = len(points)
    return simhash.roots(n, np.searchsorted(points, u), np.searchsorted(points, v)).tolist()


def test_forest_links_exactly():
    for seed in range(4):
        p = cloud(seed, 60)
        want = partition(p, *map(np.array, zip(*[(a, b) for i, a in enumerate(p) for b in p[:i]
                                                 if int(a ^ b).bit_count() <= 2])))
        assert partition(p, *simhash.forest(p, block=16)) == want
        i, j = (np.concatenate(x) for x in zip(*simhash.ball_links(p, limit=5000)))
        assert simhash.roots(len(p), i, j).tolist() == want


def test_linked_points_meet_in_a_shard():
    p = cloud(9, 80)
    tree = simhash.build_tree(p, 12, 2)
    assert tree is not None
    met = {}
    for k, members in simhash.route(p, tree, 2):
        for m in members.tolist():
            met.setdefault(m, set()).add(k)
    for i, a in enumerate(p.tolist()):
        for b in p.tolist()[:i]:
            if (a ^ b).bit_count() <= 2:
                assert met[a] & met[b]


def test_hot_shard_and_components_in_spark(spark):
    p = cloud(3, 40)
    frame = spark.createDataFrame([(int(x),) for x in p.view(np.int64).tolist()], "fp bigint")
    want = partition(p, *map(np.array, zip(*[(a, b) for i, a in enumerate(p) for b in p[:i]
                                             if int(a ^ b).bit_count() <= 2])))
    for limits in ({"hot_shard": 20, "shard": 30}, {"shard": 10}):
        pairs = simhash.components(simhash.link_edges(frame, **limits)).collect()
        top = {r.u: r.v for r in pairs}
        assert all(v not in top for v in top.values())
        got = [top.get(x, x) for x in p.view(np.int64).tolist()]
        same = {}
        for g, w in zip(got, want):
            assert same.setdefault(g, w) == w
        assert len(same) == len(set(want))


def test_keep_one(spark, documents, with_clashes, empty_docs):
    docs = with_clashes(documents)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    groups = {(r.doc_id, r.component_id) for r in simhash.simhash_groups(documents).collect()}
    want = {i for i, c in groups if i == c and i is not None}
    ids = [r.doc_id for r in rows if r.doc_id is not None]
    assert sorted(ids) == sorted(want)
    assert all(r.more == "kept more" for r in rows)
    assert simhash.keep_one(empty_docs).count() == 0
    assert simhash.simhash_groups(empty_docs).count() == 0


def test_one_id_in_two_groups(spark):
    """Each group keeps a row, also where one id names both."""
    a, b = (" ".join(f"{c}{i * i}" for i in range(60)) for c in "pq")
    docs = spark.createDataFrame([(1, a), (1, b), (2, b), (3, a)], "doc_id bigint, text string")
    assert sorted(tuple(r) for r in simhash.keep_one(docs).collect()) == [(1, a), (1, b)]
