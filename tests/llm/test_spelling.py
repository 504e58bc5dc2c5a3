import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from ragtide.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counted(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in RUN.findall((text or "").translate({i: i + 32 for i in range(65, 91)})):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            found[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    return found


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def brute(rows, min_length=7, min_count=2):
    n = {w: k for w, k in counted(rows).items() if len(w) >= min_length and k >= min_count}
    near = {w: [v for v in n if abs(len(v) - len(w)) < 2 and one_edit(v, w)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w], root(w), n[w], len(near[w]), form[w] and n[form[w]]) for w in n)


def result(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def rows(documents):
    rng = random.Random(3)
    found = [tuple(r) for r in documents.where("doc_id < 30 or doc_id >= 900 or doc_id is null").select("doc_id", "text").collect()]
    chain = ["steadily"] * 3 + ["steadilyy"] * 50 + ["steadilyyy"] * 900
    letters = "aéêz"
    words = chain + ["".join(rng.choice(letters) for _ in range(rng.randrange(7, 9))) for _ in range(600)] * 2
    words += ["aaaaaaaa", "aaaaaaa", "aaaaaab", "a" * 300, "a" * 301, "b" + "a" * 299, "ÉTÉÉTÉÉ", "étéétéé", "Kelvinsign"] * 2
    rng.shuffle(words)
    found += [(5000 + i, " ".join(words[i::7]) + " x1y,Straßenbahn strassenbahn") for i in range(7)]
    return found + found[-2:]


@pytest.mark.parametrize("limits", [{}, {"shard_words": 20, "batch": 7}])
def test_equals_brute_force(spark, rows, with_clashes, limits):
    df = with_clashes(spark.createDataFrame(rows, "doc_id bigint, text string"))
    want = brute(rows)
    assert result(spelling.variants(df, **limits)) == want
    assert sum(r[4] > 0 for r in want) > 100 and any(r[1] and r[1] != r[2] for r in want)


def test_full_leaves_are_cut(spark):
    """More words with one vector than a shard holds."""
    rng, letters = random.Random(1), list("abcdefgh")
    words = {"".join(rng.sample(letters, 8)) for _ in range(300)} | {"abcdefghi", "abcdefg"}
    rows = [(i, w + " " + w) for i, w in enumerate(sorted(words))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert result(spelling.variants(df, shard_words=10)) == brute(rows)


def test_long_runs_and_empty(spark, empty_docs):
    rows = [(1, "é" * 100_000 + " " + "é" * 100_000), (2, "é" * 99_999 + " " + "é" * 99_999), (3, None), (4, "")]
    got = result(spelling.variants(spark.createDataFrame(rows, "doc_id bigint, text string")))
    n = counted(rows)
    assert [(len(r[0]), r[3], r[4]) for r in got] == sorted((len(w), k, 1) for w, k in n.items() if k > 1)
    assert spelling.variants(empty_docs).collect() == []


def test_walk_spends_one_of_each():
    words = spelling.Words(pa.array(["aabbcc", "abbccc", "aabcc", "abcc", "bbbccc", "aabbccd"]))
    paths = words.path[[1, 2, 0, 3, 4, 5]]
    order = sorted(range(len(paths)), key=lambda i: paths[i].tolist())
    query, leaf, lost, gained = spelling.walk(spelling.trie(paths[order]), words.path[:1])
    found = {(order[x], a, b) for x, a, b in zip(leaf.tolist(), lost.tolist(), gained.tolist())}
    # itself, one b less, and one a less with one c more; gains alone are met from the other word
    assert found == {(2, -1, -1), (1, 1, -1), (0, 0, 2)}
