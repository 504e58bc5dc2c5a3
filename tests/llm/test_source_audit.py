import re
from collections import Counter, defaultdict

import pytest

from ragtide.llm import source_audit

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def brute(rows, min_docs, top=50):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        found = Counter(terms_of(text))
        counts[lang or "", source or ""].update(found)
        docs[lang or ""].update(found.keys())
    out = []
    for lang in {g[0] for g in counts}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        groups = {s: c for (x, s), c in counts.items() if x == lang}
        whole = sum(groups.values(), Counter())

        def share(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p, q = {s: share(c) for s, c in groups.items()}, share(whole)
        for s, c in groups.items():
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in groups if o != s]
            more = [(t, p[s][t] - q[t]) for t in kept if c[t] and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", more)):
                items = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(items)
                        if part == "pair" or k < top]
    return sorted(out)


@pytest.fixture(scope="module")
def rows(documents):
    more = [("Straße ÉTÉ KK  x\x85y", "de", "s1"), ("a b a", None, None), (None, None, "s1"),
            (None, "none", "only"), ("!!", "void", "s1"), ("", "void", "s2"), (None, "void", "")]
    more += [("hot " * k + f"t{k % 7}", "hot", f"s{k % 41}") for k in range(200)]
    found = [tuple(r) for r in documents.select("text", "lang", "source").collect()] + more
    return found, documents.sparkSession.createDataFrame(found, "text string, lang string, source string")


@pytest.mark.parametrize("limits", [{}, {"held": 100, "block_rows": 50, "tile": 3, "step": 7}])
def test_equals_brute_force(rows, with_clashes, limits):
    found, df = rows
    got = source_audit.audit(with_clashes(df), min_docs=5, top=8, **limits)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == brute(found, 5, 8)


def test_exact_beyond_64_bits(spark):
    n = spark.sql("select 4000000000000 as n, 9000000000000 as total, 7 as kept")
    assert n.select(source_audit.share("n", "total", "kept")).first()[0] == 1 + 10**9 * (4 * 10**12 + 5) // (9 * 10**12 + 35)


def test_empty(empty_docs):
    assert source_audit.audit(empty_docs).collect() == []
