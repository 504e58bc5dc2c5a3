import hashlib
import re

import pytest

from ragtide.llm import decontaminate

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split_words(text):
    return WORDS.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def brute(docs, items, window=13):
    windows = {}
    for i, t in items:
        w = split_words(t)
        if w:
            n = min(window, len(w))
            for k in range(len(w) - n + 1):
                windows.setdefault(n, {}).setdefault(tuple(w[k:k + n]), set()).add(i)
    out = []
    for i, t in docs:
        w, hit, found = split_words(t), set(), set()
        for n, by in windows.items():
            for k in range(len(w) - n + 1):
                if ids := by.get(tuple(w[k:k + n])):
                    hit.update(range(k, k + n))
                    found |= ids - {None}
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((str(i), len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


@pytest.fixture(scope="module")
def case(spark, sf, documents):
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    long = next(t for _, t in items if len(split_words(t)) > 20)
    items += [(500, "x y"), (501, "!!!"), (502, None), (None, "some words"), (503, "the the the"), (504, long),
              (504, "another text of the same item"), (505, "ÑANDÚ über KELVINK 日本語")]
    docs = [(1001, long.upper()), (1002, "a " * 500 + long), (1003, "the " * 40), (1004, "X, Y! z"),
            (1005, "ñandú ÜBER kelvinK 日本語"), (1006, "Ñandú Über kelvinK 日本語 ÑANDÚ über KELVINK 日本語"),
            (1007, " ".join(split_words(long)[:13])), (1008, " ".join(split_words(long)[:12]))]
    docs = documents.select("doc_id", "text").unionByName(spark.createDataFrame(docs, "doc_id bigint, text string"))
    return docs, spark.createDataFrame(items, "item_id bigint, text string")


@pytest.mark.parametrize("max_broadcast", [decontaminate.MAX_BROADCAST, 0])
def test_equals_brute_force(case, with_clashes, max_broadcast):
    docs, items = case
    got = decontaminate.contamination(with_clashes(docs), items, max_broadcast=max_broadcast).drop("_h").collect()
    want = brute([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()])
    assert sorted((str(r[0]), *r[1:]) for r in got) == want
    assert sum(x[-1] for x in want) >= 5


def test_items_without_an_id_hit_words(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma delta"), (2, "beta gamma zeta"), (3, "none")], "doc_id bigint, text string")
    items = spark.createDataFrame([(None, "beta gamma"), (None, "beta gamma"), (7, "gamma delta")], "item_id bigint, text string")
    got = {r.doc_id: (r.n_hit, r.n_items, r.contaminated) for r in decontaminate.contamination(docs, items).collect()}
    assert got == {1: (3, 1, True), 2: (2, 0, True), 3: (0, 0, False)}
    assert {r.doc_id for r in decontaminate.drop_contaminated(docs, items).collect()} == {3}


def test_oracle_agrees_on_items_without_an_id(case):
    import duckdb

    from ragtide.llm import oracle

    docs, items = case
    docs = docs.where("doc_id > 1000")  # the SQL copies a text for each of its words
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    con.register("benchmark", items.toPandas().astype({"item_id": "Int64"}))
    got = decontaminate.contamination(docs, items).drop("_h")
    want = con.execute(oracle.op7_decontaminate()).fetchdf()
    assert {tuple(r) for r in got.select(*want.columns).collect()} == {tuple(r) for r in want.itertuples(index=False)}


def test_stage_and_empty_tables(case, with_clashes, empty_docs):
    docs, items = case
    wide = with_clashes(docs)
    kept = decontaminate.drop_contaminated(wide, items)
    # an id may stand on several texts, each with its own verdict
    verdicts = decontaminate.contamination(docs, items).where("contaminated").select("doc_id", "_h").collect()
    bad = {tuple(r) for r in verdicts}
    assert kept.columns == wide.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        str(r[0]) for r in docs.select(*decontaminate.row_key()).collect() if tuple(r) not in bad)
    assert decontaminate.contamination(empty_docs, items).count() == 0
    clean = decontaminate.contamination(docs, items.limit(0)).collect()
    assert len(clean) == docs.count() and not any(r.contaminated or r.n_items for r in clean)


def test_no_python_in_the_plan(case):
    plan = decontaminate.contamination(*case)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan
