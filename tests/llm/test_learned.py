"""The two learned operators: held-out accuracy and odd tables."""

import zlib

import pytest

from ragtide.llm import language, quality_model

BIG = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def big(spark):
    return spark.read.parquet(f"{BIG}/documents.parquet"), spark.read.parquet(f"{BIG}/labels.parquet")


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_quality_on_held_out_rows(big):
    docs, labels = big
    rows = quality_model.quality_scores(docs, labels).collect()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert len(rows) == docs.count()
    assert all(r.held_out == is_held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    out = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    good, bad = ([s for s, q in out if q == k] for k in (1, 0))
    assert sum(a > b for a in good for b in bad) >= 0.98 * len(good) * len(bad)


def test_quality_ignores_other_columns_and_held_out_labels(spark, big):
    from pyspark.sql import functions as F

    docs, labels = big
    docs = docs.limit(150)
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    flipped = labels.withColumn("quality", F.when(quality_model.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a = sorted(quality_model.quality_scores(docs, labels).collect())
    assert a == sorted(quality_model.quality_scores(other, flipped).collect())


def test_quality_odd_tables(documents, labels, with_clashes, empty_docs):
    rows = quality_model.quality_scores(with_clashes(documents), labels).collect()
    assert len(rows) == documents.count()
    same = {r.score for r in rows if r.doc_id == 905}
    assert len(same) == 1
    assert quality_model.quality_scores(empty_docs, labels).count() == 0
    assert {r.score for r in quality_model.quality_scores(documents, labels.limit(0)).collect()} == {0.5}


def test_ftrl_separates_and_dot_products_are_sparse():
    import numpy as np

    texts = [b"good words here now", b"bad!! words!! here!!"] * 30
    w = quality_model.ftrl(texts, np.array([1, 0] * 30))
    s = quality_model.sigmoid(quality_model.margins(texts[:2] + [b""], w[:-1], w[-1]))
    assert s[0] > 0.9 and s[1] < 0.1 and 0 < s[2] < 1
    by_hand = w[-1]
    for bucket, _ in quality_model.features([texts[0]]):
        by_hand += quality_model.SCALE * w[bucket].mean() if len(bucket) else 0
    assert abs(quality_model.sigmoid(by_hand) - s[0]) < 1e-9


def test_ftrl_equals_a_plain_loop(big):
    """Bucket by bucket, in dictionaries, one text after the other."""
    import math
    from collections import Counter

    import numpy as np

    docs, labels = big
    rows = docs.join(labels, "doc_id").where("quality IS NOT NULL").orderBy("doc_id").limit(60).collect()
    texts, truth = [(r.text or "").encode() for r in rows], [float(r.quality) for r in rows]
    q = quality_model
    z, n = Counter(), Counter()

    def weight(i):
        if abs(z[i]) <= q.L1:
            return 0.0
        return -(z[i] - math.copysign(q.L1, z[i])) / ((q.BETA + math.sqrt(n[i])) / q.ALPHA + q.L2)

    for _ in range(q.EPOCHS):
        for text, y in zip(texts, truth):
            x = Counter({1 << q.HASH_BITS: 1.0})
            for buckets, _ in q.features([text]):
                for b in buckets.tolist():
                    x[b] += q.SCALE / len(buckets)
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-min(35, max(-35, sum(w[i] * v for i, v in x.items())))))
            for i, v in x.items():
                g = (p - y) * v
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / q.ALPHA * w[i]
                n[i] += g * g
    got = q.ftrl(texts, np.array(truth))
    want = np.array([weight(i) for i in range(len(got))])
    assert np.count_nonzero(want) > 100 and abs(got - want).max() < 1e-6


def test_quality_of_an_id_with_many_rows(spark, big):
    """Equal rows count once; an id with many texts stays within the bound."""
    docs, labels = big
    docs = docs.select("doc_id", "text").limit(200)
    hot = docs.where("text IS NOT NULL").join(labels.where("quality = 1").select("doc_id"), "doc_id").where(
        ~quality_model.held_out()).limit(1)
    once = quality_model.train(docs, labels)
    copies = docs.unionByName(hot.selectExpr("doc_id", "text", "explode(sequence(1, 3000)) AS n").drop("n"))
    assert (quality_model.train(copies, labels) == once).all()
    texts = docs.unionByName(hot.selectExpr("doc_id", "explode(sequence(1, 3000)) AS n").selectExpr(
        "doc_id", "concat('some words of text ', n) AS text"))
    few = quality_model.train(texts, labels, max_rows=200)
    assert few.any() and few[-1] > once[-1]
    long = spark.createDataFrame([(i, "word%d x!! " % i * 40_000) for i in range(2)], "doc_id bigint, text string")
    marks = spark.createDataFrame([(0, 1), (1, 0)], "doc_id bigint, quality int")
    scores = {r.doc_id: r.score for r in quality_model.quality_scores(long, marks).collect()}
    assert len(scores) == 2 and all(0 <= s <= 1 for s in scores.values())


def test_language_equals_a_plain_version(spark, big):
    """Counts, logs and the backoff by definition, in dictionaries."""
    import math
    from collections import Counter

    docs = big[0].limit(250).cache()
    rows = docs.collect()
    words, pieces = Counter(), Counter()
    for r in rows:
        if r.lang is not None and r.text and not is_held_out(r.doc_id):
            for w in language.words_of(r.text):
                words[r.lang, w] += 1
                for a in range(len(w) + 2):
                    for b in range(a + 1, min(a + language.MAX_GRAM, len(w) + 2) + 1):
                        pieces[r.lang, f" {w} "[a:b]] += 1
    words, pieces = ({k: n for k, n in t.items() if n >= language.MIN_COUNT} for t in (words, pieces))
    langs = sorted({lang for lang, _ in words} | {lang for lang, _ in pieces})
    known, grams = {w for _, w in words}, {p for _, p in pieces}
    sizes = Counter(map(len, grams))
    word_total = {lang: sum(n for (x, _), n in words.items() if x == lang) for lang in langs}
    gram_total = Counter()
    for (lang, p), n in pieces.items():
        gram_total[lang, len(p)] += n

    def log_word(lang, w):
        return math.log((words.get((lang, w), 0) + language.ALPHA) / (word_total[lang] + language.ALPHA * len(known)))

    def log_gram(lang, p):
        return math.log((pieces.get((lang, p), 0) + language.ALPHA)
                        / (gram_total[lang, len(p)] + language.ALPHA * sizes[len(p)]))

    def score(lang, w):
        if w in known:
            return log_word(lang, w)
        w, found = f" {w} ", []
        for i in range(len(w)):
            longest = next((w[i:e] for e in range(min(i + language.MAX_GRAM, len(w)), i, -1) if w[i:e] in grams), None)
            found += [log_gram(lang, longest)] if longest else []
        return sum(found) / len(found) if found else 0.0

    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(docs).collect()}
    for r in rows:
        seen = Counter(language.words_of(r.text))
        if not seen:
            assert got[r.doc_id] == ("und", 0.0)
            continue
        sums = {lang: sum(n * score(lang, w) for w, n in seen.items()) for lang in langs}
        best = max(langs, key=lambda lang: sums[lang])
        share = 1 / sum(math.exp(min(0.0, s - sums[best])) for s in sums.values())
        assert got[r.doc_id][0] == best and abs(got[r.doc_id][1] - share) < 1e-2


def test_language_ties_go_to_the_first(spark):
    rows = [(i, "alpha beta gamma", lang) for i, lang in enumerate(["bb", "aa"] * 40)]
    # as many learned rows on both sides
    rows = [r for r in rows if not is_held_out(r[0])]
    n = min(sum(r[2] == x for r in rows) for x in ("aa", "bb"))
    rows = [r for x in ("aa", "bb") for r in [r for r in rows if r[2] == x][:n]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert {(r.lang_pred, round(r.score, 6)) for r in language.predict(docs).collect()} == {("aa", 0.5)}


def test_language_on_held_out_rows(big):
    docs, _ = big
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = language.predict(docs).collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == is_held_out(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)


def test_language_odd_tables(spark, documents, with_clashes, empty_docs):
    rows = language.predict(with_clashes(documents)).collect()
    assert len(rows) == documents.count()
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in rows if r.doc_id in (900, 901, 902, 907))
    assert language.predict(empty_docs).count() == 0
    df = spark.createDataFrame([(1, "word 12", None), (2, "1234 !!", None), (3, None, "en")],
                               "doc_id bigint, text string, lang string")
    assert {r.lang_pred for r in language.predict(df).collect()} == {"und"}


def test_backoff_scores():
    rows = [{"kind": "word", "piece": "the", "lang": "en", "n": 9}, {"kind": "word", "piece": "le", "lang": "fr", "n": 9},
            {"kind": "gram", "piece": "th", "lang": "en", "n": 9}, {"kind": "gram", "piece": " l", "lang": "fr", "n": 9},
            {"kind": "gram", "piece": "e", "lang": "fr", "n": 4}]
    m = language.Model(rows, ["en", "fr"])
    known, unseen, none = m.score(["the", "then", "xx"])
    assert known.tolist() == m.logs[m.words["the"]].tolist()
    # "then": th is known as a pair, e alone, the rest is skipped
    want = (m.logs[m.grams["th"]].astype(float) + m.logs[m.grams["e"]].astype(float)) / 2
    assert abs(unseen - want).max() < 1e-6 and none.tolist() == [0, 0]


def test_a_rare_language_is_learned_beside_a_hot_one(spark):
    rows = [(i, "the house is on the hill and the road", "en") for i in range(4000)]
    rows += [(5000 + i, "talo on mäellä ja tie vie kotiin", "fi") for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = language.predict(docs, max_rows=40).groupBy("lang_pred").count().collect()
    assert {r.lang_pred: r["count"] for r in got} == {"en": 4000, "fi": 24}
