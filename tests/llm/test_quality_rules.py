import math
from collections import Counter

from ragtide.llm import quality_rules
from ragtide.llm.common import WS


def split_words(text):
    for c in WS[1:]:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def slow_base(text):
    text = text or ""
    words = split_words(text)
    lines = [x for x in text.split("\n") if split_words(x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    covered = set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered.update(range(i, i + 8))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(covered), len(words) < 20 or 100 * len(covered) > 30 * len(words))


def test_base_columns_and_repeats(spark, documents, labels, with_clashes):
    rows = documents.select("doc_id", "text").collect()
    want = sorted((str(r.doc_id), *slow_base(r.text)) for r in rows)
    got = quality_rules.quality_rules(with_clashes(documents), labels).collect()
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                   r.base_failed) for r in got) == want
    assert all(not r.kept for r in got if r.base_failed)


def test_scores_equal_brute_force(spark, labels):
    from pyspark.sql import functions as F

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(80).select("doc_id", "text")
    hashed = quality_rules.with_hashes(docs.select("doc_id", quality_rules.words_of(F.col("text")).alias("_w")))
    buckets = {r.doc_id: r.b for r in hashed.select("doc_id", quality_rules.ngram_buckets(
        F.col("_wh"), F.col("_wp"), 1 << 12).alias("b")).collect()}
    good = {r.doc_id for r in labels.collect() if r.quality == 1}
    raw, trusted = Counter(), Counter()
    for i, b in buckets.items():
        raw.update(b)
        if i in good:
            trusted.update(b)
    n, g = sum(raw.values()), sum(trusted.values())
    share, prior = g / n, quality_rules.PRIOR
    weight = {b: round(math.log((trusted[b] + prior * share) / ((raw[b] + prior) * share)) * (1 << 20)) for b in raw}
    for r in quality_rules.quality_rules(docs, labels, n_buckets=1 << 12).collect():
        b = buckets[r.doc_id]
        assert abs(r.llr - sum(weight[x] for x in b) / (1 << 20) / max(1, len(b))) < 1e-5
        assert r.kept == (not r.base_failed and r.llr >= quality_rules.THRESHOLD)


def test_labelled_documents(spark, sf):
    """At a larger scale: good labels stay, bad ones go."""
    big = sf.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{big}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_rules.quality_rules(docs, labels).join(labels, "doc_id").collect()
    good = [r for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.995 * len(good)
    assert sum(r.kept for r in bad) <= 0.1 * len(bad)


def test_filter_and_odd_tables(spark, documents, labels, with_clashes, empty_docs):
    docs = with_clashes(documents)
    kept = quality_rules.keep_good(docs, labels)
    assert kept.columns == docs.columns
    verdicts = quality_rules.quality_rules(documents, labels).where("kept").collect()
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in verdicts)
    assert quality_rules.quality_rules(empty_docs, labels).count() == 0
    odd = spark.createDataFrame([(None, 1), (5, None), (5, 0), (5, 1)], "doc_id bigint, quality int")
    assert quality_rules.trusted_sample(odd).count() == 0
    none = quality_rules.quality_rules(documents, odd.limit(0)).collect()
    assert all(r.llr == 0 and r.kept == (not r.base_failed) for r in none)
    sample = quality_rules.trusted_sample(labels, 20)
    assert 0 < sample.count() < 45 and sample.collect() == quality_rules.trusted_sample(labels, 20).collect()


def test_all_trusted_documents_count(spark):
    many = spark.range(150_000).selectExpr("id AS doc_id", "1 AS quality")
    assert quality_rules.trusted_sample(many).count() == 150_000
    assert quality_rules.trusted_sample(many.limit(3), 0).count() == 0


def test_buckets_follow_the_text(spark, documents, labels, empty_docs):
    total = sum(len((r.text or "").encode()) for r in documents.collect())
    n = quality_rules.bucket_count(documents, 64, 16)
    assert n * 64 >= total > n * 32 and n & (n - 1) == 0
    assert quality_rules.bucket_count(empty_docs, 64, 16) == 16
    near, far = (sorted(map(str, quality_rules.quality_rules(documents, labels, n_buckets=1 << 12, max_broadcast=m).collect()))
                 for m in (1 << 12, 0))
    assert near == far


def test_verdicts_across_a_doubling_of_the_buckets(spark, sf):
    """The bucket count follows the text: few verdicts may move with it."""
    big = sf.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{big}/{t}.parquet") for t in ("documents", "labels"))
    a, b = ({r.doc_id: r.kept for r in quality_rules.quality_rules(docs, labels, n_buckets=n).collect()}
            for n in (1 << 16, 1 << 17))
    assert a.keys() == b.keys() and sum(a[i] != b[i] for i in a) <= 0.005 * len(a)
