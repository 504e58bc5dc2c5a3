"""Rule statistics and a log-likelihood-ratio filter, all DataFrame functions.

Every document gets the base statistics of the rules and a score: the mean over
its hashed word n-grams of log(p_trusted / p_raw). ``p_raw`` is the multinomial
of all documents, ``p_trusted`` that of all trusted documents, both over
``n_buckets`` hash buckets, whose number follows the bytes of text. A document is kept when no base rule fails
and its score reaches ``threshold``, a constant: the verdict depends on the
corpus counts only, never on the rank of a document.

Scale: n-gram counts are aggregated map-side to ``n_buckets`` rows, and
per-document sums are integers, so that the result does not depend on the order
of addition. The weight table is broadcast up to ``max_broadcast`` buckets; beyond
it the buckets of each text, with their counts, are shuffled to their weights.
Texts are shuffled only when the trusted ids are too many to broadcast.

Defined cases: null or blank text has no words and fails the base rule; repeated
rows are judged alike and all come back; an empty table gives an empty result;
without trusted documents all weights are 0 and only the base rules decide;
only ``doc_id`` and ``text`` are read, other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ragtide.functions.text import runs
from ragtide.operators.topk import broadcast_if_small

from .common import join_on_key, keyed, let, row_key, rows_of, text_or_empty, words_of, written

#: Buckets at least; their number doubles until a bucket has no more text than this.
N_BUCKETS, BYTES_A_BUCKET = 1 << 16, 1 << 13
#: Weights are broadcast up to so many buckets.
MAX_BROADCAST = 1 << 21
#: A document may be this far below the corpus mean, in nats per n-gram.
THRESHOLD = -0.08
MIN_WORDS, WINDOW = 20, 8
#: N-grams of the raw corpus added to every bucket of both multinomials.
PRIOR, SCALE = 50, 1 << 20


def base_columns(text: Column) -> dict[str, Column]:
    """word_chars, n_symbols and n_dup_lines of a non-null text."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "")
    return {
        "n_symbols": F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
    }


def _joined(hashes: Column, step: int) -> Column:
    """Hash of each run with the run that starts ``step`` places later."""
    return let(hashes, lambda h: F.zip_with(
        h, F.slice(h, step + 1, F.greatest(F.size(h), F.lit(1))), lambda a, b: F.xxhash64(a, b)))


def repeat_words(pairs: Column) -> Column:
    """Words inside 8-word windows whose sequence occurs at least twice in the
    same text; ``pairs`` holds the hash of each word with the next one."""
    window = WINDOW

    def covered(starts):
        # sorted starts: each covers up to the next one, at most a window
        return F.aggregate(
            starts, F.struct(F.lit(0).alias("n"), F.lit(-window).alias("end")),
            lambda a, s: F.struct(
                (a["n"] + s + window - F.greatest(a["end"], s)).alias("n"),
                (s + window).alias("end")))["n"]

    def repeated(w):
        ordered = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        same = let(ordered, lambda o: F.filter(o, lambda e, k: (
            (F.get(o, k - 1)["x"] == e["x"]) | (F.get(o, k + 1)["x"] == e["x"]))))
        return covered(F.sort_array(F.transform(same, lambda e: e["i"])))

    def windows(p):
        return F.slice(_joined(_joined(p, 2), 4), 1, F.size(p) - (window - 1))

    return F.coalesce(F.when(F.size(pairs) > window, let(windows(pairs), lambda w: F.when(
        F.size(F.array_distinct(w)) < F.size(w), repeated(w)))), F.lit(0)).cast("long")


def ngram_buckets(hashes: Column, pairs: Column, n_buckets: int = N_BUCKETS) -> Column:
    """Buckets of the word unigrams and bigrams (the last word pairs with the end)."""
    return F.transform(F.concat(hashes, pairs), lambda x: F.pmod(x, F.lit(n_buckets)).cast("int"))


def with_hashes(df: DataFrame, words: str = "_w") -> DataFrame:
    """Adds _wh (a hash for each word) and _wp (one for it and the next word)."""
    return df.withColumn("_wh", F.transform(words, lambda w: F.xxhash64(w))).withColumn("_wp", _joined(F.col("_wh"), 1))


def bucket_count(docs: DataFrame, bytes_a_bucket: int = BYTES_A_BUCKET, least: int = N_BUCKETS) -> int:
    """The smallest doubling of ``least`` that holds all text of ``docs``. A document
    near the threshold may change its verdict when the corpus crosses a doubling: at
    10,000 documents 1 verdict differs between 2^16 and 2^17 buckets, 29 between 2^14
    and 2^20."""
    total = docs.agg(F.sum(F.octet_length(text_or_empty()).cast("long"))).first()[0] or 0
    while least * bytes_a_bucket < total:
        least *= 2
    return least


def trusted_sample(labels: DataFrame, max_trusted: int | None = None) -> DataFrame:
    """Ids labelled quality 1 and never 0: all of them, or at most about
    ``max_trusted``, chosen by a hash of the id (the same ones on every run)."""
    good = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
            .groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1"))
    if max_trusted is not None and (n := good.count()) > max_trusted:
        cut = int(max_trusted / n * (1 << 30))
        good = good.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < cut)
    return good.select(F.col("doc_id").alias("_tid"))


def ngram_weights(docs: DataFrame, trusted: DataFrame, n_buckets: int = N_BUCKETS) -> DataFrame:
    """(bucket, weight): log(p_trusted / p_raw), smoothed by ``PRIOR`` raw n-grams
    a bucket and scaled to an integer. ``trusted`` (``_tid``) has distinct ids."""
    marked = docs.select("doc_id", text_or_empty().alias("_t")).join(
        broadcast_if_small(trusted), F.col("doc_id") == F.col("_tid"), "left")
    # written, since both the totals and the weights read it
    words = with_hashes(marked.select(F.col("_tid").isNotNull().cast("int").alias("good"),
                                      words_of(F.col("_t")).alias("_w")))
    counts = written(words.select("good", F.explode(
        ngram_buckets(F.col("_wh"), F.col("_wp"), n_buckets)).alias("bucket"))
              .groupBy("bucket").agg(F.count("*").alias("n"), F.sum("good").alias("g")), "ngrams")
    total = counts.agg(F.sum("n").alias("n"), F.sum("g").alias("g")).first()
    n, g = total["n"] or 0, total["g"] or 0
    if not g:
        return counts.select("bucket", F.lit(0).cast("long").alias("weight"))
    # the trusted prior follows the raw corpus: rare buckets weigh next to nothing
    share = g / n
    ratio = F.log((F.col("g") + PRIOR * share) / ((F.col("n") + PRIOR) * share))
    return counts.select("bucket", F.round(ratio * SCALE).cast("long").alias("weight"))


def _scored(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, n_buckets: int | None = None,
            max_trusted: int | None = None, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    n_buckets = n_buckets or bucket_count(docs)
    weights = ngram_weights(docs, trusted_sample(labels, max_trusted), n_buckets)
    rows = (docs.select("doc_id", row_key()[1], text_or_empty().alias("_t"))
            .select(F.monotonically_increasing_id().alias("_row"), "doc_id", "_h", "_t",
                    words_of(F.col("_t")).alias("_w"))
            .select("_row", "doc_id", "_h", "_t", F.size("_w").cast("long").alias("n_words"),
                    F.length(F.concat_ws("", "_w")).cast("long").alias("word_chars"), "_w")
            .transform(with_hashes)
            .select("_row", "doc_id", "_h", "n_words", "word_chars",
                    *[c.alias(k) for k, c in base_columns(F.col("_t")).items()],
                    repeat_words(F.col("_wp")).alias("n_repeat_words"),
                    ngram_buckets(F.col("_wh"), F.col("_wp"), n_buckets).alias("_b")))
    keys = [c for c in rows.columns if c != "_b"]
    if n_buckets <= max_broadcast:
        mean = F.coalesce(F.sum("weight"), F.lit(0)) / SCALE / F.greatest(F.count("bucket"), F.lit(1))
        scored = (rows.select(*keys, F.explode_outer("_b").alias("bucket"))
                  .join(F.broadcast(weights), "bucket", "left").groupBy(*keys).agg(mean.alias("llr")))
    else:
        # by text: copies multiply both sums alike
        means = (rows.select("_h", F.explode(runs(F.col("_b"))).alias("r"))
                 .select("_h", F.col("r.value").alias("bucket"), F.col("r.n").cast("long").alias("n"))
                 .join(weights, "bucket").groupBy("_h")
                 .agg((F.sum(F.col("weight") * F.col("n")) / SCALE / F.sum("n")).alias("llr")))
        scored = rows.select(*keys).join(means, "_h", "left").select(*keys, F.coalesce("llr", F.lit(0.0)).alias("llr"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return scored.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("llr") >= threshold))


def quality_rules(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Statistics, score and verdict for each row of ``docs`` (doc_id, text)."""
    return _scored(docs, labels, **options).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "llr")


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` that ``quality_rules`` keeps; equal texts share a verdict."""
    verdicts = _scored(docs, labels, **options)
    good = verdicts.where("kept").select(F.col("doc_id").alias("_id"), "_h").distinct()
    return rows_of(join_on_key(keyed(docs), good, "left_semi"))
