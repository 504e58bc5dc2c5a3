"""Benchmark decontamination by a prefix-filtered containment join, DataFrame
functions only.

A window is ``window`` consecutive words of an item (all of them when it has
fewer). A document contains a window only if it contains the window's rarest
word, so that word alone is the necessary prefix: document words are joined to
the windows' rarest words (rarity: occurrences in all documents, ties by the
word), each meeting fixes one alignment, alignments that would start before the
document or end after it are dropped (position and length bounds), and the rest
are compared word for word.

The prefix table is broadcast when its counted rows are at most
``max_broadcast``; beyond that the same join on narrow rows shuffles. Alignments
are gathered by document and meet its text once.

Defined cases: null or wordless documents have no words and are clean; wordless
items match nothing; the windows of items without an id hit words as others do, but
such items are neither counted nor listed; repeated items or rows change nothing
else; empty tables give empty or clean results. Only ``doc_id``, ``text``,
``item_id`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, join_on_key, keyed, let, row_key, rows_of, text_or_empty, written

WINDOW = 13
MAX_BROADCAST = 500_000
#: Words of a text before lower-casing A-Z: digits, letters, all beyond ASCII.
#: The class lists single characters, which Java looks up in one table.
WORD = "[^" + "".join(f"\\x{c:02X}" for c in range(128) if not chr(c).isalnum()) + "]+"


def raw_words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, words): one row for each distinct window of an item."""
    words = (benchmark.select("item_id", raw_words(ascii_lower(text_or_empty())).alias("w"))
             .where(F.size("w") > 0).distinct())
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (window - 1), F.lit(1)))
    return (words.select("item_id", "w", F.explode(starts).alias("s"))
            .select("item_id", F.slice("w", F.col("s"), window).alias("words")).distinct())


def _small(df: DataFrame, max_rows: int) -> bool:
    return df.limit(max_rows + 1).count() <= max_rows


def prefixes(docs: DataFrame, windows: DataFrame, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """(word, at, words, items): each distinct window under its rarest word, at
    its first position there. A window with a word that no document has is out."""
    grouped = windows.groupBy("words").agg(F.collect_set("item_id").alias("items"))  # without nulls
    # keyed by the general lower case, which also merges what ASCII keeps apart:
    # more candidates, the same verified matches
    parts = grouped.select("words", "items", F.posexplode("words").alias("at", "w")).withColumn(
        "word", F.lower("w"))
    vocabulary = written(parts.select("word").distinct(), "vocabulary")
    small = _small(vocabulary, max_broadcast)
    side = F.broadcast(vocabulary) if small else vocabulary
    counts = (docs.select(F.explode(raw_words(text_or_empty())).alias("word"))
              .select(F.lower("word").alias("word")).join(side, "word").groupBy("word").agg(F.count("*").alias("n")))
    # at most a row for each word of the vocabulary; a word may be in most windows
    rarest = (parts.join(F.broadcast(counts) if small else counts, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
              .groupBy("words").agg(F.min(F.struct("n", "word", "at")).alias("p"), F.first("items").alias("items")))
    return rarest.where("p.n > 0").select("p.word", "p.at", "words", "items")


def occurrences(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """(_id, _h, hits): for each document with any, its occurrences of windows as
    (start, end, items), 1-based word positions."""
    table = written(prefixes(docs, item_windows(benchmark, window), max_broadcast), "prefixes")
    side = F.broadcast(table) if _small(table, max_broadcast) else table
    # only ids and single words are exploded: a row carries no text
    placed = docs.select(*row_key(), F.posexplode(raw_words(text_or_empty())).alias("_at", "_word"))
    met = (placed.withColumn("_word", F.lower("_word")).join(side, F.col("_word") == F.col("word"))
           .select("_id", "_h", (F.col("_at") - F.col("at") + 1).alias("start"), "words", "items")
           .where("start >= 1"))
    # alignments meet their text once for each document
    by_doc = written(met.groupBy("_id", "_h").agg(F.collect_set(F.struct("start", "words", "items")).alias("met")), "met")
    texts = docs.select(*row_key(), text_or_empty().alias("_t"))
    joined = join_on_key(by_doc, texts, "inner")

    def equal(words, m):
        n = F.size(m["words"])
        return (m["start"] + n - 1 <= F.size(words)) & (
            F.transform(F.slice(words, m["start"], n), ascii_lower) == m["words"])

    hits = let(raw_words(F.col("_t")), lambda words: F.filter("met", lambda m: equal(words, m)))
    return joined.select("_id", "_h", F.transform(hits, lambda m: F.struct(
        m["start"].alias("start"), (m["start"] + F.size(m["words"]) - 1).alias("end"),
        m["items"].alias("items"))).alias("hits")).where(F.size("hits") > 0).dropDuplicates(["_id", "_h"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """n_words, n_hit, n_items, items_sha256, contaminated for each row of ``docs``."""
    def union(spans):
        return F.aggregate(
            F.sort_array(spans), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
            lambda a, s: F.struct(
                (a["n"] + F.greatest(s["end"] - F.greatest(a["end"], s["start"] - 1), F.lit(0))).alias("n"),
                F.greatest(a["end"], s["end"]).alias("end")))["n"]

    found = occurrences(docs, benchmark, window, max_broadcast)
    items = F.array_distinct(F.flatten(F.transform("hits", lambda h: h["items"])))
    hits = found.select("_id", "_h", union(F.col("hits")).alias("n_hit"),
                        F.transform(items, lambda x: x.cast("string")).alias("items"))
    rows = docs.select(*row_key(), F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("n_words"))
    joined = join_on_key(rows, hits, "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined.select(
        F.col("_id").alias("doc_id"), "_h", "n_words", n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort(items)).cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the contaminated rows; rows of equal id and text share a verdict."""
    bad = (contamination(docs, benchmark, **options).where("contaminated")
           .select(F.col("doc_id").alias("_id"), "_h").distinct())
    return rows_of(join_on_key(keyed(docs), bad, "left_anti"))
