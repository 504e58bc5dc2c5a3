"""Language identification with word-first backoff.

A known word scores its log frequency in each language. An unseen word falls back
to its characters: from each position the longest known n-gram (5 down to 1, with
word ends marked) scores its log frequency, and the word takes their mean. A
document takes the language with the largest sum over its words; its score is
the softmax share of that sum.

The frequencies come from a bounded sample (about ``MAX_ROWS`` rows of each language,
chosen by a hash of the id); the tables keep entries seen ``MIN_COUNT`` times, so
what is broadcast is bounded by the sample. Scoring works on the distinct words
of each Arrow batch and reads whole texts.

Ids whose crc32 leaves 2 modulo 4 are held out of training; language, source and
id never enter a prediction.

Defined cases: null texts and texts without a letter are ``und`` with score 0,
as is everything when no row has a language; ties go to the first language in
string order; repeated rows are predicted alike; an empty table gives an empty
result; only ``doc_id``, ``text`` and ``lang`` are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragtide.session import ship_package

from .packing import sliced
from .quality_model import held_out

MAX_ROWS, MIN_COUNT, MAX_GRAM = 4_000, 3, 5
#: Smoothing: counts added to each entry of a table.
ALPHA = 0.5
CACHE = 300_000
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def grams(word: str, longest: int = MAX_GRAM) -> Iterator[str]:
    w = f" {word} "
    for n in range(1, longest + 1):
        for i in range(len(w) - n + 1):
            yield w[i:i + n]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        words: dict[str, Counter] = {}
        for text, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist()):
            words.setdefault(lang, Counter()).update(words_of(text))
        for lang, counts in words.items():
            pieces: Counter = Counter()
            for w, c in counts.items():
                for g in grams(w):
                    pieces[g] += c
            for kind, table in (("word", counts), ("gram", pieces)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(table), pa.string()), pa.array([kind] * len(table), pa.string()),
                     pa.array(list(table), pa.string()), pa.array(list(table.values()), pa.int64())],
                    ["lang", "kind", "piece", "n"])


class Model:
    """Log frequencies: ``words`` and ``grams`` map a string to a row of ``logs``."""

    def __init__(self, rows, languages: list[str]):
        self.languages = languages
        at = {lang: i for i, lang in enumerate(languages)}
        tables: dict[str, dict[str, np.ndarray]] = {}
        for r in rows:
            name = "word" if r["kind"] == "word" else f"gram{len(r['piece'])}"
            tables.setdefault(name, {}).setdefault(r["piece"], np.zeros(len(languages)))[at[r["lang"]]] = r["n"]
        self.words, self.grams, logs, first = {}, {}, [], 0
        for name, table in tables.items():
            n = np.array(list(table.values())) + ALPHA
            logs.append(np.log(n / n.sum(0)))
            (self.words if name == "word" else self.grams).update(zip(table, range(first, first + len(table))))
            first += len(table)
        self.logs = np.concatenate([*logs, np.zeros((1, len(languages)))]).astype(np.float32)

    def score(self, words: list[str]) -> np.ndarray:
        """A row for each word: its own, or the mean of its longest known n-grams."""
        rows, sizes, known, grams = [], [], self.words.get, self.grams.get
        for word in words:
            row = known(word)
            if row is not None:
                rows.append(row)
                sizes.append(1)
                continue
            w, before = f" {word} ", len(rows)
            n = len(w)
            for i in range(n):
                for end in range(min(i + MAX_GRAM, n), i, -1):
                    row = grams(w[i:end])
                    if row is not None:
                        rows.append(row)
                        break
            if len(rows) == before:
                rows.append(len(self.logs) - 1)
            sizes.append(len(rows) - before)
        sizes = np.array(sizes)
        starts = np.cumsum(sizes) - sizes
        out = np.empty((len(words), len(self.languages)))
        step = 1 << 16  # bounds the gathered rows
        for a in range(0, len(words), step):
            b = min(a + step, len(words))
            part = self.logs[rows[starts[a]:starts[b - 1] + sizes[b - 1]]].astype(np.float64)
            out[a:b] = np.add.reduceat(part, starts[a:b] - starts[a]) / sizes[a:b, None]
        return out


def train(docs: DataFrame, max_rows: int = MAX_ROWS, min_count: int = MIN_COUNT) -> Model:
    """Word and n-gram frequencies by language, from about ``max_rows`` rows of each
    language (all rows of one that has fewer), picked by hash."""
    ship_package(docs.sparkSession)
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()).select(
        F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"),
        F.pmod(F.xxhash64("doc_id", "text", F.lit(2)), F.lit(1 << 30)).alias("pick"))
    sizes = usable.groupBy("lang").agg(F.count("*").alias("rows"))
    # the model names every language, so that their number is small by design
    usable = usable.join(F.broadcast(sizes), "lang").where(
        F.col("pick") * F.col("rows") < F.lit(float(max_rows * (1 << 30))))
    counts = (usable.select("text", "lang").mapInArrow(_counts, "lang string, kind string, piece string, n bigint")
              .groupBy("kind", "piece", "lang").agg(F.sum("n").alias("n")))
    rows = counts.where(F.col("n") >= min_count).orderBy("kind", "piece", "lang").toArrow().to_pylist()
    return Model(rows, sorted({r["lang"] for r in rows}))


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        number: dict[str, int] = {}
        scores = np.zeros((0, len(model.languages)))
        for b in sliced(batches):
            if len(number) > CACHE:
                number, scores = {}, scores[:0]
            texts = [words_of(t.as_py()) for t in b.column("text")]
            fresh = list(dict.fromkeys(w for t in texts for w in t if w not in number))
            number.update(zip(fresh, range(len(number), len(number) + len(fresh))))
            if fresh and model.languages:
                scores = np.concatenate([scores, model.score(fresh)])
            langs, best = [], []
            for words in texts:
                if not words or not model.languages:
                    langs.append("und")
                    best.append(0.0)
                    continue
                total = scores[np.fromiter(map(number.__getitem__, words), np.int64, len(words))].sum(0)
                share = np.exp(total - total.max())
                i = int(total.argmax())
                langs.append(model.languages[i])
                best.append(float(share[i] / share.sum()))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(langs, pa.string()), pa.array(best, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"])
    return run


def predict(docs: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row of ``docs``."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, max_rows))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out().alias("held_out"), F.col("text").cast("string").alias("text")).mapInArrow(
        _predict(model), f"doc_id {kind}, held_out boolean, lang_pred string, score double")
