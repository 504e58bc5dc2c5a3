"""Personal data by fixed patterns and by bootstrapped contexts, DataFrame
functions only.

Base spans: e-mail, IP, card and phone patterns with their checks (parts, Luhn,
digit counts), leftmost and non-overlapping for each kind. A pattern's matches
and the gaps between them (``split``) give code-point positions in one pass over
a text; possessive quantifiers and look-behinds keep the patterns linear.

Bootstrapping: every base entity and every other identifier-like token (it holds
digits) is a mention with its lexical contexts: the two words to its left, and
the word on either side. Every match of the mention pattern is one word of its
text, whatever it is attached to; as a context its digits are one 0, and an
e-mail is @. Contexts (patterns) and values (instances) form a
graph. In each round Spark scores a pattern by the mean score of its distinct
instances and an instance by noisy-or over its accepted patterns; base entities
are the seeds, with score 1. Mentions of instances beyond ``accept`` inside
accepted patterns are added as spans of kind ``id``.

All counts are aggregates over the whole corpus; the graph tables are written
between rounds, so that its joins can be split when one context is hot. Texts
are only read by the scans.

Defined cases: a null text is empty; repeated rows have equal spans and all come
back; empty tables give empty results; only ``doc_id`` and ``text`` are read
(``redact`` passes other columns through).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_on_key, keyed, let, row_key, rows_of, text_or_empty, words_of, written

LOCAL = "A-Za-z0-9._%+-"
#: The contract's patterns, in the order in which kinds are listed.
PATTERNS = {
    # a start inside a run of local characters only follows a previous match
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must hold for the pattern to match at all.
NEEDS = {"email": "@", "ip": "[0-9]\\.[0-9]", "card": "[0-9][ -]?[0-9]", "phone": "\\+[0-9]"}
FOUND = "id"
TOKEN = r"(?<![A-Za-z0-9])(?:[A-Za-z]{1,8}+[._-])?+[A-Za-z]*+[0-9][A-Za-z0-9]*+(?:[._-][A-Za-z0-9]++)*+"
MENTION = "|".join([PATTERNS["phone"], PATTERNS["email"], PATTERNS["ip"],
                    r"(?<![0-9])[0-9](?:[ -]?[0-9]){11,}+", TOKEN])
#: A number as a context word: a phone or card number with its separators is one.
NUMBER = "[0-9]++(?:[ ().-]++[0-9]++)*+"
#: Marks the words that are matches; taken as a space where a text holds it.
MARK = "\x01"
SIDES = ("two", "one", "after")
ROUNDS, MIN_SUPPORT, MIN_PRECISION, ACCEPT, MIN_DIGITS = 3, 5, 0.8, 0.8, 4
CHUNK = 256


def starts_of(lengths: Column) -> Column:
    """Exclusive running sums; chunked, since growing an array copies it."""
    def running(xs, first):
        return F.aggregate(
            xs, F.struct(first.alias("at"), F.array().cast("array<bigint>").alias("out")),
            lambda a, x: F.struct((a["at"] + x).alias("at"), F.array_append(a["out"], a["at"]).alias("out")))["out"]

    def total(xs):
        return F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + x)

    zero = F.lit(0).cast("long")
    return let(lengths, lambda n: F.when(F.size(n) <= CHUNK, running(n, zero)).otherwise(
        let(F.transform(F.sequence(F.lit(0), ((F.size(n) - 1) / CHUNK).cast("int")),
                        lambda c: F.slice(n, c * CHUNK + 1, CHUNK)),
            lambda chunks: F.flatten(F.zip_with(
                chunks, running(F.transform(chunks, total), zero), running)))))


def matches(text: Column, pattern: str, needs: str, words: bool = False) -> Column:
    """Array of (value, start): matches and their code-point starts; with
    ``words`` also two, one and after (see ``neighbours``)."""
    def located(found, gaps):
        lengths = F.transform(found, lambda m, i: (F.length(F.get(gaps, i)) + F.length(m)).cast("long"))
        at = F.transform(starts_of(lengths), lambda a, i: a + F.length(F.get(gaps, i)))
        if words:
            return F.zip_with(F.zip_with(found, at, lambda m, a: F.struct(m.alias("value"), a.alias("start"))),
                              neighbours(found, gaps), lambda m, n: F.struct(
                *[m[c].alias(c) for c in ("value", "start")], *[n[c].alias(c) for c in SIDES]))
        return F.zip_with(found, at, lambda m, a: F.struct(m.alias("value"), a.alias("start")))

    fields = ["value:string", "start:bigint", *[f"{c}:string" for c in SIDES if words]]
    none = F.array().cast(f"array<struct<{','.join(fields)}>>")
    return F.when(F.rlike(text, F.lit(needs)), let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda found: let(F.split(text, pattern), lambda gaps: located(found, gaps)))).otherwise(none)


def neighbours(found: Column, gaps: Column) -> Column:
    """Array of (two, one, after): the second and the next word to the left of each
    match and the next one to its right, null where the text ends. The words are
    cut from the whole text, in which each match is a marked word."""
    def masked(m):
        return F.when(F.contains(m, F.lit("@")), F.lit("@")).otherwise(F.regexp_replace(m, NUMBER, "0"))

    text = F.lower(F.array_join(F.zip_with(gaps, found, lambda g, m: F.concat(
        F.translate(g, MARK, " "), F.coalesce(F.concat(F.lit(f" {MARK}"), masked(m), F.lit(" ")), F.lit("")))), ""))

    def word(w, i):
        return F.regexp_replace(F.translate(F.get(w, i), MARK, ""), "[0-9]+", "0")

    def around(w):
        places = F.filter(F.transform(w, lambda x, i: F.when(F.startswith(x, F.lit(MARK)), i)), lambda i: i.isNotNull())
        return F.transform(places, lambda i: F.struct(*[
            word(w, i + step).alias(c) for c, step in zip(SIDES, (-2, -1, 1))]))

    return let(words_of(text), around)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]+", "")


def luhn(number: Column) -> Column:
    """Luhn check of a string of digits."""
    def doubled(d):
        return F.when(d > 4, 2 * d - 9).otherwise(2 * d)

    value = F.transform(F.split(F.reverse(number), ""), lambda c: c.cast("int"))
    return F.aggregate(F.transform(value, lambda d, i: F.when(i % 2 == 1, doubled(d)).otherwise(d)),
                       F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        small = "^0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"
        return F.forall(F.split(value, "\\."), lambda p: F.rlike(p, F.lit(small)))
    if kind == "card":
        return let(digits(value), lambda d: F.when(F.length(d).between(12, 19), luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(digits(value)).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Array of (start, rank, kind, end), by start and then kind as listed."""
    def spans(rank, kind):
        found = F.filter(matches(text, PATTERNS[kind], NEEDS[kind]), lambda m: valid(kind, m["value"]))
        return F.transform(found, lambda m: F.struct(
            m["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"),
            (m["start"] + F.length(m["value"])).alias("end")))

    return F.sort_array(F.concat(*[spans(i, k) for i, k in enumerate(PATTERNS)]))


def mentions(docs: DataFrame) -> DataFrame:
    """(_id, _h, value, start, end, seed, patterns): base entities and other
    tokens with digits, each with its contexts."""
    rows = (docs.select(*row_key(), text_or_empty().alias("_t"))
            .select("_id", "_h", F.explode(matches(F.col("_t"), MENTION, "[0-9@]", words=True)).alias("m"))
            .select("_id", "_h", "m.*"))
    whole = [F.rlike("value", F.lit(f"^(?:{p})$")) & valid(k, F.col("value")) for k, p in PATTERNS.items()]
    seed = whole[0]
    for w in whole[1:]:
        seed = seed | w
    # null where a word is missing
    contexts = F.array(F.concat("two", F.lit(" "), "one", F.lit(" _")), F.concat("one", F.lit(" _ "), "after"))
    return (rows.withColumn("seed", seed)
            .where(F.col("seed") | (F.length(digits(F.col("value"))) >= MIN_DIGITS))
            .select("_id", "_h", F.lower("value").alias("value"), "start",
                    (F.col("start") + F.length("value")).alias("end"), "seed",
                    F.array_compact(contexts).alias("patterns")))


def bootstrap(found: DataFrame, rounds: int = ROUNDS, min_support: int = MIN_SUPPORT,
              min_precision: float = MIN_PRECISION, accept: float = ACCEPT) -> DataFrame:
    """(_id, _h, spans): mentions that high-confidence patterns discover.
    ``found`` is the written table of ``mentions``."""
    edges = written(found.select("value", "seed", F.explode("patterns").alias("pattern"))
                    .groupBy("pattern", "value").agg(F.max("seed").alias("seed")), "edges")
    scored = edges.select("pattern", "value", "seed", F.col("seed").cast("double").alias("score"))
    for _ in range(rounds):
        patterns = written(
            scored.groupBy("pattern").agg(F.avg("score").alias("precision"),
                                          F.count(F.when(F.col("score") >= accept, 1)).alias("support"))
            .where((F.col("support") >= min_support) & (F.col("precision") >= min_precision))
            .select("pattern", "precision"), "patterns")
        # a share of doubt stays with every pattern
        miss = F.exp(F.sum(F.log(1 - F.lit(0.95) * F.col("precision"))))
        instances = written(edges.where("not seed").join(patterns, "pattern")
                            .groupBy("value").agg((1 - miss).alias("score")), "instances")
        scored = written(edges.join(instances, "value", "left").select(
            "pattern", "value", "seed",
            F.when(F.col("seed"), 1.0).otherwise(F.coalesce("score", F.lit(0.0))).alias("score")), "scored")
    good = written(instances.where(F.col("score") >= accept).select("value"), "accepted")
    hits = (found.where("not seed").select("_id", "_h", "start", "end", "value", F.explode("patterns").alias("pattern"))
            .join(patterns.select("pattern"), "pattern", "left_semi").join(good, "value", "left_semi"))
    return hits.groupBy("_id", "_h").agg(F.sort_array(F.collect_set(F.struct(
        "start", F.lit(len(PATTERNS)).alias("rank"), F.lit(FOUND).alias("kind"), "end"))).alias("more"))


def with_spans(docs: DataFrame) -> DataFrame:
    """_row (the row of ``docs``), _base (its base spans) and _spans (with discovered
    ones that overlap no base span)."""
    more = bootstrap(written(mentions(docs), "mentions"))
    joined = join_on_key(keyed(docs).withColumn("_base", base_spans(text_or_empty("_row.text"))), more, "left")
    extra = F.filter("more", lambda m: ~F.exists("_base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    return joined.select("_row", "_base", F.when(F.col("more").isNull(), F.col("_base")).otherwise(
        F.sort_array(F.concat("_base", extra))).alias("_spans"))


def joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def pii_report(docs: DataFrame) -> DataFrame:
    """Counts by kind, digest of the base spans, and all spans, for each row."""
    rows = with_spans(docs.select("doc_id", "text"))
    return rows.select("_row.doc_id", *[
        F.size(F.filter("_base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}") for k in PATTERNS],
        F.sha2(joined(F.col("_base")).cast("binary"), 256).alias("base_sha256"), joined(F.col("_spans")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span's text replaced by its kind in brackets;
    overlapping spans become one. A null text stays null."""
    def rewritten(text, spans):
        def step(a, s):
            fresh = F.when(s["start"] >= a["at"], F.array(
                F.substr(text, a["at"] + 1, s["start"] - a["at"]), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))))
            return F.struct(F.greatest(a["at"], s["end"]).alias("at"),
                            F.concat(a["out"], F.coalesce(fresh, F.array().cast("array<string>"))).alias("out"))

        done = F.aggregate(spans, F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out")), step)
        return let(done, lambda a: F.concat(F.concat_ws("", a["out"]), F.substr(text, a["at"] + 1)))

    old = F.col("_row.text")
    text = F.when(F.size("_spans") > 0, rewritten(old, F.col("_spans"))).otherwise(old)
    return rows_of(with_spans(docs).withColumn("_row", F.col("_row").withField("text", text)))
