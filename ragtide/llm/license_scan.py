"""License phrases and notices by diagonal voting, DataFrame functions only.

1. Every rolling run of k words of a text is hashed (from the words' hashes) and
   joined to the templates' runs. A meeting is a vote for a diagonal: place in the
   text minus place in the template. It carries its k words.
2. Votes are gathered by (document, template, diagonal). For notices, diagonals at
   most ``GAP`` apart are merged, so that added or lost words do not split a span;
   phrases must stand consecutively and keep single diagonals.
3. A span is verified: each vote's words are compared with the template's, and its
   share is the part of the template's words that verified votes cover. A phrase
   counts at a share of 1, a notice at ``MIN_SHARE`` or more.

Phrases are matched by runs of two words, notices by runs of ``K``. The templates'
runs are broadcast, at most ``MAX_RUNS`` at once: more of them are joined slice by
slice. Texts are exploded beside the join and never shuffled: only votes and one
row for each document move.

Defined cases: a null or empty text has no words and no labels; repeated rows (same
id and text) each get the result; null ids are kept; an empty table gives an empty
result; a template of fewer words than its run length is refused; only ``doc_id``
and ``text`` are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ragtide.operators.topk import broadcast_if_small

from .common import ascii_lower, let, row_key, text_or_empty, written
from .decontaminate import raw_words

K, GAP, MIN_SHARE = 3, 4, 0.8
PHRASE_K = 2
MAX_RUNS = 1_000_000
#: The phrases and labels of the base.
PHRASES = [("gpl", "gnu general public license"), ("apache", "apache license"), ("cc-by", "cc by"),
           ("mit", "mit license")]
#: Public notices, as licensors ask users to state them.
NOTICES = [
    ("agpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                 "Affero General Public License as published by the Free Software Foundation"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("gpl-notice", "This work is licensed under the GNU General Public License"),
    ("gpl-any", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted"),
    ("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                 "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("mit-notice", "Released under the MIT License"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]


def run_hashes(words: Column, sizes: list[int]) -> Column:
    """Hashes of all runs of each size, one size behind the other."""
    def runs(hashes, k):
        at = F.when(F.size(hashes) >= k, F.sequence(F.lit(0), F.size(hashes) - k))
        found = F.transform(at, lambda i: F.xxhash64(F.lit(k), *[F.get(hashes, i + j) for j in range(k)]))
        return F.coalesce(found, F.array().cast("array<bigint>"))

    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: F.concat(*[runs(h, k) for k in sizes]))


def template_table(spark: SparkSession, phrases=None, notices=None, k: int = K) -> DataFrame:
    """(template, label, phrase, k, words)."""
    rows = ([(label, t, True, PHRASE_K) for label, t in (PHRASES if phrases is None else phrases)]
            + [(label, t, False, k) for label, t in (NOTICES if notices is None else notices)])
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                                  "template int, label string, text string, phrase boolean, k int")
    table = table.select("template", "label", "phrase", "k", raw_words(ascii_lower(F.col("text"))).alias("words"))
    short = [r.label for r in table.where(F.size("words") < F.col("k")).collect()]
    if short:
        raise ValueError(f"templates with fewer words than their runs: {short}")
    return table


def diagonals(docs: DataFrame, templates: DataFrame, max_runs: int = MAX_RUNS) -> DataFrame:
    """(_id, _h, template, diagonal, n, votes): votes (at, words) of each diagonal;
    rows of template -1 stand for documents, with their number of words as diagonal
    and the number of equal rows as n."""
    sizes = sorted(r[0] for r in templates.select("k").distinct().collect())  # a number for each run length
    # one size at a time: a template's runs in the order of its words
    grams = reduce(DataFrame.unionByName, [
        templates.where(F.col("k") == k).select(
            "template", F.col("k").alias("size"), F.posexplode(run_hashes(F.col("words"), [k])).alias("at", "gram"))
        for k in sizes])
    mark = templates.sparkSession.sql("select -1 as template, 0 as size, 0 as at, 0L as gram")
    grams = written(grams.unionByName(mark), "runs")
    slices = -(-grams.count() // max_runs)
    # one more entry for each document; its place tells it from a run of equal hash
    cut = let(raw_words(ascii_lower(text_or_empty())), lambda w: F.struct(
        w.alias("w"), F.concat(run_hashes(w, sizes), F.array(F.lit(0).cast("bigint"))).alias("runs")))
    placed = docs.select(*row_key(), cut.alias("_c")).select("_id", "_h", "_c", F.posexplode("_c.runs").alias("_p", "gram"))
    met = reduce(DataFrame.unionByName, [
        placed.join(F.broadcast(grams.where(F.pmod(F.xxhash64("gram"), F.lit(slices)) == i)), "gram")
        for i in range(slices)]).where((F.col("size") == 0) == (F.col("_p") == F.size("_c.runs") - 1))
    n = F.size("_c.w")
    before, offset = F.lit(0), F.when(F.col("size") == 0, 0)
    for k in sizes:
        offset = offset.when(F.col("size") == k, before)
        before = before + F.greatest(n - k + 1, F.lit(0))
    place = F.when(F.col("size") == 0, n).otherwise(F.col("_p") - offset - F.col("at"))
    votes = met.select("_id", "_h", "template", place.alias("diagonal"), F.struct("at", F.when(
        F.col("size") > 0, F.slice("_c.w", F.col("_p") - offset + 1, F.col("size"))).alias("words")).alias("vote"))
    return votes.groupBy("_id", "_h", "template", "diagonal").agg(
        F.count("*").alias("n"), F.collect_set("vote").alias("votes"))


def spans(found: DataFrame, templates: DataFrame, gap: int = GAP) -> DataFrame:
    """(_id, _h, label, phrase, start, end, share): verified spans, word positions
    from 0, end exclusive."""
    by = Window.partitionBy("_id", "_h", "template").orderBy("diagonal")
    apart = F.col("phrase") | (F.col("diagonal") - F.lag("diagonal").over(by) > gap)
    texts = broadcast_if_small(templates.select("template", "label", "phrase", "k", F.col("words").alias("ours")))
    bands = (found.where("template >= 0").join(texts.select("template", "phrase"), "template")
             .withColumn("new", F.when(F.coalesce(apart, F.lit(True)), 1).otherwise(0))
             .withColumn("band", F.sum("new").over(by)))
    votes = F.transform("votes", lambda v: F.struct(
        F.col("diagonal").alias("diagonal"), v["at"].alias("at"), v["words"].alias("words")))
    merged = bands.groupBy("_id", "_h", "template", "band").agg(F.flatten(F.collect_list(votes)).alias("votes"))
    equal = F.filter("votes", lambda v: v["words"] == F.slice("ours", v["at"] + 1, F.col("k")))
    checked = merged.join(texts, "template").withColumn("votes", equal).where(F.size("votes") > 0)
    places = F.transform("votes", lambda v: v["diagonal"] + v["at"])
    covered = F.size(F.array_distinct(F.flatten(F.transform(
        "votes", lambda v: F.sequence(v["at"], v["at"] + F.col("k") - 1)))))
    return checked.select("_id", "_h", "label", "phrase", F.array_min(places).alias("start"),
                          (F.array_max(places) + F.col("k")).alias("end"), (covered / F.size("ours")).alias("share"))


def license_scan(docs: DataFrame, templates: DataFrame | None = None, gap: int = GAP,
                 min_share: float = MIN_SHARE, max_runs: int = MAX_RUNS) -> DataFrame:
    """n_words, n_base, first_word, last_word, base_labels, labels, score for each
    row; score is the largest share of any span."""
    templates = templates or template_table(docs.sparkSession)
    found = written(diagonals(docs, templates, max_runs), "diagonals")
    placed = spans(found, templates, gap)
    base = F.col("phrase") & (F.col("share") == 1)
    named = base | (~F.col("phrase") & (F.col("share") >= min_share))
    rows = (found.where("template < 0").select("_id", "_h", F.col("diagonal").alias("n_words"), F.col("n").alias("rows"))
            .unionByName(placed.select(
                "_id", "_h", F.when(base, F.col("start")).alias("start"), F.when(base, F.col("label")).alias("base"),
                F.when(named, F.col("label")).alias("label"), "share"), allowMissingColumns=True))
    by_doc = rows.groupBy("_id", "_h").agg(
        F.max("n_words").alias("n_words"), F.max("rows").alias("rows"), F.count("start").alias("n_base"),
        F.min("start").alias("first"), F.max("start").alias("last"), F.collect_set("base").alias("base"),
        F.collect_set("label").alias("labels"), F.max("share").alias("share"))
    # equal rows share their result; the second step keeps the arrays short
    copies = by_doc.withColumn("_m", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("rows") - 1, F.lit(1000).cast("bigint"))))
    copies = copies.withColumn("_n", F.explode(F.sequence(F.col("_m"), F.least(F.col("_m") + 999, F.col("rows") - 1))))

    def joined(c):
        return F.array_join(F.array_sort(c), ",")

    return copies.select(
        F.col("_id").alias("doc_id"), F.col("n_words").cast("bigint"), "n_base", F.col("first").cast("bigint").alias("first_word"),
        F.col("last").cast("bigint").alias("last_word"), joined("base").alias("base_labels"),
        joined("labels").alias("labels"), F.round(F.coalesce("share", F.lit(0.0)), 6).alias("score"))
