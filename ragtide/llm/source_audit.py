"""Divergence of each source's vocabulary from the other sources of its language.

1. Tokens: ``bytes.translate`` with one table lowers A-Z and turns every separator
   into a blank, ``bytes.split`` cuts, and a ``Counter`` for each document gives its
   term frequencies. A task adds the documents up by (lang, source, term) and emits
   the sparse sums when ``HELD`` of them are held; Spark adds these again.
2. Kept terms of a language occur in at least ``min_docs`` of its documents. A
   term's smoothed share p of a group (or q of the language) is an integer in
   billionths, by exact decimal arithmetic.
3. Pairs: the sparse shares are laid out in blocks of terms and tiles of sources
   (both by hash, their number from the counted rows). A task fills a block's
   missing entries with the groups' share of an absent term and sums the absolute
   differences of the sources of two tiles; the blocks' sums are added. A term that
   is absent from both tiles counts through its number alone.

A hot source or term is one row of a block, however many documents it has; a task
holds one block of two tiles. Rows leave the pair step as sums for two sources,
never for a term.

Defined cases: null text, lang or source are ''; a group without terms gives each
kept term a count of 0; a language without kept terms gives pairs of value 0,
ranked by item; a language with one source has no pairs; an empty table gives an
empty result; repeated rows count each; only the three columns are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ragtide.operators.topk import broadcast_if_small
from ragtide.session import ship_package

from .common import written

MIN_DOCS, TOP, PRIOR, UNIT = 30, 50, 5, 1_000_000_000
#: Sums held in a task, rows of a block, sources of a tile, terms of a dense step.
HELD, BLOCK_ROWS, TILE, STEP = 400_000, 200_000, 256, 8192
#: The lower-casing and separating table: letters and bytes beyond ASCII stay.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))
COUNTS = "lang string, source string, term binary, n bigint, docs bigint"


def terms(text: bytes) -> Counter:
    return Counter(text.translate(TABLE).split())


def _counts(limit: int):
    names = [c.split()[0] for c in COUNTS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, tuple[Counter, Counter]] = {}
        held = 0

        def rows():
            for (lang, source), (n, docs) in sums.items():
                # the empty term stands for the group itself
                found = [b"", *n]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found), pa.string()), pa.array([source] * len(found), pa.string()),
                     pa.array(found, pa.binary()), pa.array([0, *n.values()], pa.int64()),
                     pa.array([0, *(docs[t] for t in n)], pa.int64())], names)

        for b in batches:
            for lang, source, text in zip(*(b.column(c).to_pylist() for c in ("lang", "source", "text"))):
                n, docs = sums.setdefault((lang, source), (Counter(), Counter()))
                before = len(n)
                found = terms(text)
                n.update(found)
                docs.update(found.keys())
                held += len(n) - before
                if held > limit:
                    yield from rows()
                    sums, held = {}, 0
        yield from rows()
    return run


def term_counts(docs: DataFrame, held: int = HELD) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in each
    group; a row with the empty term stands for every group."""
    ship_package(docs.sparkSession)

    def text(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    narrow = docs.select(text("lang").alias("lang"), text("source").alias("source"),
                         text("text").cast("binary").alias("text"))
    return (narrow.mapInArrow(_counts(held), COUNTS)
            .groupBy("lang", "source", F.col("term").cast("string").alias("term"))
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def share(n, total, kept):
    """1 + floor(UNIT * (n + PRIOR) / (total + PRIOR * kept)), exactly."""
    part = f"cast({UNIT} as decimal(10,0)) * (cast({n} as decimal(20,0)) + {PRIOR})"
    return F.expr(f"case when {kept} > 0 then 1 + ({part}) div "
                  f"(cast({total} as decimal(20,0)) + {PRIOR} * cast({kept} as decimal(20,0))) end")


def shares(counted: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame]:
    """``(terms, groups)`` of counted terms: (lang, source, term, p, q) for kept terms
    that a group has, and (lang, source, kept, z, rows) for each group, with z its
    share of an absent term and rows the language's rows in ``terms``."""
    kept = written(counted.where("term <> ''").groupBy("lang", "term")
                   .agg(F.sum("n").alias("n_lang"), F.sum("docs").alias("docs"), F.count("*").alias("rows"))
                   .where(F.col("docs") >= min_docs).drop("docs"), "kept")
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("n_lang").alias("total"),
                                     F.sum("rows").alias("rows"))
    langs = broadcast_if_small(langs)
    present = written(counted.where("term <> ''").join(kept, ["lang", "term"])
                      .select("lang", "source", "term", "n", "n_lang"), "present")
    totals = present.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = written(
        counted.where("term = ''").select("lang", "source").join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left").na.fill(0, ["n", "kept", "total", "rows"])
        .select("lang", "source", "n", "kept", "total", "rows", share("0", "n", "kept").alias("z")), "groups")
    sized = broadcast_if_small(groups.select("lang", "source", F.col("n").alias("n_group"), "kept", "total"))
    p = present.join(sized, ["lang", "source"]).select(
        "lang", "source", "term", share("n", "n_group", "kept").alias("p"), share("n_lang", "total", "kept").alias("q"))
    return p, groups.select("lang", "source", "kept", "z", "rows")


def _differences(step: int):
    def run(table: pa.Table) -> pa.Table:
        lang, first = table.column("lang")[0].as_py(), table.column("block")[0].as_py() == 0
        same = table.column("i")[0].as_py() == table.column("j")[0].as_py()
        is_group = table.column("term").is_null()
        groups, rows = table.filter(is_group), table.filter(pa.compute.invert(is_group))
        names, side = groups.column("source").to_pylist(), groups.column("tile").to_numpy()
        z = np.array(groups.column("z").to_numpy(zero_copy_only=False), np.float64)
        z = np.nan_to_num(z).astype(np.int64)  # at most UNIT + 1; absent where no term is kept
        kept = groups.column("kept")[0].as_py()
        code = rows.column("term").combine_chunks().dictionary_encode()
        col = code.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        at = {s: k for k, s in enumerate(names)}
        row = np.array([at[s] for s in rows.column("source").to_pylist()], np.int64)
        p = rows.column("p").to_numpy().astype(np.int64)
        n_terms = len(code.dictionary)
        left = np.arange(len(names)) if same else np.nonzero(side == table.column("i")[0].as_py())[0]
        right = left if same else np.nonzero(side != table.column("i")[0].as_py())[0]
        order = np.argsort(col, kind="stable")
        row, col, p = row[order], col[order], p[order]
        sums = np.zeros((len(left), len(right)), np.int64)
        for start in range(0, n_terms, step):
            a, b = np.searchsorted(col, [start, start + step])
            dense = np.repeat(z[:, None], min(step, n_terms - start), axis=1)
            dense[row[a:b], col[a:b] - start] = p[a:b]
            for k, g in enumerate(left):
                sums[k] += np.abs(dense[right] - dense[g]).sum(axis=1)
        # terms of the language that neither tile has in any block
        apart = np.abs(z[left][:, None] - z[right][None, :])
        sums += apart * ((kept if first else 0) - n_terms)
        x, y = np.meshgrid(left, right, indexing="ij")
        pick = (x != y).ravel()
        x, y, value = x.ravel()[pick], y.ravel()[pick], sums.ravel()[pick]
        if not same:
            x, y, value = np.concatenate([x, y]), np.concatenate([y, x]), np.concatenate([value, value])
        names = pa.array(names, pa.string())
        return pa.table({"lang": pa.array([lang] * len(x), pa.string()), "source": names.take(pa.array(x)),
                         "item": names.take(pa.array(y)), "value": pa.array(value)})
    return run


def pair_sums(p: DataFrame, groups: DataFrame, block_rows: int = BLOCK_ROWS, tile: int = TILE,
              step: int = STEP) -> DataFrame:
    """(lang, source, item, value): summed absolute differences of two sources."""
    sizes = groups.groupBy("lang").agg(
        F.ceil(F.count("*") / F.lit(tile)).alias("tiles"),
        F.greatest(F.ceil(F.max("rows") / F.lit(block_rows) / F.ceil(F.count("*") / F.lit(tile))), F.lit(1))
        .alias("blocks"))
    sizes = broadcast_if_small(sizes)
    own = F.pmod(F.xxhash64("source"), F.col("tiles")).alias("tile")
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1)).alias("other")
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block")
    rows = p.join(sizes, "lang").select("lang", block, own, other, "source", "term", "p",
                                        F.lit(None).cast("bigint").alias("z"), F.lit(None).cast("bigint").alias("kept"))
    blocks = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block")
    marks = (groups.join(sizes, "lang").select("lang", blocks, own, "tiles", "source", "z", "kept")
             .select("lang", "block", "tile", other, "source", F.lit(None).cast("string").alias("term"),
                     F.lit(None).cast("bigint").alias("p"), "z", "kept"))
    tiles = rows.unionByName(marks).select(
        "lang", "block", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "tile", "source",
        "term", "p", "z", "kept")
    sums = tiles.groupBy("lang", "block", "i", "j").applyInArrow(
        _differences(step), "lang string, source string, item string, value bigint")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, held: int = HELD,
          block_rows: int = BLOCK_ROWS, tile: int = TILE, step: int = STEP) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank."""
    p, groups = shares(written(term_counts(docs, held), "counts"), min_docs)
    p = written(p, "shares")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = pair_sums(p, groups, block_rows, tile, step).withColumn("rank", F.row_number().over(order))
    excess = (p.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
              .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))

    def part(df, name):
        return df.select("lang", "source", F.lit(name).alias("part"), "item", F.col("value").cast("bigint"), "rank")

    return part(pairs, "pair").unionByName(part(excess, "term"))
