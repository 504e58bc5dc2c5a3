"""Per-group ranking, dedupe and size-checked broadcast.

Top-k uses ``row_number() <= k`` so Catalyst plans a partial
``WindowGroupLimit`` before the shuffle: each map task ships at most ``k``
rows per group, which keeps a hot group (one query matching a third of the
corpus) from landing whole in one reducer.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written

# Scores are rounded before ranking so the engine and the oracle break ties
# identically despite different summation orders.
RANK_DECIMALS = 9
OUT_DECIMALS = 6

DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 256 << 20


def rank_key(score: str = "score") -> Column:
    return F.round(F.col(score), RANK_DECIMALS)


def topk_per_group(df: DataFrame, group: str | list[str], k: int | None,
                   score: str = "score", tie: str | list[str] = "doc_id",
                   rank_col: str = "rank", ascending: bool = False) -> DataFrame:
    """Keep the ``k`` best rows per group and number them 1..k.

    Order: rounded score (desc unless ``ascending``), then ``tie`` ascending.
    ``k=None`` ranks every row.
    """
    groups = [group] if isinstance(group, str) else list(group)
    ties = [tie] if isinstance(tie, str) else list(tie)
    key = rank_key(score)
    order = [key.asc() if ascending else key.desc()] + [F.col(t).asc() for t in ties]
    w = Window.partitionBy(*groups).orderBy(*order)
    ranked = df.withColumn(rank_col, F.row_number().over(w))
    if k is not None:
        ranked = ranked.filter(F.col(rank_col) <= k)
    return ranked.withColumn(rank_col, F.col(rank_col).cast("bigint"))


def same_key(left: list[str], right: list[str]) -> Column:
    """Null-safe equality of two lists of columns."""
    return reduce(Column.__and__, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right)])


def first_by_key(df: DataFrame, key: str | list[str], order: str,
                 last: bool = False) -> DataFrame:
    """Keep one row per key: the first (or last) by ``order``; rows without an
    order come after all others (before them for ``last``), but a key that has
    no other row keeps one of them. Of rows that tie, the first (last) in the order
    in which they are written stays.

    The keys are counted first; where none repeats, ``df`` is the result and nothing is
    written. Otherwise rows are written once with an address. Only key, order and address are grouped,
    reduced map-side, and only keys that repeat are joined back: their rows stay by
    address. Payloads are neither sorted nor grouped, and move only where more keys
    repeat than may be broadcast.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").isEmpty():
        return df.select(*keys, *[c for c in df.columns if c not in keys])
    others = [c for c in df.columns if c not in keys]
    pick = F.max if last else F.min
    rows = materialize(df.withColumn("_address", F.monotonically_increasing_id()))
    mine, best = [f"_k{i}" for i in range(len(keys))], [f"_b{i}" for i in range(len(keys))]
    slim = rows.select(*[F.col(c).alias(k) for c, k in zip(keys, mine)], F.col(order).alias("_o"), "_address")
    repeated = (slim.groupBy(*mine).agg(pick("_o").alias("_best"), F.count(F.lit(1)).alias("_n"))
                .where("_n > 1").select(*[F.col(m).alias(b) for m, b in zip(mine, best)], "_best"))
    top = slim.join(repeated, same_key(mine, best) & F.col("_o").eqNullSafe(F.col("_best")))
    kept, small = measure_small(top.groupBy(*best).agg(pick("_address").alias("_kept")))
    kept = F.broadcast(kept) if small else kept.hint("shuffle_hash")
    out = rows.join(kept, same_key(keys, best), "left").where("_kept IS NULL OR _kept = _address")
    return out.select(*keys, *others)


def numbered(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """Add each row's place in its group, from 0, in the order of ``order`` (without
    ties). No task holds a group: rows are range-sorted and counted by (group, range),
    and a place is the rows of the group in the ranges before plus the place inside."""
    x = materialize(df.repartitionByRange(*group, *order).withColumn("_range", F.spark_partition_id()))
    theirs = [f"_g{i}" for i in range(len(group))]
    earlier = Window.partitionBy(*theirs).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    before = (x.groupBy(*[F.col(g).alias(t) for g, t in zip(group, theirs)], F.col("_range").alias("_r"))
              .agg(F.count(F.lit(1)).alias("_n")).withColumn("_n", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
              .where("_n > 0"))
    inside = F.row_number().over(Window.partitionBy("_range", *group).orderBy(*order)) - 1
    met = x.withColumn("_i", inside).join(
        before, same_key(group, theirs) & (F.col("_range") == F.col("_r")), "left")
    return met.select(*df.columns, (F.col("_i") + F.coalesce("_n", F.lit(0))).cast("bigint").alias(name))


def _row_bytes(df: DataFrame) -> Column:
    """Approximate in-memory bytes of a row: string/binary lengths, 8 bytes per
    array element, 8 per fixed-width value, plus 16 per column of overhead."""
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(t, T.ArrayType):
            parts.append(F.coalesce(F.size(c), F.lit(0)) * 8)
        else:
            parts.append(F.lit(8))
    total = F.lit(16 * len(df.schema.fields))
    for p in parts:
        total = total + p
    return total


def measure_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                  max_bytes: int = DEFAULT_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """``(frame, is_small)``: whether ``df`` holds at most ``max_rows`` rows and
    about ``max_bytes`` bytes. The frame is computed once, into the shared folder,
    measured there and used from there, small or not."""
    out = written(df, "measured")
    m = out.agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(out)).alias("b")).first()
    return out, m.n <= max_rows and (m.b or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                       max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` only when ``measure_small`` proves it small; otherwise the join
    sorts and shuffles. Its estimate counts bytes of written files, which repeated values
    make small, so that the driver would collect rows beyond the bounds."""
    out, small = measure_small(df, max_rows, max_bytes)
    return F.broadcast(out) if small else out.hint("merge")


def materialize(df: DataFrame) -> DataFrame:
    """Write an intermediate that is used more than once, so its lineage runs
    once; nothing stays cached."""
    return written(df, "table")


def round_out(c: str, decimals: int = OUT_DECIMALS) -> Column:
    return F.round(F.col(c), decimals).alias(c)
