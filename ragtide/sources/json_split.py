"""Members of large JSON lists and objects, read by many tasks.

Spark's text reader cuts a file at its commas, split by split, on any file system it
knows. Whether a comma separates two members depends on what stands before it: the
text must be outside a string and at depth one. A first pass gives, for each split
and both possible string states at its start, the state and depth at its end and how
often it was outside a string at each depth. These few numbers of each split are
chained in file order; a second pass then knows every split's start and numbers the
members. Only members that cross splits are put together after a shuffle.

A task holds one batch and one member. A file that is neither a list nor an object,
or does not close, raises.
"""

from __future__ import annotations

import json
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package

ESCAPED = re.compile(r"\\.", re.S)
SPACE = " \t\r\n﻿"


def step(text: str, inside: int) -> tuple[int, int]:
    """The string state after a piece of JSON, and the change of depth in it."""
    parts = ESCAPED.sub("", text).split('"')
    depth = sum(p.count("{") + p.count("[") - p.count("}") - p.count("]") for p in parts[inside::2])
    return inside ^ (len(parts) + 1) % 2, depth


def _pieces(batches):
    """(file, start of the split, piece) in order."""
    for b in batches:
        yield from zip(*(b.column(c).to_pylist() for c in ("file", "block", "value")))


def _summaries(batches):
    found: dict[tuple, list] = {}
    for file, block, value in _pieces(batches):
        # for each state at the start: state and depth so far, commas outside strings by depth
        ends = found.setdefault((file, block), [[0, 0, Counter()], [1, 0, Counter()], value.lstrip(SPACE)[:1]])
        for end in ends[:2]:
            end[0], change = step(value, end[0])
            end[1] += change
            if not end[0]:
                end[2][end[1]] += 1
    rows = [(f, b, json.dumps([[s, d, sorted(c.items())] for s, d, c in e[:2]]), e[2]) for (f, b), e in found.items()]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], ["file", "block", "ends", "head"])


def _members(starts):
    def run(batches):
        where, rows, held = None, [], []
        inside = depth = number = 0
        edge = True

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], ["file", "block", "ord", "edge", "value"])
            rows.clear()
            return out

        for file, block, value in _pieces(batches):
            if (file, block) != where:
                if held:
                    rows.append((*where, number, True, ",".join(held)))
                where, held, edge = (file, block), [], True
                inside, depth, number = starts.value[where]
            inside, change = step(value, inside)
            depth += change
            held.append(value)
            if not inside and depth == 1:
                rows.append((file, block, number, edge, ",".join(held)))
                held, number, edge = [], number + 1, False
            if len(rows) >= 10_000:
                yield flush()
        if held:
            rows.append((*where, number, True, ",".join(held)))
        if rows:
            yield flush()
    return run


def json_members(spark: SparkSession, files: list[str]) -> DataFrame:
    """``(file, ord, kind, value)``: text of each member of the JSON list (kind '[')
    or object ('{', a ``"key": value`` pair) in each file, numbered from 0."""
    ship_package(spark)
    pieces = spark.read.option("lineSep", ",").text(files).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    # one row for each split of the files
    found = sorted(pieces.mapInArrow(_summaries, "file string, block bigint, ends string, head string").collect())
    starts, kinds, counts = {}, {}, {}
    inside = depth = number = 0
    for k, (file, block, ends, head) in enumerate(found):
        if file not in kinds:
            inside = depth = number = 0
            kinds[file] = head
        starts[file, block] = inside, depth, number
        inside, change, commas = json.loads(ends)[inside]
        number, depth = number + dict(map(tuple, commas)).get(1 - depth, 0), depth + change
        counts[file] = number + 1
        if k + 1 == len(found) or found[k + 1].file != file:
            if inside or depth or kinds[file] not in ("{", "["):
                raise ValueError(f"{file} holds no JSON list or object")
    parts = pieces.mapInArrow(_members(spark.sparkContext.broadcast(starts)),
                              "file string, block bigint, ord bigint, edge boolean, value string")
    crossing = (parts.where("edge").groupBy("file", "ord")
                .agg(F.array_sort(F.collect_list(F.struct("block", "value"))).alias("parts"))
                .select("file", "ord", F.array_join(F.transform("parts", lambda p: p["value"]), ",").alias("value")))
    members = parts.where("not edge").select("file", "ord", "value").unionByName(crossing)
    ends = spark.createDataFrame([(f, kinds[f], n) for f, n in counts.items()], "file string, kind string, n bigint")
    trimmed = F.btrim("value", F.lit(SPACE))
    opened = F.when(F.col("ord") == 0, F.substring(trimmed, F.lit(2), F.char_length(trimmed))).otherwise(trimmed)
    closed = F.when(F.col("ord") == F.col("n") - 1, F.substring(opened, F.lit(1), F.char_length(opened) - 1)).otherwise(opened)
    return (members.join(F.broadcast(ends), "file").select("file", "ord", "kind", "n", F.btrim(closed, F.lit(SPACE)).alias("value"))
            .where((F.col("value") != "") | (F.col("n") > 1)).drop("n"))
