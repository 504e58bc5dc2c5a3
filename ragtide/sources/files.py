"""File sources and sinks.

JSON Lines sources keep the position of every line (1-based, blank lines
counted, files in path order) because the reference derives ids from it and
lets the last duplicate win. Inside a file split ``monotonically_increasing_id``
is consecutive, so a line's position is ``split offset + (id - first id of the
split)``; only the per-split first id and count (one row per split) are
aggregated. The offsets stay a DataFrame and are broadcast back only when their
counted rows allow it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import py_strip
from ..operators.topk import broadcast_if_small, materialize
from . import csv_bom
from .json_split import json_members

STRING_CHILD_FIELDS = ("law_key", "start", "end", "title", "prefixed_text", "text", "law_name", "law_no")


def expand_paths(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Existing files for a path or glob (any Hadoop file system), sorted;
    folders are read with all folders inside them, missing paths are ignored."""
    paths = [path] if isinstance(path, str) else list(path)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out: list[str] = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        stats = fs.globStatus(hp)
        if stats is None:
            continue
        for st in stats:
            root = st.getPath().toString().rstrip("/")
            if not st.isDirectory():
                out.append(root)
                continue
            files = fs.listFiles(st.getPath(), True)
            while files.hasNext():
                name = files.next().getPath().toString()
                if not any(part.startswith(("_", ".")) for part in name[len(root):].split("/") if part):
                    out.append(name)
    return sorted(set(out))


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(value, ord)``: every line with its 1-based position across the
    files in path order. Missing paths give an empty frame."""
    files = expand_paths(spark, path)
    if not files:
        return spark.createDataFrame([], "value string, ord bigint")
    raw = spark.read.text(files).select(
        "value", F.col("_metadata.file_path").alias("_f"),
        F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_m"))
    splits = materialize(raw.groupBy("_f", "_b").agg(F.min("_m").alias("_m0"), F.count(F.lit(1)).alias("_n")))
    # offsets of splits inside a file, and of files (one row each) before a file
    inside = Window.partitionBy("_f").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("_f").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.groupBy("_f").agg(F.sum("_n").alias("_total")).select(
        "_f", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    off = (splits.withColumn("_off", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(starts, "_f")
           .select("_f", "_b", "_m0", (F.col("_off") + F.col("_start")).alias("_off")))
    x = raw.join(broadcast_if_small(off), ["_f", "_b"])
    return x.select("value", (F.col("_off") + F.col("_m") - F.col("_m0") + 1).alias("ord"))


def _parse(lines: DataFrame, schema: T.StructType, failfast: bool) -> DataFrame:
    """Parse non-blank lines; FAILFAST raises on a malformed line, otherwise
    malformed lines are dropped."""
    body = lines.filter(py_strip(F.col("value")) != "")
    if failfast:
        parsed = F.from_json(F.col("value"), schema, {"mode": "FAILFAST"})
        return body.select(parsed.alias("r"), "ord").select("r.*", "ord")
    full = T.StructType(schema.fields + [T.StructField("_corrupt_record", T.StringType())])
    parsed = F.from_json(F.col("value"), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    x = body.select(parsed.alias("r"), "ord").select("r.*", "ord")
    return x.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")


def _strings(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def scan_jsonl_corpus(spark: SparkSession, path: str, keep_law: bool = True) -> DataFrame:
    """``corpus(doc_id, ord, title, text[, law_name, law_no])``: ``doc_id`` is
    ``doc<line>`` (blank lines counted), ``title = law_name + " " + title``.
    A malformed line raises."""
    rows = _parse(read_lines(spark, path), _strings(["law_name", "law_no", "title", "text"]), failfast=True)
    cols = [F.concat(F.lit("doc"), F.col("ord").cast("string")).alias("doc_id"), "ord",
            F.concat(F.coalesce("law_name", F.lit("")), F.lit(" "), F.coalesce("title", F.lit(""))).alias("title"),
            F.coalesce("text", F.lit("")).alias("text")]
    if keep_law:
        cols += [F.coalesce("law_name", F.lit("")).alias("law_name"), F.col("law_no")]
    return rows.select(*cols)


def scan_jsonl_records(spark: SparkSession, path: str | None, fields) -> DataFrame:
    """All-string records of a JSONL path or glob with their line ``ord``;
    blank and malformed lines dropped, missing path -> empty frame."""
    if not path:
        return spark.createDataFrame([], _strings(fields).add("ord", T.LongType()))
    return _parse(read_lines(spark, path), _strings(fields), failfast=False)


def _with(fields: tuple[str, ...], text_fields: tuple[str, ...]) -> tuple[str, ...]:
    return fields + tuple(f for f in text_fields if f not in fields)


def scan_child_chunks(spark: SparkSession, path: str, text_fields: tuple[str, ...] = ()) -> DataFrame:
    """Child chunks; ``text_fields`` names further text fields to read."""
    return scan_jsonl_records(spark, path, _with(STRING_CHILD_FIELDS, tuple(text_fields)))


def scan_expanded(spark: SparkSession, path: str | None, text_fields: tuple[str, ...] = ()) -> DataFrame:
    """Expanded chunks; ``text_fields`` names further text fields to read."""
    fields = ("law_key", "start", "end", "prefixed_text", "text")
    return scan_jsonl_records(spark, path, _with(fields, tuple(text_fields)))


def scan_articles(spark: SparkSession, path: str | None) -> DataFrame:
    return scan_jsonl_records(spark, path, ("law_key", "head"))


def scan_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV, quoted fields may span lines, every column a string."""
    return (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
            .option("inferSchema", False).csv(path))


def scan_questions_csv(spark: SparkSession, path: str) -> DataFrame:
    return scan_csv(spark, path).select("ID", "Question")


def scan_submission(spark: SparkSession, path: str) -> DataFrame:
    return scan_csv(spark, path)


def scan_queries_any(spark: SparkSession, path: str | None = None, query: str | None = None,
                     fmt: str | None = None) -> DataFrame:
    """``(query_id, text)`` from a JSONL file (``id``/``qid``/``q<line>``,
    ``text``/``query``/""), a JSON object ``{id: text}``, a JSON list of
    records, or one literal query. The last duplicate id wins."""
    if path is None:
        if query is None:
            raise ValueError("a query file or a query is required")
        return spark.createDataFrame([("q1", query)], "query_id string, text string")
    def pick(*cols):
        return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])
    if fmt == "jsonl" or (fmt is None and path.endswith(".jsonl")):
        r = scan_jsonl_records(spark, path, ("id", "qid", "text", "query"))
        x = r.select(pick(F.col("id"), F.col("qid"), F.concat(F.lit("q"), F.col("ord").cast("string"))).alias("query_id"),
                     F.coalesce(pick(F.col("text"), F.col("query")), F.lit("")).alias("text"), "ord")
    else:
        members = json_members(spark, expand_paths(spark, path))
        # broken JSON raises
        strict = {"mode": "FAILFAST"}
        at = F.struct("file", "ord").alias("ord")
        pair = F.from_json(F.concat(F.lit("{"), F.col("value"), F.lit("}")), T.MapType(T.StringType(), T.StringType()), strict)
        objs = members.filter("kind = '{'").select(at, F.explode(pair).alias("query_id", "text"))
        lst = members.filter("kind = '['").select(
            "file", "ord", F.from_json("value", _strings(("id", "qid", "text", "query")), strict).alias("o")).select(
            pick(F.col("o.id"), F.col("o.qid"), F.concat(F.lit("q"), (F.col("ord") + 1).cast("string"))).alias("query_id"),
            F.coalesce(pick(F.col("o.text"), F.col("o.query")), F.lit("")).alias("text"), at)
        x = objs.select("query_id", F.coalesce("text", F.lit("")).alias("text"), "ord").unionByName(lst)
    from ..operators.grading import dedupe_last
    return dedupe_last(x, "query_id", "ord").select("query_id", "text")


def scan_rag_json(spark: SparkSession, paths: list[str], schema: T.StructType | str,
                  multi_line: bool = False) -> DataFrame:
    """Union of several JSON file sets read with one explicit schema."""
    files = expand_paths(spark, paths)
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", multi_line).json(files)


def write_submission(df: DataFrame, path: str, order: str | None = None, bom: bool = True) -> None:
    """CSV with a header; with ``bom`` every file opens with a byte-order mark, as
    spreadsheet programs expect. With ``order`` rows are range-sorted by that column,
    which is not written: part files in name order hold the template's row order."""
    if order:
        df = df.orderBy(order).drop(order)
    if bom:
        csv_bom.register(df.sparkSession)
        texts = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
        texts.write.format("csv_bom").mode("overwrite").save(path)
    else:
        df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
