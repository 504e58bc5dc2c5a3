"""Answers of an external text generator, asked once for each distinct request.

A request's key is the SHA-256 of its options and prompt. Answers are appended to a
Parquet store, wave by wave: each wave is one Spark job over at most about
``wave_rows`` requests, read from the wave's own folder, and its answers count once that job commits. A later run
reads the store and asks only for what is missing, so that a killed run repeats at
most the wave it was in. A request that fails after ``retries`` more attempts is kept
with its error and asked again by the next run.

The client is made in each task by ``client()`` and has ``generate(prompt,
**options)``, which returns the answer's text, or a dict with ``response`` and
optionally ``eval_count`` and ``eval_duration``. At most ``parallel`` tasks of a wave
talk to it at once.

Defined cases: a null prompt is not asked and has no answer; equal prompts share an
answer; an empty table makes no calls.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package
from .topk import materialize

# The options the reference generates with.
OPTIONS = {"num_predict": 128, "temperature": 0.3, "top_p": 0.9, "num_ctx": 3072}
WAVE_ROWS, PARALLEL, RETRIES = 10_000, 8, 2
STORE = "key string, generated string, eval_count bigint, eval_duration double, error string"


def request_key(prompt: str, options: dict):
    return F.sha2(F.concat(F.lit(json.dumps(options, sort_keys=True) + "\0"), F.col(prompt)).cast("binary"), 256)


def _ask(client: Callable, options: dict, retries: int):
    def run(batches):
        asked = None
        for b in batches:
            rows = []
            for key, prompt in zip(b.column("key").to_pylist(), b.column("prompt").to_pylist()):
                error = None
                for _ in range(retries + 1):
                    try:
                        asked = asked or client()
                        got = asked.generate(prompt, **options)
                        got = got if isinstance(got, dict) else {"response": got}
                        rows.append((key, got["response"], got.get("eval_count"), got.get("eval_duration"), None))
                        break
                    except Exception as e:  # any failure of the outside service
                        error = f"{type(e).__name__}: {e}"
                else:
                    rows.append((key, None, None, None, error))
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.string(), pa.string(), pa.int64(), pa.float64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             [c.split()[0] for c in STORE.split(", ")])
    return run


def path_exists(spark: SparkSession, path: str) -> bool:
    hp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hp)


def stored_answers(spark: SparkSession, store: str) -> DataFrame:
    """One row for each answered key; an empty frame where nothing is stored yet."""
    if not path_exists(spark, store):
        return spark.createDataFrame([], STORE)
    rows = spark.read.schema(STORE).parquet(store)
    # two runs at the same time may both have asked: either answer will do
    return rows.where("error is null").dropDuplicates(["key"])


def generate(prompts: DataFrame, client: Callable, store: str | None = None, id_col: str = "ID",
             prompt_col: str = "prompt", options: dict | None = None, wave_rows: int = WAVE_ROWS,
             parallel: int = PARALLEL, retries: int = RETRIES) -> DataFrame:
    """``(ID, generated, eval_count, eval_duration)`` for each row of ``prompts``."""
    spark = prompts.sparkSession
    ship_package(spark)
    options = OPTIONS if options is None else options
    store = store or scratch_path(spark, "answers")
    keyed = materialize(prompts.select(F.col(id_col).alias("ID"), F.col(prompt_col).alias("prompt")).withColumn(
        "key", request_key("prompt", options)).withColumn("_at", F.monotonically_increasing_id()))
    # what is missing is found by key; a prompt is written once, into the folder of its wave
    missing = materialize(keyed.where("prompt is not null").groupBy("key").agg(F.min("_at").alias("_at"))
                          .join(stored_answers(spark, store).select("key"), "key", "left_anti"))
    waves = -(-missing.count() // wave_rows)
    if waves:
        wave_of = F.pmod(F.xxhash64("key"), F.lit(waves)).cast("int")
        queue = scratch_path(spark, "waves")
        (keyed.join(missing, ["key", "_at"], "left_semi").select("key", "prompt", wave_of.alias("wave"))
         .repartition(max(waves, parallel), "wave", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(parallel)))
         .write.partitionBy("wave").parquet(queue))
    for wave in range(waves):
        if not path_exists(spark, f"{queue}/wave={wave}"):
            continue  # no key fell into it
        part = spark.read.schema("key string, prompt string").parquet(f"{queue}/wave={wave}")
        (part.repartition(parallel, "key").mapInArrow(_ask(client, options, retries), STORE)
         .write.mode("append").parquet(store))
    answers = stored_answers(spark, store)
    return keyed.select("ID", "key").join(answers, "key", "left").select(
        F.col("ID").alias(id_col), "generated", "eval_count", "eval_duration")


class LocalClient:
    """A generator without a model, for runs without a service: it answers with a
    choice that follows the prompt's length."""

    def generate(self, prompt: str, **options) -> dict:
        return {"response": f"답변: {len(prompt) % 4 + 1}", "eval_count": min(len(prompt), options["num_predict"])}
