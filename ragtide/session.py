"""Spark session helpers.

The library never creates machine-local scratch space on a cluster: every
materialisation (checkpoint, index table, file round trip) goes under the
shared folder named by ``spark.checkpoint.dir``. Only in local mode, and only
when that setting is missing, do we pick a temporary folder ourselves.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "ragtide", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^-\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="ragtide-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/ragtide-{name}-{uuid.uuid4().hex[:12]}"


#: Folders written inside the open ``temporary`` block, if one is open.
_TEMPORARY: ContextVar[list[str] | None] = ContextVar("temporary", default=None)


def remove_paths(spark: SparkSession, paths: list[str]) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        hp.getFileSystem(conf).delete(hp, True)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Remove what ``written`` leaves inside this block when it ends, also after an
    error. Frames of the block are of no use behind it, so finish their action inside,
    or write the result with ``keep``. Build indexes outside. Blocks may be nested."""
    mine: list[str] = []
    token = _TEMPORARY.set(mine)
    try:
        yield
    finally:
        _TEMPORARY.reset(token)
        remove_paths(spark, mine)


def written(df: DataFrame, name: str, keep: bool = False, group_rows: int | None = None) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost
    executors, holds no executor storage, and every later read sees the same
    rows. Files live as long as the folder, or as the ``temporary`` block that is
    open, unless ``keep`` is set. ``group_rows`` bounds the rows of a row group, which
    a writer and a reader hold at once: for rows of megabytes."""
    path = scratch_path(df.sparkSession, name)
    if not keep and (held := _TEMPORARY.get()) is not None:
        held.append(path)
    options = {"parquet.block.row.count.limit": group_rows} if group_rows else {}
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_bytes(spark: SparkSession, size: int) -> Iterator[None]:
    """Arrow batches that go to Python hold about ``size`` bytes in the actions of this block."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def ensure_parallel(df: DataFrame, factor: int = 2) -> DataFrame:
    """Spread a frame round-robin when its scan gives fewer partitions than
    the cluster can run at once (e.g. a file with a single row group).

    On large inputs (many files / row groups) the scan already has enough
    partitions and this is a no-op, so no extra shuffle is added at scale.
    """
    target = df.sparkSession.sparkContext.defaultParallelism * factor
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``ragtide`` importable in Python workers (pandas UDFs reference it).

    The package is zipped once per application into the shared checkpoint
    folder and registered with ``addPyFile``, which works for any Hadoop file
    system path, so it also reaches executors on other machines.
    """
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import io
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    target = scratch_path(spark, "pyfiles") + "/ragtide.zip"
    jvm = sc._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(target)
    fs = hpath.getFileSystem(sc._jsc.hadoopConfiguration())
    out = fs.create(hpath, True)
    try:
        out.write(bytearray(buf.getvalue()))
    finally:
        out.close()
    sc.addPyFile(target)
    _SHIPPED.add(key)
