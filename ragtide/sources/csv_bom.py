"""CSV files that open with a UTF-8 byte-order mark, which Spark's writer lacks.

``df.write.format("csv_bom").mode("overwrite" | "append").save(path)`` after
``register(spark)``. Each task streams its rows into a staged file; the driver moves
the files of finished tasks to ``part-<partition>-<job>.csv`` and then, for
``overwrite``, removes the files that stood there before. A failed job leaves the
folder as it was. Files hold the rows of one partition each, in order, under a header.
Nulls are empty cells, empty strings quoted ones; Spark's CSV reader takes both as null.

Files are written with ``pyarrow.fs``, which must reach the folder (``file://``,
``s3://``, ``gs://``, ``hdfs://``).
"""

from __future__ import annotations

import io
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StringType, StructType

from ..session import ship_package

BOM = "﻿"
SPECIAL = re.compile(r'[",\r\n]|^\s|\s$')


def cell(value: str | None) -> str:
    if value is None:
        return ""
    return '"' + value.replace('"', '""') + '"' if value == "" or SPECIAL.search(value) else value


def line(values) -> str:
    return ",".join(map(cell, values)) + "\n"


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """File system and plain path; a path without a scheme is a local one."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), re.sub(r"^file:/*", "/", path)
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


@dataclass
class Staged(WriterCommitMessage):
    partition: int
    path: str | None  # None: no rows


class BomCsvWriter(DataSourceWriter):
    def __init__(self, path: str, header: list[str], overwrite: bool):
        self.path, self.header, self.overwrite = path, header, overwrite
        self.job = uuid.uuid4().hex[:12]

    def _staging(self, folder: str) -> str:
        return f"{folder}/_staging-{self.job}"

    def prepare(self) -> None:
        """Runs on the driver: tasks never create the staging folder, so that one that
        outlives a failed job cannot bring it back."""
        files, folder = open_folder(self.path)
        files.create_dir(self._staging(folder), recursive=True)

    def write(self, iterator: Iterator[Row]) -> Staged:
        first, part = next(iterator, None), TaskContext.get().partitionId()
        if first is None:
            return Staged(part, None)
        files, folder = open_folder(self.path)
        # attempts of one task do not meet: only the committed one is moved
        path = f"{self._staging(folder)}/{part}-{uuid.uuid4().hex[:12]}"
        with io.TextIOWrapper(io.BufferedWriter(files.open_output_stream(path), 1 << 20), "utf-8", newline="") as out:
            out.write(BOM + line(self.header) + line(first))
            for row in iterator:
                out.write(line(row))
        return Staged(part, path)

    def commit(self, messages: list[Staged | None]) -> None:
        files, folder = open_folder(self.path)
        before = [f.path for f in files.get_file_info(fs.FileSelector(folder))
                  if f.type == fs.FileType.File and f.base_name.startswith("part-")]
        done = [m for m in messages if m is not None and m.path]
        for m in done:
            files.move(m.path, f"{folder}/part-{m.partition:05d}-{self.job}.csv")
        if not done:
            with files.open_output_stream(f"{folder}/part-00000-{self.job}.csv") as out:
                out.write((BOM + line(self.header)).encode())
        if self.overwrite:
            for path in before:
                files.delete_file(path)
        self._clear(files, folder)
        with files.open_output_stream(f"{folder}/_SUCCESS"):
            pass

    def abort(self, messages: list[Staged | None]) -> None:
        self._clear(*open_folder(self.path))

    def _clear(self, files: fs.FileSystem, folder: str) -> None:
        if files.get_file_info(self._staging(folder)).type == fs.FileType.Directory:
            files.delete_dir(self._staging(folder))


class BomCsv(DataSource):
    @classmethod
    def name(cls) -> str:
        return "csv_bom"

    def writer(self, schema: StructType, overwrite: bool) -> BomCsvWriter:
        other = [f.name for f in schema.fields if not isinstance(f.dataType, StringType)]
        if other:
            raise ValueError(f"cast these columns to strings first: {other}")
        writer = BomCsvWriter(self.options["path"], schema.names, overwrite)
        writer.prepare()
        return writer


def register(spark: SparkSession) -> None:
    ship_package(spark)
    spark.dataSource.register(BomCsv)
