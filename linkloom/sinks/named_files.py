"""Text files that the tasks name themselves, published together.

Spark's own writers choose the names of files.  Here each task streams its lines into files named
by a column and moves each file to its name when it is complete, so a repeated task replaces what
it wrote before.  All goes to a folder beside the target; when every task has reported, that folder
takes the target's place in one step, whatever the number of files.  Until then readers see the old
files, and a failing task leaves them as they are.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class _Writer(DataSourceArrowWriter):
    def __init__(self, folder: str, files: int):
        self.folder, self.files = folder, files

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """Rows (name, value), those of one file together; a value is a line."""
        # files of the local system, HDFS and object stores go by the same interface
        from pyarrow.fs import FileSystem

        folder = self.folder.replace("s3a://", "s3://", 1)
        system, root = FileSystem.from_uri(folder if "://" in folder else "file://" + folder.removeprefix("file:"))
        names: list[str] = []
        out = hidden = None

        def close() -> None:
            if out is not None:
                out.close()
                system.move(hidden, posixpath.join(root, names[-1]))

        for batch in iterator:
            for name, value in zip(batch.column("name").to_pylist(), batch.column("value").to_pylist()):
                if not names or name != names[-1]:
                    close()
                    names.append(name)
                    system.create_dir(root, recursive=True)
                    hidden = posixpath.join(root, f".{name}.{uuid.uuid4().hex}")
                    out = system.open_output_stream(hidden)
                out.write(value.encode("utf-8", "surrogatepass") + b"\n")
        close()
        return Written(names)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        names = [name for message in messages if message is not None for name in message.names]
        if len(set(names)) != len(names) or len(names) != self.files:
            raise RuntimeError(f"{len(names)} files of {self.files} were written, {len(names) - len(set(names))} names twice")


class NamedFiles(DataSource):
    """``df.write.format("linkloom_named_files")`` of rows (name, value); option ``files`` is their number."""

    @classmethod
    def name(cls) -> str:
        return "linkloom_named_files"

    def schema(self) -> str:
        return "name string, value string"

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"], int(self.options["files"]))


def write_named(lines: DataFrame, path: str, files: int) -> None:
    """Write ``lines(name, value)``, laid out so that a task has all lines of a file together and in order.

    ``files`` is the number of files that have to come of it.  What was at ``path`` is replaced.
    """
    spark = lines.sparkSession
    spark.dataSource.register(NamedFiles)
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    try:
        lines.select("name", "value").write.format(NamedFiles.name()).mode("append").option("files", files).save(staging)
        _publish(spark, staging, path)
    finally:
        _delete(spark, staging)


def _hadoop(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _delete(spark: SparkSession, path: str) -> None:
    system, folder = _hadoop(spark, path)
    system.delete(folder, True)


def _publish(spark: SparkSession, staging: str, path: str) -> None:
    system, target = _hadoop(spark, path)
    _, made = _hadoop(spark, staging)
    _, aside = _hadoop(spark, staging + "-old")
    system.mkdirs(made)  # no line, no task made it
    system.mkdirs(target.getParent())
    there = system.exists(target)
    if there and not system.rename(target, aside):
        raise RuntimeError(f"{path} could not be moved aside; nothing has changed")
    if not system.rename(made, target):
        if there:
            system.rename(aside, target)
        raise RuntimeError(f"{staging} could not be moved to {path}; the old files are back")
    if there:
        system.delete(aside, True)
