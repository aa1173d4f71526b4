"""Small Hadoop-filesystem helpers (work for file://, hdfs://, s3a:// alike)."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_and_path(spark, path)
    return bool(fs.exists(p))


def rename(spark: SparkSession, src: str, dst: str) -> bool:
    fs, s = _fs_and_path(spark, src)
    _, d = _fs_and_path(spark, dst)
    return bool(fs.rename(s, d))


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()


def fingerprint(spark: SparkSession, folder: str) -> str:
    """Names, sizes and modification times of the files of a folder of tables
    (a table is a file or a folder of files)."""
    fs, p = _fs_and_path(spark, folder)
    if not fs.exists(p):
        return ""
    seen = []
    for table in fs.listStatus(p):
        for f in fs.listStatus(table.getPath()) if table.isDirectory() else [table]:
            seen.append(f"{table.getPath().getName()}/{f.getPath().getName()}:{f.getLen()}:{f.getModificationTime()}")
    return " ".join(sorted(seen))


def folder_bytes(spark: SparkSession, folder: str) -> int:
    fs, p = _fs_and_path(spark, folder)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def write_parquet_atomic(df, path: str, sort_within: tuple[str, ...] = ()) -> str:
    """Write ``df`` as Parquet to ``path`` unless a finished copy exists.

    The data goes to a unique temporary folder first and is renamed into
    place, so a reader never sees a half-written table and a concurrent
    writer of the same table is harmless.
    """
    spark = df.sparkSession
    if exists(spark, f"{path}/_SUCCESS"):
        return path
    tmp = f"{path}.tmp-{uuid.uuid4().hex}"
    writer_df = df.sortWithinPartitions(*sort_within) if sort_within else df
    writer_df.write.mode("overwrite").parquet(tmp)
    if not rename(spark, tmp, path) and not exists(spark, f"{path}/_SUCCESS"):
        raise RuntimeError(f"could not move {tmp} to {path}")
    return path


def list_names(spark: SparkSession, folder: str) -> list[str]:
    fs, p = _fs_and_path(spark, folder)
    return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small text file unless there is one of that name; of several writers one succeeds.

    HDFS decides at creation, object stores with conditional writes when the file is closed
    (Hadoop's option for it is set and ignored by stores without), local disks by an exclusive
    open."""
    fs, p = _fs_and_path(spark, path)
    jvm = spark.sparkContext._jvm
    data = bytearray(text.encode("utf-8"))
    try:
        if fs.getUri().getScheme() == "file":
            local = jvm.java.io.File(p.toUri().getPath())
            local.getParentFile().mkdirs()
            option = spark.sparkContext._gateway.new_array(jvm.java.nio.file.OpenOption, 2)
            option[0] = jvm.java.nio.file.StandardOpenOption.CREATE_NEW
            option[1] = jvm.java.nio.file.StandardOpenOption.WRITE
            jvm.java.nio.file.Files.write(local.toPath(), data, option)
        else:
            out = fs.createFile(p).recursive().overwrite(False).opt("fs.option.create.conditional.overwrite", True).build()
            out.write(data)
            out.close()
    except Py4JJavaError as e:
        if fs.exists(p):
            return False
        raise RuntimeError(f"could not write {path}") from e
    return True


class CommitLog:
    """Numbered text entries in a folder: the highest complete one is the present state.

    An entry is added under the next free number, put if absent, so entries have one order
    and none replaces another; nothing is renamed or overwritten.  An entry without its
    closing mark (a writer died over it) counts as taken, but is passed over by readers."""

    END = "\n."

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _path(self, number: int) -> str:
        return f"{self.folder}/{number:020d}"

    def numbers(self) -> list[int]:
        return [int(n) for n in list_names(self.spark, self.folder) if n.isdigit()]

    def read(self, number: int) -> str | None:
        text = read_text(self.spark, self._path(number))
        return text[:-len(self.END)] if text is not None and text.endswith(self.END) else None

    def entries(self) -> list[tuple[int, str]]:
        return [(n, text) for n in self.numbers() if (text := self.read(n)) is not None]

    def latest(self) -> tuple[int, str] | None:
        for n in reversed(self.numbers()):
            text = self.read(n)
            if text is not None:
                return n, text
        return None

    def append(self, text: str, after: int | None = None) -> int | None:
        """Add an entry; its number.  With ``after`` (the entry the writer has seen, 0 for none)
        only directly behind it: None if another writer was there first."""
        number = (max(self.numbers(), default=0) if after is None else after) + 1
        while not put_if_absent(self.spark, self._path(number), text + self.END):
            if after is not None:
                return None
            number += 1
        return number
