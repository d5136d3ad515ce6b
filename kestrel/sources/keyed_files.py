"""One file per key, and array files.

``keyed_files`` is a Spark data source to write to: rows (key, content) become one file per
key, named by it (characters other than letters, digits, ``-``, ``_`` and ``.`` are percent-encoded, so
different keys never share a name).  Rows must come sorted by key within their partition, with all rows of a key
in one partition; ``write_keyed`` sees to it.  A file is streamed, however many rows its key has.

The write has two phases.  Tasks write below a staging folder of the job, one folder per attempt.
When all have ended, the driver moves the files of the attempts that count; if the job
fails, the staging folder goes and no file is left.  An existing file of the same name is
replaced.  Moving is one metadata call a file, as in Spark's own committer.

Array files (``.npy``) are read with Spark's ``binaryFile``, so partitions follow the files' sizes
and any store that Spark reads will do; headers are parsed and checked in the tasks.
"""

from __future__ import annotations

import io
import uuid
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from kestrel.session import ship_package


def file_name(key: str, extension: str) -> str:
    """Injective name of a key's file, never a hidden one."""
    name = quote(key, safe="")
    if name[0] in "._":
        name = f"%{ord(name[0]):02X}{name[1:]}"
    return name + extension


def folder_of(uri: str):
    """(file system, path) of a folder, for tasks that write files themselves."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


@dataclass
class Written(WriterCommitMessage):
    staged: str
    names: list[str]


class KeyedWriter(DataSourceWriter):
    def __init__(self, path: str, extension: str):
        self._path, self._extension = path.rstrip("/"), extension
        self._staging = f"{self._path}/_staging-{uuid.uuid4().hex}"

    def write(self, iterator) -> Written:
        from pyspark import TaskContext

        task = TaskContext.get()
        fs, base = folder_of(self._staging)
        own = f"{base}/{task.partitionId():06d}-{task.taskAttemptId()}"
        names, at, out = [], None, None
        try:
            for key, content in iterator:
                if not key:
                    raise ValueError("a row without a key has no file")
                if key != at:
                    if out is not None:
                        out.close()
                    else:
                        fs.create_dir(own, recursive=True)
                    name = file_name(key, self._extension)
                    if fs.get_file_info(f"{own}/{name}").type.name != "NotFound":
                        raise ValueError(f"rows of {key!r} are not together")
                    at, out = key, fs.open_output_stream(f"{own}/{name}")
                    names.append(name)
                out.write(bytes(content or b""))
        finally:
            if out is not None:
                out.close()
        return Written(own, names)

    def commit(self, messages) -> None:
        fs, base = folder_of(self._path)
        made = [(m.staged, n) for m in messages if m is not None for n in m.names]
        if len({n for _, n in made}) < len(made):
            self.abort(messages)
            raise ValueError("a key has rows in several partitions")
        fs.create_dir(base, recursive=True)
        for staged, name in made:
            fs.move(f"{staged}/{name}", f"{base}/{name}")
        self._clear()

    def abort(self, messages) -> None:
        self._clear()

    def _clear(self) -> None:
        fs, staging = folder_of(self._staging)
        if fs.get_file_info(staging).type.name == "Directory":
            fs.delete_dir(staging)


class KeyedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "keyed_files"

    def schema(self) -> str:
        return "key string, content binary"

    def writer(self, schema, overwrite: bool) -> KeyedWriter:
        return KeyedWriter(self.options["path"], self.options.get("extension", ""))


def write_keyed(df: DataFrame, key: str, content: str, path: str, extension: str, order: list[str] = ()) -> str:
    """Write one file per value of ``key``: the bytes of ``content`` of its rows, by ``order``.  Rows with a
    null or empty key raise."""
    spark = df.sparkSession
    ship_package(spark)
    spark.dataSource.register(KeyedFiles)
    rows = df.select(F.col(key).cast("string").alias("key"), F.col(content).cast("binary").alias("content"),
                     *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])
    rows = rows.repartition("key").sortWithinPartitions("key", *[f"_o{i}" for i in range(len(order))]).select("key", "content")
    rows.write.format("keyed_files").option("path", path).option("extension", extension).mode("append").save()
    return path


def read_keyed(spark: SparkSession, path: str, extension: str) -> DataFrame:
    """(key, content) of the files of ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{extension}").load(path)

    name = F.element_at(F.split("path", "/"), -1)
    key = F.expr(f"substr(_name, 1, length(_name) - {len(extension)})")
    # url_decode takes a plus for a space
    return files.withColumn("_name", name).select(F.url_decode(F.regexp_replace(key, r"\+", "%2B")).alias("key"), "content")


def write_arrays(df: DataFrame, key: str, array: str, path: str) -> str:
    """One ``.npy`` file of doubles per row: ``array`` is an array of numbers, or of rows of equal length."""
    ship_package(df.sparkSession)

    def packed(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            out = []
            for cells in b.column(array).to_pylist():
                file = io.BytesIO()
                np.save(file, np.asarray([] if cells is None else cells, np.float64), allow_pickle=False)
                out.append(file.getvalue())
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(out, pa.binary())], names=["key", "content"])
    rows = df.select(F.col(key).cast("string").alias("key"), array).mapInArrow(packed, "key string, content binary")
    return write_keyed(rows, "key", "content", path, ".npy")


def read_arrays(spark: SparkSession, path: str, columns: int | None = None) -> DataFrame:
    """(key, shape, rows) of the ``.npy`` files of ``path``; ``rows`` are the rows of a matrix, or one row of
    numbers.  Files of other than numbers, of more than two dimensions or, if given, with
    other than ``columns`` numbers a row raise."""
    ship_package(spark)

    def opened(batches):
        import numpy as np
        import pyarrow as pa

        for whole in batches:
            for i in range(whole.num_rows):  # a file at a time
                b = whole.slice(i, 1)
                key = b.column("key")[0].as_py()
                a = np.load(io.BytesIO(b.column("content")[0].as_py()), allow_pickle=False)
                if a.dtype.kind not in "fiub" or a.ndim > 2:
                    raise ValueError(f"{key}: {a.ndim} dimensions of {a.dtype}")
                table = np.atleast_2d(a) if a.size or a.ndim < 2 else a
                if columns is not None and table.shape[0] and a.size and table.shape[1] != columns:
                    raise ValueError(f"{key}: rows of {table.shape[1]} numbers, not {columns}")
                rows = table.astype(np.float64).tolist() if a.size else []
                yield pa.RecordBatch.from_arrays(
                    [b.column("key"), pa.array([list(a.shape)], pa.list_(pa.int64())), pa.array([rows], pa.list_(pa.list_(pa.float64())))],
                    names=["key", "shape", "rows"])
    return read_keyed(spark, path, ".npy").mapInArrow(opened, "key string, shape array<long>, rows array<array<double>>")
