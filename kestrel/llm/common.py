"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.session import checkpoint_dir

#: Bytes that separate words, as a Java / Python character class.
SPACE_CLASS = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared folder of ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, so a
    lost executor only repeats reads, and several consumers do not recompute it."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet").select(*cols)


def laid_out(parts: list[bytes], kind: str, index, ends) -> list[bytes]:
    """``b"".join(parts[k] for k in index[ends[i]:ends[i + 1]])`` for every i, where each part is
    a run of numbers of numpy type ``kind``."""
    import numpy as np

    flat = np.frombuffer(b"".join(parts), kind)
    size = np.fromiter(map(len, parts), np.int64, len(parts)) // flat.itemsize
    first = np.cumsum(size) - size
    n = size[index]
    stop = np.concatenate([np.zeros(1, np.int64), np.cumsum(n)])
    out = flat[np.arange(stop[-1]) + np.repeat(first[index] - stop[:-1], n)]
    cut = stop[ends]
    return [out[i:j].tobytes() for i, j in zip(cut, cut[1:])]


def runs_of(values: list[str], chars: int = 1 << 22):
    """``values`` in runs of about ``chars`` characters: bounds what is held at once."""
    run, size = [], 0
    for v in values:
        run.append(v)
        size += len(v)
        if size >= chars:
            yield run
            run, size = [], 0
    if run:
        yield run


def release_memory() -> None:
    """Give a worker's freed memory back to the system: called at a task's end, since idle
    workers stay alive beside the next stage."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # a C library without it
        pass
