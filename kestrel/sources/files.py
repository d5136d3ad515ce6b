"""File sources and sinks.

Scratch output goes below the shared checkpoint folder (``scratch_path``),
never to a machine-local temporary folder.
"""

from __future__ import annotations

import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.session import checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), "kestrel-io", f"{name}-{uuid.uuid4().hex}")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, sep: str = ",",
             header: bool = True, index_col: str | None = None) -> DataFrame:
    """CSV with an explicit schema (inference would cost a second pass);
    ``index_col`` drops a saved index column."""
    r = spark.read.option("header", header).option("sep", sep)
    df = r.schema(schema).csv(path) if schema is not None else r.option("inferSchema", True).csv(path)
    return df.drop(index_col) if index_col else df


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True, columns: list[str] | None = None,
              mode: str = "overwrite") -> str:
    (df.select(*(columns or df.columns)).write.mode(mode).option("sep", sep).option("header", header).csv(path))
    return path


# Fixed value: full microsecond precision for timestamps in JSON text.
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return (spark.read.schema(schema).option("timestampNTZFormat", TS_FORMAT)
            .option("timestampFormat", TS_FORMAT).json(path))


def write_jsonl(df: DataFrame, path: str) -> str:
    (df.write.mode("overwrite").option("timestampNTZFormat", TS_FORMAT)
       .option("timestampFormat", TS_FORMAT).json(path))
    return path


def read_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def write_text_ids(df: DataFrame, col: str, path: str) -> str:
    df.select(F.col(col).cast("string").alias("value")).write.mode("overwrite").text(path)
    return path


def write_per_value(df: DataFrame, key: str, path: str) -> str:
    """One folder per value of a column with few values (train / valid / test)."""
    df.write.mode("overwrite").partitionBy(key).parquet(path)
    return path


def write_per_key(df: DataFrame, key: str, path: str, folders: int = 64) -> str:
    """The "file per key" idiom for a column of any cardinality: keys are hashed into a
    fixed number of folders and stay a column, so a reader of one key opens one folder."""
    bucket = F.pmod(F.xxhash64(key), F.lit(folders)).cast("int").alias("_folder")
    df.select("*", bucket).write.mode("overwrite").partitionBy("_folder").parquet(path)
    return path


def read_per_key(spark: SparkSession, path: str, schema: T.StructType, key: str, value=None,
                 folders: int = 64) -> DataFrame:
    """All rows of ``write_per_key``, or those of one key (one folder is listed).  The schema is
    given, so no value is read as another type."""
    df = spark.read.schema(T.StructType([*schema.fields, T.StructField("_folder", T.IntegerType())])).parquet(path)
    if value is not None:
        same = F.lit(value).cast(schema[key].dataType)
        df = df.where((F.col("_folder") == F.pmod(F.xxhash64(same), F.lit(folders)).cast("int")) & (F.col(key) == same))
    return df.drop("_folder")


def cached_convert(spark: SparkSession, converted: str, produce) -> DataFrame:
    """Use the converted Parquet copy when present and non-empty, else build it once
    (``produce()`` returns the raw DataFrame) and read it back.  Only a missing copy is
    taken as missing; any other read error is raised and the copy left alone."""
    try:
        got = spark.read.parquet(converted)
        if got.limit(1).count() > 0:
            return got
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    produce().write.mode("overwrite").parquet(converted)
    return spark.read.parquet(converted)


def bounded_show(df: DataFrame, n: int = 20) -> list:
    """Console sink: at most ``n`` rows ever reach the driver."""
    return df.limit(n).collect()
