"""Projection, filtering and cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """NaN is not null in Spark; turn it into null once, at ingest."""
    fl = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    cols = [c for c in (cols or df.columns) if c in fl]
    return df.withColumns({c: F.when(F.isnan(c), F.lit(None)).otherwise(F.col(c)) for c in cols})


def all_null_columns(df: DataFrame) -> list[str]:
    """Columns without a single non-null value (one aggregate over the table)."""
    row = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if row[c] == 0]


def drop_all_null(df: DataFrame) -> DataFrame:
    return df.drop(*all_null_columns(df))


def split_xy(df: DataFrame, label: str | None = None) -> tuple[list[str], str]:
    """Named (or last) column is the label, all others are features."""
    label = label or df.columns[-1]
    return [c for c in df.columns if c != label], label


def rename_positional(df: DataFrame, names: list[str]) -> DataFrame:
    return df.toDF(*names)


def dropna_any(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    return df.dropna(how="any", subset=cols)


def with_min_group_size(df: DataFrame, group_col: str, min_rows: int) -> DataFrame:
    """Keep rows of groups (batches) that hold at least ``min_rows`` rows."""
    sizes = df.groupBy(group_col).agg(F.count(F.lit(1)).alias("_gsize"))
    return df.join(sizes, group_col).where(F.col("_gsize") >= min_rows).drop("_gsize")


def guard_violations(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One row: number of rows violating each named condition (0 = holds)."""
    return df.agg(*[F.count_if(~F.coalesce(c, F.lit(False))).alias(name) for name, c in checks.items()])


def assert_guards(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Fail the job on the first row that breaks a condition (``assert_true``)."""
    cond = None
    for name, c in checks.items():
        a = F.assert_true(F.coalesce(c, F.lit(False)), F.lit(f"guard failed: {name}"))
        cond = a if cond is None else F.coalesce(cond, a)
    return df.withColumn("_guard", cond).drop("_guard")
