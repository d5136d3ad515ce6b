"""Column profiling in single aggregation passes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.operators.order import exact_quantiles


def _unpivot(wide: DataFrame, cols: list[str], stats: list[str]) -> DataFrame:
    """Wide one-row ``<col>__<stat>`` aggregate -> one row per column."""
    arr = F.array(*[F.struct(F.lit(c).alias("column"),
                             *[F.col(f"{c}__{s}").alias(s) for s in stats]) for c in cols])
    return wide.select(F.inline(arr))


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """count / mean / sample std / min / max per column, numeric (not strings)."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__stddev"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    return _unpivot(df.agg(*aggs), cols, ["count", "mean", "stddev", "min", "max"])


def summary_pct(df: DataFrame, cols: list[str]) -> DataFrame:
    """describe + exact 25/50/75 % (linear interpolation, as pandas), the quantiles by
    distributed ranks."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    base = _unpivot(df.agg(*aggs), cols, ["count", "mean", "std", "min", "max"])
    q = exact_quantiles(df, [], cols, [0.25, 0.5, 0.75])
    return base.join(q, "column", "left").select("column", "count", "mean", "std", "min", F.col("q0").alias("p25"),
                                                 F.col("q1").alias("p50"), F.col("q2").alias("p75"), "max")


def min_max_mean_median(df: DataFrame, cols: list[str]) -> DataFrame:
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max"),
                 F.avg(x).alias(f"{c}__mean")]
    base = _unpivot(df.agg(*aggs), cols, ["min", "max", "mean"])
    q = exact_quantiles(df, [], cols, [0.5])
    return base.join(q, "column", "left").select("column", "min", "max", "mean", F.col("q0").alias("median"))


def null_counts(df: DataFrame) -> DataFrame:
    cols = df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}__nulls") for c in cols])
    return _unpivot(wide, cols, ["nulls"])


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def schema_table(df: DataFrame) -> DataFrame:
    """Column names and types (metadata only: no job runs)."""
    return df.sparkSession.createDataFrame(
        [(i, n, t) for i, (n, t) in enumerate(df.dtypes)], "pos int, column string, type string")


def unique_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values, null included (as pandas ``unique``)."""
    return df.select(F.col(col).alias("value")).distinct()


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Frequencies, nulls dropped, most frequent first."""
    return (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value"))
              .agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), F.asc("value")))


def group_size(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(
        F.count(F.lit(1)).alias("size"))


def month_counter(df: DataFrame, ts_col: str) -> DataFrame:
    """Rows per month taken as the second '-' part of the timestamp text."""
    month = F.split_part(F.col(ts_col).cast("string"), F.lit("-"), F.lit(2))
    return df.groupBy(month.alias("month")).agg(F.count(F.lit(1)).alias("count"))


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width bins between min and max; the last bin is closed.

    The two bounds come from one aggregate (a single row, broadcast).
    """
    x = F.col(col).cast("double")
    rng = df.agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    idx = F.least(F.floor(F.try_divide(x - F.col("_lo"), F.col("_hi") - F.col("_lo")) * F.lit(bins)),
                  F.lit(bins - 1))
    d = df.where(x.isNotNull()).crossJoin(F.broadcast(rng))
    return (d.groupBy(F.coalesce(idx, F.lit(0)).cast("long").alias("bin"), "_lo", "_hi")
             .agg(F.count(F.lit(1)).alias("count"))
             .select("bin", (F.col("_lo") + F.col("bin") * width).alias("left"),
                     (F.col("_lo") + (F.col("bin") + 1) * width).alias("right"), "count"))


def nunique_ratio(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.try_divide(F.count_distinct(col), F.count(F.lit(1))).alias("ratio"))


def corr_matrix(df: DataFrame, cols: list[str], lower_only: bool = True) -> DataFrame:
    """Pearson matrix after dropping rows with any null, as (i, j, corr) with i > j."""
    d = df.select(*cols).dropna()
    pairs = [(i, j) for i in range(len(cols)) for j in range(len(cols)) if (i > j if lower_only else True)]
    wide = d.agg(*[F.corr(cols[i], cols[j]).alias(f"c_{i}_{j}") for i, j in pairs])
    arr = F.array(*[F.struct(F.lit(cols[i]).alias("row"), F.lit(cols[j]).alias("col"),
                             F.col(f"c_{i}_{j}").alias("corr")) for i, j in pairs])
    return wide.select(F.inline(arr))


def weighted_mean(df: DataFrame, group_cols: list[str], w: str, v: str, out: str) -> DataFrame:
    """sum(w*v)/sum(w); a null v adds 0 to the top while its weight stays in the bottom."""
    return df.groupBy(*group_cols).agg(
        F.try_divide(F.sum(F.coalesce(F.col(w) * F.col(v), F.lit(0.0))), F.sum(w)).alias(out))
