"""Category encoding, assembling and scaling."""

from __future__ import annotations

from pyspark.ml.feature import HashingTF, OneHotEncoder, StringIndexer, Tokenizer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def string_index(df: DataFrame, col: str, out: str, order: str = "frequencyDesc",
                 handle_invalid: str = "error") -> DataFrame:
    """Category -> index (most frequent first; ties alphabetical)."""
    model = StringIndexer(inputCol=col, outputCol=out, stringOrderType=order,
                          handleInvalid=handle_invalid).fit(df)
    return model.transform(df)


def one_hot(df: DataFrame, col: str, out: str, drop_last: bool = True) -> DataFrame:
    idx = string_index(df, col, col + "_idx")
    return OneHotEncoder(inputCols=[col + "_idx"], outputCols=[out], dropLast=drop_last).fit(idx).transform(idx)


MAX_CATEGORIES = 2_000


def dummies(df: DataFrame, col: str, prefix: str | None = None, with_na: bool = False,
            categories: list[str] | None = None) -> DataFrame:
    """One 0/1 column per category (sorted), no category dropped; with_na adds
    ``<prefix>_nan`` for nulls.  The category list is one distinct aggregate, taken once;
    a column of more than ``MAX_CATEGORIES`` values is no category column and raises."""
    prefix = prefix or col
    if categories is None:
        found = df.select(col).where(F.col(col).isNotNull()).distinct().take(MAX_CATEGORIES + 1)
        if len(found) > MAX_CATEGORIES:
            raise ValueError(f"{col!r} has more than {MAX_CATEGORIES} values")
        categories = sorted(r[0] for r in found)
    cols = {f"{prefix}_{c}": F.coalesce((F.col(col) == F.lit(c)), F.lit(False)).cast("int") for c in categories}
    if with_na:
        cols[f"{prefix}_nan"] = F.col(col).isNull().cast("int")
    return df.withColumns(cols)


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(df)


def zscore(df: DataFrame, cols: list[str], fit_on: DataFrame | None = None, suffix: str = "") -> DataFrame:
    """(x - mean) / population std; statistics from ``fit_on`` (e.g. the train split)."""
    src = fit_on if fit_on is not None else df
    stats = src.agg(*[F.avg(c).alias(f"_m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"_s_{c}") for c in cols])
    j = df.crossJoin(F.broadcast(stats))  # one row
    j = j.withColumns({c + suffix: F.try_divide(F.col(c) - F.col(f"_m_{c}"), F.col(f"_s_{c}")) for c in cols})
    return j.drop(*[f"_m_{c}" for c in cols], *[f"_s_{c}" for c in cols])


def tokenize(df: DataFrame, col: str, out: str = "words") -> DataFrame:
    """Lower case, split on white space."""
    return Tokenizer(inputCol=col, outputCol=out).transform(df)


def hashed_tf(df: DataFrame, col: str, out: str = "tf", num_features: int = 1000) -> DataFrame:
    return HashingTF(inputCol=col, outputCol=out, numFeatures=num_features).transform(df)
