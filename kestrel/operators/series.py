"""Long-series helpers: segment-parallel forward fill and halo windows.

A window partitioned only by a series key (symbol, stock) runs the whole
series in one task.  For series that can be long, rows are also cut into
fixed segments of the (contiguous, integer) order column:

* ``forward_fill`` fills inside each segment, then carries the last value of
  earlier segments through a window over the per-segment table (one row per
  segment, so it is small).
* ``with_halo`` copies the ``back`` last rows of each segment into the next one
  and the ``fwd`` first rows into the previous one, so lags up to ``back`` and
  leads up to ``fwd`` can be computed per segment exactly; ``core`` marks the
  rows to keep afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_SEGMENT = 1 << 16


def forward_fill(df: DataFrame, key_cols: list[str], order_col: str, fill_cols: list[str],
                 segment: int = DEFAULT_SEGMENT) -> DataFrame:
    """Replace nulls in each ``fill_cols`` column by the last non-null earlier value."""
    seg = F.floor(F.col(order_col) / segment)
    d = df.withColumn("_seg", seg)
    w = (Window.partitionBy(*key_cols, "_seg").orderBy(order_col)
         .rowsBetween(Window.unboundedPreceding, 0))
    d = d.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in fill_cols})
    # last non-null per segment, carried over later segments
    lasts = d.groupBy(*key_cols, "_seg").agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order_col))).alias(c + "_seglast")
          for c in fill_cols])
    ws = Window.partitionBy(*key_cols).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    carry = lasts.select(*key_cols, "_seg",
                         *[F.last(c + "_seglast", ignorenulls=True).over(ws).alias(c + "_carry")
                           for c in fill_cols])
    out = d.join(carry, [*key_cols, "_seg"], "left")
    out = out.withColumns({c: F.coalesce(F.col(c), F.col(c + "_carry")) for c in fill_cols})
    return out.drop("_seg", *[c + "_carry" for c in fill_cols])


def with_halo(df: DataFrame, order_col: str, back: int, fwd: int,
              segment: int = DEFAULT_SEGMENT) -> DataFrame:
    """Add ``_seg`` and ``core``; rows near segment edges are duplicated as halo."""
    seg = max(segment, 2 * (back + fwd) + 1)
    pos = F.pmod(F.col(order_col), F.lit(seg))
    base = F.floor(F.col(order_col) / seg)
    tags = [F.struct(base.alias("s"), F.lit(True).alias("core"))]
    if back:
        tags.append(F.when(pos >= seg - back, F.struct((base + 1).alias("s"), F.lit(False).alias("core"))))
    if fwd:
        tags.append(F.when(pos < fwd, F.struct((base - 1).alias("s"), F.lit(False).alias("core"))))
    arr = F.filter(F.array(*tags), lambda t: t.isNotNull())
    return (df.withColumn("_tag", F.explode(arr))
              .withColumn("_seg", F.col("_tag.s")).withColumn("core", F.col("_tag.core"))
              .drop("_tag"))
