"""Global order without a single-partition window.

A ``Window`` without ``partitionBy`` moves every row into one task.  Here a
global (or per-group) order is built the distributed way:

1. ``repartitionByRange`` on (group, order) keys + ``sortWithinPartitions``
   (one shuffle; a hot group is split across partitions by the range bounds),
2. a local position from ``monotonically_increasing_id`` (partition id in the
   upper 31 bits, position in the lower 33),
3. per-(partition, group) counts — at most #partitions + #groups rows — turned
   into offsets by a small window and joined back.

Order keys must be unique within a group (add tie-breakers), otherwise the
numbering is not reproducible on a retried task.

The two uses of the range-partitioned frame (counts, numbering) must see the
same partition layout, but range bounds come from a sample that depends on
input row order; the tagged frame is therefore cut with a reliable
``checkpoint`` (shared folder, survives lost executors).  When the leading
order column is a dense integer (bins, days), ``dense_col``/``width`` selects a
cheaper deterministic variant: fixed-width segments of that column replace the
sampled bounds, and nothing is materialised.
"""

from __future__ import annotations

import functools
import math
from bisect import bisect_left, bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.session import cut_lineage

_LOW = (1 << 33) - 1


def _nparts(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _as_cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _row_number_dense(df: DataFrame, group_cols: list[str], order_cols: list, out: str,
                      dense_col: str, width: int) -> DataFrame:
    d = df.withColumn("_seg", F.floor(F.col(dense_col) / F.lit(width)))
    w = Window.partitionBy(*group_cols, "_seg").orderBy(*_as_cols(order_cols))
    numbered = d.withColumn("_lrn", F.row_number().over(w))
    cnt = d.groupBy(*group_cols, "_seg").agg(F.count(F.lit(1)).alias("_c"))
    ws = Window.partitionBy(*group_cols).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    cnt = cnt.withColumn("_off", F.coalesce(F.sum("_c").over(ws), F.lit(0))).drop("_c")
    return (numbered.join(cnt, [*group_cols, "_seg"])
                    .withColumn(out, F.col("_off") + F.col("_lrn")).drop("_seg", "_lrn", "_off"))


def row_number(df: DataFrame, group_cols: list[str], order_cols: list, out: str = "rn",
               num_partitions: int | None = None, dense_col: str | None = None,
               width: int = 1 << 16) -> DataFrame:
    """1-based row number per group (or global when ``group_cols`` is empty)."""
    if dense_col:
        return _row_number_dense(df, group_cols, order_cols, out, dense_col, width)
    keys = _as_cols(group_cols) + _as_cols(order_cols)
    n = _nparts(df, num_partitions)
    tagged = cut_lineage(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                         .withColumn("_mid", F.monotonically_increasing_id())
                         .withColumn("_pid", F.shiftrightunsigned("_mid", 33))
                         .withColumn("_loc", F.col("_mid").bitwiseAND(F.lit(_LOW))))
    stats = tagged.groupBy("_pid", *group_cols).agg(F.count(F.lit(1)).alias("_cnt"),
                                                     F.min("_loc").alias("_first"))
    w = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_before", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
    stats = stats.select("_pid", *group_cols, "_before", "_first")
    if not group_cols:
        # bounded by the number of partitions: safe to broadcast
        stats = F.broadcast(stats)
    joined = tagged.join(stats, ["_pid", *group_cols])
    return (joined.withColumn(out, F.col("_before") + F.col("_loc") - F.col("_first") + 1)
                  .drop("_mid", "_pid", "_loc", "_before", "_first"))


def running_sum(df: DataFrame, group_cols: list[str], order_cols: list, value_cols: list[str],
                suffix: str = "_cum", num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sums of ``value_cols`` in (group, order) order.

    Local sums run in a window over (partition id, group) – balanced, since the
    range partitioner already split the key space – then the totals of earlier
    partitions of the same group are added from a small offsets table.
    """
    keys = _as_cols(group_cols) + _as_cols(order_cols)
    n = _nparts(df, num_partitions)
    tagged = cut_lineage(df.repartitionByRange(n, *keys)
                         .withColumn("_pid", F.spark_partition_id()))
    local_w = (Window.partitionBy("_pid", *group_cols).orderBy(*_as_cols(order_cols))
               .rowsBetween(Window.unboundedPreceding, 0))
    local = tagged
    for c in value_cols:
        local = local.withColumn(c + "_loc", F.sum(c).over(local_w))
    totals = tagged.groupBy("_pid", *group_cols).agg(*[F.sum(c).alias(c + "_tot") for c in value_cols])
    w = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    for c in value_cols:
        totals = totals.withColumn(c + "_off", F.coalesce(F.sum(c + "_tot").over(w), F.lit(0)))
    totals = totals.select("_pid", *group_cols, *[c + "_off" for c in value_cols])
    if not group_cols:
        totals = F.broadcast(totals)
    out = local.join(totals, ["_pid", *group_cols])
    for c in value_cols:
        out = out.withColumn(c + suffix, F.col(c + "_loc") + F.col(c + "_off"))
    return out.drop("_pid", *[c + "_loc" for c in value_cols], *[c + "_off" for c in value_cols])


def with_neighbours(df: DataFrame, key: str, order_cols: list[str], cols: list[str], offsets: list[int],
                    num_partitions: int | None = None) -> DataFrame:
    """Add ``<col>_next<k>`` (``_prev<k>`` for k < 0): ``col`` k rows later in the key's order.

    Rows are range-partitioned on (key, order), so a hot key is split, and read their
    neighbours in a window over (partition, key).  The few rows that follow or precede a
    partition - at most ``max(offsets)`` on each side - are appended to it as halo
    rows; that table has a handful of rows per partition and is put together on the
    driver.
    """
    order = _as_cols([key, *order_cols])
    n = _nparts(df, num_partitions)
    need = list(dict.fromkeys([key, *order_cols, *cols]))
    tagged = cut_lineage(df.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id()))
    fwd, back = max([0, *offsets]), max([0, *(-k for k in offsets)])
    ends = []
    for size, cols_in_order in ((fwd, order), (back, [c.desc() for c in order])):
        w = Window.partitionBy("_pid").orderBy(*cols_in_order)
        ends.append(tagged.select("_pid", *need, F.row_number().over(w).alias("_rk")).where(F.col("_rk") <= size)
                    .collect() if size else [])
    heads = sorted(ends[0], key=lambda r: (r["_pid"], r["_rk"]))
    tails = sorted(ends[1], key=lambda r: (r["_pid"], -r["_rk"]))
    head_pids, tail_pids = [r["_pid"] for r in heads], [r["_pid"] for r in tails]
    halo = []
    for p in range(n):
        i, j = bisect_right(head_pids, p), bisect_left(tail_pids, p)
        halo += [(p, *[r[c] for c in need]) for r in (*heads[i:i + fwd], *tails[max(0, j - back):j])]
    schema = tagged.select("_pid", *need).schema
    extra = df.sparkSession.createDataFrame(halo, schema).withColumn("_core", F.lit(False))
    both = tagged.withColumn("_core", F.lit(True)).unionByName(extra, allowMissingColumns=True)
    w = Window.partitionBy("_pid", key).orderBy(*_as_cols(order_cols))
    named = {f"{c}_{f'next{k}' if k > 0 else f'prev{-k}'}": F.lead(c, k).over(w) if k > 0 else F.lag(c, -k).over(w)
             for k in offsets for c in cols}
    return both.withColumns(named).where("_core").drop("_pid", "_core")


#: Groups whose brackets the driver holds, and rows of a bracket that one task sorts.
BRACKET_GROUPS, BRACKET_ROWS = 10_000, 2_000_000
_SKETCH = 10_000


def exact_quantiles(df: DataFrame, group_cols: list[str], cols: list[str], probs: list[float]) -> DataFrame:
    """(group..., column, q0, q1, ...): exact quantiles with linear interpolation, nulls ignored.

    A first pass gives mergeable sketches, whose ranks are off by 1 / 10,000 at most: they
    bracket each quantile.  A second pass counts the rows below a bracket and the distinct values
    inside, and the values at the two ranks are read off; nothing is sorted as a whole.  A bracket of
    more than ``BRACKET_ROWS`` rows is narrowed by further sketches of the rows inside.  The
    brackets of up to ``BRACKET_GROUPS`` groups are broadcast; with more groups, equal values are counted
    and summed up in order by a range shuffle instead.
    """
    keys = [*group_cols, "column"]
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])
    cells = df.select(*group_cols, F.inline(cells)).where("value IS NOT NULL")
    e = 1.5 / _SKETCH
    ends = [min(max(p + d, 0.0), 1.0) for p in probs for d in (-e, e)]
    first = cells.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("value", ends, _SKETCH).alias("_at"))
    groups = first.limit(BRACKET_GROUPS + 1).collect()
    if len(groups) > BRACKET_GROUPS:
        return _ranked_quantiles(cells, keys, probs)
    brackets = []  # group, quantile, rows below the lower rank, and the bracket (none: open)
    for g in groups:
        for i, p in enumerate(probs):
            rank = math.floor(p * (g["_n"] - 1))
            lo, hi = g["_at"][2 * i:2 * i + 2]
            small = g["_n"] <= BRACKET_ROWS
            lo = -math.inf if small or p <= e else lo
            hi = math.nan if small or p >= 1 - e else hi  # NaN is above all values
            brackets.append([*(g[k] for k in keys), i, rank, lo, hi, 0.0 if small else 2 * e * g["_n"]])
    spark = df.sparkSession
    types = {f.name: f.dataType for f in cells.schema.fields}
    schema = T.StructType([*(T.StructField(f"_k{j}", types[k]) for j, k in enumerate(keys)), T.StructField("_i", T.IntegerType()),
                           T.StructField("_rank", T.LongType()), T.StructField("_lo", T.DoubleType()), T.StructField("_hi", T.DoubleType())])

    def met():
        """Cells below or inside a bracket, once for every quantile of their group."""
        b = F.broadcast(spark.createDataFrame([x[:-1] for x in brackets], schema))
        same = functools.reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_k{j}")) for j, k in enumerate(keys)])
        return cells.join(b, same).where(F.col("value") <= F.col("_hi"))
    below = F.col("value") < F.col("_lo")
    for _ in range(8):
        wide = {tuple(x[:len(keys) + 1]): x for x in brackets if x[-1] > BRACKET_ROWS and x[-3] != x[-2]}
        if not wide:
            break
        inside = F.when(~below, F.col("value"))
        found = met().groupBy(*keys, "_i").agg(F.count_if(below).alias("_below"), F.count(inside).alias("_in"), F.percentile_approx(
            inside, [k / _SKETCH for k in range(_SKETCH + 1)], _SKETCH).alias("_at")).where(F.col("_in") > BRACKET_ROWS).collect()
        moved = False
        for r in found:
            x = wide.get(tuple(r[:len(keys) + 1]))
            if x is None:
                continue
            at = (x[-4] - r["_below"]) / r["_in"] * _SKETCH  # the rank's place in the sketch
            low, high = math.floor(at) - 2, math.ceil(at) + 3
            lo = r["_at"][low] if low > 0 else x[-3]
            hi = r["_at"][high] if high < _SKETCH else x[-2]
            moved |= lo != x[-3] or hi != x[-2]
            x[-3:] = [lo, hi, 6 * r["_in"] / _SKETCH]
        if not moved:
            break  # equal values
    counted = met().groupBy(*keys, "_i", "_rank", F.when(~below, F.col("value")).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*keys, "_i").orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    upto = counted.withColumn("_upto", F.sum("_c").over(w)).where("_v IS NOT NULL")
    pairs = upto.groupBy(*keys, "_i").agg(F.min(F.when(F.col("_upto") > F.col("_rank"), F.col("_v"))).alias("_a"),
                                          F.min(F.when(F.col("_upto") > F.col("_rank") + 1, F.col("_v"))).alias("_b"))
    # the value at the next rank may stand behind the bracket only if the quantile is at the lower one
    table = spark.createDataFrame([(*x[:len(keys) + 1], *_share(probs[x[len(keys)]], n)) for x, n in zip(
        brackets, [g["_n"] for g in groups for _ in probs])], T.StructType([*schema.fields[:len(keys) + 1], T.StructField("_f", T.DoubleType())]))
    same = functools.reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_k{j}")) for j, k in enumerate(keys)])
    both = pairs.withColumnRenamed("_i", "_q").join(F.broadcast(table), same & (F.col("_q") == F.col("_i")))
    q = F.when(F.col("_f") == 0, F.col("_a")).otherwise(F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_f"))
    return both.groupBy(*keys).agg(*[F.max(F.when(F.col("_i") == i, q)).alias(f"q{i}") for i in range(len(probs))])


def _share(p: float, n: int) -> tuple[float]:
    """How far the quantile lies between its two ranks."""
    return (p * (n - 1) - math.floor(p * (n - 1)),)


def _ranked_quantiles(cells: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """Equal values are counted first (map-side), then a distributed running sum over the
    distinct values finds the values at the two ranks around each quantile; no task
    holds all values of a group."""
    counts = cells.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_sum(counts, keys, ["value"], ["_n"])
    total = ranked.groupBy(*keys).agg(F.max("_n_cum").alias("_total"))
    at = [F.lit(p) * (F.col("_total") - 1) for p in probs]

    def value_at(rank):
        return F.min(F.when(F.col("_n_cum") > rank, F.col("value")))
    aggs = [x for i, a in enumerate(at) for x in (value_at(F.floor(a)).alias(f"_lo{i}"), value_at(F.ceil(a)).alias(f"_hi{i}"))]
    ends = ranked.join(total, keys).groupBy(*keys, "_total").agg(*aggs)
    return ends.select(*keys, *[
        (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (a - F.floor(a))).alias(f"q{i}")
        for i, a in enumerate(at)])


def group_counts(df: DataFrame, group_cols: list[str], out: str = "n") -> DataFrame:
    return df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias(out))


def contiguous_fold(rn: Column, n: Column, k: int) -> Column:
    """Fold id (0-based) of 1-based row ``rn`` out of ``n`` in k contiguous folds.

    The first ``n % k`` folds hold one extra row (the usual KFold layout).
    """
    q = (n / k).cast("long")
    r = n % k
    edge = r * (q + 1)
    return (F.when(rn <= edge, ((rn - 1) / (q + 1)).cast("long"))
             .otherwise(r + ((rn - 1 - edge) / q).cast("long")))


def with_contiguous_folds(df: DataFrame, group_cols: list[str], order_cols: list, k: int,
                          out: str = "fold", dense_col: str | None = None) -> DataFrame:
    """Contiguous k folds per group, in the given order."""
    numbered = row_number(df, group_cols, order_cols, "_rn", dense_col=dense_col)
    counts = group_counts(df, group_cols, "_n")
    j = numbered.join(counts, group_cols) if group_cols else numbered.crossJoin(F.broadcast(counts))
    return j.withColumn(out, contiguous_fold(F.col("_rn"), F.col("_n"), k)).drop("_rn", "_n")


def with_stratified_folds(df: DataFrame, label_col: str, order_cols: list, k: int,
                          out: str = "fold") -> DataFrame:
    """Stratified k folds without shuffling (sorted-label round robin allocation).

    Labels are sorted; position p of the sorted label list goes to fold p % k;
    fold i therefore receives, of class c, the positions of c's block that are
    congruent to i.  Inside each class, rows keep their order and fill folds
    0..k-1 contiguously with those allocations (a table of #classes × k rows).
    """
    numbered = row_number(df, [label_col], order_cols, "_rn")
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.orderBy(label_col).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_start", F.coalesce(F.sum("_c").over(w), F.lit(0)))
    folds = df.sparkSession.range(k).select(F.col("id").alias("_fold"))
    # positions p in [start, start + c) with p % k == fold
    alloc = counts.crossJoin(folds).withColumn(
        "_a",
        F.greatest(F.lit(0),
                   F.floor((F.col("_start") + F.col("_c") - 1 - F.col("_fold")) / k)
                   - F.ceil((F.col("_start") - F.col("_fold")) / k) + 1))
    wa = Window.partitionBy(label_col).orderBy("_fold")
    alloc = (alloc.withColumn("_hi", F.sum("_a").over(wa.rowsBetween(Window.unboundedPreceding, 0)))
                  .withColumn("_lo", F.col("_hi") - F.col("_a"))
                  .where(F.col("_a") > 0)
                  .select(label_col, "_fold", "_lo", "_hi"))
    j = numbered.join(alloc, [label_col])
    return (j.where((F.col("_rn") > F.col("_lo")) & (F.col("_rn") <= F.col("_hi")))
             .withColumn(out, F.col("_fold")).drop("_rn", "_fold", "_lo", "_hi"))


