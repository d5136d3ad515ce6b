"""Exact nearest neighbours with a pivot index.

1. *Cells.*  At most ``MAX_PIVOTS`` training rows (those with the least hash) are pivots; their
   number follows the number of blocks.  Every row of both sides goes to the cell of its nearest
   pivot.  Inside a cell rows are numbered by their distance to the pivot and cut into
   blocks of at most ``block_bytes`` of coordinates, so a heavy cell becomes rings.
2. *Home.*  Each block of test rows meets the block of training rows around the nearest pivot. The
   k-th distance found there is an upper limit of a row's true k-th distance.
3. *Pruning.*  By the triangle inequality two blocks are at least so far apart as the distance of
   their pivots and their rings' bounds say.  A pair of blocks beyond the limits of all its
   test rows is never made; inside a pair, rows whose own distance to the pivot excludes the
   ring are left out.
4. *Distances.*  A matrix product gives distances with a small error; all rows within this error of
   the k-th are computed again term by term and ranked by (distance, training id), so that
   equal distances are settled exactly.
5. *Merge.*  A window with a limit before its shuffle keeps the k nearest of a test row.

Nothing is capped, and a task holds two blocks.  Per block four numbers reach the driver.  How much
is pruned depends on the data: on points spread evenly over many dimensions all distances are
alike and nearly every pair of blocks must be compared.

Rows without coordinates are neither neighbours nor get any.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.operators.order import row_number
from kestrel.session import cut_lineage, ship_package

MAX_PIVOTS = 1024
_BLOCK = 1 << 24  # blocks of a cell


@dataclass
class Blocks:
    """Blocks of one side: their number, cell, rows, and least and largest distance to the pivot."""
    block: np.ndarray
    cell: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray


def _points(column) -> np.ndarray:
    """Coordinates of an Arrow list column as a matrix."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances by a matrix product (not exact)."""
    return np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * (x @ y.T), 0)


def nearest_rows(x: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of x, row of points, squared distance) of the k nearest points of each x by (distance, id).

    The distances are sums of squared differences; the product only chooses whom to compute."""
    k = min(k, len(points))
    rows, found, far = [], [], []
    step = max(1, (4 << 20) // max(1, len(points)))
    for i in range(0, len(x) if k else 0, step):
        part = x[i:i + step]
        rough = squared(part, points)
        slack = 1e-12 * ((part * part).sum(1) + (points * points).sum(1).max())
        kth = np.partition(rough, k - 1, axis=1)[:, k - 1]
        r, c = np.nonzero(rough <= (kth + 2 * slack)[:, None])
        d = ((part[r] - points[c]) ** 2).sum(1)
        order = np.lexsort((ids[c], d, r))
        r, c, d = r[order], c[order], d[order]
        place = np.arange(len(r)) - np.searchsorted(r, r)
        keep = place < k
        rows.append(r[keep] + i)
        found.append(c[keep])
        far.append(d[keep])
    if not rows:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    return np.concatenate(rows), np.concatenate(found), np.concatenate(far)


def least_distance(pivots: np.ndarray, a: Blocks, b: Blocks) -> np.ndarray:
    """No row of block i of ``a`` is nearer to a row of block j of ``b`` than this (i, j)."""
    apart = np.sqrt(squared(pivots, pivots))[a.cell[:, None], b.cell]
    bound = np.maximum(apart - a.high[:, None] - b.high, np.maximum(a.low[:, None] - apart - b.high, b.low - apart - a.high[:, None]))
    return np.maximum(bound - 1e-6 * (1 + apart), 0)


def _located(df: DataFrame, features: str, pivots: np.ndarray) -> DataFrame:
    """``df`` with the nearest pivot ``_cell`` and the distance ``_r`` to it."""
    known = df.sparkSession.sparkContext.broadcast(pivots)

    def run(batches):
        import pyarrow as pa

        p = known.value
        for b in batches:
            x = _points(b.column(features))
            cell = squared(x, p).argmin(1) if len(x) else np.zeros(0, int)
            r = np.sqrt(((x - p[cell]) ** 2).sum(1)) if len(x) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell, pa.int64()), pa.array(r, pa.float64())],
                                             names=[*b.schema.names, "_cell", "_r"])
    return df.mapInArrow(run, df.withColumn("_cell", F.lit(0).cast("long")).withColumn("_r", F.lit(0.0)).schema)


def _in_blocks(df: DataFrame, features: str, id_col: str, pivots: np.ndarray, rows: int) -> tuple[DataFrame, Blocks]:
    """Rows with ``_block`` and a number ``_rn`` of their own, and the blocks."""
    d = row_number(_located(df, features, pivots), ["_cell"], ["_r", id_col], "_rn")
    block = F.expr(f"_cell * {_BLOCK} + (_rn - 1) div {rows}")
    d = d.withColumn("_block", block).withColumn("_rn", F.expr("shiftleft(_cell, 40) + _rn"))
    stats = d.groupBy("_block", "_cell").agg(F.count(F.lit(1)), F.min("_r"), F.max("_r")).collect()
    columns = [np.array(c) for c in zip(*sorted(map(tuple, stats)))]
    return d, Blocks(*columns)


def _dealt(df: DataFrame, partners: dict[int, np.ndarray], out: str) -> DataFrame:
    """One copy of each row for every partner block of its own block."""
    table = df.sparkSession.sparkContext.broadcast(partners)

    def run(batches):
        import pyarrow as pa

        none = np.zeros(0, np.int64)
        for b in batches:
            lists = [table.value.get(i, none) for i in b.column("_block").to_pylist()]
            index = np.repeat(np.arange(b.num_rows), [len(x) for x in lists])
            other = np.concatenate([none, *lists])
            for i in range(0, len(index), 1 << 13):
                made = b.take(pa.array(index[i:i + (1 << 13)]))
                yield pa.RecordBatch.from_arrays([*made.columns, pa.array(other[i:i + (1 << 13)], pa.int64())],
                                                 names=[*b.schema.names, out])
    return df.mapInArrow(run, df.withColumn(out, F.lit(0).cast("long")).schema)


def _compared(left: DataFrame, right: DataFrame, pairs: dict[int, np.ndarray], pivots, a: Blocks, keep: int,
              id_col: str, features: str, label: str) -> DataFrame:
    """(_rn, id, _d, _t, _y): the ``keep`` nearest training rows of every test row in each pair of blocks.

    ``pairs``: test block -> training blocks.  A test row's ``_limit`` is its k-th distance so far."""
    back: dict[int, list] = {}
    for j, blocks in pairs.items():
        for i in blocks.tolist():
            back.setdefault(i, []).append(j)
    dealt_left = _dealt(left, {i: np.array(js, np.int64) for i, js in back.items()}, "_other").withColumnsRenamed(
        {"_block": "_a", "_other": "_b"})
    dealt_right = _dealt(right, pairs, "_other").withColumnsRenamed({"_block": "_b", "_other": "_a"})
    rings = left.sparkSession.sparkContext.broadcast(
        (pivots, {int(i): (int(c), float(lo), float(hi)) for i, c, lo, hi in zip(a.block, a.cell, a.low, a.high)}))

    def meet(train, test):
        import pyarrow as pa

        at, near, far = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        if train.num_rows and test.num_rows:
            table, where = rings.value
            cell, low, high = where[train.column("_a")[0].as_py()]
            x, points = _points(test.column(features)), _points(train.column(features))
            away = np.sqrt(((x - table[cell]) ** 2).sum(1))
            reach = np.maximum(np.maximum(away - high, low - away) - 1e-6 * (1 + away), 0)
            rows = np.flatnonzero(reach ** 2 <= test.column("_limit").to_numpy())
            at, near, far = nearest_rows(x[rows], points, train.column(id_col).to_numpy(), keep)
            at = rows[at]
        at, near = pa.array(at), pa.array(near)
        return pa.table({"_rn": test.column("_rn").take(at), id_col: test.column(id_col).take(at), "_d": pa.array(far),
                         "_t": train.column(id_col).take(near), "_y": train.column(label).take(near)})

    return dealt_left.groupBy("_a", "_b").cogroup(dealt_right.groupBy("_a", "_b")).applyInArrow(
        meet, f"_rn long, {id_col} long, _d double, _t long, _y long")


def _best(found: DataFrame, keep: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("_rn").orderBy("_d", "_t"))
    return found.withColumn("_rank", rank).where(F.col("_rank") <= keep)


def nearest(train: DataFrame, test: DataFrame, k: int, id_col: str, features: str, label: str,
            block_bytes: int = 4 << 20, report: dict | None = None) -> DataFrame:
    """(_rn, id, _d, _t, _y, _rank): the k nearest training rows (squared distance, id, label) of every test row.

    ``report`` receives the number of pairs of rows in the compared blocks and of all pairs."""
    spark = train.sparkSession
    ship_package(spark)
    schema = f"_rn long, {id_col} long, _d double, _t long, _y long, _rank int"
    train = train.select(F.col(id_col).cast("long").alias(id_col), features, F.col(label).cast("long").alias(label)).dropna(
        subset=[features])
    test = test.select(F.col(id_col).cast("long").alias(id_col), features).dropna(subset=[features])
    n, wide = train.agg(F.count(F.lit(1)), F.max(F.size(features))).first()
    m = test.count()
    if not n or not m:
        return spark.createDataFrame([], schema)
    most = max(1, block_bytes // (8 * max(1, wide)))
    # test sides below a block for each task are cut finer
    few = min(most, -(-m // (4 * spark.sparkContext.defaultParallelism)))
    wanted = min(MAX_PIVOTS, max(1, (8 << 20) // (8 * max(1, wide))), -(-2 * n // most))
    chosen = train.select(features, F.xxhash64(id_col).alias("_h")).orderBy("_h", features).limit(wanted)
    pivots = np.unique(np.array([r[0] for r in chosen.collect()], np.float64), axis=0)
    left, a = _in_blocks(train, features, id_col, pivots, most)
    right, b = _in_blocks(test, features, id_col, pivots, few)

    least = least_distance(pivots, a, b)
    apart = np.sqrt(squared(pivots, pivots))[a.cell[:, None], b.cell]
    home = np.lexsort((np.broadcast_to(a.low[:, None], apart.shape), apart, np.broadcast_to((a.rows < k)[:, None], apart.shape)),
                      axis=0)[0]
    first = cut_lineage(_compared(left, right.withColumn("_limit", F.lit(math.inf)),
                                  {int(j): a.block[i:i + 1] for j, i in zip(b.block, home)},
                                  pivots, a, k, id_col, features, label))
    limits = first.groupBy("_rn").agg(F.when(F.count(F.lit(1)) >= k, F.max("_d")).otherwise(F.lit(math.inf)).alias("_limit"))
    right = right.join(limits, "_rn")
    limit = {r[0]: r[1] for r in right.groupBy("_block").agg(F.max("_limit")).collect()}
    near = least ** 2 <= np.array([limit[j] for j in b.block.tolist()])
    near[home, np.arange(len(b.block))] = False
    if report is not None:
        report["compared"] = int((a.rows[:, None] * b.rows * near).sum() + (a.rows[home] * b.rows).sum())
        report["all"] = n * m
    pairs = {int(j): a.block[near[:, q]] for q, j in enumerate(b.block) if near[:, q].any()}
    if pairs:
        first = first.unionByName(_compared(left, right, pairs, pivots, a, k, id_col, features, label))
    return _best(first, k)


def knn_votes(train: DataFrame, test: DataFrame, ks: list[int], id_col: str, features: str, label: str,
              max_train: int | None = None, block_bytes: int = 4 << 20) -> DataFrame:
    """(id, k, pred): exact k-nearest-neighbour vote of every test row, ties in distance by the
    training id and ties in votes by the smaller label.  A caller's own ``max_train`` raises for
    a larger training side."""
    if max_train is not None and (n := train.count()) > max_train:
        raise ValueError(f"{n} training rows; the caller allows {max_train}")
    found = nearest(train, test, max(ks), id_col, features, label, block_bytes)
    best = found.groupBy("_rn").agg(F.first(id_col).alias(id_col), F.array_sort(
        F.collect_list(F.struct("_rank", "_y"))).alias("_near"))  # max(ks) rows at most
    best = best.select(id_col, "_near", F.explode(F.array(*[F.lit(k) for k in ks])).alias("k"))
    votes = F.slice(F.col("_near")["_y"], F.lit(1), F.col("k"))
    best = best.select(id_col, "k", votes.alias("_v"))
    ranked = F.array_sort(F.transform(F.array_distinct("_v"), lambda y: F.struct(
        (-F.size(F.filter("_v", lambda v: v == y))).alias("n"), y.alias("y"))))
    return best.select(id_col, "k", ranked[0]["y"].cast("int").alias("pred"))
