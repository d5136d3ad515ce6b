"""Exact nearest neighbours: pruning loses nothing, heavy cells are split, ties are settled by id."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.operators import neighbours as nb


def brute(train, test, k):
    ids = np.array([i for i, *_ in train])
    points = np.array([p for _, p, _ in train])
    out = []
    for i, p, _ in test:
        d = ((np.array(p) - points) ** 2).sum(1)
        out += [(i, r, int(ids[j]), float(d[j])) for r, j in enumerate(np.lexsort((ids, d))[:k], 1)]
    return sorted(out)


def frames(spark, rows):
    df = spark.createDataFrame(rows, "id long, f array<double>, y int").repartition(4)
    return df.where("id % 4 <> 0"), df.where("id % 4 = 0")


def clustered(n, seed):
    """Tight clusters far apart; a third of the rows lie in one, some of them equal."""
    r = np.random.default_rng(seed)
    centres = r.normal(0, 50, (30, 6))
    at = np.where(r.random(n) < 0.33, 0, r.integers(0, 30, n))
    x = centres[at] + np.where(r.random((n, 1)) < 0.1, 0, r.normal(0, 1, (n, 6)))
    return [(i, [float(v) for v in p], int(a) % 3) for i, (p, a) in enumerate(zip(x, at))]


@pytest.mark.parametrize("block_bytes", [4 << 20, 1500])
def test_pruned_search_is_exact(spark, block_bytes):
    rows = clustered(2400, 1)
    train, test = frames(spark, rows)
    report = {}
    got = nb.nearest(train, test, 5, "id", "f", "y", block_bytes, report)
    want = brute([r for r in rows if r[0] % 4], [r for r in rows if r[0] % 4 == 0], 5)
    assert sorted((r.id, r._rank, r._t, pytest.approx(r._d, rel=1e-12, abs=1e-12)) for r in got.collect()) == want
    assert report["all"] == 1800 * 600
    assert report["compared"] < (0.25 if block_bytes == 1500 else 1.01) * report["all"]


def test_equal_rows_and_few_rows(spark):
    """All rows equal (one cell, one ring width of zero), and fewer training rows than k."""
    rows = [(i, [1.0, 2.0], i % 2) for i in range(400)]
    train, test = frames(spark, rows)
    got = nb.nearest(train, test, 3, "id", "f", "y", 320).select("id", "_rank", "_t").collect()
    assert sorted(map(tuple, got)) == [(i, r, (1, 2, 3)[r - 1]) for i in range(0, 400, 4) for r in (1, 2, 3)]
    assert nb.nearest(train.where("id < 3"), test, 5, "id", "f", "y").groupBy("id").count().where("count <> 2").count() == 0
    none = test.withColumn("f", F.when(F.col("id") > 8, F.col("f")))
    assert nb.nearest(train, none, 1, "id", "f", "y").count() == 97


def test_product_and_terms_agree():
    r = np.random.default_rng(2)
    x, y = r.normal(1e3, 1e-3, (50, 8)), r.normal(1e3, 1e-3, (300, 8))
    y[100:200] = y[:100]  # equal distances
    ids = r.permutation(300)
    row, found, far = nb.nearest_rows(x, y, ids, 7)
    for i in range(50):
        d = ((x[i] - y) ** 2).sum(1)
        want = np.lexsort((ids, d))[:7]
        assert found[row == i].tolist() == want.tolist() and far[row == i].tolist() == d[want].tolist()
