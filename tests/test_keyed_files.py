"""One file per key and array files: names, round trips, failed tasks."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.sources import keyed_files as kf

KEYS = ["plain", "with space", "a/b", "ä,ö", "a%2Fb", ".hidden", "_under", "+plus", "x" * 150, "A", "a"]


def test_a_file_per_key(spark, tmp_path):
    rows = [(k, i, f"{k}{i};") for k in KEYS for i in range(3)]
    df = spark.createDataFrame(rows, "k string, i int, v string").repartition(5)
    path = kf.write_keyed(df, "k", "v", str(tmp_path / "out"), ".txt", ["i"])
    names = sorted(os.listdir(path))
    assert names == sorted(kf.file_name(k, ".txt") for k in KEYS) and len(set(names)) == len(KEYS)
    assert "plain.txt" in names and "A.txt" in names
    got = {r.key: bytes(r.content).decode() for r in kf.read_keyed(spark, path, ".txt").collect()}
    shown = {k for k in KEYS if kf.file_name(k, "")[0] not in "._"}  # Spark skips hidden names; there are none
    assert got == {k: "".join(f"{k}{i};" for i in range(3)) for k in shown} and len(shown) == len(KEYS)
    kf.write_keyed(df.where("k = 'plain' AND i = 1"), "k", "v", path, ".txt")
    assert (tmp_path / "out" / "plain.txt").read_text() == "plain1;" and len(os.listdir(path)) == len(KEYS)


def test_a_failed_task_leaves_no_file(spark, tmp_path):
    df = spark.range(40).select(F.col("id").cast("string").alias("k"), F.when(F.col("id") == 33, F.raise_error(F.lit("broken")))
                                .otherwise(F.lit("x")).cast("string").alias("v"))
    with pytest.raises(Exception, match="broken"):
        kf.write_keyed(df, "k", "v", str(tmp_path / "out"), ".txt")
    assert not [f for _, _, files in os.walk(tmp_path) for f in files]
    with pytest.raises(Exception, match="without a key"):
        kf.write_keyed(df.select(F.lit("").alias("k"), F.lit("x").alias("v")), "k", "v", str(tmp_path / "out"), ".txt")
    empty = kf.write_keyed(df.limit(0), "k", "v", str(tmp_path / "none"), ".txt")
    assert os.listdir(empty) == []


def test_arrays_of_several_shapes(spark, tmp_path):
    shapes = {"m": [[1.0, 2.0], [3.5, float("nan")], [5.0, 6.0]], "one": [[7.0, 8.0]], "none": []}
    df = spark.createDataFrame(list(shapes.items()), "k string, a array<array<double>>")
    path = kf.write_arrays(df, "k", "a", str(tmp_path / "a"))
    np.save(tmp_path / "a" / "vector.npy", np.arange(4, dtype=np.int32))
    np.save(tmp_path / "a" / "scalar.npy", np.float32(2.5))
    got = {r.key: (r["shape"], r.rows) for r in kf.read_arrays(spark, path).collect()}
    assert got["one"] == ([1, 2], [[7.0, 8.0]]) and got["none"] == ([0], []) and got["m"][0] == [3, 2]
    assert np.allclose(got["m"][1], shapes["m"], equal_nan=True)
    assert got["vector"] == ([4], [[0.0, 1.0, 2.0, 3.0]]) and got["scalar"] == ([], [[2.5]])
    with pytest.raises(Exception, match="rows of 4 numbers"):
        kf.read_arrays(spark, path, columns=2).collect()
    np.save(tmp_path / "a" / "deep.npy", np.zeros((2, 2, 2)))
    with pytest.raises(Exception, match="3 dimensions"):
        kf.read_arrays(spark, path).collect()
