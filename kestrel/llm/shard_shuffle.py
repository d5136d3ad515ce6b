"""Sharding by a two-pass external shuffle.

Pass 1 scatters the records uniformly over buckets that fit in a task's memory:
the bucket is a seeded hash of the whole record and of its number among equal records, and
the number of buckets follows from the bytes of the table alone, so that a table has one
permutation on every cluster.  Pass 2 takes each bucket whole, brings it into a fixed
order and applies a Fisher-Yates shuffle with a generator seeded by (seed,
bucket).  Buckets laid end to end give every record its place in one random
permutation of the table; the law ``rows`` cuts it into shards whose counts
differ by one at most, and a record's slot is its place in the shard.

The texts cross one shuffle.  The rows before a bucket meet it in its task (cogroup); they are
summed per run of ``RUN`` buckets, and only these sums reach the driver (one number a
run, i.e. per 128 GB).

Records that occur more than once are found by a count of hashes; they alone are counted whole
(map-side first, so a third of all rows may be one record) and laid out again with a number
each, which spreads them over the buckets.

Edge cases: null and empty texts take part with size 1.  Null ids are hashed like
any other value.  Repeated rows keep separate slots.  A text above ``bucket_bytes`` makes a bucket
of that size, held whole in its task.  An empty table gives no shards.  Columns of type map
are not hashed and must not occur in repeated rows.  Output columns replace columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.llm.common import shared_path
from kestrel.session import ship_package

#: Buckets of a table at least, and buckets whose rows are summed for the driver.
LEAST_BUCKETS, RUN = 256, 4096


def record_size(text_col: str = "text"):
    """UTF-8 bytes of the text plus one."""
    return F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long") + 1


def fisher_yates(n: int, seed: int, bucket: int):
    """A uniform permutation of range(n): swaps from the end with a seeded generator."""
    import numpy as np

    order = np.arange(n)
    np.random.Generator(np.random.PCG64([seed, bucket])).shuffle(order)
    return order


def _numbered(df: DataFrame, seed: int) -> DataFrame:
    """``df`` with ``__mark``, a hash of the record, and ``__copy``, its number among equal records."""
    cols = df.columns
    marked = df.withColumn("__mark", F.xxhash64(F.lit(seed), *(
        F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, T.MapType))))
    often = marked.groupBy("__mark").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__mark")
    if often.isEmpty():
        return marked.withColumn("__copy", F.lit(0).cast("long"))
    once = marked.join(often, "__mark", "left_anti").withColumn("__copy", F.lit(0).cast("long"))
    whole = marked.join(often, "__mark", "left_semi").groupBy("__mark", *cols).agg(F.count(F.lit(1)).alias("__n"))
    copies = whole.withColumn("__copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1))).drop("__n")
    return once.unionByName(copies.select(*once.columns))


def shuffle_into_shards(df: DataFrame, num_shards: int, seed: int = 17, id_col: str = "doc_id",
                        text_col: str = "text", bucket_bytes: int = 32 << 20, folder: str | None = None) -> DataFrame:
    """Write ``df`` to ``folder`` (partitioned by shard) with columns shard and slot, and
    return the table read back."""
    spark = df.sparkSession
    ship_package(spark)
    df = df.select([c for c in df.columns if c not in ("shard", "slot")])
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(record_size(text_col)), F.lit(0))).first()
    buckets = max(LEAST_BUCKETS, -(-size // bucket_bytes))
    numbered = _numbered(df, seed)
    scattered = numbered.withColumn("__bucket", F.pmod(F.xxhash64(F.lit(seed), "__mark", "__copy"), F.lit(buckets)).cast("int"))

    counts = scattered.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n")).withColumn("__run", F.expr(f"__bucket div {RUN}"))
    before, sums = 0, []
    for run, n in sorted(map(tuple, counts.groupBy("__run").agg(F.sum("__n")).collect())):
        sums.append((run, before))
        before += n
    sums = spark.createDataFrame(sums, "__run long, __start long")
    earlier = Window.partitionBy("__run").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.join(F.broadcast(sums), "__run").select(
        F.col("__bucket").alias("__of"), (F.col("__start") + F.coalesce(F.sum("__n").over(earlier), F.lit(0))).alias("__before"))

    def pass_two(table, start):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        ordered = pc.sort_indices(table, sort_keys=[("__mark", "ascending"), ("__copy", "ascending"), (id_col, "ascending")])
        order = fisher_yates(table.num_rows, seed, start.column("__of")[0].as_py())
        at = start.column("__before")[0].as_py() + np.arange(table.num_rows, dtype=np.int64)
        shard = at * num_shards // rows
        first = -(-shard * rows // num_shards)  # the first place of a shard
        return table.take(ordered.take(pa.array(order))).select(names).append_column(
            "shard", pa.array(shard.astype(np.int32))).append_column("slot", pa.array(at - first))

    names = df.columns
    schema = T.StructType([*df.schema.fields, T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])
    placed = scattered.groupBy("__bucket").cogroup(starts.groupBy("__of")).applyInArrow(pass_two, schema)
    folder = folder or shared_path(spark, "shards")
    placed.write.partitionBy("shard").parquet(folder)
    return spark.read.schema(placed.schema).parquet(folder)
