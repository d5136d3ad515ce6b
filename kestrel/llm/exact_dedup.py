"""Exact de-duplication by a 128-bit content hash with a byte comparison.

Texts are grouped by (MD5, text): the aggregate compares the bytes of texts of
equal hash, so two different texts never share a class, and copies collapse on
the map side, however many there are.  One shuffle carries each distinct text
once; everything after it is narrow.

``duplicate_classes`` reports on every row.  Its row side carries only id and
hash, and meets the class table in an equi-join whose large keys AQE splits.  If
two texts should collide in the hash (the class table counts texts per hash),
the rows of those hashes - and only those - are told apart by their text.

``keep_one`` returns the rows that stay, in a single shuffle.

Edge cases: null text counts as empty.  Of equal texts the row with the smallest
(or, with ``keep="max"``, largest) non-null id stays; if no row of a class has an
id, ``keep_id`` is null.  Of rows that repeat both id and text, exactly one is
kept (the greatest by its remaining columns in ``keep_one``).  A very long text
is a grouping key like any other and crosses the shuffle once a class and task.  An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import text_or_empty, written


def content_hash(text: Column) -> Column:
    """128 bits of MD5."""
    return F.unhex(F.md5(text))


def _best(keep: str) -> Callable[[Column], Column]:
    if keep not in ("min", "max"):
        raise ValueError("keep must be 'min' or 'max'")
    return F.min if keep == "min" else F.max


def duplicate_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min",
                      digest: Callable[[Column], Column] | None = None,
                      hash_fn: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per input row: ``id_col``, keep_id, group_size, kept, and ``digest`` of the
    text (a function of the text column) if asked for."""
    best, text = _best(keep), text_or_empty(text_col)
    rows = df.select(F.col(id_col).alias("__id"), text.alias("__text")).withColumn("__h", hash_fn(F.col("__text")))
    per_text = rows.groupBy("__h", "__text").agg(F.count(F.lit(1)).alias("__n"), best("__id").alias("__keep"))
    per_hash = written(per_text.groupBy("__h").agg(
        F.sum("__n").alias("__n"), best("__keep").alias("__keep"), F.count(F.lit(1)).alias("__texts")),
        "duplicate-classes")
    if digest is not None:
        rows = rows.withColumn("__digest", digest(F.col("__text")))
    shown = ["__digest"] if digest is not None else []
    collided = per_hash.where("__texts > 1").select("__h")
    some = bool(collided.take(1))
    plain = rows.select("__id", "__h", *shown).groupBy("__h", "__id", *shown).agg(F.count(F.lit(1)).alias("__times"))
    out = plain.join(per_hash.where("__texts = 1"), "__h", "inner")
    if some:
        apart = rows.join(collided, "__h", "left_semi")
        told = (apart.groupBy("__h", "__text").agg(F.count(F.lit(1)).alias("__n"), best("__id").alias("__keep")))
        out = out.unionByName(apart.groupBy("__h", "__text", "__id", *shown).agg(F.count(F.lit(1)).alias("__times"))
                              .join(told, ["__h", "__text"]).drop("__text").withColumn("__texts", F.lit(1)),
                              allowMissingColumns=True)
    # rows that repeat id and text were counted; they come back one by one, the first kept
    out = out.withColumn("__k", F.explode(F.sequence(F.lit(1), F.col("__times"))))
    return out.select(F.col("__id").alias(id_col), F.col("__keep").alias("keep_id"),
                      F.col("__n").alias("group_size"),
                      (F.col("__id").eqNullSafe(F.col("__keep")) & (F.col("__k") == 1)).alias("kept"),
                      *[F.col(c).alias(c.strip("_")) for c in shown])


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """The rows that stay, with all columns of ``df``."""
    best = _best(keep)
    others = [c for c in df.columns if c != text_col]
    packed = F.struct(F.col(id_col).isNotNull() if keep == "max" else F.col(id_col).isNull(), F.col(id_col),
                      F.col(text_col).isNull(), F.struct(*others) if others else F.lit(0))
    rows = df.select(text_or_empty(text_col).alias("__text"), packed.alias("__row"))
    one = rows.groupBy(content_hash(F.col("__text")).alias("__h"), "__text").agg(best("__row").alias("__row"))
    null_text, other = (F.col("__row").getField(f) for f in ("col3", "col4"))
    text = F.when(~null_text, F.col("__text"))
    return one.select(*[text.alias(c) if c == text_col else other.getField(c).alias(c) for c in df.columns])
