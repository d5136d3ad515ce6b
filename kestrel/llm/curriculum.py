"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight and a curve, the rate at which training asks for its
words over the time 0..1 (piecewise linear).  The integral of the curve, scaled
to the source's target, is its cumulative demand.  A source lays its documents
end to end in seeded-hash order, up to ``max_repeats`` times; a copy is taken if
its middle lies before the target.  Inverting the cumulative demand at that
middle gives the copy's training position, and the mix is range-sorted by it.

Targets: the sources share all words by weight; a target stops at ``max_repeats``
times its source's words and the excess goes to the others by weight until none
is above.  Whole documents are taken, so the words taken from a source differ
from its target by half a document at most.

Running sums inside a source are distributed (range partitions plus offsets), so
a source with a third of all rows is split.  The source table has one row per
source; only scalars reach the driver.

Edge cases: null text has size 0; sources are ordered by code point, the null
source last; a document without words is taken with 0 words wherever its place
falls; an empty table or one without words gives targets of 0 and takes
nothing.  A very long text is split whole to count its words; it takes
one place as long as it is.  Equal rows count separately.  Output columns replace columns of the
same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import SPACE_CLASS, written
from kestrel.operators.order import row_number, running_sum

#: Rate over time of the sources of each weight: (time, rate) knots from 0 to 1.
CURVES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)))


def word_count(text_col: str = "text") -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text; null: 0."""
    inner = F.btrim(F.col(text_col), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(F.length(inner) > 0, F.size(F.split(inner, f"{SPACE_CLASS}+"))).otherwise(0).cast("long")


def _source_key(source_col: str) -> Column:
    """A non-null key that sorts like the source by code point, null last."""
    return F.when(F.col(source_col).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source_col).cast("string")))


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3) -> DataFrame:
    """(__source, __size) rows -> one row per source: source_size, weight, target."""
    per = written(sized.groupBy("__source").agg(F.sum("__size").alias("source_size")), "source-sizes")
    turn = (F.col("__rn") - 1) % len(weights) + 1
    ranked = written(row_number(per, [], ["__source"], "__rn", num_partitions=1 if per.count() < 10_000 else None)
                     .select("__source", "source_size",
                             F.element_at(F.array(*map(F.lit, weights)), turn.cast("int")).alias("weight")),
                     "source-weights")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    most = F.col("source_size") * F.lit(max_repeats)
    level, capped = 0.0, -1
    while total:  # raise the level until no further source reaches its cap; at most one round per source
        full = most < F.lit(level) * F.col("weight")
        rest, share, n = ranked.agg(F.sum(F.when(full, most).otherwise(0)), F.sum(F.when(~full, F.col("weight"))),
                                    F.count(F.when(full, 1))).first()
        if n == capped or not share:
            break
        level, capped = (total - rest) / share, n
    return ranked.select("__source", "source_size", "weight",
                         F.least(most.cast("double"), F.lit(level) * F.col("weight")).alias("target"))


def _position(share: Column, weight: Column, weights, curves) -> Column:
    """Time at which a source of ``weight`` has had ``share`` (0..1) of its demand."""
    out = F.lit(None).cast("double")
    for w, knots in zip(weights, curves, strict=True):
        area = [(t1 - t0) * (r0 + r1) / 2 for (t0, r0), (t1, r1) in zip(knots, knots[1:])]
        done, when = 0.0, None
        for ((t0, r0), (t1, r1)), a in zip(zip(knots, knots[1:]), area):
            # r0 s + slope s^2 / 2 = need, solved for s in the stable form
            need = share * sum(area) - F.lit(done)
            slope = (r1 - r0) / (t1 - t0)
            root = F.sqrt(F.greatest(F.lit(0.0), F.lit(r0 * r0) + F.lit(2 * slope) * need))
            t = F.least(F.lit(t1), F.lit(t0) + 2 * need / (F.lit(r0) + root))
            when = F.when(share * sum(area) <= done + a, t) if when is None else when.when(share * sum(area) <= done + a, t)
            done += a
        out = F.when(weight == w, when.otherwise(F.lit(1.0))).otherwise(out)
    return out


def _takes(df: DataFrame, keys: list[str], source_col: str, text_col: str, seed: int, weights, curves,
           max_repeats: int) -> DataFrame:
    """Narrow table: ``keys``, size, source_size, target, copies, positions."""
    sized = written(df.select(*keys, _source_key(source_col).alias("__source"),
                              word_count(text_col).alias("__size")), "document-sizes")
    targets = source_targets(sized, weights, max_repeats)
    order = [F.xxhash64(F.lit(seed), *keys), *keys, "__size"]
    placed = running_sum(sized.withColumn("__order", order[0]), ["__source"], ["__order", *keys, "__size"], ["__size"])
    middle = F.col("__size_cum") - F.col("__size") / 2
    out = placed.join(targets, "__source")
    at = F.transform(F.sequence(F.lit(0), F.lit(max_repeats - 1)), lambda r: r * F.col("source_size") + middle)
    out = out.withColumn("__at", F.filter(at, lambda x: x < F.col("target")))
    out = out.withColumn("positions", F.transform("__at", lambda x: _position(x / F.col("target"), F.col("weight"),
                                                                              weights, curves)))
    return out.select(*keys, F.col("__size").alias("size"), "source_size", "target", "positions")


def mix(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: int = 29,
        weights: tuple[int, ...] = (1, 2, 3), curves=CURVES, max_repeats: int = 3) -> DataFrame:
    """One row per document: ``id_col``, size, source_size, target, taken, positions (one
    per copy taken, ascending within a source's passes)."""
    named = df.select(F.col(id_col).alias("__id"), F.col(source_col).alias("__src"), F.col(text_col).alias("__text"))
    out = _takes(named, ["__id"], "__src", "__text", seed, weights, curves, max_repeats)
    return out.select(F.col("__id").alias(id_col), "size", "source_size", "target",
                      (F.size("positions") * F.col("size")).alias("taken"), "positions")


def training_order(df: DataFrame, source_col: str = "source", text_col: str = "text", seed: int = 29,
                   weights: tuple[int, ...] = (1, 2, 3), curves=CURVES, max_repeats: int = 3) -> DataFrame:
    """The mixed corpus: the rows of ``df``, each as often as it is taken, range-sorted by
    training position.  A row is known by a 128-bit hash of its columns; rows equal in
    all columns are interchangeable."""
    rows = df.select(F.struct(*df.columns).alias("__row"))
    marked = rows.select("__row", F.xxhash64("__row").alias("__k1"), F.xxhash64(F.lit(seed), "__row").alias("__k2"))
    narrow = marked.select("__k1", "__k2", F.col("__row").getField(source_col).alias("__src"),
                           F.col("__row").getField(text_col).alias("__text"))
    takes = _takes(narrow, ["__k1", "__k2"], "__src", "__text", seed, weights, curves, max_repeats)
    takes = written(takes.select("__k1", "__k2", F.explode("positions").alias("__position")), "training-positions")
    once = marked.dropDuplicates(["__k1", "__k2"]) if _repeats(narrow) else marked
    mixed = once.join(takes, ["__k1", "__k2"])
    return (mixed.repartitionByRange("__position", "__k1").sortWithinPartitions("__position", "__k1", "__k2")
            .select(*[F.col("__row").getField(c).alias(c) for c in df.columns]))


def _repeats(narrow: DataFrame) -> bool:
    return bool(narrow.groupBy("__k1", "__k2").count().where("count > 1").take(1))
