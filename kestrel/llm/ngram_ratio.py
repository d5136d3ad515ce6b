"""Quality rules from a hashed n-gram log-likelihood ratio, in native expressions.

Words and word pairs are hashed into a fixed number of buckets.  Two
multinomials are counted over them: the trusted target (documents that the label
table calls good) and the raw corpus (every document).  With e the count that a
bucket would have in the target if the target were like the corpus, its weight
is ln((target + prior) / (e + prior)): both sides carry the same prior mass, so
rare n-grams weigh little.  A document's score is the mean weight of its n-grams,
and a document stays if it passes the base rules and its score reaches the
threshold.

Weights are whole multiples of 1/``SCALE``, so scores do not depend on the order
of summation.  The corpus counts cover all rows: one scan, counted on the map
side, ``buckets`` rows shuffled per task.  The model has ``buckets`` numbers
whatever the input and enters the plan as a constant.  The trusted side is
fitted on at most ``max_trusted`` labelled documents (those with the smallest
hash of the id), which bounds the broadcast id list.

Base rules: fewer than 20 words, or more than 30 % of the words in 8-word windows
that occur twice or more in the text (windows are compared by 64-bit hashes
within their document).

Everything is per row, so long or frequent documents and hot sources meet no
shuffle.  Edge cases: null text has no words and fails the base rules; without
labels (or without any trusted document) every weight is 0 and the base rules
alone decide; an empty table gives an empty result; columns of ``df`` may bear
any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import SPACE_CLASS

SPACES = " \t\n\x0b\x0c\r"
SCALE = 10_000
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30


def _words(text: Column) -> Column:
    inner = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(inner) > 0, F.split(inner, f"{SPACE_CLASS}+")).otherwise(F.array().cast("array<string>"))


def _hashed_words(df: DataFrame) -> DataFrame:
    """``__text`` -> ``__words`` and their hashes ``__h``.  Each step is used more than once
    by the next, so the optimizer keeps the steps apart and computes each once."""
    d = df.withColumn("__words", _words(F.col("__text")))
    return d.withColumns({"__h": F.transform("__words", lambda w: F.xxhash64(w)),
                          "__n": F.size("__words").cast("long")})


def _buckets_of(buckets: int) -> Column:
    """Buckets of the words and of the word pairs."""
    at = F.col("__h")
    one = F.transform(at, lambda h: F.pmod(h, F.lit(buckets)).cast("int"))
    two = F.transform(at, lambda h, i: F.pmod(F.xxhash64(h, F.get(at, i + 1)), F.lit(buckets)).cast("int"))
    return F.concat(one, F.slice(two, F.lit(1), F.greatest(F.size(at) - 1, F.lit(0))))


def _text_rules(d: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed under
    names with a leading double underscore; needs ``_hashed_words``."""
    at = F.col("__h")
    window = F.transform(at, lambda h, i: F.xxhash64(h, *[F.get(at, i + k) for k in range(1, WINDOW)]))
    lines = F.filter(F.split("__text", "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)
    d = d.withColumns({
        "__windows": F.slice(window, F.lit(1), F.greatest(F.size(at) - (WINDOW - 1), F.lit(0))),
        "__lines": lines,
        "__word_chars": F.length(F.array_join("__words", "")).cast("long"),
        "__n_symbols": (F.size(F.split("__text", "[#*$%&|<>]")) - 1).cast("long")}).drop("__words", "__text")
    d = d.withColumns({
        "__n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        # only texts that repeat a window are sorted
        "__placed": F.when(F.size(F.array_distinct("__windows")) < F.size("__windows"), F.array_sort(
            F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(
                F.array().cast("array<struct<h:bigint,i:int>>"))}).drop("__windows", "__lines")
    placed = F.col("__placed")
    twice = F.filter(placed, lambda p, j: F.get(placed, j - 1)["h"].eqNullSafe(p["h"])
                     | F.get(placed, j + 1)["h"].eqNullSafe(p["h"]))
    starts = F.array_sort(F.transform(twice, lambda p: p["i"]))
    covered = F.aggregate(
        starts, F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda acc, i: F.struct((i + WINDOW).alias("end"),
                                (acc["n"] + (i + WINDOW - F.greatest(acc["end"], i))).cast("long").alias("n")),
        lambda acc: acc["n"])
    d = d.withColumn("__n_repeat_words", covered).drop("__placed")
    return d.withColumn("__base_failed", (F.col("__n") < MIN_WORDS)
                        | (100 * F.col("__n_repeat_words") > MAX_REPEAT_PERCENT * F.col("__n")))


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_id: str = "doc_id", trusted: Column | None = None, buckets: int = 1 << 16, prior: float = 20.0,
        max_trusted: int = 50_000) -> list[int]:
    """Weight of each bucket, in units of 1/``SCALE``.  ``trusted`` is the condition on a
    label row that makes its document part of the target (default: quality = 1)."""
    good = F.col("quality") == 1 if trusted is None else trusted
    ids = (labels.where(good & F.col(label_id).isNotNull()).select(F.col(label_id).cast("long").alias("__id"))
           .distinct().orderBy(F.xxhash64("__id"), "__id").limit(max_trusted).withColumn("__good", F.lit(1)))
    d = df.select(F.col(id_col).cast("long").alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    d = _hashed_words(d.join(F.broadcast(ids), "__id", "left"))
    per = d.select(F.explode(_buckets_of(buckets)).alias("b"), F.col("__good").alias("g")).groupBy("b").agg(
        F.count(F.lit(1)).alias("raw"), F.count("g").alias("target"))
    whole = Window.partitionBy()
    totals = per.select("b", "raw", "target", F.sum("raw").over(whole).alias("r"), F.sum("target").over(whole).alias("t"))
    expected = F.col("raw") * F.col("t") / F.col("r")
    weight = F.rint(SCALE * F.log((F.col("target") + prior) / (expected + prior))).cast("int")
    out = [0] * buckets
    for r in totals.select("b", weight.alias("w")).collect():  # at most ``buckets`` rows
        out[r.b] = r.w
    return out


def judged(df: DataFrame, weights: list[int], threshold: float = -0.08, text_col: str = "text") -> DataFrame:
    """``df`` with its columns renamed to ``__c0, __c1, ...`` and the rules' columns __n (words),
    __word_chars, __n_symbols, __n_dup_lines, __n_repeat_words, __base_failed, __score, __kept."""
    d = df.toDF(*[f"__c{i}" for i in range(len(df.columns))])
    d = d.withColumn("__text", F.coalesce(F.col(f"__c{df.columns.index(text_col)}"), F.lit("")))
    d = _hashed_words(d)
    table = F.from_json(F.lit("[" + ",".join(map(str, weights)) + "]"), "array<int>")  # folded to a constant
    total = F.aggregate(_buckets_of(len(weights)), F.lit(0).cast("long"), lambda acc, b: acc + F.get(table, b))
    grams = F.greatest(2 * F.col("__n") - 1, F.lit(1))
    d = _text_rules(d.withColumn("__score", total / (SCALE * grams))).drop("__h")
    return d.withColumn("__kept", ~F.col("__base_failed") & (F.col("__score") >= threshold))


def keep_good(df: DataFrame, weights: list[int], threshold: float = -0.08, text_col: str = "text") -> DataFrame:
    """The rows that pass, with the columns of ``df``."""
    d = judged(df, weights, threshold, text_col)
    cols = [f"__c{i}" for i in range(len(df.columns))]
    # the generator keeps the filter above the rules; pushed below, it would repeat them
    d = d.select(*cols, F.explode(F.array("__kept")).alias("__stays"))
    return d.where("__stays").select(*cols).toDF(*df.columns)
