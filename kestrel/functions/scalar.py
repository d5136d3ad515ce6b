"""Scalar column functions; all JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# File-name slug rules (replacements in order, length cap, suffix).
SLUG_MAX = 240
SLUG_SUFFIX = "..."

# Class-id maps of the point-cloud targets.
CRYSTAL_FAMILY = {"cubic": 0, "orthorhombic": 1, "tetragonal": 2, "monoclinic": 3, "triclinic": 4,
                  "hexagonal": 5, "trigonal": 5}
CRYSTAL_SYSTEM = {"cubic": 0, "orthorhombic": 1, "tetragonal": 2, "monoclinic": 3, "triclinic": 4,
                  "hexagonal": 5, "trigonal": 6}
TOPOLOGY = {"trivial*": 0, "TI*": 1, "SM*": 2}


def slug(c: Column) -> Column:
    """' ' and '/' -> '_', ',' removed; names over 240 chars cut and marked '...'."""
    s = F.replace(F.replace(F.replace(c, F.lit(" "), F.lit("_")), F.lit("/"), F.lit("_")), F.lit(","), F.lit(""))
    return F.when(F.length(s) > SLUG_MAX, F.concat(F.substring(s, 1, SLUG_MAX), F.lit(SLUG_SUFFIX))).otherwise(s)


def seconds_in_hour(ts: Column) -> Column:
    """minute * 60 + second of a timestamp (fraction dropped)."""
    return F.minute(ts) * 60 + F.second(ts)


def hour_key(ts: Column) -> Column:
    """The 'YYYY-MM-DD HH' prefix used for same-hour tests."""
    return F.date_format(ts, "yyyy-MM-dd HH")


def round_half_even(c: Column, scale: int = 0) -> Column:
    return F.bround(c, scale)


def label_map(c: Column, mapping: dict[str, int], strict: bool = True) -> Column:
    """Category -> class id; unknown categories raise (``strict``) or give null."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    got = F.try_element_at(m, c)
    if strict:
        return F.when(got.isNull() & c.isNotNull(),
                      F.raise_error(F.concat(F.lit("unknown category: "), c))).otherwise(got)
    return got


def parse_list_pick(s: Column, index: int) -> Column:
    """'[a, b, c]' text -> element ``index`` (0-based) as double."""
    return F.get(F.from_json(s, "array<double>"), index)


def binarize(c: Column, threshold: float, strict: bool = False) -> Column:
    """1 when c >= threshold (or > when strict), as int."""
    return (c > threshold if strict else c >= threshold).cast("int")


def softmax_argmax(logprobs: Column) -> tuple[Column, Column]:
    """(argmax class, its probability) from an array of log-probabilities."""
    probs = F.transform(logprobs, lambda x: F.exp(x))
    best = F.array_max(probs)
    return (F.array_position(probs, best) - 1).cast("int"), best


def null_safe_equal_flag(a: Column, b: Column) -> Column:
    """a == b as int, null-containing comparisons are 0 (pandas: NaN != NaN)."""
    return F.coalesce(a == b, F.lit(False)).cast("int")
