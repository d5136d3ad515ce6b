"""URL filters by a temporal join with dated lists, in native DataFrame operations.

A list is a log of dated entries (value, day, add or remove).  A value is a host, a
parent domain, a host with leading path segments, or a whole address without
query and fragment, always in lower-case host form.  Entries become validity
intervals [from, until); every capture is judged by the intervals that hold on
the day it was fetched, by an as-of join.

Scale: entries are first reduced to one state per (value, day), and captures to
their distinct (key, day) pairs, both with map-side combining.  Thus the window
that finds the latest interval sees at most one row per day of a value, even
if a third of all captures share a host.  The states go back to the captures in an
equi-join on (key, day), whose large keys AQE splits.  Nothing is broadcast or
collected but one number, the path depth of the deepest entry, beyond which no
prefix of an address can be listed.

Edge cases: null or unparsable addresses have no keys and are not listed; a null
fetch day matches nothing; on a day with both an add and a remove of a value the
remove wins; a remove before any add has no effect; repeated entries count once;
repeated captures each give a row; very long addresses have as many keys as path segments; without
entries no capture is listed, and without captures there are no rows; columns of the captures may bear any names but
those of the result, which they lose to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import written


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and trailing dot; empty if there is none."""
    authority = F.regexp_extract(url, r"^\s*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#\s]*)", 1)
    host = F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":[0-9]*$", "")
    return F.lower(F.regexp_replace(host, r"\.$", ""))


def path_of(url: Column) -> Column:
    """Path without query, fragment and trailing slashes."""
    path = F.regexp_extract(url, r"^\s*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//[^/?#\s]*([^?#]*)", 1)
    return F.regexp_replace(F.trim(path), r"/+$", "")


def with_keys(df: DataFrame, url_col: str, out: str, path_depth: int | None = None) -> DataFrame:
    """``df`` with ``out``, every list value that covers its address: the host, its parent
    domains of two labels or more, the host with every number of leading path segments (up to
    ``path_depth``, if given), and the whole address."""
    url, host, path = F.col(url_col), F.col("__host"), F.col("__path")
    labels, steps = F.col("__labels"), F.col("__steps")
    d = df.withColumns({"__host": host_of(url), "__path": path_of(url)})
    steps_of = F.split(path, "/")
    d = d.withColumns({"__labels": F.split(host, r"\."),
                       "__steps": F.slice(steps_of, 2, F.size(steps_of) if path_depth is None else path_depth)})
    parents = F.transform(F.sequence(F.lit(2), F.greatest(F.size(labels), F.lit(2))),
                          lambda k: F.array_join(F.slice(labels, -k, k), "."))
    prefixes = F.transform(steps, lambda s, i: F.when(
        s != "", F.concat(host, F.lit("/"), F.array_join(F.slice(steps, F.lit(1), i + 1), "/"))))
    keys = F.concat(F.array(host, F.concat(host, path)), parents, prefixes)
    keys = F.filter(F.array_distinct(keys), lambda k: k != "")
    return d.withColumn(out, F.when(host != "", keys).otherwise(F.array().cast("array<string>"))).drop(
        "__host", "__path", "__labels", "__steps")


def validity_intervals(entries: DataFrame) -> DataFrame:
    """Dated entries (value, day, added boolean) -> (value, valid_from, valid_until): the times
    at which a value is listed; ``valid_until`` null: still listed."""
    days = entries.where("value is not null and day is not null").groupBy("value", "day").agg(
        F.min("added").alias("added"))
    by_day = Window.partitionBy("value").orderBy("day")
    days = days.withColumn("valid_until", F.lead("day").over(by_day))
    return days.where("added").select("value", F.col("day").alias("valid_from"), "valid_until")


def listed_captures(captures: DataFrame, entries: DataFrame, url_col: str = "url", day_col: str = "fetch_day",
                    path_depth: int | None = None) -> DataFrame:
    """``captures`` with n_listed (list values that hold for it on its day), first_listed (the least
    of them) and listed.  Addresses are probed with as many path segments as the deepest entry
    has, unless ``path_depth`` says fewer."""
    deepest = entries.agg(F.max(F.size(F.split("value", "/")) - 1)).first()[0] or 0
    path_depth = deepest if path_depth is None else min(path_depth, deepest)
    kept = [c for c in captures.columns if c not in ("n_listed", "first_listed", "listed")]
    rows = captures.select(F.struct(*kept).alias("__row"), F.col(url_col).alias("__url"), F.col(day_col).alias("__day"))
    # the verdict depends on address and day alone
    asked = rows.where("__url is not null and __day is not null").select("__url", "__day").distinct()
    probes = with_keys(asked, "__url", "__keys", path_depth).select("__url", "__day", F.explode("__keys").alias("__key"))
    intervals = validity_intervals(entries)
    line = intervals.select(F.col("value").alias("__key"), F.col("valid_from").alias("__day"), F.lit(0).alias("__probe"),
                            F.struct("valid_from", "valid_until").alias("__interval"))
    line = line.unionByName(probes.select("__key", "__day").distinct().withColumn("__probe", F.lit(1)),
                            allowMissingColumns=True)
    latest = Window.partitionBy("__key").orderBy("__day", "__probe").rowsBetween(Window.unboundedPreceding, 0)
    state = line.withColumn("__interval", F.last("__interval", ignorenulls=True).over(latest))
    state = state.where((F.col("__probe") == 1) & F.col("__interval").isNotNull() & (
        F.col("__interval.valid_until").isNull() | (F.col("__day") < F.col("__interval.valid_until"))))
    state = written(state.select("__key", "__day"), "listed-days")
    hits = written(probes.join(state, ["__key", "__day"]).groupBy("__url", "__day").agg(
        F.count(F.lit(1)).alias("__n"), F.min("__key").alias("__first")), "listed-addresses")
    out = rows.join(hits, ["__url", "__day"], "left")
    return out.select(*[F.col("__row").getField(c).alias(c) for c in kept],
                      F.coalesce("__n", F.lit(0)).cast("long").alias("n_listed"),
                      F.col("__first").alias("first_listed"), F.col("__n").isNotNull().alias("listed"))
