"""Stand-in views over the driver tables (FIXTURES.md part B), Spark side.

Each function has a DuckDB twin of the same name in ``fixtures_sql``; the two
definitions must stay identical for the oracle check to mean anything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.session import cut_lineage
from kestrel.sources.tables import load

# Tick layout of the `ticks` view.
TICK_BIN_US = 900_000_000          # 15-minute bins
TICK_BASE_US = 0                   # microseconds since 2024-01-01
EPOCH_NTZ = "TIMESTAMP_NTZ'2024-01-01 00:00:00'"

# Category names of the 10 point-cloud labels, in label order.
POINT_LABELS = ["cubic", "orthorhombic", "tetragonal", "monoclinic", "triclinic",
                "hexagonal", "trigonal", "trivial*", "TI*", "SM*"]


def micros_since_2024(ts_col: str = "ts"):
    """µs since 2024-01-01 on a timestamp_ntz column (time-zone free)."""
    return F.expr(f"timestampdiff(MICROSECOND, {EPOCH_NTZ}, {ts_col})")


def ticks(spark: SparkSession, d: str) -> DataFrame:
    ev = load(spark, d, "events")
    trade = F.col("event_type") == "purchase"
    eid = F.col("event_id")
    px = F.col("value") + F.lit(100)
    zero = F.lit(0.0)
    return ev.select(
        F.when(F.col("user_id") % 2 == 0, F.lit("STOCKA")).otherwise(F.lit("STOCKB")).alias("symbol"),
        micros_since_2024("ts").alias("time"),
        F.when(trade, zero).otherwise(px).alias("bid"),
        F.when(trade, zero).otherwise((eid % 10 + 1).cast("double")).alias("bidsz"),
        F.when(trade, zero).otherwise(px + (eid % 5 + 1).cast("double") * F.lit(0.1)).alias("ask"),
        F.when(trade, zero).otherwise((eid % 7 + 1).cast("double")).alias("asksz"),
        F.when(trade, px).otherwise(zero).alias("trdpx"),
        F.when(trade, (eid % 4 + 1).cast("double")).otherwise(zero).alias("trdsz"),
        F.when(trade, F.when(eid % 2 == 0, F.lit(1.0)).otherwise(F.lit(-1.0))).otherwise(zero).alias("trdsd"),
    )


def returns_panel(spark: SparkSession, d: str) -> DataFrame:
    o = load(spark, d, "orders")
    daily = (o.groupBy(F.to_date("o_orderdate").alias("date"),
                       F.col("o_orderpriority").alias("uspn"))
             .agg(F.count(F.lit(1)).cast("double").alias("weight"),
                  F.avg("o_totalprice").alias("price")))
    w = Window.partitionBy("uspn").orderBy("date")
    return daily.withColumn("ret", F.try_divide(F.col("price"), F.lag("price").over(w)) - F.lit(1))


def macro_series(spark: SparkSession, d: str) -> DataFrame:
    """Five series.  The result has one row per series and period whatever the tables hold; its
    lineage is cut, so the plans on top read it again instead of the tables."""
    o = load(spark, d, "orders")
    li = load(spark, d, "lineitem")
    od, sd = F.to_date("o_orderdate"), F.to_date("l_shipdate")
    parts = [
        o.groupBy(F.trunc(od, "quarter").alias("date")).agg(F.sum("o_totalprice").alias("value"))
         .withColumn("series", F.lit("GDP")),
        li.groupBy(F.trunc(sd, "month").alias("date")).agg(F.sum("l_extendedprice").alias("value"))
          .withColumn("series", F.lit("CPIAUCSL")),
        li.groupBy(F.trunc(sd, "month").alias("date")).agg(F.avg("l_discount").alias("value"))
          .withColumn("series", F.lit("BAA10YM")),
        o.groupBy(od.alias("date")).agg(F.avg("o_totalprice").alias("value"))
         .withColumn("series", F.lit("DGS3MO")),
        li.groupBy(sd.alias("date")).agg((F.avg("l_tax") + F.lit(0.01)).alias("value"))
          .withColumn("series", F.lit("DGS10")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return cut_lineage(out.select("series", "date", "value"))


def transactions(spark: SparkSession, d: str) -> DataFrame:
    ev = load(spark, d, "events")
    return ev.select(
        F.col("event_id").alias("row_id"),
        F.col("user_id").alias("account"),
        F.col("ts"),
        F.col("event_type").alias("merchant_category"),
        (F.floor(F.col("value") / F.lit(25)) * F.lit(25)).cast("double").alias("amount"),
        F.expr("CAST(get_json_object(props, '$.k') AS INT) div 10").cast("bigint").alias("balance"),
        (F.lit(1000.0) - F.col("value")).alias("available"),
        (F.col("event_type") == "error").alias("is_fraud"),
    )


def reg_table(spark: SparkSession, d: str) -> DataFrame:
    li = load(spark, d, "lineitem")
    p = load(spark, d, "part").select("p_partkey", "p_size", "p_retailprice")
    return li.join(p, li.l_partkey == p.p_partkey).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
        F.col("l_extendedprice").alias("label"),
        "l_quantity", "l_discount", "l_tax",
        F.col("p_size").cast("double").alias("p_size"), "p_retailprice", "l_returnflag")


REG_FEATURES = ["l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice"]
REG_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "label", "l_shipdate"]


def dataset_family(spark: SparkSession, d: str) -> DataFrame:
    li = load(spark, d, "lineitem")
    return li.select(F.col("l_suppkey").alias("dataset_id"),
                     F.col("l_quantity").alias("x"),
                     F.col("l_extendedprice").alias("y"),
                     "l_orderkey", "l_linenumber", "l_partkey")


def points(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "embeddings")
    names = F.array(*[F.lit(n) for n in POINT_LABELS])
    pts = F.expr("transform(sequence(0, 15), i -> "
                 "transform(slice(embedding, i * 4 + 1, 4), (v, j) -> "
                 "IF(j = 3, abs(CAST(v AS DOUBLE)), CAST(v AS DOUBLE))))")
    return e.select(F.col("vec_id").alias("id"), pts.alias("points"),
                    F.col("label"), F.element_at(names, F.col("label") + 1).alias("category"))


def scores(spark: SparkSession, d: str) -> DataFrame:
    from kestrel.operators.order import row_number
    lb = load(spark, d, "labels")
    base = lb.select("doc_id",
                     ((F.col("doc_id") * 7919) % 100 / F.lit(100.0)).alias("p1"),
                     F.col("quality").alias("target"))
    rn = row_number(base, [], ["doc_id"], "rn")
    return rn.select("doc_id", "p1", "target", ((F.col("rn") - 1) / 32).cast("long").alias("batch"))


def docs_lines(spark: SparkSession, d: str) -> DataFrame:
    doc = load(spark, d, "documents")
    return doc.select("doc_id", F.explode(F.split("text", "\n", -1)).alias("value"))


def docs_labeled(spark: SparkSession, d: str) -> DataFrame:
    doc = load(spark, d, "documents").select("doc_id", "text")
    lb = load(spark, d, "labels").select("doc_id", "quality")
    return doc.join(lb, "doc_id").select(F.col("doc_id").alias("id"), "text",
                                         F.col("quality").cast("double").alias("label"))


LI_A_PATTERN = r'<li><a href="([^"]*)">([^<]*)</a></li>'


def page_items(spark: SparkSession, d: str) -> DataFrame:
    pg = load(spark, d, "pages")
    hrefs = F.regexp_extract_all("html", F.lit(LI_A_PATTERN), 1)
    names = F.regexp_extract_all("html", F.lit(LI_A_PATTERN), 2)
    return (pg.select("page_id", F.arrays_zip(hrefs.alias("href"), names.alias("name")).alias("z"))
              .select("page_id", F.posexplode("z").alias("pos", "item"))
              .select("page_id", (F.col("pos") + 1).alias("pos"),
                      F.col("item.href").alias("href"), F.col("item.name").alias("name")))


def materials(spark: SparkSession, d: str) -> DataFrame:
    p = load(spark, d, "part")
    li = load(spark, d, "lineitem")
    band = (li.where((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45))
              .select(F.col("l_partkey").alias("p_partkey")).distinct()
              .withColumn("has_band", F.lit(True)))
    return (p.join(band, "p_partkey", "left")
             .select(F.col("p_partkey").alias("material_id"), "p_name", "p_brand", "p_type",
                     "p_size", "p_retailprice",
                     F.coalesce("has_band", F.lit(False)).alias("has_band")))


def nan_nulls(spark: SparkSession, d: str) -> DataFrame:
    """Customer table with negative balances turned into NaN (raw, not yet cleaned)."""
    c = load(spark, d, "customer")
    return c.withColumn("c_acctbal", F.when(F.col("c_acctbal") < 0, F.lit(float("nan")))
                        .otherwise(F.col("c_acctbal")))
