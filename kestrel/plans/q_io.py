"""Source / sink round trips, synthetic sets and the parallel map.

Each query writes (part of) a driver table or view to the shared scratch
folder in the reference's format and returns the DataFrame read back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import fanout
from kestrel.plans.registry import register
from kestrel.sources import files as fl, fixtures as fx, synthetic as syn
from kestrel.sources.fixtures_sql import with_views
from kestrel.sources.tables import load

REG_CSV_COLS = ["label", "l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice", "l_returnflag"]
REG_CSV_SCHEMA = ("label double, l_quantity double, l_discount double, l_tax double, p_size double, "
                  "p_retailprice double, l_returnflag string")
TXN_SCHEMA = ("row_id long, account long, ts timestamp_ntz, merchant_category string, amount double, "
              "balance long, available double, is_fraud boolean")


@register("src_csv", sql=with_views(f"SELECT {', '.join(REG_CSV_COLS)} FROM reg_table", ["reg_table"]))
def q_src_csv(spark, d):
    p = fl.write_csv(fx.reg_table(spark, d), fl.scratch_path(spark, "csv"), columns=REG_CSV_COLS)
    return fl.read_csv(spark, p, REG_CSV_SCHEMA)


@register("src_csv_sep", sql=with_views("SELECT row_id, account, amount, balance FROM transactions",
                                        ["transactions"]))
def q_src_csv_sep(spark, d):
    t = fx.transactions(spark, d).select(F.col("row_id").alias("idx"), "row_id", "account", "amount", "balance")
    p = fl.write_csv(t, fl.scratch_path(spark, "csv-sep"), sep=";")
    return fl.read_csv(spark, p, "idx long, row_id long, account long, amount double, balance long", sep=";",
                       index_col="idx")


@register("src_csv_idprop", sql=with_views("SELECT CAST(material_id AS VARCHAR) AS material_id, "
                                           "CAST(p_retailprice AS DOUBLE) AS target FROM materials", ["materials"]))
def q_src_idprop(spark, d):
    m = fx.materials(spark, d).select(F.col("material_id").cast("string").alias("material_id"),
                                      F.col("p_retailprice").alias("target"))
    p = fl.write_csv(m, fl.scratch_path(spark, "idprop"))
    return fl.read_csv(spark, p, "material_id string, target double")


@register("src_jsonl", sql=with_views("SELECT * FROM transactions", ["transactions"]))
def q_src_jsonl(spark, d):
    p = fl.scratch_path(spark, "jsonl")
    fl.write_jsonl(fx.transactions(spark, d), p)
    return fl.read_jsonl(spark, p, TXN_SCHEMA)


@register("src_text", sql=with_views("SELECT value FROM docs_lines", ["docs_lines"]))
def q_src_text(spark, d):
    p = fl.scratch_path(spark, "text")
    load(spark, d, "documents").select("text").write.mode("overwrite").option("lineSep", "\n").text(p)
    return spark.read.option("lineSep", "\n").text(p)


@register("src_panel_hdf", sql=with_views("SELECT * FROM returns_panel", ["returns_panel"]))
def q_src_panel(spark, d):
    p = fl.scratch_path(spark, "panel")
    fx.returns_panel(spark, d).write.mode("overwrite").parquet(p)
    return spark.read.parquet(p)


@register("src_npy", sql=with_views("SELECT id, points FROM points", ["points"]))
def q_src_npy(spark, d):
    """One array file per id, read back with its header checked."""
    from kestrel.sources import keyed_files as kf
    p = kf.write_arrays(fx.points(spark, d), "id", "points", fl.scratch_path(spark, "clouds"))
    return kf.read_arrays(spark, p, columns=4).select(F.col("key").cast("long").alias("id"), F.col("rows").alias("points"))


@register("src_cached_convert", sql=with_views("SELECT * FROM transactions", ["transactions"]))
def q_cached(spark, d):
    raw = fl.scratch_path(spark, "raw-jsonl")
    fl.write_jsonl(fx.transactions(spark, d), raw)
    conv = fl.scratch_path(spark, "converted")
    first = fl.cached_convert(spark, conv, lambda: fl.read_jsonl(spark, raw, TXN_SCHEMA))
    again = fl.cached_convert(spark, conv, lambda: (_ for _ in ()).throw(RuntimeError("must reuse")))
    assert first.columns == again.columns
    return again


SPLIT = "CASE WHEN id % 10 < 8 THEN 'train' WHEN id % 10 = 8 THEN 'valid' ELSE 'test' END"


@register("src_split_dirs", sql=with_views(f"SELECT {SPLIT} AS split, count(*) AS n, sum(label) AS s FROM points "
                                           "GROUP BY 1", ["points"]))
def q_split_dirs(spark, d):
    p = fl.scratch_path(spark, "splits")
    pts = fx.points(spark, d).withColumn("split", F.expr(SPLIT))
    fl.write_per_value(pts, "split", p)
    back = spark.read.schema(pts.schema).parquet(p)  # the split stays a string whatever it looks like
    parts = [back.where(F.col("split") == s) for s in ["train", "valid", "test"]]  # partition pruning
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("s"))


@register("src_dataset_family", sql=with_views(
    "SELECT dataset_id, count(*) AS n FROM dataset_family GROUP BY dataset_id", ["dataset_family"]))
def q_src_family(spark, d):
    """Every data set with its size; no data set is too large for the one-aggregate fits."""
    return fx.dataset_family(spark, d).groupBy("dataset_id").agg(F.count(F.lit(1)).alias("n"))


MOONS_SQL = """
SELECT o_orderkey, CASE WHEN outer_ THEN cos(t) ELSE 1 - cos(t) END AS x,
       CASE WHEN outer_ THEN sin(t) ELSE 1 - sin(t) - 0.5 END AS y, CASE WHEN outer_ THEN 0 ELSE 1 END AS label
FROM (SELECT *, i < n // 2 AS outer_,
             CASE WHEN i < n // 2 THEN pi() * i / greatest(n // 2 - 1, 1)
                  ELSE pi() * (i - n // 2) / greatest(n - n // 2 - 1, 1) END AS t
      FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i, count(*) OVER () AS n FROM orders))"""

CIRCLES_SQL = """
SELECT o_orderkey, cos(t) * r AS x, sin(t) * r AS y, CASE WHEN outer_ THEN 0 ELSE 1 END AS label
FROM (SELECT *, i < n // 2 AS outer_, CASE WHEN i < n // 2 THEN 1.0 ELSE 0.5 END AS r,
             CASE WHEN i < n // 2 THEN 2 * pi() * i / (n // 2) ELSE 2 * pi() * (i - n // 2) / (n - n // 2) END AS t
      FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i, count(*) OVER () AS n FROM orders))"""


@register("src_synth_moons", sql=MOONS_SQL)
def q_moons(spark, d):
    return syn.moons(load(spark, d, "orders"), "o_orderkey")


@register("src_synth_circles", sql=CIRCLES_SQL)
def q_circles(spark, d):
    return syn.circles(load(spark, d, "orders"), "o_orderkey")


@register("src_synth_class")
def q_blobs(spark, d):
    return syn.linear_blobs(load(spark, d, "orders"), "o_orderkey")


@register("src_mesh", sql=with_views("""
SELECT x0 + (x1 - x0) * i / 19 AS label, y0 + (y1 - y0) * j / 19 AS p_retailprice
FROM (SELECT min(label) AS x0, max(label) AS x1, min(p_retailprice) AS y0, max(p_retailprice) AS y1 FROM reg_table)
CROSS JOIN range(0, 20) a(i) CROSS JOIN range(0, 20) b(j)""", ["reg_table"]))
def q_mesh(spark, d):
    return syn.mesh(fx.reg_table(spark, d), "label", "p_retailprice", steps=20)


@register("snk_csv", sql=with_views("SELECT doc_id, p1, target FROM scores", ["scores"]))
def q_snk_csv(spark, d):
    p = fl.write_csv(fx.scores(spark, d), fl.scratch_path(spark, "scores"), sep=";",
                     columns=["doc_id", "p1", "target"])
    return fl.read_csv(spark, p, "doc_id long, p1 double, target int", sep=";")


@register("snk_text_ids", sql=with_views("SELECT CAST(doc_id AS VARCHAR) AS value FROM scores "
                                         "WHERE (CASE WHEN p1 > 1.0 - p1 THEN 1 ELSE 0 END) <> target", ["scores"]))
def q_snk_ids(spark, d):
    s = fx.scores(spark, d)
    wrong = s.where(F.when(F.col("p1") > F.lit(1.0) - F.col("p1"), 1).otherwise(0) != F.col("target"))
    p = fl.write_text_ids(wrong, "doc_id", fl.scratch_path(spark, "ids"))
    return spark.read.text(p)


@register("snk_file_per_row", sql=with_views("SELECT slug, page_id, pos, href FROM items", ["page_items"],
                                             [("items", "SELECT page_id, pos, href, CASE WHEN length(s) > 240 THEN substr(s, 1, 240) || '...' "
                                                        "ELSE s END AS slug FROM (SELECT page_id, pos, href, replace(replace(replace(name, "
                                                        "' ', '_'), '/', '_'), ',', '') AS s FROM page_items)")]))
def q_file_per_row(spark, d):
    """One file per item name, named by it; an item's rows are the file's lines."""
    from kestrel.functions.scalar import slug
    from kestrel.sources import keyed_files as kf
    items = fx.page_items(spark, d).select(slug(F.col("name")).alias("slug"), "page_id", "pos", "href")
    line = F.concat(F.to_json(F.struct("page_id", "pos", "href")), F.lit("\n"))
    p = kf.write_keyed(items.withColumn("line", line), "slug", "line", fl.scratch_path(spark, "per-row"), ".jsonl", ["page_id", "pos"])
    rows = kf.read_keyed(spark, p, ".jsonl").select(F.col("key").alias("slug"), F.explode(
        F.split(F.rtrim(F.decode("content", "utf-8"), F.lit("\n")), "\n")).alias("line"))
    shape = items.select("page_id", "pos", "href").schema
    return rows.select("slug", F.inline(F.array(F.from_json("line", shape))))


@register("snk_array_per_id", sql=with_views("""
SELECT id, points AS conventional, list_transform(points, lambda p: p[1:3]) AS conventional_basis,
       list_concat(list_transform(list_filter(points, lambda p: p[4] <= 1e-8), lambda p: [p[1], p[2], p[3], 0.0]),
                   list_transform(list_filter(points, lambda p: p[4] > 1e-8), lambda p: [p[1], p[2], p[3], 1.0])) AS primitive,
       list_transform(range(1, 5), lambda j: list_transform(points, lambda p: p[j])) AS primitive_basis
FROM points""", ["points"]))
def q_array_per_id(spark, d):
    """Four array columns per id in one wide Parquet row (instead of four files)."""
    from kestrel.functions import arrays as ar
    pts = fx.points(spark, d)
    wide = pts.select("id", F.col("points").alias("conventional"), ar.drop_dim(F.col("points")).alias("conventional_basis"),
                      ar.binarize_intensity(F.col("points")).alias("primitive"),
                      ar.transpose(F.col("points")).alias("primitive_basis"))
    p = fl.scratch_path(spark, "arrays")
    wide.write.mode("overwrite").parquet(p)
    return spark.read.parquet(p)


LOG_CUTS = (0.5, 0.3)  # decision threshold of each epoch


@register("snk_scalar_log", sql=with_views("\nUNION ALL\n".join(f"""
SELECT 'run0' AS run, {e} AS epoch, batch AS step, 'accuracy' AS metric,
       CAST(count(*) FILTER (WHERE target = CASE WHEN p1 > {c} THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS value
FROM scores GROUP BY batch""" for e, c in enumerate(LOG_CUTS)), ["scores"]))
def q_scalar_log(spark, d):
    """Per-step metric log (run, epoch, step, metric, value) appended per epoch; an epoch
    stands for a decision threshold, so the epochs differ."""
    from kestrel.operators import metrics as mt
    p = fl.scratch_path(spark, "log")
    for epoch, cut in enumerate(LOG_CUTS):
        s = fx.scores(spark, d).withColumn("pred", F.when(F.col("p1") > cut, 1).otherwise(0))
        per = mt.classification_metrics(s, "target", "pred", ["batch"])
        per.select(F.lit("run0").alias("run"), F.lit(epoch).alias("epoch"), F.col("batch").alias("step"),
                   F.lit("accuracy").alias("metric"), F.col("accuracy").alias("value")).write.mode("append").parquet(p)
    return spark.read.parquet(p)


@register("snk_console")
def q_console(spark, d):
    rows = fl.bounded_show(fx.reg_table(spark, d).orderBy(*fx.REG_ORDER), 5)
    return spark.createDataFrame(rows, fx.reg_table(spark, d).schema)


@register("udf_parallel_map", sql="SELECT doc_id, nfc_normalize(text) AS text, "
                                  "CAST(length(nfc_normalize(text)) AS BIGINT) AS n_chars FROM documents")
def q_parallel_map(spark, d):
    """A function that needs Python, written per id: Unicode normalisation of every text."""
    docs = load(spark, d, "documents").select("doc_id", "text")
    out = fanout.parallel_map(docs, fanout.normalized, "doc_id long, text string, n_chars long")
    p = fl.write_per_key(out, "doc_id", fl.scratch_path(spark, "per-id"))
    return fl.read_per_key(spark, p, out.schema, "doc_id")
