"""Projection, filters, joins, sort/limit/sampling, set ops, scalar and array
functions (SURVEY §2.3, 2.4, 2.7, 2.8, 2.9)."""

from __future__ import annotations

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from kestrel.functions import arrays as ar, scalar as sc
from kestrel.operators import clean, order
from kestrel.plans.registry import register
from kestrel.sources import fixtures as fx
from kestrel.sources.fixtures_sql import with_views
from kestrel.sources.tables import load

FEAT_LIST = ", ".join(fx.REG_FEATURES)

# ---------------------------------------------------------------- 2.3


@register("prj_select", sql=with_views("SELECT label, l_quantity FROM reg_table", ["reg_table"]))
def q_select(spark, d):
    return fx.reg_table(spark, d).select("label", "l_quantity")


@register("prj_drop", sql=with_views(
    "SELECT row_id, account, merchant_category, amount, balance, available FROM transactions",
    ["transactions"]))
def q_drop(spark, d):
    return fx.transactions(spark, d).drop("ts", "is_fraud")


ALLNULL_SQL = """
SELECT *, CASE WHEN amount < 0 THEN merchant_category END AS echo_buffer,
          CASE WHEN available > 1e9 THEN available END AS merchant_zip FROM transactions"""


def _with_null_cols(t):
    return (t.withColumn("echo_buffer", F.when(F.col("amount") < 0, F.col("merchant_category")))
             .withColumn("merchant_zip", F.when(F.col("available") > 1e9, F.col("available"))))


@register("prj_drop_allnull", sql=with_views(
    "SELECT row_id, account, ts, merchant_category, amount, balance, available, is_fraud FROM wide",
    ["transactions"], [("wide", ALLNULL_SQL)]))
def q_drop_allnull(spark, d):
    return clean.drop_all_null(_with_null_cols(fx.transactions(spark, d)))


@register("prj_split_xy", sql=with_views(f"SELECT label, [{FEAT_LIST}] AS features FROM reg_table",
                                         ["reg_table"]))
def q_split_xy(spark, d):
    df = fx.reg_table(spark, d).select(*fx.REG_FEATURES, "label")
    feats, label = clean.split_xy(df, "label")
    return df.select(label, F.array(*feats).alias("features"))


@register("prj_rename", sql="SELECT r_regionkey AS region_id, r_name AS region_name FROM region")
def q_rename(spark, d):
    return clean.rename_positional(load(spark, d, "region"), ["region_id", "region_name"])


@register("prj_concat_cols", sql=with_views(
    "SELECT row_id, amount, available, CAST(is_fraud AS INTEGER) AS is_fraud_int, "
    "CAST(merchant_category = 'purchase' AS INTEGER) AS mc_purchase FROM transactions", ["transactions"]))
def q_concat_cols(spark, d):
    t = fx.transactions(spark, d)
    return t.select("row_id", "amount", "available", "is_fraud", "merchant_category").withColumns({
        "is_fraud_int": F.col("is_fraud").cast("int"),
        "mc_purchase": (F.col("merchant_category") == "purchase").cast("int")}).drop(
        "is_fraud", "merchant_category")


TRANSPOSE_COLS = fx.REG_FEATURES


@register("prj_transpose", sql=with_views(
    "\nUNION ALL\n".join(
        f"SELECT '{s}' AS stat, " + ", ".join(f"CAST({fn}({c}) AS DOUBLE) AS {c}" for c in TRANSPOSE_COLS)
        + " FROM reg_table"
        for s, fn in [("count", "count"), ("mean", "avg"), ("stddev", "stddev_samp"), ("min", "min"),
                      ("max", "max")]), ["reg_table"]))
def q_transpose(spark, d):
    from kestrel.operators.profile import describe
    long = describe(fx.reg_table(spark, d), TRANSPOSE_COLS)
    stats = ["count", "mean", "stddev", "min", "max"]
    cells = long.select("column", F.inline(F.array(*[F.struct(F.lit(s).alias("stat"),
                                                                F.col(s).cast("double").alias("value"))
                                                       for s in stats])))
    return cells.groupBy("stat").pivot("column", TRANSPOSE_COLS).agg(F.first("value"))


@register("flt_le", sql=with_views("SELECT row_id, amount FROM transactions WHERE amount <= 600",
                                   ["transactions"]))
def q_le(spark, d):
    return fx.transactions(spark, d).where(F.col("amount") <= 600).select("row_id", "amount")


CLEAN_NAN = ("clean", "SELECT c_custkey, c_name, c_nationkey, CASE WHEN isnan(c_acctbal) THEN NULL "
                      "ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM nan_nulls")


@register("flt_notnull_target", sql=with_views("SELECT * FROM clean WHERE c_acctbal IS NOT NULL",
                                               ["nan_nulls"], [CLEAN_NAN]))
def q_notnull_target(spark, d):
    return clean.nan_to_null(fx.nan_nulls(spark, d)).dropna(subset=["c_acctbal"])


@register("flt_dropna_any", sql=with_views(
    "SELECT * FROM returns_panel WHERE date IS NOT NULL AND uspn IS NOT NULL AND weight IS NOT NULL "
    "AND price IS NOT NULL AND ret IS NOT NULL", ["returns_panel"]))
def q_dropna_any(spark, d):
    return clean.dropna_any(fx.returns_panel(spark, d))


@register("flt_skip_zero", sql=with_views("SELECT row_id, amount FROM transactions WHERE amount <> 0",
                                          ["transactions"]))
def q_skip_zero(spark, d):
    return fx.transactions(spark, d).where(F.col("amount") != 0).select("row_id", "amount")


@register("flt_min_batch", sql=with_views(
    "SELECT doc_id, batch FROM scores WHERE batch IN (SELECT batch FROM scores GROUP BY batch "
    "HAVING count(*) >= 16)", ["scores"]))
def q_min_batch(spark, d):
    return clean.with_min_group_size(fx.scores(spark, d), "batch", 16).select("doc_id", "batch")


MISCLS_SQL = """
SELECT doc_id, target AS true_label, pred AS pred_label, probs[target + 1] AS score_true,
       probs[pred + 1] AS score_pred
FROM (SELECT doc_id, target, [1.0 - p1, p1] AS probs, CASE WHEN p1 > 1.0 - p1 THEN 1 ELSE 0 END AS pred
      FROM scores)
WHERE pred <> target"""


@register("flt_misclassified", sql=with_views(MISCLS_SQL, ["scores"]))
def q_misclassified(spark, d):
    s = fx.scores(spark, d).withColumn("probs", F.array(F.lit(1.0) - F.col("p1"), F.col("p1")))
    s = s.withColumn("pred", F.when(F.col("p1") > F.lit(1.0) - F.col("p1"), 1).otherwise(0))
    return (s.where(F.col("pred") != F.col("target"))
             .select("doc_id", F.col("target").alias("true_label"), F.col("pred").alias("pred_label"),
                     F.element_at("probs", F.col("target") + 1).alias("score_true"),
                     F.element_at("probs", F.col("pred") + 1).alias("score_pred")))


@register("flt_date_range", sql=with_views(
    "SELECT * FROM macro_series WHERE date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'", ["macro_series"]))
def q_date_range(spark, d):
    return fx.macro_series(spark, d).where(F.col("date").between(F.lit("1996-01-01").cast("date"),
                                                                 F.lit("2000-12-31").cast("date")))


GUARD_SQL = """
SELECT count(*) FILTER (WHERE NOT coalesce(len(points) = 16, false)) AS n_points_16,
       count(*) FILTER (WHERE NOT coalesce(list_min(list_transform(points, lambda p: p[4])) >= 0, false)) AS intensity_nonneg,
       count(*) FILTER (WHERE NOT coalesce(label BETWEEN 0 AND 9, false)) AS label_domain
FROM points"""


@register("asr_guard", sql=with_views(GUARD_SQL, ["points"]))
def q_guard(spark, d):
    p = fx.points(spark, d)
    return clean.guard_violations(p, {
        "n_points_16": F.size("points") == 16,
        "intensity_nonneg": F.array_min(F.transform("points", lambda x: x[3])) >= 0,
        "label_domain": F.col("label").between(0, 9)})


# ---------------------------------------------------------------- 2.4


@register("jn_isin_flag", sql=with_views("SELECT material_id, has_band FROM materials", ["materials"]))
def q_isin_flag(spark, d):
    return fx.materials(spark, d).select("material_id", "has_band")


SKIP_SQL = """
SELECT i.page_id, i.pos, i.slug
FROM items i
WHERE NOT EXISTS (SELECT 1 FROM manifest m WHERE m.slug = i.slug AND m.size > 0)"""
ITEMS_SQL = ("items", """
SELECT page_id, pos,
       CASE WHEN length(s) > 240 THEN substr(s, 1, 240) || '...' ELSE s END AS slug
FROM (SELECT page_id, pos, replace(replace(replace(name, ' ', '_'), '/', '_'), ',', '') AS s FROM page_items)""")
MANIFEST_SQL = ("manifest", """
SELECT i.slug, CASE WHEN p.page_id % 9 = 0 THEN 0 ELSE length(p.html) END AS size
FROM items i JOIN pages p ON i.page_id = p.page_id WHERE p.page_id % 3 = 0""")


def _items(spark, d):
    return fx.page_items(spark, d).select("page_id", "pos", sc.slug(F.col("name")).alias("slug"))


@register("jn_skip_done", sql=with_views(SKIP_SQL, ["page_items"], [ITEMS_SQL, MANIFEST_SQL]))
def q_skip_done(spark, d):
    items = _items(spark, d)
    pages = load(spark, d, "pages").select("page_id", "html")
    manifest = (items.join(pages, "page_id").where(F.col("page_id") % 3 == 0)
                .select("slug", F.when(F.col("page_id") % 9 == 0, F.lit(0))
                        .otherwise(F.length("html")).alias("size")))
    done = manifest.where(F.col("size") > 0).select("slug")
    return items.join(done, "slug", "left_anti").select("page_id", "pos", "slug")


# ---------------------------------------------------------------- 2.7


@register("srt_desc", sql="SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_acctbal DESC, s_suppkey")
def q_sort_desc(spark, d):
    return load(spark, d, "supplier").select("s_suppkey", "s_acctbal").orderBy(F.desc("s_acctbal"), "s_suppkey")


@register("lim_head", sql=with_views(
    f"SELECT * FROM reg_table ORDER BY {', '.join(fx.REG_ORDER)} LIMIT 3", ["reg_table"]))
def q_head(spark, d):
    return fx.reg_table(spark, d).orderBy(*fx.REG_ORDER).limit(3)


@register("lim_argmax", sql="""
SELECT s_nationkey, s_suppkey, s_acctbal FROM (
  SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS rk FROM supplier)
WHERE rk = 1""")
def q_argmax(spark, d):
    s = load(spark, d, "supplier")
    w = Window.partitionBy("s_nationkey").orderBy(F.desc("s_acctbal"), "s_suppkey")
    return s.withColumn("rk", F.row_number().over(w)).where("rk = 1").select("s_nationkey", "s_suppkey", "s_acctbal")


@register("lim_argmin", sql="""
SELECT c_nationkey, min_by(c_custkey, (c_acctbal, c_custkey)) AS c_custkey, min(c_acctbal) AS c_acctbal
FROM customer GROUP BY c_nationkey""")
def q_argmin(spark, d):
    c = load(spark, d, "customer")
    return c.groupBy("c_nationkey").agg(
        F.min_by("c_custkey", F.struct("c_acctbal", "c_custkey")).alias("c_custkey"),
        F.min("c_acctbal").alias("c_acctbal"))


@register("lim_page", sql=with_views("""
SELECT (rn - 1) // 200 AS page_no, count(*) AS n_items, min(page_id) AS first_page, max(page_id) AS last_page
FROM (SELECT page_id, row_number() OVER (ORDER BY page_id, pos) AS rn FROM page_items)
GROUP BY 1""", ["page_items"]))
def q_page(spark, d):
    items = fx.page_items(spark, d)
    n = order.row_number(items, [], ["page_id", "pos"], "rn")
    return n.groupBy(((F.col("rn") - 1) / 200).cast("long").alias("page_no")).agg(
        F.count(F.lit(1)).alias("n_items"), F.min("page_id").alias("first_page"),
        F.max("page_id").alias("last_page"))


@register("smp_split_ratio", sql=with_views("""
SELECT CASE WHEN l_orderkey % 100 < 75 THEN 'train' ELSE 'test' END AS split, count(*) AS n, sum(label) AS s
FROM reg_table GROUP BY 1""", ["reg_table"]))
def q_split_ratio(spark, d):
    from kestrel.operators.sampling import split_by_key
    parts = split_by_key(fx.reg_table(spark, d), "l_orderkey", 0.75)
    return parts.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("s"))


@register("smp_random_split")
def q_random_split(spark, d):
    from kestrel.operators.sampling import random_split
    tr, te = random_split(fx.reg_table(spark, d), [0.75, 0.25], seed=123)
    return tr.select(F.lit("train").alias("split")).unionByName(te.select(F.lit("test").alias("split"))) \
             .groupBy("split").count()


@register("smp_shuffle", sql=with_views("SELECT l_orderkey, l_linenumber, label FROM reg_table", ["reg_table"]))
def q_shuffle(spark, d):
    """All rows in seeded random order (the oracle compares them as a multiset)."""
    from kestrel.operators.sampling import shuffled
    return shuffled(fx.reg_table(spark, d).select("l_orderkey", "l_linenumber", "label"), seed=0)


KFOLD_SQL = f"""
SELECT fold, count(*) AS n, sum(label) AS s, min(rn) AS first_rn FROM (
  SELECT *, CASE WHEN rn <= (cnt % 5) * (cnt // 5 + 1) THEN (rn - 1) // (cnt // 5 + 1)
                 ELSE cnt % 5 + (rn - 1 - (cnt % 5) * (cnt // 5 + 1)) // (cnt // 5) END AS fold
  FROM (SELECT *, row_number() OVER (ORDER BY {', '.join(fx.REG_ORDER)}) AS rn, count(*) OVER () AS cnt
        FROM reg_table))
GROUP BY fold"""


@register("smp_kfold", sql=with_views(KFOLD_SQL, ["reg_table"]))
def q_kfold(spark, d):
    r = fx.reg_table(spark, d)
    n = order.row_number(r, [], fx.REG_ORDER, "rn")
    f = n.crossJoin(F.broadcast(r.agg(F.count(F.lit(1)).alias("cnt")))).withColumn(
        "fold", order.contiguous_fold(F.col("rn"), F.col("cnt"), 5))
    return f.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("s"),
                                 F.min("rn").alias("first_rn"))


STRAT_SQL = """
WITH base AS (SELECT doc_id, target, row_number() OVER (PARTITION BY target ORDER BY doc_id) AS rn FROM scores),
cls AS (SELECT target, count(*) AS c FROM scores GROUP BY target),
cls2 AS (SELECT target, c, coalesce(sum(c) OVER (ORDER BY target ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS st FROM cls),
alloc AS (SELECT target, f AS fold,
                 greatest(0, CAST(floor((st + c - 1 - f) / 5) AS BIGINT) - CAST(ceil((st - f) / 5) AS BIGINT) + 1) AS a
          FROM cls2 CROSS JOIN range(0, 5) t(f)),
alloc2 AS (SELECT target, fold, sum(a) OVER (PARTITION BY target ORDER BY fold) AS hi, a FROM alloc)
SELECT b.target, a.fold, count(*) AS n, min(b.doc_id) AS first_doc
FROM base b JOIN alloc2 a ON b.target = a.target AND b.rn > a.hi - a.a AND b.rn <= a.hi
GROUP BY b.target, a.fold"""


@register("smp_kfold_stratified", sql=with_views(STRAT_SQL.replace("WITH base", ", base", 1), ["scores"]))
def q_kfold_strat(spark, d):
    s = fx.scores(spark, d)
    f = order.with_stratified_folds(s, "target", ["doc_id"], 5)
    return f.groupBy("target", "fold").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc"))


@register("smp_batches", sql=with_views("SELECT batch, count(*) AS n, min(doc_id) AS first_doc FROM scores "
                                        "GROUP BY batch", ["scores"]))
def q_batches(spark, d):
    return fx.scores(spark, d).groupBy("batch").agg(F.count(F.lit(1)).alias("n"),
                                                   F.min("doc_id").alias("first_doc"))


PREFIX_SIZES = list(range(20, 481, 10))
PREFIX_SQL = f"""
SELECT f.fold, s.size, count(*) AS n, sum(label) AS s_label
FROM (SELECT *, CASE WHEN rn <= (cnt % 5) * (cnt // 5 + 1) THEN (rn - 1) // (cnt // 5 + 1)
                     ELSE cnt % 5 + (rn - 1 - (cnt % 5) * (cnt // 5 + 1)) // (cnt // 5) END AS rfold
      FROM (SELECT *, row_number() OVER (ORDER BY {', '.join(fx.REG_ORDER)}) AS rn, count(*) OVER () AS cnt
            FROM reg_table)) r
CROSS JOIN range(0, 5) f(fold)
JOIN (SELECT unnest(range(20, 481, 10)) AS size) s ON TRUE
WHERE r.rfold <> f.fold
  AND (CASE WHEN r.rfold < f.fold THEN r.rn ELSE r.rn - (cnt // 5 + CASE WHEN f.fold < cnt % 5 THEN 1 ELSE 0 END) END) <= s.size
GROUP BY f.fold, s.size"""


@register("smp_prefix", sql=with_views(PREFIX_SQL, ["reg_table"]))
def q_prefix(spark, d):
    from kestrel.operators.sampling import fold_prefixes
    r = fx.reg_table(spark, d)
    pre = fold_prefixes(r, fx.REG_ORDER, 5, PREFIX_SIZES)
    return pre.groupBy("fold", "size").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("s_label"))


# ---------------------------------------------------------------- 2.8


@register("set_union_rows", sql=with_views("""
SELECT page_id, pos, name FROM page_items WHERE pos % 2 = 1
UNION ALL
SELECT page_id, pos, name FROM page_items WHERE pos % 2 = 0""", ["page_items"]))
def q_union_rows(spark, d):
    it = fx.page_items(spark, d).select("page_id", "pos", "name")
    return it.where(F.col("pos") % 2 == 1).unionByName(it.where(F.col("pos") % 2 == 0))


# ---------------------------------------------------------------- 2.9 scalar

HALF_LIFE = 120.0


@register("fn_log_pow", sql=with_views(f"""
SELECT series, date, ln(value) AS log_v, sqrt(value) AS sqrt_v, value * value AS sq_v,
       pow(2.0, -1.0 / {HALF_LIFE}) AS decay FROM macro_series WHERE value > 0""", ["macro_series"]))
def q_log_pow(spark, d):
    m = fx.macro_series(spark, d).where(F.col("value") > 0)
    return m.select("series", "date", F.ln("value").alias("log_v"), F.sqrt("value").alias("sqrt_v"),
                    (F.col("value") * F.col("value")).alias("sq_v"),
                    F.pow(F.lit(2.0), F.lit(-1.0 / HALF_LIFE)).alias("decay"))


@register("fn_round_half_even", sql=with_views("""
SELECT row_id, round_even(amount / 50, 0) AS r0, round_even(available / 10, 1) AS r1 FROM transactions""",
                                               ["transactions"]))
def q_round(spark, d):
    t = fx.transactions(spark, d)
    return t.select("row_id", sc.round_half_even(F.col("amount") / 50, 0).alias("r0"),
                    sc.round_half_even(F.col("available") / 10, 1).alias("r1"))


@register("fn_str_split", sql=with_views("""
SELECT row_id, split_part(s, ' ', 1) AS day, split_part(s, '-', 2) AS month,
       split_part(split_part(s, ' ', 2), ':', 1) AS hour, split_part(s, ':', 2) AS minute
FROM (SELECT row_id, CAST(ts AS VARCHAR) AS s FROM transactions)""", ["transactions"]))
def q_str_split(spark, d):
    t = fx.transactions(spark, d).select("row_id", F.col("ts").cast("string").alias("s"))
    sp = lambda c, sep, i: F.split_part(c, F.lit(sep), F.lit(i))
    return t.select("row_id", sp(F.col("s"), " ", 1).alias("day"), sp(F.col("s"), "-", 2).alias("month"),
                    sp(sp(F.col("s"), " ", 2), ":", 1).alias("hour"), sp(F.col("s"), ":", 2).alias("minute"))


@register("fn_hms_seconds", sql=with_views("""
SELECT row_id, minute(ts) * 60 + second(ts) AS sec_in_hour, strftime(ts, '%Y-%m-%d %H') AS hour_key
FROM transactions""", ["transactions"]))
def q_hms(spark, d):
    t = fx.transactions(spark, d)
    return t.select("row_id", sc.seconds_in_hour(F.col("ts")).alias("sec_in_hour"),
                    sc.hour_key(F.col("ts")).alias("hour_key"))


@register("fn_slug", sql=with_views("""
SELECT doc_id, CASE WHEN length(s) > 240 THEN substr(s, 1, 240) || '...' ELSE s END AS slug
FROM (SELECT doc_id, replace(replace(replace(text, ' ', '_'), '/', '_'), ',', '') AS s FROM documents)"""))
def q_slug(spark, d):
    return load(spark, d, "documents").select("doc_id", sc.slug(F.col("text")).alias("slug"))


@register("fn_cast_int", sql=with_views("SELECT row_id, CAST(is_fraud AS INTEGER) AS is_fraud FROM transactions",
                                        ["transactions"]))
def q_cast_int(spark, d):
    return fx.transactions(spark, d).select("row_id", F.col("is_fraud").cast("int").alias("is_fraud"))


@register("fn_cmp_flag", sql=with_views("""
SELECT c_custkey, CAST(coalesce(c_nationkey % 10 = CAST(floor(c_acctbal) AS BIGINT) % 10, false) AS INTEGER) AS match
FROM clean""", ["nan_nulls"], [CLEAN_NAN]))
def q_cmp_flag(spark, d):
    c = clean.nan_to_null(fx.nan_nulls(spark, d))
    return c.select("c_custkey", sc.null_safe_equal_flag(F.col("c_nationkey") % 10,
                                                         F.floor("c_acctbal") % 10).alias("match"))


@register("fn_binarize", sql=with_views("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, label, l_shipdate,
       CAST(l_quantity >= 10 AS INTEGER) AS q_ge_10, CAST(l_discount > 1e-6 AS INTEGER) AS d_gt_eps,
       CAST(l_tax < 0.01 AS INTEGER) AS t_lt_001, CAST(p_size >= 50 AS INTEGER) AS s_ge_50,
       CAST(p_retailprice >= 100 AS INTEGER) AS p_ge_100, CAST(l_discount >= 0.03 AS INTEGER) AS d_ge_003
FROM reg_table""", ["reg_table"]))
def q_binarize(spark, d):
    r = fx.reg_table(spark, d)
    return r.select(*fx.REG_ORDER,
                    sc.binarize(F.col("l_quantity"), 10).alias("q_ge_10"),
                    sc.binarize(F.col("l_discount"), 1e-6, strict=True).alias("d_gt_eps"),
                    (F.col("l_tax") < 0.01).cast("int").alias("t_lt_001"),
                    sc.binarize(F.col("p_size"), 50).alias("s_ge_50"),
                    sc.binarize(F.col("p_retailprice"), 100).alias("p_ge_100"),
                    sc.binarize(F.col("l_discount"), 0.03).alias("d_ge_003"))


def _map_sql(col, mapping):
    return "CASE " + " ".join(f"WHEN {col} = '{k}' THEN {v}" for k, v in mapping.items()) + " END"


@register("fn_label_map", sql=with_views(f"""
SELECT id, category, {_map_sql('category', sc.CRYSTAL_FAMILY)} AS family_id,
       {_map_sql('category', sc.CRYSTAL_SYSTEM)} AS system_id, {_map_sql('category', sc.TOPOLOGY)} AS topo_id
FROM points""", ["points"]))
def q_label_map(spark, d):
    p = fx.points(spark, d)
    c = F.col("category")
    return p.select("id", "category", sc.label_map(c, sc.CRYSTAL_FAMILY, strict=False).alias("family_id"),
                    sc.label_map(c, sc.CRYSTAL_SYSTEM, strict=False).alias("system_id"),
                    sc.label_map(c, sc.TOPOLOGY, strict=False).alias("topo_id"))


@register("fn_parse_list_pick", sql="""
SELECT p_partkey, CAST(s AS DOUBLE[])[2] AS shear, CAST(CAST(s AS DOUBLE[])[2] >= 50 AS INTEGER) AS shear_flag
FROM (SELECT p_partkey, '[' || CAST(p_partkey % 97 AS VARCHAR) || ', ' || CAST(p_size AS VARCHAR) || ', '
                            || CAST(p_partkey % 7 AS VARCHAR) || ']' AS s FROM part)""")
def q_parse_list(spark, d):
    p = load(spark, d, "part")
    s = F.concat(F.lit("["), (F.col("p_partkey") % 97).cast("string"), F.lit(", "), F.col("p_size").cast("string"),
                 F.lit(", "), (F.col("p_partkey") % 7).cast("string"), F.lit("]"))
    v = sc.parse_list_pick(s, 1)
    return p.select("p_partkey", v.alias("shear"), sc.binarize(v, 50).alias("shear_flag"))


@register("fn_softmax_argmax", sql="""
SELECT vec_id, list_position(pr, list_max(pr)) - 1 AS pred, list_max(pr) AS score
FROM (SELECT vec_id, list_transform(embedding, lambda x: exp(CAST(x AS DOUBLE))) AS pr FROM embeddings)""")
def q_softmax(spark, d):
    e = load(spark, d, "embeddings")
    lp = F.transform("embedding", lambda x: x.cast("double"))
    pred, score = sc.softmax_argmax(lp)
    return e.select("vec_id", pred.alias("pred"), score.alias("score"))


# ---------------------------------------------------------------- 2.9 arrays

NPOINT = 20
ROT = ar.rotation_matrix(math.pi * 0.1, math.pi * 0.2, math.pi * 0.3)


@register("arr_pad", sql=with_views(f"""
SELECT id, list_concat(points, list_transform(range(0, {NPOINT} - len(points)), lambda i: [0.0, 0.0, 0.0, 0.0])) AS points
FROM points""", ["points"]))
def q_pad(spark, d):
    return fx.points(spark, d).select("id", ar.pad(F.col("points"), NPOINT).alias("points"))


def _rot_sql():
    rows = []
    for i in range(3):
        terms = " + ".join(f"p[{k + 1}] * {ROT[i][k]!r}" for k in range(3))
        rows.append(f"0.0 + {terms}")
    return f"list_transform(points, lambda p: [{rows[0]}, {rows[1]}, {rows[2]}, p[4]])"


@register("arr_rotate", sql=with_views(f"SELECT id, {_rot_sql()} AS points FROM points", ["points"]))
def q_rotate(spark, d):
    return fx.points(spark, d).select("id", ar.rotate(F.col("points"), ROT).alias("points"))


@register("arr_scale_intensity", sql=with_views("""
SELECT id, list_transform(points, lambda p: [p[1], p[2], p[3], p[4] * ((id * 7919 % 1000) / 1000.0)]) AS points
FROM points""", ["points"]))
def q_scale_intensity(spark, d):
    """The factor follows from the id, so that it is the same in every run."""
    factor = (F.col("id") * 7919 % 1000) / F.lit(1000.0)
    return fx.points(spark, d).select("id", ar.scale_intensity(F.col("points"), factor).alias("points"))


@register("arr_binarize_intensity", sql=with_views("""
SELECT id, list_concat(list_transform(list_filter(points, lambda p: p[4] <= 1e-8), lambda p: [p[1], p[2], p[3], 0.0]),
                       list_transform(list_filter(points, lambda p: p[4] > 1e-8), lambda p: [p[1], p[2], p[3], 1.0])) AS points
FROM points""", ["points"]))
def q_binarize_intensity(spark, d):
    return fx.points(spark, d).select("id", ar.binarize_intensity(F.col("points")).alias("points"))


@register("arr_shuffle_tail")
def q_shuffle_tail(spark, d):
    return fx.points(spark, d).select("id", ar.shuffle_tail(F.col("points")).alias("points"))


@register("arr_drop_dim", sql=with_views(
    "SELECT id, list_transform(points, lambda p: p[1:3]) AS points FROM points", ["points"]))
def q_drop_dim(spark, d):
    return fx.points(spark, d).select("id", ar.drop_dim(F.col("points")).alias("points"))


@register("arr_transpose", sql=with_views(
    "SELECT id, list_transform(range(1, 5), lambda j: list_transform(points, lambda p: p[j])) AS points FROM points",
    ["points"]))
def q_transpose_arr(spark, d):
    return fx.points(spark, d).select("id", ar.transpose(F.col("points")).alias("points"))
