"""Text, HTML and encoding queries."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from kestrel.operators import encode as en, text as tx
from kestrel.plans.registry import register
from kestrel.sources import fixtures as fx
from kestrel.sources.fixtures_sql import with_views


@register("agg_wordcount", sql=with_views("""
SELECT word, count(*) AS count FROM (SELECT unnest(string_split(value, ' ')) AS word FROM docs_lines) GROUP BY word""",
                                          ["docs_lines"]))
def q_wordcount(spark, d):
    return tx.word_count(fx.docs_lines(spark, d))


@register("enc_tokenize", sql=with_views("""
SELECT id, string_split_regex(lower(text), '\\s') AS words FROM docs_labeled""", ["docs_labeled"]))
def q_tokenize(spark, d):
    t = en.tokenize(fx.docs_labeled(spark, d), "text")
    return t.select("id", "words")


@register("enc_hashtf")
def q_hashtf(spark, d):
    t = en.hashed_tf(en.tokenize(fx.docs_labeled(spark, d), "text"), "words", num_features=1000)
    return t.select("id", vector_to_array("tf").alias("tf"))


ROWS_VIEW = """
SELECT p_partkey AS page_id, unnest([
  {'row': 0, 'name': 'Brand', 'Metric': p_brand, 'English': p_type, 'Comments': p_name},
  {'row': 1, 'name': 'Size', 'Metric': CAST(p_size AS VARCHAR), 'English': CAST(p_size * 2 AS VARCHAR), 'Comments': ''}],
  recursive := true) FROM part"""


@register("html_rows", sql=ROWS_VIEW)
def q_html_rows(spark, d):
    """Attribute tables: rows of the two row classes are markup made from `part`, with
    other rows between them, and come back as (name, Metric, English, Comments)."""
    from kestrel.sources.tables import load

    def tr(cls, *cells):
        return F.concat(F.lit(f'<tr class="{cls}">'), *[x for c in cells for x in (F.lit("<td>"), c, F.lit("</td>"))],
                        F.lit("</tr>"))
    size = F.col("p_size")
    page = F.concat(F.lit("<table>"), tr("header", F.lit("Property"), F.lit("Metric")),
                    tr(tx.ROW_CLASSES[0], F.lit("Brand"), F.col("p_brand"), F.col("p_type"), F.col("p_name")),
                    tr(tx.ROW_CLASSES[1], F.lit("Size"), size.cast("string"), (size * 2).cast("string"), F.lit("")),
                    F.lit("</table>"))
    return tx.html_rows(load(spark, d, "part").select(F.col("p_partkey").alias("page_id"), page.alias("html")))


@register("html_list", sql=with_views("SELECT page_id, list(name ORDER BY pos) AS names FROM page_items GROUP BY page_id",
                                      ["page_items"]))
def q_html_list(spark, d):
    return tx.html_list(fx.page_items(spark, d))


@register("enc_index", sql=with_views("""
SELECT l_returnflag, CAST(row_number() OVER (ORDER BY cnt DESC, l_returnflag) - 1 AS DOUBLE) AS idx, cnt AS count
FROM (SELECT l_returnflag, count(*) AS cnt FROM reg_table GROUP BY 1)""", ["reg_table"]))
def q_index(spark, d):
    r = en.string_index(fx.reg_table(spark, d), "l_returnflag", "idx")
    return r.groupBy("l_returnflag", "idx").agg(F.count(F.lit(1)).alias("count"))


@register("enc_onehot", sql=with_views("""
SELECT l_orderkey, l_linenumber, [CAST(k = 0 AS INTEGER) * 1.0, CAST(k = 1 AS INTEGER) * 1.0] AS flag_vec
FROM reg_table JOIN (SELECT l_returnflag, row_number() OVER (ORDER BY count(*) DESC, l_returnflag) - 1 AS k
                     FROM reg_table GROUP BY 1) USING (l_returnflag)""", ["reg_table"]))
def q_onehot(spark, d):
    r = en.one_hot(fx.reg_table(spark, d), "l_returnflag", "flag_vec")
    return r.select("l_orderkey", "l_linenumber", vector_to_array("flag_vec").alias("flag_vec"))


@register("enc_dummies", sql=with_views("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, label, l_shipdate,
       CAST(l_returnflag = 'A' AS INTEGER) AS flag_A, CAST(l_returnflag = 'N' AS INTEGER) AS flag_N,
       CAST(l_returnflag = 'R' AS INTEGER) AS flag_R FROM reg_table""", ["reg_table"]))
def q_dummies(spark, d):
    r = en.dummies(fx.reg_table(spark, d), "l_returnflag", "flag")
    return r.select(*fx.REG_ORDER, "flag_A", "flag_N", "flag_R")


SEG_NA = ("seg", "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS seg FROM customer")


@register("enc_dummies_na", sql=with_views("""
SELECT c_custkey, """ + ", ".join(f"CAST(coalesce(seg = '{s}', false) AS INTEGER) AS seg_{s}" for s in
                                  ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"])
                                           + ", CAST(seg IS NULL AS INTEGER) AS seg_nan FROM seg", [], [SEG_NA]))
def q_dummies_na(spark, d):
    from kestrel.sources.tables import load
    c = load(spark, d, "customer").select("c_custkey", F.when(F.col("c_acctbal") < 0, F.lit(None))
                                          .otherwise(F.col("c_mktsegment")).alias("seg"))
    out = en.dummies(c, "seg", "seg", with_na=True)
    return out.drop("seg")


@register("enc_assemble", sql=with_views(
    "SELECT " + ", ".join(fx.REG_ORDER) + ", [" + ", ".join(f"CAST({c} AS DOUBLE)" for c in fx.REG_FEATURES)
    + "] AS features FROM reg_table", ["reg_table"]))
def q_assemble(spark, d):
    r = en.assemble(fx.reg_table(spark, d), fx.REG_FEATURES)
    return r.select(*fx.REG_ORDER, vector_to_array("features").alias("features"))


@register("enc_scale", sql=with_views("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, "
                                      + ", ".join(f"({c} - avg({c}) OVER ()) / NULLIF(stddev_pop({c}) OVER (), 0) AS {c}"
                                                  for c in fx.REG_FEATURES + ["label"]) + " FROM reg_table",
                                      ["reg_table"]))
def q_scale(spark, d):
    cols = fx.REG_FEATURES + ["label"]
    r = fx.reg_table(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", *cols)
    return en.zscore(r, cols)
