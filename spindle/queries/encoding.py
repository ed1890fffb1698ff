"""Encoding queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from spindle.operators import encode, split
from spindle.operators.assemble import SlotTable
from spindle.sources import load_table
from spindle.queries.splitting import md5_bucket_sql

CHI2_FEATURES = ["l_linestatus_code", "l_linenumber", "l_discount", "l_tax"]


def q_string_index(spark, sf_dir):
    part = load_table(spark, sf_dir, "part", ["p_brand", "p_type"])
    return encode.fit_string_indexes(part, ["p_brand", "p_type"])


def q_label_index(spark, sf_dir):
    cust = load_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    train, _ = split.split_frames(cust, ["c_custkey"], 80)
    model = encode.IndexModel.fit(train, ["c_mktsegment"])            # fitted on train only
    out = model.transform(cust, ["c_mktsegment"], suffix="_label")
    return out.select("c_custkey", F.col("c_mktsegment_label").alias("label"))


def q_one_hot(spark, sf_dir):
    cust = load_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    model = encode.IndexModel.fit(cust, ["c_mktsegment"])
    idx = model.transform(cust, ["c_mktsegment"])
    k = model.size("c_mktsegment")
    out = encode.one_hot_columns(idx, "c_mktsegment_index", k, "seg", drop_last=True)
    return out.drop("c_mktsegment")


def q_standard_scale(spark, sf_dir):
    cust = load_table(spark, sf_dir, "customer", ["c_custkey", "c_acctbal"])
    out = encode.standard_scale(cust, ["c_acctbal"])
    return out.select("c_custkey", F.round("c_acctbal_scaled", 6).alias("acctbal_scaled"))


def _chi2_frame(spark, sf_dir):
    li = load_table(spark, sf_dir, "lineitem", ["l_linestatus", "l_linenumber", "l_discount", "l_tax",
                                                 "l_returnflag"])
    return li.select((F.col("l_returnflag") == "R").cast("int").alias("label"),
                     (F.col("l_linestatus") == "F").cast("int").alias("l_linestatus_code"),
                     "l_linenumber", "l_discount", "l_tax")


def q_chi2_select(spark, sf_dir):
    stats = encode.chi2_statistics(_chi2_frame(spark, sf_dir), "label", CHI2_FEATURES)
    return stats.select("feature", F.round("statistic", 6).alias("statistic"), "dof")


WIDE_FEATURES = [*CHI2_FEATURES, "l_orderkey"]         # the last one has far more than 10 000 values


def q_chi2_selected(spark, sf_dir):
    """Selection at a false-positive rate of 0.05."""
    li = load_table(spark, sf_dir, "lineitem", ["l_linestatus", "l_linenumber", "l_discount", "l_tax", "l_returnflag", "l_orderkey"])
    df = li.select((F.col("l_returnflag") == "R").cast("int").alias("label"),
                   (F.col("l_linestatus") == "F").cast("int").alias("l_linestatus_code"),
                   "l_linenumber", "l_discount", "l_tax", "l_orderkey")
    out = encode.chi2_selected(df, "label", WIDE_FEATURES, fpr=0.05)
    return out.select("feature", "dof", F.abs(F.round("p_value", 4)).alias("p_value"), "selected")


ENCODED = (["o_orderpriority", "o_orderstatus"], ["o_totalprice", "year"])


def q_encoded_rows(spark, sf_dir):
    """Index, one-hot and assembly fitted on 80 % of the orders and applied to
    all: a status of test rows only gets no slot, a NULL number drops its row."""
    orders = load_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])
    train = split.hash_bucket(["o_orderkey"]) < 80
    rows = orders.select(
        "o_orderkey", "o_orderpriority", train.alias("train"),
        F.when(~train & (F.col("o_orderkey") % 3 == 0), "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(F.col("o_orderkey") % 40 != 0, F.col("o_totalprice")).alias("o_totalprice"),
        F.year("o_orderdate").cast("double").alias("year"))
    model = SlotTable.fit(rows.filter("train"), *ENCODED)
    out = model.transform(rows, "o_orderkey", null_number="skip")
    return out.select("o_orderkey", "size", F.array_join("indices", ",").alias("indices"),
                      F.round(F.aggregate("values", F.lit(0.0), lambda a, x: a + x), 4).alias("values_sum"))


_CHI2_SQL = """
WITH li AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
                   CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS l_linestatus_code,
                   l_linenumber, l_discount, l_tax FROM lineitem),
pairs AS (
  SELECT 'l_linestatus_code' AS feature, CAST(l_linestatus_code AS DOUBLE) AS value, label FROM li UNION ALL
  SELECT 'l_linenumber', CAST(l_linenumber AS DOUBLE), label FROM li UNION ALL
  SELECT 'l_discount', l_discount, label FROM li UNION ALL
  SELECT 'l_tax', l_tax, label FROM li),
cells AS (SELECT feature, value, label, count(*) AS o FROM pairs GROUP BY ALL),
m AS (SELECT *, sum(o) OVER (PARTITION BY feature) AS n, sum(o) OVER (PARTITION BY feature, value) AS nv,
             sum(o) OVER (PARTITION BY feature, label) AS ny FROM cells)
SELECT feature, round(sum(o * o / (nv * ny / n)) - max(n), 6) AS statistic,
       CAST((count(DISTINCT value) - 1) * (count(DISTINCT label) - 1) AS BIGINT) AS dof
FROM m GROUP BY feature"""

QUERIES = {
    "string_index": (q_string_index, """
WITH pairs AS (SELECT 'p_brand' AS column_name, p_brand AS value FROM part
               UNION ALL SELECT 'p_type', p_type FROM part),
c AS (SELECT column_name, value, count(*) AS n_rows FROM pairs GROUP BY ALL)
SELECT column_name, value, n_rows,
       CAST(row_number() OVER (PARTITION BY column_name ORDER BY n_rows DESC, value ASC) - 1 AS DOUBLE) AS label_index
FROM c"""),
    "label_index": (q_label_index, f"""
WITH tr AS (SELECT c_mktsegment AS value, count(*) AS n FROM customer
            WHERE {md5_bucket_sql('c_custkey')} < 80 GROUP BY 1),
ix AS (SELECT value, CAST(row_number() OVER (ORDER BY n DESC, value ASC) - 1 AS DOUBLE) AS label_index FROM tr)
SELECT c.c_custkey, coalesce(ix.label_index, (SELECT CAST(count(*) AS DOUBLE) FROM ix)) AS label
FROM customer c LEFT JOIN ix ON c.c_mktsegment = ix.value"""),
    "one_hot": (q_one_hot, """
WITH ix AS (SELECT value, row_number() OVER (ORDER BY n DESC, value ASC) - 1 AS i
            FROM (SELECT c_mktsegment AS value, count(*) AS n FROM customer GROUP BY 1)),
j AS (SELECT c.c_custkey, CAST(ix.i AS DOUBLE) AS c_mktsegment_index FROM customer c JOIN ix ON c.c_mktsegment = ix.value)
SELECT c_custkey, c_mktsegment_index,
  CAST(CASE WHEN c_mktsegment_index = 0 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS seg_0,
  CAST(CASE WHEN c_mktsegment_index = 1 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS seg_1,
  CAST(CASE WHEN c_mktsegment_index = 2 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS seg_2,
  CAST(CASE WHEN c_mktsegment_index = 3 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS seg_3
FROM j"""),
    "standard_scale": (q_standard_scale, """
SELECT c_custkey, round(c_acctbal / (SELECT stddev_samp(c_acctbal) FROM customer), 6) AS acctbal_scaled
FROM customer"""),
    "chi2_select": (q_chi2_select, _CHI2_SQL),
    "chi2_selected": (q_chi2_selected, _CHI2_SQL.replace("l_tax FROM lineitem)", "l_tax, l_orderkey FROM lineitem)")
                      .replace("SELECT 'l_tax', l_tax, label FROM li)",
                               "SELECT 'l_tax', l_tax, label FROM li UNION ALL\n  SELECT 'l_orderkey', CAST(l_orderkey AS DOUBLE), label FROM li)")
                      .replace("SELECT feature, round(", "SELECT feature, dof, round(p, 4) AS p_value, p < 0.05 AS selected FROM ("
                               "SELECT feature, dof, greatest(1 - list_sum(list_transform(range(0, CAST(ceil(greatest((x - dof) / 2, 0) "
                               "+ 20 * sqrt(x / 2) + 200) AS BIGINT)), lambda i: exp(-x / 2 + (dof / 2 + i) * ln(x / 2) "
                               "- lgamma(dof / 2 + i + 1)))), 0) AS p FROM (SELECT feature, greatest(")
                      .replace("- max(n), 6) AS statistic,", "- max(n), 1e-12) AS x,") + "))"),
    "encoded_rows": (q_encoded_rows, f"""
WITH o AS (SELECT o_orderkey, o_orderpriority, {md5_bucket_sql('o_orderkey')} < 80 AS train, o_totalprice, year(o_orderdate) AS year, o_orderstatus FROM orders),
r AS (SELECT o_orderkey, o_orderpriority, train, CASE WHEN NOT train AND o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 40 <> 0 THEN o_totalprice END AS o_totalprice, CAST(year AS DOUBLE) AS year FROM o),
p AS (SELECT o_orderpriority AS v, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS i FROM r WHERE train GROUP BY 1),
s AS (SELECT o_orderstatus AS v, (SELECT count(*) FROM p) + row_number() OVER (ORDER BY count(*) DESC, o_orderstatus) - 1 AS i FROM r WHERE train GROUP BY 1),
n AS (SELECT (SELECT count(*) FROM p) + (SELECT count(*) FROM s) AS n)
SELECT o_orderkey, CAST(n + 2 AS INTEGER) AS size, concat_ws(',', p.i, s.i, CASE WHEN o_totalprice <> 0 THEN n END, n + 1) AS indices,
  round((CASE WHEN p.i IS NULL THEN 0 ELSE 1 END) + (CASE WHEN s.i IS NULL THEN 0 ELSE 1 END) + o_totalprice + year, 4) AS values_sum
FROM r CROSS JOIN n LEFT JOIN p ON p.v = o_orderpriority LEFT JOIN s ON s.v = o_orderstatus WHERE o_totalprice IS NOT NULL"""),
}
