"""Cleaning queries: projection, filters, sentinels, fills, modes.

The driver tables hold no missing values, so each query first places markers
with a deterministic key rule (every row is kept and processed; the rule only
decides where a marker goes).  The oracle SQL applies the same rule.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from spindle.operators import clean, split
from spindle.operators.common import broadcast_if_small
from spindle.queries.splitting import md5_bucket_sql
from spindle.sources import load_table


def q_scan_project_alias(spark, sf_dir):
    cust = load_table(spark, sf_dir, "customer")
    keep = [c for c in cust.columns if c not in ("c_name",)]          # schema-driven (P3)
    return cust.select(*keep, F.round(F.col("c_acctbal") / 1000.0, 6).alias("acctbal_k"))


def q_group_filter_dropna(spark, sf_dir):
    ev = load_table(spark, sf_dir, "events", ["event_id", "event_type", "value"])
    ev = clean.inject_marker(ev, "value", None, F.col("event_id") % 7 == 0)
    picked = ev.filter(F.col("event_type").isin("click", "purchase"))   # P6
    return clean.drop_incomplete(picked)                                # P9


def _customer_with_na(spark, sf_dir):
    cust = load_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_acctbal"])
    cust = clean.inject_marker(cust, "c_acctbal", "NA", F.col("c_custkey") % 10 == 0)
    return clean.inject_marker(cust, "c_nationkey", "NA", F.col("c_custkey") % 13 == 0)


def q_sentinel_filter_cast(spark, sf_dir):
    cust = clean.drop_marked(_customer_with_na(spark, sf_dir), ["c_acctbal", "c_nationkey"], "NA")
    cust = clean.cast_columns(cust, ["c_acctbal"], "double")
    return clean.cast_columns(cust, ["c_nationkey"], "int")


def q_labels_complete(spark, sf_dir):
    labels = load_table(spark, sf_dir, "labels")
    labels = clean.inject_marker(labels, "quality", None, F.col("doc_id") % 9 == 0)
    docs = load_table(spark, sf_dir, "documents", ["doc_id", "lang", "n_chars"])  # text pruned
    joined = labels.join(docs, "doc_id", "inner")
    return clean.drop_incomplete(joined, ["quality", "toxic"])


def q_fill_constant(spark, sf_dir):
    orders = load_table(spark, sf_dir, "orders")
    orders = clean.inject_marker(orders, "o_orderpriority", None, F.col("o_orderkey") % 11 == 0)
    filled = clean.fill_constant(orders, {"o_orderpriority": "UNKNOWN"})
    filled = filled.withColumn("is_urgent", (F.col("o_orderpriority") == "1-URGENT").cast("int"))
    return filled.drop("o_totalprice", "o_orderdate", "o_custkey")


def _customer_with_unknown(spark, sf_dir):
    cust = load_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment", "c_nationkey"])
    cust = clean.inject_marker(cust, "c_mktsegment", "?", F.col("c_custkey") % 20 == 0)
    return clean.inject_marker(cust, "c_nationkey", "?", F.col("c_custkey") % 17 == 0)


def q_mode_impute(spark, sf_dir):
    cust = _customer_with_unknown(spark, sf_dir)
    train, _ = split.split_frames(cust, ["c_custkey"], 80)
    modes = clean.modes_dict(clean.column_modes(train, ["c_mktsegment", "c_nationkey"], exclude="?"))
    return clean.impute_marker(cust, modes, "?")


def q_freq_items(spark, sf_dir):
    orders = load_table(spark, sf_dir, "orders", ["o_orderstatus", "o_orderpriority"])
    return clean.frequent_items(orders, ["o_orderstatus", "o_orderpriority"], support=0.2)


def q_category_collapse(spark, sf_dir):
    cust = load_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
    nation = load_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    joined = cust.join(broadcast_if_small(nation), cust.c_nationkey == nation.n_nationkey, "inner")
    # the raw label text carries a trailing dot on some rows, as in a test file
    raw = F.concat(F.col("c_mktsegment"),
                   F.when(F.col("c_custkey") % 2 == 1, F.lit(".")).otherwise(F.lit("")))
    return joined.select("c_custkey",
                         clean.collapse_category("n_name", "NATION_0", "Other").alias("country"),
                         clean.binary_label(raw, "BUILDING").alias("label"))


_MODE_SQL = f"""
WITH c AS (
  SELECT c_custkey,
         CASE WHEN c_custkey % 20 = 0 THEN '?' ELSE c_mktsegment END AS c_mktsegment,
         CASE WHEN c_custkey % 17 = 0 THEN '?' ELSE CAST(c_nationkey AS VARCHAR) END AS c_nationkey
  FROM customer),
train AS (SELECT * FROM c WHERE {md5_bucket_sql('c_custkey')} < 80),
seg AS (SELECT c_mktsegment AS v FROM train WHERE c_mktsegment <> '?'
        GROUP BY 1 ORDER BY count(*) DESC, v DESC LIMIT 1),
nat AS (SELECT c_nationkey AS v FROM train WHERE c_nationkey <> '?'
        GROUP BY 1 ORDER BY count(*) DESC, v DESC LIMIT 1)
SELECT c_custkey,
       CASE WHEN c_mktsegment = '?' THEN (SELECT v FROM seg) ELSE c_mktsegment END AS c_mktsegment,
       CASE WHEN c_nationkey = '?' THEN (SELECT v FROM nat) ELSE c_nationkey END AS c_nationkey
FROM c
"""

QUERIES = {
    "scan_project_alias": (q_scan_project_alias, """
SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment, round(c_acctbal / 1000.0, 6) AS acctbal_k
FROM customer"""),
    "group_filter_dropna": (q_group_filter_dropna, """
WITH marked AS (
  SELECT event_id, event_type, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value FROM events)
SELECT event_id, event_type, value FROM marked
WHERE event_type IN ('click', 'purchase') AND event_id IS NOT NULL AND event_type IS NOT NULL
  AND value IS NOT NULL"""),
    "sentinel_filter_cast": (q_sentinel_filter_cast, """
WITH marked AS (
  SELECT c_custkey,
         CASE WHEN c_custkey % 10 = 0 THEN 'NA' ELSE CAST(c_acctbal AS VARCHAR) END AS c_acctbal,
         CASE WHEN c_custkey % 13 = 0 THEN 'NA' ELSE CAST(c_nationkey AS VARCHAR) END AS c_nationkey
  FROM customer)
SELECT c_custkey, TRY_CAST(c_nationkey AS INTEGER) AS c_nationkey, TRY_CAST(c_acctbal AS DOUBLE) AS c_acctbal
FROM marked WHERE coalesce(c_acctbal <> 'NA', false) AND coalesce(c_nationkey <> 'NA', false)"""),
    "labels_complete": (q_labels_complete, """
WITH marked AS (SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN NULL ELSE quality END AS quality, toxic FROM labels)
SELECT l.doc_id, l.quality, l.toxic, d.lang, d.n_chars
FROM marked l JOIN documents d ON l.doc_id = d.doc_id
WHERE l.quality IS NOT NULL AND l.toxic IS NOT NULL"""),
    "fill_constant": (q_fill_constant, """
SELECT o_orderkey, o_orderstatus,
       CASE WHEN o_orderkey % 11 = 0 THEN 'UNKNOWN' ELSE o_orderpriority END AS o_orderpriority,
       CASE WHEN o_orderkey % 11 <> 0 AND o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS is_urgent
FROM orders"""),
    "mode_impute": (q_mode_impute, _MODE_SQL),
    "freq_items": (q_freq_items, """
SELECT column_name, item, count(*) AS n_rows FROM (
  SELECT 'o_orderstatus' AS column_name, o_orderstatus AS item FROM orders UNION ALL
  SELECT 'o_orderpriority', o_orderpriority FROM orders)
GROUP BY ALL HAVING count(*) > 0.2 * (SELECT count(*) FROM orders)"""),
    "category_collapse": (q_category_collapse, """
SELECT c.c_custkey,
       CASE WHEN n.n_name <> 'NATION_0' THEN 'Other' ELSE n.n_name END AS country,
       CASE WHEN c.c_mktsegment = 'BUILDING' THEN 0 ELSE 1 END AS label
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey"""),
}
