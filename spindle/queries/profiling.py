"""Profiling queries: schema, shape, counts, describe, class balance
(S7, S8, A1–A4, A6, P11, P18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from spindle.operators import clean, profile
from spindle.sources import load_table

DESCRIBE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _customer_cast(spark, sf_dir):
    cust = load_table(spark, sf_dir, "customer")
    cust = clean.inject_marker(cust, "c_acctbal", "NA", F.col("c_custkey") % 10 == 0)
    return cust


def q_schema_report(spark, sf_dir):
    cust = clean.cast_columns(_customer_cast(spark, sf_dir), ["c_acctbal"], "double")
    return profile.schema_report(cust)


def q_shape_report(spark, sf_dir):
    raw = _customer_cast(spark, sf_dir)
    cleaned = clean.cast_columns(clean.drop_marked(raw, ["c_acctbal"], "NA"), ["c_acctbal"], "double")
    return profile.shape_report({"raw": raw, "clean": cleaned})


def q_expr_predicate_count(spark, sf_dir):
    return profile.row_count(load_table(spark, sf_dir, "labels"), "toxic == 1")


def q_class_distribution(spark, sf_dir):
    return profile.class_distribution(load_table(spark, sf_dir, "labels"), "toxic", "quality")


def q_describe_numeric(spark, sf_dir):
    return profile.describe_numeric(load_table(spark, sf_dir, "lineitem"), DESCRIBE_COLS, digits=4)


def q_class_balance(spark, sf_dir):
    return profile.class_balance(load_table(spark, sf_dir, "labels"), "toxic")


def q_class_weights(spark, sf_dir):
    labels = load_table(spark, sf_dir, "labels", ["doc_id", "toxic"])
    ratio = profile.class_balance(labels, "toxic").first()["balancing_ratio"]
    out = profile.with_class_weights(labels, "toxic", ratio)
    return out.withColumn("class_weight", F.round("class_weight", 6))


_CUST_NA = """(SELECT c_custkey, c_name, c_nationkey,
        CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal, c_mktsegment
 FROM customer)"""

_DESCRIBE_SQL = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 4) AS mean, "
    f"round(stddev_samp({c}), 4) AS stddev, min({c}) AS min_value, max({c}) AS max_value FROM lineitem"
    for c in DESCRIBE_COLS)

QUERIES = {
    "schema_report": (q_schema_report, "\nUNION ALL\n".join(
        f"SELECT {i + 1} AS position, '{c}' AS column_name, '{t}' AS data_type, count({c}) AS non_null "
        f"FROM {_CUST_NA} c"
        for i, (c, t) in enumerate([("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"),
                                    ("c_acctbal", "double"), ("c_mktsegment", "string")]))),
    "shape_report": (q_shape_report, """
SELECT 'raw' AS stage, count(*) AS n_rows, 5 AS n_cols FROM customer
UNION ALL
SELECT 'clean' AS stage, count(*) AS n_rows, 5 AS n_cols FROM
  (SELECT CASE WHEN c_custkey % 10 = 0 THEN 'NA' ELSE CAST(c_acctbal AS VARCHAR) END AS c_acctbal FROM customer)
WHERE coalesce(c_acctbal <> 'NA', false)"""),
    "expr_predicate_count": (q_expr_predicate_count,
                             "SELECT count(*) AS n_rows FROM labels WHERE toxic = 1"),
    "class_distribution": (q_class_distribution, """
SELECT toxic, count(*) AS n_rows, CAST(sum(quality) AS BIGINT) AS sum_quality FROM labels GROUP BY toxic"""),
    "describe_numeric": (q_describe_numeric, _DESCRIBE_SQL),
    "class_balance": (q_class_balance, """
SELECT count(*) AS total, count(*) FILTER (WHERE toxic = 1) AS positives,
       count(*) - count(*) FILTER (WHERE toxic = 1) AS negatives,
       count(*) FILTER (WHERE toxic = 1) * 100.0 / count(*) AS pct_positive,
       CAST(count(*) - count(*) FILTER (WHERE toxic = 1) AS DOUBLE) / count(*) AS balancing_ratio
FROM labels"""),
    "class_weights": (q_class_weights, """
WITH b AS (SELECT CAST(count(*) - count(*) FILTER (WHERE toxic = 1) AS DOUBLE) / count(*) AS r FROM labels)
SELECT doc_id, toxic, round(CASE WHEN toxic = 1 THEN r ELSE 1.0 - r END, 6) AS class_weight
FROM labels, b"""),
}
