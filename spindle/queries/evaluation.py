"""Evaluation queries on a fixed linear scorer over lineitem (P12, P17,
A7–A11), so the metrics are checked independently of any model fit."""

from __future__ import annotations

from pyspark.sql import functions as F

from spindle.operators import evaluate, split
from spindle.sources import load_table

# Fixed scorer: margin z = -2 + 0.04·quantity + 8·discount − 6·tax; label = return flag 'R'.
INTERCEPT, W_QTY, W_DISC, W_TAX = -2.0, 0.04, 8.0, -6.0


def scored_lineitem(spark, sf_dir):
    li = load_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag"])
    z = (F.lit(INTERCEPT) + F.lit(W_QTY) * F.col("l_quantity") + F.lit(W_DISC) * F.col("l_discount")
         + F.lit(W_TAX) * F.col("l_tax"))
    out = li.select(
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
        z.alias("margin"),
        F.when(z > 0, 1.0).otherwise(0.0).alias("prediction"),
        "l_orderkey", "l_linenumber")
    return split.hash_split(out, ["l_orderkey", "l_linenumber"], 80)


def q_confusion_matrix(spark, sf_dir):
    return evaluate.confusion_counts(scored_lineitem(spark, sf_dir), "label", "prediction", ["split"])


def q_binary_metrics(spark, sf_dir):
    conf = evaluate.confusion_counts(scored_lineitem(spark, sf_dir), "label", "prediction", ["split"])
    return evaluate.derived_metrics(conf)


def q_accuracy_rate(spark, sf_dir):
    return evaluate.accuracy_rate(scored_lineitem(spark, sf_dir), "label", "prediction", ["split"])


def q_auc_roc(spark, sf_dir):
    return evaluate.area_under_roc(scored_lineitem(spark, sf_dir), "label", "margin", ["split"])


def q_auc_pr(spark, sf_dir):
    return evaluate.area_under_pr(scored_lineitem(spark, sf_dir), "label", "margin", ["split"])


SCORED_SQL = f"""
s AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
         {INTERCEPT} + {W_QTY} * l_quantity + {W_DISC} * l_discount + {W_TAX} * l_tax AS margin,
         CASE WHEN CAST(('0x' || substr(md5(concat_ws('|', CAST(l_orderkey AS VARCHAR),
              CAST(l_linenumber AS VARCHAR))), 1, 8)) AS BIGINT) % 100 < 80 THEN 'train' ELSE 'test' END AS split
  FROM lineitem),
p AS (SELECT *, CASE WHEN margin > 0 THEN 1.0 ELSE 0.0 END AS prediction FROM s)"""

CONF_SQL = f"""WITH {SCORED_SQL},
cm AS (SELECT split,
  count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
  count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
  count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
  count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn
  FROM p GROUP BY split)"""

CURVE_SQL = f"""WITH {SCORED_SQL},
c AS (SELECT split, margin, count(*) FILTER (WHERE label = 1) AS pos,
             count(*) FILTER (WHERE label <> 1) AS neg FROM s GROUP BY split, margin),
cum AS (SELECT *, CAST(sum(pos) OVER (PARTITION BY split ORDER BY margin DESC ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS cum_pos,
                  CAST(sum(neg) OVER (PARTITION BY split ORDER BY margin DESC ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS cum_neg,
                  CAST(sum(pos) OVER (PARTITION BY split) AS DOUBLE) AS P,
                  CAST(sum(neg) OVER (PARTITION BY split) AS DOUBLE) AS N FROM c)"""


def _ratio(a, b):
    return f"CASE WHEN ({b}) = 0 THEN NULL ELSE ({a}) / ({b}) END"


_SENS = _ratio("CAST(tp AS DOUBLE)", "tp + fn")
_SPEC = _ratio("CAST(tn AS DOUBLE)", "tn + fp")

QUERIES = {
    "confusion_matrix": (q_confusion_matrix, CONF_SQL + "\nSELECT * FROM cm"),
    "binary_metrics": (q_binary_metrics, CONF_SQL + f"""
SELECT split, tp, tn, fp, fn,
  round({_ratio('CAST(tp + tn AS DOUBLE)', 'tp + tn + fp + fn')}, 6) AS accuracy,
  round(1.0 - {_ratio('CAST(tp + tn AS DOUBLE)', 'tp + tn + fp + fn')}, 6) AS misclassification,
  round({_SENS}, 6) AS sensitivity,
  round({_SPEC}, 6) AS specificity,
  round({_ratio('CAST(tp AS DOUBLE)', 'tp + fp')}, 6) AS ppv,
  round({_ratio('CAST(tn AS DOUBLE)', 'tn + fn')}, 6) AS npv,
  round({_ratio(_SENS, f'1.0 - {_SPEC}')}, 6) AS lr_positive,
  round({_ratio(f'1.0 - {_SENS}', _SPEC)}, 6) AS lr_negative
FROM cm"""),
    "accuracy_rate": (q_accuracy_rate, f"""WITH {SCORED_SQL}
SELECT split, round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) * 100.0, 6) AS accuracy_pct
FROM p GROUP BY split"""),
    "auc_roc": (q_auc_roc, CURVE_SQL + """
SELECT split, round(sum(neg * (cum_pos * 2 - pos) / 2.0) / (max(P) * max(N)), 6) AS auc_roc
FROM cum GROUP BY split"""),
    "auc_pr": (q_auc_pr, CURVE_SQL + """
SELECT split, round(sum(pos * (cum_pos / (cum_pos + cum_neg)
    + CASE WHEN cum_pos - pos + cum_neg - neg = 0 THEN cum_pos / (cum_pos + cum_neg)
           ELSE (cum_pos - pos) / (cum_pos - pos + cum_neg - neg) END) / 2.0) / max(P), 6) AS auc_pr
FROM cum GROUP BY split"""),
}
