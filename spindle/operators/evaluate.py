"""Classifier evaluation.

All metrics are aggregates over the scored rows.  The confusion matrix is a
single conditional aggregation (not one job per cell).  The areas under ROC
and PR use exact step/trapezoid sums over distinct scores with running totals
computed by :func:`spindle.operators.common.prefix_sums`, so no window ever
pulls every score into one partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.operators.common import materialized, prefix_sums


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _d(name: str) -> Column:
    """A count as a double: products of counts overflow a bigint from 3e9 rows on."""
    return F.col(name).cast("double")


def confusion_counts(df: DataFrame, label: str, prediction: str, by: list[str] | None = None) -> DataFrame:
    """TP, TN, FP, FN per group in one pass."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    aggs = [F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 0)).alias("tn"),
            F.count_if((y == 0) & (p == 1)).alias("fp"), F.count_if((y == 1) & (p == 0)).alias("fn")]
    return df.groupBy(*(by or [])).agg(*aggs)


def derived_metrics(conf: DataFrame, digits: int | None = 6) -> DataFrame:
    """accuracy, misclassification, sensitivity, specificity, PPV, NPV and
    likelihood ratios from a confusion table (A8).  An empty margin gives
    NULL instead of a division error."""
    tp, tn, fp, fn = (F.col(c).cast("double") for c in ("tp", "tn", "fp", "fn"))
    total = tp + tn + fp + fn
    sens = F.try_divide(tp, tp + fn)
    spec = F.try_divide(tn, tn + fp)
    cols = {
        "accuracy": F.try_divide(tp + tn, total),
        "misclassification": F.lit(1.0) - F.try_divide(tp + tn, total),
        "sensitivity": sens,
        "specificity": spec,
        "ppv": F.try_divide(tp, tp + fp),
        "npv": F.try_divide(tn, tn + fn),
        "lr_positive": F.try_divide(sens, F.lit(1.0) - spec),
        "lr_negative": F.try_divide(F.lit(1.0) - sens, spec),
    }
    if digits is not None:
        cols = {k: F.round(v, digits) for k, v in cols.items()}
    return conf.withColumns(cols)


def accuracy_rate(df: DataFrame, label: str, prediction: str, by: list[str] | None = None,
                  digits: int | None = 6) -> DataFrame:
    """100 × share of rows whose prediction equals the label."""
    same = F.when(F.col(label).cast("double") == F.col(prediction).cast("double"), 1.0).otherwise(0.0)
    acc = F.avg(same) * 100.0
    return df.groupBy(*(by or [])).agg((F.round(acc, digits) if digits is not None else acc)
                                       .alias("accuracy_pct"))


def _score_counts(df: DataFrame, label: str, score: str, by: list[str]) -> DataFrame:
    y = F.col(label).cast("double")
    return (df.groupBy(*by, F.col(score).cast("double").alias("_s"))
            .agg(F.count_if(y == 1).alias("pos"), F.count_if(y != 1).alias("neg")))


def _curve(df: DataFrame, label: str, score: str, by: list[str]) -> tuple[DataFrame, list[str]]:
    """Distinct thresholds (descending) with inclusive running counts and
    the per-group totals P, N.  Without grouping a constant key stands in,
    so the totals attach by an equi-join on one row."""
    keys = by or ["_all"]
    if not by:
        df = df.withColumn("_all", F.lit(1))
    # distinct scores are read twice below (running sums, totals)
    counts = materialized(_score_counts(df, label, score, keys), "score-counts")
    cum = prefix_sums(counts, "_s", ["pos", "neg"], by=keys, descending=True)
    totals = counts.groupBy(*keys).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return cum.join(totals, keys, "inner"), keys


def area_under_roc(df: DataFrame, label: str, score: str, by: list[str] | None = None,
                   digits: int | None = 6) -> DataFrame:
    """Exact area under the ROC curve, ties as one threshold (A10).  Equals
    MLlib's evaluator with ``numBins=0``."""
    cur, keys = _curve(df, label, score, by or [])
    # trapezoid between the previous point (cum - own) and this one
    term = _d("neg") * (_d("cum_pos") * 2 - _d("pos")) / 2.0
    auc = F.try_divide(F.sum(term), F.first(_d("P")) * F.first(_d("N")))
    out = cur.groupBy(*keys).agg((F.round(auc, digits) if digits is not None else auc).alias("auc_roc"))
    return out if by else out.drop("_all")


def area_under_pr(df: DataFrame, label: str, score: str, by: list[str] | None = None,
                  digits: int | None = 6) -> DataFrame:
    """Area under the precision-recall curve (A11): trapezoids over distinct
    thresholds, starting at (recall 0, precision of the first threshold) as
    MLlib's evaluator does."""
    cur, keys = _curve(df, label, score, by or [])
    tp, fp = _d("cum_pos"), _d("cum_neg")
    prec = tp / (tp + fp)
    prev_tp, prev_fp = tp - F.col("pos"), fp - F.col("neg")
    prev_prec = F.when(prev_tp + prev_fp == 0, prec).otherwise(prev_tp / (prev_tp + prev_fp))
    term = F.col("pos") * (prec + prev_prec) / 2.0
    auc = F.try_divide(F.sum(term), F.first("P").cast("double"))
    out = cur.groupBy(*keys).agg((F.round(auc, digits) if digits is not None else auc).alias("auc_pr"))
    return out if by else out.drop("_all")


def curve_areas(df: DataFrame, label: str, score: str, by: list[str] | None = None,
                digits: int | None = 6) -> DataFrame:
    """Both areas (ROC and PR) from one pass over the distinct-threshold
    curve: ``(*by, auc_roc, auc_pr)``."""
    cur, keys = _curve(df, label, score, by or [])
    tp, fp = _d("cum_pos"), _d("cum_neg")
    roc_term = _d("neg") * (tp * 2 - _d("pos")) / 2.0
    prec = tp / (tp + fp)
    prev_tp, prev_fp = tp - F.col("pos"), fp - F.col("neg")
    prev_prec = F.when(prev_tp + prev_fp == 0, prec).otherwise(prev_tp / (prev_tp + prev_fp))
    pr_term = F.col("pos") * (prec + prev_prec) / 2.0
    roc = F.try_divide(F.sum(roc_term), F.first(_d("P")) * F.first(_d("N")))
    pr = F.try_divide(F.sum(pr_term), F.first("P").cast("double"))
    if digits is not None:
        roc, pr = F.round(roc, digits), F.round(pr, digits)
    out = cur.groupBy(*keys).agg(roc.alias("auc_roc"), pr.alias("auc_pr"))
    return out if by else out.drop("_all")


def evaluator_metric(df: DataFrame, label: str, raw: str = "rawPrediction",
                     metric: str = "areaUnderROC", exact: bool = True) -> float:
    """MLlib's BinaryClassificationEvaluator (parity path); ``exact`` sets
    ``numBins=0`` so no down-sampling of the curve happens."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    ev = BinaryClassificationEvaluator(rawPredictionCol=raw, labelCol=label, metricName=metric,
                                       numBins=0 if exact else 1000)
    return ev.evaluate(df)
