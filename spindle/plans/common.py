"""Evaluation shared by the workload plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.operators import evaluate
from spindle.operators.common import materialized


def metrics_by_split(scored: DataFrame, label: str, score: str = "p1",
                     prediction: str = "prediction") -> DataFrame:
    """One row per split: confusion counts, derived rates, accuracy %, and
    areas under ROC and PR.  ``scored`` carries a ``split`` column.  Only the
    columns the metrics read are written (two aggregations read them)."""
    scored = materialized(scored.select(F.col(label).cast("double").alias(label), score, prediction, "split"), "scored")
    y, p = F.col(label), F.col(prediction).cast("double")
    counts = scored.groupBy("split").agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"), F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.round(F.avg(F.when(y == p, 1.0).otherwise(0.0)) * 100.0, 6).alias("accuracy_pct"))
    conf = evaluate.derived_metrics(counts)
    areas = evaluate.curve_areas(scored, label, score, ["split"])
    return conf.join(areas, "split", "left")
