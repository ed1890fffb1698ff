"""Classifiers: fit, score, inspect.

Solvers are MLlib's (distributed L-BFGS / tree induction with tree
aggregation).  What this module adds is the plumbing the workloads need:
weighted and capped fits, a named coefficient table, scoring with fixed
coefficients as a plain expression, and multi-label scoring as one chained
plan instead of one join per label.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.functions.vectors import vector_element  # noqa: F401 (re-exported)
from spindle.operators.common import ensure_parallelism


def fit_logistic(df: DataFrame, features_col: str, label_col: str, reg_param: float = 0.0,
                 max_iter: int = 100, weight_col: str | None = None, elastic_net: float = 0.0,
                 aggregation_depth: int = 2):
    """Binary logistic regression (K5: L2 via ``reg_param``; K6: weighted
    and/or capped iterations).  Rows keep the partitions they have; raise
    ``aggregation_depth`` where thousands of them sum a wide gradient."""
    from pyspark.ml.classification import LogisticRegression
    kw = dict(featuresCol=features_col, labelCol=label_col, regParam=reg_param, maxIter=max_iter,
              elasticNetParam=elastic_net, family="binomial", aggregationDepth=aggregation_depth)
    if weight_col:
        kw["weightCol"] = weight_col
    return LogisticRegression(**kw).fit(df)


def fit_decision_tree(df: DataFrame, features_col: str, label_col: str, max_depth: int = 5,
                      seed: int = 1, weight_col: str | None = None):
    """Decision tree classifier (K9)."""
    from pyspark.ml.classification import DecisionTreeClassifier
    kw = dict(featuresCol=features_col, labelCol=label_col, maxDepth=max_depth, seed=seed)
    if weight_col:
        kw["weightCol"] = weight_col
    return DecisionTreeClassifier(**kw).fit(ensure_parallelism(df))


def fit_random_forest(df: DataFrame, features_col: str, label_col: str, num_trees: int = 20,
                      max_depth: int = 5, seed: int = 1, weight_col: str | None = None):
    """Random forest classifier."""
    from pyspark.ml.classification import RandomForestClassifier
    kw = dict(featuresCol=features_col, labelCol=label_col, numTrees=num_trees, maxDepth=max_depth,
              seed=seed)
    if weight_col:
        kw["weightCol"] = weight_col
    return RandomForestClassifier(**kw).fit(ensure_parallelism(df))


def feature_names(df: DataFrame, features_col: str) -> list[str]:
    """Slot names of an assembled vector, from the ML attribute metadata."""
    meta = df.schema[features_col].metadata.get("ml_attr", {})
    size = meta.get("num_attrs", 0)
    names = [f"f{i}" for i in range(size)]
    for group in meta.get("attrs", {}).values():
        for a in group:
            if a["idx"] < len(names):
                names[a["idx"]] = a.get("name", names[a["idx"]])
    return names


def coefficient_table(spark, model, names: list[str]) -> DataFrame:
    """``(feature, coefficient)`` plus an ``(intercept)`` row (K8).  The model
    already lives on the driver; this only labels its numbers."""
    coefs = model.coefficients.toArray().tolist()
    if len(names) != len(coefs):
        names = [f"f{i}" for i in range(len(coefs))]
    rows = [(n, float(c)) for n, c in zip(names, coefs)] + [("(intercept)", float(model.intercept))]
    return spark.createDataFrame(rows, "feature string, coefficient double")


def linear_margin(weights: dict[str, float], intercept: float) -> Column:
    """intercept + Σ wᵢ·xᵢ, summed left to right in the given order."""
    z = F.lit(float(intercept))
    for c, w in weights.items():
        z = z + F.lit(float(w)) * F.col(c)
    return z


def score_linear(df: DataFrame, weights: dict[str, float], intercept: float,
                 threshold: float = 0.5) -> DataFrame:
    """Logistic scoring with given coefficients as a plain expression (K8):
    adds ``margin``, ``probability`` (of class 1) and ``prediction``."""
    z = linear_margin(weights, intercept)
    cut = math.log(threshold / (1.0 - threshold))
    return (df.withColumn("margin", z)
            .withColumn("probability", F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("margin"))))
            .withColumn("prediction", F.when(F.col("margin") > F.lit(cut), 1.0).otherwise(0.0)))


def positive_probability(df: DataFrame, prob_col: str = "probability", out: str = "p1") -> DataFrame:
    """P(class 1) as a double column (F4, replaces the row UDF)."""
    return df.withColumn(out, vector_element(prob_col, 1))


def fit_multilabel(train: DataFrame, features_col: str, labels: list[str], reg_param: float = 0.1,
                   max_iter: int = 100, parallelism: int = 4) -> dict:
    """One binary model per label column (K7).  The caller persists the
    feature frame once; every fit reads it.  Up to ``parallelism`` fits run
    as concurrent Spark jobs from driver threads (each optimiser step is a
    small job, so the cluster would otherwise idle between steps)."""
    from concurrent.futures import ThreadPoolExecutor

    def fit_one(lab):
        rows = train.filter(F.col(lab).isNotNull())
        return lab, fit_logistic(rows, features_col, lab, reg_param=reg_param, max_iter=max_iter)

    workers = max(1, min(parallelism, len(labels)))
    with ThreadPoolExecutor(max_workers=workers) as pool:
        done = dict(pool.map(fit_one, labels))
    return {lab: done[lab] for lab in labels}


def score_multilabel(models: dict, df: DataFrame, id_col: str, features_col: str,
                     prefix: str = "p_") -> DataFrame:
    """Chain every label's transform over one plan, each writing its own
    probability column (raw and prediction columns switched off so they do
    not collide), then keep ``id`` and one P(class 1) per label — no join."""
    out = df.select(id_col, features_col)
    for lab, model in models.items():
        m = model.copy()
        m.setProbabilityCol(f"_prob_{lab}").setRawPredictionCol("").setPredictionCol("")
        m.setFeaturesCol(features_col)
        out = m.transform(out)
    return out.select(id_col, *[vector_element(f"_prob_{lab}", 1).alias(f"{prefix}{lab}") for lab in models])
