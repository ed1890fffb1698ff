"""Ten-year-risk style model on the driver tables.

orders ⋈ customer, label = order status 'F'.  Steps, with every statistic
learnt on the training split only:
sentinel filter + cast → split (key hash) → index/one-hot/assemble →
χ² selection of the categorical block → standardised numerics → class
weights → weighted LR (maxIter 10) or a tree model → metrics per split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.operators import clean, encode, profile, split
from spindle.operators.classify import (fit_decision_tree, fit_logistic, fit_random_forest,
                                        positive_probability)
from spindle.operators.common import materialized, skew_split_join
from spindle.plans.common import metrics_by_split
from spindle.sources import load_table

CATEGORICAL = ["o_orderpriority", "c_mktsegment"]
NUMERIC = ["o_totalprice", "c_acctbal", "order_year"]
LABEL = "label"


def risk_frame(spark, sf_dir) -> DataFrame:
    """Joined rows with 'NA' markers as a CSV source would carry them."""
    orders = load_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus",
                                                  "o_totalprice", "o_orderdate", "o_orderpriority"])
    cust = load_table(spark, sf_dir, "customer", ["c_custkey", "c_acctbal", "c_mktsegment"])
    # a customer may own a large share of all orders: split join on hot keys
    df = skew_split_join(orders, cust.withColumnRenamed("c_custkey", "o_custkey"), ["o_custkey"], "inner")
    df = df.select("o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias(LABEL),
                   "o_orderpriority", "c_mktsegment", "o_totalprice", "c_acctbal",
                   F.year("o_orderdate").cast("double").alias("order_year"))
    df = clean.inject_marker(df, "o_totalprice", "NA", F.col("o_orderkey") % 50 == 0)
    return clean.inject_marker(df, "c_acctbal", "NA", F.col("o_orderkey") % 70 == 0)


def prepare(df: DataFrame):
    """Clean, split and encode; returns (train, test) with ``features``."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    df = clean.drop_marked(df, ["o_totalprice", "c_acctbal"], "NA")
    # both splits read the joined, cleaned rows: build them once
    df = clean.cast_columns(df, ["o_totalprice", "c_acctbal"], "double")
    df = materialized(clean.drop_incomplete(df, NUMERIC), "risk")        # a number that does not parse is NULL
    train, test = split.split_frames(df, ["o_orderkey"], 80)
    ratio = profile.class_balance(train, LABEL).first()["balancing_ratio"]
    train = profile.with_class_weights(train, LABEL, ratio, "class_weight")
    test = profile.with_class_weights(test, LABEL, ratio, "class_weight")
    cat = encode.encoding_pipeline(CATEGORICAL, [], features_col="cat_vec", handle_invalid="keep")
    num = VectorAssembler(inputCols=NUMERIC, outputCol="num_vec", handleInvalid="error")
    scaler = StandardScaler(inputCol="num_vec", outputCol="num_scaled")
    selector = encode.chi2_selector("cat_vec", LABEL, "cat_selected", fpr=0.05)
    final = VectorAssembler(inputCols=["cat_selected", "num_scaled"], outputCol="features")
    model = Pipeline(stages=[cat, num, scaler, selector, final]).fit(train)
    keep = ["o_orderkey", LABEL, "class_weight", "features"]
    return model.transform(train).select(*keep), model.transform(test).select(*keep)


def run_risk(spark, sf_dir, learner: str = "lr") -> DataFrame:
    train, test = prepare(risk_frame(spark, sf_dir))
    train = materialized(train, "risk-train")
    if learner == "lr":
        model = fit_logistic(train, "features", LABEL, max_iter=10, weight_col="class_weight")
    elif learner == "tree":
        model = fit_decision_tree(train, "features", LABEL, max_depth=5, weight_col="class_weight")
    else:
        model = fit_random_forest(train, "features", LABEL, num_trees=20, max_depth=5,
                                  weight_col="class_weight")
    scored = (model.transform(train).withColumn("split", F.lit("train"))
              .unionByName(model.transform(test).withColumn("split", F.lit("test"))))
    scored = positive_probability(scored)
    return metrics_by_split(scored, LABEL)
