"""Census-income style model on the driver tables.

customer ⋈ nation ⋈ per-customer order aggregates; label = account balance
above 5000 (encoded from a text label that carries a trailing dot on test
rows).  Mode imputation of '?' markers uses training modes only; the
country collapses to one value vs. the rest; LR with maxIter 10.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.operators import clean, encode, split
from spindle.operators.classify import (coefficient_table, feature_names, fit_logistic,
                                        positive_probability)
from spindle.operators.common import broadcast_if_small, materialized
from spindle.plans.common import metrics_by_split
from spindle.sources import load_table

CATEGORICAL = ["c_mktsegment", "country", "region"]
NUMERIC = ["n_orders", "avg_price", "total_price"]
MARKED = ["c_mktsegment", "n_name"]


def income_frame(spark, sf_dir) -> DataFrame:
    cust = load_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    nation = load_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    orders = load_table(spark, sf_dir, "orders", ["o_custkey", "o_totalprice"])
    per_cust = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).cast("double").alias("n_orders"),
                                               F.avg("o_totalprice").alias("avg_price"),
                                               F.sum("o_totalprice").alias("total_price"))
    df = (cust.join(broadcast_if_small(nation), cust.c_nationkey == nation.n_nationkey, "inner")
          .join(per_cust, cust.c_custkey == per_cust.o_custkey, "left")
          .na.fill({"n_orders": 0.0, "avg_price": 0.0, "total_price": 0.0}))
    df = df.select("c_custkey", "c_mktsegment", "n_name", F.col("n_regionkey").cast("string").alias("region"),
                   *NUMERIC, F.when(F.col("c_acctbal") > 5000, ">5K").otherwise("<=5K").alias("income"))
    df = clean.inject_marker(df, "c_mktsegment", "?", F.col("c_custkey") % 20 == 0)
    return clean.inject_marker(df, "n_name", "?", F.col("c_custkey") % 23 == 0)


def prepare(df: DataFrame):
    df = materialized(df, "income")          # both splits read the joined rows: build them once
    train, test = split.split_frames(df, ["c_custkey"], 80)
    # test rows carry the other spelling of the label ('<=5K.')
    test = test.withColumn("income", F.concat("income", F.lit(".")))
    modes = clean.modes_dict(clean.column_modes(train, MARKED, exclude="?"))   # train only

    def shape(frame):
        frame = clean.impute_marker(frame, modes, "?")
        frame = frame.withColumn("country", clean.collapse_category("n_name", "NATION_0", "Not-0"))
        return frame.withColumn("label", clean.binary_label("income", "<=5K").cast("double"))

    train, test = shape(train), shape(test)
    pipe = encode.encoding_pipeline(CATEGORICAL, NUMERIC, handle_invalid="keep").fit(train)
    keep = ["c_custkey", "label", "features"]
    return pipe.transform(train).select(*keep), pipe.transform(test).select(*keep)


def run_income(spark, sf_dir, with_coefficients: bool = False):
    train, test = prepare(income_frame(spark, sf_dir))
    train = materialized(train, "income-train")
    model = fit_logistic(train, "features", "label", max_iter=10)
    scored = (model.transform(train).withColumn("split", F.lit("train"))
              .unionByName(model.transform(test).withColumn("split", F.lit("test"))))
    metrics = metrics_by_split(positive_probability(scored), "label")
    if with_coefficients:
        return metrics, coefficient_table(spark, model, feature_names(train, "features"))
    return metrics
