"""Model queries: LR fits and scoring, multi-label, trees, and the two
tabular workloads end to end (K5–K10, W3–W5).  Solver output is not
bit-stable across engines, so fits are rows-only; scoring with fixed
coefficients is checked with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from spindle.operators import encode
from spindle.operators.multilabel import gradient_table
from spindle.queries.splitting import md5_bucket_sql
from spindle.operators.classify import (coefficient_table, feature_names, fit_decision_tree, fit_logistic,
                                        fit_random_forest, positive_probability, score_linear)
from spindle.plans import income, risk, text_scoring
from spindle.queries.evaluation import INTERCEPT, W_DISC, W_QTY, W_TAX
from spindle.sources import load_table


def q_lr_score_fixed(spark, sf_dir):
    li = load_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity",
                                                "l_discount", "l_tax"])
    out = score_linear(li, {"l_quantity": W_QTY, "l_discount": W_DISC, "l_tax": W_TAX}, INTERCEPT)
    return out.select("l_orderkey", "l_linenumber", F.round("probability", 6).alias("probability"),
                      "prediction")


def q_lr_l2_fit(spark, sf_dir):
    return text_scoring.run_single(spark, sf_dir, "toxic")


def q_lr_weighted_fit(spark, sf_dir):
    """K6 alone: class-weighted LR capped at 10 iterations on order rows,
    per-order P(status 'F') on every order."""
    from spindle.operators import profile
    orders = load_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus", "o_totalprice",
                                                  "o_orderpriority"])
    orders = orders.withColumn("label", (F.col("o_orderstatus") == "F").cast("int"))
    ratio = profile.class_balance(orders, "label").first()["balancing_ratio"]
    orders = profile.with_class_weights(orders, "label", ratio, "class_weight")
    pipe = encode.encoding_pipeline(["o_orderpriority"], ["o_totalprice"]).fit(orders)
    x = pipe.transform(orders).select("o_orderkey", "label", "class_weight", "features")
    model = fit_logistic(x, "features", "label", max_iter=10, weight_col="class_weight")
    out = positive_probability(model.transform(x))
    return out.select("o_orderkey", "label", F.round("p1", 6).alias("probability"), "prediction")


def q_lr_coefficients(spark, sf_dir):
    cust = load_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    cust = cust.withColumn("label", (F.col("c_acctbal") > 5000).cast("double"))
    pipe = encode.encoding_pipeline(["c_mktsegment"], ["c_nationkey"]).fit(cust)
    x = pipe.transform(cust).select("label", "features")
    model = fit_logistic(x, "features", "label", max_iter=10)
    return coefficient_table(spark, model, feature_names(x, "features"))


def q_lr_gradient(spark, sf_dir):
    """The penalised, standardised gradient at the registered coefficients (K5)."""
    li = load_table(spark, sf_dir, "lineitem", ["l_quantity", "l_discount", "l_tax", "l_returnflag"])
    li = li.withColumn("label", (F.col("l_returnflag") == "R").cast("int"))
    out = gradient_table(li, ["l_quantity", "l_discount", "l_tax"], "label",
                         {"l_quantity": W_QTY, "l_discount": W_DISC, "l_tax": W_TAX}, INTERCEPT, reg_param=0.1)
    return out.select("feature", F.round("gradient", 6).alias("gradient"))


def q_lr_l2_certificate(spark, sf_dir):
    """An L2 fit with class weights on lineitem and its gradient there, to
    four places: zero in every coordinate proves the minimum (K5, K6)."""
    from pyspark.ml.feature import VectorAssembler
    from spindle.operators import profile
    from spindle.operators.common import materialized
    names = ["l_quantity", "l_discount", "l_tax"]
    li = load_table(spark, sf_dir, "lineitem", [*names, "l_returnflag"])
    li = li.withColumn("label", (F.col("l_returnflag") == "R").cast("int"))
    ratio = profile.class_balance(li, "label").first()["balancing_ratio"]
    li = profile.with_class_weights(li, "label", ratio, "class_weight")
    x = materialized(VectorAssembler(inputCols=names, outputCol="features").transform(li), "certificate")
    model = fit_logistic(x, "features", "label", reg_param=0.1, weight_col="class_weight")
    fitted = dict(zip(names, model.coefficients.toArray().tolist()))
    out = gradient_table(x, names, "label", fitted, model.intercept, reg_param=0.1, weight="class_weight")
    return out.select("feature", F.abs(F.round("gradient", 4)).alias("gradient"))


def q_lr_saturated(spark, sf_dir):
    """Weighted LR on the one-hot levels of one category: the fitted log-odds
    of each level are the level's weighted log-odds in the data (K6, K8)."""
    from spindle.operators import profile
    from spindle.operators.common import materialized
    orders = load_table(spark, sf_dir, "orders", ["o_orderstatus", "o_orderpriority"])
    orders = orders.withColumn("label", (F.col("o_orderstatus") == "F").cast("int"))
    ratio = profile.class_balance(orders, "label").first()["balancing_ratio"]
    orders = profile.with_class_weights(orders, "label", ratio, "class_weight")
    pipe = encode.encoding_pipeline(["o_orderpriority"], []).fit(orders)
    x = materialized(pipe.transform(orders).select("label", "class_weight", "features"), "saturated")
    model = fit_logistic(x, "features", "label", weight_col="class_weight")
    table = coefficient_table(spark, model, pipe.stages[0].labelsArray[0])
    return (table.filter("feature <> '(intercept)'")
            .select(F.col("feature").alias("o_orderpriority"),
                    F.round(F.col("coefficient") + F.lit(float(model.intercept)), 3).alias("log_odds")))


def _tree_check(spark, sf_dir, fit):
    """Rows whose probability by the node table differs from the model's own."""
    from pyspark.ml.functions import vector_to_array
    from spindle.operators import trees
    from spindle.operators.common import materialized
    train, _ = risk.prepare(risk.risk_frame(spark, sf_dir))
    train = materialized(train, "tree-rows")
    model = fit(train, "features", risk.LABEL, max_depth=5, weight_col="class_weight")
    scored = model.transform(train).select("o_orderkey", vector_to_array("features").alias("x"),
                                           vector_to_array("probability")[1].alias("p"))
    size = model.numFeatures
    table = trees.tree_table(spark, model)
    share = trees.tree_probability(table, [F.col("x")[i] for i in range(size)])
    return scored.select("p", share.alias("q")).agg(F.count(F.lit(1)).alias("n_rows"),
                                                    F.count_if(F.abs(F.col("p") - F.col("q")) > 1e-9).alias("n_different"))


def q_tree_table(spark, sf_dir):
    return _tree_check(spark, sf_dir, fit_decision_tree)


def q_forest_table(spark, sf_dir):
    return _tree_check(spark, sf_dir, fit_random_forest)


def q_text_certificate(spark, sf_dir):
    """Optimality of the text models: the largest gradient of each label at
    the fitted coefficients, to three places (0 at the minimum)."""
    out = text_scoring.run_certificate(spark, sf_dir)
    return out.select("label", "n_rows", F.abs(F.round("largest_gradient", 3)).alias("largest_gradient"))


def q_multilabel_scores(spark, sf_dir):
    return text_scoring.run_multilabel(spark, sf_dir)


def q_risk_model(spark, sf_dir):
    return risk.run_risk(spark, sf_dir, "lr")


def q_income_model(spark, sf_dir):
    return income.run_income(spark, sf_dir)


def q_decision_tree(spark, sf_dir):
    return risk.run_risk(spark, sf_dir, "tree")


def q_random_forest(spark, sf_dir):
    return risk.run_risk(spark, sf_dir, "forest")


_TREE_SQL = f"""
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_orderkey % 50 <> 0 AND o_orderkey % 70 <> 0 AND {md5_bucket_sql('o_orderkey')} < 80
  AND o_totalprice IS NOT NULL AND c_acctbal IS NOT NULL AND o_orderdate IS NOT NULL"""

QUERIES = {
    "lr_score_fixed": (q_lr_score_fixed, f"""
SELECT l_orderkey, l_linenumber,
       round(1.0 / (1.0 + exp(-({INTERCEPT} + {W_QTY} * l_quantity + {W_DISC} * l_discount + {W_TAX} * l_tax))), 6) AS probability,
       CAST(CASE WHEN {INTERCEPT} + {W_QTY} * l_quantity + {W_DISC} * l_discount + {W_TAX} * l_tax > 0 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS prediction
FROM lineitem"""),
    "lr_l2_fit": (q_lr_l2_fit, None),
    "lr_gradient": (q_lr_gradient, f"""
WITH r AS (SELECT l_quantity, l_discount, l_tax, 1.0 / (1.0 + exp(-({INTERCEPT} + {W_QTY} * l_quantity + {W_DISC} * l_discount + {W_TAX} * l_tax)))
  - CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS miss FROM lineitem)
SELECT 'l_quantity' AS feature, round(avg(miss * l_quantity) / stddev_samp(l_quantity) + 0.1 * {W_QTY} * stddev_samp(l_quantity), 6) AS gradient FROM r
UNION ALL SELECT 'l_discount', round(avg(miss * l_discount) / stddev_samp(l_discount) + 0.1 * {W_DISC} * stddev_samp(l_discount), 6) FROM r
UNION ALL SELECT 'l_tax', round(avg(miss * l_tax) / stddev_samp(l_tax) + 0.1 * {W_TAX} * stddev_samp(l_tax), 6) FROM r
UNION ALL SELECT '(intercept)', round(avg(miss), 6) FROM r"""),
    "lr_l2_certificate": (q_lr_l2_certificate, """
SELECT unnest(['l_quantity', 'l_discount', 'l_tax', '(intercept)']) AS feature, CAST(0 AS DOUBLE) AS gradient"""),
    "lr_saturated": (q_lr_saturated, """
WITH b AS (SELECT avg(CASE WHEN o_orderstatus = 'F' THEN 0.0 ELSE 1.0 END) AS ratio FROM orders)
SELECT o_orderpriority, round(ln(sum(CASE WHEN o_orderstatus = 'F' THEN ratio ELSE 0 END)
  / sum(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 - ratio END)), 3) AS log_odds FROM orders, b GROUP BY o_orderpriority"""),
    "tree_table": (q_tree_table, _TREE_SQL),
    "forest_table": (q_forest_table, _TREE_SQL),
    "lr_weighted_fit": (q_lr_weighted_fit, None),
    "lr_coefficients": (q_lr_coefficients, None),
    "multilabel_scores": (q_multilabel_scores, None),
    "text_certificate": (q_text_certificate, """
SELECT label, count(*) AS n_rows, CAST(0 AS DOUBLE) AS largest_gradient
FROM (SELECT doc_id, unnest(['quality', 'toxic']) AS label FROM labels JOIN documents USING (doc_id)
      WHERE quality IS NOT NULL AND toxic IS NOT NULL) GROUP BY label"""),
    "risk_model": (q_risk_model, None),
    "income_model": (q_income_model, None),
    "decision_tree": (q_decision_tree, None),
    "random_forest": (q_random_forest, None),
}
