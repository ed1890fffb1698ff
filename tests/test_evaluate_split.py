"""Evaluation metrics (with MLlib cross-checks) and reproducible splits."""

import random

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from spindle.operators import evaluate, split


def test_confusion_and_zero_margins(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 1.0), (0, 1.0)], "y int, p double")
    conf = evaluate.confusion_counts(df, "y", "p").first()
    assert (conf.tp, conf.tn, conf.fp, conf.fn) == (2, 0, 1, 0)
    m = evaluate.derived_metrics(evaluate.confusion_counts(df, "y", "p")).first()
    assert m.specificity == 0.0 and m.npv is None        # empty margin → NULL, no error
    assert m.lr_negative is None


@pytest.mark.parametrize("metric,fn,col", [("areaUnderROC", evaluate.area_under_roc, "auc_roc"),
                                           ("areaUnderPR", evaluate.area_under_pr, "auc_pr")])
def test_auc_matches_mllib_with_ties(spark, metric, fn, col):
    rnd = random.Random(7)
    rows = [(float(rnd.randint(0, 1)), float(rnd.randint(0, 30)) / 10.0) for _ in range(800)]
    df = spark.createDataFrame(rows, "y double, s double")
    ours = fn(df, "y", "s", digits=None).first()[col]
    vec = df.select("y", F.array("s", "s").alias("a")).rdd.map(
        lambda r: (r.y, Vectors.dense([-r.a[0], r.a[1]]))).toDF(["y", "raw"])
    theirs = evaluate.evaluator_metric(vec, "y", "raw", metric, exact=True)
    assert ours == pytest.approx(theirs, abs=1e-9)


def test_auc_by_group_uses_each_group(spark):
    df = spark.createDataFrame([("a", 1, 0.9), ("a", 0, 0.1), ("b", 1, 0.1), ("b", 0, 0.9)],
                               "g string, y int, s double")
    out = {r.g: r.auc_roc for r in evaluate.area_under_roc(df, "y", "s", ["g"]).collect()}
    assert out == {"a": 1.0, "b": 0.0}


def test_accuracy_rate(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 1.0), (0, 0.0), (1, 1.0)], "y int, p double")
    assert evaluate.accuracy_rate(df, "y", "p").first().accuracy_pct == 75.0


def test_hash_split_is_partition_stable(spark):
    base = spark.range(5000).withColumnRenamed("id", "k")
    a = {r.k for r in split.hash_split(base.repartition(1), ["k"]).filter("split = 'train'").collect()}
    b = {r.k for r in split.hash_split(base.repartition(7), ["k"]).filter("split = 'train'").collect()}
    assert a == b and 0.75 < len(a) / 5000 < 0.85


def test_hash_sample_and_preview(spark):
    base = spark.range(100).withColumnRenamed("id", "k")
    s1 = [r.k for r in split.hash_sample(base.repartition(3), ["k"], 10).collect()]
    s2 = [r.k for r in split.hash_sample(base.repartition(5), ["k"], 10).collect()]
    assert s1 == s2 and len(s1) == 10
    assert [r.k for r in split.preview(base, ["k"], 3).collect()] == [0, 1, 2]


def test_prefix_sums_bucketed_path_equals_direct(spark):
    from spindle.operators.common import prefix_sums
    rows = [("a" if i % 3 else "b", float(i), i % 5) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, s double, v int")
    direct = {(r.g, r.s): r.cum_v for r in prefix_sums(df, "s", ["v"], by=["g"], descending=True).collect()}
    bucketed = {(r.g, r.s): r.cum_v for r in
                prefix_sums(df, "s", ["v"], by=["g"], descending=True, buckets=16).collect()}
    assert direct == bucketed


def test_curve_areas_equal_single_metrics(spark):
    rows = [(i % 2, float((i * 37) % 11)) for i in range(400)]
    df = spark.createDataFrame(rows, "y int, s double")
    both = evaluate.curve_areas(df, "y", "s").first()
    assert both.auc_roc == evaluate.area_under_roc(df, "y", "s").first().auc_roc
    assert both.auc_pr == evaluate.area_under_pr(df, "y", "s").first().auc_pr


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_split_join_equals_plain_join(spark, how):
    from spindle.operators.common import skew_split_join
    big = spark.createDataFrame([(0 if i % 3 == 0 else i % 50, i) for i in range(600)], "k int, v int")
    small = spark.createDataFrame([(k, f"s{k}") for k in range(0, 60, 2)], "k int, name string")
    want = sorted(tuple(r) for r in big.join(small, ["k"], how).collect())
    got = skew_split_join(big, small, ["k"], how, broadcast_limit=5, hot_limit=3)
    assert sorted(tuple(r) for r in got.collect()) == want


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_metrics_partition_stable(spark, parts):
    rnd = random.Random(11)
    rows = [(rnd.randint(0, 1), float(rnd.randint(0, 40)) / 8.0) for _ in range(1500)]
    base = spark.createDataFrame(rows, "y int, s double")
    ref = evaluate.curve_areas(base.repartition(1), "y", "s").first()
    got = evaluate.curve_areas(base.repartition(parts), "y", "s").first()
    assert (got.auc_roc, got.auc_pr) == (ref.auc_roc, ref.auc_pr)


def test_curve_areas_at_billions_of_rows(spark, monkeypatch):
    from spindle.operators import evaluate
    big = spark.createDataFrame([(0.9, 4_000_000_000, 0, 1), (0.1, 0, 4_000_000_000, 1)], "_s double, pos long, neg long, _all int")
    monkeypatch.setattr(evaluate, "_score_counts", lambda *a: big)
    df = spark.createDataFrame([(1, 0.5)], "y int, s double")
    assert evaluate.area_under_roc(df, "y", "s").first().auc_roc == 1.0
    assert evaluate.curve_areas(df, "y", "s").first().auc_pr == 1.0
