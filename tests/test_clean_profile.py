"""Cleaning and profiling operators on tiny in-memory fixtures."""

import pytest
from pyspark.sql import functions as F

from spindle.operators import clean, profile


def test_drop_marked_handles_null_marker_and_numeric(spark):
    df = spark.createDataFrame([(1, "NA", 3.0), (2, "5", None), (3, "7", 1.0), (4, None, 2.0)],
                               "id int, a string, b double")
    out = clean.drop_marked(df, ["a", "b"], "NA")       # numeric b must not raise
    assert sorted(r.id for r in out.collect()) == [3]


def test_cast_columns_bad_value_becomes_null(spark):
    df = spark.createDataFrame([("1.5",), ("NA",), (None,)], "x string")
    vals = [r.x for r in clean.cast_columns(df, ["x"], "double").collect()]
    assert vals == [1.5, None, None]


def test_fill_and_drop(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "id int, s string")
    assert clean.fill_constant(df, {"s": ""}).filter("s = ''").count() == 1
    assert clean.drop_incomplete(df).count() == 1


def test_modes_exclude_marker_and_break_ties_high(spark):
    df = spark.createDataFrame([("?",), ("?",), ("?",), ("a",), ("b",), (None,)], "c string")
    modes = clean.modes_dict(clean.column_modes(df, ["c"], exclude="?"))
    assert modes == {"c": "b"}                 # '?' most frequent but excluded; a/b tie → 'b'
    out = clean.impute_marker(df, modes, "?", include_null=True)
    assert sorted(r.c for r in out.collect()) == ["a", "b", "b", "b", "b", "b"]
    assert clean.impute_marker(df, modes, "?").filter("c is null").count() == 1


def test_collapse_and_binary_label(spark):
    df = spark.createDataFrame([("US", "<=50K"), ("FR", "<=50K."), (None, " >50K")], "c string, y string")
    rows = df.select(clean.collapse_category("c", "US", "Not-US").alias("c"),
                     clean.binary_label("y", "<=50K").alias("y")).collect()
    assert [(r.c, r.y) for r in rows] == [("US", 0), ("Not-US", 0), (None, 1)]


def test_frequent_items_contains_true_heavy_hitter(spark):
    df = spark.createDataFrame([("x",)] * 8 + [("y",), ("z",)], "c string")
    items = {r.item for r in clean.frequent_items(df, ["c"], 0.6).collect()}
    assert "x" in items


def test_describe_and_balance(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 0), (3.0, 0), (None, 0)], "x double, y int")
    d = profile.describe_numeric(df, ["x"]).first()
    assert (d.n, d.mean, d.stddev, d.min_value, d.max_value) == (3, 2.0, 1.0, 1.0, 3.0)
    b = profile.class_balance(df, "y").first()
    assert (b.total, b.positives, b.negatives, b.balancing_ratio) == (4, 1, 3, 0.75)
    w = profile.with_class_weights(df, "y", 0.75).select("class_weight").collect()
    assert sorted(r.class_weight for r in w) == [0.25, 0.25, 0.25, 0.75]


def test_schema_and_shape_report(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "id bigint, s string")
    rep = {r.column_name: (r.position, r.data_type, r.non_null) for r in profile.schema_report(df).collect()}
    assert rep == {"id": (1, "bigint", 2), "s": (2, "string", 1)}
    shape = {r.stage: (r.n_rows, r.n_cols) for r in
             profile.shape_report({"raw": df, "clean": df.na.drop()}).collect()}
    assert shape == {"raw": (2, 2), "clean": (1, 2)}


def test_row_count_predicate_text(spark):
    df = spark.createDataFrame([(1,), (0,), (1,)], "t int")
    assert profile.row_count(df, "t == 1").first().n_rows == 2


def test_frequent_items_are_exact(spark):
    from collections import Counter
    values = ["a"] * 30 + ["b"] * 21 + ["c"] * 20 + [f"r{i}" for i in range(29)]
    df = spark.createDataFrame([(v, None) for v in values], "v string, n string").repartition(7)
    got = {(r.column_name, r.item): r.n_rows for r in clean.frequent_items(df, ["v", "n"], 0.2).collect()}
    assert got == {("v", k): n for k, n in Counter(values).items() if n > 20}
    assert clean.frequent_items(df.filter("false"), ["v"], 0.2).count() == 0
