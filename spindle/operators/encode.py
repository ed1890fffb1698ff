"""Categorical and numeric encoders.

Each encoder exists twice where that matters:

* a relational form — counts, ranks and conditional columns — that scales
  with the data and is checked against SQL; and
* the MLlib estimator the workloads fit in a ``Pipeline`` (parity path).

Statistics are always learnt on the frame passed to the fit function
(training rows) and applied unchanged to any other frame.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spindle.operators.common import broadcast_if_small, materialized

def _ranked(counts: DataFrame) -> DataFrame:
    """label_index for index tables of any size, without an unbounded window.

    Rows are range-partitioned on (column, count desc, value) — the values
    are distinct, so sampling balances the ranges — and written together with
    the number of their range, so that every later read sees the same ranges.
    Each range numbers its rows, a table of one row per range gives offsets,
    and each column's first position is subtracted.
    """
    order = [F.col("column_name").asc(), F.col("n_rows").desc(), F.col("value").asc()]
    ranges = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialized(counts.repartitionByRange(ranges, *order)
                          .withColumn("_pid", F.spark_partition_id()), "index-ranges")
    local = ranged.withColumn("_pos", F.row_number().over(Window.partitionBy("_pid").orderBy(*order)))
    sizes = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.select("_pid", F.coalesce(F.sum("_size").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    glob = local.join(F.broadcast(offsets), "_pid").withColumn("_g", F.col("_off") + F.col("_pos") - 1)
    starts = glob.groupBy("column_name").agg(F.min("_g").alias("_start"))
    return (glob.join(broadcast_if_small(starts), "column_name")
            .select("column_name", "value", "n_rows",
                    (F.col("_g") - F.col("_start")).cast("double").alias("label_index")))


def fit_string_indexes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Index table for several columns in one pass:
    ``(column_name, value, label_index, n_rows)``.  Index 0 is the most
    frequent value; ties are broken by value, ascending (StringIndexer's
    ``frequencyDesc`` order).  NULL is not a label."""
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
        for c in columns])).alias("p")).select("p.*").filter(F.col("value").isNotNull())
    counts = pairs.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n_rows"))
    return _ranked(counts)


@dataclass
class IndexModel:
    table: DataFrame                        # column_name, value, label_index, n_rows (written)
    sizes: dict[str, int]                   # labels of each column

    @classmethod
    def fit(cls, df: DataFrame, columns: list[str]) -> "IndexModel":
        table = materialized(fit_string_indexes(df, columns), "index")
        sizes = {r.column_name: r["count"] for r in table.groupBy("column_name").count().collect()}     # a row a column
        return cls(table, {c: sizes.get(c, 0) for c in columns})

    def size(self, column: str) -> int:
        return self.sizes[column]

    def transform(self, df: DataFrame, columns: list[str], suffix: str = "_index",
                  handle_invalid: str = "keep") -> DataFrame:
        """Add ``<col><suffix>`` for each column by a join to its index rows.
        Unseen or NULL values: ``keep`` → index k (one past the last label);
        ``skip`` → the row is dropped; ``error`` → a ValueError if any such
        row exists."""
        out = df
        for c in columns:
            side = (self.table.filter(F.col("column_name") == c)
                    .select(F.col("value").alias(f"_v_{c}"), F.col("label_index").alias(f"{c}{suffix}")))
            out = (out.join(side, F.col(c).cast("string") == F.col(f"_v_{c}"), "left")
                   .drop(f"_v_{c}"))
            k = self.size(c)
            if handle_invalid == "keep":
                out = out.withColumn(f"{c}{suffix}", F.coalesce(F.col(f"{c}{suffix}"), F.lit(float(k))))
            else:
                if handle_invalid == "error":
                    bad = out.filter(F.col(f"{c}{suffix}").isNull()).limit(1).count()
                    if bad:
                        raise ValueError(f"unseen label in column {c}")
                out = out.filter(F.col(f"{c}{suffix}").isNotNull())
        return out


def one_hot_columns(df: DataFrame, index_col: str, size: int, prefix: str,
                    drop_last: bool = True) -> DataFrame:
    """Indicator columns ``<prefix>_<i>`` for an index column (E7).  With
    ``drop_last`` the last category is the all-zero reference level."""
    n = size - 1 if drop_last else size
    return df.withColumns({f"{prefix}_{i}": (F.col(index_col) == F.lit(float(i))).cast("double")
                           for i in range(n)})


def standard_scale(df: DataFrame, columns: list[str], with_mean: bool = False,
                   suffix: str = "_scaled") -> DataFrame:
    """Divide by the sample standard deviation (optionally centre first) —
    StandardScaler's defaults (E10).  The statistics are one aggregate job;
    a zero deviation maps the column to 0.0, as the estimator does."""
    stats = df.agg(*[F.stddev_samp(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(columns)],
                   *[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    out = {}
    for i, c in enumerate(columns):
        sd, mean = stats[f"s{i}"], stats[f"m{i}"]
        x = F.col(c).cast("double") - (F.lit(mean) if with_mean else F.lit(0.0))
        out[f"{c}{suffix}"] = x / F.lit(sd) if sd else F.lit(0.0)
    return df.withColumns(out)


def chi2_statistics(df: DataFrame, label: str, features: list[str]) -> DataFrame:
    """Pearson χ² of each feature against the label, every distinct feature
    value its own category (what ChiSqSelector does with continuous input):
    ``(feature, statistic, dof)``.  Uses Σ o²/e − N over observed cells only,
    so empty cells never need to be materialised."""
    pairs = df.select(F.col(label).cast("double").alias("_y"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
        for c in features])).alias("p")).select("_y", "p.*")
    cells = pairs.groupBy("feature", "value", "_y").agg(F.count(F.lit(1)).alias("o"))
    # Row margin per (feature, value): a window over that value's few label
    # cells, spread over many tasks.  Column margins per (feature, label) and
    # totals per feature are tiny (features × labels rows) and joined back,
    # so no step ever holds all cells of one feature in one task.
    cells = cells.withColumn("nv", F.sum("o").over(Window.partitionBy("feature", "value")))
    ny = cells.groupBy("feature", "_y").agg(F.sum("o").alias("ny"))
    n = cells.groupBy("feature").agg(F.sum("o").alias("n"), F.countDistinct("_y").alias("n_labels"))
    cells = (cells.join(broadcast_if_small(ny), ["feature", "_y"])
             .join(broadcast_if_small(n), "feature"))
    o = F.col("o").cast("double")
    e = F.col("nv").cast("double") / F.col("n") * F.col("ny")
    return cells.groupBy("feature").agg(
        (F.sum(o * o / e) - F.first("n")).alias("statistic"),
        ((F.countDistinct("value") - 1) * (F.first("n_labels") - 1)).alias("dof"))


def chi2_selected(df: DataFrame, label: str, features: list[str], fpr: float = 0.05) -> DataFrame:
    """χ² selection (E11) for features of any number of values:
    ``(feature, statistic, dof, p_value, selected)``; selected if the
    statistic's upper tail is below ``fpr``."""
    from spindle.functions.special import chi2_upper_tail
    stats = chi2_statistics(df, label, features)
    p = F.when(F.col("dof") > 0, chi2_upper_tail(F.col("statistic"), F.col("dof"))).otherwise(1.0)
    return stats.withColumn("p_value", p).withColumn("selected", F.col("p_value") < fpr)


def encoding_pipeline(categorical: list[str], numeric: list[str], features_col: str = "features",
                      label: str | None = None, label_out: str = "label",
                      handle_invalid: str = "keep", drop_last: bool = True):
    """MLlib stages: one multi-column StringIndexer, one OneHotEncoder, an
    optional label indexer and a VectorAssembler (E5–E9).  ``handle_invalid``
    is for categories; a NULL number and an unseen or NULL label raise."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
    idx = [f"{c}_index" for c in categorical]
    vec = [f"{c}_vec" for c in categorical]
    stages = []
    if categorical:
        stages.append(StringIndexer(inputCols=categorical, outputCols=idx, handleInvalid=handle_invalid,
                                    stringOrderType="frequencyDesc"))
        # With handleInvalid='keep' the indexer already maps unseen values to
        # index k (its '__unknown' level); drop-last then removes exactly that
        # slot, so an unseen value encodes as all zeros.
        stages.append(OneHotEncoder(inputCols=idx, outputCols=vec, dropLast=drop_last,
                                    handleInvalid="error"))
    if label:
        stages.append(StringIndexer(inputCol=label, outputCol=label_out, handleInvalid="error"))
    stages.append(VectorAssembler(inputCols=vec + numeric, outputCol=features_col, handleInvalid="error"))
    return Pipeline(stages=stages)


def chi2_selector(features_col: str, label: str, out: str, fpr: float = 0.05):
    """χ² selection with the mode stated explicitly (categorical features and
    label, false-positive-rate threshold) — E11."""
    from pyspark.ml.feature import UnivariateFeatureSelector
    sel = UnivariateFeatureSelector(featuresCol=features_col, labelCol=label, outputCol=out,
                                    selectionMode="fpr")
    sel.setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(fpr)
    return sel
