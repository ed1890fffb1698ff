"""Schema, shape and summary statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: ``(position, column_name, data_type, non_null)``.
    Types come from the plan; the non-NULL counts are one aggregate pass."""
    fields = df.schema.fields
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"_n{i}") for i, f in enumerate(fields)])
    rows = F.explode(F.array(*[
        F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("column_name"),
                 F.lit(f.dataType.simpleString()).alias("data_type"),
                 F.col(f"_n{i}").alias("non_null"))
        for i, f in enumerate(fields)]))
    return counts.select(rows.alias("r")).select("r.*")


def shape_report(stages: dict[str, DataFrame]) -> DataFrame:
    """``(stage, n_rows, n_cols)`` for named stages of a plan."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(name).alias("stage"), "n_rows", F.lit(len(df.columns)).alias("n_cols"))
             for name, df in stages.items()]
    return reduce(DataFrame.unionByName, parts)


def row_count(df: DataFrame, predicate: str | Column | None = None) -> DataFrame:
    """Count rows, optionally under a predicate given as SQL text."""
    if predicate is not None:
        df = df.filter(F.expr(predicate) if isinstance(predicate, str) else predicate)
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def class_distribution(df: DataFrame, label: str, sum_col: str | None = None) -> DataFrame:
    """Rows per class (A2), with an optional per-class sum (A3)."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    if sum_col:
        aggs.append(F.sum(sum_col).cast("bigint").alias(f"sum_{sum_col}"))
    return df.groupBy(label).agg(*aggs)


def describe_numeric(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """count / mean / sample stddev / min / max per column in one pass (A4),
    returned as typed rows instead of ``describe()``'s strings."""
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    stats = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n"),
                 F.round(f"m{i}", digits).alias("mean"), F.round(f"s{i}", digits).alias("stddev"),
                 F.col(f"lo{i}").alias("min_value"), F.col(f"hi{i}").alias("max_value"))
        for i, c in enumerate(columns)]))
    return stats.select(rows.alias("r")).select("r.*")


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """One row: total, positives, % positives, negatives and the balancing
    ratio negatives/total (A6) — a single aggregate job."""
    y = F.col(label)
    return (df.agg(F.count(F.lit(1)).alias("total"), F.count_if(y == 1).alias("positives"))
            .withColumn("negatives", F.col("total") - F.col("positives"))
            .withColumn("pct_positive", F.try_divide(F.col("positives") * 100.0, F.col("total")))
            .withColumn("balancing_ratio", F.try_divide(F.col("negatives").cast("double"), F.col("total"))))


def with_class_weights(df: DataFrame, label: str, ratio: float, out: str = "class_weight") -> DataFrame:
    """Positives weigh ``ratio``, negatives ``1 - ratio`` (P18).  ``ratio`` is
    the scalar from :func:`class_balance`, fitted on training rows."""
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(ratio)).otherwise(F.lit(1.0 - ratio)))
