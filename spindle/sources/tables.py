"""Parquet tables of the driver data set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def load_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    """Read one table.  Selecting ``columns`` here keeps the Parquet
    ReadSchema narrow even before Catalyst's own pruning runs."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
