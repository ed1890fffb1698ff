"""CSV sources and the CSV sink.

The reference reads CSV with a header and schema inference, optionally
trimming blanks round each field, and one workload parses quoted fields that
hold line breaks.  All of that is Spark's built-in CSV source; these helpers
only fix the option set so every workload reads the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = True, infer_schema: bool = False, trim: bool = False,
             multiline: bool = False, null_value: str | None = None) -> DataFrame:
    """Read CSV.

    * ``schema`` given: no inference pass (one job fewer, stable types).
    * ``trim``: ignore blanks before and after each field (S3).
    * ``multiline``: quoted fields may span lines; ``"`` escapes itself (S5).
    * ``null_value``: a marker that becomes NULL at read time (e.g. ``'NA'``).
    """
    reader = spark.read.option("header", header)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", infer_schema)
    if trim:
        reader = (reader.option("ignoreLeadingWhiteSpace", True)
                  .option("ignoreTrailingWhiteSpace", True))
    if multiline:
        reader = reader.option("multiLine", True).option("escape", '"')
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    return reader.csv(path)


def read_pair(spark: SparkSession, directory: str, train_name: str = "train",
              test_name: str = "test", **options) -> tuple[DataFrame, DataFrame]:
    """A directory holding a train and a test input."""
    base = directory.rstrip("/")
    return (read_csv(spark, f"{base}/{train_name}", **options),
            read_csv(spark, f"{base}/{test_name}", **options))


def write_csv(df: DataFrame, path: str, header: bool = True,
              multiline_safe: bool = False) -> str:
    """Write CSV with a header; ``multiline_safe`` quotes every field and
    escapes quotes by doubling them so that a multi-line reader gets the
    exact text back."""
    writer = df.write.mode("overwrite").option("header", header)
    if multiline_safe:
        writer = writer.option("quoteAll", True).option("escape", '"')
    writer.csv(path)
    return path
