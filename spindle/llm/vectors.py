"""Vector tables as blocks, shared by the two vector searches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def valid_vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(vec_id, v array<double>)`` of the rows that take part: id and
    vector not NULL, not empty, all components finite.  Rows repeated with the same
    id and vector count once."""
    v = F.col(vector_col).cast("array<double>")
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & finite).distinct()


def matrix(column, width: int) -> np.ndarray:
    """Vectors of an Arrow list column as rows, short ones filled with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = np.asarray(column.value_lengths()).astype(np.int64)
    out = np.zeros((len(n), width))
    out[np.arange(width) < n[:, None]] = np.asarray(column.flatten())
    return out


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query over all blocks, ties to the smaller vec_id."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
