"""Reproducible splits, samples and previews.

Every random choice is keyed by an md5 of the row key, so a split is the same
under any partitioning, on any engine, and after a task is retried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_hash(keys: list[str]) -> Column:
    """md5 (hex) of the row key."""
    parts = [F.col(k).cast("string") for k in keys]
    text = parts[0] if len(parts) == 1 else F.concat_ws("|", *parts)
    return F.md5(text)


def hash_bucket(keys: list[str], buckets: int = 100) -> Column:
    """Integer in ``[0, buckets)`` from the first 32 bits of the key's md5."""
    return F.conv(F.substring(key_hash(keys), 1, 8), 16, 10).cast("bigint") % F.lit(buckets)


def hash_split(df: DataFrame, keys: list[str], train_pct: int = 80, out: str = "split") -> DataFrame:
    """Label rows ``'train'`` / ``'test'`` by key hash (L2)."""
    return df.withColumn(out, F.when(hash_bucket(keys) < train_pct, F.lit("train"))
                         .otherwise(F.lit("test")))


def split_frames(df: DataFrame, keys: list[str], train_pct: int = 80) -> tuple[DataFrame, DataFrame]:
    b = hash_bucket(keys)
    return df.filter(b < train_pct), df.filter(b >= train_pct)


def hash_sample(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The ``n`` rows with the smallest key hash: a reproducible sample that
    replaces an order-less ``limit(n)`` (L1).  Planned as a per-partition
    top-n followed by one merge of at most n rows per task."""
    return df.withColumn("sample_hash", key_hash(keys)).orderBy("sample_hash", *keys).limit(n)


def preview(df: DataFrame, order_by: list[str], n: int = 20) -> DataFrame:
    """First ``n`` rows in key order — a stable ``show(n)``."""
    return df.orderBy(*order_by).limit(n)
