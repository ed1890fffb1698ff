"""Helpers shared by the operator families."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Largest table that is ever broadcast.  A side is broadcast only after its
# rows have been counted against this bound.
BROADCAST_ROW_LIMIT = 2_000_000


def row_count_at_most(df: DataFrame, limit: int) -> bool:
    """True when ``df`` has at most ``limit`` rows: a partial-aggregate count,
    one number for each partition."""
    return df.count() <= limit


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Mark ``df`` for broadcast only if its size is proven to be bounded;
    otherwise leave it to the planner (sort-merge join, AQE skew handling)."""
    return F.broadcast(df) if row_count_at_most(df, limit) else df


# Keys of the big side that get the broadcast treatment in a split join.
HOT_KEY_LIMIT = 10_000


def skew_split_join(big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner",
                    broadcast_limit: int = BROADCAST_ROW_LIMIT,
                    hot_limit: int = HOT_KEY_LIMIT) -> DataFrame:
    """Join ``big`` to ``small`` on ``keys`` so that no key, however hot,
    lands in a single task.

    * ``small`` proven to fit the broadcast bound → one broadcast join.
    * Otherwise the ``hot_limit`` heaviest keys of ``big`` are found with a
      partial aggregate and a top-k (at most ``hot_limit`` rows).  Rows with
      a hot key are joined to the matching slice of ``small`` by broadcast
      (that slice is size-checked too); the remaining, cold rows take a
      shuffle join in which every key holds a bounded share of the rows.
    ``how`` is ``inner`` or ``left`` (rows of ``big`` are kept).
    """
    if row_count_at_most(small, broadcast_limit):
        return big.join(F.broadcast(small), keys, how)
    heavy = materialized(
        big.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        .orderBy(F.col("_n").desc()).limit(hot_limit).select(*keys), "hot-keys")
    hot_small = small.join(F.broadcast(heavy), keys, "left_semi")
    if not row_count_at_most(hot_small, broadcast_limit):
        return big.join(small, keys, how)          # AQE skew-join remains the fallback
    hot = big.join(F.broadcast(heavy), keys, "left_semi").join(F.broadcast(hot_small), keys, how)
    cold = big.join(F.broadcast(heavy), keys, "left_anti").join(small, keys, how)
    return hot.unionByName(cold)


def materialized(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: lineage is cut, the data survives executor loss (it lives in the
    shared folder, not in executor memory), and the planner sees its real
    size.  Used for model-sized state read many times (centres, IDF)."""
    from spindle.session import shared_path
    path = shared_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)     # no job to read the schema


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None,
                       keys: list[str] | None = None) -> DataFrame:
    """Spread ``df`` over at least ``min_partitions`` (default: the cluster's
    default parallelism) before CPU-heavy or iterative work.

    Reading a few large row groups can leave a scan with fewer partitions
    than cores; every later narrow step then runs on those few tasks.  Only
    in that case a repartition is added — by ``keys`` when given, so a later
    aggregation on those keys reuses the partitioning, else round-robin; a
    frame that already has enough partitions (the normal case on a big
    input) is returned as is.  Apply it to a scan (or a cached frame): on a
    plan that still contains a shuffle, reading the partition count makes
    adaptive execution run those stages first.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, *keys) if keys else df.repartition(target)


def rounded(c: Column | str, digits: int = 6) -> Column:
    """Round a floating result so engines with different summation orders
    agree; used only on reported values, never inside a fit."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


def prefix_sums(df: DataFrame, order_col: str, value_cols: list[str],
                by: list[str] | None = None, descending: bool = False,
                buckets: int | None = None) -> DataFrame:
    """Running totals of ``value_cols`` along ``order_col`` (inclusive), per
    group of ``by``, computed without a single-partition window.

    ``order_col`` must be unique within each group (aggregate ties first).
    Rows are range-partitioned by group and order (into as many ranges as
    shuffle partitions unless given) and written with the number of their range; each
    (group, range) sums in parallel, and the totals of the ranges before — one
    row per (group, range) — are joined on.  Where a row belongs is decided by
    the exchange alone.
    """
    by = list(by or [])
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialized(df.repartitionByRange(buckets, *[F.col(c) for c in by], order)
                          .withColumn("_bucket", F.spark_partition_id()), "prefix-ranges")
    local_w = (Window.partitionBy(*by, "_bucket").orderBy(order)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.select("*", *[F.sum(c).over(local_w).alias(f"_local_{c}") for c in value_cols])
    totals = ranged.groupBy(*by, "_bucket").agg(*[F.sum(c).alias(f"_tot_{c}") for c in value_cols])
    off_w = (Window.partitionBy(*by).orderBy("_bucket")
             .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(
        *by, "_bucket",
        *[F.coalesce(F.sum(f"_tot_{c}").over(off_w), F.lit(0)).alias(f"_off_{c}")
          for c in value_cols])
    out = local.join(offsets, [*by, "_bucket"])
    return out.select(
        *[F.col(c) for c in df.columns],
        *[(F.col(f"_local_{c}") + F.col(f"_off_{c}")).alias(f"cum_{c}") for c in value_cols])
