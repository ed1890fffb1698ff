"""Cluster centres per group value, every group in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame

from spindle.operators.cluster import fit_grouped_kmeans


def centres_per_group(df: DataFrame, group_col: str, features: list[str], groups: list | None = None,
                      k: int = 4, max_iter: int = 20, digits: int | None = None) -> DataFrame:
    """Rows ``(group, cluster, <features>)``.  ``groups`` restricts to the
    listed group values (a semi-join-able filter pushed to the scan)."""
    if groups is not None:
        df = df.filter(df[group_col].isin(list(groups)))
    return fit_grouped_kmeans(df, group_col, features, k=k, max_iter=max_iter, digits=digits).centers
