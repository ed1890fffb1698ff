"""Fitted trees as node tables (K9, K10) and scoring as a fold of predicates.

A tree is a table of nodes: the feature and threshold (or set of categories)
of an inner node, its children, and the class shares of a leaf.  Scoring is
one nested CASE expression per tree over plain columns, so a table exported
from one session scores rows in any other, without MLlib and without Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.session import shared_path


def tree_table(spark, model) -> DataFrame:
    """``(tree, node, feature, threshold, categories, left, right, shares)``
    of a fitted tree or forest.  A row goes left if its feature is at most
    the threshold or, for a categorical split, one of ``categories``.  Leaves have
    no feature; ``shares`` are the classes' shares of a node's training weight."""
    path = shared_path(spark, "tree")
    model.save(path)
    nodes = spark.read.parquet(f"{path}/data")
    if "nodeData" in nodes.columns:
        nodes = nodes.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        nodes = nodes.withColumn("tree", F.lit(0))
    inner, split, stats = F.col("leftChild") >= 0, F.col("split"), F.col("impurityStats")
    number = split["numCategories"] < 0
    total = F.aggregate(stats, F.lit(0.0), lambda a, b: a + b)
    return nodes.select(
        "tree", F.col("id").alias("node"), F.when(inner, split["featureIndex"]).alias("feature"),
        F.when(inner & number, split["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.when(inner & ~number, split["leftCategoriesOrThreshold"]).alias("categories"),
        F.when(inner, F.col("leftChild")).alias("left"), F.when(inner, F.col("rightChild")).alias("right"),
        F.transform(stats, lambda s: s / total).alias("shares"))


def tree_probability(table: DataFrame, features: list[Column], of_class: int = 1) -> Column:
    """Mean over the trees of the share of ``of_class`` in the leaf that a row
    falls into.  The table is read to the driver: it holds at most ``2 **
    depth`` nodes a tree, whatever the data."""
    trees: dict[int, dict] = {}
    for r in table.collect():
        trees.setdefault(r.tree, {})[r.node] = r

    def below(nodes: dict, at: int) -> Column:
        n = nodes[at]
        if n.feature is None:
            return F.lit(float(n.shares[of_class]))
        x = features[n.feature]
        left = x <= F.lit(float(n.threshold)) if n.threshold is not None else x.isin([float(c) for c in n.categories])
        return F.when(left, below(nodes, n.left)).otherwise(below(nodes, n.right))
    total = None
    for _, nodes in sorted(trees.items()):
        share = below(nodes, 0)
        total = share if total is None else total + share
    return total / len(trees)
