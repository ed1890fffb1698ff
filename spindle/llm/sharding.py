"""Shards by a hierarchical weighted hash tree.

A tree has regions, their racks, and the racks' shards, each leaf with a
weight; a node weighs what its leaves weigh.  A row descends level by level:
at each node every child draws an exponential ``-ln(u) / weight`` from a hash
of the row's key and the child's name, and the smallest draw wins.  A
child is chosen with probability in proportion to its weight, and where one
child's weight grows, rows move only into that child: movement stays within
the subtrees whose weights change.

One more shard enters as a region of its own (``grow``): no other weight
changes, so rows move into the new shard only.

Everything is a DataFrame expression.  Slots (positions within a shard) need
no window over a whole shard: equal rows are counted first, key ranges of
each shard are numbered by themselves and start where the ranges before end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Key ranges of a shard that are numbered apart; their number bounds the table of starts.
SLOT_RANGES = 1024

#: region -> rack -> {shard: weight}
Tree = dict[str, dict[str, dict[int, float]]]


def tree_of(shards: int, base: int = 8) -> Tree:
    """The tree of ``shards`` equal shards: up to ``base`` in two regions of
    two racks each, every further one as grown."""
    tree: Tree = {}
    for s in range(min(shards, base)):
        tree.setdefault(f"region{s % 2}", {}).setdefault(f"rack{s // 2 % 2}", {})[s] = 1.0
    for s in range(base, shards):
        tree = grow(tree, s)
    return tree


def grow(tree: Tree, shard: int, weight: float = 1.0) -> Tree:
    """The tree with one more shard, in a region of its own."""
    return tree | {f"region-of-{shard}": {"rack0": {shard: weight}}}


def _weight(node) -> float:
    return sum(map(_weight, node.values())) if isinstance(node, dict) else float(node)


def _draw(key: Column, name: str, weight: float) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(name)), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(u) / weight


def _winner(key: Column, path: str, node: dict) -> Column:
    """Name of the child with the smallest draw; ties to the first name."""
    names = [n for n in node if _weight(node[n]) > 0]
    draws = [F.struct(_draw(key, f"{path}/{n}", _weight(node[n])).alias("d"), F.lit(str(n)).alias("n")) for n in names]
    return F.least(*draws)["n"] if len(draws) > 1 else F.lit(str(names[0]))


def descend(df: DataFrame, key: str, tree: Tree, out: str) -> DataFrame:
    """Add the shard of each row as ``out``: one draw for each child of the
    nodes on the row's way, nothing for the rest of the tree."""
    k, region, rack = F.col(key), f"_{out}_region", f"_{out}_rack"

    def choose(on: list[tuple[Column, Column]]) -> Column:
        value = F.when(*on[0])
        for condition, result in on[1:]:
            value = value.when(condition, result)
        return value

    df = df.withColumn(region, _winner(k, "", tree))
    df = df.withColumn(rack, choose([(F.col(region) == r, _winner(k, f"/{r}", racks)) for r, racks in tree.items()]))
    df = df.withColumn(out, choose([((F.col(region) == r) & (F.col(rack) == q), _winner(k, f"/{r}/{q}", shards))
                                    for r, racks in tree.items() for q, shards in racks.items()]).cast("int"))
    return df.drop(region, rack)


def with_slots(df: DataFrame, shard: str, order: list[str], ranges: int = SLOT_RANGES) -> DataFrame:
    """Add ``slot``, gapless from 0 within each shard.  The order is by key
    range (a hash of the first order column), then by ``order``; equal rows
    take neighbouring slots."""
    keys = [shard, "_range", *order]
    same = (df.withColumn("_range", F.pmod(F.xxhash64(order[0]), F.lit(ranges)).cast("int"))
            .groupBy(*dict.fromkeys([*df.columns, "_range"])).agg(F.count(F.lit(1)).alias("_times")))
    sizes = (df.select(shard, F.pmod(F.xxhash64(order[0]), F.lit(ranges)).cast("int").alias("_range"))
             .groupBy(shard, "_range").agg(F.count(F.lit(1)).alias("_n")))
    before = Window.partitionBy(shard).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(shard, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(shard, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = same.withColumn("_at", F.coalesce(F.sum("_times").over(within), F.lit(0)))
    placed = placed.join(F.broadcast(starts), [shard, "_range"])       # shards x ranges rows at most
    first = F.col("_start") + F.col("_at")
    return (placed.select(*df.columns, F.explode(F.sequence(first, first + F.col("_times") - 1)).alias("slot"))
            .drop(*[k for k in keys if k.startswith("_")]))


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` for every
    row of ``docs (doc_id, text)`` under the law ``key``: doc_id and the
    number of shards decide.

    A NULL doc_id is a key like any other; NULL texts have size 1 and the
    crc32 of an empty text.  Rows with the same doc_id share a shard and take
    slots of their own.  Other columns are ignored; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"))
    tree = tree_of(shards)
    rows = descend(descend(rows, "doc_id", tree, "shard"), "doc_id", grow(tree, shards), "grown_shard")
    placed = with_slots(rows, "shard", ["doc_id", "size", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                         F.col("slot").cast("long").alias("slot"), "grown_shard")
