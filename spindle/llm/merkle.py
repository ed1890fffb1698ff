"""Merkle manifest of a table by time-forward processing.

Every row is a leaf; leaves of one group, in order, form a tree whose nodes
are the digests of ``fanout`` consecutive nodes below, and the trees' roots
(in the order of their groups) form the tree above.  Nodes are labelled
(level, index), children before parents.

Upward sweep: every node sends its digest to its parent through a priority
queue ordered by label, so a node is worked out when all its children have
sent.  The queue is external: labels are cut into slabs of ``height`` levels,
and a slab into blocks of ``fanout ** height`` leaves.  Inside a block the
messages wait in a heap; a message that leaves the slab is a row of a written
table, which Spark delivers by label for the next slab.  Downward sweep: the
same labels in reverse, a node sends each child the proof of the node with the
child's siblings put before it.  No task holds more than a block, and there
are as many rounds as slabs (logarithmic in the rows).

Positions come from one range-partitioned sort: a row's place in its range,
plus the rows of its group in the ranges before.
"""

from __future__ import annotations

import hashlib
import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindle.llm.base import buckets, discard, written

#: Levels of a slab: a block of a binary tree holds 2 ** 10 nodes at most.
HEIGHT = 10

STEP = "array<struct<before:string,after:string>>"
_STEP = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def leaf_digest(values: list[Column]) -> Column:
    """SHA-256 (hex) of the values: ``-`` for NULL, else byte count, ``:``, value."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts]), 256)


def _positions(leaves: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """``leaves`` (a written table) with ``_pos`` (from 0 in ``_tree``, by
    ``order``) and ``_n`` (leaves of the tree), and the largest ``_n``.
    Rows equal in the whole order are told apart by their place in the table,
    so that a group of equal rows is cut over several ranges."""
    spark = leaves.sparkSession
    keys = ["_tree", *order, "_row"]
    ranged = (leaves.withColumn("_row", F.monotonically_increasing_id())
              .repartitionByRange(buckets(spark), *keys).sortWithinPartitions(*keys).drop("_row")
              .withColumn("_seq", F.monotonically_increasing_id()))
    ranged = written(ranged.withColumn("_part", F.shiftright("_seq", 33))
                     .withColumn("_at", F.col("_seq").bitwiseAND(F.lit((1 << 33) - 1))).drop("_seq"), "merkle-ranges")
    before = Window.partitionBy("_tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    each = ranged.groupBy("_part", "_tree").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    starts = written(each.select("_part", "_tree", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"),
                                 F.sum("_rows").over(Window.partitionBy("_tree")).alias("_n")), "merkle-starts")
    largest = starts.agg(F.max("_n")).first()[0] or 0
    out = ranged.join(starts, ["_part", "_tree"]).withColumn("_pos", F.col("_at") - F.col("_first") + F.col("_start"))
    return out.drop("_part", "_at", "_first", "_start"), largest


def climb(positions: list[int], digests: list[str], n: int, fanout: int, height: int):
    """The nodes above a block, in label order, as ``(level, index, digests of
    the children)``, and the block's last ``(index, digest, is the tree's root)``."""
    if n == 1:
        return [], (0, digests[0], True)
    queue = [(1, p // fanout, p, d) for p, d in zip(positions, digests)]
    heapq.heapify(queue)
    nodes, last = [], None
    while queue:
        level, index = queue[0][:2]
        children = []
        while queue and queue[0][:2] == (level, index):
            children.append(heapq.heappop(queue)[3])
        digest = hashlib.sha256("".join(children).encode()).hexdigest()
        nodes.append((level, index, children))
        root = -(-n // fanout ** level) == 1
        if root or level == height:
            last = (index, digest, root)
        else:
            heapq.heappush(queue, (level + 1, index // fanout, index, digest))
    return nodes, last


def descend(nodes: list, positions: list[int], above: list, fanout: int) -> list[list]:
    """The proofs of a block's leaves: labels in reverse, each node sends every
    child the child's siblings and its own proof."""
    if not nodes:
        return [above for _ in positions]
    waiting = {nodes[-1][:2]: above}
    for level, index, children in reversed(nodes):
        own = waiting.pop((level, index))
        for j in range(len(children)):
            step = ("".join(children[:j]), "".join(children[j + 1:]))
            waiting[level - 1, index * fanout + j] = [step, *own]
    return [waiting[0, p] for p in positions]


def _ordered(table: pa.Table) -> tuple[pa.Table, list[int], list[str], int]:
    table = table.sort_by("_pos")
    return table, table["_pos"].to_pylist(), table["_digest"].to_pylist(), table["_n"][0].as_py()


def _upward(level: DataFrame, fanout: int, height: int) -> DataFrame:
    """Messages that leave the slab: ``(_tree, _pos, _digest, _n, _root)``."""
    def block(table: pa.Table) -> pa.Table:
        table, positions, digests, n = _ordered(table)
        index, digest, root = climb(positions, digests, n, fanout, height)[1]
        return pa.table({"_tree": table["_tree"][:1], "_pos": pa.array([index], pa.int64()), "_digest": [digest],
                         "_n": pa.array([-(-n // fanout ** height)], pa.int64()), "_root": [root]})
    rows = level.select("_tree", "_pos", "_digest", "_n", F.expr(f"_pos div {fanout ** height}").alias("_block"))
    return rows.groupBy("_tree", "_block").applyInArrow(
        block, "_tree string, _pos long, _digest string, _n long, _root boolean")


def _proof_array(proofs: list[list]) -> pa.Array:
    offsets = [0]
    for p in proofs:
        offsets.append(offsets[-1] + len(p))
    steps = [s for p in proofs for s in p]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
        [pa.array([s[0] for s in steps], pa.string()), pa.array([s[1] for s in steps], pa.string())], ["before", "after"]))


def _downward(level: DataFrame, messages: DataFrame, fanout: int, height: int) -> DataFrame:
    """``level`` with the proof, subroot and root of every node, from the
    ``messages (_tree, _block, _proof, _subroot, _root)`` of the blocks' tops."""
    names = [c for c in level.columns if c not in ("_tree", "_pos", "_digest", "_n")]

    def block(table: pa.Table, message: pa.Table) -> pa.Table:
        table, positions, digests, n = _ordered(table)
        above = [(s["before"], s["after"]) for s in message["_proof"][0].as_py()]
        proofs = descend(climb(positions, digests, n, fanout, height)[0], positions, above, fanout)
        out = {c: table[c] for c in ["_tree", "_pos", "_digest", *names]}
        for c in ("_subroot", "_root"):
            out[c] = pa.array([message[c][0].as_py()] * table.num_rows, pa.string())
        return pa.table(out | {"_proof": _proof_array(proofs)})
    kept = T.StructType([f for f in level.schema if f.name in names])
    schema = T.StructType([T.StructField("_tree", T.StringType()), T.StructField("_pos", T.LongType()),
                           T.StructField("_digest", T.StringType()), *kept, T.StructField("_subroot", T.StringType()),
                           T.StructField("_root", T.StringType()), T.StructField("_proof", T._parse_datatype_string(STEP))])
    rows = level.withColumn("_block", F.expr(f"_pos div {fanout ** height}"))
    return (rows.groupBy("_tree", "_block").cogroup(messages.groupBy("_tree", "_block"))
            .applyInArrow(block, schema))


def _sweep_up(leaves: DataFrame, order: list[str], fanout: int, height: int) -> tuple[list[DataFrame], DataFrame]:
    """The slabs' node tables, lowest first, and ``(_tree, _digest, _slab)``:
    each tree's root with the slab it is found in."""
    level, largest = _positions(leaves, order)
    slabs, tops = [level], []
    while True:
        up = written(_upward(slabs[-1], fanout, height), "merkle-slab")
        tops.append(up.filter("_root").select("_tree", "_digest", F.lit(len(tops)).alias("_slab")))
        largest = -(-largest // fanout ** height)
        if largest <= 1:
            break
        slabs.append(up.filter("not _root").drop("_root"))
    roots = tops[0]
    for t in tops[1:]:
        roots = roots.unionByName(t)
    return slabs, roots


def _sweep_down(slabs: list[DataFrame], roots: DataFrame, fanout: int, height: int) -> DataFrame:
    """The lowest slab with proofs; ``roots`` are the trees' roots with
    ``_slab``, ``_proof``, ``_subroot`` and ``_root``."""
    sent = None
    for k in range(len(slabs) - 1, -1, -1):
        messages = roots.filter(F.col("_slab") == k).select("_tree", F.lit(0).cast("long").alias("_block"), "_proof",
                                                            "_subroot", "_root")
        if sent is not None:
            messages = messages.unionByName(sent)
        below = _downward(slabs[k], messages, fanout, height)
        if k == 0:
            return below
        sent = written(below.select("_tree", F.col("_pos").alias("_block"), "_proof", "_subroot", "_root"), "merkle-proofs")
    raise AssertionError


def manifest(docs: DataFrame, leaf: Column, group: Column, order: Column, keep: dict[str, Column],
             fanout: int = 2, height: int = HEIGHT) -> DataFrame:
    """The columns ``keep`` of every row with ``leaf`` (its digest),
    ``subroot`` (of its group's tree), ``root`` (of all) and ``proof``, an
    array of ``(before, after)``: the siblings' digests left and right of the
    path, level by level up to the root.

    Groups are text and ascend bytewise, NULL first; leaves of a group ascend
    by ``order`` (NULL first), ties by digest, and every repeated row is a leaf
    of its own.  A node alone in its run is hashed alone; a lone leaf is its
    group's subroot and a lone subroot the root.  An empty table gives no rows.
    A name of ``keep`` that is also one of the four outputs is not returned;
    columns not in ``keep`` are ignored, whatever they are called.
    """
    own = ("leaf", "subroot", "root", "proof")
    names = [c for c in keep if c not in own]
    leaves = written(docs.select(F.when(group.isNull(), "").otherwise(F.concat(F.lit("="), group.cast("string"))).alias("_tree"),
                                 order.alias("_order"), leaf.alias("_digest"),
                                 *[keep[c].alias(f"_keep_{c}") for c in names]), "merkle-leaves")
    slabs, roots = _sweep_up(leaves, ["_order", "_digest"], fanout, height)
    roots = written(roots, "merkle-roots")
    above = roots.select(F.lit("").alias("_tree"), F.col("_tree").alias("_name"), "_digest", "_slab")
    upper, top = _sweep_up(above, ["_name"], fanout, height)
    top = top.select("_tree", "_slab", F.lit(None).cast("string").alias("_subroot"), F.col("_digest").alias("_root"),
                     F.array().cast(STEP).alias("_proof"))
    down = _sweep_down(upper, top, fanout, height)
    messages = written(down.select(F.col("_name").alias("_tree"), "_slab", "_proof", F.col("_digest").alias("_subroot"), "_root"),
                       "merkle-messages")
    out = _sweep_down(slabs, messages, fanout, height)
    out = out.select(*[F.col(f"_keep_{c}").alias(c) for c in names], F.col("_digest").alias("leaf"),
                     F.col("_subroot").alias("subroot"), F.col("_root").alias("root"), F.col("_proof").alias("proof"))
    discard(leaves)
    return out


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda d, s: F.sha2(F.concat(s["before"], d, s["after"]), 256))


def proof_digest(proof: Column) -> Column:
    """SHA-256 of all siblings of a proof, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), ""), 256)


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def verified_documents(docs: DataFrame, tampered_share: int = 7) -> DataFrame:
    """The manifest of ``docs`` by lang, and what verification finds when the
    n_chars of every row whose crc32(doc_id) is divisible by
    ``tampered_share`` is one more: ``(doc_id, leaf, subroot, root,
    proof_sha256, folded_root, verified)``.  Rows with a NULL doc_id or
    n_chars are not changed and verify.  Other columns are ignored.
    """
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % tampered_share == 0
    changed = [(F.col("n_chars") + F.when(tampered, 1).otherwise(0)) if c == "n_chars" else F.col(c) for c in FIELDS]
    leaf = leaf_digest([F.col(c) for c in FIELDS])
    listed = manifest(docs, leaf, F.col("lang"), F.col("doc_id"),
                      {"doc_id": F.col("doc_id"), "given": F.when(tampered, leaf_digest(changed)).otherwise(leaf)})
    fold = listed.withColumn("folded_root", folded(F.col("given"), F.col("proof")))
    return fold.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"),
                       "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
