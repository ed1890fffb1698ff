"""Exact top-k by inner product with Fagin's threshold algorithm.

Candidates lie in blocks of about ``BLOCK`` rows.  For every block a written
table holds, for each dimension, the block's rows sorted by their component.  A
query reads all lists at once, downwards where its component is positive and
upwards where it is negative, deeper by steps; rows seen for the first time
are scored in full.  No unseen row can score more than the threshold, the
sum of the query's components times the last values read, so the query
stops as soon as its k-th score is above the threshold (equal scores might
still win by a smaller id) or all rows are seen.  Blocks meet query chunks by
an equi-join: each chunk one block first, whose k-th scores every other block
starts from, so that a block whose bound lies below reads a few steps only.
Each query's best over all blocks are ranked.

How early the bound stops depends on the vectors.  A query of few heavy
components reads few rows; vectors spread evenly over many dimensions have
every row near the top of some list, so that all rows are seen (README).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.llm.base import written
from spindle.llm.vectors import matrix, ranked, valid_vectors

#: Rows of a block (list positions fit 16 bits) and of a chunk of queries.
BLOCK, CHUNK = 8192, 1024
#: Depth that a list is first read to, and its growth from step to step.
DEPTH, DEEPER = 8, 2


def _packed(width: int, scale: float, lists: bool):
    def run(table: pa.Table) -> pa.Table:
        key = table.column_names[0]
        ids = np.asarray(table.column("vec_id"))
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], np.floor(scale * matrix(table.column("v"), width))[order]
        row = {key: table.column(key)[0].as_py(), f"{key}_ids": ids.tobytes(), f"{key}_values": x.tobytes()}
        types = [(key, pa.int32()), (f"{key}_ids", pa.binary()), (f"{key}_values", pa.binary())]
        if lists:
            sort = np.argsort(x, axis=0, kind="stable").T.astype(np.uint32)
            row["lists"] = np.ascontiguousarray(sort).tobytes()
            types.append(("lists", pa.binary()))
        return pa.Table.from_pylist([row], schema=pa.schema(types))
    return run


def threshold_search(x: np.ndarray, ids: np.ndarray, lists: np.ndarray, q: np.ndarray, own: int, k: int,
                     floor: float = -np.inf):
    """``(rows, scores, rows read)``: the rows of a block that may be among
    the k best of query ``q`` (its own id aside), given that k rows elsewhere
    score ``floor`` or more; exactly the block's k best of at least ``floor``,
    ties by id.  Only the scores of rows read are filled in."""
    n, (up, down) = len(x), (np.flatnonzero(q < 0), np.flatnonzero(q > 0))
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, x.dtype), 0
    score, seen, done = np.zeros(n, x.dtype), np.zeros(n, bool), np.zeros(n, bool)
    other = ids != own
    depth, last = 0, min(DEPTH, n)
    while True:
        seen[lists[down, n - last:n - depth].ravel()] = True
        seen[lists[up, depth:last].ravel()] = True
        if not len(up) and not len(down):
            seen[:] = True
        new = np.flatnonzero(seen & ~done)
        if len(new) > n // 2:                        # most rows are new: one product over the block
            score = x @ q
        else:
            score[new] = x[new] @ q
        done |= seen
        hit, whole = np.flatnonzero(done & other), done.all()
        kth = np.partition(score[hit], len(hit) - k)[len(hit) - k] if len(hit) >= k else -np.inf
        least = max(kth, floor)
        bound = (q[down] * x[lists[down, n - last], down]).sum() + (q[up] * x[lists[up, last - 1], up]).sum()
        if whole or least > bound:
            hit = hit[score[hit] >= least]
            return hit[np.lexsort((ids[hit], -score[hit]))[:k]], score, int(done.sum())
        depth, last = last, min(n, last * DEEPER)


def _searched(row: dict, width: int, k: int):
    """A block and a chunk of queries -> for each query its id, the rows found
    and their scores."""
    ids, own = np.frombuffer(row["block_ids"], np.int64), np.frombuffer(row["chunk_ids"], np.int64)
    x = np.frombuffer(row["block_values"], float).reshape(-1, width)
    queries = np.frombuffer(row["chunk_values"], float).reshape(-1, width)
    lists = np.frombuffer(row["lists"], np.uint32).reshape(width, -1)
    floors = np.frombuffer(row["floors"], float) if row.get("floors") else np.full(len(own), -np.inf)
    most = max(np.abs(x).max(initial=0), np.abs(queries).max(initial=0))
    if most * most * width < 1 << 24:        # sums of whole numbers stay exact in single precision
        x, queries = x.astype(np.float32), queries.astype(np.float32)
    elif most * most * width >= 1 << 53:
        x, queries = x.astype(np.int64), queries.astype(np.int64)
    for q, me, floor in zip(queries, own, floors):
        hit, score, _ = threshold_search(x, ids, lists, q, me, k, floor)
        yield me, ids[hit], score[hit].astype(np.int64)


_HITS = pa.list_(pa.struct([(c, pa.int64()) for c in ("query_id", "vec_id", "score")]))


def _at_most(score: int) -> float:
    """The score as a double, never above it."""
    return float(score) if abs(score) < 1 << 53 else float(np.nextafter(float(score), -np.inf))


def _first(width: int, k: int):
    """Chunks, each with one block -> the chunks with each query's k-th score
    there (``floors``) and the rows found (``hits``, k for each query at most)."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                if row["lists"] is None:                 # a block without rows
                    row.update(block_ids=b"", block_values=b"", lists=b"")
                floors, hits = [], []
                for me, found, score in _searched(row, width, k):
                    floors.append(_at_most(int(score[-1])) if len(score) == k else -np.inf)
                    hits += [{"query_id": me, "vec_id": v, "score": s} for v, s in zip(found.tolist(), score.tolist())]
                yield pa.RecordBatch.from_pylist(
                    [{**{c: row[c] for c in ("chunk", "chunk_ids", "chunk_values")}, "floors": np.array(floors).tobytes(),
                      "hits": hits}], schema=pa.schema([("chunk", pa.int32())] + [(c, pa.binary()) for c in (
                          "chunk_ids", "chunk_values", "floors")] + [("hits", _HITS)]))
    return run


def _search(width: int, k: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                found = [(np.full(len(i), me), i, s) for me, i, s in _searched(row, width, k)]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*found)],
                                                 names=["query_id", "vec_id", "score"])
    return run


def top_inner_products(table: DataFrame, k: int = 20, every: int = 20, scale: float = 64.0, id_col: str = "vec_id",
                       vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row whose id is divisible
    by ``every``, the k rows of other ids with the largest inner product of
    ``floor(scale * x)``, ties to the smaller id.

    Rows with a NULL id or vector, an empty vector or a component that is NULL
    or not finite take no part.  Shorter vectors count as filled with zeros;
    repeated rows count once.  Other columns are ignored; an empty table gives
    no rows, a table with fewer rows than k all of them.
    """
    rows = written(valid_vectors(table, id_col, vector_col), "topk-rows")
    queries = rows.filter(F.col("vec_id") % every == 0)
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("w"),
                    F.count_if(F.col("vec_id") % every == 0).alias("q")).first()
    blocks, chunks, width = -(-size["n"] // BLOCK) or 1, -(-size["q"] // CHUNK) or 1, size["w"] or 1
    part = lambda n: F.pmod(F.xxhash64("vec_id", "v"), F.lit(n)).cast("int")      # noqa: E731
    lists = written(rows.select(part(blocks).alias("block"), "vec_id", "v").groupBy("block").applyInArrow(
        _packed(width, scale, True), "block int, block_ids binary, block_values binary, lists binary"), "topk-lists")
    asked = queries.select(part(chunks).alias("chunk"), "vec_id", "v").groupBy("chunk").applyInArrow(
        _packed(width, scale, False), "chunk int, chunk_ids binary, chunk_values binary")
    begin = asked.withColumn("block", F.col("chunk") % blocks).join(lists, "block", "left")
    begin = begin.repartition(chunks, "chunk") if chunks > 1 else begin
    first = written(begin.mapInArrow(_first(width, k), "chunk int, chunk_ids binary, chunk_values binary, floors binary, "
                                     "hits array<struct<query_id:long,vec_id:long,score:long>>"), "topk-first")
    pairs = (lists.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
             .filter(F.col("chunk") % blocks != F.col("block")).join(first.drop("hits"), "chunk"))
    pairs = pairs.repartition(blocks * chunks, "block", "chunk") if blocks * chunks > 1 else pairs
    rest = pairs.mapInArrow(_search(width, k), "query_id long, vec_id long, score long")
    return ranked(first.select(F.inline("hits")).unionByName(rest), k)
