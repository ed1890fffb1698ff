"""Approximate nearest neighbours by inner product in balanced posting lists.

* Vectors get one more component, so that all have the length of the longest:
  the largest inner product is then the smallest distance.
* Centroids come from a balanced k-means (full clusters repel) over a bounded
  sample; there are as many as the table needs, up to ``MAX_LISTS`` and an
  eighth of the sample (2500 of a full one): beyond that, lists grow longer.
* Every vector is posted to its nearest centroid, and to each further one
  (``COPIES`` at most) whose distance is within ``BOUNDARY`` of that: boundary
  vectors are found from either side.
* Queries search the centroids on an in-memory graph (each linked to its
  nearest others), best first, and keep the lists whose distance is within
  ``PRUNE`` times that of the nearest.
* Lists are put in an order in which neighbours follow each other (centroids
  halved along their widest direction) and packed into shards of at most
  ``SHARD`` postings; a longer list has shards of its own.  A query goes to the
  shards of its lists only, reads its lists there, and its best of all shards
  are ranked.  Scores are inner products of the original vectors.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.llm.base import buckets, mix64, received, shared, written
from spindle.llm.vectors import matrix, ranked, valid_vectors

#: Vectors the centroids are fitted on; vectors of a list; most lists; postings of a shard.
SAMPLE, LIST, MAX_LISTS, SHARD = 20_000, 200, 4096, 8192
#: Most lists of a vector and their distance ratio; distance ratio of a query's lists.
COPIES, BOUNDARY, PRUNE = 3, 1.04, 1.16
#: Queries that one task routes.
ROUTED = 256
#: Links of a centroid and centroids kept in the search.
LINKS, BEAM = 16, 256


def balanced_centroids(x: np.ndarray, lists: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """k-means in which a centroid's distance grows with its share of rows."""
    rng = np.random.default_rng(seed)
    c = x[rng.permutation(len(x))[:lists]].copy()
    weight = np.zeros(len(c))
    for _ in range(rounds):
        d = (c * c).sum(1) - 2 * x @ c.T + weight
        own = d.argmin(1)
        size = np.bincount(own, minlength=len(c))
        spread = np.abs(d.min(1) + (x * x).sum(1)).mean()
        weight += 0.05 * spread * (size / max(len(x) / len(c), 1) - 1)
        for i in np.flatnonzero(size):
            c[i] = x[own == i].mean(0)
    return c


class Graph:
    """Centroids linked to their nearest others and to a few far ones."""

    def __init__(self, c: np.ndarray, seed: int = 7):
        self.c, n = c, len(c)
        d = (c * c).sum(1) - 2 * c @ c.T
        near = np.argsort(d, axis=1, kind="stable")[:, 1:LINKS + 1]
        far = np.random.default_rng(seed).integers(0, n, (n, 2))
        self.links = [np.unique(np.concatenate([a, b])) for a, b in zip(near, far)]
        for i, row in enumerate(near):
            for j in row:
                self.links[j] = np.union1d(self.links[j], [i])

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """About the ``beam`` nearest centroids and their distances, nearest first."""
        seen = np.zeros(len(self.c), bool)
        seen[0] = True
        start = float(((self.c[0] - q) ** 2).sum())
        queue, best = [(start, 0)], [(-start, 0)]
        while queue:
            d, i = heapq.heappop(queue)
            if len(best) >= beam and d > -best[0][0]:
                break
            new = self.links[i][~seen[self.links[i]]]
            seen[new] = True
            for e, j in zip(((self.c[new] - q) ** 2).sum(1).tolist(), new.tolist()):
                if len(best) < beam or e < -best[0][0]:
                    heapq.heappush(queue, (e, j))
                    heapq.heappush(best, (-e, j))
                    if len(best) > beam:
                        heapq.heappop(best)
        order = sorted((-d, i) for d, i in best)
        return np.array([i for _, i in order]), np.sqrt(np.maximum([d for d, _ in order], 0))


def list_order(c: np.ndarray) -> np.ndarray:
    """Centroids in an order that halves them along their widest direction, again and again."""
    def halve(at: np.ndarray) -> list[np.ndarray]:
        if len(at) < 3:
            return [at]
        x = c[at] - c[at].mean(0)
        along = x @ np.linalg.eigh(x.T @ x)[1][:, -1]
        at = at[np.argsort(along, kind="stable")]
        return halve(at[:len(at) // 2]) + halve(at[len(at) // 2:])
    return np.concatenate(halve(np.arange(len(c))))


def shard_plan(order: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First shard and number of shards of each list, for lists of ``sizes``
    postings taken in ``order``: whole lists share a shard up to ``SHARD``
    postings, a longer one is cut over shards of its own."""
    first, parts = np.zeros(len(sizes), np.int64), np.maximum(-(-sizes // SHARD), 1)
    shard, used = 0, 0
    for a in order.tolist():
        if used and used + sizes[a] > SHARD:
            shard, used = shard + 1, 0
        first[a], used = shard, used + sizes[a]
        if parts[a] > 1:
            shard, used = shard + int(parts[a]), 0
    return first, parts


def _lifted(x: np.ndarray, length: float) -> np.ndarray:
    """Vectors with the component that gives all of them one length."""
    rest = np.sqrt(np.maximum(length ** 2 - (x * x).sum(1), 0))
    return np.concatenate([x, rest[:, None]], axis=1)


def _post(model, width: int, length: float, plan=None):
    """Vectors -> their postings; with a plan of shards those of each, else the lists alone."""
    def run(batches):
        c, _ = received(model)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _lifted(matrix(batch.column("v"), width), length)
            d = np.sqrt(np.maximum((x * x).sum(1)[:, None] + (c * c).sum(1) - 2 * x @ c.T, 0))
            near = np.argsort(d, axis=1, kind="stable")[:, :COPIES]
            dist = np.take_along_axis(d, near, 1)
            row, col = np.nonzero((dist <= BOUNDARY * dist[:, :1]) | (np.arange(near.shape[1]) == 0))
            lists = near[row, col]
            if plan is None:
                found, times = np.unique(lists, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(times.astype(np.int64))],
                                                 names=["list", "n"])
                continue
            first, parts = plan
            part = mix64(np.asarray(batch.column("vec_id")).view(np.uint64))[row] % parts[lists].astype(np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array((first[lists] + part.astype(np.int64)).astype(np.int32)), pa.array(lists.astype(np.int32)),
                 batch.column("vec_id").take(pa.array(row)), batch.column("v").take(pa.array(row))],
                names=["shard", "list", "vec_id", "v"])
    return run


def _route(model, width: int, length: float, plan):
    """Queries -> one row for each shard that holds some of their lists."""
    def run(batches):
        c, graph = received(model)
        first, parts = plan
        for batch in batches:
            x = matrix(batch.column("v"), width)
            x = np.concatenate([x / np.maximum(np.linalg.norm(x, axis=1), 1e-300)[:, None] * length, np.zeros((len(x), 1))], 1)
            row, shard, lists = [], [], []
            for i, q in enumerate(x):
                near, d = graph.search(q, min(BEAM, len(c)))
                near = near[(d <= PRUNE * d[0]) | (np.arange(len(d)) == 0)]
                of = np.repeat(near, parts[near])
                at = np.concatenate([np.arange(f, f + n) for f, n in zip(first[near], parts[near])])
                for s in np.unique(at):
                    row.append(i)
                    shard.append(s)
                    lists.append(of[at == s].astype(np.int32))
            row = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int32()), batch.column("vec_id").take(row), batch.column("v").take(row),
                 pa.array(lists, pa.list_(pa.int32()))], names=["shard", "query_id", "q", "lists"])
    return run


def _search(width: int, k: int):
    schema = {"query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}

    def run(posted: pa.Table, asked: pa.Table) -> pa.Table:
        empty = pa.table({c: pa.array([], t) for c, t in schema.items()})
        if not posted.num_rows or not asked.num_rows:
            return empty
        lists, ids = np.asarray(posted.column("list")), np.asarray(posted.column("vec_id"))
        order = np.argsort(lists, kind="stable")
        lists, ids, x = lists[order], ids[order], matrix(posted.column("v"), width)[order]
        first = {a: (int(np.searchsorted(lists, a)), int(np.searchsorted(lists, a, "right"))) for a in np.unique(lists).tolist()}
        out = [[], [], []]
        queries = matrix(asked.column("q"), width)
        for me, q, wanted in zip(asked.column("query_id").to_pylist(), queries, asked.column("lists").to_pylist()):
            spans = [first[a] for a in wanted if a in first]
            if not spans:
                continue
            at = np.concatenate([np.arange(a, b) for a, b in spans])
            at = at[ids[at] != me]
            if not len(at):
                continue
            rough = x[at] @ q
            if len(at) > COPIES * k:                       # a vector may be there COPIES times
                least = np.partition(rough, len(at) - COPIES * k)[len(at) - COPIES * k]
                at = at[rough >= least - 1e-9 * max(1.0, abs(least))]
            score = (x[at] * q).sum(axis=1)
            pick = np.lexsort((ids[at], -score))
            _, one = np.unique(ids[at][pick], return_index=True)
            pick = pick[np.sort(one)][:k]
            for col, part in zip(out, (np.full(len(pick), me), ids[at][pick], score[pick])):
                col.append(part)
        if not out[0]:
            return empty
        return pa.table({c: pa.array(np.concatenate(o), t) for (c, t), o in zip(schema.items(), out)})
    return run


def nearest_vectors(table: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id",
                    vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row whose id is divisible
    by ``every``, the k rows of other ids found with the largest inner
    product, ties to the smaller id.

    Rows with a NULL id, a NULL, empty or zero vector or a component that is
    NULL or not finite take no part.  Shorter vectors count as filled with
    zeros; repeated rows count once, as does an id with several vectors among a query's
    results (its best).  Other columns are ignored; an empty table gives no
    rows.  A table of at most ``LIST`` rows is one list, so all are found.
    """
    spark = table.sparkSession
    rows = valid_vectors(table, id_col, vector_col).withColumn(
        "norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).filter("norm > 0")
    rows = written(rows, "ann-rows")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("w"), F.max("norm").alias("length"),
                    F.count_if(F.col("vec_id") % every == 0).alias("q")).first()
    n, width, length = size["n"], size["w"] or 1, size["length"] or 1.0
    sample = rows.select("v").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()     # SAMPLE rows at most
    x = _lifted(matrix(sample.column("v"), width), length)
    centroids = balanced_centroids(x, max(1, min(MAX_LISTS, n // LIST, len(x) // 8))) if n else np.zeros((1, width + 1))
    model = shared(spark, (centroids, Graph(centroids)))
    sizes = np.zeros(len(centroids), np.int64)                       # a row for each list, MAX_LISTS at most
    for r in rows.mapInArrow(_post(model, width, length), "list int, n long").groupBy("list").agg(F.sum("n")).collect():
        sizes[r[0]] = r[1]
    plan = shard_plan(list_order(centroids), sizes)
    posted = rows.mapInArrow(_post(model, width, length, plan), "shard int, list int, vec_id long, v array<double>")
    tasks = max(1, min(buckets(spark), -(-size["q"] // ROUTED)))
    asked = rows.filter(F.col("vec_id") % every == 0).repartition(tasks, "vec_id").mapInArrow(
        _route(model, width, length, plan), "shard int, query_id long, q array<double>, lists array<int>")
    found = posted.groupBy("shard").cogroup(asked.groupBy("shard")).applyInArrow(
        _search(width, k), "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return ranked(best, k)
