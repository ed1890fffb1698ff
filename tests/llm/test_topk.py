"""The threshold algorithm: rows read, scores carried over blocks, whole results."""

import numpy as np
import pytest

from spindle.llm import topk


def _sparse(n, seed=3):
    rng, x = np.random.default_rng(seed), np.zeros((n, 64))
    for i in range(n):
        x[i, rng.choice(64, 4, replace=False)] = np.minimum(rng.pareto(1.2, 4) * 4, 900).astype(int) / 64
    return x


def _want(x, q, k):
    score = np.floor(64 * x) @ np.floor(64 * x[q])
    return [(i, int(score[i])) for i in np.lexsort((np.arange(len(x)), -score)) if i != q][:k]


def test_few_rows_are_read_where_the_bound_can_stop():
    x, ids = np.floor(64 * _sparse(4000)), np.arange(4000)
    lists = np.argsort(x, axis=0, kind="stable").T.astype(np.uint32)
    read = warm = 0
    for q in range(0, 4000, 100):
        hit, score, rows = topk.threshold_search(x, ids, lists, x[q], q, 20)
        assert [(int(ids[i]), int(score[i])) for i in hit] == _want(x / 64, q, 20)
        floor = score[hit[-1]]
        again, _, fewer = topk.threshold_search(x, ids, lists, x[q], q, 20, floor)
        assert again.tolist() == hit.tolist() and fewer <= rows
        none, _, least = topk.threshold_search(x, ids, lists, x[q], q, 20, floor=float(x[q] @ x.max(axis=0)) + 1)
        assert not len(none) and least <= 64 * topk.DEPTH
        read, warm = read + rows, warm + least
    assert read < 0.25 * 40 * 4000 and warm < 0.02 * 40 * 4000


@pytest.mark.parametrize("negative", [False, True])
def test_many_blocks_and_chunks(spark, monkeypatch, negative):
    monkeypatch.setattr(topk, "BLOCK", 150)
    monkeypatch.setattr(topk, "CHUNK", 16)
    x = _sparse(1000, 5)
    x[::7] = x[0]                                             # ties
    if negative:
        x[:, ::2] *= -1
        x[1::5] = np.random.default_rng(1).normal(size=(200, 64)) / 8
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in topk.top_inner_products(table).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == {q: _want(x, q, 20) for q in range(0, 1000, 20)}


def test_empty_block_and_large_scores():
    hit, _, rows = topk.threshold_search(np.zeros((0, 2)), np.zeros(0, np.int64), np.zeros((2, 0), np.uint32), np.ones(2), 1, 5)
    assert not len(hit) and rows == 0
    assert topk._at_most(1543) == 1543.0 and all(topk._at_most(2 ** 60 + d) <= 2 ** 60 + d for d in (-1, 0, 1, 127))
