"""Posting lists: packing into shards, routing, recall on clustered vectors and the share of rows read."""

import numpy as np

from spindle.llm import ann


def test_plan_covers_every_list():
    rng = np.random.default_rng(2)
    c, sizes = rng.normal(size=(300, 8)), rng.integers(0, 900, 300)
    sizes[17] = 5 * ann.SHARD + 3                          # a hot list
    order = ann.list_order(c)
    assert sorted(order.tolist()) == list(range(300))
    first, parts = ann.shard_plan(order, sizes)
    assert parts[17] == 6 and (np.delete(parts, 17) == 1).all()
    load = np.zeros(int((first + parts).max()), np.int64)
    for a in range(300):
        load[first[a]:first[a] + parts[a]] += -(-sizes[a] // parts[a])
    assert load.max() <= ann.SHARD and len(load) <= 2 * sizes.sum() / ann.SHARD + 3
    assert not set(range(first[17], first[17] + 6)) & set(np.delete(first, 17).tolist())


def test_recall_and_rows_read_on_clusters(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD", 1500)
    rng = np.random.default_rng(4)
    heart = rng.normal(size=(80, 32))
    x = heart[rng.integers(0, 80, 20_000)] + 0.35 * rng.normal(size=(20_000, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[3000:6000] = x[3000]                                 # equal vectors: a hot list
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got: dict = {}
    for r in ann.nearest_vectors(table).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    hits = []
    for q in range(0, 20_000, 20):
        s = x @ x[q]
        s[q] = -9
        assert len(got[q]) == 20 and len({i for i, _ in got[q]}) == 20 and q not in {i for i, _ in got[q]}
        assert all(abs(v - s[i]) < 1e-12 for i, v in got[q])
        hits.append(sum(v >= np.sort(s)[-20] - 1e-12 for _, v in got[q]) / 20)
    assert np.mean(hits) >= 0.95 and np.mean(np.array(hits) >= 0.9) >= 0.9
    # share of rows in the lists of a query, with the operator's own centroids and pruning
    lifted = ann._lifted(x, 1.0 + 1e-12)
    c = ann.balanced_centroids(lifted, 100)
    own, graph, share = ((c * c).sum(1) - 2 * lifted @ c.T).argmin(1), ann.Graph(c), []
    for q in range(0, 20_000, 200):
        near, d = graph.search(lifted[q], min(ann.BEAM, len(c)))
        share.append(np.isin(own, near[d <= ann.PRUNE * d[0]]).mean())
    assert np.mean(share) < 0.5
