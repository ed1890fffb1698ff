"""Katz scores against a plain model that holds every n-gram in dictionaries."""

import zlib
from collections import Counter

import numpy as np
import pytest

from spindle.llm import katz
from tests.conftest import SMALL

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _words(text):
    return (text or "").translate(LOWER).encode().split()


class Plain:
    def __init__(self, texts, order):
        self.c = [Counter() for _ in range(order)]
        for text in texts:
            seq = [b"<b>"] * (order - 1) + [*_words(text), b"<e>"]
            for i in range(order - 1, len(seq)):
                for k in range(order):
                    self.c[k][tuple(seq[i - k:i + 1])] += 1
        self.order, self.begins = order, len(texts)
        self.d = []
        for c in self.c:
            kinds = Counter(c.values())
            self.d.append(katz.discounts(list(kinds.values()), at=list(kinds)))
        self.n = sum(self.c[0].values())
        words = self.c[0]
        self.base = self.n + 0.1 * (len(words) + 1)
        self.unseen = min(max(sum(x == 1 for x in words.values()) / self.n, 0.1 / self.base), 0.5)
        self.mass = sum(self.star(0, x) for x in words.values())
        self.after = {}
        for k in range(1, order):
            for g in self.c[k]:
                self.after.setdefault(g[:-1], []).append(g)
        self.weight = {}

    def star(self, k, x):
        return x * (self.d[k][x] if x < len(self.d[k]) else 1.0)

    def p(self, g):
        k = len(g) - 1
        if k == 0:
            return self.star(0, self.c[0][g]) * (1 - self.unseen) / self.mass if self.c[0][g] else self.unseen
        h = g[:-1]
        if h not in self.after:
            return self.p(g[1:])
        if h not in self.weight:
            total = sum(self.c[k][x] for x in self.after[h])
            seen = sum(self.star(k, self.c[k][x]) for x in self.after[h])
            keep, room = min(seen / total, 1 - 0.5 / (total + 1)), 1 - sum(self.p(x[1:]) for x in self.after[h])
            self.weight[h] = (1 / seen, 0.0) if room <= 1e-12 else (keep / seen, (1 - keep) / room)
        own, alpha = self.weight[h]
        return self.star(k, self.c[k][g]) * own if self.c[k][g] else alpha * self.p(g[1:])

    def score(self, text):
        seq = [b"<b>"] * (self.order - 1) + [*_words(text), b"<e>"]
        at = range(self.order - 1, len(seq))
        return (sum(np.log10(self.p(tuple(seq[i - self.order + 1:i + 1]))) for i in at),
                sum(np.log10((self.c[0][(seq[i],)] + 0.1) / self.base) for i in at),
                sum(self.c[0][(seq[i],)] > 0 for i in at))


def _train(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 10 != 0


def _compare(rows, got, order):
    model = Plain([t for i, t in rows if _train(i)], order)
    want = sorted((-1 if i is None else i, not _train(i), len(_words(t)) + 1, model.score(t)[2], model.n,
                   *model.score(t)[1::-1]) for i, t in rows)
    have = sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score,
                   r.score) for r in got)
    assert len(have) == len(want)
    for a, b in zip(have, want):
        assert a[:5] == b[:5] and np.allclose(a[5:], b[5:], rtol=1e-9, atol=1e-9)
    return model


ODD = [(None, "x y z"), (3, None), (4, ""), (5, "Only once HERE"), (6, "a b a b a b"), (6, "a b a b a b"), (7, "b a"),
       (9, "été É a"), (10, " \t "), (11, "a " * 300)]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_of_small_texts(spark, monkeypatch, order):
    monkeypatch.setattr(katz, "CHUNK_TOKENS", 7)          # many chunks, so that grams and contexts are shared
    rows = ODD + [(i, " ".join(f"w{(i * j * j + j) % 23}" for j in range(i % 9))) for i in range(20, 120)]
    table = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, train string")
    model = _compare(rows, katz.katz_scores(table, order=order).collect(), order)
    words = [g for g in model.c[0]]
    for h in list(model.after)[:200]:                     # exactly normalised, the unseen word included
        assert abs(sum(model.p((*h, *w)) for w in words) + model.p((*h, b"never seen")) - 1) < 1e-9


@pytest.mark.parametrize("order", [2, 3])
def test_scores_of_whole_documents(spark, order):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    _compare([tuple(r) for r in docs.collect()], katz.katz_scores(docs, order=order).collect(), order)


def test_rare_words_keep_their_own_contexts(spark):
    # two rare words with different followers: one class of rare words would give both the same continuation
    train = [i for i in range(1, 4000) if _train(i)][:600]
    held = [i for i in range(5000, 9000) if not _train(i)][:2]
    rows = [(i, f"k{n} rare{n % 200} {'left' if n % 2 else 'right'}") for n, i in enumerate(train)]
    rows += [(held[0], "rare1 left"), (held[1], "rare1 right")]
    got = {r.doc_id: r.score for r in katz.katz_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[held[0]] > got[held[1]] + 0.3


def test_tables_without_training_rows_and_empty(spark):
    held = [i for i in range(1, 500) if not _train(i)][:3]
    rows = spark.createDataFrame([(i, "a b") for i in held], "doc_id long, text string")
    got = katz.katz_scores(rows).collect()
    assert [r.train_tokens for r in got] == [0, 0, 0] and all(np.isfinite(r.score) and r.n_known == 0 for r in got)
    assert katz.katz_scores(rows.limit(0)).count() == 0
