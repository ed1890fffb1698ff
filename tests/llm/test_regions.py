"""Regions of the near-copy join: who meets, and that no link is lost."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from spindle.llm import jaccard


def _bitmap(grams):
    table = next(jaccard._bitmaps([_Batch(grams)]))
    return jaccard._Bitmap(table.column("n")[0].as_py(), table.column("bits")[0].as_py())


class _Batch:
    def __init__(self, grams):
        self.columns = {"rep": pa.array([0], pa.int64()),
                        "grams": pa.array([jaccard._pack(np.sort(np.array(grams, np.uint64)))], pa.binary())}

    def column(self, name):
        return self.columns[name]


@pytest.mark.parametrize("threshold", [0.85, 0.8, 0.4])
def test_bitmaps_hold_no_linked_sets_apart(threshold, monkeypatch):
    monkeypatch.setattr(jaccard, "MAP_BITS", 256)                # larger sets share bits
    draw = random.Random(7)
    new = lambda k: {draw.getrandbits(50) for _ in range(k)}
    sets = []
    for n in (1, 2, 5, 12, 40, 63, 64, 65, 130, 500):
        base = new(n)
        for k in (0, 0, 1, 1, 2, n // 20, n // 12, n // 8, n // 5):
            some = set(draw.sample(sorted(base), n - min(k, n - 1)))
            sets += [some, some | new(k)]
    linked = 0
    sets.sort(key=len)
    maps = [_bitmap(list(s)) for s in sets]
    group = {i: g for g, places in enumerate(jaccard._groups(maps, threshold)) for i in places}
    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) >= threshold * len(a | sets[j]) - 1e-9:
                linked += 1
                assert maps[i].may_link(maps[j], threshold) and maps[j].may_link(maps[i], threshold)
                assert group[i] == group[j]
    assert linked > 100 and len(set(group.values())) > 3


@pytest.fixture()
def largest(monkeypatch):
    """Documents of the largest region of each call of the join."""
    seen = []
    whole = jaccard._region_links

    def watched(regions, *rest):
        seen.append(regions.groupBy("head").agg(F.count(F.lit(1)).alias("c")).agg(F.max("c")).first()[0])
        return whole(regions, *rest)
    monkeypatch.setattr(jaccard, "_region_links", watched)
    return seen


def _pairs_with_passages(spark):
    """Forty pairs of near copies; each pair shares a passage with the pair
    before and one with the pair after it, which links nothing."""
    passage = [" ".join(f"p{k}x{i}" for i in range(20)) for k in range(41)]
    rows = []
    for k in range(40):
        own = " ".join(f"o{k}x{i}" for i in range(60))
        text = f"{passage[k]} {own} {passage[k + 1]}"
        rows += [(2 * k, text), (2 * k + 1, text + " more")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_documents_with_a_common_passage_do_not_meet(spark, largest):
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(_pairs_with_passages(spark)).collect()}
    assert got == {i: i - i % 2 for i in range(80)}
    assert largest == [2]


def test_near_copies_of_the_pipeline_meet_alone(spark, largest):
    kept = corpus_pipeline.drop_near_copies(spark, _pairs_with_passages(spark), "")
    assert sorted(r.doc_id for r in kept.collect()) == list(range(0, 80, 2))
    assert largest == [2]


def test_exact_copies_are_one_document_of_the_second_pass(spark, monkeypatch):
    """Thirty texts three times each, ten of them with a near copy besides."""
    text = [" ".join(f"t{k}x{i}" for i in range(60)) for k in range(30)]
    rows = [(100 * c + k, t.upper() if c == 1 else t) for k, t in enumerate(text) for c in range(3)]
    rows += [(1000 + k, text[k] + " more") for k in range(10)]
    points = []
    whole = jaccard.frequent_grams

    def watched(table, *rest):
        points.append(table.count())
        return whole(table, *rest)
    monkeypatch.setattr(jaccard, "frequent_grams", watched)
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(table).collect()}
    assert got == {i: i % 100 if i < 1000 else i - 1000 for i, _ in rows}
    assert points == [20]
