"""The Merkle manifest against a plain recomputation: several slabs, other
fan-outs, NULLs, repeated rows, one row, no rows, clashing columns."""

import hashlib
import zlib
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from spindle.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, root int, _pos int"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def encoded(row):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)


def tree(leaves, fanout):
    """Root and, for every leaf, its steps ``(before, after)``."""
    steps, where, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        for i, at in enumerate(where):
            run = at // fanout * fanout
            steps[i].append(("".join(level[run:at]), "".join(level[at + 1:run + fanout])))
        where = [at // fanout for at in where]
        level = [sha(*level[k:k + fanout]) for k in range(0, len(level), fanout)]
    return level[0], steps


def expected(rows, fanout):
    key = lambda r: (r[2] is not None, (r[2] or "").encode())
    groups = [sorted(g, key=lambda r: (r[0] is not None, r[0] or 0, sha(encoded(r))))
              for _, g in groupby(sorted(rows, key=key), key)]
    subs = [tree([sha(encoded(r)) for r in g], fanout) for g in groups]
    root, above = tree([s[0] for s in subs], fanout)
    return sorted((str(r[0]), sha(encoded(r)), s[0], root, tuple(s[1][i] + above[k]))
                  for k, (g, s) in enumerate(zip(groups, subs)) for i, r in enumerate(g))


def rows():
    out = [(i, f"src{i % 3}", ["en", "de", "é", None][min(3, i % 7)], i, f"text {i} ñ") for i in range(40)]
    return out + [(5, None, "en", None, None)] * 9 + [(None, "s", "en", 1, ""), (7, "s", "only", 3, "x" * 70_000)]


def got(frame):
    return sorted((str(r.doc_id), r.leaf, r.subroot, r.root, tuple((s.before, s.after) for s in r.proof)) for r in frame.collect())


def listed(table, **options):
    return merkle.manifest(table, merkle.leaf_digest([F.col(c) for c in merkle.FIELDS]), F.col("lang"), F.col("doc_id"),
                           {"doc_id": F.col("doc_id")}, **options)


@pytest.mark.parametrize("fanout,height", [(2, 10), (2, 2), (3, 1)])
def test_proofs_over_slabs(spark, fanout, height):
    table = spark.createDataFrame([(*r, "mine", 1, 1) for r in rows()], SCHEMA).repartition(5)
    out = listed(table, fanout=fanout, height=height)
    assert got(out) == expected(rows(), fanout)
    assert out.filter(merkle.folded(F.col("leaf"), F.col("proof")) != F.col("root")).count() == 0


def test_one_row_and_none(spark):
    one = spark.createDataFrame([(1, "s", None, 3, "a", "x", 0, 0)], SCHEMA)
    assert got(listed(one)) == [("1", sha(encoded((1, "s", None, 3, "a"))),) + (sha(encoded((1, "s", None, 3, "a"))),) * 2 + ((),)]
    empty = merkle.verified_documents(one.filter("false"))
    assert empty.count() == 0 and empty.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_tampered_rows_are_found(spark):
    table = spark.createDataFrame([(*r, "mine", 1, 1) for r in rows()], SCHEMA)
    out = merkle.verified_documents(table).collect()
    assert len(out) == len(rows())
    null = sha(encoded((5, None, "en", None, None)))
    for r in out:
        changed = r.doc_id is not None and r.leaf != null and zlib.crc32(str(r.doc_id).encode()) % 7 == 0
        assert r.verified == (not changed) == (r.folded_root == r.root)
