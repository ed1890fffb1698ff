"""Exact Jaccard join of word n-gram sets as a metric-space join.

Distance is 1 - |x & y| / |x | y|, a metric; documents link within
``eps = 1 - threshold``.  All pivots live in the same space:

1.  *Pruning.*  A document that links to anything shares at least
    ``threshold`` of its n-grams.  In any fixed order of n-grams (here: by
    hash), two linked documents also share many of the n-grams that come
    first in each (the prefix lemma).  Each part of the input sends the
    first n-grams of its documents to key ranges, which answer how many of
    them occur in another document; documents with too few leave.  A second
    pass uses whole sets, one document of each distinct set that is left.
2.  *Outer regions.*  Sets of one n-gram are the first pivots.  The cell of
    pivot {g} holds the documents for which g is among the n-grams that can
    be the first shared one; a document near several cells is replicated to
    each.  Cells of the same documents are one.  Bitmaps of the sets bound
    from above what two documents share; a cell falls apart into groups
    between which no pair can link, so that documents with a common n-gram
    by chance don't meet.  A group is merged into the region of its smallest
    document, and that document's own groups with it, so that copies meet
    once or twice.
3.  *Inner regions.*  A region joins recursively: pivots are documents of the
    region, each document goes to its nearest pivot's cell, and to the cell
    of each pivot that is at most ``2 * eps`` farther (the triangle
    inequality: partners cannot be farther).  Documents within ``eps`` of one
    pivot are linked by it and need no pairs of their own.  A region over
    ``region_limit`` documents is cut over several tasks in the same way.

Links become connected components.  Documents with equal sets are one point
of the space and are joined by a group-by.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.llm.base import (buckets, components, hashed_words, key_bucket, mix64, received, runs, shared, small_batches,
                              written)

#: Documents of one batch, as bits of a packed key; n-grams have the other 50.
DOC_BITS = 14
GRAM_BITS = 64 - DOC_BITS
#: Part of a set, beyond what the threshold leaves free, that the first pruning compares.
SLACK = 0.08
#: N-grams of fewer documents than this count as equally rare; at most so many are told apart (16 bytes each, broadcast).
FREQUENT_LEAST, FREQUENT_MOST = 8, 200_000
#: Documents of a region that one task joins; larger regions are cut over several tasks.
REGION_LIMIT = 4096
#: Bits of a set's bitmap at most; a larger set is only held apart less well.
MAP_BITS = 1 << 15
#: Documents of a cell that one task compares by bitmaps, times the region limit; a larger cell stays whole.
CELL_LIMIT = 4
#: Rows of cells that one task gets, about.
CELL_ROWS = 50_000
#: Survivors up to this many ids (8 bytes each) are broadcast to the scan; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: The same for the sets that are left (40 bytes each).
BROADCAST_SETS = 250_000


def ngram_keys(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of each row as sorted packed keys ``row << 50 | gram``
    and their number by row.  A row with fewer words has one gram, the whole
    sequence; a row without words has none."""
    h, counts = hashed_words(column)
    rows = len(counts)
    if rows > 1 << DOC_BITS:
        raise ValueError("a batch holds too many rows for the packed keys")
    row = np.repeat(np.arange(rows), counts)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]]) if rows else np.zeros(0, np.int64)
    at = np.arange(len(h)) - np.repeat(first, counts)
    whole = at + words <= np.repeat(counts, counts)             # a full n-gram starts here
    start = np.flatnonzero(whole | ((at == 0) & (np.repeat(counts, counts) < words)))
    left = np.minimum(np.repeat(counts, counts)[start] - at[start], words)
    gram = np.zeros(len(start), np.uint64)
    for k in range(words):
        take = start[k < left] + k
        gram[k < left] = mix64(gram[k < left] * np.uint64(0x9E3779B97F4A7C15) + h[take] + np.uint64(k + 1))
    keys = (row[start].astype(np.uint64) << np.uint64(GRAM_BITS)) | (gram >> np.uint64(DOC_BITS))
    keys.sort()
    keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys
    return keys, np.bincount((keys >> np.uint64(GRAM_BITS)).astype(np.int64), minlength=rows)


def _least(n: np.ndarray, share: float) -> np.ndarray:
    """Smallest integer not below ``share * n``, free of rounding error."""
    return np.ceil(n * share - 1e-9).astype(np.int64)


def _requests(words: int, threshold: float, slack: float, parts: int):
    """Batches of documents -> one row for each key range: the documents, how
    many of their n-grams in this range are known to be shared within the
    batch, and the other n-grams with their single owner."""
    schema = pa.schema([("bucket", pa.int32()), ("home", pa.binary()), ("doc_id", pa.binary()),
                        ("gram", pa.binary()), ("owner", pa.binary())])

    def run(batches):
        for batch in small_batches(batches):
            keys, n = ngram_keys(batch.column("text"), words)
            ids = np.asarray(batch.column("doc_id").cast(pa.int64()))
            free = n - _least(n, threshold)                    # n-grams that a partner may lack
            extra = np.floor(slack * n).astype(np.int64) if slack < 1 else n
            zone = np.minimum(n, free + np.maximum(extra, 1))
            partner = _least(n, threshold)                     # the smallest set that may link
            need = np.maximum(1, np.floor(slack * partner).astype(np.int64)) if slack < 1 else partner
            first = np.cumsum(n) - n
            rank = np.arange(len(keys)) - np.repeat(first, n)
            keys = keys[rank < np.repeat(zone, n)]
            mask = np.uint64((1 << GRAM_BITS) - 1)
            packed = ((keys & mask) << np.uint64(DOC_BITS)) | (keys >> np.uint64(GRAM_BITS))
            packed.sort()
            gram, doc = packed >> np.uint64(DOC_BITS), (packed & np.uint64((1 << DOC_BITS) - 1)).astype(np.int64)
            at, times = runs(gram)
            local = np.bincount(doc[np.repeat(times > 1, times)], minlength=len(ids))
            owner = np.where(times == 1, doc[at], -1)
            gram = gram[at]
            of = key_bucket(gram << np.uint64(DOC_BITS), parts)
            home = (mix64(ids.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
            about = np.stack([ids, n, need, local], axis=1)
            for b in np.union1d(np.unique(of), np.unique(home)):
                lo, hi = np.searchsorted(of, [b, b + 1])
                own = owner[lo:hi]
                there = np.unique(own[own >= 0])
                own = np.where(own >= 0, np.searchsorted(there, own), -1).astype(np.int16)
                yield pa.RecordBatch.from_pylist([{
                    "bucket": int(b), "home": about[home == b].tobytes(), "doc_id": ids[there].tobytes(),
                    "gram": gram[lo:hi].tobytes(), "owner": own.tobytes()}], schema=schema)
    return run, "bucket int, home binary, doc_id binary, gram binary, owner binary"


_FACTS = ("doc_id", "n_shingles", "need", "shared")


def _answers(parts: int):
    """One key range: what its home documents brought along, and for each
    document how many of its n-grams here another document has too; one row
    for each range that the documents are at home in."""
    def run(table: pa.Table) -> pa.Table:
        rows = _range_facts(table)
        home = (mix64(rows[:, 0].astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
        rows = rows[np.argsort(home, kind="stable")]
        at, size = runs(np.sort(home))
        return pa.table({"home": pa.array(np.sort(home)[at].astype(np.int32)),
                         "facts": pa.array([rows[a:a + n].tobytes() for a, n in zip(at, size)], pa.binary())})
    return run


def _summed(table: pa.Table) -> pa.Table:
    """One home range: the facts of each of its documents."""
    rows = np.concatenate([np.frombuffer(b, np.int64).reshape(-1, 4) for b in table.column("facts").to_pylist()])
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    at, size = runs(rows[:, 0])
    known = np.add.reduceat(rows[:, 2] < 0, at) + at               # first row that states the need
    return pa.table({"doc_id": pa.array(rows[at, 0]), "n_shingles": pa.array(np.maximum.reduceat(rows[:, 1], at)),
                     "need": pa.array(rows[known, 2]), "shared": pa.array(np.add.reduceat(rows[:, 3], at))})


def _range_facts(table: pa.Table) -> np.ndarray:
    blobs = {c: table.column(c).to_pylist() for c in ("home", "doc_id", "gram", "owner")}
    grams = [np.frombuffer(x, np.uint64) for x in blobs["gram"]]
    both = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
    both.sort()
    at, times = runs(both)
    common = both[at[times > 1]]
    out = [np.frombuffer(b, np.int64).reshape(-1, 4) for b in blobs["home"]]
    for i, gram in enumerate(grams if len(common) else []):
        ids = np.frombuffer(blobs["doc_id"][i], np.int64)
        owner = np.frombuffer(blobs["owner"][i], np.int16)
        spot = np.minimum(np.searchsorted(common, gram), len(common) - 1)
        shared = np.bincount(owner[(common[spot] == gram) & (owner >= 0)], minlength=len(ids))
        some = np.flatnonzero(shared)
        none = np.full(len(some), -1)
        out.append(np.stack([ids[some], none, none, shared[some]], axis=1))
    return np.concatenate(out) if out else np.zeros((0, 4), np.int64)


def shared_counts(docs: DataFrame, words: int, threshold: float, slack: float) -> DataFrame:
    """``(doc_id, n_shingles, need, shared)`` for every document: how many of
    its compared n-grams occur elsewhere and how many a link would need."""
    parts = buckets(docs.sparkSession)
    run, schema = _requests(words, threshold, slack, parts)
    rows = docs.select("doc_id", "text").mapInArrow(run, schema)
    facts = rows.groupBy("bucket").applyInArrow(_answers(parts), "home int, facts binary")
    return facts.groupBy("home").applyInArrow(_summed, ", ".join(f"{c} long" for c in _FACTS))


def kept_rows(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is in the written table ``ids``."""
    if ids.count() <= BROADCAST_IDS:
        return docs.join(F.broadcast(ids), "doc_id", "left_semi")
    return docs.join(ids, "doc_id", "left_semi")


def rows_without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is not in the written table ``ids``."""
    if ids.count() <= BROADCAST_IDS:
        return docs.join(F.broadcast(ids), "doc_id", "left_anti")
    return docs.join(ids, "doc_id", "left_anti")


def _sets(words: int, whole: bool):
    """Documents -> size and two fingerprints of their sets, and with ``whole`` the sets."""
    def run(batches):
        for batch in small_batches(batches):
            keys, n = ngram_keys(batch.column("text"), words)
            gram = keys & np.uint64((1 << GRAM_BITS) - 1)
            rows = np.flatnonzero(n)
            if not len(rows):
                continue
            end = np.cumsum(n)[rows]
            first = end - n[rows]
            ids = np.asarray(batch.column("doc_id").cast(pa.int64()))
            out = [pa.array(x.astype(np.int64)) for x in
                   (ids[rows], n[rows], np.add.reduceat(mix64(gram), first),
                    np.bitwise_xor.reduceat(mix64(gram + np.uint64(77)), first))]
            if whole:
                out.append(pa.array([_pack(gram[a:b]) for a, b in zip(first, end)], pa.binary()))
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "n", "fp1", "fp2", "grams"][:len(out)])
    return run, "doc_id long, n long, fp1 long, fp2 long" + ", grams binary" * whole


def _pack(g: np.ndarray) -> bytes:
    """Sorted 50-bit n-grams, seven bytes each."""
    return g.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7].tobytes()


def _unpack(b: bytes) -> np.ndarray:
    raw = np.zeros((len(b) // 7, 8), np.uint8)
    raw[:, :7] = np.frombuffer(b, np.uint8).reshape(-1, 7)
    return raw.reshape(-1).view("<u8")


def _gram_counts(batches):
    for batch in batches:
        sets = [_unpack(b) for b in batch.column("grams").to_pylist()]
        if sets:
            grams, c = np.unique(np.concatenate(sets), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(grams.astype(np.int64)), pa.array(c)], names=["gram", "c"])


def frequent_grams(points: DataFrame, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent n-grams, at most ``most`` and none below ``least``
    documents, sorted, with their numbers of documents.  They only set the
    order in which n-grams are compared, so any choice gives the same links."""
    counts = written(points.mapInArrow(_gram_counts, "gram long, c long").groupBy("gram")
                     .agg(F.sum("c").alias("c")).filter(F.col("c") >= least), "jaccard-frequent")
    step = F.floor(F.log2("c") * 16)
    steps = {r["step"]: r["k"] for r in counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("k")).collect()}
    floor, room = max(steps, default=0) + 1, most
    while floor > min(steps, default=0) and steps.get(floor - 1, 0) <= room:
        floor -= 1
        room -= steps.get(floor, 0)
    top = counts.filter(step >= floor).toPandas().sort_values("gram")       # at most ``most`` rows
    return top["gram"].to_numpy(np.int64).view(np.uint64), top["c"].to_numpy(np.int64)


def _prefix(threshold: float, frequent):
    """Set -> the n-grams one of which every linked set has in the same role:
    the first in the order of frequency (all rare ones alike), then hash."""
    def run(batches):
        known, often = received(frequent)
        for batch in batches:
            ids, grams = [], []
            for i, b in zip(batch.column("rep").to_pylist(), batch.column("grams").to_pylist()):
                g = _unpack(b)
                if len(known):
                    at = np.minimum(np.searchsorted(known, g), len(known) - 1)
                    g = g[np.argsort(np.where(known[at] == g, often[at], 0), kind="stable")]
                first = g[:len(g) - int(_least(np.array([len(g)]), threshold)[0]) + 1]
                ids.append(np.full(len(first), i, np.int64))
                grams.append(first.astype(np.int64))
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(grams)), pa.array(np.concatenate(ids))],
                                                 names=["gram", "rep"])
    return run, "gram long, rep long"


def _bitmaps(batches):
    """Sets -> their size and a bitmap, whose bit i tells that an n-gram falls on i."""
    for batch in batches:
        sizes, maps = [], []
        for b in batch.column("grams").to_pylist():
            g = _unpack(b)
            width = min(max(64, 1 << (len(g) - 1).bit_length()), MAP_BITS)
            bits = np.zeros(width, np.uint8)
            bits[(g & np.uint64(width - 1)).astype(np.int64)] = 1
            sizes.append(len(g))
            maps.append(np.packbits(bits, bitorder="little").tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(sizes, pa.int64()), pa.array(maps, pa.binary())],
                                         names=["rep", "n", "bits"])


class _Bitmap:
    """A set's bitmap as a whole number, folded to any smaller width."""

    def __init__(self, n: int, bits: bytes):
        self.n, self.width = n, 8 * len(bits)
        bits = int.from_bytes(bits, "little")
        self.folds = {self.width: (bits, bits.bit_count())}

    def fold(self, width: int) -> tuple[int, int]:
        if width not in self.folds:
            bits, _ = self.fold(2 * width)
            bits = (bits & ((1 << width) - 1)) | (bits >> width)
            self.folds[width] = bits, bits.bit_count()
        return self.folds[width]

    def may_link(self, other: _Bitmap, threshold: float) -> bool:
        """False only if no link is possible: every bit of one set alone
        stands for an n-gram that the other set lacks."""
        width = min(self.width, other.width)
        (a, a_bits), (b, b_bits) = self.fold(width), other.fold(width)
        same = (a & b).bit_count()
        both = min(self.n - a_bits + same, other.n - b_bits + same)
        return both >= threshold * (self.n + other.n - both) - 1e-9


def _groups(maps: list[_Bitmap], threshold: float):
    """Places in ``maps`` (ascending sizes) in groups between which no pair
    can link; groups of one are left out."""
    left, sizes = list(range(len(maps))), [m.n for m in maps]
    while left:
        group = todo = [left.pop(0)]
        sizes.pop(0)
        while todo and left:
            p, todo = maps[todo[0]], todo[1:]
            lo, hi = bisect_left(sizes, p.n * threshold - 1e-6), bisect_right(sizes, p.n / threshold + 1e-6)
            near = {i for i in left[lo:hi] if p.may_link(maps[i], threshold)}
            if near:
                left = [i for i in left if i not in near]
                sizes = [maps[i].n for i in left]
                group, todo = [*group, *near], [*todo, *near]
        if len(group) > 1:
            yield group


def _cut_cells(threshold: float):
    """Cells of one key range -> the groups of each and their smallest document."""
    def run(table: pa.Table) -> pa.Table:
        gram, rep, n = (np.asarray(table.column(c)) for c in ("gram", "rep", "n"))
        bits = table.column("bits").to_pylist()
        order = np.lexsort((n, gram))
        heads, reps = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a, k in zip(*runs(gram[order])):
            cell = order[a:a + k]
            for group in _groups([_Bitmap(int(n[i]), bits[i]) for i in cell], threshold):
                ids = rep[cell[group]]
                heads.append(np.full(len(ids), ids.min()))
                reps.append(ids)
        return pa.table({"head": pa.array(np.concatenate(heads)), "rep": pa.array(np.concatenate(reps))})
    return run, "head long, rep long"


def _cell_groups(cells: DataFrame, points: DataFrame, threshold: float, limit: int) -> DataFrame:
    """``(head, rep)``: documents of a cell that may link, under the smallest
    of them.  Cells of more than ``limit`` documents stay whole."""
    seen = (cells.groupBy("gram").agg(F.count(F.lit(1)).alias("c"), F.bit_xor(F.xxhash64("rep")).alias("x"),
                                      F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("y")).filter("c > 1"))
    once = written(seen.groupBy("c", "x", "y").agg(F.min("gram").alias("gram")).select("gram", "c"), "jaccard-once")
    maps = written(points.mapInArrow(_bitmaps, "rep long, n long, bits binary"), "jaccard-maps")
    rows = once.filter(F.col("c") <= limit).agg(F.sum("c")).first()[0] or 0
    part = F.pmod(F.xxhash64("gram"), F.lit(max(buckets(cells.sparkSession), -(-rows // CELL_ROWS))))
    run, schema = _cut_cells(threshold)
    groups = (cells.join(once.filter(F.col("c") <= limit).select("gram"), "gram").join(maps, "rep")
              .groupBy(part.alias("part")).applyInArrow(run, schema))
    large = once.filter(F.col("c") > limit).select("gram")
    heads = cells.join(large, "gram").groupBy("gram").agg(F.min("rep").alias("head"))
    return groups.unionByName(cells.join(heads, "gram").select("head", "rep")).distinct()


class _Region:
    """Documents of a region as rows of n-gram numbers; distances by blocks."""

    def __init__(self, sets: list[np.ndarray], threshold: float):
        self.size = np.array([len(s) for s in sets], np.int64)
        self.threshold, self.eps = threshold, 1 - threshold
        _, inverse = np.unique(np.concatenate(sets), return_inverse=True)
        self.end = np.cumsum(self.size)
        self.inverse = inverse
        self.width = int(inverse.max()) + 1
        self.parent = np.arange(len(sets))

    def row(self, i: int) -> np.ndarray:
        return self.inverse[self.end[i] - self.size[i]:self.end[i]]

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def union(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.parent[max(i, j)] = min(i, j)

    def shared(self, p: int, others: np.ndarray) -> np.ndarray:
        """Sizes of the intersections of document ``p`` with ``others``."""
        mark = np.zeros(self.width, np.int64)
        mark[self.row(p)] = 1
        n = self.size[others]
        first = np.cumsum(n) - n
        pos = np.repeat(self.end[others] - n - first, n) + np.arange(n.sum())
        return np.add.reduceat(mark[self.inverse[pos]], first)

    def distance(self, p: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances from ``p``, and whether each is a link (in whole numbers)."""
        both = self.shared(p, others)
        union = self.size[p] + self.size[others] - both
        return 1 - both / union, both >= _least(union, self.threshold)

    def touches(self, y: int, others: np.ndarray) -> bool:
        """Does ``y`` link to any of ``others``?"""
        fits = ((self.size[others] >= _least(self.size[y:y + 1], self.threshold))
                & (self.size[y] >= _least(self.size[others], self.threshold)))
        others, step = others[fits], 16
        while len(others):
            if self.distance(y, others[:step])[1].any():
                return True
            others, step = others[step:], 4 * step
        return False

    def join(self, members: np.ndarray) -> None:
        """Link all members of one region to the components they belong to."""
        todo = [members]
        while todo:
            rest = todo.pop()
            while len(rest) > 1 and len({self.root(i) for i in rest}) > 1:      # else all are joined
                p, rest = rest[0], rest[1:]
                # sizes alone hold the others farther than two eps away
                least, most = np.minimum(self.size[rest], self.size[p]), np.maximum(self.size[rest], self.size[p])
                close = 1 - least / most <= 2 * self.eps + 1e-9
                others = rest[close]
                if not len(others):
                    continue
                d, linked = self.distance(p, others)
                for x in others[linked]:
                    self.union(p, x)
                # cell of p: linked documents.  Of the rest only those within two
                # eps of p can have a partner in the cell; they are replicated to it.
                ball, border = others[linked], others[~linked & (d <= 2 * self.eps + 1e-9)]
                db, dr = d[linked], d[~linked & (d <= 2 * self.eps + 1e-9)]
                for y, dy in zip(border, dr):
                    near = ball[np.abs(db - dy) <= self.eps + 1e-9]
                    if self.root(y) != self.root(p) and self.touches(y, near):
                        self.union(p, y)
                close[close] = linked
                rest = rest[~close]


def _join_region(threshold: float):
    """One region, or all regions (by ``head``) of one key range."""
    def join(ids: np.ndarray, blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids, first = np.unique(ids, return_index=True)
        region = _Region([_unpack(blobs[i]) for i in first], threshold)
        region.join(np.arange(len(ids)))
        top = np.array([region.root(i) for i in range(len(ids))])
        far = np.flatnonzero(top != np.arange(len(ids)))
        return ids[far], ids[top[far]]

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        head, rep = np.asarray(table.column("head")), np.asarray(table.column("rep"))
        order = np.argsort(head, kind="stable")
        links = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for a, k in zip(*runs(head[order])):
            rows = order[a:a + k]
            links.append(join(rep[rows], table.column("grams").take(pa.array(rows)).to_pylist()))
        return pa.table({c: pa.array(np.concatenate(x)) for c, x in zip("ab", zip(*links))})
    return run, "a long, b long"


def jaccard_components(docs: DataFrame, words: int = 4, threshold: float = 0.85,
                       slack: float = SLACK, region_limit: int = REGION_LIMIT) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of ``docs (doc_id, text)``.

    NULL or empty texts and texts without words have no n-grams and link to
    nothing.  Rows with the same doc_id count as one document: one result
    row, its largest set size, the links of all its texts.  Rows with a NULL
    doc_id take no part.  Other columns are ignored; an empty table gives no
    rows.
    """
    docs = docs.select("doc_id", "text").filter("doc_id is not null")
    counts = written(shared_counts(docs, words, threshold, slack), "jaccard-counts")
    some = written(counts.filter("shared >= need and n_shingles > 0").select("doc_id"), "jaccard-some")
    # every distinct set is a point of its own; a doc_id with several texts holds several
    key = ["n", "fp1", "fp2"]
    marks = written(kept_rows(docs, some).mapInArrow(*_sets(words, False)), "jaccard-marks")
    same = written(marks.groupBy(*key).agg(F.min("doc_id").alias("doc_id")).withColumn("rep", F.monotonically_increasing_id()),
                   "jaccard-same")
    own = written(marks.join(same.drop("doc_id"), key).select("doc_id", "rep").distinct(), "jaccard-own")
    firsts = written(same.select("doc_id").distinct(), "jaccard-firsts")
    again = written(shared_counts(kept_rows(docs, firsts), words, threshold, 1.0)
                    .filter("shared >= need and n_shingles > 0").select("doc_id"), "jaccard-again")
    left = written(same.join(again, "doc_id"), "jaccard-left")
    sets = kept_rows(docs, again).mapInArrow(*_sets(words, True))
    left = F.broadcast(left) if left.count() <= BROADCAST_SETS else left
    points = written(sets.join(left, [*key, "doc_id"]).dropDuplicates(["rep"]).select("rep", "grams"), "jaccard-points")
    often = shared(points.sparkSession, frequent_grams(points, FREQUENT_LEAST, FREQUENT_MOST))
    run, schema = _prefix(threshold, often)
    cells = written(points.mapInArrow(run, schema).distinct(), "jaccard-cells")
    pairs = written(_cell_groups(cells, points, threshold, CELL_LIMIT * region_limit), "jaccard-groups")
    tops = (pairs.groupBy(F.col("rep").alias("a")).agg(F.min("head").alias("b"))
            .join(pairs.select(F.col("head").alias("a")).distinct(), "a", "left_semi").filter("a <> b"))
    tops = components(tops, "jaccard-heads").withColumnRenamed("id", "head")
    regions = written(pairs.join(tops, "head", "left").select(F.coalesce("label", "head").alias("head"), "rep")
                      .distinct(), "jaccard-regions")
    links = _region_links(regions, points, threshold, region_limit)
    several = own.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("last")).filter("a <> last")
    held = several.join(own, "doc_id").filter("rep <> a").select("a", F.col("rep").alias("b"))
    labels = components(held.unionByName(links), "jaccard").withColumnRenamed("id", "rep")
    found = written(own.join(labels, "rep", "left").select("doc_id", F.coalesce("label", "rep").alias("label")).distinct(),
                    "jaccard-found")
    least = found.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    found = found.join(least, "label").select("doc_id", "component_id")          # one row a document: its points are linked
    return (counts.join(found, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))


def _region_links(regions: DataFrame, points: DataFrame, threshold: float, limit: int) -> DataFrame:
    """Links (enough of them to connect every component) of all regions."""
    run, schema = _join_region(threshold)
    sizes = written(regions.groupBy("head").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > limit),
                    "jaccard-large")
    small = regions.join(sizes, "head", "left_anti")
    part = F.pmod(F.xxhash64("head"), F.lit(max(buckets(points.sparkSession), -(-regions.count() // limit))))
    links = small.join(points, "rep").groupBy(part.alias("part")).applyInArrow(run, schema)
    if not sizes.limit(1).count():
        return links
    # Regions over the limit: distances to the head by salted parts of the region,
    # then only pairs that the triangle inequality allows, in blocks.
    blocks = sizes.withColumn("blocks", F.ceil(F.col("c") / limit).cast("int"))
    rows = (regions.join(blocks, "head").join(points, "rep")
            .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")))
    pivots = (blocks.join(points.select(F.col("rep").alias("head"), F.col("grams").alias("pivot")), "head")
              .select("head", "pivot", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")))
    near, near_schema = _to_pivot(threshold)
    cut = written(rows.join(pivots, ["head", "block"]).filter("rep <> head")
                  .mapInArrow(near, near_schema), "jaccard-cut")
    each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    rest = (cut.filter("not linked").select("head", "rep", "grams", "block", each)
            .select("head", F.lit("rest").alias("kind"), F.least("block", "other").alias("i"),
                    F.greatest("block", "other").alias("j"), "rep", "grams"))
    border = cut.filter("not linked and border")
    rim = border.select("head", "rep", "grams", "block", each).select(
        "head", F.lit("rim").alias("kind"), F.col("other").alias("i"), F.col("block").alias("j"), "rep", "grams")
    with_rim = border.select("head", F.col("block").alias("j")).distinct()
    ball = (cut.filter("linked").join(with_rim, "head").select(
        "head", F.lit("rim").alias("kind"), F.col("block").alias("i"), "j", "rep", "grams"))
    inner = rest.unionByName(ball).unionByName(rim).groupBy("head", "kind", "i", "j").applyInArrow(run, schema)
    return links.unionByName(inner).unionByName(
        cut.filter("linked").select(F.col("rep").alias("a"), F.col("head").alias("b")))


def _to_pivot(threshold: float):
    def run(batches):
        for batch in batches:
            linked, border = [], []
            for a, b in zip(batch.column("grams").to_pylist(), batch.column("pivot").to_pylist()):
                x, y = _unpack(a), _unpack(b)
                both = len(np.intersect1d(x, y, assume_unique=True))
                union = len(x) + len(y) - both
                linked.append(both >= int(_least(np.array([union]), threshold)[0]))
                border.append(1 - both / union <= 2 * (1 - threshold) + 1e-9)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("head", "rep", "blocks", "block", "grams")]
                + [pa.array(linked, pa.bool_()), pa.array(border, pa.bool_())],
                names=["head", "rep", "blocks", "block", "grams", "linked", "border"])
    return run, "head long, rep long, blocks int, block int, grams binary, linked boolean, border boolean"
