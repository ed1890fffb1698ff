"""Logistic models of several labels fitted together (K7), and the proof that
a fit is one (K5–K8).

All labels share the features, so each optimiser step is one pass over them:
a task sums the loss and gradient of every label over its rows and hands the
sums on in blocks of features, which Spark adds up block by block.  The
optimiser (limited-memory BFGS, one state per label) lives on the driver and
holds one vector per label, as MLlib's does for its single one.

The problem is MLlib's: mean weighted logistic loss plus ``reg_param / 2``
times the squared length of the coefficients of features divided by their
standard deviations; the intercept is free, constant features get 0.  A
label's NULL rows count for the other labels only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Features that are added up together in one group of the exchange.
BLOCK = 8192


def sparse_columns(features_col: str) -> list[Column]:
    """A vector column as ``_at`` (int array of places) and ``_x`` (values)."""
    vector = F.unwrap_udt(features_col)
    dense = F.sequence(F.lit(0), F.size(vector["values"]) - 1)
    return [F.when(vector["type"] == 0, vector["indices"]).otherwise(dense).alias("_at"), vector["values"].alias("_x")]


def label_columns(labels: list[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in labels]).alias("_y")


def _batch(batch: pa.RecordBatch, labels: int):
    """Row of every entry, its place and value, and labels (NaN where NULL)."""
    at, x = batch.column("_at"), batch.column("_x")
    rows = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(at.offsets)))
    y = np.asarray(batch.column("_y").flatten().to_numpy(zero_copy_only=False), dtype=float).reshape(-1, labels)
    return rows, np.asarray(at.flatten()), np.asarray(x.flatten()), y


def _column_sums(rows: DataFrame, size: int, width: int, work) -> np.ndarray:
    """Sums of what ``work(batch)`` adds to an array ``(width, size)``, over all
    rows.  Tasks send blocks that they have touched; each block is added up by
    one group; ``width * size`` numbers reach the driver."""
    def local(batches):
        total = np.zeros((width, size))
        for batch in batches:
            if batch.num_rows:
                work(batch, total)
        for s in range(0, size, BLOCK):
            if total[:, s:s + BLOCK].any():
                yield pa.RecordBatch.from_arrays([pa.array([s], pa.int64()),
                                                  pa.array([total[:, s:s + BLOCK].tobytes()], pa.binary())], ["start", "sums"])

    def added(table: pa.Table) -> pa.Table:
        sums = np.sum([np.frombuffer(v.as_py()) for v in table["sums"]], axis=0)
        return pa.table({"start": table["start"][:1], "sums": pa.array([sums.tobytes()], pa.binary())})
    schema = "start long, sums binary"
    out = np.zeros((width, size))
    for r in rows.mapInArrow(local, schema).groupBy("start").applyInArrow(added, schema).collect():
        block = np.frombuffer(r.sums).reshape(width, -1)
        out[:, r.start:r.start + block.shape[1]] = block
    return out


def _minimum(x: np.ndarray, max_iter: int, tol: float, memory: int = 10):
    """Limited-memory BFGS as a coroutine: yields points, is sent ``(value,
    gradient)``, returns the last point.  Armijo line search with halving."""
    value, slope = yield x
    pairs: list = []
    for _ in range(max_iter):
        if np.abs(slope).max() <= tol:
            break
        step, alphas = -slope, []
        for s, y, r in reversed(pairs):
            alphas.append(r * (s @ step))
            step = step - alphas[-1] * y
        if pairs:
            s, y, _r = pairs[-1]
            step = step * ((s @ y) / (y @ y))
        for (s, y, r), a in zip(pairs, reversed(alphas)):
            step = step + s * (a - r * (y @ step))
        size = 1.0 if pairs else min(1.0, 1.0 / np.abs(slope).sum())
        while True:
            near, steep = yield x + size * step
            if near <= value + 1e-4 * size * (slope @ step) or size < 1e-12:
                break
            size /= 2
        moved, bent = size * step, steep - slope
        if moved @ bent > 1e-18:
            pairs = [*pairs, (moved, bent, 1 / (moved @ bent))][-memory:]
        if near > value:
            break
        x, value, slope = x + moved, near, steep
    return x


@dataclass
class MultilabelModel:
    """``coefficients[label]`` on the original features, and intercepts."""
    labels: list[str]
    coefficients: np.ndarray
    intercepts: np.ndarray
    passes: int

    def transform(self, df: DataFrame, features_col: str, keep: list[str], prefix: str = "p_") -> DataFrame:
        """The columns ``keep`` and the probability of 1 for every label, in one pass."""
        shared = df.sparkSession.sparkContext.broadcast((self.coefficients, self.intercepts))
        outputs = [f"{prefix}{lab}" for lab in self.labels]
        rows = df.select(*keep, *sparse_columns(features_col))
        schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in keep]
                           + [f"`{o}` double" for o in outputs])

        def score(batches):
            weights, free = shared.value
            for batch in batches:
                at, x = batch.column("_at"), batch.column("_x")
                row = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(at.offsets)))
                at, x = np.asarray(at.flatten()), np.asarray(x.flatten())
                p = [1 / (1 + np.exp(-(np.bincount(row, x * w[at], batch.num_rows) + b))) for w, b in zip(weights, free)]
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(v) for v in p], [*keep, *outputs])
        return rows.mapInArrow(score, schema)


def fit_labels(train: DataFrame, features_col: str, labels: list[str], size: int, reg_param: float = 0.1,
               max_iter: int = 100, tol: float = 1e-4) -> MultilabelModel:
    """One L2-penalised logistic model per label, all fitted by the same passes
    over ``train`` (a written or cached frame; ``size`` features).  Labels are
    0, 1 or NULL; a label of one class only gets no coefficients and an infinite
    intercept."""
    k = len(labels)
    rows = train.select(*sparse_columns(features_col), label_columns(labels))

    def moments(batch, total):
        row, at, x, y = _batch(batch, k)
        for j in range(k):
            known = ~np.isnan(y[:, j])[row]
            total[2 * j] += np.bincount(at[known], x[known], size)
            total[2 * j + 1] += np.bincount(at[known], x[known] ** 2, size)
    sums = _column_sums(rows, size, 2 * k, moments)
    counts = train.agg(*[F.count(c).alias(f"n{j}") for j, c in enumerate(labels)],
                       *[F.sum(F.col(c).cast("double")).alias(f"s{j}") for j, c in enumerate(labels)]).first()
    n, ones = (np.array([counts[f"{w}{j}"] or 0 for j in range(k)], dtype=float) for w in "ns")
    spread = (sums[1::2] - sums[::2] ** 2 / np.maximum(n, 1)[:, None]) / np.maximum(n - 1, 1)[:, None]
    scale = np.where(spread > 0, 1 / np.sqrt(np.where(spread > 0, spread, 1)), 0.0)
    with np.errstate(divide="ignore"):
        start = np.log(ones) - np.log(n - ones)
    searches, points, passes = {}, {}, 1
    for j in range(k):
        if np.isfinite(start[j]):
            searches[j] = _minimum(np.append(np.zeros(size), start[j]), max_iter, tol)
            points[j] = next(searches[j])
    final = {j: np.append(np.zeros(size), start[j]) for j in range(k)}
    while points:
        active = sorted(points)
        shared = train.sparkSession.sparkContext.broadcast([(points[j][:-1] * scale[j], points[j][-1]) for j in active])

        def losses(batch, total, shared=shared, active=active):
            row, at, x, y = _batch(batch, k)
            for i, (j, (weights, free)) in enumerate(zip(active, shared.value)):
                known = ~np.isnan(y[:, j])
                margin = np.bincount(row, x * weights[at], batch.num_rows) + free
                target = np.where(known, y[:, j], 0.0)
                miss = np.where(known, 1 / (1 + np.exp(-margin)) - target, 0.0)
                total[i, :size] += np.bincount(at, x * miss[row], size)
                total[i, size] += miss.sum()
                total[i, size + 1] += np.where(known, np.logaddexp(0, margin) - target * margin, 0.0).sum()
        got = _column_sums(rows, size + 2, len(active), losses)
        shared.destroy()
        passes += 1
        for i, j in enumerate(active):
            b = points[j][:-1]
            value = got[i, size + 1] / n[j] + reg_param / 2 * (b @ b)
            slope = np.append(got[i, :size] * scale[j] / n[j] + reg_param * b, got[i, size] / n[j])
            try:
                points[j] = searches[j].send((value, slope))
            except StopIteration as end:
                final[j] = end.value
                del points[j]
    return MultilabelModel(labels, np.stack([final[j][:-1] * scale[j] for j in range(k)]),
                           np.array([final[j][-1] for j in range(k)]), passes)


def gradient_table(df: DataFrame, features: list[str], label: str, coefficients: dict[str, float], intercept: float,
                   reg_param: float = 0.0, weight: str | None = None) -> DataFrame:
    """The optimality certificate of a fit on plain columns: ``(feature,
    gradient)`` of the penalised, standardised objective at the given
    coefficients, with an ``(intercept)`` row.  All zeros prove the minimum;
    one aggregate for any number of rows."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    z = F.lit(float(intercept))
    for c in features:
        z = z + F.lit(float(coefficients[c])) * F.col(c)
    rows = df.select(*features, w.alias("_w"), (1 / (1 + F.exp(-z)) - F.col(label).cast("double")).alias("_miss"))
    sums = rows.agg(F.sum("_w").alias("_total"), F.sum(F.col("_w") * F.col("_miss")).alias("_g"),
                    *[F.sum(F.col("_w") * F.col("_miss") * F.col(c)).alias(f"_g{i}") for i, c in enumerate(features)],
                    *[F.stddev_samp(F.col(c).cast("double")).alias(f"_s{i}") for i, c in enumerate(features)])
    each = [F.struct(F.lit(c).alias("feature"), F.when(F.col(f"_s{i}") > 0, F.col(f"_g{i}") / F.col("_total") / F.col(f"_s{i}")
            + F.lit(reg_param * float(coefficients[c])) * F.col(f"_s{i}")).otherwise(0.0).alias("gradient"))
            for i, c in enumerate(features)]
    each.append(F.struct(F.lit("(intercept)").alias("feature"), (F.col("_g") / F.col("_total")).alias("gradient")))
    return sums.select(F.explode(F.array(*each)).alias("_r")).select("_r.*")


def vector_certificate(train: DataFrame, features_col: str, model: MultilabelModel, reg_param: float) -> DataFrame:
    """``(label, n_rows, largest_gradient)`` for every label of a model on a vector column, relationally: entries
    of the vectors, joined to the coefficients, summed by feature."""
    spark = train.sparkSession
    names = model.labels
    table = spark.createDataFrame([(int(i), *[float(c[i]) for c in model.coefficients])
                                   for i in np.flatnonzero(np.abs(model.coefficients).sum(axis=0))],
                                  "_at int, " + ", ".join(f"_w{j} double" for j in range(len(names))))
    rows = train.select(F.monotonically_increasing_id().alias("_row"), label_columns(names), *sparse_columns(features_col))
    entries = rows.select("_row", "_y", F.explode(F.arrays_zip("_at", "_x")).alias("e")).select("_row", "_y", "e.*")
    margins = (entries.join(table, "_at").groupBy("_row").agg(*[F.sum(F.col("_x") * F.col(f"_w{j}")).alias(f"_z{j}")
                                                                for j in range(len(names))]))
    out = None
    rows = rows.join(margins, "_row", "left")
    for j, name in enumerate(names):
        z = F.coalesce(F.col(f"_z{j}"), F.lit(0.0)) + F.lit(float(model.intercepts[j]))
        known = rows.select("_row", "_at", "_x", F.col("_y")[j].alias("y"), z.alias("z")).filter("y is not null")
        known = known.withColumn("_miss", 1 / (1 + F.exp(-F.col("z"))) - F.col("y"))
        total = known.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("_miss").alias("_free"))
        by = (known.select("_miss", F.explode(F.arrays_zip("_at", "_x")).alias("e")).groupBy("e._at")
              .agg(F.sum(F.col("e._x") * F.col("_miss")).alias("g"), F.sum("e._x").alias("s"), F.sum(F.col("e._x") ** 2).alias("ss")))
        by = by.join(table.select("_at", F.col(f"_w{j}").alias("w")), "_at", "left").crossJoin(total)     # total: one row
        spread = F.sqrt((F.col("ss") - F.col("s") * F.col("s") / F.col("n_rows")) / (F.col("n_rows") - 1))
        slope = F.when(spread > 0, F.col("g") / F.col("n_rows") / spread + reg_param * F.coalesce("w", F.lit(0.0)) * spread)
        worst = by.agg(F.max("n_rows").alias("n_rows"), F.greatest(F.max(F.abs(slope)), F.max(F.abs(F.col("_free") / F.col("n_rows"))))
                       .alias("largest_gradient")).select(F.lit(name).alias("label"), "n_rows", "largest_gradient")
        out = worst if out is None else out.unionByName(worst)
    return out
