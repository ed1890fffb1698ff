"""k-means: per-group k-means‖ and Lloyd iterations in one plan (K3, K4)
and MLlib's global k-means (K1, K2).

Per-group k-means fits one independent model per group value, all groups at
once, with the same jobs for one group or a million:

* **Distinct points.**  The input is read once, into the distinct points of
  every group with their counts (one aggregate, partial on the map side).
  Rounds, weights and steps read only these, weighted; a point without
  copies is shuffled once.
* **Start (k-means‖).**  A first centre per group, then rounds of
  oversampling: a point is drawn with probability ``oversampling · k · d² /
  φ``, where ``d²`` is its squared distance to the group's candidates and
  ``φ`` the group's sum of them.  Candidates are weighted with the points
  they are nearest to and reduced, inside one row per group, to ``k`` by the
  greedy rule "largest weight times squared distance".  A round is two
  partial aggregates over the distinct points; only drawn ones are shuffled.
* **Draws without a seed.**  A point's draw is an md5 of its coordinates'
  full text and the round, so the fit is the same under any partitioning and
  in any engine.  Equal points draw alike.
* **Lloyd steps.**  Points join the one-row-per-group table of centres
  (``k × d`` plain columns), the nearest is found by arithmetic and ``least``
  inside whole-stage codegen, and one aggregate by group gives the new row.  An
  empty cluster keeps its centre.
* Every table of centres is written to the shared checkpoint folder: lineage
  doesn't grow, and the planner knows the table's size in bytes and decides
  on a broadcast (or a skew-splitting shuffle join) by it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.operators.common import ensure_parallelism, materialized

#: Rounds of oversampling and, times k, the points expected from each (MLlib's values).
ROUNDS, OVERSAMPLING = 2, 2


def point_text(features: list[str]) -> Column:
    """The coordinates in full precision as text; 0.0 and -0.0 are equal."""
    return F.concat_ws("|", *[(F.col(c) + F.lit(0.0)).cast("string") for c in features])


def _digits(text: Column, turn: int | Column) -> Column:
    """The first 52 bits of an md5 as 13 hexadecimal digits."""
    turn = turn.cast("string") if isinstance(turn, Column) else F.lit(str(turn))
    return F.substring(F.md5(F.concat(turn, F.lit(":"), text)), 1, 13)


def _draw(text: Column, turn: int) -> Column:
    """A number in [0, 1) from the first 52 bits of an md5."""
    return F.conv(_digits(text, turn), 16, 10).cast("double") / F.lit(float(1 << 52))


def _digits_below(chance: Column) -> Column:
    """The digits that those of every smaller draw sort before: ``_draw`` is
    below ``chance`` where ``_digits`` are below these."""
    whole = F.ceil(F.least(chance, F.lit(1.0)) * F.lit(float(1 << 52)))
    return F.when(chance >= 1, F.lit("g")).otherwise(F.lower(F.lpad(F.hex(whole), 13, "0")))


def _squared(a: list[Column], b: list[Column]) -> Column:
    total = (a[0] - b[0]) * (a[0] - b[0])
    for x, y in zip(a[1:], b[1:]):
        total = total + (x - y) * (x - y)
    return total


def _by_group(candidates: DataFrame, group_col: str) -> DataFrame:
    """One row per group with its candidates ``(_h, <features>)``, sorted."""
    rest = [c for c in candidates.columns if c != group_col]
    return candidates.groupBy(group_col).agg(F.array_sort(F.collect_list(F.struct(*rest))).alias("_candidates"))


def _distance(features: list[str]) -> Column:
    """Squared distance of a row to the nearest of its group's candidates."""
    point = [F.col(c) for c in features]
    return F.array_min(F.transform("_candidates", lambda c: _squared(point, [c[f] for f in features])))


def distinct_points(points: DataFrame, group_col: str, features: list[str]) -> DataFrame:
    """The distinct points of every group with their number of rows ``_n``,
    written once: whatever follows reads these, however many copies come in."""
    return ensure_parallelism(materialized(points.groupBy(group_col, *features).agg(F.count(F.lit(1)).alias("_n")),
                                           "kmeans-distinct"))


def start_candidates(points: DataFrame, group_col: str, features: list[str], k: int,
                     rounds: int = ROUNDS, oversampling: int = OVERSAMPLING) -> DataFrame:
    """``(group, _h, <features>)``: the first centre of every group (smallest
    md5) and the points drawn in each round.  Rounds go on beyond ``rounds``
    only while a group with more distinct points has less than k candidates."""
    found = _candidates(distinct_points(points, group_col, features), group_col, features, k, rounds, oversampling)
    return found.select(group_col, F.explode("_candidates").alias("_p")).select(group_col, "_p.*")


def _candidates(each: DataFrame, group_col: str, features: list[str], k: int, rounds: int, oversampling: int) -> DataFrame:
    """``(group, _candidates)`` from the distinct points with their counts.

    Equal points draw alike, so where a point has m copies on average a round
    draws m times fewer points than it should, and m times more are needed.
    Beyond ``rounds`` one pass therefore tries m / 4
    rounds: up to a group's first round with a draw nothing changes in the
    group.  A group goes on by itself until it has k candidates; the others
    follow up to the same round, as rounds are shared.  After 4 m of a group's
    rounds (4 draws for every row of it) its points are drawn by
    their copies, which finds one in a round or two."""
    copies, at, phi = F.sum("_n") / F.count(F.lit(1)), F.col("_at"), F.col("_phi")
    point = F.struct(F.md5(point_text(features)).alias("_h"), *features)
    state = materialized(
        each.groupBy(group_col).agg(F.array(F.min(point)).alias("_candidates"), F.ceil(copies / 4).alias("_step"),
                                    (F.ceil(copies * 4) + rounds).alias("_most"))
        .select(group_col, "_step", "_most", F.lit(0).cast("long").alias("_at"), F.lit(float("inf")).alias("_phi"),
                "_candidates"), "kmeans-first")

    # columns of a round, for all rounds: built once, as each costs calls to the JVM
    distance, spread_of = _distance(features), F.sum(F.col("_n") * F.col("_d")).alias("_spread")
    chance = F.lit(float(oversampling * k)) * F.col("_d") / F.col("_spread")
    text_md5 = F.md5(point_text(features))

    def turn_of(chance: Column) -> Column:
        """The first of a row's rounds that draws it; text and bound are bound once a row, not once a round."""
        bound = F.struct(point_text(features).alias("text"), _digits_below(chance).alias("below"))
        return F.get(F.flatten(F.transform(F.array(bound), lambda b: F.filter(
            F.sequence("_from", "_to"), lambda t: _digits(b["text"], t) < b["below"]))), F.lit(0))
    turn = {False: turn_of(chance), True: turn_of(chance * F.col("_n"))}
    drawn_of = [F.min("_turn").alias("_turn"), F.collect_list(F.struct("_turn", text_md5.alias("_h"), *features)).alias("_drawn")]
    new = F.transform(F.filter("_drawn", lambda c: c["_turn"] == F.col("_turn")),
                      lambda c: F.struct(*[c[x].alias(x) for x in ("_h", *features)]))
    left = F.when(F.col("_to").isNull(), phi).otherwise(F.coalesce("_spread", F.lit(0.0)))
    after_round = [
        F.when(left > 0, F.coalesce("_turn", "_to", at)).otherwise(at).alias("_at"), left.alias("_phi"),
        F.when(F.col("_turn").isNull(), F.col("_candidates")).otherwise(F.array_sort(F.concat("_candidates", new)))
        .alias("_candidates")]

    def after(state: DataFrame, which: Column, until: Column, by_copies: bool = False) -> DataFrame:
        """The groups of ``which`` after their next round with a draw, or after a step without one."""
        state = state.withColumn("_from", at + 1).withColumn("_to", F.when(which, F.least(at + F.col("_step"), until)))
        spread = (each.join(state.filter(F.col("_to").isNotNull()).select(group_col, "_candidates"), group_col)
                  .withColumn("_d", distance).filter(F.col("_d") > 0).groupBy(group_col).agg(spread_of))
        # written, so that the points are not shuffled by group to meet it
        state = materialized(state.join(spread, group_col, "left"), "kmeans-spread")
        going = state.filter(F.col("_spread").isNotNull()).select(group_col, "_candidates", "_from", "_to", "_spread")
        drawn = (each.join(going, group_col).withColumn("_d", distance).filter(F.col("_d") > 0)
                 .withColumn("_turn", turn[by_copies]).filter(F.col("_turn").isNotNull()).groupBy(group_col).agg(*drawn_of))
        return materialized(state.join(drawn, group_col, "left").select(group_col, "_step", "_most", *after_round), "kmeans-rounds")

    for r in range(1, rounds + 1):
        state = after(state, phi > 0, F.lit(r))
    short = (F.size("_candidates") < k) & (phi > 0)
    while not state.filter(short & (at < F.col("_most"))).isEmpty():
        state = after(state, short & (at < F.col("_most")), F.col("_most"))
    last = F.least(F.lit(state.agg(F.max("_at")).first()[0]), F.col("_most"))
    while not state.filter((at < last) & (phi > 0)).isEmpty():
        state = after(state, (at < last) & (phi > 0), last)
    while not state.filter(short).isEmpty():
        state = after(state, short, at + 1, by_copies=True)
    return state.select(group_col, "_candidates")


def initial_centers(points: DataFrame, group_col: str, features: list[str], k: int,
                    rounds: int = ROUNDS, oversampling: int = OVERSAMPLING) -> DataFrame:
    """Start centres of every group as one row ``(group, _centers)``: the
    candidates weighted by the points nearest to them (ties to the smaller
    md5), then k of them greedily: the heaviest, then whichever has the
    largest weight times squared distance to those chosen."""
    return _centers(distinct_points(points, group_col, features), group_col, features, k, rounds, oversampling)


def _centers(each: DataFrame, group_col: str, features: list[str], k: int, rounds: int, oversampling: int) -> DataFrame:
    """``initial_centers`` from the distinct points with their counts."""
    found = _candidates(each, group_col, features, k, rounds, oversampling)
    point = [F.col(c) for c in features]
    nearest = F.array_min(F.transform("_candidates", lambda c: F.struct(
        _squared(point, [c[f] for f in features]).alias("d"), c["_h"].alias("_h"), *[c[f].alias(f) for f in features])))
    weighted = (each.join(found, group_col).select(group_col, "_n", nearest.alias("_c"))
                .groupBy(group_col, *[F.col("_c")[x].alias(x) for x in ("_h", *features)]).agg(F.sum("_n").alias("_w")))
    grouped = _by_group(weighted.select(group_col, "_h", "_w", *features), group_col)

    def heaviest(score) -> Column:
        """The candidate of the largest score, ties to the first."""
        return F.array_max(F.transform("_candidates", lambda c, i: F.struct(
            score(c).alias("score"), (-i).alias("at"), F.struct(*[c[f].alias(f) for f in features]).alias("p"))))

    def add(chosen: Column, _: Column) -> Column:
        best = heaviest(lambda c: c["_w"].cast("double") * F.array_min(F.transform(
            chosen, lambda s: _squared([c[f] for f in features], [s[f] for f in features]))))
        return F.when(best["score"] > 0, F.concat(chosen, F.array(best["p"]))).otherwise(chosen)
    first = F.array(heaviest(lambda c: c["_w"].cast("double"))["p"])
    chosen = F.aggregate(F.sequence(F.lit(1), F.lit(k - 1)), first, add) if k > 1 else first
    return grouped.select(group_col, chosen.alias("_centers"))


def _center_columns(features: list[str], k: int) -> list[str]:
    return [f"_c{j}_{i}" for j in range(k) for i in range(len(features))]


def _nearest(features: list[str], k: int) -> Column:
    """Index of the nearest centre; ties go to the lowest index.  Plain
    arithmetic and ``least`` over (distance, index) structs, so the whole
    assignment stays inside whole-stage codegen."""
    inf, point = F.lit(float("inf")), [F.col(c) for c in features]
    cands = [F.struct(F.coalesce(_squared(point, [F.col(f"_c{j}_{i}") for i in range(len(features))]), inf).alias("d"),
                      F.lit(j).alias("cluster")) for j in range(k)]
    return (F.least(*cands) if len(cands) > 1 else cands[0])["cluster"]


@dataclass
class GroupedKMeansModel:
    wide: DataFrame             # group, _c{cluster}_{feature} (written); NULL beyond a group's centres
    group_col: str
    features: list[str]
    k: int
    iterations: int

    @property
    def centers(self) -> DataFrame:
        """``(group, cluster, <features>)``."""
        each = F.explode(F.array(*[F.struct(F.lit(j).alias("cluster"), *[F.col(f"_c{j}_{i}").alias(c)
                                   for i, c in enumerate(self.features)]) for j in range(self.k)]))
        rows = self.wide.select(self.group_col, each.alias("_c")).select(self.group_col, "_c.*")
        return rows.filter(F.col(self.features[0]).isNotNull())

    def assign(self, points: DataFrame, out_col: str = "cluster") -> DataFrame:
        """Attach the nearest centre's id to every point of a fitted group."""
        joined = points.join(self.wide, self.group_col)
        return joined.withColumn(out_col, _nearest(self.features, self.k)).drop(*_center_columns(self.features, self.k))


def fit_grouped_kmeans(df: DataFrame, group_col: str, features: list[str], k: int = 4,
                       max_iter: int = 20, tol: float = 0.0, digits: int | None = None,
                       persist: bool = True, rounds: int = ROUNDS, oversampling: int = OVERSAMPLING) -> GroupedKMeansModel:
    """Fit k-means per value of ``group_col`` on ``features``.

    Rows with a NULL group or feature are dropped (the reference's
    ``na.drop()``).  ``digits`` rounds centres after each step so that runs on
    different engines or partitionings agree; ``None`` keeps full precision.
    Stops early when no centre moves by more than ``tol`` (with ``tol=0``
    this only stops once the fit has reached its fixed point, so the result
    equals running all ``max_iter`` steps).  A group with fewer distinct
    points than k gets a centre for each.
    """
    points = df.select(group_col, *[F.col(c).cast("double").alias(c) for c in features]).na.drop()
    each = distinct_points(points, group_col, features)
    if persist:
        each = each.persist(StorageLevel.MEMORY_AND_DISK)
    start = _centers(each, group_col, features, k, rounds, oversampling)
    wide = materialized(start.select(group_col, *[F.get("_centers", F.lit(j))[c].alias(f"_c{j}_{i}")
                                                  for j in range(k) for i, c in enumerate(features)]), "kmeans-start")
    names, it = _center_columns(features, k), 0
    # columns of a step, for all steps
    nearest, mine, n = _nearest(features, k), [F.col("_k") == j for j in range(k)], F.col("_n")
    rows = [F.sum(F.when(x, n)) for x in mine]
    means = [F.sum(F.when(mine[j], n * F.col(c))) / rows[j] for j in range(k) for c in features]
    means = [(x if digits is None else F.round(x, digits)).alias(f"_new{name}") for name, x in zip(names, means)]
    moved = [F.coalesce(f"_new{name}", name) for name in names]
    shift = F.greatest(F.lit(0.0), *[F.abs(m - F.col(name)) for m, name in zip(moved, names)]).alias("_shift")
    moved = [m.alias(name) for m, name in zip(moved, names)]
    for it in range(1, max_iter + 1):
        new = each.join(wide, group_col).withColumn("_k", nearest).groupBy(group_col).agg(*means)
        step = materialized(wide.join(new, group_col).select(group_col, *moved, shift), "kmeans-step")
        wide = step.drop("_shift")
        if step.filter(F.col("_shift") > tol).isEmpty():
            break
    if persist:
        each.unpersist()
    return GroupedKMeansModel(wide, group_col, features, k, it)


def cluster_sizes(model: GroupedKMeansModel, df: DataFrame) -> DataFrame:
    """Points per (group, cluster) under the fitted centres."""
    points = (df.select(model.group_col, *[F.col(c).cast("double").alias(c) for c in model.features])
              .na.drop())
    return (model.assign(points).groupBy(model.group_col, "cluster")
            .agg(F.count(F.lit(1)).alias("n_points")))


def fit_global_kmeans(df: DataFrame, features_col: str, k: int, max_iter: int = 20,
                      seed: int = 1):
    """MLlib k-means (k-means|| start) on a vector column (K1, K2)."""
    from pyspark.ml.clustering import KMeans
    return KMeans(k=k, maxIter=max_iter, seed=seed, featuresCol=features_col).fit(df)


def centers_table(spark, model, feature_names: list[str]) -> DataFrame:
    """MLlib centres as rows ``(cluster, <feature names>)`` (K4).  The model
    holds k centres on the driver already; this only re-shapes them."""
    rows = [(i, *[float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, ["cluster", *feature_names])
