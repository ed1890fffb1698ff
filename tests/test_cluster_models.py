"""k-means invariants and classifier plumbing."""

import pytest
from pyspark.sql import functions as F

from spindle.operators import classify, cluster


def _points(spark):
    rows = []
    for g, off in (("a", 0.0), ("b", 100.0)):
        for i in range(40):
            rows.append((g, off + (i % 4) * 10.0 + (i % 3) * 0.1, float(i % 5)))
    rows.append(("a", None, 1.0))                    # NULL feature row is dropped
    rows.append(("c", 1.0, 1.0))                     # group with fewer distinct points than k
    return spark.createDataFrame(rows, "g string, x double, y double")


def _cost(model, df):
    a = model.assign(df.na.drop())
    c = model.centers.select("g", "cluster", F.col("x").alias("cx"), F.col("y").alias("cy"))
    return a.join(c, ["g", "cluster"]).select(
        F.sum((F.col("x") - F.col("cx")) ** 2 + (F.col("y") - F.col("cy")) ** 2)).first()[0]


def test_grouped_kmeans_cost_never_rises_and_groups_independent(spark):
    df = _points(spark)
    costs = [_cost(cluster.fit_grouped_kmeans(df, "g", ["x", "y"], k=4, max_iter=i), df)
             for i in (1, 2, 3, 6)]
    assert all(b <= a + 1e-9 for a, b in zip(costs, costs[1:]))
    m = cluster.fit_grouped_kmeans(df, "g", ["x", "y"], k=4, max_iter=10)
    per = {r.g: r["count"] for r in m.centers.groupBy("g").count().collect()}
    assert per == {"a": 4, "b": 4, "c": 1}
    # group b lives at x >= 100, group a below: no centre mixes the groups
    assert all(r.x < 100 for r in m.centers.filter("g = 'a'").collect())
    assert all(r.x >= 100 for r in m.centers.filter("g = 'b'").collect())


def test_grouped_kmeans_partition_stable(spark):
    df = _points(spark)
    r1 = sorted(tuple(r) for r in cluster.fit_grouped_kmeans(df.repartition(1), "g", ["x", "y"], digits=6).centers.collect())
    r2 = sorted(tuple(r) for r in cluster.fit_grouped_kmeans(df.repartition(5), "g", ["x", "y"], digits=6).centers.collect())
    assert r1 == r2


def test_score_linear_and_multilabel(spark):
    from pyspark.ml.feature import VectorAssembler
    rows = [(i, float(i % 10), 1 if i % 10 > 4 else 0, 1 if i % 2 else 0) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, x double, a int, b int")
    s = classify.score_linear(df, {"x": 1.0}, -4.5).select("probability", "prediction", "x").collect()
    assert all((r.prediction == 1.0) == (r.x > 4.5) and 0 < r.probability < 1 for r in s)
    x = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    models = classify.fit_multilabel(x, "features", ["a", "b"], reg_param=0.1)
    out = classify.score_multilabel(models, x, "id", "features")
    assert out.columns == ["id", "p_a", "p_b"] and out.count() == 200
    hi = out.filter("id = 9").first()
    assert hi.p_a > 0.5 and 0.0 <= hi.p_b <= 1.0


def test_coefficient_table_names(spark):
    from spindle.operators import encode
    df = spark.createDataFrame([("u", 1.0, 1.0), ("v", 2.0, 0.0), ("u", 3.0, 1.0), ("w", 0.5, 0.0)],
                               "c string, n double, label double")
    x = encode.encoding_pipeline(["c"], ["n"]).fit(df).transform(df)
    m = classify.fit_logistic(x, "features", "label", reg_param=0.1, max_iter=10)
    names = [r.feature for r in classify.coefficient_table(spark, m, classify.feature_names(x, "features")).collect()]
    assert names[-1] == "(intercept)" and "n" in names and len(names) == 5
    assert not any("unknown" in n for n in names)
    unseen = spark.createDataFrame([("zz", 1.0, 1.0)], "c string, n double, label double")
    pipe = encode.encoding_pipeline(["c"], ["n"]).fit(df)
    assert pipe.transform(unseen).first().features.toArray().tolist() == [0.0, 0.0, 0.0, 1.0]


def test_grouped_kmeans_same_with_and_without_broadcast(spark):
    df = _points(spark)
    a = sorted(tuple(r) for r in cluster.fit_grouped_kmeans(df, "g", ["x", "y"], digits=9).centers.collect())
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        b = sorted(tuple(r) for r in cluster.fit_grouped_kmeans(df, "g", ["x", "y"], digits=9).centers.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert a == b


def test_initial_centers_distinct_under_hot_duplicate(spark):
    # one point holds most rows of its group; start centres must still be k distinct points
    rows = [("g", 1.0, 1.0)] * 500 + [("g", float(i), 2.0 * i) for i in range(2, 30)]
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(6)
    init = cluster.initial_centers(df, "g", ["x", "y"], 4).collect()
    assert len(init) == 1 and len({tuple(p) for p in init[0]["_centers"]}) == 4


def test_kmeans_parallel_start_costs_no_more_than_mllib(spark):
    """Cost within 5 % of one MLlib fit per group, over blobs of unlike sizes."""
    import numpy as np
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler
    draw, rows = np.random.default_rng(11), []
    for g in range(3):
        for c in range(5):
            at = draw.normal(0, 20, 2)
            rows += [(f"g{g}", float(x), float(y)) for x, y in draw.normal(at, 1 + c / 3, (40 + 60 * c, 2))]
    df = spark.createDataFrame(rows, "g string, x double, y double").cache()
    model = cluster.fit_grouped_kmeans(df, "g", ["x", "y"], k=5, max_iter=20)
    ours = {r.g: r.cost for r in model.assign(df).join(model.centers.withColumnsRenamed({"x": "cx", "y": "cy"}), ["g", "cluster"])
            .groupBy("g").agg(F.sum((F.col("x") - F.col("cx")) ** 2 + (F.col("y") - F.col("cy")) ** 2).alias("cost")).collect()}
    x = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(df)
    for g, cost in ours.items():
        fit = KMeans(k=5, maxIter=20, seed=1).fit(x.filter(F.col("g") == g))
        assert cost <= 1.05 * fit.summary.trainingCost
    df.unpersist()


def test_multilabel_chain_equals_per_label_join(spark):
    """The chained single-plan scoring gives the same probabilities as the
    reference's per-label transform + join on id."""
    from pyspark.ml.feature import VectorAssembler
    rows = [(i, float(i % 7), float((i * 3) % 5), 1 if i % 7 > 3 else 0, 1 if (i * 3) % 5 > 1 else 0)
            for i in range(300)]
    df = spark.createDataFrame(rows, "id int, x double, z double, a int, b int")
    x = VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(df)
    models = classify.fit_multilabel(x, "features", ["a", "b"], reg_param=0.1)
    chained = {r.id: (r.p_a, r.p_b) for r in classify.score_multilabel(models, x, "id", "features").collect()}
    joined = x.select("id")
    for lab, m in models.items():
        res = m.transform(x).select("id", classify.vector_element("probability", 1).alias(lab))
        joined = joined.join(res, "id")
    brute = {r.id: (r.a, r.b) for r in joined.collect()}
    assert chained.keys() == brute.keys()
    assert all(chained[k] == pytest.approx(brute[k], abs=1e-12) for k in brute)


def test_grouped_kmeans_tiny_and_huge_coordinates(spark):
    from spindle.operators.cluster import fit_grouped_kmeans
    near = spark.createDataFrame([("g", 1e-8 * i) for i in range(100)], "g string, x double")
    assert fit_grouped_kmeans(near, "g", ["x"], k=4).centers.select("x").distinct().count() == 4
    far = spark.createDataFrame([("g", 1e13 + i) for i in range(20)], "g string, x double")
    assert fit_grouped_kmeans(far, "g", ["x"], k=2).centers.count() == 2


def test_labels_fitted_together_equal_mllib_fits(spark):
    """Coefficients and probabilities of the shared passes equal one MLlib fit
    per label; NULL labels count for the other label only."""
    import numpy as np
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors, VectorUDT
    from pyspark.sql import types as T
    from spindle.operators import multilabel
    draw = np.random.default_rng(5)
    rows = []
    for i in range(400):
        at = sorted(draw.choice(30, 6, replace=False).tolist())
        x = [float(v) for v in draw.integers(1, 4, 6)]
        z = sum(v if p < 10 else -v for p, v in zip(at, x)) / 4
        v = Vectors.sparse(30, at, x) if i % 3 else Vectors.dense(Vectors.sparse(30, at, x).toArray())
        rows.append((i, v, int(draw.random() < 1 / (1 + np.exp(-z))), None if i % 9 == 0 else int(draw.random() < 0.3), 1))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("features", VectorUDT()),
                           *[T.StructField(c, T.IntegerType()) for c in ("a", "b", "one")]])
    df = spark.createDataFrame(rows, schema).repartition(3).cache()
    model = multilabel.fit_labels(df, "features", ["a", "b", "one"], 30, reg_param=0.1, tol=1e-9)
    got = {r.id: (r.p_a, r.p_b, r.p_one) for r in model.transform(df, "features", ["id"]).collect()}
    for j, c in enumerate(("a", "b")):
        fit = LogisticRegression(labelCol=c, regParam=0.1, tol=1e-12, maxIter=500).fit(df.filter(F.col(c).isNotNull()))
        assert np.abs(fit.coefficients.toArray() - model.coefficients[j]).max() < 1e-6
        for r in fit.transform(df).select("id", "probability").collect():
            assert abs(got[r.id][j] - r.probability[1]) < 1e-6
    assert all(p[2] == 1.0 for p in got.values())
    worst = multilabel.vector_certificate(df, "features", multilabel.fit_labels(df, "features", ["a", "b"], 30, tol=1e-9), 0.1)
    assert {r.label: r.n_rows for r in worst.collect()} == {"a": 400, "b": 355}
    assert all(r.largest_gradient < 1e-6 for r in worst.collect())
    df.unpersist()


def test_tree_tables_score_like_the_models(spark):
    from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler, VectorIndexer
    from pyspark.ml.functions import vector_to_array
    from spindle.operators import trees
    df = spark.range(300).selectExpr("cast(id % 7 as double) a", "cast(id % 31 as double) b",
                                     "cast((id % 7 in (1, 2, 5)) = (id % 31 > 12) as double) label")
    x = VectorAssembler(inputCols=["a", "b"], outputCol="raw").transform(df)
    x = VectorIndexer(inputCol="raw", outputCol="features", maxCategories=8).fit(x).transform(x)     # a: categorical splits
    for learner in (DecisionTreeClassifier(maxDepth=4), RandomForestClassifier(numTrees=5, maxDepth=3, seed=2)):
        model = learner.fit(x)
        table = trees.tree_table(spark, model)
        assert table.filter("categories is not null").count() > 0
        own = vector_to_array("features")
        out = model.transform(x).select(vector_to_array("probability")[1].alias("p"),
                                        trees.tree_probability(table, [own[i] for i in range(2)]).alias("q")).collect()
        assert all(abs(r.p - r.q) < 1e-12 for r in out)


def test_workloads_leave_nothing_cached(spark):
    from spindle.queries import registry
    from tests.conftest import SMALL
    spark.catalog.clearCache()
    for name in ("income_model", "risk_model", "auc_roc", "kmeans_assign", "lr_l2_certificate"):
        registry()[name][0](spark, SMALL).count()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def _plain_rounds(rows, k, rounds):
    """Candidates of every group by one round after another over all rows, in plain Python."""
    import hashlib
    from collections import Counter
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    groups = {g: Counter(r[1:] for r in rows if r[0] == g) for g in {r[0] for r in rows}}
    text = {p: "|".join(str(x) for x in p) for each in groups.values() for p in each}
    near = lambda p, found: min(sum((a - b) ** 2 for a, b in zip(p, c)) for c in found)
    found = {g: {min(each, key=lambda p: md5(text[p]))} for g, each in groups.items()}
    turn = 0
    while True:
        turn += 1
        d = {g: {p: near(p, found[g]) for p in each} for g, each in groups.items()}
        phi = {g: sum(n * d[g][p] for p, n in each.items()) for g, each in groups.items()}
        if turn > rounds and not any(len(found[g]) < k and phi[g] > 0 for g in groups):
            return {(g, *p) for g in groups for p in found[g]}, turn - 1
        for g, each in groups.items():
            found[g] |= {p for p in each if d[g][p] > 0
                         and int(md5(f"{turn}:{text[p]}")[:13], 16) / 2 ** 52 < 2 * k * d[g][p] / phi[g]}


def test_later_rounds_of_copied_points_equal_plain_rounds_in_few_passes(spark, monkeypatch):
    # every point comes 400 times: a round draws 0.02 points a group, so that 4 candidates take hundreds of rounds
    rows = [(g, float(i % 7), float(i % 5) + off) for g, off in (("a", 0.0), ("b", 50.0)) for i in range(35)] * 400
    rows += [("c", 1.0, 1.0)] * 3                    # fewer distinct points than k
    want, turns = _plain_rounds(rows, 4, 2)
    assert turns > 100
    names = []
    written = cluster.materialized
    monkeypatch.setattr(cluster, "materialized", lambda df, name="table": names.append(name) or written(df, name))
    points = spark.createDataFrame(rows, "g string, x double, y double").repartition(4)
    found = cluster.start_candidates(points, "g", ["x", "y"], 4)
    got = [tuple(r) for r in found.select("g", "x", "y").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert len(names) < 60


def test_later_rounds_end_where_copies_hide_the_rest(spark):
    # copies of one far point hold nearly all of the spread: unlike points are drawn by their copies in the end
    rows = [("g", 0.0, float(i)) for i in range(30)] + [("g", 1e6, 0.0)] * 3000
    points = spark.createDataFrame(rows, "g string, x double, y double").repartition(4)
    assert cluster.start_candidates(points, "g", ["x", "y"], 4).count() >= 4


def test_digits_below_agree_with_the_draw(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("t"), (F.rand(3) * 1.1).alias("c"))
    draw = cluster._draw(F.col("t"), 7)
    df = df.unionByName(df.select("t", draw.alias("c"))).unionByName(df.select("t", (draw + F.lit(2.0 ** -53)).alias("c")))
    at = F.lit(7)
    assert df.filter((draw < F.col("c")) != (cluster._digits(F.col("t"), at) < cluster._digits_below(F.col("c")))).isEmpty()


def test_kmeans_per_group_of_copied_lineitems_starts_in_few_passes(spark, tmp_path, monkeypatch):
    from spindle.queries import clustering
    rows = [(g, float(q), d / 100, 0.02 * (q % 3)) for g in "ANR" for q in range(1, 13) for d in range(3)]
    df = spark.createDataFrame(rows, "l_returnflag string, l_quantity double, l_discount double, l_tax double")
    df.crossJoin(spark.range(500)).drop("id").write.parquet(f"{tmp_path}/lineitem.parquet")
    names = []
    written = cluster.materialized
    monkeypatch.setattr(cluster, "materialized", lambda df, name="table": names.append(name) or written(df, name))
    got = clustering.q_kmeans_per_group(spark, str(tmp_path), max_iter=2).groupBy("l_returnflag").count().collect()
    assert {r.l_returnflag: r["count"] for r in got} == {"A": 4, "N": 4, "R": 4}
    assert len([n for n in names if n != "kmeans-step"]) < 60


def test_grouped_kmeans_keeps_distinct_points_and_equals_plain_steps(spark, monkeypatch):
    # unlike numbers of copies: rounds and steps read each point once, weighted with its rows
    points = [(g, float(x), float((x * x) % 7) + off) for g, off in (("a", 0.0), ("b", 30.0)) for x in range(25)]
    rows = [p for i, p in enumerate(points) for _ in range(1 + 40 * (i % 3))] + [("a", None, 1.0), (None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(4)
    start = {r.g: [tuple(c) for c in r._centers]
             for r in cluster.initial_centers(df.na.drop(), "g", ["x", "y"], 4).collect()}
    kept, persist = [], type(df).persist
    monkeypatch.setattr(type(df), "persist", lambda self, *a: kept.append(self.count()) or persist(self, *a))
    model = cluster.fit_grouped_kmeans(df, "g", ["x", "y"], k=4, max_iter=5)
    assert kept == [len(points)]
    for g, centers in start.items():
        mine = [p[1:] for p in rows if p[0] == g and None not in p]
        for _ in range(5):
            nearest = [min(range(len(centers)), key=lambda j: (sum((a - b) ** 2 for a, b in zip(p, centers[j])), j)) for p in mine]
            of = [[p for p, n in zip(mine, nearest) if n == j] for j in range(len(centers))]
            centers = [tuple(sum(x) / len(x) for x in zip(*ps)) if ps else c for ps, c in zip(of, centers)]
        got = [(r.x, r.y) for r in model.centers.filter(F.col("g") == g).orderBy("cluster").collect()]
        assert len(got) == len(centers) and all(a == pytest.approx(b, abs=1e-9) for a, b in zip(got, centers))
