"""Encoders and text features, cross-checked against MLlib estimators."""

import math

import pytest
from pyspark.ml.feature import (IDF, HashingTF, StandardScaler, StringIndexer, Tokenizer,
                                VectorAssembler)
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from spindle.functions.stopwords import ENGLISH_STOP_WORDS
from spindle.functions.text import clean_text
from spindle.operators import encode, text


def test_string_index_matches_stringindexer_order(spark):
    df = spark.createDataFrame([(v,) for v in "b a c a b d".split()], "c string")
    ours = {r.value: r.label_index for r in encode.fit_string_indexes(df, ["c"]).collect()}
    m = StringIndexer(inputCol="c", outputCol="i").fit(df)
    assert ours == {v: float(i) for i, v in enumerate(m.labels)}


def test_index_unseen_value_keep_and_skip(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",)], "c string")
    test = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    model = encode.IndexModel.fit(train, ["c"])
    kept = [r.c_index for r in model.transform(test, ["c"]).collect()]
    assert kept == [0.0, 2.0, 2.0]
    assert model.transform(test, ["c"], handle_invalid="skip").count() == 1
    with pytest.raises(ValueError):
        model.transform(test, ["c"], handle_invalid="error")


def test_one_hot_drop_last(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,)], "i double")
    out = encode.one_hot_columns(df, "i", 3, "c").collect()
    assert [(r.c_0, r.c_1) for r in out] == [(1.0, 0.0), (0.0, 1.0), (0.0, 0.0)]


def test_standard_scale_matches_mllib(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (8.0,)], "x double")
    ours = [r.x_scaled for r in encode.standard_scale(df, ["x"]).collect()]
    vec = VectorAssembler(inputCols=["x"], outputCol="v").transform(df)
    theirs = [r.s[0] for r in StandardScaler(inputCol="v", outputCol="s").fit(vec).transform(vec).collect()]
    assert ours == pytest.approx(theirs)


def test_chi2_matches_chisquaretest(spark):
    rows = [(i % 2, i % 3, (i * 7) % 5) for i in range(200)]
    df = spark.createDataFrame(rows, "y int, a int, b int")
    ours = {r.feature: (r.statistic, r.dof) for r in encode.chi2_statistics(df, "y", ["a", "b"]).collect()}
    vec = VectorAssembler(inputCols=["a", "b"], outputCol="v").transform(df)
    t = ChiSquareTest.test(vec, "v", "y").first()
    assert ours["a"][0] == pytest.approx(t.statistics[0]) and ours["a"][1] == t.degreesOfFreedom[0]
    assert ours["b"][0] == pytest.approx(t.statistics[1]) and ours["b"][1] == t.degreesOfFreedom[1]


def test_clean_text_rules(spark):
    df = spark.createDataFrame([("Héllo, World\nfoo 42!",), ("",), (None,)], "t string")
    out = [r.c for r in df.select(clean_text("t").alias("c")).collect()]
    assert out == ["hllo worldfoo ", "", None]        # accents/digits go, words fuse at breaks


def test_tokens_and_stop_words(spark):
    df = spark.createDataFrame([("the  cat and The dog",)], "t string")
    r = df.select(text.tokens("t").alias("tok")).select(
        "tok", text.without_stop_words("tok").alias("w")).first()
    assert r.tok == ["the", "cat", "and", "the", "dog"] and r.w == ["cat", "dog"]
    assert len(ENGLISH_STOP_WORDS) == 181


def test_stop_word_list_equals_estimator_default(spark):
    from pyspark.ml.feature import StopWordsRemover
    assert ENGLISH_STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")


def test_idf_matches_mllib_idf(spark):
    docs = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["b"]), (3, ["c", "b"]), (4, [])],
                                 "id int, words array<string>")
    model = text.fit_idf(docs, "words")
    ours = {r.term: r.idf for r in model.table.collect()}
    assert model.n_docs == 4
    assert ours["a"] == pytest.approx(math.log(5 / 2)) and ours["b"] == pytest.approx(math.log(5 / 4))
    tf = HashingTF(inputCol="words", outputCol="tf", numFeatures=1 << 10).transform(docs)
    idf = IDF(inputCol="tf", outputCol="x").fit(tf)
    h = HashingTF(numFeatures=1 << 10)
    assert idf.idf[h.indexOf("a")] == pytest.approx(ours["a"])
    # unseen term gets ln((N+1)/1)
    test_tf = text.term_frequency(spark.createDataFrame([(9, ["zzz"])], "id int, words array<string>"),
                                  "id", "words")
    r = model.transform(test_tf, "id").first()
    assert r.idf == pytest.approx(math.log(5.0))


def test_tokens_drop_empty_vs_tokenizer(spark):
    df = spark.createDataFrame([("a  b",)], "t string")
    assert Tokenizer(inputCol="t", outputCol="w").transform(df).first().w == ["a", "", "b"]
    assert df.select(text.tokens("t").alias("w")).first().w == ["a", "b"]


def test_index_join_keeps_unseen_values(spark):
    df = spark.createDataFrame([(f"v{i % 7}",) for i in range(50)] + [("zz",)], "c string")
    test = spark.createDataFrame([("v1",), ("nope",), (None,)], "c string")
    m = encode.IndexModel.fit(df, ["c"])
    assert {r.c: r.c_index for r in m.transform(test, ["c"]).collect()} == {"v1": 1.0, "nope": 8.0, None: 8.0}


def test_string_index_ties_many_frequencies(spark):
    rows = [(v,) for v, n in [("a", 3), ("b", 3), ("c", 1), ("d", 2), ("e", 1), ("f", 3)] for _ in range(n)]
    df = spark.createDataFrame(rows, "c string")
    ours = {r.value: r.label_index for r in encode.fit_string_indexes(df, ["c"]).collect()}
    assert ours == {"a": 0.0, "b": 1.0, "f": 2.0, "d": 3.0, "c": 4.0, "e": 5.0}


def test_string_index_many_values_without_exchange_reuse(spark):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        df = spark.range(400_000).select(F.concat(F.lit("a"), "id").alias("a"), (F.col("id") % 3).alias("b"))
        got = encode.fit_string_indexes(df, ["a", "b"]).groupBy("column_name").agg(
            F.count_distinct("label_index").alias("k"), F.min("label_index").alias("lo"), F.max("label_index").alias("hi"))
        assert {r.column_name: (r.k, r.lo, r.hi) for r in got.collect()} == {"a": (400_000, 0.0, 399_999.0), "b": (3, 0.0, 2.0)}
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_idf_least_document_frequency_matches_mllib(spark):
    docs = spark.createDataFrame([(0, ["a", "b"]), (1, ["a"]), (2, ["c", "a"])], "id int, w array<string>")
    table = text.fit_idf(docs, "w", min_doc_freq=2)
    tf = text.term_frequency(docs, "id", "w")
    got = {r.term: r.idf for r in table.transform(tf, "id").collect()}
    assert got["b"] == got["c"] == 0.0 and abs(got["a"] - 0.0) < 1e-12


def test_encoding_pipeline_raises_on_null_numbers_and_zeroes_unseen_categories(spark):
    from spindle.operators.encode import encoding_pipeline
    train = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 3.0)], "c string, x double")
    model = encoding_pipeline(["c"], ["x"]).fit(train)
    seen = {r.c: r.features.toArray().tolist() for r in model.transform(
        spark.createDataFrame([("a", 5.0), ("b", 5.0), ("new", 5.0)], "c string, x double")).collect()}
    assert seen == {"a": [1.0, 0.0, 5.0], "b": [0.0, 1.0, 5.0], "new": [0.0, 0.0, 5.0]}
    with pytest.raises(Exception, match="(?i)null"):
        model.transform(spark.createDataFrame([("a", None)], "c string, x double")).collect()


def test_slot_table_equals_the_mllib_pipeline(spark):
    from spindle.operators.assemble import SlotTable
    rows = [(i, f"c{i % 5}", "xyz"[i % 3], float(i % 11), float(i)) for i in range(60)]
    train = spark.createDataFrame(rows, "id long, c string, d string, n double, m double")
    test = spark.createDataFrame([(100, "new", "x", 0.0, 1.0), (101, "c1", None, 2.0, 0.0), (102, "c1", "z", 5.0, 2.5)],
                                 "id long, c string, d string, n double, m double")
    table = SlotTable.fit(train, ["c", "d"], ["n", "m"])
    pipe = encode.encoding_pipeline(["c", "d"], ["n", "m"]).fit(train)
    for frame in (train, test):
        want = {r.id: r.features.toArray().tolist() for r in pipe.transform(frame).select("id", "features").collect()}
        got = table.transform(frame, "id").collect()
        assert len(got) == len(want)
        for r in got:
            dense = [0.0] * r["size"]
            for i, v in zip(r["indices"], r["values"]):
                dense[i] = v
            assert dense == want[r.id] and r["indices"] == sorted(r["indices"])
    missing = spark.createDataFrame([(1, "c1", "x", None, 1.0), (2, "c1", "x", 1.0, 1.0)], train.schema)
    with pytest.raises(Exception, match="NULL in a number column"):
        table.transform(missing, "id").collect()
    assert [r.id for r in table.transform(missing, "id", "skip").collect()] == [2]
    kept = {r.id: r["values"] for r in table.transform(missing, "id", "keep").collect()}
    assert kept[1][2] != kept[1][2]                                     # NaN
    names = [r.name for r in table.table.orderBy("slot").collect()]
    assert names[-2:] == ["n", "m"] and len(names) == 10


def test_chi2_tail_and_selection_beyond_mllib_limit(spark):
    from pyspark.ml.feature import ChiSqSelector, VectorAssembler
    from pyspark.ml.stat import ChiSquareTest
    from spindle.functions.special import chi2_upper_tail, log_gamma
    import math
    got = spark.createDataFrame([(0.3,), (1.0,), (7.5,), (900.0,)], "z double").select("z", log_gamma(F.col("z")).alias("g")).collect()
    assert all(abs(r.g - math.lgamma(r.z)) < 1e-9 * max(1, abs(r.g)) for r in got)
    tail = spark.createDataFrame([(3.841459, 1), (18.307038, 10), (0.0, 3), (16000.0, 15000), (14000.0, 15000)], "x double, d int")
    p = [r.p for r in tail.select(chi2_upper_tail(F.col("x"), F.col("d")).alias("p")).collect()]
    assert p[0] == pytest.approx(0.05, abs=1e-6) and p[1] == pytest.approx(0.05, abs=1e-6) and p[2] == 1.0
    assert p[3] < 1e-7 and p[4] > 1 - 1e-7
    df = spark.range(600).selectExpr("cast(id % 2 as int) label", "cast(id % 4 as double) a", "cast(id % 7 as double) b",
                                     "cast(id as double) wide", "1.0 constant")
    out = {r.feature: r for r in encode.chi2_selected(df, "label", ["a", "b", "wide", "constant"]).collect()}
    x = VectorAssembler(inputCols=["a", "b", "wide"], outputCol="features").transform(df)
    want = ChiSquareTest.test(x, "features", "label").first().pValues.toArray().tolist()
    assert [out[f].p_value for f in ("a", "b", "wide")] == pytest.approx(want, abs=1e-9)
    assert out["a"].selected and not out["b"].selected and not out["constant"].selected


def test_estimator_tokens_follow_the_tokenizer(spark):
    from pyspark.ml.feature import Tokenizer
    df = spark.createDataFrame([(" a  b ",), ("",), ("  ",), ("A\tb\n\nC",), ("x",), ("\n x \t\t",), ("tail  ",)], "t string")
    want = Tokenizer(inputCol="t", outputCol="w").transform(df).collect()
    got = df.select("t", text.estimator_tokens("t").alias("w")).collect()
    assert [r.w for r in got] == [r.w for r in want]


def test_term_frequency_counts_inside_the_row(spark):
    df = spark.createDataFrame([(1, ["b", "a", "b"]), (2, []), (3, None), (4, ["é", "é", "é", "z"])], "id int, w array<string>")
    out = text.term_frequency(df.repartition(3), "id", "w")
    assert sorted((r.id, r.term, r.tf) for r in out.collect()) == [(1, "a", 1), (1, "b", 2), (4, "z", 1), (4, "é", 3)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan


def test_clean_text_keeps_the_same_code_points(spark):
    from spindle.functions.text import strip_non_letters
    kept = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ \t\n\x0b\f\r"
    points = [p for p in [*range(0x3000), 0x212a, 0xfeff, 0xff21, 0x1d400, 0x1f600, 0x10ffff]]
    df = spark.createDataFrame([(p, "a" + chr(p) + chr(p) + "Z") for p in points], "p int, t string")
    got = {r.p: r.s for r in df.select("p", strip_non_letters("t").alias("s")).collect()}
    assert got == {p: "a" + (chr(p) * 2 if chr(p) in kept else "") + "Z" for p in points}


def test_clean_text_costs_about_as_much_as_a_plain_replacement(spark):
    import time
    from spindle.functions.text import strip_non_letters
    text = F.repeat(F.lit("Some words, 12 of them; and a few more - then it ends.\n"), 2000)
    df = spark.range(80).select(F.concat(F.col("id").cast("string"), text).alias("t")).repartition(4).persist()
    df.count()

    def seconds(c):
        took = []
        for _ in range(4):
            t = time.perf_counter()
            df.agg(F.sum(F.length(c))).collect()
            took.append(time.perf_counter() - t)
        return min(took)
    plain, ours = seconds(F.regexp_replace("t", "[0-9]+", "")), seconds(strip_non_letters("t"))
    df.unpersist()
    assert ours < 5 * plain
