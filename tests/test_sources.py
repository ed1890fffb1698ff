"""CSV sources: trimming, null markers, quoted multi-line fields, pairs."""

import os

from spindle.session import shared_path
from spindle.sources import read_csv, read_pair, write_csv


def _write(spark, name, text):
    path = shared_path(spark, name)
    os.makedirs(path.replace("file:", ""), exist_ok=True)
    with open(os.path.join(path.replace("file:", ""), "part.csv"), "w") as fh:
        fh.write(text)
    return path


def test_trim_and_infer(spark):
    path = _write(spark, "trim", "id, name ,score\n 1 ,  ann , 2.5\n2,bob  ,3\n")
    df = read_csv(spark, path, infer_schema=True, trim=True)
    assert df.columns == ["id", "name", "score"]
    assert dict(df.dtypes) == {"id": "int", "name": "string", "score": "double"}
    assert [tuple(r) for r in df.orderBy("id").collect()] == [(1, "ann", 2.5), (2, "bob", 3.0)]


def test_null_marker_at_read(spark):
    path = _write(spark, "na", "a,b\n1,NA\n2,3.5\n")
    df = read_csv(spark, path, schema="a int, b double", null_value="NA")
    assert [tuple(r) for r in df.orderBy("a").collect()] == [(1, None), (2, 3.5)]


def test_multiline_quoted_text(spark):
    text = 'id,comment_text,toxic\n1,"hello ""world""\nnext line",0\n2,"",1\n'
    path = _write(spark, "ml", text)
    df = read_csv(spark, path, schema="id int, comment_text string, toxic int", multiline=True)
    rows = {r.id: (r.comment_text, r.toxic) for r in df.collect()}
    assert rows[1] == ('hello "world"\nnext line', 0)
    assert rows[2][1] == 1 and df.count() == 2
    # without the multi-line option the record splits and a label turns NULL
    broken = read_csv(spark, path, schema="id int, comment_text string, toxic int")
    assert broken.count() > 2


def test_write_and_read_pair_roundtrip(spark):
    df = spark.createDataFrame([(1, "a\nb"), (2, 'q"x'), (3, None)], "id bigint, text string")
    base = shared_path(spark, "pair")
    write_csv(df.filter("id < 3"), f"{base}/train", multiline_safe=True)
    write_csv(df.filter("id >= 3"), f"{base}/test", multiline_safe=True)
    train, test = read_pair(spark, base, schema="id bigint, text string", multiline=True)
    assert sorted(tuple(r) for r in train.collect()) == [(1, "a\nb"), (2, 'q"x')]
    assert [r.id for r in test.collect()] == [3]
