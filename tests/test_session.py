"""Shared-folder contract: state goes under the session's checkpoint folder."""

from spindle.operators.common import materialized
from spindle.session import checkpoint_root, shared_path


def test_checkpoint_root_is_session_setting_and_stable(spark):
    root = checkpoint_root(spark)
    assert root == spark.sparkContext.getCheckpointDir()
    assert checkpoint_root(spark) == root          # never replaced once set


def test_materialized_lives_under_checkpoint_root(spark):
    root = checkpoint_root(spark).replace("file:", "")
    df = materialized(spark.range(10).toDF("x"), "contract")
    files = df.inputFiles()
    assert files and all(root in f for f in files)
    assert sorted(r.x for r in df.collect()) == list(range(10))
    a, b = shared_path(spark, "p"), shared_path(spark, "p")
    assert a != b and a.startswith(checkpoint_root(spark).rstrip("/"))
