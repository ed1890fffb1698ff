"""Workload plans end to end on sf0.001: shape and sanity of the metrics."""

import pytest

from tests.conftest import SMALL


@pytest.mark.parametrize("learner", ["lr", "tree"])
def test_risk_plan_metrics(spark, learner):
    from spindle.plans.risk import run_risk
    rows = {r.split: r for r in run_risk(spark, SMALL, learner).collect()}
    assert set(rows) == {"train", "test"}
    for r in rows.values():
        assert r.tp + r.tn + r.fp + r.fn > 0
        assert 0.0 <= r.auc_roc <= 1.0 and 0.0 <= r.auc_pr <= 1.0
        assert r.accuracy_pct == pytest.approx(100.0 * r.accuracy, abs=1e-4)


def test_income_plan_with_coefficients(spark):
    from spindle.plans.income import run_income
    metrics, coefs = run_income(spark, SMALL, with_coefficients=True)
    assert {r.split for r in metrics.collect()} == {"train", "test"}
    names = [r.feature for r in coefs.collect()]
    assert names[-1] == "(intercept)" and "n_orders" in names
    assert not any("?" in n for n in names)          # markers were imputed before encoding


def test_multilabel_plan_probabilities(spark):
    from spindle.plans.text_scoring import run_multilabel
    out = run_multilabel(spark, SMALL)
    assert out.columns == ["doc_id", "p_quality", "p_toxic"]
    rows = out.collect()
    assert rows and all(0.0 <= r.p_quality <= 1.0 and 0.0 <= r.p_toxic <= 1.0 for r in rows)
