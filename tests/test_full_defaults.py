"""Registered training queries use the library's own rounds, folds, trials and iterations."""

import inspect

import pytest

from cohortlens.models import boost, collaborative, multitask, tune
from cohortlens.plans import modelling, recommend  # noqa: F401
from cohortlens.plans.registry import QUERIES

EFFORT = {"rounds", "depth", "k", "trials", "max_iter"}


class Called(Exception):
    pass


def stopping(fn, wanted=None):
    """Instead of the work, raises with what was passed for EFFORT other than the defaults."""

    def call(*args, **kwargs):
        bound = inspect.signature(fn).bind(*args, **kwargs).arguments
        raise Called({n: v for n, v in bound.items() if n in EFFORT and v != inspect.signature(fn).parameters[n].default})

    return call


CASES = [
    ("j10_cross_validate", tune, "cross_validate"),
    ("j11_fold_results", tune, "cross_validate"),
    ("j13_sample_weights", multitask, "fit_heads"),
    ("j14_parameter_search", tune, "search"),
    ("o7_graduate_heads", multitask, "fit_heads"),
    ("o8_survey_heads", multitask, "fit_heads"),
    ("o9_retention_heads", multitask, "fit_heads"),
    ("o10_exam_heads", multitask, "fit_heads"),
    ("o11_wellbeing_heads", multitask, "fit_heads"),
    ("o12_demand_heads", multitask, "fit_heads"),
    ("n5_factorisation", collaborative, "fit_factors"),
    ("n6_factorisation_lists", collaborative, "fit_factors"),
    ("n8_hybrid_factorisation", collaborative, "fit_hybrid"),
    ("n9_neural_factors", collaborative, "fit_factors"),
    ("n9_neural_factors", collaborative, "fit_neural"),
]


@pytest.mark.parametrize("name, module, fn", CASES)
def test_query_uses_defaults(spark, folder, monkeypatch, name, module, fn):
    if fn == "fit_neural":
        monkeypatch.setattr(module, "fit_factors", lambda *a, **k: None)
    monkeypatch.setattr(module, fn, stopping(getattr(module, fn)))
    with pytest.raises(Called) as raised:
        QUERIES[name](spark, folder)
    assert raised.value.args[0] == {}


def test_trainer_uses_defaults(campus, monkeypatch):
    monkeypatch.setattr(boost, "fit_booster", stopping(boost.fit_booster))
    with pytest.raises(Called) as raised:
        modelling.yield_trainer(campus.students, {})
    assert raised.value.args[0] == {}


def test_survival_curves_keep_their_table(spark, folder, monkeypatch):
    """The model reads its table several times; what it was made from is not read again."""
    monkeypatch.setattr(modelling.survival, "fit_cox", lambda table, *a, **k: (_ for _ in ()).throw(Called(table._jdf.queryExecution().executedPlan().toString())))
    with pytest.raises(Called) as raised:
        QUERIES["o14_survival_curves"](spark, folder)
    assert "parquet" not in raised.value.args[0]
