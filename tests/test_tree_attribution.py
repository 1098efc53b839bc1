"""Exact contributions of boosted trees against all subsets."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohortlens.models import boost, explain
from cohortlens.models.base import assembled

NAMES = list("abcde")


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(500, 5)).round(2)
    y = ((x[:, 0] * x[:, 1] > 0) ^ (x[:, 2] > 0.5)).astype(int)
    rows = spark.createDataFrame([(i, *map(float, v), int(t)) for i, (v, t) in enumerate(zip(x, y))], "student_id long, a double, b double, c double, d double, e double, y int").persist()
    return rows, boost.fit_booster(rows, "y", NAMES, rounds=4, depth=4)


def value(leaves, x, known):
    """Expected margin when only the features in ``known`` are known."""
    total = 0.0
    for leaf in leaves:
        p = leaf.value
        for f, lo, hi, share in zip(leaf.features, leaf.low, leaf.high, leaf.share):
            p *= float(lo < x[f] <= hi) if f in known else share
        total += p
    return total


def test_contributions_equal_all_subsets(fitted):
    rows, model = fitted
    leaves = explain.boosted_leaves(model.model)
    few = rows.limit(12)
    got = {(r["student_id"], r["feature"]): r["contribution"] for r in explain.tree_contributions(few, NAMES, model.model).collect()}
    for r in few.collect():
        x = [r[n] for n in NAMES]
        for f, name in enumerate(NAMES):
            want = 0.0
            for k in range(5):
                for s in combinations([j for j in range(5) if j != f], k):
                    want += factorial(k) * factorial(4 - k) / factorial(5) * (value(leaves, x, {*s, f}) - value(leaves, x, set(s)))
            assert got[r["student_id"], name] == pytest.approx(want, abs=1e-12)


def test_contributions_add_up_to_the_margin(fitted):
    rows, model = fitted
    sums = explain.tree_contributions(rows, NAMES, model.model).groupBy("student_id").agg(F.sum("contribution").alias("s"))
    leaves = explain.boosted_leaves(model.model)
    mean = sum(leaf.value * np.prod(leaf.share) for leaf in leaves)
    scored = model.model.transform(assembled(rows, NAMES)).select("student_id", vector_to_array("rawPrediction")[1].alias("margin"))
    for r in scored.join(sums, "student_id").collect():
        # the classifier's raw prediction is the trees' weighted sum
        assert r["margin"] == pytest.approx(r["s"] + mean, abs=1e-9)
    assert explain.tree_contributions(rows.limit(0), NAMES, model.model).count() == 0
