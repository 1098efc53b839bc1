"""Pairwise ranking and the modes of the hybrid recommender."""

import numpy as np
import pytest

from cohortlens.models import hybrid, ranker
from cohortlens.plans.features import model_scores
from cohortlens.plans.recommend import SERVED_WEIGHTS, course_vectors, routes, served_scores


@pytest.fixture(scope="module")
def samples(spark):
    """Enrolled courses score higher with model a; b is noise."""
    rng = np.random.default_rng(3)
    rows = []
    for s in range(60):
        for k in range(int(rng.integers(1, 8))):
            label = int(k < 2)
            rows.append((s, k, float(rng.normal(label * 1.5, 1)), float(rng.normal()), label, s))
    return spark.createDataFrame(rows, "student_id long, course_id long, a double, b double, label int, query_id long")


def test_derivatives_equal_explicit_pairs(samples):
    w = np.array([0.3, -0.4])
    loss, gradient, curvature = ranker.pair_derivatives(ranker.student_lists(samples, ["a", "b"]), w)
    table = samples.toPandas()
    losses, slopes, bends = [], [], []
    for _, g in table.groupby("query_id"):
        good, bad = (g[g["label"] == y][["a", "b"]].to_numpy() for y in (1, 0))
        pairs = np.array([x - y for x in good for y in bad])
        if len(pairs):
            p = 1 / (1 + np.exp(pairs @ w))
            losses.append(np.log1p(np.exp(-pairs @ w)).mean())
            slopes.append((-p[:, None] * pairs).mean(0))
            bends.append(np.mean([q * (1 - q) * np.outer(d, d) for q, d in zip(p, pairs)], axis=0))
    assert loss == pytest.approx(np.mean(losses)) and np.allclose(gradient, np.mean(slopes, 0)) and np.allclose(curvature, np.mean(bends, 0))


def test_fit_finds_the_useful_model(spark, samples):
    scores = samples.selectExpr("student_id", "course_id", "stack(2, 'a', a, 'b', b) as (model, score)")
    fitted = ranker.fit_pairwise(scores, samples.where("label = 1"))
    weight = dict(zip(fitted.models, fitted.weights))
    assert weight["a"] > 0.5 and abs(weight["b"]) < weight["a"] / 2
    first = fitted.recommend(scores, 1).join(samples.select("student_id", "course_id", "label"), ["student_id", "course_id"])
    assert first.where("label = 1").count() > 0.7 * first.count()


def test_no_pairs(spark, samples):
    loss, gradient, _ = ranker.pair_derivatives(ranker.student_lists(samples.where("label = 1"), ["a", "b"]), np.zeros(2))
    assert loss == 0 and not gradient.any()


def test_modes_serve_every_student(campus):
    scores, way = served_scores(campus), routes(campus)
    fitted = ranker.PairwiseRanker(["popularity", "matrix_factorization", "content_based"], np.array([0.1, 0.2, 0.3]))
    students = campus.students.count()
    for mode in hybrid.MODES:
        served = hybrid.HybridRecommender(scores, SERVED_WEIGHTS, course_vectors(campus), mode=mode, ranker=fitted).recommend(way, 3)
        rows = served.groupBy("student_id").count().collect()
        assert len(rows) == students and {r["count"] for r in rows} == {3}


def test_lists_are_made_diverse_from_all_courses(campus):
    scores = model_scores(campus)
    every = hybrid.HybridRecommender(scores, {"popularity": 1, "rating": 1}, course_vectors(campus), mode="mmr", diversity=0.1)
    few = hybrid.HybridRecommender(scores, {"popularity": 1, "rating": 1}, course_vectors(campus), mode="mmr", diversity=0.1, candidates=6)
    way = routes(campus)
    assert {tuple(r) for r in every.recommend(way, 3).select("student_id", "course_id").collect()} != {
        tuple(r) for r in few.recommend(way, 3).select("student_id", "course_id").collect()
    }
