"""Learning to rank over the scores of several recommenders."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.models.base import assembled, class_probability
from cohortlens.operators.feature_tables import ranking_samples
from cohortlens.operators.recommend import best_courses, wide_scores
from cohortlens.session import reliable_checkpoint


@dataclass
class Ranker:
    models: list[str]
    model: object

    def recommend(self, scores: DataFrame, n: int = 10) -> DataFrame:
        """Re-rank the union of the recommenders' lists by the learned relevance."""
        wide = wide_scores(scores, self.models)
        scored = self.model.transform(assembled(wide, self.models)).withColumn("score", class_probability())
        return best_courses(scored.select("student_id", "course_id", "score"), n)


def fit_ranker(scores: DataFrame, positives: DataFrame, rounds: int = 5, depth: int = 3, seed: int = 42) -> Ranker:
    """Pointwise boosted trees: enrolled against other recommended courses, weighted alike per student."""
    samples = ranking_samples(scores, positives)
    models = [c for c in samples.columns if c not in ("student_id", "course_id", "label", "query_id")]
    sizes = samples.groupBy("query_id").agg(F.count("*").alias("_n"))
    weighted = samples.join(sizes, "query_id").withColumn("weight", 1.0 / F.col("_n"))
    ready = assembled(weighted, models).select("features", F.col("label").cast("double").alias("label"), "weight")
    learner = GBTClassifier(weightCol="weight", maxIter=rounds, maxDepth=depth, seed=seed)
    return Ranker(models, learner.fit(ready))


@dataclass
class PairwiseRanker:
    """Linear relevance of the recommenders' scores, learned from pairs."""

    models: list[str]
    weights: np.ndarray

    def recommend(self, scores: DataFrame, n: int = 10) -> DataFrame:
        """Re-rank the union of the recommenders' lists by the learned relevance."""
        wide = wide_scores(scores, self.models)
        relevance = F.lit(0.0)
        for m, w in zip(self.models, self.weights):
            relevance = relevance + F.coalesce(F.col(f"`{m}`"), F.lit(0.0)) * float(w)
        return best_courses(wide.select("student_id", "course_id", relevance.alias("score")), n)


def student_lists(samples: DataFrame, models: list[str]) -> DataFrame:
    """One row per student that has both: the features of enrolled and of other listed courses."""
    x = F.array(*[F.col(f"`{m}`").cast("double") for m in models])
    packed = samples.groupBy("query_id").agg(
        F.collect_list(F.when(F.col("label") == 1, x)).alias("good"), F.collect_list(F.when(F.col("label") == 0, x)).alias("bad")
    )
    return packed.where((F.size("good") > 0) & (F.size("bad") > 0)).select("good", "bad")


def pair_derivatives(lists: DataFrame, weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, gradient and curvature of the mean over students of the mean over pairs of log(1 + exp(s_bad - s_good)).

    The pairs of a student exist as a matrix of score differences only. A task sums up its
    students, and the tasks' sums are added by Spark.
    """
    m = len(weights)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(2 + m + m * m)
        for batch in batches:
            for good, bad in zip(batch["good"], batch["bad"]):
                a, b = np.stack(good), np.stack(bad)
                gap = (a @ weights)[:, None] - (b @ weights)[None, :]
                wrong = 1 / (1 + np.exp(gap))
                share = 1 / gap.size
                total[0] += 1
                total[1] += np.logaddexp(0, -gap).sum() * share
                total[2 : 2 + m] -= (wrong.sum(1) @ a - wrong.sum(0) @ b) * share
                bend = wrong * (1 - wrong)
                cross = a.T @ bend @ b
                square = (a * bend.sum(1)[:, None]).T @ a + (b * bend.sum(0)[:, None]).T @ b - cross - cross.T
                total[2 + m :] += square.ravel() * share
        yield pd.DataFrame({"j": np.arange(len(total)), "value": total})

    parts = lists.mapInPandas(run, "j int, value double").groupBy("j").agg(F.sum("value").alias("value")).collect()
    total = np.zeros(2 + m + m * m)
    for r in parts:
        total[r["j"]] = r["value"]
    n = max(total[0], 1.0)
    return total[1] / n, total[2 : 2 + m] / n, total[2 + m :].reshape(m, m) / n


def fit_pairwise(scores: DataFrame, positives: DataFrame, ridge: float = 1e-3, max_iter: int = 10, tolerance: float = 1e-6) -> PairwiseRanker:
    """Newton steps on the pairwise logistic loss of the ranking samples; a step is halved while it does not help."""
    samples = ranking_samples(scores, positives)
    models = [c for c in samples.columns if c not in ("student_id", "course_id", "label", "query_id")]
    lists = reliable_checkpoint(student_lists(samples, models))
    weights = np.zeros(len(models))
    at = pair_derivatives(lists, weights)
    for _ in range(max_iter):
        loss, gradient, curvature = at
        step = np.linalg.solve(curvature + ridge * np.eye(len(weights)), gradient + ridge * weights)
        for _ in range(20):
            new = weights - step
            found = pair_derivatives(lists, new)
            if found[0] + ridge / 2 * new @ new <= loss + ridge / 2 * weights @ weights + 1e-12:
                break
            step = step / 2
        moved = np.abs(new - weights).max()
        weights, at = new, found
        if moved < tolerance:
            break
    return PairwiseRanker(models, weights)
