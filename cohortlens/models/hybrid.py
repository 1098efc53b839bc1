"""One entry point over the recommenders."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.models.ranker import PairwiseRanker, Ranker
from cohortlens.operators import recommend
from cohortlens.operators.mmr import mmr

MODES = ["ensemble", "ltr", "mmr", "hybrid"]


@dataclass
class HybridRecommender:
    """Fuses, learns, diversifies and routes.

    ``scores`` is the long table (student_id, course_id, model, score) of the
    recommenders' lists. Students without history take the routed model's list; all
    others go through the mode. Lists are made diverse from all fused courses, or from the
    first ``candidates`` of them.
    """

    scores: DataFrame
    weights: Mapping[str, float]
    vectors: DataFrame
    mode: str = "ensemble"
    ranker: Ranker | PairwiseRanker | None = None
    candidates: int | None = None
    diversity: float = 0.7

    def ranked(self, scores: DataFrame, n: int) -> DataFrame:
        if self.mode == "ltr":
            if self.ranker is None:
                raise ValueError("mode ltr needs a fitted ranker")
            return self.ranker.recommend(scores, n)
        return recommend.ensemble(scores, self.weights, n)

    def recommend(self, routes: DataFrame, n: int = 10) -> DataFrame:
        """(student_id, course_id, rank, score); ``routes`` is (student_id, route)."""
        if self.mode not in MODES:
            raise ValueError(f"unknown mode {self.mode}")
        warm = routes.where(F.col("route") == recommend.ROUTES[0]).select("student_id")
        cold = routes.where(F.col("route") != recommend.ROUTES[0])
        diverse = self.mode in ("mmr", "hybrid")
        # a student has at most as many courses as the recommenders' lists together
        listed = self.ranked(self.scores.join(warm, "student_id", "left_semi"), (self.candidates or 2**31 - 1) if diverse else n)
        if diverse:
            listed = mmr(listed, self.vectors, n, self.diversity)
        out = ["student_id", "course_id", "rank", "score"]
        other = recommend.best_courses(recommend.routed(cold, self.scores), n)
        return listed.where(F.col("rank") <= n).select(*out).unionByName(other.select(*out))

    def explain(self, pairs: DataFrame) -> DataFrame:
        wanted = self.scores.join(pairs.select("student_id", "course_id"), ["student_id", "course_id"], "left_semi")
        return recommend.explain_fusion(wanted, recommend.normalised(self.weights))
