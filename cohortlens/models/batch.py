"""Batch scoring in the shape of the service responses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators import risk


def enrolment_response(scored: DataFrame) -> DataFrame:
    """(student_id, probability, prediction, confidence) of rows with a score."""
    p = F.col("score")
    return scored.select(
        "student_id",
        F.round(p, 4).alias("probability"),
        (p >= 0.5).cast("int").alias("prediction"),
        F.round(F.abs(p - 0.5) * 2, 4).alias("confidence"),
    )


def risk_response(scored: DataFrame) -> DataFrame:
    """(student_id, risk_score, tier, recommended_actions) of rows with a score."""
    value = F.round(F.col("score") * 100, 1)
    named = scored.select("student_id", value.alias("risk_score")).withColumn("tier", risk.tier(F.col("risk_score")))
    return named.withColumn("recommended_actions", risk.actions(F.col("tier")))


def degree_response(scored: DataFrame, classes: Sequence[str]) -> DataFrame:
    """(student_id, predicted_class, class probabilities as a map)."""
    names = F.array(*[F.lit(c) for c in classes])
    return scored.select(
        "student_id",
        F.element_at(names, F.col("p") + 1).alias("predicted_class"),
        F.map_from_arrays(names, F.transform("class_probabilities", lambda x: F.round(x, 4))).alias("class_probabilities"),
    )


def recommendation_response(listed: DataFrame) -> DataFrame:
    """(student_id, recommendations as an ordered array) of top-n lists."""
    cell = F.struct("rank", "course_id", "score")
    packed = listed.groupBy("student_id").agg(F.array_sort(F.collect_list(cell)).alias("r"))
    return packed.select(
        "student_id",
        F.transform("r", lambda x: F.struct(x["course_id"].alias("course_id"), x["score"].alias("score"))).alias("recommendations"),
    )
