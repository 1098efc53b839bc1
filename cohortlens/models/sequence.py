"""Classifier over weekly sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.models.base import class_probability
from cohortlens.operators.prep import Scaling
from cohortlens.operators.sequences import WEEKLY, as_arrays


class SequenceModel:
    """A perceptron over the weeks of a student, laid out side by side."""

    def __init__(self, columns: Sequence[str], scaling: Scaling, model):
        self.columns, self.scaling, self.model = list(columns), scaling, model

    def score(self, steps: DataFrame) -> DataFrame:
        ready = flat(self.scaling.transform(steps), self.columns)
        return self.model.transform(ready).select("student_id", class_probability().alias("score"))


def flat(steps: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per student with all weeks in one vector, in week order."""
    return as_arrays(steps, list(columns)).select("student_id", array_to_vector(F.flatten("sequence")).alias("features"))


def fit_sequence(
    steps: DataFrame,
    labels: DataFrame,
    length: int,
    columns: Sequence[str] = WEEKLY,
    hidden: int = 16,
    max_iter: int = 30,
    seed: int = 42,
) -> SequenceModel:
    """``steps`` is (student_id, week 1..length, columns), ``labels`` (student_id, target)."""
    scaling = Scaling.fit(steps, columns)
    ready = flat(scaling.transform(steps), columns).join(labels, "student_id")
    layers = [length * len(columns), hidden, 2]
    learner = MultilayerPerceptronClassifier(labelCol="target", layers=layers, maxIter=max_iter, seed=seed)
    return SequenceModel(columns, scaling, learner.fit(ready.select("features", F.col("target").cast("double").alias("target"))))
