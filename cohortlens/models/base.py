"""Assembly and scoring helpers shared by the training jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def feature_names(df: DataFrame, leave_out: Sequence[str] = ()) -> list[str]:
    """Numeric columns that are neither ids, labels (``y_…``, target) nor weights."""
    fixed = {"student_id", "course_id", "module_id", "target", "weight", "part", "fold", *leave_out}
    numeric = {"int", "bigint", "double", "float", "smallint", "tinyint"}
    return [c for c, t in df.dtypes if t in numeric and c not in fixed and not c.startswith("y_")]


def assembled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Add the vector column ``features``; missing numbers count as zero."""
    filled = df.fillna(0, subset=list(features))
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(filled)


def class_probability(k: int = 1, column: str = "probability") -> Column:
    return vector_to_array(F.col(column))[k]


def probabilities(n: int, column: str = "probability", prefix: str = "prob_") -> list[Column]:
    cells = vector_to_array(F.col(column))
    return [cells[k].alias(f"{prefix}{k}") for k in range(n)]


def at_threshold(score: Column, threshold: float = 0.5) -> Column:
    return (score >= threshold).cast("int")
