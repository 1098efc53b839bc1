"""Course-level features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.expr import flag, one_hot
from cohortlens.operators.categories import dummies
from cohortlens.operators.sparse import LevelTable

TARIFF_LABELS = ["Low", "Medium", "High", "Very High"]


def tariff_band(tariff: Column) -> Column:
    """(0,96] Low, (96,120] Medium, (120,144] High, above Very High; NULL at or below 0."""
    return (
        F.when(tariff <= 0, None)
        .when(tariff <= 96, "Low")
        .when(tariff <= 120, "Medium")
        .when(tariff <= 144, "High")
        .when(tariff > 144, "Very High")
    )


def course_features(courses: DataFrame, levels: LevelTable | None = None) -> DataFrame:
    """Department, tariff band and assessment-style features, one row per course.

    With ``levels`` (of department) the departments are positions ``categories`` of a sparse vector.
    """
    if levels is None:
        departments = dummies(courses, "department", "dept")
    else:
        courses, departments = levels.positions(courses, "categories"), [F.col("categories")]
    banded = courses.withColumn("tariff_band", tariff_band(F.col("entry_tariff")))
    return banded.select(
        "course_id",
        *departments,
        "entry_tariff",
        "tariff_band",
        *one_hot(F.col("tariff_band"), TARIFF_LABELS, "tariff"),
        flag(F.col("course_length_years") == 4).alias("sandwich_year"),
        flag(F.col("coursework_weight_pct") > 60).alias("coursework_heavy"),
        "employment_rate_15m",
        "satisfaction_score",
        F.col("accredited").cast("int").alias("accredited"),
    )
