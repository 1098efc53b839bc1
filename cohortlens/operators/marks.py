"""Assessment-based features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.expr import count_where, safe_ratio, share, std0


def unique_modules(modules: DataFrame) -> DataFrame:
    """One row per module id: the one of the smallest (course, year, credits)."""
    return modules.groupBy("module_id").agg(F.min(F.struct("course_id", "year", "credits")).alias("m")).select(
        "module_id", "m.course_id", "m.year", "m.credits"
    )


def performance_features(assessments: DataFrame, modules: DataFrame, years: Sequence[int] = (1, 2, 3)) -> DataFrame:
    """Mark, submission and resit features per student, in one pass."""
    joined = assessments.join(unique_modules(modules), "module_id", "left")
    mark, year = F.col("mark"), F.col("year")
    by_student = joined.groupBy("student_id").agg(
        F.avg(mark).alias("avg_mark"),
        std0(mark).alias("std_mark"),
        F.min(mark).alias("min_mark"),
        F.max(mark).alias("max_mark"),
        F.count(mark).alias("total_assessments"),
        F.sum("submitted").alias("submitted_count"),
        F.sum("late_submission").alias("late_submission_count"),
        count_where(F.col("attempt") > 1).alias("resit_count"),
        share(mark >= 40).alias("pass_rate"),
        *[F.avg(F.when(year == y, mark)).alias(f"year{y}_avg_mark") for y in years],
    )
    total = F.col("total_assessments")
    first, last = f"year{years[0]}_avg_mark", f"year{years[-1]}_avg_mark"
    return by_student.withColumns(
        {
            "submission_rate": F.try_divide("submitted_count", total),
            "late_submission_rate": F.try_divide("late_submission_count", total),
            "resit_rate": F.try_divide("resit_count", total),
            "performance_trend": F.coalesce(F.col(last) - F.col(first), F.lit(0.0)),
        }
    )


def credit_weighted_mean(mark: Column, credits: Column) -> Column:
    """Aggregate: Σ mark·credits / Σ credits."""
    return F.try_divide(F.sum(mark * credits), F.sum(credits))


def resit_features(assessments: DataFrame) -> DataFrame:
    resit = F.col("attempt") > 1
    counted = assessments.groupBy("student_id").agg(
        count_where(resit).alias("resit_count"),
        count_where(resit & (F.col("mark") >= 40)).alias("resits_passed"),
    )
    return counted.withColumn("resit_success_rate", safe_ratio(F.col("resits_passed"), F.col("resit_count")))


def late_features(assessments: DataFrame) -> DataFrame:
    return assessments.groupBy("student_id").agg(
        F.sum("late_submission").alias("late_submissions"),
        F.avg("late_submission").alias("late_submission_rate"),
    )


def mark_range(assessments: DataFrame) -> DataFrame:
    return assessments.groupBy("student_id").agg(
        F.max("mark").alias("best_mark"),
        F.min("mark").alias("worst_mark"),
        std0(F.col("mark")).alias("std_mark"),
    )


def before_final_year(assessments: DataFrame, modules: DataFrame, n_years: int = 3) -> DataFrame:
    """Assessments of modules below the final year, with year and credits."""
    return assessments.join(unique_modules(modules).drop("course_id"), "module_id").where(F.col("year") < n_years)


def module_history(assessments: DataFrame) -> DataFrame:
    """Mean, spread and count of grades and the completion rate of each module."""
    return assessments.groupBy("module_id").agg(
        F.avg("mark").alias("avg_grade"),
        std0(F.col("mark")).alias("grade_std"),
        F.count("mark").alias("total_enrollments"),
        F.avg("submitted").alias("completion_rate"),
    )


def trend_code(change: Column) -> Column:
    """0 declining (≤ -5), 1 stable (≤ 5), 2 improving, -1 unknown."""
    return F.when(change.isNull(), -1).when(change <= -5, 0).when(change <= 5, 1).otherwise(2)


def module_year(code: Column) -> Column:
    """Year of study from a module code: ``…_MODnn`` by blocks of four, ``ABCD2001`` by its first digit."""
    position = F.regexp_extract(code, r"_MOD(\d+)$", 1).try_cast("int")
    digit = F.regexp_extract(code, r"^[A-Z]+([1-9])\d{3}$", 1).try_cast("int")
    by_position = F.when(position >= 1, F.floor((position - 1) / 4) + 1)
    return F.coalesce(by_position, digit, F.lit(1)).cast("int")
