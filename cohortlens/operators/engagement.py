"""Attendance and online-activity features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.expr import count_where, std0


def halfterm_trend(x: Column, week: Column, middle: int = 15) -> Column:
    """Aggregate: mean after the middle week minus mean up to it, 0 if a half is missing."""
    return F.coalesce(F.avg(F.when(week > middle, x)) - F.avg(F.when(week <= middle, x)), F.lit(0.0))


def attendance_summary(attendance: DataFrame) -> DataFrame:
    week = F.col("week")
    return attendance.groupBy("student_id").agg(
        F.avg("attended").alias("attendance_rate"),
        std0(F.col("attended")).alias("attendance_std"),
        F.count("week").alias("total_weeks"),
        F.sum("attended").alias("weeks_present"),
        count_where(F.col("status") == "Authorised Absence").alias("authorised_absences"),
        count_where(F.col("status") == "Medical").alias("medical_absences"),
        halfterm_trend(F.col("attended"), week).alias("attendance_trend"),
    )


def vle_summary(vle: DataFrame) -> DataFrame:
    return vle.groupBy("student_id").agg(
        F.sum("logins").alias("total_logins"),
        F.sum("resources_accessed").alias("total_resources"),
        F.sum("forum_posts").alias("total_forum_posts"),
        F.sum("quiz_attempts").alias("total_quiz_attempts"),
        F.sum("video_views").alias("total_video_views"),
        F.sum("total_actions").alias("total_actions"),
        F.avg("logins").alias("avg_logins_per_week"),
        F.avg("resources_accessed").alias("avg_resources_per_week"),
        halfterm_trend(F.col("total_actions"), F.col("week")).alias("vle_engagement_trend"),
        std0(F.col("total_actions")).alias("vle_consistency"),
    )


def engagement_features(attendance: DataFrame, vle: DataFrame) -> DataFrame:
    """Both summaries; a student may be missing from either source."""
    return attendance_summary(attendance).join(vle_summary(vle), "student_id", "full_outer")


def vle_totals(vle: DataFrame) -> DataFrame:
    """The short activity totals used by the outcome jobs."""
    return vle.groupBy("student_id").agg(
        F.sum("logins").alias("total_logins"),
        F.avg("logins").alias("avg_logins"),
        F.sum("resources_accessed").alias("total_resources"),
        F.sum("total_actions").alias("total_actions"),
        F.avg("total_actions").alias("avg_actions"),
    )


def head_tail_trend(weekly: DataFrame, value: str, into: str, span: int | None = None) -> DataFrame:
    """Mean of the last rows minus mean of the first rows of each student, in week order.

    Without ``span`` the two ends are ``n // 2`` rows each, and fewer than 4 rows
    give 0. With ``span`` they are that many rows, and fewer than ``2 * span`` rows
    give 0. ``weekly`` holds one row per student and week, so a student's rows are
    bounded by the length of the calendar.
    """
    mine = Window.partitionBy("student_id")
    ranked = weekly.select(
        "student_id",
        F.col(value).alias("_x"),
        F.row_number().over(mine.orderBy("week")).alias("_at"),
        F.count("*").over(mine).alias("_n"),
    )
    n = F.col("_n")
    ends = F.lit(span) if span else F.floor(n / 2)
    needed = 2 * span if span else 4
    trend = F.avg(F.when(F.col("_at") > n - ends, F.col("_x"))) - F.avg(F.when(F.col("_at") <= ends, F.col("_x")))
    return ranked.groupBy("student_id").agg(
        F.when(F.max("_n") >= needed, trend).otherwise(F.lit(0.0)).alias(into)
    )


def mean_weekly_change(weekly: DataFrame, value: str, into: str) -> DataFrame:
    """Mean difference between consecutive weeks of each student."""
    w = Window.partitionBy("student_id").orderBy("week")
    steps = weekly.select("student_id", (F.col(value) - F.lag(value).over(w)).alias("_step"))
    return steps.groupBy("student_id").agg(F.coalesce(F.avg("_step"), F.lit(0.0)).alias(into))


def observed_weeks(vle: DataFrame, attendance: DataFrame) -> DataFrame:
    """Number of distinct weeks in the richer of the two sources."""
    v = vle.groupBy("student_id").agg(F.count_distinct("week").alias("vle_weeks"))
    a = attendance.groupBy("student_id").agg(F.count_distinct("week").alias("attendance_weeks"))
    return v.join(a, "student_id", "full_outer").select(
        "student_id",
        F.greatest(F.coalesce("vle_weeks", F.lit(0)), F.coalesce("attendance_weeks", F.lit(0))).alias("n_weeks"),
    )


def with_enough_history(vle: DataFrame, attendance: DataFrame, min_weeks: int) -> DataFrame:
    return observed_weeks(vle, attendance).where(F.col("n_weeks") >= min_weeks)


def attendance_percent(attendance: DataFrame) -> DataFrame:
    """Share of sessions attended in percent."""
    return attendance.groupBy("student_id").agg(
        (count_where(F.col("status") == "Present") / F.count("*") * 100).alias("attendance_pct")
    )


def max_normalised_means(vle: DataFrame) -> DataFrame:
    """Mean weekly activity per student, relative to the largest such mean."""
    means = vle.groupBy("student_id").agg(
        F.avg("logins").alias("avg_logins"),
        F.avg("total_actions").alias("avg_actions"),
        F.sum("forum_posts").alias("forum_posts"),
    )
    top_logins = means.agg(F.max("avg_logins")).scalar()
    top_actions = means.agg(F.max("avg_actions")).scalar()
    return means.select(
        "student_id",
        F.when(top_logins > 0, F.col("avg_logins") / top_logins).otherwise(F.col("avg_logins")).alias("avg_logins"),
        F.when(top_actions > 0, F.col("avg_actions") / top_actions).otherwise(F.col("avg_actions")).alias("avg_actions"),
        "forum_posts",
    )


def engagement_rate(totals: DataFrame, plus_one: bool = True) -> Column:
    """Total actions in percent of the largest total (plus one)."""
    top = totals.agg(F.max("total_actions")).scalar()
    return F.col("total_actions") / (top + (1 if plus_one else 0)) * 100
