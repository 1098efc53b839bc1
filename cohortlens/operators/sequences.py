"""Weekly feature sequences per student."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.expr import count_where, flag
from cohortlens.operators.engagement import head_tail_trend, with_enough_history

ACTIVITY = ["logins", "resources_accessed", "forum_posts", "quiz_attempts", "video_views", "total_actions"]
ASSESSED = ["avg_mark", "n_assessments", "submission_rate", "late_rate"]
WEEKLY = [*ACTIVITY, "attendance_rate", "absent_count", "authorised_absent", *ASSESSED]


def cumulative_assessments(assessments: DataFrame) -> DataFrame:
    """Assessment statistics up to each week a student has marks in.

    Marks are first summed per student and week, so the window sees one row a week.
    """
    weekly = assessments.groupBy("student_id", "week").agg(
        F.sum("mark").alias("marks"),
        F.count("*").alias("n"),
        F.sum("submitted").alias("submitted"),
        F.sum("late_submission").alias("late"),
    )
    upto = Window.partitionBy("student_id").orderBy("week").rowsBetween(Window.unboundedPreceding, 0)
    n = F.sum("n").over(upto)
    return weekly.select(
        "student_id",
        "week",
        (F.sum("marks").over(upto) / n).alias("avg_mark"),
        n.alias("n_assessments"),
        (F.sum("submitted").over(upto) / n).alias("submission_rate"),
        (F.sum("late").over(upto) / n).alias("late_rate"),
    )


def assessed_so_far(assessments: DataFrame, length: int) -> DataFrame:
    """Assessment statistics for every week 1..length, carried forward from the last week with marks."""
    if "week" not in assessments.columns:
        whole = assessments.groupBy("student_id").agg(
            F.avg("mark").alias("avg_mark"),
            F.count("*").alias("n_assessments"),
            F.avg("submitted").alias("submission_rate"),
            F.avg("late_submission").alias("late_rate"),
        )
        return whole.withColumn("week", F.explode(F.sequence(F.lit(1), F.lit(length))))
    # each state holds from its week to the week before the next one
    states = cumulative_assessments(assessments)
    following = F.lead("week").over(Window.partitionBy("student_id").orderBy("week"))
    spans = states.withColumn("_first", F.greatest(F.col("week"), F.lit(1))).withColumn(
        "_last", F.least(F.coalesce(following - 1, F.lit(length)), F.lit(length))
    )
    return (
        spans.where(F.col("_first") <= F.col("_last"))
        .withColumn("week", F.explode(F.sequence(F.col("_first").cast("int"), F.col("_last").cast("int"))))
        .drop("_first", "_last")
    )


def weekly_sequences(
    vle: DataFrame,
    attendance: DataFrame,
    assessments: DataFrame,
    length: int = 12,
    min_weeks: int = 4,
    as_of_week: int | None = None,
) -> DataFrame:
    """One row per student and step 1..length with thirteen features.

    Students with fewer than ``min_weeks`` observed weeks are left out. Steps after
    a student's last week are zero. By default step = week; with ``as_of_week`` the
    steps are the last ``length`` weeks up to that week.
    """
    shift = 0 if as_of_week is None else max(as_of_week - length, 0)
    keys = ["student_id", "week"]
    acts = vle.groupBy(*keys).agg(*[F.sum(a).alias(a) for a in ACTIVITY])
    present = attendance.groupBy(*keys).agg(
        F.avg("attended").alias("attendance_rate"),
        count_where(F.col("status") == "Absent").alias("absent_count"),
        count_where(F.col("status") == "Authorised Absence").alias("authorised_absent"),
    )
    last = (
        vle.select(*keys).unionByName(attendance.select(*keys)).groupBy("student_id").agg(F.max("week").alias("_last"))
    )
    students = with_enough_history(vle, attendance, min_weeks).select("student_id").join(last, "student_id")
    grid = students.withColumn("week", F.explode(F.sequence(F.lit(1 + shift), F.lit(length + shift))))
    joined = (
        grid.join(acts, keys, "left")
        .join(present, keys, "left")
        .join(assessed_so_far(assessments, length + shift), keys, "left")
    )
    live = F.col("week") <= F.col("_last")
    kinds = dict(joined.dtypes)
    zero = {c: F.lit(0.0) if kinds[c] == "double" else F.lit(0) for c in WEEKLY}
    return joined.select(
        "student_id",
        (F.col("week") - shift).alias("week"),
        *[F.when(live, F.coalesce(F.col(c), zero[c])).otherwise(zero[c]).alias(c) for c in WEEKLY],
    )


def as_arrays(sequences: DataFrame, columns: list[str] = WEEKLY) -> DataFrame:
    """Each student's steps as one array of feature arrays, in step order."""
    step = F.struct("week", F.array(*[F.col(c).cast("double") for c in columns]).alias("x"))
    packed = sequences.groupBy("student_id").agg(F.array_sort(F.collect_list(step)).alias("steps"))
    return packed.select("student_id", F.transform("steps", lambda s: s["x"]).alias("sequence"))


def static_features(students: DataFrame, qualifications: DataFrame) -> DataFrame:
    """The eleven background features that go with a sequence."""
    joined = students.join(qualifications, "student_id", "left")
    return joined.select(
        "student_id",
        flag(F.col("gender") == "Female").alias("female"),
        flag(F.col("gender") == "Male").alias("male"),
        (F.coalesce("imd_decile", F.lit(5)) / 10.0).alias("imd_norm"),
        flag(F.coalesce("polar_quintile", F.lit(3)) == 1).alias("polar_q1"),
        F.coalesce("care_leaver", F.lit(0)).alias("care_leaver"),
        F.coalesce("first_generation_uni", F.lit(0)).alias("first_gen"),
        F.coalesce("disability", F.lit(0)).alias("disability"),
        (F.coalesce("ucas_tariff_points", F.lit(100)) / 168.0).alias("tariff_norm"),
        flag(F.col("qualification_type") == "A-Level").alias("a_level"),
        flag(F.col("qualification_type") == "BTEC").alias("btec"),
        flag(F.col("predicted_grade") == 1).alias("predicted_grade"),
        *[F.lit(0.0).alias(f"reserved_{i}") for i in range(1, 5)],
    )


def event_target(enrollments: DataFrame, kind: str = "both") -> DataFrame:
    """1 for students who dropped out, failed, or either."""
    dropout = F.col("enrollment_status") == "Withdrawn"
    failure = F.coalesce("retained_year2", F.lit(1)) == 0
    rule = {"dropout": dropout, "failure": failure, "both": dropout | failure}[kind]
    return enrollments.select("student_id", flag(rule).alias("target"))


def early_warning_sequences(
    vle: DataFrame,
    attendance: DataFrame,
    assessments: DataFrame,
    students: DataFrame,
    qualifications: DataFrame,
    enrollments: DataFrame,
    length: int = 12,
    min_weeks: int = 4,
    kind: str = "both",
) -> DataFrame:
    """Weekly features with the background features and the target of each student."""
    steps = weekly_sequences(vle, attendance, assessments, length, min_weeks)
    people = event_target(enrollments, kind).join(static_features(students, qualifications), "student_id", "left")
    return steps.join(people, "student_id")


def early_warning_aggregates(
    vle: DataFrame,
    attendance: DataFrame,
    assessments: DataFrame,
    students: DataFrame,
    qualifications: DataFrame,
) -> DataFrame:
    """Twenty-five features per student seen in any source; a missing source counts as zero."""
    v = vle.groupBy("student_id").agg(
        F.sum("logins").alias("vle_total_logins"),
        F.sum("resources_accessed").alias("vle_total_resources"),
        F.sum("forum_posts").alias("vle_total_posts"),
        F.avg("logins").alias("vle_avg_weekly_logins"),
        F.stddev("logins").alias("vle_std_weekly_logins"),
    )
    a = attendance.groupBy("student_id").agg(
        F.avg("attended").alias("attendance_rate"),
        F.stddev("attended").alias("attendance_std"),
        count_where(F.col("status") == "Absent").alias("total_absences"),
        count_where(F.col("status") == "Authorised Absence").alias("authorised_absences"),
        count_where(F.col("status") == "Medical").alias("medical_absences"),
    )
    m = assessments.groupBy("student_id").agg(
        F.avg("mark").alias("avg_mark"),
        F.stddev("mark").alias("std_mark"),
        F.min("mark").alias("min_mark"),
        F.count("*").alias("n_assessments"),
        F.avg("submitted").alias("submission_rate"),
        F.avg("late_submission").alias("late_submission_rate"),
        F.avg((F.col("attempt") > 1).cast("double")).alias("resit_rate"),
    )
    v = v.join(head_tail_trend(vle, "total_actions", "vle_trend"), "student_id")
    a = a.join(head_tail_trend(attendance, "attended", "attendance_trend"), "student_id")
    merged = v.join(a, "student_id", "full_outer").join(m, "student_id", "full_outer")
    measured = [c for c in merged.columns if c != "student_id"]
    background = students.join(qualifications, "student_id", "left").select(
        "student_id",
        flag(F.col("gender") == "Female").alias("gender_female"),
        F.col("imd_decile"),
        flag(F.col("polar_quintile") == 1).alias("polar_q1"),
        F.col("care_leaver"),
        F.col("first_generation_uni").alias("first_gen"),
        F.col("ucas_tariff_points").alias("ucas_tariff"),
    )
    defaults = {c: 0 for c in measured} | {
        "gender_female": 0,
        "imd_decile": 5,
        "polar_q1": 0,
        "care_leaver": 0,
        "first_gen": 0,
        "ucas_tariff": 100,
    }
    return merged.join(background, "student_id", "left").fillna(defaults)
