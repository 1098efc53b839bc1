"""Rules that derive outcome labels from marks, activity and background.

Only the deterministic part of each rule is kept; where a rule draws at random the
caller passes a column of draws in [0, 1).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.expr import clip, ladder, lookup, truthy
from cohortlens.functions.ordering import exact_quantiles, fit_medians
from cohortlens.operators.engagement import attendance_percent, engagement_rate, vle_totals
from cohortlens.operators.marks import credit_weighted_mean, unique_modules
from cohortlens.operators.recommend import first_per_key
from cohortlens.operators.targets import DEGREE_CODES
from cohortlens.session import reliable_checkpoint

# What each degree class stands for.
EMPLOYMENT_PROBABILITY = {"First": 0.95, "2:1": 0.85, "2:2": 0.70, "Third": 0.55, "Fail": 0.35}
SALARY_SCORE = {"First": 3.3, "2:1": 2.7, "2:2": 1.8, "Third": 1.2, "Fail": 0.5}
BASE_SATISFACTION = {"First": 85.0, "2:1": 78.0, "2:2": 68.0, "Third": 58.0, "Fail": 48.0}
PREDICTED_FINAL = {"First": 75.0, "2:1": 68.0, "2:2": 58.0, "Third": 50.0, "Fail": 35.0}
# Survey themes with offset from the base and weight in the overall score.
THEMES = {
    "teaching": (0, 0.25),
    "assessment": (-5, 0.15),
    "feedback": (-8, 0.15),
    "support": (3, 0.15),
    "organisation": (-3, 0.10),
    "learning_resources": (5, 0.10),
    "student_voice": (-5, 0.10),
}
# Demand multiplier by department.
DEPARTMENT_DEMAND = {
    "Computer Science": 1.3,
    "Software Engineering": 1.25,
    "Data Science": 1.25,
    "Statistics": 1.2,
    "Mathematics": 1.1,
    "Economics": 1.05,
    "Electronic Engineering": 1.0,
    "Physics": 1.0,
    "Mechanical Engineering": 0.95,
    "Chemistry": 0.9,
    "Biology": 0.9,
    "Psychology": 0.85,
    "Management": 0.85,
    "Law": 0.8,
    "History": 0.7,
    "Philosophy": 0.7,
}


def degree_class(gpa: Column) -> Column:
    return ladder(gpa, [(3.7, "First"), (3.0, "2:1"), (2.0, "2:2"), (1.0, "Third")], "Fail")


def degree_outcomes(assessments: DataFrame, modules: DataFrame, enrollments: DataFrame) -> DataFrame:
    """Credit-weighted GPA (0-4) and class of every enrolled student with marks."""
    graded = assessments.join(unique_modules(modules).select("module_id", "credits"), "module_id")
    gpa = graded.groupBy("student_id").agg(
        (credit_weighted_mean(F.col("mark"), F.col("credits")) / 25.0).alias("weighted_gpa")
    )
    return gpa.join(enrollments.select("student_id", "course_id"), "student_id").select(
        "student_id", "course_id", "weighted_gpa", degree_class(F.col("weighted_gpa")).alias("final_classification")
    )


def spread_classes(degrees: DataFrame) -> DataFrame:
    """Push GPAs away from 2.6, then lift the top 4 % into First and drop the last 5 % into Fail."""
    gpa = F.col("weighted_gpa")
    pushed = reliable_checkpoint(degrees.withColumn("gpa", clip(gpa + 0.30 * (gpa - 2.6), 0.0, 4.0)))
    cuts = {share: q for (_, share), q in exact_quantiles(pushed, ["gpa"], [0.05, 0.96]).items()}
    g = F.col("gpa")
    top, bottom = (g >= cuts[0.96]) & (g < 3.7), (g <= cuts[0.05]) & (g >= 1.0)
    edge = pushed.agg(
        F.struct(F.min(F.when(top, g)).alias("low"), F.max(F.when(bottom, g)).alias("high"))
    ).scalar()
    final = (
        F.when(top, clip(g + (3.75 - edge["low"]) * 0.5, 3.70, 4.0))
        .when(bottom, clip(g - (edge["high"] - 0.85) * 0.5, 0.0, 0.99))
        .otherwise(g)
    )
    return pushed.select(
        "student_id", "course_id", final.alias("weighted_gpa"), degree_class(final).alias("final_classification")
    )


def graduate_outcomes(
    students: DataFrame, degrees: DataFrame, vle: DataFrame, draw: Column, second_draw: Column
) -> DataFrame:
    """Employment, salary, further study and readiness of every student."""
    totals = vle_totals(vle)
    top_logins = totals.agg(F.max("total_logins")).scalar()
    joined = (
        students.select("student_id")
        .join(degrees.select("student_id", "final_classification"), "student_id", "left")
        .join(totals.select("student_id", "total_logins", "total_resources"), "student_id", "left")
    )
    name = F.col("final_classification")
    p = lookup(name, EMPLOYMENT_PROBABILITY, 0.6)
    salary = lookup(name, SALARY_SCORE, 1.5)
    status = (
        F.when(draw < p * 0.5, "Employed")
        .when(draw < p * 0.75, "Both Employed and Study")
        .when(draw < p * 0.90, "Further Study Only")
        .otherwise("Unemployed")
    )
    employed = F.col("employment_status") == "Employed"
    study = (
        F.when(employed & (second_draw < 0.85), "Not Studying")
        .when(employed & (second_draw < 0.95), "UK")
        .when(employed, "EU")
        .when(second_draw < 0.50, "UK")
        .when(second_draw < 0.75, "EU")
        .otherwise("International")
    )
    logins = F.coalesce("total_logins", F.lit(0))
    return joined.withColumn("employment_status", status).select(
        "student_id",
        p.alias("employment_prob"),
        "employment_status",
        ladder(salary, [(3.0, "Over £40,000"), (2.0, "£30,000 - £40,000"), (1.0, "£20,000 - £30,000")], "Under £20,000")
        .alias("salary_band"),
        study.alias("study_destination"),
        clip(career_readiness(lookup(name, DEGREE_CODES, 2), logins, top_logins), 0.0, 100.0).alias("career_readiness_score"),
        F.col("employment_status").isin("Employed", "Both Employed and Study").cast("int").alias("is_employed"),
        lookup(name, DEGREE_CODES, 2).alias("degree_class_ordinal"),
        logins.alias("total_logins"),
        F.coalesce("total_resources", F.lit(0)).alias("total_resources"),
    )


def career_readiness(ordinal: Column, logins: Column, top_logins: Column) -> Column:
    return ordinal / 4.0 * 60 + F.coalesce(F.try_divide(logins, top_logins), F.lit(0.0)) * 40


def nss_outcomes(students: DataFrame, degrees: DataFrame, vle: DataFrame) -> DataFrame:
    """Survey theme scores, overall satisfaction and promoter score."""
    totals = vle_totals(vle)
    joined = (
        students.select("student_id")
        .join(degrees.select("student_id", "final_classification"), "student_id", "left")
        .join(totals.select("student_id", "total_actions"), "student_id", "left")
        .withColumn("total_actions", F.coalesce("total_actions", F.lit(0)))
        .withColumn("engagement_rate", engagement_rate(totals, plus_one=False))
    )
    base = lookup(F.col("final_classification"), BASE_SATISFACTION, 65.0)
    boost = F.col("engagement_rate") * 0.15
    scores = joined.select(
        "student_id",
        "engagement_rate",
        *[clip(base + off + boost, 10.0, 100.0).alias(f"{t}_score") for t, (off, _) in THEMES.items()],
    )
    overall = sum((F.col(f"{t}_score") * w for t, (_, w) in THEMES.items()), F.lit(0.0))
    whole = scores.withColumn("overall_score", overall)
    return whole.select(
        "*",
        (F.col("overall_score") >= 60).cast("int").alias("overall_satisfied"),
        F.bround(clip(F.col("overall_score") / 10, 0.0, 10.0), 0).cast("int").alias("nps_score"),
        F.bround(clip(F.col("engagement_rate") / 100 * 8, 0.0, 8.0), 0).cast("int").alias("module_evals_submitted"),
        clip(F.col("engagement_rate") * 0.8, 0.0, 100.0).alias("feedback_response_rate"),
    )


def module_enrollments(assessments: DataFrame) -> DataFrame:
    """One row per student and module: mean grade and whether anything was submitted."""
    return assessments.groupBy("student_id", "module_id").agg(
        F.avg("mark").alias("grade"), F.max("submitted").alias("completed")
    )


def module_demand(modules: DataFrame, taken: DataFrame) -> DataFrame:
    """Expected enrolment, fill rate, demand category and popularity per module.

    ``modules`` carries ``department`` and ``capacity``; ``taken`` is (student, module).
    """
    history = taken.groupBy("module_id").agg(F.count("*").alias("historical"))
    multiplier = lookup(F.col("department"), DEPARTMENT_DEMAND, 1.0)
    counted = modules.join(history, "module_id", "left").select(
        *modules.columns,
        multiplier.alias("dept_multiplier"),
        F.greatest(F.lit(5), F.bround(F.coalesce("historical", F.lit(0)) * multiplier, 0).cast("int")).alias("enrollment_count"),
    )
    rate = clip(F.col("enrollment_count") / F.col("capacity") * 100, 0.0, 150.0)
    filled = counted.withColumn("fill_rate", rate)
    score = clip(clip(F.col("fill_rate"), 0.0, 100.0) * 0.7 + F.col("dept_multiplier") * 30, 0.0, 100.0)
    return filled.select(
        *modules.columns,
        "enrollment_count",
        "fill_rate",
        ladder(F.col("fill_rate"), [(100, "Oversubscribed"), (80, "High"), (50, "Medium")], "Low").alias("demand_category"),
        score.alias("popularity_score"),
    )


def activity_and_marks(students: DataFrame, vle: DataFrame, assessments: DataFrame) -> DataFrame:
    """Students with activity totals (0 if none), engagement rate and mark statistics.

    A missing mean mark becomes the median of the known ones, a missing spread 0.
    """
    totals = vle_totals(vle)
    grades = assessments.groupBy("student_id").agg(
        F.avg("mark").alias("avg_mark"),
        F.stddev("mark").alias("mark_std"),
        F.min("mark").alias("min_mark"),
        F.max("mark").alias("max_mark"),
        F.count("mark").alias("n_assessments"),
    )
    zero = ["total_logins", "total_resources", "total_actions", "avg_logins", "avg_actions"]
    # read marks and activity once: the medians and every later use come from the result
    joined = reliable_checkpoint(
        students.join(totals, "student_id", "left")
        .join(grades, "student_id", "left")
        .fillna(0, subset=zero)
        .withColumn("engagement_rate", engagement_rate(totals))
    )
    medians = fit_medians(joined, ["avg_mark"])
    return joined.fillna(medians).fillna(0, subset=["mark_std"])


def retention_outcomes(students: DataFrame, vle: DataFrame, assessments: DataFrame) -> DataFrame:
    """Risk score, category and flag of leaving."""
    people = activity_and_marks(students, vle, assessments)
    engaged, mark = F.col("engagement_rate"), F.col("avg_mark")
    low_engagement, low_grade = (engaged < 30).cast("int"), (mark < 50).cast("int")
    score = (
        low_engagement * 30
        + low_grade * 25
        + (F.col("mark_std") > 15).cast("int") * 10
        + (100 - engaged) * 0.15
        + (50 - clip(mark, 0.0, 100.0)) * 0.3
        + F.when(truthy(F.col("first_generation_uni")), 10).otherwise(0)
        + (10 - clip(F.col("imd_decile"), 1, 10)) * 2
    )
    return people.withColumn("risk_score", clip(score, 0.0, 100.0)).select(
        "student_id",
        "risk_score",
        ladder(F.col("risk_score"), [(75, "Critical"), (50, "High"), (25, "Medium")], "Low").alias("risk_category"),
        (F.col("risk_score") >= 50).cast("int").alias("retention_risk"),
        (F.col("risk_score") < 50).cast("int").alias("retained"),
        "engagement_rate",
        "avg_mark",
        "total_logins",
        "total_resources",
        low_engagement.alias("low_engagement"),
        low_grade.alias("low_grade"),
    )


def departure_year(retention_risk: Column, draw: Column) -> Column:
    """Year 1, 2 or 3 (half, 35 %, 15 %) for students at risk, else 0."""
    year = F.when(draw < 0.50, 1).when(draw < 0.85, 2).otherwise(3)
    return F.when(retention_risk == 1, year).otherwise(0)


def confidence(mark_std: Column, engagement: Column, n_marks: Column) -> Column:
    """Weight of consistent marks (.4), engagement in percent (.3) and number of marks (.3)."""
    steady = 1 / (1 + F.coalesce(mark_std, F.lit(0.0)) / 10)
    return 0.4 * steady + 0.3 * engagement / 100 + 0.3 * clip(n_marks, 1, 20) / 20


def exam_outcomes(
    students: DataFrame,
    assessments: DataFrame,
    vle: DataFrame,
    modules: DataFrame,
    degrees: DataFrame,
    courses: DataFrame,
) -> DataFrame:
    """Expected exam mark, pass flag, grade and confidence per student."""
    people = activity_and_marks(students, vle, assessments)
    gaps = fit_medians(people, ["mark_std", "n_assessments"])
    by_module = assessments.groupBy("module_id").agg(
        F.avg("mark").alias("module_avg_mark"), F.avg((F.col("mark") >= 40).cast("double")).alias("module_pass_rate")
    )
    sample = first_per_key(modules, "course_id", ["module_id"]).join(by_module, "module_id").drop("module_id")
    joined = (
        people.fillna(gaps)
        .join(degrees.select("student_id", "course_id", "final_classification"), "student_id", "left")
        .join(sample, "course_id", "left")
        .join(courses.select("course_id", "exam_weight_pct"), "course_id", "left")
    )
    predicted = lookup(F.col("final_classification"), PREDICTED_FINAL, 60.0)
    module_mark = F.coalesce("module_avg_mark", F.lit(65.0))
    engaged = F.col("engagement_rate")
    raw = (
        F.col("avg_mark") * 0.6
        + predicted * 0.4
        + engaged / 100 * 4.5
        + (module_mark - 65) / 65 * 2
        + (predicted - 65) / 65 * 3
    )
    marked = joined.withColumn("exam_mark", F.bround(clip(raw, 0.0, 100.0), 1))
    return marked.select(
        "student_id",
        "exam_mark",
        (F.col("exam_mark") >= 40).cast("int").alias("pass_fail"),
        ladder(F.col("exam_mark"), [(70, "Distinction"), (60, "Merit"), (40, "Pass")], "Fail").alias("grade_class"),
        F.bround(clip(confidence(F.col("mark_std"), engaged, F.col("n_assessments")), 0.0, 1.0), 3).alias("prediction_confidence"),
        F.col("avg_mark").alias("cw_mean"),
        F.col("mark_std").alias("cw_std"),
        "engagement_rate",
        F.coalesce("exam_weight_pct", F.lit(60)).alias("exam_weight_pct"),
        F.coalesce("module_pass_rate", F.lit(0.85)).alias("module_pass_rate"),
        predicted.alias("predicted_final_score"),
    )


def wellbeing_outcomes(students: DataFrame, vle: DataFrame, assessments: DataFrame, attendance: DataFrame) -> DataFrame:
    """Wellbeing score with risk level, flag and support need."""
    people = activity_and_marks(students, vle, assessments).join(attendance_percent(attendance), "student_id", "left")
    attended = F.coalesce("attendance_pct", F.lit(75.0))
    n = F.coalesce("n_assessments", F.lit(5))
    score = (
        30
        + F.col("engagement_rate") / 100 * 25
        + attended / 100 * 20
        + (clip(F.col("avg_mark"), 30.0, 90.0) - 30) / 60 * 25
        - F.when(truthy(F.col("first_generation_uni")), 8).otherwise(0)
        - (10 - clip(F.col("imd_decile"), 1, 10)) * 1.5
        - F.when(truthy(F.col("care_leaver")), 10).otherwise(0)
        - n / 10 * 5
    )
    scored = people.withColumn("wellbeing_score", F.bround(clip(score, 0.0, 100.0), 1))
    s = F.col("wellbeing_score")
    return scored.select(
        "student_id",
        "wellbeing_score",
        ladder(s, [(70, "Low"), (50, "Medium"), (30, "High")], "Critical").alias("risk_level"),
        (s < 50).cast("int").alias("at_risk"),
        ladder(s, [(60, 0), (45, 1), (30, 2)], 3).alias("support_need"),
        "engagement_rate",
        attended.alias("attendance_rate"),
        "avg_mark",
        "total_logins",
        n.alias("n_assessments"),
        "total_resources",
    )
