"""Model-ready feature tables, one function per prediction task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.expr import count_where, flag, lookup, one_hot, std0
from cohortlens.functions.ordering import fit_medians
from cohortlens.operators import targets
from cohortlens.operators.categories import dense_codes, dummies_drop_first, levels, top_levels
from cohortlens.operators.engagement import (
    attendance_percent,
    head_tail_trend,
    max_normalised_means,
    vle_totals,
)
from cohortlens.operators.marks import before_final_year, credit_weighted_mean, trend_code
from cohortlens.operators.outcomes import career_readiness
from cohortlens.operators.sparse import LevelTable
from cohortlens.session import reliable_checkpoint, spread
from cohortlens.operators.student import ETHNICITY_FLAGS, age_at, age_by_year, ethnicity_group

BACKGROUND = ["gender", "ethnicity", "disability", "care_leaver", "first_generation_uni"]


def flags(**conditions: Column) -> list[Column]:
    return [flag(condition).alias(f"feat_{name}") for name, condition in conditions.items()]


def yield_features(
    enrollments: DataFrame,
    students: DataFrame,
    qualifications: DataFrame,
    courses: DataFrame,
    vle: DataFrame | None = None,
    label: str = "accepted",
    known: LevelTable | None = None,
) -> DataFrame:
    """Applicant, course, engagement and timing features of every enrolment (``feat_…``) with the label.

    With ``known``, levels of ``qualification_type`` are positions ``categories`` and no columns.

    Activity is summed per student before the join, so an applicant stays one row.
    Missing numbers become the column's median.
    """
    df = (
        enrollments.join(students, "student_id", "left")
        .join(qualifications, "student_id", "left")
        .join(courses, "course_id", "left")
    )
    if known is None:
        kinds = one_hot(F.col("qualification_type"), levels(qualifications, "qualification_type"), "feat_qual")
    else:
        df, kinds = known.positions(df, "categories"), [F.col("categories")]
    tariff, entry = F.col("ucas_tariff_points"), F.col("entry_tariff")
    age = age_at(F.col("enrollment_date"), F.col("date_of_birth"))
    imd, polar = F.col("imd_decile"), F.col("polar_quintile")
    coursework, month = F.col("coursework_weight_pct"), F.month("enrollment_date")
    late = month >= 6
    applicants = enrollments.select("student_id", "course_id")
    ethnic = top_levels(applicants.join(students.select("student_id", "ethnicity"), "student_id"), "ethnicity", 5)
    dept = top_levels(applicants.join(courses.select("course_id", "department"), "course_id"), "department", 5)
    out = [
        *flags(
            tariff_band_low=tariff <= 96,
            tariff_band_medium=(tariff > 96) & (tariff <= 128),
            tariff_band_high=tariff > 128,
        ),
        *kinds,
        F.col("predicted_grade").cast("int").alias("feat_has_predicted_grade"),
        *flags(gender_female=F.col("gender") == "Female", gender_male=F.col("gender") == "Male"),
        *one_hot(F.col("ethnicity"), ethnic, "feat_ethnicity"),
        age.alias("feat_age_at_enrollment"),
        *flags(age_under_21=age < 21, age_mature=age >= 25),
        (11 - imd).alias("feat_imd_inverse"),
        *flags(
            imd_most_deprived=imd <= 2,
            imd_least_deprived=imd >= 9,
            low_participation_area=polar == 1,
            high_participation_area=polar >= 4,
            care_leaver=F.col("care_leaver") == 1,
            first_generation=F.col("first_generation_uni") == 1,
            has_disability=F.col("disability") == 1,
        ),
        (entry / 168.0).alias("feat_entry_tariff_normalized"),
        *flags(entry_tariff_high=entry >= 144, entry_tariff_low=entry <= 112),
        ((tariff - entry) / 168.0).alias("feat_grade_match"),
        *flags(meets_entry_requirements=tariff >= entry, exceeds_entry_requirements=tariff >= entry + 16),
        F.col("employment_rate_15m").alias("feat_employment_rate"),
        *flags(high_employment=F.col("employment_rate_15m") >= 0.90),
        (F.col("satisfaction_score") / 5.0).alias("feat_satisfaction_score"),
        *flags(high_satisfaction=F.col("satisfaction_score") >= 4.5),
        *one_hot(F.col("department"), dept, "feat_dept"),
        *flags(
            sandwich_year=F.col("course_length_years") == 4,
            coursework_heavy=coursework >= 60,
            exam_heavy=coursework <= 40,
            accredited=F.col("accredited") == 1,
        ),
    ]
    if vle is not None:
        trend = head_tail_trend(vle, "total_actions", "engagement_trend", span=7)
        df = df.join(vle_totals(vle).drop("total_actions", "avg_actions"), "student_id", "left").join(
            trend, "student_id", "left"
        )
        logins = F.log1p(F.coalesce("total_logins", F.lit(0)))
        out += [
            logins.alias("feat_total_logins"),
            F.log1p(F.coalesce("total_resources", F.lit(0))).alias("feat_total_resources"),
            F.coalesce("avg_logins", F.lit(0.0)).alias("feat_avg_weekly_logins"),
            F.coalesce("engagement_trend", F.lit(0.0)).alias("feat_engagement_trend"),
            *flags(high_engagement=logins >= 3.0),
        ]
    if "postcode" in df.columns:
        out += flags(local_applicant=F.upper(F.substring("postcode", 1, 2)) == "AB")
    out += [
        month.alias("feat_application_month"),
        *flags(
            early_application=month <= 11,
            late_application=late,
            insurance_choice=tariff < entry - 16,
            clearing_eligible=late & (tariff <= 96),
        ),
    ]
    wide = reliable_checkpoint(df.select("student_id", "course_id", *out, F.col(label)))
    names = [c for c in wide.columns if c.startswith("feat_")]
    medians = fit_medians(wide, names)
    return wide.fillna(medians) if medians else wide


def degree_features(
    degrees: DataFrame,
    students: DataFrame,
    qualifications: DataFrame,
    courses: DataFrame,
    assessments: DataFrame,
    modules: DataFrame,
    attendance: DataFrame,
    vle: DataFrame,
    n_years: int = 3,
) -> DataFrame:
    """Pre-final-year marks, engagement and background of every graduate, with the ordinal target."""
    early = before_final_year(assessments, modules, n_years)
    mark, resit = F.col("mark"), F.col("attempt") > 1
    graded = early.groupBy("student_id").agg(
        *[F.avg(F.when(F.col("year") == y, mark)).alias(f"feat_year_{y}_gpa") for y in range(1, n_years)],
        F.avg(mark).alias("feat_pre_final_gpa"),
        F.max(mark).alias("feat_best_mark"),
        F.min(mark).alias("feat_worst_mark"),
        std0(mark).alias("feat_std_mark"),
        count_where(resit).alias("feat_resit_count"),
        (count_where(resit & (mark >= 40)) / F.greatest(count_where(resit), F.lit(1))).alias("feat_resit_success_rate"),
        F.sum("late_submission").alias("feat_late_submissions"),
        F.avg("late_submission").alias("feat_late_submission_rate"),
        credit_weighted_mean(mark, F.col("credits")).alias("feat_credit_weighted_avg"),
    )
    present = attendance.groupBy("student_id").agg(
        F.avg("attended").alias("feat_attendance_rate"),
        (F.sum(1 - F.col("attended")) / F.count("*")).alias("feat_absence_rate"),
    )
    acts = max_normalised_means(vle).select(
        "student_id",
        F.col("avg_logins").alias("feat_vle_avg_logins"),
        F.col("avg_actions").alias("feat_vle_total_actions"),
        F.col("forum_posts").alias("feat_vle_total_forum_posts"),
    )
    df = (
        degrees.join(students, "student_id", "left")
        .join(qualifications.select("student_id", "ucas_tariff_points"), "student_id", "left")
        .join(courses.select("course_id", "course_length_years"), "course_id", "left")
        .join(graded, "student_id", "left")
        .join(present, "student_id", "left")
        .join(head_tail_trend(attendance, "attended", "feat_attendance_trend"), "student_id", "left")
        .join(acts, "student_id", "left")
        .join(head_tail_trend(vle, "total_actions", "feat_vle_trend"), "student_id", "left")
        .withColumn("target", lookup(F.col("final_classification"), targets.DEGREE_CODES))
        .dropna(subset=["target"])
    )
    df = reliable_checkpoint(df)
    medians = fit_medians(df, ["ucas_tariff_points"])
    group = ethnicity_group(F.col("ethnicity"))
    change = F.col("feat_year_2_gpa") - F.col("feat_year_1_gpa")
    low, decline = flag(F.col("feat_year_1_gpa") < 50), flag(change < -10)
    absent = flag(F.col("feat_absence_rate") > 0.2)
    tariff = F.coalesce(F.col("ucas_tariff_points").cast("double"), F.lit(medians.get("ucas_tariff_points", 100.0)))
    derived = [
        change.alias("feat_mark_trend_y2_vs_y1"),
        trend_code(change).alias("feat_mark_trend_category"),
        flag(F.col("feat_vle_total_forum_posts") > 0).alias("feat_vle_forum_activity"),
        tariff.alias("feat_entry_tariff"),
        (tariff / 168.0).alias("feat_entry_tariff_normalized"),
        *flags(gender_female=F.col("gender") == "Female", gender_male=F.col("gender") == "Male"),
        *[flag(group == g).alias(f"feat_ethnicity_{g}") for g in ETHNICITY_FLAGS],
        (F.coalesce("imd_decile", F.lit(5)) / 10.0).alias("feat_imd_deprivation"),
        *flags(
            low_participation=F.col("polar_quintile") == 1,
            care_leaver=F.col("care_leaver") == 1,
            disability=F.col("disability") == 1,
            first_generation=F.col("first_generation_uni") == 1,
        ),
        F.lit(0.5).alias("feat_course_difficulty"),
        F.coalesce("course_length_years", F.lit(3)).alias("feat_course_length"),
        (F.col("feat_year_1_gpa") / 100.0).alias("feat_year_1_gpa_normalized"),
        low.alias("feat_early_warning_low_y1"),
        decline.alias("feat_early_warning_decline"),
        absent.alias("feat_early_warning_absence"),
        (low + decline + absent).alias("feat_early_warning_score"),
        F.signum(F.coalesce(change, F.lit(0.0))).alias("feat_gpa_trajectory"),
        (
            F.coalesce("feat_vle_total_actions", F.lit(0.0)) * 0.5
            + F.coalesce("feat_attendance_rate", F.lit(0.5)) * 0.5
        ).alias("feat_engagement_index"),
    ]
    measured = [c for c in df.columns if c.startswith("feat_")]
    wide = df.select("student_id", *measured, *derived, "target")
    return wide.fillna(0, subset=[c for c in wide.columns if c.startswith("feat_")])


def mark_statistics(assessments: DataFrame) -> DataFrame:
    return assessments.groupBy("student_id").agg(
        F.avg("mark").alias("assess_mean"),
        F.stddev("mark").alias("assess_std"),
        F.min("mark").alias("assess_min"),
        F.max("mark").alias("assess_max"),
        F.count("mark").alias("n_assessments"),
    )


def finished(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    labels: Sequence[Column],
    levels: LevelTable | None = None,
) -> DataFrame:
    """Numbers with missing values at their median, dummies without the first level, labels.

    With ``levels`` the dummies are the positions ``categories`` of a sparse vector, for categories of
    any number of levels; without, each level is a column.
    """
    df = reliable_checkpoint(df)
    medians = fit_medians(df, numeric)
    filled = [
        F.coalesce(F.col(c).cast("double"), F.lit(medians[c])).alias(c) if c in medians else F.col(c) for c in numeric
    ]
    if levels is not None:
        return levels.positions(df, "categories").select("student_id", *filled, "categories", *labels)
    return df.select("student_id", *filled, *dummies_drop_first(df, categorical), *labels)


def background(students: DataFrame) -> DataFrame:
    return students.select("student_id", *BACKGROUND, "imd_decile", "polar_quintile")


def gpa_and_class(degrees: DataFrame) -> DataFrame:
    return degrees.select(
        "student_id",
        F.col("weighted_gpa").alias("gpa"),
        lookup(F.col("final_classification"), targets.DEGREE_CODES, 2).alias("predicted_class_ordinal"),
    )


def graduate_features(
    outcomes: DataFrame, students: DataFrame, degrees: DataFrame, attendance: DataFrame, levels: LevelTable | None = None
) -> DataFrame:
    """Features and the employment, salary and study labels of every graduate."""
    top = outcomes.agg(F.max("total_logins")).scalar()
    df = (
        outcomes.join(background(students), "student_id", "left")
        .join(gpa_and_class(degrees), "student_id", "left")
        .join(attendance_percent(attendance), "student_id", "left")
        .withColumn("predicted_class_ordinal", F.coalesce("predicted_class_ordinal", F.lit(2)))
        .withColumn(
            "career_readiness_score",
            career_readiness(F.col("degree_class_ordinal"), F.col("total_logins"), top + 1),
        )
    )
    numeric = [
        "gpa", "predicted_class_ordinal", "career_readiness_score", "attendance_pct", "total_logins",
        "total_resources", "imd_decile", "polar_quintile", "degree_class_ordinal",
    ]
    labels = [
        lookup(F.col("employment_status"), targets.EMPLOYMENT_CODES).alias("y_employment"),
        lookup(F.col("salary_band"), targets.SALARY_CODES).alias("y_salary"),
        lookup(F.col("study_destination"), targets.DESTINATION_CODES).alias("y_study"),
    ]
    return finished(df, numeric, BACKGROUND, labels, levels)


def survey_features(
    survey: DataFrame, students: DataFrame, degrees: DataFrame, vle: DataFrame, attendance: DataFrame, levels: LevelTable | None = None
) -> DataFrame:
    """Features and the nine survey labels of every student."""
    df = (
        survey.join(background(students), "student_id", "left")
        .join(gpa_and_class(degrees), "student_id", "left")
        .join(vle_totals(vle), "student_id", "left")
        .join(attendance_percent(attendance), "student_id", "left")
        .fillna(0, subset=["total_logins", "total_resources", "total_actions"])
        .withColumn("predicted_class_ordinal", F.coalesce("predicted_class_ordinal", F.lit(2)))
    )
    numeric = [
        "gpa", "predicted_class_ordinal", "engagement_rate", "attendance_pct", "total_logins", "total_resources",
        "imd_decile", "polar_quintile", "module_evals_submitted", "feedback_response_rate",
    ]
    themes = [c for c in survey.columns if c.endswith("_score") and c not in ("overall_score", "nps_score")]
    labels = [
        F.col("overall_satisfied").alias("y_satisfied"),
        F.col("nps_score").alias("y_nps"),
        *[F.col(t).alias(f"y_{t}") for t in themes],
    ]
    return finished(df, numeric, BACKGROUND, labels, levels)


def retention_features(
    outcomes: DataFrame, students: DataFrame, vle: DataFrame, assessments: DataFrame, levels: LevelTable | None = None
) -> DataFrame:
    """Features and the four retention labels of every student."""
    df = (
        outcomes.select(
            "student_id", "engagement_rate", "risk_score", "retention_risk", "risk_category", "departure_year"
        )
        .join(background(students), "student_id", "left")
        .join(students.select("student_id", age_by_year(F.col("date_of_birth")).alias("age")), "student_id", "left")
        .join(vle_totals(vle), "student_id", "left")
        .join(mark_statistics(assessments), "student_id", "left")
    )
    numeric = [
        "engagement_rate", "assess_mean", "assess_std", "assess_min", "assess_max", "n_assessments", "total_logins",
        "total_resources", "total_actions", "imd_decile", "polar_quintile", "age",
    ]
    labels = [
        F.col("risk_score").alias("y_risk_score"),
        F.col("retention_risk").alias("y_retention_risk"),
        lookup(F.col("risk_category"), targets.RISK_CODES, 0).alias("y_risk_category"),
        F.col("departure_year").alias("y_departure_year"),
    ]
    return finished(df, numeric, BACKGROUND, labels, levels)


def exam_features(
    outcomes: DataFrame, students: DataFrame, assessments: DataFrame, vle: DataFrame, levels: LevelTable | None = None
) -> DataFrame:
    """Features and the three exam labels of every student."""
    df = (
        outcomes.join(background(students), "student_id", "left")
        .join(mark_statistics(assessments), "student_id", "left")
        .join(vle_totals(vle), "student_id", "left")
    )
    numeric = [
        "cw_mean", "cw_std", "engagement_rate", "total_logins", "total_resources", "total_actions", "avg_logins",
        "avg_actions", "assess_mean", "assess_std", "n_assessments", "exam_weight_pct", "module_pass_rate",
        "predicted_final_score", "imd_decile", "polar_quintile",
    ]
    labels = [
        F.col("exam_mark").alias("y_exam_mark"),
        F.col("pass_fail").alias("y_pass_fail"),
        lookup(F.col("grade_class"), targets.GRADE_CODES, 1).alias("y_grade_class"),
    ]
    return finished(df, numeric, BACKGROUND, labels, levels)


def wellbeing_features(
    outcomes: DataFrame, students: DataFrame, assessments: DataFrame, attendance: DataFrame, levels: LevelTable | None = None
) -> DataFrame:
    """Features and the four wellbeing labels of every student."""
    df = (
        outcomes.drop("n_assessments")
        .join(background(students), "student_id", "left")
        .join(mark_statistics(assessments), "student_id", "left")
        .join(attendance_percent(attendance), "student_id", "left")
    )
    numeric = [
        "engagement_rate", "attendance_rate", "avg_mark", "assess_mean", "assess_std", "total_logins",
        "total_resources", "n_assessments", "assess_min", "assess_max", "imd_decile", "polar_quintile",
        "attendance_pct",
    ]
    labels = [
        F.col("wellbeing_score").alias("y_wellbeing_score"),
        F.col("at_risk").alias("y_at_risk"),
        lookup(F.col("risk_level"), targets.RISK_CODES, 0).alias("y_risk_level"),
        F.col("support_need").alias("y_support_need"),
    ]
    return finished(df, numeric, BACKGROUND, labels, levels)


def demand_features(demand: DataFrame, taken: DataFrame, fill: float | None = None) -> DataFrame:
    """Features and the three demand labels of every module.

    A module without history gets the median grade and zeros, or ``fill`` throughout.
    """
    history = taken.groupBy("module_id").agg(
        F.avg("grade").alias("avg_grade"),
        F.stddev("grade").alias("grade_std"),
        F.count("*").alias("total_enrollments"),
        F.avg("completed").alias("completion_rate"),
    )
    df = demand.join(history, "module_id", "left")
    if fill is None:
        df = df.fillna(fit_medians(df, ["avg_grade"]))
    rest = ["avg_grade", "grade_std", "total_enrollments", "completion_rate"]
    df = df.fillna(0 if fill is None else fill, subset=rest)
    coded = dense_codes(df, "department", "department_encoded")
    return coded.select(
        "module_id", "capacity", "exam_weight_pct", "coursework_weight_pct", *rest, "department_encoded",
        "popularity_score",
        F.col("enrollment_count").alias("y_enrollment_count"),
        F.col("fill_rate").alias("y_fill_rate"),
        lookup(F.col("demand_category"), targets.DEMAND_CODES, 1).alias("y_demand_category"),
    )


def ranking_samples(scores: DataFrame, positives: DataFrame, per_positive: int = 2) -> DataFrame:
    """Training rows for learning to rank: one score column per model, label and query id.

    ``scores`` is long (student, course, model, score); ``positives`` the enrolments.
    Each student keeps the courses enrolled in and at most ``per_positive`` times as
    many other recommended courses, best first.
    """
    models = levels(scores, "model")
    own = [F.when(F.col("model") == m, F.col("score")).alias(m) for m in models]
    none = [F.lit(None).cast(scores.schema["score"].dataType).alias(m) for m in models]
    pair = ["student_id", "course_id"]
    wanted = positives.select(*pair).distinct().select(*pair, *none, F.lit(1).alias("label"))
    marked = scores.select(*pair, *own, F.lit(0).alias("label")).unionByName(wanted)
    # listed and enrolled courses meet in one aggregate by student; where a key is missing, they don't
    apart = F.when(F.col("student_id").isNull() | F.col("course_id").isNull(), F.col("label"))
    rows = spread(marked, scores.count() + positives.count(), "student_id").withColumn("_apart", apart).groupBy(*pair, "_apart")
    wide = rows.agg(*[F.max(f"`{m}`").alias(m) for m in models], F.max("label").alias("label")).drop("_apart")
    best = F.greatest(*[F.coalesce(F.col(f"`{m}`"), F.lit(0.0)) for m in models], F.lit(0.0))
    place = F.row_number().over(Window.partitionBy("student_id").orderBy("label", best.desc(), "course_id"))
    held = F.sum("label").over(Window.partitionBy("student_id"))
    placed = wide.withColumns({"_place": place, "_n": held})
    other = (F.col("_place") <= per_positive * F.col("_n")) & F.col("student_id").isNotNull()
    kept = placed.where((F.col("label") == 1) | other).drop("_place", "_n")
    return kept.fillna(0.0, subset=models).withColumn("query_id", F.col("student_id"))

