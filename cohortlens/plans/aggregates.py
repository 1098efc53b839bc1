"""Aggregations (rows E1–E26)."""

from pyspark.sql import functions as F

from cohortlens.functions import expr
from cohortlens.functions.ordering import exact_quantiles
from cohortlens.operators import categories, dashboard, engagement, marks, profile, recommend
from cohortlens.plans.registry import query

ATTENDANCE_SQL = """SELECT student_id, AVG(attended) AS attendance_rate, COALESCE(STDDEV_SAMP(attended), 0) AS attendance_std,
 COUNT(week) AS total_weeks, CAST(SUM(attended) AS BIGINT) AS weeks_present,
 COUNT(CASE WHEN status = 'Authorised Absence' THEN 1 END) AS authorised_absences,
 COUNT(CASE WHEN status = 'Medical' THEN 1 END) AS medical_absences,
 COALESCE(AVG(CASE WHEN week > 15 THEN attended END) - AVG(CASE WHEN week <= 15 THEN attended END), 0) AS attendance_trend
 FROM attendance GROUP BY student_id"""
VLE_SQL = """SELECT student_id, CAST(SUM(logins) AS BIGINT) AS total_logins, CAST(SUM(resources_accessed) AS BIGINT) AS total_resources,
 CAST(SUM(forum_posts) AS BIGINT) AS total_forum_posts, CAST(SUM(quiz_attempts) AS BIGINT) AS total_quiz_attempts,
 CAST(SUM(video_views) AS BIGINT) AS total_video_views, CAST(SUM(total_actions) AS BIGINT) AS total_actions,
 AVG(logins) AS avg_logins_per_week, AVG(resources_accessed) AS avg_resources_per_week,
 COALESCE(AVG(CASE WHEN week > 15 THEN total_actions END) - AVG(CASE WHEN week <= 15 THEN total_actions END), 0) AS vle_engagement_trend,
 COALESCE(STDDEV_SAMP(total_actions), 0) AS vle_consistency FROM vle_engagement GROUP BY student_id"""
ATTENDANCE_DOUBLES = ["attendance_rate", "attendance_std", "attendance_trend"]
VLE_DOUBLES = ["avg_logins_per_week", "avg_resources_per_week", "vle_engagement_trend", "vle_consistency"]
MARKS_SQL = """SELECT student_id, AVG(mark) AS avg_mark, COALESCE(STDDEV_SAMP(mark), 0) AS std_mark, MIN(mark) AS min_mark,
 MAX(mark) AS max_mark, COUNT(mark) AS total_assessments, CAST(SUM(submitted) AS BIGINT) AS submitted_count,
 CAST(SUM(late_submission) AS BIGINT) AS late_submission_count, COUNT(CASE WHEN attempt > 1 THEN 1 END) AS resit_count,
 SUM(submitted) / CAST(COUNT(mark) AS DOUBLE) AS submission_rate, SUM(late_submission) / CAST(COUNT(mark) AS DOUBLE) AS late_submission_rate,
 COUNT(CASE WHEN attempt > 1 THEN 1 END) / CAST(COUNT(mark) AS DOUBLE) AS resit_rate,
 AVG(CASE WHEN mark >= 40 THEN 1.0 ELSE 0.0 END) AS pass_rate,
 AVG(CASE WHEN year = 1 THEN mark END) AS year1_avg_mark, AVG(CASE WHEN year = 2 THEN mark END) AS year2_avg_mark,
 AVG(CASE WHEN year = 3 THEN mark END) AS year3_avg_mark,
 COALESCE(AVG(CASE WHEN year = 3 THEN mark END) - AVG(CASE WHEN year = 1 THEN mark END), 0) AS performance_trend
 FROM assessments LEFT JOIN modules USING (module_id) GROUP BY student_id"""
MARKS_DOUBLES = [
    "avg_mark", "std_mark", "min_mark", "max_mark", "submission_rate", "late_submission_rate", "resit_rate",
    "pass_rate", "year1_avg_mark", "year2_avg_mark", "year3_avg_mark", "performance_trend",
]


@query("e1_attendance_aggregate", ATTENDANCE_SQL, ATTENDANCE_DOUBLES)
def _(c):
    return engagement.attendance_summary(c.attendance)


@query(
    "e2_halfterm_trend",
    """SELECT student_id, COALESCE(AVG(CASE WHEN week > 15 THEN total_actions END) - AVG(CASE WHEN week <= 15 THEN total_actions END), 0) AS trend
       FROM vle_engagement GROUP BY 1""",
    ["trend"],
)
def _(c):
    trend = engagement.halfterm_trend(F.col("total_actions"), F.col("week"))
    return c.vle_engagement.groupBy("student_id").agg(trend.alias("trend"))


@query("e3_vle_aggregate", VLE_SQL, VLE_DOUBLES)
def _(c):
    return engagement.vle_summary(c.vle_engagement)


@query(
    "e4_consistency",
    "SELECT student_id, COALESCE(STDDEV_SAMP(total_actions), 0) AS consistency FROM vle_engagement GROUP BY 1",
    ["consistency"],
)
def _(c):
    return c.vle_engagement.groupBy("student_id").agg(expr.std0(F.col("total_actions")).alias("consistency"))


@query(
    "e5_performance_aggregate",
    f"""SELECT student_id, avg_mark, std_mark, min_mark, max_mark, total_assessments, submitted_count, late_submission_count,
        resit_count, submission_rate, late_submission_rate, resit_rate FROM ({MARKS_SQL})""",
    MARKS_DOUBLES[:7],
)
def _(c):
    return marks.performance_features(c.assessments, c.modules).select(
        "student_id", "avg_mark", "std_mark", "min_mark", "max_mark", "total_assessments", "submitted_count",
        "late_submission_count", "resit_count", "submission_rate", "late_submission_rate", "resit_rate",
    )


@query(
    "e6_pass_rate",
    "SELECT student_id, AVG(CASE WHEN mark >= 40 THEN 1.0 ELSE 0.0 END) AS pass_rate FROM assessments GROUP BY 1",
    ["pass_rate"],
)
def _(c):
    return c.assessments.groupBy("student_id").agg(expr.share(F.col("mark") >= 40).alias("pass_rate"))


@query(
    "e7_year_averages",
    f"SELECT student_id, year1_avg_mark, year2_avg_mark, year3_avg_mark, performance_trend FROM ({MARKS_SQL})",
    MARKS_DOUBLES[8:],
)
def _(c):
    return marks.performance_features(c.assessments, c.modules).select("student_id", *MARKS_DOUBLES[8:])


@query(
    "e8_credit_weighted_mean",
    "SELECT student_id, SUM(mark * credits) / SUM(credits) AS weighted FROM assessments JOIN modules USING (module_id) GROUP BY 1",
    ["weighted"],
)
def _(c):
    joined = c.assessments.join(marks.unique_modules(c.modules), "module_id")
    return joined.groupBy("student_id").agg(marks.credit_weighted_mean(F.col("mark"), F.col("credits")).alias("weighted"))


@query(
    "e9_best_worst",
    """SELECT student_id, MAX(mark) AS best_mark, MIN(mark) AS worst_mark, COALESCE(STDDEV_SAMP(mark), 0) AS std_mark
       FROM assessments GROUP BY 1""",
    ["best_mark", "worst_mark", "std_mark"],
)
def _(c):
    return marks.mark_range(c.assessments)


@query(
    "e10_resits",
    """SELECT student_id, COUNT(CASE WHEN attempt > 1 THEN 1 END) AS resit_count,
       COUNT(CASE WHEN attempt > 1 AND mark >= 40 THEN 1 END) AS resits_passed,
       COUNT(CASE WHEN attempt > 1 AND mark >= 40 THEN 1 END) / CAST(GREATEST(COUNT(CASE WHEN attempt > 1 THEN 1 END), 1) AS DOUBLE) AS resit_success_rate
       FROM assessments GROUP BY 1""",
    ["resit_success_rate"],
)
def _(c):
    return marks.resit_features(c.assessments)


@query(
    "e11_late",
    """SELECT student_id, CAST(SUM(late_submission) AS BIGINT) AS late_submissions, AVG(late_submission) AS late_submission_rate
       FROM assessments GROUP BY 1""",
    ["late_submission_rate"],
)
def _(c):
    return marks.late_features(c.assessments)


@query(
    "e12_distinct_weeks",
    """SELECT student_id, GREATEST(COALESCE(v, 0), COALESCE(a, 0)) AS n_weeks
       FROM (SELECT student_id, COUNT(DISTINCT week) AS v FROM vle_engagement GROUP BY 1) x
       FULL JOIN (SELECT student_id, COUNT(DISTINCT week) AS a FROM attendance GROUP BY 1) y USING (student_id)""",
)
def _(c):
    return engagement.observed_weeks(c.vle_engagement, c.attendance)


def head_tail_sql(table, value, into, span=None):
    ends, need = (str(span), 2 * span) if span else ("FLOOR(n / 2)", 4)
    return f"""SELECT student_id, CASE WHEN MAX(n) >= {need} THEN AVG(CASE WHEN pos > n - {ends} THEN x END)
 - AVG(CASE WHEN pos <= {ends} THEN x END) ELSE 0 END AS {into} FROM (SELECT student_id, {value} AS x,
 ROW_NUMBER() OVER (PARTITION BY student_id ORDER BY week) AS pos, COUNT(*) OVER (PARTITION BY student_id) AS n FROM {table}) GROUP BY student_id"""


@query("e13_halves_trend", head_tail_sql("vle_engagement", "total_actions", "vle_trend"), ["vle_trend"])
def _(c):
    return engagement.head_tail_trend(c.vle_engagement, "total_actions", "vle_trend")


@query("e14_seven_week_trend", head_tail_sql("vle_engagement", "total_actions", "trend", 7), ["trend"])
def _(c):
    return engagement.head_tail_trend(c.vle_engagement, "total_actions", "trend", span=7)


@query(
    "e15_max_normalised",
    """WITH m AS (SELECT student_id, AVG(logins) AS l, AVG(total_actions) AS a FROM vle_engagement GROUP BY 1)
       SELECT student_id, l / (SELECT MAX(l) FROM m) AS avg_logins, a / (SELECT MAX(a) FROM m) AS avg_actions FROM m""",
    ["avg_logins", "avg_actions"],
)
def _(c):
    return engagement.max_normalised_means(c.vle_engagement).select("student_id", "avg_logins", "avg_actions")


@query(
    "e16_engagement_rate",
    """WITH t AS (SELECT student_id, SUM(total_actions) AS a FROM vle_engagement GROUP BY 1)
       SELECT student_id, a / CAST((SELECT MAX(a) FROM t) + 1 AS DOUBLE) * 100 AS rate, a / CAST((SELECT MAX(a) FROM t) AS DOUBLE) * 100 AS rate_of_max FROM t""",
    ["rate", "rate_of_max"],
)
def _(c):
    totals = engagement.vle_totals(c.vle_engagement)
    return totals.select(
        "student_id",
        engagement.engagement_rate(totals).alias("rate"),
        engagement.engagement_rate(totals, plus_one=False).alias("rate_of_max"),
    )


@query(
    "e17_popularity_count",
    "SELECT course_id, CAST(COUNT(e.student_id) AS DOUBLE) AS score FROM courses LEFT JOIN enrollments e USING (course_id) GROUP BY course_id",
    ["score"],
)
def _(c):
    return recommend.popularity(c.courses, c.enrollments)


@query(
    "e18_ground_truth",
    """SELECT student_id, COUNT(*) AS n, ARRAY_TO_STRING(LIST_SORT(LIST(course_id)), ',') AS courses FROM interactions GROUP BY 1""",
)
def _(c):
    sets = recommend.taken_courses(c.interactions)
    return sets.select("student_id", F.size("courses").cast("bigint").alias("n"), F.array_join("courses", ",").alias("courses"))


@query(
    "e19_value_counts",
    """SELECT v AS enrollment_status, COUNT(student_id) AS n FROM (VALUES ('Active'), ('Completed'), ('Withdrawn'), ('Transferred'), ('Suspended')) t(v)
       LEFT JOIN enrollments ON enrollment_status = v GROUP BY v""",
)
def _(c):
    order = ["Active", "Completed", "Withdrawn", "Transferred", "Suspended"]
    return categories.counts_in_order(c.enrollments, "enrollment_status", order)


@query(
    "e20_crosstab",
    """SELECT o_orderpriority AS intervention, COUNT(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS "F",
       COUNT(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS "O", COUNT(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS "P"
       FROM orders GROUP BY 1""",
)
def _(c):
    log = c.raw("orders").withColumnRenamed("o_orderpriority", "intervention")
    return dashboard.crosstab(log, "intervention", "o_orderstatus", ["F", "O", "P"])


@query(
    "e21_group_stats",
    "SELECT gender, AVG(score) AS mean, STDDEV_SAMP(score) AS std, COUNT(*) AS n FROM predictions GROUP BY 1",
    ["mean", "std"],
)
def _(c):
    return dashboard.group_stats(c.predictions, "gender", "score")


@query(
    "e22_module_history",
    """SELECT module_id, AVG(mark) AS avg_grade, COALESCE(STDDEV_SAMP(mark), 0) AS grade_std, COUNT(mark) AS total_enrollments,
       AVG(submitted) AS completion_rate FROM assessments GROUP BY 1""",
    ["avg_grade", "grade_std", "completion_rate"],
)
def _(c):
    return marks.module_history(c.assessments)


def profile_sql(table, numbers, others):
    """All statistics of all columns."""
    out = []
    for x in numbers:
        for name, value in (("mean", "AVG({x})"), ("std", "STDDEV_SAMP({x})"), ("min", "MIN({x})"), ("max", "MAX({x})")):
            out.append((x, name, value))
    out += [(x, "distinct", "COUNT(DISTINCT {x})") for x in others]
    for x in [*numbers, *others]:
        out += [(x, "null_count", "COUNT(*) - COUNT({x})"), (x, "null_percent", "100.0 * (COUNT(*) - COUNT({x})) / COUNT(*)")]
    return " UNION ALL ".join(f"""SELECT '{x}' AS "column", '{name}' AS statistic, CAST({value.format(x=x)} AS DOUBLE) AS value FROM {table}""" for x, name, value in out)


QUALIFICATION_PROFILE_SQL = profile_sql("qualifications", ["student_id", "ucas_tariff_points", "predicted_grade"], ["qualification_type"])


@query("e23_column_profile", QUALIFICATION_PROFILE_SQL, ["value"])
def _(c):
    return profile.column_profile(c.qualifications)


@query(
    "e24_quantiles",
    """SELECT 'mark' AS "column", q AS share, v AS quantile FROM (
         SELECT UNNEST([0.05, 0.5, 0.96]) AS q, UNNEST(QUANTILE_CONT(mark, [0.05, 0.5, 0.96])) AS v FROM assessments)
       UNION ALL SELECT 'ucas_tariff_points', q, v FROM (
         SELECT UNNEST([0.05, 0.5, 0.96]) AS q, UNNEST(QUANTILE_CONT(CAST(ucas_tariff_points AS DOUBLE), [0.05, 0.5, 0.96])) AS v FROM qualifications)""",
    ["share", "quantile"],
)
def _(c):
    found = exact_quantiles(c.assessments, ["mark"], [0.05, 0.5, 0.96])
    found |= exact_quantiles(c.qualifications, ["ucas_tariff_points"], [0.05, 0.5, 0.96])
    rows = [(column, share, q) for (column, share), q in found.items()]
    return c.spark.createDataFrame(rows, "column string, share double, quantile double")


@query(
    "e25_attendance_percent",
    """SELECT student_id, COALESCE(100.0 * p / n, 75) AS attendance_pct FROM students LEFT JOIN
       (SELECT student_id, COUNT(CASE WHEN status = 'Present' THEN 1 END) AS p, COUNT(*) AS n FROM attendance GROUP BY 1) a USING (student_id)""",
    ["attendance_pct"],
)
def _(c):
    pct = engagement.attendance_percent(c.attendance)
    return c.students.join(pct, "student_id", "left").select(
        "student_id", F.coalesce("attendance_pct", F.lit(75.0)).alias("attendance_pct")
    )
