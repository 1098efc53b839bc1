"""Outcome rules (rows S1–S9)."""

from pyspark.sql import functions as F

from cohortlens.operators import outcomes
from cohortlens.operators.outcomes import DEPARTMENT_DEMAND, THEMES
from cohortlens.plans.registry import query

CLASS_SQL = """CASE WHEN gpa >= 3.7 THEN 'First' WHEN gpa >= 3.0 THEN '2:1' WHEN gpa >= 2.0 THEN '2:2'
 WHEN gpa >= 1.0 THEN 'Third' ELSE 'Fail' END"""
DEGREES_SQL = f"""SELECT student_id, course_id, gpa AS weighted_gpa, {CLASS_SQL} AS final_classification FROM
 (SELECT student_id, SUM(mark * credits) / SUM(credits) / 25.0 AS gpa FROM assessments JOIN modules USING (module_id) GROUP BY 1) g
 JOIN (SELECT student_id, course_id FROM enrollments) e USING (student_id)"""
SPREAD_SQL = f"""WITH degrees AS ({DEGREES_SQL}),
 pushed AS (SELECT student_id, course_id, LEAST(GREATEST(weighted_gpa + CAST(0.3 AS DOUBLE) * (weighted_gpa - 2.6), 0), 4) AS g FROM degrees),
 cuts AS (SELECT QUANTILE_CONT(g, 0.96) AS hi, QUANTILE_CONT(g, 0.05) AS lo FROM pushed),
 edge AS (SELECT MIN(CASE WHEN g >= hi AND g < 3.7 THEN g END) AS low, MAX(CASE WHEN g <= lo AND g >= 1.0 THEN g END) AS high FROM pushed, cuts),
 final AS (SELECT student_id, course_id, CASE WHEN g >= hi AND g < 3.7 THEN LEAST(GREATEST(g + (3.75 - low) * 0.5, 3.7), 4.0)
   WHEN g <= lo AND g >= 1.0 THEN LEAST(GREATEST(g - (high - 0.85) * 0.5, 0), 0.99) ELSE g END AS gpa FROM pushed, cuts, edge)
 SELECT student_id, course_id, gpa AS weighted_gpa, {CLASS_SQL} AS final_classification FROM final"""
TOTALS_SQL = """SELECT student_id, SUM(logins) AS total_logins, AVG(logins) AS avg_logins, SUM(resources_accessed) AS total_resources,
 SUM(total_actions) AS total_actions, AVG(total_actions) AS avg_actions FROM vle_engagement GROUP BY 1"""
DRAW = lambda factor: (F.col("student_id") * factor % 1000) / 1000.0
DRAW_SQL = "(CAST(student_id * {} % 1000 AS DOUBLE) / 1000)"


def degrees(c):
    return outcomes.spread_classes(outcomes.degree_outcomes(c.assessments, c.modules, c.enrollments))


@query("s1_degree_class", DEGREES_SQL, ["weighted_gpa"])
def _(c):
    return outcomes.degree_outcomes(c.assessments, c.modules, c.enrollments)


@query("s2_spread_classes", SPREAD_SQL, ["weighted_gpa"])
def _(c):
    return degrees(c)


GRADUATES_SQL = f"""WITH d AS ({SPREAD_SQL}), t AS ({TOTALS_SQL}),
 j AS (SELECT s.student_id, final_classification AS k, COALESCE(total_logins, 0) AS l, COALESCE(total_resources, 0) AS r,
   {DRAW_SQL.format(7919).replace('student_id', 's.student_id')} AS u, {DRAW_SQL.format(104729).replace('student_id', 's.student_id')} AS w
   FROM students s LEFT JOIN d USING (student_id) LEFT JOIN t USING (student_id)),
 p AS (SELECT *, CASE k WHEN 'First' THEN CAST(0.95 AS DOUBLE) WHEN '2:1' THEN 0.85 WHEN '2:2' THEN 0.70 WHEN 'Third' THEN 0.55 WHEN 'Fail' THEN 0.35 ELSE 0.6 END AS p,
   CASE k WHEN 'First' THEN 3.3 WHEN '2:1' THEN 2.7 WHEN '2:2' THEN 1.8 WHEN 'Third' THEN 1.2 WHEN 'Fail' THEN 0.5 ELSE 1.5 END AS sal,
   CASE k WHEN 'First' THEN 4 WHEN '2:1' THEN 3 WHEN '2:2' THEN 2 WHEN 'Third' THEN 1 WHEN 'Fail' THEN 0 ELSE 2 END AS o FROM j),
 e AS (SELECT *, CASE WHEN u < p * CAST(0.5 AS DOUBLE) THEN 'Employed' WHEN u < p * CAST(0.75 AS DOUBLE) THEN 'Both Employed and Study'
   WHEN u < p * CAST(0.9 AS DOUBLE) THEN 'Further Study Only' ELSE 'Unemployed' END AS es FROM p)
 SELECT student_id, p AS employment_prob, es AS employment_status,
  CASE WHEN sal < 1 THEN 'Under £20,000' WHEN sal < 2 THEN '£20,000 - £30,000' WHEN sal < 3 THEN '£30,000 - £40,000' ELSE 'Over £40,000' END AS salary_band,
  CASE WHEN es = 'Employed' THEN CASE WHEN w < 0.85 THEN 'Not Studying' WHEN w < 0.95 THEN 'UK' ELSE 'EU' END
    WHEN w < 0.5 THEN 'UK' WHEN w < 0.75 THEN 'EU' ELSE 'International' END AS study_destination,
  LEAST(GREATEST(o / 4.0 * 60 + l / CAST((SELECT MAX(total_logins) FROM t) AS DOUBLE) * 40, 0), 100) AS career_readiness_score,
  CASE WHEN es IN ('Employed', 'Both Employed and Study') THEN 1 ELSE 0 END AS is_employed, o AS degree_class_ordinal,
  CAST(l AS BIGINT) AS total_logins, CAST(r AS BIGINT) AS total_resources FROM e"""


def graduates(c, d=None):
    return outcomes.graduate_outcomes(c.students, d or degrees(c), c.vle_engagement, DRAW(7919), DRAW(104729))


@query(
    "s3_employment_salary",
    f"SELECT student_id, employment_prob, employment_status, salary_band, study_destination, is_employed FROM ({GRADUATES_SQL})",
    ["employment_prob"],
)
def _(c):
    return graduates(c).select(
        "student_id", "employment_prob", "employment_status", "salary_band", "study_destination", "is_employed"
    )


@query(
    "s4_career_readiness",
    f"SELECT student_id, career_readiness_score, degree_class_ordinal, total_logins FROM ({GRADUATES_SQL})",
    ["career_readiness_score"],
)
def _(c):
    return graduates(c).select("student_id", "career_readiness_score", "degree_class_ordinal", "total_logins")


THEME_SQL = ", ".join(
    f"LEAST(GREATEST(base + {off} + er * CAST(0.15 AS DOUBLE), 10), 100) AS {t}_score" for t, (off, _) in THEMES.items()
)
OVERALL_SQL = " + ".join(f"{t}_score * CAST({w} AS DOUBLE)" for t, (_, w) in THEMES.items())
NSS_SQL = f"""WITH d AS ({SPREAD_SQL}), t AS ({TOTALS_SQL}),
 j AS (SELECT s.student_id, CASE final_classification WHEN 'First' THEN 85 WHEN '2:1' THEN 78 WHEN '2:2' THEN 68 WHEN 'Third' THEN 58 WHEN 'Fail' THEN 48 ELSE 65 END AS base,
   COALESCE(total_actions, 0) / CAST((SELECT MAX(total_actions) FROM t) AS DOUBLE) * 100 AS er
   FROM students s LEFT JOIN d USING (student_id) LEFT JOIN t USING (student_id)),
 th AS (SELECT student_id, er AS engagement_rate, {THEME_SQL} FROM j),
 ov AS (SELECT *, {OVERALL_SQL} AS overall_score FROM th)
 SELECT *, CASE WHEN overall_score >= 60 THEN 1 ELSE 0 END AS overall_satisfied,
   CAST(ROUND_EVEN(LEAST(GREATEST(overall_score / 10, 0), 10), 0) AS INT) AS nps_score,
   CAST(ROUND_EVEN(LEAST(GREATEST(engagement_rate / 100 * 8, 0), 8), 0) AS INT) AS module_evals_submitted,
   LEAST(GREATEST(engagement_rate * CAST(0.8 AS DOUBLE), 0), 100) AS feedback_response_rate FROM ov"""
NSS_DOUBLES = ["engagement_rate", *[f"{t}_score" for t in THEMES], "overall_score", "feedback_response_rate"]


def survey(c, d=None):
    return outcomes.nss_outcomes(c.students, d or degrees(c), c.vle_engagement)


@query("s5_survey_scores", NSS_SQL, NSS_DOUBLES)
def _(c):
    return survey(c)


# the part types stand for departments; two of them keep a name outside the table
NAMED = {"ECONOMY": "Economics", "LARGE": "Computer Science", "MEDIUM": "Law", "PROMO": "History"}
MODULES_SQL = """SELECT module_id, year, credits, 80 + module_id * 37 % 200 AS capacity, exam_weight_pct, coursework_weight_pct,
 CASE department WHEN 'ECONOMY' THEN 'Economics' WHEN 'LARGE' THEN 'Computer Science' WHEN 'MEDIUM' THEN 'Law'
  WHEN 'PROMO' THEN 'History' ELSE department END AS department FROM modules JOIN courses USING (course_id)"""
TAKEN_SQL = "SELECT student_id, module_id, AVG(mark) AS grade, MAX(submitted) AS completed FROM assessments GROUP BY 1, 2"
DEMAND_SQL = f"""WITH m AS ({MODULES_SQL}), h AS (SELECT module_id, COUNT(*) AS n FROM ({TAKEN_SQL}) GROUP BY 1),
 x AS (SELECT m.*, CAST(CASE department {' '.join(f"WHEN '{k}' THEN {v}" for k, v in DEPARTMENT_DEMAND.items())} ELSE 1.0 END AS DOUBLE) AS mult, COALESCE(n, 0) AS n
   FROM m LEFT JOIN h USING (module_id)),
 y AS (SELECT *, GREATEST(5, CAST(ROUND_EVEN(n * mult, 0) AS INT)) AS enrollment_count FROM x),
 z AS (SELECT *, LEAST(enrollment_count / CAST(capacity AS DOUBLE) * 100, 150) AS fill_rate FROM y)
 SELECT module_id, year, credits, capacity, exam_weight_pct, coursework_weight_pct, department, enrollment_count, fill_rate,
  CASE WHEN fill_rate >= 100 THEN 'Oversubscribed' WHEN fill_rate >= 80 THEN 'High' WHEN fill_rate >= 50 THEN 'Medium' ELSE 'Low' END AS demand_category,
  LEAST(GREATEST(LEAST(fill_rate, 100) * CAST(0.7 AS DOUBLE) + mult * 30, 0), 100) AS popularity_score FROM z"""


def described_modules(c):
    named = F.col("department")
    for old, new in NAMED.items():
        named = F.when(F.col("department") == old, new).otherwise(named)
    courses = c.courses.select("course_id", "department", "exam_weight_pct", "coursework_weight_pct")
    return c.modules.join(courses, "course_id").select(
        "module_id",
        "year",
        "credits",
        (80 + F.col("module_id") * 37 % 200).alias("capacity"),
        "exam_weight_pct",
        "coursework_weight_pct",
        named.alias("department"),
    )


def demand(c):
    return outcomes.module_demand(described_modules(c), outcomes.module_enrollments(c.assessments))


@query("s6_module_demand", DEMAND_SQL, ["fill_rate", "popularity_score"])
def _(c):
    return demand(c)


PEOPLE_SQL = f"""SELECT s.*, COALESCE(total_logins, 0) AS total_logins, COALESCE(total_resources, 0) AS total_resources,
 COALESCE(total_actions, 0) AS total_actions, COALESCE(avg_logins, 0) AS avg_logins, COALESCE(avg_actions, 0) AS avg_actions,
 COALESCE(total_actions, 0) / CAST((SELECT MAX(total_actions) FROM ({TOTALS_SQL})) + 1 AS DOUBLE) * 100 AS engagement_rate,
 COALESCE(m, (SELECT MEDIAN(m) FROM (SELECT AVG(mark) AS m FROM assessments GROUP BY student_id))) AS avg_mark,
 COALESCE(sd, 0) AS mark_std, lo AS min_mark, hi AS max_mark, n AS n_assessments
 FROM students s LEFT JOIN ({TOTALS_SQL}) t USING (student_id)
 LEFT JOIN (SELECT student_id, AVG(mark) AS m, STDDEV_SAMP(mark) AS sd, MIN(mark) AS lo, MAX(mark) AS hi, COUNT(mark) AS n FROM assessments GROUP BY 1) a USING (student_id)"""
RETENTION_SQL = f"""WITH p AS ({PEOPLE_SQL}),
 r AS (SELECT *, LEAST(GREATEST((CASE WHEN engagement_rate < 30 THEN 30 ELSE 0 END) + (CASE WHEN avg_mark < 50 THEN 25 ELSE 0 END)
  + (CASE WHEN mark_std > 15 THEN 10 ELSE 0 END) + (100 - engagement_rate) * CAST(0.15 AS DOUBLE)
  + (50 - LEAST(GREATEST(avg_mark, 0), 100)) * CAST(0.3 AS DOUBLE) + first_generation_uni * 10 + (10 - imd_decile) * 2, 0), 100) AS risk_score FROM p)
 SELECT student_id, risk_score, CASE WHEN risk_score >= 75 THEN 'Critical' WHEN risk_score >= 50 THEN 'High' WHEN risk_score >= 25 THEN 'Medium' ELSE 'Low' END AS risk_category,
  CASE WHEN risk_score >= 50 THEN 1 ELSE 0 END AS retention_risk, CASE WHEN risk_score < 50 THEN 1 ELSE 0 END AS retained,
  engagement_rate, avg_mark, CAST(total_logins AS BIGINT) AS total_logins, CAST(total_resources AS BIGINT) AS total_resources,
  CASE WHEN engagement_rate < 30 THEN 1 ELSE 0 END AS low_engagement, CASE WHEN avg_mark < 50 THEN 1 ELSE 0 END AS low_grade FROM r"""


def retention(c):
    return outcomes.retention_outcomes(c.students, c.vle_engagement, c.assessments)


@query("s7_retention_risk", RETENTION_SQL, ["risk_score", "engagement_rate", "avg_mark"])
def _(c):
    return retention(c)


EXAM_SQL = f"""WITH p AS ({PEOPLE_SQL}), d AS ({SPREAD_SQL}),
 bm AS (SELECT module_id, AVG(mark) AS mm, AVG(CASE WHEN mark >= 40 THEN 1.0 ELSE 0.0 END) AS pr FROM assessments GROUP BY 1),
 sm AS (SELECT course_id, mm, pr FROM (SELECT course_id, MIN(module_id) AS module_id FROM modules GROUP BY 1) JOIN bm USING (module_id)),
 j AS (SELECT p.*, CASE final_classification WHEN 'First' THEN CAST(75 AS DOUBLE) WHEN '2:1' THEN 68 WHEN '2:2' THEN 58 WHEN 'Third' THEN 50 WHEN 'Fail' THEN 35 ELSE 60 END AS pf,
   COALESCE(mm, 65) AS mm, COALESCE(pr, 0.85) AS pr, COALESCE(exam_weight_pct, 60) AS ew,
   COALESCE(n_assessments, (SELECT QUANTILE_CONT(CAST(n_assessments AS DOUBLE), 0.5) FROM p)) AS nn
   FROM p LEFT JOIN d USING (student_id) LEFT JOIN sm USING (course_id) LEFT JOIN courses USING (course_id)),
 k AS (SELECT *, ROUND_EVEN(LEAST(GREATEST(avg_mark * CAST(0.6 AS DOUBLE) + pf * CAST(0.4 AS DOUBLE) + engagement_rate / 100 * 4.5
   + (mm - 65) / 65 * 2 + (pf - 65) / 65 * 3, 0), 100), 1) AS em FROM j)
 SELECT student_id, em AS exam_mark, CASE WHEN em >= 40 THEN 1 ELSE 0 END AS pass_fail,
  CASE WHEN em >= 70 THEN 'Distinction' WHEN em >= 60 THEN 'Merit' WHEN em >= 40 THEN 'Pass' ELSE 'Fail' END AS grade_class,
  ROUND_EVEN(LEAST(GREATEST(CAST(0.4 AS DOUBLE) / (1 + mark_std / 10) + CAST(0.3 AS DOUBLE) * engagement_rate / 100
    + CAST(0.3 AS DOUBLE) * LEAST(GREATEST(nn, 1), 20) / 20, 0), 1), 3) AS prediction_confidence,
  avg_mark AS cw_mean, mark_std AS cw_std, engagement_rate, ew AS exam_weight_pct, pr AS module_pass_rate, pf AS predicted_final_score FROM k"""
EXAM_DOUBLES = ["exam_mark", "prediction_confidence", "cw_mean", "cw_std", "engagement_rate", "module_pass_rate", "predicted_final_score"]


def exams(c, d=None):
    return outcomes.exam_outcomes(
        c.students, c.assessments, c.vle_engagement, c.modules, d or degrees(c), c.courses
    )


@query("s8_exam_estimate", EXAM_SQL, EXAM_DOUBLES)
def _(c):
    return exams(c)


WELLBEING_SQL = f"""WITH p AS ({PEOPLE_SQL}),
 a AS (SELECT student_id, 100.0 * COUNT(CASE WHEN status = 'Present' THEN 1 END) / COUNT(*) AS ap FROM attendance GROUP BY 1),
 w AS (SELECT p.*, COALESCE(ap, 75) AS att, COALESCE(n_assessments, 5) AS nn FROM p LEFT JOIN a USING (student_id)),
 s AS (SELECT *, ROUND_EVEN(LEAST(GREATEST(30 + engagement_rate / 100 * 25 + att / 100 * 20 + (LEAST(GREATEST(avg_mark, 30), 90) - 30) / 60 * 25
   - first_generation_uni * 8 - (10 - imd_decile) * 1.5 - care_leaver * 10 - nn / CAST(10 AS DOUBLE) * 5, 0), 100), 1) AS ws FROM w)
 SELECT student_id, ws AS wellbeing_score, CASE WHEN ws < 30 THEN 'Critical' WHEN ws < 50 THEN 'High' WHEN ws < 70 THEN 'Medium' ELSE 'Low' END AS risk_level,
  CASE WHEN ws < 50 THEN 1 ELSE 0 END AS at_risk, CASE WHEN ws < 30 THEN 3 WHEN ws < 45 THEN 2 WHEN ws < 60 THEN 1 ELSE 0 END AS support_need,
  engagement_rate, att AS attendance_rate, avg_mark, CAST(total_logins AS BIGINT) AS total_logins, nn AS n_assessments,
  CAST(total_resources AS BIGINT) AS total_resources FROM s"""
WELLBEING_DOUBLES = ["wellbeing_score", "engagement_rate", "attendance_rate", "avg_mark"]


def wellbeing(c):
    return outcomes.wellbeing_outcomes(c.students, c.vle_engagement, c.assessments, c.attendance)


@query("s9_wellbeing", WELLBEING_SQL, WELLBEING_DOUBLES)
def _(c):
    return wellbeing(c)
