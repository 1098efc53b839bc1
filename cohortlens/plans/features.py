"""Feature tables and sequence operators (rows F and I)."""

from pyspark.sql import functions as F

from cohortlens.operators import engagement, feature_tables, marks, outcomes, prep, risk, sequences, student, targets
from cohortlens.operators.course import course_features
from cohortlens.operators.recommend import best_courses, popularity, popular_for_all
from cohortlens.plans.aggregates import (
    ATTENDANCE_DOUBLES,
    ATTENDANCE_SQL,
    MARKS_DOUBLES,
    MARKS_SQL,
    VLE_DOUBLES,
    VLE_SQL,
    head_tail_sql,
)
from cohortlens.plans.outcomes import (
    DEMAND_SQL,
    DRAW,
    DRAW_SQL,
    EXAM_SQL,
    GRADUATES_SQL,
    NSS_SQL,
    RETENTION_SQL,
    SPREAD_SQL,
    TAKEN_SQL,
    TOTALS_SQL,
    WELLBEING_SQL,
    degrees,
    demand,
    exams,
    graduates,
    retention,
    survey,
    wellbeing,
)
from cohortlens.operators.outcomes import THEMES
from cohortlens.plans.registry import query
from cohortlens.plans.scalars import DEPARTMENTS, GRADE_SQL, KINDS, SEGMENTS, TARIFF_SQL, sql_dummies
from cohortlens.session import reliable_checkpoint

GRADES = student.GRADE_LABELS
TARIFFS = ["Low", "Medium", "High", "Very High"]


@query(
    "f1_top_n_per_user",
    """SELECT student_id, course_id, rating AS score, CAST(place AS INT) AS rank FROM
       (SELECT *, ROW_NUMBER() OVER (PARTITION BY student_id ORDER BY rating DESC, course_id) AS place FROM interactions) WHERE place <= 5""",
    ["score"],
)
def _(c):
    return best_courses(c.interactions.select("student_id", "course_id", F.col("rating").alias("score")), 5)


PERCENTILE_SQL = """SELECT student_id, (RANK() OVER (ORDER BY score) + (COUNT(*) OVER (PARTITION BY score) - 1) / CAST(2 AS DOUBLE) - 1)
 / COUNT(*) OVER () * 100 AS percentile FROM predictions"""


@query("f2_percentile_rank", PERCENTILE_SQL, ["percentile"])
def _(c):
    return prep.percentile_ranks(c.predictions, "score").select("student_id", "percentile")


@query(
    "f3_minmax",
    """SELECT student_id, (score - (SELECT MIN(score) FROM predictions)) /
       ((SELECT MAX(score) FROM predictions) - (SELECT MIN(score) FROM predictions)) * 100 AS risk_score FROM predictions""",
    ["risk_score"],
)
def _(c):
    return risk.minmax_score(c.predictions, "score").select("student_id", "risk_score")


HISTORY_SQL = """valid AS (SELECT student_id FROM (SELECT student_id, COUNT(DISTINCT week) AS v FROM vle_engagement GROUP BY 1) x
   FULL JOIN (SELECT student_id, COUNT(DISTINCT week) AS a FROM attendance GROUP BY 1) y USING (student_id)
   WHERE GREATEST(COALESCE(v, 0), COALESCE(a, 0)) >= 4),
 lastw AS (SELECT student_id, MAX(week) AS lw FROM (SELECT student_id, week FROM vle_engagement UNION ALL SELECT student_id, week FROM attendance) GROUP BY 1),
 grid AS (SELECT student_id, CAST(w AS INT) AS week, lw FROM valid JOIN lastw USING (student_id), RANGE(1, 13) t(w)),
 pres AS (SELECT student_id, week, AVG(attended) AS ar, COUNT(CASE WHEN status = 'Absent' THEN 1 END) AS ab,
   COUNT(CASE WHEN status = 'Authorised Absence' THEN 1 END) AS au FROM attendance GROUP BY 1, 2)"""


def sequence_sql(assessed: str) -> str:
    live = lambda x, zero="0": f"CASE WHEN g.week <= lw THEN COALESCE({x}, {zero}) ELSE {zero} END"
    return f"""WITH {HISTORY_SQL}, ass AS ({assessed})
 SELECT g.student_id, g.week, {', '.join(f"{live('v.' + a)} AS {a}" for a in sequences.ACTIVITY)},
  {live('ar')} AS attendance_rate, {live('ab')} AS absent_count, {live('au')} AS authorised_absent, {live('m')} AS avg_mark,
  {live('n')} AS n_assessments, {live('sr')} AS submission_rate, {live('lr')} AS late_rate
 FROM grid g LEFT JOIN vle_engagement v ON v.student_id = g.student_id AND v.week = g.week
 LEFT JOIN pres p ON p.student_id = g.student_id AND p.week = g.week LEFT JOIN ass ON ass.student_id = g.student_id AND ass.aw = g.week"""


WHOLE_SQL = """SELECT student_id, aw, AVG(mark) AS m, COUNT(*) AS n, AVG(submitted) AS sr, AVG(late_submission) AS lr
 FROM assessments, RANGE(1, 13) t(aw) GROUP BY 1, 2"""
DATED_SQL = """SELECT student_id, aw, AVG(mark) AS m, COUNT(*) AS n, AVG(submitted) AS sr, AVG(late_submission) AS lr
 FROM (SELECT *, 1 + module_id % 16 AS week FROM assessments) d, RANGE(1, 13) t(aw) WHERE d.week <= aw GROUP BY 1, 2"""
SEQ_DOUBLES = ["attendance_rate", "avg_mark", "submission_rate", "late_rate"]


@query("f4_weekly_sequence", sequence_sql(WHOLE_SQL), SEQ_DOUBLES)
def _(c):
    return sequences.weekly_sequences(c.vle_engagement, c.attendance, c.assessments)


@query(
    "f5_fixed_length",
    f"""SELECT student_id, COUNT(*) AS steps, ARRAY_TO_STRING(LIST(total_actions ORDER BY week), ',') AS actions
        FROM ({sequence_sql(WHOLE_SQL)}) GROUP BY 1""",
)
def _(c):
    steps = sequences.weekly_sequences(c.vle_engagement, c.attendance, c.assessments)
    packed = sequences.as_arrays(steps, ["total_actions"])
    acts = F.transform("sequence", lambda x: x[0].cast("bigint").cast("string"))
    return packed.select("student_id", F.size("sequence").cast("bigint").alias("steps"), F.array_join(acts, ",").alias("actions"))


@query("f6_cumulative_assessments", sequence_sql(DATED_SQL), SEQ_DOUBLES)
def _(c):
    dated = c.assessments.withColumn("week", (1 + F.col("module_id") % 16).cast("int"))
    return sequences.weekly_sequences(c.vle_engagement, c.attendance, dated)


@query(
    "f7_time_split",
    """SELECT student_id, CASE WHEN place <= FLOOR(n * 0.8) THEN 'train' ELSE 'test' END AS part FROM
       (SELECT student_id, ROW_NUMBER() OVER (ORDER BY enrollment_date, student_id) AS place, COUNT(*) OVER () AS n FROM enrollments)""",
)
def _(c):
    return prep.time_split(c.enrollments, "enrollment_date", "student_id", 0.2).select("student_id", "part")


@query(
    "f8_lead_time",
    """SELECT COUNT(*) AS n_events, AVG(time - 8) AS mean_lead, MEDIAN(CAST(time - 8 AS DOUBLE)) AS median_lead,
       STDDEV_POP(time - 8) AS std_lead, AVG(CASE WHEN time - 8 >= 4 THEN 1.0 ELSE 0.0 END) AS share_early
       FROM (SELECT 1 + student_id % 30 AS time FROM enrollments WHERE enrollment_status = 'Withdrawn')""",
    ["mean_lead", "median_lead", "std_lead", "share_early"],
)
def _(c):
    gone = c.enrollments.where(F.col("enrollment_status") == "Withdrawn")
    return risk.lead_time(gone.select((1 + F.col("student_id") % 30).alias("time")), horizon=4)


@query(
    "f9_mean_weekly_change",
    """SELECT student_id, COALESCE(AVG(d), 0) AS change FROM (SELECT student_id, total_actions - LAG(total_actions)
       OVER (PARTITION BY student_id ORDER BY week) AS d FROM vle_engagement) GROUP BY 1""",
    ["change"],
)
def _(c):
    return engagement.mean_weekly_change(c.vle_engagement, "total_actions", "change")


STUDENT_FEATURES_SQL = f"""SELECT student_id, CASE WHEN gender = 'Female' THEN 1 ELSE 0 END AS gender_encoded, {sql_dummies('ethnicity', 'ethnicity', SEGMENTS)},
        11 - imd_decile AS imd_inverse, CASE WHEN polar_quintile = 1 THEN 1 ELSE 0 END AS low_participation_area,
        care_leaver * 3 + first_generation_uni * 2 + CASE WHEN polar_quintile = 1 THEN 1 ELSE 0 END AS contextual_score,
        {sql_dummies('qualification_type', 'qual', KINDS)}, ucas_tariff_points, predicted_grade, grade_band,
        {sql_dummies('grade_band', 'grade', GRADES)}
        FROM (SELECT *, {GRADE_SQL} AS grade_band FROM students LEFT JOIN qualifications USING (student_id))"""


@query("i1_student_features", STUDENT_FEATURES_SQL)
def _(c):
    return student.student_features(c.students, c.qualifications)


@query(
    "i2_course_features",
    f"""SELECT course_id, {sql_dummies('department', 'dept', DEPARTMENTS)}, entry_tariff, tariff_band, {sql_dummies('tariff_band', 'tariff', TARIFFS)},
        CASE WHEN course_length_years = 4 THEN 1 ELSE 0 END AS sandwich_year, CASE WHEN coursework_weight_pct > 60 THEN 1 ELSE 0 END AS coursework_heavy,
        employment_rate_15m, satisfaction_score, accredited FROM (SELECT *, {TARIFF_SQL} AS tariff_band FROM courses)""",
    ["employment_rate_15m", "satisfaction_score"],
)
def _(c):
    return course_features(c.courses)


@query(
    "i3_engagement_features",
    f"SELECT * FROM ({ATTENDANCE_SQL}) a FULL JOIN ({VLE_SQL}) v USING (student_id)",
    ATTENDANCE_DOUBLES + VLE_DOUBLES,
)
def _(c):
    return engagement.engagement_features(c.attendance, c.vle_engagement)


@query("i4_performance_features", MARKS_SQL, MARKS_DOUBLES)
def _(c):
    return marks.performance_features(c.assessments, c.modules)


TARGETS_SQL = """SELECT student_id, course_id, CASE WHEN retained_year2 = 1 AND final_classification IN ('First', '2:1', 'Completed') THEN 1 ELSE 0 END AS high_satisfaction,
 1 AS accepted_offer, CASE WHEN enrollment_status = 'Withdrawn' OR retained_year2 = 0 THEN 1 ELSE 0 END AS at_risk,
 CASE final_classification WHEN 'First' THEN 4 WHEN '2:1' THEN 3 WHEN '2:2' THEN 2 WHEN 'Third' THEN 1 WHEN 'Pass' THEN 0 WHEN 'Fail' THEN 0 ELSE -1 END AS classification_numeric
 FROM enrollments"""


@query("i5_targets", TARGETS_SQL)
def _(c):
    return targets.enrollment_targets(c.enrollments)


def when(**conditions) -> str:
    return ", ".join(f"CASE WHEN {cond} THEN 1 ELSE 0 END AS feat_{name}" for name, cond in conditions.items())


AGE = "((enrollment_date - date_of_birth) / 365.25)"
MONTH = "EXTRACT(MONTH FROM enrollment_date)"
# at every scale the data has five segments; of the six part types the rarest falls out
TOP_DEPARTMENTS = ["MEDIUM", "LARGE", "STANDARD", "SMALL", "PROMO"]
YIELD_SQL = f"""SELECT student_id, course_id, {when(tariff_band_low='ucas_tariff_points <= 96',
   tariff_band_medium='ucas_tariff_points > 96 AND ucas_tariff_points <= 128', tariff_band_high='ucas_tariff_points > 128')},
 {sql_dummies('qualification_type', 'feat_qual', KINDS)}, predicted_grade AS feat_has_predicted_grade,
 {when(gender_female="gender = 'Female'", gender_male="gender = 'Male'")}, {sql_dummies('ethnicity', 'feat_ethnicity', SEGMENTS)},
 {AGE} AS feat_age_at_enrollment, {when(age_under_21=AGE + ' < 21', age_mature=AGE + ' >= 25')}, 11 - imd_decile AS feat_imd_inverse,
 {when(imd_most_deprived='imd_decile <= 2', imd_least_deprived='imd_decile >= 9', low_participation_area='polar_quintile = 1',
   high_participation_area='polar_quintile >= 4', care_leaver='care_leaver = 1', first_generation='first_generation_uni = 1', has_disability='disability = 1')},
 entry_tariff / 168.0 AS feat_entry_tariff_normalized, {when(entry_tariff_high='entry_tariff >= 144', entry_tariff_low='entry_tariff <= 112')},
 (ucas_tariff_points - entry_tariff) / 168.0 AS feat_grade_match,
 {when(meets_entry_requirements='ucas_tariff_points >= entry_tariff', exceeds_entry_requirements='ucas_tariff_points >= entry_tariff + 16')},
 employment_rate_15m AS feat_employment_rate, {when(high_employment='employment_rate_15m >= 0.9')},
 satisfaction_score / 5.0 AS feat_satisfaction_score, {when(high_satisfaction='satisfaction_score >= 4.5')},
 {sql_dummies('department', 'feat_dept', TOP_DEPARTMENTS)},
 {when(sandwich_year='course_length_years = 4', coursework_heavy='coursework_weight_pct >= 60', exam_heavy='coursework_weight_pct <= 40', accredited='accredited = 1')},
 LN(1 + COALESCE(total_logins, 0)) AS feat_total_logins, LN(1 + COALESCE(total_resources, 0)) AS feat_total_resources,
 COALESCE(avg_logins, 0) AS feat_avg_weekly_logins, COALESCE(et, 0) AS feat_engagement_trend, {when(high_engagement='LN(1 + COALESCE(total_logins, 0)) >= 3')},
 CAST({MONTH} AS INT) AS feat_application_month,
 {when(early_application=MONTH + ' <= 11', late_application=MONTH + ' >= 6', insurance_choice='ucas_tariff_points < entry_tariff - 16',
   clearing_eligible=MONTH + ' >= 6 AND ucas_tariff_points <= 96')},
 CASE WHEN retained_year2 = 1 THEN 1 ELSE 0 END AS accepted
 FROM enrollments LEFT JOIN students USING (student_id) LEFT JOIN qualifications USING (student_id) LEFT JOIN courses USING (course_id)
 LEFT JOIN ({TOTALS_SQL}) t USING (student_id) LEFT JOIN ({head_tail_sql('vle_engagement', 'total_actions', 'et', 7)}) e USING (student_id)"""
YIELD_DOUBLES = [
    f"feat_{x}"
    for x in (
        "age_at_enrollment", "entry_tariff_normalized", "grade_match", "employment_rate", "satisfaction_score",
        "total_logins", "total_resources", "avg_weekly_logins", "engagement_trend",
    )
]


def yield_table(c):
    labelled = targets.yield_label(c.enrollments)
    return feature_tables.yield_features(labelled, c.students, c.qualifications, c.courses, c.vle_engagement)


@query("i6_yield_features", YIELD_SQL, YIELD_DOUBLES)
def _(c):
    return yield_table(c)


STATIC_SQL = """SELECT student_id, CASE WHEN gender = 'Female' THEN 1 ELSE 0 END AS female, CASE WHEN gender = 'Male' THEN 1 ELSE 0 END AS male,
 imd_decile / 10.0 AS imd_norm, CASE WHEN polar_quintile = 1 THEN 1 ELSE 0 END AS polar_q1, care_leaver, first_generation_uni AS first_gen, disability,
 COALESCE(ucas_tariff_points, 100) / 168.0 AS tariff_norm, CASE WHEN qualification_type = 'A-Level' THEN 1 ELSE 0 END AS a_level,
 CASE WHEN qualification_type = 'BTEC' THEN 1 ELSE 0 END AS btec, predicted_grade, 0 AS reserved_1, 0 AS reserved_2, 0 AS reserved_3, 0 AS reserved_4
 FROM students LEFT JOIN qualifications USING (student_id)"""


def sequence_table(c, kind="both"):
    return sequences.early_warning_sequences(
        c.vle_engagement, c.attendance, c.assessments, c.students, c.qualifications, c.enrollments, kind=kind
    )


@query(
    "i7_early_warning_sequences",
    f"""SELECT * FROM ({sequence_sql(WHOLE_SQL)}) q JOIN (SELECT student_id, CASE WHEN enrollment_status = 'Withdrawn' OR retained_year2 = 0 THEN 1 ELSE 0 END AS target FROM enrollments) e USING (student_id)
        LEFT JOIN ({STATIC_SQL}) s USING (student_id)""",
    SEQ_DOUBLES + ["imd_norm", "tariff_norm", "reserved_1", "reserved_2", "reserved_3", "reserved_4"],
)
def _(c):
    return sequence_table(c)


AGGREGATES_SQL = f"""SELECT student_id, CAST(COALESCE(a1, 0) AS BIGINT) AS vle_total_logins, CAST(COALESCE(a2, 0) AS BIGINT) AS vle_total_resources,
 CAST(COALESCE(a3, 0) AS BIGINT) AS vle_total_posts, COALESCE(a4, 0) AS vle_avg_weekly_logins, COALESCE(a5, 0) AS vle_std_weekly_logins, COALESCE(vle_trend, 0) AS vle_trend,
 COALESCE(b1, 0) AS attendance_rate, COALESCE(b2, 0) AS attendance_std, COALESCE(b3, 0) AS total_absences, COALESCE(b4, 0) AS authorised_absences,
 COALESCE(b5, 0) AS medical_absences, COALESCE(attendance_trend, 0) AS attendance_trend, COALESCE(m1, 0) AS avg_mark, COALESCE(m2, 0) AS std_mark,
 COALESCE(m3, 0) AS min_mark, COALESCE(m4, 0) AS n_assessments, COALESCE(m5, 0) AS submission_rate, COALESCE(m6, 0) AS late_submission_rate,
 COALESCE(m7, 0) AS resit_rate, CASE WHEN gender = 'Female' THEN 1 ELSE 0 END AS gender_female, COALESCE(imd_decile, 5) AS imd_decile,
 CASE WHEN polar_quintile = 1 THEN 1 ELSE 0 END AS polar_q1, COALESCE(care_leaver, 0) AS care_leaver, COALESCE(first_generation_uni, 0) AS first_gen,
 COALESCE(ucas_tariff_points, 100) AS ucas_tariff
 FROM (SELECT student_id FROM vle_engagement UNION SELECT student_id FROM attendance UNION SELECT student_id FROM assessments) ids
 LEFT JOIN (SELECT student_id, SUM(logins) AS a1, SUM(resources_accessed) AS a2, SUM(forum_posts) AS a3, AVG(logins) AS a4, STDDEV_SAMP(logins) AS a5 FROM vle_engagement GROUP BY 1) v USING (student_id)
 LEFT JOIN ({head_tail_sql('vle_engagement', 'total_actions', 'vle_trend')}) vt USING (student_id)
 LEFT JOIN (SELECT student_id, AVG(attended) AS b1, STDDEV_SAMP(attended) AS b2, COUNT(CASE WHEN status = 'Absent' THEN 1 END) AS b3,
   COUNT(CASE WHEN status = 'Authorised Absence' THEN 1 END) AS b4, COUNT(CASE WHEN status = 'Medical' THEN 1 END) AS b5 FROM attendance GROUP BY 1) a USING (student_id)
 LEFT JOIN ({head_tail_sql('attendance', 'attended', 'attendance_trend')}) tt USING (student_id)
 LEFT JOIN (SELECT student_id, AVG(mark) AS m1, STDDEV_SAMP(mark) AS m2, MIN(mark) AS m3, COUNT(*) AS m4, AVG(submitted) AS m5, AVG(late_submission) AS m6,
   AVG(CASE WHEN attempt > 1 THEN 1.0 ELSE 0.0 END) AS m7 FROM assessments GROUP BY 1) m USING (student_id)
 LEFT JOIN students USING (student_id) LEFT JOIN qualifications USING (student_id)"""
AGGREGATE_DOUBLES = [
    "vle_avg_weekly_logins", "vle_std_weekly_logins", "vle_trend", "attendance_rate", "attendance_std", "attendance_trend",
    "avg_mark", "std_mark", "min_mark", "submission_rate", "late_submission_rate", "resit_rate",
]


def aggregate_table(c):
    return sequences.early_warning_aggregates(
        c.vle_engagement, c.attendance, c.assessments, c.students, c.qualifications
    )


@query("e26_early_warning_union", AGGREGATES_SQL, AGGREGATE_DOUBLES)
@query("i8_early_warning_aggregates", AGGREGATES_SQL, AGGREGATE_DOUBLES)
def _(c):
    return aggregate_table(c)


DEGREE_FEATURES_SQL = f"""WITH d AS ({SPREAD_SQL}),
 pre AS (SELECT * FROM assessments JOIN (SELECT module_id, year, credits FROM modules) mo USING (module_id) WHERE year < 3),
 g AS (SELECT student_id, AVG(CASE WHEN year = 1 THEN mark END) AS y1, AVG(CASE WHEN year = 2 THEN mark END) AS y2, AVG(mark) AS pm, MAX(mark) AS bm, MIN(mark) AS wm,
   COALESCE(STDDEV_SAMP(mark), 0) AS sm, COUNT(CASE WHEN attempt > 1 THEN 1 END) AS rc,
   COUNT(CASE WHEN attempt > 1 AND mark >= 40 THEN 1 END) / CAST(GREATEST(COUNT(CASE WHEN attempt > 1 THEN 1 END), 1) AS DOUBLE) AS rs,
   SUM(late_submission) AS ls, AVG(late_submission) AS lr, SUM(mark * credits) / SUM(credits) AS cw FROM pre GROUP BY 1),
 att AS (SELECT student_id, AVG(attended) AS ar, AVG(1 - attended) AS ab FROM attendance GROUP BY 1),
 vm AS (SELECT student_id, AVG(logins) AS l, AVG(total_actions) AS a, SUM(forum_posts) AS fp FROM vle_engagement GROUP BY 1),
 j AS (SELECT student_id, y1, y2, pm, bm, wm, sm, rc, rs, ls, lr, cw, ar, ab, attt, l / (SELECT MAX(l) FROM vm) AS vl, a / (SELECT MAX(a) FROM vm) AS va, fp, vt,
   ucas_tariff_points AS ut, gender, ethnicity, imd_decile, polar_quintile, care_leaver, disability, first_generation_uni, course_length_years AS cl, y2 - y1 AS ch,
   CASE final_classification WHEN 'Fail' THEN 0 WHEN 'Third' THEN 1 WHEN '2:2' THEN 2 WHEN '2:1' THEN 3 WHEN 'First' THEN 4 END AS target
   FROM d LEFT JOIN students USING (student_id) LEFT JOIN qualifications USING (student_id) LEFT JOIN (SELECT course_id, course_length_years FROM courses) co USING (course_id)
   LEFT JOIN g USING (student_id) LEFT JOIN att USING (student_id) LEFT JOIN ({head_tail_sql('attendance', 'attended', 'attt')}) at2 USING (student_id)
   LEFT JOIN vm USING (student_id) LEFT JOIN ({head_tail_sql('vle_engagement', 'total_actions', 'vt')}) vt2 USING (student_id))
 SELECT student_id, COALESCE(y1, 0) AS feat_year_1_gpa, COALESCE(y2, 0) AS feat_year_2_gpa, COALESCE(pm, 0) AS feat_pre_final_gpa, COALESCE(bm, 0) AS feat_best_mark,
  COALESCE(wm, 0) AS feat_worst_mark, COALESCE(sm, 0) AS feat_std_mark, COALESCE(rc, 0) AS feat_resit_count, COALESCE(rs, 0) AS feat_resit_success_rate,
  CAST(COALESCE(ls, 0) AS BIGINT) AS feat_late_submissions, COALESCE(lr, 0) AS feat_late_submission_rate, COALESCE(cw, 0) AS feat_credit_weighted_avg,
  COALESCE(ar, 0) AS feat_attendance_rate, COALESCE(ab, 0) AS feat_absence_rate, COALESCE(attt, 0) AS feat_attendance_trend, COALESCE(vl, 0) AS feat_vle_avg_logins,
  COALESCE(va, 0) AS feat_vle_total_actions, CAST(COALESCE(fp, 0) AS BIGINT) AS feat_vle_total_forum_posts, COALESCE(vt, 0) AS feat_vle_trend,
  COALESCE(ch, 0) AS feat_mark_trend_y2_vs_y1, CASE WHEN ch IS NULL THEN -1 WHEN ch <= -5 THEN 0 WHEN ch <= 5 THEN 1 ELSE 2 END AS feat_mark_trend_category,
  CASE WHEN fp > 0 THEN 1 ELSE 0 END AS feat_vle_forum_activity, CAST(ut AS DOUBLE) AS feat_entry_tariff, ut / 168.0 AS feat_entry_tariff_normalized,
  {when(gender_female="gender = 'Female'", gender_male="gender = 'Male'", ethnicity_white_british="ethnicity = 'White British'", ethnicity_asian="ethnicity = 'Asian/Asian British'",
    ethnicity_black="ethnicity = 'Black/Black British'", ethnicity_white_other="ethnicity IN ('White Irish', 'White Other')", ethnicity_mixed="ethnicity = 'Mixed'")},
  imd_decile / 10.0 AS feat_imd_deprivation, {when(low_participation='polar_quintile = 1', care_leaver='care_leaver = 1', disability='disability = 1', first_generation='first_generation_uni = 1')},
  0.5 AS feat_course_difficulty, COALESCE(cl, 3) AS feat_course_length, COALESCE(y1 / 100, 0) AS feat_year_1_gpa_normalized,
  {when(early_warning_low_y1='y1 < 50', early_warning_decline='ch < -10', early_warning_absence='ab > 0.2')},
  (CASE WHEN y1 < 50 THEN 1 ELSE 0 END) + (CASE WHEN ch < -10 THEN 1 ELSE 0 END) + (CASE WHEN ab > 0.2 THEN 1 ELSE 0 END) AS feat_early_warning_score,
  CAST(SIGN(COALESCE(ch, 0)) AS DOUBLE) AS feat_gpa_trajectory, COALESCE(va, 0) * 0.5 + COALESCE(ar, 0.5) * 0.5 AS feat_engagement_index, target FROM j"""
DEGREE_DOUBLES = [
    f"feat_{x}"
    for x in (
        "year_1_gpa", "year_2_gpa", "pre_final_gpa", "best_mark", "worst_mark", "std_mark", "resit_success_rate",
        "late_submission_rate", "credit_weighted_avg", "attendance_rate", "absence_rate", "attendance_trend",
        "vle_avg_logins", "vle_total_actions", "vle_trend", "mark_trend_y2_vs_y1", "entry_tariff", "entry_tariff_normalized",
        "imd_deprivation", "course_difficulty", "year_1_gpa_normalized", "gpa_trajectory", "engagement_index",
    )
]


def degree_table(c):
    return feature_tables.degree_features(
        degrees(c), c.students, c.qualifications, c.courses, c.assessments, c.modules, c.attendance, c.vle_engagement
    )


@query("i9_degree_features", DEGREE_FEATURES_SQL, DEGREE_DOUBLES)
def _(c):
    return degree_table(c)


DROP_FIRST_SQL = ", ".join(
    [
        sql_dummies("gender", "gender", ["Male", "Not disclosed", "Other"]),
        sql_dummies("ethnicity", "ethnicity", SEGMENTS[1:]),
        *[sql_dummies(f"CAST({x} AS VARCHAR)", x, ["1"]) for x in ("disability", "care_leaver", "first_generation_uni")],
    ]
)
PERCENT_SQL = "SELECT student_id, 100.0 * COUNT(CASE WHEN status = 'Present' THEN 1 END) / COUNT(*) AS attendance_pct FROM attendance GROUP BY 1"
PERCENT_FILLED = f"COALESCE(attendance_pct, (SELECT MEDIAN(attendance_pct) FROM ({PERCENT_SQL}))) AS attendance_pct"
STUDY_SQL = "SELECT student_id, weighted_gpa, final_classification FROM ({})".format(SPREAD_SQL)
ORDINAL_SQL = "CASE final_classification WHEN 'Fail' THEN 0 WHEN 'Third' THEN 1 WHEN '2:2' THEN 2 WHEN '2:1' THEN 3 WHEN 'First' THEN 4 ELSE 2 END"


def filled_sql(column: str, table: str) -> str:
    """A column with its median in the gaps: whole numbers become doubles."""
    return f"CAST(COALESCE({column}, (SELECT QUANTILE_CONT(CAST({column} AS DOUBLE), 0.5) FROM ({table}) f)) AS DOUBLE) AS {column}"


GRADUATE_FEATURES_SQL = f"""WITH gr AS ({GRADUATES_SQL}), st AS ({STUDY_SQL}),
 j AS (SELECT * FROM gr JOIN students USING (student_id) LEFT JOIN st USING (student_id) LEFT JOIN ({PERCENT_SQL}) pc USING (student_id))
 SELECT student_id, COALESCE(weighted_gpa, (SELECT MEDIAN(weighted_gpa) FROM j)) AS gpa, {ORDINAL_SQL} AS predicted_class_ordinal,
  degree_class_ordinal / 4.0 * 60 + total_logins / CAST((SELECT MAX(total_logins) FROM gr) + 1 AS DOUBLE) * 40 AS career_readiness_score,
  {PERCENT_FILLED}, total_logins, total_resources, imd_decile, polar_quintile, degree_class_ordinal, {DROP_FIRST_SQL},
  CASE employment_status WHEN 'Unemployed' THEN 0 WHEN 'Further Study Only' THEN 1 WHEN 'Both Employed and Study' THEN 2 ELSE 3 END AS y_employment,
  CASE salary_band WHEN 'Under £20,000' THEN 0 WHEN '£20,000 - £30,000' THEN 1 WHEN '£30,000 - £40,000' THEN 2 ELSE 3 END AS y_salary,
  CASE study_destination WHEN 'Not Studying' THEN 0 WHEN 'UK' THEN 1 WHEN 'EU' THEN 2 ELSE 3 END AS y_study FROM j"""


def graduate_table(c):
    d = degrees(c)
    return feature_tables.graduate_features(graduates(c, d), c.students, d, c.attendance)


@query("i10_graduate_features", GRADUATE_FEATURES_SQL, ["gpa", "career_readiness_score", "attendance_pct"])
def _(c):
    return graduate_table(c)


SURVEY_FEATURES_SQL = f"""WITH nss AS ({NSS_SQL}), st AS ({STUDY_SQL}),
 j AS (SELECT * FROM nss JOIN students USING (student_id) LEFT JOIN st USING (student_id) LEFT JOIN ({PERCENT_SQL}) pc USING (student_id)
   LEFT JOIN (SELECT student_id, total_logins, total_resources FROM ({TOTALS_SQL})) tt USING (student_id))
 SELECT student_id, COALESCE(weighted_gpa, (SELECT MEDIAN(weighted_gpa) FROM j)) AS gpa, {ORDINAL_SQL} AS predicted_class_ordinal, engagement_rate, {PERCENT_FILLED},
  CAST(COALESCE(total_logins, 0) AS BIGINT) AS total_logins, CAST(COALESCE(total_resources, 0) AS BIGINT) AS total_resources, imd_decile, polar_quintile,
  module_evals_submitted, feedback_response_rate, {DROP_FIRST_SQL}, overall_satisfied AS y_satisfied, nps_score AS y_nps,
  {', '.join(f'{t}_score AS y_{t}_score' for t in THEMES)} FROM j"""


def survey_table(c):
    d = degrees(c)
    return feature_tables.survey_features(survey(c, d), c.students, d, c.vle_engagement, c.attendance)


@query(
    "i11_survey_features",
    SURVEY_FEATURES_SQL,
    ["gpa", "engagement_rate", "attendance_pct", "feedback_response_rate", *[f"y_{t}_score" for t in THEMES]],
)
def _(c):
    return survey_table(c)


MARK_STATS_SQL = """SELECT student_id, AVG(mark) AS assess_mean, STDDEV_SAMP(mark) AS assess_std, MIN(mark) AS assess_min,
 MAX(mark) AS assess_max, COUNT(mark) AS n_assessments FROM assessments GROUP BY 1"""
ACT_FILLED = ", ".join(filled_sql(x, TOTALS_SQL) for x in ("total_logins", "total_resources", "total_actions"))
MARKS_FILLED = ["assess_mean", "assess_std", "assess_min", "assess_max"]
RETENTION_FEATURES_SQL = f"""WITH ro AS ({RETENTION_SQL}), ms AS ({MARK_STATS_SQL})
 SELECT student_id, engagement_rate, assess_mean, assess_std, assess_min, assess_max, n_assessments, {ACT_FILLED}, imd_decile, polar_quintile,
  2024 - CAST(EXTRACT(YEAR FROM date_of_birth) AS INT) AS age, {DROP_FIRST_SQL}, risk_score AS y_risk_score, retention_risk AS y_retention_risk,
  CASE risk_category WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 WHEN 'High' THEN 2 ELSE 3 END AS y_risk_category,
  CASE WHEN retention_risk = 1 THEN CASE WHEN {DRAW_SQL.format(7919)} < 0.5 THEN 1 WHEN {DRAW_SQL.format(7919)} < 0.85 THEN 2 ELSE 3 END ELSE 0 END AS y_departure_year
 FROM (SELECT student_id, engagement_rate, risk_score, retention_risk, risk_category FROM ro) r JOIN students USING (student_id)
 LEFT JOIN ({TOTALS_SQL}) t USING (student_id) LEFT JOIN ms USING (student_id)"""


def retention_table(c):
    known = retention(c)
    left = known.withColumn("departure_year", outcomes.departure_year(F.col("retention_risk"), DRAW(7919)))
    return feature_tables.retention_features(left, c.students, c.vle_engagement, c.assessments)


@query(
    "i12_retention_features",
    RETENTION_FEATURES_SQL,
    ["engagement_rate", *MARKS_FILLED, "total_logins", "total_resources", "total_actions", "y_risk_score"],
)
def _(c):
    return retention_table(c)


EXAM_FEATURES_SQL = f"""WITH ex AS ({EXAM_SQL}), ms AS ({MARK_STATS_SQL})
 SELECT student_id, cw_mean, cw_std, engagement_rate, {ACT_FILLED}, {filled_sql('avg_logins', TOTALS_SQL)}, {filled_sql('avg_actions', TOTALS_SQL)},
  assess_mean, assess_std, n_assessments, exam_weight_pct, module_pass_rate, predicted_final_score, imd_decile, polar_quintile, {DROP_FIRST_SQL},
  exam_mark AS y_exam_mark, pass_fail AS y_pass_fail, CASE grade_class WHEN 'Fail' THEN 0 WHEN 'Pass' THEN 1 WHEN 'Merit' THEN 2 ELSE 3 END AS y_grade_class
 FROM ex JOIN students USING (student_id) LEFT JOIN ({TOTALS_SQL}) t USING (student_id) LEFT JOIN ms USING (student_id)"""


def exam_table(c):
    return feature_tables.exam_features(exams(c), c.students, c.assessments, c.vle_engagement)


@query(
    "i13_exam_features",
    EXAM_FEATURES_SQL,
    ["cw_mean", "cw_std", "engagement_rate", "total_logins", "total_resources", "total_actions", "avg_logins", "avg_actions",
     "assess_mean", "assess_std", "module_pass_rate", "predicted_final_score", "y_exam_mark"],
)
def _(c):
    return exam_table(c)


WELLBEING_FEATURES_SQL = f"""WITH wb AS ({WELLBEING_SQL}), ms AS ({MARK_STATS_SQL})
 SELECT student_id, engagement_rate, attendance_rate, avg_mark, assess_mean, assess_std, total_logins, total_resources, n_assessments, assess_min, assess_max,
  imd_decile, polar_quintile, {PERCENT_FILLED}, {DROP_FIRST_SQL}, wellbeing_score AS y_wellbeing_score, at_risk AS y_at_risk,
  CASE risk_level WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 WHEN 'High' THEN 2 ELSE 3 END AS y_risk_level, support_need AS y_support_need
 FROM (SELECT * EXCLUDE (n_assessments) FROM wb) w JOIN students USING (student_id) LEFT JOIN ms USING (student_id) LEFT JOIN ({PERCENT_SQL}) pc USING (student_id)"""


def wellbeing_table(c):
    return feature_tables.wellbeing_features(wellbeing(c), c.students, c.assessments, c.attendance)


@query(
    "i14_wellbeing_features",
    WELLBEING_FEATURES_SQL,
    ["engagement_rate", "attendance_rate", "avg_mark", *MARKS_FILLED, "attendance_pct", "y_wellbeing_score"],
)
def _(c):
    return wellbeing_table(c)


DEMAND_FEATURES_SQL = f"""WITH dm AS ({DEMAND_SQL}), h AS (SELECT module_id, AVG(grade) AS avg_grade, STDDEV_SAMP(grade) AS grade_std, COUNT(*) AS total_enrollments,
   AVG(completed) AS completion_rate FROM ({TAKEN_SQL}) GROUP BY 1)
 SELECT module_id, capacity, exam_weight_pct, coursework_weight_pct, avg_grade, COALESCE(grade_std, 0) AS grade_std, COALESCE(total_enrollments, 0) AS total_enrollments,
  COALESCE(completion_rate, 0) AS completion_rate, CAST(DENSE_RANK() OVER (ORDER BY department) - 1 AS INT) AS department_encoded, popularity_score,
  enrollment_count AS y_enrollment_count, fill_rate AS y_fill_rate, CASE demand_category WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 WHEN 'High' THEN 2 ELSE 3 END AS y_demand_category
 FROM dm LEFT JOIN h USING (module_id)"""


def demand_table(c):
    return feature_tables.demand_features(demand(c), outcomes.module_enrollments(c.assessments))


@query(
    "i15_demand_features",
    DEMAND_FEATURES_SQL,
    ["avg_grade", "grade_std", "completion_rate", "popularity_score", "y_fill_rate"],
)
def _(c):
    return demand_table(c)


def listed_scores(c, n: int = 10):
    """Score lists of two recommenders: overall popularity, and the student's own mean rating."""
    popular = popular_for_all(c.students, popularity(c.courses, c.enrollments), n)
    rated = best_courses(c.interactions.select("student_id", "course_id", F.col("rating").alias("score")), n)
    cols = ["student_id", "course_id", "score"]
    return (
        popular.select(*cols, F.lit("popularity").alias("model"))
        .unionByName(rated.select(*cols, F.lit("rating").alias("model")))
    )


def model_scores(c, n: int = 10):
    """The score lists, kept: several steps count and read them."""
    return reliable_checkpoint(listed_scores(c, n))


SCORES_SQL = """SELECT s.student_id, p.course_id, CAST(p.n AS DOUBLE) AS score, 'popularity' AS model FROM students s
   CROSS JOIN (SELECT course_id, COUNT(*) AS n FROM enrollments JOIN courses USING (course_id) GROUP BY 1 ORDER BY n DESC, course_id LIMIT 10) p
 UNION ALL SELECT student_id, course_id, rating, 'rating' FROM
   (SELECT *, ROW_NUMBER() OVER (PARTITION BY student_id ORDER BY rating DESC, course_id) AS place FROM interactions) WHERE place <= 10"""


SAMPLES_SQL = f"""WITH sc AS ({SCORES_SQL}), wide AS (SELECT student_id, course_id, MAX(CASE WHEN model = 'popularity' THEN score END) AS popularity,
          MAX(CASE WHEN model = 'rating' THEN score END) AS rating FROM sc GROUP BY 1, 2),
        good AS (SELECT DISTINCT student_id, course_id FROM enrollments), held AS (SELECT student_id, COUNT(*) AS n FROM good GROUP BY 1),
        bad AS (SELECT w.*, n, ROW_NUMBER() OVER (PARTITION BY w.student_id ORDER BY GREATEST(COALESCE(popularity, 0), COALESCE(rating, 0), 0) DESC, w.course_id) AS place
          FROM wide w JOIN held ON held.student_id = w.student_id WHERE NOT EXISTS (SELECT 1 FROM good g WHERE g.student_id = w.student_id AND g.course_id = w.course_id))
        SELECT student_id, course_id, COALESCE(popularity, 0) AS popularity, COALESCE(rating, 0) AS rating, 1 AS label, student_id AS query_id
        FROM good LEFT JOIN wide USING (student_id, course_id)
        UNION ALL SELECT student_id, course_id, COALESCE(popularity, 0), COALESCE(rating, 0), 0, student_id FROM bad WHERE place <= 2 * n"""


@query(
    "i16_ranking_samples",
    SAMPLES_SQL,
    ["popularity", "rating"],
)
def _(c):
    return feature_tables.ranking_samples(model_scores(c), c.enrollments)
