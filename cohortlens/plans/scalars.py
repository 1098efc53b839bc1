"""Scalar column operators (rows B1–B30)."""

from pyspark.sql import functions as F

from cohortlens.functions import expr
from cohortlens.operators import categories, course, engagement, marks, profiles, sparse, student, targets
from cohortlens.plans.registry import query

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
KINDS = ["A-Level", "Access to HE", "BTEC", "International Baccalaureate"]
DEPARTMENTS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def sql_dummies(column, prefix, names):
    return ", ".join(
        f"""CASE WHEN {column} = '{v}' THEN 1 ELSE 0 END AS "{expr.column_name(prefix, v)}\"""" for v in names
    )


@query(
    "b1_equality_flag",
    """SELECT student_id, CASE WHEN gender = 'Female' THEN 1 ELSE 0 END AS female,
       CASE WHEN final_classification = 'First' THEN 1 ELSE 0 END AS is_first
       FROM students LEFT JOIN enrollments USING (student_id)""",
)
def _(c):
    return c.students.join(c.enrollments, "student_id", "left").select(
        "student_id",
        expr.flag(F.col("gender") == "Female").alias("female"),
        expr.flag(F.col("final_classification") == "First").alias("is_first"),
    )


@query(
    "b2_threshold_flags",
    """SELECT course_id, CASE WHEN coursework_weight_pct > 60 THEN 1 ELSE 0 END AS coursework_heavy,
       CASE WHEN coursework_weight_pct >= 60 THEN 1 ELSE 0 END AS coursework_heavy_yield,
       CASE WHEN coursework_weight_pct <= 40 THEN 1 ELSE 0 END AS exam_heavy,
       CASE WHEN employment_rate_15m >= 0.9 THEN 1 ELSE 0 END AS high_employment,
       CASE WHEN satisfaction_score >= 4.5 THEN 1 ELSE 0 END AS high_satisfaction FROM courses""",
)
def _(c):
    cw = F.col("coursework_weight_pct")
    return c.courses.select(
        "course_id",
        expr.flag(cw > 60).alias("coursework_heavy"),
        expr.flag(cw >= 60).alias("coursework_heavy_yield"),
        expr.flag(cw <= 40).alias("exam_heavy"),
        expr.flag(F.col("employment_rate_15m") >= 0.90).alias("high_employment"),
        expr.flag(F.col("satisfaction_score") >= 4.5).alias("high_satisfaction"),
    )


@query(
    "b3_normalise",
    """SELECT student_id, 11 - imd_decile AS imd_inverse, ucas_tariff_points / 168.0 AS tariff_norm,
       imd_decile / 10.0 AS imd_norm FROM students LEFT JOIN qualifications USING (student_id)""",
    ["tariff_norm", "imd_norm"],
)
def _(c):
    return c.students.join(c.qualifications, "student_id", "left").select(
        "student_id",
        (11 - F.col("imd_decile")).alias("imd_inverse"),
        (F.col("ucas_tariff_points") / 168.0).alias("tariff_norm"),
        (F.col("imd_decile") / 10.0).alias("imd_norm"),
    )


@query(
    "b4_contextual_score",
    """SELECT student_id, care_leaver * 3 + first_generation_uni * 2
       + CASE WHEN polar_quintile = 1 THEN 1 ELSE 0 END AS contextual_score FROM students""",
)
def _(c):
    low = expr.flag(F.col("polar_quintile") == 1)
    return c.students.select(
        "student_id",
        student.contextual_score(F.col("care_leaver"), F.col("first_generation_uni"), low).alias("contextual_score"),
    )


GRADE_SQL = """CASE WHEN ucas_tariff_points > 0 AND ucas_tariff_points <= 80 THEN 'C'
 WHEN ucas_tariff_points > 80 AND ucas_tariff_points <= 112 THEN 'BC'
 WHEN ucas_tariff_points > 112 AND ucas_tariff_points <= 128 THEN 'B'
 WHEN ucas_tariff_points > 128 AND ucas_tariff_points <= 144 THEN 'AB'
 WHEN ucas_tariff_points > 144 AND ucas_tariff_points <= 168 THEN 'A'
 WHEN ucas_tariff_points > 168 AND ucas_tariff_points <= 200 THEN 'A*' END"""
TARIFF_SQL = """CASE WHEN entry_tariff > 0 AND entry_tariff <= 96 THEN 'Low'
 WHEN entry_tariff > 96 AND entry_tariff <= 120 THEN 'Medium'
 WHEN entry_tariff > 120 AND entry_tariff <= 144 THEN 'High' WHEN entry_tariff > 144 THEN 'Very High' END"""


@query("b5_grade_band", f"SELECT student_id, {GRADE_SQL} AS grade_band FROM qualifications")
def _(c):
    return c.qualifications.select("student_id", student.grade_band(F.col("ucas_tariff_points")).alias("grade_band"))


@query("b6_tariff_band", f"SELECT course_id, {TARIFF_SQL} AS tariff_band FROM courses")
def _(c):
    return c.courses.select("course_id", course.tariff_band(F.col("entry_tariff")).alias("tariff_band"))


@query(
    "b7_tariff_flags",
    """SELECT student_id, CASE WHEN ucas_tariff_points <= 96 THEN 1 ELSE 0 END AS low,
       CASE WHEN ucas_tariff_points > 96 AND ucas_tariff_points <= 128 THEN 1 ELSE 0 END AS medium,
       CASE WHEN ucas_tariff_points > 128 THEN 1 ELSE 0 END AS high FROM qualifications""",
)
def _(c):
    t = F.col("ucas_tariff_points")
    return c.qualifications.select(
        "student_id",
        expr.flag(t <= 96).alias("low"),
        expr.flag((t > 96) & (t <= 128)).alias("medium"),
        expr.flag(t > 128).alias("high"),
    )


YEAR_MEANS_SQL = """SELECT student_id, AVG(CASE WHEN year = 1 THEN mark END) AS y1,
 AVG(CASE WHEN year = 2 THEN mark END) AS y2 FROM assessments JOIN modules USING (module_id) GROUP BY student_id"""


@query(
    "b8_trend_code",
    f"""SELECT student_id, CASE WHEN y2 - y1 IS NULL THEN -1 WHEN y2 - y1 <= -5 THEN 0
        WHEN y2 - y1 <= 5 THEN 1 ELSE 2 END AS trend FROM ({YEAR_MEANS_SQL})""",
)
def _(c):
    f = marks.performance_features(c.assessments, c.modules)
    change = F.col("year2_avg_mark") - F.col("year1_avg_mark")
    return f.select("student_id", marks.trend_code(change).alias("trend"))


@query("b9_one_hot", f"SELECT student_id, {sql_dummies('ethnicity', 'ethnicity', SEGMENTS)} FROM students")
def _(c):
    return c.students.select("student_id", *categories.dummies(c.students, "ethnicity", "ethnicity"))


@query(
    "b10_one_hot_drop_first",
    f"""SELECT student_id, {sql_dummies("COALESCE(gender, 'Unknown')", 'gender', ['Male', 'Not disclosed', 'Other'])},
        {sql_dummies("COALESCE(CAST(disability AS VARCHAR), 'Unknown')", 'disability', ['1'])} FROM students""",
)
def _(c):
    return c.students.select("student_id", *categories.dummies_drop_first(c.students, ["gender", "disability"]))


@query(
    "b9_sparse_one_hot",
    """WITH long AS (SELECT course_id, 0 AS i, 'course_name' AS "column", course_name AS level FROM courses
         UNION ALL SELECT course_id, 1, 'department', department FROM courses),
       numbered AS (SELECT i, level, ROW_NUMBER() OVER (ORDER BY i, level) - 1 AS position FROM (SELECT DISTINCT i, level FROM long))
       SELECT course_id, position, "column", level FROM long JOIN numbered USING (i, level)""",
)
def _(c):
    return sparse.LevelTable.fit(c.courses, ["course_name", "department"]).pairs(c.courses, "course_id")


@query(
    "b10_sparse_drop_first",
    """WITH long AS (SELECT student_id, 0 AS i, 'gender' AS "column", COALESCE(gender, 'Unknown') AS level FROM students
         UNION ALL SELECT student_id, 1, 'date_of_birth', COALESCE(CAST(date_of_birth AS VARCHAR), 'Unknown') FROM students),
       kinds AS (SELECT DISTINCT i, level FROM long),
       numbered AS (SELECT i, level, ROW_NUMBER() OVER (ORDER BY i, level) - 1 AS position
         FROM kinds WHERE (i, level) NOT IN (SELECT (i, MIN(level)) FROM kinds GROUP BY i))
       SELECT student_id, position, "column", level FROM long JOIN numbered USING (i, level)""",
)
def _(c):
    return sparse.LevelTable.fit(c.students, ["gender", "date_of_birth"], drop_first=True, missing="Unknown").pairs(c.students, "student_id")


@query(
    "b11_top_levels",
    """WITH top AS (SELECT department, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, department) AS place
        FROM courses GROUP BY department)
       SELECT course_id, COALESCE(CAST(place AS INT), 0) AS top_place FROM courses
       LEFT JOIN (SELECT * FROM top WHERE place <= 5) t USING (department)""",
)
def _(c):
    top = categories.top_levels(c.courses, "department", 5)
    place = F.array_position(F.array(*[F.lit(v) for v in top]), F.col("department"))
    return c.courses.select("course_id", F.coalesce(place, F.lit(0)).cast("int").alias("top_place"))


@query(
    "b12_ethnicity_group",
    """SELECT student_id, CASE WHEN ethnicity = 'White British' THEN 'white_british'
       WHEN ethnicity IN ('White Irish', 'White Other') THEN 'white_other' WHEN ethnicity = 'Mixed' THEN 'mixed'
       WHEN ethnicity = 'Asian/Asian British' THEN 'asian' WHEN ethnicity = 'Black/Black British' THEN 'black'
       WHEN ethnicity = 'Other Ethnic Group' THEN 'other' WHEN ethnicity = 'Not disclosed' THEN 'not_disclosed'
       ELSE 'unknown' END AS ethnicity_group
       FROM (SELECT student_id, CASE student_id % 9 WHEN 0 THEN 'White British' WHEN 1 THEN 'White Irish'
         WHEN 2 THEN 'White Other' WHEN 3 THEN 'Mixed' WHEN 4 THEN 'Asian/Asian British'
         WHEN 5 THEN 'Black/Black British' WHEN 6 THEN 'Other Ethnic Group' WHEN 7 THEN 'Not disclosed'
         ELSE ethnicity END AS ethnicity FROM students)""",
)
def _(c):
    # the customer segments carry none of the eight names: spread these over the students
    names = list(student.ETHNICITY_GROUPS)
    spread = F.try_element_at(F.array(*[F.lit(n) for n in names]), (F.col("student_id") % 9 + 1).cast("int"))
    named = c.students.withColumn("ethnicity", F.coalesce(spread, F.col("ethnicity")))
    return named.select("student_id", student.ethnicity_group(F.col("ethnicity")).alias("ethnicity_group"))


@query(
    "b13_age_at_enrolment",
    """SELECT student_id, (enrollment_date - date_of_birth) / 365.25 AS age,
       CASE WHEN (enrollment_date - date_of_birth) / 365.25 < 21 THEN 1 ELSE 0 END AS under_21,
       CASE WHEN (enrollment_date - date_of_birth) / 365.25 >= 25 THEN 1 ELSE 0 END AS mature
       FROM enrollments JOIN students USING (student_id)""",
    ["age"],
)
def _(c):
    age = student.age_at(F.col("enrollment_date"), F.col("date_of_birth"))
    return c.enrollments.join(c.students, "student_id").select(
        "student_id",
        age.alias("age"),
        expr.flag(age < 21).alias("under_21"),
        expr.flag(age >= 25).alias("mature"),
    )


@query(
    "b14_age_by_year",
    "SELECT student_id, COALESCE(2024 - CAST(EXTRACT(YEAR FROM date_of_birth) AS INT), 19) AS age FROM students",
)
def _(c):
    return c.students.select("student_id", student.age_by_year(F.col("date_of_birth")).alias("age"))


@query(
    "b15_application_timing",
    """SELECT student_id, CAST(EXTRACT(MONTH FROM enrollment_date) AS INT) AS month,
       CASE WHEN EXTRACT(MONTH FROM enrollment_date) <= 11 THEN 1 ELSE 0 END AS early,
       CASE WHEN EXTRACT(MONTH FROM enrollment_date) >= 6 THEN 1 ELSE 0 END AS late FROM enrollments""",
)
def _(c):
    month = F.month("enrollment_date")
    return c.enrollments.select(
        "student_id", month.alias("month"), expr.flag(month <= 11).alias("early"), expr.flag(month >= 6).alias("late")
    )


@query(
    "b16_postcode_area",
    """SELECT s_suppkey, UPPER(SUBSTR(s_name, 1, 2)) AS area,
       CASE WHEN UPPER(SUBSTR(s_name, 1, 2)) = 'SU' THEN 1 ELSE 0 END AS is_local FROM supplier""",
)
def _(c):
    area = profiles.postcode_area(F.col("s_name"))
    return c.raw("supplier").select("s_suppkey", area.alias("area"), expr.flag(area == "SU").alias("is_local"))


@query(
    "b17_grade_match",
    """SELECT student_id, (ucas_tariff_points - entry_tariff) / 168.0 AS grade_match,
       CASE WHEN ucas_tariff_points >= entry_tariff THEN 1 ELSE 0 END AS meets,
       CASE WHEN ucas_tariff_points >= entry_tariff + 16 THEN 1 ELSE 0 END AS exceeds,
       CASE WHEN ucas_tariff_points < entry_tariff - 16 THEN 1 ELSE 0 END AS insurance
       FROM enrollments LEFT JOIN qualifications USING (student_id) LEFT JOIN courses USING (course_id)""",
    ["grade_match"],
)
def _(c):
    have, need = F.col("ucas_tariff_points"), F.col("entry_tariff")
    joined = c.enrollments.join(c.qualifications, "student_id", "left").join(c.courses, "course_id", "left")
    return joined.select(
        "student_id",
        ((have - need) / 168.0).alias("grade_match"),
        expr.flag(have >= need).alias("meets"),
        expr.flag(have >= need + 16).alias("exceeds"),
        expr.flag(have < need - 16).alias("insurance"),
    )


@query(
    "b18_clearing_eligible",
    """SELECT student_id, CASE WHEN EXTRACT(MONTH FROM enrollment_date) >= 6 AND ucas_tariff_points <= 96
       THEN 1 ELSE 0 END AS clearing FROM enrollments LEFT JOIN qualifications USING (student_id)""",
)
def _(c):
    late = F.month("enrollment_date") >= 6
    return c.enrollments.join(c.qualifications, "student_id", "left").select(
        "student_id", expr.flag(late & (F.col("ucas_tariff_points") <= 96)).alias("clearing")
    )


@query(
    "b19_log1p",
    """SELECT student_id, LN(1 + SUM(logins)) AS log_logins, LN(1 + SUM(resources_accessed)) AS log_resources,
       CASE WHEN LN(1 + SUM(logins)) >= 3 THEN 1 ELSE 0 END AS high_engagement
       FROM vle_engagement GROUP BY student_id""",
    ["log_logins", "log_resources"],
)
def _(c):
    return engagement.vle_totals(c.vle_engagement).select(
        "student_id",
        F.log1p("total_logins").alias("log_logins"),
        F.log1p("total_resources").alias("log_resources"),
        expr.flag(F.log1p("total_logins") >= 3.0).alias("high_engagement"),
    )


@query(
    "b20_sign_clip_round",
    f"""SELECT student_id, CAST(SIGN(COALESCE(y2 - y1, 0)) AS DOUBLE) AS direction,
        CASE WHEN y2 - y1 < -20 THEN -20 WHEN y2 - y1 > 20 THEN 20 ELSE y2 - y1 END AS clipped, ROUND_EVEN(y1 / 2, 0) AS half_even FROM ({YEAR_MEANS_SQL})""",
    ["direction", "clipped", "half_even"],
)
def _(c):
    f = marks.performance_features(c.assessments, c.modules)
    change = F.col("year2_avg_mark") - F.col("year1_avg_mark")
    return f.select(
        "student_id",
        F.signum(F.coalesce(change, F.lit(0.0))).alias("direction"),
        expr.clip(change, -20.0, 20.0).alias("clipped"),
        F.bround(F.col("year1_avg_mark") / 2, 0).alias("half_even"),
    )


@query(
    "b21_ordinal_map",
    """SELECT student_id, CASE final_classification WHEN 'First' THEN 4 WHEN '2:1' THEN 3 WHEN '2:2' THEN 2
       WHEN 'Third' THEN 1 WHEN 'Pass' THEN 0 WHEN 'Fail' THEN 0 ELSE -1 END AS code FROM enrollments""",
)
def _(c):
    return c.enrollments.select("student_id", targets.classification_code(F.col("final_classification")).alias("code"))


@query(
    "b22_factorize",
    """SELECT course_id, CAST(DENSE_RANK() OVER (ORDER BY department) - 1 AS INT) AS department_code FROM courses""",
)
def _(c):
    return categories.dense_codes(c.courses, "department", "department_code").select("course_id", "department_code")


@query(
    "b23_module_year",
    """SELECT module_id, CASE WHEN module_id % 2 = 0 THEN
         CAST(FLOOR((1 + module_id % 16 - 1) / 4) + 1 AS INT) ELSE CAST(year AS INT) END AS parsed_year FROM modules""",
)
def _(c):
    by_block = F.concat(F.col("course_id"), F.lit("_MOD"), F.lpad((1 + F.col("module_id") % 16).cast("string"), 2, "0"))
    by_digit = F.concat(F.lit("COMP"), F.col("year"), F.lit("001"))
    code = F.when(F.col("module_id") % 2 == 0, by_block).otherwise(by_digit)
    return c.modules.select("module_id", marks.module_year(code).alias("parsed_year"))


COURSE_TEXT_SQL = "CONCAT_WS(' ', course_name, department)"
STUDENT_TEXT_SQL = """CONCAT_WS(' ', qualification_type, ethnicity, CASE WHEN ucas_tariff_points >= 144
 THEN 'high grades distinction' WHEN ucas_tariff_points >= 112 THEN 'good grades merit'
 WHEN ucas_tariff_points IS NOT NULL THEN 'standard grades pass' END)"""


@query("b24_course_text", f"SELECT course_id, {COURSE_TEXT_SQL} AS text FROM courses")
def _(c):
    return profiles.course_text(c.courses).select("course_id", "text")


@query(
    "b25_student_text",
    f"""SELECT student_id, {STUDENT_TEXT_SQL} AS keywords, CONCAT_WS(' ', qualification_type, ethnicity,
        CASE WHEN ucas_tariff_points >= 144 THEN 'high achieving student with excellent grades'
        WHEN ucas_tariff_points >= 112 THEN 'good student with solid academic performance'
        WHEN ucas_tariff_points IS NOT NULL THEN 'student meeting standard entry requirements' END) AS sentence
        FROM students LEFT JOIN qualifications USING (student_id)""",
)
def _(c):
    people = profiles.student_profiles(c.students, c.qualifications)
    return people.select(
        "student_id",
        profiles.student_text(people, "keywords").alias("keywords"),
        profiles.student_text(people, "sentence").alias("sentence"),
    )


@query("b26_sigmoid", "SELECT student_id, 1 / (1 + EXP(-score)) AS squashed FROM predictions", ["squashed"])
def _(c):
    return c.predictions.select("student_id", expr.sigmoid(F.col("score")).alias("squashed"))


@query(
    "b27_median_fill",
    """WITH joined AS (SELECT student_id, total_logins FROM students LEFT JOIN
         (SELECT student_id, SUM(logins) AS total_logins FROM vle_engagement GROUP BY 1) v USING (student_id))
       SELECT student_id, COALESCE(total_logins, 0) AS zero_filled,
         CAST(COALESCE(total_logins, (SELECT QUANTILE_CONT(CAST(total_logins AS DOUBLE), 0.5) FROM joined)) AS DOUBLE) AS median_filled
       FROM joined""",
    ["median_filled"],
)
def _(c):
    from cohortlens.functions.ordering import fit_medians

    joined = c.students.select("student_id").join(engagement.vle_totals(c.vle_engagement), "student_id", "left")
    medians = fit_medians(joined, ["total_logins"])
    return joined.select(
        "student_id",
        F.coalesce("total_logins", F.lit(0)).alias("zero_filled"),
        F.coalesce(F.col("total_logins").cast("double"), F.lit(medians.get("total_logins", 0.0))).alias("median_filled"),
    )


@query(
    "b28_safe_ratio",
    """SELECT student_id, COUNT(CASE WHEN attempt > 1 AND mark >= 40 THEN 1 END)
       / CAST(GREATEST(COUNT(CASE WHEN attempt > 1 THEN 1 END), 1) AS DOUBLE) AS ratio FROM assessments GROUP BY 1""",
    ["ratio"],
)
def _(c):
    return marks.resit_features(c.assessments).select("student_id", F.col("resit_success_rate").alias("ratio"))


@query(
    "b29_truthy_flag",
    """SELECT student_id, CASE WHEN LOWER(CAST(first_generation_uni AS VARCHAR)) IN ('true', 'yes', '1')
       THEN 10 ELSE 0 END AS first_gen_risk FROM students""",
)
def _(c):
    return c.students.select(
        "student_id", F.when(expr.truthy(F.col("first_generation_uni")), 10).otherwise(0).alias("first_gen_risk")
    )


@query(
    "b30_confidence",
    """SELECT student_id, 0.4 / (1 + COALESCE(STDDEV_SAMP(mark), 0) / 10)
       + 0.3 * LEAST(GREATEST(COUNT(*), 1), 20) / 20.0 AS confidence FROM assessments GROUP BY student_id""",
    ["confidence"],
)
def _(c):
    from cohortlens.operators.outcomes import confidence

    f = marks.performance_features(c.assessments, c.modules)
    return f.select(
        "student_id", confidence(F.col("std_mark"), F.lit(0.0), F.col("total_assessments")).alias("confidence")
    )
