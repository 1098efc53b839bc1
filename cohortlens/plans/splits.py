"""Encoding, scaling, splits and folds (rows J1–J9, J12)."""

from pyspark.sql import functions as F

from cohortlens.operators import prep
from cohortlens.operators.categories import LabelCodes
from cohortlens.plans.registry import query


@query(
    "j1_label_encode",
    """WITH train AS (SELECT DISTINCT CAST(entry_tariff AS VARCHAR) AS v FROM courses WHERE entry_tariff <= 120),
        codes AS (SELECT v, CAST(ROW_NUMBER() OVER (ORDER BY v) - 1 AS INT) AS code FROM train)
       SELECT course_id, COALESCE(code, -1) AS entry_tariff_encoded FROM courses LEFT JOIN codes ON v = CAST(entry_tariff AS VARCHAR)""",
)
def _(c):
    fitted = LabelCodes.fit(c.courses.where(F.col("entry_tariff") <= 120), ["entry_tariff"])
    return fitted.transform(c.courses).select("course_id", "entry_tariff_encoded")


@query(
    "j2_standard_scale",
    """SELECT course_id, (entry_tariff - (SELECT AVG(entry_tariff) FROM courses)) / (SELECT STDDEV_POP(entry_tariff) FROM courses) AS entry_tariff,
       (employment_rate_15m - (SELECT AVG(employment_rate_15m) FROM courses)) / (SELECT STDDEV_POP(employment_rate_15m) FROM courses) AS employment_rate_15m FROM courses""",
    ["entry_tariff", "employment_rate_15m"],
)
def _(c):
    columns = ["entry_tariff", "employment_rate_15m"]
    return prep.Scaling.fit(c.courses, columns).transform(c.courses).select("course_id", *columns)


SPLIT_SQL = """SELECT student_id, CASE WHEN place <= FLOOR(n * 0.8) THEN 'train' ELSE 'test' END AS part FROM
 (SELECT student_id, ROW_NUMBER() OVER (ORDER BY enrollment_date, student_id) AS place, COUNT(*) OVER () AS n FROM enrollments)"""


@query(
    "j3_split_then_scale",
    f"""WITH s AS (SELECT student_id, part, ucas_tariff_points AS x FROM ({SPLIT_SQL}) JOIN qualifications USING (student_id))
        SELECT student_id, part, (x - (SELECT AVG(x) FROM s WHERE part = 'train')) / (SELECT STDDEV_POP(x) FROM s WHERE part = 'train') AS ucas_tariff_points FROM s""",
    ["ucas_tariff_points"],
)
def _(c):
    parts = prep.time_split(c.enrollments, "enrollment_date", "student_id", 0.2).select("student_id", "part")
    whole = parts.join(c.qualifications.select("student_id", "ucas_tariff_points"), "student_id")
    scaling = prep.Scaling.fit(whole.where(F.col("part") == "train"), ["ucas_tariff_points"])
    return scaling.transform(whole)


@query("j4_random_split")
def _(c):
    return prep.random_split(c.students, "student_id").select("student_id", "part")


@query("j5_stratified_split")
def _(c):
    return prep.stratified_split(c.predictions, "student_id", "y_true").select("student_id", "y_true", "part")


@query(
    "j6_time_split",
    """SELECT o_orderkey, CASE WHEN place <= FLOOR(n * 0.75) THEN 'train' ELSE 'test' END AS part FROM
       (SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderdate, o_orderkey) AS place, COUNT(*) OVER () AS n FROM orders)""",
)
def _(c):
    return prep.time_split(c.raw("orders"), "o_orderdate", "o_orderkey", 0.25).select("o_orderkey", "part")


@query("j7_group_folds")
def _(c):
    return prep.group_folds(c.enrollments, "course_id").select("student_id", "course_id", "fold")


@query("j8_stratified_folds")
def _(c):
    return prep.stratified_folds(c.predictions, "student_id", "y_true").select("student_id", "y_true", "fold")


@query(
    "j9_time_folds",
    """WITH p AS (SELECT student_id, ROW_NUMBER() OVER (ORDER BY enrollment_date, student_id) - 1 AS at0, COUNT(*) OVER () AS n FROM enrollments),
        f AS (SELECT student_id, CAST(k AS INT) AS fold, at0, n - (4 - k) * (n // 5) AS start, n // 5 AS size FROM p, RANGE(4) t(k))
       SELECT student_id, fold, CASE WHEN at0 < start - 10 THEN 'train' ELSE 'test' END AS part FROM f
       WHERE at0 < start - 10 OR (at0 >= start AND at0 < start + size)""",
)
def _(c):
    return prep.time_folds(c.enrollments, "enrollment_date", "student_id", k=4, gap=10).select("student_id", "fold", "part")


@query(
    "j12_imbalance_weight",
    """SELECT COUNT(CASE WHEN y_true = 1 THEN 1 END) AS n_pos, COUNT(CASE WHEN y_true = 0 THEN 1 END) AS n_neg,
       COUNT(CASE WHEN y_true = 0 THEN 1 END) / CAST(COUNT(CASE WHEN y_true = 1 THEN 1 END) AS DOUBLE) AS weight FROM predictions""",
    ["weight"],
)
def _(c):
    return prep.imbalance_weight(c.predictions, "y_true")
