"""Fairness audits (rows A13, Q1–Q15)."""

from pyspark.sql import functions as F

from cohortlens.operators import fairness
from cohortlens.plans.metrics import curve_sql
from cohortlens.plans.registry import query

ATTRIBUTES = ["gender", "ethnicity", "imd_band"]
LONG_SQL = " UNION ALL ".join(f"""SELECT '{a}' AS attribute, {a} AS "group", y_true, y_pred, score, y, p FROM predictions""" for a in ATTRIBUTES)
RATES_SQL = f"""SELECT attribute, "group", AVG(y_pred) AS positive_rate, COALESCE(AVG(CASE WHEN y_true = 1 THEN y_pred END), 0) AS tpr,
 COALESCE(AVG(CASE WHEN y_true = 0 THEN y_pred END), 0) AS fpr, COUNT(*) AS n FROM ({LONG_SQL}) GROUP BY 1, 2"""
CALIBRATION_SQL = f"""SELECT attribute, "group", AVG(ABS(rate - mean_predicted)) AS calibration_error FROM
 ({curve_sql('y_true', 'score', 10, f'({LONG_SQL})', by='attribute, "group"')}) GROUP BY 1, 2"""


@query("q1_parity_difference", f"SELECT attribute, MAX(positive_rate) - MIN(positive_rate) AS parity_difference FROM ({RATES_SQL}) GROUP BY 1", ["parity_difference"])
def _(c):
    return fairness.parity_difference(fairness.group_rates(c.predictions, ATTRIBUTES))


@query(
    "q2_equalized_odds",
    f"""SELECT attribute, MAX(tpr) - MIN(tpr) AS tpr_difference, MAX(fpr) - MIN(fpr) AS fpr_difference,
        GREATEST(MAX(tpr) - MIN(tpr), MAX(fpr) - MIN(fpr)) AS odds_difference FROM ({RATES_SQL}) GROUP BY 1""",
    ["tpr_difference", "fpr_difference", "odds_difference"],
)
def _(c):
    return fairness.equalized_odds(fairness.group_rates(c.predictions, ATTRIBUTES))


@query(
    "q3_disparate_impact",
    f"""SELECT attribute, CASE WHEN MAX(positive_rate) > 0 THEN MIN(positive_rate) / MAX(positive_rate) ELSE 1 END AS impact_ratio,
        CASE WHEN MAX(positive_rate) > 0 AND MIN(positive_rate) / MAX(positive_rate) < 0.8 THEN 'FAIL' ELSE 'PASS' END AS impact_status FROM ({RATES_SQL}) GROUP BY 1""",
    ["impact_ratio"],
)
def _(c):
    return fairness.disparate_impact(fairness.group_rates(c.predictions, ATTRIBUTES))


@query("q4_group_calibration", CALIBRATION_SQL, ["calibration_error"])
def _(c):
    return fairness.group_calibration(c.predictions, ATTRIBUTES)


AUDIT_SQL = f"""WITH a AS (SELECT attribute, MAX(positive_rate) - MIN(positive_rate) AS pd, GREATEST(MAX(tpr) - MIN(tpr), MAX(fpr) - MIN(fpr)) AS od,
   MIN(positive_rate) / MAX(positive_rate) AS ir FROM ({RATES_SQL}) GROUP BY 1),
 k AS (SELECT attribute, MAX(calibration_error) AS ce FROM ({CALIBRATION_SQL}) GROUP BY 1),
 s AS (SELECT attribute, pd, od, ir, ce, 0.25 * GREATEST(0, 1 - pd / 0.2) + 0.30 * GREATEST(0, 1 - od / 0.2) + 0.30 * LEAST(1, ir / 0.8) + 0.15 * GREATEST(0, 1 - ce / 0.2) AS sc FROM a JOIN k USING (attribute)),
 o AS (SELECT * FROM s UNION ALL SELECT 'overall', AVG(pd), AVG(od), AVG(ir), AVG(ce), AVG(sc) FROM s)
 SELECT attribute, pd AS parity_difference, od AS odds_difference, ir AS impact_ratio, ce AS calibration_error, sc AS score, CASE WHEN sc >= 0.7 THEN 'PASS' ELSE 'FAIL' END AS status FROM o"""
AUDIT_DOUBLES = ["parity_difference", "odds_difference", "impact_ratio", "calibration_error", "score"]


@query("q5_fairness_score", f"SELECT attribute, score FROM ({AUDIT_SQL})", ["score"])
def _(c):
    return fairness.audit(c.predictions, ATTRIBUTES).select("attribute", "score")


@query("a13_fairness_report", AUDIT_SQL, AUDIT_DOUBLES)
@query("q6_audit", AUDIT_SQL, AUDIT_DOUBLES)
def _(c):
    return fairness.audit(c.predictions, ATTRIBUTES)


ORDINAL_SQL = f"""SELECT attribute, "group", AVG(p) AS mean_predicted, AVG(CASE WHEN p >= 3 THEN 1.0 ELSE 0.0 END) AS favourable_rate,
 {', '.join(f'AVG(CASE WHEN p = {k} THEN 1.0 ELSE 0.0 END) AS share_{k}' for k in range(5))}, AVG(CASE WHEN y <> p THEN 1.0 ELSE 0.0 END) AS exact_error,
 AVG(ABS(y - p)) AS mae, AVG(CASE WHEN ABS(y - p) <= 1 THEN 1.0 ELSE 0.0 END) AS within_one,
 {', '.join(f'AVG(CASE WHEN y = {k} THEN CASE WHEN y <> p THEN 1.0 ELSE 0.0 END END) AS error_{k}' for k in range(5))},
 AVG(p - y) AS mean_bias, AVG(p - y) / 4 AS normalised_bias, AVG(CASE WHEN p > y THEN 1.0 ELSE 0.0 END) AS over_rate, AVG(CASE WHEN p < y THEN 1.0 ELSE 0.0 END) AS under_rate,
 STDDEV_POP(p - y) AS signed_error_std FROM ({LONG_SQL}) GROUP BY 1, 2"""
PARITY = ["mean_predicted", "favourable_rate", *[f"share_{k}" for k in range(5)]]
ERRORS = ["exact_error", "mae", "within_one", *[f"error_{k}" for k in range(5)]]
BIAS = ["mean_bias", "normalised_bias", "over_rate", "under_rate", "signed_error_std"]


def ordinal_columns(names):
    return f"""SELECT attribute, "group", {', '.join(names)} FROM ({ORDINAL_SQL})"""


@query("q7_ordinal_parity", ordinal_columns(PARITY), PARITY)
def _(c):
    return fairness.ordinal_groups(c.predictions, ATTRIBUTES).select("attribute", "group", *PARITY)


@query("q8_ordinal_errors", ordinal_columns(ERRORS), ERRORS)
def _(c):
    return fairness.ordinal_groups(c.predictions, ATTRIBUTES).select("attribute", "group", *ERRORS)


@query("q9_ordinal_bias", ordinal_columns(BIAS), BIAS)
def _(c):
    return fairness.ordinal_groups(c.predictions, ATTRIBUTES).select("attribute", "group", *BIAS)


@query(
    "q10_ordinal_audit",
    f"""WITH d AS (SELECT attribute, MAX(mean_predicted) - MIN(mean_predicted) AS a, MAX(mae) - MIN(mae) AS b, MAX(mean_bias) - MIN(mean_bias) AS c FROM ({ORDINAL_SQL}) GROUP BY 1),
        s AS (SELECT GREATEST(0, 1 - (AVG(a) + AVG(b) + AVG(c)) / 3 / 2) AS o FROM d)
        SELECT attribute, a AS parity_disparity, b AS mae_disparity, c AS bias_disparity, o AS overall_score, CASE WHEN o >= 0.7 THEN 'PASS' ELSE 'FAIL' END AS status FROM d, s""",
    ["parity_disparity", "mae_disparity", "bias_disparity", "overall_score"],
)
def _(c):
    return fairness.ordinal_audit(c.predictions, ATTRIBUTES)


GAPS_SQL = f"""SELECT attribute, MAX(e) - MIN(e) AS employment_gap, MAX(s) - MIN(s) AS salary_gap, MAX(fp) - MIN(fp) AS fpr_gap, MAX(fn) - MIN(fn) AS fnr_gap FROM
 (SELECT attribute, "group", AVG(CASE WHEN p >= 3 THEN 1.0 ELSE 0.0 END) AS e, AVG(p) AS s, COALESCE(AVG(CASE WHEN y = 0 THEN CASE WHEN p = 1 THEN 1.0 ELSE 0.0 END END), 0) AS fp,
   COALESCE(AVG(CASE WHEN y = 1 THEN CASE WHEN p = 0 THEN 1.0 ELSE 0.0 END END), 0) AS fn FROM ({LONG_SQL}) GROUP BY 1, 2) GROUP BY 1"""


@query("q11_employment_gap", f"SELECT attribute, employment_gap FROM ({GAPS_SQL})", ["employment_gap"])
def _(c):
    return fairness.graduate_gaps(c.predictions, ATTRIBUTES).select("attribute", "employment_gap")


@query("q12_salary_gap", f"SELECT attribute, salary_gap FROM ({GAPS_SQL})", ["salary_gap"])
def _(c):
    return fairness.graduate_gaps(c.predictions, ATTRIBUTES).select("attribute", "salary_gap")


@query("q13_error_rate_gaps", f"SELECT attribute, fpr_gap, fnr_gap FROM ({GAPS_SQL})", ["fpr_gap", "fnr_gap"])
def _(c):
    return fairness.graduate_gaps(c.predictions, ATTRIBUTES).select("attribute", "fpr_gap", "fnr_gap")


@query(
    "q14_violation_score",
    f"""WITH v AS (SELECT COUNT(CASE WHEN employment_gap > 0.05 THEN 1 END) + COUNT(CASE WHEN salary_gap > 0.1 THEN 1 END)
         + COUNT(CASE WHEN fpr_gap > 0.05 THEN 1 END) + COUNT(CASE WHEN fnr_gap > 0.05 THEN 1 END) AS n FROM ({GAPS_SQL}))
        SELECT n AS violations, 1 - n / 12.0 AS fairness_score, CASE WHEN 1 - n / 12.0 > 0.8 THEN 'PASS' ELSE 'FAIL' END AS status FROM v""",
    ["fairness_score"],
)
def _(c):
    return fairness.graduate_audit(c.predictions, ATTRIBUTES)


@query(
    "q15_group_risk_monitor",
    """SELECT AVG(CASE WHEN care_leaver = 1 OR imd_decile <= 2 THEN 100 * score END) AS mean_inside, AVG(CASE WHEN NOT (care_leaver = 1 OR imd_decile <= 2) THEN 100 * score END) AS mean_outside,
       AVG(CASE WHEN care_leaver = 1 OR imd_decile <= 2 THEN 100 * score END) - AVG(CASE WHEN NOT (care_leaver = 1 OR imd_decile <= 2) THEN 100 * score END) AS disparity,
       'disadvantaged' AS "group", ABS(AVG(CASE WHEN care_leaver = 1 OR imd_decile <= 2 THEN 100 * score END) - AVG(CASE WHEN NOT (care_leaver = 1 OR imd_decile <= 2) THEN 100 * score END)) > 5 AS warn
       FROM predictions JOIN (SELECT student_id, care_leaver, imd_decile FROM students) s USING (student_id)""",
    ["mean_inside", "mean_outside", "disparity"],
)
def _(c):
    people = c.students.select("student_id", "care_leaver", "imd_decile")
    scored = c.predictions.select("student_id", (F.col("score") * 100).alias("risk_score")).join(people, "student_id")
    flagged = (F.col("care_leaver") == 1) | (F.col("imd_decile") <= 2)
    return fairness.risk_monitor(scored, "disadvantaged", flagged)
