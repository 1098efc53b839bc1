"""Classification, regression, calibration and survival metrics (rows P1–P18)."""

from pyspark.sql import functions as F

from cohortlens.operators import scores
from cohortlens.operators.outcomes import THEMES
from cohortlens.plans.features import demand_table, exam_table, graduate_table, retention_table, survey_table, wellbeing_table
from cohortlens.plans.features import (
    DEMAND_FEATURES_SQL,
    EXAM_FEATURES_SQL,
    GRADUATE_FEATURES_SQL,
    RETENTION_FEATURES_SQL,
    SURVEY_FEATURES_SQL,
    WELLBEING_FEATURES_SQL,
)
from cohortlens.plans.registry import query


def binary_sql(y, p, table, prefix=""):
    tp = f"COUNT(CASE WHEN {y} = 1 AND {p} = 1 THEN 1 END)"
    fp = f"COUNT(CASE WHEN {y} <> 1 AND {p} = 1 THEN 1 END)"
    fn = f"COUNT(CASE WHEN {y} = 1 AND {p} <> 1 THEN 1 END)"
    return {
        f"{prefix}accuracy": f"(SELECT AVG(CASE WHEN {y} = {p} THEN 1.0 ELSE 0.0 END) FROM {table})",
        f"{prefix}precision": f"(SELECT COALESCE({tp} / CAST(NULLIF({tp} + {fp}, 0) AS DOUBLE), 0) FROM {table})",
        f"{prefix}recall": f"(SELECT COALESCE({tp} / CAST(NULLIF({tp} + {fn}, 0) AS DOUBLE), 0) FROM {table})",
        f"{prefix}f1": f"(SELECT COALESCE(2 * {tp} / CAST(NULLIF(2 * {tp} + {fp} + {fn}, 0) AS DOUBLE), 0) FROM {table})",
    }


def auc_sql(y, s, table):
    return f"""(SELECT (SUM(CASE WHEN y = 1 THEN r END) - COUNT(CASE WHEN y = 1 THEN 1 END) * (COUNT(CASE WHEN y = 1 THEN 1 END) + 1) / CAST(2 AS DOUBLE))
 / NULLIF(COUNT(CASE WHEN y = 1 THEN 1 END) * CAST(COUNT(CASE WHEN y <> 1 THEN 1 END) AS DOUBLE), 0) FROM
 (SELECT {y} AS y, RANK() OVER (ORDER BY {s}) + (COUNT(*) OVER (PARTITION BY {s}) - 1) / CAST(2 AS DOUBLE) AS r FROM {table}))"""


def ap_sql(y, s, table):
    return f"""(SELECT SUM(pos * tp / CAST(seen AS DOUBLE)) / SUM(pos) FROM (SELECT pos, SUM(pos) OVER (ORDER BY s DESC) AS tp, SUM(n) OVER (ORDER BY s DESC) AS seen
 FROM (SELECT {s} AS s, SUM({y}) AS pos, COUNT(*) AS n FROM {table} GROUP BY 1)))"""


def curve_sql(y, s, n, table, by=""):
    keys = f"{by}, " if by else ""
    return f"""SELECT {keys}CAST(LEAST(FLOOR({s} * {n}), {n - 1}) AS INT) AS bin, COUNT(*) AS n, AVG({s}) AS mean_predicted, AVG({y}) AS rate FROM {table} GROUP BY ALL"""


def error_sql(y, s, n, table):
    return f"(SELECT AVG(ABS(rate - mean_predicted)) FROM ({curve_sql(y, s, n, table)}))"


def kappa_sql(y, p, k, table):
    return f"""(SELECT CASE WHEN e > 0 THEN 1 - o / e ELSE 0 END FROM (SELECT SUM(w * c) AS o, SUM(w * ra * cb / CAST(n AS DOUBLE)) AS e FROM
 (SELECT i, j, (i - j) * (i - j) AS w, (SELECT COUNT(*) FROM {table} WHERE {y} = i AND {p} = j) AS c, (SELECT COUNT(*) FROM {table} WHERE {y} = i) AS ra,
  (SELECT COUNT(*) FROM {table} WHERE {p} = j) AS cb, (SELECT COUNT(*) FROM {table}) AS n FROM RANGE({k}) a(i), RANGE({k}) b(j))))"""


def regression_sql(y, p, table, prefix):
    return {
        f"{prefix}mae": f"(SELECT AVG(ABS({y} - {p})) FROM {table})",
        f"{prefix}rmse": f"(SELECT SQRT(AVG(({y} - {p}) * ({y} - {p}))) FROM {table})",
        f"{prefix}r2": f"(SELECT 1 - SUM(({y} - {p}) * ({y} - {p})) / SUM(({y} - m) * ({y} - m)) FROM (SELECT *, AVG({y}) OVER () AS m FROM {table}))",
        f"{prefix}corr": f"(SELECT CORR({y}, {p}) FROM {table})",
    }


def ordinal_sql(y, p, table, names):
    return {
        name: f"(SELECT AVG(CASE WHEN ABS({y} - {p}) <= {n} THEN 1.0 ELSE 0.0 END) FROM {table})" for name, n in names.items()
    }


def rows_sql(parts):
    return " UNION ALL ".join(f"SELECT '{name}' AS metric, CAST({sql} AS DOUBLE) AS value" for name, sql in parts.items())


def columns_sql(parts):
    return "SELECT " + ", ".join(f"{sql} AS {name}" for name, sql in parts.items())


@query("p1_binary_metrics", columns_sql(binary_sql("y_true", "y_pred", "predictions")), ["accuracy", "precision", "recall", "f1"])
def _(c):
    return scores.binary(c.predictions, "y_true", "y_pred")


CLASS_SQL = """SELECT k AS class, COALESCE(tp / CAST(NULLIF(pr, 0) AS DOUBLE), 0) AS precision, COALESCE(tp / CAST(NULLIF(ac, 0) AS DOUBLE), 0) AS recall,
 COALESCE(2 * tp / CAST(NULLIF(pr + ac, 0) AS DOUBLE), 0) AS f1, ac AS support FROM (SELECT CAST(k AS INT) AS k,
 (SELECT COUNT(*) FROM predictions WHERE y = k AND p = k) AS tp, (SELECT COUNT(*) FROM predictions WHERE p = k) AS pr, (SELECT COUNT(*) FROM predictions WHERE y = k) AS ac FROM RANGE(5) t(k))"""


@query("p2_weighted_f1", f"SELECT SUM(f1 * support) / SUM(support) AS weighted_f1 FROM ({CLASS_SQL})", ["weighted_f1"])
def _(c):
    return scores.weighted_f1(c.predictions, "y", "p")


@query("p3_roc_auc", f"SELECT {auc_sql('y_true', 'score', 'predictions')} AS roc_auc", ["roc_auc"])
def _(c):
    return scores.roc_auc(c.predictions, "y_true", "score")


@query("p4_pr_auc", f"SELECT {ap_sql('y_true', 'score', 'predictions')} AS pr_auc", ["pr_auc"])
def _(c):
    return scores.pr_auc(c.predictions, "y_true", "score")


# class weights 1 / (1 + |k - p|) with a small id-dependent part, normalised per student;
# nine decimals, so that equal probabilities are equal whatever the order of the sum
PROB_SQL = """SELECT student_id, y, p, k, ROUND(w / SUM(w) OVER (PARTITION BY student_id), 9) AS prob FROM (SELECT student_id, y, p, CAST(k AS INT) AS k,
 1 / CAST(1 + ABS(k - p) AS DOUBLE) + CAST(student_id * (k + 3) % 7 AS DOUBLE) / 20 AS w FROM predictions, RANGE(5) t(k))"""


def with_probabilities(df, pred="p", prefix="prob_", n=5):
    weights = [1.0 / (1 + F.abs(F.lit(k) - F.col(pred))) + F.col("student_id") * (k + 3) % 7 / 20.0 for k in range(n)]
    total = weights[0]
    for w in weights[1:]:
        total = total + w
    return df.withColumns({f"{prefix}{k}": F.round(w / total, 9) for k, w in enumerate(weights)})


@query(
    "p5_macro_auc",
    f"WITH w AS ({PROB_SQL}) SELECT AVG(a) AS macro_auc FROM (" + " UNION ALL ".join(
        f"SELECT {auc_sql(f'CASE WHEN y = {k} THEN 1 ELSE 0 END', 'prob', f'(SELECT * FROM w WHERE k = {k})')} AS a" for k in range(5)
    ) + ")",
    ["macro_auc"],
)
def _(c):
    return scores.macro_auc(with_probabilities(c.predictions), "y", [f"prob_{k}" for k in range(5)])


@query("p6_brier", "SELECT AVG((score - y_true) * (score - y_true)) AS brier FROM predictions", ["brier"])
def _(c):
    return scores.brier(c.predictions, "y_true", "score")


@query("p7_calibration_curve", curve_sql("y_true", "score", 10, "predictions"), ["mean_predicted", "rate"])
def _(c):
    return scores.calibration_curve(c.predictions, "y_true", "score")


CLASS_CALIBRATION_SQL = f"""WITH w AS ({PROB_SQL}), b AS (SELECT k, CAST(LEAST(FLOOR(prob * 5), 4) AS INT) AS bin, AVG(prob) AS mp, AVG(CASE WHEN y = k THEN 1.0 ELSE 0.0 END) AS rt FROM w GROUP BY 1, 2),
 e AS (SELECT k, AVG(ABS(rt - mp)) AS er FROM b GROUP BY 1), s AS (SELECT k, COUNT(CASE WHEN y = k THEN 1 END) AS n, AVG(prob) AS mp, AVG(CASE WHEN y = k THEN 1.0 ELSE 0.0 END) AS ar FROM w GROUP BY 1)
 SELECT k AS class, n AS n_samples, er AS calibration_error, mp AS mean_predicted, ar AS actual_rate FROM s JOIN e USING (k)"""


@query("p8_class_calibration", CLASS_CALIBRATION_SQL, ["calibration_error", "mean_predicted", "actual_rate"])
def _(c):
    return scores.class_calibration(with_probabilities(c.predictions), "y", [f"prob_{k}" for k in range(5)])


@query(
    "p9_confusion",
    """SELECT CAST(i AS INT) AS actual, CAST(j AS INT) AS predicted, (SELECT COUNT(*) FROM predictions WHERE y = i AND p = j) AS n FROM RANGE(5) a(i), RANGE(5) b(j)""",
)
def _(c):
    return scores.confusion(c.predictions, "y", "p", 5)


@query("p10_per_class", CLASS_SQL, ["precision", "recall", "f1"])
def _(c):
    return scores.per_class(c.predictions, "y", "p")


@query(
    "p11_ordinal_agreement",
    "SELECT (SELECT AVG(ABS(y - p)) FROM predictions) AS mae, " + ", ".join(
        f"{sql} AS {n}" for n, sql in ordinal_sql("y", "p", "predictions", {"exact": 0, "within_one": 1, "within_two": 2}).items()
    ),
    ["mae", "exact", "within_one", "within_two"],
)
def _(c):
    return scores.ordinal(c.predictions, "y", "p")


@query("p12_kappa", f"SELECT {kappa_sql('y', 'p', 5, 'predictions')} AS qwk", ["qwk"])
def _(c):
    return scores.kappa(c.predictions, "y", "p", 5)


MARKS_PAIR_SQL = "(SELECT student_id, AVG(mark) AS y, AVG(CASE WHEN module_id % 2 = 0 THEN mark END) AS p FROM assessments GROUP BY 1 HAVING AVG(CASE WHEN module_id % 2 = 0 THEN mark END) IS NOT NULL)"


@query(
    "p13_regression",
    columns_sql(regression_sql("y", "p", MARKS_PAIR_SQL, "") | {"mae_clipped": f"(SELECT AVG(ABS(y - LEAST(GREATEST(p, 40), 60))) FROM {MARKS_PAIR_SQL})"}),
    ["mae", "rmse", "r2", "corr", "mae_clipped"],
)
def _(c):
    even = F.avg(F.when(F.col("module_id") % 2 == 0, F.col("mark"))).alias("p")
    pairs = c.assessments.groupBy("student_id").agg(F.avg("mark").alias("y"), even).where(F.col("p").isNotNull())
    return scores.regression(pairs, "y", "p", bounds=(40.0, 60.0))


@query(
    "p14_concordance",
    """WITH s AS (SELECT student_id, 1 + student_id % 30 AS time, student_id % 3 < 2 AS event, ROUND(score, 2) AS risk FROM predictions)
       SELECT COUNT(*) AS comparable, (COUNT(CASE WHEN a.risk > b.risk THEN 1 END) + 0.5 * COUNT(CASE WHEN a.risk = b.risk THEN 1 END)) / COUNT(*) AS c_index
       FROM s a JOIN s b ON a.time < b.time WHERE a.event""",
    ["c_index"],
)
def _(c):
    rows = c.predictions.select(
        (1 + F.col("student_id") % 30).cast("int").alias("time"),
        (F.col("student_id") % 3 < 2).cast("int").alias("event"),
        F.round("score", 2).alias("risk"),
    )
    return scores.concordance(rows, "time", "event", "risk")


@query(
    "p18_recall_of_top",
    """SELECT SUM(CASE WHEN place <= CEIL(n * 0.2) THEN y_true ELSE 0 END) / CAST(SUM(y_true) AS DOUBLE) AS recall_top,
       AVG(CASE WHEN place <= CEIL(n * 0.2) THEN y_true END) AS precision_top FROM
       (SELECT y_true, ROW_NUMBER() OVER (ORDER BY score DESC, student_id) AS place, COUNT(*) OVER () AS n FROM predictions)""",
    ["recall_top", "precision_top"],
)
def _(c):
    return scores.recall_of_top(c.predictions, "y_true", "score", "student_id")


# --- P15-P17: evaluation suites over the feature tables' labels -------------------------
# The predictions are the labels moved by the student id: level ± 1 within its range,
# numbers by up to 6 points, flags turned for every seventh student.


def moved_level(y, top):
    return F.least(F.lit(top), F.greatest(F.lit(0), F.col(y) + (F.col("student_id") % 3).cast("int") - 1))


def moved_number(y):
    return F.col(y) + (F.col("student_id") % 13).cast("int") - 6


def turned(y):
    return F.when(F.col("student_id") % 7 == 0, 1 - F.col(y)).otherwise(F.col(y))


def chance(y):
    return 0.3 + 0.4 * turned(y) + (F.col("student_id") % 5) / 20.0


LEVEL = "LEAST({top}, GREATEST(0, {y} + CAST(student_id % 3 AS INT) - 1))"
NUMBER = "({y} + CAST(student_id % 13 AS INT) - 6)"
TURNED = "(CASE WHEN student_id % 7 = 0 THEN 1 - {y} ELSE {y} END)"
CHANCE = "(CAST(0.3 AS DOUBLE) + CAST(0.4 AS DOUBLE) * " + TURNED + " + CAST(student_id % 5 AS DOUBLE) / 20)"

ENROLMENT_PARTS = binary_sql("y_true", "y_pred", "predictions") | {
    "roc_auc": auc_sql("y_true", "score", "predictions"),
    "pr_auc": ap_sql("y_true", "score", "predictions"),
    "brier": "(SELECT AVG((score - y_true) * (score - y_true)) FROM predictions)",
    "calibration_error": error_sql("y_true", "score", 10, "predictions"),
}


@query("p17_evaluate_enrolment", rows_sql(ENROLMENT_PARTS), ["value"])
def _(c):
    return scores.evaluate_enrolment(c.predictions)


DEGREE_PARTS = {
    "mae": "(SELECT AVG(ABS(y - p)) FROM predictions)",
    **ordinal_sql("y", "p", "predictions", {"exact": 0, "within_one": 1, "within_two": 2}),
    "qwk": kappa_sql("y", "p", 5, "predictions"),
    "ece": "(SELECT SUM(n_samples * calibration_error) / SUM(n_samples) FROM cc)",
}


@query("p17_evaluate_degree", f"WITH cc AS ({CLASS_CALIBRATION_SQL}) {rows_sql(DEGREE_PARTS)}", ["value"])
def _(c):
    return scores.evaluate_degree(with_probabilities(c.predictions))


def with_mean(parts, name, suffix):
    found = [v for k, v in parts.items() if k.endswith(suffix)]
    return parts | {name: "(" + " + ".join(found) + f") / {len(found)}"}


RETENTION_PARTS = binary_sql("y_risk", "p_risk", "t", "risk_")
RETENTION_PARTS |= {"risk_roc_auc": auc_sql("y_risk", "prob_risk", "t")}
RETENTION_PARTS |= {k: v for k, v in regression_sql("y_score", "p_score", "t", "score_").items() if k in ("score_mae", "score_rmse")}
RETENTION_PARTS |= {"score_mae_clipped": "(SELECT AVG(ABS(y_score - LEAST(GREATEST(p_score, 0), 100))) FROM t)"}
for head in ("category", "departure"):
    RETENTION_PARTS |= ordinal_sql(f"y_{head}", f"p_{head}", "t", {f"{head}_accuracy": 0, f"{head}_exact": 0, f"{head}_within_1": 1})
    RETENTION_PARTS |= {f"{head}_qwk": kappa_sql(f"y_{head}", f"p_{head}", 4, "t")}
RETENTION_PARTS = with_mean(RETENTION_PARTS, "composite_accuracy", "_accuracy")
RETENTION_PARTS = with_mean(RETENTION_PARTS, "composite_roc_auc", "_roc_auc")
RETENTION_T = f"""t AS (SELECT y_retention_risk AS y_risk, {TURNED.format(y='y_retention_risk')} AS p_risk, {CHANCE.format(y='y_retention_risk')} AS prob_risk,
 y_risk_score AS y_score, {NUMBER.format(y='y_risk_score')} AS p_score, y_risk_category AS y_category, {LEVEL.format(y='y_risk_category', top=3)} AS p_category,
 y_departure_year AS y_departure, {LEVEL.format(y='y_departure_year', top=3)} AS p_departure FROM ({RETENTION_FEATURES_SQL}))"""


def retention_predictions(c):
    return retention_table(c).select(
        F.col("y_retention_risk").alias("y_risk"),
        turned("y_retention_risk").alias("p_risk"),
        chance("y_retention_risk").alias("prob_risk"),
        F.col("y_risk_score").alias("y_score"),
        moved_number("y_risk_score").alias("p_score"),
        F.col("y_risk_category").alias("y_category"),
        moved_level("y_risk_category", 3).alias("p_category"),
        F.col("y_departure_year").alias("y_departure"),
        moved_level("y_departure_year", 3).alias("p_departure"),
    )


@query("p17_evaluate_retention", f"WITH {RETENTION_T} {rows_sql(RETENTION_PARTS)}", ["value"])
def _(c):
    return scores.evaluate_retention(retention_predictions(c))


@query(
    "p16_composite_means",
    f"WITH {RETENTION_T} SELECT * FROM ({rows_sql(RETENTION_PARTS)}) WHERE metric LIKE 'composite%'",
    ["value"],
)
def _(c):
    return scores.evaluate_retention(retention_predictions(c)).where(F.col("metric").startswith("composite"))


TASKS = {"employment": 4, "salary": 4, "study": 4}
GRADUATE_PARTS = {}
for task, n in TASKS.items():
    GRADUATE_PARTS |= ordinal_sql(f"y_{task}", f"p_{task}", "t", {f"{task}_accuracy": 0})
    terms = [auc_sql(f"CASE WHEN y_{task} = {k} THEN 1 ELSE 0 END", f"prob_{task}_{k}", "t") for k in range(n)]
    GRADUATE_PARTS |= {f"{task}_roc_auc": "(SELECT AVG(v) FROM (" + " UNION ALL ".join(f"SELECT {x} AS v" for x in terms) + "))"}
GRADUATE_PARTS |= {"salary_qwk": kappa_sql("y_salary", "p_salary", 4, "t")}
GRADUATE_PARTS = with_mean(GRADUATE_PARTS, "composite_roc_auc", "_roc_auc")
GRADUATE_PARTS = with_mean(GRADUATE_PARTS, "composite_accuracy", "_accuracy")


def weight_sql(task, k):
    return f"(1 / CAST(1 + ABS({k} - p_{task}) AS DOUBLE) + CAST(student_id * ({k} + 3) % 7 AS DOUBLE) / 20)"


def prob_sql(task, n):
    total = " + ".join(weight_sql(task, k) for k in range(n))
    return ", ".join(f"ROUND({weight_sql(task, k)} / ({total}), 9) AS prob_{task}_{k}" for k in range(n))


GRADUATE_T = f"""t0 AS (SELECT student_id, {', '.join(f"y_{t}, {LEVEL.format(y=f'y_{t}', top=3)} AS p_{t}" for t in TASKS)} FROM ({GRADUATE_FEATURES_SQL})),
 t AS (SELECT *, {', '.join(prob_sql(t, n) for t, n in TASKS.items())} FROM t0)"""


@query("p17_evaluate_graduates", f"WITH {GRADUATE_T} {rows_sql(GRADUATE_PARTS)}", ["value"])
def _(c):
    table = graduate_table(c).select(
        "student_id", *[f"y_{t}" for t in TASKS], *[moved_level(f"y_{t}", 3).alias(f"p_{t}") for t in TASKS]
    )
    for t, n in TASKS.items():
        table = with_probabilities(table, f"p_{t}", f"prob_{t}_", n)
    return scores.evaluate_graduates(table, TASKS)


SURVEY_PARTS = {
    "satisfaction_accuracy": binary_sql("y_satisfied", "p_satisfied", "t")["accuracy"],
    "satisfaction_roc_auc": auc_sql("y_satisfied", "p_satisfied", "t"),
    **{k: v for k, v in regression_sql("y_nps", "p_nps", "t", "nps_").items() if k != "nps_rmse"},
}
for theme in THEMES:
    SURVEY_PARTS |= {k: v for k, v in regression_sql(f"y_{theme}", f"p_{theme}", "t", f"{theme}_").items() if k[-3:] in ("mae", "_r2")}
SURVEY_PARTS = {k: v for k, v in SURVEY_PARTS.items()}
for stat in ("mae", "r2"):
    SURVEY_PARTS |= {f"avg_theme_{stat}": "(" + " + ".join(SURVEY_PARTS[f"{t}_{stat}"] for t in THEMES) + f") / {len(THEMES)}"}
SURVEY_PARTS |= {
    "overall_score": f"{SURVEY_PARTS['satisfaction_accuracy']} * 0.3 + GREATEST(0, {SURVEY_PARTS['nps_r2']}) * 0.2 + GREATEST(0, {SURVEY_PARTS['avg_theme_r2']}) * 0.5"
}
SURVEY_T = f"""t AS (SELECT y_satisfied, {TURNED.format(y='y_satisfied')} AS p_satisfied, CAST(y_nps AS DOUBLE) AS y_nps, CAST({LEVEL.format(y='y_nps', top=10)} AS DOUBLE) AS p_nps,
 {', '.join(f"y_{t}_score AS y_{t}, {NUMBER.format(y=f'y_{t}_score')} AS p_{t}" for t in THEMES)} FROM ({SURVEY_FEATURES_SQL}))"""


@query("p17_evaluate_survey", f"WITH {SURVEY_T} {rows_sql(SURVEY_PARTS)}", ["value"])
def _(c):
    table = survey_table(c).select(
        "y_satisfied",
        turned("y_satisfied").alias("p_satisfied"),
        "y_nps",
        moved_level("y_nps", 10).alias("p_nps"),
        *[F.col(f"y_{t}_score").alias(f"y_{t}") for t in THEMES],
        *[moved_number(f"y_{t}_score").alias(f"p_{t}") for t in THEMES],
    )
    return scores.evaluate_survey(table, list(THEMES))


EXAM_PARTS = regression_sql("y_mark", "p_mark", "t", "mark_")
EXAM_PARTS |= {k: v for k, v in binary_sql("y_pass", "p_pass", "t", "pass_").items() if k != "pass_f1"}
EXAM_PARTS |= {"pass_roc_auc": auc_sql("y_pass", "prob_pass", "t"), "grade_qwk": kappa_sql("y_grade", "p_grade", 4, "t")}
EXAM_PARTS |= ordinal_sql("y_grade", "p_grade", "t", {"grade_accuracy": 0, "grade_within_1": 1})
EXAM_PARTS |= {"brier": "(SELECT AVG((prob_pass - y_pass) * (prob_pass - y_pass)) FROM t)"}
EXAM_PARTS |= {
    "overall_score": f"""GREATEST(0, {EXAM_PARTS['mark_r2']}) * 0.30 + {EXAM_PARTS['pass_roc_auc']} * 0.35 + {EXAM_PARTS['grade_qwk']} * 0.20
 + GREATEST(0, 1 - {EXAM_PARTS['mark_mae']} / 10) * 0.15"""
}
EXAM_T = f"""t AS (SELECT y_exam_mark AS y_mark, {NUMBER.format(y='y_exam_mark')} AS p_mark, y_pass_fail AS y_pass, {TURNED.format(y='y_pass_fail')} AS p_pass,
 {CHANCE.format(y='y_pass_fail')} AS prob_pass, y_grade_class AS y_grade, {LEVEL.format(y='y_grade_class', top=3)} AS p_grade FROM ({EXAM_FEATURES_SQL}))"""


def exam_predictions(c):
    return exam_table(c).select(
        F.col("y_exam_mark").alias("y_mark"),
        moved_number("y_exam_mark").alias("p_mark"),
        F.col("y_pass_fail").alias("y_pass"),
        turned("y_pass_fail").alias("p_pass"),
        chance("y_pass_fail").alias("prob_pass"),
        F.col("y_grade_class").alias("y_grade"),
        moved_level("y_grade_class", 3).alias("p_grade"),
    )


@query("p17_evaluate_exam", f"WITH {EXAM_T} {rows_sql(EXAM_PARTS)}", ["value"])
def _(c):
    return scores.evaluate_exam(exam_predictions(c))


@query(
    "p15_composite_score",
    f"WITH {EXAM_T} SELECT 'overall_score' AS metric, CAST({EXAM_PARTS['overall_score']} AS DOUBLE) AS value",
    ["value"],
)
def _(c):
    return scores.evaluate_exam(exam_predictions(c)).where(F.col("metric") == "overall_score")


WELLBEING_PARTS = regression_sql("y_score", "p_score", "t", "score_")
WELLBEING_PARTS |= {k: v for k, v in binary_sql("y_risk", "p_risk", "t", "at_risk_").items() if k != "at_risk_f1"}
WELLBEING_PARTS |= {"at_risk_roc_auc": auc_sql("y_risk", "prob_risk", "t"), "support_qwk": kappa_sql("y_support", "p_support", 4, "t")}
WELLBEING_PARTS |= ordinal_sql("y_support", "p_support", "t", {"support_accuracy": 0, "support_within_1": 1})
WELLBEING_PARTS |= {"brier": "(SELECT AVG((prob_risk - y_risk) * (prob_risk - y_risk)) FROM t)"}
WELLBEING_PARTS |= {
    "overall_score": f"""GREATEST(0, {WELLBEING_PARTS['score_r2']}) * 0.30 + {WELLBEING_PARTS['at_risk_roc_auc']} * 0.40 + {WELLBEING_PARTS['support_qwk']} * 0.15
 + GREATEST(0, 1 - {WELLBEING_PARTS['score_mae']} / 20) * 0.15"""
}
WELLBEING_T = f"""t AS (SELECT y_wellbeing_score AS y_score, {NUMBER.format(y='y_wellbeing_score')} AS p_score, y_at_risk AS y_risk, {TURNED.format(y='y_at_risk')} AS p_risk,
 {CHANCE.format(y='y_at_risk')} AS prob_risk, y_support_need AS y_support, {LEVEL.format(y='y_support_need', top=3)} AS p_support FROM ({WELLBEING_FEATURES_SQL}))"""


@query("p17_evaluate_wellbeing", f"WITH {WELLBEING_T} {rows_sql(WELLBEING_PARTS)}", ["value"])
def _(c):
    table = wellbeing_table(c).select(
        F.col("y_wellbeing_score").alias("y_score"),
        moved_number("y_wellbeing_score").alias("p_score"),
        F.col("y_at_risk").alias("y_risk"),
        turned("y_at_risk").alias("p_risk"),
        chance("y_at_risk").alias("prob_risk"),
        F.col("y_support_need").alias("y_support"),
        moved_level("y_support_need", 3).alias("p_support"),
    )
    return scores.evaluate_wellbeing(table)


DEMAND_PARTS = {k: v for k, v in regression_sql("y_enrollment", "p_enrollment", "t", "enrollment_").items() if k != "enrollment_corr"}
DEMAND_PARTS |= {k: v for k, v in regression_sql("y_fill_rate", "p_fill_rate", "t", "fill_rate_").items() if k in ("fill_rate_mae", "fill_rate_r2")}
DEMAND_PARTS |= ordinal_sql("y_category", "p_category", "t", {"demand_category_accuracy": 0})
DEMAND_PARTS |= {
    "overall_score": f"""LEAST(1, 20 / GREATEST({DEMAND_PARTS['enrollment_mae']}, 1)) * 0.25 + GREATEST(0, {DEMAND_PARTS['enrollment_r2']}) * 0.25
 + GREATEST(0, {DEMAND_PARTS['fill_rate_r2']}) * 0.25 + {DEMAND_PARTS['demand_category_accuracy']} * 0.25"""
}
DEMAND_T = f"""t AS (SELECT CAST(y_enrollment_count AS DOUBLE) AS y_enrollment, CAST({NUMBER.format(y='y_enrollment_count')} AS DOUBLE) AS p_enrollment,
 y_fill_rate, {NUMBER.format(y='y_fill_rate')} AS p_fill_rate, y_demand_category AS y_category, {LEVEL.format(y='y_demand_category', top=3)} AS p_category
 FROM (SELECT *, module_id AS student_id FROM ({DEMAND_FEATURES_SQL})))"""


@query("p17_evaluate_demand", f"WITH {DEMAND_T} {rows_sql(DEMAND_PARTS)}", ["value"])
def _(c):
    table = demand_table(c).withColumn("student_id", F.col("module_id")).select(
        F.col("y_enrollment_count").alias("y_enrollment"),
        moved_number("y_enrollment_count").alias("p_enrollment"),
        "y_fill_rate",
        moved_number("y_fill_rate").alias("p_fill_rate"),
        F.col("y_demand_category").alias("y_category"),
        moved_level("y_demand_category", 3).alias("p_category"),
    )
    return scores.evaluate_demand(table)
