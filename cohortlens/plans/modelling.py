"""Training, scoring and explanation jobs (rows J10, J11, J13, J14 and O1–O19)."""

from pyspark.sql import functions as F

from cohortlens.models import batch, boost, explain, multitask, ordinal, sequence, survival, tune
from cohortlens.models.base import at_threshold, feature_names
from cohortlens.operators.sequences import event_target, weekly_sequences
from cohortlens.operators.recommend import best_courses
from cohortlens.plans.alerts import ACTION_SQL, TIER_SQL
from cohortlens.plans.features import (
    SCORES_SQL,
    AGGREGATES_SQL,
    degree_table,
    demand_table,
    exam_table,
    graduate_table,
    retention_table,
    survey_table,
    wellbeing_table,
    aggregate_table,
    model_scores,
    yield_table,
)
from cohortlens.plans.registry import query
from cohortlens.session import reliable_checkpoint


def yield_columns(df):
    return [c for c in df.columns if c.startswith("feat_")]


def yield_trainer(train, params):
    fitted = boost.fit_booster(train, "accepted", yield_columns(train), **params)
    return fitted.predict


@query("j10_cross_validate")
def _(c):
    table = yield_table(c)
    results = tune.cross_validate(table, "accepted", yield_trainer, scoring="roc_auc")
    return tune.summarised(results)


@query("j11_fold_results")
def _(c):
    return tune.cross_validate(yield_table(c), "accepted", yield_trainer, strategy="group", scoring="accuracy", group="course_id")


@query("j13_sample_weights")
def _(c):
    table = wellbeing_table(c).withColumn("row_weight", 1.0 + F.col("imd_decile") / 10.0)
    names = feature_names(table, ["row_weight"])
    heads = {"y_at_risk": "flag"}
    return multitask.fit_heads(table, heads, names, weight="row_weight").transform(table).select(
        "student_id", "p_at_risk", "prob_at_risk"
    )


@query("j14_parameter_search")
def _(c):
    space = {"depth": ("int", 2, 4), "step": ("log", 0.05, 0.3), "subsample": ("float", 0.6, 1.0)}
    return tune.search(yield_table(c), "accepted", yield_trainer, space)[1]


@query("o1_booster")
def _(c):
    table = yield_table(c)
    fitted = boost.fit_booster(table, "accepted", yield_columns(table))
    return fitted.score(table).select("student_id", "course_id", "score")


@query("o2_calibration")
def _(c):
    table = yield_table(c)
    fitted = boost.fit_booster(table, "accepted", yield_columns(table), calibrate="isotonic")
    return fitted.score(table).select("student_id", "course_id", "score")


@query("o3_threshold", "SELECT student_id, CASE WHEN score >= 0.6 THEN 1 ELSE 0 END AS label FROM predictions")
def _(c):
    return c.predictions.select("student_id", at_threshold(F.col("score"), 0.6).alias("label"))


@query("g4_top_features")
def _(c):
    table = yield_table(c)
    return boost.fit_booster(table, "accepted", yield_columns(table)).importance(c.spark, 10)


@query("o4_feature_importance")
def _(c):
    table = yield_table(c)
    return boost.fit_booster(table, "accepted", yield_columns(table)).importance(c.spark)


@query("o5_train_and_evaluate")
def _(c):
    table = yield_table(c)
    return boost.train_and_evaluate(table, "accepted", yield_columns(table), calibrate="platt")[1]


@query("o6_ordinal")
def _(c):
    table = degree_table(c)
    model = ordinal.fit_ordinal(table, "target", feature_names(table), 5)
    return model.transform(table).select("student_id", "p", *[F.col("class_probabilities")[k].alias(f"prob_{k}") for k in range(5)])


@query(
    "o6_ordinal_combine",
    """WITH a AS (SELECT student_id, score * 0.5 AS c0, score * 0.9 - 0.2 * y_true AS c1, score AS c2 FROM predictions),
        m AS (SELECT student_id, c0 AS m0, GREATEST(c0, c1) AS m1, GREATEST(c0, c1, c2) AS m2 FROM a), p AS (SELECT student_id, m0 AS p0, m1 - m0 AS p1, m2 - m1 AS p2, 1 - m2 AS p3 FROM m)
       SELECT student_id, p0, p1, p2, p3 FROM p""",
    ["p0", "p1", "p2", "p3"],
)
def _(c):
    s = F.col("score")
    at_most = c.predictions.select("student_id", F.array(s * 0.5, s * 0.9 - 0.2 * F.col("y_true"), s).alias("c"))
    made = at_most.select("student_id", ordinal.combine(F.col("c")).alias("p"))
    return made.select("student_id", *[F.col("p")[k].alias(f"p{k}") for k in range(4)])


def heads_query(name, table_of, heads, key="student_id"):
    @query(name)
    def _(c):
        table = table_of(c)
        fitted = multitask.fit_heads(table, heads, feature_names(table))
        return fitted.transform(table).select(key, *[f"p_{h.removeprefix('y_')}" for h in heads])


heads_query("o7_graduate_heads", graduate_table, multitask.GRADUATE_HEADS)
heads_query("o8_survey_heads", survey_table, multitask.SURVEY_HEADS)
heads_query("o9_retention_heads", retention_table, multitask.RETENTION_HEADS)
heads_query("o10_exam_heads", exam_table, multitask.EXAM_HEADS)
heads_query("o11_wellbeing_heads", wellbeing_table, multitask.WELLBEING_HEADS)
heads_query("o12_demand_heads", demand_table, multitask.DEMAND_HEADS, key="module_id")

SURVIVAL_FEATURES = ["avg_mark", "std_mark", "resit_rate", "attendance_rate", "imd_decile", "first_gen"]


def survival_table(c):
    """Background and marks with a week of exit (from the id) and whether the exit was an event."""
    events = event_target(c.enrollments).select("student_id", F.col("target").alias("event"))
    week = (1 + F.col("student_id") % 30).cast("int")
    return aggregate_table(c).join(events, "student_id").withColumn("time", week).select(
        "student_id", "time", "event", *SURVIVAL_FEATURES
    )


@query("o13_cox")
def _(c):
    return survival.fit_cox(survival_table(c), "time", "event", SURVIVAL_FEATURES).importance(c.spark)


COX_AT = {"a": -0.5, "b": 0.3, "c": 0.2}


def derivative_sql():
    """Suffix sums of all products over time, term by term."""
    names = list(COX_AT)
    both = [(j, k) for i, j in enumerate(names) for k in names[i:]]
    sums = ", ".join([f"SUM(w * {j}) AS w{j}, SUM(event * {j}) AS e{j}" for j in names] + [f"SUM(w * {j} * {k}) AS w{j}{k}" for j, k in both])
    later = ", ".join(f"SUM({c}) OVER (ORDER BY time DESC) AS r{c}" for c in ["w", *[f"w{j}" for j in names], *[f"w{j}{k}" for j, k in both]])
    rows = [f"SELECT '{j}' AS feature, NULL AS other, SUM(e{j} - d * rw{j} / rw) / (SELECT COUNT(*) FROM x) AS value FROM r" for j in names]
    rows += [
        f"SELECT '{j}', '{k}', SUM(d * (rw{j}{k} / rw - rw{j} / rw * rw{k} / rw)) / (SELECT COUNT(*) FROM x) FROM r" for j, k in both
    ]
    weight = " + ".join(f"{b} * {c}" for c, b in COX_AT.items())
    return f"""WITH e AS (SELECT student_id, 1 + student_id * 7 % 4999 AS time, CASE WHEN enrollment_status = 'Withdrawn' OR retained_year2 = 0 THEN 1 ELSE 0 END AS event FROM enrollments),
        f AS (SELECT time, event, avg_mark / 100 AS a, imd_decile / 10.0 AS b, CAST(first_gen AS DOUBLE) AS c FROM ({AGGREGATES_SQL}) JOIN e USING (student_id)),
        x AS (SELECT *, EXP({weight}) AS w FROM f),
        t AS (SELECT time, SUM(w) AS w, SUM(event) AS d, {sums} FROM x GROUP BY time),
        r AS (SELECT d, {", ".join(f"e{j}" for j in names)}, {later} FROM t)
        {" UNION ALL ".join(rows)}"""


@query("o13_cox_derivatives", derivative_sql(), ["value"])
def _(c):
    table = survival_table(c).withColumn("time", 1 + F.col("student_id") * 7 % 4999)
    x = [F.col("avg_mark") / 100, F.col("imd_decile") / 10.0, F.col("first_gen")]
    rows = survival.CoxRows.of(table, "time", "event", x)
    return survival.derivative_table(c.spark, rows, list(COX_AT), list(COX_AT.values()))


@query(
    "o14_baseline_hazard",
    f"""WITH e AS (SELECT student_id, 1 + student_id % 30 AS time, CASE WHEN enrollment_status = 'Withdrawn' OR retained_year2 = 0 THEN 1 ELSE 0 END AS event FROM enrollments),
        t AS (SELECT time, SUM(event) AS d, SUM(EXP(-0.01 * avg_mark + 0.05 * imd_decile)) AS s FROM ({AGGREGATES_SQL}) JOIN e USING (student_id) GROUP BY 1),
        h AS (SELECT time, d, d / SUM(s) OVER (ORDER BY time DESC) AS step FROM t)
        SELECT CAST(time AS INT) AS time, SUM(step) OVER (ORDER BY time) AS hazard FROM h WHERE d > 0""",
    ["hazard"],
)
def _(c):
    risk = -0.01 * F.col("avg_mark") + 0.05 * F.col("imd_decile")
    return survival.baseline_hazard(survival_table(c).withColumn("risk", risk), "time", "event", "risk")


@query("o14_survival_curves")
def _(c):
    table = reliable_checkpoint(survival_table(c))
    return survival.fit_cox(table, "time", "event", SURVIVAL_FEATURES).survival(table.select("student_id", *SURVIVAL_FEATURES)).select(
        "student_id", "time", "survival"
    )


@query("o15_weekly_hazard")
def _(c):
    table = reliable_checkpoint(survival_table(c))
    return survival.fit_hazard(table, "time", "event", SURVIVAL_FEATURES, weeks=30).survival(table)


@query("o16_survival_evaluation")
def _(c):
    table = reliable_checkpoint(survival_table(c))
    return survival.fit_and_evaluate(table, "time", "event", SURVIVAL_FEATURES)[1]


@query("o17_sequence_classifier")
def _(c):
    steps = reliable_checkpoint(weekly_sequences(c.vle_engagement, c.attendance, c.assessments))
    model = sequence.fit_sequence(steps, event_target(c.enrollments), length=12, max_iter=10)
    return model.score(steps)


COEFFICIENTS = {"avg_mark": -0.05, "resit_rate": 2.0, "imd_decile": 0.1}


@query(
    "o18_linear_attribution",
    f"""WITH a AS (SELECT student_id, avg_mark, resit_rate, imd_decile FROM ({AGGREGATES_SQL}))
        SELECT student_id, 'avg_mark' AS feature, (avg_mark - (SELECT AVG(avg_mark) FROM a)) * -0.05 AS contribution FROM a
        UNION ALL SELECT student_id, 'resit_rate', (resit_rate - (SELECT AVG(resit_rate) FROM a)) * 2.0 FROM a
        UNION ALL SELECT student_id, 'imd_decile', (imd_decile - (SELECT AVG(imd_decile) FROM a)) * 0.1 FROM a""",
    ["contribution"],
)
def _(c):
    return explain.linear_contributions(aggregate_table(c), COEFFICIENTS)


@query("o18_sampled_attribution")
def _(c):
    table = reliable_checkpoint(survival_table(c))
    fitted = boost.fit_booster(table, "event", SURVIVAL_FEATURES)
    values = explain.sampled_contributions(table, SURVIVAL_FEATURES, fitted.score)
    return explain.strongest(values, 3)


@query("o18_tree_attribution")
def _(c):
    table = reliable_checkpoint(survival_table(c))
    fitted = boost.fit_booster(table, "event", SURVIVAL_FEATURES)
    return explain.strongest(explain.tree_contributions(table, SURVIVAL_FEATURES, fitted.model), 3)


@query(
    "o19_risk_response",
    f"""SELECT student_id, risk_score, tier, {ACTION_SQL} AS actions FROM (SELECT *, {TIER_SQL.format(s='risk_score')} AS tier FROM (SELECT student_id, ROUND(score * 100, 1) AS risk_score FROM predictions))""",
    ["risk_score"],
)
def _(c):
    out = batch.risk_response(c.predictions)
    return out.select("student_id", "risk_score", "tier", F.array_join("recommended_actions", "; ").alias("actions"))


CLASSES = ["Fail", "Third", "2:2", "2:1", "First"]


@query(
    "o19_degree_response",
    """WITH x AS (SELECT student_id, p, [CASE WHEN k = p THEN 0.6 ELSE 0.1 END FOR k IN [0, 1, 2, 3, 4]] AS probs FROM predictions)
       SELECT student_id, ['Fail', 'Third', '2:2', '2:1', 'First'][CAST(p AS INT) + 1] AS predicted_class, CAST(probs[1] AS DOUBLE) AS p_fail, CAST(probs[5] AS DOUBLE) AS p_first FROM x""",
    ["p_fail", "p_first"],
)
def _(c):
    probabilities = F.array(*[F.when(F.col("p") == k, 0.6).otherwise(0.1) for k in range(5)])
    out = batch.degree_response(c.predictions.withColumn("class_probabilities", probabilities), CLASSES)
    return out.select(
        "student_id", "predicted_class", F.col("class_probabilities")["Fail"].alias("p_fail"), F.col("class_probabilities")["First"].alias("p_first")
    )


@query(
    "o19_recommendation_response",
    f"""WITH sc AS ({SCORES_SQL}), r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY student_id ORDER BY score DESC, course_id) AS place FROM sc WHERE model = 'popularity')
        SELECT student_id, STRING_AGG(CAST(course_id AS VARCHAR), ',' ORDER BY place) AS courses, COUNT(*) AS n FROM r WHERE place <= 5 GROUP BY 1""",
)
def _(c):
    listed = best_courses(model_scores(c).where("model = 'popularity'"), 5)
    packed = batch.recommendation_response(listed)
    return packed.select(
        "student_id",
        F.array_join(F.transform("recommendations", lambda r: r["course_id"].cast("string")), ",").alias("courses"),
        F.size("recommendations").cast("long").alias("n"),
    )


@query(
    "o19_batch_scoring",
    """SELECT student_id, ROUND(score, 4) AS probability, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS prediction, ROUND(ABS(score - 0.5) * 2, 4) AS confidence FROM predictions""",
    ["probability", "confidence"],
)
def _(c):
    return batch.enrolment_response(c.predictions)
