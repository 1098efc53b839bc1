"""Risk scoring, alerts and the tutor pages (rows R1–R10, T1–T6)."""

from pyspark.sql import functions as F

from cohortlens.operators import dashboard, engagement, fairness, prep, risk
from cohortlens.operators.attribution import top_factors
from cohortlens.plans.features import PERCENTILE_SQL
from cohortlens.plans.outcomes import RETENTION_SQL, retention
from cohortlens.plans.registry import query

TIER_SQL = """CASE WHEN {s} <= 20 THEN 'LOW' WHEN {s} <= 40 THEN 'MEDIUM' WHEN {s} <= 60 THEN 'HIGH' WHEN {s} <= 80 THEN 'VERY_HIGH' ELSE 'CRITICAL' END"""
SCORED_SQL = "SELECT student_id, 100 * score AS risk_score FROM predictions"


def scored(c):
    return c.predictions.select("student_id", (F.col("score") * 100).alias("risk_score"))


@query(
    "r1_risk_score",
    """SELECT student_id, (risk_score - (SELECT MIN(risk_score) FROM r)) / ((SELECT MAX(risk_score) FROM r) - (SELECT MIN(risk_score) FROM r)) * 100 AS scaled FROM r""".join(
        [f"WITH r AS ({RETENTION_SQL}) ", ""]
    ),
    ["scaled"],
)
def _(c):
    return risk.minmax_score(retention(c), "risk_score", "scaled").select("student_id", "scaled")


@query("r2_tier", f"SELECT student_id, {TIER_SQL.format(s='risk_score')} AS tier FROM ({SCORED_SQL})")
def _(c):
    return scored(c).select("student_id", risk.tier(F.col("risk_score")).alias("tier"))


COLOUR_SQL = "CASE tier " + " ".join(f"WHEN '{t}' THEN '{v}'" for t, v in risk.COLOURS.items()) + " END"
SYMBOL_SQL = "CASE tier " + " ".join(f"WHEN '{t}' THEN '{v}'" for t, v in risk.SYMBOLS.items()) + " END"
TIERED_SQL = f"SELECT student_id, risk_score, {TIER_SQL.format(s='risk_score')} AS tier FROM ({SCORED_SQL})"


@query("r3_tier_decoration", f"SELECT student_id, tier, {COLOUR_SQL} AS color, {SYMBOL_SQL} AS symbol FROM ({TIERED_SQL})")
def _(c):
    tiered = scored(c).withColumn("tier", risk.tier(F.col("risk_score")))
    return risk.decorate(tiered).select("student_id", "tier", "color", "symbol")


@query(
    "r4_percentile_tier",
    f"""SELECT student_id, CASE WHEN percentile < 25 THEN 'low' WHEN percentile < 50 THEN 'medium' WHEN percentile < 75 THEN 'high' ELSE 'very_high' END AS tier FROM ({PERCENTILE_SQL})""",
)
def _(c):
    ranked = prep.percentile_ranks(c.predictions, "score")
    return ranked.select("student_id", risk.percentile_tier(F.col("percentile")).alias("tier"))


ACTION_SQL = "CASE tier " + " ".join(f"WHEN '{t}' THEN '{'; '.join(a)}'" for t, a in risk.ACTIONS.items()) + " END"


@query("r5_actions", f"SELECT student_id, tier, {ACTION_SQL} AS actions FROM ({TIERED_SQL})")
def _(c):
    tiered = scored(c).withColumn("tier", risk.tier(F.col("risk_score")))
    return tiered.select("student_id", "tier", F.array_join(risk.actions(F.col("tier")), "; ").alias("actions"))


FACTORS = {"absence": "attendance_trend", "activity": "vle_engagement_trend"}


def weekly_factors(c):
    """Two signed factors per student seen online: falling attendance and falling activity."""
    f = engagement.engagement_features(c.attendance, c.vle_engagement)
    return f.select(
        "student_id",
        F.round(F.least(F.lit(100.0), F.greatest(F.lit(0.0), 100 * (1 - F.col("attendance_rate")) * 4)), 3).alias("risk_score"),
        F.round(-F.col("attendance_trend"), 3).alias("absence"),
        F.round(-F.col("vle_engagement_trend"), 3).alias("activity"),
    )


FACTOR_SQL = """SELECT student_id, ROUND(LEAST(100, GREATEST(0, 100 * (1 - ar) * 4)), 3) AS risk_score, CASE WHEN ROUND(at2, 3) = 0 THEN 0 ELSE ROUND(-at2, 3) END AS absence, CASE WHEN ROUND(vt, 3) = 0 THEN 0 ELSE ROUND(-vt, 3) END AS activity FROM
 (SELECT student_id, AVG(attended) AS ar, COALESCE(AVG(CASE WHEN week > 15 THEN attended END) - AVG(CASE WHEN week <= 15 THEN attended END), 0) AS at2 FROM attendance GROUP BY 1)
 JOIN (SELECT student_id, COALESCE(AVG(CASE WHEN week > 15 THEN total_actions END) - AVG(CASE WHEN week <= 15 THEN total_actions END), 0) AS vt FROM vle_engagement GROUP BY 1) USING (student_id)"""


@query(
    "r6_explanation",
    f"""WITH f AS ({FACTOR_SQL}), l AS (SELECT student_id, risk_score, name, v, ROW_NUMBER() OVER (PARTITION BY student_id ORDER BY ABS(v) DESC, name) AS pos
          FROM (SELECT student_id, risk_score, 'absence' AS name, absence AS v FROM f UNION ALL SELECT student_id, risk_score, 'activity', activity FROM f)),
        t AS (SELECT student_id, MAX(risk_score) AS s, STRING_AGG(CASE WHEN v > 0 THEN name || ' (+' || PRINTF('%.3f', v) || ')' END, ', ' ORDER BY pos) AS up,
          STRING_AGG(CASE WHEN v <= 0 THEN name || ' (' || PRINTF('%.3f', v) || ')' END, ', ' ORDER BY pos) AS down FROM l GROUP BY 1)
        SELECT student_id, CONCAT_WS(' ', 'This student has a ' || PRINTF('%.1f', s) || '/100 risk score (' || {TIER_SQL.format(s='s')} || ').',
          CASE WHEN up IS NOT NULL THEN 'Key risk factors: ' || up || '.' END, CASE WHEN down IS NOT NULL THEN 'Protective factors: ' || down || '.' END) AS explanation FROM t""",
)
def _(c):
    f = weekly_factors(c)
    factors = top_factors({n: F.col(n) + 0.0 for n in FACTORS}, 3)
    score = F.col("risk_score")
    return f.select("student_id", risk.explanation(score, risk.tier(score), factors).alias("explanation"))


ALERTS_SQL = f"""SELECT student_id, ROUND(risk_score, 1) AS risk_score, tier, {SYMBOL_SQL} AS symbol, {ACTION_SQL} AS actions FROM ({TIERED_SQL})
 WHERE tier IN ('HIGH', 'VERY_HIGH', 'CRITICAL') ORDER BY ROUND(risk_score, 1) DESC, student_id LIMIT 100"""


@query("r7_batch_alerts", ALERTS_SQL, ["risk_score"])
def _(c):
    listed = risk.alerts(scored(c), min_tier="HIGH", top_k=100)
    return listed.select(
        "student_id", "risk_score", "tier", "symbol", F.array_join("recommended_actions", "; ").alias("actions")
    )


SUMMARY_SQL = f"""SELECT t AS tier, COUNT(student_id) AS n, COUNT(student_id) * 100.0 / (SELECT COUNT(*) FROM predictions) AS percent
 FROM (VALUES ('LOW'), ('MEDIUM'), ('HIGH'), ('VERY_HIGH'), ('CRITICAL')) v(t) LEFT JOIN ({TIERED_SQL}) x ON tier = t GROUP BY t"""


@query("r8_tier_summary", SUMMARY_SQL, ["percent"])
def _(c):
    return risk.tier_summary(scored(c))


@query(
    "r9_lead_time_summary",
    """SELECT COUNT(*) AS n_events, AVG(time - 8) AS mean_lead, MEDIAN(CAST(time - 8 AS DOUBLE)) AS median_lead, STDDEV_POP(time - 8) AS std_lead,
       AVG(CASE WHEN time - 8 >= 6 THEN 1.0 ELSE 0.0 END) AS share_early FROM (SELECT MAX(week) AS time FROM vle_engagement GROUP BY student_id)""",
    ["mean_lead", "median_lead", "std_lead", "share_early"],
)
def _(c):
    last = c.vle_engagement.groupBy("student_id").agg(F.max("week").alias("time"))
    return risk.lead_time(last, horizon=6)


@query(
    "r10_alert_record",
    f"""SELECT student_id, tier || '|' || PRINTF('%.1f', ROUND(risk_score, 1)) || '|' || {ACTION_SQL} || '|retention' AS record FROM
        (SELECT student_id, risk_score, {TIER_SQL.format(s='risk_score')} AS tier FROM ({RETENTION_SQL})) WHERE tier <> 'LOW'""",
)
def _(c):
    rows = risk.alerts(retention(c), min_tier="MEDIUM", model="retention")
    alert = F.struct("tier", F.format_string("%.1f", "risk_score").alias("score"), F.array_join("recommended_actions", "; ").alias("actions"), "model_name")
    parts = [F.col(f"alert.{p}") for p in ("tier", "score", "actions", "model_name")]
    return rows.select("student_id", alert.alias("alert")).select("student_id", F.concat_ws("|", *parts).alias("record"))


@query(
    "r10_full_alert_record",
    f"""WITH f AS ({FACTOR_SQL}), l AS (SELECT student_id, risk_score, name, v, ROW_NUMBER() OVER (PARTITION BY student_id ORDER BY ABS(v) DESC, name) AS pos
          FROM (SELECT student_id, risk_score, 'absence' AS name, absence AS v FROM f UNION ALL SELECT student_id, risk_score, 'activity', activity FROM f)),
        t AS (SELECT student_id, MAX(risk_score) AS s, STRING_AGG(CASE WHEN v > 0 THEN name || ' (+' || PRINTF('%.3f', v) || ')' END, ', ' ORDER BY pos) AS up,
          STRING_AGG(CASE WHEN v <= 0 THEN name || ' (' || PRINTF('%.3f', v) || ')' END, ', ' ORDER BY pos) AS down,
          STRING_AGG(name || '=' || PRINTF('%.3f', v), ',' ORDER BY pos) AS factors FROM l GROUP BY 1),
        x AS (SELECT *, {TIER_SQL.format(s='s')} AS tier FROM t)
        SELECT student_id, ROUND(s, 1) AS risk_score, tier, {SYMBOL_SQL} AS symbol, {ACTION_SQL} AS actions, CONCAT_WS(' ', 'This student has a ' || PRINTF('%.1f', s) || '/100 risk score (' || tier || ').',
          CASE WHEN up IS NOT NULL THEN 'Key risk factors: ' || up || '.' END, CASE WHEN down IS NOT NULL THEN 'Protective factors: ' || down || '.' END) AS explanation, factors, 'weekly' AS model_name
        FROM x WHERE tier <> 'LOW'""",
    ["risk_score"],
)
def _(c):
    factors = top_factors({n: F.col(n) + 0.0 for n in FACTORS}, 3)
    rows = risk.alert_records(weekly_factors(c), factors, model="weekly")
    told = F.transform("alert.top_factors", lambda f: F.concat(f["factor"], F.lit("="), F.format_string("%.3f", f["value"])))
    return rows.select(
        "student_id",
        "alert.risk_score",
        "alert.tier",
        "alert.symbol",
        F.array_join("alert.recommended_actions", "; ").alias("actions"),
        "alert.explanation",
        F.array_join(told, ",").alias("factors"),
        "alert.model_name",
    )


@query(
    "t1_kpis",
    f"""SELECT COUNT(*) AS total, COUNT(CASE WHEN tier IN ('HIGH', 'VERY_HIGH', 'CRITICAL') THEN 1 END) AS at_risk,
        COUNT(CASE WHEN tier = 'CRITICAL' THEN 1 END) AS critical, COUNT(CASE WHEN tier = 'MEDIUM' THEN 1 END) AS medium FROM ({TIERED_SQL})""",
)
def _(c):
    return dashboard.kpis(scored(c).withColumn("tier", risk.tier(F.col("risk_score"))))


@query(
    "t2_at_risk_list",
    f"""SELECT student_id, risk_score, tier, course_id FROM (SELECT student_id, risk_score, tier, course_id FROM ({TIERED_SQL}) JOIN enrollments USING (student_id))
        WHERE tier IN ('VERY_HIGH', 'CRITICAL') ORDER BY risk_score DESC, student_id LIMIT 50""",
    ["risk_score"],
)
def _(c):
    tiered = scored(c).withColumn("tier", risk.tier(F.col("risk_score")))
    people = tiered.join(c.enrollments.select("student_id", "course_id"), "student_id")
    shown = dashboard.filtered(people, tiers=["VERY_HIGH", "CRITICAL"]).withColumnRenamed("risk_score", "score")
    page = dashboard.sorted_list(shown, "score_desc", 50)
    return page.select("student_id", F.col("score").alias("risk_score"), "tier", "course_id")


@query("t3_score_histogram", f"SELECT ROUND(risk_score, 1) AS risk_score, COUNT(*) AS n FROM ({SCORED_SQL}) GROUP BY 1", ["risk_score"])
def _(c):
    return dashboard.value_counts(scored(c).withColumn("risk_score", F.round("risk_score", 1)), "risk_score")


LOG_SQL = """SELECT o_custkey AS student_id, o_orderpriority AS intervention, CASE o_orderstatus WHEN 'F' THEN 'Improved' WHEN 'O' THEN 'No response' ELSE 'Pending' END AS outcome,
 1 + o_orderkey % 5 AS outcome_score, CAST(o_orderdate AS DATE) AS follow_up FROM orders"""


def log(c):
    """The orders as an intervention log."""
    state = F.col("o_orderstatus")
    return c.raw("orders").select(
        F.col("o_custkey").alias("student_id"),
        F.col("o_orderpriority").alias("intervention"),
        F.when(state == "F", "Improved").when(state == "O", "No response").otherwise("Pending").alias("outcome"),
        (1 + F.col("o_orderkey") % 5).alias("outcome_score"),
        F.to_date("o_orderdate").alias("follow_up"),
    )


@query(
    "t4_intervention_kpis",
    f"""SELECT COUNT(*) AS total, COUNT(CASE WHEN outcome = 'Improved' THEN 1 END) AS improved, COUNT(CASE WHEN outcome = 'No response' THEN 1 END) AS no_response,
        AVG(outcome_score) AS mean_score FROM ({LOG_SQL})""",
    ["mean_score"],
)
def _(c):
    return dashboard.intervention_kpis(log(c))


@query(
    "t5_outcomes_by_intervention",
    f"""SELECT intervention, COUNT(CASE WHEN outcome = 'Improved' THEN 1 END) AS "Improved", COUNT(CASE WHEN outcome = 'No response' THEN 1 END) AS "No response",
        COUNT(CASE WHEN outcome = 'Pending' THEN 1 END) AS "Pending", COUNT(*) AS n, COUNT(CASE WHEN follow_up <= DATE '1997-03-08' THEN 1 END) AS due FROM ({LOG_SQL}) GROUP BY 1""",
)
def _(c):
    return dashboard.outcomes_by_intervention(log(c), "1997-03-01")


@query(
    "t6_group_risk",
    f"""SELECT ethnicity, AVG(100 * score) AS mean, STDDEV_SAMP(100 * score) AS std, COUNT(*) AS n,
        100 * AVG(CASE WHEN {TIER_SQL.format(s='100 * score')} IN ('HIGH', 'VERY_HIGH', 'CRITICAL') THEN 1.0 ELSE 0.0 END) AS high_risk_rate FROM predictions GROUP BY 1""",
    ["mean", "std", "high_risk_rate"],
)
def _(c):
    people = c.predictions.select("student_id", "ethnicity", (F.col("score") * 100).alias("risk_score"))
    tiered = people.withColumn("tier", risk.tier(F.col("risk_score")))
    stats = dashboard.group_stats(tiered, "ethnicity", "risk_score")
    return stats.join(fairness.high_risk_rate(tiered, "ethnicity"), "ethnicity")
