"""Quality rules, drift, metrics and fairness on small tables."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import drift, fairness, quality, ranking_metrics as rm, risk, scores
from cohortlens.operators.survival import comparable_pairs


def test_rules(spark):
    df = spark.createDataFrame([(1, 5.0, None), (1, 50.0, "x"), (2, None, None)], "id int, mark double, c string")
    rules = [
        quality.SchemaRule(columns=["id", "no"], families={"mark": "string"}),
        quality.NullRule(columns=["c"], max_share=0.5),
        quality.RangeRule(column="mark", minimum=10.0),
        quality.UniqueRule(columns=["id", "c"], allow_duplicates=True),
        quality.CardinalityRule(column="id", minimum=3),
        quality.RangeRule(column="absent", minimum=1.0),
    ]
    got = {r["rule_no"]: (r["passed"], r["message"], r["severity"]) for r in quality.validate(df, rules).collect()}
    assert got[1] == (False, "Missing required columns: no; Column mark has type double, expected string", "error")
    assert got[2] == (False, "Column c has 66.7% nulls (max: 50.0%)", "error")
    assert got[3] == (False, "1 values in mark below minimum 10.0", "warning")
    assert got[4] == (True, "Column id has 1 duplicate values; Column c has 1 duplicate values", "warning")
    assert got[5][0] is False and got[6] == (True, "Column absent not found", "warning")
    assert quality.summary(quality.validate(df, rules)).first()["rules_failed"] == 4


def test_a_broken_rule_is_reported(spark):
    class Broken(quality.Rule):
        def verdict(self, df):
            raise RuntimeError("no")

    row = quality.validate(spark.range(3), [Broken(name="b")]).first()
    assert not row["passed"] and "no" in row["message"]


def test_drift_identical_constant_and_empty(spark):
    df = spark.range(200).select((F.col("id") % 20).cast("double").alias("x"), F.lit(3).alias("k"), F.lit("a").alias("c"))
    same = {r["column"]: r for r in drift.detect_drift(df, df).collect()}
    assert all(abs(r["psi"]) < 1e-9 and not r["drift_detected"] for r in same.values())
    assert same["x"]["ks_statistic"] == 0 and same["x"]["ks_p_value"] == 1
    empty = {r["column"]: r for r in drift.divergence(df, df.where("x < 0")).collect()}
    assert empty["x"]["psi"] == math.inf and empty["x"]["interpretation"] == "Current data is empty"
    far = df.withColumn("x", F.col("x") + 100)
    assert drift.divergence(df, far).where("column = 'x'").first()["psi"] == math.inf


def test_ks_against_plain(spark):
    rng = random.Random(3)
    a, b = [rng.gauss(0, 1) for _ in range(300)], [rng.gauss(0.4, 1) for _ in range(200)]
    points = sorted(a + b)
    want = max(abs(sum(x <= p for x in a) / 300 - sum(x <= p for x in b) / 200) for p in points)
    one = lambda v: spark.createDataFrame([(x,) for x in v], "x double")
    got = drift.ks_test(one(a), one(b)).first()
    assert got["ks_statistic"] == pytest.approx(want) and 0 < got["ks_p_value"] < 0.01


def test_concordance_against_all_pairs(spark):
    rng = random.Random(4)
    rows = [(rng.randint(0, 40), rng.randint(0, 1), rng.choice([0.5, round(rng.random(), 1)])) for _ in range(400)]
    got = comparable_pairs(spark.createDataFrame(rows, "time int, event int, risk double")).first()
    pairs = [(a[2], b[2]) for a in rows for b in rows if a[0] < b[0] and a[1]]
    assert got["comparable"] == len(pairs)
    assert got["concordant"] == sum(x > y for x, y in pairs) and got["tied"] == sum(x == y for x, y in pairs)


def test_concordance_without_events(spark):
    df = spark.createDataFrame([(1, 0, 0.2), (2, 0, 0.1)], "time int, event int, risk double")
    assert scores.concordance(df, "time", "event", "risk").first()["c_index"] is None


def test_auc_ties_and_single_class(spark):
    tied = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.5)], "y int, s double")
    assert scores.roc_auc(tied, "y", "s").first()["roc_auc"] == 0.5
    single = spark.createDataFrame([(1, 0.5), (1, 0.1)], "y int, s double")
    assert scores.roc_auc(single, "y", "s").first()["roc_auc"] is None


def test_auc_and_average_precision_against_plain(spark):
    rng = random.Random(5)
    rows = [(int(rng.random() < 0.4), round(rng.random(), 1)) for _ in range(300)]
    df = spark.createDataFrame(rows, "y int, s double")
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)
    assert scores.roc_auc(df, "y", "s").first()["roc_auc"] == pytest.approx(auc)
    ap = sum(
        sum(s == t for s in pos) * sum(s >= t for s in pos) / sum(s >= t for _, s in rows) for t in sorted({s for _, s in rows})
    ) / len(pos)
    assert scores.pr_auc(df, "y", "s").first()["pr_auc"] == pytest.approx(ap)


def test_kappa_of_perfect_and_undefined(spark):
    perfect = spark.createDataFrame([(0, 0), (1, 1), (3, 3)], "y int, p int")
    assert scores.kappa(perfect, "y", "p", 4).first()["qwk"] == 1.0
    constant = spark.createDataFrame([(2, 2), (2, 2)], "y int, p int")
    assert scores.kappa(constant, "y", "p", 4).first()["qwk"] == 0.0


def test_binary_metrics_without_positives(spark):
    row = scores.binary(spark.createDataFrame([(0, 0), (0, 0)], "y int, p int"), "y", "p").first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"]) == (1.0, 0.0, 0.0, 0.0)


def judged(spark, rows):
    return spark.createDataFrame(rows, "student_id int, course_id int, score double, relevance int")


def test_ranking_edge_cases(spark):
    df = judged(spark, [(1, 1, 0.9, 0), (1, 2, 0.8, 0), (2, 1, 0.9, 0), (2, 2, 0.5, 1)])
    ndcg = {r["student_id"]: r["ndcg"] for r in rm.ndcg(df, 10).collect()}
    assert ndcg[1] == 0 and ndcg[2] == pytest.approx(1 / math.log2(3))
    rr = {r["student_id"]: r["rr"] for r in rm.reciprocal_rank(df).collect()}
    assert rr == {1: 0.0, 2: 0.5}


def test_repeated_items_count_once(spark):
    predicted = spark.createDataFrame([(1, 1, 7), (1, 2, 7), (1, 3, 8), (2, 1, 9)], "student_id int, rank int, course_id int")
    actual = spark.createDataFrame([(1, 7), (1, 8)], "student_id int, course_id int")
    got = {r["student_id"]: r["ap"] for r in rm.average_precision(predicted, actual, 3).collect()}
    assert got == {1: pytest.approx((1 + 2 / 3) / 2), 2: 0.0}


def test_impact_of_no_positives_and_one_group(spark):
    df = spark.createDataFrame([(1, 0, 0.1, "a", "m"), (0, 0, 0.2, "b", "m")], "y_true int, y_pred int, score double, g string, h string")
    got = {r["attribute"]: r for r in fairness.disparate_impact(fairness.group_rates(df, ["g", "h"])).collect()}
    assert got["g"]["impact_ratio"] == 1.0 and got["h"]["impact_status"] == "PASS"
    odds = {r["attribute"]: r["odds_difference"] for r in fairness.equalized_odds(fairness.group_rates(df, ["g", "h"])).collect()}
    assert odds["h"] == 0


def test_alerts(spark):
    df = spark.createDataFrame([(1, 15.0), (2, 45.0), (3, 95.0), (4, 75.0)], "student_id int, risk_score double")
    got = risk.alerts(df, "HIGH", top_k=2).collect()
    assert [(r["student_id"], r["tier"]) for r in got] == [(3, "CRITICAL"), (4, "VERY_HIGH")]
    assert got[0]["recommended_actions"] == ["Immediate welfare check", "Escalate to head of year"]
    assert {r["tier"]: r["n"] for r in risk.tier_summary(df).collect()}["MEDIUM"] == 0


def test_lead_time(spark):
    df = spark.createDataFrame([(9,), (12,), (12,), (20,)], "time int")
    row = risk.lead_time(df, horizon=4).first()
    leads = np.array([1, 4, 4, 12])
    assert (row["mean_lead"], row["median_lead"], row["share_early"]) == (leads.mean(), np.median(leads), 0.75)
    assert row["std_lead"] == pytest.approx(leads.std())
