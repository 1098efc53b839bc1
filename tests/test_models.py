"""Training jobs: invariants and small brute-force checks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.models import batch, boost, explain, multitask, ordinal, sequence, survival, tune
from cohortlens.models.base import feature_names


@pytest.fixture(scope="module")
def flags(spark):
    """A label that follows x with some noise."""
    rows = spark.range(600).select(
        F.col("id").alias("student_id"),
        (F.col("id") % 97 / 97.0).alias("x"),
        (F.col("id") % 13 / 13.0).alias("z"),
    )
    return rows.withColumn("y", ((F.col("x") + 0.2 * F.col("z")) > 0.7).cast("int")).persist()


@pytest.mark.parametrize("method", [None, "platt", "isotonic"])
def test_booster_beats_chance_and_gives_probabilities(flags, method):
    fitted, metrics = boost.train_and_evaluate(flags, "y", ["x", "z"], rounds=3, depth=3, calibrate=method)
    got = {r["metric"]: r["value"] for r in metrics.collect()}
    assert got["roc_auc"] > 0.9 and got["accuracy"] > 0.8
    row = fitted.score(flags).agg(F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    assert 0 <= row["lo"] < row["hi"] <= 1


def test_isotonic_is_monotone(flags):
    plain = boost.fit_booster(flags, "y", ["x", "z"], rounds=3, depth=2, calibrate="isotonic")
    base = boost.Booster(plain.features, plain.model).score(flags).select("student_id", F.col("score").alias("raw"))
    rows = plain.score(flags).join(base, "student_id").orderBy("raw").select("score").collect()
    values = [r[0] for r in rows]
    assert all(a <= b + 1e-9 for a, b in zip(values, values[1:]))


def test_importance_and_unknown_calibration(spark, flags):
    fitted = boost.fit_booster(flags, "y", ["x", "z"], rounds=2, depth=2)
    assert fitted.importance(spark, 1).first()["feature"] == "x"
    with pytest.raises(ValueError):
        boost.fit_booster(flags, "y", ["x"], rounds=1, calibrate="odd")


def test_combine_makes_probabilities(spark):
    df = spark.createDataFrame([([0.2, 0.1, 0.7],), ([0.0, 0.5, 0.4],)], "c array<double>")
    got = [r["p"] for r in df.select(ordinal.combine(F.col("c")).alias("p")).collect()]
    assert got[0] == pytest.approx([0.2, 0.0, 0.5, 0.3]) and got[1] == pytest.approx([0.0, 0.5, 0.0, 0.5])


def test_ordinal_model(flags):
    df = flags.withColumn("level", F.floor(F.col("x") * 4).cast("int"))
    scored = ordinal.fit_ordinal(df, "level", ["x", "z"], 4, rounds=3, depth=3).transform(df)
    total = F.aggregate("class_probabilities", F.lit(0.0), lambda a, v: a + v)
    row = scored.agg(
        F.max(F.abs(total - 1)).alias("off"), F.min(F.array_min("class_probabilities")).alias("low"),
        F.avg((F.col("p") == F.col("level")).cast("double")).alias("hit"),
    ).first()
    assert row["off"] < 1e-9 and row["low"] >= 0 and row["hit"] > 0.9


def test_heads(flags):
    df = flags.withColumns({"y_flag": F.col("y"), "y_number": F.col("x") * 10, "y_level": F.floor(F.col("x") * 3).cast("int")}).drop("y")
    names = feature_names(df)
    assert names == ["x", "z"]
    heads = {"y_flag": "flag", "y_number": "number", "y_level": 3}
    got = multitask.fit_heads(df, heads, names, rounds=5, depth=3).transform(df)
    row = got.agg(
        F.avg(F.abs(F.col("p_number") - F.col("y_number"))).alias("mae"),
        F.avg((F.col("p_level") == F.col("y_level")).cast("double")).alias("hit"),
        F.max(F.abs(F.col("prob_level_0") + F.col("prob_level_1") + F.col("prob_level_2") - 1)).alias("off"),
    ).first()
    assert row["mae"] < 2 and row["hit"] > 0.9 and row["off"] < 1e-9
    with pytest.raises(ValueError):
        multitask.fit_heads(df.withColumn("y_flag", F.lit(1)), {"y_flag": "flag"}, names, rounds=1)


@pytest.fixture(scope="module")
def lives(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(400):
        a, b = rng.normal(), rng.normal()
        t = int(min(30, 1 + rng.exponential(12 * np.exp(-0.8 * a))))
        rows.append((i, t, int(t < 30 and rng.random() < 0.8), float(a), float(b)))
    return spark.createDataFrame(rows, "student_id long, time int, event int, a double, b double").persist()


def test_cox_against_direct_maximisation(lives):
    model = survival.fit_cox(lives, "time", "event", ["a", "b"], alpha=0.0, max_iter=20)
    rows = lives.collect()
    x = np.array([[(r["a"] - model.scaling.mean["a"]) / model.scaling.std["a"], (r["b"] - model.scaling.mean["b"]) / model.scaling.std["b"]] for r in rows])
    t, e = np.array([r["time"] for r in rows]), np.array([r["event"] for r in rows])

    def slope(beta):
        w = np.exp(x @ beta)
        out = np.zeros(2)
        for i in np.nonzero(e)[0]:
            at = t >= t[i]
            out += x[i] - (w[at] @ x[at]) / w[at].sum()
        return out

    assert np.abs(slope(model.beta)).max() < 1e-3 and model.beta[0] > 0.4
    zeroed = survival.fit_cox(lives, "time", "event", ["a", "b"], alpha=0.05, l1_ratio=1.0)
    assert zeroed.beta[1] == 0 and 0 < zeroed.beta[0] < model.beta[0]


def test_survival_curves_fall(lives):
    model, metric = survival.fit_and_evaluate(lives, "time", "event", ["a", "b"])
    assert metric.first()["c_index"] > 0.6
    for rows in (
        model.survival(lives.limit(5)).orderBy("student_id", "time").collect(),
        survival.fit_hazard(lives, "time", "event", ["a", "b"], weeks=10, rounds=2).survival(lives.limit(5)).orderBy("student_id", "time").collect(),
    ):
        assert rows and all(0 <= r["survival"] <= 1 for r in rows)
        for p, q in zip(rows, rows[1:]):
            assert p["student_id"] != q["student_id"] or q["survival"] <= p["survival"] + 1e-12


def test_second_model(lives):
    assert survival.fit_accelerated(lives, "time", "event", ["a", "b"], 5).coefficients.size == 2


@pytest.fixture(scope="module")
def many_times(spark):
    """6,000 rows at 5,000 distinct times, some shared by many rows."""
    rng = np.random.default_rng(4)
    n = 6000
    x = rng.normal(size=(n, 3))
    time = np.where(np.arange(n) < 5000, np.arange(n) * 0.37, rng.integers(0, 4, n) * 0.37)
    event = (rng.random(n) < 0.5).astype(int)
    rows = [(i, float(t), int(e), *map(float, v)) for i, (t, e, v) in enumerate(zip(time, event, x))]
    return spark.createDataFrame(rows, "student_id long, time double, event int, a double, b double, c double").persist()


def test_cox_derivatives_at_5000_times(many_times):
    beta = np.array([0.4, -0.2, 0.1])
    gradient, curvature = survival.CoxRows.of(many_times, "time", "event", [F.col(c) for c in "abc"]).derivatives(beta)
    rows = many_times.toPandas()
    x, t, e = rows[["a", "b", "c"]].to_numpy(), rows["time"].to_numpy(), rows["event"].to_numpy()
    w = np.exp(x @ beta)
    g, h = np.zeros(3), np.zeros((3, 3))
    for i in np.flatnonzero(e):
        at = t >= t[i]
        mean = w[at] @ x[at] / w[at].sum()
        g += x[i] - mean
        h += (x[at] * w[at, None]).T @ x[at] / w[at].sum() - np.outer(mean, mean)
    assert np.allclose(gradient, g / len(t)) and np.allclose(curvature, h / len(t))


def test_fit_and_curves_at_5000_times(many_times):
    model = survival.fit_cox(many_times, "time", "event", ["a", "b"], max_iter=2)
    steps = {r["time"]: r["hazard"] for r in model.baseline.collect()}
    rows = many_times.where("event = 1").select("time").distinct().count()
    assert len(steps) == rows > 2000
    last = max(steps)
    curve = {r["time"]: r["survival"] for r in model.survival(many_times.limit(1).drop("time"), [-1.0, last / 2, last + 1]).collect()}
    assert curve[-1.0] == 1.0 > curve[last / 2] > curve[last + 1]


def test_sequence_model(spark):
    steps = spark.range(80).select(F.col("id").alias("student_id"), F.explode(F.sequence(F.lit(1), F.lit(3))).alias("week"))
    steps = steps.withColumn("v", F.when(F.col("student_id") % 2 == 1, F.col("week")).otherwise(-F.col("week")).cast("double"))
    labels = spark.range(80).select(F.col("id").alias("student_id"), (F.col("id") % 2).alias("target"))
    scored = sequence.fit_sequence(steps, labels, 3, ["v"], hidden=4, max_iter=30).score(steps).join(labels, "student_id")
    hit = scored.agg(F.avg(((F.col("score") > 0.5).cast("int") == F.col("target")).cast("double"))).first()[0]
    assert hit > 0.95


def test_contributions_add_up(flags):
    names = ["x", "z"]
    linear = explain.linear_contributions(flags, {"x": 2.0, "z": -1.0})
    total = linear.groupBy("student_id").agg(F.sum("contribution").alias("s")).join(flags, "student_id")
    mean = flags.agg(F.avg("x").alias("x"), F.avg("z").alias("z")).first()
    off = total.agg(F.max(F.abs(F.col("s") - (2 * (F.col("x") - mean["x"]) - (F.col("z") - mean["z"]))))).first()[0]
    assert off < 1e-9
    fitted = boost.fit_booster(flags, "y", names, rounds=2, depth=2)
    some = flags.where("student_id % 20 = 0")  # 30 rows over the whole range of x
    sampled = explain.sampled_contributions(some, names, fitted.score, permutations=3)
    base = fitted.score(some.agg(F.avg("x").alias("x"), F.avg("z").alias("z"))).first()["score"]
    sums = sampled.groupBy("student_id").agg(F.sum("contribution").alias("s")).join(fitted.score(some), "student_id")
    assert sums.agg(F.max(F.abs(F.col("s") + base - F.col("score")))).first()[0] < 1e-9
    assert explain.mean_strength(sampled, 1).first()["feature"] == "x"
    assert explain.strongest(sampled, 1).count() == 30


def test_cross_validation_and_search(flags):
    def trainer(train, params):
        return boost.fit_booster(train, "y", ["x", "z"], **{"rounds": 2, "depth": 2, **params}).predict

    results = tune.cross_validate(flags, "y", trainer, k=3)
    assert results.count() == 3 and tune.summarised(results).first()["mean"] > 0.8
    assert sum(r["n_val"] for r in results.collect()) == 600
    best, trials = tune.search(flags, "y", trainer, {"depth": ("int", 1, 3), "step": ("log", 0.05, 0.3)}, trials=2)
    assert trials.count() == 2 and set(best) == {"depth", "step"}
    assert tune.draws({"a": ("float", 0, 1)}, 3) == tune.draws({"a": ("float", 0, 1)}, 3)
    with pytest.raises(ValueError):
        tune.draws({"a": ("odd", 0, 1)}, 1)


def test_responses(spark):
    scored = spark.createDataFrame([(1, 0.73456)], "student_id long, score double")
    assert tuple(batch.enrolment_response(scored).first()) == (1, 0.7346, 1, 0.4691)
    row = batch.risk_response(scored).first()
    assert row["tier"] == "VERY_HIGH" and len(row["recommended_actions"]) == 2
    graded = spark.createDataFrame([(1, 1, [0.1, 0.9])], "student_id long, p int, class_probabilities array<double>")
    degree = batch.degree_response(graded, ["Fail", "Third"]).first()
    assert degree["predicted_class"] == "Third" and degree["class_probabilities"] == {"Fail": 0.1, "Third": 0.9}
    listed = spark.createDataFrame([(1, 2, 9, 0.5), (1, 1, 8, 0.7)], "student_id long, rank int, course_id long, score double")
    assert [c["course_id"] for c in batch.recommendation_response(listed).first()["recommendations"]] == [8, 9]
