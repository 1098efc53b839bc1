"""Edge cases of the feature operators, computed by hand."""

import pytest
from pyspark.sql import functions as F

from cohortlens.functions import expr
from cohortlens.operators import categories, engagement, marks, risk, sequences, student
from cohortlens.operators.course import tariff_band
from cohortlens.sources import files, mapping, registry


def column(spark, values, kind, made):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in rows.select("i", made(F.col("x")).alias("y")).orderBy("i").collect()]


def test_bands_are_right_closed(spark):
    assert column(spark, [0.0, 80.0, 80.5, 200.0, 201.0], "double", student.grade_band) == [None, "C", "BC", "A*", None]
    assert column(spark, [0, 96, 97, 144, 145], "int", tariff_band) == [None, "Low", "Medium", "High", "Very High"]


def test_trend_code(spark):
    assert column(spark, [-5.0, 5.0, 6.0, None], "double", marks.trend_code) == [0, 1, 2, -1]


def test_tiers(spark):
    want = ["LOW", "LOW", "MEDIUM", "CRITICAL", "CRITICAL", None]
    assert column(spark, [0.0, 20.0, 20.1, 100.0, 101.0, None], "double", risk.tier) == want
    assert column(spark, [0.0, 25.0, 50.0, 75.0], "double", risk.percentile_tier) == ["low", "medium", "high", "very_high"]


def test_constant_risk_is_fifty(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 2.0)], "student_id int, raw double")
    assert {r["risk_score"] for r in risk.minmax_score(df, "raw").collect()} == {50.0}


def test_module_year(spark):
    codes = ["C1_MOD04", "C1_MOD05", "C1_MOD12", "C1_MOD13", "COMP2001", "odd", "C_MODx"]
    assert column(spark, codes, "string", marks.module_year) == [1, 2, 3, 4, 2, 1, 1]


def test_single_assessment_has_no_spread(spark):
    a = spark.createDataFrame([(1, 7, 55.0, 1, 0, 1)], "student_id int, module_id int, mark double, submitted int, late_submission int, attempt int")
    m = spark.createDataFrame([(7, 1, 1, 20), (7, 2, 1, 20)], "module_id int, course_id int, year int, credits int")
    row = marks.performance_features(a, m).first()
    assert row["std_mark"] == 0 and row["total_assessments"] == 1 and row["resit_rate"] == 0
    assert row["year2_avg_mark"] is None and row["performance_trend"] == 0
    assert marks.resit_features(a).first()["resit_success_rate"] == 0


@pytest.mark.parametrize("values, want", [([1, 2, 100, 5, 6], 4.0), ([1, 2, 9], 0.0), ([1, 3, 5, 7], 4.0)])
def test_head_tail_trend(spark, values, want):
    df = spark.createDataFrame([(1, w, v) for w, v in enumerate(values)], "student_id int, week int, x int")
    assert engagement.head_tail_trend(df, "x", "t").first()["t"] == want


def test_unseen_category_is_minus_one(spark):
    train = spark.createDataFrame([("b",), ("a",)], "c string")
    fitted = categories.LabelCodes.fit(train, ["c"])
    got = fitted.transform(spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "c string")).collect()
    assert [r["c_encoded"] for r in got] == [0, 1, -1, -1]


def test_too_many_levels_are_refused(spark, monkeypatch):
    monkeypatch.setattr(categories, "MAX_LEVELS", 3)
    with pytest.raises(ValueError):
        categories.levels(spark.range(10).select(F.col("id").cast("string").alias("c")), "c")


def test_drop_first_counts_missing_as_unknown(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "c string")
    cols = categories.dummies_drop_first(df, ["c"])
    assert df.select(*cols).columns == ["c_a", "c_b"]
    assert [tuple(r) for r in df.select(*cols).collect()] == [(0, 1), (0, 0), (1, 0)]


def test_truthy_and_lookup(spark):
    assert column(spark, ["True", "YES", "1", "0", None], "string", expr.truthy) == [True, True, True, False, False]
    assert column(spark, ["a", "z", None], "string", lambda c: expr.lookup(c, {"a": 1}, -1)) == [1, -1, -1]


def test_sequence_is_padded_and_carries_marks_forward(spark):
    vle = spark.createDataFrame([(1, w, 1, 1, 1, 1, 1, 5) for w in (1, 2, 4, 5)], "student_id int, week int, logins int, resources_accessed int, forum_posts int, quiz_attempts int, video_views int, total_actions int")
    att = spark.createDataFrame([(1, 1, 1, "Present"), (1, 2, 0, "Absent")], "student_id int, week int, attended int, status string")
    ass = spark.createDataFrame([(1, 2, 60.0, 1, 0), (1, 4, 80.0, 0, 1)], "student_id int, week int, mark double, submitted int, late_submission int")
    steps = sequences.weekly_sequences(vle, att, ass, length=6, min_weeks=4).orderBy("week").collect()
    assert [r["week"] for r in steps] == [1, 2, 3, 4, 5, 6]
    assert [r["total_actions"] for r in steps] == [5, 5, 0, 5, 5, 0]
    assert [r["avg_mark"] for r in steps] == [0.0, 60.0, 60.0, 70.0, 70.0, 0.0]
    assert [r["n_assessments"] for r in steps] == [0, 1, 1, 2, 2, 0]
    assert steps[1]["absent_count"] == 1
    last = sequences.weekly_sequences(vle, att, ass, length=2, min_weeks=4, as_of_week=5).orderBy("week").collect()
    assert [r["total_actions"] for r in last] == [5, 5]
    short = sequences.weekly_sequences(vle, att, ass, length=6, min_weeks=5)
    assert short.count() == 0


def test_vendor_names():
    assert mapping.to_vendor("students", "SITS")["gender"] == "SPR_SEX"
    assert mapping.to_vendor("enrollments", "tribal")["enrollment_date"] == "START_DATE"
    assert mapping.to_vendor("modules", "tribal")["credits"] == "CREDITS"
    assert mapping.to_vendor("nothing", "sits") == {}
    assert mapping.from_vendor("courses", "tribal")["NSS_SCORE"] == "satisfaction_score"
    with pytest.raises(ValueError):
        mapping.to_vendor("students", "other")


def test_registry(spark, tmp_path):
    r = registry.FeatureRegistry()
    r.register("a", "numeric", "first, with comma", "g1")
    r.register("b", "binary", "second", "g2", cardinality=2)
    registry.save(r, spark, str(tmp_path / "r"))
    back = registry.load(spark, str(tmp_path / "r"))
    assert back.entries == r.entries and back.names("g2") == ["b"]
    with pytest.raises(ValueError):
        r.register("c", "odd", "", "g")


def test_upsert_takes_the_latest_version(spark):
    now = spark.createDataFrame([(1, "a", 1), (2, "b", 3)], "k int, v string, version int")
    new = spark.createDataFrame([(1, "c", 2), (2, "old", 1), (3, "n", 1)], "k int, v string, version int")
    assert {tuple(r) for r in files.upsert(now, new, ["k"], "version").collect()} == {(1, "c", 2), (2, "b", 3), (3, "n", 1)}
