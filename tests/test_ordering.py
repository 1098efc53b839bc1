"""Distributed ordering against plain Python, with heavy ties and hot groups."""

import random

import pytest
from pyspark.sql import functions as F

from cohortlens.functions import ordering
from cohortlens.operators import prep


def table(spark, values, schema):
    return spark.createDataFrame(values, schema)


def test_running_totals_per_group_with_a_hot_group(spark):
    rng = random.Random(1)
    rows = [("hot" if i % 3 else f"g{i % 5}", i * 37 % 1009, rng.randint(0, 5)) for i in range(1009)]
    df = table(spark, rows, "g string, x int, n int")
    got = {(r["g"], r["x"]): r["t"] for r in ordering.running_totals(df, "x", {"t": "n"}, within=["g"]).collect()}
    assert len(got) == len(rows)
    for g in {r[0] for r in rows}:
        total = 0
        for _, x, n in sorted(r for r in rows if r[0] == g):
            total += n
            assert got[g, x] == total


def test_running_totals_descending_keeps_null_groups(spark):
    df = table(spark, [(None, 1, 10), (None, 2, 20), ("a", 3, 5)], "g string, x int, n int")
    got = {(r["g"], r["x"]): r["t"] for r in ordering.running_totals(df, "x", {"t": "n"}, ["g"], descending=True).collect()}
    assert got == {(None, 2): 20, (None, 1): 30, ("a", 3): 5}


def test_average_ranks_with_ties(spark):
    df = table(spark, [(1, 5.0), (2, 5.0), (3, 1.0), (4, 9.0)], "id int, x double")
    got = {r["id"]: r["rank"] for r in ordering.average_ranks(df, "x").collect()}
    assert got == {3: 1.0, 1: 2.5, 2: 2.5, 4: 4.0}


def quantile(values, share):
    at = share * (len(values) - 1)
    lo = int(at)
    hi = min(lo + 1, len(values) - 1)
    return values[lo] + (values[hi] - values[lo]) * (at - lo) if values[lo] != values[hi] else values[lo]


def test_exact_quantiles(spark):
    rng = random.Random(2)
    columns = {
        "a": [rng.choice([7.0, rng.uniform(0, 50)]) for _ in range(801)] + [None],
        "b": [rng.choice([0.0, -0.0, 5e-324, -5e-324, 1e-310, 2.0**-1022, -1e308, 1.7976931348623157e308, 1.0, -1.0, 3.0]) for _ in range(802)],
        "c": [None] * 802,
        "d": [rng.gauss(0, 1) * 10.0 ** rng.randint(-30, 30) for _ in range(802)],
        "e": [float("inf") if i % 5 == 0 else float(i % 3) for i in range(802)],
    }
    df = table(spark, list(zip(*columns.values())), "a double, b double, c double, d double, e double")
    shares = (0.0, 0.05, 0.5, 0.961, 1.0)
    got = ordering.exact_quantiles(df, list(columns), shares)
    for c, v in columns.items():
        values = sorted(x for x in v if x is not None)
        for share in shares:
            assert (c, share) in got if values else (c, share) not in got
            if values:
                want = quantile(values, share)
                assert got[c, share] == want or got[c, share] == pytest.approx(want, rel=1e-12)
    assert ordering.exact_quantiles(df.limit(0), ["a"], [0.5]) == {}


def test_keys_are_ordered_like_the_numbers(spark):
    rng = random.Random(9)
    values = [2.0**e * f for e in (-1074, -1030, -1022, -1021, -3, 0, 1, 52, 53, 1023) for f in (1.0, 1.0000000000000002, 1.5, 1.9999999999999998)]
    values += [v * rng.uniform(1, 2) for v in values if v < 1e300] + [0.0, float("inf")]
    values += [-v for v in values]
    df = table(spark, [(v,) for v in values], "x double")
    got = {r["x"]: r["k"] for r in df.select("x", ordering.ordered_key(F.col("x")).alias("k")).collect()}
    order = sorted(set(values))
    assert [got[v] for v in order] == sorted(got[v] for v in order) and len({got[v] for v in order}) == len(order)
    assert all(ordering.key_value(got[v]) == v for v in order)


def test_medians_only_of_columns_with_gaps(spark):
    df = table(spark, [(1.0, 2.0), (3.0, None), (8.0, 4.0)], "a double, b double")
    assert ordering.fit_medians(df, ["a", "b"]) == {"b": 3.0}


def test_place_in_group_when_all_rows_tie(spark):
    df = spark.range(500).select(F.col("id"), F.lit(1).alias("g"), F.lit(7).alias("x"))
    got = prep.place_in_group(df, "g", "x", "id", many_ties=True).select("id", "_place").collect()
    assert all(r["_place"] == r["id"] + 1 for r in got)


def test_splits_are_exact_disjoint_and_repeatable(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 10 < 3).cast("int").alias("y"))
    parts = prep.stratified_split(df, "id", "y", 0.2)
    counts = {(r["y"], r["part"]): r["count"] for r in parts.groupBy("y", "part").count().collect()}
    assert counts == {(1, "test"): 60, (1, "train"): 240, (0, "test"): 140, (0, "train"): 560}
    again = prep.stratified_split(df, "id", "y", 0.2)
    assert parts.exceptAll(again).count() == 0


def test_random_split_share(spark):
    share = prep.random_split(spark.range(20000), "id", 0.2).agg(F.avg((F.col("part") == "test").cast("int"))).first()[0]
    assert abs(share - 0.2) < 0.02


def test_group_folds_keep_groups_whole_and_sizes_even(spark):
    df = spark.range(1200).select(F.col("id"), F.expr("case when id < 400 then 0 else id % 40 end").alias("g"))
    folds = prep.group_folds(df, "g", 4)
    assert folds.count() == 1200
    assert folds.groupBy("g").agg(F.count_distinct("fold").alias("n")).where("n > 1").count() == 0
    assert folds.select("fold").distinct().count() == 4


def test_stratified_folds_spread_classes(spark):
    df = spark.range(300).select(F.col("id"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    got = prep.stratified_folds(df, "id", "y", 5).groupBy("fold", "y").count().collect()
    assert all(r["count"] == (20 if r["y"] else 40) for r in got)


def test_time_folds_expand_with_a_gap(spark):
    df = spark.range(60).select(F.col("id"), F.expr("date_add(date'2024-01-01', cast(id / 7 as int))").alias("day"))
    rows = prep.time_folds(df, "day", "id", k=3, gap=5).collect()
    for fold in range(3):
        train = [r["id"] for r in rows if r["fold"] == fold and r["part"] == "train"]
        test = [r["id"] for r in rows if r["fold"] == fold and r["part"] == "test"]
        assert len(test) == 15 and min(test) == 15 * (fold + 1)
        assert train == [] or max(train) == min(test) - 6


def test_scaling_of_a_constant_column(spark):
    df = table(spark, [(1.0, 4.0), (3.0, 4.0)], "a double, b double")
    got = prep.Scaling.fit(df, ["a", "b"]).transform(df).collect()
    assert [(r["a"], r["b"]) for r in got] == [(-1.0, 0.0), (1.0, 0.0)]
