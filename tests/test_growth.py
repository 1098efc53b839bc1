"""Work and memory of a task that must not grow with ties or with the tables."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortlens import session
from cohortlens.models import ordinal, survival, tune
from cohortlens.operators import recommend, vectors
from cohortlens.operators.feature_tables import ranking_samples


def brute(q, items, k):
    """First k courses by product and id; an id that is not wanted is left out wherever it occurs."""
    out = []
    for asked, x, without in zip(q["id"], q["vector"], q["without"]):
        rows = sorted((-float(np.dot(x, v)), i) for i, v in zip(items["id"], items["vector"]) if i not in (without or ()))
        out += [(asked, i, -s) for s, i in rows[:k]]
    return out


def test_items_of_equal_vector_are_scored_once():
    rng = np.random.default_rng(5)
    kinds = rng.integers(-4, 5, (30, 3)) / 4.0
    ids = np.r_[rng.permutation(5000)[:3990], [7] * 10]  # some ids stand in the catalogue many times
    items = pd.DataFrame({"id": ids, "vector": list(kinds[rng.integers(0, 30, len(ids))])})
    held = [None, [], [7], *[sorted(rng.choice(ids, n).tolist()) for n in (1, 20, 400) for _ in range(5)]]
    q = pd.DataFrame({"id": range(len(held)), "vector": list(rng.integers(-4, 5, (len(held), 3)) / 2.0), "without": held})
    scored = []

    def kernel(a, b):
        scored.append(a.shape[0] * b.shape[1])
        return a @ b

    found = vectors.block_best(q.assign(k=4), items, True, None, None, None, kernel)
    got = sorted(zip(found["query_id"], -found["score"], found["item_id"]))
    assert [(a, i, -s) for a, s, i in got] == sorted(brute(q, items, 4), key=lambda r: (r[0], -r[2], r[1]))
    assert sum(scored) <= len(q) * 30


def old_samples(spark, scores, positives, per_positive=2):
    """The ranking samples by plain loops."""
    wide = {}
    for s, c, m, x in scores:
        row = wide.setdefault((s, c), {})
        row[m] = max(row.get(m, x), x)
    good = set(positives)
    cells = lambda row: (row.get("a") or 0.0, row.get("b") or 0.0)
    out = [(s, c, *cells({} if s is None or c is None else wide.get((s, c), {})), 1) for s, c in good]
    for s in {s for s, _ in good} - {None}:
        n = sum(t == s for t, _ in good)
        other = [(c, cells(row)) for (t, c), row in wide.items() if t == s and (c is None or (t, c) not in good)]
        other.sort(key=lambda e: (-max(*e[1], 0.0), e[0] is not None, e[0] or 0))
        out += [(s, c, *x, 0) for c, x in other[: per_positive * n]]
    return sorted(map(str, out))


def test_ranking_samples_are_spread_by_student(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 200)
    keys = [None, *range(60)]
    scores = [(s, c, m, float((c or 3) * 7 % 5 - (s or 1) % 3)) for s in keys for c in [None, *range(6)] for m in "ab" if ((s or 0) + (c or 0)) % 3]
    positives = [(s, c) for s in keys for c in [None, *range(9)] if ((s or 0) * 5 + (c or 1)) % 4 == 0]
    long = spark.createDataFrame(scores + scores[:5], "student_id long, course_id long, model string, score double")
    taken = spark.createDataFrame(positives + positives[:5], "student_id long, course_id long")
    samples = ranking_samples(long, taken)
    got = [(r["student_id"], r["course_id"], r["a"], r["b"], r["label"]) for r in samples.collect()]
    assert samples.columns == ["student_id", "course_id", "a", "b", "label", "query_id"]
    assert sorted(map(str, got)) == old_samples(spark, scores, positives)
    assert len(samples.groupBy(F.spark_partition_id()).count().collect()) > 3


def test_spread_keeps_small_tables_and_cuts_large_ones(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    ids = spark.range(1000).coalesce(1)
    assert session.spread(ids, 100, "id") is ids
    assert max(r["count"] for r in session.spread(ids, 1000, "id").groupBy(F.spark_partition_id()).count().collect()) < 500


def test_scores_beside_the_lists_are_spread(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 200)
    long = spark.createDataFrame([(s, c, m, s + c / 8) for s in range(300) for c in range(4) for m in ("a", "b")], "student_id long, course_id long, model string, score double")
    wide = recommend.scores_by_model(recommend.ensemble(long, {"a": 1, "b": 1}, 3), long, ["a", "b"])
    rows = wide.collect()
    assert len(rows) == 900 and all(r["a"] == r["b"] == r["student_id"] + r["course_id"] / 8 for r in rows)
    assert len(wide.groupBy(F.spark_partition_id()).count().collect()) > 3


def test_person_weeks_are_spread(spark, monkeypatch):
    people = spark.range(80).selectExpr("id AS student_id", "cast(1 + id % 6 AS int) AS time", "cast(id % 2 AS int) AS event", "id % 9 / 9 AS x").coalesce(1)
    plain = survival.fit_hazard(people, "time", "event", ["x"], weeks=6, rounds=1, depth=2).survival(people)
    want = sorted((r["student_id"], r["time"], round(r["survival"], 9)) for r in plain.collect())
    monkeypatch.setattr(session, "TASK_ROWS", 60)
    cut = survival.fit_hazard(people, "time", "event", ["x"], weeks=6, rounds=1, depth=2).survival(people)
    assert sorted((r["student_id"], r["time"], round(r["survival"], 9)) for r in cut.collect()) == want
    sizes = [r["count"] for r in cut.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 3 and sum(sizes) == 480


@pytest.mark.parametrize("strategy", ["stratified", "group"])
def test_folds_are_kept_once(spark, monkeypatch, strategy):
    table = spark.range(120).selectExpr("id AS student_id", "cast(id % 2 AS int) AS y", "id % 11 AS course_id", "'x' AS part")
    kept = []
    monkeypatch.setattr(tune, "reliable_checkpoint", lambda df: kept.append(df.count()) or session.reliable_checkpoint(df))
    trainer = lambda train, params: lambda test: test.withColumns({"score": F.col("y") / 2, "y_pred": F.col("y")})
    rows = tune.cross_validate(table, "y", trainer, strategy=strategy, scoring="accuracy", k=4, group="course_id").collect()
    whole = tune.folds_of(table, strategy, "student_id", "y", 4, group="course_id")
    want = {(r["fold"], r["part"]): r["count"] for r in whole.groupBy("fold", "part").count().collect()}
    assert kept[0] == 120 and max(kept) == 120
    assert {(r["fold"], p): r[n] for r in rows for p, n in (("train", "n_train"), ("test", "n_val"))} == want


def test_rows_of_the_ordinal_model_are_made_once(spark):
    """All boosters learn from one reading of the features, and their threshold comes with it."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(len(batch))
            yield batch

    rows = spark.range(300).selectExpr("id AS student_id", "cast(id % 4 AS int) AS level", "id % 4 + id % 3 / 9 AS x")
    fitted = ordinal.fit_ordinal(rows.mapInPandas(count, rows.schema), "level", ["x"], 4, rounds=2, depth=2)
    assert made.value == 300
    assert all(r["p"] == r["level"] for r in fitted.transform(rows).collect())
