import numpy as np
import pytest
from pyspark.ml.classification import FMClassifier
from pyspark.sql import functions as F

from cohortlens.models import collaborative, machine
from cohortlens.operators.sparse import LevelTable


@pytest.fixture(scope="module")
def world(spark):
    """A student without pairs and one with two rows, a course without pairs, missing kinds."""
    kinds = [None, "a", "b", "c"]
    students = spark.createDataFrame([(i, kinds[i % 4]) for i in range(1, 31)] + [(7, "b")], "student_id long, kind string")
    courses = spark.createDataFrame([(i, f"f{i % 3}") for i in range(100, 116)], "course_id long, field string")
    taken = spark.createDataFrame([(s, 100 + s * k % 15) for s in range(1, 30) for k in (1, 4)], "student_id long, course_id long")
    return students, courses, taken


def no_trainer(*args):
    raise AssertionError("trained on the driver")


def fitted(world, **options):
    students, courses, taken = world
    of_students = LevelTable.fit(students.join(taken, "student_id", "left_semi"), ["student_id", "kind"])
    of_courses = LevelTable.fit(courses, ["course_id", "field"], first=of_students.size)
    pairs = collaborative.with_negatives(taken, courses).localCheckpoint()
    intercept, table = machine.fit_machine(pairs, students, courses, of_students, of_courses, **options)
    got = {r["position"]: (r["weight"], *r["vector"]) for r in table.collect()}
    placed = of_courses.positions(of_students.positions(collaborative.with_sides(pairs, students, courses), "_s"), "_c")
    rows = placed.select(F.concat("_s", "_c").alias("at"), "label").collect()
    size = of_students.size + of_courses.size
    assert sorted(got) == list(range(size))
    return intercept, np.array([got[i] for i in range(size)]), rows


def by_hand(rows, x, turns, step=0.05):
    """The same steps with all coefficients in one array; the intercept stands behind them."""
    at = np.zeros((len(rows), len(x)))
    for i, r in enumerate(rows):
        at[i, r["at"]] = 1
    y = np.array([r["label"] for r in rows])
    w0 = 0.0
    m, v = np.zeros(x.size + 1), np.zeros(x.size + 1)
    for turn in range(1, turns + 1):
        sums = at @ x[:, 1:]
        raw = w0 + at @ x[:, 0] + ((sums**2).sum(1) - at @ (x[:, 1:] ** 2).sum(1)) / 2
        miss = 1 / (1 + np.exp(-raw)) - y
        slopes = np.column_stack([at.T @ miss, at.T @ (miss[:, None] * sums) - (at.T @ miss)[:, None] * x[:, 1:]])
        g = np.append(slopes.ravel(), miss.sum()) / len(rows)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = step * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.999**turn)) + 1e-8)
        x, w0 = x - move[:-1].reshape(x.shape), w0 - move[-1]
    return w0, x


@pytest.mark.parametrize("few", [0, machine.FEW_LEVELS])
def test_table_machine_takes_the_steps_by_hand(world, monkeypatch, few):
    monkeypatch.setattr(machine, "FEW_LEVELS", few)
    zero, start, rows = fitted(world, factors=3, max_iter=0)
    assert zero == 0 and np.abs(start[:, 1:]).max() > 0 and (start[:, 0] == 0).all()
    intercept, got, _ = fitted(world, factors=3, max_iter=4)
    want_intercept, want = by_hand(rows, start, 4)
    assert intercept == pytest.approx(want_intercept, abs=1e-9)
    assert got == pytest.approx(want, abs=1e-9)


def test_table_machine_is_sparks_where_nothing_is_drawn(spark, world):
    intercept, got, rows = fitted(world, factors=2, max_iter=6, deviation=0.0)
    from pyspark.ml.linalg import Vectors

    ready = spark.createDataFrame([(Vectors.sparse(len(got), sorted(r["at"]), [1.0] * len(r["at"])), r["label"]) for r in rows], ["features", "label"])
    model = FMClassifier(factorSize=2, maxIter=6, stepSize=0.05, initStd=1e-30).fit(ready)
    assert intercept == pytest.approx(model.intercept, abs=1e-9)
    assert got[:, 0] == pytest.approx(model.linear.toArray(), abs=1e-9)


def test_many_levels_are_not_trained_on_the_driver(world, monkeypatch):
    students, courses, taken = world
    monkeypatch.setattr(collaborative, "DRIVER_LEVELS", 10)
    monkeypatch.setattr(FMClassifier, "fit", no_trainer)
    model = collaborative.fit_hybrid(taken, students.dropDuplicates(["student_id"]), courses, ["kind"], ["field"], max_iter=3)
    scored = model.score(taken).collect()
    assert len(scored) == taken.count() and all(0 < r["score"] < 1 for r in scored)
