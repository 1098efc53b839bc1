"""Lists of the hybrid and the neural model: equal to scoring every pair."""

import numpy as np
import pytest
from pyspark.ml.classification import FMClassifier, MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohortlens.models import collaborative
from cohortlens.operators import vectors

BIG = 10**11


@pytest.fixture(scope="module")
def world(spark):
    """Students and courses with ids beyond 32 bits, some pairs, and a student without any."""
    students = spark.range(40).select((F.col("id") + BIG).alias("student_id"), (F.col("id") % 3).cast("string").alias("kind"))
    courses = spark.range(25).select((F.col("id") * 7 + BIG).alias("course_id"), (F.col("id") % 4).cast("string").alias("field"))
    pairs = spark.range(39).select((F.col("id") + BIG).alias("student_id"), F.explode(F.array(*[F.lit(k) for k in range(3)])).alias("k"))
    taken = pairs.select("student_id", ((((F.col("student_id") - BIG) * 5 + F.col("k") * 4) % 25) * 7 + BIG).alias("course_id")).distinct()
    return students.persist(), courses.persist(), taken.persist()


def best_by_pairs(model, students, courses, taken, n):
    every = students.select("student_id").crossJoin(courses.select("course_id"))
    open_ = model.score(every).join(taken, ["student_id", "course_id"], "left_anti").collect()
    lists = {}
    for r in open_:
        lists.setdefault(r["student_id"], []).append((-round(r["score"], 9), r["course_id"]))
    return {s: [(k, x) for x, k in sorted(v)[:n]] for s, v in lists.items()}


def check_lists(model, world, n):
    """The candidates are the courses that the model knows."""
    students, courses, taken = world
    courses = courses.join(model.factors.courses if hasattr(model, "factors") else model.courses, "course_id", "left_semi")
    got = {}
    for r in model.recommend(students, taken, n).orderBy("student_id", "rank").collect():
        got.setdefault(r["student_id"], []).append((r["course_id"], -round(r["score"], 9)))
    want = best_by_pairs(model, students, courses, taken, n)
    assert got.keys() == want.keys() and len(got) == 40
    for s, listed in got.items():
        assert len(listed) == n
        assert [x for _, x in listed] == pytest.approx([x for _, x in want[s]], abs=2e-9)
        # of equal scores the order may differ in the last digit only
        assert {k for k, x in listed if x < want[s][-1][1] - 1e-8} == {k for k, x in want[s] if x < want[s][-1][1] - 1e-8}


def test_hybrid_scores_are_those_of_the_machine(spark, world, monkeypatch):
    students, courses, taken = world
    kept = {}
    fit = FMClassifier.fit

    def keep(self, rows, *args):
        kept["model"], kept["rows"] = fit(self, rows, *args), rows
        return kept["model"]

    monkeypatch.setattr(FMClassifier, "fit", keep)
    pairs = {}
    draw = collaborative.with_negatives
    monkeypatch.setattr(collaborative, "with_negatives", lambda *a, **k: pairs.setdefault("rows", draw(*a, **k).orderBy("student_id", "course_id").persist()))
    model = collaborative.fit_hybrid(taken, students, courses, ["kind"], ["field"], factors=3, max_iter=5)
    probability = kept["model"].transform(kept["rows"]).select(vector_to_array("probability")[1].alias("p")).collect()
    assert sorted(round(r["p"], 9) for r in probability) == pytest.approx(sorted(round(r["score"], 9) for r in model.score(pairs["rows"]).collect()), abs=2e-9)
    assert kept["model"].numFeatures == 39 + 3 + 25 + 4
    check_lists(model, world, 6)


def test_neural_scores_are_those_of_the_perceptron(spark, world, monkeypatch):
    students, courses, taken = world
    ratings = taken.withColumn("rating", (F.col("course_id") % 5).cast("double"))
    factors = collaborative.fit_factors(ratings, rank=3, max_iter=2)
    kept = {}
    fit = MultilayerPerceptronClassifier.fit
    monkeypatch.setattr(MultilayerPerceptronClassifier, "fit", lambda self, rows, *a: kept.setdefault("model", fit(self, rows, *a)))
    model = collaborative.fit_neural(taken, courses, factors, hidden=4, max_iter=5)
    every = students.select("student_id").crossJoin(courses.select("course_id"))
    ready = collaborative.side_by_side(every, factors)
    want = {(r[0], r[1]): r[2] for r in kept["model"].transform(ready).select("student_id", "course_id", vector_to_array("probability")[1]).collect()}
    got = {(r["student_id"], r["course_id"]): r["score"] for r in model.score(every).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in got)
    check_lists(model, world, 5)


def test_factor_lists_with_large_ids(world):
    students, courses, taken = world
    ratings = taken.withColumn("rating", (F.col("course_id") % 5).cast("double"))
    check_lists(collaborative.fit_factors(ratings, rank=3, max_iter=2), world, 4)


def test_ranks_on_full_scores():
    part = vectors.pd.DataFrame({"id": [1], "vector": [np.array([1.0])], "k": [1]})
    items, ids = np.array([[0.5], [0.5 + 1e-9]]), np.array([10, 11])
    assert vectors.chunk_best(part, items, ids, True, None, None, None)["item_id"].tolist() == [11]
    assert vectors.chunk_best(part, items, ids, True, None, None)["item_id"].tolist() == [10]


def test_ceilings_are_above_all_scores_of_a_box():
    rng = np.random.default_rng(3)
    outer = np.array([2.0, -1.5, 0.5])
    a, b = rng.normal(size=(20, 3)), rng.normal(size=(50, 3))
    top = collaborative.perceptron_ceilings(a, b.min(0)[None], b.max(0)[None], outer, 0.25)
    assert (top[:, 0] >= collaborative.perceptron(a, b.T, outer, 0.25).max(1)).all()
    assert (vectors.product_ceilings(a, b.min(0)[None], b.max(0)[None])[:, 0] >= (a @ b.T).max(1) - 1e-12).all()


def test_taken_courses_do_not_leave_a_block(spark):
    """Every course but three is taken, and only those three are found."""
    rng = np.random.default_rng(8)
    rows = [(i, [float(v) for v in rng.normal(size=3)]) for i in range(600)]
    items = spark.createDataFrame(rows, "id long, vector array<double>")
    asked = spark.createDataFrame([(1, rows[1][1], [i for i in range(700) if i not in (5, 77, 400)]), (2, rows[2][1], None), (3, rows[3][1], [])], "id long, vector array<double>, without array<long>")
    got = {}
    for r in vectors.best_products(asked, items, 4, decimals=None).collect():
        got.setdefault(r["query_id"], []).append((-r["score"], r["item_id"]))
    score = lambda q, i: sum(a * b for a, b in zip(rows[q][1], rows[i][1]))
    want = {1: [5, 77, 400], 2: range(600), 3: range(600)}
    assert {q: [i for _, i in sorted(f)] for q, f in got.items()} == {q: sorted(w, key=lambda i: -score(q, i))[:4] for q, w in want.items()}


def test_an_unwanted_item_goes_to_its_own_block_and_short_vectors_lie_in_bounded_blocks(spark, monkeypatch):
    def counted(q, i, **options):
        here, n = set(i["id"].to_pylist()), [x for w in q["without"].to_pylist() for x in w or []]
        assert here.issuperset(n)
        return vectors.pa.table([[0], [len(n)], [float(max(q.num_rows, i.num_rows))]], ["query_id", "item_id", "score"])

    for name, rows in (("ITEM_BLOCK", 50), ("LARGE_BLOCK_ROWS", 50), ("SHORT_BLOCK_ROWS", 100)):
        monkeypatch.setattr(vectors, name, rows)
    monkeypatch.setattr(vectors, "table_best", counted)
    items = spark.range(600).select("id", F.array(F.col("id") * 0.5, F.lit(1.0)).alias("vector"))
    asked = items.withColumn("without", F.transform(F.sequence(F.lit(0), F.lit(3)), lambda j: (F.col("id") * 7 + j) % 600))
    found = vectors.best_products(asked, items, 4, decimals=None).collect()
    assert len(found) >= 36 and sum(r["item_id"] for r in found) == 4 * 600 and max(r["score"] for r in found) <= 150


def test_tables_of_a_block_are_searched_like_its_rows():
    rng = np.random.default_rng(5)
    ids, x = np.arange(3000) * 3 + 2**60, rng.integers(0, 4, (3000, 3)) / 4
    lists = [None if j % 5 == 0 else rng.choice(ids, j % 7).tolist() for j in range(2000)]
    frames = vectors.pd.DataFrame({"id": ids[:2000], "vector": list(x[:2000]), "without": lists}), vectors.pd.DataFrame({"id": ids, "vector": list(x)})
    tables = [vectors.pa.table({"id": f["id"].tolist(), "vector": [v.tolist() for v in f["vector"]], **({"without": lists} if "without" in f else {})}) for f in frames]
    for same in (True, False):
        options = {"same": same, "lower": None, "decimals": None, "kernel": np.matmul, "ceilings": vectors.product_ceilings}
        want = vectors.block_best(frames[0].assign(k=4), frames[1], dims=None, **options)
        got = vectors.table_best(*tables, k=4, **options).to_pandas()
        assert len(got) > 7000 and got.equals(want.astype(got.dtypes))
    empty = vectors.table_best(tables[0], tables[1].slice(0, 0), k=4, **options)
    assert empty.num_rows == 0 and [str(t) for t in empty.schema.types] == ["int64", "int64", "double"]


def test_single_precision_leaves_no_pair_out():
    rng = np.random.default_rng(11)
    for spread in (0.01, 1.0, 12.0, 80.0, 500.0):
        a, b = rng.normal(size=(60, 5)) * spread, rng.normal(size=(5, 90)) * spread
        outer = rng.normal(size=5) * 3
        kernel = collaborative.PerceptronKernel(outer, -0.5)
        with np.errstate(over="ignore"):
            plain = 1 / (1 + np.exp(0.5 - sum(w / (1 + np.exp(-(a[:, h, None] + b[None, h]))) for h, w in enumerate(outer))))
            scores = kernel(a, b)
            assert np.allclose(scores, plain, rtol=0, atol=1e-13)
            for least in (scores[:, 3], np.sort(scores, 1)[:, -4], np.zeros(60), np.full(60, -np.inf), np.ones(60)):
                at, c, s = kernel.above(a, b, least)
                want = np.nonzero(scores >= least[:, None])
                assert (at == want[0]).all() and (c == want[1]).all() and (s == scores[want]).all()
    few = kernel.above(np.zeros((1, 5)), rng.normal(size=(5, 50)), np.array([1.0]))
    assert len(few[0]) == 0


def test_many_ratings_are_cut_into_more_blocks_and_turns_are_kept(world, monkeypatch):
    students, courses, taken = world
    ratings = taken.withColumn("rating", (F.col("course_id") % 5).cast("double"))
    asked, plain = [], collaborative.ALS
    monkeypatch.setattr(collaborative, "ALS", lambda **options: asked.append(options) or plain(**options))
    n = ratings.count()
    for most, blocks in ((collaborative.BLOCK_RATINGS, 10), (n // 12, -(-n // (n // 12)))):
        monkeypatch.setattr(collaborative, "BLOCK_RATINGS", most)
        found = collaborative.fit_factors(ratings, rank=2, max_iter=2)
        assert (asked[-1]["numUserBlocks"], asked[-1]["numItemBlocks"], asked[-1]["checkpointInterval"]) == (blocks, blocks, 1)
        assert found.students.count() == ratings.select("student_id").distinct().count()
    assert blocks > 10
