"""Recommenders against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.models import collaborative, hybrid, ranker
from cohortlens.operators import mmr as mmr_module
from cohortlens.operators import recommend, text, vectors


def points(spark, n, seed, dims=5):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(v) for v in rng.normal(size=dims)]) for i in range(n)]
    rows[1] = (1, rows[0][1])
    return rows, spark.createDataFrame(rows, "id long, vector array<double>")


@pytest.mark.parametrize("blocks", [(16384, 4096), (7, 11)])
def test_nearest_against_all_pairs(spark, monkeypatch, blocks):
    """Whatever the blocks, the lists are those of all pairs."""
    monkeypatch.setattr(vectors, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(vectors, "ITEM_BLOCK", blocks[1])
    a, left = points(spark, 30, 1)
    b, right = points(spark, 50, 2)
    got = {}
    for r in vectors.most_similar(left, right, 4).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["item_id"])
    unit = lambda v: np.array(v) / np.linalg.norm(v)
    for i, v in a:
        scored = sorted((-round(float(unit(v) @ unit(w)), 6), j) for j, w in b)
        assert got[i] == [j for _, j in scored[:4]]


def test_products_by_boxes_are_those_of_all_pairs():
    """Ties, repeated and zero vectors, other numbers wanted, and the query itself left out."""
    rng = np.random.default_rng(6)
    x = np.round(rng.normal(size=(3000, 4)), 1)
    x[:900], x[900:950] = x[1], 0
    ids = rng.permutation(len(x)).astype(np.int64)
    items = vectors.pd.DataFrame({"id": ids, "vector": list(x)})
    asked = items.iloc[::10].assign(k=np.arange(300) % 40 + 1)
    for same, lower, decimals in ((True, None, 6), (False, None, None), (False, 0.0, 3)):
        found = vectors.block_best(asked, items, same, lower, None, decimals, np.matmul)
        got = {q: list(zip(f["item_id"], f["score"])) for q, f in found.groupby("query_id")}
        for q, v, k in zip(asked["id"], asked["vector"], asked["k"]):
            scores = x @ v if lower is None else np.clip(x @ v, lower, 1.0)
            scores = np.round(scores, decimals) if decimals else np.round(scores, 12)
            want = sorted((-s, i) for s, i in zip(scores, ids) if same or i != q)[:k]
            if decimals:
                assert [i for i, _ in got[q]] == [i for _, i in want]
            assert np.allclose([s for _, s in got[q]], [-s for s, _ in want])


def test_few_boxes_are_scored():
    rng = np.random.default_rng(7)
    x, scored = rng.normal(size=(20_000, 3)), []

    def kernel(a, b):
        scored.append(a.shape[0] * b.shape[1])
        return a @ b

    items = vectors.pd.DataFrame({"id": np.arange(len(x)), "vector": list(x)})
    found = vectors.block_best(items.iloc[:2000].assign(k=5), items, True, None, None, None, kernel)
    assert len(found) == 10_000 and sum(scored) < 0.3 * 2000 * len(x)


def test_copies_of_items_do_not_grow_with_the_blocks_of_queries(spark):
    """Few large blocks: neither side is shuffled more than a few times."""
    assert vectors.blocks_of(spark.range(300_000), vectors.BLOCK_NUMBERS // 64) <= 5


def test_sides_are_copied_as_often_at_any_size():
    """The blocks grow with the table, so that the copies of a side don't grow, up to blocks of 2**18 rows."""
    for rows in (60_000, 600_000, 1_800_000):
        least = -(-rows // min(vectors.LARGE_BLOCK_ROWS, vectors.LARGE_BLOCK_NUMBERS // 64))
        n_query, n_item = vectors.block_counts(rows, rows, least, least, 100, 64, 3)
        assert n_query + n_item <= 14 and n_query * n_item >= vectors.BLOCK_PAIRS
    assert vectors.block_counts(900_000, 2000, 4, 1, 100, 64, 5) == (vectors.BLOCK_PAIRS, 1)
    assert vectors.block_counts(0, 0, 1, 1, 100, 64, 5) == (1, 1)


def test_vectors_of_single_precision_move_as_they_are(spark, monkeypatch):
    rng = np.random.default_rng(13)
    x = rng.normal(size=(3000, 6)).astype(np.float32)
    x[7], x[9] = 0, 2 * x[8]
    df = spark.createDataFrame([(i, [float(n) for n in v]) for i, v in enumerate(x)], "id long, vector array<float>")
    assert vectors.with_length(df, None).schema["vector"].dataType.elementType.simpleString() == "float"
    monkeypatch.setattr(vectors, "ITEM_BLOCK", 500)
    monkeypatch.setattr(vectors, "BLOCK_NUMBERS", 3000)
    monkeypatch.setattr(vectors, "LARGE_BLOCK_ROWS", 1000)
    got = {}
    for r in vectors.most_similar(df, df, 3, same=False).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["item_id"], r["score"]))
    d = x.astype(float)
    d /= np.where((n := np.sqrt((d * d).sum(1))) > 0, n, 1)[:, None]
    for i in (*range(0, 3000, 100), 7, 8, 9):
        want = sorted((-round(float(s), 6), j) for j, s in enumerate(d @ d[i]) if j != i)[:3]
        assert got[i] == [(j, -s) for s, j in want]


def test_nearest_leaves_out_the_query_and_handles_zero(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.0])], "id long, vector array<double>")
    got = {(r["query_id"], r["item_id"]): r["score"] for r in vectors.most_similar(df, df, 2, same=False).collect()}
    assert got[(2, 3)] == 1.0 and got[(1, 2)] == 0.0 and (1, 1) not in got and len(got) == 6


def test_random_lists(spark):
    students = spark.range(40).withColumnRenamed("id", "student_id")
    for n_courses in (5, 30, 500):
        courses = spark.range(n_courses).withColumnRenamed("id", "course_id")
        one = recommend.random_courses(students, courses, 4)
        per = one.groupBy("student_id").agg(F.count_distinct("course_id").alias("n")).collect()
        assert len(per) == 40 and all(r["n"] == 4 for r in per)
        assert one.exceptAll(recommend.random_courses(students, courses, 4)).count() == 0
        assert one.exceptAll(recommend.random_courses(students, courses, 4, seed=7)).count() > 0


def test_random_lists_do_not_broadcast_the_catalogue(spark, capsys):
    """Even a catalogue below the threshold for broadcasts is shuffled, as its size is only estimated."""
    students = spark.range(40).withColumnRenamed("id", "student_id")
    recommend.random_courses(students, spark.range(500).withColumnRenamed("id", "course_id"), 4).explain()
    plan = capsys.readouterr().out
    by_position = next(line for line in plan.splitlines() if "Join" in line and "_position" in line)
    by_draw = next(line for line in plan.splitlines() if "Join" in line and "_draw" in line)
    assert "SortMergeJoin" in by_position and "SortMergeJoin" in by_draw


def test_fusion_uses_the_models_a_student_has(spark):
    rows = [(1, 10, "a", 0.8), (1, 11, "a", 0.2), (1, 10, "b", 0.4), (2, 10, "a", 0.6)]
    df = spark.createDataFrame(rows, "student_id int, course_id int, model string, score double")
    got = {(r["student_id"], r["course_id"]): r["score"] for r in recommend.fuse(df, {"a": 3, "b": 1}, 5).collect()}
    assert got[1, 10] == pytest.approx((3 * 0.8 + 0.4) / 4) and got[1, 11] == pytest.approx(0.6 / 4) and got[2, 10] == pytest.approx(0.6)


def test_weights_are_normalised():
    assert recommend.normalised({"a": 1, "b": 3}) == {"a": 0.25, "b": 0.75}
    with pytest.raises(ValueError):
        recommend.normalised({"a": 0})


def greedy(items, vecs, n, weight):
    picked, rest = [], list(items)
    while rest and len(picked) < n:
        best = None
        for c, rel in rest:
            near = 0.0
            for p, _ in picked:
                a, b = vecs.get(c), vecs.get(p)
                if a is not None and b is not None and np.linalg.norm(a) and np.linalg.norm(b):
                    near = max(near, (a @ b / np.linalg.norm(a) / np.linalg.norm(b) + 1) / 2)
            value = weight * rel - (1 - weight) * near
            if best is None or value > best[1]:
                best = (c, value)
        picked.append(best)
        rest = [r for r in rest if r[0] != best[0]]
    return picked


def test_diverse_lists_against_greedy(spark):
    rng = random.Random(6)
    vecs = {c: np.array([rng.gauss(0, 1) for _ in range(3)]) for c in range(12)}
    vecs[3] = np.zeros(3)
    lists = {s: sorted(((c, rng.random()) for c in rng.sample(range(14), 3 + s)), key=lambda x: -x[1]) for s in range(6)}
    rows = [(s, c, i + 1, v) for s, items in lists.items() for i, (c, v) in enumerate(items)]
    listed = spark.createDataFrame(rows, "student_id long, course_id long, rank int, score double")
    table = spark.createDataFrame([(c, [float(x) for x in v]) for c, v in vecs.items()], "course_id long, vector array<double>")
    got = {}
    for r in mmr_module.mmr(listed, table, 5, 0.6).orderBy("student_id", "rank").collect():
        got.setdefault(r["student_id"], []).append((r["course_id"], r["score"]))
    for s, items in lists.items():
        want = greedy(items, vecs, 5, 0.6)
        assert [c for c, _ in got[s]] == [c for c, _ in want]
        assert [v for _, v in got[s]] == pytest.approx([v for _, v in want])


def test_single_item_keeps_its_score(spark):
    listed = spark.createDataFrame([(1, 5, 1, 0.9)], "student_id long, course_id long, rank int, score double")
    table = spark.createDataFrame([(5, [1.0])], "course_id long, vector array<double>")
    assert mmr_module.mmr(listed, table, 3).first()["score"] == 0.9


@pytest.fixture(scope="module")
def factors(campus):
    return collaborative.fit_factors(campus.interactions, rank=4, max_iter=3)


def test_factor_lists_are_complete_and_untaken(spark, campus, factors):
    """Against scoring every pair, also for a student who took nearly everything."""
    courses = campus.courses.select("course_id")
    all_ids = [r[0] for r in factors.courses.select("course_id").collect()]
    hog = spark.createDataFrame([(7, int(x)) for x in all_ids[:-2]], "student_id long, course_id long")
    taken = campus.interactions.select("student_id", "course_id").unionByName(hog).distinct()
    students = spark.createDataFrame([(7,), (8,), (999_999,)], "student_id long")
    got = {}
    for r in factors.recommend(students, taken, 5).orderBy("student_id", "rank").collect():
        got.setdefault(r["student_id"], []).append((r["course_id"], r["score"]))
    held = {}
    for r in taken.where(F.col("student_id").isin(7, 8, 999_999)).collect():
        held.setdefault(r[0], set()).add(r[1])
    pairs = students.crossJoin(courses.where(F.col("course_id").isin([int(x) for x in all_ids])))
    scored = {}
    for r in factors.score(pairs).collect():
        scored.setdefault(r["student_id"], {})[r["course_id"]] = r["score"]
    for s in (7, 8, 999_999):
        open_ = {c: v for c, v in scored[s].items() if c not in held.get(s, set())}
        want = sorted(open_.values(), reverse=True)[:5]
        assert [v for _, v in got.get(s, [])] == pytest.approx(want, abs=1e-5)
        assert not {c for c, _ in got.get(s, [])} & held.get(s, set())
    assert len(got[7]) <= 2 and len(got[999_999]) == 5


def test_factors_beat_the_mean(campus, factors):
    rated = factors.score(campus.interactions.select("student_id", "course_id", "rating"))
    row = rated.agg(
        F.avg((F.col("score") - F.col("rating")) ** 2).alias("mse"), F.var_pop("rating").alias("var")
    ).first()
    assert row["mse"] < row["var"]


def test_negatives_are_not_positives(campus):
    rows = collaborative.with_negatives(campus.enrollments, campus.courses)
    assert rows.groupBy("student_id", "course_id").count().where("count > 1").count() == 0
    assert rows.where("label = 0").count() > 0


def test_neural_and_hybrid_scores_are_probabilities(campus, factors):
    pairs = campus.enrollments.select("student_id", "course_id")
    neural = collaborative.fit_neural(campus.enrollments, campus.courses, factors, max_iter=5).score(pairs)
    people = campus.students.join(campus.qualifications, "student_id")
    side = collaborative.fit_hybrid(campus.enrollments, people, campus.courses, ["gender"], ["department"], max_iter=2).score(pairs)
    for scored in (neural, side):
        row = scored.agg(F.min("score").alias("lo"), F.max("score").alias("hi"), F.count("*").alias("n")).first()
        assert 0 <= row["lo"] <= row["hi"] <= 1 and row["n"] == pairs.count()


def scores(spark):
    rows = [(s, c, m, float((s * 7 + c * 3 + len(m)) % 10) / 10) for s in range(20) for c in range(8) for m in ("a", "bb")]
    return spark.createDataFrame(rows, "student_id long, course_id long, model string, score double")


def test_ranker_prefers_the_enrolled(spark):
    table = scores(spark)
    liked = table.where("model = 'a' and score >= 0.8").select("student_id", "course_id")
    fitted = ranker.fit_ranker(table, liked)
    first = fitted.recommend(table, 1).join(liked, ["student_id", "course_id"], "left_semi")
    assert first.count() >= 0.8 * liked.select("student_id").distinct().count()


@pytest.mark.parametrize("mode", ["ensemble", "ltr", "mmr", "hybrid"])
def test_hybrid_modes(spark, mode):
    table = scores(spark).withColumn("model", F.when(F.col("model") == "a", "content_based").otherwise("popularity"))
    vectors_ = spark.range(8).select(F.col("id").alias("course_id"), F.array(F.col("id").cast("double"), F.lit(1.0)).alias("vector"))
    routes = spark.range(20).select(
        F.col("id").alias("student_id"),
        F.when(F.col("id") < 10, "matrix_factorization").when(F.col("id") < 15, "content_based").otherwise("popularity").alias("route"),
    )
    learned = None
    if mode == "ltr":
        learned = ranker.fit_ranker(table, table.where("score >= 0.8").select("student_id", "course_id").distinct())
    served = hybrid.HybridRecommender(table, {"content_based": 1, "popularity": 1}, vectors_, mode, learned)
    per = served.recommend(routes, 3).groupBy("student_id").agg(F.count("*").alias("n"), F.max("rank").alias("r")).collect()
    assert len(per) == 20 and all(r["n"] == 3 and r["r"] == 3 for r in per)


def test_unknown_mode_and_missing_ranker(spark):
    table = scores(spark)
    routes = spark.createDataFrame([(1, "matrix_factorization")], "student_id long, route string")
    with pytest.raises(ValueError):
        hybrid.HybridRecommender(table, {"a": 1}, table, "odd").recommend(routes)
    with pytest.raises(ValueError):
        hybrid.HybridRecommender(table, {"a": 1}, table, "ltr").recommend(routes)


def test_terms_and_empty_text(spark):
    docs = spark.createDataFrame([(1, "The Data of Science data"), (2, "data science"), (3, "x")], "id long, text string")
    fitted = text.TfIdf(docs, min_df=1, max_df=1.0)
    words = {(r["id"], r["term"]): r["weight"] for r in fitted.weights(docs).collect()}
    assert (1, "data science") in words and (1, "science data") in words and (1, "the") not in words
    assert all(i != 3 for i, _ in words)
    assert sum(w * w for (i, _), w in words.items() if i == 2) == pytest.approx(1.0)
    found = {r["query_id"]: (r["item_id"], r["score"]) for r in fitted.most_similar(docs, docs, 1).collect()}
    assert found[2] == (2, 1.0) and found[3] == (1, 0.0)


def test_profiles_share_one_query(spark):
    people = spark.createDataFrame([(i, [1.0, 0.0] if i % 3 else [0.0, 1.0]) for i in range(30)], "id long, vector array<double>")
    items = spark.createDataFrame([(1, [1.0, 0.1]), (2, [0.1, 1.0])], "id long, vector array<double>")
    got = {r["query_id"]: r["item_id"] for r in vectors.most_similar_by_profile(people, items, 1).collect()}
    assert got == {i: 1 if i % 3 else 2 for i in range(30)}


def test_popular_lists_are_not_made_by_the_few_tasks_that_read_the_students(spark, monkeypatch):
    monkeypatch.setattr(recommend, "LISTED_ROWS", 500)
    students = spark.range(400).select(F.col("id").alias("student_id")).coalesce(1)
    courses = spark.createDataFrame([(i, float(i % 4)) for i in range(9)], "course_id long, score double")
    listed = recommend.popular_for_all(students, courses, 5)
    sizes = listed.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 4 and max(r["count"] for r in sizes) < 1000
    got = {(r["student_id"], r["rank"]): (r["course_id"], r["score"]) for r in listed.collect()}
    best = [(3, 3.0), (7, 3.0), (2, 2.0), (6, 2.0), (1, 1.0)]
    assert got == {(s, k + 1): best[k] for s in range(400) for k in range(5)}


def test_wide_scores_are_the_pivot(spark):
    rows = [(s, c, m, float(c * (s or 3) % 5)) for s in (1, 2, None) for c in range(4) for m in ("a", "b.c", None) if m != "a" or c != s]
    long = spark.createDataFrame(rows + rows[:3], "student_id long, course_id long, model string, score double")
    want = long.groupBy("student_id", "course_id").pivot("model", ["a", "b.c"]).agg(F.max("score"))
    got = recommend.wide_scores(long, ["a", "b.c"])
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
