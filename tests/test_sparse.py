"""Sparse one-hot features: any number of levels, against SQL."""

import duckdb
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from cohortlens.operators import categories, course, feature_tables, sparse, student

N = 50_000


@pytest.fixture(scope="module")
def wide(spark):
    """50,000 levels in one column, a hot level and missing values in the other."""
    key = F.col("id")
    return spark.range(N + 5000).select(
        key.alias("row"),
        F.concat(F.lit("level-"), key % N).alias("a"),
        F.when(key % 3 == 0, "hot").when(key % 7 == 0, None).otherwise((key % 900).cast("string")).alias("b"),
    )


@pytest.mark.parametrize("drop_first", [False, True])
def test_50000_levels_equal_sql(spark, wide, drop_first):
    known = sparse.LevelTable.fit(wide, ["a", "b"], drop_first=drop_first, missing="Unknown")
    got = known.pairs(wide, "row").toPandas()
    gone = "WHERE (i, level) NOT IN (SELECT (i, MIN(level)) FROM kinds GROUP BY i)" if drop_first else ""
    con = duckdb.connect()
    con.register("pairs", got)
    con.execute(f"""CREATE TABLE want AS WITH wide AS (SELECT id AS row, 'level-' || (id % {N}) AS a,
          CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE CAST(id % 900 AS VARCHAR) END AS b FROM range({N + 5000}) t(id)),
        long AS (SELECT row, 0 AS i, 'a' AS "column", a AS level FROM wide UNION ALL SELECT row, 1, 'b', COALESCE(b, 'Unknown') FROM wide),
        kinds AS (SELECT DISTINCT i, level FROM long),
        numbered AS (SELECT i, level, ROW_NUMBER() OVER (ORDER BY i, level) - 1 AS position FROM kinds {gone})
        SELECT row, position, "column", level FROM long JOIN numbered USING (i, level)""")
    assert con.execute('SELECT COUNT(*) FROM (SELECT row, position, "column", level FROM pairs EXCEPT ALL SELECT * FROM want)').fetchone() == (0,)
    assert con.execute("SELECT COUNT(*) FROM want").fetchone() == (len(got),)
    assert known.size > N


def test_unseen_and_missing_levels_have_no_position(spark):
    df = spark.createDataFrame([("x", "u"), ("y", None)], "a string, `b c` string")
    known = sparse.LevelTable.fit(df, ["a", "b c"], first=10)
    other = spark.createDataFrame([("y", "u"), ("new", "u"), (None, None)], "a string, `b c` string")
    assert [r["positions"] for r in known.positions(other).collect()] == [[11, 12], [12], []]
    assert known.size == 3 and known.positions(other).columns == ["a", "b c", "positions"]
    assert sparse.LevelTable.fit(df.limit(0), ["a"]).size == 0


def test_vectors_train_a_model(spark):
    df = spark.range(3000).select((F.col("id") % 1500).cast("string").alias("a"), ((F.col("id") % 1500) % 2).cast("double").alias("label"))
    known = sparse.LevelTable.fit(df, ["a"])
    ready = sparse.as_vectors(known.positions(df), "positions", known.size)
    assert ready.first()["features"].size == 1500 and ready.first()["features"].numNonzeros() == 1
    scored = LogisticRegression(maxIter=5).fit(ready).transform(ready)
    assert scored.where("prediction = label").count() == 3000


def test_feature_tables_with_sparse_levels(campus):
    """Positions name the same levels as the columns do."""
    c = campus
    known = sparse.LevelTable.fit(c.students.join(c.qualifications, "student_id"), ["ethnicity", "qualification_type"])
    plain = student.student_features(c.students, c.qualifications)
    thin = student.student_features(c.students, c.qualifications, known)
    names = {r["position"]: r for r in known.table.collect()}
    on = {r["student_id"]: {k for k, v in r.asDict().items() if v == 1 and k.startswith(("ethnicity_", "qual_"))} for r in plain.collect()}
    prefix = {"ethnicity": "ethnicity", "qualification_type": "qual"}
    for r in thin.collect():
        assert {f"{prefix[names[p]['column']]}_{names[p]['level']}".replace(" ", "_") for p in r["categories"]} == on[r["student_id"]]
    departments = sparse.LevelTable.fit(c.courses, ["department"])
    assert course.course_features(c.courses, departments).where(F.size("categories") != 1).count() == 0


def test_finished_tables_with_sparse_levels(campus):
    c = campus
    df = c.students.select("student_id", *feature_tables.BACKGROUND, "imd_decile")
    known = sparse.LevelTable.fit(df, feature_tables.BACKGROUND, drop_first=True, missing="Unknown")
    plain = feature_tables.finished(df, ["imd_decile"], feature_tables.BACKGROUND, [])
    thin = feature_tables.finished(df, ["imd_decile"], feature_tables.BACKGROUND, [], known)
    columns = [f"{r['column']}_{r['level']}".replace(" ", "_") for r in known.table.orderBy("position").collect()]
    want = {r["student_id"]: [i for i, name in enumerate(columns) if r[name] == 1] for r in plain.collect()}
    assert {r["student_id"]: r["categories"] for r in thin.collect()} == want


def test_too_many_columns_point_to_sparse_levels(spark, monkeypatch):
    monkeypatch.setattr(categories, "MAX_LEVELS", 3)
    with pytest.raises(ValueError, match="sparse"):
        categories.levels(spark.range(10).select(F.col("id").cast("string").alias("c")), "c")
