"""Recommenders (rows N1–N21)."""

import numpy as np
from pyspark.sql import functions as F

from cohortlens.models import collaborative, hybrid, ranker
from cohortlens.operators import profiles, recommend, vectors
from cohortlens.operators.mmr import mmr
from cohortlens.operators.text import TfIdf
from cohortlens.operators.feature_tables import ranking_samples
from cohortlens.plans.features import SAMPLES_SQL, SCORES_SQL, listed_scores, model_scores
from cohortlens.plans.ranking import METRICS, POPULARITY_SQL, course_vectors, popularity_lists, top10
from cohortlens.plans.registry import query
from cohortlens.session import reliable_checkpoint


@query("n1_random")
def _(c):
    return recommend.random_courses(c.students, c.courses, 10)


POPULAR_SQL = " UNION ALL ".join(
    POPULARITY_SQL.format(m=m, expr=e)
    for m, e in zip(METRICS, ("CAST(COALESCE(n, 0) AS DOUBLE)", "employment_rate_15m", "satisfaction_score"))
)


@query(
    "n2_popularity",
    f"SELECT model, student_id, course_id, score FROM students CROSS JOIN (SELECT * FROM ({POPULAR_SQL}) WHERE place <= 10) p",
    ["score"],
)
def _(c):
    return popularity_lists(c)


STUDENT_PARTS_SQL = """SELECT student_id, CASE qualification_type WHEN 'A-Level' THEN CAST(0.6 AS DOUBLE) WHEN 'International Baccalaureate' THEN 0.55 WHEN 'BTEC' THEN 0.35 ELSE 0.45 END AS a,
 ucas_tariff_points / CAST(168 AS DOUBLE) AS b, (11 - imd_decile) / CAST(10 AS DOUBLE) AS c,
 1 - (care_leaver * 3 + first_generation_uni * 2 + CASE WHEN polar_quintile = 1 THEN 1 ELSE 0 END) / CAST(6 AS DOUBLE) AS d FROM students JOIN qualifications USING (student_id)"""
COURSE_PARTS_SQL = """SELECT course_id, exam_weight_pct / CAST(100 AS DOUBLE) AS a, entry_tariff / CAST(168 AS DOUBLE) AS b, satisfaction_score / 5 AS c, employment_rate_15m AS d FROM courses"""
WEIGHTED = "0.3 * {x}.a * {y}.a + 0.3 * {x}.b * {y}.b + 0.2 * {x}.c * {y}.c + 0.2 * {x}.d * {y}.d"


@query(
    "n3_content_based",
    f"""WITH s AS ({STUDENT_PARTS_SQL}), c AS ({COURSE_PARTS_SQL}), sl AS (SELECT *, SQRT({WEIGHTED.format(x='s', y='s')}) AS l FROM s), cl AS (SELECT *, SQRT({WEIGHTED.format(x='c', y='c')}) AS l FROM c),
        p AS (SELECT student_id, course_id, ROUND(LEAST(1, GREATEST(0, ({WEIGHTED.format(x='sl', y='cl')}) / (sl.l * cl.l))), 6) AS score FROM sl, cl)
        SELECT student_id, course_id, score, CAST(place AS INT) AS rank FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY student_id ORDER BY score DESC, course_id) AS place FROM p) WHERE place <= 5""",
    ["score"],
)
def _(c):
    return recommend.content_based(c.students, c.qualifications, c.courses, 5)


@query(
    "n4_explain_match",
    f"""WITH s AS ({STUDENT_PARTS_SQL}), c AS ({COURSE_PARTS_SQL}),
        j AS (SELECT e.student_id, e.course_id, s.a AS sa, s.b AS sb, s.c AS sc, s.d AS sd, c.a AS ca, c.b AS cb, c.c AS cc, c.d AS cd FROM enrollments e JOIN s ON s.student_id = e.student_id JOIN c ON c.course_id = e.course_id),
        o AS (SELECT *, (sa*ca + sb*cb + sc*cc + sd*cd) / (SQRT(sa*sa + sb*sb + sc*sc + sd*sd) * SQRT(ca*ca + cb*cb + cc*cc + cd*cd)) AS overall FROM j),
        l AS (SELECT student_id, course_id, overall, 'qualification' AS feature, sa AS sv, ca AS cv FROM o UNION ALL SELECT student_id, course_id, overall, 'grade', sb, cb FROM o
          UNION ALL SELECT student_id, course_id, overall, 'subject', sc, cc FROM o UNION ALL SELECT student_id, course_id, overall, 'outcome', sd, cd FROM o)
        SELECT student_id, course_id, overall, feature, sv AS student_value, cv AS course_value, 1 - ABS(sv - cv) AS similarity FROM
        (SELECT *, ROW_NUMBER() OVER (PARTITION BY student_id, course_id ORDER BY ABS(sv - cv), feature) AS place FROM l) WHERE place <= 3""",
    ["overall", "student_value", "course_value", "similarity"],
)
def _(c):
    people = recommend.student_components(c.students, c.qualifications)
    return recommend.explain_match(c.enrollments, people, recommend.course_components(c.courses), 3)


@query("n5_factorisation")
def _(c):
    factors = collaborative.fit_factors(c.interactions)
    return factors.score(c.enrollments.select("student_id", "course_id"))


@query("n6_factorisation_lists")
def _(c):
    factors = collaborative.fit_factors(c.interactions)
    return factors.recommend(c.students, c.interactions, 5)


VECTORS_SQL = "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings"
COSINE = "ROUND(LIST_DOT_PRODUCT({a}, {b}) / (SQRT(LIST_DOT_PRODUCT({a}, {a})) * SQRT(LIST_DOT_PRODUCT({b}, {b}))), 6)"


@query(
    "n7_item_similarity",
    f"""WITH i AS ({VECTORS_SQL}), s AS (SELECT a.vec_id AS query_id, b.vec_id AS item_id, {COSINE.format(a='a.v', b='b.v')} AS score FROM i a JOIN i b ON a.vec_id <> b.vec_id)
        SELECT query_id, item_id, score, CAST(place AS INT) AS rank FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS place FROM s) WHERE place <= 5""",
    ["score"],
)
def _(c):
    items = c.raw("embeddings").select(F.col("vec_id").alias("course_id"), F.col("embedding").alias("factors"))
    given = collaborative.Factors(0.0, c.students, items)
    return given.similar_courses(5)


@query("n8_hybrid_factorisation")
def _(c):
    people = c.students.join(c.qualifications, "student_id")
    model = collaborative.fit_hybrid(
        c.enrollments, people, c.courses, ["qualification_type", "gender"], ["department"]
    )
    return model.score(c.enrollments.select("student_id", "course_id"))


@query("n9_neural_factors")
def _(c):
    factors = collaborative.fit_factors(c.interactions)
    model = collaborative.fit_neural(c.enrollments, c.courses, factors)
    return model.score(c.enrollments.select("student_id", "course_id"))


def given_factors(c):
    """Factors that follow from the ids; eighths and sixteenths, so that all sums are exact."""
    s, k = F.col("student_id"), F.col("course_id")
    people = c.students.select("student_id", (s % 7 / 8.0).alias("bias"), F.array(s % 8 / 8.0, s % 5 / 4.0, s * 3 % 16 / 16.0).alias("factors"))
    courses = c.courses.select("course_id", (k % 32 / 32.0).alias("bias"), F.array(k * 5 % 8 / 8.0, k * 3 % 4 / 4.0, k % 16 / 16.0).alias("factors"))
    return collaborative.Factors(-1.5, people, courses)


GIVEN_SQL = """open AS (SELECT s.student_id, c.course_id, s.student_id AS s, c.course_id AS k FROM students s, courses c
  WHERE (s.student_id, c.course_id) NOT IN (SELECT (o_custkey, l_partkey) FROM lineitem JOIN orders ON l_orderkey = o_orderkey)),
 x AS (SELECT student_id, course_id, s % 7 / 8.0 AS sb, k % 32 / 32.0 AS cb, s % 8 / 8.0 AS p1, s % 5 / 4.0 AS p2, s * 3 % 16 / 16.0 AS p3,
  k * 5 % 8 / 8.0 AS q1, k * 3 % 4 / 4.0 AS q2, k % 16 / 16.0 AS q3 FROM open)"""
LISTED_SQL = """SELECT student_id, course_id, score, CAST(place AS INT) AS rank FROM
 (SELECT *, ROW_NUMBER() OVER (PARTITION BY student_id ORDER BY score DESC, course_id) AS place FROM r) WHERE place <= 5"""


@query(
    "n6_lists_of_given_factors",
    f"""WITH {GIVEN_SQL}, r AS (SELECT student_id, course_id, CAST(-1.5 + sb + cb + p1 * q1 + p2 * q2 + p3 * q3 AS DOUBLE) AS score FROM x) {LISTED_SQL}""",
    ["score"],
)
def _(c):
    return given_factors(c).recommend(c.students, c.interactions, 5)


@query(
    "n8_lists_of_given_factors",
    f"""WITH {GIVEN_SQL}, r AS (SELECT student_id, course_id, 1 / (1 + EXP(-CAST(-1.5 + sb + cb + p1 * q1 + p2 * q2 + p3 * q3 AS DOUBLE))) AS score FROM x) {LISTED_SQL}""",
    ["score"],
)
def _(c):
    return collaborative.HybridModel(given_factors(c)).recommend(c.students, c.interactions, 5)


GIVEN_INNER = [[0.5, -0.25, 1.0, 0.5, -1.0, 0.5, 0.25, 1.0], [-0.5, 1.0, 0.25, -1.0, 0.75, 0.5, -0.5, 0.25]]


def neural_sql():
    """Hidden units over student and course values, as one statement per unit."""
    names = ["p1", "p2", "p3", "sb", "q1", "q2", "q3", "cb"]
    units = [f"1 / (1 + EXP(-CAST({b} + {' + '.join(f'({w}) * {n}' for w, n in zip(row, names))} AS DOUBLE)))" for row, b in zip(GIVEN_INNER, (0.125, -0.25))]
    return f"""WITH {GIVEN_SQL}, r AS (SELECT student_id, course_id, ROUND(1 / (1 + EXP(-(0.25 + 2.0 * {units[0]} - 1.5 * {units[1]}))), 9) AS score FROM x) {LISTED_SQL}"""


@query("n9_lists_of_given_weights", neural_sql(), ["score"])
def _(c):
    model = collaborative.NeuralModel(given_factors(c), np.array(GIVEN_INNER), np.array([0.125, -0.25]), np.array([2.0, -1.5]), 0.25)
    return model.recommend(c.students, c.interactions, 5)


@query("n8_hybrid_lists")
def _(c):
    people = c.students.join(c.qualifications, "student_id")
    model = collaborative.fit_hybrid(c.enrollments, people, c.courses, ["qualification_type", "gender"], ["department"])
    return model.recommend(c.students, c.enrollments, 5)


@query("n9_neural_lists")
def _(c):
    model = collaborative.fit_neural(c.enrollments, c.courses, collaborative.fit_factors(c.interactions))
    return model.recommend(c.students, c.enrollments, 5)


def course_docs(c):
    return profiles.course_text(c.courses).select(F.col("course_id").alias("id"), "text")


def student_docs(c):
    """Student texts whose interests are the name and department of the enrolled course."""
    interests = c.enrollments.join(c.courses, "course_id").select(
        "student_id", F.concat_ws(" ", "course_name", "department").alias("subject_interests")
    )
    people = c.students.join(c.qualifications, "student_id").join(interests, "student_id")
    return people.select(F.col("student_id").alias("id"), profiles.student_text(people).alias("text"))


STUDENT_TEXT_SQL = """SELECT student_id AS id, CONCAT_WS(' ', qualification_type, CONCAT_WS(' ', course_name, department), CASE WHEN ucas_tariff_points >= 144 THEN 'high grades distinction'
 WHEN ucas_tariff_points >= 112 THEN 'good grades merit' ELSE 'standard grades pass' END) AS text FROM qualifications JOIN enrollments USING (student_id) JOIN courses USING (course_id)"""
COURSE_TEXT_SQL = "SELECT course_id AS id, CONCAT_WS(' ', course_name, department) AS text FROM courses"


def counts_sql(docs):
    """Words without the two stop words the texts hold ('to', 'he'), and pairs of what is left."""
    return f"""(SELECT id, term, COUNT(*) AS n FROM (
 SELECT id, UNNEST(LIST_CONCAT(w, CASE WHEN LEN(w) > 1 THEN LIST_TRANSFORM(RANGE(1, LEN(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE [] END)) AS term
 FROM (SELECT id, LIST_FILTER(REGEXP_EXTRACT_ALL(LOWER(text), '\\b\\w\\w+\\b'), lambda x: x NOT IN ('to', 'he')) AS w FROM ({docs}))) GROUP BY 1, 2)"""


TFIDF_SQL = f"""cc AS {counts_sql(COURSE_TEXT_SQL)}, sc AS {counts_sql(STUDENT_TEXT_SQL)}, nd AS (SELECT COUNT(*) AS nd FROM courses),
 vocab AS (SELECT term, df, tt, LN((1 + nd) / CAST(1 + df AS DOUBLE)) + 1 AS idf FROM (SELECT term, COUNT(*) AS df, SUM(n) AS tt FROM cc GROUP BY 1), nd WHERE df >= 2 AND df <= 0.95 * nd ORDER BY tt DESC, term LIMIT 5000),
 cw AS (SELECT id, term, n * idf AS w FROM cc JOIN vocab USING (term)), cn AS (SELECT id, term, w / SQRT(SUM(w * w) OVER (PARTITION BY id)) AS w FROM cw),
 sw AS (SELECT id, term, n * idf AS w FROM sc JOIN vocab USING (term)), sn AS (SELECT id, term, w / SQRT(SUM(w * w) OVER (PARTITION BY id)) AS w FROM sw)"""


@query(
    "n10_tfidf",
    f"""WITH {TFIDF_SQL}, dots AS (SELECT s.id AS student_id, c.id AS course_id, ROUND(SUM(s.w * c.w), 6) AS score FROM sn s JOIN cn c USING (term) GROUP BY 1, 2),
        p AS (SELECT st.id AS student_id, co.id AS course_id, COALESCE(score, 0) AS score FROM ({STUDENT_TEXT_SQL}) st CROSS JOIN ({COURSE_TEXT_SQL}) co
          LEFT JOIN dots d ON d.student_id = st.id AND d.course_id = co.id)
        SELECT student_id, course_id, score, CAST(place AS INT) AS rank FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY student_id ORDER BY score DESC, course_id) AS place FROM p) WHERE place <= 5""",
    ["score"],
)
def _(c):
    fitted = TfIdf(course_docs(c))
    return recommend.as_courses(fitted.most_similar(student_docs(c), course_docs(c), 5))


@query(
    "n11_tfidf_terms",
    f"""WITH {TFIDF_SQL} SELECT id AS course_id, term, w AS weight, CAST(place AS INT) AS rank FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY ROUND(w, 9) DESC, term) AS place FROM cn) WHERE place <= 10""",
    ["weight"],
)
def _(c):
    from cohortlens.functions.ordering import top_n

    weights = TfIdf(course_docs(c)).weights(course_docs(c))
    top = top_n(weights, "id", [F.desc(F.round("weight", 9)), F.asc("term")], 10)
    return top.select(F.col("id").alias("course_id"), "term", "weight", "rank")


def student_vectors(c):
    """Mean vector of the courses a student took (courses stand in a ring of the given vectors)."""
    n = c.raw("embeddings").agg(F.count("*")).scalar()
    met = c.interactions.select("student_id", (F.col("course_id") % n).alias("vec_id")).distinct()
    joined = met.join(c.raw("embeddings").select("vec_id", "embedding"), "vec_id")
    means = vectors.mean_vectors(joined, "student_id", "embedding")
    return reliable_checkpoint(means.select(F.col("student_id").alias("id"), "vector"))


STUDENT_VECTORS_SQL = f"""sv AS (SELECT student_id, LIST(x ORDER BY pos) AS v FROM (SELECT student_id, pos, AVG(CAST(embedding[pos] AS DOUBLE)) AS x FROM
   (SELECT DISTINCT student_id, course_id % (SELECT COUNT(*) FROM embeddings) AS vec_id FROM interactions) m JOIN embeddings USING (vec_id), RANGE(1, 65) t(pos) GROUP BY 1, 2) GROUP BY 1)"""


@query(
    "n12_embedding_lists",
    f"""WITH {STUDENT_VECTORS_SQL}, i AS ({VECTORS_SQL}), p AS (SELECT student_id, vec_id AS course_id, {COSINE.format(a='sv.v', b='i.v')} AS score FROM sv, i)
        SELECT student_id, course_id, score, CAST(place AS INT) AS rank FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY student_id ORDER BY score DESC, course_id) AS place FROM p) WHERE place <= 5""",
    ["score"],
)
def _(c):
    items = c.raw("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return recommend.as_courses(vectors.most_similar(student_vectors(c), items, 5))


WEIGHTS = {"popularity": 0.4, "rating": 0.6}
WEIGHT_SQL = "CASE model WHEN 'popularity' THEN CAST(0.4 AS DOUBLE) ELSE 0.6 END"


def first_sql(table, n):
    return f"SELECT student_id, course_id, score, CAST(place AS INT) AS rank FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY student_id ORDER BY score DESC, course_id) AS place FROM {table}) WHERE place <= {n}"


@query(
    "n13_fusion",
    f"""WITH sc AS ({SCORES_SQL}), w AS (SELECT student_id, SUM(w) AS t FROM (SELECT DISTINCT student_id, model, {WEIGHT_SQL} AS w FROM sc) GROUP BY 1),
        f AS (SELECT student_id, course_id, SUM({WEIGHT_SQL} * score) / MAX(t) AS score FROM sc JOIN w USING (student_id) GROUP BY 1, 2) {first_sql('f', 10)}""",
    ["score"],
)
def _(c):
    return recommend.fuse(model_scores(c), WEIGHTS, 10)


@query(
    "n14_fusion_explanation",
    f"SELECT student_id, course_id, model, {WEIGHT_SQL} AS weight, score, {WEIGHT_SQL} * score AS contribution FROM ({SCORES_SQL})",
    ["weight", "score", "contribution"],
)
def _(c):
    return recommend.explain_fusion(model_scores(c), WEIGHTS)


@query(
    "n15_vector_search",
    f"""WITH q AS (SELECT label, LIST(x ORDER BY pos) AS v FROM (SELECT label, pos, AVG(CAST(embedding[pos] AS DOUBLE)) AS x FROM embeddings, RANGE(1, 65) t(pos) GROUP BY 1, 2) GROUP BY 1), i AS ({VECTORS_SQL}),
        p AS (SELECT label, vec_id, {COSINE.format(a='q.v', b='i.v')} AS s FROM q, i)
        SELECT label, vec_id, 1 - s AS distance FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY label ORDER BY s DESC, vec_id) AS place FROM p) WHERE place <= 10""",
    ["distance"],
)
def _(c):
    table = c.raw("embeddings")
    wanted = vectors.mean_vectors(table, "label", "embedding").select(F.col("label").alias("id"), "vector")
    items = table.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    found = vectors.most_similar(wanted, items, 10)
    return found.select(F.col("query_id").cast("int").alias("label"), F.col("item_id").alias("vec_id"), (1 - F.col("score")).alias("distance"))


ENSEMBLE_SQL = f"""SELECT student_id, course_id, SUM({WEIGHT_SQL} / (1 + EXP(-score))) / COUNT(*) AS score FROM ({SCORES_SQL}) GROUP BY 1, 2"""


@query(
    "n16_ensemble",
    f"""WITH e AS ({ENSEMBLE_SQL}), t AS (SELECT student_id, course_id, score, place FROM (SELECT student_id, course_id, score, ROW_NUMBER() OVER (PARTITION BY student_id ORDER BY ROUND(score, 9) DESC, course_id) AS place FROM e) WHERE place <= 10),
        m AS (SELECT student_id, course_id, MAX(CASE WHEN model = 'popularity' THEN score END) AS popularity, MAX(CASE WHEN model = 'rating' THEN score END) AS rating FROM ({SCORES_SQL}) GROUP BY 1, 2)
        SELECT student_id, course_id, score, popularity, rating FROM t LEFT JOIN m USING (student_id, course_id)""",
    ["score", "popularity", "rating"],
)
def _(c):
    scores = model_scores(c)
    listed = recommend.ensemble(scores, {"popularity": 2, "rating": 3}, 10)
    return recommend.scores_by_model(listed, scores, list(WEIGHTS)).drop("rank")


@query("n18_learning_to_rank")
def _(c):
    scores = model_scores(c)
    return ranker.fit_ranker(scores, c.enrollments).recommend(scores, 5)


AT_WEIGHTS = (0.02, -0.03)
PAIR_SQL = f"""WITH sm AS ({SAMPLES_SQL}), pr AS (SELECT a.query_id, a.popularity - b.popularity AS dp, a.rating - b.rating AS dr
   FROM sm a JOIN sm b ON a.query_id = b.query_id AND a.label = 1 AND b.label = 0),
 g AS (SELECT *, 1 / (1 + EXP({AT_WEIGHTS[0]} * dp + {AT_WEIGHTS[1]} * dr)) AS wrong, COUNT(*) OVER (PARTITION BY query_id) AS n FROM pr),
 t AS (SELECT COUNT(DISTINCT query_id) AS students FROM g)
 SELECT SUM(-LN(1 - wrong) / n) / MAX(students) AS loss, SUM(-wrong * dp / n) / MAX(students) AS g_popularity, SUM(-wrong * dr / n) / MAX(students) AS g_rating,
  SUM(wrong * (1 - wrong) * dp * dp / n) / MAX(students) AS c_popularity, SUM(wrong * (1 - wrong) * dp * dr / n) / MAX(students) AS c_both,
  SUM(wrong * (1 - wrong) * dr * dr / n) / MAX(students) AS c_rating FROM g, t"""
PAIR_COLUMNS = ["loss", "g_popularity", "g_rating", "c_popularity", "c_both", "c_rating"]


@query("n18_pairwise_derivatives", PAIR_SQL, PAIR_COLUMNS)
def _(c):
    lists = ranker.student_lists(ranking_samples(model_scores(c), c.enrollments), ["popularity", "rating"])
    loss, gradient, curvature = ranker.pair_derivatives(lists, np.array(AT_WEIGHTS))
    row = (loss, *gradient, curvature[0, 0], curvature[0, 1], curvature[1, 1])
    return c.spark.createDataFrame([tuple(map(float, row))], ", ".join(f"{x} double" for x in PAIR_COLUMNS))


@query("n18_pairwise_ranking")
def _(c):
    scores = model_scores(c)
    return ranker.fit_pairwise(scores, c.enrollments).recommend(scores, 5)


@query(
    "n17_reweight",
    f"""WITH e AS (SELECT student_id, course_id, SUM(CASE model WHEN 'popularity' THEN CAST(0.2 AS DOUBLE) ELSE 0.8 END * (1 / (1 + EXP(-score)))) / COUNT(*) AS score FROM ({SCORES_SQL}) GROUP BY 1, 2)
        SELECT student_id, course_id, score, CAST(place AS INT) AS rank FROM
        (SELECT *, ROW_NUMBER() OVER (PARTITION BY student_id ORDER BY score DESC, course_id) AS place FROM e) WHERE place <= 5""",
    ["score"],
)
def _(c):
    return recommend.ensemble(model_scores(c), recommend.normalised({"popularity": 1, "rating": 4}), 5)


@query("n19_mmr")
def _(c):
    return mmr(top10(c), course_vectors(c), 5)


ROUTE_SQL = """SELECT s.student_id, CASE WHEN h.student_id IS NOT NULL THEN 'matrix_factorization' WHEN ucas_tariff_points IS NOT NULL THEN 'content_based' ELSE 'popularity' END AS route
 FROM students s LEFT JOIN (SELECT DISTINCT user_id AS student_id FROM events) h USING (student_id) LEFT JOIN qualifications q USING (student_id)"""


def routes(c):
    """Only the students seen online count as having a history."""
    seen = c.raw("events").select(F.col("user_id").alias("student_id"))
    return recommend.route(c.students, c.qualifications, seen)


@query(
    "n20_cold_start",
    f"""WITH r AS ({ROUTE_SQL}), sc AS MATERIALIZED (SELECT student_id, course_id, score, CASE model WHEN 'rating' THEN 'matrix_factorization' ELSE model END AS model FROM ({SCORES_SQL})),
        pick AS (SELECT student_id, CASE WHEN BOOL_OR(model = route) THEN MAX(route) ELSE 'popularity' END AS model FROM sc JOIN r USING (student_id) GROUP BY 1)
        SELECT student_id, model, course_id, score FROM sc JOIN pick USING (student_id, model)""",
    ["score"],
)
def _(c):
    renamed = F.when(F.col("model") == "rating", recommend.ROUTES[0]).otherwise(F.col("model"))
    scores = model_scores(c).withColumn("model", renamed)
    return recommend.routed(routes(c), scores).select("student_id", "model", "course_id", "score")


CONTENT_SQL = f"""WITH s AS ({STUDENT_PARTS_SQL}), c AS ({COURSE_PARTS_SQL}), sl AS (SELECT *, SQRT({WEIGHTED.format(x='s', y='s')}) AS l FROM s), cl AS (SELECT *, SQRT({WEIGHTED.format(x='c', y='c')}) AS l FROM c),
 p AS (SELECT student_id, course_id, ROUND(LEAST(1, GREATEST(0, ({WEIGHTED.format(x='sl', y='cl')}) / (sl.l * cl.l))), 6) AS score FROM sl, cl)
 SELECT student_id, course_id, score FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY student_id ORDER BY score DESC, course_id) AS place FROM p) WHERE place <= 5"""


def served_scores(c):
    """The lists of all three routes."""
    renamed = F.when(F.col("model") == "rating", recommend.ROUTES[0]).otherwise(F.col("model"))
    content = recommend.content_based(c.students, c.qualifications, c.courses, 5).select("student_id", "course_id", "score", F.lit(recommend.ROUTES[1]).alias("model"))
    return reliable_checkpoint(listed_scores(c).withColumn("model", renamed).unionByName(content))


@query(
    "n20_content_route",
    f"""WITH r AS ({ROUTE_SQL}), ct AS MATERIALIZED ({CONTENT_SQL}), ot AS MATERIALIZED ({SCORES_SQL}),
        sc AS (SELECT student_id, course_id, score, CASE model WHEN 'rating' THEN 'matrix_factorization' ELSE model END AS model FROM ot UNION ALL SELECT student_id, course_id, score, 'content_based' FROM ct),
        pick AS (SELECT student_id, CASE WHEN BOOL_OR(model = route) THEN MAX(route) WHEN BOOL_OR(model = 'content_based') THEN 'content_based' ELSE 'popularity' END AS model FROM sc JOIN r USING (student_id) GROUP BY 1)
        SELECT student_id, model, course_id, score FROM sc JOIN pick USING (student_id, model)""",
    ["score"],
)
def _(c):
    return recommend.routed(routes(c), served_scores(c)).select("student_id", "model", "course_id", "score")


SERVED_WEIGHTS = {"popularity": 2, "matrix_factorization": 3, "content_based": 5}
SERVED_SQL = f"""SELECT student_id, course_id, score, CASE model WHEN 'rating' THEN 'matrix_factorization' ELSE model END AS model FROM ({SCORES_SQL})
 UNION ALL SELECT student_id, course_id, score, 'content_based' FROM ({CONTENT_SQL})"""
SERVED_SHARE = "CASE model WHEN 'popularity' THEN CAST(0.2 AS DOUBLE) WHEN 'matrix_factorization' THEN 0.3 ELSE 0.5 END"


@query(
    "n21_ensemble_mode",
    f"""WITH r AS ({ROUTE_SQL}), sc AS MATERIALIZED ({SERVED_SQL}),
        warm AS (SELECT student_id, course_id, SUM({SERVED_SHARE} * (1 / (1 + EXP(-score)))) / COUNT(*) AS score FROM sc JOIN r USING (student_id) WHERE route = 'matrix_factorization' GROUP BY 1, 2),
        pick AS (SELECT student_id, CASE WHEN BOOL_OR(model = route) THEN MAX(route) WHEN BOOL_OR(model = 'content_based') THEN 'content_based' ELSE 'popularity' END AS model
          FROM sc JOIN r USING (student_id) WHERE route <> 'matrix_factorization' GROUP BY 1),
        every AS (SELECT student_id, course_id, score FROM warm UNION ALL SELECT student_id, course_id, score FROM sc JOIN pick USING (student_id, model))
        SELECT student_id, course_id, CAST(place AS INT) AS rank, score FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY student_id ORDER BY score DESC, course_id) AS place FROM every) WHERE place <= 5""",
    ["score"],
)
def _(c):
    return hybrid.HybridRecommender(served_scores(c), SERVED_WEIGHTS, course_vectors(c), mode="ensemble").recommend(routes(c), 5)


@query("n21_ltr_mode")
def _(c):
    scores = served_scores(c)
    fitted = ranker.fit_pairwise(scores, c.enrollments)
    return hybrid.HybridRecommender(scores, SERVED_WEIGHTS, course_vectors(c), mode="ltr", ranker=fitted).recommend(routes(c), 5)


@query("n21_mmr_mode")
def _(c):
    return hybrid.HybridRecommender(served_scores(c), SERVED_WEIGHTS, course_vectors(c), mode="mmr").recommend(routes(c), 5)


@query(
    "n21_explain",
    f"""WITH sc AS ({SERVED_SQL}) SELECT student_id, course_id, model, {SERVED_SHARE} AS weight, score, {SERVED_SHARE} * score AS contribution
        FROM sc WHERE (student_id, course_id) IN (SELECT (student_id, course_id) FROM enrollments)""",
    ["weight", "score", "contribution"],
)
def _(c):
    return hybrid.HybridRecommender(served_scores(c), SERVED_WEIGHTS, course_vectors(c)).explain(c.enrollments)


@query("n21_hybrid")
def _(c):
    served = hybrid.HybridRecommender(model_scores(c), {"popularity": 2, "rating": 3}, course_vectors(c), mode="hybrid")
    return served.recommend(routes(c), 5)
