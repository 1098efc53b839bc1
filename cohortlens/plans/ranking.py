"""Ranking metrics (rows M1–M13)."""

from pyspark.sql import functions as F

from cohortlens.operators import ranking_metrics as rm
from cohortlens.operators.recommend import best_courses, popular_for_all, popularity
from cohortlens.plans.registry import query

JUDGED_SQL = """SELECT student_id, course_id, rating AS score, (student_id * 31 + course_id) % 4 AS grade,
 CASE WHEN (student_id * 31 + course_id) % 4 = 0 THEN 1 ELSE 0 END AS hit FROM interactions"""


def judged(c, graded=False):
    """Interactions as scored candidates with a derived relevance (graded 0-3 or 0/1)."""
    grade = (F.col("student_id") * 31 + F.col("course_id")) % 4
    relevance = grade if graded else (grade == 0).cast("int")
    return c.interactions.select("student_id", "course_id", F.col("rating").alias("score"), relevance.alias("relevance"))


def dcg_sql(rel, order, k, into):
    return f"""SELECT student_id, SUM({rel} / LOG2(place + 1)) AS {into} FROM (SELECT *, ROW_NUMBER() OVER
 (PARTITION BY student_id ORDER BY {order} DESC, course_id) AS place FROM j) WHERE place <= {k} GROUP BY 1"""


def ndcg_sql(rel, k):
    return f"""SELECT student_id, CASE WHEN i > 0 THEN d / i ELSE 0 END AS ndcg FROM ({dcg_sql(rel, 'score', k, 'd')}) x
 JOIN ({dcg_sql(rel, rel, k, 'i')}) y USING (student_id)"""


PLACED = "(SELECT *, ROW_NUMBER() OVER (PARTITION BY student_id ORDER BY score DESC, course_id) AS place FROM j)"
RR_SQL = f"""SELECT student_id, COALESCE(1.0 / MIN(CASE WHEN hit > 0 THEN place END), 0) AS rr FROM {PLACED} GROUP BY 1"""


def at_k_sql(k):
    return f"""SELECT student_id, AVG(CASE WHEN place <= {k} THEN hit END) AS p, CASE WHEN SUM(hit) > 0 THEN SUM(CASE WHEN place <= {k} THEN hit ELSE 0 END)
 / CAST(SUM(hit) AS DOUBLE) ELSE 0 END AS r FROM {PLACED} GROUP BY 1"""


@query("m1_dcg", f"WITH j AS ({JUDGED_SQL}) {dcg_sql('grade', 'score', 10, 'dcg')}", ["dcg"])
def _(c):
    return rm.dcg(judged(c, graded=True), 10)


@query("m2_ndcg", f"WITH j AS ({JUDGED_SQL}) {ndcg_sql('grade', 10)}", ["ndcg"])
def _(c):
    return rm.ndcg(judged(c, graded=True), 10)


LISTS_SQL = """lists AS (SELECT student_id, place, course_id % 200 AS course_id FROM (SELECT *, ROW_NUMBER() OVER
   (PARTITION BY student_id ORDER BY rating DESC, course_id) AS place FROM interactions) WHERE place <= 20),
 truth AS (SELECT DISTINCT student_id, course_id % 200 AS course_id FROM interactions WHERE n_taken >= 1 AND rating >= 40 AND student_id % 11 > 0)"""
AP_SQL = f"""WITH {LISTS_SQL}, firsts AS (SELECT student_id, course_id, MIN(place) AS place FROM lists WHERE place <= 10 GROUP BY 1, 2),
 gains AS (SELECT student_id, ROW_NUMBER() OVER (PARTITION BY student_id ORDER BY place) / CAST(place AS DOUBLE) AS g FROM firsts JOIN truth USING (student_id, course_id)),
 want AS (SELECT student_id, COUNT(*) AS w FROM truth GROUP BY 1)
 SELECT student_id, COALESCE(s / LEAST(w, 10), 0) AS ap FROM (SELECT DISTINCT student_id FROM lists) u LEFT JOIN want USING (student_id)
 LEFT JOIN (SELECT student_id, SUM(g) AS s FROM gains GROUP BY 1) g USING (student_id)"""


def lists_and_truth(c):
    """Top-20 lists in a folded catalogue (so that items repeat) and the well-rated courses."""
    folded = (F.col("course_id") % 200).alias("course_id")
    rated = c.interactions.select("student_id", "course_id", F.col("rating").alias("score"))
    lists = best_courses(rated, 20).select("student_id", "rank", folded)
    liked = c.interactions.where((F.col("rating") >= 40) & (F.col("student_id") % 11 > 0))
    return lists, liked.select("student_id", folded).distinct()


@query("m3_average_precision", AP_SQL, ["ap"])
def _(c):
    return rm.average_precision(*lists_and_truth(c), 10)


@query("m4_map", f"SELECT AVG(ap) AS map FROM ({AP_SQL})", ["map"])
def _(c):
    return rm.average_precision(*lists_and_truth(c), 10).agg(F.avg("ap").alias("map"))


@query("m5_mrr", f"WITH j AS ({JUDGED_SQL}) {RR_SQL}", ["rr"])
def _(c):
    return rm.reciprocal_rank(judged(c))


@query("m6_precision", f"WITH j AS ({JUDGED_SQL}) SELECT student_id, p AS precision FROM ({at_k_sql(10)})", ["precision"])
def _(c):
    return rm.precision(judged(c), 10)


@query("m7_recall", f"WITH j AS ({JUDGED_SQL}) SELECT student_id, r AS recall FROM ({at_k_sql(10)})", ["recall"])
def _(c):
    return rm.recall(judged(c), 10)


VECTOR_SQL = "SELECT course_id, entry_tariff / CAST(168 AS DOUBLE) AS a, employment_rate_15m AS b, satisfaction_score / 5 AS c, coursework_weight_pct / CAST(100 AS DOUBLE) AS d FROM courses"


def course_vectors(c):
    parts = [
        F.col("entry_tariff") / 168.0,
        F.col("employment_rate_15m"),
        F.col("satisfaction_score") / 5.0,
        F.col("coursework_weight_pct") / 100.0,
    ]
    return c.courses.select("course_id", F.array(*parts).alias("vector"))


@query(
    "m8_intra_list_distance",
    f"""WITH v AS ({VECTOR_SQL}), l AS (SELECT student_id, place, a, b, c, d FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY student_id ORDER BY rating DESC, course_id) AS place
         FROM interactions) JOIN v USING (course_id) WHERE place <= 10)
        SELECT x.student_id, AVG(SQRT((x.a-y.a)*(x.a-y.a) + (x.b-y.b)*(x.b-y.b) + (x.c-y.c)*(x.c-y.c) + (x.d-y.d)*(x.d-y.d))) AS distance
        FROM l x JOIN l y ON x.student_id = y.student_id AND x.place < y.place GROUP BY 1""",
    ["distance"],
)
def _(c):
    rated = c.interactions.select("student_id", "course_id", F.col("rating").alias("score"))
    return rm.intra_list_distance(best_courses(rated, 10), course_vectors(c))


TOP10_SQL = """SELECT student_id, course_id FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY student_id ORDER BY rating DESC, course_id) AS place
 FROM interactions) WHERE place <= 10"""


def top10(c):
    return best_courses(c.interactions.select("student_id", "course_id", F.col("rating").alias("score")), 10)


@query(
    "m9_coverage",
    f"SELECT COUNT(DISTINCT t.course_id) / CAST((SELECT COUNT(*) FROM courses) AS DOUBLE) AS coverage FROM ({TOP10_SQL}) t JOIN courses USING (course_id)",
    ["coverage"],
)
def _(c):
    return rm.coverage(top10(c), c.courses)


@query(
    "m10_novelty",
    f"""WITH pop AS (SELECT course_id, COUNT(*) AS n FROM enrollments GROUP BY 1)
        SELECT AVG(v) AS novelty FROM (SELECT student_id, AVG(-LOG2(n / CAST((SELECT COUNT(*) FROM students) AS DOUBLE))) AS v FROM ({TOP10_SQL}) JOIN pop USING (course_id) GROUP BY 1)""",
    ["novelty"],
)
def _(c):
    pop = c.enrollments.groupBy("course_id").agg(F.count("*").alias("popularity"))
    return rm.novelty(top10(c), pop, c.students.agg(F.count("*")).scalar())


EVALUATE_SQL = f"""WITH j AS ({JUDGED_SQL}) """ + " UNION ALL ".join(
    [f"SELECT 'ndcg_at_{k}' AS metric, AVG(ndcg) AS value FROM ({ndcg_sql('hit', k)})" for k in (5, 10, 20)]
    + [f"SELECT 'precision_at_{k}', AVG(p) FROM ({at_k_sql(k)})" for k in (5, 10, 20)]
    + [f"SELECT 'recall_at_{k}', AVG(r) FROM ({at_k_sql(k)})" for k in (5, 10, 20)]
    + [f"SELECT 'mrr', AVG(rr) FROM ({RR_SQL})"]
)


@query("m11_evaluate_ranking", EVALUATE_SQL, ["value"])
def _(c):
    return rm.evaluate(judged(c))


METRICS = ["enrollment_count", "employment_rate", "satisfaction"]
POPULARITY_SQL = """SELECT '{m}' AS model, course_id, score, ROW_NUMBER() OVER (ORDER BY score DESC, course_id) AS place FROM
 (SELECT course_id, {expr} AS score FROM courses LEFT JOIN (SELECT course_id, COUNT(*) AS n FROM enrollments GROUP BY 1) e USING (course_id))"""
COMPARE_SQL = f"""WITH tops AS (SELECT * FROM ({' UNION ALL '.join(POPULARITY_SQL.format(m=m, expr=e) for m, e in zip(METRICS, ('CAST(COALESCE(n, 0) AS DOUBLE)', 'employment_rate_15m', 'satisfaction_score')))}) WHERE place <= 10),
 truth AS (SELECT DISTINCT student_id, course_id FROM interactions),
 lists AS (SELECT model, s.student_id, t.course_id, place, CASE WHEN g.course_id IS NULL THEN 0 ELSE 1 END AS hit FROM students s CROSS JOIN tops t
   LEFT JOIN truth g ON g.student_id = s.student_id AND g.course_id = t.course_id WHERE s.student_id IN (SELECT student_id FROM truth)),
 per AS (SELECT model, student_id, SUM(hit / LOG2(place + 1)) AS d, SUM(hit / LOG2(best + 1)) AS i, AVG(hit) AS p FROM
   (SELECT *, ROW_NUMBER() OVER (PARTITION BY model, student_id ORDER BY hit DESC, course_id) AS best FROM lists) GROUP BY 1, 2),
 n AS (SELECT model, student_id, p, CASE WHEN i > 0 THEN d / i ELSE 0 END AS v FROM per)
 SELECT model, COALESCE(AVG(CASE WHEN p > 0 THEN v END), 0) AS ndcg_of_hits, COALESCE(AVG(CASE WHEN p > 0 THEN p END), 0) AS precision_of_hits,
  AVG(v) AS ndcg, AVG(p) AS precision, COUNT(*) AS students FROM n GROUP BY 1"""
COMPARE_DOUBLES = ["ndcg_of_hits", "precision_of_hits", "ndcg", "precision"]


def popularity_lists(c, n=10):
    out = None
    for m in METRICS:
        scored = popularity(c.courses, c.enrollments, m)
        rows = popular_for_all(c.students, scored, n).select("student_id", "course_id", "score", F.lit(m).alias("model"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("m12_compare_baselines", COMPARE_SQL, COMPARE_DOUBLES)
def _(c):
    return rm.compare_models(popularity_lists(c), c.interactions)


@query("m13_model_performance", f"SELECT model, ndcg_of_hits, students FROM ({COMPARE_SQL})", ["ndcg_of_hits"])
def _(c):
    return rm.compare_models(popularity_lists(c), c.interactions).select("model", "ndcg_of_hits", "students")
