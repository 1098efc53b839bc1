"""Filters, joins, set operations and sorts (rows C, D, G, H)."""

from pyspark.sql import functions as F

from cohortlens.functions import expr
from cohortlens.operators import engagement, marks, recommend, risk, vectors
from cohortlens.plans.registry import query

WEEKS_SQL = """SELECT student_id, GREATEST(COALESCE(v, 0), COALESCE(a, 0)) AS n_weeks
 FROM (SELECT student_id, COUNT(DISTINCT week) AS v FROM vle_engagement GROUP BY 1) x
 FULL JOIN (SELECT student_id, COUNT(DISTINCT week) AS a FROM attendance GROUP BY 1) y USING (student_id)"""


@query("c1_min_history", f"SELECT student_id, n_weeks FROM ({WEEKS_SQL}) WHERE n_weeks >= 20")
def _(c):
    return engagement.with_enough_history(c.vle_engagement, c.attendance, 20)


@query(
    "c2_before_final_year",
    """SELECT student_id, COUNT(*) AS n, SUM(mark) AS marks FROM assessments JOIN modules USING (module_id)
       WHERE year < 3 GROUP BY 1""",
    ["marks"],
)
def _(c):
    early = marks.before_final_year(c.assessments, c.modules)
    return early.groupBy("student_id").agg(F.count("*").alias("n"), F.sum("mark").alias("marks"))


@query(
    "c3_membership",
    """SELECT student_id, final_classification FROM enrollments WHERE final_classification IN ('First', '2:1')""",
)
def _(c):
    good = F.col("final_classification").isin("First", "2:1")
    return c.enrollments.where(good).select("student_id", "final_classification")


@query(
    "c4_min_tier",
    f"""SELECT student_id, tier FROM (SELECT student_id, {{tier}} AS tier FROM (SELECT student_id, 100 * score AS s FROM predictions))
       WHERE tier IN ('HIGH', 'VERY_HIGH', 'CRITICAL')""".replace("{tier}", """CASE WHEN s <= 20 THEN 'LOW'
 WHEN s <= 40 THEN 'MEDIUM' WHEN s <= 60 THEN 'HIGH' WHEN s <= 80 THEN 'VERY_HIGH' ELSE 'CRITICAL' END"""),
)
def _(c):
    scored = c.predictions.select("student_id", (F.col("score") * 100).alias("risk_score"))
    tiered = scored.withColumn("tier", risk.tier(F.col("risk_score")))
    return tiered.where(risk.at_least(F.col("tier"), "HIGH")).select("student_id", "tier")


@query(
    "c5_drop_unmapped_target",
    """SELECT student_id, CASE final_classification WHEN 'First' THEN 4 WHEN '2:1' THEN 3 WHEN '2:2' THEN 2
       WHEN 'Third' THEN 1 WHEN 'Fail' THEN 0 END AS target FROM enrollments
       WHERE final_classification IN ('First', '2:1', '2:2', 'Third', 'Fail')""",
)
def _(c):
    from cohortlens.operators.targets import DEGREE_CODES

    coded = c.enrollments.withColumn("target", expr.lookup(F.col("final_classification"), DEGREE_CODES))
    return coded.dropna(subset=["target"]).select("student_id", "target")


POPULAR_SQL = """SELECT course_id, COUNT(e.student_id) AS n FROM courses LEFT JOIN enrollments e USING (course_id) GROUP BY course_id"""


@query(
    "c6_exclude_taken",
    f"""WITH popular AS (SELECT course_id, n FROM ({POPULAR_SQL}) ORDER BY n DESC, course_id LIMIT 20)
        SELECT s.student_id, p.course_id, p.n FROM students s CROSS JOIN popular p
        WHERE NOT EXISTS (SELECT 1 FROM interactions i WHERE i.student_id = s.student_id AND i.course_id = p.course_id)""",
)
def _(c):
    listed = recommend.popular_for_all(c.students, recommend.popularity(c.courses, c.enrollments), 20)
    kept = recommend.exclude_taken(listed, c.interactions)
    return kept.select("student_id", "course_id", F.col("score").cast("bigint").alias("n"))


@query("c7_at_risk_above", "SELECT student_id, score FROM predictions WHERE score >= 0.7", ["score"])
def _(c):
    return c.predictions.where(F.col("score") >= 0.7).select("student_id", "score")


@query(
    "c8_follow_ups_due",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS follow_up FROM orders
       WHERE CAST(o_orderdate AS DATE) <= DATE '1995-06-08'""",
)
def _(c):
    from cohortlens.operators.dashboard import follow_ups_due

    log = c.raw("orders").select("o_orderkey", F.to_date("o_orderdate").alias("follow_up"))
    return follow_ups_due(log, "1995-06-01")


@query("c9_week_cap", "SELECT student_id, week, total_actions FROM vle_engagement WHERE week <= 12")
def _(c):
    return c.vle_engagement.where(F.col("week") <= 12).select("student_id", "week", "total_actions")


@query(
    "d1_left_join",
    """SELECT student_id, enrollment_status, gender, qualification_type, department FROM enrollments
       LEFT JOIN students USING (student_id) LEFT JOIN qualifications USING (student_id)
       LEFT JOIN courses USING (course_id)""",
)
def _(c):
    return (
        c.enrollments.join(c.students, "student_id", "left")
        .join(c.qualifications, "student_id", "left")
        .join(c.courses, "course_id", "left")
        .select("student_id", "enrollment_status", "gender", "qualification_type", "department")
    )


@query(
    "d2_inner_join",
    "SELECT course_id, COUNT(*) AS n, SUM(mark) AS marks FROM assessments JOIN enrollments USING (student_id) GROUP BY 1",
    ["marks"],
)
def _(c):
    # one row per student on both sides before the join: a student with very many marks shuffles as one row
    totals = c.assessments.groupBy("student_id").agg(F.count("*").alias("n"), F.sum("mark").alias("marks"))
    joined = totals.join(c.enrollments.select("student_id", "course_id"), "student_id")
    return joined.groupBy("course_id").agg(F.sum("n").alias("n"), F.sum("marks").alias("marks"))


@query(
    "d3_full_outer_join",
    """SELECT student_id, n_marks, n_weeks FROM (SELECT student_id, COUNT(*) AS n_marks FROM assessments GROUP BY 1) a
       FULL JOIN (SELECT student_id, COUNT(*) AS n_weeks FROM vle_engagement GROUP BY 1) v USING (student_id)""",
)
def _(c):
    a = c.assessments.groupBy("student_id").agg(F.count("*").alias("n_marks"))
    v = c.vle_engagement.groupBy("student_id").agg(F.count("*").alias("n_weeks"))
    return a.join(v, "student_id", "full_outer")


@query(
    "d4_dimension_lookup",
    """SELECT student_id, COALESCE(course_length_years, 3) AS course_length FROM enrollments LEFT JOIN courses USING (course_id)""",
)
def _(c):
    lengths = c.courses.select("course_id", "course_length_years")
    return c.enrollments.join(lengths, "course_id", "left").select(
        "student_id", F.coalesce("course_length_years", F.lit(3)).alias("course_length")
    )


@query(
    "d5_dedupe_then_join",
    """WITH one AS (SELECT * FROM (SELECT o_custkey AS student_id, o_orderkey, o_totalprice,
         ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1)
       SELECT student_id, gender, o_orderkey, o_totalprice FROM students JOIN one USING (student_id)""",
    ["o_totalprice"],
)
def _(c):
    first = recommend.first_per_key(
        c.raw("orders").withColumnRenamed("o_custkey", "student_id"), "student_id", ["o_orderkey", "o_totalprice"]
    )
    return c.students.join(first, "student_id").select("student_id", "gender", "o_orderkey", "o_totalprice")


@query(
    "d6_union_ids_defaults",
    """WITH ids AS (SELECT student_id FROM vle_engagement UNION SELECT student_id FROM attendance UNION SELECT student_id FROM assessments)
       SELECT student_id, CAST(COALESCE(l, 0) AS BIGINT) AS logins, COALESCE(n, 0) AS n_assessments,
         COALESCE(imd_decile, 5) AS imd_decile FROM ids
       LEFT JOIN (SELECT student_id, SUM(logins) AS l FROM vle_engagement GROUP BY 1) v USING (student_id)
       LEFT JOIN (SELECT student_id, COUNT(*) AS n FROM assessments GROUP BY 1) a USING (student_id)
       LEFT JOIN students USING (student_id)""",
)
def _(c):
    v = c.vle_engagement.groupBy("student_id").agg(F.sum("logins").alias("logins"))
    a = c.assessments.groupBy("student_id").agg(F.count("*").alias("n_assessments"))
    seen = c.attendance.select("student_id").distinct()
    # full joins of per-source aggregates keep every id without a separate union pass
    merged = v.join(a, "student_id", "full_outer").join(seen, "student_id", "full_outer")
    return merged.join(c.students, "student_id", "left").select(
        "student_id",
        F.coalesce("logins", F.lit(0)).alias("logins"),
        F.coalesce("n_assessments", F.lit(0)).alias("n_assessments"),
        F.coalesce("imd_decile", F.lit(5)).alias("imd_decile"),
    )


COSINE_SQL = """WITH items AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
 scored AS (SELECT a.vec_id AS query_id, b.vec_id AS item_id,
   ROUND(LIST_DOT_PRODUCT(a.v, b.v) / (SQRT(LIST_DOT_PRODUCT(a.v, a.v)) * SQRT(LIST_DOT_PRODUCT(b.v, b.v))), 6) AS score
   FROM items a JOIN items b ON a.vec_id <> b.vec_id),
 ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS place FROM scored)"""


@query(
    "d7_candidate_pairs",
    COSINE_SQL + " SELECT query_id, item_id, score FROM ranked WHERE place <= 3",
    ["score"],
)
def _(c):
    v = c.raw("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return vectors.most_similar(v, v, 3, same=False).select("query_id", "item_id", "score")


@query(
    "d8_anti_join",
    """SELECT course_id, department FROM courses WHERE course_id NOT IN (SELECT course_id FROM enrollments)""",
)
def _(c):
    taken = c.enrollments.select("course_id").distinct()
    return c.courses.join(taken, "course_id", "left_anti").select("course_id", "department")


@query(
    "d9_score_lookup",
    """WITH pop AS (SELECT course_id, COUNT(*) AS n FROM enrollments GROUP BY 1)
       SELECT e.student_id, e.course_id, CAST(COALESCE(n, 0) AS DOUBLE) AS popularity, COALESCE(rating, 0) AS rating
       FROM enrollments e LEFT JOIN pop USING (course_id)
       LEFT JOIN interactions i ON i.student_id = e.student_id AND i.course_id = e.course_id""",
    ["popularity", "rating"],
)
def _(c):
    pop = c.enrollments.groupBy("course_id").agg(F.count("*").cast("double").alias("popularity"))
    met = c.interactions.select("student_id", "course_id", "rating")
    pairs = c.enrollments.select("student_id", "course_id")
    return pairs.join(pop, "course_id", "left").join(met, ["student_id", "course_id"], "left").select(
        "student_id",
        "course_id",
        F.coalesce("popularity", F.lit(0.0)).alias("popularity"),
        F.coalesce("rating", F.lit(0.0)).alias("rating"),
    )


@query(
    "d10_representative_join",
    """WITH rep AS (SELECT course_id, MIN(module_id) AS module_id FROM modules GROUP BY 1)
       SELECT student_id, course_id, module_id FROM enrollments LEFT JOIN rep USING (course_id)""",
)
def _(c):
    rep = recommend.first_per_key(c.modules, "course_id", ["module_id"])
    return c.enrollments.join(rep, "course_id", "left").select("student_id", "course_id", "module_id")


@query(
    "d11_comparable_pairs",
    """WITH s AS (SELECT student_id, 1 + student_id % 30 AS time, student_id % 3 < 2 AS event, score FROM predictions)
       SELECT COUNT(*) AS comparable, COUNT(CASE WHEN a.score > b.score THEN 1 END) AS concordant,
         COUNT(CASE WHEN a.score = b.score THEN 1 END) AS tied
       FROM s a JOIN s b ON a.time < b.time WHERE a.event""",
)
def _(c):
    from cohortlens.operators.survival import comparable_pairs

    rows = c.predictions.select(
        (1 + F.col("student_id") % 30).cast("int").alias("time"),
        (F.col("student_id") % 3 < 2).cast("int").alias("event"),
        F.col("score").alias("risk"),
    )
    return comparable_pairs(rows)


@query(
    "g1_top_popular",
    f"SELECT course_id, n FROM ({POPULAR_SQL}) ORDER BY n DESC, course_id LIMIT 10",
)
def _(c):
    counted = recommend.popularity(c.courses, c.enrollments)
    return counted.orderBy(F.desc("score"), "course_id").limit(10).select(
        "course_id", F.col("score").cast("bigint").alias("n")
    )


@query(
    "g2_top_risk",
    "SELECT student_id, score FROM predictions ORDER BY score DESC, student_id LIMIT 25",
    ["score"],
)
def _(c):
    return c.predictions.orderBy(F.desc("score"), "student_id").limit(25).select("student_id", "score")


@query(
    "g3_sort_modes",
    """SELECT 'score_desc' AS mode, student_id, place FROM (SELECT student_id, ROW_NUMBER() OVER (ORDER BY score DESC, student_id) AS place FROM predictions) WHERE place <= 50
       UNION ALL SELECT 'score_asc', student_id, place FROM (SELECT student_id, ROW_NUMBER() OVER (ORDER BY score, student_id) AS place FROM predictions) WHERE place <= 50
       UNION ALL SELECT 'last_activity', student_id, place FROM (SELECT student_id, ROW_NUMBER() OVER (ORDER BY last_week DESC, student_id) AS place FROM
         (SELECT student_id, MAX(week) AS last_week FROM vle_engagement GROUP BY 1)) WHERE place <= 50""",
)
def _(c):
    from cohortlens.operators.dashboard import sorted_list

    activity = c.vle_engagement.groupBy("student_id").agg(F.max("week").alias("last_activity"))
    people = c.predictions.select("student_id", "score").join(activity, "student_id", "left")
    out = [sorted_list(people, mode, 50).withColumn("mode", F.lit(mode)) for mode in ("score_desc", "score_asc")]
    out.append(sorted_list(people.dropna(subset=["last_activity"]), "last_activity", 50).withColumn("mode", F.lit("last_activity")))
    return out[0].unionByName(out[1]).unionByName(out[2]).select("mode", "student_id", "place")


@query(
    "g5_nearest_vectors",
    COSINE_SQL + " SELECT query_id, item_id, 1 - score AS distance, CAST(place AS INT) AS place FROM ranked WHERE place <= 10",
    ["distance"],
)
def _(c):
    v = c.raw("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    near = vectors.most_similar(v, v, 10, same=False)
    return near.select("query_id", "item_id", (1 - F.col("score")).alias("distance"), F.col("rank").alias("place"))


@query(
    "h1_union_ids",
    """SELECT student_id FROM vle_engagement UNION SELECT student_id FROM attendance UNION SELECT student_id FROM enrollments""",
)
def _(c):
    ids = [t.select("student_id") for t in (c.vle_engagement, c.attendance, c.enrollments)]
    return ids[0].union(ids[1]).union(ids[2]).distinct()


@query(
    "h2_intersection",
    "SELECT course_id FROM enrollments INTERSECT SELECT course_id FROM interactions",
)
def _(c):
    return c.enrollments.select("course_id").intersect(c.interactions.select("course_id"))


@query(
    "h3_difference",
    "SELECT course_id FROM courses EXCEPT SELECT course_id FROM enrollments",
)
def _(c):
    return c.courses.select("course_id").subtract(c.enrollments.select("course_id"))


@query(
    "h4_category_union",
    """SELECT ethnicity, COALESCE(a, 0) AS completed, COALESCE(b, 0) AS withdrawn FROM
       (SELECT ethnicity, COUNT(*) AS a FROM students JOIN enrollments USING (student_id) WHERE enrollment_status = 'Completed' GROUP BY 1) x
       FULL JOIN (SELECT ethnicity, COUNT(*) AS b FROM students JOIN enrollments USING (student_id) WHERE enrollment_status = 'Withdrawn' GROUP BY 1) y USING (ethnicity)""",
)
def _(c):
    joined = c.students.join(c.enrollments, "student_id")
    a = joined.where(F.col("enrollment_status") == "Completed").groupBy("ethnicity").agg(F.count("*").alias("completed"))
    b = joined.where(F.col("enrollment_status") == "Withdrawn").groupBy("ethnicity").agg(F.count("*").alias("withdrawn"))
    both = a.join(b, "ethnicity", "full_outer")
    return both.select("ethnicity", F.coalesce("completed", F.lit(0)).alias("completed"), F.coalesce("withdrawn", F.lit(0)).alias("withdrawn"))


@query(
    "h5_append_rows",
    """SELECT student_id, 'meeting' AS action FROM enrollments WHERE enrollment_status = 'Withdrawn'
       UNION ALL SELECT student_id, 'email' FROM enrollments WHERE retained_year2 = 0""",
)
def _(c):
    log = c.enrollments.where(F.col("enrollment_status") == "Withdrawn").select("student_id", F.lit("meeting").alias("action"))
    more = c.enrollments.where(F.col("retained_year2") == 0).select(F.lit("email").alias("action"), "student_id")
    return log.unionByName(more)
