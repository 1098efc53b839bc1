"""Course recommenders over long score tables ``(student_id, course_id, score)``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.expr import sigmoid
from cohortlens.functions.ordering import top_n
from cohortlens.session import spread

#: Rows of lists that one task may make.
LISTED_ROWS = 2**20


def first_per_key(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by ``columns`` in their order, combined map-side."""
    picked = df.groupBy(key).agg(F.min(F.struct(*columns)).alias("_row"))
    return picked.select(key, *[F.col(f"_row.{c}").alias(c) for c in columns])


def best_courses(scores: DataFrame, n: int) -> DataFrame:
    """First ``n`` courses per student by score, ties by course id."""
    return top_n(scores, "student_id", [F.desc("score"), F.asc("course_id")], n)


def popularity(courses: DataFrame, enrollments: DataFrame, metric: str = "enrollment_count") -> DataFrame:
    """Score of every course: enrolments, employment rate or satisfaction."""
    if metric == "enrollment_count":
        counts = enrollments.groupBy("course_id").agg(F.count("student_id").alias("_n"))
        return courses.join(counts, "course_id", "left").select(
            "course_id", F.coalesce("_n", F.lit(0)).cast("double").alias("score")
        )
    column = {"employment_rate": "employment_rate_15m", "satisfaction": "satisfaction_score"}[metric]
    return courses.select("course_id", F.coalesce(F.col(column).cast("double"), F.lit(0.0)).alias("score"))


def popular_for_all(students: DataFrame, course_scores: DataFrame, n: int) -> DataFrame:
    """The same ``n`` best courses for every student.

    The list is one array of ``n`` entries in a scalar subquery, so the students are not
    joined. Many ids are spread first: one task may read them all from a small file, and the
    hash table of an aggregate over its ``n`` times as many rows would be its alone.
    """
    listed = (
        course_scores.orderBy(F.desc("score"), F.asc("course_id"))
        .limit(n)
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "course_id"))))
        .scalar()
    )
    ids = students.select("student_id")
    ids = spread(ids, ids.count() * n, "student_id", per_task=LISTED_ROWS)
    rows = ids.select("student_id", F.posexplode(listed).alias("at", "entry"))
    return rows.select(
        "student_id",
        F.col("entry.course_id").alias("course_id"),
        (-F.col("entry.minus")).alias("score"),
        (F.col("at") + 1).alias("rank"),
    )


def exclude_taken(scores: DataFrame, taken: DataFrame) -> DataFrame:
    """Scores without the courses a student already took."""
    return scores.join(taken.select("student_id", "course_id"), ["student_id", "course_id"], "left_anti")


def taken_courses(taken: DataFrame) -> DataFrame:
    """Sorted courses of every student as one array (for records that show them)."""
    return taken.groupBy("student_id").agg(F.array_sort(F.collect_set("course_id")).alias("courses"))


def normalised(weights: Mapping[str, float]) -> dict[str, float]:
    """Weights that add up to one."""
    total = sum(weights.values())
    if total <= 0:
        raise ValueError("weights must add up to more than zero")
    return {m: w / total for m, w in weights.items()}


def weight_of(model: Column, weights: Mapping[str, float]) -> Column:
    out = F.lit(0.0)
    for name, w in weights.items():
        out = F.when(model == name, F.lit(float(w))).otherwise(out)
    return out


def fuse(scores: DataFrame, weights: Mapping[str, float], n: int) -> DataFrame:
    """Weighted mean of the scores over the models that know the student, best ``n``.

    ``scores`` is (student_id, course_id, model, score). A course missing from a
    model's list counts as zero there.
    """
    w = weight_of(F.col("model"), weights)
    summed = scores.groupBy("student_id", "course_id").agg(F.sum(w * F.col("score")).alias("_sum"))
    per_model = scores.groupBy("student_id", "model").agg(F.first(w).alias("_w"))
    available = per_model.groupBy("student_id").agg(F.sum("_w").alias("_total"))
    fused = summed.join(available, "student_id").select(
        "student_id", "course_id", F.coalesce(F.try_divide("_sum", "_total"), F.lit(0.0)).alias("score")
    )
    return best_courses(fused, n)


def explain_fusion(scores: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """What each model adds to a course: (student, course, model, weight, score, contribution)."""
    w = weight_of(F.col("model"), weights)
    return scores.select(
        "student_id", "course_id", "model", w.alias("weight"), "score", (w * F.col("score")).alias("contribution")
    )


def ensemble(scores: DataFrame, weights: Mapping[str, float], n: int) -> DataFrame:
    """Mean over models of weight · sigmoid(score), best ``n`` courses per student."""
    share = normalised(weights)
    squashed = weight_of(F.col("model"), share) * sigmoid(F.col("score"))
    fused = spread(scores, scores.count(), "student_id").groupBy("student_id", "course_id").agg((F.sum(squashed) / F.count("*")).alias("score"))
    return best_courses(fused, n)


def wide_scores(scores: DataFrame, models: Sequence[str]) -> DataFrame:
    """One row per student and course with one column of the highest score per model, in one aggregate."""
    best = [F.max(F.when(F.col("model") == m, F.col("score"))).alias(m) for m in models]
    return spread(scores, scores.count(), "student_id").groupBy("student_id", "course_id").agg(*best)


def scores_by_model(listed: DataFrame, scores: DataFrame, models: Sequence[str]) -> DataFrame:
    """The listed courses with one column of raw scores per model."""
    pair, rows = ["student_id", "course_id"], scores.count()
    return spread(listed, rows, *pair).join(spread(wide_scores(scores, models), rows, *pair), pair, "left")


def next_prime(n: int) -> int:
    """Smallest prime of at least ``n``."""
    while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def random_courses(students: DataFrame, courses: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """``n`` courses per student by a reproducible random score, without scoring all pairs.

    Each student walks through the catalogue positions in steps of a length of its own;
    only the courses met get a score. The walk meets ``n`` courses, or all if there are
    fewer, whatever the size of the catalogue.
    """
    from cohortlens.operators.prep import place_in_group

    size = courses.count()
    drawn = F.xxhash64("course_id", F.lit(seed))
    keyed = courses.select("course_id", drawn.alias("_draw"), F.lit(0).alias("_all"))
    numbered = place_in_group(keyed, "_all", "_draw", "course_id", spread=True).select(
        "course_id", (F.col("_place") - 1).alias("_position")
    )
    # position j of a student is (start + j * step) modulo a prime of at least ``size``: all
    # are distinct, and no more than prime - size of them lie outside the catalogue
    prime = next_prime(max(size, 2))
    start = F.pmod(F.xxhash64("student_id", F.lit(seed), F.lit(0)), F.lit(prime))
    step = 1 + F.pmod(F.xxhash64("student_id", F.lit(seed), F.lit(1)), F.lit(prime - 1))
    turns = F.sequence(F.lit(0), F.lit(min(prime, n + prime - size) - 1))
    places = F.transform(turns, lambda j: (start + j * step) % prime)
    positions = F.slice(F.filter(places, lambda x: x < size), 1, n)
    rows = students.select("student_id", F.explode(positions).alias("_position"))
    score = F.pmod(F.xxhash64("student_id", "course_id", F.lit(seed)), F.lit(1_000_000_007)) / 1_000_000_007
    # the catalogue may be of any size: it is shuffled, not broadcast through the driver
    scored = rows.join(numbered.hint("merge"), "_position").select("student_id", "course_id", score.alias("score"))
    return best_courses(scored, n)


# Weights of the aligned components.
COMPONENTS = {"qualification": 0.3, "grade": 0.3, "subject": 0.2, "outcome": 0.2}


def student_components(students: DataFrame, qualifications: DataFrame) -> DataFrame:
    """What a student brings, on the scale of ``course_components``.

    Qualification: how exam-based the route is. Grade: tariff. Subject: need for a
    well-rated course, from local deprivation. Outcome: contextual advantage.
    """
    kind = F.col("qualification_type")
    exams = F.when(kind == "A-Level", 0.6).when(kind == "International Baccalaureate", 0.55).when(kind == "BTEC", 0.35)
    low = (F.col("polar_quintile") == 1).cast("int")
    context = F.col("care_leaver") * 3 + F.col("first_generation_uni") * 2 + low
    parts = [
        exams.otherwise(0.45),
        F.col("ucas_tariff_points") / 168.0,
        (11 - F.col("imd_decile")) / 10.0,
        1.0 - context / 6.0,
    ]
    joined = students.join(qualifications, "student_id", "left")
    return joined.select(F.col("student_id").alias("id"), F.array(*[F.coalesce(p, F.lit(0.0)) for p in parts]).alias("parts"))


def course_components(courses: DataFrame) -> DataFrame:
    """Exam share, entry tariff, satisfaction and employment of a course."""
    parts = [
        F.col("exam_weight_pct") / 100.0,
        F.col("entry_tariff") / 168.0,
        F.col("satisfaction_score") / 5.0,
        F.col("employment_rate_15m"),
    ]
    return courses.select(F.col("course_id").alias("id"), F.array(*parts).alias("parts"))


def weighted_vector(parts: Column) -> Column:
    """Components scaled so that a dot product carries the component weights."""
    roots = F.array(*[F.lit(w**0.5) for w in COMPONENTS.values()])
    return F.zip_with(parts, roots, lambda x, r: x * r)


def content_based(students: DataFrame, qualifications: DataFrame, courses: DataFrame, n: int) -> DataFrame:
    """Courses by weighted cosine of the components, limited to [0, 1]."""
    from cohortlens.operators.vectors import most_similar_by_profile

    people = student_components(students, qualifications).select("id", weighted_vector(F.col("parts")).alias("vector"))
    items = course_components(courses).select("id", weighted_vector(F.col("parts")).alias("vector"))
    return as_courses(most_similar_by_profile(people, items, n, lower=0.0))


def as_courses(found: DataFrame) -> DataFrame:
    return found.withColumnsRenamed({"query_id": "student_id", "item_id": "course_id"})


def explain_match(pairs: DataFrame, students: DataFrame, courses: DataFrame, n: int = 5) -> DataFrame:
    """Closest components of given (student, course) pairs with the overall cosine."""
    from cohortlens.operators.vectors import cosine

    joined = (
        pairs.select("student_id", "course_id")
        .join(students.select(F.col("id").alias("student_id"), F.col("parts").alias("s")), "student_id")
        .join(courses.select(F.col("id").alias("course_id"), F.col("parts").alias("c")), "course_id")
    )
    names = F.array(*[F.lit(x) for x in COMPONENTS])
    cells = F.zip_with(
        names,
        F.arrays_zip("s", "c"),
        lambda name, v: F.struct(
            (F.abs(v["s"] - v["c"])).alias("gap"), name.alias("feature"), v["s"].alias("student_value"), v["c"].alias("course_value")
        ),
    )
    closest = F.slice(F.array_sort(cells), 1, n)
    rows = joined.select("student_id", "course_id", cosine(F.col("s"), F.col("c")).alias("overall"), F.explode(closest).alias("e"))
    return rows.select(
        "student_id", "course_id", "overall", "e.feature", "e.student_value", "e.course_value",
        (1 - F.col("e.gap")).alias("similarity"),
    )


ROUTES = ["matrix_factorization", "content_based", "popularity"]


def route(students: DataFrame, qualifications: DataFrame, taken: DataFrame) -> DataFrame:
    """Which recommender serves a student: history, else a known tariff, else popularity."""
    active = taken.select("student_id").distinct().withColumn("_history", F.lit(True))
    known = qualifications.where(F.col("ucas_tariff_points").isNotNull()).select("student_id", F.lit(True).alias("_known"))
    joined = students.select("student_id").join(active, "student_id", "left").join(known, "student_id", "left")
    choice = F.when(F.col("_history"), ROUTES[0]).when(F.col("_known"), ROUTES[1]).otherwise(ROUTES[2])
    return joined.select("student_id", choice.alias("route"))


def routed(routes: DataFrame, scores: DataFrame, fallback: Sequence[str] = ("content_based", "popularity")) -> DataFrame:
    """Rows of the routed model, or of the first model in the fallback chain that has any.

    ``scores`` is (student_id, course_id, model, score, …). Both steps are aggregates
    and joins by student.
    """
    have = scores.select("student_id", "model").distinct()
    order = F.when(F.col("model") == F.col("route"), 0)
    for i, name in enumerate(fallback, start=1):
        order = order.when(F.col("model") == name, i)
    chosen = (
        have.join(routes, "student_id")
        .withColumn("_order", order)
        .where(F.col("_order").isNotNull())
        .groupBy("student_id")
        .agg(F.min(F.struct("_order", "model")).alias("_pick"))
        .select("student_id", F.col("_pick.model").alias("model"))
    )
    return scores.join(chosen, ["student_id", "model"])
