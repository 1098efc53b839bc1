"""Ranking metrics over long tables ``(student_id, course_id, score, relevance)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.expr import squared
from cohortlens.functions.ordering import top_n


def first_k(judged: DataFrame, k: int, by: str = "score", keys: Sequence[str] = ("student_id",)) -> DataFrame:
    return top_n(judged, list(keys), [F.desc(by), F.asc("course_id")], k)


def discounted(relevance: Column, rank: Column) -> Column:
    return relevance / F.log2(rank + 1)


def dcg(judged: DataFrame, k: int, by: str = "score", into: str = "dcg", keys: Sequence[str] = ("student_id",)) -> DataFrame:
    """Discounted gain of the first ``k`` rows of every list."""
    return first_k(judged, k, by, keys).groupBy(*keys).agg(F.sum(discounted(F.col("relevance"), F.col("rank"))).alias(into))


def ndcg(judged: DataFrame, k: int, keys: Sequence[str] = ("student_id",)) -> DataFrame:
    """DCG relative to the best order of the same list; 0 if nothing is relevant."""
    best = dcg(judged, k, by="relevance", into="_ideal", keys=keys)
    ratio = F.when(F.col("_ideal") > 0, F.col("dcg") / F.col("_ideal")).otherwise(F.lit(0.0))
    return dcg(judged, k, keys=keys).join(best, list(keys)).select(*keys, ratio.alias("ndcg"))


def reciprocal_rank(judged: DataFrame) -> DataFrame:
    """1 / place of the first relevant row, 0 without one.

    The place is one more than the number of rows ahead of the best relevant row, a
    count that is combined map-side; no list is sorted.
    """
    place = F.struct(F.col("score"), (-F.col("course_id")).alias("tie"))
    best = judged.groupBy("student_id").agg(F.max(F.when(F.col("relevance") > 0, place)).alias("_best"))
    ahead = judged.join(best, "student_id").groupBy("student_id").agg(
        F.count_if(place > F.col("_best")).alias("_ahead"), F.max(F.col("_best").isNotNull()).alias("_any")
    )
    return ahead.select(
        "student_id", F.when(F.col("_any"), 1.0 / (F.col("_ahead") + 1)).otherwise(F.lit(0.0)).alias("rr")
    )


def precision(judged: DataFrame, k: int, keys: Sequence[str] = ("student_id",)) -> DataFrame:
    return first_k(judged, k, keys=keys).groupBy(*keys).agg(F.avg("relevance").alias("precision"))


def recall(judged: DataFrame, k: int) -> DataFrame:
    hits = first_k(judged, k).groupBy("student_id").agg(F.sum("relevance").alias("_hits"))
    total = judged.groupBy("student_id").agg(F.sum("relevance").alias("_total"))
    share = F.coalesce(F.try_divide("_hits", "_total"), F.lit(0.0))
    return total.join(hits, "student_id").select("student_id", share.alias("recall"))


def average_precision(predicted: DataFrame, actual: DataFrame, k: int) -> DataFrame:
    """AP@k of ranked lists ``(student_id, rank, course_id)``; a repeated item counts once."""
    head = predicted.where(F.col("rank") <= k)
    first = head.groupBy("student_id", "course_id").agg(F.min("rank").alias("rank"))
    truth = actual.select("student_id", "course_id").distinct()
    hits = first.join(truth, ["student_id", "course_id"])
    upto = Window.partitionBy("student_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    gained = hits.withColumn("_gain", F.count("*").over(upto) / F.col("rank"))
    sums = gained.groupBy("student_id").agg(F.sum("_gain").alias("_sum"))
    wanted = actual.groupBy("student_id").agg(F.count("*").alias("_wanted"))
    users = predicted.select("student_id").distinct()
    ap = F.coalesce(F.col("_sum") / F.least(F.col("_wanted"), F.lit(k)), F.lit(0.0))
    return users.join(wanted, "student_id", "left").join(sums, "student_id", "left").select("student_id", ap.alias("ap"))


def intra_list_distance(lists: DataFrame, vectors: DataFrame) -> DataFrame:
    """Mean pairwise distance within each short list of at least two items.

    ``lists`` holds top-n lists, so one array per student has n vectors at most; the
    pairs are summed inside the row and never become rows.
    """
    packed = (
        lists.join(vectors, "course_id")
        .groupBy("student_id")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "vector"))).alias("_items"))
        .select("student_id", F.col("_items.vector").alias("v"), F.size("_items").alias("n"))
        .where(F.col("n") >= 2)
    )
    gap = lambda a, b: F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: squared(x - y)), F.lit(0.0), lambda s, x: s + x))
    later = lambda i: F.slice(F.col("v"), i + 2, F.col("n"))
    per_item = F.transform("v", lambda a, i: F.aggregate(later(i), F.lit(0.0), lambda s, b: s + gap(a, b)))
    total = F.aggregate(per_item, F.lit(0.0), lambda s, x: s + x)
    return packed.select("student_id", (total / (F.col("n") * (F.col("n") - 1) / 2)).alias("distance"))


def coverage(recommended: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Share of the catalogue that is recommended to somebody."""
    shown = recommended.select("course_id").distinct().withColumn("_shown", F.lit(1))
    return (
        catalogue.select("course_id").distinct().join(shown, "course_id", "left")
        .agg(F.coalesce(F.try_divide(F.count("_shown"), F.count("*")), F.lit(0.0)).alias("coverage"))
    )


def novelty(recommended: DataFrame, popularity: DataFrame, n_users: Column) -> DataFrame:
    """Mean over students of the mean -log2 popularity of their items; unknown items are skipped."""
    known = recommended.join(popularity.where(F.col("popularity") > 0), "course_id")
    per_student = known.groupBy("student_id").agg(F.avg(-F.log2(F.col("popularity") / n_users)).alias("_n"))
    return per_student.agg(F.coalesce(F.avg("_n"), F.lit(0.0)).alias("novelty"))


def evaluate(judged: DataFrame, ks: Sequence[int] = (5, 10, 20)) -> DataFrame:
    """NDCG, precision and recall at each k and MRR, averaged over students: (metric, value).

    One ranking by score and one by relevance serve every k.
    """
    most = max(ks)
    at = F.col("rank")
    real = first_k(judged, most).groupBy("student_id").agg(
        *[F.sum(F.when(at <= k, discounted(F.col("relevance"), at))).alias(f"dcg_{k}") for k in ks],
        *[F.avg(F.when(at <= k, F.col("relevance"))).alias(f"precision_{k}") for k in ks],
        *[F.sum(F.when(at <= k, F.col("relevance"))).alias(f"hits_{k}") for k in ks],
    )
    ideal = first_k(judged, most, by="relevance").groupBy("student_id").agg(
        *[F.sum(F.when(at <= k, discounted(F.col("relevance"), at))).alias(f"ideal_{k}") for k in ks]
    )
    total = judged.groupBy("student_id").agg(F.sum("relevance").alias("total"))
    per = real.join(ideal, "student_id").join(total, "student_id").join(reciprocal_rank(judged), "student_id")
    ratio = lambda a, b: F.avg(F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0)))
    named = {}
    for k in ks:
        named[f"ndcg_at_{k}"] = ratio(f"dcg_{k}", f"ideal_{k}")
        named[f"precision_at_{k}"] = F.avg(f"precision_{k}")
        named[f"recall_at_{k}"] = ratio(f"hits_{k}", "total")
    named["mrr"] = F.avg("rr")
    return long_metrics(per.agg(*[v.alias(m) for m, v in named.items()]), list(named))


def long_metrics(one: DataFrame, names: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Columns of metric values as rows (…keys, metric, value)."""
    cells = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(f"`{n}`").cast("double").alias("value")) for n in names])
    return one.select(*keys, F.explode(cells).alias("cell")).select(*keys, "cell.metric", "cell.value")


def compare_models(scores: DataFrame, positives: DataFrame, k: int = 10) -> DataFrame:
    """NDCG@k and precision@k per model, over students with a hit and over all students."""
    truth = positives.select("student_id", "course_id").distinct().withColumn("relevance", F.lit(1))
    known = positives.select("student_id").distinct()
    judged = (
        scores.join(truth, ["student_id", "course_id"], "left")
        .fillna(0, subset=["relevance"])
        .join(known, "student_id", "left_semi")
    )
    keys = ("model", "student_id")
    per = ndcg(judged, k, keys).join(precision(judged, k, keys), list(keys))
    hit = F.col("precision") > 0
    return per.groupBy("model").agg(
        F.coalesce(F.avg(F.when(hit, F.col("ndcg"))), F.lit(0.0)).alias("ndcg_of_hits"),
        F.coalesce(F.avg(F.when(hit, F.col("precision"))), F.lit(0.0)).alias("precision_of_hits"),
        F.avg("ndcg").alias("ndcg"),
        F.avg("precision").alias("precision"),
        F.count("*").alias("students"),
    )
