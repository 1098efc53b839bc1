"""Queries behind the tutor pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.expr import count_where

SORT_MODES = {
    "score_desc": lambda: [F.desc("score"), F.asc("student_id")],
    "score_asc": lambda: [F.asc("score"), F.asc("student_id")],
    "last_activity": lambda: [F.desc("last_activity"), F.asc("student_id")],
}


def sorted_list(people: DataFrame, mode: str, n: int) -> DataFrame:
    """First ``n`` rows of a sort mode with their place (a page of the list)."""
    page = people.orderBy(*SORT_MODES[mode]()).limit(n)
    return page.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*SORT_MODES[mode]())))


def follow_ups_due(log: DataFrame, today: str, days: int = 7) -> DataFrame:
    """Actions whose follow-up date is at most ``days`` after ``today``."""
    return log.where(F.col("follow_up") <= F.date_add(F.lit(today).cast("date"), days))


def crosstab(log: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    """Counts of ``row`` by the given values of ``column``, 0 where absent."""
    return log.groupBy(row).pivot(column, values).count().fillna(0)


def group_stats(people: DataFrame, group: str, value: str) -> DataFrame:
    return people.groupBy(group).agg(
        F.avg(value).alias("mean"), F.stddev(value).alias("std"), F.count("*").alias("n")
    )


def kpis(tiered: DataFrame) -> DataFrame:
    """Students in total, in the upper three tiers, critical and medium."""
    t = F.col("tier")
    return tiered.agg(
        F.count("*").alias("total"),
        count_where(t.isin("HIGH", "VERY_HIGH", "CRITICAL")).alias("at_risk"),
        count_where(t == "CRITICAL").alias("critical"),
        count_where(t == "MEDIUM").alias("medium"),
    )


def filtered(people: DataFrame, tiers: list[str] | None = None, course: int | None = None) -> DataFrame:
    out = people.where(F.col("tier").isin(tiers)) if tiers else people
    return out if course is None else out.where(F.col("course_id") == course)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def intervention_kpis(log: DataFrame) -> DataFrame:
    return log.agg(
        F.count("*").alias("total"),
        count_where(F.col("outcome") == "Improved").alias("improved"),
        count_where(F.col("outcome") == "No response").alias("no_response"),
        F.avg("outcome_score").alias("mean_score"),
    )


def outcomes_by_intervention(log: DataFrame, today: str, days: int = 7) -> DataFrame:
    """Outcome counts, frequency and follow-ups due per intervention, in one pass."""
    due = F.col("follow_up") <= F.date_add(F.lit(today).cast("date"), days)
    outcomes = ["Improved", "No response", "Pending"]
    return log.groupBy("intervention").agg(
        *[count_where(F.col("outcome") == o).alias(o) for o in outcomes],
        F.count("*").alias("n"),
        count_where(due).alias("due"),
    )
