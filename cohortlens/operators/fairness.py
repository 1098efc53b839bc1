"""Fairness across groups. Every audit reads the table once: attributes become rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.expr import share
from cohortlens.operators.scores import calibration_error

KEYS = ["attribute", "group"]


def by_attribute(df: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Each row once per protected attribute, as (attribute, group, …)."""
    rest = [c for c in df.columns if c not in attributes]
    cells = [F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("group")) for a in attributes]
    long = df.select(*rest, F.explode(F.array(*cells)).alias("cell"))
    return long.select("cell.attribute", "cell.group", *rest).where(F.col("group").isNotNull())


def spread(c: str) -> Column:
    """Aggregate over groups: largest minus smallest value, 0 for a single group."""
    return F.max(c) - F.min(c)


def group_rates(df: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Positive rate, TPR, FPR and rows per group (columns y_true, y_pred)."""
    pred = F.col("y_pred").cast("double")
    return by_attribute(df, attributes).groupBy(*KEYS).agg(
        F.avg(pred).alias("positive_rate"),
        F.coalesce(F.avg(F.when(F.col("y_true") == 1, pred)), F.lit(0.0)).alias("tpr"),
        F.coalesce(F.avg(F.when(F.col("y_true") == 0, pred)), F.lit(0.0)).alias("fpr"),
        F.count("*").alias("n"),
    )


def parity_difference(rates: DataFrame) -> DataFrame:
    return rates.groupBy("attribute").agg(spread("positive_rate").alias("parity_difference"))


def equalized_odds(rates: DataFrame) -> DataFrame:
    gaps = rates.groupBy("attribute").agg(spread("tpr").alias("tpr_difference"), spread("fpr").alias("fpr_difference"))
    return gaps.withColumn("odds_difference", F.greatest("tpr_difference", "fpr_difference"))


def disparate_impact(rates: DataFrame) -> DataFrame:
    """Lowest over highest positive rate; 1 if there are no positives or a single group."""
    ratio = F.coalesce(F.try_divide(F.min("positive_rate"), F.max("positive_rate")), F.lit(1.0))
    out = rates.groupBy("attribute").agg(ratio.alias("impact_ratio"))
    return out.withColumn("impact_status", F.when(F.col("impact_ratio") >= 0.8, "PASS").otherwise("FAIL"))


def group_calibration(df: DataFrame, attributes: Sequence[str], n_bins: int = 10) -> DataFrame:
    """Calibration error per group."""
    return calibration_error(by_attribute(df, attributes), "y_true", "score", n_bins, KEYS)


def fairness_score(parity: Column, odds: Column, impact: Column, calibration: Column) -> Column:
    """Weighted mean of the four normalised measures, 1 being fair."""
    falling = lambda x: F.greatest(F.lit(0.0), 1 - x / 0.2)
    return (
        0.25 * falling(parity)
        + 0.30 * falling(odds)
        + 0.30 * F.least(F.lit(1.0), impact / 0.8)
        + 0.15 * falling(calibration)
    )


def audit(df: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """One row per attribute and one row 'overall' with the mean score and the verdict."""
    rates = group_rates(df, attributes)
    worst = group_calibration(df, attributes).groupBy("attribute").agg(F.max("calibration_error").alias("calibration_error"))
    gaps = rates.groupBy("attribute").agg(
        spread("positive_rate").alias("parity_difference"),
        F.greatest(spread("tpr"), spread("fpr")).alias("odds_difference"),
        F.coalesce(F.try_divide(F.min("positive_rate"), F.max("positive_rate")), F.lit(1.0)).alias("impact_ratio"),
    )
    cols = [F.col(c) for c in ("parity_difference", "odds_difference", "impact_ratio", "calibration_error")]
    each = gaps.join(worst, "attribute").withColumn("score", fairness_score(*cols))
    total = each.agg(F.lit("overall").alias("attribute"), *[F.avg(c).alias(n) for n, c in zip(
        ("parity_difference", "odds_difference", "impact_ratio", "calibration_error", "score"), [*cols, F.col("score")])])
    whole = each.unionByName(total)
    return whole.withColumn("status", F.when(F.col("score") >= 0.7, "PASS").otherwise("FAIL"))


def ordinal_groups(df: DataFrame, attributes: Sequence[str], n_classes: int = 5) -> DataFrame:
    """All ordinal measures per group (columns y, p), from one pass."""
    y, p = F.col("y"), F.col("p")
    gap = p - y
    return by_attribute(df, attributes).groupBy(*KEYS).agg(
        F.avg(p).alias("mean_predicted"),
        share(p >= 3).alias("favourable_rate"),
        *[share(p == k).alias(f"share_{k}") for k in range(n_classes)],
        share(y != p).alias("exact_error"),
        F.avg(F.abs(gap)).alias("mae"),
        share(F.abs(gap) <= 1).alias("within_one"),
        *[F.avg(F.when(y == k, (y != p).cast("double"))).alias(f"error_{k}") for k in range(n_classes)],
        F.avg(gap).alias("mean_bias"),
        (F.avg(gap) / 4.0).alias("normalised_bias"),
        share(gap > 0).alias("over_rate"),
        share(gap < 0).alias("under_rate"),
        F.stddev_pop(gap).alias("signed_error_std"),
    )


def ordinal_audit(df: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Disparities per attribute with the overall score over all of them."""
    groups = ordinal_groups(df, attributes)
    each = groups.groupBy("attribute").agg(
        spread("mean_predicted").alias("parity_disparity"),
        spread("mae").alias("mae_disparity"),
        spread("mean_bias").alias("bias_disparity"),
    )
    mean = (F.avg("parity_disparity") + F.avg("mae_disparity") + F.avg("bias_disparity")) / 3
    score = each.agg(F.greatest(F.lit(0.0), 1 - mean / 2.0)).scalar()
    return each.withColumn("overall_score", score).withColumn(
        "status", F.when(F.col("overall_score") >= 0.7, "PASS").otherwise("FAIL")
    )


def graduate_gaps(df: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Employment, salary, FPR and FNR gaps per attribute (columns y, p)."""
    y, p = F.col("y"), F.col("p")
    groups = by_attribute(df, attributes).groupBy(*KEYS).agg(
        share(p >= 3).alias("employed"),
        F.avg(p).alias("salary"),
        F.coalesce(F.avg(F.when(y == 0, (p == 1).cast("double"))), F.lit(0.0)).alias("fpr"),
        F.coalesce(F.avg(F.when(y == 1, (p == 0).cast("double"))), F.lit(0.0)).alias("fnr"),
    )
    return groups.groupBy("attribute").agg(
        spread("employed").alias("employment_gap"),
        spread("salary").alias("salary_gap"),
        spread("fpr").alias("fpr_gap"),
        spread("fnr").alias("fnr_gap"),
    )


def graduate_audit(df: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Violations of the gap limits and the resulting score."""
    limits = {"employment_gap": 0.05, "salary_gap": 0.1, "fpr_gap": 0.05, "fnr_gap": 0.05}
    gaps = graduate_gaps(df, attributes)
    broken = sum((F.count_if(F.col(c) > limit) for c, limit in limits.items()), F.lit(0))
    score = 1.0 - broken / (len(limits) * max(len(attributes), 1))
    out = gaps.agg(broken.alias("violations"), score.alias("fairness_score"))
    return out.withColumn("status", F.when(F.col("fairness_score") > 0.8, "PASS").otherwise("FAIL"))


def risk_monitor(df: DataFrame, group: str, flagged: Column) -> DataFrame:
    """Mean risk of flagged against other students with a warning beyond 5 points."""
    inside = F.avg(F.when(flagged, F.col("risk_score")))
    outside = F.avg(F.when(~flagged, F.col("risk_score")))
    return df.agg(
        inside.alias("mean_inside"), outside.alias("mean_outside"), (inside - outside).alias("disparity")
    ).withColumns({"group": F.lit(group), "warn": F.abs(F.col("disparity")) > 5})


def high_risk_rate(df: DataFrame, group: str) -> DataFrame:
    """Percentage of students in the upper three tiers per group."""
    high = F.col("tier").isin("HIGH", "VERY_HIGH", "CRITICAL")
    return df.groupBy(group).agg((share(high) * 100).alias("high_risk_rate"))
