"""Risk scores, tiers and alerts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.expr import count_where, lookup

# Tiers as (low, high], colours, symbols and actions.
TIERS = {
    "LOW": (0.0, 20.0),
    "MEDIUM": (20.0, 40.0),
    "HIGH": (40.0, 60.0),
    "VERY_HIGH": (60.0, 80.0),
    "CRITICAL": (80.0, 100.0),
}
COLOURS = {
    "LOW": "#22c55e",
    "MEDIUM": "#eab308",
    "HIGH": "#f97316",
    "VERY_HIGH": "#ef4444",
    "CRITICAL": "#a855f7",
}
SYMBOLS = {"LOW": "🟢", "MEDIUM": "🟡", "HIGH": "🟠", "VERY_HIGH": "🔴", "CRITICAL": "🟣"}
ACTIONS = {
    "LOW": ["Continue monitoring"],
    "MEDIUM": ["Send engagement check-in email", "Assign peer mentor"],
    "HIGH": ["Schedule one-to-one meeting", "Send warning letter"],
    "VERY_HIGH": ["Urgent tutor meeting", "Involve student welfare services"],
    "CRITICAL": ["Immediate welfare check", "Escalate to head of year"],
}
TIER_ORDER = list(TIERS)
PERCENTILE_LABELS = ["low", "medium", "high", "very_high"]


def tier(score: Column, tiers: Mapping[str, tuple[float, float]] = TIERS) -> Column:
    """Tier whose ``(low, high]`` holds the score; the outer tiers take what lies beyond."""
    names = list(tiers)
    out = F.when(score <= tiers[names[0]][1], names[0])
    for name in names[1:-1]:
        out = out.when(score <= tiers[name][1], name)
    return F.when(score.isNotNull(), out.otherwise(names[-1]))


def tier_index(name: Column) -> Column:
    return lookup(name, {t: i for i, t in enumerate(TIER_ORDER)}, 0)


def at_least(name: Column, minimum: str) -> Column:
    return tier_index(name) >= TIER_ORDER.index(minimum)


def minmax_score(df: DataFrame, raw: str, into: str = "risk_score") -> DataFrame:
    """Scale to 0-100 over the whole table; a constant column becomes 50."""
    span = df.agg(F.struct(F.min(raw).alias("lo"), F.max(raw).alias("hi"))).scalar()
    lo, hi = span["lo"], span["hi"]
    return df.withColumn(into, F.when(hi > lo, (F.col(raw) - lo) / (hi - lo) * 100).otherwise(F.lit(50.0)))


def decorate(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"color": lookup(F.col("tier"), COLOURS), "symbol": lookup(F.col("tier"), SYMBOLS)}
    )


def actions(name: Column) -> Column:
    """Recommended actions of a tier, three at most."""
    table = F.create_map(*[x for t, a in ACTIONS.items() for x in (F.lit(t), F.array(*[F.lit(s) for s in a]))])
    return F.slice(F.try_element_at(table, name), 1, 3)


def explanation(score: Column, name: Column, factors: Column) -> Column:
    """Text with up to three raising and three lowering factors.

    ``factors`` is an array of ``struct<factor, value>`` in order of weight.
    """
    head = F.concat(F.lit("This student has a "), F.format_string("%.1f", score), F.lit("/100 risk score ("), name, F.lit(")."))
    raising = F.slice(F.filter(factors, lambda f: f["value"] > 0), 1, 3)
    lowering = F.slice(F.filter(factors, lambda f: f["value"] <= 0), 1, 3)
    up = F.transform(raising, lambda f: F.concat(f["factor"], F.lit(" (+"), F.format_string("%.3f", f["value"]), F.lit(")")))
    down = F.transform(lowering, lambda f: F.concat(f["factor"], F.lit(" ("), F.format_string("%.3f", f["value"]), F.lit(")")))
    return F.concat_ws(
        " ",
        head,
        F.when(F.size(up) > 0, F.concat(F.lit("Key risk factors: "), F.array_join(up, ", "), F.lit("."))),
        F.when(F.size(down) > 0, F.concat(F.lit("Protective factors: "), F.array_join(down, ", "), F.lit("."))),
    )


def alerts(scored: DataFrame, min_tier: str = "MEDIUM", top_k: int | None = None, model: str = "unknown") -> DataFrame:
    """Alert rows of students at or above a tier, highest risk first.

    ``scored`` has ``student_id`` and ``risk_score``. With ``top_k`` Spark keeps that
    many rows per task and never sorts the table as a whole.
    """
    tiered = scored.withColumn("tier", tier(F.col("risk_score")))
    listed = tiered.where(at_least(F.col("tier"), min_tier)).select(
        "student_id",
        F.round("risk_score", 1).alias("risk_score"),
        "tier",
        lookup(F.col("tier"), SYMBOLS).alias("symbol"),
        actions(F.col("tier")).alias("recommended_actions"),
        F.lit(model).alias("model_name"),
    )
    ordered = listed.orderBy(F.desc("risk_score"), F.asc("student_id"))
    return ordered if top_k is None else ordered.limit(top_k)


def alert_records(scored: DataFrame, factors: Column, min_tier: str = "MEDIUM", model: str = "unknown", at: Column | None = None) -> DataFrame:
    """Whole alert records as one struct: score, tier, symbol, actions, explanation and the factors behind it.

    ``scored`` has ``student_id``, ``risk_score`` and what ``factors`` (an array of ``struct<factor, value>`` in
    order of weight) is made of; ``at`` is the time that the record carries.
    """
    tiered = scored.withColumn("tier", tier(F.col("risk_score"))).where(at_least(F.col("tier"), min_tier))
    record = F.struct(
        F.round("risk_score", 1).alias("risk_score"),
        "tier",
        lookup(F.col("tier"), SYMBOLS).alias("symbol"),
        actions(F.col("tier")).alias("recommended_actions"),
        explanation(F.col("risk_score"), F.col("tier"), factors).alias("explanation"),
        factors.alias("top_factors"),
        F.lit(model).alias("model_name"),
        (F.lit(None).cast("timestamp") if at is None else at).alias("created_at"),
    )
    return tiered.select("student_id", record.alias("alert"))


def tier_summary(scored: DataFrame) -> DataFrame:
    """Students and percentage per tier, also for empty tiers."""
    named = scored.select(tier(F.col("risk_score")).alias("tier"))
    counted = named.agg(
        F.count("tier").alias("total"), *[count_where(F.col("tier") == t).alias(t) for t in TIER_ORDER]
    )
    cells = F.array(*[F.struct(F.lit(t).alias("tier"), F.col(t).alias("n")) for t in TIER_ORDER])
    rows = counted.select("total", F.explode(cells).alias("cell"))
    return rows.select(
        "cell.tier", "cell.n", F.coalesce(F.try_divide(F.col("cell.n") * 100.0, "total"), F.lit(0.0)).alias("percent")
    )


def lead_time(events: DataFrame, horizon: float, predicted_at: float = 8) -> DataFrame:
    """Weeks between prediction and event, over events: mean, median, spread, share ≥ horizon.

    ``events`` holds one row per event with its ``time``. Times are few whole weeks,
    so the median is taken over counts per lead.
    """
    leads = events.groupBy((F.col("time") - predicted_at).alias("lead")).agg(F.count("*").alias("n"))
    return leads.agg(
        F.sum("n").alias("n_events"),
        (F.sum(F.col("lead") * F.col("n")) / F.sum("n")).alias("mean_lead"),
        F.percentile(F.col("lead"), F.lit(0.5), F.col("n")).alias("median_lead"),
        F.sqrt(
            F.greatest(
                F.lit(0.0),
                F.sum(F.col("lead") * F.col("lead") * F.col("n")) / F.sum("n")
                - (F.sum(F.col("lead") * F.col("n")) / F.sum("n")) * (F.sum(F.col("lead") * F.col("n")) / F.sum("n")),
            )
        ).alias("std_lead"),
        (F.sum(F.when(F.col("lead") >= horizon, F.col("n")).otherwise(0)) / F.sum("n")).alias("share_early"),
    )


def percentile_tier(percentile: Column, cuts: Sequence[float] = (25, 50, 75)) -> Column:
    """low, medium, high, very_high by percentile; a cut belongs to the tier above it."""
    out = F.when(percentile < cuts[0], PERCENTILE_LABELS[0])
    for cut, name in zip(cuts[1:], PERCENTILE_LABELS[1:]):
        out = out.when(percentile < cut, name)
    return out.otherwise(PERCENTILE_LABELS[-1])
