"""Time-to-event operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.ordering import running_totals


def comparable_pairs(rows: DataFrame) -> DataFrame:
    """Counts of comparable, concordant and tied pairs of ``(time, event, risk)`` rows.

    A pair is comparable when the earlier of two different times is an event; it is
    concordant when that earlier row has the higher risk. ``time`` is a whole number.

    No pair is ever formed. Two times differ first at exactly one binary digit: at
    that digit the earlier one has 0, the later one 1, and all higher digits agree.
    So each row takes part once per digit, in the group of its higher digits, and a
    running count of later rows by risk answers how many lie below it.
    """
    longest = rows.agg(F.max("time")).first()[0] or 0
    counts = rows.groupBy("time", "risk").agg(F.sum("event").alias("events"), F.count("*").alias("n"))
    digits = F.sequence(F.lit(0), F.lit(max(int(longest).bit_length() - 1, 0)))
    spread = counts.withColumn("digit", F.explode(digits))
    later = F.expr("(shiftright(time, digit) & 1) = 1")
    groups = spread.withColumn("higher", F.expr("shiftright(time, digit + 1)"))
    by_risk = groups.groupBy("digit", "higher", "risk").agg(
        F.sum(F.when(later, 0).otherwise(F.col("events"))).alias("early"),
        F.sum(F.when(later, F.col("n")).otherwise(0)).alias("late"),
    )
    ranked = running_totals(by_risk, "risk", {"late_upto": "late"}, within=["digit", "higher"])
    big = lambda c: c.cast("decimal(19,0)")
    hits = ranked.agg(
        F.sum(big(F.col("early")) * big(F.col("late_upto") - F.col("late"))).alias("concordant"),
        F.sum(big(F.col("early")) * big(F.col("late"))).alias("tied"),
    )
    sizes = by_risk.groupBy("digit", "higher").agg(F.sum("early").alias("early"), F.sum("late").alias("late"))
    all_pairs = sizes.agg(F.sum(big(F.col("early")) * big(F.col("late")))).scalar()
    zero = F.lit(0).cast("decimal(38,0)")
    return hits.select(
        F.coalesce(all_pairs, zero).cast("bigint").alias("comparable"),
        F.coalesce("concordant", zero).cast("bigint").alias("concordant"),
        F.coalesce("tied", zero).cast("bigint").alias("tied"),
    )
