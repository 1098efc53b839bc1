"""Distribution drift between a reference table and a current one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.functions.ordering import running_totals

BINS = 20
EPSILON = 1e-6


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


class Profile:
    """Range of every numeric column of the reference, from one pass."""

    def __init__(self, reference: DataFrame):
        self.numeric = numeric_columns(reference)
        self.other = [c for c in reference.columns if c not in self.numeric]
        aggs = [f(F.col(c).cast("double")).alias(f"{n}{i}") for i, c in enumerate(self.numeric) for n, f in (("lo", F.min), ("hi", F.max))]
        row = reference.agg(*aggs).first() if aggs else None
        self.edges = {}
        for i, c in enumerate(self.numeric):
            lo, hi = row[f"lo{i}"], row[f"hi{i}"]
            if lo is not None and lo == hi:  # a constant column gets a bin around it
                lo, hi = lo - 0.5, hi + 0.5
            self.edges[c] = (lo, hi)

    def place(self, column: str) -> Column:
        """Bin 0..19 of a number (NULL outside the reference range), else the value itself."""
        if column in self.other:
            return F.col(column).cast("string")
        lo, hi = self.edges[column]
        if lo is None:
            return F.lit(None).cast("string")
        x = F.col(column).cast("double")
        at = F.least(F.floor((x - lo) * (BINS / (hi - lo))), F.lit(BINS - 1)).cast("int")
        return F.when((x >= lo) & (x <= hi), at.cast("string"))

    def counts(self, df: DataFrame) -> DataFrame:
        """Rows (column, bin, n), all columns in one pass."""
        cells = [F.struct(F.lit(c).alias("column"), self.place(c).alias("bin")) for c in self.numeric + self.other]
        long = df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")
        return long.where(F.col("bin").isNotNull()).groupBy("column", "bin").agg(F.count("*").alias("n"))

    def bins(self) -> list[tuple[str, str]]:
        return [(c, str(b)) for c in self.numeric for b in range(BINS)]


def reference_profile(reference: DataFrame) -> DataFrame:
    """Share of the rows per bin or value: (column, bin, share); empty bins included."""
    profile = Profile(reference)
    counted = with_empty_bins(profile, profile.counts(reference))
    totals = counted.groupBy("column").agg(F.sum("n").alias("_total"))
    return counted.join(totals, "column").select("column", "bin", (F.col("n") / F.col("_total")).alias("share"))


def with_empty_bins(profile: Profile, counted: DataFrame) -> DataFrame:
    spark = counted.sparkSession
    grid = spark.createDataFrame(profile.bins(), "column string, bin string") if profile.numeric else None
    if grid is None:
        return counted
    return grid.join(counted, ["column", "bin"], "full_outer").fillna(0, subset=["n"])


def interpretation(psi: Column) -> Column:
    return (
        F.when(psi == float("inf"), "Current data is empty")
        .when(psi < 0.1, "No significant change")
        .when(psi < 0.25, "Moderate change")
        .otherwise("Significant change")
    )


def divergence(reference: DataFrame, current: DataFrame, threshold: float = 0.1) -> DataFrame:
    """PSI and KL divergence of every column: (column, psi, kl, interpretation, drift_detected).

    Numbers are binned on the reference range, current values outside it are left
    out; categories are the union of both sides.
    """
    profile = Profile(reference)
    ref = with_empty_bins(profile, profile.counts(reference)).withColumnRenamed("n", "r")
    cur = profile.counts(current).withColumnRenamed("n", "c")
    both = ref.join(cur, ["column", "bin"], "full_outer").fillna(0, subset=["r", "c"])
    sums = both.groupBy("column").agg(F.sum("r").alias("_r"), F.sum("c").alias("_c"), F.count("*").alias("_k"))
    smooth = lambda n, total: (F.try_divide(F.col(n), F.col(total)) + EPSILON) / (1 + F.col("_k") * EPSILON)
    shares = both.join(sums, "column").select("column", smooth("r", "_r").alias("p"), smooth("c", "_c").alias("q"), "_c")
    q, p = F.col("q"), F.col("p")
    out = shares.groupBy("column").agg(
        F.sum((q - p) * F.ln(q / p)).alias("_psi"), F.sum(q * F.ln(q / p)).alias("_kl"), F.max("_c").alias("_c")
    )
    empty = F.col("_c") == 0
    return out.select(
        "column",
        F.when(empty, F.lit(float("inf"))).otherwise(F.col("_psi")).alias("psi"),
        F.when(empty, F.lit(float("inf"))).otherwise(F.col("_kl")).alias("kl"),
    ).select(
        "*", interpretation(F.col("psi")).alias("interpretation"), (F.col("psi") > threshold).alias("drift_detected")
    )


def ks_test(reference: DataFrame, current: DataFrame) -> DataFrame:
    """Two-sample Kolmogorov–Smirnov of every numeric column: (column, ks_statistic, ks_p_value).

    Values of both tables are counted per (column, value) and accumulated in order.
    The p-value is the asymptotic one.
    """
    columns = [c for c in numeric_columns(reference) if c in current.columns]

    def long(df: DataFrame, side: str) -> DataFrame:
        cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns]
        rows = df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*").where(F.col("x").isNotNull())
        zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
        return rows.select("column", "x", (one if side == "r" else zero).alias("r"), (one if side == "c" else zero).alias("c"))

    counts = long(reference, "r").unionByName(long(current, "c")).groupBy("column", "x").agg(
        F.sum("r").alias("r"), F.sum("c").alias("c")
    )
    totals = counts.groupBy("column").agg(F.sum("r").alias("n_r"), F.sum("c").alias("n_c"))
    upto = running_totals(counts, "x", {"upto_r": "r", "upto_c": "c"}, within=["column"]).join(totals, "column")
    gap = F.abs(F.try_divide("upto_r", "n_r") - F.try_divide("upto_c", "n_c"))
    stat = upto.groupBy("column").agg(
        F.coalesce(F.max(gap), F.lit(0.0)).alias("ks_statistic"), F.max("n_r").alias("n_r"), F.max("n_c").alias("n_c")
    )
    return stat.select(
        "column", "ks_statistic", kolmogorov_tail(F.col("ks_statistic"), F.col("n_r"), F.col("n_c")).alias("ks_p_value")
    )


def kolmogorov_tail(statistic: Column, n: Column, m: Column) -> Column:
    """2 Σ (-1)^(k-1) exp(-2 k² t²), t = D √(nm / (n+m))."""
    t2 = statistic * statistic * (n.cast("double") * m / (n + m))
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(100)),
        lambda k: F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2 * k * k * t2),
    )
    total = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    return F.when(t2 < 0.04, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2 * total)))


def detect_drift(reference: DataFrame, current: DataFrame, threshold: float = 0.1) -> DataFrame:
    """Divergence of all columns with the KS result of the numeric ones."""
    return divergence(reference, current, threshold).join(ks_test(reference, current), "column", "left")
