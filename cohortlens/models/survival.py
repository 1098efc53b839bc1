"""Time-to-event models for any number of distinct times."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.regression import AFTSurvivalRegression
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlens.functions.ordering import bucket_totals, value_buckets
from cohortlens.models.base import assembled, class_probability
from cohortlens.operators.prep import Scaling, stratified_split
from cohortlens.operators.scores import concordance
from cohortlens.session import reliable_checkpoint, spread


@dataclass
class CoxModel:
    """Coefficients on standardised features and the cumulative baseline hazard (a table of time and hazard)."""

    features: list[str]
    scaling: Scaling
    beta: np.ndarray
    baseline: DataFrame

    def risk(self, df: DataFrame) -> DataFrame:
        """Add ``risk``, the log hazard relative to the mean student."""
        terms = F.lit(0.0)
        for c, b in zip(self.features, self.beta):
            terms = terms + (F.col(c) - self.scaling.mean[c]) / self.scaling.std[c] * float(b)
        return df.withColumn("risk", terms)

    def survival(self, df: DataFrame, times: Sequence[float] | None = None) -> DataFrame:
        """S(t) of every row at the given times, or at every event time: (…, time, survival).

        The hazard at a time is that of the last event time up to it, 0 before the first.
        """
        if times is None:
            # the curve as one row: the result has it once per row of ``df`` anyway
            steps = self.baseline.agg(F.sort_array(F.collect_list(F.struct("time", "hazard"))).alias("_steps"))
        else:
            at = [F.coalesce(F.max(F.when(F.col("time") <= t, F.col("hazard"))), F.lit(0.0)) for t in times]
            pairs = [F.struct(F.lit(float(t)).alias("time"), h.alias("hazard")) for t, h in zip(times, at)]
            steps = self.baseline.agg(F.array(*pairs).alias("_steps"))
        rows = self.risk(df).crossJoin(steps).withColumn("_step", F.explode("_steps"))
        return rows.select(
            *df.columns, F.col("_step.time").alias("time"), F.exp(-F.col("_step.hazard") * F.exp("risk")).alias("survival")
        )

    def importance(self, spark, top: int | None = None) -> DataFrame:
        rows = [(c, float(b), abs(float(b))) for c, b in zip(self.features, self.beta)]
        table = spark.createDataFrame(rows, "feature string, coefficient double, importance double")
        ordered = table.orderBy(F.desc("importance"), "feature")
        return ordered if top is None else ordered.limit(top)


def baseline_hazard(df: DataFrame, time: str, event: str, risk: str) -> DataFrame:
    """Breslow cumulative baseline hazard: (time, hazard), hazard Σ d / Σ exp(risk) over those at risk.

    Rows are merged by time; both running sums are split by ranges of time.
    """
    sums = df.groupBy(F.col(time).alias("time")).agg(F.sum(event).alias("d"), F.sum(F.exp(risk)).alias("s"))
    bucketed = value_buckets(reliable_checkpoint(sums), "time")
    at_risk = bucket_totals(bucketed, "time", {"at_risk": "s"}, descending=True)
    steps = at_risk.where(F.col("d") > 0).withColumn("step", F.col("d") / F.col("at_risk"))
    return bucket_totals(steps, "time", {"hazard": "step"}).select("time", "hazard")


def pairs_of(p: int) -> list[tuple[int, int]]:
    return [(j, k) for j in range(p) for k in range(j, p)]


@dataclass
class CoxRows:
    """Rows of a proportional-hazards fit (``_time``, ``_event``, ``_x_0`` …), each with the bucket of its time."""

    rows: DataFrame
    p: int
    n: int

    @staticmethod
    def of(df: DataFrame, time: str, event: str, features: Sequence[Column]) -> CoxRows:
        kept = reliable_checkpoint(
            df.select(
                F.col(time).cast("double").alias("_time"),
                F.col(event).cast("double").alias("_event"),
                *[x.cast("double").alias(f"_x_{j}") for j, x in enumerate(features)],
            )
        )
        return CoxRows(value_buckets(kept, "_time"), len(features), kept.count())

    def derivatives(self, beta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradient and curvature of the mean log partial likelihood at ``beta`` (Breslow ties).

        Rows are reduced to sums per distinct time: of the weights w = exp(xβ), of wx, of wxxᵀ and over
        events. Suffix sums over time give those at risk, r0 and r1; the running sum A of d / r0 turns the
        sum over times of d r2 / r0 into the sum of A · wxxᵀ, so matrices are summed and never scanned. One row of
        sums leaves Spark.
        """
        x = [F.col(f"_x_{j}") for j in range(self.p)]
        score = F.lit(0.0)
        for xj, b in zip(x, beta):
            score = score + xj * float(b)
        w = F.exp(score)
        by_time = self.rows.groupBy("_bucket", "_time").agg(
            F.sum(w).alias("s0"),
            F.sum("_event").alias("d"),
            *[F.sum(w * x[j]).alias(f"s1_{j}") for j in range(self.p)],
            *[F.sum(F.col("_event") * x[j]).alias(f"xd_{j}") for j in range(self.p)],
            *[F.sum(w * x[j] * x[k]).alias(f"s2_{j}_{k}") for j, k in pairs_of(self.p)],
        )
        kept = reliable_checkpoint(by_time)
        at_risk = bucket_totals(kept, "_time", {"r0": "s0"} | {f"r1_{j}": f"s1_{j}" for j in range(self.p)}, descending=True)
        steps = reliable_checkpoint(at_risk.withColumn("step", F.col("d") / F.col("r0")))
        found = bucket_totals(steps, "_time", {"A": "step"})
        mean = [F.col(f"r1_{j}") / F.col("r0") for j in range(self.p)]
        d = F.col("d")
        sums = found.agg(
            *[F.sum(F.col(f"xd_{j}") - d * mean[j]).alias(f"g_{j}") for j in range(self.p)],
            *[F.sum(F.col("A") * F.col(f"s2_{j}_{k}") - d * mean[j] * mean[k]).alias(f"c_{j}_{k}") for j, k in pairs_of(self.p)],
        ).first()
        gradient = np.array([sums[f"g_{j}"] for j in range(self.p)]) / self.n
        curvature = np.zeros((self.p, self.p))
        for j, k in pairs_of(self.p):
            curvature[j, k] = curvature[k, j] = sums[f"c_{j}_{k}"] / self.n
        return gradient, curvature


def derivative_table(spark: SparkSession, rows: CoxRows, names: Sequence[str], beta: Sequence[float]) -> DataFrame:
    """Gradient (``other`` is null) and curvature at given coefficients: feature, other, value."""
    gradient, curvature = rows.derivatives(np.array(beta))
    table = [(c, None, float(g)) for c, g in zip(names, gradient)]
    table += [(names[j], names[k], float(curvature[j, k])) for j, k in pairs_of(len(names))]
    return spark.createDataFrame(table, "feature string, other string, value double")


def fit_cox(
    df: DataFrame,
    time: str,
    event: str,
    features: Sequence[str],
    alpha: float = 0.01,
    l1_ratio: float = 0.5,
    max_iter: int = 10,
    tolerance: float = 1e-6,
) -> CoxModel:
    """Proportional hazards with an elastic-net penalty (Breslow ties).

    Each step reads the rows once; the driver gets one row of sums and solves the small
    penalised system, however many distinct times there are.
    """
    features = list(features)
    scaling = Scaling.fit(df, features)
    rows = CoxRows.of(df, time, event, [(F.col(c) - scaling.mean[c]) / scaling.std[c] for c in features])
    beta = np.zeros(len(features))
    for _ in range(max_iter):
        new = penalised_step(beta, *rows.derivatives(beta), alpha, l1_ratio)
        moved = np.abs(new - beta).max()
        beta = new
        if moved < tolerance:
            break
    model = CoxModel(features, scaling, beta, df)
    model.baseline = reliable_checkpoint(baseline_hazard(model.risk(df), time, event, "risk"))
    return model


def penalised_step(beta, gradient, curvature, alpha, l1_ratio) -> np.ndarray:
    """Minimise the quadratic model of the loss plus the elastic net, by coordinate descent."""
    new = beta.copy()
    for _ in range(200):
        before = new.copy()
        for j in range(len(beta)):
            slope = gradient[j] - curvature[j] @ (new - beta) + curvature[j, j] * new[j]
            shrunk = np.sign(slope) * max(abs(slope) - alpha * l1_ratio, 0.0)
            new[j] = shrunk / (curvature[j, j] + alpha * (1 - l1_ratio) + 1e-12)
        if np.abs(new - before).max() < 1e-10:
            break
    return new


def fit_accelerated(df: DataFrame, time: str, event: str, features: Sequence[str], max_iter: int = 20):
    """Weibull accelerated failure time as the second survival model."""
    ready = assembled(df, features).withColumn("_censor", F.col(event).cast("double"))
    return AFTSurvivalRegression(labelCol=time, censorCol="_censor", maxIter=max_iter).fit(ready)


@dataclass
class HazardModel:
    """Chance of the event in each week, from boosted trees over person-weeks."""

    features: list[str]
    model: object
    weeks: int

    def survival(self, df: DataFrame) -> DataFrame:
        """S(t) for t = 1..weeks: (student_id, time, survival)."""
        people = spread(df, df.count() * self.weeks, "student_id")
        rows = people.withColumn("_week", F.explode(F.sequence(F.lit(1), F.lit(self.weeks))))
        scored = self.model.transform(assembled(rows, [*self.features, "_week"]))
        upto = Window.partitionBy("student_id").orderBy("_week").rowsBetween(Window.unboundedPreceding, 0)
        hazard = F.least(class_probability(), F.lit(0.999999))
        return scored.select("student_id", "_week", F.ln(1 - hazard).alias("_log")).select(
            "student_id", F.col("_week").alias("time"), F.exp(F.sum("_log").over(upto)).alias("survival")
        )


def fit_hazard(
    df: DataFrame, time: str, event: str, features: Sequence[str], weeks: int, rounds: int = 5, depth: int = 3, seed: int = 42
) -> HazardModel:
    """Boosted trees on one row per student and week at risk, positive in the week of the event."""
    at_risk = F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.col(time).cast("int"), F.lit(weeks))))
    # the learner keeps the person-weeks in memory, so they are what a task's share is measured by
    rows = spread(df, df.count() * weeks).withColumn("_week", F.explode(at_risk))
    here = ((F.col("_week") == F.col(time)) & (F.col(event) == 1)).cast("double")
    ready = assembled(rows.withColumn("_event", here), [*features, "_week"]).select("features", "_event")
    model = GBTClassifier(labelCol="_event", maxIter=rounds, maxDepth=depth, seed=seed).fit(ready)
    return HazardModel(list(features), model, weeks)


def fit_and_evaluate(df: DataFrame, time: str, event: str, features: Sequence[str], key: str = "student_id") -> tuple[CoxModel, DataFrame]:
    """Cox on a stratified four fifths; concordance on the rest."""
    parts = stratified_split(df, key, event, 0.2)
    model = fit_cox(parts.where(F.col("part") == "train"), time, event, features)
    scored = model.risk(parts.where(F.col("part") == "test"))
    return model, concordance(scored, time, event, "risk")
