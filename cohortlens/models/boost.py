"""Binary boosted trees with calibrated probabilities."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.expr import clip
from cohortlens.models.base import assembled, at_threshold, class_probability
from cohortlens.operators.prep import stratified_split, with_class_weight
from cohortlens.operators.scores import evaluate_enrolment
from cohortlens.session import reliable_checkpoint


@dataclass
class Booster:
    """A fitted booster with an optional calibrator of its raw probability."""

    features: list[str]
    model: object
    calibrator: object | None = None
    method: str | None = None

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``score``, the probability of the positive class."""
        raw = self.model.transform(assembled(df, self.features)).withColumn("raw_score", class_probability())
        raw = raw.drop("features", "rawPrediction", "probability", "prediction")
        if self.method is None:
            return raw.withColumn("score", F.col("raw_score")).drop("raw_score")
        if self.method == "isotonic":
            done = self.calibrator.transform(raw).withColumn("score", clip(F.col("prediction"), 0.0, 1.0))
            return done.drop("prediction", "raw_score")
        vector = VectorAssembler(inputCols=["raw_score"], outputCol="_raw").transform(raw)
        done = self.calibrator.transform(vector).withColumn("score", class_probability(column="_platt"))
        return done.drop("_raw", "_platt", "_platt_raw", "_platt_label", "raw_score")

    def predict(self, df: DataFrame, threshold: float = 0.5) -> DataFrame:
        return self.score(df).withColumn("y_pred", at_threshold(F.col("score"), threshold))

    def importance(self, spark, top: int | None = None) -> DataFrame:
        """Features by importance: (feature, importance)."""
        rows = list(zip(self.features, [float(v) for v in self.model.featureImportances.toArray()]))
        table = spark.createDataFrame(rows, "feature string, importance double")
        ordered = table.orderBy(F.desc("importance"), "feature")
        return ordered if top is None else ordered.limit(top)


def fit_booster(
    train: DataFrame,
    label: str,
    features: Sequence[str],
    rounds: int = 10,
    depth: int = 4,
    subsample: float = 0.8,
    columns: str = "all",
    step: float = 0.1,
    seed: int = 42,
    calibrate: str | None = None,
    key: str = "student_id",
) -> Booster:
    """Boosted trees with positives weighted by class imbalance.

    With ``calibrate`` ('platt' or 'isotonic') a stratified fifth of the rows is held
    out of the boosting and the calibrator learns on its scores.
    """
    fitting, holding = train, None
    if calibrate:
        parts = reliable_checkpoint(stratified_split(train, key, label, 0.2, seed))
        fitting, holding = parts.where(F.col("part") == "train"), parts.where(F.col("part") == "test")
    weighted = with_class_weight(fitting, label)
    booster = GBTClassifier(
        labelCol=label,
        weightCol="weight",
        maxIter=rounds,
        maxDepth=depth,
        stepSize=step,
        subsamplingRate=subsample,
        featureSubsetStrategy=columns,
        seed=seed,
    )
    fitted = Booster(list(features), booster.fit(assembled(weighted, features)))
    if calibrate:
        held = fitted.score(holding).select(F.col(label).cast("double").alias("label"), F.col("score").alias("raw_score"))
        fitted.method = calibrate
        if calibrate == "isotonic":
            fitted.calibrator = IsotonicRegression(featuresCol="raw_score", labelCol="label").fit(held)
        elif calibrate == "platt":
            vector = VectorAssembler(inputCols=["raw_score"], outputCol="_raw").transform(held)
            fitted.calibrator = LogisticRegression(
                featuresCol="_raw",
                labelCol="label",
                probabilityCol="_platt",
                rawPredictionCol="_platt_raw",
                predictionCol="_platt_label",
            ).fit(vector)
        else:
            raise ValueError(f"unknown calibration {calibrate}")
    return fitted


def train_and_evaluate(
    df: DataFrame, label: str, features: Sequence[str], key: str = "student_id", test_size: float = 0.2, **options
) -> tuple[Booster, DataFrame]:
    """Fit on a stratified split; metrics of the held-out rows as (metric, value)."""
    parts = reliable_checkpoint(stratified_split(df, key, label, test_size))
    fitted = fit_booster(parts.where(F.col("part") == "train").drop("part"), label, features, key=key, **options)
    scored = fitted.predict(parts.where(F.col("part") == "test"))
    kept = reliable_checkpoint(scored.select(F.col(label).alias("y_true"), "y_pred", "score"))
    return fitted, evaluate_enrolment(kept)
