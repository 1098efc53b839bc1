"""Ordered classes from one threshold model per class boundary."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassifier
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.models.base import assembled, class_probability
from cohortlens.session import reliable_checkpoint


def combine(at_most: Column) -> Column:
    """Class probabilities from P(y ≤ k), k = 0..K-2: made rising, then differenced."""
    rising = F.transform(at_most, lambda _, i: F.array_max(F.slice(at_most, 1, i + 1)))
    upper = F.concat(rising, F.array(F.lit(1.0)))
    lower = F.concat(F.array(F.lit(0.0)), rising)
    return F.zip_with(upper, lower, lambda u, l: u - l)


def likeliest(probabilities: Column) -> Column:
    """First class of highest probability."""
    return (F.array_position(probabilities, F.array_max(probabilities)) - 1).cast("int")


@dataclass
class OrdinalModel:
    features: list[str]
    n_classes: int
    models: list = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``class_probabilities`` (array) and ``p``, the likeliest class."""
        out = assembled(df, self.features)
        for k, model in enumerate(self.models):
            out = model.setProbabilityCol(f"_prob_{k}").setRawPredictionCol(f"_raw_{k}").setPredictionCol(f"_pred_{k}").transform(out)
        at_most = F.array(*[1 - class_probability(1, f"_prob_{k}") for k in range(len(self.models))])
        work = [c for c in out.columns if c.startswith(("_prob_", "_raw_", "_pred_"))]
        whole = out.withColumn("class_probabilities", combine(at_most)).drop("features", *work)
        return whole.withColumn("p", likeliest(F.col("class_probabilities")))


def fit_ordinal(
    train: DataFrame, label: str, features: Sequence[str], n_classes: int, rounds: int = 10, depth: int = 4, seed: int = 42
) -> OrdinalModel:
    """One booster per threshold for P(y > k), all from one reading of the features."""
    ready = reliable_checkpoint(assembled(train, features).select(label, "features"))
    out = OrdinalModel(list(features), n_classes)
    for k in range(n_classes - 1):
        above = ready.withColumn("_above", (F.col(label) > k).cast("double"))
        booster = GBTClassifier(labelCol="_above", maxIter=rounds, maxDepth=depth, seed=seed)
        out.models.append(booster.fit(above))
    return out
