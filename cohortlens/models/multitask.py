"""Several heads over one feature table: flags, levels and numbers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.models.base import assembled, class_probability
from cohortlens.session import reliable_checkpoint

# Heads per task: label column -> kind ('flag', 'number' or a number of classes).
GRADUATE_HEADS = {"y_employment": 4, "y_salary": 4, "y_study": 4}
SURVEY_HEADS = {
    "y_satisfied": "flag",
    "y_nps": "number",
    "y_teaching_score": "number",
    "y_assessment_score": "number",
    "y_feedback_score": "number",
    "y_support_score": "number",
    "y_organisation_score": "number",
    "y_learning_resources_score": "number",
    "y_student_voice_score": "number",
}
RETENTION_HEADS = {"y_retention_risk": "flag", "y_risk_score": "number", "y_risk_category": 4, "y_departure_year": 4}
EXAM_HEADS = {"y_exam_mark": "number", "y_pass_fail": "flag", "y_grade_class": 4}
WELLBEING_HEADS = {"y_wellbeing_score": "number", "y_at_risk": "flag", "y_support_need": 4}
DEMAND_HEADS = {"y_enrollment_count": "number", "y_fill_rate": "number", "y_demand_category": 4}


@dataclass
class MultiTask:
    features: list[str]
    heads: dict
    models: dict = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``p_<label>`` per head, and ``prob_<label>`` (flag) or one per class."""
        out = assembled(df, self.features)
        for head, kind in self.heads.items():
            model, name = self.models[head], head.removeprefix("y_")
            if model is None:
                continue
            model = model.setPredictionCol("_pred")
            if kind != "number":
                model = model.setProbabilityCol("_prob").setRawPredictionCol("_raw")
            out = model.transform(out)
            if kind == "number":
                out = out.withColumn(f"p_{name}", F.col("_pred"))
            elif kind == "flag":
                out = out.withColumns({f"p_{name}": F.col("_pred").cast("int"), f"prob_{name}": class_probability(1, "_prob")})
            else:
                cells = {f"prob_{name}_{k}": class_probability(k, "_prob") for k in range(model.numClasses)}
                out = out.withColumns({f"p_{name}": F.col("_pred").cast("int"), **cells})
            out = out.drop("_pred", "_prob", "_raw")
        return out.drop("features")


def fit_heads(
    train: DataFrame,
    heads: Mapping[str, object],
    features: Sequence[str],
    rounds: int = 10,
    depth: int = 4,
    weight: str | None = None,
    seed: int = 42,
) -> MultiTask:
    """Fit every head on the same assembled rows.

    Flags and numbers get boosted trees, levels a random forest (its trees give class
    probabilities for any number of classes). ``weight`` names a column of row weights.
    """
    # one reading of the features serves all heads
    keep = [*heads, "features", *([weight] if weight else [])]
    ready = reliable_checkpoint(assembled(train, features).select(*keep))
    flags = [h for h, kind in heads.items() if kind == "flag"]
    counts = ready.agg(*[F.count_distinct(h).alias(h) for h in flags]).first() if flags else {}
    out = MultiTask(list(features), dict(heads))
    extra = {"weightCol": weight} if weight else {}
    for head, kind in heads.items():
        if kind == "number":
            learner = GBTRegressor(labelCol=head, maxIter=rounds, maxDepth=depth, seed=seed, **extra)
        elif kind == "flag":
            if counts[head] < 2:
                raise ValueError(f"{head} has a single class")
            learner = GBTClassifier(labelCol=head, maxIter=rounds, maxDepth=depth, seed=seed, **extra)
        else:
            learner = RandomForestClassifier(labelCol=head, numTrees=rounds, maxDepth=depth, seed=seed, **extra)
        out.models[head] = learner.fit(ready)
    return out
