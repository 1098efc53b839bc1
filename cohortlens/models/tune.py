"""Cross-validation and parameter search."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators import prep, scores
from cohortlens.session import reliable_checkpoint

# A trainer takes (train rows, parameters) and returns a function adding score and y_pred.
Trainer = Callable[[DataFrame, Mapping[str, object]], Callable[[DataFrame], DataFrame]]


def folds_of(df: DataFrame, strategy: str, key: str, label: str, k: int, group: str | None = None, time: str | None = None) -> DataFrame:
    """Rows with ``fold`` and ``part`` for a strategy: stratified, group or time."""
    if strategy == "time":
        return prep.time_folds(df, time, key, k)
    dealt = dealt_folds(df, strategy, key, label, k, group)
    both = dealt.withColumnRenamed("fold", "_own").withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    return both.withColumn("part", F.when(F.col("_own") == F.col("fold"), "test").otherwise("train")).drop("_own")


def dealt_folds(df: DataFrame, strategy: str, key: str, label: str, k: int, group: str | None = None) -> DataFrame:
    """Each row once, with the ``fold`` that tests on it."""
    return prep.group_folds(df, group, k) if strategy == "group" else prep.stratified_folds(df, key, label, k)


def train_and_test(folds: DataFrame, i: int) -> tuple[DataFrame, DataFrame]:
    """Rows of one fold, from rows with ``part`` per fold or from rows with the fold that tests on them."""
    here = F.col("fold").eqNullSafe(F.lit(i))
    if "part" in folds.columns:
        mine = folds.where(here)
        return tuple(mine.where(F.col("part") == part).drop("fold", "part") for part in ("train", "test"))
    return folds.where(~here).drop("fold"), folds.where(here).drop("fold")


def scored_by(scoring: str, df: DataFrame, label: str) -> float:
    """Accuracy, weighted F1 or ROC-AUC of scored rows."""
    if scoring == "accuracy":
        return scores.binary(df, label, "y_pred").first()["accuracy"]
    if scoring == "f1":
        return scores.weighted_f1(df, label, "y_pred").first()["weighted_f1"]
    if scoring == "roc_auc":
        return scores.roc_auc(df, label, "score").first()["roc_auc"]
    raise ValueError(f"unknown scoring {scoring}")


def fold_results(
    folds: DataFrame, k: int, label: str, trainer: Trainer, scoring: str, params: Mapping[str, object] | None = None
) -> Iterator[tuple[int, int, int, float]]:
    """Per fold: number, training rows, validation rows, score."""
    for i in range(k):
        train, test = train_and_test(folds, i)
        # the metric reads the scored rows several times, so they are kept, not scored anew
        scored = reliable_checkpoint(trainer(train, params or {})(test).select(label, "score", "y_pred"))
        yield i, train.count(), test.count(), float(scored_by(scoring, scored, label))


def cross_validate(
    df: DataFrame,
    label: str,
    trainer: Trainer,
    strategy: str = "stratified",
    scoring: str = "roc_auc",
    k: int = 5,
    key: str = "student_id",
    **columns,
) -> DataFrame:
    """(fold, n_train, n_val, score) of every fold; their mean and deviation are one ``agg`` away."""
    # kept once, not once per fold; time folds leave rows out, so they come with their parts
    dealt = folds_of(df, strategy, key, label, k, **columns) if strategy == "time" else dealt_folds(df, strategy, key, label, k, columns.get("group"))
    folds = reliable_checkpoint(dealt if strategy == "time" else dealt.drop("part"))
    rows = list(fold_results(folds, k, label, trainer, scoring))
    return df.sparkSession.createDataFrame(rows, "fold int, n_train long, n_val long, score double")


def summarised(results: DataFrame) -> DataFrame:
    return results.agg(F.avg("score").alias("mean"), F.stddev_pop("score").alias("std"))


def draws(space: Mapping[str, tuple], trials: int, seed: int = 42) -> list[dict[str, object]]:
    """Parameter sets from ranges ``(kind, low, high)`` with kind int, float or log."""
    rng = random.Random(seed)
    out = []
    for _ in range(trials):
        params: dict[str, object] = {}
        for name, (kind, low, high) in space.items():
            if kind == "int":
                params[name] = rng.randint(low, high)
            elif kind == "float":
                params[name] = rng.uniform(low, high)
            elif kind == "log":
                params[name] = math.exp(rng.uniform(math.log(low), math.log(high)))
            else:
                raise ValueError(f"unknown range {kind}")
        out.append(params)
    return out


def search(
    df: DataFrame,
    label: str,
    trainer: Trainer,
    space: Mapping[str, tuple],
    trials: int = 10,
    scoring: str = "roc_auc",
    key: str = "student_id",
    seed: int = 42,
    parallelism: int = 2,
) -> tuple[dict[str, object], DataFrame]:
    """Best parameters on a stratified validation share, and all trials by score."""
    parts = reliable_checkpoint(prep.stratified_split(df, key, label, 0.25, seed))
    train, test = (parts.where(F.col("part") == p).drop("part") for p in ("train", "test"))

    def trial(numbered: tuple[int, dict[str, object]]) -> tuple[int, str, float]:
        i, params = numbered
        scored = reliable_checkpoint(trainer(train, params)(test).select(label, "score", "y_pred"))
        value = scored_by(scoring, scored, label)
        return i, ", ".join(f"{n}={v}" for n, v in params.items()), float(value)

    tried = list(enumerate(draws(space, trials, seed)))
    with ThreadPoolExecutor(parallelism) as pool:
        rows = list(pool.map(trial, tried))
    best = max(rows, key=lambda r: (r[2], -r[0]))
    table = df.sparkSession.createDataFrame(rows, "trial int, params string, score double").orderBy(F.desc("score"), "trial")
    return tried[best[0]][1], table
