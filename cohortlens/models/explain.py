"""Contributions of features to single predictions."""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.ordering import top_n


def linear_contributions(df: DataFrame, coefficients: Mapping[str, float], key: str = "student_id") -> DataFrame:
    """coefficient · (value − mean) per row and feature: (key, feature, contribution). Exact for linear scores."""
    names = list(coefficients)
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in names])).scalar()
    cells = [
        F.struct(F.lit(c).alias("feature"), ((F.col(c) - means[c]) * float(coefficients[c])).alias("contribution"))
        for c in names
    ]
    return df.select(key, F.explode(F.array(*cells)).alias("cell")).select(key, "cell.*")


def sampled_contributions(
    df: DataFrame,
    features: Sequence[str],
    score: Callable[[DataFrame], DataFrame],
    permutations: int = 4,
    key: str = "student_id",
    seed: int = 42,
) -> DataFrame:
    """Shapley values by sampled feature orders, against the mean row: (key, feature, contribution).

    For each order the features of a row replace the mean ones step by step; the
    change of the score at a step belongs to the feature replaced. ``score`` adds a
    column ``score``. The values of a row add up to its score less that of the mean.
    """
    rng = random.Random(seed)
    names = list(features)
    means = df.agg(*[F.avg(c).alias(c) for c in names]).first()
    orders = [rng.sample(range(len(names)), len(names)) for _ in range(permutations)]
    # a step is described by which features are already the row's own
    steps = [
        (sorted(order[:s]), order[s - 1] if s else None, order[s] if s < len(names) else None)
        for order in orders
        for s in range(len(names) + 1)
    ]
    cells = [
        F.struct(
            *[(F.col(c).cast("double") if j in own else F.lit(float(means[c]))).alias(c) for j, c in enumerate(names)],
            F.lit(-1 if gained is None else gained).alias("_gained"),
            F.lit(-1 if lost is None else lost).alias("_lost"),
        )
        for own, gained, lost in steps
    ]
    rows = df.select(key, F.explode(F.array(*cells)).alias("cell")).select(key, "cell.*")
    scored = score(rows).select(key, "score", "_gained", "_lost")
    sides = F.array(
        F.struct(F.col("_gained").alias("at"), F.col("score").alias("v")),
        F.struct(F.col("_lost").alias("at"), (-F.col("score")).alias("v")),
    )
    long = scored.select(key, F.explode(sides).alias("side")).where(F.col("side.at") >= 0)
    named = F.element_at(F.array(*[F.lit(c) for c in names]), F.col("side.at") + 1)
    return long.groupBy(key, named.alias("feature")).agg((F.sum("side.v") / permutations).alias("contribution"))


@dataclass
class Leaf:
    """A leaf of a fitted tree: its value and, for each feature on its path, the range that leads to it
    and the share of the training rows that goes that way where the feature is unknown."""

    value: float
    features: list[int]
    low: list[float]
    high: list[float]
    share: list[float]


def leaves_of(node: object, weight: float, bounds: Mapping[int, tuple[float, float, float]] | None = None) -> list[Leaf]:
    """Leaves of a tree of the JVM model, walked from its root; ``bounds`` is (low, high, share) by feature."""
    bounds = dict(bounds or {})
    if node.subtreeDepth() == 0:
        names = sorted(bounds)
        low, high, share = ([bounds[f][i] for f in names] for i in range(3))
        return [Leaf(weight * node.prediction(), names, low, high, share)]
    feature, cut = node.split().featureIndex(), node.split().threshold()
    size = node.impurityStats().count()
    out = []
    for child, left in ((node.leftChild(), True), (node.rightChild(), False)):
        low, high, share = bounds.get(feature, (-np.inf, np.inf, 1.0))
        # a row goes left if its value is at most the threshold
        narrowed = (low, min(high, cut)) if left else (max(low, cut), high)
        part = child.impurityStats().count() / size if size else 0.0
        out += leaves_of(child, weight, bounds | {feature: (*narrowed, share * part)})
    return out


def boosted_leaves(model: object) -> list[Leaf]:
    """All leaves of boosted trees over numbers; as many as the model has, whatever the data."""
    return [leaf for tree, w in zip(model.trees, model.treeWeights) for leaf in leaves_of(tree._java_obj.rootNode(), w)]


def path_weights(x: np.ndarray, leaves: Sequence[Leaf]) -> np.ndarray:
    """Shapley values of the summed leaf values for every row of ``x``.

    A known feature decides whether a row can reach a leaf, an unknown one reaches it by its share.
    With o and z for the two, a leaf adds (o_f - z_f) times the mean over the sizes of sets S of other
    path features of the products of o in S and z outside; the products are summed up by size, one
    feature after the other.
    """
    out = np.zeros(x.shape)
    for leaf in leaves:
        d = len(leaf.features)
        if not d:
            continue
        known = [((x[:, f] > lo) & (x[:, f] <= hi)).astype(float) for f, lo, hi in zip(leaf.features, leaf.low, leaf.high)]
        for i, f in enumerate(leaf.features):
            by_size = np.zeros((d, len(x)))
            by_size[0] = 1.0
            for j in range(d):
                if j != i:
                    grown = by_size * leaf.share[j]
                    grown[1:] += by_size[:-1] * known[j]
                    by_size = grown
            weights = np.array([factorial(k) * factorial(d - k - 1) / factorial(d) for k in range(d)])
            out[:, f] += leaf.value * (known[i] - leaf.share[i]) * (weights @ by_size)
    return out


def tree_contributions(df: DataFrame, features: Sequence[str], model: object, key: str = "student_id") -> DataFrame:
    """Exact contributions of features to the margin of boosted trees: (key, feature, contribution).

    One pass over the rows; a row's values add up to its margin less the mean margin over the
    trees' training rows. Missing numbers count as zero, as in scoring.
    """
    names, leaves = list(features), boosted_leaves(model)
    kind = df.schema[key].dataType.simpleString()
    filled = df.select(key, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"_x{i}") for i, c in enumerate(names)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = path_weights(batch[[f"_x{i}" for i in range(len(names))]].to_numpy(float), leaves)
            yield pd.DataFrame({key: np.repeat(batch[key].to_numpy(), len(names)), "feature": names * len(batch), "contribution": got.ravel()})

    return filled.mapInPandas(run, f"`{key}` {kind}, feature string, contribution double")


def strongest(contributions: DataFrame, n: int, key: str = "student_id") -> DataFrame:
    """The ``n`` strongest signed contributions of each row."""
    return top_n(contributions, key, [F.desc(F.abs("contribution")), F.asc("feature")], n)


def mean_strength(contributions: DataFrame, n: int | None = None) -> DataFrame:
    """Mean absolute contribution per feature, strongest first."""
    ordered = (
        contributions.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("strength"))
        .orderBy(F.desc("strength"), "feature")
    )
    return ordered if n is None else ordered.limit(n)
