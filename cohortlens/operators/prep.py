"""Scaling, splits and folds."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.expr import count_where
from cohortlens.functions.ordering import average_ranks, join_same, running_totals


def percentile_ranks(df: DataFrame, value: str, into: str = "percentile") -> DataFrame:
    """(mean rank - 1) / n · 100 of every row."""
    n = df.agg(F.count(value)).scalar()
    ranked = average_ranks(df, value, "_rank")
    return ranked.withColumn(into, (F.col("_rank") - 1) / n * 100).drop("_rank")


@dataclass
class Scaling:
    """Means and population deviations learned on one table, applied to any other."""

    mean: dict[str, float]
    std: dict[str, float]

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str]) -> Scaling:
        row = df.agg(
            *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
            *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)],
        ).first()
        return cls(
            {c: row[f"m{i}"] for i, c in enumerate(columns)},
            {c: row[f"s{i}"] or 1.0 for i, c in enumerate(columns)},
        )

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c) - self.mean[c]) / self.std[c] for c in self.mean})


def hash_draw(key: Column, seed: int = 42) -> Column:
    """A reproducible number in [0, 1) per key."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1_000_000_007)) / 1_000_000_007


def random_split(df: DataFrame, key: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``part`` train/test by a hash of the key; needs no shuffle."""
    return df.withColumn("part", F.when(hash_draw(F.col(key), seed) < test_size, "test").otherwise("train"))


def stratified_split(df: DataFrame, key: str, label: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``part`` so that each class gives exactly its rounded share to the test rows.

    The first rows of each class by hash order are the test rows. The order is
    computed in buckets, as a class may hold most of the table.
    """
    drawn = df.withColumn("_draw", F.xxhash64(F.col(key), F.lit(seed)))
    placed = place_in_group(drawn, label, "_draw", key)
    sizes = df.groupBy(label).agg(F.count("*").alias("_size"))
    limit = F.bround(F.col("_size") * test_size, 0)
    return (
        join_same(placed, sizes, [label])
        .withColumn("part", F.when(F.col("_place") <= limit, "test").otherwise("train"))
        .drop("_draw", "_place", "_size")
    )


def place_in_group(df: DataFrame, group: str, order: str, key: str, many_ties: bool = False, spread: bool = False) -> DataFrame:
    """Add ``_place``: 1, 2, … per group by ``order``, then ``key``, without a task per group.

    Rows that agree in group and order are few by default, as with a hash. With
    ``many_ties`` they may be most of the table; ``key`` must then be a unique number,
    and the rows of a tie are placed by running counts over it as well. With ``spread`` the counts
    of the earlier rows, one per group and order, are shuffled whatever their size, so that the driver
    never holds them for a broadcast.
    """
    ties = df.groupBy(group, order).agg(F.count("*").alias("_n"))
    before = running_totals(ties, order, {"_upto": "_n"}, within=[group]).select(
        group, order, (F.col("_upto") - F.col("_n")).alias("_before")
    )
    if many_ties:
        counted = df.withColumn("_one", F.lit(1).cast("bigint"))
        inside = running_totals(counted, key, {"_inside": "_one"}, within=[group, order]).drop("_one")
    else:
        inside = df.withColumn("_inside", F.row_number().over(Window.partitionBy(group, order).orderBy(key)))
    if spread:
        before = before.hint("merge")
    whole = join_same(inside, before, [group, order])
    return whole.withColumn("_place", F.col("_before") + F.col("_inside")).drop("_before", "_inside")


def time_split(df: DataFrame, time: str, key: str, test_size: float = 0.2) -> DataFrame:
    """Add ``part``: the earliest rows are train, the last share is test."""
    placed = place_by_time(df, time, key)
    n = df.agg(F.count("*")).scalar()
    return placed.withColumn(
        "part", F.when(F.col("_place") <= F.floor(n * (1 - test_size)), "train").otherwise("test")
    ).drop("_place")


def place_by_time(df: DataFrame, time: str, key: str) -> DataFrame:
    """Add ``_place``: 1, 2, … by time, then key."""
    ticks = df.withColumn("_tick", F.unix_micros(F.col(time).cast("timestamp")))
    whole = place_in_group(ticks.withColumn("_all", F.lit(0)), "_all", "_tick", key, many_ties=True)
    return whole.drop("_all", "_tick")


def group_folds(df: DataFrame, group: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Add ``fold``: all rows of a group share one; groups are dealt out by size."""
    # larger groups come first; groups of one size in hash order
    sizes = df.groupBy(group).agg(F.count("*").alias("_n")).select(
        group,
        F.lit(0).alias("_all"),
        (-F.col("_n")).alias("_order"),
        F.xxhash64(F.col(group), F.lit(seed)).alias("_hash"),
    )
    dealt = place_in_group(sizes, "_all", "_order", "_hash", many_ties=True)
    snake = (F.col("_place") - 1) % (2 * k)
    fold = F.when(snake < k, snake).otherwise(2 * k - 1 - snake).cast("int")
    return join_same(df, dealt.select(group, fold.alias("fold")), [group])


def stratified_folds(df: DataFrame, key: str, label: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Add ``fold`` so that each class is spread evenly: round robin in hash order per class."""
    drawn = df.withColumn("_draw", F.xxhash64(F.col(key), F.lit(seed)))
    placed = place_in_group(drawn, label, "_draw", key)
    return placed.withColumn("fold", ((F.col("_place") - 1) % k).cast("int")).drop("_draw", "_place")


def time_folds(df: DataFrame, time: str, key: str, k: int = 5, gap: int = 0, test_size: int | None = None) -> DataFrame:
    """Expanding-window folds as rows ``(…, fold, part)``.

    The last ``k`` blocks of ``test_size`` rows (default n // (k+1)) are the tests;
    the rows before a block, less ``gap``, are its training rows.
    """
    n = df.count()
    size = test_size or n // (k + 1)
    placed = place_by_time(df, time, key)
    folds = placed.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    start = n - (k - F.col("fold")) * size
    at = F.col("_place") - 1
    part = F.when(at < start - gap, "train").when((at >= start) & (at < start + size), "test")
    return folds.withColumn("part", part).where(F.col("part").isNotNull()).drop("_place")


def imbalance_weight(df: DataFrame, label: str) -> DataFrame:
    """One row: negatives per positive, 1 if there are no positives."""
    pos, neg = count_where(F.col(label) == 1), count_where(F.col(label) == 0)
    return df.agg(
        pos.alias("n_pos"), neg.alias("n_neg"), F.coalesce(F.try_divide(neg, pos), F.lit(1.0)).alias("weight")
    )


def with_class_weight(df: DataFrame, label: str, into: str = "weight") -> DataFrame:
    """Weight positives by the imbalance, negatives by 1."""
    weight = imbalance_weight(df, label).select("weight").scalar()
    return df.withColumn(into, F.when(F.col(label) == 1, weight).otherwise(1.0))
