"""Category levels, dummies and codes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.expr import column_name, flag, one_hot
from cohortlens.functions.ordering import distinct_numbers

MAX_LEVELS = 1000


def levels(df: DataFrame, column: str) -> list[str]:
    """Sorted distinct values of a category column."""
    return levels_of(df, {column: F.col(column)})[column]


def levels_of(df: DataFrame, values: Mapping[str, Column]) -> dict[str, list[str]]:
    """Sorted distinct values of several category columns, from one pass.

    The lists become columns of a plan, one per level, which suits up to ``MAX_LEVELS`` values per
    column; ``sparse.LevelTable`` gives the same features for any number of levels.
    """
    cells = [F.struct(F.lit(c).alias("column"), v.alias("value")) for c, v in values.items()]
    long = df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")
    most = MAX_LEVELS * len(values)
    found = long.where(F.col("value").isNotNull()).distinct().limit(most + 1).collect()
    out = {c: sorted(r["value"] for r in found if r["column"] == c) for c in values}
    if len(found) > most or any(len(v) > MAX_LEVELS for v in out.values()):
        raise ValueError(f"more than {MAX_LEVELS} columns for {list(values)}: use sparse.LevelTable, which takes any number of levels")
    return out


def top_levels(df: DataFrame, column: str, n: int = 5) -> list[str]:
    """The ``n`` most frequent values, ties by name."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return [r[0] for r in counts.orderBy(F.desc("n"), column).limit(n).collect()]


def dummies(df: DataFrame, column: str, prefix: str) -> list[Column]:
    """0/1 columns for all levels of the data."""
    return one_hot(F.col(column), levels(df, column), prefix)


def dummies_drop_first(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """0/1 columns for all but the first level; a missing value is level 'Unknown'."""
    values = {c: F.coalesce(F.col(c).cast("string"), F.lit("Unknown")) for c in columns}
    known = levels_of(df, values)
    return [flag(v == level).alias(column_name(c, level)) for c, v in values.items() for level in known[c][1:]]


def dense_codes(df: DataFrame, column: str, into: str) -> DataFrame:
    """Code 0, 1, 2, … per distinct value in name order; -1 for a missing value."""
    return coded(df, column, F.col(column), distinct_numbers(df.select(F.col(column).alias("_value"))), into)


def coded(df: DataFrame, column: str, value: Column, numbers: DataFrame, into: str) -> DataFrame:
    """Join a table of codes (_value, _number); values that it lacks become -1."""
    found = df.withColumn("_value", value).join(numbers, "_value", "left")
    return found.withColumn(into, F.coalesce("_number", F.lit(-1)).cast("int")).drop("_value", "_number")


class LabelCodes:
    """Codes of the sorted training values; values not seen in training become -1."""

    def __init__(self, known: dict[str, DataFrame]):
        self.known = known

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str]) -> LabelCodes:
        return cls({c: distinct_numbers(df.select(F.col(c).cast("string").alias("_value"))) for c in columns})

    def transform(self, df: DataFrame) -> DataFrame:
        for c, numbers in self.known.items():
            df = coded(df, c, F.col(c).cast("string"), numbers, f"{c}_encoded")
        return df


def counts_in_order(df: DataFrame, column: str, ordered: Sequence[str]) -> DataFrame:
    """Row count per value of a fixed list, 0 for absent values: (value, n)."""
    grid = df.agg(
        *[F.count_if(F.col(column) == v).alias(f"n{i}") for i, v in enumerate(ordered)]
    )
    return grid.select(
        F.explode(
            F.array(*[
                F.struct(F.lit(v).alias(column), F.coalesce(F.col(f"n{i}"), F.lit(0)).alias("n"))
                for i, v in enumerate(ordered)
            ])
        ).alias("row")
    ).select("row.*")
