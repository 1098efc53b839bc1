"""One-hot features of any number of levels, as positions of a sparse vector."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.ordering import distinct_numbers
from cohortlens.session import reliable_checkpoint


@dataclass
class LevelTable:
    """Numbered levels of several columns: (column, level, position), in a table of any size.

    Positions run from ``first`` without gaps, by column and then by level. ``missing`` is the
    level of a missing value; without it a missing value has no position, like an unseen one.
    """

    columns: list[str]
    table: DataFrame
    missing: str | None
    first: int = 0

    @classmethod
    def fit(
        cls, df: DataFrame, columns: Sequence[str], drop_first: bool = False, missing: str | None = None, first: int = 0
    ) -> LevelTable:
        """Number the levels of the data; ``drop_first`` leaves out each column's smallest."""
        columns = list(columns)
        cells = [F.struct(F.lit(i).alias("i"), level(F.col(c), missing).alias("level")) for i, c in enumerate(columns)]
        long = df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*").where("level is not null").distinct()
        if drop_first:
            # one row per column
            least = long.groupBy("i").agg(F.min("level").alias("level"))
            long = long.join(least, ["i", "level"], "left_anti")
        numbers = distinct_numbers(long.select(F.struct("i", "level").alias("_value")))
        names = F.array(*[F.lit(c) for c in columns])
        table = numbers.select(
            names[F.col("_value.i")].alias("column"), F.col("_value.level").alias("level"), (F.col("_number") + first).alias("position")
        )
        return cls(columns, reliable_checkpoint(table), missing, first)

    @cached_property
    def size(self) -> int:
        return self.table.count()

    def positions(self, df: DataFrame, into: str = "positions") -> DataFrame:
        """Add the ascending positions of each row's levels."""
        at = []
        for i, c in enumerate(self.columns):
            mine = self.table.where(F.col("column") == c).select(F.col("level").alias(f"_level_{i}"), F.col("position").alias(f"_at_{i}"))
            df = df.withColumn(f"_value_{i}", level(F.col(f"`{c}`"), self.missing)).join(
                mine, F.col(f"_value_{i}") == F.col(f"_level_{i}"), "left"
            )
            at.append(F.col(f"_at_{i}"))
        spare = [f"_{x}_{i}" for i in range(len(self.columns)) for x in ("value", "level", "at")]
        return df.withColumn(into, F.array_compact(F.array(*at))).drop(*spare)

    def pairs(self, df: DataFrame, key: str) -> DataFrame:
        """One row per row of ``df`` and level: (key, position, column, level)."""
        long = self.positions(df).select(key, F.explode("positions").alias("position"))
        return long.join(self.table, "position").select(key, "position", "column", "level")


def level(value: Column, missing: str | None) -> Column:
    text = value.cast("string")
    return text if missing is None else F.coalesce(text, F.lit(missing))


def as_vectors(df: DataFrame, positions: str, size: int, into: str = "features") -> DataFrame:
    """Sparse vectors with ones at the positions, for models whose coefficients are as many.

    Such a model holds ``size`` coefficients on the driver, and so does the list of positions here.
    """
    words = CountVectorizerModel.from_vocabulary([str(i) for i in range(size)], inputCol="_words", outputCol=into)
    words.setBinary(True)
    return words.transform(df.withColumn("_words", F.transform(positions, lambda p: p.cast("string")))).drop("_words")
