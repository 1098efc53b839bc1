"""Column statistics of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def column_profile(df: DataFrame) -> DataFrame:
    """Statistics as rows ``(column, statistic, value)``, from one pass over the table.

    Numbers: mean, std, min, max; other columns: distinct values. All columns:
    missing values as count and percentage.
    """
    aggs, names = [], []

    def add(column: str, statistic: str, value) -> None:
        names.append((column, statistic))
        aggs.append(value.cast("double").alias(f"s{len(aggs)}"))

    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, T.NumericType):
            for statistic, fn in (("mean", F.avg), ("std", F.stddev), ("min", F.min), ("max", F.max)):
                add(field.name, statistic, fn(c))
        else:
            add(field.name, "distinct", F.count_distinct(c))
        missing = F.count("*") - F.count(c)
        add(field.name, "null_count", missing)
        add(field.name, "null_percent", F.try_divide(missing * 100.0, F.count("*")))
    cells = [
        F.struct(F.lit(c).alias("column"), F.lit(s).alias("statistic"), F.col(f"s{i}").alias("value"))
        for i, (c, s) in enumerate(names)
    ]
    return df.agg(*aggs).select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")
