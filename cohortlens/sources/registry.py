"""Feature registry: what a feature is, how it was made and where it belongs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ["numeric", "categorical", "binary", "datetime", "ordinal"]
SCHEMA = "name string, kind string, description string, feature_group string, transformation string, cardinality long"


class FeatureRegistry:
    """Metadata rows by feature name; a later entry of a name replaces the earlier one."""

    def __init__(self):
        self.entries: dict[str, tuple] = {}

    def register(
        self,
        name: str,
        kind: str,
        description: str,
        group: str,
        transformation: str | None = None,
        cardinality: int | None = None,
    ) -> None:
        if kind not in KINDS:
            raise ValueError(f"unknown kind {kind!r}: use one of {KINDS}")
        self.entries[name] = (name, kind, description, group, transformation, cardinality)

    def names(self, group: str | None = None) -> list[str]:
        return [e[0] for e in self.entries.values() if group is None or e[3] == group]

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.entries.values()), SCHEMA)

    def annotate(self, df: DataFrame) -> DataFrame:
        """Attach description and group to the columns as metadata."""
        for name, kind, description, group, *_ in self.entries.values():
            if name in df.columns:
                df = df.withMetadata(name, {"kind": kind, "description": description, "group": group})
        return df


def describe(df: DataFrame, groups: Mapping[str, str], key: str) -> FeatureRegistry:
    """Register every column but the key; ``groups`` maps name prefixes to groups.

    Distinct values of all columns are counted together, as (column, value) rows that combine in the tasks.
    """
    registry = FeatureRegistry()
    names = [c for c in df.columns if c != key]
    cells = [F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").cast("string").alias("value")) for c in names]
    long = df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*").where("value is not null").distinct()
    counts = dict.fromkeys(names, 0) | {r["name"]: r["n"] for r in long.groupBy("name").agg(F.count("*").alias("n")).collect()}
    for field in df.schema.fields:
        if field.name == key:
            continue
        group = next((g for prefix, g in groups.items() if field.name.startswith(prefix)), "other")
        number = isinstance(field.dataType, T.NumericType)
        kind = "categorical" if not number else "binary" if counts[field.name] <= 2 else "numeric"
        registry.register(field.name, kind, f"{group}: {field.name}", group, cardinality=counts[field.name])
    return registry


def save(registry: FeatureRegistry, spark: SparkSession, path: str) -> None:
    registry.table(spark).write.option("header", True).csv(path)


def load(spark: SparkSession, path: str) -> FeatureRegistry:
    out = FeatureRegistry()
    for row in spark.read.schema(SCHEMA).option("header", True).csv(path).collect():
        out.entries[row["name"]] = tuple(row)
    return out
