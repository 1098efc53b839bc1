"""Reading typed CSV and writing results."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.session import reliable_checkpoint

# Tables of the tutor pages.
RISK_SCHEMA = (
    "student_id string, risk_score double, tier string, course_code string, year_group string, "
    "last_activity_date date, risk_trend double, gender string, ethnicity string, disadvantaged boolean"
)
INTERVENTION_SCHEMA = (
    "student_id string, date date, intervention string, outcome string, outcome_score double, "
    "tutor string, follow_up_date date"
)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header, read with a declared schema (dates included)."""
    return spark.read.schema(schema).option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)


def append(df: DataFrame, path: str) -> None:
    """Add rows to a parquet table."""
    df.write.mode("append").parquet(path)


def write_statistics(profile: DataFrame, path: str) -> None:
    """Column statistics (column, statistic, value) as JSON lines."""
    profile.write.mode("overwrite").json(path)


def upsert(current: DataFrame, changes: DataFrame, key: Sequence[str], version: str) -> DataFrame:
    """Current rows with changes put in their place: per key the row of the highest version.

    The winner is found by an aggregate that combines map-side, so a key with very
    many versions is no heavy group. Write the result to a new path.
    """
    keys = list(key)
    rest = [c for c in current.columns if c not in keys and c != version]
    both = current.unionByName(changes)
    latest = both.groupBy(*keys).agg(F.max_by(F.struct(version, *rest), version).alias("_row"))
    return latest.select(*keys, F.col(f"_row.{version}").alias(version), *[F.col(f"_row.{c}").alias(c) for c in rest]).select(
        *current.columns
    )


@dataclass
class BucketedTable:
    """A parquet table laid out by a hash of its key, of which an upsert rewrites the touched buckets only.

    The layout (key and number of buckets) is fixed when the table is made. The declared ``schema``
    is what an empty table is read with.
    """

    path: str
    key: list[str]
    version: str
    buckets: int
    schema: str | None = None

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.key]), F.lit(self.buckets)).cast("int")

    def write(self, df: DataFrame, mode: str) -> None:
        # rows of a bucket meet in a few tasks, so a bucket is a few files
        dealt = df.withColumn("_bucket", self.bucket()).repartition("_bucket")
        writer = dealt.write.partitionBy("_bucket").mode(mode)
        if mode == "overwrite":
            writer = writer.option("partitionOverwriteMode", "dynamic")
        writer.parquet(self.path)

    def create(self, df: DataFrame) -> None:
        self.write(df, "errorifexists")

    def read(self, spark: SparkSession, only: Sequence[int] | None = None) -> DataFrame:
        reader = spark.read if self.schema is None else spark.read.schema(f"{self.schema}, _bucket int")
        table = reader.parquet(self.path)
        chosen = table if only is None else table.where(F.col("_bucket").isin(list(only)))
        return chosen.drop("_bucket")

    def upsert(self, changes: DataFrame) -> list[int]:
        """Put changed rows in place of those of equal key and lower version; returns the buckets rewritten.

        The new buckets are computed and kept before the old ones are replaced, so a lost task or
        executor never reads what it is replacing.
        """
        spark = changes.sparkSession
        kept = reliable_checkpoint(changes)
        touched = sorted(r[0] for r in kept.select(self.bucket()).distinct().collect())  # at most one number per bucket
        if touched:
            current = self.read(spark, touched).select(*kept.columns)
            self.write(reliable_checkpoint(upsert(current, kept, self.key, self.version)), "overwrite")
        return touched
