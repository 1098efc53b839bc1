"""Weekly online activity kept up to date from a stream of raw events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions.expr import count_where
from cohortlens.sources.files import BucketedTable

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
#: What an event of each type counts as.
COUNTS = {"logins": "view", "resources_accessed": "click", "forum_posts": "signup", "quiz_attempts": "purchase", "video_views": "error"}
WEEK = "7 days"
TABLE_SCHEMA = "student_id long, week_start timestamp_ntz, " + ", ".join(f"{c} long" for c in [*COUNTS, "total_actions"]) + ", version long"


def read_events(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """Events of a growing folder of parquet files (or a pattern of paths); each micro-batch takes some of the files."""
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def activity() -> list[Column]:
    return [*[count_where(F.col("event_type") == kind).alias(name) for name, kind in COUNTS.items()], F.count("*").alias("total_actions")]


def weekly_activity(events: DataFrame, late: str = "14 days") -> DataFrame:
    """Counts per student and seven-day window.

    An event counts if it is no more than ``late`` behind the newest event of the micro-batches
    before (and, as Spark lets the mark take effect a batch later, of those before these). A window
    whose end lies further back is closed: its counts stay and its state is dropped.
    """
    # times without a zone are read as UTC whatever the session's zone, so that weeks begin alike everywhere
    zone = F.current_timezone()
    timed = events.withColumn("at", F.convert_timezone(F.lit("UTC"), zone, F.col("ts")).cast("timestamp")).withWatermark("at", late)
    grouped = timed.groupBy(F.col("user_id").alias("student_id"), F.window("at", WEEK).alias("w")).agg(*activity())
    start = F.convert_timezone(zone, F.lit("UTC"), F.col("w.start").cast("timestamp_ntz"))
    return grouped.select("student_id", start.alias("week_start"), *COUNTS, "total_actions")


def keep_weekly(events: DataFrame, table: BucketedTable, state: str, late: str = "14 days") -> None:
    """Process all files that are there, then stop; the table holds the newest counts of every window.

    Each micro-batch upserts the windows that it changed, with the batch number as version, so a
    batch that is run again changes nothing. ``state`` is the folder of the stream's progress.
    """

    def put(batch: DataFrame, number: int) -> None:
        table.upsert(batch.withColumn("version", F.lit(number).cast("long")))

    query = (
        weekly_activity(events, late)
        .writeStream.outputMode("update")
        .option("checkpointLocation", state)
        .foreachBatch(put)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def new_table(spark: SparkSession, path: str, buckets: int = 16) -> BucketedTable:
    table = BucketedTable(path, ["student_id", "week_start"], "version", buckets, TABLE_SCHEMA)
    table.create(spark.createDataFrame([], TABLE_SCHEMA))
    return table
