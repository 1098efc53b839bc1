"""Input tables: the parquet files and the canonical student tables over them."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions.expr import count_where
from cohortlens.session import spread

# Declared schemas, so that a scan needs no inference job.
RAW_SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


class Campus:
    """Lazy access to the tables of one data folder.

    Every attribute is an unexecuted DataFrame; nothing is read until an action.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(RAW_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def tables(self) -> dict[str, DataFrame]:
        """The canonical table set by name."""
        return {name: getattr(self, name) for name in CANONICAL}

    @cached_property
    def n_courses(self) -> Column:
        """Number of courses as a scalar subquery."""
        return self.raw("part").agg(F.count("*")).scalar()

    @cached_property
    def students(self) -> DataFrame:
        key = F.col("c_custkey")
        twentieth = key % 20
        return self.raw("customer").select(
            key.alias("student_id"),
            F.when(twentieth == 0, "Other").when(twentieth == 1, "Not disclosed")
            .when(twentieth < 11, "Male").otherwise("Female").alias("gender"),
            F.col("c_mktsegment").alias("ethnicity"),
            F.date_add(F.lit("1986-01-01").cast("date"), (key * 37 % 3600).cast("int")).alias("date_of_birth"),
            (1 + key % 10).cast("int").alias("imd_decile"),
            (1 + F.col("c_nationkey") % 5).cast("int").alias("polar_quintile"),
            (key % 50 == 0).cast("int").alias("care_leaver"),
            (key % 7 == 0).cast("int").alias("disability"),
            (key % 9 < 4).cast("int").alias("first_generation_uni"),
        )

    @cached_property
    def qualifications(self) -> DataFrame:
        kind = F.col("c_nationkey") % 5
        return self.raw("customer").select(
            F.col("c_custkey").alias("student_id"),
            F.when(kind == 0, "BTEC").when(kind == 1, "Access to HE")
            .when(kind == 2, "International Baccalaureate").otherwise("A-Level").alias("qualification_type"),
            (56 + F.floor((F.col("c_acctbal") + 1000.0) / 11000.0 * 112)).cast("int").alias("ucas_tariff_points"),
            (F.col("c_custkey") % 10 < 7).cast("int").alias("predicted_grade"),
        )

    @cached_property
    def courses(self) -> DataFrame:
        size = F.col("p_size")
        return self.raw("part").select(
            F.col("p_partkey").alias("course_id"),
            F.col("p_name").alias("course_name"),
            F.col("p_type").alias("department"),
            (80 + 8 * (size % 12)).cast("int").alias("entry_tariff"),
            F.when(F.col("p_partkey") % 7 == 0, 4).otherwise(3).alias("course_length_years"),
            (80 - size).cast("int").alias("exam_weight_pct"),
            (20 + size).cast("int").alias("coursework_weight_pct"),
            (0.70 + 0.28 * ((F.col("p_retailprice") - 900.0) / 100.0)).alias("employment_rate_15m"),
            (3.5 + (size % 14) / 10.0).cast("double").alias("satisfaction_score"),
            (F.col("p_partkey") % 5 < 2).cast("int").alias("accredited"),
        )

    @cached_property
    def enrollments(self) -> DataFrame:
        # the first order by (date, key): a min over a struct, combined map-side,
        # so that a customer with very many orders is no heavy group
        first = self.raw("orders").groupBy("o_custkey").agg(
            F.min(F.struct("o_orderdate", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")).alias("o")
        )
        status, price = F.col("o.o_orderstatus"), F.col("o.o_totalprice")
        left = (status == "P") & F.col("o.o_orderpriority").isin("1-URGENT", "2-HIGH")
        return first.select(
            F.col("o_custkey").alias("student_id"),
            (F.col("o.o_orderkey") % self.n_courses).alias("course_id"),
            F.to_date("o.o_orderdate").alias("enrollment_date"),
            F.when(status == "F", "Completed").when(left, "Withdrawn").otherwise("Active").alias("enrollment_status"),
            F.when(left | (F.col("o.o_orderkey") % 10 == 0), 0).otherwise(1).alias("retained_year2"),
            F.when(status != "F", None).when(price >= 400000, "First").when(price >= 250000, "2:1")
            .when(price >= 100000, "2:2").when(price >= 30000, "Third").otherwise("Pass").alias("final_classification"),
            F.year("o.o_orderdate").alias("academic_year"),
        )

    @cached_property
    def modules(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.raw("supplier").select(
            key.alias("module_id"),
            (key % self.n_courses).alias("course_id"),
            (1 + key % 3).cast("int").alias("year"),
            F.when(key % 3 == 0, 10).when(key % 3 == 1, 15).otherwise(20).alias("credits"),
        )

    @cached_property
    def assessments(self) -> DataFrame:
        flagged, line = F.col("l_returnflag"), F.col("l_linestatus")
        return (
            self.raw("lineitem")
            .join(self.raw("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                F.col("o_custkey").alias("student_id"),
                F.col("l_suppkey").alias("module_id"),
                (F.col("l_quantity") * 2.0).alias("mark"),
                F.when((flagged == "R") & (line == "O"), 0).otherwise(1).alias("submitted"),
                F.when((flagged == "A") & (line == "O"), 1).otherwise(0).alias("late_submission"),
                F.when(F.col("l_linenumber") >= 6, 2).otherwise(1).alias("attempt"),
            )
        )

    @cached_property
    def vle_engagement(self) -> DataFrame:
        kind = F.col("event_type")
        return (
            self.raw("events")
            .groupBy(F.col("user_id").alias("student_id"), F.dayofmonth("ts").alias("week"))
            .agg(
                count_where(kind == "view").alias("logins"),
                count_where(kind == "click").alias("resources_accessed"),
                count_where(kind == "signup").alias("forum_posts"),
                count_where(kind == "purchase").alias("quiz_attempts"),
                count_where(kind == "error").alias("video_views"),
                F.count("*").alias("total_actions"),
            )
        )

    @cached_property
    def attendance(self) -> DataFrame:
        vle = self.vle_engagement.select("student_id", "week", "total_actions")
        # a calendar holds at most 31 day numbers, so one small array carries all weeks
        weeks = vle.agg(F.collect_set("week")).scalar()
        grid = vle.select("student_id").distinct().withColumn("week", F.explode(weeks))
        spread = (F.col("student_id") + F.col("week")) % 20
        present = F.col("total_actions") >= 1
        return grid.join(vle, ["student_id", "week"], "left").select(
            "student_id",
            "week",
            F.when(present, 1).otherwise(0).alias("attended"),
            F.when(present, "Present").when(spread < 10, "Absent").when(spread < 17, "Authorised Absence")
            .otherwise("Medical").alias("status"),
        )

    @cached_property
    def interactions(self) -> DataFrame:
        """How often a student met a course: (student_id, course_id, n_taken, rating)."""
        lines, orders = self.raw("lineitem").select("l_orderkey", "l_partkey", "l_quantity"), self.raw("orders").select("o_orderkey", "o_custkey")
        size = lines.count()
        met = spread(lines, size, "l_orderkey").join(spread(orders, size, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        pairs = met.select(F.col("o_custkey").alias("student_id"), F.col("l_partkey").alias("course_id"), "l_quantity")
        return (
            spread(pairs, size, "student_id", "course_id")
            .groupBy("student_id", "course_id")
            .agg(F.count("*").alias("n_taken"), F.avg("l_quantity").alias("rating"))
        )

    @cached_property
    def predictions(self) -> DataFrame:
        """Binary and ordinal predictions with groups, derived from the students."""
        key = F.col("student_id")
        truth = (key % 5 < 2).cast("int")
        score = ((key * 7919) % 1000) / 1000.0 * 0.6 + 0.4 * truth
        y = (key % 5).cast("int")
        return self.students.select(
            "student_id",
            "gender",
            "ethnicity",
            F.when(F.col("imd_decile") <= 2, "low").when(F.col("imd_decile") <= 7, "mid").otherwise("high").alias("imd_band"),
            truth.alias("y_true"),
            score.cast("double").alias("score"),
            (score >= 0.5).cast("int").alias("y_pred"),
            y.alias("y"),
            F.least(F.lit(4), F.greatest(F.lit(0), y + (key % 3).cast("int") - 1)).alias("p"),
        )


CANONICAL = [
    "students",
    "qualifications",
    "courses",
    "enrollments",
    "modules",
    "assessments",
    "vle_engagement",
    "attendance",
]
