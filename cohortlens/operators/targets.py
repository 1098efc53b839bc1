"""Labels of enrolments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.expr import flag, lookup

# Ordinal codes.
CLASSIFICATION_CODES = {"First": 4, "2:1": 3, "2:2": 2, "Third": 1, "Pass": 0, "Fail": 0}
DEGREE_CODES = {"Fail": 0, "Third": 1, "2:2": 2, "2:1": 3, "First": 4}
EMPLOYMENT_CODES = {"Unemployed": 0, "Further Study Only": 1, "Both Employed and Study": 2, "Employed": 3}
SALARY_CODES = {"Under £20,000": 0, "£20,000 - £30,000": 1, "£30,000 - £40,000": 2, "Over £40,000": 3}
DESTINATION_CODES = {"Not Studying": 0, "UK": 1, "EU": 2, "International": 3}
RISK_CODES = {"Low": 0, "Medium": 1, "High": 2, "Critical": 3}
GRADE_CODES = {"Fail": 0, "Pass": 1, "Merit": 2, "Distinction": 3}
DEMAND_CODES = {"Low": 0, "Medium": 1, "High": 2, "Oversubscribed": 3}


def classification_code(name: Column) -> Column:
    return lookup(name, CLASSIFICATION_CODES, -1)


def at_risk(status: Column, retained: Column) -> Column:
    return flag((status == "Withdrawn") | (retained == 0))


def enrollment_targets(enrollments: DataFrame) -> DataFrame:
    """Satisfaction, acceptance, risk and classification labels per enrolment."""
    good = F.col("final_classification").isin("First", "2:1", "Completed")
    return enrollments.select(
        "student_id",
        "course_id",
        flag((F.col("retained_year2") == 1) & good).alias("high_satisfaction"),
        F.lit(1).alias("accepted_offer"),
        at_risk(F.col("enrollment_status"), F.col("retained_year2")).alias("at_risk"),
        classification_code(F.col("final_classification")).alias("classification_numeric"),
    )


def yield_label(enrollments: DataFrame) -> DataFrame:
    """A two-class label where offer data is absent: kept past the first year or not."""
    return enrollments.withColumn("accepted", flag(F.col("retained_year2") == 1))
