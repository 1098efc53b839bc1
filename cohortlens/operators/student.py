"""Student-level features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.expr import band, flag, lookup, one_hot
from cohortlens.operators.categories import dummies
from cohortlens.operators.sparse import LevelTable

# Grade band edges and labels.
GRADE_EDGES = [0, 80, 112, 128, 144, 168, 200]
GRADE_LABELS = ["C", "BC", "B", "AB", "A", "A*"]
# Ethnicity groups.
ETHNICITY_GROUPS = {
    "White British": "white_british",
    "White Irish": "white_other",
    "White Other": "white_other",
    "Mixed": "mixed",
    "Asian/Asian British": "asian",
    "Black/Black British": "black",
    "Other Ethnic Group": "other",
    "Not disclosed": "not_disclosed",
}
ETHNICITY_FLAGS = ["white_british", "asian", "black", "white_other", "mixed"]


def grade_band(tariff: Column) -> Column:
    return band(tariff, GRADE_EDGES, GRADE_LABELS)


def contextual_score(care_leaver: Column, first_generation: Column, low_participation: Column) -> Column:
    return care_leaver.cast("int") * 3 + first_generation.cast("int") * 2 + low_participation.cast("int")


def ethnicity_group(ethnicity: Column) -> Column:
    return lookup(ethnicity, ETHNICITY_GROUPS, "unknown")


def age_at(enrolled: Column, born: Column) -> Column:
    return F.datediff(enrolled, born) / 365.25


def age_by_year(born: Column, reference_year: int = 2024, default: int = 19) -> Column:
    return F.coalesce(F.lit(reference_year) - F.year(born), F.lit(default))


def student_features(students: DataFrame, qualifications: DataFrame, levels: LevelTable | None = None) -> DataFrame:
    """Demographic, socio-economic and qualification features, one row per student.

    With ``levels`` (of ethnicity and qualification_type) the levels are positions ``categories`` of a sparse
    vector, without each is a column.
    """
    if levels is None:
        ethnicities = dummies(students, "ethnicity", "ethnicity")
        kinds = dummies(qualifications, "qualification_type", "qual")
    else:
        ethnicities, kinds = [F.col("categories")], []
    low = flag(F.col("polar_quintile") == 1)
    joined = students.join(qualifications, "student_id", "left").withColumn(
        "grade_band", grade_band(F.col("ucas_tariff_points"))
    )
    if levels is not None:
        joined = levels.positions(joined, "categories")
    return joined.select(
        "student_id",
        flag(F.col("gender") == "Female").alias("gender_encoded"),
        *ethnicities,
        (11 - F.col("imd_decile")).alias("imd_inverse"),
        low.alias("low_participation_area"),
        contextual_score(F.col("care_leaver"), F.col("first_generation_uni"), low).alias("contextual_score"),
        *kinds,
        "ucas_tariff_points",
        F.col("predicted_grade").cast("int").alias("predicted_grade"),
        "grade_band",
        *one_hot(F.col("grade_band"), GRADE_LABELS, "grade"),
    )
