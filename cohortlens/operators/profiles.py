"""Text profiles of courses and students."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COURSE_TEXT = [
    "course_name",
    "department",
    "course_description",
    "modules",
    "career_outcomes",
    "entry_requirements",
]
# Tariff phrases (at least 144, at least 112, below).
TARIFF_PHRASES = {
    "keywords": ["high grades distinction", "good grades merit", "standard grades pass"],
    "sentence": [
        "high achieving student with excellent grades",
        "good student with solid academic performance",
        "student meeting standard entry requirements",
    ],
}


def course_text(courses: DataFrame) -> DataFrame:
    """Add ``text``: the descriptive columns that exist, joined by blanks, NULLs left out."""
    parts = [F.col(c).cast("string") for c in COURSE_TEXT if c in courses.columns]
    return courses.withColumn("text", F.concat_ws(" ", *parts))


def student_profiles(students: DataFrame, qualifications: DataFrame) -> DataFrame:
    """Students with qualification, tariff and subject interests (the segment stands in for them)."""
    return students.join(qualifications, "student_id", "left").withColumn("subject_interests", F.col("ethnicity"))


def student_text(people: DataFrame, phrases: str = "keywords") -> Column:
    """Qualification, interests, career goals and a tariff phrase as one text."""
    high, good, standard = TARIFF_PHRASES[phrases]
    tariff = F.col("ucas_tariff_points")
    kinds = dict(people.dtypes)
    parts = []
    for c in ("qualification_type", "subject_interests", "career_aspirations"):
        if c in kinds:
            parts.append(F.array_join(c, " ") if kinds[c].startswith("array") else F.col(c))
    phrase = F.when(tariff >= 144, high).when(tariff >= 112, good).when(tariff.isNotNull(), standard)
    return F.concat_ws(" ", *parts, phrase)


def postcode_area(postcode: Column) -> Column:
    return F.upper(F.substring(postcode, 1, 2))
