"""Sources, sinks and schema mapping (rows A1–A11)."""

from pyspark.sql import functions as F

from cohortlens.operators.profile import column_profile
from cohortlens.operators.student import student_features
from cohortlens.plans.registry import query
from cohortlens.functions.expr import column_name
from cohortlens.plans.aggregates import QUALIFICATION_PROFILE_SQL
from cohortlens.plans.features import GRADES, STUDENT_FEATURES_SQL
from cohortlens.plans.scalars import KINDS, SEGMENTS
from cohortlens.session import new_table_path
from cohortlens.sources import files, mapping, registry
from cohortlens.sources.tables import CANONICAL
from cohortlens.streaming import weekly


@query(
    "a1_scan_tables",
    " UNION ALL ".join(f"SELECT '{t}' AS name, COUNT(*) AS n FROM {t}" for t in CANONICAL),
)
def _(c):
    out = None
    for name, table in c.tables().items():
        one = table.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


LOG_SQL = """SELECT CAST(o_custkey AS VARCHAR) AS student_id, CAST(o_orderdate AS DATE) AS date, o_orderpriority AS intervention, o_orderstatus AS outcome,
 CAST(1 + o_orderkey % 5 AS DOUBLE) AS outcome_score, 'T' || CAST(o_orderkey % 9 AS VARCHAR) AS tutor, CAST(o_orderdate AS DATE) + 14 AS follow_up_date FROM orders"""


def log(c):
    day = F.to_date("o_orderdate")
    return c.raw("orders").select(
        F.col("o_custkey").cast("string").alias("student_id"),
        day.alias("date"),
        F.col("o_orderpriority").alias("intervention"),
        F.col("o_orderstatus").alias("outcome"),
        (1 + F.col("o_orderkey") % 5).cast("double").alias("outcome_score"),
        F.concat(F.lit("T"), F.col("o_orderkey") % 9).alias("tutor"),
        F.date_add(day, 14).alias("follow_up_date"),
    )


@query("a2_csv_scan", LOG_SQL, ["outcome_score"])
def _(c):
    path = new_table_path(c.spark, "interventions")
    log(c).write.option("header", True).csv(path)
    return files.read_csv(c.spark, path, files.INTERVENTION_SCHEMA)


GROUPS = {"ethnicity": "demographics", "gender": "demographics", "qual": "qualifications", "grade": "qualifications", "imd": "socioeconomic"}


STUDENT_FEATURES = [
    "gender_encoded", *[f"ethnicity_{v}" for v in SEGMENTS], "imd_inverse", "low_participation_area", "contextual_score",
    *[column_name("qual", v) for v in KINDS], "ucas_tariff_points", "predicted_grade", "grade_band", *[f"grade_{g}" for g in GRADES],
]


def registry_sql():
    """One row per feature, with its kind, group and distinct values."""
    rows = []
    for name in STUDENT_FEATURES:
        group = next((g for prefix, g in GROUPS.items() if name.startswith(prefix)), "other")
        kind = "'categorical'" if name == "grade_band" else f"""CASE WHEN COUNT(DISTINCT "{name}") <= 2 THEN 'binary' ELSE 'numeric' END"""
        rows.append(f"""SELECT '{name}' AS name, {kind} AS kind, '{group}' AS feature_group, COUNT(DISTINCT "{name}") AS cardinality FROM f""")
    return f"WITH f AS ({STUDENT_FEATURES_SQL}) " + " UNION ALL ".join(rows)


@query("a3_registry_round_trip", registry_sql())
def _(c):
    path = new_table_path(c.spark, "registry")
    described = registry.describe(student_features(c.students, c.qualifications), GROUPS, "student_id")
    registry.save(described, c.spark, path)
    return registry.load(c.spark, path).table(c.spark).select("name", "kind", "feature_group", "cardinality")


@query("a4_statistics_sink", QUALIFICATION_PROFILE_SQL, ["value"])
def _(c):
    path = new_table_path(c.spark, "statistics")
    files.write_statistics(column_profile(c.qualifications), path)
    return c.spark.read.schema("column string, statistic string, value double").json(path)


@query("a5_append_sink", f"SELECT outcome, COUNT(*) AS n FROM ({LOG_SQL}) GROUP BY 1")
def _(c):
    path = new_table_path(c.spark, "log")
    improved = F.col("outcome") == "F"
    files.append(log(c).where(improved), path)
    files.append(log(c).where(~improved), path)
    whole = c.spark.read.parquet(path)
    return whole.groupBy("outcome").agg(F.count("*").alias("n"))


@query(
    "a6_keyed_upsert",
    """SELECT vec_id, CASE WHEN vec_id % 3 = 0 THEN label + 100 ELSE label END AS label, CASE WHEN vec_id % 3 = 0 THEN 2 ELSE 1 END AS version FROM embeddings
       UNION ALL SELECT vec_id + 1000000, label, 2 FROM embeddings WHERE vec_id % 7 = 0""",
)
def _(c):
    current = c.raw("embeddings").select("vec_id", "label", F.lit(1).alias("version"))
    changed = current.where(F.col("vec_id") % 3 == 0).select("vec_id", (F.col("label") + 100).alias("label"), F.lit(2).alias("version"))
    new = current.where(F.col("vec_id") % 7 == 0).select((F.col("vec_id") + 1000000).alias("vec_id"), "label", F.lit(2).alias("version"))
    return files.upsert(current, changed.unionByName(new), ["vec_id"], "version")


@query(
    "a6_bucketed_upsert",
    """SELECT vec_id, CASE WHEN vec_id % 3 = 0 THEN label + 100 ELSE label END AS label, CASE WHEN vec_id % 3 = 0 THEN 2 ELSE 1 END AS version FROM embeddings
       UNION ALL SELECT vec_id + 1000000, label, 2 FROM embeddings WHERE vec_id % 7 = 0""",
)
def _(c):
    current = c.raw("embeddings").select("vec_id", "label", F.lit(1).alias("version"))
    changed = current.where(F.col("vec_id") % 3 == 0).select("vec_id", (F.col("label") + 100).alias("label"), F.lit(2).alias("version"))
    new = current.where(F.col("vec_id") % 7 == 0).select((F.col("vec_id") + 1000000).alias("vec_id"), "label", F.lit(2).alias("version"))
    table = files.BucketedTable(new_table_path(c.spark, "vectors"), ["vec_id"], "version", 8)
    table.create(current)
    table.upsert(changed.unionByName(new))
    return table.read(c.spark).select("vec_id", "label", "version")


@query(
    "w1_streamed_weeks",
    f"""SELECT user_id AS student_id, TIME_BUCKET(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01') AS week_start, {", ".join(f"COUNT(CASE WHEN event_type = '{kind}' THEN 1 END) AS {name}" for name, kind in weekly.COUNTS.items())},
        COUNT(*) AS total_actions FROM events GROUP BY 1, 2""",
)
def _(c):
    table = weekly.new_table(c.spark, new_table_path(c.spark, "weeks"))
    weekly.keep_weekly(weekly.read_events(c.spark, f"{c.folder}/event[s].parquet"), table, new_table_path(c.spark, "weeks-state"))
    return table.read(c.spark).drop("version")


@query("a7_vendor_names", """SELECT c_custkey AS "SPR_CODE", c_mktsegment AS "SPR_ETN" FROM customer""")
def _(c):
    names = mapping.to_vendor("students", "sits")
    return c.students.select(*[F.col(x).alias(names[x]) for x in ("student_id", "ethnicity")])


@query(
    "a8_inverse_names",
    """SELECT p_partkey AS course_id, CAST(3.5 + (p_size % 14) / 10.0 AS DOUBLE) AS satisfaction_score FROM part""",
    ["satisfaction_score"],
)
def _(c):
    vendor = mapping.rename_to_vendor(c.courses, "courses", "tribal")
    names = mapping.from_vendor("courses", "tribal")
    return vendor.select(*[F.col(v).alias(names[v]) for v in ("COURSE_ID", "NSS_SCORE")])


@query("a9_rename_from_vendor", "SELECT student_id, qualification_type, ucas_tariff_points, predicted_grade FROM qualifications")
def _(c):
    vendor = c.qualifications.toDF("SCH_CODE", "SCH_QUAL", "SCH_UCAS", "SCH_PRED")
    return mapping.rename_from_vendor(vendor, "qualifications", "sits")


@query(
    "a10_rename_to_vendor",
    """SELECT student_id AS "STUDENT_ID", course_id AS "COURSE_ID", enrollment_date AS "START_DATE", enrollment_status AS "STATUS",
       retained_year2 AS "YEAR2_RETAINED", final_classification AS "CLASSIFICATION", academic_year AS "ACADEMIC_YEAR" FROM enrollments""",
)
def _(c):
    return mapping.rename_to_vendor(c.enrollments, "enrollments", "tribal")


@query("a11_feature_registry", f"""SELECT feature_group, name, kind, cardinality FROM ({registry_sql()}) WHERE feature_group IN ('qualifications', 'demographics')""")
def _(c):
    described = registry.describe(student_features(c.students, c.qualifications), GROUPS, "student_id")
    names = [n for group in ("qualifications", "demographics") for n in described.names(group)]
    return described.table(c.spark).where(F.col("name").isin(names)).select("feature_group", "name", "kind", "cardinality")
