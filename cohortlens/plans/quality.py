"""Data quality and drift (rows A12, K1–K7, L1–L7)."""

from pyspark.sql import functions as F

from cohortlens.operators import drift, quality
from cohortlens.plans.registry import query

RULES = [
    quality.SchemaRule(columns=["student_id", "mark", "missing_column"], families={"mark": "numeric"}, allow_missing=True),
    quality.NullRule(columns=["final_classification"], max_share=0.5),
    quality.NullRule(columns=["final_classification"], max_share=0.1, allow_nulls=True),
    quality.RangeRule(column="mark", minimum=10.0, maximum=90.0),
    quality.UniqueRule(columns=["student_id"]),
    quality.CardinalityRule(column="module_id", minimum=50, maximum=80),
]


def graded(c):
    names = c.enrollments.select("student_id", "final_classification")
    return c.assessments.join(names, "student_id", "left")


GRADED_SQL = "SELECT * FROM assessments LEFT JOIN (SELECT student_id, final_classification FROM enrollments) e USING (student_id)"


@query("k1_schema_check", """SELECT 1 AS rule_no, TRUE AS passed, 'Missing columns (allowed): missing_column' AS message
 UNION ALL SELECT 2, FALSE, 'Missing required columns: missing_column; Column gender has type string, expected numeric'""")
def _(c):
    rules = [
        quality.SchemaRule(columns=["student_id", "missing_column"], allow_missing=True),
        quality.SchemaRule(columns=["student_id", "missing_column"], families={"gender": "numeric"}),
    ]
    return quality.validate(c.students, rules).select("rule_no", "passed", "message")


@query(
    "k2_null_check",
    f"""SELECT CAST(AVG(CASE WHEN final_classification IS NULL THEN 1.0 ELSE 0.0 END) AS DOUBLE) AS null_share,
        AVG(CASE WHEN final_classification IS NULL THEN 1.0 ELSE 0.0 END) <= 0.5 AS passed FROM ({GRADED_SQL})""",
    ["null_share"],
)
def _(c):
    rule = RULES[1]
    df = graded(c)
    one = df.agg(*[m.alias(n) for n, m in rule.measures(df).items()])
    return one.select(F.col("null_final_classification").alias("null_share"), rule.verdict(df)[0].alias("passed"))


@query(
    "k3_range_check",
    """SELECT COUNT(CASE WHEN mark < 10 THEN 1 END) AS below, COUNT(CASE WHEN mark > 90 THEN 1 END) AS above FROM assessments""",
)
def _(c):
    rule = RULES[3]
    one = c.assessments.agg(*[m.alias(n) for n, m in rule.measures(c.assessments).items()])
    return one.select(F.col("below_mark").alias("below"), F.col("above_mark").alias("above"))


@query(
    "k4_uniqueness",
    """SELECT COUNT(*) - COUNT(DISTINCT final_classification) - MAX(CASE WHEN final_classification IS NULL THEN 1 ELSE 0 END) AS classes,
       COUNT(*) - COUNT(DISTINCT student_id) - MAX(CASE WHEN student_id IS NULL THEN 1 ELSE 0 END) AS students FROM enrollments""",
)
def _(c):
    return c.enrollments.agg(
        quality.repeated(F.col("final_classification")).alias("classes"),
        quality.repeated(F.col("student_id")).alias("students"),
    )


@query(
    "k5_cardinality",
    "SELECT COUNT(DISTINCT module_id) AS modules, COUNT(DISTINCT module_id) >= 50 AS passed FROM assessments",
)
def _(c):
    rule = RULES[5]
    one = c.assessments.agg(*[m.alias(n) for n, m in rule.measures(c.assessments).items()])
    return one.select(F.col("distinct_module_id").alias("modules"), rule.verdict(c.assessments)[0].alias("passed"))


REPORT_SQL = f"""WITH g AS ({GRADED_SQL}),
 m AS (SELECT AVG(CASE WHEN final_classification IS NULL THEN 1.0 ELSE 0.0 END) AS nu, COUNT(CASE WHEN mark < 10 THEN 1 END) AS lo,
  COUNT(CASE WHEN mark > 90 THEN 1 END) AS hi, COUNT(*) - COUNT(DISTINCT student_id) AS du, COUNT(DISTINCT module_id) AS ca FROM g)
 SELECT 1 AS rule_no, 'schema_validation' AS rule, 'error' AS severity, TRUE AS passed, 'Missing columns (allowed): missing_column' AS message FROM m
 UNION ALL SELECT 2, 'null_check', 'error', nu <= 0.5, CASE WHEN nu > 0.5 THEN 'Column final_classification has ' || PRINTF('%.1f', nu * 100) || '% nulls (max: 50.0%)' ELSE 'Null check passed' END FROM m
 UNION ALL SELECT 3, 'null_check', 'warning', TRUE, CASE WHEN nu > 0.1 THEN 'Column final_classification has ' || PRINTF('%.1f', nu * 100) || '% nulls (max: 10.0%)' ELSE 'Null check passed' END FROM m
 UNION ALL SELECT 4, 'range_check', 'warning', lo = 0 AND hi = 0, CASE WHEN lo = 0 AND hi = 0 THEN 'Range check passed' ELSE
   CONCAT_WS('; ', CASE WHEN lo > 0 THEN lo || ' values in mark below minimum 10.0' END, CASE WHEN hi > 0 THEN hi || ' values in mark above maximum 90.0' END) END FROM m
 UNION ALL SELECT 5, 'uniqueness_check', 'error', du = 0, CASE WHEN du > 0 THEN 'Column student_id has ' || du || ' duplicate values' ELSE 'Uniqueness check passed' END FROM m
 UNION ALL SELECT 6, 'cardinality_check', 'warning', ca >= 50, CASE WHEN ca < 50 THEN 'Column module_id has low cardinality (' || ca || ' < 50)'
   WHEN ca > 80 THEN 'Column module_id has high cardinality (' || ca || ' > 80)' ELSE 'Cardinality check passed' END FROM m"""


@query("k6_validator", REPORT_SQL)
def _(c):
    return quality.validate(graded(c), RULES).select("rule_no", "rule", "severity", "passed", "message")


@query(
    "k7_severity",
    f"SELECT severity, COUNT(*) AS rules, COUNT(CASE WHEN NOT passed THEN 1 END) AS failed FROM ({REPORT_SQL}) GROUP BY 1",
)
def _(c):
    results = quality.validate(graded(c), RULES)
    return results.groupBy("severity").agg(F.count("*").alias("rules"), F.count_if(~F.col("passed")).alias("failed"))


@query(
    "a12_validation_report",
    f"""SELECT COUNT(CASE WHEN passed THEN 1 END) AS rules_passed, COUNT(CASE WHEN NOT passed THEN 1 END) AS rules_failed,
        CASE WHEN COUNT(CASE WHEN NOT passed THEN 1 END) = 0 THEN 'passed' ELSE 'failed' END AS overall_status,
        AVG(CASE WHEN passed THEN 1.0 ELSE 0.0 END) AS validation_score FROM ({REPORT_SQL})""",
    ["validation_score"],
)
def _(c):
    return quality.summary(quality.validate(graded(c), RULES))


NUMBERS = ["l_quantity", "l_extendedprice", "l_discount"]
NAMES = ["l_returnflag", "l_linestatus"]
CUT = "1998-01-01"
#: All columns of the table.
ALL_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *NUMBERS, "l_tax"]
ALL_NAMES = [*NAMES, "l_shipdate"]


def halves(c, pick=(*NUMBERS, *NAMES)):
    lines = c.raw("lineitem")
    early = F.col("l_shipdate") < F.lit(CUT).cast("timestamp_ntz")
    return lines.where(early).select(*pick), lines.where(~early).select(*pick)


SIDES_SQL = f"""early AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '{CUT}'), late AS (SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '{CUT}')"""


def bin_sql(col, side):
    lo, hi = f"(SELECT MIN({col}) FROM early)", f"(SELECT MAX({col}) FROM early)"
    place = f"CAST(LEAST(FLOOR(({col} - {lo}) * (CAST(20 AS DOUBLE) / ({hi} - {lo}))), 19) AS INT)"
    return f"""SELECT '{col}' AS "column", CAST({place} AS VARCHAR) AS bin, COUNT(*) AS n FROM {side} WHERE {col} >= {lo} AND {col} <= {hi} GROUP BY 2"""


def name_sql(col, side):
    return f"""SELECT '{col}' AS "column", CAST({col} AS VARCHAR) AS bin, COUNT(*) AS n FROM {side} GROUP BY 2"""


def counts_sql(side, numbers=NUMBERS, names=NAMES):
    return " UNION ALL ".join([bin_sql(x, side) for x in numbers] + [name_sql(x, side) for x in names])


def grid_sql(numbers=NUMBERS):
    return " UNION ALL ".join(f"""SELECT '{x}' AS "column", CAST(b AS VARCHAR) AS bin FROM RANGE(20) t(b)""" for x in numbers)


@query(
    "l1_reference_profile",
    f"""WITH {SIDES_SQL}, c AS ({counts_sql('early')}), g AS ({grid_sql()}),
        f AS (SELECT "column", bin, COALESCE(n, 0) AS n FROM g FULL JOIN c USING ("column", bin))
        SELECT "column", bin, n / CAST(SUM(n) OVER (PARTITION BY "column") AS DOUBLE) AS share FROM f""",
    ["share"],
)
def _(c):
    return drift.reference_profile(halves(c)[0])


def divergence_sql(numbers=NUMBERS, names=NAMES):
    return f"""WITH {SIDES_SQL}, r AS ({counts_sql('early', numbers, names)}), g AS ({grid_sql(numbers)}), u AS ({counts_sql('late', numbers, names)}),
 rf AS (SELECT "column", bin, COALESCE(n, 0) AS r FROM g FULL JOIN r USING ("column", bin)),
 b AS (SELECT "column", bin, COALESCE(r, 0) AS r, COALESCE(n, 0) AS c FROM rf FULL JOIN u USING ("column", bin)),
 s AS (SELECT "column", r / CAST(SUM(r) OVER w AS DOUBLE) + 1e-6 AS p, c / CAST(SUM(c) OVER w AS DOUBLE) + 1e-6 AS q, COUNT(*) OVER w AS k FROM b WINDOW w AS (PARTITION BY "column")),
 d AS (SELECT "column", p / (1 + k * 1e-6) AS p, q / (1 + k * 1e-6) AS q FROM s),
 v AS (SELECT "column", SUM((q - p) * LN(q / p)) AS psi, SUM(q * LN(q / p)) AS kl FROM d GROUP BY 1)
 SELECT "column", psi, kl, CASE WHEN psi < 0.1 THEN 'No significant change' WHEN psi < 0.25 THEN 'Moderate change' ELSE 'Significant change' END AS interpretation,
  psi > 0.1 AS drift_detected FROM v"""


DIVERGENCE_SQL = divergence_sql()
quoted = lambda names: ", ".join(f"'{n}'" for n in names)


@query("l2_psi_numeric", f"""SELECT "column", psi FROM ({DIVERGENCE_SQL}) WHERE "column" IN ({quoted(NUMBERS)})""", ["psi"])
def _(c):
    early, late = halves(c)
    return drift.divergence(early.select(NUMBERS), late.select(NUMBERS)).select("column", "psi")


@query("l3_psi_categorical", f"""SELECT "column", psi FROM ({DIVERGENCE_SQL}) WHERE "column" IN ({quoted(NAMES)})""", ["psi"])
def _(c):
    early, late = halves(c)
    return drift.divergence(early.select(NAMES), late.select(NAMES)).select("column", "psi")


@query("l4_psi_banding", f"""SELECT "column", interpretation, drift_detected FROM ({DIVERGENCE_SQL})""")
def _(c):
    return drift.divergence(*halves(c)).select("column", "interpretation", "drift_detected")


@query("l5_kl_divergence", f"""SELECT "column", psi, kl FROM ({DIVERGENCE_SQL})""", ["psi", "kl"])
def _(c):
    return drift.divergence(*halves(c)).select("column", "psi", "kl")


def ks_sql(col):
    return f"""SELECT '{col}' AS "column", MAX(ABS(cr / CAST(nr AS DOUBLE) - cc / CAST(nc AS DOUBLE))) AS ks_statistic, MAX(nr) AS nr, MAX(nc) AS nc FROM
 (SELECT SUM(r) OVER (ORDER BY x) AS cr, SUM(c) OVER (ORDER BY x) AS cc, SUM(r) OVER () AS nr, SUM(c) OVER () AS nc FROM
  (SELECT {col} AS x, COUNT(CASE WHEN e THEN 1 END) AS r, COUNT(CASE WHEN NOT e THEN 1 END) AS c FROM
   (SELECT {col}, l_shipdate < TIMESTAMP '{CUT}' AS e FROM lineitem) GROUP BY 1))"""


def all_ks_sql(numbers=NUMBERS):
    return f"""WITH ks AS ({' UNION ALL '.join(ks_sql(x) for x in numbers)})
 SELECT "column", ks_statistic, CASE WHEN t2 < 0.04 THEN 1 ELSE LEAST(1, GREATEST(0, 2 * (SELECT SUM((CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END) * EXP(-2 * k * k * t2)) FROM RANGE(1, 101) t(k)))) END AS ks_p_value
 FROM (SELECT *, ks_statistic * ks_statistic * (nr * CAST(nc AS DOUBLE) / (nr + nc)) AS t2 FROM ks)"""


KS_SQL = all_ks_sql()


@query("l6_ks_test", KS_SQL, ["ks_statistic", "ks_p_value"])
def _(c):
    return drift.ks_test(*halves(c))


@query(
    "l7_drift_all_columns",
    f"""SELECT "column", psi, kl, interpretation, drift_detected, ks_statistic, ks_p_value FROM ({divergence_sql(ALL_NUMBERS, ALL_NAMES)}) d LEFT JOIN ({all_ks_sql(ALL_NUMBERS)}) k USING ("column")""",
    ["psi", "kl", "ks_statistic", "ks_p_value"],
)
def _(c):
    return drift.detect_drift(*halves(c, ["*"]))
