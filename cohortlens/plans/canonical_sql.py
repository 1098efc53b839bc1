"""The canonical tables as SQL over the parquet tables (used by the oracle queries)."""

CTES: dict[str, str] = {
    "students": """
SELECT c_custkey AS student_id,
  CASE WHEN c_custkey % 20 = 0 THEN 'Other' WHEN c_custkey % 20 = 1 THEN 'Not disclosed'
       WHEN c_custkey % 20 < 11 THEN 'Male' ELSE 'Female' END AS gender,
  c_mktsegment AS ethnicity, DATE '1986-01-01' + CAST(c_custkey * 37 % 3600 AS INT) AS date_of_birth,
  CAST(1 + c_custkey % 10 AS INT) AS imd_decile, CAST(1 + c_nationkey % 5 AS INT) AS polar_quintile,
  CASE WHEN c_custkey % 50 = 0 THEN 1 ELSE 0 END AS care_leaver,
  CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END AS disability,
  CASE WHEN c_custkey % 9 < 4 THEN 1 ELSE 0 END AS first_generation_uni
FROM customer""",
    "qualifications": """
SELECT c_custkey AS student_id,
  CASE c_nationkey % 5 WHEN 0 THEN 'BTEC' WHEN 1 THEN 'Access to HE'
       WHEN 2 THEN 'International Baccalaureate' ELSE 'A-Level' END AS qualification_type,
  CAST(56 + FLOOR((c_acctbal + 1000.0) / 11000.0 * 112) AS INT) AS ucas_tariff_points,
  CASE WHEN c_custkey % 10 < 7 THEN 1 ELSE 0 END AS predicted_grade
FROM customer""",
    "courses": """
SELECT p_partkey AS course_id, p_name AS course_name, p_type AS department,
  CAST(80 + 8 * (p_size % 12) AS INT) AS entry_tariff,
  CASE WHEN p_partkey % 7 = 0 THEN 4 ELSE 3 END AS course_length_years,
  CAST(80 - p_size AS INT) AS exam_weight_pct, CAST(20 + p_size AS INT) AS coursework_weight_pct,
  CAST(0.70 + 0.28 * ((p_retailprice - 900.0) / 100.0) AS DOUBLE) AS employment_rate_15m,
  CAST(3.5 + (p_size % 14) / 10.0 AS DOUBLE) AS satisfaction_score,
  CASE WHEN p_partkey % 5 < 2 THEN 1 ELSE 0 END AS accredited
FROM part""",
    "enrollments": """
SELECT o_custkey AS student_id, o_orderkey % (SELECT COUNT(*) FROM part) AS course_id,
  CAST(o_orderdate AS DATE) AS enrollment_date,
  CASE WHEN o_orderstatus = 'F' THEN 'Completed'
       WHEN o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'Withdrawn'
       ELSE 'Active' END AS enrollment_status,
  CASE WHEN o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT','2-HIGH') THEN 0
       WHEN o_orderkey % 10 = 0 THEN 0 ELSE 1 END AS retained_year2,
  CASE WHEN o_orderstatus <> 'F' THEN NULL WHEN o_totalprice >= 400000 THEN 'First'
       WHEN o_totalprice >= 250000 THEN '2:1' WHEN o_totalprice >= 100000 THEN '2:2'
       WHEN o_totalprice >= 30000 THEN 'Third' ELSE 'Pass' END AS final_classification,
  CAST(EXTRACT(YEAR FROM o_orderdate) AS INT) AS academic_year
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
      FROM orders) t WHERE rn = 1""",
    "modules": """
SELECT s_suppkey AS module_id, s_suppkey % (SELECT COUNT(*) FROM part) AS course_id,
  CAST(1 + s_suppkey % 3 AS INT) AS year,
  CASE s_suppkey % 3 WHEN 0 THEN 10 WHEN 1 THEN 15 ELSE 20 END AS credits
FROM supplier""",
    "assessments": """
SELECT o_custkey AS student_id, l_suppkey AS module_id, l_quantity * 2.0 AS mark,
  CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 0 ELSE 1 END AS submitted,
  CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 1 ELSE 0 END AS late_submission,
  CASE WHEN l_linenumber >= 6 THEN 2 ELSE 1 END AS attempt
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "vle_engagement": """
SELECT user_id AS student_id, CAST(EXTRACT(DAY FROM ts) AS INT) AS week,
  COUNT(CASE WHEN event_type='view' THEN 1 END) AS logins,
  COUNT(CASE WHEN event_type='click' THEN 1 END) AS resources_accessed,
  COUNT(CASE WHEN event_type='signup' THEN 1 END) AS forum_posts,
  COUNT(CASE WHEN event_type='purchase' THEN 1 END) AS quiz_attempts,
  COUNT(CASE WHEN event_type='error' THEN 1 END) AS video_views, COUNT(*) AS total_actions
FROM events GROUP BY 1, 2""",
    "attendance": """
SELECT g.student_id, g.week, CASE WHEN e.total_actions >= 1 THEN 1 ELSE 0 END AS attended,
  CASE WHEN e.total_actions >= 1 THEN 'Present'
       WHEN (g.student_id + g.week) % 20 < 10 THEN 'Absent'
       WHEN (g.student_id + g.week) % 20 < 17 THEN 'Authorised Absence' ELSE 'Medical' END AS status
FROM (SELECT s.student_id, w.week
      FROM (SELECT DISTINCT user_id AS student_id FROM events) s
      CROSS JOIN (SELECT DISTINCT CAST(EXTRACT(DAY FROM ts) AS INT) AS week FROM events) w) g
LEFT JOIN vle_engagement e ON e.student_id = g.student_id AND e.week = g.week""",
    "interactions": """
SELECT o_custkey AS student_id, l_partkey AS course_id, COUNT(*) AS n_taken, AVG(l_quantity) AS rating
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""",
    "predictions": """
SELECT student_id, gender, ethnicity,
  CASE WHEN imd_decile <= 2 THEN 'low' WHEN imd_decile <= 7 THEN 'mid' ELSE 'high' END AS imd_band,
  CASE WHEN student_id % 5 < 2 THEN 1 ELSE 0 END AS y_true,
  CAST(((student_id * 7919) % 1000) AS DOUBLE) / 1000 * CAST(0.6 AS DOUBLE)
    + CAST(0.4 AS DOUBLE) * (CASE WHEN student_id % 5 < 2 THEN 1 ELSE 0 END) AS score,
  CASE WHEN CAST(((student_id * 7919) % 1000) AS DOUBLE) / 1000 * CAST(0.6 AS DOUBLE)
    + CAST(0.4 AS DOUBLE) * (CASE WHEN student_id % 5 < 2 THEN 1 ELSE 0 END) >= 0.5 THEN 1 ELSE 0 END AS y_pred,
  CAST(student_id % 5 AS INT) AS y,
  CAST(LEAST(4, GREATEST(0, student_id % 5 + student_id % 3 - 1)) AS INT) AS p
FROM students""",
}
