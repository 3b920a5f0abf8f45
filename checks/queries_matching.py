"""Joins, matches, staging tables, benchmarks and the mart."""

import datetime as dt

from pyspark.sql import functions as F

from checks.queries_columns import PAYROLL_SQL, POSTINGS_SQL
from checks.queries_scalars import ALNUM_KEY, GRAMS, SIMILARITY
from checks.ratio_sql import best_match
from checks.registry import dec, query, rounded
from paygrain.functions.columns import benchmarks_for_year
from paygrain.operators import benchmark, facts, marts, payroll, postings, reports
from paygrain.session import materialize

PAY, JOBS, BENCH = ["fx_payroll"], ["fx_jobs"], ["fx_benchmark"]
BOTH_FACTS = ["fx_fact_jobs", "fx_fact_durations"]
YEARS = (1997, 1998)
RULES = ((("%NATION_1", "%NATION_2"), "Joint Office"), (("%TION_3",), "Third Office"))
RULES_SQL = """CASE WHEN upper({0}) LIKE '%NATION_1' OR upper({0}) LIKE '%NATION_2' THEN 'Joint Office'
    WHEN upper({0}) LIKE '%TION_3' THEN 'Third Office' ELSE {0} END"""
STAMPS = ("dbt_loaded_at", "dbt_valid_from")

STG_JOBS = f"""SELECT job_id, agency AS agency_name, business_title, title_description,
    CAST(NULL AS VARCHAR) AS job_description,
    CASE WHEN salary_range_from > 0 THEN salary_range_from END AS salary_range_from,
    CASE WHEN salary_range_to > 0 THEN salary_range_to END AS salary_range_to,
    CAST(posting_date AS TIMESTAMP) AS posting_date,
    CAST(application_deadline AS TIMESTAMP) AS application_deadline,
    CAST(NULL AS VARCHAR) AS work_location, CAST(NULL AS VARCHAR) AS minimum_qual_requirements,
    CAST(NULL AS VARCHAR) AS preferred_skills, CAST(NULL AS VARCHAR) AS employment_type, career_level,
    (salary_range_from + salary_range_to) / 2 AS salary_midpoint,
    CAST(epoch(CAST(application_deadline AS TIMESTAMP) - CAST(posting_date AS TIMESTAMP)) / 86400 AS INT)
        AS posting_duration_days,
    {RULES_SQL.format("agency")} AS agency_name_standardized
FROM fx_jobs WHERE job_id IS NOT NULL"""
STG_PAY = f"""SELECT payroll_number, agency_name, title_description,
    CASE WHEN base_salary > 0 THEN base_salary END AS base_salary,
    CASE WHEN regular_hours >= 0 THEN regular_hours END AS regular_hours,
    CASE WHEN regular_gross_paid >= 0 THEN regular_gross_paid END AS regular_gross_paid,
    CASE WHEN total_ot_paid >= 0 THEN total_ot_paid ELSE 0 END AS total_ot_paid,
    CASE WHEN total_other_pay >= 0 THEN total_other_pay ELSE 0 END AS total_other_pay,
    leave_status_as_of_june_30 AS leave_status, fiscal_year,
    coalesce(base_salary, 0) + coalesce(total_ot_paid, 0) + coalesce(total_other_pay, 0)
        AS total_compensation,
    CASE WHEN regular_hours > 0 THEN base_salary / regular_hours END AS estimated_hourly_rate,
    {RULES_SQL.format("agency_name")} AS agency_name_standardized,
    upper(leave_status_as_of_june_30) IN ('ACTIVE', 'A') AS is_active_employee
FROM fx_payroll"""


def _d(expr: str, precision: int = 10, scale: int = 2) -> str:
    return f"TRY_CAST(CAST({expr} AS DECIMAL(24,6)) AS DECIMAL({precision},{scale}))"


STATS = f"""SELECT agency_name_standardized AS agency_name, title_description, fiscal_year,
    count(*) AS employee_count, min(base_salary) AS min_base_salary, max(base_salary) AS max_base_salary,
    {_d("avg(base_salary)")} AS avg_base_salary,
    {_d("quantile_cont(base_salary, 0.5)")} AS median_base_salary,
    {_d("quantile_cont(base_salary, 0.25)")} AS q1_base_salary,
    {_d("quantile_cont(base_salary, 0.75)")} AS q3_base_salary,
    {_d("avg(total_compensation)")} AS avg_total_compensation,
    min(total_compensation) AS min_total_compensation, max(total_compensation) AS max_total_compensation,
    {_d("stddev_samp(base_salary)")} AS salary_std_dev,
    {_d("stddev_samp(base_salary) / avg(base_salary)", 4, 3)} AS salary_coefficient_variation,
    {_d("avg(regular_hours)", 8, 2)} AS avg_regular_hours,
    {_d("avg(estimated_hourly_rate)", 8, 2)} AS avg_hourly_rate
FROM stg_pay WHERE is_active_employee AND base_salary > 0
GROUP BY 1, 2, 3 HAVING count(*) >= 3"""
BENCHMARKS = f"""SELECT *, CASE WHEN avg_base_salary < 40000 THEN 'Entry Level'
        WHEN avg_base_salary < 60000 THEN 'Mid Level' WHEN avg_base_salary < 80000 THEN 'Senior Level'
        WHEN avg_base_salary < 120000 THEN 'Manager Level' ELSE 'Executive Level' END AS salary_band,
    {_d("CAST(median_base_salary AS DOUBLE) * 0.8")} AS salary_range_lower,
    {_d("CAST(median_base_salary AS DOUBLE) * 1.2")} AS salary_range_upper,
    coalesce(salary_coefficient_variation > 0.20, FALSE) AS is_high_variance_position
FROM stats"""
# Postings carry the business title here, so that equal, similar and unrelated titles occur.
MATCHED = f"""jobs AS (SELECT * REPLACE (business_title AS title_description) FROM ({STG_JOBS}) s
    WHERE posting_date >= TIMESTAMP '1997-01-01' AND posting_date <= TIMESTAMP '1998-12-31'),
bench AS (SELECT * FROM benchmarks WHERE fiscal_year = 1998),
titles AS (SELECT a.title_description AS t, b.title_description AS u,
    {GRAMS.format("a.title_description")} AS g, {GRAMS.format("b.title_description")} AS h
    FROM (SELECT DISTINCT title_description FROM jobs) a,
         (SELECT DISTINCT title_description FROM bench) b),
near_titles AS (SELECT t, u, CASE WHEN t = u THEN CAST(1.0 AS FLOAT) ELSE {SIMILARITY.format("g", "h")} END
    AS ratio FROM titles),
partners AS (SELECT t, ratio, bench.* FROM bench JOIN near_titles ON u = title_description
    WHERE t = u OR ratio > CAST({{threshold}} AS DOUBLE)),
matched AS (SELECT j.*, p.min_base_salary AS payroll_min_salary, p.max_base_salary AS payroll_max_salary,
    p.median_base_salary AS payroll_median_salary, p.avg_base_salary AS payroll_avg_salary,
    p.employee_count AS payroll_employee_count, p.salary_band AS payroll_salary_band,
    p.is_high_variance_position, coalesce(p.ratio, CAST(0.0 AS FLOAT)) AS salary_match_ratio
    FROM jobs j LEFT JOIN partners p
        ON j.agency_name_standardized = p.agency_name AND j.title_description = p.t)"""
MODELS = f"WITH stg_pay AS ({STG_PAY}),\nstats AS ({STATS}),\nbenchmarks AS ({BENCHMARKS})"


def _staged_jobs(fx):
    raw = fx.jobs.withColumn("title_description", F.col("business_title"))
    return marts.stg_job_postings(raw, RULES)


def _staged_pay(fx):
    return marts.stg_payroll_data(fx.payroll, RULES)


# ---- joins ----------------------------------------------------------------------------------


@query("J1_attach_group_stats", """
WITH stats AS (SELECT agency_name, title_description, min(base_salary) AS salary_min,
    max(base_salary) AS salary_max, count(base_salary) AS employee_count_in_role
    FROM fx_payroll GROUP BY 1, 2)
SELECT payroll_number, base_salary, salary_min, salary_max, employee_count_in_role
FROM fx_payroll LEFT JOIN stats USING (agency_name, title_description)""", PAY)
def _(fx):
    df = payroll.standardize_annual_salary(fx.payroll)
    return payroll.attach_group_stats(df, payroll.role_salary_range(df)).select(
        "payroll_number", "base_salary", "salary_min", "salary_max", "employee_count_in_role"
    )


LOOKUP = f"""pay AS (SELECT * FROM ({PAYROLL_SQL}) p),
lookup AS (SELECT fuzzy_match_string AS key, {dec("avg(salary_min)")} AS payroll_salary_min,
    {dec("avg(salary_max)")} AS payroll_salary_max FROM pay
    WHERE fuzzy_match_string <> '' AND salary_min IS NOT NULL AND salary_max IS NOT NULL GROUP BY 1)"""
JOBS_PROCESSED = f"""{LOOKUP}, prepared AS MATERIALIZED ({POSTINGS_SQL}),
keys AS MATERIALIZED (SELECT DISTINCT fuzzy_match_string AS key FROM prepared),
{best_match("keys", "lookup", 0.85)},
jobs_processed AS MATERIALIZED (SELECT p.*, b.match AS best_payroll_match, b.score AS best_match_score,
    l.payroll_salary_min, l.payroll_salary_max
    FROM prepared p LEFT JOIN best b ON p.fuzzy_match_string = b.key LEFT JOIN lookup l ON b.match = l.key)"""
MATCH_COLUMNS = ["best_payroll_match", "best_match_score", "payroll_salary_min", "payroll_salary_max"]
MATCH_SCALES = {"payroll_salary_min": 2, "payroll_salary_max": 2}


@query("J2_best_fuzzy_match", f"""
WITH RECURSIVE {JOBS_PROCESSED}
SELECT job_id, fuzzy_match_string, {", ".join(MATCH_COLUMNS)} FROM jobs_processed""", ["fx_payroll", "fx_jobs"])
def _(fx):
    df = postings.prepare_postings(fx.jobs, YEARS).select("job_id", "fuzzy_match_string")
    matched = postings.match_payroll(df, payroll.build_payroll(fx.payroll))
    return rounded(matched.select("job_id", "fuzzy_match_string", *MATCH_COLUMNS), **MATCH_SCALES)


ORDERED_PAY = PAYROLL_SQL.replace("SELECT agency_name, title_description, base_salary,",
                                  "SELECT payroll_number, agency_name, title_description, base_salary,")


@query("J2_best_fuzzy_match_by_first_row", f"""
WITH RECURSIVE lookup AS MATERIALIZED (SELECT fuzzy_match_string AS key, min(CAST(payroll_number AS BIGINT)) AS ord
    FROM ({ORDERED_PAY}) p WHERE fuzzy_match_string <> '' AND salary_min IS NOT NULL GROUP BY 1),
prepared AS MATERIALIZED ({POSTINGS_SQL}),
keys AS MATERIALIZED (SELECT DISTINCT fuzzy_match_string AS key FROM prepared),
{best_match("keys", "lookup", 0.85, ordered=True)}
SELECT job_id, match AS best_payroll_match, score AS best_match_score
FROM prepared p LEFT JOIN best b ON p.fuzzy_match_string = b.key""", ["fx_payroll", "fx_jobs"])
def _(fx):
    pay = fx.payroll.withColumn("ord", F.col("payroll_number").cast("bigint"))
    df = postings.prepare_postings(fx.jobs, YEARS).select("job_id", "fuzzy_match_string")
    matched = postings.match_payroll(df, payroll.build_payroll(pay))
    return matched.select("job_id", "best_payroll_match", "best_match_score")


TITLE_MATCH = f"""title_keys AS MATERIALIZED (SELECT DISTINCT {ALNUM_KEY.format("business_title")} AS key
    FROM prepared),
titles AS MATERIALIZED (SELECT {ALNUM_KEY.format("job_title")} AS key, job_title,
    median_posting_duration, CAST(total_postings AS INT) AS total_postings, median_salary, top_skills,
    education_requirements, experience_level FROM fx_benchmark),
{best_match("title_keys", "titles", 0.7)},
matched AS (SELECT p.*, b.score, t.*, posting_duration_days - median_posting_duration AS days_over
    FROM prepared p LEFT JOIN best b ON {ALNUM_KEY.format("p.business_title")} = b.key
    LEFT JOIN titles t ON b.match = t.key)"""
TITLE_COLUMNS = """job_title AS lighthouse_match_title, score AS lighthouse_match_score,
    median_posting_duration AS lighthouse_median_posting_duration,
    total_postings AS lighthouse_total_postings, median_salary AS lighthouse_median_salary,
    top_skills AS lighthouse_top_skills, education_requirements AS lighthouse_education_requirements,
    experience_level AS lighthouse_experience_level,
    CASE WHEN score IS NULL THEN NULL WHEN median_salary < 40000 THEN 'Low'
         WHEN median_salary < 70000 THEN 'Medium' WHEN median_salary < 100000 THEN 'High'
         ELSE 'Very High' END AS lighthouse_salary_category,
    total_postings / median_posting_duration AS lighthouse_posting_intensity,
    days_over AS duration_variance,
    CASE WHEN median_posting_duration > 0 THEN days_over / median_posting_duration * 100 END
        AS duration_variance_pct"""


@query("J3_best_title_match", f"""
WITH RECURSIVE prepared AS MATERIALIZED ({POSTINGS_SQL}), {TITLE_MATCH}
SELECT job_id, business_title, posting_duration_days, {TITLE_COLUMNS} FROM matched""", ["fx_jobs", "fx_benchmark"])
def _(fx):
    df = postings.prepare_postings(fx.jobs, YEARS).select(
        "job_id", "business_title", "posting_duration_days"
    )
    return benchmark.match_benchmark(df, benchmark.build_benchmark(fx.benchmark))


@query("J3_best_title_match_by_first_row", f"""
WITH RECURSIVE prepared AS MATERIALIZED ({POSTINGS_SQL}),
title_keys AS MATERIALIZED (SELECT DISTINCT {ALNUM_KEY.format("business_title")} AS key FROM prepared),
titles AS MATERIALIZED (SELECT {ALNUM_KEY.format("job_title")} AS key, job_title, reverse(job_title) AS ord FROM fx_benchmark),
{best_match("title_keys", "titles", 0.7, ordered=True)}
SELECT job_id, job_title AS lighthouse_match_title, score AS lighthouse_match_score
FROM prepared p LEFT JOIN best b ON {ALNUM_KEY.format("p.business_title")} = b.key
LEFT JOIN titles t ON b.match = t.key""", ["fx_jobs", "fx_benchmark"])
def _(fx):
    bench = benchmark.build_benchmark(fx.benchmark.withColumn("position", F.reverse("job_title")))
    df = postings.prepare_postings(fx.jobs, YEARS).select("job_id", "business_title", "posting_duration_days")
    matched = benchmark.match_benchmark(df, bench, order="lighthouse_position")
    return matched.select("job_id", "lighthouse_match_title", "lighthouse_match_score")


def _matched(threshold: float) -> str:
    return MATCHED.replace("{threshold}", str(threshold))


J4_COLUMNS = ["job_id", "agency_name_standardized", "title_description", "payroll_median_salary",
              "payroll_employee_count", "payroll_salary_band", "salary_match_ratio"]


def _partners(fx, threshold: float):
    from paygrain.functions.columns import filter_date_range

    df = marts.benchmark_match(
        filter_date_range(_staged_jobs(fx), "posting_date", "1997-01-01", "1998-12-31"),
        benchmarks_for_year(marts.int_salary_benchmarks(_staged_pay(fx)), 1998),
        threshold,
    )
    return df.select(J4_COLUMNS)


@query("J4_benchmark_match", f"""
{MODELS}, {_matched(0.85)} SELECT {", ".join(J4_COLUMNS)} FROM matched""", ["fx_payroll", "fx_jobs"])
def _(fx):
    return _partners(fx, 0.85)


@query("J4_benchmark_match_several_partners", f"""
{MODELS}, {_matched(0.4)} SELECT {", ".join(J4_COLUMNS)} FROM matched""", ["fx_payroll", "fx_jobs"])
def _(fx):
    return _partners(fx, 0.4)


@query("J5_posting_duration_join", """
SELECT d.job_id, d.actual_posting_duration_days, j.number_of_positions
FROM fx_fact_durations d JOIN fx_fact_jobs j ON d.job_id = j.job_id
WHERE d.lighthouse_match_score >= 0.7""", BOTH_FACTS)
def _(fx):
    columns = [F.col(c) for c in ("job_id", "agency", "business_title", "actual_posting_duration_days",
               "lighthouse_median_posting_duration", "duration_variance_pct", "lighthouse_match_score")]
    return reports.posting_duration_view(fx.fact_durations.select(columns), fx.fact_jobs).select(
        "job_id", "actual_posting_duration_days", "number_of_positions"
    )


@query("J6_orphans", """
SELECT d.job_id, d.actual_posting_duration_days FROM fx_fact_durations d
LEFT JOIN fx_fact_jobs j ON d.job_id = j.job_id WHERE j.job_id IS NULL""", BOTH_FACTS)
def _(fx):
    return reports.orphans(fx.fact_durations, fx.fact_jobs).select(
        "job_id", "actual_posting_duration_days"
    )


@query("J7_salary_lookup", f"""
WITH pay AS ({PAYROLL_SQL.replace("WITH stats AS", "SELECT * FROM (WITH stats AS")}) p)
SELECT fuzzy_match_string AS key, {dec("avg(salary_min)")} AS payroll_salary_min,
       {dec("avg(salary_max)")} AS payroll_salary_max FROM pay
WHERE fuzzy_match_string <> '' AND salary_min IS NOT NULL AND salary_max IS NOT NULL
GROUP BY 1""", PAY)
def _(fx):
    lookup = payroll.salary_lookup(payroll.build_payroll(fx.payroll)).drop("ord")
    return rounded(lookup, payroll_salary_min=2, payroll_salary_max=2)


@query("J8_title_lookup", f"""
SELECT {ALNUM_KEY.format("title")} AS key, min(p_partkey) AS ord,
       arg_max(title, p_partkey) AS lighthouse_match_title,
       arg_max(p_size, p_partkey) AS lighthouse_total_postings,
       arg_max(p_retailprice, p_partkey) AS lighthouse_median_salary
FROM (SELECT *, CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN upper(p_name)
             ELSE concat(' ', p_name, '!') END AS title FROM part) p GROUP BY 1""")
def _(fx):
    key = F.col("p_partkey")
    title = (
        F.when(key % 3 == 0, F.col("p_name"))
        .when(key % 3 == 1, F.upper("p_name"))
        .otherwise(F.concat(F.lit(" "), "p_name", F.lit("!")))
    )
    rows = fx.table("part").select(
        title.alias("lighthouse_job_title"),
        F.col("p_size").alias("lighthouse_total_postings"),
        F.col("p_retailprice").alias("lighthouse_median_salary"),
        "p_partkey",
    )
    return benchmark.title_lookup(rows, "p_partkey").select(
        "key", "ord", "lighthouse_match_title", "lighthouse_total_postings", "lighthouse_median_salary"
    )


# ---- processed tables -----------------------------------------------------------------------


@query("V1_payroll_processed", PAYROLL_SQL, PAY)
def _(fx):
    return payroll.build_payroll(fx.payroll)


POSTING_COLUMNS = ["job_id", "agency", "posting_type", "number_of_positions", "business_title",
                   "career_level", "salary_range_from", "salary_range_to", "posting_date",
                   "posting_duration_days", "fuzzy_match_string"]


@query("V2_jobs_processed", f"WITH RECURSIVE {JOBS_PROCESSED} SELECT * FROM jobs_processed", ["fx_payroll", "fx_jobs"])
def _(fx):
    df = postings.build_postings(fx.jobs, payroll.build_payroll(fx.payroll), YEARS)
    return rounded(df, **MATCH_SCALES)


@query("V3_benchmark_processed", """
SELECT job_title AS lighthouse_job_title, CAST(total_postings AS INT) AS lighthouse_total_postings,
       median_posting_duration AS lighthouse_median_posting_duration,
       median_salary AS lighthouse_median_salary, top_skills AS lighthouse_top_skills,
       education_requirements AS lighthouse_education_requirements,
       experience_level AS lighthouse_experience_level,
       total_postings / coalesce(median_posting_duration, 30) AS lighthouse_posting_intensity,
       CASE WHEN median_salary < 40000 THEN 'Low' WHEN median_salary < 70000 THEN 'Medium'
            WHEN median_salary < 100000 THEN 'High' ELSE 'Very High' END AS lighthouse_salary_category,
       replace(lower(job_title), ' ', '_') AS lighthouse_fuzzy_match_string
FROM fx_benchmark""", BENCH)
def _(fx):
    return benchmark.build_benchmark(fx.benchmark)


def _jobs_processed(fx):
    pay = payroll.build_payroll(fx.payroll)
    return materialize(postings.build_postings(fx.jobs, pay, YEARS), "jobs")


@query("V4_jobs_benchmark_matched", f"""
WITH RECURSIVE prepared AS MATERIALIZED ({POSTINGS_SQL}), {TITLE_MATCH}
SELECT {", ".join(POSTING_COLUMNS)}, {TITLE_COLUMNS} FROM matched""", ["fx_jobs", "fx_benchmark"])
def _(fx):
    matched = benchmark.match_benchmark(_jobs_processed(fx), benchmark.build_benchmark(fx.benchmark))
    return matched.drop(*MATCH_COLUMNS)


STAMP = dt.datetime(1999, 1, 1)
STAMPED = "TIMESTAMP '1999-01-01' AS created_at, TIMESTAMP '1999-01-01' AS updated_at"
FACT_COLUMNS = f"""job_id, agency, posting_type, CAST(number_of_positions AS INT) AS number_of_positions, business_title,
    CAST(NULL AS VARCHAR) AS civil_service_title, CAST(NULL AS VARCHAR) AS job_category,
    CAST(NULL AS VARCHAR) AS full_time_part_time_indicator, career_level,
    {_d("salary_range_from", 12)} AS salary_range_from, {_d("salary_range_to", 12)} AS salary_range_to,
    CAST(NULL AS VARCHAR) AS salary_frequency, CAST(NULL AS VARCHAR) AS work_location,
    CAST(posting_date AS TIMESTAMP) AS posting_date, posting_duration_days, fuzzy_match_string, best_payroll_match,
    {_d("best_match_score", 5, 4)} AS best_match_score, {_d("payroll_salary_min", 12)} AS payroll_salary_min,
    {_d("payroll_salary_max", 12)} AS payroll_salary_max, @stamps"""
FACT_POSTINGS_SQL = f"WITH RECURSIVE {JOBS_PROCESSED} SELECT {FACT_COLUMNS} FROM jobs_processed"
FACT_DURATION_SQL = f"""
WITH RECURSIVE prepared AS MATERIALIZED ({POSTINGS_SQL}), {TITLE_MATCH},
wide AS (SELECT job_id, agency, business_title, posting_duration_days, {TITLE_COLUMNS} FROM matched),
fact AS (SELECT job_id, agency, business_title, posting_duration_days AS actual_posting_duration_days,
    {_d("lighthouse_median_posting_duration", 8, 2)} AS lighthouse_median_posting_duration,
    {_d("duration_variance", 8, 2)} AS duration_variance,
    {_d("duration_variance_pct", 8, 2)} AS duration_variance_pct, lighthouse_match_title,
    {_d("lighthouse_match_score", 5, 4)} AS lighthouse_match_score, lighthouse_total_postings,
    {_d("lighthouse_median_salary", 12, 2)} AS lighthouse_median_salary, lighthouse_top_skills,
    lighthouse_education_requirements, lighthouse_experience_level, lighthouse_salary_category,
    {_d("lighthouse_posting_intensity", 8, 4)} AS lighthouse_posting_intensity FROM wide)
SELECT @ids *, @stamps FROM fact"""
DENSE = "row_number() OVER (ORDER BY job_id) AS duration_analysis_id,"


def fact_duration_sql(ids: str, stamps: str) -> str:
    return FACT_DURATION_SQL.replace("@ids", ids).replace("@stamps", stamps)


@query("V5_fact_job_postings", FACT_POSTINGS_SQL.replace("@stamps", STAMPED), ["fx_payroll", "fx_jobs"])
def _(fx):
    return facts.conform_postings(_jobs_processed(fx), as_of=STAMP, check_widths=True)


@query("V5_fact_posting_duration", fact_duration_sql("", STAMPED), ["fx_jobs", "fx_benchmark"])
def _(fx):
    matched = benchmark.match_benchmark(_jobs_processed(fx), benchmark.build_benchmark(fx.benchmark))
    return facts.conform_duration(matched, with_id=False, as_of=STAMP)


@query("S11_dense_ids", fact_duration_sql(DENSE, STAMPED), ["fx_jobs", "fx_benchmark"])
def _(fx):
    matched = benchmark.match_benchmark(_jobs_processed(fx), benchmark.build_benchmark(fx.benchmark))
    return facts.conform_duration(matched.repartition(7), as_of=STAMP)


@query("V6_high_quality_payroll_matches", """
SELECT job_id, agency, business_title, salary_range_from, salary_range_to, payroll_salary_min,
       payroll_salary_max, best_match_score, posting_duration_days FROM fx_fact_jobs
WHERE best_match_score >= 0.85 AND payroll_salary_min IS NOT NULL
    AND payroll_salary_max IS NOT NULL""", ["fx_fact_jobs"])
def _(fx):
    return reports.high_quality_payroll_view(fx.fact_jobs)


@query("V7_posting_duration_analysis", """
SELECT d.job_id, d.agency, d.business_title, d.actual_posting_duration_days,
       d.lighthouse_median_posting_duration, d.duration_variance_pct, d.lighthouse_match_score,
       j.salary_range_from, j.salary_range_to, j.number_of_positions
FROM fx_fact_durations d JOIN fx_fact_jobs j ON d.job_id = j.job_id
WHERE d.lighthouse_match_score >= 0.7""", BOTH_FACTS)
def _(fx):
    return reports.posting_duration_view(fx.fact_durations, fx.fact_jobs)


@query("V9_stg_job_postings", STG_JOBS, JOBS)
def _(fx):
    return marts.stg_job_postings(fx.jobs, RULES).drop(*STAMPS)


@query("V10_stg_payroll_data", STG_PAY, PAY)
def _(fx):
    return _staged_pay(fx).drop(*STAMPS)


@query("V11_int_salary_benchmarks", f"{MODELS} SELECT * FROM benchmarks", PAY)
def _(fx):
    return marts.int_salary_benchmarks(_staged_pay(fx))


MART = """SELECT job_id, agency_name, agency_name_standardized, business_title, title_description,
    posting_date, application_deadline, posting_duration_days, work_location, employment_type,
    career_level, salary_range_from AS posted_salary_min, salary_range_to AS posted_salary_max,
    salary_midpoint AS posted_salary_midpoint,
    CASE WHEN salary_match_ratio >= CAST(0.85 AS DOUBLE) THEN payroll_min_salary END
        AS benchmark_salary_min,
    CASE WHEN salary_match_ratio >= CAST(0.85 AS DOUBLE) THEN payroll_max_salary END
        AS benchmark_salary_max,
    CASE WHEN salary_match_ratio >= CAST(0.85 AS DOUBLE) THEN payroll_median_salary END
        AS benchmark_salary_median,
    CASE WHEN salary_match_ratio >= CAST(0.85 AS DOUBLE) THEN payroll_employee_count END
        AS benchmark_employee_count,
    salary_match_ratio, variance AS salary_variance_pct,
    salary_match_ratio >= CAST(0.85 AS DOUBLE) AS has_salary_benchmark,
    salary_range_from IS NOT NULL AND salary_range_to IS NOT NULL AS has_posted_salary,
    coalesce(posting_duration_days > 0, FALSE) AS has_valid_posting_period,
    coalesce(abs(variance) > 0.20, FALSE) AS is_salary_outlier,
    payroll_salary_band, is_high_variance_position
FROM (SELECT *, CASE WHEN salary_match_ratio >= CAST(0.85 AS DOUBLE)
    THEN (salary_midpoint - CAST(payroll_median_salary AS DOUBLE))
         / CAST(payroll_median_salary AS DOUBLE) END AS variance FROM matched) m"""


@query("V12_mart_job_posting_analysis", f"{MODELS}, {_matched(0.85)} {MART}", ["fx_payroll", "fx_jobs"])
def _(fx):
    return marts.mart_job_posting_analysis(
        _staged_jobs(fx),
        marts.int_salary_benchmarks(_staged_pay(fx)),
        1998,
        "1997-01-01",
        "1998-12-31",
    ).drop("analysis_timestamp")


BEST = """, ranked AS (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY salary_match_ratio DESC,
    payroll_employee_count DESC, payroll_min_salary) AS rank FROM matched)
SELECT job_id, salary_match_ratio, payroll_employee_count FROM ranked WHERE rank = 1"""


@query("V12_mart_best_partner", f"{MODELS}, {_matched(0.85)}{BEST}", ["fx_payroll", "fx_jobs"])
def _(fx):
    df = marts.mart_job_posting_analysis(
        _staged_jobs(fx),
        marts.int_salary_benchmarks(_staged_pay(fx)),
        1998,
        "1997-01-01",
        "1998-12-31",
        mode="best",
    )
    return df.select(
        "job_id",
        "salary_match_ratio",
        F.col("benchmark_employee_count").alias("payroll_employee_count"),
    )


@query("S11_conform_to_fact", f"""
WITH prepared AS MATERIALIZED ({POSTINGS_SQL}), unmatched AS (SELECT *, CAST(NULL AS VARCHAR) AS best_payroll_match,
    CAST(NULL AS DOUBLE) AS best_match_score, CAST(NULL AS DOUBLE) AS payroll_salary_min,
    CAST(NULL AS DOUBLE) AS payroll_salary_max FROM prepared)
SELECT {FACT_COLUMNS.replace("@stamps", STAMPED)} FROM unmatched""", JOBS)
def _(fx):
    df = postings.build_postings(fx.jobs, None, YEARS)
    return facts.conform_postings(df, as_of=STAMP, check_widths=True)
