"""Projection, casts and filters over the stand-in views."""

import datetime as dt

from pyspark.sql import functions as F

from checks.registry import query
from checks.queries_scalars import ANNUAL, END, JOB_KEY, PAY_KEY, START
from paygrain.functions import columns, scalars
from paygrain.operators import payroll, postings
from paygrain.sources.schemas import RAW_PAYROLL

PAY, JOBS, FACTS, DURATIONS = ["fx_payroll"], ["fx_jobs"], ["fx_fact_jobs"], ["fx_fact_durations"]
AS_OF = dt.datetime(1998, 7, 1, 12)

PAYROLL_SQL = f"""
WITH stats AS (SELECT agency_name, title_description, min(base_salary) AS salary_min,
                      max(base_salary) AS salary_max, count(base_salary) AS employee_count_in_role
               FROM fx_payroll GROUP BY 1, 2)
SELECT agency_name, title_description, base_salary, pay_basis, regular_hours, regular_gross_paid,
       ot_hours, total_ot_paid, total_other_pay, {ANNUAL} AS annual_salary_standardized, salary_min,
       salary_max, salary_max - salary_min AS salary_range_width, employee_count_in_role,
       {PAY_KEY} AS fuzzy_match_string
FROM fx_payroll LEFT JOIN stats USING (agency_name, title_description)"""
POSTINGS_SQL = f"""
SELECT job_id, agency, posting_type, number_of_positions, business_title, career_level,
       salary_range_from, salary_range_to, posting_date,
       CAST(trunc(epoch({END} - {START}) / 86400) AS INT) AS posting_duration_days,
       {JOB_KEY} AS fuzzy_match_string
FROM fx_jobs WHERE year({START}) IN (1997, 1998)"""
POSTING_COLUMNS = ["job_id", "agency", "posting_type", "number_of_positions", "business_title",
                   "career_level", "salary_range_from", "salary_range_to", "posting_date",
                   "posting_duration_days", "fuzzy_match_string"]


@query("P1_select_available", """
SELECT agency_name, title_description, base_salary, pay_basis, regular_hours, regular_gross_paid,
       ot_hours, total_ot_paid, total_other_pay FROM fx_payroll""", PAY)
def _(fx):
    return columns.select_available(fx.payroll, [*RAW_PAYROLL, "not_there"])[0]


@query("P2_final_projection_payroll", PAYROLL_SQL, PAY)
def _(fx):
    return payroll.build_payroll(fx.payroll)


@query("P3_final_projection_postings", POSTINGS_SQL, JOBS)
def _(fx):
    df = postings.build_postings(fx.jobs, None, (1997, 1998))
    return df.select(POSTING_COLUMNS)


@query("P4_standardize_columns", """
SELECT job_title AS lighthouse_job_title, total_postings AS lighthouse_total_postings,
       median_posting_duration AS lighthouse_median_posting_duration,
       median_salary AS lighthouse_median_salary, top_skills AS lighthouse_top_skills,
       education_requirements AS lighthouse_education_requirements,
       experience_level AS lighthouse_extra_column FROM fx_benchmark""", ["fx_benchmark"])
def _(fx):
    raw = fx.benchmark.toDF(
        "Job Title", "postings", "Posting-Duration", "Median Salary", "skills", "Education",
        "Extra Column!",
    )
    return columns.standardize_columns(raw)


@query("P5_cast_by_name_pattern", """
SELECT job_title AS lighthouse_job_title, CAST(total_postings AS INT) AS lighthouse_total_postings,
       median_posting_duration AS lighthouse_median_posting_duration,
       median_salary AS lighthouse_median_salary, CASE WHEN length(job_title) % 2 = 0
       THEN CAST('2024-05-06 07:08:09' AS TIMESTAMP) END AS lighthouse_listed_date FROM fx_benchmark""", ["fx_benchmark"])
def _(fx):
    # A year or a bare date is no timestamp.
    even, three = F.length("job_title") % 2 == 0, F.length("job_title") % 3 == 0
    raw = fx.benchmark.select(
        F.when(even, "2024-05-06T07:08:09.000").when(three, "2024").otherwise("2024-05-06").alias("lighthouse_listed_date"),
        F.col("job_title").alias("lighthouse_job_title"),
        F.concat(F.col("total_postings").cast("string"), F.lit(".0")).alias("lighthouse_total_postings"),
        F.col("median_posting_duration").cast("string").alias("lighthouse_median_posting_duration"),
        F.col("median_salary").cast("string").alias("lighthouse_median_salary"),
    )
    return columns.cast_by_name_pattern(raw)


MIXED = "CASE WHEN pay_basis = 'per Day' THEN concat('n/a ', pay_basis) ELSE CAST({0} AS VARCHAR) END"


@query("P6_lenient_numeric", f"""
SELECT payroll_number, TRY_CAST({MIXED.format("regular_hours")} AS DOUBLE) AS hours
FROM fx_payroll""", PAY)
def _(fx):
    words = F.concat(F.lit("n/a "), "pay_basis")
    mixed = F.when(F.col("pay_basis") == "per Day", words).otherwise(F.col("regular_hours").cast("string"))
    return fx.payroll.select("payroll_number", columns.lenient_numeric(mixed).alias("hours"))


@query("P7_lenient_timestamp", f"""
SELECT job_id, {START} AS posted, CAST(process_date AS TIMESTAMP) AS processed,
       CAST(NULL AS TIMESTAMP) AS bad FROM fx_jobs""", JOBS)
def _(fx):
    return fx.jobs.select(
        "job_id",
        columns.lenient_timestamp(F.col("posting_date")).alias("posted"),
        columns.lenient_timestamp(F.col("process_date")).alias("processed"),
        columns.lenient_timestamp(F.substring("posting_date", 1, 10)).alias("bad"),
    )


@query("P8_typed_null_columns", """
SELECT job_id, CAST(NULL AS VARCHAR) AS best_payroll_match, CAST(NULL AS DOUBLE) AS best_match_score,
       CAST(NULL AS DOUBLE) AS payroll_salary_min, CAST(NULL AS DOUBLE) AS payroll_salary_max
FROM fx_jobs""", JOBS)
def _(fx):
    return postings.match_payroll(fx.jobs.select("job_id"), None)


@query("P9_safe_cast", """
SELECT payroll_number, CAST(base_salary AS VARCHAR) IS NOT NULL AS is_text,
       TRY_CAST(agency_name AS DOUBLE) AS not_a_number FROM fx_payroll""", PAY)
def _(fx):
    return fx.payroll.select(
        "payroll_number",
        columns.safe_cast(F.col("base_salary"), "string").isNotNull().alias("is_text"),
        columns.safe_cast(F.col("agency_name"), "double").alias("not_a_number"),
    )


@query("P10_strict_cast", """
SELECT payroll_number, CAST(payroll_number AS BIGINT) AS number, CAST(fiscal_year AS INT) AS fiscal_year
FROM fx_payroll""", PAY)
def _(fx):
    return fx.payroll.select(
        "payroll_number",
        columns.strict_cast(F.col("payroll_number"), "bigint").alias("number"),
        columns.strict_cast(F.col("fiscal_year"), "int").alias("fiscal_year"),
    )


@query("P11_rename", """
SELECT job_id, agency AS agency_name, career_level FROM fx_jobs""", JOBS)
def _(fx):
    names = {"agency": "agency_name", "full_time_part_time_indicator": "employment_type"}
    return columns.rename(fx.jobs.select("job_id", "agency", "career_level"), names)


@query("P12_load_stamps", """
SELECT job_id, TIMESTAMP '1998-07-01 12:00:00' AS dbt_loaded_at, DATE '1998-07-01' AS dbt_valid_from
FROM fx_jobs""", JOBS)
def _(fx):
    return columns.load_stamps(fx.jobs.select("job_id"), AS_OF)


@query("F1_filter_years", f"""
SELECT job_id, {START} AS posting_start FROM fx_jobs WHERE year({START}) IN (1997, 1999)""", JOBS)
def _(fx):
    df = postings.with_posting_dates(fx.jobs).select("job_id", "posting_start")
    return columns.filter_years(df, "posting_start", (1997, 1999))


@query("F2_require_not_null", """
SELECT job_id, agency, business_title FROM fx_fact_jobs
WHERE agency IS NOT NULL AND business_title IS NOT NULL""", FACTS)
def _(fx):
    df = fx.fact_jobs.select("job_id", "agency", "business_title")
    return columns.require_not_null(df, ["agency", "business_title"])


@query("F3_filter_date_range", f"""
SELECT job_id, {START} AS posting_start FROM fx_jobs
WHERE {START} >= TIMESTAMP '1997-01-01' AND {START} <= TIMESTAMP '1998-12-31'""", JOBS)
def _(fx):
    df = postings.with_posting_dates(fx.jobs).select("job_id", "posting_start")
    return columns.filter_date_range(df, "posting_start", "1997-01-01", "1998-12-31")


@query("F4_active_paid_only", """
SELECT payroll_number, base_salary FROM fx_payroll
WHERE leave_status_as_of_june_30 = 'ACTIVE' AND base_salary > 0""", PAY)
def _(fx):
    active = scalars.is_active(F.col("leave_status_as_of_june_30"))
    df = fx.payroll.withColumn("is_active_employee", active)
    return columns.active_paid_only(df).select("payroll_number", "base_salary")


@query("F5_benchmarks_for_year", """
SELECT payroll_number, fiscal_year FROM fx_payroll WHERE fiscal_year = 1998""", PAY)
def _(fx):
    return columns.benchmarks_for_year(fx.payroll, 1998).select("payroll_number", "fiscal_year")


@query("F6_high_quality_payroll_matches", """
SELECT job_id, best_match_score FROM fx_fact_jobs WHERE best_match_score >= 0.85
    AND payroll_salary_min IS NOT NULL AND payroll_salary_max IS NOT NULL""", FACTS)
def _(fx):
    return columns.high_quality_payroll_matches(fx.fact_jobs).select("job_id", "best_match_score")


@query("F7_benchmark_matches", """
SELECT job_id, lighthouse_match_score, lighthouse_match_score >= 0.8 AS high FROM fx_fact_durations
WHERE lighthouse_match_score >= 0.7""", DURATIONS)
def _(fx):
    score = F.col("lighthouse_match_score")
    return columns.benchmark_matches(fx.fact_durations).select("job_id", score, (score >= 0.8).alias("high"))


@query("F8_sign_rules", """
SELECT job_id, CASE WHEN d > 0 THEN d END AS positive, CASE WHEN d >= 0 THEN d END AS non_negative,
       CASE WHEN d >= 0 THEN d ELSE 0 END AS or_zero
FROM (SELECT job_id, CAST(posting_duration_days AS DOUBLE) AS d FROM fx_fact_jobs) j""", FACTS)
def _(fx):
    days = F.col("posting_duration_days").cast("double")
    return fx.fact_jobs.select(
        "job_id",
        columns.non_positive_to_null(days).alias("positive"),
        columns.negative_to_null(days).alias("non_negative"),
        columns.negative_to_zero(days).alias("or_zero"),
    )


@query("F9_rule_violations", """
SELECT job_id, posting_duration_days FROM fx_fact_jobs WHERE salary_range_from > salary_range_to
    OR posting_duration_days < 0 OR posting_duration_days > 365""", FACTS)
def _(fx):
    return columns.rule_violations(fx.fact_jobs).select("job_id", "posting_duration_days")


@query("F10_matched_only", """
SELECT job_id, best_match_score FROM fx_fact_jobs WHERE best_match_score IS NOT NULL""", FACTS)
def _(fx):
    return columns.matched_only(fx.fact_jobs).select("job_id", "best_match_score")
