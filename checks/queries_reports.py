"""Aggregations, reports, top-k queries and quality checks."""

import datetime as dt

from pyspark.sql import functions as F

from checks.queries_scalars import END, START
from checks.registry import dec, query, rounded
from paygrain.functions.columns import rule_violations
from paygrain.plans import audit
from paygrain.operators import benchmark, marts, payroll, postings, quality, reports
from paygrain.sources import snapshots

PAY, JOBS, FACTS, DURATIONS = ["fx_payroll"], ["fx_jobs"], ["fx_fact_jobs"], ["fx_fact_durations"]
BOTH = ["fx_fact_jobs", "fx_fact_durations"]
RANGES = """stats AS (SELECT agency_name, title_description, min(base_salary) AS salary_min,
    max(base_salary) AS salary_max, max(base_salary) - min(base_salary) AS salary_range_width,
    count(base_salary) AS employee_count_in_role FROM fx_payroll GROUP BY 1, 2)"""


def _ranged(fx):
    return payroll.role_table(payroll.standardize_annual_salary(fx.payroll))


@query("A1_role_salary_range", f"""
WITH {RANGES} SELECT agency_name, title_description, salary_min, salary_max, employee_count_in_role
FROM stats""", PAY)
def _(fx):
    return payroll.role_salary_range(payroll.standardize_annual_salary(fx.payroll))


@query("A2_salary_benchmarks", f"""
SELECT agency_name, title_description, fiscal_year, count(*) AS employee_count,
       {dec("avg(base_salary)")} AS avg_base_salary,
       {dec("quantile_cont(base_salary, 0.5)")} AS median_base_salary,
       {dec("quantile_cont(base_salary, 0.25)")} AS q1_base_salary,
       {dec("quantile_cont(base_salary, 0.75)")} AS q3_base_salary,
       {dec("stddev_samp(base_salary)")} AS salary_std_dev
FROM fx_payroll WHERE leave_status_as_of_june_30 = 'ACTIVE' AND base_salary > 0
GROUP BY 1, 2, 3 HAVING count(*) >= 2""", PAY)
def _(fx):
    df = marts.salary_benchmarks(marts.stg_payroll_data(fx.payroll), min_count=2)
    names = ["avg_base_salary", "median_base_salary", "q1_base_salary", "q3_base_salary", "salary_std_dev"]
    return df.select(
        *marts.ROLE_YEAR, "employee_count", *[F.col(c).cast("decimal(18,2)").alias(c) for c in names]
    )


@query("A2_percentiles_of_hot_groups", f"""
SELECT pay_basis, count(*) AS n, {dec("quantile_cont(base_salary, 0.1)", 4)} AS p10,
       {dec("quantile_cont(base_salary, 0.5)", 4)} AS p50, {dec("quantile_cont(base_salary, 0.9)", 4)} AS p90
FROM fx_payroll GROUP BY pay_basis""", PAY)
def _(fx):
    from paygrain.operators.percentiles import agg_with_percentiles

    fractions = {"p10": ("base_salary", 0.1), "p50": ("base_salary", 0.5), "p90": ("base_salary", 0.9)}
    df = agg_with_percentiles(fx.payroll, ["pay_basis"], [F.count(F.lit(1)).alias("n")], fractions)
    return rounded(df, p10=4, p50=4, p90=4)


@query("A3_minimum_group_size", """
SELECT agency_name, title_description, fiscal_year, count(*) AS employee_count FROM fx_payroll
WHERE leave_status_as_of_june_30 = 'ACTIVE' AND base_salary > 0 GROUP BY 1, 2, 3
HAVING count(*) >= 10""", PAY)
def _(fx):
    df = marts.salary_benchmarks(marts.stg_payroll_data(fx.payroll), min_count=10)
    return df.select(*marts.ROLE_YEAR, "employee_count")


@query("A4_salary_range_stats", f"""
WITH {RANGES} SELECT {dec("avg(salary_min)")} AS avg_min_salary, {dec("avg(salary_max)")} AS avg_max_salary,
    {dec("avg(salary_range_width)")} AS avg_range_width,
    count(*) FILTER (WHERE salary_range_width > 0) AS positions_with_salary_range,
    {dec("avg(employee_count_in_role)")} AS avg_employees_per_role
FROM fx_payroll JOIN stats USING (agency_name, title_description)""", PAY)
def _(fx):
    return rounded(
        payroll.salary_range_stats(_ranged(fx)),
        avg_min_salary=2, avg_max_salary=2, avg_range_width=2, avg_employees_per_role=2,
    )


DAYS = f"CAST(trunc(epoch({END} - {START}) / 86400) AS INT)"


@query("A5_duration_stats", f"""
SELECT {dec("avg(d)", 4)} AS avg_duration, median(d) AS median_duration, min(d) AS min_duration,
       max(d) AS max_duration, count(*) FILTER (WHERE process_date IS NULL) AS null_process_dates
FROM (SELECT {DAYS} AS d, process_date FROM fx_jobs) j""", JOBS)
def _(fx):
    df = postings.with_posting_duration(postings.with_posting_dates(fx.jobs))
    return rounded(postings.duration_stats(df), avg_duration=4)


@query("A6_payroll_match_stats", f"""
SELECT {dec("avg(best_match_score)", 4)} AS avg_match_score, count(best_match_score) AS total_jobs,
       {dec("median(CAST(best_match_score AS DOUBLE))", 4)} AS median_match_score,
       count(best_match_score) AS high_quality_matches_85_plus, count(*) AS n_rows,
       count(payroll_salary_min) AS jobs_with_payroll_salary FROM fx_fact_jobs""", FACTS)
def _(fx):
    df = fx.fact_jobs.withColumn("best_match_score", F.col("best_match_score").cast("double"))
    return rounded(postings.payroll_match_stats(df), avg_match_score=4, median_match_score=4)


@query("A7_benchmark_match_stats", f"""
SELECT count(lighthouse_match_score) AS total_jobs, count(lighthouse_match_score) AS jobs_with_lighthouse_match,
       {dec("avg(lighthouse_match_score)", 4)} AS avg_match_score,
       {dec("median(CAST(lighthouse_match_score AS DOUBLE))", 4)} AS median_match_score,
       count(*) FILTER (WHERE lighthouse_match_score >= 0.8) AS high_quality_matches_80_plus,
       {dec("avg(duration_variance)", 4)} AS avg_duration_variance_days,
       {dec("avg(duration_variance_pct)", 4)} AS avg_duration_variance_pct, count(*) AS n_rows
FROM fx_fact_durations""", DURATIONS)
def _(fx):
    names = ("lighthouse_match_score", "duration_variance", "duration_variance_pct")
    df = fx.fact_durations.withColumns({c: F.col(c).cast("double") for c in names})
    return rounded(
        benchmark.benchmark_match_stats(df),
        avg_match_score=4, median_match_score=4, avg_duration_variance_days=4,
        avg_duration_variance_pct=4,
    )


COMPLETE = ", ".join(
    f"{dec(f'count({c}) / count(*) * 100', 4)} AS {n}_completeness_pct" for c, n in reports.COMPLETENESS.items()
)


@query("A8_completeness", f"""
SELECT count(*) AS total_records, {", ".join(f"count({c}) AS {n}_complete" for c, n in reports.COMPLETENESS.items())},
       {COMPLETE} FROM fx_fact_jobs""", FACTS)
def _(fx):
    scales = {f"{n}_completeness_pct": 4 for n in reports.COMPLETENESS.values()}
    return rounded(reports.completeness(fx.fact_jobs), **scales)


PAYROLL_QUALITY = f"""count(*) FILTER (WHERE best_match_score >= 0.85) AS high_quality_payroll_matches,
    count(*) FILTER (WHERE best_match_score >= 0.70) AS good_payroll_matches,
    count(*) FILTER (WHERE best_match_score IS NOT NULL AND payroll_salary_min IS NOT NULL)
        AS jobs_with_payroll_salary,
    {dec("coalesce(avg(best_match_score), 0)", 4)} AS avg_payroll_match_score"""
DURATION_QUALITY = f"""count(*) FILTER (WHERE lighthouse_match_score >= 0.80) AS high_quality_lighthouse_matches,
    count(*) FILTER (WHERE lighthouse_match_score >= 0.70) AS good_lighthouse_matches,
    {dec("coalesce(avg(lighthouse_match_score), 0)", 4)} AS avg_lighthouse_match_score,
    {dec("coalesce(avg(duration_variance_pct) FILTER (WHERE lighthouse_match_score IS NOT NULL), 0)", 4)}
        AS avg_duration_variance_pct"""
RULE_COUNTS = """count(*) FILTER (WHERE salary_range_from > salary_range_to OR posting_duration_days < 0
        OR posting_duration_days > 365) AS invalid_salary_ranges,
    count(*) FILTER (WHERE salary_range_from > salary_range_to) AS from_gt_to,
    count(*) FILTER (WHERE posting_duration_days < 0) AS negative_durations,
    count(*) FILTER (WHERE posting_duration_days > 365) AS excessive_durations"""


@query("A9_payroll_match_quality", f"""
SELECT count(best_match_score) AS total_jobs, {PAYROLL_QUALITY} FROM fx_fact_jobs""", FACTS)
def _(fx):
    return rounded(reports.payroll_match_quality(fx.fact_jobs), avg_payroll_match_score=4)


@query("A10_duration_match_quality", f"""
SELECT count(lighthouse_match_score) AS total_duration_records, {DURATION_QUALITY},
       min(duration_variance_pct) FILTER (WHERE lighthouse_match_score IS NOT NULL) AS min_duration_variance_pct,
       max(duration_variance_pct) FILTER (WHERE lighthouse_match_score IS NOT NULL) AS max_duration_variance_pct
FROM fx_fact_durations""", DURATIONS)
def _(fx):
    df = reports.duration_match_quality(fx.fact_durations)
    return rounded(df, avg_lighthouse_match_score=4, avg_duration_variance_pct=4)


ORPHANS = """SELECT count(*) AS orphaned_duration_records FROM fx_fact_durations d
LEFT JOIN fx_fact_jobs j ON d.job_id = j.job_id WHERE j.job_id IS NULL"""


@query("A11_orphan_count", ORPHANS, BOTH)
def _(fx):
    return reports.orphan_count(fx.fact_durations, fx.fact_jobs)


@query("A12_business_rule_counts", f"SELECT {RULE_COUNTS} FROM fx_fact_jobs", FACTS)
def _(fx):
    return reports.business_rule_counts(fx.fact_jobs)


@query("A13_row_counts", """
SELECT (SELECT count(*) FROM fx_fact_jobs) AS total_job_postings,
       (SELECT count(*) FROM fx_fact_durations) AS total_duration_records""", BOTH)
def _(fx):
    return reports.row_counts(fx.fact_jobs, fx.fact_durations)


SUMMARY = f"""
SELECT (SELECT count(*) FROM fx_fact_jobs) AS total_job_postings,
  (SELECT count(*) FROM fx_fact_jobs WHERE best_match_score >= 0.85) AS high_quality_payroll_matches,
  (SELECT {dec("avg(best_match_score)", 4)} FROM fx_fact_jobs) AS avg_payroll_match_score,
  (SELECT count(*) FROM fx_fact_durations) AS total_duration_records,
  (SELECT count(*) FROM fx_fact_durations WHERE lighthouse_match_score >= 0.7) AS good_lighthouse_matches,
  (SELECT {dec("avg(duration_variance_pct)", 4)} FROM fx_fact_durations) AS avg_duration_variance_pct,
  (SELECT count(DISTINCT agency) FROM fx_fact_jobs) AS unique_agencies,
  (SELECT count(DISTINCT business_title) FROM fx_fact_jobs) AS unique_job_titles"""


def _summary(fx):
    df = reports.audit_summary(fx.fact_jobs, fx.fact_durations)
    return rounded(df, avg_payroll_match_score=4, avg_duration_variance_pct=4)


query("A14_audit_summary", SUMMARY, BOTH)(_summary)
query("V8_audit_summary_stats", SUMMARY, BOTH)(_summary)


@query("A15_agency_breakdown", f"""
SELECT agency, count(*) AS job_count, count(*) FILTER (WHERE best_match_score >= 0.85) AS high_quality_matches,
       {dec("avg(posting_duration_days)")} AS avg_posting_duration, {dec("avg(salary_range_from)")} AS avg_min_salary,
       {dec("avg(salary_range_to)")} AS avg_max_salary
FROM fx_fact_jobs GROUP BY agency ORDER BY job_count DESC, agency NULLS FIRST LIMIT 10""", FACTS)
def _(fx):
    df = reports.agency_breakdown(fx.fact_jobs)
    return rounded(df, avg_posting_duration=2, avg_min_salary=2, avg_max_salary=2)


@query("A16_top_titles", f"""
SELECT business_title, count(*) AS posting_count, {dec("avg(best_match_score)", 4)} AS avg_match_score,
       {dec("avg(posting_duration_days)")} AS avg_duration
FROM fx_fact_jobs GROUP BY business_title ORDER BY posting_count DESC, business_title NULLS FIRST LIMIT 10""", FACTS)
def _(fx):
    return rounded(reports.top_titles(fx.fact_jobs), avg_match_score=4, avg_duration=2)


SALARY_STATS = f"""SELECT {dec("avg(salary_range_from)")} AS avg_min_salary,
    {dec("avg(salary_range_to)")} AS avg_max_salary, {dec("avg(payroll_salary_min)")} AS avg_payroll_min,
    {dec("avg(payroll_salary_max)")} AS avg_payroll_max,
    {dec("quantile_cont(CAST(salary_range_from AS DOUBLE), 0.5)")} AS median_min_salary,
    {dec("quantile_cont(CAST(salary_range_to AS DOUBLE), 0.5)")} AS median_max_salary
FROM fx_fact_jobs WHERE salary_range_from IS NOT NULL AND salary_range_to IS NOT NULL"""
SALARY_SCALES = dict.fromkeys(
    ["avg_min_salary", "avg_max_salary", "avg_payroll_min", "avg_payroll_max", "median_min_salary",
     "median_max_salary"], 2)
VARIANCE_STATS = f"""SELECT {dec("avg(duration_variance_pct)")} AS avg_variance_pct,
    {dec("quantile_cont(CAST(duration_variance_pct AS DOUBLE), 0.5)")} AS median_variance_pct,
    count(*) FILTER (WHERE abs(duration_variance_pct) > 50) AS significant_variances,
    count(*) FILTER (WHERE duration_variance_pct > 0) AS longer_than_expected,
    count(*) FILTER (WHERE duration_variance_pct < 0) AS shorter_than_expected
FROM fx_fact_durations WHERE duration_variance_pct IS NOT NULL"""


@query("A17_salary_statistics", SALARY_STATS, FACTS)
def _(fx):
    return rounded(reports.salary_statistics(fx.fact_jobs), **SALARY_SCALES)


@query("A17_salary_statistics_hot", SALARY_STATS, FACTS)
def _(fx):
    return rounded(reports.salary_statistics(fx.fact_jobs.repartition(40)), **SALARY_SCALES)


@query("A18_duration_variance_statistics", VARIANCE_STATS, DURATIONS)
def _(fx):
    df = reports.duration_variance_statistics(fx.fact_durations)
    return rounded(df, avg_variance_pct=2, median_variance_pct=2)


@query("A19_n_unique", """
SELECT count(*) AS n FROM (SELECT DISTINCT business_title FROM fx_fact_jobs) t""", FACTS)
def _(fx):
    return benchmark.n_unique(fx.fact_jobs, "business_title")


@query("A20_avg_duration_variance", f"""
SELECT {dec("avg(duration_variance_pct)", 4)} AS avg_duration_variance_pct FROM fx_fact_durations""", DURATIONS)
def _(fx):
    return rounded(reports.avg_duration_variance(fx.fact_durations), avg_duration_variance_pct=4)


# ---- top-k, samples, union ------------------------------------------------------------------


@query("K1_top_ranges", f"""
WITH {RANGES} SELECT * FROM stats
ORDER BY salary_range_width DESC NULLS FIRST, agency_name, title_description LIMIT 5""", PAY)
def _(fx):
    return payroll.top_ranges(_ranged(fx))


@query("K2_top_n_groups", """
SELECT career_level, count(*) AS n FROM fx_jobs GROUP BY 1 ORDER BY n DESC, career_level LIMIT 3""", JOBS)
def _(fx):
    return reports.top_n_groups(fx.jobs, "career_level", [], "n", 3)


@query("K3_distinct_sample", f"""
WITH {RANGES} SELECT * FROM stats
ORDER BY agency_name, title_description, salary_min, salary_max LIMIT 10""", PAY)
def _(fx):
    return payroll.distinct_sample(_ranged(fx))


@query("K4_preview", "SELECT * FROM fx_benchmark ORDER BY job_title LIMIT 5", ["fx_benchmark"])
def _(fx):
    return payroll.preview(fx.benchmark.orderBy("job_title"))


@query("K5_union_all", """
SELECT job_id, agency FROM fx_fact_jobs UNION ALL SELECT job_id, agency FROM fx_fact_durations""", BOTH)
def _(fx):
    return snapshots.concat_chunks(
        [df.select("job_id", "agency") for df in (fx.fact_jobs, fx.fact_durations)]
    )


# ---- composite reports ----------------------------------------------------------------------


@query("V13_quality_report", f"""
WITH jobs AS (SELECT count(*) AS total_job_postings, {COMPLETE}, {PAYROLL_QUALITY}, {RULE_COUNTS} FROM fx_fact_jobs),
durations AS (SELECT count(*) AS total_duration_records, {DURATION_QUALITY} FROM fx_fact_durations),
orphans AS ({ORPHANS}),
wide AS (SELECT CAST(COLUMNS(*) AS DECIMAL(18,4)) FROM jobs, durations, orphans)
SELECT metric, value FROM (UNPIVOT wide ON COLUMNS(*) INTO NAME metric VALUE value)""", BOTH)
def _(fx):
    return rounded(reports.quality_report(fx.fact_jobs, fx.fact_durations), value=4)


# Every measure of the report, by section, with its SQL.
AGENCY_MEASURES = {
    "job_count": "count(*)", "high_quality_matches": "count(*) FILTER (WHERE best_match_score >= 0.85)",
    "avg_posting_duration": "avg(posting_duration_days)", "avg_min_salary": "avg(CAST(salary_range_from AS DOUBLE))",
    "avg_max_salary": "avg(CAST(salary_range_to AS DOUBLE))",
}
TITLE_MEASURES = {
    "posting_count": "count(*)", "avg_match_score": "avg(CAST(best_match_score AS DOUBLE))",
    "avg_duration": "avg(posting_duration_days)",
}
DURATION_MEASURES = ["avg_variance_pct", "median_variance_pct", "significant_variances", "longer_than_expected",
                     "shorter_than_expected"]


def _largest(key: str, measures: dict[str, str]) -> str:
    values = ", ".join(f"{dec(sql)} AS {name}" for name, sql in measures.items())
    return f"""SELECT {key} AS name, {values}, count(*) AS n FROM fx_fact_jobs GROUP BY 1
    ORDER BY n DESC, name NULLS FIRST LIMIT 10"""


def _long(section: str, name: str, table: str, measures) -> str:
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, {name} AS name, '{m}' AS measure, CAST({m} AS DECIMAL(18,2)) AS value FROM {table}"
        for m in measures
    )


@query("V14_summary_report", f"""
WITH agencies AS ({_largest("agency", AGENCY_MEASURES)}), titles AS ({_largest("business_title", TITLE_MEASURES)}),
pay AS ({SALARY_STATS}), lengths AS ({VARIANCE_STATS})
{_long("agency", "name", "agencies", AGENCY_MEASURES)} UNION ALL {_long("title", "name", "titles", TITLE_MEASURES)}
UNION ALL {_long("salary", "NULL", "pay", SALARY_SCALES)} UNION ALL {_long("duration", "NULL", "lengths", DURATION_MEASURES)}
""", BOTH)
def _(fx):
    report = reports.summary_report(fx.fact_jobs, fx.fact_durations)
    none = F.lit(None).cast("string")
    sections = [
        ("agency", "agency_breakdown", F.col("agency")),
        ("title", "top_job_titles", F.col("business_title")),
        ("salary", "salary_statistics", none),
        ("duration", "duration_variance_statistics", none),
    ]
    parts = []
    for section, table, name in sections:
        df = report[table]
        measures = [c for c in df.columns if c not in ("agency", "business_title")]
        values = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in measures])
        parts.append(df.select(F.lit(section).alias("section"), name.alias("name"), F.inline(values)))
    return rounded(snapshots.concat_chunks(parts), value=2)


# ---- quality checks -------------------------------------------------------------------------


@query("Q1_check_unique", """
SELECT agency, count(*) AS n FROM fx_fact_jobs WHERE agency IS NOT NULL GROUP BY 1 HAVING count(*) > 1""", FACTS)
def _(fx):
    return quality.check_unique(fx.fact_jobs, "agency")


@query("Q2_check_not_null", "SELECT job_id FROM fx_fact_jobs WHERE business_title IS NULL", FACTS)
def _(fx):
    return quality.check_not_null(fx.fact_jobs, "business_title").select("job_id")


@query("Q3_check_accepted_range", """
SELECT job_id, salary_range_to FROM fx_fact_jobs WHERE NOT salary_range_to BETWEEN 20000 AND 400000""", FACTS)
def _(fx):
    df = quality.check_accepted_range(fx.fact_jobs, "salary_range_to", 20000, 400000)
    return df.select("job_id", "salary_range_to")


@query("Q_run_checks", """
WITH c AS (SELECT 'not_null' AS "check", 'agency' AS "column", count(*) FILTER (WHERE agency IS NULL) AS failed_rows
    FROM fx_fact_jobs
UNION ALL SELECT 'accepted_range', 'salary_range_from',
    count(*) FILTER (WHERE NOT salary_range_from BETWEEN 0 AND 500000) FROM fx_fact_jobs
UNION ALL SELECT 'unique', 'job_id', count(*) FROM (SELECT job_id FROM fx_fact_jobs GROUP BY 1 HAVING count(*) > 1) d
UNION ALL SELECT 'unique', 'business_title', count(*) FROM (SELECT business_title FROM fx_fact_jobs
    WHERE business_title IS NOT NULL GROUP BY 1 HAVING count(*) > 1) d)
SELECT *, failed_rows = 0 AS passed FROM c""", FACTS)
def _(fx):
    checks = quality.TableChecks(
        unique=["job_id", "business_title"],
        not_null=["agency"],
        accepted_range={"salary_range_from": (0, 500_000)},
    )
    return quality.run_checks(fx.fact_jobs, checks)


@query("Q4_critical_gate", """
SELECT count(*) AS rows, count(*) > 0 AND count(agency) >= 0.95 * count(*)
       AND count(business_title) >= 0.95 * count(*) AS passed FROM fx_fact_jobs""", FACTS)
def _(fx):
    # Facts without orphans: durations of the postings themselves.
    own = fx.fact_jobs.select(
        "job_id",
        F.col("best_match_score").alias("lighthouse_match_score"),
        F.col("posting_duration_days").alias("duration_variance_pct"),
    )
    try:
        quality.critical_gate(fx.fact_jobs, own)
        passed = True
    except quality.QualityGateError:
        passed = False
    return fx.fact_jobs.agg(F.count(F.lit(1)).alias("rows"), F.lit(passed).alias("passed"))


@query("Q5_load_gate", f"SELECT orphaned_duration_records AS orphans FROM ({ORPHANS}) o", BOTH)
def _(fx):
    found = quality.load_gate(fx.fact_jobs, fx.fact_durations)
    return fx.fact_jobs.agg(F.lit(found).cast("bigint").alias("orphans"))


@query("Q6_empty_stage_gate", "SELECT count(*) AS n FROM fx_jobs", JOBS)
def _(fx):
    return quality.empty_stage_gate(fx.jobs, "postings").agg(F.count(F.lit(1)).alias("n"))


def _model_checks() -> str:
    parts = []
    for model, source, checks in (
        ("stg_job_postings", "jobs", quality.MODEL_CHECKS["stg_job_postings"]),
        ("stg_payroll_data", "pay", quality.MODEL_CHECKS["stg_payroll_data"]),
    ):
        head = f"SELECT '{model}' AS model, '{{}}' AS \"check\", '{{}}' AS \"column\", count(*) AS failed_rows FROM {source} WHERE "
        parts += [head.format("not_null", c) + f"{c} IS NULL" for c in checks.not_null]
        parts += [
            head.format("accepted_range", c) + f"{c} NOT BETWEEN {low} AND {high}"
            for c, (low, high) in checks.accepted_range.items()
        ]
        parts += [
            head.format("unique", c)
            + f"{c} IN (SELECT {c} FROM {source} GROUP BY 1 HAVING count(*) > 1)"
            for c in checks.unique
        ]
    return " UNION ALL ".join(parts)


@query("Q3_model_checks", f"""
WITH jobs AS (SELECT job_id, agency AS agency_name, posting_date,
    CASE WHEN salary_range_from > 0 THEN salary_range_from END AS salary_range_from,
    CASE WHEN salary_range_to > 0 THEN salary_range_to END AS salary_range_to FROM fx_jobs WHERE job_id IS NOT NULL),
pay AS (SELECT payroll_number, agency_name, CASE WHEN base_salary > 0 THEN base_salary END AS base_salary FROM fx_payroll),
checks AS ({_model_checks()})
SELECT *, failed_rows = 0 AS passed FROM checks
UNION ALL SELECT 'mart_job_posting_analysis', "check", 'job_id', 0, TRUE FROM (VALUES ('unique'), ('not_null')) v("check")
UNION ALL SELECT 'mart_job_posting_analysis', 'accepted_range', 'salary_match_ratio', 0, TRUE""", ["fx_jobs", "fx_payroll"])
def _(fx):
    as_of = dt.datetime(1998, 7, 1)
    models = audit.run_models(fx.payroll, fx.jobs, as_of, "1997-01-01", "1998-12-31", mode="best")
    return models["model_checks"]


@query("Q7_null_and_duplicate_rates", f"""
WITH r AS (SELECT 'agency' AS "column", {dec("(count(*) - count(agency)) / count(*)", 4)} AS null_rate,
    {dec("(count(agency) - count(DISTINCT agency)) / count(*)", 4)} AS duplicate_rate FROM fx_fact_jobs
UNION ALL SELECT 'posting_date', {dec("(count(*) - count(posting_date)) / count(*)", 4)},
    {dec("(count(posting_date) - count(DISTINCT posting_date)) / count(*)", 4)} FROM fx_fact_jobs
UNION ALL SELECT 'job_id', {dec("(count(*) - count(job_id)) / count(*)", 4)},
    {dec("(count(job_id) - count(DISTINCT job_id)) / count(*)", 4)} FROM fx_fact_jobs)
SELECT *, null_rate <= 0.05 AS null_rate_passed, duplicate_rate <= 0.01 AS duplicate_rate_passed FROM r""", FACTS)
def _(fx):
    df = quality.rate_checks(fx.fact_jobs, ["agency", "posting_date", "job_id"])
    return rounded(df, null_rate=4, duplicate_rate=4)


@query("Q8_keys", """
WITH c AS (SELECT 'foreign_key' AS "check", 'job_id' AS "column", count(*) AS failed_rows
    FROM fx_fact_durations d WHERE d.job_id NOT IN (SELECT job_id FROM fx_fact_jobs)
UNION ALL SELECT 'not_null', 'job_id', count(*) FROM fx_fact_jobs WHERE job_id IS NULL
UNION ALL SELECT 'unique', 'job_id', count(*) FROM (SELECT job_id FROM fx_fact_jobs GROUP BY 1 HAVING count(*) > 1) d)
SELECT *, failed_rows = 0 AS passed FROM c""", BOTH)
def _(fx):
    child = quality.check_foreign_key(fx.fact_durations, fx.fact_jobs)
    return child.unionByName(quality.check_primary_key(fx.fact_jobs))


@query("F9_violations_by_rule", """
SELECT count(*) AS n FROM fx_fact_jobs WHERE salary_range_from > salary_range_to
    OR posting_duration_days < 0 OR posting_duration_days > 100""", FACTS)
def _(fx):
    return rule_violations(fx.fact_jobs, 100).agg(F.count(F.lit(1)).alias("n"))
