"""Scalar expressions over the stand-in views."""

from pyspark.sql import functions as F

from checks.registry import dec, query, rounded
from checks.ratio_sql import ratio
from paygrain.functions import columns, scalars, text
from paygrain.operators import payroll

PAY, JOBS, FACTS = ["fx_payroll"], ["fx_jobs"], ["fx_fact_jobs"]
TITLE_RULES = ((("%WIDGET%", "%GIZMO%"), "Device"), (("%GEAR%",), "Drive"))

ANNUAL = """CASE pay_basis WHEN 'per Annum' THEN base_salary WHEN 'per Hour' THEN base_salary * 2080
    WHEN 'per Day' THEN base_salary * 260
    ELSE regular_gross_paid + coalesce(total_ot_paid, 0) + coalesce(total_other_pay, 0) END"""
START = "CAST(posting_date AS TIMESTAMP)"
END = f"""coalesce(CAST(process_date AS TIMESTAMP), CAST(posting_updated AS TIMESTAMP),
    {START} + INTERVAL 30 DAY)"""


@query("C1_annualize_salary", f"""
SELECT payroll_number, pay_basis, {ANNUAL} AS annual_salary_standardized FROM fx_payroll""", PAY)
def _(fx):
    return payroll.standardize_annual_salary(fx.payroll).select(
        "payroll_number", "pay_basis", "annual_salary_standardized"
    )


@query("C2_salary_range_width", """
SELECT agency, business_title, min(salary_range_to - salary_range_from) AS narrowest,
       max(salary_range_to - salary_range_from) AS widest
FROM fx_fact_jobs GROUP BY agency, business_title""", FACTS)
def _(fx):
    width = scalars.salary_range_width(F.col("salary_range_from"), F.col("salary_range_to"))
    return fx.fact_jobs.groupBy("agency", "business_title").agg(
        F.min(width).alias("narrowest"), F.max(width).alias("widest")
    )


@query("C3_salary_midpoint", """
SELECT job_id, (salary_range_from + salary_range_to) / 2 AS salary_midpoint FROM fx_jobs""", JOBS)
def _(fx):
    mid = scalars.salary_midpoint(F.col("salary_range_from"), F.col("salary_range_to"))
    return fx.jobs.select("job_id", mid.alias("salary_midpoint"))


def _dated(fx):
    from paygrain.operators.postings import with_posting_dates, with_posting_duration

    return with_posting_duration(with_posting_dates(fx.jobs))


@query("C4_posting_end", f"SELECT job_id, {END} AS posting_end FROM fx_jobs", JOBS)
def _(fx):
    return _dated(fx).select("job_id", F.col("calculated_end_date").alias("posting_end"))


@query("C5_posting_duration_days", f"""
SELECT job_id, CAST(trunc(epoch({END} - {START}) / 86400) AS INT) AS posting_duration_days
FROM fx_jobs""", JOBS)
def _(fx):
    return _dated(fx).select("job_id", "posting_duration_days")


@query("C6_deadline_duration_days", f"""
SELECT job_id, CAST(trunc(epoch(CAST(application_deadline AS TIMESTAMP) - {START}) / 86400) AS INT)
       AS deadline_days FROM fx_jobs""", JOBS)
def _(fx):
    start, end = (columns.lenient_timestamp(F.col(c)) for c in ("posting_date", "application_deadline"))
    return fx.jobs.select("job_id", scalars.whole_days_between(start, end).alias("deadline_days"))


@query("C7_standardize_agency", """
SELECT job_id, CASE WHEN upper(business_title) LIKE '%WIDGET%' OR upper(business_title) LIKE '%GIZMO%'
    THEN 'Device' WHEN upper(business_title) LIKE '%GEAR%' THEN 'Drive'
    ELSE business_title END AS label FROM fx_jobs""", JOBS)
def _(fx):
    label = text.standardize_agency(F.col("business_title"), TITLE_RULES)
    return fx.jobs.select("job_id", label.alias("label"))


@query("C8_is_active", """
SELECT payroll_number, coalesce(upper(leave_status_as_of_june_30) IN ('ACTIVE', 'A'), FALSE)
       AS is_active_employee FROM fx_payroll""", PAY)
def _(fx):
    active = scalars.is_active(F.col("leave_status_as_of_june_30"))
    return fx.payroll.select("payroll_number", active.alias("is_active_employee"))


@query("C9_total_compensation", """
SELECT payroll_number, coalesce(base_salary, 0) + coalesce(total_ot_paid, 0)
       + coalesce(total_other_pay, 0) AS total_compensation FROM fx_payroll""", PAY)
def _(fx):
    total = scalars.total_compensation(
        F.col("base_salary"), F.col("total_ot_paid"), F.col("total_other_pay")
    )
    return fx.payroll.select("payroll_number", total.alias("total_compensation"))


@query("C10_estimated_hourly_rate", """
SELECT payroll_number, CASE WHEN regular_hours > 0 THEN base_salary / regular_hours END AS rate
FROM fx_payroll""", PAY)
def _(fx):
    rate = scalars.estimated_hourly_rate(F.col("base_salary"), F.col("regular_hours"))
    return fx.payroll.select("payroll_number", rate.alias("rate"))


@query("C11_salary_category", """
SELECT CASE WHEN salary_range_to < 40000 THEN 'Low' WHEN salary_range_to < 70000 THEN 'Medium'
       WHEN salary_range_to < 100000 THEN 'High' ELSE 'Very High' END AS category,
       count(*) AS n FROM fx_jobs GROUP BY 1""", JOBS)
def _(fx):
    category = scalars.salary_category(F.col("salary_range_to")).alias("category")
    return fx.jobs.groupBy(category).agg(F.count(F.lit(1)).alias("n"))


@query("C12_salary_band", """
SELECT CASE WHEN base_salary < 40000 THEN 'Entry Level' WHEN base_salary < 60000 THEN 'Mid Level'
       WHEN base_salary < 80000 THEN 'Senior Level' WHEN base_salary < 120000 THEN 'Manager Level'
       ELSE 'Executive Level' END AS band, count(*) AS n FROM fx_payroll GROUP BY 1""", PAY)
def _(fx):
    band = scalars.salary_band(F.col("base_salary")).alias("band")
    return fx.payroll.groupBy(band).agg(F.count(F.lit(1)).alias("n"))


@query("C13_posting_intensity", """
SELECT job_title, total_postings / coalesce(nullif(median_posting_duration, 0), 30) AS intensity
FROM fx_benchmark""", ["fx_benchmark"])
def _(fx):
    per_day = scalars.posting_intensity(
        F.col("total_postings"), F.nullif("median_posting_duration", F.lit(0.0))
    )
    return fx.benchmark.select("job_title", per_day.alias("intensity"))


@query("C14_acceptable_range", f"""
SELECT agency_name, title_description, {dec("quantile_cont(base_salary, 0.5) * 0.8")} AS lower_bound,
       {dec("quantile_cont(base_salary, 0.5) * 1.2")} AS upper_bound
FROM fx_payroll GROUP BY 1, 2""", PAY)
def _(fx):
    from paygrain.operators.percentiles import agg_with_percentiles

    keys = ["agency_name", "title_description"]
    df = agg_with_percentiles(fx.payroll, keys, [F.count(F.lit(1)).alias("n")], {"m": ("base_salary", 0.5)})
    low, high = scalars.acceptable_range(F.col("m"))
    return df.select(
        *keys, columns.money(low, 18, 2).alias("lower_bound"), columns.money(high, 18, 2).alias("upper_bound")
    )


@query("C15_is_high_variance", """
SELECT agency_name, title_description, coalesce(stddev_samp(base_salary) / avg(base_salary) > 0.55, FALSE)
       AS is_high FROM fx_payroll GROUP BY 1, 2""", PAY)
def _(fx):
    cv = F.try_divide(F.stddev_samp("base_salary"), F.avg("base_salary"))
    return fx.payroll.groupBy("agency_name", "title_description").agg(
        scalars.is_high_variance(cv, 0.55).alias("is_high")
    )


# Expressions on pairs of titles use the distinct (title, description) pairs of the postings.
GRAMS = """list_distinct(flatten(list_transform(list_filter(string_split(regexp_replace(lower({0}),
    '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> ''), lambda w: list_transform(
    range(1, CAST(length(w) + 2 AS BIGINT)), lambda i: substr('  ' || w || ' ', i, 3)))))"""
SIMILARITY = """CAST(CAST(len(list_intersect({0}, {1})) AS DOUBLE)
    / (len({0}) + len({1}) - len(list_intersect({0}, {1}))) AS FLOAT)"""
TITLE_PAIRS = f"""pairs AS (SELECT DISTINCT business_title, title_description FROM fx_jobs),
grams AS (SELECT *, {GRAMS.format("business_title")} AS a, {GRAMS.format("title_description")} AS b
          FROM pairs),
scored AS (SELECT business_title, title_description, {SIMILARITY.format("a", "b")} AS similarity
           FROM grams)"""


def _pairs(fx):
    return fx.jobs.select("business_title", "title_description").distinct()


@query("T5_trigram_similarity", f"WITH {TITLE_PAIRS} SELECT * FROM scored", JOBS)
def _(fx):
    similarity = text.trigram_similarity(F.col("business_title"), F.col("title_description"))
    return _pairs(fx).withColumn("similarity", similarity)


@query("C16_match_ratio", f"""
WITH {TITLE_PAIRS} SELECT business_title, title_description,
    CAST(CASE WHEN business_title = title_description THEN 1.0 WHEN similarity > CAST(0.8 AS DOUBLE) THEN similarity
    ELSE 0.0 END AS FLOAT) AS ratio FROM scored""", JOBS)
def _(fx):
    a, b = F.col("business_title"), F.col("title_description")
    ratio = scalars.match_ratio(F.lit(True), a == b, text.trigram_similarity(a, b))
    return _pairs(fx).withColumn("ratio", ratio)


@query("T4_sequence_ratio", f"""
WITH RECURSIVE pairs AS (SELECT DISTINCT business_title AS x, title_description AS y FROM fx_jobs),
{ratio("pairs")}
SELECT x AS business_title, y AS title_description, ratio FROM ratios""", JOBS)
def _(fx):
    from paygrain.operators.similarity import sequence_ratio

    # One Python call per distinct pair, spread over the tasks.
    return _pairs(fx).withColumn("ratio", sequence_ratio("business_title", "title_description"))


@query("C17_benchmark_gate", """
SELECT job_id, CASE WHEN best_match_score >= 0.85 THEN payroll_salary_min END AS gated_min,
       CASE WHEN best_match_score >= 0.85 THEN payroll_salary_max END AS gated_max
FROM fx_fact_jobs""", FACTS)
def _(fx):
    score = F.col("best_match_score")
    return fx.fact_jobs.select(
        "job_id",
        scalars.benchmark_gate(score, F.col("payroll_salary_min")).alias("gated_min"),
        scalars.benchmark_gate(score, F.col("payroll_salary_max")).alias("gated_max"),
    )


VARIANCE = """(CAST(salary_range_to AS DOUBLE) - CAST(payroll_salary_min AS DOUBLE))
    / CAST(payroll_salary_min AS DOUBLE)"""


@query("C18_salary_variance_pct", f"""
SELECT job_id, CASE WHEN best_match_score >= 0.85 THEN {VARIANCE} END AS variance
FROM fx_fact_jobs""", FACTS)
def _(fx):
    value = scalars.salary_variance(F.col("salary_range_to"), F.col("payroll_salary_min"))
    gated = scalars.benchmark_gate(F.col("best_match_score"), value)
    return fx.fact_jobs.select("job_id", gated.alias("variance"))


@query("C19_quality_flags", """
SELECT job_id, coalesce(best_match_score >= 0.85, FALSE) AS has_salary_benchmark,
       salary_range_from IS NOT NULL AND salary_range_to IS NOT NULL AS has_posted_salary,
       coalesce(posting_duration_days > 0, FALSE) AS has_valid_posting_period
FROM fx_fact_jobs""", FACTS)
def _(fx):
    return fx.fact_jobs.select(
        "job_id",
        scalars.flag(F.col("best_match_score") >= 0.85).alias("has_salary_benchmark"),
        (F.col("salary_range_from").isNotNull() & F.col("salary_range_to").isNotNull()).alias(
            "has_posted_salary"
        ),
        scalars.flag(F.col("posting_duration_days") > 0).alias("has_valid_posting_period"),
    )


@query("C20_is_salary_outlier", f"""
SELECT job_id, coalesce(best_match_score >= 0.85 AND abs({VARIANCE}) > 0.20, FALSE) AS is_outlier
FROM fx_fact_jobs""", FACTS)
def _(fx):
    value = scalars.salary_variance(F.col("salary_range_to"), F.col("payroll_salary_min"))
    gated = scalars.benchmark_gate(F.col("best_match_score"), value)
    return fx.fact_jobs.select("job_id", scalars.is_salary_outlier(gated).alias("is_outlier"))


@query("C21_duration_variance", """
WITH d AS (SELECT job_id, actual_posting_duration_days AS actual,
                  CAST(lighthouse_median_posting_duration AS DOUBLE) AS expected FROM fx_fact_durations)
SELECT job_id, actual - expected AS duration_variance,
       CASE WHEN expected > 0 THEN (actual - expected) / expected * 100 END AS duration_variance_pct
FROM d""", ["fx_fact_durations"])
def _(fx):
    actual = F.col("actual_posting_duration_days")
    expected = F.col("lighthouse_median_posting_duration").cast("double")
    return fx.fact_durations.select(
        "job_id",
        scalars.duration_variance(actual, expected).alias("duration_variance"),
        scalars.duration_variance_pct(actual, expected).alias("duration_variance_pct"),
    )


@query("C22_pct_complete", f"""
SELECT agency, {dec("count(salary_range_to) / count(*) * 100", 4)} AS complete_pct
FROM fx_fact_jobs GROUP BY agency""", FACTS)
def _(fx):
    complete = scalars.pct_complete(F.col("salary_range_to"))
    return rounded(fx.fact_jobs.groupBy("agency").agg(complete.alias("complete_pct")), complete_pct=4)


def _key_sql(col: str) -> str:
    return f"regexp_replace(regexp_replace({col}, '[^\\w\\s]', '', 'g'), '\\s+', '_', 'g')"


JOB_KEY = _key_sql("trim(lower(agency)) || '_' || trim(lower(business_title))")
PAY_KEY = _key_sql("trim(lower(agency_name)) || '_' || trim(lower(title_description))")


@query("T1_match_key", f"SELECT job_id, {JOB_KEY} AS fuzzy_match_string FROM fx_jobs", JOBS)
def _(fx):
    key = text.match_key(F.col("agency"), F.col("business_title"))
    return fx.jobs.select("job_id", key.alias("fuzzy_match_string"))


@query("T2_title_key_regex", f"SELECT job_id, {_key_sql('trim(lower(business_title))')} AS title_key FROM fx_jobs", JOBS)
def _(fx):
    return fx.jobs.select("job_id", text.title_key_regex(F.col("business_title")).alias("title_key"))


ALNUM_KEY = "regexp_replace(trim(regexp_replace(lower({0}), '[^a-z0-9\\s]', '', 'g')), '\\s+', '_', 'g')"


@query("T3_title_key_alnum", f"SELECT job_id, {ALNUM_KEY.format('business_title')} AS title_key FROM fx_jobs", JOBS)
def _(fx):
    return fx.jobs.select("job_id", text.title_key_alnum(F.col("business_title")).alias("title_key"))


@query("T6_upper_like_any", """
SELECT agency, count(*) AS n FROM fx_jobs WHERE upper(business_title) LIKE '%WIDGET%'
    OR upper(business_title) LIKE '%II' GROUP BY agency""", JOBS)
def _(fx):
    hit = text.upper_like_any(F.col("business_title"), ["%WIDGET%", "%II"])
    return fx.jobs.where(hit).groupBy("agency").agg(F.count(F.lit(1)).alias("n"))


@query("T7_header_or_default", """
SELECT workbook, sheet, row_idx, col_idx,
       coalesce(nullif(trim(value), ''), concat('col_', CAST(col_idx AS VARCHAR))) AS header
FROM fx_cells""", ["fx_cells"])
def _(fx):
    name = text.header_or_default(F.col("value"), F.col("col_idx"))
    return fx.cells.select("workbook", "sheet", "row_idx", "col_idx", name.alias("header"))
