"""Staging tables, salary benchmarks by role and year, and the posting analysis mart."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paygrain.functions import scalars, text
from paygrain.functions.columns import (
    active_paid_only,
    benchmarks_for_year,
    filter_date_range,
    lenient_numeric,
    lenient_timestamp,
    load_stamps,
    money,
    negative_to_null,
    negative_to_zero,
    non_positive_to_null,
    require_not_null,
    safe_cast,
    stamp,
    strict_cast,
    with_missing,
)
from paygrain.operators.percentiles import agg_with_percentiles
from paygrain.operators.similarity import overlap_pairs
from paygrain.session import materialize
from paygrain.sources.schemas import (
    RAW_PAYROLL,
    RAW_PAYROLL_EXTRA,
    RAW_POSTINGS,
    RAW_POSTINGS_EXTRA,
)

ROLE_YEAR = ["agency_name", "title_description", "fiscal_year"]


def _text(name: str):
    return safe_cast(F.col(name), "string")


def _when(name: str, types: dict[str, str]):
    """Text must be an ISO timestamp; typed columns are cast."""
    col = F.col(name)
    return lenient_timestamp(col) if types[name] == "string" else safe_cast(col, "timestamp_ntz")


def stg_job_postings(
    raw: DataFrame, agency_rules=text.AGENCY_RULES, as_of: dt.datetime | None = None
) -> DataFrame:
    df = require_not_null(with_missing(raw, RAW_POSTINGS + RAW_POSTINGS_EXTRA), ["job_id"])
    types = dict(df.dtypes)
    df = df.select(
        strict_cast(F.col("job_id"), "string").alias("job_id"),
        strict_cast(F.col("agency"), "string").alias("agency_name"),
        *[_text(c).alias(c) for c in ("business_title", "title_description", "job_description")],
        non_positive_to_null(lenient_numeric(F.col("salary_range_from"))).alias("salary_range_from"),
        non_positive_to_null(lenient_numeric(F.col("salary_range_to"))).alias("salary_range_to"),
        _when("posting_date", types).alias("posting_date"),
        _when("application_deadline", types).alias("application_deadline"),
        *[_text(c).alias(c) for c in ("work_location", "minimum_qual_requirements", "preferred_skills")],
        _text("full_time_part_time_indicator").alias("employment_type"),
        _text("career_level").alias("career_level"),
    )
    return load_stamps(df, as_of).withColumns(
        {
            "salary_midpoint": scalars.salary_midpoint(
                F.col("salary_range_from"), F.col("salary_range_to")
            ),
            "posting_duration_days": scalars.whole_days_between(
                F.col("posting_date"), F.col("application_deadline")
            ),
            "agency_name_standardized": text.standardize_agency(F.col("agency_name"), agency_rules),
        }
    )


def stg_payroll_data(
    raw: DataFrame, agency_rules=text.AGENCY_RULES, as_of: dt.datetime | None = None
) -> DataFrame:
    df = with_missing(raw, RAW_PAYROLL + RAW_PAYROLL_EXTRA)
    df = require_not_null(df, ["payroll_number", *ROLE_YEAR]).select(
        _text("payroll_number").alias("payroll_number"),
        _text("agency_name").alias("agency_name"),
        _text("title_description").alias("title_description"),
        non_positive_to_null(lenient_numeric(F.col("base_salary"))).alias("base_salary"),
        negative_to_null(lenient_numeric(F.col("regular_hours"))).alias("regular_hours"),
        negative_to_null(lenient_numeric(F.col("regular_gross_paid"))).alias("regular_gross_paid"),
        negative_to_zero(lenient_numeric(F.col("total_ot_paid"))).alias("total_ot_paid"),
        negative_to_zero(lenient_numeric(F.col("total_other_pay"))).alias("total_other_pay"),
        _text("leave_status_as_of_june_30").alias("leave_status"),
        strict_cast(F.col("fiscal_year"), "int").alias("fiscal_year"),
    )
    base, hours = F.col("base_salary"), F.col("regular_hours")
    return load_stamps(df, as_of).withColumns(
        {
            "total_compensation": scalars.total_compensation(
                base, F.col("total_ot_paid"), F.col("total_other_pay")
            ),
            "estimated_hourly_rate": scalars.estimated_hourly_rate(base, hours),
            "agency_name_standardized": text.standardize_agency(F.col("agency_name"), agency_rules),
            "is_active_employee": scalars.is_active(F.col("leave_status")),
        }
    )


def salary_benchmarks(
    staged: DataFrame, min_count: int = 3
) -> DataFrame:
    """Pay statistics of active staff by role and fiscal year, for groups of ``min_count``."""
    base = "base_salary"
    df = active_paid_only(staged).select(
        F.col("agency_name_standardized").alias("agency_name"),
        "title_description",
        "fiscal_year",
        base,
        "total_compensation",
        "regular_hours",
        "estimated_hourly_rate",
    )
    stats = agg_with_percentiles(
        df,
        ROLE_YEAR,
        [
            F.count(F.lit(1)).alias("employee_count"),
            F.min(base).alias("min_base_salary"),
            F.max(base).alias("max_base_salary"),
            F.avg(base).alias("avg_base"),
            F.avg("total_compensation").alias("avg_comp"),
            F.min("total_compensation").alias("min_total_compensation"),
            F.max("total_compensation").alias("max_total_compensation"),
            F.stddev_samp(base).alias("std_base"),
            F.avg("regular_hours").alias("avg_hours"),
            F.avg("estimated_hourly_rate").alias("avg_rate"),
        ],
        {"median": (base, 0.5), "q1": (base, 0.25), "q3": (base, 0.75)},
    ).where(F.col("employee_count") >= min_count)
    return stats.select(
        *ROLE_YEAR,
        "employee_count",
        "min_base_salary",
        "max_base_salary",
        money(F.col("avg_base")).alias("avg_base_salary"),
        money(F.col("median")).alias("median_base_salary"),
        money(F.col("q1")).alias("q1_base_salary"),
        money(F.col("q3")).alias("q3_base_salary"),
        money(F.col("avg_comp")).alias("avg_total_compensation"),
        "min_total_compensation",
        "max_total_compensation",
        money(F.col("std_base")).alias("salary_std_dev"),
        money(F.try_divide("std_base", "avg_base"), 4, 3).alias("salary_coefficient_variation"),
        money(F.col("avg_hours"), 8, 2).alias("avg_regular_hours"),
        money(F.col("avg_rate"), 8, 2).alias("avg_hourly_rate"),
    )


def int_salary_benchmarks(
    staged: DataFrame,
    min_count: int = 3,
    variance_threshold: float = 0.20,
) -> DataFrame:
    df = salary_benchmarks(staged, min_count)
    low, high = scalars.acceptable_range(F.col("median_base_salary").cast("double"))
    return df.withColumns(
        {
            "salary_band": scalars.salary_band(F.col("avg_base_salary")),
            "salary_range_lower": money(low),
            "salary_range_upper": money(high),
            "is_high_variance_position": scalars.is_high_variance(
                F.col("salary_coefficient_variation"), variance_threshold
            ),
        }
    )


def similar_titles(
    postings: DataFrame, benchmarks: DataFrame, threshold: float = 0.85
) -> DataFrame:
    """Pairs of titles of one agency that are equal or have a trigram similarity above the
    threshold: ``agency_name, title_description, benchmark_title, salary_match_ratio``.

    Works on the distinct (agency, title) combinations of both sides.
    """
    keys = ["agency_name", "title_description"]
    left = materialize(
        postings.select(F.col("agency_name_standardized").alias("agency_name"), "title_description")
        .dropna()
        .distinct(),
        "posting-titles",
    )
    right = materialize(benchmarks.select(*keys).dropna().distinct(), "benchmark-titles")
    exact = left.join(right, keys).select(
        *keys,
        F.col("title_description").alias("benchmark_title"),
        F.lit(1.0).cast("float").alias("salary_match_ratio"),
    )

    def tokens(df: DataFrame) -> DataFrame:
        title = F.col("title_description")
        return df.select("agency_name", title.alias("key"), text.trigram_tokens(title).alias("tokens"))

    # The ratio is single precision, so the exact bound is taken a little below the threshold.
    low = threshold - 1e-6
    pairs = overlap_pairs(
        tokens(left),
        tokens(right),
        low / (1 + low),
        ["agency_name"],
        accept=lambda shared, m, n: text.trigram_ratio(shared, m, n) > threshold,
    )
    ratio = text.trigram_ratio(F.col("shared"), F.col("left_size"), F.col("right_size"))
    near = pairs.where(F.col("left_key") != F.col("right_key")).select(
        "agency_name",
        F.col("left_key").alias("title_description"),
        F.col("right_key").alias("benchmark_title"),
        ratio.alias("salary_match_ratio"),
    )
    return exact.unionByName(near)


def benchmark_match(
    postings: DataFrame, benchmarks: DataFrame, threshold: float = 0.85, mode: str = "all"
) -> DataFrame:
    """Left join of staged postings with the benchmarks of the same agency and a similar title.

    ``mode="all"`` keeps every partner, so a posting may appear several times. ``mode="best"``
    keeps one: highest ratio, then most employees, then title. The benchmarks are stored, a row a role and year: they are
    read twice, and the payroll behind them should be read and aggregated once.
    """
    values = materialize(
        benchmarks.select(
            "agency_name",
            F.col("title_description").alias("benchmark_title"),
            "fiscal_year",
            F.col("min_base_salary").alias("payroll_min_salary"),
            F.col("max_base_salary").alias("payroll_max_salary"),
            F.col("median_base_salary").alias("payroll_median_salary"),
            F.col("avg_base_salary").alias("payroll_avg_salary"),
            F.col("employee_count").alias("payroll_employee_count"),
            F.col("salary_band").alias("payroll_salary_band"),
            "is_high_variance_position",
        ),
        "benchmarks",
    )
    pairs = similar_titles(postings, values.withColumnRenamed("benchmark_title", "title_description"), threshold)
    partners = pairs.join(values, ["agency_name", "benchmark_title"])
    if mode == "best":
        # One row per (posting title, partner): the groups hold similar titles, not postings.
        best = Window.partitionBy("agency_name", "title_description").orderBy(
            F.desc("salary_match_ratio"), F.desc("payroll_employee_count"), "benchmark_title",
            F.desc("fiscal_year"),
        )
        partners = partners.withColumn("rank", F.row_number().over(best)).where("rank = 1").drop("rank")
    elif mode != "all":
        raise ValueError(f"unknown mode: {mode}")
    partners = partners.drop("fiscal_year").withColumnRenamed("agency_name", "agency_name_standardized")
    joined = postings.join(partners, ["agency_name_standardized", "title_description"], "left")
    ratio = F.coalesce("salary_match_ratio", F.lit(0.0).cast("float"))
    return joined.select(
        *postings.columns,
        *[c for c in partners.columns if c.startswith("payroll_")],
        "is_high_variance_position",
        ratio.alias("salary_match_ratio"),
    )


def mart_job_posting_analysis(
    postings: DataFrame,
    benchmarks: DataFrame,
    as_of_year: int,
    start: str = "2024-01-01",
    end: str = "2025-12-31",
    threshold: float = 0.85,
    outlier_threshold: float = 0.20,
    mode: str = "all",
    as_of: dt.datetime | None = None,
) -> DataFrame:
    matched = benchmark_match(
        filter_date_range(postings, "posting_date", start, end),
        benchmarks_for_year(benchmarks, as_of_year),
        threshold,
        mode,
    )
    ratio = F.col("salary_match_ratio")

    def gate(col):
        return scalars.benchmark_gate(ratio, col, threshold)

    variance = gate(scalars.salary_variance(F.col("salary_midpoint"), F.col("payroll_median_salary")))
    return matched.select(
        "job_id",
        "agency_name",
        "agency_name_standardized",
        "business_title",
        "title_description",
        "posting_date",
        "application_deadline",
        "posting_duration_days",
        "work_location",
        "employment_type",
        "career_level",
        F.col("salary_range_from").alias("posted_salary_min"),
        F.col("salary_range_to").alias("posted_salary_max"),
        F.col("salary_midpoint").alias("posted_salary_midpoint"),
        gate(F.col("payroll_min_salary")).alias("benchmark_salary_min"),
        gate(F.col("payroll_max_salary")).alias("benchmark_salary_max"),
        gate(F.col("payroll_median_salary")).alias("benchmark_salary_median"),
        gate(F.col("payroll_employee_count")).alias("benchmark_employee_count"),
        "salary_match_ratio",
        variance.alias("salary_variance_pct"),
        scalars.flag(ratio >= threshold).alias("has_salary_benchmark"),
        (F.col("salary_range_from").isNotNull() & F.col("salary_range_to").isNotNull()).alias(
            "has_posted_salary"
        ),
        scalars.flag(F.col("posting_duration_days") > 0).alias("has_valid_posting_period"),
        scalars.is_salary_outlier(variance, outlier_threshold).alias("is_salary_outlier"),
        "payroll_salary_band",
        "is_high_variance_position",
        stamp(as_of).alias("analysis_timestamp"),
    )


MODELS: Sequence[str] = (
    "stg_job_postings",
    "stg_payroll_data",
    "int_salary_benchmarks",
    "mart_job_posting_analysis",
)
