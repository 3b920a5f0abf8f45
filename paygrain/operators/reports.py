"""Views over the fact tables, quality metrics and summary reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paygrain.functions.columns import (
    benchmark_matches,
    high_quality_payroll_matches,
    rule_conditions,
)
from paygrain.operators.percentiles import agg_with_percentiles

COMPLETENESS = {
    "agency": "agency",
    "business_title": "title",
    "posting_date": "date",
    "salary_range_from": "salary_from",
    "salary_range_to": "salary_to",
}


def _count_where(condition: Column, name: str) -> Column:
    return F.count_if(condition).alias(name)


def _side_by_side(*single_rows: DataFrame) -> DataFrame:
    """Columns of several one-row tables as one row, by scalar subqueries."""
    first, *others = single_rows
    for other in others:
        packed = other.select(F.struct(*other.columns)).scalar()
        first = first.withColumn("_row", packed).select(
            *first.columns, *[F.col(f"_row.{c}").alias(c) for c in other.columns]
        )
    return first


# ---- views ----------------------------------------------------------------------------------


def high_quality_payroll_view(postings: DataFrame) -> DataFrame:
    return high_quality_payroll_matches(postings).select(
        "job_id", "agency", "business_title", "salary_range_from", "salary_range_to",
        "payroll_salary_min", "payroll_salary_max", "best_match_score", "posting_duration_days",
    )


def posting_duration_view(durations: DataFrame, postings: DataFrame) -> DataFrame:
    return (
        benchmark_matches(durations)
        .select(
            "job_id", "agency", "business_title", "actual_posting_duration_days",
            "lighthouse_median_posting_duration", "duration_variance_pct", "lighthouse_match_score",
        )
        .join(
            postings.select("job_id", "salary_range_from", "salary_range_to", "number_of_positions"),
            "job_id",
        )
    )


def audit_summary(postings: DataFrame, durations: DataFrame) -> DataFrame:
    """One pass over each table."""
    score = F.col("best_match_score")
    jobs = postings.agg(
        F.count(F.lit(1)).alias("total_job_postings"),
        _count_where(score >= 0.85, "high_quality_payroll_matches"),
        F.avg(score.cast("double")).alias("avg_payroll_match_score"),
        F.countDistinct("agency").alias("unique_agencies"),
        F.countDistinct("business_title").alias("unique_job_titles"),
    )
    length = durations.agg(
        F.count(F.lit(1)).alias("total_duration_records"),
        _count_where(F.col("lighthouse_match_score") >= 0.7, "good_lighthouse_matches"),
        F.avg(F.col("duration_variance_pct").cast("double")).alias("avg_duration_variance_pct"),
    )
    return _side_by_side(jobs, length).select(
        "total_job_postings", "high_quality_payroll_matches", "avg_payroll_match_score",
        "total_duration_records", "good_lighthouse_matches", "avg_duration_variance_pct",
        "unique_agencies", "unique_job_titles",
    )


# ---- quality metrics ------------------------------------------------------------------------


def orphans(durations: DataFrame, postings: DataFrame, key: str = "job_id") -> DataFrame:
    """Rows without a posting; a null key is an orphan too."""
    return durations.join(postings.select(key), key, "left_anti")


def orphan_count(durations: DataFrame, postings: DataFrame) -> DataFrame:
    return orphans(durations, postings).agg(F.count(F.lit(1)).alias("orphaned_duration_records"))


def row_counts(postings: DataFrame, durations: DataFrame) -> DataFrame:
    count = F.count(F.lit(1))
    return _side_by_side(
        postings.agg(count.alias("total_job_postings")),
        durations.agg(count.alias("total_duration_records")),
    )


def _completeness_columns() -> list[Column]:
    total = F.count(F.lit(1))
    return [
        (F.try_divide(F.count(column), total) * 100).alias(f"{name}_completeness_pct")
        for column, name in COMPLETENESS.items()
    ]


def completeness(postings: DataFrame) -> DataFrame:
    return postings.agg(
        F.count(F.lit(1)).alias("total_records"),
        *[F.count(c).alias(f"{n}_complete") for c, n in COMPLETENESS.items()],
        *_completeness_columns(),
    )


def _payroll_quality_columns() -> list[Column]:
    score = F.col("best_match_score")
    return [
        _count_where(score >= 0.85, "high_quality_payroll_matches"),
        _count_where(score >= 0.70, "good_payroll_matches"),
        _count_where(
            score.isNotNull() & F.col("payroll_salary_min").isNotNull(), "jobs_with_payroll_salary"
        ),
        F.coalesce(F.avg(score.cast("double")), F.lit(0.0)).alias("avg_payroll_match_score"),
    ]


def payroll_match_quality(postings: DataFrame) -> DataFrame:
    return postings.agg(
        F.count("best_match_score").alias("total_jobs"), *_payroll_quality_columns()
    )


def _duration_quality_columns() -> list[Column]:
    score = F.col("lighthouse_match_score")
    pct = F.when(score.isNotNull(), F.col("duration_variance_pct").cast("double"))
    return [
        _count_where(score >= 0.80, "high_quality_lighthouse_matches"),
        _count_where(score >= 0.70, "good_lighthouse_matches"),
        F.coalesce(F.avg(score.cast("double")), F.lit(0.0)).alias("avg_lighthouse_match_score"),
        F.coalesce(F.avg(pct), F.lit(0.0)).alias("avg_duration_variance_pct"),
    ]


def duration_match_quality(durations: DataFrame) -> DataFrame:
    score, pct = F.col("lighthouse_match_score"), F.col("duration_variance_pct")
    matched = F.when(score.isNotNull(), pct)
    return durations.agg(
        F.count(score).alias("total_duration_records"),
        *_duration_quality_columns(),
        F.min(matched).alias("min_duration_variance_pct"),
        F.max(matched).alias("max_duration_variance_pct"),
    )


def _rule_columns(max_days: int = 365) -> list[Column]:
    """``invalid_salary_ranges`` counts the rows with any violation; ``from_gt_to`` the ranges."""
    rules = rule_conditions(max_days)
    anything = F.lit(False)
    for condition in rules.values():
        anything = anything | F.coalesce(condition, F.lit(False))
    return [
        _count_where(anything, "invalid_salary_ranges"),
        *[_count_where(condition, name) for name, condition in rules.items()],
    ]


def business_rule_counts(postings: DataFrame, max_days: int = 365) -> DataFrame:
    return postings.agg(*_rule_columns(max_days))


def avg_duration_variance(durations: DataFrame) -> DataFrame:
    pct = F.col("duration_variance_pct").cast("double")
    return durations.agg(F.avg(pct).alias("avg_duration_variance_pct"))


def quality_row(postings: DataFrame, durations: DataFrame) -> DataFrame:
    """All quality metrics as one row: one pass over each table and the orphan join."""
    jobs = postings.agg(
        F.count(F.lit(1)).alias("total_job_postings"),
        *_completeness_columns(),
        *_payroll_quality_columns(),
        *_rule_columns(),
    )
    length = durations.agg(
        F.count(F.lit(1)).alias("total_duration_records"), *_duration_quality_columns()
    )
    return _side_by_side(jobs, length, orphan_count(durations, postings))


def quality_report(postings: DataFrame, durations: DataFrame) -> DataFrame:
    """The metrics of :func:`quality_row` as (metric, value) rows."""
    row = quality_row(postings, durations)
    doubles = row.select([F.col(c).cast("double").alias(c) for c in row.columns])
    return doubles.unpivot([], doubles.columns, "metric", "value")


# ---- summary reports ------------------------------------------------------------------------


def top_n_groups(df: DataFrame, key: str, aggregates: Sequence[Column], count: str, n: int = 10):
    """The n largest groups; ties go by the key."""
    grouped = df.groupBy(key).agg(F.count(F.lit(1)).alias(count), *aggregates)
    return grouped.orderBy(F.desc(count), key).limit(n)


def agency_breakdown(postings: DataFrame, n: int = 10) -> DataFrame:
    return top_n_groups(
        postings,
        "agency",
        [
            _count_where(F.col("best_match_score") >= 0.85, "high_quality_matches"),
            F.avg("posting_duration_days").alias("avg_posting_duration"),
            F.avg(F.col("salary_range_from").cast("double")).alias("avg_min_salary"),
            F.avg(F.col("salary_range_to").cast("double")).alias("avg_max_salary"),
        ],
        "job_count",
        n,
    )


def top_titles(postings: DataFrame, n: int = 10) -> DataFrame:
    return top_n_groups(
        postings,
        "business_title",
        [
            F.avg(F.col("best_match_score").cast("double")).alias("avg_match_score"),
            F.avg("posting_duration_days").alias("avg_duration"),
        ],
        "posting_count",
        n,
    )


def salary_statistics(postings: DataFrame) -> DataFrame:
    names = ("salary_range_from", "salary_range_to", "payroll_salary_min", "payroll_salary_max")
    low, high, pay_low, pay_high = names
    df = postings.where(F.col(low).isNotNull() & F.col(high).isNotNull()).select(
        [F.col(c).cast("double").alias(c) for c in names]
    )
    return agg_with_percentiles(
        df,
        [],
        [
            F.avg(low).alias("avg_min_salary"),
            F.avg(high).alias("avg_max_salary"),
            F.avg(pay_low).alias("avg_payroll_min"),
            F.avg(pay_high).alias("avg_payroll_max"),
        ],
        {"median_min_salary": (low, 0.5), "median_max_salary": (high, 0.5)},
    )


def duration_variance_statistics(durations: DataFrame) -> DataFrame:
    pct = F.col("duration_variance_pct")
    df = durations.where(pct.isNotNull()).select(pct.cast("double").alias("duration_variance_pct"))
    return agg_with_percentiles(
        df,
        [],
        [
            F.avg(pct).alias("avg_variance_pct"),
            _count_where(F.abs(pct) > 50, "significant_variances"),
            _count_where(pct > 0, "longer_than_expected"),
            _count_where(pct < 0, "shorter_than_expected"),
        ],
        {"median_variance_pct": ("duration_variance_pct", 0.5)},
    )


def summary_report(postings: DataFrame, durations: DataFrame, n: int = 10) -> dict[str, DataFrame]:
    return {
        "agency_breakdown": agency_breakdown(postings, n),
        "top_job_titles": top_titles(postings, n),
        "salary_statistics": salary_statistics(postings),
        "duration_variance_statistics": duration_variance_statistics(durations),
    }
