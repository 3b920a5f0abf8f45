"""Job postings: year filter, duration, match key and the best payroll match."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paygrain.functions import scalars, text
from paygrain.functions.columns import (
    filter_year_text,
    lenient_timestamp,
    select_available,
    typed_nulls,
    with_missing,
)
from paygrain.operators.payroll import salary_lookup
from paygrain.operators.percentiles import agg_with_percentiles
from paygrain.operators.similarity import attach_best_match
from paygrain.session import materialize
from paygrain.sources.schemas import POSTINGS_OUTPUT, RAW_POSTINGS

MATCH_THRESHOLD = 0.85
MATCH_TYPES = {
    "best_payroll_match": "string",
    "best_match_score": "double",
    "payroll_salary_min": "double",
    "payroll_salary_max": "double",
}


def with_posting_dates(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "posting_start": lenient_timestamp(F.col("posting_date")),
            "posting_end": lenient_timestamp(F.col("process_date")),
            "posting_updated_parsed": lenient_timestamp(F.col("posting_updated")),
        }
    )


def with_posting_duration(df: DataFrame) -> DataFrame:
    end = scalars.posting_end(
        F.col("posting_start"), F.col("posting_end"), F.col("posting_updated_parsed")
    )
    return df.withColumn("calculated_end_date", end).withColumn(
        "posting_duration_days",
        scalars.whole_days_between(F.col("posting_start"), F.col("calculated_end_date")),
    )


def prepare_postings(raw: DataFrame, years: Sequence[int] = (2024, 2025)) -> DataFrame:
    """All narrow steps: selection, dates, year filter, duration and match key."""
    df, _ = select_available(raw, RAW_POSTINGS)
    df = filter_year_text(with_missing(df, RAW_POSTINGS), "posting_date", years)
    df = with_posting_dates(df).where(F.col("posting_start").isNotNull())
    key = text.match_key(F.col("agency"), F.col("business_title"))
    return with_posting_duration(df).withColumn("fuzzy_match_string", key)


def match_payroll(
    df: DataFrame, payroll: DataFrame | None, threshold: float = MATCH_THRESHOLD
) -> DataFrame:
    """Best payroll key per posting with its mean salary range; nulls without payroll data."""
    if payroll is None:
        return typed_nulls(df, MATCH_TYPES)
    lookup = materialize(salary_lookup(payroll), "payroll-lookup")
    matched = attach_best_match(
        df, F.col("fuzzy_match_string"), lookup, threshold, "payroll-match"
    )
    return matched.withColumnsRenamed({"match": "best_payroll_match", "score": "best_match_score"})


def build_postings(
    raw: DataFrame,
    payroll: DataFrame | None,
    years: Sequence[int] = (2024, 2025),
    threshold: float = MATCH_THRESHOLD,
) -> DataFrame:
    """Processed postings, 20 columns (those of the source that exist)."""
    df = match_payroll(prepare_postings(raw, years), payroll, threshold)
    dropped = set(RAW_POSTINGS) - set(raw.columns)
    return df.select([c for c in POSTINGS_OUTPUT if c not in dropped])


def duration_stats(df: DataFrame) -> DataFrame:
    days = "posting_duration_days"
    return agg_with_percentiles(
        df,
        [],
        [
            F.avg(days).alias("avg_duration"),
            F.min(days).alias("min_duration"),
            F.max(days).alias("max_duration"),
            F.count_if(F.col("posting_end").isNull()).alias("null_process_dates"),
        ],
        {"median_duration": (days, 0.5)},
    )


def payroll_match_stats(df: DataFrame) -> DataFrame:
    """``total_jobs`` counts matched rows only; ``n_rows`` is the number of rows."""
    score = "best_match_score"
    return agg_with_percentiles(
        df,
        [],
        [
            F.avg(score).alias("avg_match_score"),
            F.count(score).alias("high_quality_matches_85_plus"),
            F.count(score).alias("total_jobs"),
            F.count("payroll_salary_min").alias("jobs_with_payroll_salary"),
            F.count(F.lit(1)).alias("n_rows"),
        ],
        {"median_match_score": (score, 0.5)},
    )
