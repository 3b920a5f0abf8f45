"""Occupational benchmark: clean-up, derived columns and the posting-duration data set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paygrain.functions import scalars, text
from paygrain.functions.columns import cast_by_name_pattern, standardize_columns, typed_nulls
from paygrain.operators.percentiles import agg_with_percentiles
from paygrain.operators.similarity import attach_best_match
from paygrain.session import materialize

MATCH_THRESHOLD = 0.7
# Benchmark attributes that a matched posting carries, and their types.
ATTRIBUTES = {
    "lighthouse_median_posting_duration": "double",
    "lighthouse_total_postings": "int",
    "lighthouse_median_salary": "double",
    "lighthouse_top_skills": "string",
    "lighthouse_education_requirements": "string",
    "lighthouse_experience_level": "string",
    "lighthouse_salary_category": "string",
    "lighthouse_posting_intensity": "double",
}
REQUIRED_POSTING = ("business_title", "posting_duration_days")
REQUIRED_BENCHMARK = ("lighthouse_job_title", "lighthouse_median_posting_duration")


def with_analysis_columns(df: DataFrame) -> DataFrame:
    """Derived columns, each only if its inputs exist."""
    have, new = set(df.columns), {}
    if {"lighthouse_total_postings", "lighthouse_median_posting_duration"} <= have:
        new["lighthouse_posting_intensity"] = scalars.posting_intensity(
            F.col("lighthouse_total_postings"), F.col("lighthouse_median_posting_duration")
        )
    if "lighthouse_median_salary" in have:
        new["lighthouse_salary_category"] = scalars.salary_category(
            F.col("lighthouse_median_salary")
        )
    if "lighthouse_job_title" in have:
        new["lighthouse_fuzzy_match_string"] = text.title_key_regex(F.col("lighthouse_job_title"))
    return df.withColumns(new) if new else df


def build_benchmark(raw: DataFrame) -> DataFrame:
    return with_analysis_columns(cast_by_name_pattern(standardize_columns(raw)))


def title_lookup(benchmark: DataFrame, order: str | None = None) -> DataFrame:
    """One row per cleaned title: ``key, ord, lighthouse_match_title`` and the attributes.

    With an ``order`` column the last row of a title gives the attributes and its first
    appearance the position; without one the largest row and the key itself stand in.
    """
    title = F.col("lighthouse_job_title")
    df = typed_nulls(benchmark, {c: t for c, t in ATTRIBUTES.items() if c not in benchmark.columns})
    row = F.struct(title.alias("lighthouse_match_title"), *ATTRIBUTES)
    df = df.where(F.length(title) > 0).select(
        text.title_key_alnum(title).alias("key"),
        row.alias("row"),
        *([F.col(order).alias("position")] if order else []),
    )
    last = F.max_by("row", "position") if order else F.max("row")
    first = [F.min("position").alias("ord")] if order else []
    lookup = df.groupBy("key").agg(last.alias("row"), *first)
    return lookup.select("key", F.col("ord" if order else "key").alias("ord"), "row.*")


def match_benchmark(
    postings: DataFrame,
    benchmark: DataFrame,
    threshold: float = MATCH_THRESHOLD,
    order: str | None = None,
) -> DataFrame | None:
    """Postings with their best benchmark title, its attributes and the duration variance.

    ``None`` if a required column is missing.
    """
    if not set(REQUIRED_POSTING) <= set(postings.columns):
        return None
    if not set(REQUIRED_BENCHMARK) <= set(benchmark.columns):
        return None
    lookup = materialize(title_lookup(benchmark, order), "title-lookup")
    key = text.title_key_alnum(F.col("business_title"))
    df = attach_best_match(postings, key, lookup, threshold, "title-match").drop("match")
    actual, expected = (
        F.col("posting_duration_days"),
        F.col("lighthouse_median_posting_duration"),
    )
    return df.withColumnRenamed("score", "lighthouse_match_score").select(
        *postings.columns,
        "lighthouse_match_title",
        "lighthouse_match_score",
        *ATTRIBUTES,
        scalars.duration_variance(actual, expected).alias("duration_variance"),
        scalars.duration_variance_pct(actual, expected).alias("duration_variance_pct"),
    )


def benchmark_match_stats(df: DataFrame) -> DataFrame:
    """``total_jobs`` counts matched rows only; ``n_rows`` is the number of rows."""
    score = "lighthouse_match_score"
    return agg_with_percentiles(
        df,
        [],
        [
            F.count(score).alias("total_jobs"),
            F.count(score).alias("jobs_with_lighthouse_match"),
            F.avg(score).alias("avg_match_score"),
            F.count_if(F.col(score) >= 0.8).alias("high_quality_matches_80_plus"),
            F.avg("duration_variance").alias("avg_duration_variance_days"),
            F.avg("duration_variance_pct").alias("avg_duration_variance_pct"),
            F.count(F.lit(1)).alias("n_rows"),
        ],
        {"median_match_score": (score, 0.5)},
    )


def n_unique(df: DataFrame, column: str) -> DataFrame:
    """One row ``n``: the number of distinct values; null counts as one."""
    return df.select(column).distinct().agg(F.count(F.lit(1)).alias("n"))
