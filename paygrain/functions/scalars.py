"""Pay, duration and flag expressions (Column -> Column)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HOURS_PER_YEAR = 2080
DAYS_PER_YEAR = 260


def _or_zero(col: Column) -> Column:
    return F.coalesce(col, F.lit(0.0))


def annualize_salary(
    basis: Column,
    base: Column,
    gross: Column,
    overtime: Column,
    other: Column,
    hours_per_year: int = HOURS_PER_YEAR,
    days_per_year: int = DAYS_PER_YEAR,
    trim_basis: bool = False,
) -> Column:
    """Yearly pay; an unknown basis falls back to gross + overtime + other pay."""
    basis = F.trim(basis) if trim_basis else basis
    paid = gross + _or_zero(overtime) + _or_zero(other)
    return (
        F.when(basis == "per Annum", base)
        .when(basis == "per Hour", base * hours_per_year)
        .when(basis == "per Day", base * days_per_year)
        .otherwise(paid)
    )


def salary_range_width(low: Column, high: Column) -> Column:
    return high - low


def salary_midpoint(low: Column, high: Column) -> Column:
    return (low + high) / 2


def posting_end(start: Column, processed: Column, updated: Column, default_days: int = 30) -> Column:
    return F.coalesce(processed, updated, start + F.make_dt_interval(F.lit(default_days)))


def whole_days_between(start: Column, end: Column) -> Column:
    """Whole days toward zero; may be negative."""
    return F.extract(F.lit("DAY"), end - start).cast("int")


def is_active(status: Column, active: Sequence[str] = ("ACTIVE", "A")) -> Column:
    return F.coalesce(F.upper(status).isin(*active), F.lit(False))


def total_compensation(base: Column, overtime: Column, other: Column) -> Column:
    return _or_zero(base) + _or_zero(overtime) + _or_zero(other)


def estimated_hourly_rate(base: Column, hours: Column) -> Column:
    return F.when(hours > 0, F.try_divide(base, hours))


def _banded(value: Column, bounds: Sequence[tuple[int, str]], top: str) -> Column:
    chain = F
    for bound, label in bounds:
        chain = chain.when(value < bound, F.lit(label))
    return chain.otherwise(F.lit(top))


def salary_category(salary: Column, null_label: str | None = None) -> Column:
    """A null salary lands in the top category unless ``null_label`` is given."""
    label = _banded(salary, ((40000, "Low"), (70000, "Medium"), (100000, "High")), "Very High")
    return label if null_label is None else F.when(salary.isNull(), null_label).otherwise(label)


def salary_band(average: Column) -> Column:
    bounds = (
        (40000, "Entry Level"),
        (60000, "Mid Level"),
        (80000, "Senior Level"),
        (120000, "Manager Level"),
    )
    return _banded(average, bounds, "Executive Level")


def posting_intensity(postings: Column, duration: Column, default_days: int = 30) -> Column:
    """Postings per day; null for a duration of zero."""
    return F.try_divide(postings.cast("double"), F.coalesce(duration, F.lit(float(default_days))))


def acceptable_range(median: Column, low: float = 0.8, high: float = 1.2) -> tuple[Column, Column]:
    """Lower and upper bound of the pay that is usual for a median."""
    return median * low, median * high


def is_high_variance(variation: Column, threshold: float = 0.20) -> Column:
    return F.coalesce(variation > threshold, F.lit(False))


def match_ratio(
    same_agency: Column, same_title: Column, similarity: Column, floor: float = 0.8
) -> Column:
    return (
        F.when(same_agency & same_title, F.lit(1.0).cast("float"))
        .when(same_agency & (similarity > floor), similarity)
        .otherwise(F.lit(0.0).cast("float"))
    )


def benchmark_gate(ratio: Column, value: Column, threshold: float = 0.85) -> Column:
    return F.when(ratio >= threshold, value)


def salary_variance(midpoint: Column, median: Column) -> Column:
    return F.try_divide(midpoint.cast("double") - median.cast("double"), median.cast("double"))


def is_salary_outlier(variance: Column, threshold: float = 0.20) -> Column:
    return F.coalesce(F.abs(variance) > threshold, F.lit(False))


def flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def duration_variance(actual: Column, expected: Column) -> Column:
    return actual - expected


def duration_variance_pct(actual: Column, expected: Column) -> Column:
    return F.when(expected > 0, F.try_divide(actual - expected, expected) * 100)


def pct_complete(col: Column) -> Column:
    """Aggregate: share of non-null values in percent; null for no rows."""
    return F.try_divide(F.count(col), F.count(F.lit(1))) * 100
