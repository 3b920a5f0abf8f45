"""Projection, lenient casts and filters."""

from __future__ import annotations

import datetime as dt
import re
import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paygrain.sources.schemas import BENCHMARK_NAMES

_ISO_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?$"


# ---- projection -----------------------------------------------------------------------------


def select_available(df: DataFrame, wanted: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Keep the wanted columns that exist; return the names that do not."""
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        warnings.warn(f"missing columns: {missing}", stacklevel=2)
    return df.select([c for c in wanted if c in df.columns]), missing


def with_missing(df: DataFrame, wanted: Sequence[str], data_type: str = "string") -> DataFrame:
    """Add the absent columns as typed nulls."""
    absent = {c: F.lit(None).cast(data_type) for c in wanted if c not in df.columns}
    return df.withColumns(absent) if absent else df


def typed_nulls(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: F.lit(None).cast(t) for c, t in types.items()})


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def stamp(as_of: dt.datetime | None) -> Column:
    """The given or the current time without zone; independent of the zone of the session."""
    if as_of is None:
        return F.localtimestamp()
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def load_stamps(df: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    now = stamp(as_of)
    return df.withColumns({"dbt_loaded_at": now, "dbt_valid_from": now.cast("date")})


# ---- column names that are data -------------------------------------------------------------

def standard_name(raw: str, names: Mapping[str, str], prefix: str) -> str:
    """The standard name of a raw column name.

    ``names`` is tried with the name as it is and in plain form: lower case, each blank or hyphen inside an
    underscore, and nothing else but letters, digits and underscores. A plain name that is not known
    gets the prefix, once.
    """
    plain = re.sub(r"[ -]", "_", raw.strip().lower())
    plain = re.sub(r"\W", "", plain)
    known = names.get(raw, names.get(plain))
    if known is not None:
        return known
    return plain if plain.startswith(prefix) else f"{prefix}{plain}"


def standardize_columns(
    df: DataFrame,
    names: Mapping[str, str] = BENCHMARK_NAMES,
    prefix: str = "lighthouse_",
) -> DataFrame:
    """Rename by exact name, then by tidied name, else prefix the tidied name."""
    new = [standard_name(c, names, prefix) for c in df.columns]
    clashes = sorted({n for n in new if new.count(n) > 1})
    if clashes:
        raise ValueError(f"several columns map to the same name: {clashes}")
    return df.toDF(*new)


def type_for_name(name: str) -> str | None:
    low = name.lower()
    if "posting" in low and "duration" not in low:
        return "int"
    if "salary" in low or "duration" in low:
        return "double"
    return "timestamp_ntz" if low.endswith("_date") else None


def cast_by_name_pattern(df: DataFrame) -> DataFrame:
    """Type the columns by their names; values that do not parse become null."""
    casts = {}
    for name in df.columns:
        target = type_for_name(name)
        if target == "int":
            casts[name] = F.col(f"`{name}`").try_cast("double").try_cast("int")
        elif target == "timestamp_ntz":
            casts[name] = lenient_timestamp(F.col(f"`{name}`"))
        elif target:
            casts[name] = F.col(f"`{name}`").try_cast(target)
    return df.withColumns(casts) if casts else df


# ---- casts ----------------------------------------------------------------------------------


def lenient_numeric(col: Column) -> Column:
    return col.try_cast("double")


def lenient_timestamp(col: Column) -> Column:
    """ISO text with an optional fraction; everything else (also a bare date) becomes null."""
    text = col.cast("string")
    return F.when(text.rlike(_ISO_TIMESTAMP), text.try_cast("timestamp_ntz"))


def safe_cast(col: Column, data_type: str) -> Column:
    return col.try_cast(data_type)


def strict_cast(col: Column, data_type: str) -> Column:
    """Raises on bad input under ANSI mode."""
    return col.cast(data_type)


def money(col: Column, precision: int = 10, scale: int = 2) -> Column:
    """Decimal with half-up rounding, rounded at six digits first so that a binary half cent
    falls on the same side in every engine; null on overflow."""
    return col.cast("double").try_cast("decimal(24,6)").try_cast(f"decimal({precision},{scale})")


# ---- filters --------------------------------------------------------------------------------


def _year_runs(years: Sequence[int]) -> list[tuple[int, int]]:
    """Consecutive years as (first, one after the last)."""
    runs: list[tuple[int, int]] = []
    for year in sorted(set(years)):
        if runs and runs[-1][1] == year:
            runs[-1] = (runs[-1][0], year + 1)
        else:
            runs.append((year, year + 1))
    return runs


def filter_years(df: DataFrame, timestamp: str, years: Sequence[int] = (2024, 2025)) -> DataFrame:
    """Keep the years; written as ranges so that partitions and row groups can be skipped."""
    col, keep = F.col(timestamp), F.lit(False)
    for first, end in _year_runs(years):
        low, high = (F.lit(f"{y:04d}-01-01").cast("timestamp_ntz") for y in (first, end))
        keep = keep | ((col >= low) & (col < high))
    return df.where(keep)


def filter_year_text(df: DataFrame, iso_text: str, years: Sequence[int]) -> DataFrame:
    """The same on ISO text, which sorts like the dates: a range of strings that the scan can use.

    Text that is no timestamp may stay and has to fail the cast afterwards. A typed column is
    filtered by :func:`filter_years`.
    """
    if not isinstance(df.schema[iso_text].dataType, T.StringType):
        return filter_years(df, iso_text, years)
    col, keep = F.col(iso_text), F.lit(False)
    for first, end in _year_runs(years):
        keep = keep | ((col >= f"{first:04d}-") & (col < f"{end:04d}-"))
    return df.where(keep)


def require_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def filter_date_range(df: DataFrame, timestamp: str, start: str, end: str) -> DataFrame:
    """Both ends inclusive; the end is midnight, so later times of that day fall out."""
    low, high = (F.lit(x).cast("timestamp_ntz") for x in (start, end))
    return df.where((F.col(timestamp) >= low) & (F.col(timestamp) <= high))


def active_paid_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("is_active_employee") & (F.col("base_salary") > 0))


def benchmarks_for_year(df: DataFrame, year: int) -> DataFrame:
    return df.where(F.col("fiscal_year") == year)


def high_quality_payroll_matches(df: DataFrame, threshold: float = 0.85) -> DataFrame:
    return df.where(
        (F.col("best_match_score") >= threshold)
        & F.col("payroll_salary_min").isNotNull()
        & F.col("payroll_salary_max").isNotNull()
    )


def benchmark_matches(df: DataFrame, threshold: float = 0.7) -> DataFrame:
    return df.where(F.col("lighthouse_match_score") >= threshold)


def matched_only(df: DataFrame, score: str = "best_match_score") -> DataFrame:
    return df.where(F.col(score).isNotNull())


def rule_conditions(max_days: int = 365) -> dict[str, Column]:
    return {
        "from_gt_to": F.col("salary_range_from") > F.col("salary_range_to"),
        "negative_durations": F.col("posting_duration_days") < 0,
        "excessive_durations": F.col("posting_duration_days") > max_days,
    }


def rule_violations(df: DataFrame, max_days: int = 365) -> DataFrame:
    hit = F.lit(False)
    for condition in rule_conditions(max_days).values():
        hit = hit | condition
    return df.where(hit)


def non_positive_to_null(col: Column) -> Column:
    return F.when(col > 0, col)


def negative_to_null(col: Column) -> Column:
    return F.when(col >= 0, col)


def negative_to_zero(col: Column) -> Column:
    """Also turns null into zero."""
    return F.when(col >= 0, col).otherwise(F.lit(0.0))
