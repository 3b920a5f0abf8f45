"""Column checks and gates."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paygrain.operators.reports import orphans, quality_row

CHECK_SCHEMA = "check string, column string, failed_rows bigint, passed boolean"


class QualityGateError(Exception):
    """Raised with all reasons that stop the run."""


@dataclass
class TableChecks:
    unique: Sequence[str] = ()
    not_null: Sequence[str] = ()
    accepted_range: Mapping[str, tuple[float, float]] = field(default_factory=dict)


# Checks of the three models.
MODEL_CHECKS = {
    "stg_job_postings": TableChecks(
        unique=["job_id"],
        not_null=["job_id", "agency_name", "posting_date"],
        accepted_range={"salary_range_from": (0, 500_000), "salary_range_to": (0, 500_000)},
    ),
    "stg_payroll_data": TableChecks(
        not_null=["payroll_number", "agency_name"], accepted_range={"base_salary": (0, 1_000_000)}
    ),
    "mart_job_posting_analysis": TableChecks(
        unique=["job_id"], not_null=["job_id"], accepted_range={"salary_match_ratio": (0, 1)}
    ),
}


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count; nulls are not compared."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.where("n > 1")


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def check_accepted_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Values outside the inclusive bounds; null passes."""
    return df.where(~F.col(column).between(low, high))


def check_widths(df: DataFrame, widths: Mapping[str, int]) -> DataFrame:
    """(check, column, failed_rows, passed): texts longer than the declared width of their column."""
    long = [F.count_if(F.length(c) > w).alias(c) for c, w in widths.items()]
    return _as_checks(df.agg(*long), {c: ("max_length", c) for c in widths})


def _as_checks(row: DataFrame, names: Mapping[str, tuple[str, str]]) -> DataFrame:
    """One row of failure counts -> (check, column, failed_rows, passed)."""
    items = [
        F.struct(
            F.lit(check).alias("check"),
            F.lit(column).alias("column"),
            F.col(f"`{alias}`").cast("bigint").alias("failed_rows"),
            (F.col(f"`{alias}`") == 0).alias("passed"),
        )
        for alias, (check, column) in names.items()
    ]
    return row.select(F.inline(F.array(*items)))


def run_checks(df: DataFrame, checks: TableChecks) -> DataFrame:
    """All checks of a table in one scan: (check, column, failed_rows, passed).

    Each row gives one entry that carries its failed row checks, and one with its value for each unique column. Entries
    are counted by (column, value), combined before the shuffle, and the counts are summed up once.
    """
    failed = {f"not_null.{c}": F.col(c).isNull() for c in checks.not_null}
    for c, (low, high) in checks.accepted_range.items():
        failed[f"accepted_range.{c}"] = ~F.col(c).between(low, high)
    names = {alias: tuple(alias.split(".", 1)) for alias in failed}
    names.update({f"unique.{c}": ("unique", c) for c in checks.unique})
    if not names:
        return df.sparkSession.createDataFrame([], CHECK_SCHEMA)

    def entry(column: str | None, value: Column) -> Column:
        own = [F.when(bad, 1).otherwise(0) if column is None else F.lit(0) for bad in failed.values()]
        marks = [n.cast("long").alias(f"f{i}") for i, n in enumerate(own)]
        return F.struct(F.lit(column).cast("string").alias("column"), value.cast("string").alias("value"), *marks)

    entries = [entry(None, F.lit(None)), *[entry(c, F.col(c)) for c in checks.unique]]
    sums = [F.sum(f"f{i}").alias(f"f{i}") for i in range(len(failed))]
    counts = df.select(F.inline(F.array(*entries))).where("column IS NULL OR value IS NOT NULL")
    counts = counts.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"), *sums)
    repeated = [F.count_if((F.col("column") == c) & (F.col("n") > 1)).alias(f"unique.{c}") for c in checks.unique]
    totals = [F.coalesce(F.sum(f"f{i}"), F.lit(0)).alias(alias) for i, alias in enumerate(failed)]
    return _as_checks(counts.agg(*totals, *repeated), names)


def model_checks(models: Mapping[str, DataFrame]) -> DataFrame:
    """(model, check, column, failed_rows, passed) of the declared checks of the given models."""
    parts = [
        run_checks(df, MODEL_CHECKS[name]).select(F.lit(name).alias("model"), "*")
        for name, df in models.items()
        if name in MODEL_CHECKS
    ]
    return reduce(DataFrame.unionByName, parts)


def model_gate(checks: DataFrame) -> None:
    """Raise with every check of :func:`model_checks` that failed, a row each."""
    failed = checks.where("NOT passed").collect()
    if failed:
        reasons = [f"{r.model}: {r.check} {r.column} ({r.failed_rows} rows)" for r in sorted(failed)]
        raise QualityGateError("; ".join(reasons))


def rate_checks(
    df: DataFrame, columns: Sequence[str], max_null: float = 0.05, max_duplicate: float = 0.01
) -> DataFrame:
    """Share of nulls and of surplus copies per column against the limits, all in one scan and two sums."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    per_value = df.select(F.inline(pairs)).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    present = F.when(F.col("value").isNotNull(), F.col("n"))
    sums = per_value.groupBy("column").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.coalesce(F.sum(present - 1), F.lit(0)).alias("duplicates"),
    )
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    result = names.join(sums, "column", "left").select(
        "column",
        F.try_divide("nulls", "rows").alias("null_rate"),
        F.try_divide("duplicates", "rows").alias("duplicate_rate"),
    )
    return result.withColumns(
        {
            "null_rate_passed": F.coalesce(F.col("null_rate") <= max_null, F.lit(True)),
            "duplicate_rate_passed": F.coalesce(
                F.col("duplicate_rate") <= max_duplicate, F.lit(True)
            ),
        }
    )


def check_primary_key(df: DataFrame, column: str = "job_id") -> DataFrame:
    return run_checks(df, TableChecks(unique=[column], not_null=[column]))


def check_foreign_key(child: DataFrame, parent: DataFrame, key: str = "job_id") -> DataFrame:
    """A null reference passes a foreign key."""
    row = orphans(child.where(F.col(key).isNotNull()), parent, key).agg(
        F.count(F.lit(1)).alias("failed")
    )
    return _as_checks(row, {"failed": ("foreign_key", key)})


def critical_gate(
    postings: DataFrame,
    durations: DataFrame,
    min_complete: float = 95.0,
    orphans_fatal: bool = True,
) -> dict[str, float]:
    """Evaluate the quality metrics (one row) and raise with every critical reason."""
    metrics = quality_row(postings, durations).first().asDict()
    found = metrics["orphaned_duration_records"]
    if metrics["total_job_postings"] == 0:
        raise QualityGateError("no job postings")
    reasons = []
    for column in ("agency", "title"):
        share = metrics[f"{column}_completeness_pct"]
        if share < min_complete:
            reasons.append(f"{column} completeness {share:.1f}% below {min_complete}%")
    if found and orphans_fatal:
        reasons.append(f"{found} orphaned duration records")
    elif found:
        warnings.warn(f"{found} orphaned duration records", stacklevel=2)
    if reasons:
        raise QualityGateError("; ".join(reasons))
    return metrics


def load_gate(postings: DataFrame, durations: DataFrame) -> int:
    """Raise if either fact is empty; orphans only warn. Returns the number of orphans."""
    empty = [n for n, df in (("job postings", postings), ("durations", durations)) if df.isEmpty()]
    if empty:
        raise QualityGateError("no records: " + ", ".join(empty))
    found = orphans(durations, postings).count()
    if found:
        warnings.warn(f"{found} orphaned duration records", stacklevel=2)
    return found


def empty_stage_gate(df: DataFrame | None, stage: str) -> DataFrame:
    if df is None or df.isEmpty():
        raise QualityGateError(f"{stage}: no rows")
    return df
