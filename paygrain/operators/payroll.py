"""Payroll: yearly pay, role salary ranges and match keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paygrain.functions import scalars, text
from paygrain.functions.columns import lenient_numeric, select_available, with_missing
from paygrain.sources.schemas import PAYROLL_OUTPUT, RAW_PAYROLL

ROLE = ("agency_name", "title_description")
RANGE_COLUMNS = ["salary_min", "salary_max", "salary_range_width", "employee_count_in_role"]


def standardize_annual_salary(df: DataFrame) -> DataFrame:
    """Numeric copies (``*_num``) of the text amounts and the yearly pay."""
    df = df.withColumns(
        {
            "base_salary_num": lenient_numeric(F.col("base_salary")),
            "regular_gross_num": lenient_numeric(F.col("regular_gross_paid")),
            "total_ot_num": lenient_numeric(F.col("total_ot_paid")),
            "total_other_num": lenient_numeric(F.col("total_other_pay")),
            "regular_hours_num": lenient_numeric(F.col("regular_hours")),
        }
    )
    pay = scalars.annualize_salary(
        F.col("pay_basis"),
        F.col("base_salary_num"),
        F.col("regular_gross_num"),
        F.col("total_ot_num"),
        F.col("total_other_num"),
    )
    return df.withColumn("annual_salary_standardized", pay)


def role_table(df: DataFrame) -> DataFrame:
    """One row per role: its range (null if a part of the role is null) and its number of rows."""
    stats = role_salary_range(df, more=[F.count(F.lit(1)).alias("n_rows")])
    whole = F.col(ROLE[0]).isNotNull() & F.col(ROLE[1]).isNotNull()
    width = scalars.salary_range_width(F.col("salary_min"), F.col("salary_max"))
    stats = stats.withColumn("salary_range_width", width)
    return stats.select(*ROLE, *[F.when(whole, F.col(c)).alias(c) for c in RANGE_COLUMNS], "n_rows")


def role_salary_range(
    df: DataFrame, keys: Sequence[str] = ROLE, more: Sequence[Column] = ()
) -> DataFrame:
    """Lowest, highest and non-null number of base salaries per role."""
    return df.groupBy(*keys).agg(
        F.min("base_salary_num").alias("salary_min"),
        F.max("base_salary_num").alias("salary_max"),
        F.count("base_salary_num").alias("employee_count_in_role"),
        *more,
    )


def attach_group_stats(df: DataFrame, stats: DataFrame, keys: Sequence[str] = ROLE) -> DataFrame:
    """Left equi-join of the group rows back to the rows; null keys get null statistics.

    Pass a stored table: its size is then known, and the rows are joined map-side whenever it is small
    enough to broadcast, and shuffled (with skewed keys split) only if it is not.
    """
    return df.join(stats.dropna(subset=list(keys)), list(keys), "left")


def with_role_range(df: DataFrame, ranges: DataFrame | None = None) -> DataFrame:
    """``ranges``: the stored result of :func:`role_salary_range`; computed in the plan if absent."""
    df = attach_group_stats(df, role_salary_range(df) if ranges is None else ranges)
    width = scalars.salary_range_width(F.col("salary_min"), F.col("salary_max"))
    return df.withColumn("salary_range_width", width)


def prepare_payroll(raw: DataFrame) -> DataFrame:
    """The source columns and the yearly pay; an ``ord`` column (row order) stays."""
    selected, _ = select_available(raw, RAW_PAYROLL)
    if "ord" in raw.columns:
        selected = raw.select(*selected.columns, "ord")
    return standardize_annual_salary(with_missing(selected, RAW_PAYROLL))


def build_payroll(raw: DataFrame, ranges: DataFrame | None = None) -> DataFrame:
    """Processed payroll, 15 columns, and ``ord`` if the source has it."""
    df = with_role_range(prepare_payroll(raw), ranges)
    key = text.match_key(F.col("agency_name"), F.col("title_description"))
    df = df.withColumn("fuzzy_match_string", key)
    dropped = set(RAW_PAYROLL) - set(raw.columns)
    kept = [c for c in PAYROLL_OUTPUT if c not in dropped]
    return df.select(*kept, *(["ord"] if "ord" in raw.columns else []))


def salary_range_stats(df: DataFrame) -> DataFrame:
    """Means over rows, from rows with their role's range or from :func:`role_table`."""
    weight = F.col("n_rows") if "n_rows" in df.columns else F.lit(1)

    def mean(column: str) -> Column:
        present = F.when(F.col(column).isNotNull(), weight)
        return F.try_divide(F.sum(F.col(column).cast("double") * weight), F.sum(present))

    positive = F.sum(F.when(F.col("salary_range_width") > 0, weight))
    return df.agg(
        mean("salary_min").alias("avg_min_salary"),
        mean("salary_max").alias("avg_max_salary"),
        mean("salary_range_width").alias("avg_range_width"),
        F.coalesce(positive, F.lit(0)).cast("long").alias("positions_with_salary_range"),
        mean("employee_count_in_role").alias("avg_employees_per_role"),
    )


def top_ranges(df: DataFrame, n: int = 5, nulls_first: bool = True) -> DataFrame:
    """Distinct roles (of rows, or of :func:`role_table`) with the widest range; a role without a range sorts first, as an unknown
    width does in the descending sort this reproduces. Ties go by the role."""
    width = F.col("salary_range_width")
    order = width.desc_nulls_first() if nulls_first else width.desc_nulls_last()
    return df.select(*ROLE, *RANGE_COLUMNS).distinct().orderBy(order, *ROLE).limit(n)


def distinct_sample(df: DataFrame, n: int = 10) -> DataFrame:
    """Some distinct roles, the first ones in order, so that the result is repeatable."""
    columns = [*ROLE, *RANGE_COLUMNS]
    return df.select(*columns).distinct().orderBy(*columns).limit(n)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def salary_lookup(payroll: DataFrame) -> DataFrame:
    """Row-weighted mean salary range per match key: ``key, ord, payroll_salary_min/max``.

    The rows are summed up per role first, because the key is a function of the role and costs
    several regular expressions. ``ord`` decides ties of the match: the first appearance if the
    input has an ``ord`` column, else the smallest key.
    """
    ordered = [F.min("ord").alias("ord")] if "ord" in payroll.columns else []
    low, high = F.col("salary_min"), F.col("salary_max")
    roles = (
        payroll.where(low.isNotNull() & high.isNotNull())
        .groupBy(*ROLE)
        .agg(F.sum(low).alias("low"), F.sum(high).alias("high"), F.count(low).alias("n"), *ordered)
    )
    key = text.match_key(*map(F.col, ROLE))
    lookup = (
        roles.withColumn("key", key)
        .where(F.length("key") > 0)
        .groupBy("key")
        .agg(
            (F.sum("low") / F.sum("n")).alias("payroll_salary_min"),
            (F.sum("high") / F.sum("n")).alias("payroll_salary_max"),
            *ordered,
        )
    )
    return lookup if ordered else lookup.withColumn("ord", F.col("key"))
