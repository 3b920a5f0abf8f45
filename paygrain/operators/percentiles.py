"""Exact, interpolated percentiles by radix selection.

Every group is first reduced to its distinct values with their counts, combined before the shuffle. The values
are cut by their leading bits (65,536 cuts between a power of two and the next). The counts of a group's
cuts give the cut that holds a wanted rank, and only the values of that cut are ordered. So no task
orders more of a group than its cuts, or the distinct values of one cut; there is one way for groups of
all sizes. Interpolation is that of the built-in ``percentile``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LEADING = 1 << 16


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    parts = [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def _cut(value: Column) -> Column:
    """A whole number that never falls as the value rises.

    With |v| = f * 2^e, it is made of e and the leading bits of f. Scaling by a power of two is exact, and a
    rounded logarithm still grows with the value, so that the order is right even where e is one off.
    """
    finite = ~F.isnan(value) & (F.abs(value) < float("inf"))
    size = F.when(finite & (value != 0), F.abs(value))
    exponent = F.floor(F.log2(size))
    lead = F.floor(size / F.pow(F.lit(2.0), exponent) * F.lit(float(_LEADING)))
    cut = (exponent + 1100) * F.lit(4 * _LEADING) + lead
    ends = F.when(F.isnan(value), F.lit(2)).when(value < 0, F.lit(-1)).otherwise(F.lit(1)) * F.lit(1 << 50)
    signed = F.when(value < 0, -cut).otherwise(cut)
    return F.when(~finite, ends).when(value == 0, F.lit(0)).otherwise(signed).cast("long")


def _ranked(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], fractions: Sequence[float]
) -> DataFrame:
    """``_column, n, rank, v`` of every group: the values at the ranks next to a fraction, from n values.

    All columns go through one pass. Nothing runs before the result is used.
    """
    keys, group = list(keys), [*keys, "_column"]
    pairs = [F.struct(F.lit(c).alias("_column"), F.col(c).cast("double").alias("v")) for c in values]
    counts = (
        df.select(*keys, F.inline(F.array(*pairs)))
        .where("v IS NOT NULL")
        .groupBy(*group, "v")
        .agg(F.count("*").alias("c"))
        .withColumn("cut", _cut(F.col("v")))
    )
    whole = Window.partitionBy(*group)
    so_far = whole.orderBy("cut").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cuts = (
        counts.groupBy(*group, "cut")
        .agg(F.sum("c").alias("n_cut"))
        .withColumn("end", F.sum("n_cut").over(so_far))
        .withColumn("n", F.sum("n_cut").over(whole))
    )
    places = [(F.col("n") - 1) * F.lit(float(f)) for f in fractions]
    ranks = F.array_distinct(F.array(*[f(p).cast("long") for p in places for f in (F.floor, F.ceil)]))
    wanted = (
        cuts.withColumn("ranks", F.filter(ranks, lambda r: (r < F.col("end")) & (r >= F.col("end") - F.col("n_cut"))))
        .where(F.size("ranks") > 0)
        .select(*group, "cut", "n", (F.col("end") - F.col("n_cut")).alias("base"), "ranks")
    )
    a, b = counts.alias("a"), wanted.alias("b")
    within = Window.partitionBy(*group, "cut").orderBy("v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        a.join(b, _same("a", "b", [*group, "cut"]))
        .select(*[F.col(f"a.{c}").alias(c) for c in [*group, "cut", "v", "c"]], "n", "base", "ranks")
        .withColumn("end", F.col("base") + F.sum("c").over(within))
        .withColumn("at", F.filter("ranks", lambda r: (r < F.col("end")) & (r >= F.col("end") - F.col("c"))))
        .select(*group, "n", F.explode("at").alias("rank"), "v")
    )


def _at(column: str, fraction: float) -> Column:
    """The percentile from the aggregates of :func:`_gathered`."""
    at, place = F.col(f"_at_{column}"), (F.col(f"_n_{column}") - 1) * F.lit(float(fraction))
    low, high = F.floor(place).cast("long"), F.ceil(place).cast("long")
    between = (high - place) * at[low] + (place - low) * at[high]
    return F.when((low == high) | (at[low] == at[high]), at[low]).otherwise(between)


def _gathered(values: Sequence[str]) -> list[Column]:
    """Number of values and map from rank to value of each column; two ranks a fraction at most."""
    out = []
    for c in values:
        mine = F.col("_column") == c
        out.append(F.max(F.when(mine, F.col("n"))).alias(f"_n_{c}"))
        ranks = F.collect_list(F.when(mine, F.struct("rank", "v")))
        out.append(F.map_from_entries(ranks).alias(f"_at_{c}"))
    return out


def percentiles_of(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], fractions: Sequence[float]
) -> DataFrame:
    """Keys and, per value column, an array ``<column>`` with a double per fraction; null without values."""
    found = _ranked(df, keys, values, fractions).groupBy(*keys).agg(*_gathered(values))
    present = {c: F.array(*[_at(c, f) for f in fractions]) for c in values}
    return found.select(
        *keys, *[F.when(F.col(f"_n_{c}").isNotNull(), p).alias(c) for c, p in present.items()]
    )


def agg_with_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    aggregates: Sequence[Column],
    percentiles: Mapping[str, tuple[str, float]],
) -> DataFrame:
    """``groupBy(keys).agg(...)`` plus exact percentiles ``{name: (column, fraction)}``.

    Without keys the result has exactly one row. A group without a value has null percentiles. The few ranked
    values of a group meet its other aggregates in one last grouping, not in a join.
    """
    keys = list(keys)
    result = df.groupBy(*keys).agg(*aggregates)
    names = [c for c in result.columns if c not in keys]
    columns = list(dict.fromkeys(c for c, _ in percentiles.values()))
    fractions = list(dict.fromkeys(f for _, f in percentiles.values()))
    ranked = _ranked(df, keys, columns, fractions)
    plain = result.select(*keys, F.struct(*names).alias("_plain"))
    whole = plain.unionByName(ranked, allowMissingColumns=True).groupBy(*keys)
    whole = whole.agg(F.first("_plain", ignorenulls=True).alias("_plain"), *_gathered(columns))
    return whole.select(
        *keys,
        *[F.col("_plain")[c].alias(c) for c in names],
        *[_at(c, f).alias(n) for n, (c, f) in percentiles.items()],
    )
