"""The whole analysis as one job."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paygrain.functions import text
from paygrain.functions.columns import standard_name
from paygrain.operators import benchmark, facts, marts, payroll, postings, quality, reports
from paygrain.operators.percentiles import agg_with_percentiles
from paygrain.session import materialize
from paygrain.sources import snapshots
from paygrain.sources.schemas import BENCHMARK_NAMES, FACT_POSTINGS, PAYROLL_SCHEMA, POSTINGS_SCHEMA


PAYROLL_SOURCE, POSTINGS_SOURCE, BENCHMARK_SOURCE = "raw_payroll", "raw_postings", "raw_benchmark"


def _means(*columns: str) -> list[Column]:
    return [F.avg(F.col(c).cast("double")).alias(f"avg_{c}") for c in columns]


def _statistics(name: str, columns: Sequence[str]) -> list[Column]:
    """Aggregates of a stage that its writing job takes along."""
    if name == "payroll_processed":
        return [
            *_means("salary_min", "salary_max", "salary_range_width", "employee_count_in_role"),
            F.count_if(F.col("salary_range_width") > 0).alias("positions_with_salary_range"),
        ]
    if name == "jobs_processed":
        return [
            *_means("posting_duration_days", "best_match_score"),
            F.min("posting_duration_days").alias("min_duration"),
            F.max("posting_duration_days").alias("max_duration"),
            F.count("best_match_score").alias("matched_rows"),
            F.count("payroll_salary_min").alias("jobs_with_payroll_salary"),
        ]
    if name == "benchmark_processed" and {*benchmark.ATTRIBUTES, "lighthouse_job_title"} <= set(columns):
        return [
            *_means("lighthouse_total_postings", "lighthouse_median_salary", "lighthouse_posting_intensity"),
            F.sum("lighthouse_total_postings").alias("total_postings"),
            F.count("lighthouse_job_title").alias("titles"),
        ]
    if name == "jobs_benchmark_matched":
        return [
            *_means("lighthouse_match_score", "duration_variance", "duration_variance_pct"),
            F.count("lighthouse_match_score").alias("matched_rows"),
            F.count_if(F.col("lighthouse_match_score") >= 0.8).alias("high_quality_matches_80_plus"),
        ]
    return []


# Medians that the run records of a stage have, by their source column.
_MEDIANS = {
    "jobs_processed": {
        "median_duration": "posting_duration_days", "median_match_score": "best_match_score",
    },
    "benchmark_processed": {
        "median_salary": "lighthouse_median_salary", "median_posting_duration": "lighthouse_median_posting_duration",
    },
    "jobs_benchmark_matched": {"median_match_score": "lighthouse_match_score"},
}


def _medians(stored: DataFrame, name: str) -> dict[str, float | None]:
    """Exact medians of a stored stage, from two or three of its columns."""
    wanted = {m: (c, 0.5) for m, c in _MEDIANS.get(name, {}).items() if c in stored.columns}
    if not wanted:
        return {}
    row = agg_with_percentiles(stored, [], [F.count(F.lit(1)).alias("n")], wanted).first()
    return {m: row[m] for m in wanted}


class _Store:
    """Writes stage results as snapshots under ``root``, else to the scratch area."""

    def __init__(self, spark: SparkSession, root: str | None, as_of: dt.datetime):
        self.spark, self.root, self.as_of = spark, root, as_of
        self.kept: dict[int, tuple[DataFrame, int]] = {}  # stages stored here and their rows

    def rows_of(self, source: DataFrame) -> int:
        """Rows that a stage gets, counted apart from its scan, which can then push its filters down.

        Those of a stored stage are known. For others a count without columns is made, which Parquet answers
        from the footers; JSON lines are read once more.
        """
        known = self.kept.get(id(source))
        return known[1] if known else source.count()

    def counted(self, source: DataFrame, parts: DataFrame) -> None:
        """The rows of a source are those of its stored ``parts``, by their column ``n_rows``."""
        self.kept[id(source)] = source, parts.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]

    def keep(
        self,
        build: Callable[[DataFrame], DataFrame | None],
        source: DataFrame,
        name: str,
        steps: Sequence[str],
        thresholds: dict | None = None,
    ) -> DataFrame | None:
        """Store ``build(source)``; the run record has the rows of the source, and the rows written with the
        statistics of the stage, which the writing job counts."""
        df = build(source)
        if df is None or self.root is None:
            return None if df is None else materialize(df, name)
        path = snapshots.snapshot_path(self.root, name, self.as_of)
        measures = _statistics(name, df.columns)
        counted = snapshots.write_snapshot(df, self.root, name, self.as_of, measures=measures)
        rows = counted.pop("rows")
        stored = self.spark.read.schema(df.schema).parquet(path)
        snapshots.record_run(
            self.spark, self.root, name, self.rows_of(source), rows, df.columns, steps, self.as_of,
            thresholds, {**counted, **_medians(stored, name)},
        )
        self.kept[id(stored)] = stored, rows
        return stored


def run_audit(
    raw_payroll: DataFrame,
    raw_postings: DataFrame,
    raw_benchmark: DataFrame,
    as_of: dt.datetime,
    years: Sequence[int] = (2024, 2025),
    payroll_threshold: float = postings.MATCH_THRESHOLD,
    benchmark_threshold: float = benchmark.MATCH_THRESHOLD,
    root: str | None = None,
    gates: bool = True,
    order: str | None = None,
    tables: tuple[str, str] | None = None,
    table_path: str | None = None,
    register: bool = False,
    processed_payroll: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Process the three sources, match them, build and load the facts, views and reports.

    Every stage that more than one later stage reads is stored once (as a snapshot with a run
    record if ``root`` is given). With ``gates`` an empty stage or a failed quality gate raises. ``order``
    names a column of payroll and benchmark that gives the order of their rows: the first key wins a
    tie of the match, the last row of a title its attributes. ``tables`` are the catalog tables (postings,
    durations) that the facts replace together, below ``table_path`` if given, once they have passed the load
    gate. ``register``
    makes the facts and views known to SQL. ``processed_payroll`` replaces the first stage.
    """
    spark = raw_postings.sparkSession
    store = _Store(spark, root, as_of)

    def stage(df: DataFrame | None, name: str) -> DataFrame:
        return quality.empty_stage_gate(df, name) if gates else df

    pay = processed_payroll
    if pay is None:
        ordered = raw_payroll.withColumnRenamed(order, "ord") if order else raw_payroll
        rows = [F.count(F.lit(1)).alias("n_rows")]
        ranges = payroll.role_salary_range(payroll.prepare_payroll(ordered), more=rows)
        ranges = materialize(ranges, "role-ranges")
        store.counted(ordered, ranges)
        ranges = ranges.drop("n_rows")
        pay = store.keep(
            lambda raw: payroll.build_payroll(raw, ranges),
            ordered,
            "payroll_processed",
            ["column_selection", "annual_salary", "role_salary_range", "match_key"],
        )
    pay = stage(pay, "payroll")
    jobs = store.keep(
        lambda raw: postings.build_postings(raw, pay, years, payroll_threshold),
        raw_postings,
        "jobs_processed",
        ["year_filter", "posting_duration", "match_key", "payroll_match"],
        {"match_threshold": payroll_threshold},
    )
    jobs = stage(jobs, "postings")
    bench = store.keep(
        benchmark.build_benchmark,
        raw_benchmark,
        "benchmark_processed",
        ["column_names", "data_types", "analysis_columns"],
    )
    bench = stage(bench, "benchmark")
    place = standard_name(order, BENCHMARK_NAMES, "lighthouse_") if order else None
    matched = store.keep(
        lambda df: benchmark.match_benchmark(df, bench, benchmark_threshold, place),
        jobs,
        "jobs_benchmark_matched",
        ["benchmark_match", "duration_variance"],
        {"match_threshold": benchmark_threshold},
    )
    matched = stage(matched, "duration")
    fact_postings = store.keep(
        lambda df: facts.conform_postings(df, as_of=as_of), jobs, "fact_postings", ["conform"]
    )
    fact_duration = store.keep(
        lambda df: facts.conform_duration(df, as_of=as_of), matched, "fact_duration", ["conform"]
    )
    if gates:
        quality.critical_gate(fact_postings, fact_duration)
    if tables:
        loads = dict(zip(tables, (fact_postings, fact_duration)))
        facts.load_facts(loads, table_path, quality.load_gate if gates else None)
    views = {
        "fact_postings": fact_postings,
        "fact_duration": fact_duration,
        "vw_high_quality_payroll_matches": reports.high_quality_payroll_view(fact_postings),
        "vw_posting_duration_analysis": reports.posting_duration_view(fact_duration, fact_postings),
        "vw_audit_summary_stats": reports.audit_summary(fact_postings, fact_duration),
    }
    if register:
        for name, df in views.items():
            df.createOrReplaceTempView(name)
    return {
        "payroll_processed": pay,
        "jobs_processed": jobs,
        "benchmark_processed": bench,
        "jobs_benchmark_matched": matched,
        **views,
        "quality_report": reports.quality_report(fact_postings, fact_duration),
        "width_checks": quality.check_widths(fact_postings, facts.declared_widths(FACT_POSTINGS)),
        **reports.summary_report(fact_postings, fact_duration),
    }


def run_audit_from(
    spark: SparkSession,
    root: str,
    as_of: dt.datetime,
    max_age_hours: float = 24,
    benchmark_max_age_hours: float = 48,
    limit: int | None = None,
    **options,
) -> dict[str, DataFrame]:
    """:func:`run_audit` from the landed snapshots below ``root``, which also gets the stages.

    Payroll and postings are JSON lines, the benchmark is a stored table; the newest committed snapshot of each
    is read. Processed payroll that is young enough at ``as_of`` is used as it is. A source without a
    snapshot, or a benchmark that is too old, raises. ``limit`` takes that many rows of payroll and of postings only, for
    trial runs; by default all are taken.
    """
    done = snapshots.recent_snapshot(spark, root, "payroll_processed", as_of, max_age_hours)
    found = {
        PAYROLL_SOURCE: snapshots.latest_snapshot(spark, root, PAYROLL_SOURCE, PAYROLL_SCHEMA),
        POSTINGS_SOURCE: snapshots.latest_snapshot(spark, root, POSTINGS_SOURCE, POSTINGS_SCHEMA),
        BENCHMARK_SOURCE: snapshots.recent_snapshot(
            spark, root, BENCHMARK_SOURCE, as_of, benchmark_max_age_hours
        ),
    }
    missing = [n for n, df in found.items() if df is None and not (done and n == PAYROLL_SOURCE)]
    if missing:
        raise FileNotFoundError(f"no snapshot of {', '.join(missing)} below {root}")
    raw = [None if df is None else df.drop("snapshot_ts") for df in found.values()]
    if limit is not None:
        raw[:2] = [None if df is None else snapshots.limit_rows(df, limit) for df in raw[:2]]
    if done is not None:
        done = done.drop("snapshot_ts")
    return run_audit(*raw, as_of, root=root, processed_payroll=done, **options)


def run_models(
    raw_payroll: DataFrame,
    raw_postings: DataFrame,
    as_of: dt.datetime,
    start: str = "2024-01-01",
    end: str = "2025-12-31",
    agency_rules=text.AGENCY_RULES,
    mode: str = "all",
    register: bool = False,
    gate: bool = False,
) -> dict[str, DataFrame]:
    """Staging, benchmarks, mart and ``model_checks``; ``register`` also creates temporary views for SQL
    users. The checks are a table (model, check, column, failed_rows, passed) that is evaluated when read; with
    ``gate`` they are evaluated here, and one that fails raises with all that failed, before anything is registered."""
    staged_pay = marts.stg_payroll_data(raw_payroll, agency_rules, as_of)
    staged_jobs = marts.stg_job_postings(raw_postings, agency_rules, as_of)
    benchmarks = materialize(marts.int_salary_benchmarks(staged_pay), "int-benchmarks")
    mart = marts.mart_job_posting_analysis(
        staged_jobs, benchmarks, as_of.year, start, end, mode=mode, as_of=as_of
    )
    models = dict(zip(marts.MODELS, (staged_jobs, staged_pay, benchmarks, mart)))
    if gate:
        quality.model_gate(quality.model_checks(models))
    if register:
        for name, df in models.items():
            df.createOrReplaceTempView(name)
    return {**models, "model_checks": quality.model_checks(models)}
