"""Operators build without jobs; the job from landed files; row order; loading."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from checks.standins import Fx
from paygrain.functions import columns
from paygrain.operators import benchmark, marts, payroll, quality, reports
from paygrain.operators import postings as postings_module
from paygrain.plans import audit
from paygrain.plans.audit import run_audit, run_audit_from, run_models
from paygrain.session import materialize, scratch_dir
from paygrain.sources import snapshots
from paygrain.sources.schemas import BENCHMARK_NAMES, PAYROLL_SCHEMA, POSTINGS_SCHEMA, all_strings

SF = "/root/testdata/sf0.001"
AS_OF = dt.datetime(1998, 7, 1)
YEARS = (1997, 1998)


def jobs_of(spark, build):
    """Number of Spark jobs that ``build`` starts."""
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        build()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_building_starts_no_job(spark):
    fx = Fx(spark, SF)
    pay, jobs, bench, postings, durations = fx.payroll, fx.jobs, fx.benchmark, fx.fact_jobs, fx.fact_durations
    ranges = materialize(payroll.role_salary_range(payroll.prepare_payroll(pay)), "ranges")
    builds = {
        "payroll": lambda: payroll.build_payroll(pay, ranges),
        "benchmarks": lambda: marts.int_salary_benchmarks(marts.stg_payroll_data(pay)),
        "benchmark": lambda: benchmark.build_benchmark(bench),
        "postings": lambda: marts.stg_job_postings(jobs),
        "quality": lambda: reports.quality_report(postings, durations),
        "summary": lambda: reports.summary_report(postings, durations),
        "stats": lambda: benchmark.benchmark_match_stats(
            durations.withColumn("lighthouse_match_score", F.col("lighthouse_match_score").cast("double"))
        ),
        "checks": lambda: quality.rate_checks(postings, ["agency", "job_id"]),
    }
    assert {name: jobs_of(spark, build) for name, build in builds.items()} == dict.fromkeys(builds, 0)


def land(spark, root, stamp, names=("payroll", "postings", "benchmark")):
    fx = Fx(spark, SF)
    frames = {"payroll": (fx.payroll, PAYROLL_SCHEMA), "postings": (fx.jobs, POSTINGS_SCHEMA)}
    for name in names:
        if name == "benchmark":
            snapshots.write_processed(fx.benchmark, root, "raw_benchmark", stamp)
        else:
            df, schema = frames[name]
            texts = [F.col(c).cast("string") for c in schema.names if c in df.columns]
            snapshots.write_raw(df.select(texts), root, f"raw_{name}", stamp)


def test_run_from_landed_files(spark, tmp_path):
    root, early = str(tmp_path), AS_OF - dt.timedelta(hours=5)
    with pytest.raises(FileNotFoundError, match="raw_payroll, raw_postings, raw_benchmark"):
        run_audit_from(spark, root, AS_OF)
    land(spark, root, early)
    # A newer landing that has not ended is passed over.
    (tmp_path / "raw_payroll" / "snapshot_ts=19980630_235959" / "_temporary").mkdir(parents=True)
    tables = ("landed_postings", "landed_durations")
    out = run_audit_from(spark, root, AS_OF, years=YEARS, tables=tables, table_path=f"{root}/facts", register=True)
    fx = Fx(spark, SF)
    direct = run_audit(fx.payroll, fx.jobs, fx.benchmark, AS_OF, years=YEARS)
    for name in ("jobs_processed", "fact_postings"):
        a, b = (o[name].drop("created_at", "updated_at") for o in (out, direct))
        columns_ = [c for c in b.columns if c in a.columns and not c.startswith("salary_range")]
        assert a.select(columns_).exceptAll(b.select(columns_)).isEmpty()
    assert spark.table(tables[0]).count() == out["fact_postings"].count()
    assert spark.sql("SELECT total_job_postings FROM vw_audit_summary_stats").first()[0] == out["fact_postings"].count()
    runs = {r.stage: r for r in snapshots.read_runs(spark, root).collect()}
    assert runs["jobs_processed"].input_rows == fx.jobs.count()
    details = json.loads(runs["jobs_processed"].details)
    assert details["matched_rows"] == out["jobs_processed"].where("best_match_score IS NOT NULL").count()
    # A second run soon after uses the processed payroll; much later it does not.
    later = AS_OF + dt.timedelta(hours=3)
    run_audit_from(spark, root, later, years=YEARS)
    stamps = [s for s, _ in snapshots.list_snapshots(spark, root, "payroll_processed")]
    assert stamps == [AS_OF.strftime(snapshots.TIMESTAMP_FORMAT)]
    run_audit_from(spark, root, AS_OF + dt.timedelta(hours=26), years=YEARS)
    assert len(snapshots.list_snapshots(spark, root, "payroll_processed")) == 2
    with pytest.raises(FileNotFoundError, match="raw_benchmark"):
        run_audit_from(spark, root, AS_OF + dt.timedelta(hours=90), years=YEARS)


def test_filters_reach_the_scan_of_the_job(spark, tmp_path, monkeypatch):
    fx, plans = Fx(spark, SF), {}
    stored = materialize(fx.jobs, "raw-jobs")
    write, store = snapshots.write_counted, postings_module.prepare_postings

    def watched(df, path, *args, **options):
        plans[path.split("/")[-2]] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, path, *args, **options)

    def prepared(raw, years):
        df = store(raw, years)
        plans["read"] = df._jdf.queryExecution().executedPlan().toString()
        return df

    monkeypatch.setattr(snapshots, "write_counted", watched)
    monkeypatch.setattr(postings_module, "prepare_postings", prepared)
    root = str(tmp_path)
    run_audit(fx.payroll, stored, fx.benchmark, AS_OF, years=YEARS, root=root)
    for name in ("read", "jobs_processed"):
        assert "PushedFilters" in plans[name] and "GreaterThanOrEqual(posting_date" in plans[name]
        assert "CollectMetrics" not in plans["read"]
    runs = {r.stage: r for r in snapshots.read_runs(spark, root).collect()}
    assert runs["jobs_processed"].input_rows == stored.count() > runs["jobs_processed"].output_rows
    assert runs["fact_postings"].input_rows == runs["jobs_processed"].output_rows
    assert len(runs) == 6


def test_load_gate_after_loading(spark, tmp_path):
    fx = Fx(spark, SF)
    with pytest.raises(quality.QualityGateError):
        run_audit(fx.payroll, fx.jobs, fx.benchmark, AS_OF, years=(2030,), tables=("a", "b"))


def test_row_order_decides_ties_end_to_end(spark):
    pay = [("A", "abcx", "1", 2), ("A", "abcy", "2", 1)]
    pay = spark.createDataFrame(pay, "agency_name string, title_description string, base_salary string, position int")
    pay = pay.withColumn("pay_basis", F.lit("per Annum"))
    jobs = spark.createDataFrame(
        [("1", "A", "abcz", "2024-01-01T00:00:00.000")],
        all_strings(["job_id", "agency", "business_title", "posting_date"]),
    )
    rows = [("abcq", 1.0, "first", 5), ("abcq", 9.0, "last", 8), ("abcw", 7.0, "other", 6)]
    schema = "job_title string, median_posting_duration double, skills string, position int"
    bench = spark.createDataFrame(rows, schema)
    options = dict(payroll_threshold=0.8, benchmark_threshold=0.7, gates=False)
    with pytest.warns(UserWarning):
        ordered = run_audit(pay, jobs, bench, AS_OF, order="position", **options)
        plain = run_audit(pay.drop("position"), jobs, bench.drop("position"), AS_OF, **options)
    assert ordered["jobs_processed"].first().best_payroll_match == "a_abcy"
    assert plain["jobs_processed"].first().best_payroll_match == "a_abcx"
    got = ordered["jobs_benchmark_matched"].first()
    assert (got.lighthouse_match_title, got.lighthouse_top_skills) == ("abcq", "last")


def test_model_checks(spark):
    fx = Fx(spark, SF)
    models = run_models(fx.payroll, fx.jobs, AS_OF, "1997-01-01", "1998-12-31", mode="best")
    rows = models["model_checks"].collect()
    assert len(rows) == 12 and {r.model for r in rows} == set(quality.MODEL_CHECKS)
    broken = {**models, "stg_job_postings": models["stg_job_postings"].withColumn("job_id", F.lit("1"))}
    failed = [(r.model, r.check, r.column) for r in quality.model_checks(broken).collect() if not r.passed]
    assert ("stg_job_postings", "unique", "job_id") in failed
    assert quality.run_checks(models["stg_job_postings"], quality.TableChecks()).count() == 0
    assert quality.rate_checks(fx.fact_jobs.limit(0), ["agency"]).first().null_rate_passed


def test_gate_of_the_models_and_limited_runs(spark, tmp_path):
    fx = Fx(spark, SF)
    models = run_models(fx.payroll, fx.jobs, AS_OF, "1997-01-01", "1998-12-31", mode="best")
    failed = models["model_checks"].where("NOT passed").count()
    if failed:
        with pytest.raises(quality.QualityGateError):
            run_models(fx.payroll, fx.jobs, AS_OF, "1997-01-01", "1998-12-31", mode="best", gate=True)
    twice = fx.jobs.unionByName(fx.jobs)
    with pytest.raises(quality.QualityGateError, match="stg_job_postings: unique job_id"):
        run_models(fx.payroll, twice, AS_OF, "1997-01-01", "1998-12-31", mode="best", gate=True)
    root = str(tmp_path)
    land(spark, root, AS_OF - dt.timedelta(hours=5))
    run_audit_from(spark, root, AS_OF, years=YEARS, gates=False, limit=50)
    runs = {r.stage: r for r in snapshots.read_runs(spark, root).collect()}
    assert runs["payroll_processed"].input_rows == runs["jobs_processed"].input_rows == 50
    assert runs["benchmark_processed"].input_rows == fx.benchmark.count()
    details = json.loads(runs["benchmark_processed"].details)
    truth = sorted(r.median_salary for r in fx.benchmark.collect())
    middle = (truth[(len(truth) - 1) // 2] + truth[len(truth) // 2]) / 2
    assert details["median_salary"] == pytest.approx(middle) and details["titles"] == len(truth)
    assert set(json.loads(runs["jobs_processed"].details)) >= {"median_duration", "median_match_score"}


def test_checks_of_a_model_scan_it_once(spark):
    stored = materialize(Fx(spark, SF).jobs.select("job_id", "agency", "salary_range_from"), "checked")
    rules = quality.TableChecks(unique=["job_id", "agency"], not_null=["job_id"], accepted_range={"salary_range_from": (0, 9)})
    df = quality.run_checks(stored, rules)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") <= 2
    got = {(r.check, r.column): (r.failed_rows, r.passed) for r in df.collect()}
    n = stored.groupBy("agency").count().where("count > 1").count()
    over = stored.where("salary_range_from > 9").count()
    assert got == {
        ("unique", "job_id"): (0, True), ("unique", "agency"): (n, False), ("not_null", "job_id"): (0, True),
        ("accepted_range", "salary_range_from"): (over, False),
    }
    odd = spark.createDataFrame([(None, 1), (None, 1), ("a", None), ("a", 2), ("b", 99)], "k string, v int")
    got = {(r.check, r.column): r.failed_rows for r in quality.run_checks(
        odd, quality.TableChecks(unique=["k", "v"], not_null=["k"], accepted_range={"v": (0, 9)})).collect()}
    assert got == {("unique", "k"): 1, ("unique", "v"): 1, ("not_null", "k"): 2, ("accepted_range", "v"): 1}
    assert quality.run_checks(odd.limit(0), quality.TableChecks(unique=["k"], not_null=["k"])).where("passed").count() == 2


def test_names_of_benchmark_columns():
    name = lambda raw: columns.standard_name(raw, BENCHMARK_NAMES, "lighthouse_")
    assert [name(x) for x in ("Job Title", " JOB-title ", "job_title!", "Salary ($)")] == [
        "lighthouse_job_title", "lighthouse_job_title", "lighthouse_job_title", "lighthouse_salary_",
    ]
    assert name("Größe 2") == "lighthouse_größe_2" and name("lighthouse_x") == "lighthouse_x"
    assert name("a\tb.c") == "lighthouse_abc" and name("") == "lighthouse_"


def test_dates_and_typed_columns(spark):
    df = spark.createDataFrame([("2024",), ("2024-05-06T07:08:09",)], "start_date string")
    got = [r[0] for r in columns.cast_by_name_pattern(df).collect()]
    assert got == [None, dt.datetime(2024, 5, 6, 7, 8, 9)]
    typed = df.select(columns.lenient_timestamp(F.col("start_date")).alias("posting_date"))
    assert columns.filter_year_text(typed, "posting_date", (2024,)).count() == 1
    assert columns.filter_year_text(typed, "posting_date", (2023,)).count() == 0


def test_scratch_folder(spark):
    assert scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_rows_of_a_source_come_from_its_stored_parts(spark):
    source = spark.range(3).select(F.raise_error(F.lit("read again")).alias("text")).where("text IS NOT NULL")
    parts = spark.createDataFrame([("a", 2), (None, 3)], "agency_name string, n_rows bigint")
    store = audit._Store(spark, None, dt.datetime(2025, 1, 1))
    store.counted(source, parts)
    assert store.rows_of(source) == 5
    store.counted(source, parts.limit(0))
    assert store.rows_of(source) == 0
