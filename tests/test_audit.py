import datetime as dt

import pytest

from checks.standins import Fx
from paygrain.operators.quality import QualityGateError
from paygrain.plans.audit import run_audit, run_models
from paygrain.sources.snapshots import read_runs

SF = "/root/testdata/sf0.001"
AS_OF = dt.datetime(1998, 7, 1)


def test_run_audit_stores_stages_and_runs(spark, tmp_path):
    fx = Fx(spark, SF)
    out = run_audit(fx.payroll, fx.jobs, fx.benchmark, AS_OF, years=(1997, 1998), root=str(tmp_path))
    jobs = out["jobs_processed"].count()
    assert jobs == out["fact_postings"].count() == out["fact_duration"].count() > 0
    assert out["vw_audit_summary_stats"].first().total_job_postings == jobs
    assert out["agency_breakdown"].count() == 10
    assert out["width_checks"].where("NOT passed").isEmpty() and out["width_checks"].count() == 12
    runs = {r.stage: r for r in read_runs(spark, str(tmp_path)).collect()}
    assert runs["jobs_processed"].output_rows == jobs
    assert runs["jobs_processed"].thresholds == {"match_threshold": 0.85}
    assert len(runs) == 6


def test_empty_stage_stops_the_run(spark):
    fx = Fx(spark, SF)
    with pytest.raises(QualityGateError, match="postings: no rows"):
        run_audit(fx.payroll, fx.jobs, fx.benchmark, AS_OF, years=(2030,))


def test_models_as_views(spark):
    fx = Fx(spark, SF)
    models = run_models(fx.payroll, fx.jobs, AS_OF, "1997-01-01", "1998-12-31", mode="best", register=True)
    mart = models["mart_job_posting_analysis"]
    assert mart.count() == mart.select("job_id").distinct().count() > 0
    assert spark.sql("SELECT count(*) FROM int_salary_benchmarks WHERE employee_count < 3").first()[0] == 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 5
    assert set(entry.oracle_sql()) <= set(entry.queries())
