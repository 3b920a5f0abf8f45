import datetime as dt

import pytest
from pyspark.sql import functions as F

from paygrain.operators import facts, quality, reports
from paygrain.sources.schemas import FACT_DURATION, FACT_POSTINGS

AS_OF = dt.datetime(2025, 1, 1)


def postings(spark, rows):
    """rows: (job_id, agency, title, low, high, days, score)"""
    schema = ("job_id string, agency string, business_title string, salary_range_from string, "
              "salary_range_to string, posting_duration_days int, best_match_score double, "
              "posting_date string, payroll_salary_min double")  # fmt: skip
    full = [(*r, "2024-05-01T00:00:00.000", 5.0) for r in rows]
    return facts.conform_postings(spark.createDataFrame(full, schema), as_of=AS_OF)


def durations(spark, ids):
    rows = [(i, 40.0 * n, 0.75) for n, i in enumerate(ids)]
    schema = "job_id string, duration_variance_pct double, lighthouse_match_score double"
    return facts.conform_duration(spark.createDataFrame(rows, schema), as_of=AS_OF)


GOOD = ("Parks", "Clerk", "10", "20", 5, 0.9)


def test_conform(spark):
    df = postings(spark, [("1", "Parks", "Clerk", "10.005", "x", 5, 0.99995)])
    assert df.columns == [*FACT_POSTINGS, "created_at", "updated_at"]
    row = df.first()
    assert (str(row.salary_range_from), row.salary_range_to, str(row.best_match_score)) == ("10.01", None, "1.0000")
    assert row.posting_date == dt.datetime(2024, 5, 1) and row.created_at == AS_OF
    d = durations(spark, ["1", "2"])
    assert d.columns == ["duration_analysis_id", *FACT_DURATION, "created_at", "updated_at"]
    assert len({r.duration_analysis_id for r in d.collect()}) == 2
    long = spark.createDataFrame([("x" * 51,)], "job_id string")
    assert len(facts.conform_postings(long).first().job_id) == 51
    with pytest.raises(Exception, match="longer than 50"):
        facts.conform_postings(long, check_widths=True).collect()
    assert quality.check_widths(long, {"job_id": 50}).first().failed_rows == 1


def test_load_fact_replaces(spark, tmp_path):
    for n in (2, 1):
        facts.load_fact(postings(spark, [(str(i), *GOOD) for i in range(n)]), "fact_test", str(tmp_path / "t"))
    assert spark.table("fact_test").count() == 1


def test_facts_change_together_or_not_at_all(spark, tmp_path, monkeypatch):
    tables, path = ("swap_postings", "swap_durations"), str(tmp_path)

    def load(n, broken=None):
        frames = [postings(spark, [(str(i), *GOOD) for i in range(n)]), durations(spark, ["0"] * n)]
        if broken is not None:  # dies while it is written, after the first one
            problem = F.raise_error(F.lit("disk")).cast("string")
            frames[1] = frames[1].withColumn("agency", F.when(F.col("job_id") == broken, problem))
        return facts.load_facts(dict(zip(tables, frames)), path, quality.load_gate)

    def rows():
        return [spark.table(t).count() for t in tables]

    first = load(3)
    assert rows() == [3, 3]
    with pytest.raises(Exception, match="disk"):
        load(5, broken="0")
    assert rows() == [3, 3]
    with pytest.raises(quality.QualityGateError):
        load(0)
    assert rows() == [3, 3]
    point = facts._point

    def fails_once(session, table, folder, schema):
        if table == tables[1] and "load=" in folder and folder not in first.values():
            raise RuntimeError("catalog")
        point(session, table, folder, schema)

    monkeypatch.setattr(facts, "_point", fails_once)
    with pytest.raises(RuntimeError, match="catalog"):
        load(4)
    assert rows() == [3, 3]
    monkeypatch.setattr(facts, "_point", point)
    second = load(2)
    assert rows() == [2, 2] and set(first.values()).isdisjoint(second.values())
    # The earlier folders are still there.
    assert spark.read.parquet(first[tables[0]]).count() == 3
    with pytest.raises(ValueError, match="columns of swap_postings"):
        facts.load_facts({tables[0]: spark.range(3)}, path)
    assert rows() == [2, 2]


def test_first_load_that_fails_leaves_no_table(spark, tmp_path, monkeypatch):
    point = facts._point

    def fails(session, table, folder, schema):
        if table == "fresh_two":
            raise RuntimeError("catalog")
        point(session, table, folder, schema)

    monkeypatch.setattr(facts, "_point", fails)
    with pytest.raises(RuntimeError):
        facts.load_facts({"fresh_one": spark.range(2), "fresh_two": spark.range(2)}, str(tmp_path))
    assert not spark.catalog.tableExists("fresh_one") and not spark.catalog.tableExists("fresh_two")


def test_dense_ids_do_not_depend_on_the_partitions(spark):
    rows = [(f"j{i % 40:02d}", i % 3 or None, 0.5 * i) for i in range(200)] + [("hot", 1, 1.0)] * 300 + [(None, None, None)] * 2
    df = spark.createDataFrame(rows, "job_id string, n int, x double")
    want = None
    for parts in (1, 3, 16):
        got = facts.dense_ids(df.repartition(parts), "id", ["job_id"])
        assert got.columns == ["id", "job_id", "n", "x"]
        got = sorted(tuple(r) for r in got.collect())
        assert [r[0] for r in got] == list(range(1, len(rows) + 1))
        assert [r[1] for r in got] == sorted([r[0] for r in rows], key=lambda k: (k is not None, k or ""))
        assert want in (None, got)
        want = got
    assert facts.dense_ids(df.limit(0), "id").count() == 0


def test_gate_passes_and_reports_every_reason(spark):
    jobs = postings(spark, [(str(i), *GOOD) for i in range(20)])
    metrics = quality.critical_gate(jobs, durations(spark, ["1", "2"]))
    assert metrics["total_job_postings"] == 20 and metrics["orphaned_duration_records"] == 0
    # 95 % complete passes, 94 % does not.
    edge = postings(spark, [(str(i), None if i < 1 else "Parks", *GOOD[1:]) for i in range(20)])
    quality.critical_gate(edge, durations(spark, ["1"]))
    bad = postings(spark, [(str(i), None if i < 6 else "Parks", *GOOD[1:]) for i in range(100)])
    with pytest.raises(quality.QualityGateError, match="agency completeness 94.0%.*1 orphaned"):
        quality.critical_gate(bad, durations(spark, ["1", "no"]))
    with pytest.warns(UserWarning, match="1 orphaned"):
        quality.critical_gate(jobs, durations(spark, ["no"]), orphans_fatal=False)
    with pytest.raises(quality.QualityGateError, match="no job postings"):
        quality.critical_gate(postings(spark, []), durations(spark, ["1"]))


def test_load_and_stage_gates(spark):
    jobs = postings(spark, [("1", *GOOD)])
    with pytest.raises(quality.QualityGateError, match="durations"):
        quality.load_gate(jobs, durations(spark, []))
    with pytest.warns(UserWarning, match="1 orphaned"):
        assert quality.load_gate(jobs, durations(spark, ["1", "2"])) == 1
    with pytest.raises(quality.QualityGateError, match="stage: no rows"):
        quality.empty_stage_gate(jobs.limit(0), "stage")
    with pytest.raises(quality.QualityGateError):
        quality.empty_stage_gate(None, "stage")


def test_rules_and_checks(spark):
    jobs = postings(
        spark,
        [
            ("1", "Parks", "a", "30", "20", 5, 0.9),
            ("1", None, "a", "0", "500000", -1, None),
            ("3", "Fire", "b", None, "500001", 366, 0.7),
            ("4", "Fire", "b", "-1", None, None, 0.85),
        ],
    )
    rules = reports.business_rule_counts(jobs).first().asDict()
    assert rules == dict(invalid_salary_ranges=3, from_gt_to=1, negative_durations=1, excessive_durations=1)
    checks = quality.MODEL_CHECKS["stg_job_postings"]
    df = quality.run_checks(jobs.withColumnRenamed("agency", "agency_name"), checks)
    failed = {(r.check, r.column): r.failed_rows for r in df.collect()}
    assert failed == {
        ("not_null", "job_id"): 0,
        ("not_null", "agency_name"): 1,
        ("not_null", "posting_date"): 0,
        ("accepted_range", "salary_range_from"): 1,
        ("accepted_range", "salary_range_to"): 1,
        ("unique", "job_id"): 1,
    }
    rates = {r.column: r for r in quality.rate_checks(jobs, ["agency", "job_id"]).collect()}
    assert (rates["agency"].null_rate, rates["agency"].duplicate_rate) == (0.25, 0.25)
    assert rates["job_id"].null_rate_passed and not rates["job_id"].duplicate_rate_passed


def test_reports_on_empty_tables(spark):
    row = reports.quality_row(postings(spark, []), durations(spark, [])).first()
    assert (row.total_job_postings, row.agency_completeness_pct, row.avg_payroll_match_score) == (0, None, 0.0)
    long = reports.quality_report(postings(spark, []), durations(spark, []))
    assert long.columns == ["metric", "value"] and long.count() == len(row)


def test_null_reference_is_an_orphan_but_no_foreign_key_failure(spark):
    jobs, lengths = postings(spark, [("1", *GOOD)]), durations(spark, ["1", None])
    assert reports.orphan_count(lengths, jobs).first()[0] == 1
    assert quality.check_foreign_key(lengths, jobs).first().passed
