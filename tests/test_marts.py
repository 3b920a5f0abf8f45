import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from paygrain.operators import marts
from paygrain.operators.percentiles import agg_with_percentiles

AS_OF = dt.datetime(2025, 6, 1)


def test_percentiles_equal_the_built_in_to_the_last_bit(spark):
    rng = random.Random(5)
    groups = {
        "many": [round(rng.gauss(100, 50), 2) for _ in range(3000)],
        "wide": [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randint(-12, 12) for _ in range(700)],
        "close": [1000 + rng.randint(0, 300) * 2.0**-40 for _ in range(400)],
        "powers": [s * 2.0**k for k in range(-40, 40) for s in (1, -1, 1 - 2**-52)],
        "same": [7.0] * 900 + [8.0],
        "odd": [0.0, float("inf"), float("-inf"), 5e-324, -5e-324, float("nan")],
        "few": [3.0, 1.0, None, 2.0, 10.0],
        None: [1.0, 2.0],
        "empty": [None, None],
    }
    for i in range(60):
        groups[f"g{i}"] = [rng.gauss(0, 1) for _ in range(rng.randint(1, 9))]
    rows = [(k, v) for k, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    fractions = {"q1": 0.25, "m": 0.5, "p99": 0.99, "lo": 0.0, "hi": 1.0}
    wanted = {n: ("v", f) for n, f in fractions.items()}
    got = agg_with_percentiles(df, ["k"], [F.count(F.lit(1)).alias("n")], wanted).collect()
    built_in = df.groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), *[F.percentile("v", f).alias(n) for n, f in fractions.items()]
    )
    assert len(got) == len(groups)
    assert {str(r.asDict()) for r in got} == {str(r.asDict()) for r in built_in.collect()}
    row = agg_with_percentiles(df.where("v < 1000"), [], [F.count("v").alias("n")], {"m": ("v", 0.37)}).first()
    assert row.m == df.where("v < 1000").agg(F.percentile("v", 0.37)).first()[0]


def test_global_percentile_of_nothing_is_one_null_row(spark):
    df = spark.createDataFrame([], "v double")
    rows = agg_with_percentiles(df, [], [F.count("v").alias("n")], {"m": ("v", 0.5)}).collect()
    assert [tuple(r) for r in rows] == [(0, None)]


def pay(number, title="Clerk", agency="City Police", base="100", status="ACTIVE", year="2025", **more):
    row = dict(payroll_number=number, agency_name=agency, title_description=title, base_salary=base,
               leave_status_as_of_june_30=status, fiscal_year=year, regular_hours="10", **more)
    return row


def staged(spark, rows):
    names = sorted({k for r in rows for k in r})
    schema = ", ".join(f"{n} string" for n in names)
    return marts.stg_payroll_data(spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema), as_of=AS_OF)


def test_staging_payroll(spark):
    rows = [
        pay("1", total_ot_paid="-5", total_other_pay="7"),
        pay("2", base="-1", status="a"),
        pay("3", base="oops", status=None),
        pay(None),
        pay("5", year=None),
    ]
    got = {r.payroll_number: r for r in staged(spark, rows).collect()}
    assert set(got) == {"1", "2", "3"}
    assert (got["1"].total_ot_paid, got["1"].total_compensation, got["1"].estimated_hourly_rate) == (0.0, 107.0, 10.0)
    assert got["1"].agency_name_standardized == "Police Department" and got["1"].fiscal_year == 2025
    assert (got["2"].base_salary, got["2"].is_active_employee) == (None, True)
    assert (got["3"].base_salary, got["3"].is_active_employee, got["3"].total_compensation) == (None, False, 0.0)
    assert got["1"].dbt_valid_from == dt.date(2025, 6, 1)


def test_benchmarks_need_three(spark):
    rows = [pay(str(i), base=b) for i, b in enumerate(["100", "200", "400"])]
    rows += [pay(f"x{i}", title="Typist") for i in range(2)]
    rows += [pay("y", base="900", status="CEASED")]
    got = marts.int_salary_benchmarks(staged(spark, rows)).collect()
    assert len(got) == 1
    row = got[0]
    assert (row.employee_count, float(row.median_base_salary), float(row.q1_base_salary)) == (3, 200.0, 150.0)
    assert float(row.salary_std_dev) == round(statistics.stdev([100, 200, 400]), 2)
    assert row.salary_band == "Entry Level" and row.is_high_variance_position
    assert (float(row.salary_range_lower), float(row.salary_range_upper)) == (160.0, 240.0)


def job(job_id, title, low="90", high="150", **more):
    row = dict(job_id=job_id, agency="Police of the City", business_title=title, title_description=title,
               salary_range_from=low, salary_range_to=high, posting_date="2025-01-05T00:00:00",
               application_deadline="2025-01-15T00:00:00")
    return {**row, **more}


def jobs(spark, rows):
    names = sorted(rows[0])
    schema = ", ".join(f"{n} string" for n in names)
    return marts.stg_job_postings(spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema), as_of=AS_OF)


def test_mart_modes_and_flags(spark):
    titles = ["Computer Systems Manager", "Computer Systems Managers", "Clerk"]
    rows = [pay(f"{t}{i}", title=t, base="100") for t in titles for i in range(3)]
    rows.append(pay("extra", title=titles[1], base="100"))
    bench = marts.int_salary_benchmarks(staged(spark, rows))
    posted = jobs(
        spark,
        [
            job("exact", titles[0]),
            job("clerk", "Clerk", "0", "150"),
            job("none", "Astronaut"),
            job("late", "Clerk", posting_date="2026-01-05T00:00:00"),
            job("edge", "Clerk", "100", "140"),
        ],
    )
    rows = marts.mart_job_posting_analysis(posted, bench, 2025, as_of=AS_OF).collect()
    count = lambda j: sum(r.job_id == j for r in rows)
    assert (count("exact"), count("clerk"), count("none"), count("late")) == (2, 1, 1, 0)
    by_ratio = sorted((r.salary_match_ratio for r in rows if r.job_id == "exact"))
    assert by_ratio[1] == 1.0 and 0.85 < by_ratio[0] < 1.0
    one = {r.job_id: r for r in rows if r.salary_match_ratio in (1.0, 0.0)}
    assert one["exact"].salary_variance_pct == pytest.approx(0.2)
    assert one["edge"].salary_variance_pct == pytest.approx(0.2) and not one["edge"].is_salary_outlier
    assert (one["clerk"].posted_salary_min, one["clerk"].has_posted_salary) == (None, False)
    assert one["clerk"].salary_variance_pct is None and not one["clerk"].is_salary_outlier
    assert (one["none"].salary_match_ratio, one["none"].benchmark_salary_median) == (0.0, None)
    assert not one["none"].has_salary_benchmark and one["none"].has_valid_posting_period
    best = marts.mart_job_posting_analysis(posted, bench, 2025, mode="best", as_of=AS_OF).collect()
    assert sorted(r.job_id for r in best) == ["clerk", "edge", "exact", "none"]
    assert {r.job_id: r.salary_match_ratio for r in best}["exact"] == 1.0
    with pytest.raises(ValueError):
        marts.mart_job_posting_analysis(posted, bench, 2025, mode="some")


def test_similar_titles_plan_is_an_equi_join(spark):
    left = spark.createDataFrame([("A", "Clerk One")], "agency_name_standardized string, title_description string")
    right = spark.createDataFrame([("A", "Clerk Two")], "agency_name string, title_description string")
    plan = marts.similar_titles(left, right)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan


@pytest.mark.parametrize("mode", ["all", "best"])
def test_benchmarks_behind_the_match_are_computed_once(spark, mode):
    bench = marts.int_salary_benchmarks(staged(spark, [pay(f"c{i}", title="Clerk", base="100") for i in range(3)]))
    read = spark.sparkContext.accumulator(0)

    def noted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    counted = bench.mapInArrow(noted, bench.schema)
    rows = marts.benchmark_match(jobs(spark, [job("a", "Clerk"), job("b", "Cook")]), counted, mode=mode).collect()
    assert sorted((r.job_id, r.payroll_employee_count, r.salary_match_ratio) for r in rows) == [
        ("a", 3, 1.0), ("b", None, 0.0)
    ]
    assert read.value == 1
