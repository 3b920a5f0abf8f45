import datetime as dt

from pyspark.sql import functions as F

from paygrain.functions import columns, scalars
from paygrain.operators import postings
from paygrain.sources.schemas import POSTINGS_OUTPUT, RAW_POSTINGS, all_strings


def test_lenient_timestamp(spark):
    values = ["2024-01-05T10:00:00", "2024-01-05T10:00:00.123", "2024-01-05T10:00:00.123456",
              "2024-01-05T10:00:00.12", "2024-01-05", "2024", "2024-01-05 10:00:00", "garbage",
              "2024-13-05T10:00:00", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = [r[1] for r in df.select("i", columns.lenient_timestamp(F.col("s"))).orderBy("i").collect()]
    base = dt.datetime(2024, 1, 5, 10)
    micro = [0, 123000, 123456, 120000]
    assert got == [base.replace(microsecond=m) for m in micro] + [None] * 6


def posting(job_id, **values):
    row = dict.fromkeys(RAW_POSTINGS)
    row.update(job_id=job_id, agency="Parks", business_title="Clerk", **values)
    return tuple(row[c] for c in RAW_POSTINGS)


def test_duration_rules(spark):
    start = "2024-03-01T12:00:00.000"
    rows = [
        posting("both", posting_date=start, process_date="2024-03-11T11:00:00", posting_updated="2024-04-01T00:00:00"),
        posting("updated", posting_date=start, posting_updated="2024-03-04T12:00:00"),
        posting("neither", posting_date=start),
        posting("before", posting_date=start, process_date="2024-02-29T06:00:00"),
        posting("bad end", posting_date=start, process_date="soon"),
        posting("2025", posting_date="2025-12-31T23:59:59.999"),
        posting("2026", posting_date="2026-01-01T00:00:00"),
        posting("2023", posting_date="2023-12-31T23:59:59"),
        posting("text", posting_date="2024-not a date"),
        posting("null"),
    ]
    df = postings.prepare_postings(spark.createDataFrame(rows, all_strings(RAW_POSTINGS)))
    days = {r.job_id: r.posting_duration_days for r in df.collect()}
    assert days == {"both": 9, "updated": 3, "neither": 30, "before": -1, "bad end": 30, "2025": 30}


def test_build_without_payroll_has_typed_nulls(spark):
    raw = spark.createDataFrame([posting("1", posting_date="2024-03-01T12:00:00")], all_strings(RAW_POSTINGS))
    df = postings.build_postings(raw, None)
    assert df.columns == POSTINGS_OUTPUT
    types = dict(df.dtypes)
    assert (types["best_payroll_match"], types["best_match_score"]) == ("string", "double")
    row = df.first()
    assert row.best_match_score is None and row.fuzzy_match_string == "parks_clerk"


def test_year_filter_reaches_the_scan(spark, tmp_path):
    raw = spark.createDataFrame([posting("1", posting_date="2024-03-01T12:00:00")], all_strings(RAW_POSTINGS))
    raw.write.parquet(str(tmp_path / "p"))
    df = postings.prepare_postings(spark.read.parquet(str(tmp_path / "p")), (2023, 2024, 2026))
    plan = df.select("job_id", "posting_duration_days")._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") : plan.index("ReadSchema")]
    assert "GreaterThanOrEqual(posting_date,2023-)" in pushed and "LessThan(posting_date,2025-)" in pushed
    assert "job_description" not in plan


def test_date_range_end_is_midnight(spark):
    df = spark.createDataFrame([("2025-12-31T10:00:00",), ("2025-12-31T00:00:00",)], "s string")
    df = df.withColumn("t", columns.lenient_timestamp(F.col("s")))
    assert columns.filter_date_range(df, "t", "2024-01-01", "2025-12-31").count() == 1
    assert columns.filter_years(df, "t", (2025,)).count() == 2


def test_sign_rules_and_ratios(spark):
    df = spark.createDataFrame([(1, -1.0), (2, 0.0), (3, 2.0), (4, None)], "i int, x double")
    x = F.col("x")
    rows = df.select(
        "i", columns.non_positive_to_null(x), columns.negative_to_null(x), columns.negative_to_zero(x),
        scalars.posting_intensity(F.lit(10), x), scalars.duration_variance_pct(F.lit(5), x),
        scalars.salary_category(x), scalars.salary_category(x, "Unknown"),
    ).orderBy("i").collect()
    assert [tuple(r)[1:] for r in rows] == [
        (None, None, 0.0, -10.0, None, "Low", "Low"),
        (None, 0.0, 0.0, None, None, "Low", "Low"),
        (2.0, 2.0, 2.0, 5.0, 150.0, "Low", "Low"),
        (None, None, 0.0, 10 / 30, None, "Very High", "Unknown"),
    ]


def test_category_and_band_bounds(spark):
    values = [39999.0, 40000.0, 59999.0, 60000.0, 70000.0, 80000.0, 100000.0, 120000.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = df.select(scalars.salary_category(F.col("x")), scalars.salary_band(F.col("x"))).collect()
    assert [r[0] for r in rows] == ["Low", "Medium", "Medium", "Medium", "High", "High", "Very High", "Very High"]
    assert [r[1].split()[0] for r in rows] == [
        "Entry", "Mid", "Mid", "Senior", "Senior", "Manager", "Manager", "Executive",
    ]


def test_stats_count_matched_rows_only(spark):
    df = spark.createDataFrame([(0.9, 1.0), (0.95, None), (None, None)], "best_match_score double, payroll_salary_min double")
    row = postings.payroll_match_stats(df).first()
    assert (row.total_jobs, row.n_rows, row.jobs_with_payroll_salary, row.median_match_score) == (2, 3, 1, 0.925)


def test_results_do_not_depend_on_the_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2024-12-31T23:59:59",), ("2025-01-01T00:00:00",)], "s string")
        df = df.withColumn("t", columns.lenient_timestamp(F.col("s")))
        assert columns.filter_years(df, "t", (2025,)).first().s == "2025-01-01T00:00:00"
        stamped = columns.load_stamps(df, dt.datetime(2025, 1, 1, 2)).first()
        assert stamped.dbt_loaded_at == dt.datetime(2025, 1, 1, 2)
        assert stamped.dbt_valid_from == dt.date(2025, 1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
