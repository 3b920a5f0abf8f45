import pytest
from pyspark.sql import functions as F

from paygrain.operators import payroll
from paygrain.session import materialize
from paygrain.sources.schemas import PAYROLL_OUTPUT, RAW_PAYROLL, all_strings

ROWS = [
    # agency, title, base, basis, hours, gross, ot hours, ot paid, other
    ("Parks", "Clerk", "50000", "per Annum", "0", "1", "0", "2", "3"),
    ("Parks", "Clerk", "30", "per Hour", "0", "1", "0", "2", "3"),
    ("Parks", "Clerk", "200", "per Day", "0", "1", "0", "2", "3"),
    ("Parks", "Typist", "abc", "Prorated Annual", "0", "1000", "0", None, "5.5"),
    ("Parks", "Typist", "1,200", None, "0", "1000", "0", "1", None),
    ("Parks", "Typist", None, "other", "0", None, "0", "1", "1"),
    (None, "Clerk", "70000", "per Annum", "0", "1", "0", "2", "3"),
    ("parks ", "CLERK!", "60000", " per Annum", "0", "10", "0", "2", "3"),
]


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(ROWS, all_strings(RAW_PAYROLL))


def test_build_payroll(spark, raw):
    df = payroll.build_payroll(raw)
    assert df.columns == PAYROLL_OUTPUT
    rows = {(r.agency_name, r.title_description, r.base_salary): r for r in df.collect()}
    assert len(rows) == len(ROWS)
    pay = [rows[(r[0], r[1], r[2])].annual_salary_standardized for r in ROWS]
    assert pay == [50000.0, 30 * 2080.0, 200 * 260.0, 1005.5, 1001.0, None, 70000.0, 15.0]
    clerk = rows[("Parks", "Clerk", "30")]
    assert (clerk.salary_min, clerk.salary_max, clerk.salary_range_width) == (30.0, 50000.0, 49970.0)
    assert clerk.employee_count_in_role == 3 and clerk.fuzzy_match_string == "parks_clerk"
    typist = rows[("Parks", "Typist", None)]
    assert (typist.salary_min, typist.employee_count_in_role) == (None, 0)
    # A null key does not match its own group.
    nobody = rows[(None, "Clerk", "70000")]
    assert (nobody.salary_min, nobody.employee_count_in_role, nobody.fuzzy_match_string) == (None,) * 3


def test_missing_columns_warn_and_stay_out(spark, raw):
    with pytest.warns(UserWarning, match="ot_hours"):
        df = payroll.build_payroll(raw.drop("ot_hours"))
    assert "ot_hours" not in df.columns and len(df.columns) == len(PAYROLL_OUTPUT) - 1


def test_lookup_is_weighted_by_rows(spark, raw):
    rows = {r.key: r for r in payroll.salary_lookup(payroll.build_payroll(raw)).collect()}
    assert set(rows) == {"parks_clerk"}
    # Three rows of one role and one row of the other share the key.
    assert rows["parks_clerk"].payroll_salary_min == (3 * 30 + 60000) / 4
    assert rows["parks_clerk"].payroll_salary_max == (3 * 50000 + 60000) / 4
    assert rows["parks_clerk"].ord == "parks_clerk"


def test_lookup_keeps_first_appearance(spark, raw):
    df = payroll.build_payroll(raw).withColumn("ord", F.col("annual_salary_standardized").cast("int"))
    assert payroll.salary_lookup(df).first().ord == 15


def test_top_ranges_and_sample(spark, raw):
    df = payroll.with_role_range(payroll.standardize_annual_salary(raw))
    top = payroll.top_ranges(df, nulls_first=False).collect()
    assert [r.salary_range_width for r in top] == [49970.0, 0.0, None, None]
    assert payroll.top_ranges(df, 1).first().salary_range_width is None
    assert payroll.distinct_sample(df, 2).count() == 2
    stats = payroll.salary_range_stats(df).first()
    assert stats.positions_with_salary_range == 3 and stats.avg_employees_per_role == 10 / 7


def test_join_back_is_map_side_for_stored_statistics(spark, raw):
    pay = payroll.standardize_annual_salary(raw)
    df = payroll.with_role_range(pay, materialize(payroll.role_salary_range(pay), "ranges"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_role_table_equals_the_joined_rows(spark, raw):
    pay = payroll.standardize_annual_salary(raw)
    rows, roles = payroll.with_role_range(pay), payroll.role_table(pay)
    assert sum(r.n_rows for r in roles.collect()) == len(ROWS)
    for f in (payroll.top_ranges, payroll.distinct_sample):
        assert f(rows, 9).collect() == f(roles, 9).collect()
    a, b = (payroll.salary_range_stats(df).first() for df in (rows, roles))
    assert list(a) == pytest.approx(list(b)) and a.positions_with_salary_range == 3


def test_join_back_splits_skew_when_statistics_are_large(spark):
    """Beyond the broadcast limit the plan is a sort-merge join whose hot key is split."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = spark.range(0, 200000, 1, 8).select(
            F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("a"), F.col("id") % 500)).alias("agency_name"),
            F.lit("t").alias("title_description"),
            F.rand(1).alias("base_salary_num"),
        )
        df = payroll.attach_group_stats(rows, payroll.role_salary_range(rows))
        assert df.where("employee_count_in_role = 100000").count() == 100000
        df.write.format("noop").mode("overwrite").save()
        from pyspark.sql import Observation

        seen = Observation()
        checked = df.observe(seen, F.count(F.lit(1)).alias("n"))
        checked.collect()
        plan = checked._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
        assert seen.get["n"] == 200000
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
