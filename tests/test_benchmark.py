import pytest

from paygrain.functions.columns import standardize_columns, type_for_name
from paygrain.operators import benchmark


def test_names(spark):
    df = spark.createDataFrame([(1,) * 6], ["Job Title", "posting-duration", "Extra Col!", " Salary ", "lighthouse_x", "postings"])
    assert standardize_columns(df).columns == [
        "lighthouse_job_title", "lighthouse_median_posting_duration", "lighthouse_extra_col",
        "lighthouse_median_salary", "lighthouse_x", "lighthouse_total_postings",
    ]
    with pytest.raises(ValueError, match="lighthouse_job_title"):
        standardize_columns(df.toDF("title", "job_title", "a", "b", "c", "d"))


def test_types_by_name():
    assert type_for_name("total_postings") == "int"
    assert type_for_name("posting_salary") == "int"
    assert type_for_name("posting_duration") == "double"
    assert type_for_name("Salary_date") == "double"
    assert type_for_name("start_DATE") == "timestamp_ntz"
    assert type_for_name("skills") is None


def raw(spark, rows):
    return spark.createDataFrame(rows, "title string, postings string, `posting duration` string, salary string, skills string")


def test_build(spark):
    df = benchmark.build_benchmark(
        raw(spark, [("Data Analyst", "12.0", "4", "39999", "a"), ("B/C", "x", "0", None, None), ("D", "30", None, "100000", "b")])
    )
    rows = {r.lighthouse_job_title: r for r in df.collect()}
    first = rows["Data Analyst"]
    assert (first.lighthouse_total_postings, first.lighthouse_posting_intensity) == (12, 3.0)
    assert first.lighthouse_fuzzy_match_string == "data_analyst"
    assert rows["B/C"].lighthouse_posting_intensity is None and rows["B/C"].lighthouse_total_postings is None
    assert rows["B/C"].lighthouse_salary_category == "Very High"
    assert rows["D"].lighthouse_posting_intensity == 1.0


def test_last_row_of_a_title_wins_and_ties_go_to_the_first(spark):
    rows = [(0, "Clerk A", 1.0), (1, "Clerk B", 2.0), (2, "clerk a!", 3.0), (3, "", 9.0), (4, None, 9.0)]
    bench = spark.createDataFrame(rows, "pos int, lighthouse_job_title string, lighthouse_median_posting_duration double")
    lookup = {r.key: r for r in benchmark.title_lookup(bench, "pos").collect()}
    assert set(lookup) == {"clerk_a", "clerk_b"}
    assert (lookup["clerk_a"].ord, lookup["clerk_a"].lighthouse_match_title) == (0, "clerk a!")
    jobs = spark.createDataFrame(
        [("1", "Clerk C", 6), ("2", "Clerk B", None), ("3", "zzz", 1), ("4", None, 1), ("5", "!!", 1)],
        "job_id string, business_title string, posting_duration_days int",
    )
    df = benchmark.match_benchmark(jobs, bench, order="pos")
    found = {r.job_id: r for r in df.collect()}
    assert len(found) == 5
    assert found["1"].lighthouse_match_title == "clerk a!"  # 0.857 with both, the first one stays
    assert (found["1"].duration_variance, found["1"].duration_variance_pct) == (3.0, 100.0)
    assert found["2"].lighthouse_match_score == 1.0 and found["2"].duration_variance is None
    assert all(found[i].lighthouse_match_score is None for i in "345")


def test_guard_for_missing_columns(spark):
    jobs = spark.createDataFrame([("x",)], "business_title string")
    assert benchmark.match_benchmark(jobs, jobs) is None


def test_n_unique_counts_null(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "t string")
    assert [tuple(r) for r in benchmark.n_unique(df, "t").collect()] == [(2,)]
