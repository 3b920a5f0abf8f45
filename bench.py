"""Headline queries on one folder of test tables; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default: all), BENCH_RUNS (default 3).
The test tables are first brought into the shape of the landed sources (stored files; this time
is reported apart). Each query is run once to warm up and then BENCH_RUNS times; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import functions as F

from checks.standins import Fx
from paygrain.operators import benchmark, marts, payroll, postings, reports, similarity
from paygrain.session import build_session, materialize

YEARS = (1997, 1998)
SCRATCH = os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="paygrain-bench-")


def role_ranges(fx):
    return payroll.top_ranges(payroll.role_table(payroll.standardize_annual_salary(fx.payroll)))


def salary_benchmarks(fx):
    return marts.int_salary_benchmarks(marts.stg_payroll_data(fx.payroll))


def mart(fx):
    # The benchmarks are stored first, as the model job does.
    stored = materialize(salary_benchmarks(fx), "bench-benchmarks")
    return marts.mart_job_posting_analysis(
        marts.stg_job_postings(fx.jobs), stored, 1998, "1997-01-01", "1998-12-31"
    )


def fuzzy_085(fx):
    df = postings.prepare_postings(fx.jobs, YEARS).select("job_id", "fuzzy_match_string")
    return postings.match_payroll(df, payroll.build_payroll(fx.payroll))


def fuzzy_070(fx):
    df = postings.prepare_postings(fx.jobs, YEARS).select(
        "job_id", "business_title", "posting_duration_days"
    )
    return benchmark.match_benchmark(df, benchmark.build_benchmark(fx.benchmark))


def quality(fx):
    report = reports.summary_report(fx.fact_jobs, fx.fact_durations)
    parts = [reports.quality_report(fx.fact_jobs, fx.fact_durations), *report.values()]
    rows = [p.select(F.to_json(F.struct(*p.columns)).alias("row")) for p in parts]
    result = rows[0]
    for r in rows[1:]:
        result = result.unionByName(r)
    return result


def text_keys(fx, part: int):
    """Distinct keys that grow with the data: the first words of half of the documents."""
    words = F.slice(F.split(F.lower("text"), "[^a-z]+"), 2, 4)
    docs = fx.table("documents").where(F.col("doc_id") % 2 == part)
    keys = docs.select(F.array_join(words, "_").alias("key")).where(F.length("key") > 3).distinct()
    return keys.withColumn("ord", F.col("key"))


def fuzzy_text(threshold: float):
    def query(fx):
        left, right = (fx.stored_keys(part) for part in (0, 1))
        return similarity.best_fuzzy_match(left.select("key"), right, threshold)

    return query


QUERIES = {
    "bench_role_ranges": role_ranges,
    "bench_salary_benchmarks": salary_benchmarks,
    "bench_mart": mart,
    "bench_fuzzy_085": fuzzy_085,
    "bench_fuzzy_070": fuzzy_070,
    "bench_fuzzy_085_text": fuzzy_text(0.85),
    "bench_fuzzy_070_text": fuzzy_text(0.7),
    "bench_quality": quality,
}


def pair_counts(fx) -> dict[str, dict[str, int]]:
    """All pairs of keys without an equal partner, those compared in any tier, past the bounds, and scored; untimed."""
    counts = {}
    for threshold in (0.85, 0.7):
        left, right = (fx.stored_keys(part) for part in (0, 1))
        rest = left.join(right.select("key"), "key", "left_anti").select("key")
        work = dict.fromkeys(("compared", "bounded", "scored"), 0)
        for tier in similarity.match_in_tiers(rest, right, threshold):
            sums = tier.agg(*[F.sum(c) for c in work]).first()
            work = {c: n + (x or 0) for (c, n), x in zip(work.items(), sums)}
        counts[f"bench_fuzzy_{round(threshold * 100):03d}_text"] = {"pairs": rest.count() * right.count(), **work}
    return counts


class StoredFx(Fx):
    """The stand-in sources as files, as many as there are cores."""

    def __init__(self, spark, sf_dir: str, files: int):
        super().__init__(spark, sf_dir)
        self.files, self.stored = files, {}

    def stored_keys(self, part: int):
        if part not in self.stored:
            self.stored[part] = materialize(text_keys(self, part), "bench-keys")
        return self.stored[part]

    def view(self, name: str):
        if name not in self.stored:
            df = super().view(name).repartition(self.files)
            self.stored[name] = materialize(df, f"bench-{name}")
        return self.stored[name]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
           "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": SCRATCH},
    )
    spark.sparkContext.setLogLevel("ERROR")
    start, fx, seconds = time.perf_counter(), StoredFx(spark, sf_dir, int(cpus)), {}
    for name in ("fx_payroll", "fx_jobs", "fx_benchmark", "fx_fact_jobs", "fx_fact_durations"):
        fx.view(name)
    for part in (0, 1):
        fx.stored_keys(part)
    preparation = round(time.perf_counter() - start, 3)
    for name, query in QUERIES.items():
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            query(fx).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:] or times), 3)
    result = {
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
        "cpus": int(cpus),
        "input_preparation_sec": preparation,
        "total_with_input_sec": round(sum(seconds.values()) + preparation, 3),
        "pairs": pair_counts(fx),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
