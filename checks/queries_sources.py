"""Readers, writers, snapshots and sheets; the files are written from the test tables first."""

import datetime as dt
import uuid

from pyspark.sql import functions as F


from checks.queries_columns import POSTINGS_SQL
from checks.queries_matching import DENSE, FACT_POSTINGS_SQL, JOBS_PROCESSED, TITLE_MATCH, fact_duration_sql
from checks.registry import query
from paygrain.functions.text import sheet_slug
from paygrain.plans import audit, sheets
from paygrain.session import scratch_dir
from paygrain.sources import cells, snapshots
from paygrain.sources.schemas import PAYROLL_SCHEMA, POSTINGS_SCHEMA, all_strings

PAY, JOBS, CELLS = ["fx_payroll"], ["fx_jobs"], ["fx_cells"]
FIRST, SECOND = dt.datetime(1998, 6, 1, 6), dt.datetime(1998, 6, 2, 6)
JOB_COLUMNS = ["job_id", "agency", "business_title", "posting_date", "process_date"]
JOB_SQL = "SELECT job_id, agency, business_title, posting_date, process_date FROM fx_jobs"


def _folder(fx) -> str:
    return f"{scratch_dir(fx.spark).rstrip('/')}/paygrain/check-{uuid.uuid4().hex}"


@query("S1_read_raw_json", JOB_SQL, JOBS)
def _(fx):
    # A third of the postings in each form: arrays (a file each), {"data": [...]} objects, lines.
    path, schema = _folder(fx), all_strings(JOB_COLUMNS)
    number = F.col("job_id").cast("bigint")
    rows = fx.jobs.select(number.alias("k"), F.struct(*JOB_COLUMNS).alias("row"))

    def packed(third: int, size: int):
        lists = rows.where(F.col("k") % 3 == third).groupBy(F.floor(F.col("k") / size))
        return lists.agg(F.collect_list("row").alias("data"))

    arrays = packed(0, 1000).select(F.to_json("data").alias("value"))
    arrays.write.option("maxRecordsPerFile", 1).text(f"{path}/arrays")
    packed(1, 100).select(F.to_json(F.struct("data")).alias("value")).write.text(f"{path}/wrapped")
    rows.where("k % 3 = 2").select(F.to_json("row").alias("value")).write.text(f"{path}/lines")
    forms = {"arrays": {}, "wrapped": {"lines": True, "wrapped": True}, "lines": {"lines": True}}
    return snapshots.concat_chunks(
        [snapshots.read_raw_json(fx.spark, f"{path}/{name}", schema, **form) for name, form in forms.items()]
    )


@query("S2_read_benchmark", """
SELECT job_title, total_postings, median_salary, top_skills FROM fx_benchmark""", ["fx_benchmark"])
def _(fx):
    path = _folder(fx) + ".csv"
    fx.benchmark.write.csv(path, header=True)
    return snapshots.read_benchmark(fx.spark, path).select(
        "job_title",
        F.col("total_postings").cast("bigint").alias("total_postings"),
        F.col("median_salary").cast("double").alias("median_salary"),
        "top_skills",
    )


@query("S3_read_processed", "SELECT payroll_number, base_salary, pay_basis FROM fx_payroll", PAY)
def _(fx):
    root = _folder(fx)
    df = fx.payroll.select("payroll_number", "base_salary", "pay_basis")
    snapshots.write_processed(df, root, "payroll", FIRST)
    return snapshots.read_processed(fx.spark, snapshots.snapshot_path(root, "payroll", FIRST))


@query("S4_write_raw", JOB_SQL, JOBS)
def _(fx):
    root = _folder(fx)
    snapshots.write_raw(fx.jobs.select(JOB_COLUMNS), root, "postings", FIRST)
    return snapshots.latest_snapshot(fx.spark, root, "postings", all_strings(JOB_COLUMNS)).drop(
        "snapshot_ts"
    )


@query("S5_write_processed", "SELECT count(*) AS written, count(*) AS found FROM fx_payroll", PAY)
def _(fx):
    root = _folder(fx)
    rows = snapshots.write_processed(fx.payroll, root, "payroll", FIRST)
    df = snapshots.latest_snapshot(fx.spark, root, "payroll")
    return df.agg(F.lit(rows).cast("bigint").alias("written"), F.count(F.lit(1)).alias("found"))


@query("S6_record_run", """
SELECT 'postings' AS stage, count(*) AS output_rows, 5 AS n_columns, CAST(0.85 AS DECIMAL(3,2)) AS threshold FROM fx_jobs""", JOBS)
def _(fx):
    root, df = _folder(fx), fx.jobs.select(JOB_COLUMNS)
    rows = snapshots.write_processed(df, root, "postings", FIRST)
    snapshots.record_run(
        fx.spark, root, "postings", rows, rows, df.columns, ["selection"], FIRST, {"match_threshold": 0.85}
    )
    return snapshots.read_runs(fx.spark, root).select(
        "stage",
        "output_rows",
        F.size("columns").alias("n_columns"),
        F.col("thresholds")["match_threshold"].cast("decimal(3,2)").alias("threshold"),
    )


def _two_snapshots(fx) -> str:
    root = _folder(fx)
    for stamp in (FIRST, SECOND):
        df = fx.payroll.select("payroll_number", "base_salary", F.lit(str(stamp)).alias("tag"))
        snapshots.write_processed(df, root, "payroll", stamp)
    # A newer one whose write has not been committed.
    unfinished = snapshots.snapshot_path(root, "payroll", SECOND + dt.timedelta(hours=1))
    writer = df.limit(10).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    writer.parquet(unfinished)
    return root


@query("S7_latest_snapshot", """
SELECT payroll_number, base_salary, '1998-06-02 06:00:00' AS tag, '19980602_060000' AS snapshot_ts
FROM fx_payroll""", PAY)
def _(fx):
    return snapshots.latest_snapshot(fx.spark, _two_snapshots(fx), "payroll")


@query("S8_recent_snapshot", """
SELECT payroll_number, base_salary, '1998-06-02 06:00:00' AS tag FROM fx_payroll""", PAY)
def _(fx):
    noon = SECOND + dt.timedelta(hours=6)
    return snapshots.recent_snapshot(fx.spark, _two_snapshots(fx), "payroll", noon).drop("snapshot_ts")


@query("S9_limit_rows", "SELECT job_id, agency FROM fx_jobs ORDER BY job_id LIMIT 10000", JOBS)
def _(fx):
    return snapshots.limit_rows(fx.jobs.select("job_id", "agency"), 10_000, ["job_id"])


def _landed(fx) -> str:
    """The three sources as landed snapshots."""
    root = _folder(fx)
    for df, schema, name in ((fx.payroll, PAYROLL_SCHEMA, "payroll"), (fx.jobs, POSTINGS_SCHEMA, "postings")):
        texts = [F.col(c).cast("string") for c in schema.names if c in df.columns]
        snapshots.write_raw(df.select(texts), root, f"raw_{name}", FIRST)
    snapshots.write_processed(fx.benchmark, root, "raw_benchmark", FIRST)
    return root


NOON = FIRST + dt.timedelta(hours=6)


@query("S6_stage_records", f"""
WITH ranges AS (SELECT agency_name, title_description, max(base_salary) > min(base_salary) AS wide
    FROM fx_payroll GROUP BY 1, 2),
pay_rows AS (SELECT count(*) AS n, count(*) FILTER (WHERE wide) AS wide
    FROM fx_payroll JOIN ranges USING (agency_name, title_description)),
raw_rows AS (SELECT count(*) AS n FROM fx_jobs), bench_rows AS (SELECT count(*) AS n FROM fx_benchmark),
job_rows AS (WITH RECURSIVE {JOBS_PROCESSED}
    SELECT count(*) AS n, count(best_match_score) AS m FROM jobs_processed),
match_rows AS (WITH RECURSIVE prepared AS MATERIALIZED ({POSTINGS_SQL}), {TITLE_MATCH}
    SELECT count(*) AS n, count(score) AS m FROM matched)
SELECT 'payroll_processed' AS stage, n AS input_rows, n AS output_rows, wide AS positions_with_salary_range,
    CAST(NULL AS BIGINT) AS matched_rows, CAST(NULL AS DECIMAL(3,2)) AS threshold FROM pay_rows
UNION ALL SELECT 'jobs_processed', r.n, j.n, NULL, m, 0.85 FROM raw_rows r, job_rows j
UNION ALL SELECT 'benchmark_processed', n, n, NULL, NULL, NULL FROM bench_rows
UNION ALL SELECT 'jobs_benchmark_matched', j.n, x.n, NULL, x.m, 0.7 FROM job_rows j, match_rows x
UNION ALL SELECT 'fact_postings', n, n, NULL, NULL, NULL FROM job_rows
UNION ALL SELECT 'fact_duration', n, n, NULL, NULL, NULL FROM match_rows""", [*PAY, *JOBS, "fx_benchmark"])
def _(fx):
    root = _landed(fx)
    audit.run_audit_from(fx.spark, root, NOON, years=(1997, 1998), gates=False)

    def detail(name: str):
        return F.get_json_object("details", f"$.{name}").cast("bigint").alias(name)

    limit = F.col("thresholds")["match_threshold"].cast("decimal(3,2)").alias("threshold")
    return snapshots.read_runs(fx.spark, root).select(
        "stage", "input_rows", "output_rows", detail("positions_with_salary_range"), detail("matched_rows"), limit
    )


LOADED = "TIMESTAMP '1998-06-01 13:00:00' AS created_at, TIMESTAMP '1998-06-01 13:00:00' AS updated_at"


def _loaded(fx) -> list[str]:
    """Both facts, through the job from landed files; the second load replaces the first."""
    root, names = _landed(fx), [f"check_{uuid.uuid4().hex}" for _ in range(2)]
    for hours in (0, 1):
        audit.run_audit_from(
            fx.spark, root, NOON + dt.timedelta(hours=hours), years=(1997, 1998), gates=False,
            tables=tuple(names), table_path=root,
        )
    return names


@query("S10_load_fact", FACT_POSTINGS_SQL.replace("@stamps", LOADED), [*PAY, *JOBS])
def _(fx):
    return fx.spark.table(_loaded(fx)[0])


@query("S10_load_fact_duration", fact_duration_sql(DENSE, LOADED), [*JOBS, "fx_benchmark"])
def _(fx):
    return fx.spark.table(_loaded(fx)[1])


FILLED = "trim(value) <> ''"


@query("S12_profile_sheets", f"""
WITH p AS (SELECT workbook, sheet, count(DISTINCT CASE WHEN row_idx < 50 AND {FILLED} THEN row_idx END) AS data_rows,
    max(col_idx) + 1 AS max_column, max(row_idx) + 1 AS max_row FROM fx_cells GROUP BY 1, 2),
q AS (SELECT *, data_rows > 5 AND max_column > 2 AS qualifies FROM p)
SELECT *, qualifies OR NOT bool_or(qualifies) OVER (PARTITION BY workbook) AS keep FROM q""", CELLS)
def _(fx):
    return cells.profile_sheets(fx.cells)


SHEETS = f"""WITH filled AS (SELECT workbook, sheet, row_idx, count(*) AS n, arg_min(trim(value), col_idx) AS first
    FROM fx_cells WHERE row_idx < 10 AND {FILLED} GROUP BY 1, 2, 3),
heads AS (SELECT workbook, sheet, min(row_idx) FILTER (WHERE n > 2) AS header FROM filled GROUP BY 1, 2),
titles AS (SELECT f.workbook, f.sheet, arg_min(first, row_idx) AS title
    FROM filled f JOIN heads h ON f.workbook = h.workbook AND f.sheet = h.sheet
    WHERE n <= 2 AND (header IS NULL OR row_idx < header) GROUP BY 1, 2),
layout AS (SELECT d.workbook, d.sheet, d.width, coalesce(header, 0) AS start,
    coalesce(title, concat('Sheet: ', d.sheet)) AS title
    FROM (SELECT workbook, sheet, max(col_idx) + 1 AS width FROM fx_cells GROUP BY 1, 2) d
    LEFT JOIN heads USING (workbook, sheet) LEFT JOIN titles USING (workbook, sheet)),
kept AS (SELECT DISTINCT c.workbook, c.sheet, c.row_idx, title, start, width
    FROM fx_cells c JOIN layout l ON c.workbook = l.workbook AND c.sheet = l.sheet
    WHERE {FILLED} AND c.row_idx > start),
grid AS (SELECT k.*, unnest(range(0, width)) AS col_idx FROM kept k)
SELECT g.workbook, g.sheet, g.title, g.row_idx,
    coalesce(nullif(trim(h.value), ''), concat('col_', CAST(g.col_idx AS VARCHAR))) AS header,
    coalesce(trim(v.value), '') AS value
FROM grid g
LEFT JOIN fx_cells h ON h.workbook = g.workbook AND h.sheet = g.sheet AND h.row_idx = g.start AND h.col_idx = g.col_idx
LEFT JOIN fx_cells v ON v.workbook = g.workbook AND v.sheet = g.sheet AND v.row_idx = g.row_idx AND v.col_idx = g.col_idx"""


@query("S13_sheet_to_table", SHEETS, CELLS)
def _(fx):
    return cells.sheet_values(cells.sheet_rows(fx.cells))


@query("S13_ingest_sheets", f"""
WITH p AS (SELECT workbook, sheet, count(DISTINCT CASE WHEN row_idx < 50 AND {FILLED} THEN row_idx END) AS data_rows,
    max(col_idx) + 1 AS width, max(row_idx) + 1 AS input_rows FROM fx_cells GROUP BY 1, 2),
q AS (SELECT *, data_rows > 5 AND width > 2 AS qualifies FROM p),
kept AS (SELECT * FROM (SELECT *, qualifies OR NOT bool_or(qualifies) OVER (PARTITION BY workbook) AS keep FROM q) k WHERE keep),
filled AS (SELECT workbook, sheet, row_idx, count(*) AS n FROM fx_cells WHERE {FILLED} GROUP BY 1, 2, 3),
heads AS (SELECT workbook, sheet, min(row_idx) AS header FROM filled WHERE row_idx < 10 AND n > 2 GROUP BY 1, 2),
counts AS (SELECT k.workbook, k.sheet, count(f.row_idx) AS output_rows FROM kept k
    LEFT JOIN heads h ON k.workbook = h.workbook AND k.sheet = h.sheet
    LEFT JOIN filled f ON k.workbook = f.workbook AND k.sheet = f.sheet AND f.row_idx > coalesce(h.header, 0)
    GROUP BY 1, 2)
SELECT concat(k.workbook, '/lighthouse_sheet_', right(k.sheet, 1)) AS stage, input_rows, output_rows
FROM kept k JOIN counts c ON k.workbook = c.workbook AND k.sheet = c.sheet""", CELLS)
def _(fx):
    runs = sheets.ingest_sheets(fx.cells, _folder(fx), FIRST)
    return runs.select("stage", "input_rows", "output_rows")


@query("S14_concat_chunks", "SELECT payroll_number, base_salary FROM fx_payroll", PAY)
def _(fx):
    df = fx.payroll.select("payroll_number", "base_salary", "pay_basis")
    hourly = F.col("pay_basis") == "per Hour"
    return snapshots.concat_chunks([df.where(hourly), df.where(~hourly)]).drop("pay_basis")


@query("S15_sheet_slug", """
SELECT DISTINCT concat('lighthouse_', regexp_replace(regexp_replace(lower(concat(p_name, ' (', p_type, ') - ', p_brand)),
    '[^\\w\\s-]', '', 'g'), '[-\\s]+', '_', 'g')) AS slug FROM part""")
def _(fx):
    name = F.concat("p_name", F.lit(" ("), "p_type", F.lit(") - "), "p_brand")
    return fx.table("part").select(sheet_slug(name).alias("slug")).distinct()
