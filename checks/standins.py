"""Views that give the test tables the shape of the payroll, posting and benchmark sources.

The same text runs on both engines; ``{ts}`` is the name of the type without time zone.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "fx_payroll": """
SELECT CAST(l.l_orderkey * 10 + l.l_linenumber AS VARCHAR(32)) AS payroll_number,
       CAST(year(l.l_shipdate) AS INT) AS fiscal_year,
       n.n_name AS agency_name,
       p.p_name AS title_description,
       CASE WHEN l.l_linestatus = 'O' THEN 'ACTIVE' ELSE 'CEASED' END AS leave_status_as_of_june_30,
       l.l_extendedprice AS base_salary,
       CASE WHEN l.l_returnflag = 'A' THEN 'per Annum' WHEN l.l_returnflag = 'R' THEN 'per Hour'
            WHEN l.l_linenumber % 2 = 0 THEN 'per Day' ELSE 'Prorated Annual' END AS pay_basis,
       l.l_quantity * 40 AS regular_hours,
       l.l_extendedprice * 0.9 AS regular_gross_paid,
       l.l_quantity AS ot_hours,
       CASE WHEN l.l_tax > 0 THEN l.l_extendedprice * l.l_tax END AS total_ot_paid,
       CASE WHEN l.l_discount > 0 THEN l.l_extendedprice * l.l_discount END AS total_other_pay
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey""",
    "fx_jobs": """
SELECT CAST(o.o_orderkey AS VARCHAR(32)) AS job_id, n.n_name AS agency,
       CASE WHEN o.o_orderstatus = 'O' THEN 'External' ELSE 'Internal' END AS posting_type,
       CAST(o.o_orderkey % 4 + 1 AS VARCHAR(8)) AS number_of_positions,
       CASE o.o_orderkey % 4 WHEN 0 THEN p.p_name WHEN 1 THEN concat(upper(p.p_name), '!')
            WHEN 2 THEN concat(p.p_name, ' ii') ELSE concat(lower(p.p_type), ' ', p.p_name)
       END AS business_title,
       p.p_name AS title_description,
       o.o_orderpriority AS career_level,
       o.o_totalprice * 0.8 AS salary_range_from,
       CASE WHEN o.o_orderkey % 7 <> 0 THEN o.o_totalprice END AS salary_range_to,
       concat(replace(CAST(o.o_orderdate AS VARCHAR(32)), ' ', 'T'), '.000') AS posting_date,
       CASE WHEN o.o_orderkey % 5 <> 0 THEN concat(replace(CAST(o.o_orderdate
            + INTERVAL 45 DAY AS VARCHAR(32)), ' ', 'T'), '.000') END AS process_date,
       CASE WHEN o.o_orderkey % 10 <> 0 THEN concat(replace(CAST(o.o_orderdate
            + INTERVAL 20 DAY AS VARCHAR(32)), ' ', 'T'), '.000') END AS posting_updated,
       concat(replace(CAST(o.o_orderdate
            + INTERVAL 30 DAY AS VARCHAR(32)), ' ', 'T'), '.000') AS application_deadline
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN part p ON p.p_partkey = o.o_orderkey % (SELECT count(*) FROM part)""",
    "fx_benchmark": """
SELECT p.p_name AS job_title, count(*) AS total_postings,
       CAST(avg(p.p_size) AS DOUBLE) AS median_posting_duration,
       CAST(CAST(CAST(avg(p.p_retailprice) AS DECIMAL(24,6)) AS DECIMAL(18,2)) AS DOUBLE) * 60
           AS median_salary,
       min(p.p_brand) AS top_skills, min(p.p_type) AS education_requirements,
       max(p.p_type) AS experience_level
FROM part p GROUP BY p.p_name""",
    "fx_fact_jobs": """
SELECT job_id, CASE WHEN k % 200 <> 0 THEN agency END AS agency,
       CAST(number_of_positions AS INT) AS number_of_positions,
       CASE WHEN k % 300 <> 0 THEN business_title END AS business_title,
       CAST(CASE WHEN k % 90 = 0 THEN salary_range_from * 3 ELSE salary_range_from END
            AS DECIMAL(12,2)) AS salary_range_from,
       CAST(salary_range_to AS DECIMAL(12,2)) AS salary_range_to,
       CASE WHEN k % 11 <> 0 THEN CAST(posting_date AS {ts}) END AS posting_date,
       CAST(CASE WHEN k % 50 = 0 THEN -1 WHEN k % 51 = 0 THEN 400 WHEN k % 53 = 0 THEN NULL
            ELSE 10 + k % 60 END AS INT) AS posting_duration_days,
       CASE WHEN k % 3 <> 0 THEN CAST(0.60 + (k % 41) / 100.0 AS DECIMAL(5,4))
       END AS best_match_score,
       CASE WHEN k % 3 <> 0 AND k % 41 >= 25 THEN CAST(salary_range_from AS DECIMAL(12,2))
       END AS payroll_salary_min,
       CASE WHEN k % 3 <> 0 AND k % 41 >= 30 THEN CAST(salary_range_to AS DECIMAL(12,2))
       END AS payroll_salary_max
FROM (SELECT *, CAST(job_id AS BIGINT) AS k FROM fx_jobs) j""",
    "fx_fact_durations": """
SELECT CASE WHEN k % 40 = 1 THEN concat('x', job_id) ELSE job_id END AS job_id, agency,
       business_title, actual_posting_duration_days, lighthouse_median_posting_duration,
       CAST(actual_posting_duration_days - lighthouse_median_posting_duration AS DECIMAL(8,2))
           AS duration_variance,
       CAST((actual_posting_duration_days - lighthouse_median_posting_duration)
            / lighthouse_median_posting_duration * 100 AS DECIMAL(8,2)) AS duration_variance_pct,
       CASE WHEN k % 5 <> 0 THEN CAST(0.65 + (k % 36) / 100.0 AS DECIMAL(5,4))
       END AS lighthouse_match_score
FROM (SELECT job_id, agency, business_title, CAST(job_id AS BIGINT) AS k,
             posting_duration_days AS actual_posting_duration_days,
             CAST(CASE CAST(job_id AS BIGINT) % 4 WHEN 1 THEN 20 WHEN 2 THEN 25 ELSE 40 END
                  AS DECIMAL(8,2)) AS lighthouse_median_posting_duration
      FROM fx_fact_jobs) j""",
}


def _cells_column(col: int) -> str:
    """Sheets of 50 rows: a title (but for one sheet in four), a header, data and blank rows."""
    title = "CASE WHEN s <> 3 THEN ' Postings ' ELSE '' END" if col == 0 else "''"
    header = ("'Job Id'", "' '", "CASE WHEN s = 2 THEN '' ELSE ' Status ' END",
              "CASE WHEN s = 2 THEN '' ELSE 'Flag' END")[col]
    data = ("CAST(k AS VARCHAR(32))", "concat(' ', o_orderpriority, ' ')", "o_orderstatus",
            "CASE WHEN k % 5 = 0 THEN 'x' END")[col]
    return f"""
SELECT concat('wb', CAST(w AS VARCHAR(32))) AS workbook,
       concat('Sheet ', CAST(s AS VARCHAR(8))) AS sheet, CAST(row_idx AS INT) AS row_idx,
       CAST({col} AS INT) AS col_idx,
       CASE row_idx WHEN 0 THEN {title} WHEN 1 THEN {header}
            ELSE CASE WHEN k % 7 = 0 THEN '' ELSE {data} END END AS value
FROM (SELECT o_orderkey AS k, o_orderpriority, o_orderstatus, o_orderkey % 4 AS s,
             CAST(floor(o_orderkey / 200) AS BIGINT) AS w,
             CAST(floor((o_orderkey % 200) / 4) AS BIGINT) AS row_idx
      FROM orders) o{col}"""


VIEWS["fx_cells"] = (
    "SELECT * FROM ("
    + "\nUNION ALL".join(_cells_column(c) for c in range(4))
    + ") cells WHERE value IS NOT NULL"
)
# Which view reads which.
_NEEDS = {"fx_fact_jobs": ["fx_jobs"], "fx_fact_durations": ["fx_fact_jobs"]}
TABLES = ("lineitem", "part", "supplier", "nation", "orders", "customer")


def _closure(names) -> list[str]:
    wanted: list[str] = []
    for name in names:
        for need in [*_closure(_NEEDS.get(name, [])), name]:
            if need not in wanted:
                wanted.append(need)
    return wanted


def oracle(names, body: str) -> str:
    """The query with the views it needs as common table expressions.

    They are materialized: DuckDB 2.0.0 can fail internally when it filters the dictionary-coded
    strings of a view that it has inlined.
    """
    parts = [f"{n} AS MATERIALIZED ({VIEWS[n].format(ts='TIMESTAMP')}\n)" for n in _closure(names)]
    body = body.strip()
    for start in ("WITH RECURSIVE ", "WITH "):
        if body.startswith(start) and parts:
            return start + ",\n".join(parts) + ",\n" + body.removeprefix(start)
    return "WITH " + ",\n".join(parts) + "\n" + body if parts else body


class Fx:
    """Lazy stand-in DataFrames over one folder of test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        parts = [f"{n} AS ({VIEWS[n].format(ts='TIMESTAMP_NTZ')}\n)" for n in _closure([name])]
        text = "WITH " + ",\n".join(parts) + f"\nSELECT * FROM {name}"
        used = {}
        for t in TABLES:
            marked = text.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t}", f"JOIN {{{t}}}")
            if marked != text:
                text, used[t] = marked, self.table(t)
        return self.spark.sql(text, **used)

    @cached_property
    def payroll(self) -> DataFrame:
        return self.view("fx_payroll")

    @cached_property
    def jobs(self) -> DataFrame:
        return self.view("fx_jobs")

    @cached_property
    def benchmark(self) -> DataFrame:
        return self.view("fx_benchmark")

    @cached_property
    def fact_jobs(self) -> DataFrame:
        return self.view("fx_fact_jobs")

    @cached_property
    def fact_durations(self) -> DataFrame:
        return self.view("fx_fact_durations")

    @cached_property
    def cells(self) -> DataFrame:
        return self.view("fx_cells")
