"""Workbook sheets, as a table of cells, to stored tables with a record for each sheet."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paygrain.functions.text import sheet_slug
from paygrain.session import materialize
from paygrain.sources import cells as sheets
from paygrain.sources import snapshots

SOURCE, HEADS = "sheets", "sheet_heads"
# Read with their types: the name of a workbook such as 007 is no number.
ROW_SCHEMA = "sheet string, row_idx int, filled map<int,string>, workbook string, slug string"
HEAD_SCHEMA = "workbook string, sheet string, title string, width int, heads map<int,string>"
ROWS_A_FILE = 1_000_000
# More sheets than this share files: a file for each would cost more than its rows.
OWN_FILES = 1_000


def ingest_sheets(cells: DataFrame, root: str, as_of: dt.datetime) -> DataFrame:
    """Store every sheet that holds a table, and a run record for each; the records.

    The rows of all kept sheets are put together and written once, with their filled cells only. Up to ``OWN_FILES`` sheets
    lie in folders of workbook and slug: a sheet is one file, a large one a file for each million of its rows. More sheets
    share files, whose rows are sorted by workbook, slug and row, so that the files grow with the rows and not with the
    sheets, and a reader of one sheet skips the rest by their value ranges. A table of the heads,
    a row a sheet, goes beside them, and the records are one more write. Nothing is done sheet by sheet on the
    driver, however many there are. A kept sheet without rows below its header has a record with no
    output. :func:`read_sheet` gives a sheet with its own column names.
    """
    spark = cells.sparkSession
    profile = materialize(sheets.profile_sheets(cells), "sheet-profile")
    top = materialize(sheets.top_cells(cells, profile), "sheet-tops")
    rows, heads = sheets.sparse_rows(cells, keep=profile, top=top)
    stamp = as_of.strftime(snapshots.TIMESTAMP_FORMAT)
    snapshots.begin_snapshot(spark, root, SOURCE, stamp)
    heads_path = snapshots.snapshot_path(root, HEADS, as_of)
    heads.write.mode("overwrite").parquet(heads_path)
    path = snapshots.snapshot_path(root, SOURCE, as_of)
    rows = rows.withColumn("slug", sheet_slug(F.col("sheet")))
    part = F.floor(F.col("row_idx") / ROWS_A_FILE)
    dealt = rows.repartition("workbook", "slug", part)
    if profile.where("keep").count() <= OWN_FILES:
        dealt.write.mode("overwrite").partitionBy("workbook", "slug").parquet(path)
    else:
        dealt.sortWithinPartitions("workbook", "slug", "row_idx").write.mode("overwrite").parquet(path)
    stored_rows = spark.read.schema(ROW_SCHEMA).parquet(path)
    snapshots.commit_snapshot(spark, root, SOURCE, stamp, stored_rows.count())
    counts = stored_rows.groupBy(*sheets.SHEET).agg(F.count("*").alias("n_rows"))
    known = spark.read.schema(HEAD_SCHEMA).parquet(heads_path)
    found = counts.join(known, sheets.SHEET).select(*sheets.SHEET, "title", "n_rows", sheets.headers().alias("headers"))
    stored = profile.where("keep").join(found, sheets.SHEET, "left")
    none = F.array().cast("array<string>")
    records = stored.select(
        F.concat_ws("/", "workbook", sheet_slug(F.col("sheet"))).alias("stage"),
        F.col("max_row").cast("long").alias("input_rows"),
        F.coalesce("n_rows", F.lit(0)).cast("long").alias("output_rows"),
        F.coalesce("headers", none).alias("columns"),
        F.array(F.lit("header_detection")).alias("transformations"),
        F.create_map().cast("map<string,double>").alias("thresholds"),
        F.to_json(F.struct("workbook", "sheet", "title")).alias("details"),
        F.lit(as_of).cast("timestamp_ntz").alias("processed_timestamp"),
    )
    snapshots.append_runs(records, root)
    return snapshots.read_runs(spark, root).where(F.col("processed_timestamp") == F.lit(as_of).cast("timestamp_ntz"))


def read_sheet(spark: SparkSession, root: str, workbook: str, sheet: str) -> DataFrame | None:
    """The newest stored table of a sheet, with its header as column names; None for one without rows."""
    found = snapshots.list_snapshots(spark, root, SOURCE)
    if not found:
        return None
    stamp, path = found[-1]
    here = (F.col("workbook") == workbook) & (F.col("sheet") == sheet)
    rows = spark.read.schema(ROW_SCHEMA).parquet(path).where(here)
    heads = spark.read.schema(HEAD_SCHEMA).parquet(f"{root}/{HEADS}/snapshot_ts={stamp}").where(here)
    head = heads.select(sheets.headers().alias("headers")).first()
    if head is None or rows.isEmpty():
        return None
    sheets.check_names(sheet, head.headers)
    # The filled cells fall into their columns in one pass over them, however wide the sheet is.
    wide = T.StructType([T.StructField(str(j), T.StringType()) for j in range(len(head.headers))])
    row = F.from_json(F.to_json("filled"), wide).alias("row")
    return rows.select(row).select("row.*").na.fill("").toDF(*head.headers)
