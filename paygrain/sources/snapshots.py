"""Landed sources, time-stamped snapshots and run metadata.

Layout: ``<root>/<source>/snapshot_ts=<yyyyMMdd_HHmmss>/``. Snapshots are found in a log below the root, whose
rows are written before and after the data, so that a reader opens the files of one whole snapshot only.
"""

from __future__ import annotations

import datetime as dt
import json
import time
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIMESTAMP_FORMAT = "%Y%m%d_%H%M%S"
LOG, LOG_SCHEMA = "snapshot_log", "source string, stamp string, n_rows bigint, at bigint"
# Landed JSON lines are packed, as field names repeat in every row. Packed files cannot be split, so their rows are bounded.
JSON_OPTIONS = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 250_000}
METADATA_SCHEMA = (
    "stage string, input_rows bigint, output_rows bigint, columns array<string>, "
    "transformations array<string>, thresholds map<string,double>, details string, "
    "processed_timestamp timestamp_ntz"
)


# ---- readers --------------------------------------------------------------------------------


def read_raw_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    lines: bool = False,
    wrapped: bool = False,
    corrupt: str | None = None,
) -> DataFrame:
    """Rows of a JSON array per file, or (``lines``) of one object a line, or (``wrapped``) of the lists in
    ``{"data": [...]}`` objects in either layout.

    Only lines can be split over tasks; a file in the other layout is read by one task. Text that is no
    JSON raises, unless ``corrupt`` names a column that then holds it (null for good rows).
    """
    shape = T.StructType([T.StructField("data", T.ArrayType(schema))]) if wrapped else schema
    names = [f.name for f in schema.fields]
    if corrupt is None:
        df = spark.read.schema(shape).json(path, multiLine=not lines, mode="FAILFAST")
        return df.select(F.inline("data")) if wrapped else df
    shape = T.StructType([*shape.fields, T.StructField(corrupt, T.StringType())])
    df = spark.read.schema(shape).json(
        path, multiLine=not lines, mode="PERMISSIVE", columnNameOfCorruptRecord=corrupt
    )
    if not wrapped:
        return df
    rows = df.select(corrupt, F.explode_outer("data").alias("row"))
    return rows.where(F.col("row").isNotNull() | F.col(corrupt).isNotNull()).select(
        *[F.col("row")[n].alias(n) for n in names], corrupt
    )


def read_benchmark(spark: SparkSession, path: str) -> DataFrame:
    """Free column names; csv or json by suffix, all values as text."""
    if path.endswith(".csv"):
        return spark.read.csv(path, header=True)
    if path.endswith(".json"):
        return spark.read.json(path, multiLine=True, primitivesAsString=True)
    raise ValueError(f"unsupported format: {path}")


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _log_event(spark: SparkSession, root: str, source: str, stamp: str, rows: int | None) -> None:
    """Append to the snapshot log: a write has begun (``rows`` null) or ended."""
    event = spark.range(0, 1, 1, 1).select(
        F.lit(source).alias("source"),
        F.lit(stamp).alias("stamp"),
        F.lit(rows).cast("long").alias("n_rows"),
        F.lit(time.time_ns()).alias("at"),
    )
    event.write.mode("append").partitionBy("source").parquet(f"{root}/{LOG}")


def begin_snapshot(spark: SparkSession, root: str, source: str, stamp: str) -> None:
    """Hide a snapshot folder, if there is one, until :func:`commit_snapshot`."""
    _log_event(spark, root, source, stamp, None)


def commit_snapshot(spark: SparkSession, root: str, source: str, stamp: str, rows: int) -> None:
    """Make a snapshot folder known to the readers; for folders that another tool has written whole."""
    _log_event(spark, root, source, stamp, rows)


def snapshot_log(spark: SparkSession, root: str) -> DataFrame:
    """(source, stamp, n_rows, at) of the committed snapshots below ``root``.

    A snapshot counts while the last event of its folder is the end of a write, so one that was never ended, or
    that is being replaced, does not.
    """
    try:
        events = spark.read.schema(LOG_SCHEMA).parquet(f"{root}/{LOG}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        events = spark.createDataFrame([], LOG_SCHEMA)
    last = events.groupBy("source", "stamp").agg(
        F.max_by("n_rows", "at").alias("n_rows"), F.max("at").alias("at")
    )
    return last.where(F.col("n_rows").isNotNull())


def list_snapshots(spark: SparkSession, root: str, source: str) -> list[tuple[str, str]]:
    """(timestamp text, path) of the committed snapshots of a source, oldest first."""
    found = snapshot_log(spark, root).where(F.col("source") == source).select("stamp")
    return sorted((r.stamp, _folder(root, source, r.stamp)) for r in found.collect())


def _read_snapshot(
    spark: SparkSession, root: str, source: str, path: str, schema: T.StructType | None
) -> DataFrame:
    base = f"{root}/{source}"
    if schema is None:
        return spark.read.option("basePath", base).parquet(path)
    return read_raw_json(spark, path, schema, lines=True).withColumn(
        "snapshot_ts", F.lit(path.rsplit("snapshot_ts=", 1)[1])
    )


def latest_snapshot(
    spark: SparkSession, root: str, source: str, schema: T.StructType | None = None
) -> DataFrame | None:
    """Last snapshot by name; Parquet, or JSON lines if a schema is given."""
    found = list_snapshots(spark, root, source)
    return _read_snapshot(spark, root, source, found[-1][1], schema) if found else None


def recent_snapshot(
    spark: SparkSession,
    root: str,
    source: str,
    as_of: dt.datetime,
    max_age_hours: float = 24,
    schema: T.StructType | None = None,
) -> DataFrame | None:
    """Newest snapshot younger than ``max_age_hours`` at ``as_of``; malformed names are skipped."""
    cutoff = as_of - dt.timedelta(hours=max_age_hours)
    for stamp, path in reversed(list_snapshots(spark, root, source)):
        try:
            taken = dt.datetime.strptime(stamp, TIMESTAMP_FORMAT)
        except ValueError:
            continue
        if taken > cutoff:
            return _read_snapshot(spark, root, source, path, schema)
    return None


def limit_rows(df: DataFrame, n: int, order_by: Sequence[str] = ()) -> DataFrame:
    """At most n rows to ingest; the first ones in order if an order is given."""
    return (df.orderBy(*order_by) if order_by else df).limit(int(n))


def concat_chunks(chunks: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, chunks)


# ---- writers --------------------------------------------------------------------------------


def _folder(root: str, source: str, stamp: str) -> str:
    return f"{root}/{source}/snapshot_ts={stamp}"


def snapshot_path(root: str, source: str, as_of: dt.datetime) -> str:
    return _folder(root, source, as_of.strftime(TIMESTAMP_FORMAT))


def write_counted(
    df: DataFrame, path: str, file_format: str = "parquet", measures: Sequence[Column] = ()
) -> dict[str, object]:
    """Write; the number of ``rows`` and other aggregates, taken by the writing job itself."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *measures)
    options = JSON_OPTIONS if file_format == "json" else {}
    counted.write.mode("overwrite").format(file_format).options(**options).save(path)
    return seen.get


def write_snapshot(
    df: DataFrame,
    root: str,
    source: str,
    as_of: dt.datetime,
    file_format: str = "parquet",
    measures: Sequence[Column] = (),
) -> dict[str, object]:
    """:func:`write_counted` into the folder of the snapshot, which readers see once the log has its end."""
    spark, stamp = df.sparkSession, as_of.strftime(TIMESTAMP_FORMAT)
    begin_snapshot(spark, root, source, stamp)
    counted = write_counted(df, snapshot_path(root, source, as_of), file_format, measures)
    commit_snapshot(spark, root, source, stamp, counted["rows"])
    return counted


def write_raw(df: DataFrame, root: str, source: str, as_of: dt.datetime) -> int:
    return write_snapshot(df, root, source, as_of, "json")["rows"]


def write_processed(df: DataFrame, root: str, name: str, as_of: dt.datetime) -> int:
    return write_snapshot(df, root, name, as_of)["rows"]


def record_run(
    spark: SparkSession,
    root: str,
    stage: str,
    input_rows: int | None,
    output_rows: int | None,
    columns: Sequence[str],
    transformations: Sequence[str],
    as_of: dt.datetime,
    thresholds: Mapping[str, float] | None = None,
    details: Mapping[str, object] | None = None,
) -> None:
    """Append one row to the run metadata table."""
    limits = {k: float(v) for k, v in (thresholds or {}).items()}
    row = (
        stage, input_rows, output_rows, list(columns), list(transformations), limits,
        json.dumps(details or {}, default=str), as_of,
    )
    append_runs(spark.createDataFrame([row], METADATA_SCHEMA).coalesce(1), root)


def append_runs(records: DataFrame, root: str) -> None:
    """Append rows of the run metadata table."""
    records.write.mode("append").parquet(f"{root}/run_metadata")


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(METADATA_SCHEMA).parquet(f"{root}/run_metadata")
