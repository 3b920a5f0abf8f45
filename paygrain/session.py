"""Session settings and the shared scratch area for intermediate tables."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Sequence
from weakref import WeakKeyDictionary

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where that costs one more shuffle downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, set as a setting or on the context.

    A local session without it uses its warehouse folder; any other is refused.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured
    if sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
        return spark.conf.get("spark.sql.warehouse.dir")
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")


RUNS_SCHEMA = "run string, event string, at bigint"
_begun: set[tuple[str, str]] = set()
_stored: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()  # folders of the intermediate tables


def _base(spark: SparkSession) -> str:
    return f"{scratch_dir(spark).rstrip('/')}/paygrain"


def _log_run(spark: SparkSession, run: str, event: str) -> None:
    row = spark.range(0, 1, 1, 1).select(
        F.lit(run).alias("run"), F.lit(event).alias("event"), F.lit(time.time_ns()).alias("at")
    )
    row.write.mode("append").parquet(f"{_base(spark)}/runs")


def run_dir(spark: SparkSession) -> str:
    """Folder of the intermediate tables of this application; its first use is recorded."""
    run, base = spark.sparkContext.applicationId, _base(spark)
    if (base, run) not in _begun:
        _log_run(spark, run, "begin")
        _begun.add((base, run))
    return f"{base}/run-{run}"


def end_run(spark: SparkSession) -> None:
    """Record that nothing reads the intermediate tables of this application any more."""
    run, base = spark.sparkContext.applicationId, _base(spark)
    _log_run(spark, run, "end")
    _begun.discard((base, run))


def sweep_scratch(spark: SparkSession, max_age: dt.timedelta | None = None) -> list[str]:
    """Empty the folders of ended runs; their names.

    A run that was lost never records its end: with ``max_age`` those that began longer ago are emptied too, except for
    this application. A folder is overwritten by a table without rows, so that any file system that Spark can write to
    will do. A run that began again after its end, or after a sweep, is open.
    """
    base, mine = _base(spark), spark.sparkContext.applicationId
    try:
        events = spark.read.schema(RUNS_SCHEMA).parquet(f"{base}/runs")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    last = events.groupBy("run").agg(F.max_by("event", "at").alias("event"), F.max("at").alias("at"))
    stale = F.col("event") == "end"
    if max_age is not None:
        before = time.time_ns() - int(max_age.total_seconds() * 1e9)
        stale |= (F.col("event") == "begin") & (F.col("at") < before) & (F.col("run") != mine)
    swept = sorted(r.run for r in last.where(stale).select("run").collect())  # a name a run
    for run in swept:
        spark.range(0).write.mode("overwrite").parquet(f"{base}/run-{run}")
        _log_run(spark, run, "swept")
    return swept


def materialize(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the scratch area and read it back.

    Used for compact, aggregated tables that several later steps read. It cuts the lineage
    (a lost executor does not redo the work) and gives the planner the true size, so that a
    join against the table is broadcast only if it fits ``spark.sql.autoBroadcastJoinThreshold``
    and is a skew-splittable sort-merge join otherwise. The tables stay until :func:`sweep_scratch`, or until
    they are given to :func:`emptied`.
    """
    spark = df.sparkSession
    path = f"{run_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, partitionBy=list(by) or None)
    table = spark.read.schema(df.schema).parquet(path)
    _stored[table] = path
    return table


def emptied(*tables: DataFrame) -> None:
    """Free the disk of results of :func:`materialize` that nothing will read again, as :func:`sweep_scratch` does."""
    for table in tables:
        table.sparkSession.range(0).write.mode("overwrite").parquet(_stored.pop(table))
