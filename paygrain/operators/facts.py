"""The two fact tables: column order, types, audit stamps and loading."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paygrain.functions.columns import lenient_timestamp, money, stamp
from paygrain.session import materialize
from paygrain.sources.schemas import FACT_DURATION, FACT_POSTINGS


def _width(data_type: str) -> int | None:
    found = re.fullmatch(r"varchar\((\d+)\)", data_type)
    return int(found.group(1)) if found else None


def _conformed(df: DataFrame, name: str, data_type: str, check_widths: bool) -> Column:
    if name not in df.columns:
        kind = "string" if _width(data_type) else data_type
        return F.lit(None).cast(kind).alias(name)
    col, source = F.col(name), dict(df.dtypes)[name]
    width = _width(data_type)
    if width:
        col = col.cast("string")
        if check_widths:
            problem = F.raise_error(F.lit(f"{name}: longer than {width} characters"))
            col = F.when(F.length(col) > width, problem).otherwise(col)
    elif data_type.startswith("decimal") and source in ("double", "float"):
        precision, scale = map(int, re.findall(r"\d+", data_type))
        col = money(col, precision, scale)
    elif data_type.startswith("timestamp") and source == "string":
        col = lenient_timestamp(col)
    else:
        col = col.try_cast(data_type)
    return col.alias(name)


def declared_widths(ddl: Mapping[str, str]) -> dict[str, int]:
    """Widths of the varchar columns of a definition."""
    found = ((name, re.fullmatch(r"varchar\((\d+)\)", kind)) for name, kind in ddl.items())
    return {name: int(m[1]) for name, m in found if m}


def conform(
    df: DataFrame,
    ddl: Mapping[str, str],
    as_of: dt.datetime | None = None,
    check_widths: bool = False,
) -> DataFrame:
    """Columns of ``ddl`` in order and type plus the audit stamps; absent ones become null."""
    return df.select(
        *[_conformed(df, n, t, check_widths) for n, t in ddl.items()],
        stamp(as_of).alias("created_at"),
        stamp(as_of).alias("updated_at"),
    )


def conform_postings(df: DataFrame, **options) -> DataFrame:
    return conform(df, FACT_POSTINGS, **options)


def dense_ids(df: DataFrame, name: str, first_by: Sequence[str] = ()) -> DataFrame:
    """The rows with a first column ``name``, numbered from 1 without a gap.

    The order is that of ``first_by`` and then of all other columns, so the ids depend on the rows
    alone, not on how they are dealt; equal rows are interchangeable. It is a prefix sum: the rows are dealt
    by ranges and sorted where they lie (equal rows are split by a salt), stored with their place, and each
    partition adds the number of rows before it. Only the counts, a row a partition, meet in one task.
    """
    order = [*first_by, *[c for c in df.columns if c not in first_by], "_salt"]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.withColumn("_salt", F.monotonically_increasing_id()).repartitionByRange(parts, *order)
    # The generated number has the partition in its upper bits and the place in the lower 33.
    placed = dealt.sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    stored = materialize(placed.drop("_salt"), "dense-ids").withColumn("_part", F.shiftright("_at", 33))
    counts = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return stored.join(F.broadcast(before), "_part").select(place.cast("long").alias(name), *df.columns)


def conform_duration(df: DataFrame, with_id: bool = True, **options) -> DataFrame:
    """The duration column gets its fact name. The surrogate id is dense and follows the order of the postings."""
    named = df.withColumnRenamed("posting_duration_days", "actual_posting_duration_days")
    fact = conform(named, FACT_DURATION, **options)
    return dense_ids(fact, "duration_analysis_id", ["job_id"]) if with_id else fact


def _location(spark: SparkSession, table: str) -> str | None:
    """Folder of a catalog table, None if there is no such table."""
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[-1].data_type


def _point(spark: SparkSession, table: str, folder: str, schema: StructType) -> None:
    """Make ``folder`` the content of a table: one change of the catalog."""
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path=folder, source="parquet", schema=schema)


def load_facts(
    loads: Mapping[str, DataFrame],
    path: str | None = None,
    check: Callable[..., object] | None = None,
) -> dict[str, str]:
    """Full refresh of catalog tables, all or none; returns the folder of each.

    Every table is written beside its present content, to a new folder ``load=<id>`` below ``<path>/<table>`` (by default below
    the warehouse). Once all are there, and ``check`` of the staged tables has not raised, each table is pointed
    to its new folder by one change of the catalog. A load that dies before that changes no table; if a
    change fails, those made already are taken back. Earlier folders stay, for readers that still use them and to
    return to; a retention rule may remove all but the present one. Columns that differ from those of an existing
    table raise before any change.
    """
    spark = next(iter(loads.values())).sparkSession
    base = (path or f"{spark.conf.get('spark.sql.warehouse.dir')}/loads").rstrip("/")
    load, staged = uuid.uuid4().hex, {}
    for table, df in loads.items():
        if spark.catalog.tableExists(table) and spark.table(table).dtypes != df.dtypes:
            raise ValueError(f"the columns of {table} have changed")
    for table, df in loads.items():
        staged[table] = f"{base}/{table}/load={load}"
        df.write.parquet(staged[table])
    if check is not None:
        check(*[spark.read.schema(loads[t].schema).parquet(f) for t, f in staged.items()])
    before, changed = {t: _location(spark, t) for t in staged}, []
    try:
        for table, folder in staged.items():
            changed.append(table)
            _point(spark, table, folder, loads[table].schema)
    except BaseException:
        for table in changed:
            if before[table] is not None:
                _point(spark, table, before[table], loads[table].schema)
            elif spark.catalog.tableExists(table):
                spark.sql(f"DROP TABLE {table}")
        raise
    return staged


def load_fact(df: DataFrame, table: str, path: str | None = None) -> str:
    """:func:`load_facts` of one table."""
    return load_facts({table: df}, path)[table]


def load_fact_jdbc(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str], batch_size: int = 1000
) -> None:
    """Full refresh of a database table; keeps its definition and inserts in batches."""
    writer = df.write.mode("overwrite").option("truncate", True).option("batchsize", batch_size)
    writer.jdbc(url, table, properties=dict(properties))
