"""Helpers shared by the operators: row maps with bounded batches, folds, hashes, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from paygrain.session import materialize

ROWS_AT_ONCE = 256
OUTPUT_BYTES = 8 << 20
PARTIAL = StructType(
    [StructField("i", IntegerType()), StructField("values", ArrayType(DoubleType()))]
)


def fold(doc_id: Column, of: int = 5) -> Column:
    """crc32 of the id as text, modulo ``of``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % of


def whole_texts(docs: DataFrame, *more: str) -> DataFrame:
    """(doc_id as long, text), a null text as the empty text; other columns are left behind."""
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["text"], F.lit("")).alias("text"),
        *[docs[c] for c in more],
    )


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs started inside hand at most so many rows at once to Python: for wide rows, whose bytes Arrow does not count."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs planned and run inside leave no shuffle files behind once they have ended."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _size(value) -> int:
    return len(value) if isinstance(value, (str, bytes, list)) else 8


def map_slices(df: DataFrame, make: Callable[[], Callable], schema: StructType) -> DataFrame:
    """``make()`` gives, once a task, a function from the columns of a slice of rows (lists) to rows.

    Input is taken in slices and output is handed back in batches of a few megabytes, so that a
    task holds a bounded number of texts (one at least) whatever the partition holds.
    """
    arrow = to_arrow_schema(schema)

    def batch(rows: list) -> pa.RecordBatch:
        columns = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, out, held = make(), [], 0
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                part = whole.slice(start, ROWS_AT_ONCE)
                for made in f(*[c.to_pylist() for c in part.columns]):
                    out.append(made)
                    held += sum(map(_size, made))
                    if held >= OUTPUT_BYTES:
                        yield batch(out)
                        out, held = [], 0
        if out:
            yield batch(out)

    return df.mapInArrow(run, schema)


def map_rows(df: DataFrame, make: Callable[[], Callable], schema: StructType) -> DataFrame:
    """As :func:`map_slices`, with a function from the values of a row to a list of rows."""

    def by_row():
        f = make()
        return lambda *columns: (made for row in zip(*columns) for made in f(*row))

    return map_slices(df, by_row, schema)


def filter_rows(docs: DataFrame, make: Callable[[], Callable[[str], bool]]) -> DataFrame:
    """The rows of ``docs`` whose whole text ``make()(text)`` accepts, all columns as they are; no shuffle.

    A null text is given as the empty text.
    """
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        accepts = make()
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                part = whole.slice(start, ROWS_AT_ONCE)
                keep = [accepts(t or "") for t in part.column(at).to_pylist()]
                yield part.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the smallest node reachable, for every node of the edges (u, v).

    Each round points every node to its smallest neighbour, follows the pointers to their ends and
    contracts the edges to those ends. A round at least halves the number of nodes that
    still have edges, and following pointers doubles its reach with every join, so the number of
    jobs is logarithmic. Nothing but "is anything left" comes to the driver. Hot nodes are met
    by map-side combined minima and by plain joins that can be split where they are skewed.
    """

    def tidy(e: DataFrame) -> DataFrame:
        pair = e.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
        return materialize(pair.where("u < v").distinct(), f"{name}-edges")

    edges, found = tidy(edges), None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        up = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("low"))
        up = up.select("node", F.least("node", "low").alias("root"))
        while True:
            up = materialize(up, f"{name}-roots")
            next_up = up.select(F.col("node").alias("root"), F.col("root").alias("next"))
            hop = up.join(next_up, "root").select("node", "root", "next")
            if hop.where(F.col("root") != F.col("next")).isEmpty():
                break
            up = hop.select("node", F.col("next").alias("root"))
        root = up.select(F.col("node").alias("u"), F.col("root").alias("ru"))
        edges = tidy(
            edges.join(root, "u")
            .join(root.select(F.col("u").alias("v"), F.col("ru").alias("rv")), "v")
            .select(F.col("ru").alias("u"), F.col("rv").alias("v"))
        )
        if found is None:
            found = up
        else:
            again = up.select(F.col("node").alias("root"), F.col("root").alias("next"))
            found = found.join(again, "root", "left").select(
                "node", F.coalesce("next", "root").alias("root")
            )
            found = materialize(found, f"{name}-found")
    if found is None:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.select("node", F.col("root").alias("component"))


def summed(rows: DataFrame, partial: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """The sum over all rows of the matrix that ``partial`` gives for a batch; empty without rows.

    Tasks add up their batches, Spark adds up the cells of the tasks. The matrix must have a size that does
    not depend on the data: it comes to the driver.
    """
    arrow = to_arrow_schema(PARTIAL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                part = partial(b)
                total = part if total is None else total + part
        if total is not None:
            columns = [pa.array(range(len(total)), pa.int32()), pa.array(list(total), arrow.field(1).type)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    cells = rows.mapInArrow(run, PARTIAL).select("i", F.posexplode("values").alias("j", "x"))
    got = cells.groupBy("i", "j").agg(F.sum("x").alias("x")).toArrow()
    if not got.num_rows:
        return np.zeros((0, 0))
    i, j = got["i"].to_numpy(), got["j"].to_numpy()
    total = np.zeros((i.max() + 1, j.max() + 1))
    total[i, j] = got["x"].to_numpy()
    return total
