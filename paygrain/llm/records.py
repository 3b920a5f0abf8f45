"""Token ids as length-delimited binary records with a separate offset index.

A record is: length of the payload (unsigned 64 bit), masked crc32 of these eight bytes (32 bit), the
payload, masked crc32 of the payload (32 bit); all little-endian. The payload holds the ids, two bytes each if
the vocabulary has at most 65,536 ids, else four. The index is a Parquet table with a row for
each record. It is written by Spark's committer after the files, and only files named in it
count: a task that is run again writes a file of another name, and what a lost attempt left is never read.

Files are written and read through Arrow where it opens the store. Where only Spark does, the framed records
are the rows of a Parquet table beside the index, in files of Spark's committer; all else is the same.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from paygrain.llm.common import ROWS_AT_ONCE, dropped_shuffles, map_rows, whole_texts
from paygrain.llm.word_bpe import encoder

# Fixed value: the rotation constant of masked checksums in record files.
MASK_DELTA = 0xA282EAD8
HEAD, TAIL = struct.Struct("<QI"), struct.Struct("<I")
FLUSH_BYTES, INDEX_ROWS = 4 << 20, 50_000

INDEX = StructType(
    [
        StructField("part", IntegerType()),
        StructField("file", StringType()),
        StructField("record", LongType()),
        StructField("doc_id", LongType()),
        StructField("offset", LongType()),
        StructField("length", LongType()),
        StructField("width", IntegerType()),
        StructField("start_in_file", LongType()),
        StructField("n_tokens", LongType()),
    ]
)
FRAMES = StructType([*INDEX, StructField("data", BinaryType())])
RECORDS = StructType(
    [
        StructField("file", StringType()),
        StructField("record", LongType()),
        StructField("doc_id", LongType()),
        StructField("ids", BinaryType()),
    ]
)


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join(
        (length, TAIL.pack(masked_crc(length)), payload, TAIL.pack(masked_crc(payload)))
    )


def unframe(data: bytes) -> bytes:
    """The payload of one whole record; raises ValueError if a checksum or the length is wrong."""
    length, crc = HEAD.unpack_from(data)
    payload = data[HEAD.size : HEAD.size + length]
    if crc != masked_crc(data[:8]) or len(data) != HEAD.size + length + TAIL.size:
        raise ValueError("damaged record length")
    if TAIL.unpack_from(data, HEAD.size + length)[0] != masked_crc(payload):
        raise ValueError("damaged record payload")
    return payload


# Names under which Arrow knows a store that Hadoop calls otherwise.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3", "abfs": "abfss"}
KNOWN_SCHEMES = ("file", "s3", "gs", "gcs", "hdfs", "viewfs", "abfss")


def full_uri(folder: str, master: str, default: str | None = None) -> str:
    """``folder`` with a scheme, so that Spark and Arrow open the same store.

    A bare path belongs to the file system ``default`` (of Hadoop); without one it is a local folder, which is
    refused unless the session is local, as every executor would write to its own disk.
    """
    if folder.startswith("file:/") and not folder.startswith("file://"):
        return "file://" + folder.removeprefix("file:")
    if "://" in folder:
        return folder
    if default and not default.startswith("file:"):
        return default.rstrip("/") + folder
    if master.startswith("local") and not master.startswith("local-cluster"):
        return "file://" + os.path.abspath(folder)
    raise ValueError(f"{folder}: name the scheme of a folder that all executors share")


def arrow_uri(uri: str) -> str:
    scheme, rest = uri.split("://", 1)
    scheme = ARROW_SCHEMES.get(scheme, scheme)
    if scheme not in KNOWN_SCHEMES:
        raise ValueError(f"{uri}: Arrow opens none of these stores; known are {', '.join(KNOWN_SCHEMES)}")
    return f"{scheme}://{rest}"


def shared_folder(spark: SparkSession, folder: str) -> str:
    return full_uri(folder, spark.sparkContext.master, spark.conf.get("spark.hadoop.fs.defaultFS", None))


def store(uri: str):
    """(file system, path) of a folder given with its scheme."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(arrow_uri(uri))


def arrow_folder(spark: SparkSession, folder: str) -> str | None:
    """``folder``, made if need be, with a scheme under which Arrow opens it; None if Arrow does not."""
    try:
        uri = shared_folder(spark, folder)
        system, path = store(uri)
        system.create_dir(path, recursive=True)
    except (ValueError, OSError, ImportError, NotImplementedError):
        return None
    return uri


def spark_folder(spark: SparkSession, folder: str) -> str:
    """``folder`` for Spark's readers and writers, which know what file system a bare path belongs to."""
    try:
        return shared_folder(spark, folder)
    except ValueError:
        return folder


def write_records(docs: DataFrame, vocabulary: str, folder: str, end_id: int = 1) -> DataFrame:
    """Writes the ids of all whole texts below ``folder`` in ascending doc_id order; the index.

    ``folder`` must be reachable from every executor, by Arrow (:func:`full_uri`) or by Spark alone. Texts are shuffled by ranges of doc_id first
    and encoded once, in the task that writes them; a file holds one range. A null or empty text
    gives a record with the end id alone, null doc_ids come first, rows of one doc_id are ordered by
    the hashes of their texts, by which many of them are cut into several ranges, and an empty table gives an empty
    index. Other columns are not read.
    """
    spark = docs.sparkSession
    by_arrow, folder = arrow_folder(spark, folder), spark_folder(spark, folder)

    def batch(rows: list[tuple], schema: StructType) -> pa.RecordBatch:
        arrow = to_arrow_schema(schema)
        columns = [pa.array(c, type=f.type) for c, f in zip(zip(*rows), arrow)]
        return pa.RecordBatch.from_arrays(columns, schema=arrow)

    def framed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bytes]]:
        """The index row and the bytes of each record, in order."""
        words = encoder(vocabulary)
        width = 2 if words.tokenizer.get_vocab_size() <= 1 << 16 else 4
        end = np.array([end_id], f"<u{width}").tobytes()
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.rec"
        offset, record, start = 0, 0, 0
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                some = whole.slice(at, ROWS_AT_ONCE)
                for doc_id, text in zip(*[c.to_pylist() for c in some.columns]):
                    ids = b"".join(words.of_text(text))
                    if width == 2:
                        ids = np.frombuffer(ids, "<u4").astype("<u2").tobytes()
                    data = frame(ids + end)
                    n = len(ids) // width + 1
                    yield (part, name, record, doc_id, offset, len(data), width, start, n), data
                    offset, record, start = offset + len(data), record + 1, start + n

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = store(by_arrow)
        out, rows, waiting, held = None, [], [], 0
        for row, data in framed(batches):
            rows.append(row)
            waiting.append(data)
            held += len(data)
            if held >= FLUSH_BYTES:
                out = out or system.open_output_stream(f"{path}/{row[1]}", compression=None)
                out.write(b"".join(waiting))
                waiting, held = [], 0
            if len(rows) >= INDEX_ROWS:  # they count only once the task has ended
                yield batch(rows, INDEX)
                rows = []
        if waiting:
            out = out or system.open_output_stream(f"{path}/{row[1]}", compression=None)
            out.write(b"".join(waiting))
        if out is not None:
            out.close()
        if rows:
            yield batch(rows, INDEX)

    def hand_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for row, data in framed(batches):
            rows.append((*row, data))
            held += len(data)
            if held >= FLUSH_BYTES or len(rows) >= INDEX_ROWS:
                yield batch(rows, FRAMES)
                rows, held = [], 0
        if rows:
            yield batch(rows, FRAMES)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    mark = F.xxhash64("text")
    ordered = whole_texts(docs).repartitionByRange(parts, "doc_id", mark)
    ordered = ordered.sortWithinPartitions("doc_id", mark, "text")
    with dropped_shuffles(spark):
        if by_arrow:
            ordered.mapInArrow(write, INDEX).write.parquet(f"{folder}/index")
        else:
            ordered.mapInArrow(hand_on, FRAMES).write.parquet(f"{folder}/records")
            kept_frames(spark, folder).drop("data").write.parquet(f"{folder}/index")
    return read_index(spark, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each record: file, place in it, doc_id, number of ids and of ids before it."""
    return spark.read.schema(INDEX).parquet(f"{spark_folder(spark, folder)}/index")


def kept_frames(spark: SparkSession, folder: str) -> DataFrame | None:
    """The table of framed records, None if they lie in files of Arrow's."""
    try:
        return spark.read.schema(FRAMES).parquet(f"{spark_folder(spark, folder)}/records")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def unframed(frames: DataFrame) -> DataFrame:
    """(file, record, doc_id, ids) of framed records with their index rows, both checksums verified."""

    def make():
        return lambda file, record, doc_id, width, data: [(file, record, doc_id, ids_of(data, width))]

    return map_rows(frames.select("file", "record", "doc_id", "width", "data"), make, RECORDS)


def ids_of(data: bytes, width: int) -> bytes:
    """The ids of one framed record as little-endian unsigned 32-bit integers."""
    payload = unframe(data)
    return payload if width == 4 else np.frombuffer(payload, f"<u{width}").astype("<u4").tobytes()


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """(file, record, doc_id, ids) of the records that ``index`` names, in the order of its rows.

    Any choice and any order of index rows will do (shuffled reads); each record is fetched by its
    offset and both checksums are verified. Ids are little-endian unsigned 32-bit integers.
    """
    spark = index.sparkSession
    kept = kept_frames(spark, folder)
    if kept is not None:
        wanted = index.select("file", "record").withColumn("place", F.monotonically_increasing_id())
        return unframed(wanted.join(kept, ["file", "record"]).orderBy("place"))
    folder = shared_folder(spark, folder)

    def make():
        system, path = store(folder)
        opened: list = [None, None]

        def read(file, record, doc_id, offset, length, width):
            if opened[0] != file:
                if opened[1] is not None:
                    opened[1].close()
                opened[:] = file, system.open_input_file(f"{path}/{file}")
            return [(file, record, doc_id, ids_of(opened[1].read_at(length, offset), width))]

        return read

    wanted = index.select("file", "record", "doc_id", "offset", "length", "width")
    return map_rows(wanted, make, RECORDS)


def record_digests(docs: DataFrame, vocabulary: str, folder: str, end_id: int = 1) -> DataFrame:
    """Writes, reads the files back and gives the start, length and crc32 of every document's ids."""
    index = write_records(docs, vocabulary, folder, end_id)
    in_order = Window.orderBy("part")  # one row for each file
    files = index.groupBy("part", "file").agg(F.sum("n_tokens").alias("file_tokens"))
    files = files.withColumn("before", F.sum("file_tokens").over(in_order) - F.col("file_tokens"))
    kept = kept_frames(docs.sparkSession, folder)
    if kept is None:
        by_file = index.repartition("file").sortWithinPartitions("file", "offset")
        records = read_records(by_file, folder)
    else:
        records = unframed(kept)  # all of them, as they lie; the join with the index finds their places
    records = records.select(
        "file",
        "record",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
    places = index.select("file", "record", "doc_id", "start_in_file")
    return (
        places.join(records, ["file", "record"])
        .join(files.select("file", "before"), "file")
        .select(
            "doc_id",
            (F.col("before") + F.col("start_in_file")).alias("start"),
            "n_tokens",
            "ids_crc32",
        )
    )
