"""Near-duplicate vectors: random-hyperplane hashing in several tables, exact cosines, components.

Equal vectors of a label are one class. The signs of a class on ``bits`` random hyperplanes form its key in
each table; two vectors at the threshold agree on one sign with probability 1 - angle / pi. The number of
bits follows the size of the largest label, so that buckets stay small, and the number of tables
follows from the bits, so that a pair at the threshold is missed in all tables with probability ``MISS``
at most. All signs together are a sketch: a pair of a bucket goes on only if its sketches differ in no more
places than a pair at the threshold does (six standard deviations allowed), and is then confirmed
on the whole vectors in double precision.
"""

from __future__ import annotations

import math

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    LongType,
    StructField,
    StructType,
)

from paygrain.llm.common import components, map_rows
from paygrain.session import materialize

THRESHOLD, MISS, LEAST_BITS, SEED = 0.98, 1e-4, 10, 31

SIGNED = StructType(
    [
        StructField("vec_id", LongType()),
        StructField("node", LongType()),
        StructField("vector", BinaryType()),
        StructField("sketch", ArrayType(LongType())),
        StructField("keys", ArrayType(LongType())),
    ]
)
LINKS = StructType(
    [StructField("u", LongType()), StructField("v", LongType()), StructField("linked", BooleanType())]
)


def tables_for(rows_per_label: int, threshold: float, miss: float = MISS) -> tuple[int, int]:
    """(bits of a key, number of tables)."""
    bits = max(LEAST_BITS, math.ceil(math.log2(max(rows_per_label, 2))))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log1p(-agree))


def allowed_difference(signs: int, threshold: float) -> int:
    p = math.acos(threshold) / math.pi
    return math.ceil(signs * p + 6 * math.sqrt(signs * p * (1 - p)))


class Hyperplanes:
    """Signs of a vector, grouped into keys; planes of a dimension are drawn when first needed."""

    def __init__(self, bits: int, tables: int):
        self.bits, self.tables, self.planes = bits, tables, {}
        self.weights = (1 << np.arange(bits)).astype(np.int64)

    def sign(self, label: int, vector: np.ndarray) -> tuple[list[int], list[int]]:
        n = len(vector)
        if n not in self.planes:
            rng = np.random.default_rng((SEED, n))
            self.planes[n] = rng.normal(size=(self.bits * self.tables, n))
        signs = self.planes[n] @ vector >= 0
        buckets = signs.reshape(self.tables, self.bits) @ self.weights
        head = xxhash.xxh3_64_intdigest(np.array([label, n], np.int64).tobytes())
        keys = np.stack([np.full(self.tables, head).astype(np.uint64).view(np.int64), np.arange(self.tables), buckets], 1)
        keys = [xxhash.xxh3_64_intdigest(k.tobytes()) - (1 << 63) for k in keys]
        packed = np.packbits(np.pad(signs, (0, -len(signs) % 64))).view(np.int64)
        return packed.tolist(), keys


def scaled(vector: np.ndarray) -> np.ndarray:
    """Same direction, largest component 1, so that squares neither overflow nor vanish."""
    return vector / np.abs(vector).max()


def cosine(a: np.ndarray, b: np.ndarray) -> float:
    a, b = scaled(a), scaled(b)
    return float(a @ b) / (math.sqrt(float(a @ a)) * math.sqrt(float(b @ b)))


def near_vectors(
    vectors: DataFrame, threshold: float = THRESHOLD, miss: float = MISS
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding, label).

    Two vectors are linked if their labels are equal, their lengths too, and their cosine is at least
    ``threshold``; n_links counts rows. Null or zero vectors, vectors with null, infinite or NaN components,
    and rows with a null label or null vec_id are linked with nothing; the last have no component and are
    kept. Rows that repeat a vec_id count as vectors of their own. An empty table gives no rows. Other
    columns are not read.
    """
    rows = vectors.select(
        vectors["vec_id"].cast("long").alias("vec_id"),
        vectors["embedding"].cast("array<double>").alias("e"),
        # Labels of any simple type, as 64-bit hashes of their texts.
        F.when(vectors["label"].isNotNull(), F.xxhash64(vectors["label"].cast("string"))).alias("label"),
    )
    largest = rows.where("label IS NOT NULL").groupBy("label").count().agg(F.max("count")).first()[0]
    bits, tables = tables_for(largest or 0, threshold, miss)

    def make():
        planes = Hyperplanes(bits, tables)

        def f(vec_id, e, label):
            bad = vec_id is None or label is None or not e or any(x is None for x in e)
            vector = None if bad else np.array(e, np.float64) + 0.0  # -0.0 becomes 0.0
            if bad or not np.isfinite(vector).all() or not vector.any():
                return [(vec_id, None, None, None, None)]
            node = xxhash.xxh3_64_intdigest(np.int64(label).tobytes() + vector.tobytes()) - (1 << 63)
            return [(vec_id, node, vector.tobytes(), *planes.sign(label, scaled(vector)))]

        return f

    signed = materialize(map_rows(rows, make, SIGNED), "vectors-signed")
    classes = (
        signed.where("node IS NOT NULL")
        .groupBy("node")
        .agg(F.count("*").alias("size"), F.min(F.struct("vec_id", "vector", "sketch", "keys")).alias("x"))
        .select("node", "size", "x.*")
    )
    classes = materialize(classes, "vectors-classes")
    keyed = classes.select("node", "sketch", F.explode("keys").alias("key"))
    words = -(-bits * tables // 64)
    a = keyed.select("key", F.col("node").alias("u"), F.col("sketch").alias("s"))
    b = keyed.select("key", F.col("node").alias("v"), F.col("sketch").alias("t"))
    differ = sum(F.bit_count(F.col("s")[i].bitwiseXOR(F.col("t")[i])) for i in range(words))
    near = differ <= allowed_difference(bits * tables, threshold)
    pairs = a.join(b, "key").where((F.col("u") < F.col("v")) & near)
    pairs = materialize(pairs.select("u", "v").distinct(), "vectors-pairs")
    left = classes.select(F.col("node").alias("u"), F.col("vector").alias("x"))
    right = classes.select(F.col("node").alias("v"), F.col("vector").alias("y"))

    def confirm():
        def f(u, v, x, y):
            x, y = np.frombuffer(x), np.frombuffer(y)
            return [(u, v, True)] if len(x) == len(y) and cosine(x, y) >= threshold else []

        return f

    both = pairs.join(left, "u").join(right, "v").select("u", "v", "x", "y")
    links = materialize(map_rows(both, confirm, LINKS).select("u", "v"), "vectors-links")
    found = components(links, "vectors")
    ends = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    others = (
        ends.join(classes.select(F.col("node").alias("v"), "size"), "v")
        .groupBy(F.col("u").alias("node"))
        .agg(F.sum("size").alias("others"))
    )
    place = classes.select("node", "size", "vec_id").join(found, "node", "left")
    place = place.withColumn("component", F.coalesce("component", "node"))
    lowest = place.groupBy("component").agg(F.min("vec_id").alias("low"))
    named = place.join(lowest, "component").join(others, "node", "left")
    named = named.select("node", "low", (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n"))
    component = F.coalesce("low", "vec_id")
    return (
        signed.select("vec_id", "node")
        .join(named, "node", "left")
        .select(
            "vec_id",
            F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
            component.alias("component_id"),
            F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
        )
    )
