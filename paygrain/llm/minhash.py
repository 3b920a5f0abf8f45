"""Near-duplicates by MinHash with tensored banding, verified on whole shingle sets.

Two collections of ``m`` short hash vectors (``width`` minhashes each) are computed for a set of
shingles. A table key joins one vector of either collection, so m * m tables of 2 * width minhashes
cost 2 * m * width minhashes only. A pair of similarity s is missed with probability
1 - (1 - (1 - s ** width) ** m) ** 2 at most: 0.0002 at 0.8 for the parameters below.

Equal sets are one class from the start. Candidates are found in two rounds:

1. the most central member of each table bucket is its lead, each set is compared with the most central of its leads
   (a star, not all pairs), and the links found are contracted to components; buckets that still hold several get a few
   more rounds of stars, around a member outside of their largest component;
2. only buckets that still hold several components go on. In small ones the pairs of different
   components are compared. Members of large ones are handed to an exact join: sets of this similarity share
   one of their rarest shingles, so pairs are taken from the prefixes of the sets in a common order of
   rareness, where passages that many documents share do not appear, as far as the shingles behind the
   shared one can still make up the similarity.

From the second round of stars on, rows carry a sketch of their set: the parities of the numbers of its items in each of
1024 classes. Each bit in which two sketches differ stands for an item that one set has alone, so a pair whose sketches
differ in more bits than its similarity leaves room for is no link, and is not looked at further. Of a group whose members
are almost similar enough, next to none of the pairs is left; sets of more than 2,300 items are not told apart like this.

Every pair that is compared is confirmed on both whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from paygrain.llm.common import components, map_rows, small_batches, whole_texts
from paygrain.session import materialize

M, WIDTH, SEED = 9, 2, 20
SMALL_BUCKET = 32
COUNT_CLASSES = 1 << 18
PERCENT = 80
ROUNDS, WIDE_ROWS = 4, 64
SKETCH_BITS = 10

SIGNED = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("node", LongType()),
        StructField("n_shingles", LongType()),
        StructField("left", ArrayType(LongType())),
        StructField("right", ArrayType(LongType())),
        StructField("sketch", ArrayType(LongType())),
    ]
)
SETS = StructType([StructField("node", LongType()), StructField("items", BinaryType())])
PREFIX = StructType([StructField(c, LongType()) for c in ("node", "n", "place", "item")])
CLASS_COUNTS = StructType([StructField("class", IntegerType()), StructField("n", LongType())])
PAIRS = StructType(
    [StructField("u", LongType()), StructField("v", LongType()), StructField("linked", BooleanType())]
)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(text: str, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``words``-word shingles of a text.

    A-Z count as a-z; words are parted by blank, tab, line feed, vertical tab, form feed and return.
    Fewer words make one shingle, none make the empty set.
    """
    split = text.encode("utf-8").lower().split()
    if not split:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, split), np.uint64, len(split))
    n = max(len(h) - words + 1, 1)
    out = np.full(n, min(len(h), words), np.uint64)
    for i in range(min(words, len(h))):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n])
    return np.unique(out)


class Signer:
    """The two collections of hash vectors of a set."""

    def __init__(self, m: int, width: int):
        rng = np.random.default_rng(SEED)
        count = 2 * m * width
        self.shape = (2 * m, width)
        self.xor = rng.integers(0, 1 << 63, count, np.uint64)[:, None]
        self.odd = (rng.integers(0, 1 << 63, count, np.uint64) * np.uint64(2) + np.uint64(1))[:, None]

    def vectors(self, items: np.ndarray) -> tuple[list[int], list[int]]:
        low = np.full(len(self.xor), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(items), 4096):
            some = (items[at : at + 4096] ^ self.xor) * self.odd
            low = np.minimum(low, some.min(axis=1))
        vectors = low.reshape(self.shape)
        h = vectors[:, 0]
        for i in range(1, self.shape[1]):
            h = mix(h * np.uint64(31) + vectors[:, i])
        h = mix(h).view(np.int64).tolist()
        half = len(h) // 2
        return h[:half], h[half:]


def node_of(items: np.ndarray) -> int:
    """Equal sets have the same node: a 64-bit digest of the whole set."""
    return xxhash.xxh3_64_intdigest(items.tobytes()) - (1 << 63)


def sketch_of(items: np.ndarray) -> list[int]:
    """Parities of the numbers of items in each class, as words of 64 bits."""
    classes = (items >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)
    odd = np.bincount(classes, minlength=1 << SKETCH_BITS).astype(np.uint8) & np.uint8(1)
    return np.packbits(odd).view(np.int64).tolist()


def may_link(a: str, b: str, na: str, nb: str, percent: int):
    """Whether sets of sizes ``na`` and ``nb`` with these sketches can reach the similarity.

    Two sets that differ in d items have it if (100 + percent) * d <= (100 - percent) * (na + nb); their sketches differ in
    at most d bits.
    """
    apart = sum(F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range((1 << SKETCH_BITS) // 64))
    return apart * (100 + percent) <= (F.col(na) + F.col(nb)) * (100 - percent)


def confirmed(a: bytes, b: bytes, percent: int = PERCENT) -> bool:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    both = int((y[at] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def sign(docs: DataFrame, words: int, m: int = M, width: int = WIDTH) -> DataFrame:
    """(doc_id, node, n_shingles, left, right, sketch); node, vectors and sketch are null for an empty set."""

    def make():
        signer = Signer(m, width)

        def f(doc_id, text):
            items = shingles(text, words)
            if not len(items):
                return [(doc_id, None, 0, None, None, None)]
            return [(doc_id, node_of(items), len(items), *signer.vectors(items), sketch_of(items))]

        return f

    return map_rows(whole_texts(docs), make, SIGNED)


class Sets:
    """Whole sets of classes, fetched once each from the text of one member."""

    def __init__(self, docs: DataFrame, classes: DataFrame, words: int):
        self.texts, self.classes, self.words = whole_texts(docs), classes, words
        self.stored: DataFrame | None = None

    def fetch(self, nodes: DataFrame) -> DataFrame:
        """(node, items) of some distinct nodes; those fetched before are read back."""
        words = self.words
        new = nodes
        if self.stored is not None:
            new = nodes.join(self.stored.select("node"), "node", "left_anti")
        members = self.classes.select("node", "doc_id").join(new, "node")
        asked = self.texts.join(members.hint("shuffle_hash"), "doc_id").select("node", "text")

        def make():
            def f(node, text):
                items = shingles(text, words)
                return [(node, items.tobytes())] if len(items) and node_of(items) == node else []

            return f

        fresh = map_rows(asked, make, SETS)
        fresh = materialize(fresh, "minhash-sets")
        self.stored = fresh if self.stored is None else self.stored.unionByName(fresh)
        return self.stored


def verify(pairs: DataFrame, sets: Sets, percent: int) -> DataFrame:
    """(u, v) of the distinct pairs (u, v, nu, nv) whose whole sets reach the similarity."""
    near = pairs.where(F.least("nu", "nv") * 100 >= F.greatest("nu", "nv") * percent)
    near = materialize(near.select("u", "v").distinct(), "minhash-pairs")
    nodes = near.select(F.col("u").alias("node")).unionByName(near.select(F.col("v").alias("node")))
    stored = sets.fetch(nodes.distinct()).dropDuplicates(["node"])
    left = stored.select(F.col("node").alias("u"), F.col("items").alias("a"))
    right = stored.select(F.col("node").alias("v"), F.col("items").alias("b"))
    both = near.join(left, "u").join(right, "v").select("u", "v", "a", "b")

    def make():
        return lambda u, v, a, b: [(u, v, True)] if confirmed(a, b, percent) else []

    with small_batches(pairs.sparkSession, WIDE_ROWS):  # a row holds two whole sets
        return materialize(map_rows(both, make, PAIRS).select("u", "v"), "minhash-links")


def item_counts(sets: DataFrame) -> np.ndarray:
    """How many sets have an item of each hash class; summed in tasks first, of fixed size."""
    arrow = to_arrow_schema(CLASS_COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNT_CLASSES, np.int64)
        for b in batches:
            for items in b.column(0).to_pylist():
                at = (np.frombuffer(items, np.uint64) % np.uint64(COUNT_CLASSES)).astype(np.int64)
                np.add.at(counts, at, 1)
        some = np.flatnonzero(counts)
        columns = [pa.array(some.astype(np.int32)), pa.array(counts[some])]
        yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    got = sets.select("items").mapInArrow(run, CLASS_COUNTS).groupBy("class").agg(F.sum("n").alias("n"))
    got, counts = got.toArrow(), np.zeros(COUNT_CLASSES, np.int64)
    counts[got["class"].to_numpy()] = got["n"].to_numpy()
    return counts


def rare_prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(node, n, place, item): the rarest items of each set, of which any similar set shares one.

    Of sets of sizes a and b with similarity t, a set of size a shares at least t * a items; so one of its
    a - ceil(t * a) + 1 first is shared, by both sides' prefixes in any common order. The order here is by
    the count of the item's hash class, which puts frequent items last; the classes are of fixed number, and
    more collisions could only make the prefixes less selective.
    """
    counts = sets.sparkSession.sparkContext.broadcast(item_counts(sets))

    def make():
        known = counts.value

        def f(node, items):
            x = np.frombuffer(items, np.uint64)
            n = len(x)
            order = np.lexsort((x, known[(x % np.uint64(COUNT_CLASSES)).astype(np.int64)]))
            first = x[order[: n + (-n * percent // 100) + 1]].view(np.int64)
            return [(node, n, i, item) for i, item in enumerate(first.tolist())]

        return f

    return map_rows(sets.select("node", "items"), make, PREFIX)


def stars(hits: DataFrame) -> DataFrame:
    """(u, v, nu, nv): each set v with the most central one u of the leads of its buckets; at most a row a set.

    Central are sets that meet many others in all their buckets: of a text and its altered
    copies that is the text, to which the copies are closer than to each other. The lead of a bucket is its most central
    member.
    """
    weight = hits.groupBy("node").agg(F.sum("members").alias("weight"))
    weighed = hits.join(weight, "node").select("key", F.struct("weight", "node", "n").alias("x"))
    leads = weighed.groupBy("key").agg(F.max("x").alias("lead"))
    star = hits.join(leads, "key").where(F.col("node") != F.col("lead.node"))
    star = star.groupBy(F.col("node").alias("v"), F.col("n").alias("nv")).agg(F.max("lead").alias("lead"))
    return star.select(F.col("lead.node").alias("u"), "v", F.col("lead.n").alias("nu"), "nv")


def crossing(hits: DataFrame, key: str, found: DataFrame, sketches: DataFrame | None = None) -> DataFrame:
    """Rows of buckets that hold several components, with the component ``c``, the size of the bucket and the
    component ``top`` that has most of it; with ``sketches``, their sketch is added."""
    placed = hits.join(found.withColumnRenamed("component", "c"), "node", "left")
    placed = placed.withColumn("c", F.coalesce("c", "node"))
    parts = placed.groupBy(key, "c").agg(F.count("*").alias("part"))
    mixed = parts.groupBy(key).agg(
        F.sum("part").alias("members"),
        F.count("*").alias("parts"),
        F.max(F.struct("part", "c")).alias("most"),
    )
    mixed = mixed.where("parts > 1").select(key, "members", F.col("most.c").alias("top"))
    # Both stored, so that this join and the one of the rows with each other can be split at hot keys.
    mixed = materialize(mixed, f"minhash-mixed-{key}")
    still = placed.join(mixed, key)
    if sketches is not None:
        still = still.join(sketches, "node")
    return materialize(still, f"minhash-open-{key}")


def next_stars(mixed: DataFrame, rounds: int, percent: int) -> DataFrame:
    """(u, v, nu, nv): members of a bucket with one that lies outside of its largest component, if they may be linked.

    That one changes with the round, so that in a group of near copies the parts that no copy has reached yet are
    met from another side; a member meets at most one of each other component, and at most one a bucket.
    """
    turn = F.xxhash64(F.col("node"), F.lit(rounds))
    outside = mixed.where(F.col("c") != F.col("top"))
    lead = F.min(F.struct(turn.alias("turn"), "node", "n", "c", "sketch")).alias("lead")
    lead = outside.groupBy("key").agg(lead).withColumn("nu", F.col("lead.n"))
    star = mixed.join(lead, "key").where(F.col("c") != F.col("lead.c"))
    star = star.where(may_link("sketch", "lead.sketch", "n", "nu", percent))
    star = star.groupBy("node", "n", F.col("lead.c").alias("cu")).agg(
        F.min(F.struct("lead.turn", F.col("lead.node").alias("node"), "nu")).alias("lead")
    )
    star = star.select("node", "n", F.col("lead.node").alias("u"), F.col("lead.nu").alias("nu"))
    first = F.col("u") < F.col("node")
    return star.select(
        F.least("u", "node").alias("u"),
        F.greatest("u", "node").alias("v"),
        F.when(first, F.col("nu")).otherwise(F.col("n")).alias("nu"),
        F.when(first, F.col("n")).otherwise(F.col("nu")).alias("nv"),
    )


def pairs_within(rows: DataFrame, key: str, percent: int, near=None) -> DataFrame:
    """(u, v, nu, nv): pairs of one bucket in different components, with near enough sizes and sketches.

    Every such pair has a member outside of the largest component, so only those look for partners. ``near``
    adds a condition on the columns of a (left) and b (right).
    """
    kept = [c for c in rows.columns if c not in (key, "members", "top")]
    b = rows.select(key, *[F.col(c).alias(f"b_{c}") for c in kept])
    a = rows.where(F.col("c") != F.col("top"))
    a = a.select(key, "top", *[F.col(c).alias(f"a_{c}") for c in kept])
    once = (F.col("b_c") == F.col("top")) | (F.col("a_node") < F.col("b_node"))
    sizes = F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * percent
    wanted = (F.col("a_c") != F.col("b_c")) & once & sizes
    wanted = (wanted if near is None else wanted & near) & may_link("a_sketch", "b_sketch", "a_n", "b_n", percent)
    first = F.col("a_node") < F.col("b_node")
    return a.join(b, (a[key] == b[key]) & wanted).select(
        F.when(first, F.col("a_node")).otherwise(F.col("b_node")).alias("u"),
        F.when(first, F.col("b_node")).otherwise(F.col("a_node")).alias("v"),
        F.when(first, F.col("a_n")).otherwise(F.col("b_n")).alias("nu"),
        F.when(first, F.col("b_n")).otherwise(F.col("a_n")).alias("nv"),
    )


def still_reachable(percent: int):
    """At the first item that two prefixes share, only what follows in both can be shared besides."""
    rest = F.least(F.col("a_n") - F.col("a_place"), F.col("b_n") - F.col("b_place"))
    return rest * (100 + percent) >= (F.col("a_n") + F.col("b_n")) * percent


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = PERCENT, m: int = M, width: int = WIDTH
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text).

    Documents are linked if 100 * intersection >= percent * union of their shingle sets; the
    component is named by the smallest doc_id in it, whose row is kept. Null, empty and blank texts
    have the empty set and are linked with nothing. Rows with a null doc_id are in no component: their
    component_id is null and they are kept. Rows that repeat a doc_id with the same words are one class, with
    other words they are separate members of whatever they resemble. An empty table gives no
    rows. Only doc_id and text are read.
    """
    signed = materialize(sign(docs, words, m, width), "minhash-signed")
    named = signed.where("node IS NOT NULL AND doc_id IS NOT NULL")
    classes = named.groupBy("node").agg(
        F.min(F.struct("doc_id", "n_shingles", "left", "right", "sketch")).alias("first")
    )
    classes = materialize(
        classes.select("node", "first.*").withColumnRenamed("n_shingles", "n"), "minhash-classes"
    )
    tables = F.flatten(
        F.transform(
            "left",
            lambda x, i: F.transform("right", lambda y, j: F.xxhash64(x, y, i * F.lit(m) + j)),
        )
    )
    keyed = classes.select("node", "n", F.explode(tables).alias("key"))
    buckets = keyed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    hits = materialize(keyed.join(buckets, "key"), "minhash-hits")
    sets = Sets(docs, classes, words)
    star = stars(hits)
    links = verify(star, sets, percent)
    found = components(links, "minhash-stars")

    sketches = classes.select("node", "sketch")
    mixed = crossing(hits.select("key", "node", "n"), "key", found, sketches)
    for rounds in range(ROUNDS):
        again = verify(next_stars(mixed, rounds, percent), sets, percent)
        if again.isEmpty():
            break
        links = links.unionByName(again)
        found = components(links, "minhash-stars")
        mixed = crossing(mixed.select("key", "node", "n", "sketch"), "key", found)
    small = mixed.where(F.col("members") <= SMALL_BUCKET)
    open_pairs = pairs_within(small, "key", percent).distinct()
    large = mixed.where(F.col("members") > SMALL_BUCKET).select("node").distinct()
    if not large.isEmpty():
        asked = materialize(large, "minhash-large")
        whole = sets.fetch(asked).dropDuplicates(["node"]).join(asked, "node", "left_semi")
        prefixes = materialize(rare_prefixes(whole, percent), "minhash-prefixes")
        shared = crossing(prefixes, "item", found, sketches)
        open_pairs = open_pairs.unionByName(
            pairs_within(shared, "item", percent, still_reachable(percent))
        )
    more = verify(open_pairs, sets, percent)
    if not more.isEmpty():
        found = components(links.unionByName(more), "minhash-all")
    return _named(signed, classes, found)


def _named(signed: DataFrame, classes: DataFrame, found: DataFrame) -> DataFrame:
    """The smallest doc_id of each component for every row."""
    place = classes.select("node", "doc_id").join(found, "node")
    smallest = place.groupBy("component").agg(F.min("doc_id").alias("low"))
    named = place.join(smallest, "component").select("node", "low")
    named = classes.select("node", "doc_id").join(named, "node", "left")
    named = named.select("node", F.coalesce("low", "doc_id").alias("low"))
    rows = signed.select("doc_id", "node", "n_shingles").join(named, "node", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("low", "doc_id"))
    return rows.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, words: int = 5, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest doc_id; all columns stay.

    A doc_id goes if none of its rows is kept; rows with a null doc_id stay.
    """
    found = near_duplicates(docs, words, percent).where("doc_id IS NOT NULL")
    gone = found.groupBy(F.col("doc_id").alias("_gone")).agg(F.max("kept").alias("any"))
    gone = gone.where("NOT any").select("_gone")
    return docs.join(gone, docs["doc_id"].cast("long") == F.col("_gone"), "left_anti")
