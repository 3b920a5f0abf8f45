"""Spelling variants: words that differ by one code point, found by walking a trie that is a distributed table.

The trie of all words is a table of edges by node, a node being the code points read so far. A state of the
frontier is (a, b): the two nodes reached by two words of which one edit has been spent; ``length(a)`` code
points of the first word are read. All places of the edit start at once, from the trie alone, and every
round joins the states with the edges of both nodes and moves both along the code points they share. Words with
a common beginning share their states, and a state without a common way on is dropped. States whose two
nodes end a word are neighbours. Each pair is found once: the shorter word, or of equal long ones
the smaller, comes first, and a code point put into a run of itself is taken as put behind the run.

An edge row has the edges of its child as well, so that a round reads two code points, and joins only grow with
the number of states: both joins meet at most one row a node. Walks end at ``DEEP`` code points, which bounds the
number of rounds; pairs with a longer word are found by the hashes of all ways to leave one code point
out, computed in linear time, and confirmed on the words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from paygrain.llm.common import map_rows, whole_texts
from paygrain.session import materialize

RUN = "[A-Za-zÀ-ÿ]"
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
DEEP = 32  # code points of a word that the walk reads
HELD = 200_000  # words that a task counts before it hands them on
PRIME = (1 << 61) - 1
BASE = 0x2545F4914F6CDD1D % PRIME

COUNTS = StructType([StructField("word", StringType()), StructField("n", LongType())])
LEFT_OUT = StructType(
    [
        StructField("word_id", LongType()),
        StructField("kind", IntegerType()),
        StructField("size", IntegerType()),
        StructField("place", IntegerType()),
        StructField("hash", LongType()),
    ]
)


def planted_typo(doc_id: int | None, word: str) -> str:
    """The word as this document spells it: for one in 31 (doc_id, word), a code point is left out."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
    return word if h % 31 else word[: h % len(word)] + word[h % len(word) + 1 :]


def same_spelling(doc_id: int | None, word: str) -> str:
    return word


def count_words(
    docs: DataFrame,
    least_chars: int = 7,
    least_times: int = 2,
    spelt: Callable[[int | None, str], str] = same_spelling,
) -> DataFrame:
    """(word, n) over the whole texts: maximal runs of letters, A to Z in lower case, as ``spelt`` gives them.

    Words of at least ``least_chars`` code points that occur ``least_times``; a task counts what it reads
    before anything is shuffled. A null text has no word, every repeated row counts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, sums = re.compile(f"{RUN}+").findall, Counter()

        def handed_on() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_pydict({"word": list(sums), "n": list(sums.values())})
            sums.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                own, doc_id = Counter(), doc_id.as_py()
                for letters, n in Counter(find(text.as_py())).items():
                    if len(letters) >= least_chars:  # spelt may shorten a word, never lengthen it
                        own[letters.translate(LOWER)] += n
                for word, n in own.items():
                    word = spelt(doc_id, word)
                    if len(word) >= least_chars:
                        sums[word] += n
                if len(sums) >= HELD:
                    yield handed_on()
        if sums:
            yield handed_on()

    texts = whole_texts(docs).select("doc_id", "text")
    counted = texts.mapInArrow(run, COUNTS).groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least_times)


def _trie(words: DataFrame) -> DataFrame:
    """(node, n, edges): edges are (ch, n, next); n counts the word that ends there, null where none ends."""
    read = F.explode(F.sequence(F.lit(0), F.length("word"))).alias("l")
    steps = words.select("word", "n", read)
    edges = steps.select(
        F.substring("word", F.lit(1), F.col("l")).alias("node"),
        F.substring("word", F.col("l") + 1, F.lit(1)).alias("ch"),
        F.when(F.col("l") == F.length("word"), F.col("n")).alias("n"),
    ).groupBy("node", "ch").agg(F.max("n").alias("n"))
    nodes = edges.groupBy("node").agg(
        F.max("n").alias("n"),
        F.collect_list(F.when(F.col("ch") != "", F.col("ch"))).alias("next"),
    )
    # The entry of a node itself, without a code point, lies with the entries of its children.
    size = F.length("node")
    own = nodes.select(
        "node", F.struct(F.lit("").alias("ch"), "n", F.array().cast("array<string>").alias("next")).alias("e")
    )
    child = nodes.where(size > 0).select(
        F.substring("node", F.lit(1), size - 1).alias("node"),
        F.struct(F.substring("node", size, F.lit(1)).alias("ch"), "n", "next").alias("e"),
    )
    rows = own.unionByName(child).groupBy("node").agg(F.collect_list("e").alias("entries"))
    return rows.select(
        "node",
        F.filter("entries", lambda e: e["ch"] == "")[0]["n"].alias("n"),
        F.filter("entries", lambda e: e["ch"] != "").alias("edges"),
    )


def _first_states(trie: DataFrame) -> DataFrame:
    """Both nodes right behind the edit: two children of a node, or a node and its child."""
    edges = F.col("edges")
    one = trie.select("node", edges, F.explode("edges").alias("x"))
    two = one.select("node", "x", F.explode("edges").alias("y")).where("x.ch < y.ch")
    replaced = two.select(
        F.concat("node", "x.ch").alias("a"),
        F.concat("node", "y.ch").alias("b"),
        F.col("x.n").alias("n_a"),
        F.col("y.n").alias("n_b"),
        F.array_intersect("x.next", "y.next").alias("next"),
    )
    inserted = trie.select("node", "n", edges, F.explode("edges").alias("x")).select(
        F.col("node").alias("a"),
        F.concat("node", "x.ch").alias("b"),
        F.col("n").alias("n_a"),
        F.col("x.n").alias("n_b"),
        # behind its run: the shorter word does not go on with the code point put in
        F.array_remove(
            F.array_intersect(F.transform("edges", lambda e: e["ch"]), F.col("x.next")), F.col("x.ch")
        ).alias("next"),
    )
    return replaced.unionByName(inserted).where("n_a + n_b IS NOT NULL OR size(next) > 0")


def _moved(states: DataFrame, trie: DataFrame) -> DataFrame:
    """The states two code points on: the first is read along ``next``, the second from the joined rows.

    A pair that ends after the first one comes as a state without ``next``.
    """
    steps = states.where("size(next) > 0").select("a", "b", F.explode("next").alias("ch"))
    steps = steps.select(F.concat("a", "ch").alias("a"), F.concat("b", "ch").alias("b"))
    at_a = trie.select(F.col("node").alias("a"), F.col("n").alias("own_a"), F.col("edges").alias("edges_a"))
    at_b = trie.select(F.col("node").alias("b"), F.col("n").alias("own_b"), F.col("edges").alias("edges_b"))
    met = steps.join(at_a, "a").join(at_b, "b")
    on = F.expr(
        """concat(
          array(named_struct('ch', '', 'n_a', own_a, 'n_b', own_b, 'next', CAST(array() AS ARRAY<STRING>))),
          flatten(transform(edges_a, x -> transform(filter(edges_b, y -> y.ch = x.ch), y ->
            named_struct('ch', x.ch, 'n_a', x.n, 'n_b', y.n, 'next', array_intersect(x.next, y.next))))))"""
    )
    return (
        met.select("a", "b", F.explode(on).alias("s"))
        .select(
            F.concat("a", "s.ch").alias("a"), F.concat("b", "s.ch").alias("b"), "s.n_a", "s.n_b", "s.next"
        )
        .where("n_a + n_b IS NOT NULL OR size(next) > 0")
    )


def _left_out(word_id: int, word: str, deep: int) -> Iterator[tuple]:
    """Hashes of the word and of all that is left of it without one code point (polynomials modulo a prime).

    Kind 0 is met by words of one size that differ at ``place`` only, kind 1 by a word and a longer one.
    """
    codes, size = [ord(c) + 1 for c in word], len(word)
    behind, power = [0] * (size + 1), 1  # hash of the code points from a place on
    powers = [1] * (size + 1)
    for i in range(size - 1, -1, -1):
        behind[i] = (codes[i] * power + behind[i + 1]) % PRIME
        power = power * BASE % PRIME
        powers[size - i] = power
    yield word_id, 1, size, 0, behind[0]
    if size <= deep:
        return
    before = 0
    for i in range(size):
        left = (before * powers[size - 1 - i] + behind[i + 1]) % PRIME
        yield word_id, 0, size, i, left
        if i == 0 or codes[i] != codes[i - 1]:
            yield word_id, 1, size - 1, 0, left
        before = (before * BASE + codes[i]) % PRIME


def _long_pairs(words: DataFrame, deep: int) -> DataFrame:
    """(a, b, n_a, n_b) of the near pairs whose longer word has more than ``deep`` code points."""
    long = words.where(F.length("word") >= deep).withColumn("word_id", F.xxhash64("word"))
    keys = map_rows(
        long.select("word_id", "word"), lambda: lambda i, w: _left_out(i, w, deep), LEFT_OUT
    )
    keys = materialize(keys, "spelling-left-out")
    other = keys.withColumnRenamed("word_id", "other_id")
    met = keys.join(other, ["kind", "size", "place", "hash"]).where("word_id < other_id")
    met = met.select("word_id", "other_id").distinct()
    one = long.select("word_id", F.col("word").alias("a"), F.col("n").alias("n_a"))
    two = long.select(
        F.col("word_id").alias("other_id"), F.col("word").alias("b"), F.col("n").alias("n_b")
    )
    longer = F.greatest(F.length("a"), F.length("b")) > deep
    near = longer & (F.levenshtein("a", "b", 1) == 1)
    return met.join(one, "word_id").join(two, "other_id").where(near).select("a", "b", "n_a", "n_b")


def near_pairs(words: DataFrame, deep: int = DEEP) -> DataFrame:
    """(a, b, n_a, n_b): every pair of words that are one edit apart, once.

    ``words`` has distinct ``word`` and ``n``, none of them null; it should be a stored table. An
    edit puts in, leaves out or replaces one code point. A word has at most as many partners as it has places
    times letters, so pairs grow with the words.
    """
    spark = words.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    trie = materialize(_trie(words.where(F.length("word") <= deep)), "spelling-trie")
    # Dealt and sorted once; a lost part is made again from the stored table.
    trie = trie.repartition(parts, "node").sortWithinPartitions("node").persist()
    try:
        states = materialize(_first_states(trie), "spelling-states")
        found = states
        while not states.where("size(next) > 0").isEmpty():
            states = materialize(_moved(states, trie), "spelling-states")
            found = found.unionByName(states)
    finally:
        trie.unpersist()
    pairs = found.where("n_a + n_b IS NOT NULL").select("a", "b", "n_a", "n_b")
    if not words.where(F.length("word") > deep).isEmpty():
        pairs = pairs.unionByName(_long_pairs(words, deep))
    return pairs


def spelling_forms(words: DataFrame, factor: int = 10, deep: int = DEEP) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of (word, n).

    The form is the near word that occurs most (ties: the first in code-point order), if it occurs at least ``factor``
    times as often; else null. The root is the end of the way along the forms, the word itself
    without one. Counts grow along that way by the factor, so it has no circle and the joins that follow
    it, doubling their reach, are few. An empty table gives an empty one.
    """
    if factor < 2:
        raise ValueError("the factor must be at least 2")
    pairs = near_pairs(words, deep)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("m"))
    both = both.unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("m"))
    )
    best = F.min(F.struct((-F.col("m")).alias("m"), "near")).alias("best")
    near = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    often = -F.col("best.m") >= factor * F.col("n")
    known = words.select("word", "n").join(near, "word", "left")
    known = known.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(often, F.col("best.near")).alias("form"),
        F.when(often, -F.col("best.m")).alias("form_n"),
    )
    known = materialize(known, "spelling-forms")
    way = known.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        on = way.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        hop = way.join(on, "root", "left").select("word", "root", "beyond")
        hop = materialize(hop, "spelling-roots")
        way = hop.select("word", F.coalesce("beyond", "root").alias("root"))
        if hop.where("beyond IS NOT NULL").isEmpty():
            break
    return known.join(way, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def variant_groups(
    docs: DataFrame,
    least_chars: int = 7,
    least_times: int = 2,
    factor: int = 10,
    spelt: Callable[[int | None, str], str] = same_spelling,
) -> DataFrame:
    """Words of the whole texts of ``docs`` with their forms and roots (:func:`spelling_forms`)."""
    words = count_words(docs, least_chars, least_times, spelt)
    return spelling_forms(materialize(words, "spelling-words"), factor)
