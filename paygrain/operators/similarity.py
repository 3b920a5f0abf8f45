"""String-similarity joins.

:func:`best_fuzzy_match` finds the best partner of every key by sequence ratio. The lookup keys lie in blocks of
bounded size by length and hash; a key goes to the blocks that its length allows, and a task
compares the keys of a block, or a bounded share of them, with the lookup keys of it
(:mod:`paygrain.operators.key_blocks`). Only counts by length reach the driver, which cuts the blocks; no pair
becomes a row, and the shape of the plan does not depend on the data.

:func:`overlap_pairs` finds all pairs of token sets with ``|A n B| >= coef * (|A| + |B|)`` by an
equi-join on rare tokens (prefix filtering). For trigram similarity > t, ``coef = t / (1 + t)``.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Callable, Sequence
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paygrain.operators.key_blocks import EPS, KeyBlock, partner_sizes
from paygrain.session import materialize

_EPS = EPS
# 64-bit words of the token bitmap that bounds the overlap cheaply.
_WORDS = 4
# Rows of one token that a part of it holds, on either side of the join on tokens.
HOT_ROWS = 1_000
# Largest block of lookup keys, share of the other keys that meets it, and pairs of both.
BLOCK_KEYS, BLOCK_CHARS, SHARE_KEYS, SHARE_PAIRS = 20_000, 4 << 20, 50_000, 50_000_000
# Lengths up to EXACT are told apart when lookup keys are counted by length, longer ones by this factor.
_EXACT, _STEP = 256, 1.05
# A key whose best partner reaches a tier is closed; only the others are compared at the next one. Tiers of a job
# with fewer pairs than this of keys that are open would cost more time, for planning, than they save.
TIERS, TIER_PAIRS = (0.95, 0.85), 200_000_000


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff/Obershelp ratio; the order of the arguments matters."""
    return pd.Series(
        [
            None if x is None or y is None else SequenceMatcher(None, x, y).ratio()
            for x, y in zip(a, b)
        ],
        dtype="float64",
    )


def _bitmap(word: int) -> Column:
    """One of the words of a bitmap with a bit per token hash."""
    return F.expr(f"""
        aggregate(tokens, 0L, (bits, t) -> CASE
            WHEN pmod(xxhash64(t), {64 * _WORDS}) DIV 64 = {word}
            THEN bits | shiftleft(1L, int(pmod(xxhash64(t), 64))) ELSE bits END)""")


def _misses(mine: str, other: str) -> str:
    """At least so many of my tokens are certainly not among the other ones."""
    return " + ".join(
        f"bit_count({mine}_bits{w} & ~{other}_bits{w})" for w in range(_WORDS)
    )


def _encoded(left: DataFrame, right: DataFrame, block: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with the rare tokens first, size, bitmap and the parts of each token on either side.

    The frequency of every token within its block is counted on both sides and joined to the tokens. Stored, because
    the optimizer would otherwise repeat the array expressions in every filter that it pushes down.
    """
    df = left.withColumn("right_side", F.lit(False)).unionByName(
        right.withColumn("right_side", F.lit(True)), allowMissingColumns=True
    )
    names = [c for c in df.columns if c != "tokens"]
    one = df.withColumn("token", F.explode("tokens")).drop("tokens")
    counts = one.groupBy(*block, "token").agg(
        F.count_if("right_side").alias("f"), F.count_if(~F.col("right_side")).alias("g")
    )
    met = F.struct(
        "f",
        "token",
        F.ceil(F.col("f") / HOT_ROWS).cast("int").alias("right_parts"),
        F.ceil(F.col("g") / HOT_ROWS).cast("int").alias("left_parts"),
    )
    ranked = (
        one.join(counts, [*block, "token"])
        .groupBy(*names)
        .agg(F.sort_array(F.collect_list(met)).alias("ranked"))
        .withColumn("tokens", F.transform("ranked", lambda x: x["token"]))
        .withColumn("parts", F.transform("ranked", lambda x: F.struct(
            F.greatest(x["right_parts"], F.lit(1)).alias("right"), F.greatest(x["left_parts"], F.lit(1)).alias("left"))))
        .drop("ranked")
    )
    encoded = ranked.withColumn("size", F.size("tokens")).withColumns(
        {f"bits{w}": _bitmap(w) for w in range(_WORDS)}
    )
    stored = materialize(encoded, "tokens")
    return stored.where("NOT right_side"), stored.where("right_side")


def _prefixed(df: DataFrame, side: str, coef: float, size_class: str, others) -> DataFrame:
    """One row per (size class, prefix token) with the other columns named after the side.

    The prefix holds the rarest tokens, so many that any partner with enough overlap shares at
    least one of them. The rows of a token are dealt over its parts by their keys, and each stands in every part of
    the other side, so that (left_part, right_part) of a hot token hold about ``HOT_ROWS`` rows of either side.
    """
    band = (1 - coef) / coef
    least_overlap = f"ceil((size + ceil(size / {band}D - {_EPS}D)) * {coef}D - {_EPS}D)"
    own_class = f"int(floor(ln(size) / {math.log(band * (1 + _EPS))}D))"
    names = ["key", "tokens", "size", *[f"bits{w}" for w in range(_WORDS)]]
    other = "right" if side == "left" else "left"
    rows = df.selectExpr(
        *[f"{n} AS {side}_{n}" for n in names],
        *others,
        "parts",
        f"slice(tokens, 1, int(size - {least_overlap} + 1)) AS {side}_prefix",
        size_class.format(own=own_class) + " AS size_class",
    ).selectExpr("*", f"posexplode({side}_prefix) AS ({side}_pos, token)")
    return rows.selectExpr(
        *[c for c in rows.columns if c != "parts"],
        f"int(pmod(xxhash64({side}_key), parts[{side}_pos].{side})) AS {side}_part",
        f"explode(sequence(0, parts[{side}_pos].{other} - 1)) AS {other}_part",
    )


def overlap_pairs(
    left: DataFrame,
    right: DataFrame,
    coef: float,
    block: Sequence[str] = (),
    accept: Callable[[Column, Column, Column], Column] | None = None,
) -> DataFrame:
    """All (left, right) pairs with ``|A n B| >= coef * (|A| + |B|)``, each once.

    Inputs have ``block`` columns, a unique ``key`` within the block and ``tokens``, a set as
    array. Result: block columns, ``left_key``, ``right_key``, ``shared``, ``left_size``,
    ``right_size`` and the other columns of ``right``.

    The sizes of two partners differ at most by the factor ``(1 - coef) / coef``, so with
    classes of that width a partner is in the same or the next class on either side. The join
    key (block, size class, token) has no nulls; a token that is hot is cut into parts on both sides, by the counts
    of the tokens, so that no task joins more than a bounded number of rows of one token. ``accept(shared, left_size, right_size)`` may narrow the result;
    it belongs here because a later filter would be pushed in front of the cheap tests.
    """
    a, b = _encoded(left.select(*block, "key", "tokens"), right, block)
    extra = [c for c in right.columns if c not in {*block, "key", "tokens"}]
    a = _prefixed(a, "left", coef, "explode(sequence({own} - 1, {own} + 1))", block)
    b = _prefixed(b, "right", coef, "{own}", [*block, *extra])

    need = f"(left_size + right_size) * {coef}D - {_EPS}D"
    shared = "size(array_intersect(left_tokens, right_tokens))"
    enough = F.expr(f"{shared} >= {need}")
    if accept is not None:
        enough = enough & accept(F.expr(shared), F.col("left_size"), F.col("right_size"))
    # From the first shared token on, at most the shorter tail can be shared.
    reachable = f"least(left_size - left_pos, right_size - right_pos) >= {need}"
    # Cheap upper bound of the overlap from the bitmaps.
    possible = f"""least(left_size - ({_misses("left", "right")}),
        right_size - ({_misses("right", "left")})) >= {need}"""
    # A pair meets once per shared prefix token; keep the meeting at the first one.
    first_meeting = "element_at(array_intersect(left_prefix, right_prefix), 1) = token"
    # The nesting keeps the cheap tests first.
    passes = F.when(
        F.expr(reachable), F.when(F.expr(possible), F.when(F.expr(first_meeting), enough))
    )
    return (
        a.join(b, [*block, "size_class", "token", "left_part", "right_part"])
        .where(passes)
        .selectExpr(
            *block, "left_key", "right_key", f"{shared} AS shared", "left_size", "right_size", *extra
        )
    )


def _step(size: Column) -> Column:
    """A number that never falls with the length, with some 600 values up to a billion letters."""
    beyond = F.floor(F.log(F.greatest(size, F.lit(_EXACT)) / F.lit(float(_EXACT))) / math.log(_STEP))
    return (F.least(size, F.lit(_EXACT)) + beyond).cast("int")


def _reach(threshold: float) -> tuple[Column, Column]:
    """Steps of the shortest and the longest partner of a key."""
    t, size = threshold, F.length("key")
    low = F.greatest(F.ceil(size * (t / (2 - t)) - EPS), F.lit(1))
    return _step(low), _step(F.floor(size * ((2 - t) / t) + EPS))


def key_lengths(left: DataFrame, right: DataFrame) -> list[Row]:
    """(lookup, step, n, chars, least, most) of both sides: counts by length step, a few hundred rows."""
    both = left.select("key", F.lit(False).alias("lookup")).unionByName(
        right.select("key", F.lit(True).alias("lookup"))
    )
    size = F.length("key")
    return both.groupBy("lookup", _step(size).alias("step")).agg(
        F.count("*").alias("n"), F.sum(size).alias("chars"), F.min(size).alias("least"), F.max(size).alias("most")
    ).collect()


class _Cut:
    """Length classes of the lookup, of neighbouring steps with ``BLOCK_KEYS`` keys or ``BLOCK_CHARS`` characters together;
    a step with more is a class of several chunks. ``first`` has the first step of each."""

    def __init__(self, lengths: Sequence[Row]):
        self.first, self.least, self.n, self.chunks = [], [], [], []
        n = chars = 0
        for row in sorted((r for r in lengths if r.lookup), key=lambda r: r.step):
            if not self.first or n + row.n > BLOCK_KEYS or chars + row.chars > BLOCK_CHARS:
                n = chars = 0
                for column, value in ((self.first, row.step), (self.least, row.least), (self.n, 0), (self.chunks, 0)):
                    column.append(value)
            n, chars = n + row.n, chars + row.chars
            self.n[-1], self.chunks[-1] = n, max(-(-n // BLOCK_KEYS), -(-chars // BLOCK_CHARS))

    def column(self, step: Column) -> Column:
        """The class of a step, as an expression."""
        firsts = F.array(*[F.lit(x) for x in self.first[1:]]).cast("array<int>")
        return F.size(F.filter(firsts, lambda x: x <= step))

    def shares(self, lengths: Sequence[Row], threshold: float, tasks: int) -> list[int]:
        """Into how many shares the keys that meet a class are cut; small work makes about two pieces a task."""
        met = [0] * len(self.first)
        for row in lengths:
            if not row.lookup and self.first:
                low, high = partner_sizes(row.least, threshold)[0], partner_sizes(row.most, threshold)[1]
                for c in range(max(bisect_right(self.least, low) - 1, 0), bisect_right(self.least, high)):
                    met[c] += row.n
        piece = min(SHARE_PAIRS, -(-sum(m * n for m, n in zip(met, self.n)) // (2 * tasks)) or 1)
        sizes = zip(met, self.n, self.chunks)
        return [max(-(-m // SHARE_KEYS), min(-(-m * n // (k * piece)), m), 1) for m, n, k in sizes]


def _blocks(
    left: DataFrame, right: DataFrame, threshold: float, lengths: Sequence[Row], tasks: int
) -> tuple[DataFrame, DataFrame]:
    """Both sides with the (class, chunk, share) in which they meet.

    Each share of the keys that a class meets gets its copy of the chunk.
    """
    cut = _Cut(lengths)
    shares = cut.shares(lengths, threshold, tasks)
    low, high = _reach(threshold)

    def number(counts: Sequence[int]) -> Column:
        return F.element_at(F.array(*[F.lit(n) for n in counts or [1]]), F.col("class") + 1)

    def part(counts: Sequence[int]) -> Column:
        return F.pmod(F.xxhash64("key"), number(counts)).cast("int")

    def every(counts: Sequence[int]) -> Column:
        return F.explode(F.sequence(F.lit(0), number(counts) - 1))

    keys = left.select("key", F.explode(F.sequence(cut.column(low), cut.column(high))).alias("class"))
    keys = keys.select("key", "class", part(shares).alias("share"), every(cut.chunks).alias("chunk"))
    lookup = right.select("key", "ord", cut.column(_step(F.length("key"))).alias("class"))
    lookup = lookup.select(
        F.col("key").alias("match"), "ord", "class", part(cut.chunks).alias("chunk"), every(shares).alias("share")
    )
    return keys, lookup


def scored_keys(
    left: DataFrame, right: DataFrame, threshold: float, lengths: Sequence[Row] | None = None
) -> DataFrame:
    """``key, match, score, ord, compared, bounded, scored``: the best partner of a key in a block of the lookup.

    A row with a null ``key`` has the sums of a block and share: pairs that were ``compared`` at all, ``bounded`` pairs that
    passed the bounds, ratios ``scored``. ``lengths`` are the :func:`key_lengths` of both sides, or of more keys.
    """
    if threshold <= 0:
        raise ValueError("the threshold must be above 0")
    if lengths is None:
        lengths = key_lengths(left, right)
    work = [T.StructField(c, T.LongType()) for c in ("compared", "bounded", "scored")]
    schema = T.StructType(
        [
            T.StructField("key", T.StringType()),
            T.StructField("match", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("ord", right.schema["ord"].dataType),
            *work,
        ]
    )
    place = ["class", "chunk", "share"]
    # The cost of a key does not show in its bytes, so the number of partitions is given.
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys, lookup = (side.repartition(parts, *place) for side in _blocks(left, right, threshold, lengths, parts))

    def compare(mine: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
        made, done = [], np.zeros(3, np.int64)
        if len(mine) and len(other):
            block = KeyBlock(other["match"].tolist(), other["ord"].tolist(), threshold)
            for key in mine["key"]:
                best, counts = block.best(key)
                done += counts
                if best is not None:
                    made.append((key, best[2], best[0], best[1], None, None, None))
            made.append((None, None, None, None, *done.tolist()))
        return pd.DataFrame(made, columns=schema.names, dtype=object)

    return keys.groupBy(*place).cogroup(lookup.groupBy(*place)).applyInPandas(compare, schema)


def _best(scored: DataFrame) -> DataFrame:
    """``key, match, score`` of the keys that have a partner: one row for each."""
    best = F.min(F.struct((-F.col("score")).alias("score"), "ord", "match")).alias("best")
    found = scored.where("key IS NOT NULL").groupBy("key").agg(best)
    return found.select("key", F.col("best.match").alias("match"), (-F.col("best.score")).alias("score"))


def match_in_tiers(
    left: DataFrame,
    right: DataFrame,
    threshold: float,
    tiers: Sequence[float] = TIERS,
    least_pairs: int = 0,
) -> list[DataFrame]:
    """Stored results of :func:`scored_keys` for each tier above the threshold and the threshold itself.

    At a high tier few lengths and few triples allow a partner, and a key that has found one is closed, because
    all partners that reach the tier are seen there; only open keys go on. With fewer than ``least_pairs`` pairs of
    keys there is no tier but the threshold. All choices give the same best partners.
    """
    results, lengths = [], key_lengths(left, right)
    sides = [sum(r.n for r in lengths if r.lookup == lookup) for lookup in (False, True)]
    if sides[0] * sides[1] < least_pairs:
        tiers = ()
    for tier in [*sorted((t for t in tiers if threshold < t < 1), reverse=True), threshold]:
        results.append(materialize(scored_keys(left, right, tier, lengths), "fuzzy-tier"))
        closed = results[-1].select("key").where("key IS NOT NULL")
        left = left.join(closed, "key", "left_anti")
    return results


def best_fuzzy_match(
    left: DataFrame,
    right: DataFrame,
    threshold: float,
    tiers: Sequence[float] = TIERS,
    least_pairs: int = TIER_PAIRS,
) -> DataFrame:
    """Best partner per left key: ``key, match, score``; keys without a partner are absent.

    ``left``: distinct ``key``. ``right``: distinct ``key`` and ``ord``, where the smaller
    ``ord`` wins a tie. Empty keys match nothing. Both should be compact stored tables
    (:func:`paygrain.session.materialize`), because each is read several times. With a threshold of 1 only
    equal keys match; one of 0 or less is an error. The result does not depend on the ``tiers``
    of :func:`match_in_tiers`.
    """
    if threshold <= 0:
        raise ValueError("the threshold must be above 0")
    left = left.where(F.length("key") > 0)
    right = right.where(F.length("key") > 0)
    # Equal keys have ratio 1.0, which no other key reaches: they need no scoring.
    found = left.join(right, "key").select(
        "key", F.col("key").alias("match"), F.lit(1.0).alias("score")
    )
    if threshold >= 1:
        return found
    rest = left.select("key").join(right.select("key"), "key", "left_anti")
    for scored in match_in_tiers(rest, right, threshold, tiers, least_pairs):
        found = found.unionByName(_best(scored))
    return found


def attach_best_match(
    df: DataFrame, key: Column, lookup: DataFrame, threshold: float, name: str
) -> DataFrame:
    """Left-join every row with the best partner of its key.

    ``lookup`` has ``key``, ``ord`` and the attributes to carry over; it is a stored table.
    The rows get ``match``, ``score`` and the attributes, all null without a partner. Matching
    runs on the distinct keys only; the stored result is joined back by its true size.
    """
    keyed = df.withColumn("_match_key", key)
    keys = keyed.select(F.col("_match_key").alias("key")).where(F.length("key") > 0).distinct()
    best = best_fuzzy_match(materialize(keys, f"{name}-keys"), lookup, threshold)
    attributes = lookup.drop("ord").withColumnRenamed("key", "match")
    table = materialize(
        best.join(attributes, "match", "left").withColumnRenamed("key", "_match_key"), f"{name}-best"
    )
    return keyed.join(table, "_match_key", "left").drop("_match_key")
