"""A hidden Markov language model over documents, next to a smoothed unigram score.

Each token stands for a symbol: the most frequent words have their own, all others share one with
the words of like length and last byte, and the end of a text has one. A hidden Markov
model runs over the symbols; within a shared symbol every state has its own share of every training word. This is
a distribution over whole texts, and the scaled forward recursion gives its exact value.

Word counts are taken over all training texts. Baum-Welch counts are summed over partitions in every
iteration, for all training texts, with the expected count of every word of the head in every state. The last
iteration gathers those of all other words too, as rows that Spark adds up, whose number grows with the words of
the texts; until then they have common shares by symbol. Words are told apart by a 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from paygrain.llm.common import ROWS_AT_ONCE, dropped_shuffles, fold, map_slices, summed, whole_texts
from paygrain.session import emptied, materialize

STATES, OWN, LENGTHS, ENDINGS, ITERATIONS, SEED = 8, 200, 6, 9, 5, 11
SHARED = LENGTHS * ENDINGS
END = OWN + SHARED
SYMBOLS = END + 1
HEAD_WORDS = 500_000  # most frequent words whose counts every task holds (16 bytes each)
WORDS_AT_ONCE = 1 << 20  # distinct words of slices of texts that a task adds up at once
CELLS_AT_ONCE = 1 << 18  # tokens of a block; some 400 bytes each
RESCALED = 8  # steps between scalings: the chance of a token stays above 1e-30
PLACES = 1 << 12  # of the head in a block of sums
NO_WORD = -1 - SHARED  # place of ends and padding; -1 - i is that of words of shared symbol i outside of the head
WORD_SHARE = 0.8  # of a state's emissions within a shared symbol that follow the words it was seen with

COUNTED = StructType(
    [StructField("word", LongType()), StructField("shared", IntegerType()), StructField("n", LongType())]
)
CODED = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("held_out", BooleanType()),
        StructField("symbols", BinaryType()),
        StructField("known", LongType()),
        StructField("log_counts", DoubleType()),
        StructField("log_own", DoubleType()),
        StructField("rare", ArrayType(LongType())),
        StructField("head", BinaryType()),
    ]
)
IN_STATES = [f"in_{s}" for s in range(STATES)]
GATHERED = StructType(
    [StructField("block", IntegerType()), StructField("sums", BinaryType()), StructField("word", LongType())]
    + [StructField("symbol", IntegerType()), StructField("n", LongType())]
    + [StructField(name, FloatType()) for name in IN_STATES]
)
BLOCK_SUMS = StructType(GATHERED.fields[:2])
RATIOS = StructType(
    [StructField("word", LongType()), StructField("n", LongType()), StructField("ratio", BinaryType())]
)
SCORED = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("held_out", BooleanType()),
        StructField("n_tokens", LongType()),
        StructField("n_known", LongType()),
        StructField("log_counts", DoubleType()),
        StructField("log_own", DoubleType()),
        StructField("rare_logs", DoubleType()),
        StructField("log10", DoubleType()),
    ]
)


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash and shared symbol of the distinct words of some texts; for every token, which of them it is; the places
    where the texts begin and end among the tokens.

    A-Z count as a-z, the six ASCII white spaces part words.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.large_string())))
    parts = lists.flatten()
    there = pc.greater(pc.binary_length(parts), 0)  # white space at either end of a text makes an empty part
    bounds = np.append(0, np.cumsum(there.to_numpy(zero_copy_only=False)))[lists.offsets.to_numpy()]
    coded = parts.filter(there).dictionary_encode()
    n = len(coded.dictionary)
    whole = pa.LargeListArray.from_arrays(pa.array([0, n], pa.int64()), coded.dictionary)
    joined = pc.binary_join(whole, pa.scalar(" ", pa.large_string()))[0].as_buffer().to_pybytes()
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, joined.split()), np.uint64, n).view(np.int64)
    length = pc.binary_length(coded.dictionary).to_numpy()
    last = np.frombuffer(joined, np.uint8)[np.cumsum(length + 1) - 2].astype(np.int64)
    g = np.minimum(length - 1, 2 * LENGTHS - 1) // 2 * ENDINGS + last % ENDINGS
    return h, g, coded.indices.to_numpy(), bounds


def count_words(texts: DataFrame) -> DataFrame:
    """(word, shared, n) over all texts: added up in each task first, then by Spark."""
    arrow = to_arrow_schema(COUNTED)

    def batch(parts: list) -> pa.RecordBatch:
        h, g, n = (np.concatenate(x) for x in zip(*parts))
        word, first, which = np.unique(h, return_index=True, return_inverse=True)
        total = np.bincount(which, n, len(word)).astype(np.int64)
        columns = [pa.array(word), pa.array(g[first].astype(np.int32)), pa.array(total)]
        return pa.RecordBatch.from_arrays(columns, schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                h, g, which, _ = words_of(whole.column(0).slice(at, ROWS_AT_ONCE).to_pylist())
                parts.append((h, g, np.bincount(which, minlength=len(h))))
                held += len(h)
                if held >= WORDS_AT_ONCE:
                    yield batch(parts)
                    parts, held = [], 0
        if held:
            yield batch(parts)

    parts = texts.select("text").mapInArrow(run, COUNTED)
    return parts.groupBy("word").agg(F.max("shared").alias("shared"), F.sum("n").alias("n"))


def packed(values: np.ndarray) -> bytes:
    """Four-byte values, compressed after like bytes are brought together."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(planes.tobytes(), 1)


def unpacked(raw: bytes, dtype: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


@dataclass(frozen=True)
class Words:
    """Totals of the training tokens and the counts of the head; sizes are bounded by HEAD_WORDS."""

    total: int  # N, ends included
    types: int  # V, the end included
    ends: int
    shared_total: np.ndarray
    shared_types: np.ndarray
    word: np.ndarray  # sorted hashes of the head
    n: np.ndarray
    symbol: np.ndarray  # own symbol of a head word, -1 for most
    shared: np.ndarray  # shared symbol of a head word, whether it has its own or not

    @property
    def log_all(self) -> float:
        return float(np.log10(self.total + 0.5 * (self.types + 1)))

    @property
    def log_shared(self) -> np.ndarray:
        return np.log10(self.shared_total + 0.5 * (self.shared_types + 1))

    def code(self, texts: list[str]) -> Iterator[tuple]:
        """For each text: symbols with the end, known tokens, sum of log10(c + 0.5) without rare words, log10
        of the shares within shared symbols (without the counts of rare words), the rare words, and the place
        of every word in the head (negative for rare ones, by shared symbol).

        The distinct words of all the texts are looked up together.
        """
        h, g, which, bounds = words_of(texts)
        count, symbol = np.zeros(len(h), np.int64), np.full(len(h), -1)
        found, place = np.zeros(len(h), bool), (-1 - g).astype(np.int32)
        if len(self.word):
            order, at = np.argsort(h), np.empty(len(h), np.int64)
            at[order] = np.searchsorted(self.word, h[order])  # much faster in order
            at[at == len(self.word)] = 0
            found = self.word[at] == h
            count[found], symbol[found] = self.n[at[found]], self.symbol[at[found]]
            place[found] = at[found]
        own = symbol >= 0
        logs = np.where(found, np.log10(count + 0.5), 0.0)
        log_shared = np.where(own, 0.0, logs) - np.where(own, 0.0, self.log_shared[g])
        symbols = np.where(own, symbol, OWN + g).astype(np.uint8)
        end_log = float(np.log10(self.ends + 0.5))
        for i in np.split(which, bounds[1:-1]):
            known = found[i]
            yield (
                symbols[i].tobytes() + bytes([END]),
                int(known.sum()) + int(self.ends > 0),
                float(logs[i].sum()) + end_log,
                float(log_shared[i].sum()),
                h[i[~known]].tolist(),
                packed(place[i]),
            )


def word_table(counts: DataFrame, ends: int, head_words: int = HEAD_WORDS) -> Words:
    """Totals over all words, and the counts of the most frequent ones as long as they fit the head.

    The head is cut at a count, found from a histogram of logarithmic classes of counts.
    """
    step = F.floor(F.log2("n") * 64).cast("int")
    by_class = counts.groupBy(step.alias("c")).agg(F.count("*").alias("types")).toArrow().to_pylist()
    by_class.sort(key=lambda r: -r["c"])
    least, held = None, 0
    for r in by_class:
        held += r["types"]
        if held > head_words:
            break
        least = r["c"]
    shared_total, shared_types = np.zeros(SHARED), np.zeros(SHARED)
    if least is None:
        head = counts.limit(0).toArrow()
    else:
        head = counts.where(step >= least).select("word", "n", "shared").toArrow()
    word, n = head["word"].to_numpy(), head["n"].to_numpy()
    order = np.argsort(word)
    word, n, shared = word[order], n[order], head["shared"].to_numpy()[order]
    symbol = np.full(len(word), -1)
    top = np.lexsort((word, -n))[:OWN]
    symbol[top] = np.arange(len(top))
    sums = counts.groupBy("shared").agg(F.sum("n").alias("n"), F.count("*").alias("types"))
    total, types = ends, int(ends > 0)
    for r in sums.toArrow().to_pylist():
        shared_total[r["shared"]], shared_types[r["shared"]] = r["n"], r["types"]
        total, types = total + r["n"], types + r["types"]
    np.subtract.at(shared_total, shared[top], n[top])
    np.subtract.at(shared_types, shared[top], 1)
    return Words(total, types, ends, shared_total, shared_types, word, n, symbol, shared)


def blocks(column: pa.Array):
    """Symbol sequences of a batch, by falling length, step after step; a block holds a bounded number of tokens.

    Gives (symbols of all sequences that reach step 0, of all that reach step 1, ...; places of those as a mask of
    (steps, sequences); number of sequences that reach each step; rows).
    """
    sequences = [np.frombuffer(x, np.uint8) for x in column.to_pylist()]
    lengths = np.array([len(s) for s in sequences])
    order, at = np.argsort(-lengths, kind="stable"), 0
    while at < len(order):
        ahead = lengths[order[at:]]
        longest = int(ahead[0])
        n = int(np.searchsorted(np.cumsum(ahead), CELLS_AT_ONCE, "right"))
        some = order[at : at + max(1, min(n, 8 * CELLS_AT_ONCE // longest))]
        at += len(some)
        padded = np.zeros((longest, len(some)), np.uint8)
        for j, i in enumerate(some):
            padded[: lengths[i], j] = sequences[i]
        active = np.searchsorted(-lengths[some], -np.arange(longest), "left")
        inside = np.arange(len(some)) < active[:, None]
        yield padded[inside], inside, active, some


@dataclass(frozen=True)
class Hmm:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # (symbols, states)

    def emissions(self, symbols, ratio=None) -> np.ndarray:
        """Chance of every token in each state; ``ratio`` has a factor for each."""
        out = self.emit.take(symbols, 0)
        return out if ratio is None else np.multiply(out, ratio, out=out)

    def forward(self, emitted, active):
        """log10 likelihoods, and the forward values of all tokens, scaled to a sum of 1 every few steps."""
        alphas, logs, at, last = np.empty_like(emitted), np.zeros(active[0]), 0, None
        ended = np.append(active[1:], 0)
        for t, (k, later) in enumerate(zip(active.tolist(), ended.tolist())):
            here = alphas[at : at + k]
            if last is None:
                np.multiply(emitted[:k], self.start, out=here)
            else:
                np.matmul(last[:k], self.move, out=here)
                here *= emitted[at : at + k]
            if t % RESCALED == 0:
                scale = here.sum(1)
                here /= scale[:, None]
                logs[:k] += np.log10(scale)
            if later < k:
                logs[later:k] += np.log10(here[later:].sum(1))
            last, at = here, at + k
        return logs, alphas

    def backward(self, emitted, active) -> np.ndarray:
        """Backward values of all tokens, scaled now and then; ``emitted`` is multiplied by them."""
        betas, back = np.ones_like(emitted), np.ascontiguousarray(self.move.T)
        at, after, later = len(emitted), None, 0
        for t in range(len(active) - 1, -1, -1):
            k = int(active[t])
            at -= k
            here = betas[at : at + k]
            if later:
                np.matmul(after, back, out=here[:later])
                if t % RESCALED == 0:
                    here /= here.max(1)[:, None]
            after, later = emitted[at : at + k], k
            after *= here
        return betas

    def expected(self, column: pa.Array, ratios=None, seen=None) -> np.ndarray:
        """Expected counts of a batch: rows of starts, moves, emissions (states by symbols), log10.

        The chance of a move is that of its two tokens' values and the matrix, scaled to a sum of 1 for every token, so
        that the scales of the recursions do not matter. ``seen`` is given the rows of each block, the mask of its
        tokens, its symbols and the chances by state.
        """
        out = np.zeros((2 + 2 * STATES, SYMBOLS))
        for symbols, inside, active, rows in blocks(column):
            emitted = self.emissions(symbols, None if ratios is None else ratios(rows, inside))
            logs, alphas = self.forward(emitted, active)
            out[-1, 0] += logs.sum()
            betas = self.backward(emitted, active)
            first = int(active[0])
            before = alphas.take(np.arange(first, len(symbols)) - np.repeat(active[:-1], active[1:]), 0)
            after = emitted[first:]
            before /= np.einsum("ij,ij->i", before @ self.move, after)[:, None]
            out[1 : 1 + STATES, :STATES] += before.T @ after * self.move
            chances = np.multiply(alphas, betas, out=alphas)
            chances /= (chances @ np.ones(STATES))[:, None]
            out[0, :STATES] += chances[:first].sum(0)
            by_state, at = np.ascontiguousarray(chances.T), symbols.astype(np.intp)
            for s in range(STATES):
                out[1 + STATES + s] += np.bincount(at, by_state[s], SYMBOLS)
            if seen is not None:
                seen(rows, inside, symbols, by_state)
        return out

    def likelihoods(self, column: pa.Array, ratios=None) -> np.ndarray:
        out = np.zeros(len(column))
        for symbols, inside, active, rows in blocks(column):
            emitted = self.emissions(symbols, None if ratios is None else ratios(rows, inside))
            out[rows] = self.forward(emitted, active)[0]
        return out


def padded_places(heads: list[np.ndarray], rows: np.ndarray, steps: int) -> np.ndarray:
    """Places in the head of the words of some rows, as (steps, rows)."""
    out = np.full((steps, len(rows)), NO_WORD, np.int32)
    for j, i in enumerate(rows.tolist()):
        out[: len(heads[i]), j] = heads[i]
    return out


def gathered(coded: DataFrame, model: Hmm, known, table, others: bool) -> DataFrame:
    """What an iteration gathers: the matrix of :meth:`Hmm.expected` as block -1, sums of the head by blocks of
    places and, if asked for, (word, symbol, n, expected count in each state) of the other words.
    """
    arrow = to_arrow_schema(GATHERED)

    def batch(blocks: list, sums: list) -> pa.RecordBatch:
        none = [pa.nulls(len(blocks), f.type) for f in list(arrow)[2:]]
        return pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array(sums, pa.binary()), *none], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, total, ready = len(known.value.word), None, []
        sums, there, number = np.zeros((STATES, size)), np.zeros(size, bool), np.zeros(size, np.intp)
        for b in batches:
            if not b.num_rows:
                continue
            heads, rares, place = [unpacked(x, "<i4") for x in b.column(1).to_pylist()], b.column(2), None

            def ratios(rows, inside):
                nonlocal place
                place = padded_places(heads, rows, len(inside))[inside]
                return table.value.take(place, 0, mode="wrap")

            def seen(rows, inside, symbols, chances):
                flat = place
                shared = (symbols >= OWN) & (symbols < END)
                at = np.flatnonzero(shared & (flat >= 0))
                if len(at):
                    there[:] = False
                    there[flat[at]] = True
                    used = np.flatnonzero(there)
                    number[used] = np.arange(len(used))
                    key = number.take(flat[at])
                    for s in range(STATES):
                        sums[s, used] += np.bincount(key, chances[s].take(at), len(used))
                at = np.flatnonzero(shared & (flat < 0))
                if not others or not len(at):
                    return
                rare = np.zeros(inside.shape, np.int64)
                for j, i in enumerate(rows.tolist()):
                    own = rares[i].values.to_numpy()
                    if len(own):
                        rare[np.flatnonzero(heads[i] < 0), j] = own
                word, first, key, n = np.unique(
                    rare[inside][at], return_index=True, return_inverse=True, return_counts=True
                )
                added = [np.bincount(key, c.take(at), len(word)) for c in chances]
                columns = [word, symbols[at][first].astype(np.int32), n, *added]
                columns = [pa.array(c).cast(f.type) for c, f in zip(columns, list(arrow)[2:])]
                none = [pa.nulls(len(word), f.type) for f in list(arrow)[:2]]
                ready.append(pa.RecordBatch.from_arrays(none + columns, schema=arrow))

            part = model.expected(b.column(0), ratios, seen)
            total = part if total is None else total + part
            yield from ready
            ready.clear()
        if total is None:
            return
        yield batch([-1], [total.tobytes()])
        for at in range(0, size, PLACES):
            part = sums[:, at : at + PLACES]
            some = np.flatnonzero(part.any(0))
            if len(some):
                head = np.append(len(some), some).astype("<u2").tobytes()
                yield batch([at // PLACES], [head + packed(part[:, some].astype("<f4"))])

    return coded.select("symbols", "head", "rare").mapInArrow(run, GATHERED)


def block_sums(rows: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The matrix and the sums of the head (places by states); both have bounded sizes and come to the driver."""
    arrow = to_arrow_schema(BLOCK_SUMS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {}
        for b in batches:
            for block, sums in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if block < 0:
                    held[block] = held.get(block, 0) + np.frombuffer(sums)
                    continue
                total = held.setdefault(block, np.zeros((PLACES, STATES)))
                n = int.from_bytes(sums[:2], "little")
                part = unpacked(sums[2 + 2 * n :], "<f4").reshape(STATES, n).T
                total[np.frombuffer(sums, "<u2", n, 2)] += part
        for block, total in held.items():
            columns = [pa.array([block], pa.int32()), pa.array([total.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    counts, head = np.zeros((0, 0)), np.zeros((size, STATES))
    with dropped_shuffles(rows.sparkSession):
        got = rows.where("block IS NOT NULL").select("block", "sums").repartition("block").mapInArrow(run, BLOCK_SUMS)
        got = got.toArrow()
    for r in got.to_pylist():
        sums = np.frombuffer(r["sums"])
        if r["block"] < 0:
            counts = sums.reshape(-1, SYMBOLS)
        else:
            part = head[r["block"] * PLACES :][:PLACES]
            part += sums.reshape(PLACES, STATES)[: len(part)]
    return counts, head


def head_shared(words: Words) -> np.ndarray:
    """Places in the head of the words of shared symbols."""
    return np.flatnonzero(words.symbol < 0)


def rest_ratios(words: Words, ratio: np.ndarray) -> np.ndarray:
    """The table of ratios by place: that of the head, then of all other words of each shared symbol together, so
    that the shares of a state add up to one, and of no word.
    """
    own, rest = head_shared(words), np.zeros((SHARED, STATES))
    g = words.shared[own]
    plain = (words.n[own] + 0.5) / (words.shared_total[g] + 0.5 * (words.shared_types[g] + 1))
    taken = np.stack([np.bincount(g, plain * ratio[own, s], SHARED) for s in range(STATES)], 1)
    left = 1 - np.bincount(g, plain, SHARED)
    rest = np.maximum(1 - taken, 1e-9) / np.maximum(left, 1e-9)[:, None]
    return np.concatenate([ratio, np.ones((1, STATES)), rest[::-1]]).astype(np.float32)


def first_ratios(words: Words) -> np.ndarray:
    """Each state with its own bias on the words of the head, as in :func:`first_model`."""
    ratio, own = np.ones((len(words.word), STATES)), head_shared(words)
    if len(own):
        bias, g = np.exp(np.random.default_rng(SEED + 1).normal(0, 1.0, (len(own), STATES))), words.shared[own]
        weight = words.n[own] + 0.5
        whole = np.stack([np.bincount(g, weight * bias[:, s], SHARED) for s in range(STATES)], 1)
        ratio[own] = bias * (np.bincount(g, weight, SHARED)[g][:, None] / whole[g])
    return rest_ratios(words, ratio)


def head_ratios(words: Words, counts: np.ndarray, sums: np.ndarray) -> np.ndarray:
    ratio, own = np.ones((len(words.word), STATES)), head_shared(words)
    if counts.size and len(own):
        ratio[own] = word_ratios(words, counts, OWN + words.shared[own], words.n[own], sums[own])
    return ratio


def word_ratios(words: Words, counts: np.ndarray, symbol: np.ndarray, n: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """How much likelier than by its plain share within its symbol a word is in each state.

    The expected counts of a word are smoothed by half a count that is dealt as its symbol, and mixed with the
    plain shares. Over the words of a symbol, an unknown one among them, the shares of a state add up to one.
    """
    g = symbol - OWN
    total, types = words.shared_total[g], words.shared_types[g]
    whole = counts[1 + STATES : 1 + 2 * STATES].T[symbol]
    dealt = 0.5 * (whole + 1e-3) / (whole + 1e-3).sum(1, keepdims=True)
    share = (inside + dealt) / (whole + types[:, None] * dealt)
    plain = (n + 0.5) / (total + 0.5 * types)
    return WORD_SHARE * share / plain[:, None] + (1 - WORD_SHARE)


def first_model(words: Words) -> Hmm:
    """States that stay likely and emit the training shares, each with its own bias on the own symbols."""
    rng = np.random.default_rng(SEED)
    shares = np.full(SYMBOLS, 1.0)
    own = words.symbol >= 0
    shares[words.symbol[own]] += words.n[own]
    shares[OWN:END] += words.shared_total
    shares[END] += words.ends
    emit = shares[:, None] * np.exp(rng.normal(0, 1.0, (SYMBOLS, STATES)))
    move = np.full((STATES, STATES), 0.3 / STATES) + 0.7 * np.eye(STATES)
    return Hmm(np.full(STATES, 1 / STATES), move, emit / emit.sum(0))


def maximised(counts: np.ndarray, old: Hmm) -> Hmm:
    """The next model; every symbol keeps a small chance in every state."""
    if not counts.size:
        return old
    start = counts[0, :STATES] + 0.1
    move = counts[1 : 1 + STATES, :STATES] + 0.1
    emit = counts[1 + STATES : 1 + 2 * STATES]
    emit = (emit + 0.01 + 0.1 * emit.sum(0) / max(emit.sum(), 1.0)).T
    return Hmm(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def score_documents(docs: DataFrame, iterations: int = ITERATIONS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every whole text.

    Learns from documents whose fold is not 1; a null doc_id is not held out. A null or empty text is
    the end token alone. Repeated rows are scored, and learnt from, each by itself. Without training
    texts every word is unknown. Other columns are not read. Hot words are in the head, which every
    task holds; rare ones, and their shares in the states, are looked up by joins, for whatever share of the
    text they make up.
    """
    spark = docs.sparkSession
    held = F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False))
    texts = whole_texts(docs).withColumn("held_out", held)
    train = texts.where("NOT held_out")
    with dropped_shuffles(spark):
        counts = materialize(count_words(train), "hmm-words")
    words = word_table(counts, train.select("doc_id").count())
    known = spark.sparkContext.broadcast(words)

    def make():
        words = known.value

        def f(doc_ids, held_out, texts):
            for doc_id, out, made in zip(doc_ids, held_out, words.code(texts)):
                yield (doc_id, out, *made)

        return f

    coded = map_slices(texts.select("doc_id", "held_out", "text"), make, CODED)
    coded = coded.withColumn("row", F.monotonically_increasing_id())
    coded = materialize(coded, "hmm-coded")

    model, train, size = first_model(words), coded.where("NOT held_out"), len(words.word)
    table, counted, sums, rows = first_ratios(words), np.zeros((0, 0)), np.zeros((size, STATES)), None
    for i in range(iterations):
        last = i == iterations - 1
        # At most HEAD_WORDS rows of 32 bytes.
        given = spark.sparkContext.broadcast(table)
        rows = gathered(train, model, known, given, last)
        if last:
            rows = materialize(rows, "hmm-gathered")
        counted, sums = block_sums(rows, size)
        given.destroy()
        model, table = maximised(counted, model), rest_ratios(words, head_ratios(words, counted, sums))
    # In the score every word has its own ratio, and unknown ones are as likely in all states.
    table[size:] = 1.0
    table = spark.sparkContext.broadcast(table)
    ratio_arrow = to_arrow_schema(RATIOS)

    def ratios(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                symbol, n = b.column(1).to_numpy(), b.column(2).to_numpy()
                inside = np.stack([c.to_numpy() for c in b.columns[3:]], 1)
                made = word_ratios(known.value, counted, symbol, n, inside).astype(np.float32)
                columns = [b.column(0), b.column(2), pa.array([r.tobytes() for r in made], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema=ratio_arrow)

    if rows is None:
        by_word = counts.select("word", "n", F.lit(None).cast("binary").alias("ratio"))
    else:
        others = rows.where("word IS NOT NULL").groupBy("word", "symbol")
        others = others.agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in IN_STATES])
        by_word = others.mapInArrow(ratios, RATIOS)
        with dropped_shuffles(spark):
            by_word = materialize(by_word, "hmm-ratios")
        emptied(rows)

    arrow = to_arrow_schema(SCORED)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            heads = [unpacked(x, "<i4") for x in b.column("head").to_pylist()]
            places, made = b.column("at").to_pylist(), b.column("ratio").to_pylist()

            def ratio(rows, inside):
                out = table.value[padded_places(heads, rows, len(inside))[inside]]
                active = inside.sum(1)
                first = np.cumsum(active) - active  # of the tokens of a step
                for j, i in enumerate(rows.tolist()):
                    if places[i]:
                        rare = np.flatnonzero(heads[i] < 0)[places[i]]
                        out[first[rare] + j] = np.frombuffer(b"".join(made[i]), np.float32).reshape(-1, STATES)
                return out

            logs = model.likelihoods(b.column("symbols"), ratio)
            columns = [b.column(name) for name in SCORED.names[:-1]] + [pa.array(logs)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    rare = coded.select("row", F.posexplode("rare").alias("at", "word")).join(by_word, "word", "left")
    log = F.log10(F.coalesce("n", F.lit(0)) + F.lit(0.5))
    found = F.when(F.col("ratio").isNotNull(), F.struct("at", "ratio"))
    rare = rare.groupBy("row").agg(
        F.sum(log).alias("rare_logs"),
        F.count_if(F.col("n") > 0).alias("rare_known"),
        F.collect_list(found).alias("found"),
    )
    # Stored, so that the shuffles of single words are gone before the coded texts are shuffled.
    with dropped_shuffles(spark):
        rare = materialize(rare, "hmm-rare")
    emptied(counts, *([] if rows is None else [by_word]))
    run = coded.drop("rare").join(rare, "row", "left").select(
        "doc_id",
        "held_out",
        F.octet_length("symbols").cast("long").alias("n_tokens"),
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        "log_counts",
        "log_own",
        F.coalesce("rare_logs", F.lit(0.0)).alias("rare_logs"),
        "symbols",
        "head",
        "found.at",
        "found.ratio",
    )
    return run.mapInArrow(scored, SCORED).select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(words.total).cast("long").alias("train_tokens"),
        (F.col("log_counts") + F.col("rare_logs") - F.col("n_tokens") * F.lit(words.log_all)).alias("base_score"),
        (F.col("log10") + F.col("log_own") + F.col("rare_logs")).alias("score"),
    )
