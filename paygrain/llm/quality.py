"""A quality classifier on document statistics.

Random Fourier features approximate a Gaussian kernel over the statistics of a text. Ridge
scores come from normal equations that each task sums over its rows; their size depends on the
number of features only. The scores are then made probabilities by isotonic regression on labelled rows that the
ridge has not seen.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    LongType,
    StructField,
    StructType,
)

from paygrain.llm.common import filter_rows, fold, map_rows, summed, whole_texts
from paygrain.session import materialize

N_STATS, N_FOURIER, WIDTH, RIDGE, SEED, BINS = 24, 192, 3.0, 1e-3, 7, 2_000

STATS = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("stats", ArrayType(DoubleType())),
    ]
)


def document_stats(text: str) -> list[float]:
    """Shares and ratios of a whole text; all zero for an empty one."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * N_STATS
    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
    at = np.bincount(raw, minlength=256)
    size = float(raw.size)
    upper, lower, digits = at[65:91].sum(), at[97:123].sum(), at[48:58].sum()
    signs = at[33:48].sum() + at[58:65].sum() + at[91:97].sum() + at[123:127].sum()
    ends = at[33] + at[46] + at[63]
    odd = signs - at[46] - at[44] - at[39] - at[34] - at[45]
    times = Counter(words)
    top = [c for _, c in times.most_common(3)]
    lengths = np.fromiter(map(len, words), np.int64, n)
    twice = sum(map(str.__eq__, words, words[1:]))
    capitals = sum(map(str.isupper, words))
    lines = [x for x in text.split("\n") if x.strip()]
    p = at[at > 0] / size
    return [
        float(x)
        for x in (
            np.log1p(n) / 10,
            len(times) / n,
            np.log(n + 1) / np.log(len(times) + 1),
            top[0] / n,
            sum(top) / n,
            twice / max(n - 1, 1),
            capitals / n,
            lengths.mean() / 10,
            lengths.std() / 10,
            (lengths > 20).mean(),
            (lengths == 1).mean(),
            upper / max(upper + lower, 1),
            digits / size,
            signs / size,
            odd / size,
            at[33] / size,
            at[124] / size,
            ends / n,
            at[44] / n,
            at[128:].sum() / size,
            len(set(lines)) / max(len(lines), 1),
            np.log1p(size / max(len(lines), 1)) / 10,
            (at[32] + at[9] + at[10] + at[13]) / size,
            -(p * np.log(p)).sum() / 5,
        )
    ]


def stats_of(docs: DataFrame) -> DataFrame:
    """(doc_id, stats) of every whole text; a null text counts as empty."""
    return map_rows(whole_texts(docs), lambda: lambda i, t: [(i, document_stats(t))], STATS)


@dataclass(frozen=True)
class Model:
    """What fitting leaves: arrays whose size does not depend on the data."""

    mean: np.ndarray
    spread: np.ndarray
    waves: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    levels: np.ndarray  # raw scores, rising
    chances: np.ndarray  # share of label 1 at those

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.spread, -6, 6)
        waves = np.sqrt(2 / len(self.phases)) * np.cos(x @ self.waves + self.phases)
        return np.hstack([waves, x, np.ones((len(x), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.levels, self.chances), 0.0, 1.0)


def _stats_array(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, N_STATS)


def _summed(rows: DataFrame, partial) -> np.ndarray:
    """The sum over all rows of what ``partial(stats, labels)`` gives for a batch."""
    return summed(
        rows.select("stats", "label"),
        lambda b: partial(_stats_array(b.column(0)), b.column(1).to_numpy(zero_copy_only=False)),
    )


def isotonic(x: np.ndarray, weight: np.ndarray, positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centres and rising shares of the pooled blocks (pool adjacent violators)."""
    blocks: list[list[float]] = []
    for centre, w, y in zip(x, weight, positive):
        blocks.append([centre * w, w, y])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return (
        np.array([b[0] / b[1] for b in blocks]),
        np.array([b[2] / b[1] for b in blocks]),
    )


def fit(stats: DataFrame, labels: DataFrame, folds: tuple[int, ...] = (1, 2, 3, 4)) -> Model | None:
    """Learns from labelled rows whose fold of doc_id is in ``folds``; the first of them calibrates.

    ``stats`` is the result of :func:`stats_of`, ``labels`` has doc_id and quality. Rows with a null
    label are left out, repeated ones count each. None if no row is left to learn from.
    """
    marks = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].alias("label"))
    marks = marks.where("label IS NOT NULL AND doc_id IS NOT NULL")
    marks = marks.withColumn("label", F.col("label").cast("double")).withColumn("fold", fold(F.col("doc_id")))
    marks = marks.where(F.col("fold").isin(list(folds)))
    rows = materialize(stats.join(marks, "doc_id").select("stats", "label", "fold"), "quality-rows")
    train = rows.where(F.col("fold") != folds[0])

    def moments(x, y):
        return np.vstack([np.full(N_STATS, float(len(x))), x.sum(0), (x * x).sum(0)])

    sums = _summed(train, moments)
    if not sums.size:
        return None
    mean = sums[1] / sums[0]
    spread = np.sqrt(np.maximum(sums[2] / sums[0] - mean**2, 1e-8))
    rng = np.random.default_rng(SEED)
    waves = rng.normal(0.0, 1.0 / (WIDTH * np.sqrt(N_STATS / 4)), (N_STATS, N_FOURIER))
    phases = rng.uniform(0, 2 * np.pi, N_FOURIER)
    blank = Model(mean, spread, waves, phases, np.zeros(0), np.zeros(0), np.zeros(0))

    def normal(x, y):
        f = blank.features(x)
        return np.hstack([f.T @ f, (f.T @ y)[:, None]])

    sums = _summed(train, normal)
    gram, right = sums[:, :-1], sums[:, -1]
    n = gram[-1, -1]
    weights = np.linalg.solve(gram + RIDGE * n * np.eye(len(gram)), right)
    ridge = Model(mean, spread, waves, phases, weights, np.zeros(0), np.zeros(0))

    def binned(x, y):
        b = np.clip((ridge.raw(x) + 1) / 3 * BINS, 0, BINS - 1).astype(int)
        return np.vstack([np.bincount(b, minlength=BINS), np.bincount(b, y, minlength=BINS)])

    held = _summed(rows.where(F.col("fold") == folds[0]), binned)
    if not held.size:
        held = _summed(train, binned)
    some = np.flatnonzero(held[0])
    levels, chances = isotonic((some + 0.5) / BINS * 3 - 1, held[0][some], held[1][some])
    return Model(mean, spread, waves, phases, weights, levels, chances)


SCORED = StructType([StructField("doc_id", LongType()), StructField("score", DoubleType())])


def score(stats: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score): the calibrated chance of label 1, 0.5 for all rows without a model."""
    arrow = to_arrow_schema(SCORED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = _stats_array(b.column(1))
                values = model.score(x) if model is not None else np.full(len(x), 0.5)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(values)], schema=arrow)

    return stats.select("doc_id", "stats").mapInArrow(run, SCORED)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score) of every whole text, learnt from labels outside the held-out fold 0.

    A null or empty text is scored by its (zero) statistics; repeated rows and null doc_ids give a
    row each (a null id is not held out). An empty table gives no rows. Other columns are not read.
    """
    stats = materialize(stats_of(docs), "quality-stats")
    scored = score(stats, fit(stats, labels))
    held_out = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score")


def without_bad(docs: DataFrame, labels: DataFrame, least: float = 0.3) -> DataFrame:
    """``docs`` without the documents that score under ``least``; all columns stay, nothing is shuffled.

    Learns as :func:`quality_scores` does; without labels nothing is rejected.
    """
    model = fit(stats_of(docs), labels)

    def make():
        if model is None:
            return lambda text: True
        return lambda text: model.score(np.array([document_stats(text)]))[0] >= least

    return filter_rows(docs, make)
