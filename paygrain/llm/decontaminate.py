"""Benchmark decontamination by approximate matching under an edit budget.

A place where a benchmark item stands in a document with at most k edits shares at least
m + 1 - (k + 1) q of the item's m - q + 1 q-grams with it (the q-gram lemma), and all on diagonals that are at most
k apart. Shared q-grams are therefore counted in overlapping bands of diagonals, bands that meet
the bound are kept, and the item is aligned with the region of each kept band by dynamic programming
inside the band. The filter loses nothing within the budget. Items take a smaller q where their size and
budget ask for it; items of eight bytes or less without edits are looked up whole. Places of short items
begin and end at word borders, as a few bytes also stand inside other words by chance.

Items go to the tasks in blocks of bounded size; documents are read once for each block and not shuffled.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from paygrain.llm.common import filter_rows, map_rows, whole_texts

Q, EDIT_SHARE, BLOCK_BYTES, SHORT_BYTES = 8, 0.1, 4 << 20, 50
SLOTS = 1 << 20
OFFSET = 1 << 40  # makes diagonals positive
# Line ends and tabs count as blanks, A-Z as a-z; places stay the same.
PLAIN = bytes.maketrans(b"\t\n\r\x0b\x0c", b"     ")
# Scripts without blanks between words: any two characters are parted.
UNSPACED = ("CJK", "HIRAGANA", "KATAKANA", "THAI", "LAO", "KHMER", "MYANMAR", "TIBETAN")

HITS = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("item_id", LongType()),
        StructField("start_byte", LongType()),
        StructField("end_byte", LongType()),
        StructField("edits", LongType()),
        StructField("similarity", DoubleType()),
    ]
)


def plain(text: str) -> bytes:
    return text.encode("utf-8").lower().translate(PLAIN)


def grams(raw: bytes, q: int = Q) -> np.ndarray:
    """The q-gram (up to eight bytes) that starts at each place, as one integer."""
    if len(raw) < q:
        return np.zeros(0, np.uint64)
    g = np.ndarray((len(raw) - q + 1,), "<u8", raw + bytes(Q - q) if q < Q else raw, 0, (1,))
    return g & np.uint64((1 << 8 * q) - 1) if q < Q else g.copy()


def gram_size(size: int, budget: int) -> int:
    """The largest q of which at least two sampled q-grams remain after the edits, so that the counts can tell."""
    q = min(Q, size // (budget + 2))
    if not q:
        raise ValueError(f"{budget} edits in an item of {size} bytes leave nothing to find it by")
    return q


@cache
def in_word(c: str) -> bool:
    """Letters, digits and marks hold together as words, but for scripts that do not part words."""
    if not c.isalnum() and unicodedata.category(c)[0] != "M":
        return False
    return not unicodedata.name(c, "").startswith(UNSPACED)


def word_borders(raw: bytes) -> np.ndarray:
    """For each place of a text and its end: whether no word goes on there."""
    text = raw.decode("utf-8")
    code, which = np.unique(np.frombuffer(text.encode("utf-32-le"), "<u4"), return_inverse=True)
    size = 1 + (code > 0x7F).astype(int) + (code > 0x7FF) + (code > 0xFFFF)
    word = np.array([in_word(chr(c)) for c in code.tolist()], bool)[which]
    at = np.append(0, np.cumsum(size[which]))
    borders = np.zeros(len(raw) + 1, bool)
    borders[at] = ~(np.append(False, word) & np.append(word, False))
    return borders


def slot(g: np.ndarray) -> np.ndarray:
    return ((g * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)


def align(
    item: np.ndarray, region: np.ndarray, first: int, width: int, most: int, ends: np.ndarray | None = None
) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best place of the item in the region, within ``width`` diagonals from ``first``.

    The whole item is matched, the ends of the region are free. Among equal numbers of edits the first end
    counts. None as soon as no alignment can stay within ``most`` edits. ``ends`` tells for every place of the
    region whether a match may begin or end there.
    """
    m, n, far = len(item), len(region), 1 << 30
    lanes = np.arange(width)
    # Lane d of row i: the item's first i bytes, ending at region place first + d + i. A margin of
    # bytes that match nothing stands for what lies outside.
    margin = np.full(m + width + abs(first) + 1, 256, np.int16)
    padded = np.concatenate([margin, region, margin])
    shift = len(margin) + first
    outside = lambda i: (first + lanes + i < 0) | (first + lanes + i > n)
    edge = first < 0 or first + width + m > n
    barred = lambda i: ~ends[np.clip(first + lanes + i, 0, n)]
    cost = np.where(outside(0), far, 0)
    begin = first + lanes
    if ends is not None:  # region bytes between a place where a match may begin and its first byte are edits
        cost[barred(0)] = far
        run = np.minimum.accumulate(cost - lanes)
        begin = begin[np.maximum.accumulate(np.where(cost - lanes == run, lanes, 0))]
        cost = run + lanes
        cost[outside(0)] = far
    up, up_begin = np.empty_like(cost), np.empty_like(begin)
    for i in range(m):
        step = cost + (padded[shift + i : shift + i + width] != item[i])
        up[:-1], up[-1] = cost[1:], far  # item byte left out: the next lane of the row above
        up_begin[:-1], up_begin[-1] = begin[1:], 0
        up += 1
        step_begin = np.where(up < step, up_begin, begin)
        np.minimum(step, up, out=step)
        if edge:
            step[outside(i + 1)] = far
        step -= lanes  # region bytes left out move along the row: a running minimum
        run = np.minimum.accumulate(step)
        source = np.maximum.accumulate(np.where(step == run, lanes, 0))
        cost = run + lanes
        begin = step_begin[source]
        if edge:
            cost[outside(i + 1)] = far
        if cost.min() > most:
            return None
    if ends is not None:
        cost[barred(m)] = far
        if cost.min() > most:
            return None
    best = int(cost.argmin())
    return int(cost[best]), int(begin[best]), first + best + m


@dataclass(frozen=True)
class Items:
    """Benchmark items of one q: their sampled q-grams, sorted, with item and place of each."""

    q: int
    ids: list[int]
    texts: list[np.ndarray]
    budget: np.ndarray
    gram: np.ndarray
    item: np.ndarray
    place: np.ndarray
    present: np.ndarray

    @staticmethod
    def of(rows: list[tuple[int, bytes, int]], q: int) -> Items:
        """Items from (item_id, plain text, whole edits)."""
        texts, budget = [t for _, t, _ in rows], np.array([k for *_, k in rows])
        sampled = [grams(t, q)[::q] for t in texts]
        gram = np.concatenate(sampled)
        item = np.repeat(np.arange(len(rows)), [len(x) for x in sampled])
        place = np.concatenate([q * np.arange(len(x)) for x in sampled])
        order = np.argsort(gram, kind="stable")
        present = np.zeros(SLOTS, bool)
        present[slot(gram)] = True
        arrays = [np.frombuffer(t, np.uint8) for t in texts]
        return Items(q, [i for i, *_ in rows], arrays, budget, gram[order], item[order], place[order], present)

    def bands(self, g: np.ndarray) -> list[tuple[int, int]]:
        """(item, first diagonal) of the bands of 2 (k + 1) diagonals that share enough sampled q-grams.

        A new band begins every k + 1 diagonals, so that any k + 1 neighbours lie inside one.
        """
        at = np.flatnonzero(self.present[slot(g)])
        low = np.searchsorted(self.gram, g[at], "left")
        times = np.searchsorted(self.gram, g[at], "right") - low
        entry = np.repeat(low - (np.cumsum(times) - times), times) + np.arange(times.sum())
        if not entry.size:
            return []
        item, diagonal = self.item[entry], np.repeat(at, times) - self.place[entry]
        step = self.budget[item] + 1
        band = (diagonal + OFFSET) // step
        key = (np.tile(item, 2) << 44) + np.concatenate([band, band - 1])
        key, counts = np.unique(key, return_counts=True)
        item, band = key >> 44, key & ((1 << 44) - 1)
        size = np.array([len(t) for t in self.texts])[item]
        enough = counts >= size // self.q - self.budget[item]
        first = band * (self.budget[item] + 1) - OFFSET
        return list(zip(item[enough].tolist(), first[enough].tolist()))

    def shared(self, g: np.ndarray, i: int, first: int) -> int:
        """All q-grams of item i that the text shares with it on the diagonals of a band."""
        k, own = int(self.budget[i]), grams(self.texts[i].tobytes(), self.q)
        low = max(first, 0)
        near = g[low : max(first + 2 * (k + 1) + len(own), 0)]
        order = np.argsort(own, kind="stable")
        begin = np.searchsorted(own[order], near, "left")
        times = np.searchsorted(own[order], near, "right") - begin
        entry = np.repeat(begin - (np.cumsum(times) - times), times) + np.arange(times.sum())
        place, at = order[entry], low + np.repeat(np.arange(len(near)), times)
        inside = (at - place >= first) & (at - place < first + 2 * (k + 1))
        return min(len(np.unique(place[inside])), len(np.unique(at[inside])))

    def matches(self, raw: bytes, borders: np.ndarray | None) -> list[tuple[int, int, int, int, float]]:
        """(item id, start, end, edits, similarity): the best place of every item found in a text."""
        g, best = grams(raw, self.q), {}
        whole = np.frombuffer(raw, np.uint8)
        for i, first in self.bands(g):
            k, m = int(self.budget[i]), len(self.texts[i])
            if self.shared(g, i, first) < m + 1 - (k + 1) * self.q:
                continue
            begin = max(first - k, 0)
            stop = max(first + 3 * (k + 1) + m + k, 0)
            ends = borders if m < SHORT_BYTES else None
            exact = raw.find(self.texts[i].tobytes(), begin, stop)
            while exact >= 0 and ends is not None and not (ends[exact] and ends[exact + m]):
                exact = raw.find(self.texts[i].tobytes(), exact + 1, stop)
            if exact >= 0:
                found = (0, exact - begin, exact - begin + m)
            else:
                region = whole[begin:stop]
                near = None if ends is None else ends[begin : begin + len(region) + 1]
                found = align(self.texts[i], region, first - k - begin, 4 * (k + 1), k, near)
            if found is not None:
                found = (found[0], begin + found[1], begin + found[2])
                best[i] = min(best.get(i, found), found)
        return [
            (self.ids[i], start, end, edits, 1.0 - edits / len(self.texts[i]))
            for i, (edits, start, end) in sorted(best.items())
        ]


@dataclass(frozen=True)
class Tiny:
    """Items of one size of at most eight bytes, found without edits: each is one gram."""

    size: int
    ids: dict[int, list[int]]
    gram: np.ndarray

    @staticmethod
    def of(rows: list[tuple[int, bytes, int]], size: int) -> Tiny:
        ids = {}
        for i, text, _ in rows:
            ids.setdefault(int(grams(text, size)[0]), []).append(i)
        return Tiny(size, ids, np.array(sorted(ids), np.uint64))

    def matches(self, raw: bytes, borders: np.ndarray) -> list[tuple[int, int, int, int, float]]:
        """As those of :class:`Items`: the first place of every item."""
        g = grams(raw, self.size)
        at = np.flatnonzero(borders[: len(g)] & borders[self.size :][: len(g)])
        low = np.minimum(np.searchsorted(self.gram, g[at]), len(self.gram) - 1)
        at = at[self.gram[low] == g[at]]
        gram, first = np.unique(g[at], return_index=True)
        return [
            (i, start, start + self.size, 0, 1.0)
            for x, start in zip(gram.tolist(), at[first].tolist())
            for i in self.ids[x]
        ]


@dataclass(frozen=True)
class Block:
    """A block of benchmark items, parted by how they are found."""

    parts: list[Items | Tiny]
    has_short: bool

    @staticmethod
    def of(rows: list[tuple[int, bytes]], edit_share: float) -> Block:
        tiny, longer = {}, {}
        for item_id, text in rows:
            size = len(text)
            k = int(size * edit_share)
            if size <= Q and not k:
                tiny.setdefault(size, []).append((item_id, text, 0))
            else:
                longer.setdefault(gram_size(size, k), []).append((item_id, text, k))
        parts = [Tiny.of(part, size) for size, part in sorted(tiny.items())]
        parts += [Items.of(part, q) for q, part in sorted(longer.items())]
        return Block(parts, any(len(text) < SHORT_BYTES for _, text in rows))

    def matches(self, raw: bytes) -> list[tuple[int, int, int, int, float]]:
        """(item id, start, end, edits, similarity): the best place of every item found in a text."""
        borders = word_borders(raw) if self.has_short else None
        return [m for part in self.parts for m in part.matches(raw, borders)]

    def any_in(self, raw: bytes) -> bool:
        borders = word_borders(raw) if self.has_short else None
        return any(part.matches(raw, borders) for part in self.parts)


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES):
    """Items as lists of (item_id, plain text) of at most ``block_bytes`` together (or one item).

    Items come to the driver one partition at a time and one block is held; null ones and those
    of white space only are left out.
    """
    block, held = [], 0
    items = benchmark.select(benchmark["item_id"].cast("long"), benchmark["text"])
    items = items.where("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    for item_id, text in items.toLocalIterator():
        raw = plain(text).strip()
        if not raw:
            continue
        if block and held + len(raw) > block_bytes:
            yield block
            block, held = [], 0
        block.append((item_id, raw))
        held += len(raw)
    if block:
        yield block


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, edit_share: float = EDIT_SHARE, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(doc_id, item_id, start_byte, end_byte, edits, similarity): the best place of an item in a document.

    A row for each document and item that stands in it, whole, with edits of at most ``edit_share``
    of its bytes; letters A-Z in either case and any white space are the same. Places of items under ``SHORT_BYTES``
    bytes begin and end at word borders. An ``edit_share`` that leaves nothing to find an item by raises. Offsets are bytes of the UTF-8
    text. A null or empty text, or an empty benchmark, gives no rows; repeated rows and null doc_ids are reported
    once each; of equally good places the first counts. Other columns are not read.
    """
    texts, spark = whole_texts(docs), docs.sparkSession
    found = spark.createDataFrame([], HITS)
    for block in item_blocks(benchmark, block_bytes):
        held = spark.sparkContext.broadcast((block, edit_share))  # at most block_bytes and its q-grams

        def make(held=held):
            items = Block.of(*held.value)
            return lambda doc_id, text: [(doc_id, *m) for m in items.matches(plain(text))]

        found = found.unionByName(map_rows(texts, make, HITS))
    return found


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, edit_share: float = EDIT_SHARE, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``docs`` without the rows in whose text an item stands; all columns stay, nothing is shuffled."""
    for block in item_blocks(benchmark, block_bytes):
        held = docs.sparkSession.sparkContext.broadcast((block, edit_share))  # as in find_leaks

        def make(held=held):
            items = Block.of(*held.value)
            return lambda text: not items.any_in(plain(text))

        docs = filter_rows(docs, make)
    return docs
