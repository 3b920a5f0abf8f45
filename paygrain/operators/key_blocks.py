"""A block of lookup keys that a task compares with its share of the other keys.

Only what may reach the threshold is looked at: an index of the letter triples of the block (pairs, for short keys)
and their places finds keys that share enough of them at about the same place, then letter and pair counts bound the ratio, then the longest common
subsequence does, and the ratio itself is computed for the rest, best bound first. All bounds are exact.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from difflib import SequenceMatcher

import numpy as np

EPS = 1e-9
# Letters that the index takes together, and the part of a key's runs that must be shared to make it worth a look.
GRAMS, WORTH = (3, 2), 0.2
# Hash classes of letters and letter pairs.
_LETTERS, _PAIRS = 48, 96


def _flat(keys: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of the keys in a row, and the number of the key of each."""
    codes = np.frombuffer("".join(keys).encode("utf-32-le"), np.uint32).astype(np.int64)
    return codes, np.repeat(np.arange(len(keys)), [len(k) for k in keys])


def profile(keys: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the letters and of the neighbouring pairs of letters of each key, by hash class."""
    codes, owner = _flat(keys)
    kind = np.uint32 if max(map(len, keys), default=0) > 255 else np.uint8
    n, together = len(keys), owner[:-1] == owner[1:]
    letters = np.bincount(owner * _LETTERS + codes % _LETTERS, minlength=n * _LETTERS)
    pair = (codes[:-1] * 31 + codes[1:]) % _PAIRS
    pairs = np.bincount((owner[:-1] * _PAIRS + pair)[together], minlength=n * _PAIRS)
    return letters.reshape(n, _LETTERS).astype(kind), pairs.reshape(n, _PAIRS).astype(kind)


def grams(keys: Sequence[str], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n letters in a row, place, key) of all keys, in this order."""
    codes, owner = _flat(keys)
    whole = owner[: 1 - n] == owner[n - 1 :]
    code = np.zeros(max(len(codes) - n + 1, 0), np.int64)
    for i in range(n):
        code = (code << 21) + codes[i : len(code) + i]
    first = np.searchsorted(owner, np.arange(len(keys)))
    place = np.arange(len(code)) - first[owner[: len(code)]]
    code, place, owner = code[whole], place[whole], owner[: len(whole)][whole]
    order = np.lexsort((owner, place, code))
    return code[order], place[order], owner[order]


def partner_sizes(size: int, threshold: float) -> tuple[int, int]:
    """Smallest and largest size of a key that can reach the threshold with one of ``size``."""
    t = threshold
    return math.ceil(size * t / (2 - t) - EPS), math.floor(size * (2 - t) / t + EPS)


def least_shared_grams(size: int, threshold: float, n: int) -> np.ndarray:
    """How many runs of ``n`` letters, at least, are shared with a partner that reaches the threshold, for each size
    of partner (from the smallest to the largest possible); 0 or less: no bound.

    M matched letters in r stretches hold M - r (n - 1) such runs or more. Stretches are kept apart by unmatched
    letters, of which there are T - 2 M in both keys of T letters, so r is at most T - 2 M + 1.
    """
    total, matched = _matched(size, threshold)
    return matched - (n - 1) * (total - 2 * matched + 1)


def _matched(size: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Letters of both keys, and matched letters at least, for each size of partner."""
    low, high = partner_sizes(size, threshold)
    total = size + np.arange(low, max(high, low) + 1)
    return total, np.ceil(threshold * total / 2 - EPS).astype(np.int64)


def common_subsequence(masks: dict[str, int], size: int, other: str) -> int:
    """Length of the longest common subsequence of ``other`` and the string that the bit masks stand for."""
    full = (1 << size) - 1
    rest = full
    for ch in other:
        hit = rest & masks.get(ch, 0)
        rest = ((rest + hit) | (rest - hit)) & full
    return size - rest.bit_count()


class KeyBlock:
    """Some lookup keys, by length, with what bounds the ratio.

    M matched characters in r runs leave r - 1 gaps, each with an unmatched character, so that the two
    strings (T characters together) share at least M - r >= 3 M - 1 - T pairs of letters, and M letters. Merging
    letters or pairs into classes can only raise what they seem to share.
    """

    def __init__(self, keys: Sequence[str], order: Sequence[object], threshold: float):
        rows = sorted(zip(keys, order), key=lambda r: len(r[0]))
        self.keys, self.order = [k for k, _ in rows], [o for _, o in rows]
        self.sizes = np.array([len(k) for k in self.keys], np.int64)
        self.width = int(self.sizes.max(initial=1))
        self.letters, self.pairs = profile(self.keys)
        self.threshold = threshold
        self.bounds: dict[int, tuple] = {}
        self.indexes: dict[int, tuple[np.ndarray, ...]] = {}

    def index(self, n: int) -> tuple[np.ndarray, ...]:
        """(runs of n letters, number of the run and place as one, keys)."""
        if n not in self.indexes:
            code, place, owner = grams(self.keys, n)
            runs, number = np.unique(code, return_inverse=True)
            self.indexes[n] = runs, number * self.width + place, owner
        return self.indexes[n]

    def _bounds(self, size: int) -> tuple:
        """(letters taken together or 0, then by size of the lookup key: shared runs, places back, places on)."""
        total, matched = _matched(size, self.threshold)
        for n in GRAMS:
            need = least_shared_grams(size, self.threshold, n)
            if need.min(initial=size) >= max(WORTH * (size - n + 1), 1):
                by_size = np.full((3, self.width + 1), -1, np.int64)
                sizes = total - size
                known = sizes <= self.width
                by_size[:, sizes[known]] = np.stack([need, size - matched, sizes - matched])[:, known]
                return n, *by_size
        return 0, None, None, None

    def alike(self, key: str, low: int, high: int) -> np.ndarray | None:
        """Places in [low, high) that share enough runs of letters with the key; None where no bound is worth a look.

        What is matched lies at most as far apart as the keys have unmatched letters: in the lookup key further to
        the end by its own, further to the front by those of ``key``.
        """
        size = len(key)
        if size not in self.bounds:
            self.bounds[size] = self._bounds(size)
        n, need, back, on = self.bounds[size]
        if not n or low == high:
            return None if low < high else np.zeros(0, np.int64)
        runs, places, owner = self.index(n)
        code, place, _ = grams([key], n)
        at = np.searchsorted(runs, code)
        known = at < len(runs)
        known[known] = runs[at[known]] == code[known]
        place = place[known]
        at = at[known] * self.width
        first = np.searchsorted(places, at + np.maximum(place - back.max(), 0))
        last = np.searchsorted(places, at + np.minimum(place + on.max(), self.width - 1), "right")
        many = last - first
        # The rows of the index from first to last, for all runs of the key at once.
        rows = np.arange(many.sum()) + np.repeat(first - np.append(0, np.cumsum(many)[:-1]), many)
        moved = places[rows] - np.repeat(at + place, many)
        met = owner[rows]
        sizes = self.sizes[met]
        shared = np.bincount(met[(moved >= -back[sizes]) & (moved <= on[sizes])], minlength=high)[low:high]
        return low + np.flatnonzero(shared >= need[self.sizes[low:high]])

    def candidates(self, key: str) -> tuple[np.ndarray, np.ndarray, int]:
        """(places, upper bounds) of the keys whose bound reaches the threshold, best first, and keys compared."""
        t, m = self.threshold, len(key)
        shortest, longest = partner_sizes(m, t)
        low = int(np.searchsorted(self.sizes, shortest, "left"))
        high = int(np.searchsorted(self.sizes, longest, "right"))
        places = self.alike(key, low, high)
        compared = slice(low, high) if places is None else places
        letters, pairs = profile([key])
        total = m + self.sizes[compared]
        kind = np.promote_types(self.letters.dtype, letters.dtype)
        shared = np.minimum(self.letters[compared], letters.astype(kind)).sum(1, dtype=np.int64)
        fine = np.flatnonzero(2 * shared >= (t - EPS) * total)
        places = low + fine if places is None else places[fine]
        n_compared, total, shared = len(total), total[fine], shared[fine]
        near = np.minimum(self.pairs[places], pairs.astype(kind)).sum(1, dtype=np.int64)
        bound = np.minimum(2 * shared / total, 2 * (near + 1 + total) / (3 * total))
        fine = bound >= t - EPS
        places, bound = places[fine], bound[fine]
        best_first = np.argsort(-bound, kind="stable")
        return places[best_first], bound[best_first], n_compared

    def best(self, key: str) -> tuple[tuple | None, np.ndarray]:
        """((score, order, match) or None, [keys compared, past the bounds, ratios computed])."""
        places, bounds, compared = self.candidates(key)
        masks: dict[str, int] = {}
        for i, ch in enumerate(key):
            masks[ch] = masks.get(ch, 0) | 1 << i
        best, scored, matcher = None, 0, SequenceMatcher(None)
        for place, bound in zip(places.tolist(), bounds.tolist()):
            if best is not None and bound < best[0] - EPS:
                break
            other, order = self.keys[place], self.order[place]
            most = 2 * common_subsequence(masks, len(key), other) / (len(key) + len(other))
            if most < self.threshold or (best is not None and (most, best[1]) <= (best[0], order)):
                continue
            matcher.set_seqs(key, other)
            score, scored = matcher.ratio(), scored + 1
            if score >= self.threshold and (
                best is None or score > best[0] or (score == best[0] and order < best[1])
            ):
                best = (score, order, other)
        return best, np.array([compared, len(places), scored], np.int64)
