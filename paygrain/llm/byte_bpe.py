"""Byte-level BPE encoding and decoding.

The encoder takes the longest vocabulary match at a position (all matches of a piece come out
of one Aho-Corasick pass), accepts it only if it is compatible with the token before it, and steps back
to a shorter match otherwise. Two tokens are compatible if merging their joined bytes gives just
these two tokens; a sequence whose neighbours are all compatible is the one that the merge list
gives. Every position is given up at most once, so the time is linear in the text. The decoder looks up the
bytes of an id between two entries of an offset table.
"""

from __future__ import annotations

import functools
import json
from array import array

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from paygrain.llm.common import map_rows, whole_texts

# Fixed value: the published pattern that cuts a text into pieces before the merges.
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
PIECES_KEPT = 400_000

ENCODED = StructType([StructField("doc_id", LongType()), StructField("ids", BinaryType())])
DECODED = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("ids", BinaryType()),
        StructField("decoded", StringType()),
    ]
)

CHECKED = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("n_tokens", LongType()),
        StructField("ids", BinaryType()),
        StructField("intact", BooleanType()),
    ]
)


def byte_of_char() -> dict[str, int]:
    """The printable stand-in characters of byte-level vocabularies, back to bytes."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    moved = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


class Pieces(dict):
    """Ids of a piece as little-endian bytes; remembers a bounded number of pieces."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        ids = array("I", self.encode(piece.encode("utf-8"))).tobytes()
        if len(self) < PIECES_KEPT and len(piece) < 64:
            self[piece] = ids
        return ids


class ByteBpe:
    """One vocabulary file, read once by each worker."""

    def __init__(self, path: str):
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = byte_of_char()
        vocab = spec["model"]["vocab"]
        raw = {i: bytes(to_byte[c] for c in token) for token, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        raw |= {i: content.encode("utf-8") for content, i in self.special.items()}
        self.lengths = [0] * (max(raw) + 1)
        for i, b in raw.items():
            self.lengths[i] = len(b)
        # Offset table: the bytes of id i lie in blob[offsets[i]:offsets[i + 1]].
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)]).astype(np.int64)
        self.blob = np.frombuffer(b"".join(raw.get(i, b"") for i in range(len(self.lengths))), np.uint8)

        self.merged, self.parts = {}, {}
        for merge in spec["model"]["merges"]:
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b, c = vocab[left], vocab[right], vocab[left + right]
            self.merged.setdefault((a, b), c)
            self.parts.setdefault(c, (a, b))
        self.automaton = ahocorasick.Automaton()
        by_bytes = {raw[i]: i for i in vocab.values()}
        for b, i in by_bytes.items():
            self.automaton.add_word(b.decode("latin-1"), (i, len(b)))
        self.automaton.make_automaton()
        self.shorter = {}
        for b, i in by_bytes.items():
            ends = (by_bytes.get(b[:k]) for k in range(len(b) - 1, 0, -1))
            self.shorter[i] = next((x for x in ends if x is not None), None)
        self.compatible: dict[tuple[int, int], bool] = {}
        self.pattern = regex.compile(PIECES)
        self.any_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.pieces = Pieces(self.encode_piece)

    def fits(self, a: int, b: int) -> bool:
        """Whether merging the bytes of a and b together leaves exactly a and b.

        Undoes the merges next to the border, latest first, and looks whether a merge across the
        border would have come before the one undone.
        """
        key = (a, b)
        known = self.compatible.get(key)
        if known is not None:
            return known
        before, fine = 1 << 60, None
        while fine is None:
            across = self.merged.get((a, b))
            if across is not None and across < before:
                fine = False
            elif a > b and a in self.parts:
                before, a = a, self.parts[a][1]
            elif b in self.parts and (b >= a or a not in self.parts):
                before, b = b + 1, self.parts[b][0]
            elif a in self.parts:
                before, a = a, self.parts[a][1]
            else:
                fine = True
        if len(self.compatible) < 1_000_000:
            self.compatible[key] = fine
        return fine

    def encode_piece(self, piece: bytes) -> list[int]:
        longest = [0] * len(piece)
        for end, (token, length) in self.automaton.iter(piece.decode("latin-1")):
            longest[end - length + 1] = token  # ends come in rising order
        usable, ids, at = bytearray(b"\x01" * (len(piece) + 1)), [], 0
        lengths, shorter = self.lengths, self.shorter
        token = longest[0] if piece else None
        while token is not None:
            end = at + lengths[token]
            if usable[end] and (not ids or self.fits(ids[-1], token)):
                ids.append(token)
                at = end
                token = longest[at] if at < len(piece) else None
                continue
            token = shorter[token]
            while token is None:  # nothing fits here: give the position up and step back
                usable[at] = 0
                token = ids.pop()
                at -= lengths[token]
                token = shorter[token]
        return ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        get, find = self.pieces.__getitem__, self.pattern.findall
        if not any(s in text for s in self.special):
            return b"".join(map(get, find(text)))
        out = []
        for part in self.any_special.split(text):
            if part in self.special:
                out.append(array("I", [self.special[part]]).tobytes())
            else:
                out.extend(map(get, find(part)))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Bytes that are no UTF-8 become U+FFFD; an id outside of the vocabulary has no bytes."""
        tokens = np.frombuffer(ids, "<u4").astype(np.int64)
        tokens = tokens[tokens < len(self.lengths)]
        starts = self.offsets[tokens]
        lengths = self.offsets[tokens + 1] - starts
        shift = starts - (np.cumsum(lengths) - lengths)
        places = np.repeat(shift, lengths)
        places += np.arange(places.size, dtype=np.int64)
        return self.blob[places].tobytes().decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def load(path: str) -> ByteBpe:
    return ByteBpe(path)


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, ids): the ids of each whole text, as little-endian unsigned 32-bit integers.

    ``vocabulary`` is the path of a byte-level tokenizer file that every executor has. A null or
    empty text has no ids; repeated rows and null doc_ids give a row each; no special
    token is added, but its string inside a text is one token. Only doc_id and text are read, so
    other columns cannot clash. No shuffle: any lost task is simply run again.
    """

    def make():
        bpe = load(vocabulary)
        return lambda doc_id, text: [(doc_id, bpe.encode(text))]

    return map_rows(whole_texts(docs), make, ENCODED)


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, ids, decoded): the text of each id sequence; null ids decode to the empty text."""

    def make():
        bpe = load(vocabulary)
        return lambda doc_id, ids: [(doc_id, ids or b"", bpe.decode(ids or b""))]

    return map_rows(encoded.select("doc_id", "ids"), make, DECODED)


def round_trip_digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded text of every document."""
    decoded = decode(encode(docs, vocabulary), vocabulary)
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def encode_checked(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_tokens, ids, intact): ids as :func:`encode` gives them, and whether they decode to the text."""

    def make():
        bpe = load(vocabulary)

        def f(doc_id, text):
            ids = bpe.encode(text)
            return [(doc_id, len(ids) // 4, ids, bpe.decode(ids) == text)]

        return f

    return map_rows(whole_texts(docs), make, CHECKED)
