"""A word-wise view of the library tokenizer: what lies between plain white space is encoded once.

The normaliser and the pre-tokenizer of the vocabulary drop white space and never look across it, so
the ids of a text are those of its words in order. Words come from a bounded table. A new one
that is letters followed by punctuation goes to the library's merges in those two parts, which is how the
vocabulary's pattern cuts it; any other goes through the whole tokenizer.
"""

from __future__ import annotations

import functools
import os
import re
from array import array

from paygrain.llm.byte_bpe import byte_of_char

# Words, and parts of words, that a worker remembers; an entry takes some 160 bytes (counts) or 200 (ids).
WORDS_KEPT, COUNTS_KEPT = 500_000, 150_000
# White space beyond blank, tab and line ends, on which Python and the library may differ.
ODD_SPACE = re.compile(
    "[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff]"
)
PLAIN_WORD = re.compile("[^ \t\r\n]+")
# Letters whose lower case and normal form are one letter each, then ASCII signs.
EASY_WORD = re.compile("([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([!-/:-@\\[-`{-~]*)")


class WordTable(dict):
    """``kept(ids)`` of a word, where the kept values of parts add up; remembers a bounded number."""

    def __init__(self, path: str, kept, most: int = WORDS_KEPT):
        from tokenizers import Tokenizer

        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.merge = self.tokenizer.model.tokenize
        self.stand_in = {b: c for c, b in byte_of_char().items()}
        self.kept, self.parts, self.most = kept, {}, most

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def part(self, piece: str):
        """The value of letters, or of signs: one piece of the vocabulary's pattern."""
        value = self.parts.get(piece)
        if value is None:
            name = piece
            if not piece.isascii():
                name = piece.encode("utf-8").decode("latin-1").translate(self.stand_in)
            value = self.kept([t.id for t in self.merge(name)])
            if len(self.parts) < self.most and len(piece) < 64:
                self.parts[piece] = value
        return value

    def __missing__(self, word: str):
        easy = EASY_WORD.fullmatch(word)
        if easy is None:
            value = self.kept(self.whole(word))
        else:
            letters, signs = easy.groups()
            value = self.part(letters.lower())
            if signs:
                value = value + self.part(signs)
        if len(self) < self.most and len(word) < 64:
            self[word] = value
        return value

    def of_text(self, text: str):
        """The kept value of each word of a text, in order."""
        words = PLAIN_WORD.findall(text) if ODD_SPACE.search(text) else text.split()
        return map(self.__getitem__, words)


def little_endian(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


@functools.lru_cache(maxsize=1)
def encoder(path: str) -> WordTable:
    """Words to their ids as little-endian 32-bit integers."""
    return WordTable(path, little_endian)


@functools.lru_cache(maxsize=1)
def counter(path: str) -> WordTable:
    """Words to their number of ids."""
    return WordTable(path, len, COUNTS_KEPT)
