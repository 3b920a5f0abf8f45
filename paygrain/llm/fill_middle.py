"""Fill-in-middle transformation: a text is cut at two ranks of its lines and its middle is moved to the end.

The lines of a text are the units of an indexable skip list: every link of a lane carries how many units
and how many code points it passes. A descent by accumulated units ends exactly at a rank and knows
the code point at which to cut, so that neither rank is searched for in the text itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from paygrain.llm.common import map_rows, whole_texts

SENTINELS = ("<P>", "<S>", "<M>")  # before the prefix, the suffix and the middle
FAN = 16  # links of a lane that one link of the next lane spans

CUT = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("n", LongType()),
        StructField("form", StringType()),
        StructField("prefix_chars", LongType()),
        StructField("middle_chars", LongType()),
        StructField("output", StringType()),
    ]
)


class SkipList:
    """Units in their order under express lanes; a link is (units, code points) that it passes."""

    def __init__(self, widths: Sequence[int]):
        units, chars = [1] * len(widths), list(widths)
        self.lanes = [(units, chars)]
        while len(units) > FAN:
            starts = range(0, len(units), FAN)
            units = [sum(units[i : i + FAN]) for i in starts]
            chars = [sum(chars[i : i + FAN]) for i in starts]
            self.lanes.append((units, chars))

    def __len__(self) -> int:
        return len(self.lanes[0][0])

    def offset(self, rank: int) -> int:
        """Code points of the first ``rank`` units."""
        passed = offset = at = 0
        for units, chars in reversed(self.lanes):
            at *= FAN  # the same place one lane below
            while at < len(units) and passed + units[at] <= rank:
                passed, offset, at = passed + units[at], offset + chars[at], at + 1
        return offset


def line_widths(text: str) -> list[int]:
    """Code points of every line, its line feed included; an unfinished last line counts."""
    *whole, rest = text.split("\n")
    return [len(line) + 1 for line in whole] + ([len(rest)] if rest else [])


def check_sentinels(sentinels: Sequence[str]) -> None:
    """Refuse marks that could not be told apart, or found, in an output."""
    if len(sentinels) != 3 or not all(sentinels):
        raise ValueError("three marks are needed, none of them empty")
    for i, a in enumerate(sentinels):
        for j, b in enumerate(sentinels):
            if i != j and a in b or any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b)))):
                raise ValueError(f"{a!r} and {b!r} overlap")


def transform(
    docs: DataFrame,
    seed: int = 7,
    percent: int = 100,
    spm_percent: int = 50,
    sentinels: Sequence[str] = SENTINELS,
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every whole text.

    ``n`` counts the lines; ``form`` is ``psm`` (prefix, suffix, middle), ``spm`` (suffix, prefix, middle) or
    ``plain``: texts that are empty, hold a mark or are not among the ``percent`` of ids that take part.
    Cuts and forms come from the SHA-256 of seed and doc_id, so they depend on nothing else; a null doc_id
    counts as an empty one, repeated rows are treated alike and give a row each. A null text is the empty text;
    other columns are left behind. A row is worked on where it lies, without a shuffle.
    """
    check_sentinels(sentinels)
    before, behind, last = sentinels
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), name), 256)
    numbers = [
        F.conv(F.substring("digest", 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}")
        for i in range(4)
    ]
    rows = whole_texts(docs).withColumn("digest", digest).select("doc_id", "text", *numbers)

    def make():
        def f(doc_id, text, h1, h2, h3, h4):
            lines = SkipList(line_widths(text))
            n = len(lines)
            if not text or any(s in text for s in sentinels) or h3 % 100 >= percent:
                return [(doc_id, n, "plain", None, None, text)]
            one, two = sorted((h1 % (n + 1), h2 % (n + 1)))
            a, b = lines.offset(one), lines.offset(two)
            prefix, middle, suffix = text[:a], text[a:b], text[b:]
            if h4 % 100 < spm_percent:
                form, parts = "spm", (behind, suffix, before, prefix, last, middle)
            else:
                form, parts = "psm", (before, prefix, behind, suffix, last, middle)
            return [(doc_id, n, form, len(prefix), len(middle), "".join(parts))]

        return f

    return map_rows(rows, make, CUT)


def restored(output: Column, form: Column, sentinels: Sequence[str] = SENTINELS) -> Column:
    """The text that :func:`transform` was given, from its output and form alone."""
    check_sentinels(sentinels)
    before, behind, last = sentinels

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        head = F.substring_index(output, second, 1)
        rest = F.substring(output, F.length(head) + len(second) + 1, F.length(output))
        mid = F.substring_index(rest, last, 1)
        end = F.substring(rest, F.length(mid) + len(last) + 1, F.length(rest))
        return F.substring(head, F.lit(len(first) + 1), F.length(head)), mid, end

    prefix, suffix, middle = parts(before, behind)
    suffix_2, prefix_2, middle_2 = parts(behind, before)
    return (
        F.when(form == "psm", F.concat(prefix, middle, suffix))
        .when(form == "spm", F.concat(prefix_2, middle_2, suffix_2))
        .otherwise(output)
    )
