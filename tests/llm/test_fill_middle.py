"""The skip list and the forms against plain slicing of lists of lines."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from paygrain.llm import fill_middle

PARTS = ["a", "bc ", "é", "漢🙂", "\n", "\n\n", "\r\n", "<", ">", "P", "<P", "S>", "\x85", " ", ""]


def brute(doc_id, text, seed=7, percent=100, spm=50, marks=("<P>", "<S>", "<M>")):
    text = text or ""
    p, s, m = marks
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(x in text for x in marks) or h[2] % 100 >= percent:
        return n, "plain", None, None, text
    before, middle, after = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h[3] % 100 < spm:
        return n, "spm", len(before), len(middle), s + after + p + before + m + middle
    return n, "psm", len(before), len(middle), p + before + s + after + m + middle


def rows_of(seed=3, n=250):
    rng = random.Random(seed)
    rows = [(i, "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60)))) for i in range(n)]
    rows += [(n + i, t) for i, t in enumerate([None, "", "\n", "x", "a<P>b", "<M>", "<S", "line\n" * 30_000, "x" * 100_000])]
    return rows + [(None, "a\nb\nc"), (None, "a\nb\nc"), (5, rows[5][1])]


def test_offsets_of_all_ranks():
    rng = random.Random(1)
    for size in (0, 1, 15, 16, 17, 256, 257, 5000):
        widths = [rng.randint(1, 50) for _ in range(size)]
        skips = fill_middle.SkipList(widths)
        assert len(skips) == size and all(sum(u) == size and sum(c) == sum(widths) for u, c in skips.lanes)
        at = 0
        for rank in range(size + 1):
            assert skips.offset(rank) == at
            at += widths[rank] if rank < size else 0


@pytest.mark.parametrize(
    "options", [{}, {"seed": 1, "percent": 60, "spm": 20}, {"marks": ("[pre]", "[suf]", "[mid]"), "spm": 100}]
)
def test_forms_and_texts_back(docs_of, options):
    marks = options.get("marks", fill_middle.SENTINELS)
    rows = rows_of()
    cut = fill_middle.transform(
        docs_of(rows), options.get("seed", 7), options.get("percent", 100), options.get("spm", 50), marks
    )
    got = cut.withColumn("back", fill_middle.restored(F.col("output"), F.col("form"), marks)).collect()
    want = sorted(((i, *brute(i, t, **options), t or "") for i, t in rows), key=str)
    assert sorted((tuple(r) for r in got), key=str) == want
    assert {r.form for r in got} >= {"plain", "spm"}


def test_marks_that_overlap():
    for marks in (("<P>", "<S>", ""), ("a", "b", "ab"), ("xy", "yz", "q"), ("aba", "c", "d"), ("a", "a", "b")):
        with pytest.raises(ValueError):
            fill_middle.check_sentinels(marks)


def test_no_documents(docs_of):
    assert fill_middle.transform(docs_of([])).count() == 0
