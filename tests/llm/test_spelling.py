"""Spelling variants against all pairs of a small vocabulary."""

import random
import re
import zlib
from collections import Counter

import pytest

from paygrain.llm import spelling

WORDS = "word string, n long"
LONG = "".join(random.Random(4).choice("abcdé") for _ in range(9_000))


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_forms(words, factor):
    out = {}
    for w, n in words.items():
        near = [o for o in words if o != w and abs(len(o) - len(w)) < 2 and one_edit(w, o)]
        best = min(near, key=lambda o: (-words[o], o), default=None)
        form = best if best is not None and words[best] >= factor * n else None
        out[w] = [form, n, len(near), words.get(form)]
    for w in out:
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        out[w].append(root)
    return out


def forms(spark, words, **options):
    df = spark.createDataFrame(list(words.items()), WORDS)
    rows = spelling.spelling_forms(df, **options).collect()
    assert len(rows) == len(words)
    return {r.word: [r.form, r.n, r.n_near, r.form_n, r.root] for r in rows}


def vocabulary(seed, n, letters, least, most):
    rng = random.Random(seed)
    return {
        "".join(rng.choice(letters) for _ in range(rng.randint(least, most))): rng.choice([2, 2, 3, 30, 400, 9000])
        for _ in range(n)
    }


@pytest.mark.parametrize("deep", [2, 5, 32])
def test_forms_equal_brute_force(spark, deep):
    words = vocabulary(1, 300, "abÿ", 1, 9) | vocabulary(2, 40, "a", 1, 12) | vocabulary(3, 80, "xyz", 4, 6)
    assert forms(spark, words, deep=deep) == brute_forms(words, 10)


def test_forms_of_long_words(spark):
    words = {LONG: 5, LONG[:4000] + LONG[4001:]: 2, LONG[:-1]: 70, "é" + LONG: 3, LONG[1:]: 2, "b" * 33: 2, "b" * 32: 9}
    words |= {LONG[:31] + "q" + LONG[32:40]: 4, LONG[:40]: 400, LONG[:31]: 3, LONG[:32]: 60}
    assert forms(spark, words) == brute_forms(words, 10)


def test_way_to_the_root_and_ties(spark):
    words = {"aaaa": 1, "aaab": 10, "aabb": 100, "abbb": 1000, "bbbb": 10_000, "baaa": 10, "cccc": 1, "cccd": 10, "ccce": 10}
    got = forms(spark, words)
    assert got == brute_forms(words, 10)
    assert got["aaaa"][0] == "aaab" and got["aaaa"][4] == "bbbb" and got["cccc"][0] == "cccd"
    with pytest.raises(ValueError):
        spelling.spelling_forms(spark.createDataFrame([], WORDS), factor=1)


def test_words_of_documents(spark, docs_of):
    rng = random.Random(6)
    pieces = ["Variant", "variants", "ÀÉvariant", "VARIENT", "naïveté", "x×÷yÿÀÀÀ", " ", ".", "1", "\n", "_", "Ωmegaaaaa", "short"]
    rows = [(i, "".join(rng.choice(pieces) + rng.choice(["", " "]) for _ in range(rng.randint(0, 30)))) for i in range(200)]
    rows += [(3, rows[3][1]), (None, "variant variant"), (900, None), (901, ""), (902, "variant " * 20_000)]
    want = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            want[word] += 1
    want = {w: n for w, n in want.items() if len(w) >= 7 and n >= 2}
    got = spelling.count_words(docs_of(rows), spelt=spelling.planted_typo).collect()
    assert {r.word: r.n for r in got} == want and len(got) == len(want)
    grouped = spelling.variant_groups(docs_of(rows), spelt=spelling.planted_typo).collect()
    assert {r.word: [r.form, r.n, r.n_near, r.form_n, r.root] for r in grouped} == brute_forms(want, 10)


def test_tasks_hand_words_on(spark, docs_of, monkeypatch):
    rows = [(i, f"variant variante {'abcdefg' + chr(97 + i % 26)}") for i in range(60)]
    whole = {tuple(r) for r in spelling.count_words(docs_of(rows)).collect()}
    monkeypatch.setattr(spelling, "HELD", 1)
    assert {tuple(r) for r in spelling.count_words(docs_of(rows)).collect()} == whole and len(whole) == 28


def test_no_documents(docs_of):
    assert spelling.variant_groups(docs_of([])).count() == 0
    assert spelling.variant_groups(docs_of([(1, None), (None, "")])).count() == 0
