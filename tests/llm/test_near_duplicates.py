"""MinHash, vectors, components and repeated bytes against brute force."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from paygrain.llm import embedding, minhash, suffixes
from paygrain.llm.common import components
from paygrain.llm.suffix_order import common_prefixes, suffix_order


def smallest_reachable(nodes, links):
    low = {n: n for n in nodes}

    def root(n):
        while low[n] != n:
            n = low[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        low[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(1000, 1100)] + [(5, i) for i in range(6, 60)] + [(70, 71), (71, 70), (80, 80)]
    links += [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(150)]
    got = components(spark.createDataFrame(links, "u long, v long")).collect()
    links = [p for p in links if p[0] != p[1]]
    want = smallest_reachable({x for p in links for x in p}, links)
    assert {r.node: r.component for r in got} == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def shingle_set(text, words):
    split = (text or "").encode().lower().split()
    if len(split) < words:
        return frozenset([tuple(split)] if split else [])
    return frozenset(tuple(split[i : i + words]) for i in range(len(split) - words + 1))


def brute_components(rows, words):
    sets = {i: shingle_set(t, words) for i, t in rows}
    links = []
    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= 80 * len(sets[i] | sets[j]):
                links.append((i, j))
    return {i: (len(sets[i]), c) for i, c in smallest_reachable(sets, links).items()}


def near_rows(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    passage, rows = [word() for _ in range(40)], []
    for base in range(8):
        words = [word() for _ in range(rng.randint(5, 60))]
        for _ in range(rng.randint(1, 6)):
            copy = list(words)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = word()
            rows.append(" ".join(copy))
    for _ in range(60):  # a passage that many share: similar, but less than the bound or just about it
        rows.append(" ".join(passage + [word() for _ in range(rng.randint(0, 30))]))
    rows += ["One  Two\tthree", "one two THREE", "single", "SINGLE", "", "  \n", "a b", "b a"]
    rng.shuffle(rows)
    return [(3 * i + 1, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("small_bucket", [32, 2])
@pytest.mark.parametrize("words", [2, 5])
def test_minhash_equals_all_pairs(docs_of, monkeypatch, words, small_bucket):
    monkeypatch.setattr(minhash, "SMALL_BUCKET", small_bucket)
    rows = near_rows() + [(1000, "long " * 30_000), (1001, "long " * 30_001)]
    got = minhash.near_duplicates(docs_of(rows), words=words).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows, words)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_minhash_edges(docs_of):
    rows = [(9, "a b c"), (9, "a b c"), (4, "a b c"), (9, "x y z"), (None, "a b c"), (5, None), (6, ""), (7, " ")]
    got = minhash.near_duplicates(docs_of(rows), words=2).collect()
    found = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), key=str)
    want = [(9, 2, 4, False)] * 2 + [(4, 2, 4, True), (9, 2, 9, True), (None, 2, None, True)]
    want += [(5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True)]
    assert found == sorted(want, key=str)
    assert minhash.near_duplicates(docs_of([]), words=2).count() == 0
    kept = minhash.without_near_duplicates(docs_of(rows), words=2)
    assert kept.columns == docs_of([]).columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [4, 5, 6, 7, 9, 9, 9, None]


def test_missed_share_follows_the_formula():
    signer = minhash.Signer(minhash.M, minhash.WIDTH)
    rng, missed = np.random.default_rng(1), 0
    for _ in range(400):
        x = rng.integers(0, 1 << 63, 90, np.uint64)
        a, b = np.unique(x[:80]), np.unique(np.concatenate([x[9:80], x[80:89]]))  # similarity 71 / 89
        la, ra = signer.vectors(a)
        lb, rb = signer.vectors(b)
        missed += not (any(p == q for p, q in zip(la, lb)) and any(p == q for p, q in zip(ra, rb)))
    assert missed <= 3


def test_vectors_equal_all_pairs(spark):
    rng, rows = np.random.default_rng(3), []
    for label in (1, 2, 7):
        for _ in range(6):
            base = rng.normal(size=16)
            for _ in range(int(rng.integers(1, 9))):
                near = base + rng.normal(size=16) * rng.choice([0.0, 0.05, 0.12, 0.3])
                rows.append((near * rng.choice([1.0, 2.5])).tolist() + [label])
    table = [(2 * i, r[:-1], r[-1]) for i, r in enumerate(rows)]
    odd = [(900, None, 1), (901, [0.0] * 16, 1), (902, [1.0, None] + [0.0] * 14, 1), (903, [math.nan] * 16, 1),
           (904, [math.inf] + [0.0] * 15, 1), (905, table[0][1], None), (907, [1.0, 2.0], 1), (908, [], 1),
           (909, [1e300] * 16, 9), (910, [1e-300] * 16, 9), (911, [-0.0, 1.0], 1), (912, [0.0, 1.0], 1)]
    df = spark.createDataFrame(table + odd, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding.near_vectors(df).collect()}
    links = [(909, 910), (911, 912)]
    for i, x, a in table:
        for j, y, b in table:
            x_, y_ = np.array(x), np.array(y)
            if i < j and a == b and x_ @ y_ / np.sqrt(x_ @ x_) / np.sqrt(y_ @ y_) >= 0.98:
                links.append((i, j))
    times = defaultdict(int)
    for p in links:
        for n in p:
            times[n] += 1
    low = smallest_reachable([r[0] for r in table + odd], links)
    assert got == {n: (times[n], c, n == c) for n, c in low.items()}


def test_vectors_edges(spark):
    schema = "vec_id long, embedding array<float>, label int"
    rows = [(1, [1.0, 0.5], 3), (1, [1.0, 0.5], 3), (2, [1.0, 0.5], 3), (None, [1.0, 0.5], 3)]
    got = embedding.near_vectors(spark.createDataFrame(rows, schema)).collect()
    found = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got), key=str)
    assert found == sorted([(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (None, 0, None, True)], key=str)
    assert embedding.near_vectors(spark.createDataFrame([], schema)).count() == 0


def test_two_stage_order_and_prefixes_equal_plain_sorting():
    rng = np.random.default_rng(0)
    for trial in range(150):
        n, letters, depth = int(rng.integers(1, 200)), int(rng.integers(1, 5)), int(rng.integers(1, 60))
        block = rng.integers(97, 97 + letters, n).astype(np.uint8)
        if trial % 3 == 0:
            block = np.tile(block[: max(1, n // 10)], 10)
        raw, order = block.tobytes(), suffix_order(block, depth)
        assert sorted(order.tolist()) == list(range(len(raw)))
        keys = [raw[i : i + depth] for i in order]
        assert keys == sorted(keys)
        common = common_prefixes(block, order, depth)
        for a, b, c in zip(keys, keys[1:], common[1:]):
            same = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert c == same


def brute_removed(rows):
    first, out = {}, []
    raws = [(i, (t or "").encode()) for i, t in rows]
    for i, raw in raws:
        for k in range(len(raw) - 49 if i is not None else 0):
            first[raw[k : k + 50]] = min(i, first.get(raw[k : k + 50], i))
    for i, raw in raws:
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - 49 if i is not None else 0):
            if first[raw[k : k + 50]] < i:
                gone[k : k + 50] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        left = bytes(np.frombuffer(raw, np.uint8)[~gone])
        out.append((i, len(raw), edges[::2].tolist(), edges[1::2].tolist(), hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot,batch", [(10_000, 4 << 20), (3, 5_000)])
def test_repeated_bytes_equal_brute_force(docs_of, monkeypatch, hot, batch):
    monkeypatch.setattr(suffixes, "HOT_LEAST", hot)
    monkeypatch.setattr(suffixes, "BATCH_BYTES", batch)
    rng = random.Random(7)
    parts = ["".join(rng.choice("ab é") for _ in range(rng.randint(30, 120))) for _ in range(10)]
    loose = lambda: "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(1, 80)))
    pick = lambda: rng.choice(parts) if rng.random() < 0.5 else loose()
    rows = [(i, "".join(pick() for _ in range(rng.randint(0, 7)))) for i in range(150)]
    rows += [(300, None), (301, ""), (None, rows[5][1]), (None, rows[5][1]), (302, rows[5][1]), (2, rows[5][1])]
    rows += [(5, rows[6][1]), (303, "a" * 500), (304, "a" * 700), (305, "ab" * 300), (306, "xab" * 300)]
    rows += [(307, "a" * 49), (308, "a" * 50), (309, "z" * 40_000)]
    got = suffixes.repeated_bytes(docs_of(rows), keep_bytes=True).collect()
    found = sorted(((r.doc_id, r.n_bytes, r.starts, r.ends, r.kept_sha256) for r in got), key=str)
    assert found == brute_removed(rows)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)


def test_short_strings_in_common_are_no_regions(docs_of, monkeypatch):
    """Texts of the same words of 20 bytes in other orders share anchors; regions are cut only where more may match."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(20)) for _ in range(400)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(30))) for i in range(100)]
    long_one = " ".join(words[:4])
    rows += [(200, rows[0][1] + long_one + rows[1][1]), (201, "zyx" * 30 + long_one)]
    seen, spread = [], suffixes.spread_regions

    def counted(found, *more):
        seen.extend((r.doc_id, len(r.places) // 4) for r in found.select("doc_id", "places").collect())
        return spread(found, *more)

    monkeypatch.setattr(suffixes, "spread_regions", counted)
    got = suffixes.repeated_bytes(docs_of(rows)).collect()
    found = sorted(((r.doc_id, r.n_bytes, r.starts, r.ends, r.kept_sha256) for r in got), key=str)
    assert found == brute_removed(rows)
    assert {0, 1, 200, 201} <= {i for i, _ in seen}
    places = sum(n for _, n in seen)
    assert places < sum(len(t) for _, t in rows) / 17 / 2  # anchors: about one in 17 bytes, nearly all of them shared


def test_contexts_of_equal_windows_are_equal():
    rng = np.random.default_rng(3)
    for trial in range(200):
        letters = rng.integers(97, 99 if trial % 2 else 120, 300).astype(np.uint8).tobytes()
        at = int(rng.integers(0, 250))
        window = letters[at : at + suffixes.WINDOW]
        other = b"#" * int(rng.integers(0, 40)) + window + b"#" * int(rng.integers(0, 40))
        a, b = ({x for x in zip(*suffixes.contexts(r, suffixes.anchors(r)[0]))} for r in (letters, other))
        low = min((h, i) for i, h in enumerate(suffixes.gram_hashes(window).tolist()))[1]  # the window's anchor
        here = {h for i, h in a if i == at + low}
        there = {h for i, h in b if i == other.index(window) + low}
        assert here & there


def test_repeated_bytes_of_an_empty_table(docs_of):
    assert suffixes.repeated_bytes(docs_of([])).count() == 0


def test_repeated_rows_have_one_equal_result_each(docs_of):
    shared = "this passage of more than fifty bytes stands in two documents. "
    rows = [(1, shared + "one"), *[(2, "two " + shared)] * 5, *[(3, "three, a text of its own that is as long as fifty bytes")] * 4]
    got = suffixes.repeated_bytes(docs_of(rows), keep_bytes=True).collect()
    found = sorted(((r.doc_id, r.n_bytes, r.starts, r.ends, r.kept_sha256) for r in got), key=str)
    assert found == brute_removed(rows) and len(found) == 10


def test_labels_far_apart_and_labels_of_text(spark):
    same = [1.0, 2.0, 3.0]
    rows = [(0, same, 1), (1, same, 1 + (1 << 32)), (2, same, 1), (3, [1.0, 2.0, 3.001], 1 + (1 << 32)), (4, same, None)]
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], "vec_id long, embedding array<double>, label long, node string, size int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding.near_vectors(df).collect()}
    assert got == {0: (1, 0), 2: (1, 0), 1: (1, 1), 3: (1, 1), 4: (0, 4)}
    text = df.withColumn("label", F.when(F.col("label") == 1, F.lit("one")).when(F.col("label") > 1, F.lit("two")))
    assert {r.vec_id: (r.n_links, r.component_id) for r in embedding.near_vectors(text).collect()} == got


def test_chain_of_near_copies_is_one_component(docs_of):
    """Each copy is near its neighbours only, so that no single member reaches them all."""
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(60):
        rows.append((i, " ".join(words)))
        words = [*words[:i * 6 % 390], f"n{i}a", f"n{i}b", f"n{i}c", *words[i * 6 % 390 + 3:]]
    rows += [(100 + i, " ".join(f"z{i}_{j}" for j in range(50))) for i in range(10)]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs_of(rows)).collect()}
    assert {got[i] for i in range(60)} == {0} and all(got[100 + i] == 100 + i for i in range(10))


def near_misses(n, seed=11):
    """Altered copies of one text, most of them almost but not quite near enough to each other."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(90)]
    rows = [(0, " ".join(base))]
    for i in range(1, n):
        words = list(base)
        for at in rng.sample(range(90), rng.randint(4, 7)):
            words[at] = f"x{i}_{at}"
        rows.append((i, " ".join(words)))
    return rows


def test_pairs_compared_do_not_grow_with_the_square_of_a_group(docs_of, monkeypatch):
    verify, compared = minhash.verify, []

    def counted(pairs, sets, percent):
        compared[-1] += pairs.select("u", "v").distinct().count()
        return verify(pairs, sets, percent)

    monkeypatch.setattr(minhash, "verify", counted)
    for n in (60, 240):
        compared.append(0)
        rows = near_misses(n)
        got = minhash.near_duplicates(docs_of(rows), words=2).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows, 2)
        assert compared[-1] <= 3 * n
    assert compared[1] <= 6 * compared[0]


def test_sketches_never_part_a_link(spark):
    rng, rows = np.random.default_rng(8), []
    for _ in range(400):
        n = int(rng.choice([1, 2, 9, 90, 900, 3000]))
        x = np.unique(rng.integers(0, 1 << 64, 2 * n, np.uint64))
        cut = int(n * rng.uniform(0, 0.3))
        a, b = x[:n], x[cut : n + cut]
        linked = minhash.confirmed(a.tobytes(), b.tobytes())
        rows.append((minhash.sketch_of(a), minhash.sketch_of(b), len(a), len(b), linked))
    df = spark.createDataFrame(rows, "a array<long>, b array<long>, na int, nb int, linked boolean")
    got = df.select("linked", "na", minhash.may_link("a", "b", "na", "nb", 80).alias("may")).collect()
    assert all(r.may for r in got if r.linked) and sum(r.linked for r in got) > 100
    apart = [r.may for r in got if not r.linked and r.na == 90]
    assert len(apart) > 20 and sum(apart) <= 0.2 * len(apart)
