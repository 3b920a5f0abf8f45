import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from paygrain.functions import text
from paygrain.operators import similarity
from paygrain.operators.key_blocks import KeyBlock, common_subsequence

WORDS = ["senior", "junior", "data", "analyst", "clerk", "police", "officer", "ii", "of", "parks", "é"]


def keys(rng, n):
    return sorted({"_".join(rng.choices(WORDS, k=rng.randint(1, 5))) for _ in range(n)})


def brute(left, right, threshold):
    out = {}
    for a in left:
        best, match = 0.0, None
        for b in right:  # in the order of ord
            score = SequenceMatcher(None, a, b).ratio() if a and b else 0.0
            if score > best:
                best, match = score, b
        if match is not None and best >= threshold:
            out[a] = (match, best)
    return out


def run(spark, left, right, threshold):
    l = spark.createDataFrame([(k,) for k in left], "key string")
    r = spark.createDataFrame([(k, i) for i, k in enumerate(right)], "key string, ord int")
    rows = similarity.best_fuzzy_match(l, r, threshold, least_pairs=0).collect()
    found = {x.key: (x.match, x.score) for x in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("threshold", [0.85, 0.7])
def test_best_match_equals_brute_force(spark, threshold):
    rng = random.Random(int(threshold * 100))
    left, right = keys(rng, 250), keys(rng, 120)
    rng.shuffle(right)
    # Mutated copies give scores close to the threshold.
    left += [k[: len(k) // 2] + rng.choice("xyz") + k[len(k) // 2 + 1 :] for k in right]
    left = sorted(set(left))
    expected = brute(left, right, threshold)
    assert expected
    assert run(spark, left, right, threshold) == expected


def test_edges(spark):
    long = "".join(random.Random(1).choices("abcdefghij_", k=230))
    near = long[:100] + "zz" + long[100:]
    left = ["", "abcd", "tide", "diet", long, near, "a"]
    right = ["", "abce", "abcf", "diet", "tide", long, "b"]
    for threshold in (0.7, 0.5):
        assert run(spark, left, right, threshold) == brute(left, right, threshold)


def test_score_exactly_at_threshold(spark):
    # 2 * 17 / 40 = 0.85
    a, b = "a" * 3 + "bcdefghijklmnopqr", "a" * 3 + "bcdefghijklmno" + "xyz"
    assert SequenceMatcher(None, a, b).ratio() == 0.85
    assert run(spark, [a], [b], 0.85) == {a: (b, 0.85)}


def test_sequence_ratio_argument_order(spark):
    pairs = [("tide", "diet"), ("diet", "tide"), ("", ""), (None, "a")]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    got = [r[1] for r in df.select("i", similarity.sequence_ratio("a", "b")).orderBy("i").collect()]
    assert got == [0.25, 0.5, 1.0, None]


@pytest.mark.parametrize("coef", [0.35, 0.425, 0.85 / 1.85])
def test_overlap_pairs_is_lossless(spark, coef):
    rng = random.Random(7)
    left, right = keys(rng, 120), keys(rng, 120)

    def tokens(values):
        df = spark.createDataFrame([(v[0], v) for v in values], "block string, key string")
        return df.withColumn("tokens", text.trigram_tokens(F.regexp_replace("key", "_", " ")))

    a, b = tokens(left), tokens(right)
    sets = {r.key: set(r.tokens) for r in a.unionByName(b).collect()}
    expected = {
        (x, y, len(sets[x] & sets[y]))
        for x in left
        for y in right
        if x[0] == y[0] and len(sets[x] & sets[y]) >= coef * (len(sets[x]) + len(sets[y])) - 1e-9
    }
    rows = similarity.overlap_pairs(a, b, coef, ["block"]).collect()
    assert len(rows) == len(expected)
    assert {(r.left_key, r.right_key, r.shared) for r in rows} == expected


def test_hot_tokens_are_cut_into_parts(spark, monkeypatch):
    # One token stands in 90 % of the sets, which have nothing rarer.
    rows = [(i, ["hot"] if i % 10 else [f"a{i // 20}", f"b{i // 20}"]) for i in range(2000)]
    make = lambda part: spark.createDataFrame(
        [("x", f"k{i:04d}", t) for i, t in rows if i // 10 % 2 == part], "block string, key string, tokens array<string>"
    )
    counts = {}
    for limit in (10**9, 50):
        monkeypatch.setattr(similarity, "HOT_ROWS", limit)
        a, b = similarity._encoded(make(0), make(1), ["block"])
        a = similarity._prefixed(a, "left", 0.4, "explode(sequence({own} - 1, {own} + 1))", ["block"])
        b = similarity._prefixed(b, "right", 0.4, "{own}", ["block"])
        keys = ["block", "size_class", "token", "left_part", "right_part"]
        both = a.groupBy(*keys).agg(F.count("*").alias("m")).join(b.groupBy(*keys).agg(F.count("*").alias("n")), keys)
        tasks = both.groupBy(F.pmod(F.hash(*keys), F.lit(24))).agg(F.sum(F.col("m") * F.col("n")).alias("pairs"))
        counts[limit] = sorted(r.pairs for r in tasks.collect())
    assert counts[10**9][-1] > 4 * counts[10**9][len(counts[10**9]) // 2]
    assert len(counts[50]) >= 20 and counts[50][-1] <= 4 * counts[50][len(counts[50]) // 2]
    assert sum(counts[50]) == sum(counts[10**9])
    found = {}
    for limit in (10**9, 7):
        monkeypatch.setattr(similarity, "HOT_ROWS", limit)
        pairs = similarity.overlap_pairs(make(0), make(1), 0.4, ["block"])
        found[limit] = pairs.agg(F.count("*"), F.sum(F.xxhash64("left_key", "right_key") % 1000)).first()
    assert found[7] == found[10**9] and found[7][0] > 100_000


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_plan_does_not_grow_with_the_lookup(spark, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK_KEYS", 40)
    plans = []
    for n in (30, 120):  # one block of the lookup, and three
        l = spark.createDataFrame([("abcdefgh",), ("abc",)], "key string")
        rows = [(f"key_{i:04d}", i) for i in range(n)]
        scored = similarity.scored_keys(l, spark.createDataFrame(rows, "key string, ord int"), 0.85)
        r = spark.createDataFrame(rows, "key string, ord int")
        blocks = similarity._blocks(l, r, 0.85, similarity.key_lengths(l, r), 8)[1]
        assert blocks.select("chunk").distinct().count() == (1 if n == 30 else 3)
        plans.append([line.strip(" :+-").split("#")[0].split(" ")[0] for line in plan_of(scored).splitlines()])
        text = plan_of(scored)
        assert text.count("FlatMapCoGroupsInPandas") == 1 and "Cartesian" not in text
    assert plans[0] == plans[1]


def test_blocks_and_shares_give_one_best_partner(spark, monkeypatch):
    # All candidates have the same letters; the best ones lie in different blocks and tie.
    monkeypatch.setattr(similarity, "BLOCK_KEYS", 70)
    monkeypatch.setattr(similarity, "SHARE_KEYS", 1)
    rng = random.Random(4)
    hot = "abcdefghijklmnop"
    right = sorted({"".join(rng.sample(hot, len(hot))) for _ in range(400)} - {hot})
    assert run(spark, [hot, hot[::-1]], right, 0.1) == brute([hot, hot[::-1]], right, 0.1)
    monkeypatch.setattr(similarity, "BLOCK_CHARS", 64)
    assert run(spark, [hot], right[:60], 0.5) == brute([hot], right[:60], 0.5)


def test_every_key_meets_every_block_of_its_lengths_once(spark, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK_KEYS", 7)
    monkeypatch.setattr(similarity, "SHARE_KEYS", 5)
    rng = random.Random(8)
    left, right = (sorted({"x" * rng.randint(1, 60) + str(rng.random())[2:5] for _ in range(90)}) for _ in range(2))
    l = spark.createDataFrame([(k,) for k in left], "key string")
    r = spark.createDataFrame([(k, k) for k in right], "key string, ord string")
    for threshold in (0.95, 0.7, 0.3):
        mine, lookup = similarity._blocks(l, r, threshold, similarity.key_lengths(l, r), 8)
        met = mine.join(lookup, ["class", "chunk", "share"]).select("key", "match").collect()
        assert len(met) == len(set(met))
        near = {(a, b) for a in left for b in right if 2 * min(len(a), len(b)) >= threshold * (len(a) + len(b))}
        assert near <= {tuple(x) for x in met}
        sizes = lookup.groupBy("class", "chunk", "share").count()
        assert sizes.agg(F.max("count")).first()[0] <= 20


def word_made(rng, n):
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", [8, 2, 3, 4, 12, 2, 2, 6, 7, 1, 1, 4, 2, 7, 8, 2, 1, 6, 6, 9, 3, 1, 2, 1, 2, 1], k=rng.randint(3, 9))) for _ in range(400)]
    return sorted({"_".join(rng.choices(words, k=rng.randint(2, 5))) for _ in range(n)})


def compared(results):
    """Pairs compared, past the bounds, and scored, of all tiers."""
    sums = [x.agg(F.sum("compared"), F.sum("bounded"), F.sum("scored")).first() for x in results]
    return [sum(x[i] or 0 for x in sums) for i in range(3)]


def frames(spark, left, right):
    l = spark.createDataFrame([(k,) for k in left], "key string")
    return l, spark.createDataFrame([(k, k) for k in right], "key string, ord string")


@pytest.mark.parametrize("threshold,share,scored", [(0.85, 0.002, 0.0005), (0.7, 1.0, 0.005)])
def test_few_pairs_are_compared_and_the_share_does_not_grow(spark, threshold, share, scored):
    shares = []
    for n in (500, 2000):
        rng = random.Random(n)
        left, right = word_made(rng, n), word_made(rng, n)
        sums = compared([similarity.scored_keys(*frames(spark, left, right), threshold)])
        shares.append([x / (len(left) * len(right)) for x in sums])
    assert shares[1][0] <= share and shares[1][2] <= scored
    assert shares[1][0] <= 1.2 * shares[0][0] + 1e-4


def titles(rng, n):
    """Titles of words by Zipf's law, over a vocabulary that grows with the square root of the text."""
    size = int(12 * n**0.5)
    vocabulary = ["".join(rng.choices("etaoinshrdlucmfwypvbgk", k=rng.randint(3, 9))) for _ in range(size)]
    weights, out = [1 / (i + 1) for i in range(size)], set()
    while len(out) < n:
        out.add("_".join(rng.choices(vocabulary, weights, k=rng.randint(2, 5))))
    out = sorted(out)
    rng.shuffle(out)
    return out


def test_comparisons_of_a_key_grow_slower_than_the_lookup(spark):
    """Keys with a close partner are closed early; others meet a small share of the lookup."""
    per_key, share = [], []
    for n in (2000, 8000):
        rng = random.Random(n)
        words = titles(rng, n + 300)
        right = words[300:]
        typos = [k[:i] + "x" + k[i + 1 :] for k in rng.sample(right, 400) if len(k) > 20 for i in [rng.randrange(len(k))]]
        results = similarity.match_in_tiers(*frames(spark, typos, right), 0.85)
        assert results[0].where("key IS NOT NULL").select("key").distinct().count() == len(set(typos))
        per_key.append(compared(results)[0] / len(typos))
        results = similarity.match_in_tiers(*frames(spark, words[:300], right), 0.85)
        share.append(compared(results)[0] / 300 / n)
    assert per_key[1] < 2 * per_key[0]
    assert max(share) < 0.006


def test_tiers_compare_less_than_the_threshold_alone(spark):
    rng = random.Random(12)
    right = titles(rng, 1500)
    typos = [k[:i] + "x" + k[i + 1 :] for k in right[:400] if (i := rng.randrange(len(k))) >= 0]
    left = sorted(set(typos) - set(right)) + ["qqqq_zzzzzzzz_jjjj", "zq"]
    l, r = frames(spark, left, right)
    tiered, flat = (similarity.match_in_tiers(l, r, 0.7, tiers) for tiers in (similarity.TIERS, ()))
    assert len(tiered) == 3 and len(flat) == 1
    assert compared(tiered)[0] < 0.5 * compared(flat)[0]
    a, b = ({tuple(x) for x in similarity.best_fuzzy_match(l, r, 0.7, t, 0).collect()} for t in ((), similarity.TIERS))
    assert a == b and len(a) >= 390
    closed = {x.key for x in tiered[0].where("key IS NOT NULL").collect()}
    assert closed and not closed & {x.key for x in tiered[1].where("key IS NOT NULL").collect()}


def test_bounds_lose_nothing(spark):
    rng = random.Random(9)
    right = keys(rng, 60) + ["a" * 300, "ab" * 150, "x"]
    for threshold in (0.9, 0.75, 0.5, 0.2):
        block = KeyBlock(right, right, threshold)
        for key in [*keys(rng, 60), "a" * 299, "ba" * 150, "x", "xy"]:
            places, bounds, _ = block.candidates(key)
            found = {block.keys[p]: b for p, b in zip(places.tolist(), bounds.tolist())}
            for other in right:
                ratio = SequenceMatcher(None, key, other).ratio()
                if ratio >= threshold:
                    assert found[other] >= ratio - 1e-9


def test_index_loses_nothing():
    rng = random.Random(21)
    for _ in range(60):
        base = "".join(rng.choices("abcde_é", k=rng.randint(1, 40)))
        right = {base}
        while len(right) < 40:  # copies with moved, dropped, put in and doubled parts
            k = rng.choice(sorted(right))
            i, j = sorted(rng.choices(range(len(k) + 1), k=2))
            right.add(rng.choice([k[:i] + k[j:], k[i:] + k[:i], k[:i] + "xy" + k[i:], k[:j] + k[i:j][:6] + k[j:], k[::-1]])[:60] or "q")
        right = sorted(right)
        for threshold in (0.95, 0.85, 0.7):
            block = KeyBlock(right, right, threshold)
            for key in rng.sample(right, 6):
                key = key[1:] + rng.choice("ab") if rng.random() < 0.5 else key
                found = {block.keys[p] for p in block.candidates(key)[0].tolist()}
                assert {b for b in right if SequenceMatcher(None, key, b).ratio() >= threshold and key} <= found


def test_common_subsequence_equals_the_table():
    rng = random.Random(3)
    for _ in range(200):
        a, b = ("".join(rng.choices("abcé", k=rng.randint(1, 90))) for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            old, row = row, [0]
            for j, y in enumerate(b, 1):
                row.append(old[j - 1] + 1 if x == y else max(old[j], row[j - 1]))
        masks = {}
        for i, ch in enumerate(a):
            masks[ch] = masks.get(ch, 0) | 1 << i
        assert common_subsequence(masks, len(a), b) == row[-1]


def test_threshold_limits(spark):
    left, right = ["abcd", "abce"], ["abcd", "zzzz"]
    assert run(spark, left, right, 1.0) == {"abcd": ("abcd", 1.0)}
    for bad in (0, -0.5):
        with pytest.raises(ValueError):
            run(spark, left, right, bad)


def test_attach_keeps_every_row(spark):
    df = spark.createDataFrame([(1, "abcd"), (2, "abcd"), (3, None), (4, ""), (5, "zzz")], "i int, k string")
    lookup = spark.createDataFrame([("abcd", 0, 5.0), ("q", 1, 6.0)], "key string, ord int, v double")
    rows = similarity.attach_best_match(df, F.col("k"), lookup, 0.85, "t").orderBy("i").collect()
    assert [(r.i, r.match, r.score, r.v) for r in rows] == [
        (1, "abcd", 1.0, 5.0),
        (2, "abcd", 1.0, 5.0),
        (3, None, None, None),
        (4, None, None, None),
        (5, None, None, None),
    ]
