"""The quality classifier, the language model, decontamination and the pipeline."""

import random
import re
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest

import corpus_pipeline
from paygrain.llm import decontaminate, hmm, quality


def words_of(rng, n, letters="abcdefgh"):
    return ["".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n)]


def fold(i):
    return zlib.crc32(str(i).encode()) % 5


def labelled(n=300, seed=2):
    rng, rows, labels = random.Random(seed), [], []
    for i in range(n):
        good = rng.random() < 0.7
        words = words_of(rng, rng.randint(20, 80))
        rows.append((i, " ".join(words) + "." if good else "!! ".join(w.upper() for w in words)))
        labels.append((i, int(good)))
    return rows, labels


def test_classifier_on_held_out_rows(spark, docs_of):
    rows, labels = labelled()
    marks = spark.createDataFrame(labels + [(5000, 1), (3, None), (None, 1)], "doc_id long, quality int")
    odd = [(900, None), (901, ""), (None, rows[0][1]), (902, "word " * 30_000), (7, rows[7][1])]
    got = quality.quality_scores(docs_of(rows + odd), marks).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (r.doc_id is not None and fold(r.doc_id) == 0) for r in got)
    truth = dict(labels)
    held = [(r.score >= 0.3) == truth[r.doc_id] for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 30 and np.mean(held) > 0.95
    empty = {r.score for r in got if r.doc_id in (900, 901)}
    assert len(empty) == 1


def test_labels_of_the_held_out_fold_do_not_matter(spark, docs_of):
    rows, labels = labelled(120)
    schema = "doc_id long, quality int"
    turned = [(i, 1 - q if fold(i) == 0 else q) for i, q in labels]
    a, b = (
        {r.doc_id: r.score for r in quality.quality_scores(docs_of(rows), spark.createDataFrame(x, schema)).collect()}
        for x in (labels, turned)
    )
    assert a == pytest.approx(b, abs=1e-9)


def test_classifier_without_labels_or_rows(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in quality.quality_scores(docs_of([(1, "a b")]), none).collect()] == [0.5]
    assert quality.without_bad(docs_of([(1, "a b"), (2, None)]), none).count() == 2
    assert quality.quality_scores(docs_of([]), none).count() == 0


def test_isotonic_is_rising_and_keeps_the_sums():
    rng = np.random.default_rng(1)
    weight = rng.integers(1, 9, 50).astype(float)
    positive = rng.integers(0, 9, 50) % (weight + 1)
    levels, chances = quality.isotonic(np.arange(50.0), weight, positive)
    assert (np.diff(chances) > 0).all() and (np.diff(levels) > 0).all()


def base_scores(rows):
    tokens = [
        (i, re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in t or "")) + [None])
        for i, t in rows
    ]
    train = [w for i, words in tokens if i is None or fold(i) != 1 for w in words]
    times, n = Counter(train), len(train)
    whole = n + 0.5 * (len(times) + 1)
    return [
        (
            i, i is not None and fold(i) == 1, len(words), sum(times[w] > 0 for w in words), n,
            round(sum(np.log10((times[w] + 0.5) / whole) for w in words), 6),
        )
        for i, words in tokens
    ]


@pytest.mark.parametrize("head", [hmm.HEAD_WORDS, 40, 0])
def test_language_model_counts_and_base_scores(docs_of, monkeypatch, head):
    rng = random.Random(5)
    rows = [(i, " ".join(words_of(rng, rng.randint(0, 40), "abc")) + "\x0bÉnd\x1f") for i in range(60)]
    rows += [(70, None), (71, ""), (72, "\x1c A\tb"), (None, "no id"), (3, rows[3][1]), (80, "w " * 9_000)]
    table = hmm.word_table
    monkeypatch.setattr(hmm, "word_table", lambda counts, ends: table(counts, ends, head))
    got = hmm.score_documents(docs_of(rows), iterations=2).collect()
    found = [
        (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got
    ]
    assert sorted(found, key=str) == sorted(base_scores(rows), key=str)
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)


def test_language_model_edges(docs_of):
    assert hmm.score_documents(docs_of([])).count() == 0
    only_held_out = next(i for i in range(100) if fold(i) == 1)
    (r,) = hmm.score_documents(docs_of([(only_held_out, "a b")]), iterations=1).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (3, 0, 0) and np.isfinite(r.score)


@pytest.mark.parametrize("head", [hmm.HEAD_WORDS, 300, 0])
def test_language_model_learns_words_beyond_the_own_symbols(docs_of, monkeypatch, head):
    rng = random.Random(13)
    common = [f"c{i:03}" for i in range(200)]  # take the own symbols
    topics = [[f"t{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}{chr(97 + t)}x" for i in range(60)] for t in range(2)]
    rows = []
    for i in range(400):
        words = [w for _ in range(12) for w in (rng.choice(topics[i % 2]), rng.choice(common), rng.choice(topics[i % 2]))]
        rows.append((i, " ".join(words + common)))
    table = hmm.word_table
    monkeypatch.setattr(hmm, "word_table", lambda counts, ends: table(counts, ends, head))
    got = hmm.score_documents(docs_of(rows)).collect()
    held = [r for r in got if r.held_out]
    with_words = sum(r.score for r in held)
    assert len(held) > 40 and with_words > sum(r.base_score for r in held)
    # The topics share symbols, so that symbols alone cannot tell them.
    if head:
        few = 200  # only the own symbols are known as words until the last iteration
        monkeypatch.setattr(hmm, "word_table", lambda counts, ends: table(counts, ends, few))
        assert with_words > sum(r.score for r in hmm.score_documents(docs_of(rows)).collect() if r.held_out)


def test_shuffles_of_words_are_dropped_before_texts_are_shuffled(spark, docs_of, monkeypatch):
    store, table, stored = hmm.materialize, hmm.word_table, {}

    def noted(df, name):
        stored[name] = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false")
        return store(df, name)

    monkeypatch.setattr(hmm, "materialize", noted)
    monkeypatch.setattr(hmm, "word_table", lambda counts, ends: table(counts, ends, 3))
    rows = [(i, f"a b a c word{i} word{i // 2}") for i in range(20)]
    assert hmm.score_documents(docs_of(rows), iterations=1).count() == 20
    assert [stored.get(name) for name in ("hmm-words", "hmm-ratios", "hmm-rare")] == ["true"] * 3


def test_tables_that_nothing_reads_again_are_emptied(spark, docs_of, monkeypatch):
    store, table, folders = hmm.materialize, hmm.word_table, {}

    def noted(df, name):
        stored = store(df, name)
        folders[name] = stored.inputFiles()[0].rpartition("/")[0]
        return stored

    monkeypatch.setattr(hmm, "materialize", noted)
    monkeypatch.setattr(hmm, "word_table", lambda counts, ends: table(counts, ends, 3))
    scored = hmm.score_documents(docs_of([(i, f"a b a c word{i} word{i // 2}") for i in range(20)]), iterations=2)
    rows = {name: spark.read.parquet(folder).count() for name, folder in folders.items()}
    assert rows == {"hmm-words": 0, "hmm-coded": 20, "hmm-gathered": 0, "hmm-ratios": 0, "hmm-rare": 20}
    assert scored.count() == 20 and scored.where("isnan(score)").isEmpty()


def test_words_are_parted_lower_cased_and_told_apart():
    texts = ["", " a  B\x0bb ", "\x1c A\tb\x85\u00a0é", "\n", "É b"]
    h, shared, which, bounds = hmm.words_of(texts)
    words = [w for t in texts for w in t.encode().lower().split()]
    assert [int(x) for x in h[which]] == [hmm.xxhash.xxh3_64_intdigest(w) - (hmm.xxhash.xxh3_64_intdigest(w) >> 63 << 64) for w in words]
    groups = [min(len(w) - 1, 2 * hmm.LENGTHS - 1) // 2 * hmm.ENDINGS + w[-1] % hmm.ENDINGS for w in words]
    assert shared[which].tolist() == groups and len(h) == len(set(words))
    assert bounds.tolist() == [0, 0, 3, 6, 6, 8]


def test_shares_of_words_in_a_state_add_up_to_one():
    rng = np.random.default_rng(4)
    n = np.array([1, 1, 2, 9, 40])
    inside = n[:, None] * rng.dirichlet(np.ones(hmm.STATES), 5)
    total, types = np.zeros(hmm.SHARED), np.zeros(hmm.SHARED)
    total[7], types[7] = n.sum(), 5
    words = hmm.Words(int(n.sum()), 5, 0, total, types, n, n, np.full(5, -1), np.full(5, 7))
    counts = np.zeros((2 + 2 * hmm.STATES, hmm.SYMBOLS))
    counts[1 + hmm.STATES : 1 + 2 * hmm.STATES, hmm.OWN + 7] = inside.sum(0)
    ratio = hmm.word_ratios(words, counts, np.full(5, hmm.OWN + 7), n, inside)
    plain = (n + 0.5) / 10 ** words.log_shared[7]
    unknown = 0.5 / 10 ** words.log_shared[7]
    assert plain @ ratio + unknown == pytest.approx(np.ones(hmm.STATES)) and ratio.min() > 0
    assert np.abs(ratio - 1).max() > 0.2


def small_model(rng):
    norm = lambda x, axis: x / x.sum(axis, keepdims=True)
    return hmm.Hmm(
        norm(rng.random(hmm.STATES), 0),
        norm(rng.random((hmm.STATES, hmm.STATES)), 1),
        norm(rng.random((hmm.SYMBOLS, hmm.STATES)), 0),
    )


def test_forward_is_the_sum_over_all_paths_and_counts_are_its_expectations():
    import pyarrow as pa

    model = small_model(np.random.default_rng(2))
    sequences = [[3, 250, 254], [1, 254], [254], [7, 7, 9, 254]]
    column = pa.array([bytes(s) for s in sequences])
    want, emitted, moved = [], np.zeros((hmm.STATES, hmm.SYMBOLS)), np.zeros((hmm.STATES, hmm.STATES))
    for s in sequences:
        paths = list(product(range(hmm.STATES), repeat=len(s)))
        chances = []
        for path in paths:
            p = model.start[path[0]] * model.emit[s[0], path[0]]
            for a, b, symbol in zip(path, path[1:], s[1:]):
                p *= model.move[a, b] * model.emit[symbol, b]
            chances.append(p)
        want.append(np.log10(sum(chances)))
        for path, p in zip(paths, chances):
            for state, symbol in zip(path, s):
                emitted[state, symbol] += p / sum(chances)
            for a, b in zip(path, path[1:]):
                moved[a, b] += p / sum(chances)
    assert model.likelihoods(column) == pytest.approx(want)
    counts = model.expected(column)
    assert counts[1 + hmm.STATES : 1 + 2 * hmm.STATES] == pytest.approx(emitted)
    assert counts[1 : 1 + hmm.STATES, : hmm.STATES] == pytest.approx(moved)
    assert counts[-1, 0] == pytest.approx(sum(want))


def test_training_raises_the_likelihood():
    import pyarrow as pa

    rng = random.Random(6)
    column = pa.array([bytes([rng.choice([1, 2, 3] if k % 2 else [9, 8]) for _ in range(20)] + [254]) for k in range(30)])
    model, last = small_model(np.random.default_rng(3)), -np.inf
    for _ in range(4):
        counts = model.expected(column)
        assert counts[-1, 0] > last
        last, model = counts[-1, 0], hmm.maximised(counts, model)


def edits(a, b):
    """Smallest edit distance of a to any part of b."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        old, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(old[j - 1] + (x != y), old[j] + 1, row[j - 1] + 1))
    return min(row)


def test_leaks_equal_plain_alignment(spark, docs_of):
    rng = random.Random(8)
    items = [(i, " ".join(words_of(rng, rng.randint(10, 25)))) for i in range(12)]
    rows = []
    for k in range(60):
        text = " ".join(words_of(rng, 30))
        if k % 2:
            part = list(rng.choice(items)[1])
            for _ in range(rng.randint(0, len(part) // 7)):
                at = rng.randrange(len(part))
                part[at : at + 1] = rng.choice([[], ["x"], ["q", part[at]]])
            text = text[: rng.randint(0, 60)] + "\n" + "".join(part).upper() + " " + text[-rng.randint(1, 60) :]
        rows.append((k, text))
    benchmark = spark.createDataFrame(items + [(90, None), (91, ""), (None, items[0][1])], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.edits for r in decontaminate.find_leaks(docs_of(rows), benchmark).collect()}
    want = {}
    for (d, text), (i, item) in product(rows, items):
        a, b = decontaminate.plain(item), decontaminate.plain(text)
        k = min(int(len(a) * 0.1), len(a) // 8 - 2)
        if (e := edits(a, b)) <= k:
            want[d, i] = e
    assert got == want and len(want) > 10 and any(want.values())
    blocks = decontaminate.find_leaks(docs_of(rows), benchmark, block_bytes=300)
    assert {(r.doc_id, r.item_id): r.edits for r in blocks.collect()} == want


def test_leak_edges(spark, docs_of):
    item = "the quick brown fox jumps over the lazy dog again and again until dusk"
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(1, None), (2, ""), (3, "x" * 60_000 + " " + item), (None, item), (4, item), (4, item), (5, item[:30])]
    got = decontaminate.find_leaks(docs_of(rows), benchmark).collect()
    assert sorted(((r.doc_id, r.edits) for r in got), key=str) == [(3, 0), (4, 0), (4, 0), (None, 0)]
    assert next(r for r in got if r.doc_id == 3).start_byte == 60_001
    left = decontaminate.without_leaks(docs_of(rows), benchmark)
    assert sorted(r.doc_id for r in left.collect()) == [1, 2, 5] and left.columns == docs_of([]).columns
    assert decontaminate.find_leaks(docs_of([]), benchmark).count() == 0
    assert decontaminate.find_leaks(docs_of(rows), benchmark.limit(0)).count() == 0


def brute_short(item, text):
    """Smallest edit distance of an item to a part of a text between word borders."""
    a, b = item.decode(), text.decode()
    cuts = [p for p in range(len(b) + 1) if not (b[:p][-1:].isalnum() and b[p:][:1].isalnum())]
    most = int(len(item) * 0.1)
    near = [(x, y) for x in cuts for y in cuts if x <= y and abs(y - x - len(a)) <= most]
    return min((whole_edits(a.encode(), b[x:y].encode()) for x, y in near), default=len(item))


def whole_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(old[j - 1] + (x != y), old[j] + 1, row[j - 1] + 1))
    return row[-1]


def test_short_items_are_found_between_word_borders(spark, docs_of):
    rng = random.Random(12)
    letters = "abcdefghijklmnopqrstuvwxyz"
    items = [(m, "".join(rng.choice(letters) for _ in range(m))) for m in range(1, 50)]
    items += [(100 + m, t[: m // 2] + " " + t[m // 2 + 1 :]) for m, t in items if m > 4]
    rows, want = [], {}
    for i, item in items:
        part = list(item)
        for _ in range(rng.randint(0, len(item) // 10)):
            part[rng.randrange(len(part))] = rng.choice(["", "7", "8 "])
        rows.append((i, f"({item.upper()}) 10"))  # verbatim
        rows.append((1000 + i, f"00 {''.join(part)}, 11"))  # within the budget, or near it
        rows.append((2000 + i, f"9{item}9"))  # no borders
    found = decontaminate.find_leaks(docs_of(rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r.doc_id, r.item_id): r.edits for r in found}
    for (d, text), (i, item) in product(rows, items):
        a, b = decontaminate.plain(item), decontaminate.plain(text)
        if (e := edits(a, b)) <= int(len(a) * 0.1) and (e := brute_short(a, b)) <= int(len(a) * 0.1):
            want[d, i] = e
    assert got == want and all(got[i, i] == 0 for i, _ in items) and any(want.values())
    assert all(r.start_byte == 1 for r in found if r.doc_id == r.item_id)
    left = decontaminate.without_leaks(docs_of(rows), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(r.doc_id for r in left.collect()) == sorted({d for d, _ in rows} - {d for d, _ in want})


@pytest.mark.parametrize("share", [0.1, 0.25])
def test_items_have_their_whole_budget(spark, docs_of, share):
    rng = random.Random(14)
    letters = "abcdefghijklmnopqrstuvwxyz"
    items = [(m, "".join(rng.choice(letters) for _ in range(m))) for m in range(50, 100)]
    rows, want = [], {}
    for m, item in items:
        k, part = int(m * share), list(item)
        for at in range(k):
            part[at * m // k + m // k // 2] = "7"
        rows += [(m, "00 " + "".join(part) + " 11"), (1000 + m, "0 " + "".join(part)[:-1] + "5 1")]
    for (d, text), (i, item) in product(rows, items):
        if d % 1000 == i and (e := edits(item.encode(), text.encode())) <= int(i * share):
            want[d, i] = e
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_leaks(docs_of(rows), benchmark, edit_share=share).collect()
    assert {(r.doc_id, r.item_id): r.edits for r in found} == want
    assert all(want[m, m] == int(m * share) for m, _ in items)
    with pytest.raises(ValueError):
        decontaminate.gram_size(4, 3)


def test_word_borders_of_scripts():
    places = lambda t: np.flatnonzero(decontaminate.word_borders(t.encode())).tolist()
    assert places("") == [0] and places("a\u00e9b") == [0, 4] and places("\u201cab\u201d") == [0, 3, 5, 8]
    assert places("\u6771\u4eacx") == [0, 3, 6, 7] and places("e\u0301 _x") == [0, 3, 4, 5, 6]


def test_pipeline_against_its_stages_by_hand(spark, tmp_path):
    from tests.llm.test_near_duplicates import brute_components
    from tests.llm.test_secrets import brute

    rng = random.Random(9)
    rows, labels = labelled(150, 4)
    words = words_of(rng, 40)
    item = " ".join(words_of(rng, 20))
    rows += [(500 + i, " ".join(words + words_of(rng, i % 3)) + " end.") for i in range(6)]
    rows += [(600, " ".join(words_of(rng, 30)) + " " + item + ".")]
    rows += [(700, " ".join(words_of(rng, 30)) + " token=abcdefghijklmnop " + " ".join(words_of(rng, 30)) + ".")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}

    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    scores = {r.doc_id: r.score for r in quality.quality_scores(docs, marks).collect()}
    left = [(i, t) for i, t in rows if scores[i] >= 0.3]
    found = brute_components(left, 5)
    left = [(i, t) for i, t in left if found[i][1] == i and item not in t]
    assert sorted(got) == sorted(i for i, _ in left)
    assert all(r.intact for r in got.values())
    bad = [i for i, q in labels if not q]
    assert not set(bad) & set(got) and 600 not in got and 500 in got and 501 not in got
    from paygrain.llm.byte_bpe import load
    import public_tokenizers

    bpe = load(public_tokenizers.path("byte_bpe_50k.json"))
    for i, text in left:
        for start, _, _, end in reversed(brute(text)):
            text = text[:start] + "[secret]" + text[end:]
        assert bpe.decode(got[i].ids) == text


def test_pipeline_edges_and_an_empty_table(spark, tmp_path):
    rows, labels = labelled(120, 6)
    odd = [(None, rows[0][1] + " more."), (None, None), (800, None), (801, ""), (5, rows[5][1]), (5, rows[5][1]), (802, "Word " * 20_000)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, node string, blob string, _new int"
    marks = spark.createDataFrame(labels + [(None, 1), (6, None)], "doc_id long, quality int")
    item = spark.createDataFrame([(1, "no such passage stands in any of these documents"), (2, None), (3, "")], "item_id long, text string")
    for name, some in (("full", rows + odd), ("none", [])):
        folder = f"{tmp_path}/{name}"
        docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", "y", 1) for i, t in some], schema)
        docs.write.parquet(f"{folder}/documents.parquet")
        marks.write.parquet(f"{folder}/labels.parquet")
        item.write.parquet(f"{folder}/benchmark.parquet")
        got = corpus_pipeline.run(spark, folder)
        assert got.columns == ["doc_id", "n_tokens", "ids", "intact"]
        found = Counter(r.doc_id for r in got.collect())
        # Nothing here is near another text, so what the classifier keeps stays: repeated rows and null ids as well.
        scores = quality.quality_scores(docs, marks).collect()
        assert found == Counter(r.doc_id for r in scores if r.score >= 0.3)
    assert not found


def test_ridge_equals_a_dense_fit(spark, docs_of):
    rows, labels = labelled(200, 11)
    stats = quality.stats_of(docs_of(rows).repartition(5))
    model = quality.fit(stats, spark.createDataFrame(labels, "doc_id long, quality int"))
    truth = dict(labels)
    train = [(i, t) for i, t in rows if fold(i) in (2, 3, 4)]
    x = np.array([quality.document_stats(t) for _, t in train])
    y = np.array([float(truth[i]) for i, _ in train])
    assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.spread, np.sqrt(np.maximum(x.var(0), 1e-8)))
    scaled = np.clip((x - model.mean) / model.spread, -6, 6)
    waves = np.sqrt(2 / quality.N_FOURIER) * np.cos(scaled @ model.waves + model.phases)
    f = np.hstack([waves, scaled, np.ones((len(x), 1))])
    # Ridge as least squares with one more row for each weight.
    more = np.sqrt(quality.RIDGE * len(x)) * np.eye(f.shape[1])
    weights = np.linalg.lstsq(np.vstack([f, more]), np.append(y, np.zeros(f.shape[1])), rcond=None)[0]
    assert np.allclose(f @ model.weights, f @ weights, atol=1e-6)
    # The first fold calibrates: its raw scores in bins, pooled.
    held = [(i, t) for i, t in rows if fold(i) == 1]
    raw = model.raw(np.array([quality.document_stats(t) for _, t in held]))
    bins = np.clip((raw + 1) / 3 * quality.BINS, 0, quality.BINS - 1).astype(int)
    some = sorted(set(bins.tolist()))
    n = [int((bins == b).sum()) for b in some]
    good = [sum(truth[i] for (i, _), b in zip(held, bins) if b == c) for c in some]
    want = minimax(n, good)
    centres = (np.array(some) + 0.5) / quality.BINS * 3 - 1
    blocks = sorted(set(want))
    pooled = [np.average(centres[[w == b for w in want]], weights=[k for k, w in zip(n, want) if w == b]) for b in blocks]
    assert np.allclose(model.chances, blocks) and np.allclose(model.levels, pooled)


def minimax(weights, positive):
    """The rising fit of least squares by its formula: the largest, over starts, of the smallest mean over ends."""
    n = len(weights)
    mean = lambda a, b: sum(positive[a : b + 1]) / sum(weights[a : b + 1])
    return [max(min(mean(a, b) for b in range(i, n)) for a in range(i + 1)) for i in range(n)]


def test_isotonic_equals_its_formula():
    rng = random.Random(3)
    for _ in range(60):
        n = rng.randint(1, 12)
        weights = [rng.randint(1, 4) for _ in range(n)]
        positive = [rng.randint(0, w) for w in weights]
        centres, shares = quality.isotonic(np.arange(n, dtype=float), np.array(weights, float), np.array(positive, float))
        want = minimax(weights, positive)
        assert np.allclose(shares, sorted(set(want))) and (np.diff(centres) > 0).all()
