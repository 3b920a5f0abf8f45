"""Byte-level BPE, token records and token counts against the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from paygrain.llm import byte_bpe, records, token_counts
from paygrain.llm.word_bpe import encoder

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PARTS = [
    "a", "b", "th", "e ", " ", "\n", "\t", "é", "ß", "漢", "字", "'s", "'re", "1", "23", "!!", "\x1c", "\x85", "\xa0",
    " ", "　", "<|endoftext|>", "½", "²", "Ⅷ", "🙂", "é", "​", "٣", "aaaaaaaa", "\x00", "İ", "_", "'",
]
EDGES = [(1, "two words"), (1, "two words"), (2, None), (3, ""), (None, "no id"), (4, " \n "), (5, "ab " * 40_000)]


def random_texts(n, size=60, seed=1, parts=PARTS):
    rng = random.Random(seed)
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, size))) for _ in range(n)]


def ids_of(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


def test_byte_bpe_equals_the_library_and_decodes_back():
    bpe, library = byte_bpe.load(BYTE), Tokenizer.from_file(BYTE)
    letters = random_texts(1500, 40, 2, list("abcdeth "))
    for text in random_texts(1500) + letters + ["a" * 3000, "!?" * 2000]:
        want = library.encode(text, add_special_tokens=False).ids
        got = bpe.encode(text)
        assert np.frombuffer(got, "<u4").tolist() == want
        assert bpe.decode(got) == text


def test_incompatible_pairs_are_those_that_merge_otherwise():
    bpe = byte_bpe.load(BYTE)
    rng = random.Random(3)
    tokens = [t for t in bpe.parts if t not in bpe.special.values()]
    for _ in range(500):
        a, b = rng.choice(tokens), rng.choice(tokens)
        raw = [bpe.blob[bpe.offsets[x] : bpe.offsets[x + 1]].tobytes() for x in (a, b)]
        assert bpe.fits(a, b) == (bpe.encode_piece(raw[0] + raw[1]) == [a, b])


def test_encode_edges(docs_of):
    rows = byte_bpe.encode_checked(docs_of(EDGES), BYTE).collect()
    assert len(rows) == len(EDGES) and all(r.intact for r in rows)
    assert {r.doc_id: r.n_tokens for r in rows}[2] == 0
    for r in rows:
        want = [ids_of(BYTE, t) for i, t in EDGES if i == r.doc_id][0]
        assert np.frombuffer(r.ids, "<u4").tolist() == want
    assert byte_bpe.encode(docs_of([]), BYTE).count() == 0


def test_word_table_equals_the_library():
    words, library = encoder(WORD), Tokenizer.from_file(WORD)
    for text in random_texts(3000):
        got = np.frombuffer(b"".join(words.of_text(text)), "<u4").tolist()
        assert got == library.encode(text, add_special_tokens=False).ids


def test_record_checksums():
    data = records.frame(b"payload")
    assert records.unframe(data) == b"payload" and len(data) == 8 + 4 + 7 + 4
    for i in range(len(data)):
        with pytest.raises(ValueError):
            records.unframe(data[:i] + bytes([data[i] ^ 1]) + data[i + 1 :])


def test_records_round_trip_in_order(spark, docs_of, folder):
    texts = EDGES + [(100 + i, t) for i, t in enumerate(random_texts(50))]
    got = records.record_digests(docs_of(texts), WORD, f"{folder}/r").collect()
    want = {}
    order = sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    at = 0
    for i, t in order:
        ids = ids_of(WORD, t) + [1]
        want.setdefault(i, []).append((at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    have = {}
    for r in got:
        have.setdefault(r.doc_id, []).append((r.start, r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in have.items()} == want
    index = records.read_index(spark, f"{folder}/r")
    backwards = index.where("doc_id >= 100").orderBy(index["doc_id"].desc())
    some = records.read_records(backwards, f"{folder}/r").collect()
    assert [r.doc_id for r in some] == list(range(149, 99, -1))
    assert records.record_digests(docs_of([]), WORD, f"{folder}/none").count() == 0


def test_many_texts_of_one_id_and_small_index_batches(spark, docs_of, folder, monkeypatch):
    monkeypatch.setattr(records, "INDEX_ROWS", 7)
    monkeypatch.setattr(records, "FLUSH_BYTES", 64)
    texts = [(5, t) for t in random_texts(300, 20, 9)] + [(4, "before"), (6, "behind"), (None, "none"), (None, "no id")]
    index = records.write_records(docs_of(texts), WORD, f"{folder}/hot")
    parts = {r.part for r in index.where("doc_id = 5").select("part").distinct().collect()}
    assert len(parts) > 2 and index.count() == len(texts)
    found = records.read_records(index, f"{folder}/hot").collect()
    want = sorted((i, np.array(ids_of(WORD, t) + [1], "<u4").tobytes()) for i, t in texts if i is not None)
    assert sorted((r.doc_id, bytes(r.ids)) for r in found if r.doc_id is not None) == want
    digests = records.record_digests(docs_of(texts), WORD, f"{folder}/again").collect()
    spans = sorted((r.start, r.n_tokens, r.doc_id if r.doc_id is not None else -1) for r in digests)
    assert [s[2] for s in spans] == sorted(s[2] for s in spans)
    assert all(a + n == b for (a, n, _), (b, _, _) in zip(spans, spans[1:])) and spans[0][0] == 0


@pytest.mark.parametrize("bare", [False, True])
def test_records_in_a_store_that_only_spark_opens(spark, docs_of, tmp_path, monkeypatch, bare):
    """A path that Spark maps to a folder and Arrow does not know; a bare path on a cluster, which full_uri refuses."""
    if bare:
        monkeypatch.setattr(records, "shared_folder", lambda s, f: records.full_uri(f, "spark://host:7077"))
        folder = f"{tmp_path}/r"
    else:
        monkeypatch.setattr(records, "ARROW_SCHEMES", {"file": "onlyspark"})
        folder = f"file://{tmp_path}/r"
    monkeypatch.setattr(records, "FLUSH_BYTES", 300)
    texts = EDGES + [(100 + i, t) for i, t in enumerate(random_texts(50))] + [(5, "a"), (5, "b b"), (5, "a")]
    got = records.record_digests(docs_of(texts), WORD, folder).collect()
    monkeypatch.undo()
    want = records.record_digests(docs_of(texts), WORD, f"file://{tmp_path}/by-arrow").collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str) and len(got) == len(texts)
    index = records.read_index(spark, folder)
    backwards = index.where("doc_id >= 100").orderBy(index["doc_id"].desc())
    some = records.read_records(backwards, folder).collect()
    assert [r.doc_id for r in some] == list(range(149, 99, -1))
    by_id = dict(texts)
    assert all(np.frombuffer(r.ids, "<u4").tolist() == ids_of(WORD, by_id[r.doc_id]) + [1] for r in some)


def test_folders_of_records():
    assert records.full_uri("/data/x", "local[4]") == "file:///data/x"
    assert records.full_uri("file:/data/x", "yarn") == records.full_uri("file:///data/x", "yarn") == "file:///data/x"
    assert records.full_uri("/data/x", "yarn", "hdfs://name:8020") == "hdfs://name:8020/data/x"
    assert records.full_uri("s3a://bucket/x", "yarn") == "s3a://bucket/x"
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="name the scheme"):
            records.full_uri("/data/x", master, "file:///")
    assert records.arrow_uri("s3a://bucket/x") == "s3://bucket/x"
    with pytest.raises(ValueError, match="dbfs"):
        records.arrow_uri("dbfs://x")


def counts_of(docs, **more):
    rows = token_counts.count_tokens(docs, WORD, **more).collect()
    return sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in rows), key=str)


@pytest.mark.parametrize("chunk,overlap", [(300, 80), (1000, 128)])
def test_counts_of_spliced_chunks(docs_of, chunk, overlap):
    unbroken = ["ab", "th", "e", "ing", "x", "7", "!", "'s"]
    texts = [(i, t) for i, t in enumerate(random_texts(12, 3000, 5, unbroken) + random_texts(12, 3000, 6))]
    texts += [(50, "a" * 20_000), (51, "!" * 9_000), (52, "a'" * 4_000), (50, "a" * 20_000), (53, "'s" * 3_000)]
    texts += EDGES[:-1]
    want = sorted(((i, len((t or "").encode()), len(ids_of(WORD, t))) for i, t in texts), key=str)
    assert counts_of(docs_of(texts), chunk=chunk, overlap=overlap) == want


def test_no_stable_place_is_reported():
    left = {"ids": [1, 2], "starts": [10, 12], "ends": [12, 14], "open": [0, 0]}
    right = {"ids": [3, 2], "starts": [11, 13], "ends": [13, 14], "open": [0, 0]}
    assert token_counts.splice(left, right, 0, 100) is None


def test_counts_of_an_empty_table(docs_of):
    assert counts_of(docs_of([])) == []


def test_round_trip_digests_equal_the_library(docs_of):
    import hashlib

    texts = EDGES + [(100 + i, t) for i, t in enumerate(random_texts(60, 40, 12))]
    library = Tokenizer.from_file(BYTE)
    want = []
    for i, t in texts:
        ids = library.encode(t or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        want.append((i, len(ids), digest, hashlib.sha256(back.encode()).hexdigest()))
    got = [tuple(r) for r in byte_bpe.round_trip_digests(docs_of(texts), BYTE).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_ids_that_are_no_whole_characters_decode_as_the_library_does():
    bpe, library, rng = byte_bpe.load(BYTE), Tokenizer.from_file(BYTE), random.Random(8)
    for _ in range(300):
        ids = [rng.randrange(50_257) for _ in range(rng.randint(1, 12))]
        assert bpe.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids, skip_special_tokens=False)


def test_counts_over_the_limit_with_repeated_ids(docs_of):
    rows = [(1, "word " * 3000), (1, "word " * 3000), (2, "word " * 2048), (2, "word " * 2049), (None, None)]
    counted = token_counts.count_tokens(docs_of(rows), WORD).withColumn("over", F.col("n_tokens") > 2048)
    got = sorted(((r.doc_id, r.n_tokens, r.over) for r in counted.collect()), key=str)
    assert got == sorted([(1, 3000, True), (1, 3000, True), (2, 2048, False), (2, 2049, True), (None, 0, False)], key=str)
