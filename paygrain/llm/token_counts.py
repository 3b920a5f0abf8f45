"""Token counts of whole texts; huge ones in overlapping chunks that are spliced at stable borders.

A chunk is encoded by the library with offsets. Neighbours share an overlap, and are spliced
behind a token that both have in the same place with the same id, clear of both cuts:

* followed by white space: pieces never reach across it, so both encodings go on alike; or
* inside an unbroken run, followed by a second common token: merges leave exactly the sequences whose
  neighbouring tokens stay apart when merged together, and every neighbouring pair of the spliced
  sequence stands in one of the two encodings.

Where an overlap has no such place, the document is cut again with wider chunks and overlaps, until one
chunk holds it. Nothing is estimated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from paygrain.llm.common import map_rows, small_batches, whole_texts
from paygrain.llm.word_bpe import counter
from paygrain.session import materialize

CHUNK, OVERLAP = 32_768, 1_024
CLEAR = 32  # characters from a cut; longer than any special string

COUNTED = StructType(
    [StructField(c, LongType()) for c in ("doc_id", "n_bytes", "n_tokens")]
)
CHUNKS = StructType(
    [
        StructField("row", LongType()),
        StructField("k", IntegerType()),
        StructField("start", LongType()),
        StructField("last", IntegerType()),
        StructField("text", StringType()),
    ]
)
# border: -1 for the count of a chunk, else the number of the chunk on the left.
EDGES = StructType(
    [
        StructField("row", LongType()),
        StructField("border", IntegerType()),
        StructField("right", IntegerType()),
        StructField("n", LongType()),
        StructField("ids", ArrayType(LongType())),
        StructField("starts", ArrayType(LongType())),
        StructField("ends", ArrayType(LongType())),
        StructField("open", ArrayType(IntegerType())),
    ]
)
DROPS = StructType([StructField("row", LongType()), StructField("dropped", LongType())])


def cut(row: int, text: str, chunk: int, overlap: int) -> list[tuple]:
    step, n = chunk - overlap, len(text)
    starts = list(range(0, max(n - overlap, 1), step))
    return [
        (row, k, s, int(k == len(starts) - 1), text[s : s + chunk if k < len(starts) - 1 else n])
        for k, s in enumerate(starts)
    ]


def encode_chunk(tokenizer, row, k, start, last, text, overlap) -> list[tuple]:
    """The count of a chunk and its tokens in the overlaps, with places in the whole text."""
    done = tokenizer.encode(text, add_special_tokens=False)
    ids, offsets, n = done.ids, done.offsets, len(done.ids)
    out = [(row, -1, 0, n, None, None, None, None)]

    def edge(border, right, first, end):
        places = range(first, end)
        out.append(
            (
                row, border, right, n - first if not right else 0,
                [ids[i] for i in places],
                [start + offsets[i][0] for i in places],
                [start + offsets[i][1] for i in places],
                [int(text[offsets[i][1] : offsets[i][1] + 1] in (" ", "\n", "\t", "\r")) for i in places],
            )
        )

    if k > 0:
        end = next((i for i, (s, _) in enumerate(offsets) if s >= overlap), n)
        edge(k - 1, 1, 0, end)
    if not last:
        from_here = len(text) - overlap
        first = next((i for i in range(n - 1, -1, -1) if offsets[i][1] <= from_here), -1) + 1
        edge(k, 0, first, n)
    return out


def splice(left: dict, right: dict, low: int, high: int) -> int | None:
    """Tokens to drop, of both sides, around a common stable place in [low, high]; None if there is none."""
    place = {
        (i, s, e): j for j, (i, s, e) in enumerate(zip(right["ids"], right["starts"], right["ends"]))
    }
    tokens = list(zip(left["ids"], left["starts"], left["ends"]))
    inside = None
    for j, token in enumerate(tokens):
        other = place.get(token)
        if other is None or token[1] < low or token[2] > high or token[1] == token[2]:
            continue
        dropped = len(tokens) - 1 - j + other + 1
        if left["open"][j]:
            return dropped
        if inside is None and j + 1 < len(tokens) and tokens[j + 1][2] <= high:
            if place.get(tokens[j + 1]) == other + 1 and tokens[j + 1][1] == token[2]:
                inside = dropped
    return inside


def count_tokens(
    docs: DataFrame, vocabulary: str, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every whole text, as the tokenizers library counts it.

    Texts of at most ``chunk`` characters are counted word by word where they lie. Longer ones are stored
    once, and their chunks are dealt over all tasks, so that one huge document does not hold
    up one task; only tokens of the overlaps are shuffled. A null or empty text has no token;
    repeated rows and null doc_ids give a row each; other columns are not read.
    """
    texts = whole_texts(docs).withColumn("n_bytes", F.octet_length("text").cast("long"))

    def short():
        words = counter(vocabulary)
        return lambda doc_id, n_bytes, text: [(doc_id, n_bytes, sum(words.of_text(text)))]

    counted = map_rows(
        texts.where(F.length("text") <= chunk).select("doc_id", "n_bytes", "text"), short, COUNTED
    )
    huge = texts.where(F.length("text") > chunk)
    huge = huge.withColumn("row", F.monotonically_increasing_id())
    huge = materialize(huge, "token-counts-huge")
    waiting, n_chars = huge.select("row", "text"), chunk
    while not waiting.isEmpty():
        sums = materialize(_spliced(waiting, vocabulary, n_chars, overlap), "token-counts-sums")
        done = sums.where("n_tokens IS NOT NULL")
        counted = counted.unionByName(
            done.join(huge.drop("text"), "row").select("doc_id", "n_bytes", "n_tokens")
        )
        failed = sums.where("n_tokens IS NULL").select("row")
        waiting = huge.select("row", "text").join(failed, "row")
        n_chars, overlap = n_chars * 2, overlap * 8
        n_chars = max(n_chars, 2 * overlap)
    return counted


def _spliced(texts: DataFrame, vocabulary: str, chunk: int, overlap: int) -> DataFrame:
    """(row, n_tokens); n_tokens is null where a border of the row has no stable place."""
    step = chunk - overlap

    def cutter():
        return lambda row, text: cut(row, text, chunk, overlap)

    def coder():
        tokenizer = counter(vocabulary).tokenizer
        return lambda *c: encode_chunk(tokenizer, *c, overlap)

    def joiner():
        def f(row, border, l_ids, l_starts, l_ends, l_open, r_ids, r_starts, r_ends, r_open):
            left = {"ids": l_ids, "starts": l_starts, "ends": l_ends, "open": l_open}
            right = {"ids": r_ids, "starts": r_starts, "ends": r_ends, "open": r_open}
            begin = (border + 1) * step
            return [(row, splice(left, right, begin + CLEAR, begin + overlap - CLEAR))]

        return f

    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    with small_batches(texts.sparkSession, 16):
        chunks = map_rows(texts.select("row", "text"), cutter, CHUNKS).repartition(parts)
        edges = materialize(map_rows(chunks, coder, EDGES), "token-counts-edges")
    sides = ["ids", "starts", "ends", "open"]
    left = edges.where("border >= 0 AND right = 0").select("row", "border", *sides)
    right = edges.where("border >= 0 AND right = 1").select(
        "row", "border", *[F.col(c).alias(f"r_{c}") for c in sides]
    )
    drops = map_rows(left.join(right, ["row", "border"]), joiner, DROPS)
    per_chunk = edges.where("border = -1").select("row", "n", F.lit(0).alias("failed"))
    per_border = drops.select(
        "row",
        (-F.coalesce("dropped", F.lit(0))).alias("n"),
        F.col("dropped").isNull().cast("int").alias("failed"),
    )
    return (
        per_chunk.unionByName(per_border)
        .groupBy("row")
        .agg(F.when(F.max("failed") == 0, F.sum("n")).alias("n_tokens"))
    )
