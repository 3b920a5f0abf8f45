import random

import pytest
from pyspark.sql import functions as F

from paygrain.functions import text


def one(spark, expr_fn, *values):
    df = spark.createDataFrame([tuple(values)], [f"c{i}" for i in range(len(values))])
    return df.select(expr_fn(*[F.col(c) for c in df.columns])).first()[0]


def each(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r[1] for r in df.select("i", fn(F.col("c"))).orderBy("i").collect()]


def test_match_key(spark):
    df = spark.createDataFrame(
        [
            (1, " Police Dept\t", "Clerk  &  Typist"),
            (2, "FIRE", "Café_Manager II!"),
            (3, None, "x"),
            (4, "x", None),
            (5, " Parks ", "É-Tech"),
        ],
        "i int, a string, t string",
    )
    rows = df.select("i", text.match_key(F.col("a"), F.col("t")).alias("k")).orderBy("i").collect()
    assert [r.k for r in rows] == [
        "police_dept_clerk_typist",
        "fire_café_manager_ii",
        None,
        None,
        "parks_étech",
    ]


def test_title_keys(spark):
    values = ["Data_Analyst  (II)", "\tÉtat-Major ", "", "x\x1fy", "½ day²", None]
    assert each(spark, text.title_key_regex, values)[:3] == ["data_analyst_ii", "étatmajor", ""]

    def python_key(v):
        kept = "".join(c for c in v.lower().strip() if c.isalnum() or c.isspace())
        return "_".join(kept.split())

    expected = [None if v is None else python_key(v) for v in values]
    assert each(spark, text.title_key_alnum, values) == expected


def test_sheet_slug_and_header(spark):
    assert each(spark, text.sheet_slug, ["Top Jobs - 2024 (NY)!", "A--b  c"]) == [
        "lighthouse_top_jobs_2024_ny",
        "lighthouse_a_b_c",
    ]
    headers = each(spark, lambda c: text.header_or_default(c, F.lit(3)), ["  a ", " ", None])
    assert headers == ["a", "col_3", "col_3"]


def test_agency_rules_in_order(spark):
    values = ["City Police & Fire", "fire dept", "Board of Education", "DOE", "Dept of Health", "Parks", None]
    assert each(spark, text.standardize_agency, values) == [
        "Police Department",
        "Fire Department",
        "Department of Education",
        "Department of Education",
        "Department of Health",
        "Parks",
        None,
    ]


def trigrams(s):
    out = set()
    word = ""
    for c in s.lower() + " ":
        if c.isalnum():
            word += c
        elif word:
            p = f"  {word} "
            out |= {p[i : i + 3] for i in range(len(p) - 2)}
            word = ""
    return out


def test_trigram_similarity_against_sets(spark):
    rng = random.Random(3)
    words = ["senior", "data", "analyst", "clérk", "ii", "typist", "é", "a-b", "_x_", ""]
    pairs = [
        (" ".join(rng.choices(words, k=rng.randint(0, 4))), " ".join(rng.choices(words, k=rng.randint(0, 4))))
        for _ in range(200)
    ]
    pairs.append(("word", "two words"))
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    got = df.select("i", text.trigram_similarity(F.col("a"), F.col("b")).alias("s")).orderBy("i")
    for (a, b), row in zip(pairs, got.collect()):
        x, y = trigrams(a), trigrams(b)
        expected = len(x & y) / len(x | y) if x and y else 0.0
        assert row.s == pytest.approx(expected, abs=1e-6), (a, b)
    assert round(got.collect()[-1].s, 4) == 0.3636
