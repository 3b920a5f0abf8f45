"""The ledger and the spans, against the rules written with another regex engine."""

import random
import re

from pyspark.sql import functions as F

from paygrain.llm import secrets

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
PARTS = ["password", "PassWD", "secret", "token", "api_key", "APIKEY", " ", "=", ":", "'", '"', "abcdef0123456789",
         "AKIA", "ABCDEFGHIJ1234567", "é", "\n", "x", "deadbeef", "0", "Zz+/", "漢"]


def brute(text):
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 80))) for _ in range(n)]


def scan(spark, rows, ledger, rules=secrets.RULES):
    df = spark.createDataFrame([(i, t, "c") for i, t in rows], "path long, text string, blob string")
    got = secrets.scan_versions(df, ledger, rules).collect()
    return sorted(
        ((r.path, [(s.start, s.kind, s.rule.split("/")[0], s.end) for s in r.spans]) for r in got), key=str
    )


def test_spans_equal_brute_force_with_edges(spark, folder):
    rows = list(enumerate(texts(150, 5))) + [(500, None), (501, ""), (502, "x " * 30_000 + "token=abcdefghijklmnop")]
    rows += [(None, "token=abcdefghijklmnop"), (None, "token=abcdefghijklmnop"), (3, rows[3][1]), (600, rows[3][1])]
    assert scan(spark, rows, f"{folder}/l") == sorted(((i, brute(t)) for i, t in rows), key=str)


def test_only_unseen_triples_are_scanned(spark, folder):
    ledger, first = f"{folder}/l", list(enumerate(texts(20, 1)))
    scan(spark, first, ledger)
    blobs = len({t for _, t in first})
    scanned = lambda: spark.read.parquet(f"{ledger}/scanned")
    assert scanned().count() == 3 * blobs
    more = first + [(100 + i, t) for i, t in enumerate(texts(5, 2))]
    assert scan(spark, more, ledger) == sorted(((i, brute(t)) for i, t in more), key=str)
    assert scanned().count() == 3 * len({t for _, t in more})
    assert scanned().groupBy("blob", "rule").count().where("count > 1").isEmpty()
    # A new version of one rule is scanned on all blobs, the others are not.
    newer = tuple(
        secrets.Rule(r.name, 2, r.pattern, r.group, r.least) if r.name == "hex" else r for r in secrets.RULES
    )
    assert scan(spark, more, ledger, newer) == sorted(((i, brute(t)) for i, t in more), key=str)
    assert scanned().count() == 4 * len({t for _, t in more})
    assert scanned().where(F.col("rule") == "hex/2").count() == len({t for _, t in more})


def test_findings_of_a_lost_run_do_not_count(spark, folder):
    ledger, rows = f"{folder}/l", [(1, "token=abcdefghijklmnop")]
    scan(spark, rows, ledger)
    lost = spark.read.parquet(f"{ledger}/findings").withColumn("run", F.lit("lost"))
    lost = lost.withColumn("start", F.lit(5).cast("long")).withColumn("end", F.lit(6).cast("long"))
    lost.write.mode("append").parquet(f"{ledger}/findings")
    assert scan(spark, rows, ledger) == [(1, brute(rows[0][1]))]


def test_redaction_keeps_rows_and_columns(spark, folder):
    rows = [(1, "a token=abcdefghijklmnop z", 26), (1, "clean", 5), (2, None, None), (None, "AKIA" + "A" * 20, 24)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    got = sorted(map(tuple, secrets.redact(df, f"{folder}/l").collect()), key=str)
    want = [(1, "a [secret] z", 12), (1, "clean", 5), (2, None, None), (None, "[secret]", 8)]
    assert got == sorted(want, key=str)
    assert secrets.redact(df.limit(0), f"{folder}/m").count() == 0


def test_no_python_in_the_plan(spark, folder):
    df = spark.createDataFrame([(1, "token=abcdefghijklmnop")], "path long, text string")
    plan = secrets.scan_versions(df, f"{folder}/l")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_repeated_rows_and_copies_are_scanned_once(spark, folder, monkeypatch):
    find, scanned = secrets.find, []

    def watched(blobs, rules):
        scanned.append(sorted((r.text, len(r.todo)) for r in blobs.collect()))
        return find(blobs, rules)

    monkeypatch.setattr(secrets, "find", watched)
    hot, other = "token=abcdefghijklmnop", "secret: abcdefghijklmnopq"
    rows = [(1, hot)] * 50 + [(None, hot)] * 5 + [(i, hot) for i in range(2, 9)] + [(9, other), (10, None), (11, "")]
    want = sorted(((i, brute(t)) for i, t in rows), key=str)
    assert scan(spark, rows, f"{folder}/once") == want
    assert scanned == [sorted((t, 3) for t in ("", hot, other))]
    assert scan(spark, rows, f"{folder}/once") == want and scanned[1] == []
