"""Secret scans with an incremental ledger of blobs, in DataFrame functions only.

Every version of a file is addressed by the sha256 of its text. The ledger holds which (blob, rule,
rule version) triples were scanned and what was found; a run scans only triples that it
lacks, once for each blob however many paths and versions share it, and joins the findings back to all of them.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paygrain.session import materialize


@dataclass(frozen=True)
class Rule:
    """``pattern`` is searched leftmost and without overlaps; a match counts if ``group`` has ``least`` characters."""

    name: str
    version: int
    pattern: str
    group: int
    least: int

    @property
    def key(self) -> str:
        return f"{self.name}/{self.version}"


# The rules. Where a match is a whole run of a class, the least length is part of the
# pattern, which finds the same matches. An assignment can swallow the start of another, so there it is not.
RULES = (
    Rule(
        "assign",
        1,
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]{14,}", 0, 18),
    Rule("hex", 1, r"[0-9a-f]{16,}", 0, 16),
)

SCANNED = "blob binary, rule string"
FINDINGS = "blob binary, rule string, start long, end long"


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of the ledger with its run column; empty as long as no run has written it."""
    try:
        return spark.read.schema(f"{schema}, run string").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{schema}, run string")


def _pieces(text: Column, rule: Rule) -> Column:
    """Lengths of the gap before each match, of the match and of its group, all matches in order."""
    pattern = F.lit(rule.pattern)
    zipped = F.arrays_zip(
        F.transform(F.split(text, rule.pattern, -1), F.length).alias("gap"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length).alias("all"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length).alias("value"),
    )
    return F.transform(
        zipped,
        lambda m, i: F.struct(
            F.lit(rule.key).alias("rule"),
            i.alias("place"),
            m["gap"].alias("gap"),
            m["all"].alias("all"),
            m["value"].alias("value"),
        ),
    )


def find(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, rule, start, end) of the rules that ``todo`` names in each (blob, text, todo).

    Offsets are code points, the end is exclusive. Gaps and matches alternate, so a match starts at the sum
    of the lengths before it, which a running sum over the matches of one blob and rule gives.
    """
    kind = "array<struct<rule:string,place:int,gap:int,all:int,value:int>>"
    found = F.concat(
        *[
            F.coalesce(
                F.when(
                    F.array_contains("todo", rule.key) & F.col("text").rlike(rule.pattern),
                    _pieces(F.col("text"), rule),
                ).cast(kind),
                F.array().cast(kind),
            )
            for rule in rules
        ]
    )
    each = blobs.select("blob", F.explode(found).alias("m")).select("blob", "m.*")
    so_far = Window.partitionBy("blob", "rule").orderBy("place")
    length = F.coalesce(F.col("all"), F.lit(0)).cast("long")
    end = F.sum(F.col("gap") + length).over(so_far)
    least = F.element_at(F.create_map(*[F.lit(x) for r in rules for x in (r.key, r.least)]), F.col("rule"))
    return (
        each.distinct()
        .withColumn("end", end)
        .withColumn("start", F.col("end") - length)
        .where(F.col("value") >= least)
        .select("blob", "rule", "start", "end")
    )


def addressed(versions: DataFrame) -> DataFrame:
    """(path, text, blob): a null text counts as empty."""
    text = F.coalesce(versions["text"], F.lit(""))
    return versions.select(
        versions["path"].alias("path"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("blob")
    )


def scan_blobs(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, spans) of the blobs of (path, text, blob) with findings; the ledger is brought up to date.

    Findings are written before the triples that stand for them, each with the name of the run, and count
    only together with those; a run that dies half way leaves nothing behind that is read.
    """
    spark, run = versions.sparkSession, uuid.uuid4().hex
    keys = F.array(*[F.lit(r.key) for r in rules])
    known = _stored(spark, f"{ledger}/scanned", SCANNED)
    known = known.where(F.col("rule").isin([r.key for r in rules]))
    known = known.groupBy("blob").agg(F.collect_set("rule").alias("known"))  # as many as rules
    missing = F.array_except(keys, F.coalesce("known", F.array().cast("array<string>")))
    # One text a blob, taken in each task before the shuffle: a task never gets the copies of a hot one.
    unseen = (
        versions.groupBy("blob")
        .agg(F.first("text").alias("text"))
        .join(known, "blob", "left")
        .select("blob", "text", missing.alias("todo"))
        .where(F.size("todo") > 0)
    )
    todo = unseen.select("blob", "todo")
    named = find(unseen, rules).withColumn("run", F.lit(run))
    named.write.mode("append").parquet(f"{ledger}/findings")
    pairs = todo.select("blob", F.explode("todo").alias("rule"), F.lit(run).alias("run"))
    pairs.write.mode("append").parquet(f"{ledger}/scanned")

    done = _stored(spark, f"{ledger}/scanned", SCANNED).select("blob", "rule", "run")
    place = F.element_at(
        F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.key, i)]), F.col("rule")
    )
    spans = (
        _stored(spark, f"{ledger}/findings", FINDINGS)
        .where(F.col("rule").isin([r.key for r in rules]))
        .join(done, ["blob", "rule", "run"], "left_semi")
        .select("blob", F.struct("start", place.alias("kind"), "rule", "end").alias("span"))
        .distinct()
        .groupBy("blob")
        .agg(F.array_sort(F.collect_list("span")).alias("spans"))  # of one text
    )
    # Stored, so that the join back to the paths of a blob is a plain one that can be split where hot.
    return materialize(spans, "secret-spans")


def scan_versions(
    versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """(path, blob, spans) for every row of ``versions`` (path, text).

    ``spans`` holds (start, kind, rule, end) by start, then order of the rules. A null text counts as
    empty, an empty one has no spans; a null path is a path; repeated rows each get their spans, and their
    blob is scanned once; an empty table gives no rows. Only path and text are read, so other columns
    cannot clash. ``ledger`` is a folder that every executor can reach, kept between runs.
    """
    rows = addressed(versions)
    found = scan_blobs(rows, ledger, rules)
    none = F.array().cast("array<struct<start:long,kind:int,rule:string,end:long>>")
    return (
        rows.select("path", "blob")
        .join(found, "blob", "left")
        .select("path", "blob", F.coalesce("spans", none).alias("spans"))
    )


def redact(docs: DataFrame, ledger: str, mark: str = "[secret]", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` (doc_id, text, ...) with every span found replaced by ``mark``; all columns and rows stay.

    Overlapping spans become one mark. A null text stays null. n_chars, if there, is the new length.
    """
    blob = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    texts = docs.select(docs["doc_id"].alias("path"), docs["text"])
    spans = scan_blobs(addressed(texts), ledger, rules).withColumnRenamed("spans", "_spans")
    names = docs.columns
    marked = docs.select(F.struct(*[docs[c] for c in names]).alias("_doc"), blob.alias("_blob"))
    marked = marked.join(spans.withColumnRenamed("blob", "_blob"), "_blob", "left")
    old = F.col("_doc").getField("text")
    step = F.aggregate(
        "_spans",
        F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda done, s: F.struct(
            F.when(s["start"] >= done["at"], F.concat(
                done["out"], F.substring(old, (done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int")), F.lit(mark)
            )).otherwise(done["out"]).alias("out"),
            F.greatest(done["at"], s["end"]).alias("at"),
        ),
        lambda done: F.concat(done["out"], F.substring(old, (done["at"] + 1).cast("int"), F.length(old))),
    )
    new = F.when(F.col("_spans").isNotNull(), step).otherwise(old)
    columns = []
    for c in names:
        value = F.col("_doc").getField(c)
        if c == "text":
            value = F.col("_new")
        elif c == "n_chars":
            value = F.when(F.col("_spans").isNull(), value).otherwise(F.length("_new"))
            value = value.cast(docs.schema[c].dataType)
        columns.append(value.alias(c))
    return marked.withColumn("_new", new).select(*columns)
