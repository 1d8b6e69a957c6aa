"""Secret scans over a ledger of blobs, in DataFrame operations only.

Every version of every path is named by the SHA-256 of its text. The ledger holds one row for
each blob and rule version that was scanned. A scan hashes all versions, drops the pairs that the
ledger knows (anti-join), scans one copy of each new blob, appends to the ledger, and joins the
findings back to all paths. Copies and unchanged versions cost a hash.

Matches are located without a function for positions: splitting a text at the pattern gives the
pieces between the matches, so the running sum of the lengths of pieces and matches gives the ends.

Defined results: a null text counts as empty and has no findings; a null path is a path; repeated
rows give repeated results; equal blobs share their findings; other columns are dropped; an empty
table gives an empty result and an empty ledger.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlake.llm.stored import stored
from wardlake.operators.quality import unused_name

RULES_VERSION = "1"


class Rule(NamedTuple):
    """A pattern, the group whose length counts, and the characters it needs."""

    kind: str
    pattern: str
    group: int
    least: int


# The base rules.
BASE_RULES = (
    Rule(
        "assign",
        r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),  # a run of 32 or more is found whole, as [0-9a-f]+ finds it
)
OWN_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 20),
)
RULES = (*BASE_RULES, *OWN_RULES)


def _found(text: Column, rule: Rule, rank: int) -> Column:
    """For each match: rule, number, lengths of the piece before it, of itself and of its group."""
    pattern = F.lit(rule.pattern)
    parts = F.arrays_zip(
        F.transform(F.split(text, rule.pattern, -1), F.char_length).alias("piece"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.char_length).alias("whole"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.char_length).alias("value"),
    )
    named = F.transform(
        parts,
        lambda x, i: F.struct(
            F.lit(rank).alias("rank"), i.alias("number"), x["piece"].alias("piece"), x["whole"].alias("whole"), x["value"].alias("value")
        ),
    )
    kind = "array<struct<rank:int,number:int,piece:int,whole:int,value:int>>"
    return F.when(text.rlike(rule.pattern), named).otherwise(F.array().cast(kind))


def _line(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, spans): all findings of each row of (blob, text) by start, then rule order.

    ``spans`` holds structs (start, rank, end, kind); places are code points, the end is exclusive.
    Rows without findings are left out.
    """
    matches = F.flatten(F.array(*(_found(F.col("text"), rule, k) for k, rule in enumerate(rules))))
    rows = blobs.withColumn("row", F.monotonically_increasing_id()).select("blob", "row", F.inline(matches))
    order = Window.partitionBy("blob", "row", "rank").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("end", F.sum(F.col("piece") + F.coalesce("whole", F.lit(0))).over(order)).where("whole is not null")
    least = F.element_at(F.array(*(F.lit(r.least) for r in rules)), F.col("rank") + 1)
    kind = F.element_at(F.array(*(F.lit(r.kind) for r in rules)), F.col("rank") + 1)
    span = F.struct((F.col("end") - F.col("whole")).alias("start"), "rank", F.col("end"), kind.alias("kind"))
    return (
        placed.where(F.col("value") >= least)
        .groupBy("blob", "row")
        .agg(F.sort_array(F.collect_list(span)).alias("spans"))
        .groupBy("blob")
        .agg(F.max("spans").alias("spans"))  # copies of a blob that were scanned twice agree
    )


def read_ledger(spark, ledger: str) -> DataFrame | None:
    try:
        return spark.read.parquet(ledger)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None  # nothing was scanned so far


def scan_versions(
    versions: DataFrame, ledger: str, path: str = "doc_id", rules: tuple[Rule, ...] = RULES, rules_version: str = RULES_VERSION
) -> DataFrame:
    """(path, blob, spans) for every row, after scanning what the ledger in the folder lacks."""
    spark = versions.sparkSession
    named = versions.select(F.col(path).alias("path"), F.coalesce("text", F.lit("")).alias("text")).withColumn("blob", F.sha2("text", 256))
    paths = stored(named.select("path", "blob"), "paths")
    blobs = paths.groupBy("blob").agg(F.min("path").alias("path"))
    known = read_ledger(spark, ledger)
    if known is not None:
        blobs = blobs.join(known.where(F.col("rules_version") == rules_version), "blob", "left_anti")
    chosen = blobs.select(F.col("blob").alias("_blob"), F.col("path").alias("_path")).hint("shuffle_hash")
    one_each = named.join(chosen, (F.col("blob") == F.col("_blob")) & F.col("path").eqNullSafe(F.col("_path")), "left_semi")
    found = scan_blobs(one_each.select("blob", "text"), rules)
    entry = blobs.select("blob").join(found, "blob", "left").withColumn("rules_version", F.lit(rules_version))
    entry.write.mode("append").parquet(ledger)
    entries = read_ledger(spark, ledger).where(F.col("rules_version") == rules_version)
    hits = entries.where("spans is not null").select("blob", "spans").dropDuplicates(["blob"])  # entries may stand there twice
    return paths.join(hits, "blob", "left").select("path", "blob", "spans")


def digests(findings: DataFrame, path: str = "doc_id") -> DataFrame:
    """Counts of the base rules, and the spans in a line."""
    spans = F.coalesce("spans", F.array().cast(findings.schema["spans"].dataType))
    base = F.filter(spans, lambda x: x["rank"] < len(BASE_RULES))
    kinds = F.transform(spans, lambda x: x["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, r.kind))).cast("long").alias(f"n_{r.kind}") for r in BASE_RULES]
    return findings.select(F.col("path").alias(path), *counts, F.sha2(_line(base), 256).alias("base_sha256"), _line(spans).alias("spans"))


def redact(versions: DataFrame, ledger: str, path: str = "doc_id", mark: str = "<secret>") -> DataFrame:
    """The rows with every secret found replaced by a mark; all columns stay.

    Overlapping spans are replaced once, from the first start to the last end.
    """
    findings = scan_versions(versions, ledger, path).where("spans is not null")
    spans, blob, digest = (unused_name(n, versions.columns) for n in ("_spans", "_blob", "_digest"))
    by_blob = findings.groupBy(F.col("blob").alias(blob)).agg(F.max("spans").alias(spans))
    rows = versions.withColumn(digest, F.sha2(F.coalesce("text", F.lit("")), 256)).join(by_blob.hint("shuffle_hash"), F.col(digest) == F.col(blob), "left")

    def step(state, span):
        start = F.greatest(state["at"], span["start"].cast("int"))
        more = F.concat(
            state["out"],
            F.substring(F.col("text"), state["at"] + 1, start - state["at"]),
            F.when(span["end"] > state["at"], F.when((span["start"] < state["at"]) & (state["at"] > 0), F.lit("")).otherwise(F.lit(mark))).otherwise(F.lit("")),
        )
        return F.struct(F.greatest(state["at"], span["end"].cast("int")).alias("at"), more.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(spans, start, step, lambda s: F.concat(s["out"], F.substring(F.col("text"), s["at"] + 1, F.length("text"))))
    text = F.when(F.col(spans).isNull(), F.col("text")).otherwise(done)
    return rows.withColumn("text", text).select(*versions.columns)
