"""Secret scans with an incremental ledger of blobs, with DataFrame functions only.

A text is a blob, named by its SHA-256; a document is a path to it. The ledger
says which rules have scanned a blob and what they found. A run names all
texts, takes one path of each blob that some rule version has not scanned,
scans only those pairs, adds them to the ledger and joins the findings back to
all paths. So a text held by a third of all documents is scanned once, and a
later run with a new rule, or with new documents, scans only what is new.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keylane.llm.shared import documents, text_or_empty
from keylane.session import stored


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, and the group that must have at least ``least`` code points (0: the match)."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    def __post_init__(self) -> None:
        """Java walks a repeated group by recursion: a long enough text would end the executor. A repeated character class is a loop."""
        if re.search(r"\)[*+{]", re.sub(r"\\.", "", self.pattern)):
            raise ValueError(f"a rule may not repeat a group: {self.pattern}")

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The three kinds that every scan has, then formats that issuers publish.
# A run of hex digits or of an access key is as long as it can be, so the least length can stand in the pattern;
# an assignment must match before it is measured, because a short one uses up its text.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,64}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
)
BASE_KINDS = ("assign", "access", "hex")
LEDGER = "blob binary, rules array<string>, found array<struct<start:long,kind:string,end:long,rule:string>>"


def scan(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """Findings of all documents, and the ledger with this run's scans added.

    Findings are rows (doc_id, blob, found), one a document; ``found`` is sorted
    by start and then by the order of the rules. ``ledger`` is what an earlier
    run returned; findings of other rule versions stay in it but are not reported.
    Null is the empty text.
    """
    paths = stored(docs.select("doc_id", _blob().alias("blob")), "paths")
    blobs = paths.groupBy("blob").agg(F.min(F.xxhash64("doc_id")).alias("path"))
    names = F.array(*[F.lit(r.name) for r in rules])
    if ledger is None:
        unseen = blobs.withColumn("rules", names)
    else:
        seen = ledger.groupBy("blob").agg(F.flatten(F.collect_list("rules")).alias("seen"))
        unseen = blobs.join(seen, "blob", "left").withColumn("rules", F.array_except(names, F.coalesce("seen", F.array().cast("array<string>")))
                                                             ).filter(F.size("rules") > 0).select("blob", "path", "rules")
    texts = docs.select(_blob().alias("blob"), F.xxhash64("doc_id").alias("path"), text_or_empty().alias("text")).join(
        unseen, ["blob", "path"]).dropDuplicates(["blob", "path"])
    hits = _hits(texts, rules)
    new = stored(unseen.select("blob", "rules").join(hits, "blob", "left").select(
        "blob", "rules", F.coalesce("found", F.array().cast("array<struct<start:long,kind:string,end:long,rule:string>>")).alias("found")), "ledger")
    every = new if ledger is None else ledger.unionByName(new)
    return _by_path(paths, every, rules), every


def _blob() -> Column:
    return F.unhex(F.sha2(text_or_empty(), 256))


def _hits(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Rows (blob, found) of the texts in which a rule of theirs finds something.

    Spark finds matches but not where they are. The texts between matches have
    lengths too, so a running sum over both gives each match's place.
    """
    anything = "|".join(f"(?:{r.pattern})" for r in rules)
    likely = texts.filter(F.col("text").rlike(anything))
    kinds = []
    for rule in rules:
        wanted = F.array_contains("rules", rule.name)
        matches = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))
        gaps = F.split("text", rule.pattern, -1)
        measured = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group)) if rule.group else matches
        parts = F.transform(F.arrays_zip(gaps.alias("g"), matches.alias("m"), measured.alias("v")), lambda x: F.struct(
            F.char_length(x["g"]).alias("gap"), F.char_length(x["m"]).alias("long"), (F.char_length(x["v"]) >= rule.least).alias("good")))
        kinds.append(F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule.name).alias("rule"), F.when(wanted, parts).alias("parts")))
    each = likely.select("blob", F.explode(F.array(*kinds)).alias("k")).select("blob", "k.kind", "k.rule", F.posexplode("k.parts").alias("i", "p"))
    line = Window.partitionBy("blob", "rule").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.col("p.gap") + F.coalesce("p.long", F.lit(0))).over(line), F.lit(0))
    spans = each.select("blob", "kind", "rule", "p.good", (before + F.col("p.gap")).alias("start"), F.col("p.long").alias("long")).filter(
        F.col("long").isNotNull() & F.col("good"))  # the last gap has no match after it
    return spans.groupBy("blob").agg(F.collect_list(F.struct(
        F.col("start").cast("long").alias("start"), "kind", (F.col("start") + F.col("long")).cast("long").alias("end"), "rule")).alias("found"))


def _by_path(paths: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    order = F.array(*[F.lit(r.kind) for r in rules])
    now = F.array(*[F.lit(r.name) for r in rules])
    current = ledger.filter(F.arrays_overlap("rules", now))
    per_blob = current.groupBy("blob").agg(F.flatten(F.collect_list("found")).alias("found")).select("blob", F.transform(
        F.array_sort(F.transform(F.filter("found", lambda x: F.array_contains(now, x["rule"])), lambda x: F.struct(x["start"].alias("start"), F.array_position(order, x["kind"]).alias("rank"),
                                                             x["kind"].alias("kind"), x["end"].alias("end")))),
        lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))).alias("found"))
    # only blobs with findings are joined, from a table: it is broadcast if small, else a hot blob's paths are split
    held = stored(per_blob.filter(F.size("found") > 0), "findings")
    nothing = F.array().cast(held.schema["found"].dataType)
    return paths.join(held, "blob", "left").select("doc_id", "blob", F.coalesce("found", nothing).alias("found"))


def spans_text(found: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """kind:start:end of each finding, joined by commas."""
    chosen = found if kinds is None else F.filter(found, lambda x: x["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def _count(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda x: x["kind"] == kind)).cast("long")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    findings, _ = scan(documents(spark, sf_dir))
    found = F.col("found")
    counts = [_count(found, kind).alias(f"n_{kind}") for kind in BASE_KINDS]
    return findings.select("doc_id", *counts, F.sha2(spans_text(found, BASE_KINDS), 256).alias("base_sha256"),
                           spans_text(found).alias("spans"))
