"""Secret scan with an incremental ledger of content-addressed blobs.

DataFrame functions only. A version's text is addressed by its SHA-256. The ledger, a
Parquet table of (blob, rule version, spans), says what has been scanned: a
run scans only blobs it lacks under the current rule version, once however
many paths carry them, appends what it finds, and joins findings back to every path.
Copies collapse before the shuffle (map-side), so a text that fills a third of all
rows is moved once per task and scanned once. Texts are moved once and not stored again.

Matches of a kind are leftmost and do not overlap. Positions come from the pieces
between matches: ``split`` and ``regexp_extract_all`` see the same matches, so the
running sum of their lengths places each one, in code points, end exclusive.

A null text is empty. Null or repeated ids keep their rows; an empty table gives an
empty result and scans nothing; other columns are not read, and ``findings`` replaces columns named ``blob`` and ``spans``.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    least: int  # characters that the match (or the group) must have
    group: int = 0
    hint: str = ""  # text that every match contains: a cheap test before the pattern


# fixed values: the base kinds in their listed order
BASE = [
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20, hint="AKIA"),
    # runs of 24 or more: shorter ones cannot pass, and a longer one is matched whole
    Rule("hex", r"[0-9a-f]{24,}", 24),
]
MORE = [
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 1, hint="-----BEGIN "),
    # from the start of a run on and without going back, so a run is read once whatever it repeats
    Rule("signed_token", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]++\.eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++", 24, hint="eyJ"),
    Rule("hub_token", r"gh[pousr]_[A-Za-z0-9]+", 40, hint="gh"),
    Rule("url_password", r"[a-z][a-z0-9+.-]{0,15}://[^/\s:@]+:[^/\s:@]+@", 1, hint="://"),
]
RULES = BASE + MORE
RULE_VERSION = "3"
SPANS = "array<struct<start:int,rank:int,kind:string,end:int>>"
LEDGER = f"blob string, rule_version string, spans {SPANS}"
MASK = "[SECRET]"


def _found(text: Column, rank: int, r: Rule) -> Column:
    """Array of (rank, kind, places, lens, ok) struct for one rule, empty without matches."""
    p = F.lit(r.pattern)
    test = (F.contains(text, F.lit(r.hint)) if r.hint else F.lit(True)) & F.rlike(text, p)
    passes = F.transform(F.regexp_extract_all(text, p, F.lit(r.group)), lambda m: F.length(m) >= r.least)
    found = F.struct(
        F.lit(rank).alias("rank"), F.lit(r.kind).alias("kind"),
        F.transform(F.split(text, r.pattern, -1), lambda s: F.length(s)).alias("gaps"),
        F.transform(F.regexp_extract_all(text, p, F.lit(0)), lambda s: F.length(s)).alias("lens"),
        passes.alias("ok"))
    return F.when(test, found)


def scan(blobs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """(blob, spans) of distinct (blob, text): spans in order of start, then kind as listed."""
    kinds = F.filter(F.array(*[_found(F.col("text"), i, r) for i, r in enumerate(rules)]), lambda k: k.isNotNull())
    hits = blobs.select("blob", F.explode(kinds).alias("k")).select("blob", "k.rank", "k.kind", F.posexplode(F.arrays_zip("k.gaps", "k.lens", "k.ok")).alias("i", "m"))
    w = Window.partitionBy("blob", "rank").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("m.gaps") + F.coalesce("m.lens", F.lit(0))).over(w).cast("int")
    spans = hits.withColumn("end", end).filter("m.ok").select("blob", (F.col("end") - F.col("m.lens")).alias("start"), "rank", "kind", "end")
    spans = spans.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", "rank", "kind", "end"))).alias("spans"))
    return spans


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger's rows; a ledger that does not exist yet is empty, any other failure is raised."""
    try:
        return spark.read.schema(LEDGER).option("recursiveFileLookup", "true").parquet(path)
    except AnalysisException as ex:
        if ex.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def update_ledger(versions: DataFrame, path: str, rules: list[Rule] = RULES, rule_version: str = RULE_VERSION, text: str = "text") -> None:
    """Scan the blobs of ``versions`` that the ledger lacks under ``rule_version`` and append them.

    Each run writes two folders of its own: the blobs with spans, then the unseen ones without. A run that is repeated after a
    failure finds what is complete and scans the rest.
    """
    spark = versions.sparkSession
    run = f"{path}/run-{uuid.uuid4().hex[:12]}"
    seen = read_ledger(spark, path).filter(F.col("rule_version") == rule_version).select("blob")
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    unseen = versions.select(F.sha2(t, 256).alias("blob"), t.alias("text")).join(seen, "blob", "left_anti")
    blobs = unseen.groupBy("blob").agg(F.first("text").alias("text"))
    found = scan(blobs, rules).select("blob", F.lit(rule_version).alias("rule_version"), "spans")
    found.write.parquet(f"{run}-found")
    known = spark.read.schema(LEDGER).parquet(f"{run}-found").select("blob")
    clean = unseen.select("blob").distinct().join(known, "blob", "left_anti")
    clean.select("blob", F.lit(rule_version).alias("rule_version"), F.array().cast(SPANS).alias("spans")).write.parquet(f"{run}-clean")


def findings(versions: DataFrame, path: str, rule_version: str = RULE_VERSION, text: str = "text") -> DataFrame:
    """``versions`` with ``blob`` and ``spans``: the ledger joined back to every row."""
    known = read_ledger(versions.sparkSession, path).filter(F.col("rule_version") == rule_version).select("blob", "spans")
    rows = versions.drop("spans").withColumn("blob", F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256))
    return rows.join(known.dropDuplicates(["blob"]), "blob", "left")


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with every span, overlapping ones together, replaced by ``MASK``."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a, s):
        fresh = s["end"] > a["at"]
        gap = F.when(s["start"] > a["at"], F.substring(text, a["at"] + 1, s["start"] - a["at"])).otherwise("")
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"),
                        F.when(fresh, F.concat(a["out"], gap, F.when((s["start"] >= a["at"]) | (a["at"] == 0), MASK).otherwise(""))).otherwise(a["out"]).alias("out"))

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))).otherwise(text)
