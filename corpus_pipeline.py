"""Corpus pipeline: quality rules, near-duplicates, secrets, source mix, packing.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept; all but the
last return the columns of ``documents``. ``run`` writes every stage's result under the
shared folder and rereads it.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurepipe.llm import jaccard_join, mixing, packing, quality_rules, secret_scan
from featurepipe.llm.store import new_path, release, scope, stored
from featurepipe.sources.tables import read_table

MADE: list[str] = []  # tables of the stages before the current one
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
NEAR = {"k": 5, "percent": 80}  # near-duplicates: shingles of five words, similarity 0.8 (op1's contract has 4 and 85)


def _keyed(docs: DataFrame) -> DataFrame:
    """The documents with a key of each row, written once: verdicts name rows, not ids."""
    return stored(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row")), "keyed", compression="zstd")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality rules keep, whatever their ids."""
    docs = _keyed(docs)
    kept = quality_rules.judge(docs, id_col="row").filter("kept").select(F.col("doc_id").alias("row"))
    return docs.join(kept, "row", "left_semi").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group linked at ``NEAR``, the one of the smallest id; rows without an id come last.

    Every row is a vertex: repeated rows are copies, different texts of one id are not.
    """
    docs = _keyed(docs)
    groups = jaccard_join.link_components(docs, id_col="row", **NEAR).select(F.col("id").alias("row"), "component").join(docs.select("row", "doc_id"), "row")
    stay = groups.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")).alias("stay")).select("stay.row")
    return docs.join(stay, "row", "left_semi").select(*COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked."""
    ledger = new_path(spark, "ledger")
    secret_scan.update_ledger(docs, ledger)
    found = secret_scan.findings(docs.select(*COLUMNS), ledger)
    masked = found.withColumn("text", secret_scan.masked(F.col("text"), F.col("spans")))
    return masked.withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: every document, those of small sources repeated up to their budget."""
    return mixing.mix(docs.select(*COLUMNS)).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack(packing.pieces(docs))


def _staged(work):
    """The stage ``work``, after the tables of earlier stages are emptied (their results have been written by then; what ``docs`` reads stays)."""
    @wraps(work)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        MADE[:] = release(spark, MADE, docs)
        with scope() as made:
            out = work(spark, docs, sf_dir)
        MADE.extend(made)
        return out

    return stage


STAGES = [(name, _staged(work)) for name, work in (
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("secret_scans", secrets),
    ("source_mixing", mixing_weights),
    ("best_fit_packing", pack),
)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
