"""WARC archives: written by Spark's text writer, read back by boundary-chain verification.

Writing: each row is one record (header, block), the line separator is the blank
lines that end a record, and files roll at ``RECORDS_PER_FILE``; commits are those of
Spark's writers on any file system. Of records with equal payloads of at least
``LEAST`` bytes the smallest page id is the response, the others are revisits without
a payload.

Reading: a task takes a file and emits a candidate for each place where the magic
line starts, with the offset of its successor (from its own Content-Length). A
payload may hold the magic too, so a candidate is a record only if the chain from the
file's start leads to it. Pointer jumping finds those: with every round the set of
reached offsets also takes its successors, and each pointer then skips twice as
far, so n records need log2(n) rounds. Reachable candidates are the records.

Null payloads are empty. Rows with a null page id are responses and nobody refers to
them. Repeated rows give repeated records. Extra columns are not written. An
empty table writes no record and reads back empty.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurepipe.llm.store import ship, stored

LEAST = 100  # bytes of the shortest payload that may be a revisit
RECORDS_PER_FILE = 2048
MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
RECORD = "path string, at bigint, next bigint, type string, page_id bigint, uri string, payload_bytes bigint, payload_digest string, refers_to bigint, intact boolean"


def write_warc(pages: DataFrame, path: str, page: str = "page_id", uri: str = "url", payload: str = "html") -> None:
    """Write a record per row of ``pages`` under ``path``."""
    rows = pages.select(F.col(page).cast("bigint").alias("page_id"), F.col(uri).cast("string").alias("uri"), F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("bytes", F.octet_length("payload"))
    groups = rows.filter((F.col("bytes") >= LEAST) & F.col("page_id").isNotNull()).groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"))
    groups = stored(groups.filter("first < last").select("digest", "first"), "payloads")
    rows = rows.join(groups, "digest", "left")
    revisit = F.coalesce((F.col("bytes") >= LEAST) & (F.col("page_id") > F.col("first")), F.lit(False))
    block = F.when(revisit, "").otherwise(F.concat(F.lit(HTTP), F.col("payload")))
    line = lambda name, value: F.concat(F.lit(name + ": "), value, F.lit("\r\n"))
    head = F.concat(
        F.lit(MAGIC), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        F.when(F.col("page_id").isNotNull(), line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("page_id").cast("string"), F.lit(">")))).otherwise(""),
        F.when(F.col("uri").isNotNull(), line("WARC-Target-URI", F.translate("uri", "\r\n", ""))).otherwise(""),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        line("WARC-Payload-Length", F.col("bytes").cast("string")),
        F.when(revisit, line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">")))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"))
    rows.select(F.concat(head, block).alias("value")).write.option("lineSep", END).option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


FIELD = re.compile(rb"([A-Za-z-]+): ([^\r\n]*)\r\n")


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every place of a file that reads as a record, with the offset of its successor."""
    magic, end, http = MAGIC.encode(), END.encode(), HTTP.encode()
    schema = pa.schema([("path", pa.string()), ("at", pa.int64()), ("next", pa.int64()), ("type", pa.string()), ("page_id", pa.int64()), ("uri", pa.string()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("intact", pa.bool_())])
    for b in batches:
        for path, content in zip(b.column("path").to_pylist(), b.column("content")):
            data = content.as_py()
            out, at = [], data.find(magic)
            while at >= 0:
                stop = data.find(end, at)
                head = dict(FIELD.findall(data, at, stop + 2)) if stop >= 0 else {}
                size = head.get(b"Content-Length", b"")
                if size.isdigit():
                    start = stop + len(end)
                    nxt = start + int(size) + len(end)
                    if data[nxt - len(end) : nxt] == end and nxt <= len(data):
                        digest = head.get(b"WARC-Payload-Digest", b"").decode().removeprefix("sha256:")
                        known = head.get(b"WARC-Payload-Length", b"")
                        n = int(known) if known.isdigit() else None
                        intact = True
                        if head.get(b"WARC-Type") == b"response":
                            payload = memoryview(data)[start + len(http) * (data[start : start + len(http)] == http) : nxt - len(end)]
                            own = hashlib.sha256(payload).hexdigest()
                            intact, digest, n = own == digest and n == len(payload), own, len(payload)
                        ids = [re.fullmatch(rb"<urn:page:(-?\d+)>", head.get(k, b"")) for k in (b"WARC-Record-ID", b"WARC-Refers-To")]
                        out.append((path, at, nxt, head.get(b"WARC-Type", b"").decode(), ids[0] and int(ids[0][1]), head[b"WARC-Target-URI"].decode() if b"WARC-Target-URI" in head else None, n, digest, ids[1] and int(ids[1][1]), intact))
                at = data.find(magic, at + 1)
            for i in range(0, max(1, len(out)), 4096):
                cols = list(zip(*out[i : i + 4096])) or [[]] * len(schema)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def reachable(pointers: DataFrame) -> DataFrame:
    """(path, at) of the offsets on the chain from 0 of each path; ``pointers``: path, at, next (unique by path, at)."""
    jump = pointers.select("path", "at", "next")
    reached = jump.select("path", F.lit(0).cast("bigint").alias("at")).distinct()
    n = -1
    while True:
        jump = stored(jump, "jumps")
        reached = stored(reached.unionByName(reached.join(jump, ["path", "at"]).select("path", F.col("next").alias("at"))).distinct(), "reached")
        now = reached.count()
        if now == n:
            return reached
        n = now
        further = jump.select("path", F.col("at").alias("next"), F.col("next").alias("beyond"))
        jump = jump.join(further, ["path", "next"]).select("path", "at", F.col("beyond").alias("next"))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives under ``path`` (see ``RECORD``); ``intact``: a response's payload has the recorded digest and length."""
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    found = stored(files.mapInArrow(_candidates, RECORD), "candidates")
    chain = found.select(F.xxhash64("path").alias("path"), "at", "next")
    return found.withColumn("file", F.xxhash64("path")).join(reachable(chain).withColumnRenamed("path", "file"), ["file", "at"], "left_semi").drop("file")
