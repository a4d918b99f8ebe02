"""Token ids as ORC: integer run-length encoded lists, row indexes and Bloom filters on ids.

Texts are range-partitioned and sorted by id before they are encoded, so files and
their stripes hold disjoint, ascending id ranges: min/max statistics and the Bloom
filters of the id column let a reader skip stripes, and stripes are read in
parallel. ORC writes the id lists with its run-length integer encoding.

The start of a document among all ids is a two-level running sum: a window inside each
file over one small row per document, plus the totals of the files before (one row per
file). Null texts are empty; a null id sorts first; repeated rows and ids are each
encoded; an empty table writes and returns no rows; other columns are not read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from featurepipe.llm.store import ship, stored
from featurepipe.llm.tokens import DEFAULT_VOCABULARY, encoder

END_ID = 2
BATCH = 512  # documents whose ids are held at once


def vocabulary_path(name: str) -> str:
    """A path as it is; a bare file name is looked up among the installed vocabularies."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_rows(vocabulary: str, end_id: int, ordered: bool = False):
    """mapInArrow function: (id, text) to (id, ids)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(vocabulary_path(vocabulary))
        end = np.array([end_id], "<u4").tobytes()
        for b in batches:
            for i in range(0, len(b), BATCH):
                part = b.slice(i, BATCH)
                raw = [e.encode(t) + end for t in part.column(1).to_pylist()]
                off = np.concatenate(([0], np.cumsum([len(r) // 4 for r in raw]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(off), pa.array(np.frombuffer(b"".join(raw), "<i4")))], ["doc_id", "ids"])
    return rows


def write_token_ids(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = DEFAULT_VOCABULARY, end_id: int = END_ID) -> None:
    """Write (doc_id, ids) in ascending id order under ``path``; ``end_id`` closes each document."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id").mapInArrow(encode_rows(vocabulary, end_id), "doc_id bigint, ids array<int>")
    (rows.write.option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01").option("orc.create.index", "true")
     .option("orc.row.index.stride", "1000").option("orc.compress", "ZSTD").orc(path))


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids = b.column("ids")
        off, values = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False).astype("<u4")
        crc = [zlib.crc32(values[s:e].tobytes()) for s, e in zip(off[:-1], off[1:])]
        yield pa.RecordBatch.from_arrays([b.column("file"), b.column("doc_id"), pa.array(np.diff(off).astype(np.int64)), pa.array(crc, pa.int64())], ["file", "doc_id", "n_tokens", "ids_crc32"])


def read_token_index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files under ``path``."""
    ship(spark)
    rows = spark.read.schema("doc_id bigint, ids array<int>").orc(path).select(F.col("_metadata.file_name").alias("file"), "doc_id", "ids")
    rows = stored(rows.mapInArrow(_summaries, "file string, doc_id bigint, n_tokens bigint, ids_crc32 bigint"), "index")
    files = rows.groupBy("file").agg(F.sum("n_tokens").alias("total"), F.min("doc_id").alias("low"))
    before = Window.orderBy(F.asc_nulls_first("low"), "file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = files.select("file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("file").orderBy(F.asc_nulls_first("doc_id"), "ids_crc32", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return rows.join(files, "file").select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
