"""Append-only state of a streaming refresh.

Every micro-batch writes what it adds to a folder of its own per table (``<table>/batch_id=N``) and,
once all of its folders are complete, a commit row. A batch that runs again overwrites its own folders, so
replays change nothing; readers see committed batches only. ``compact`` folds the committed batches into
one base, after which reads touch the base and the batches since.

The state belongs to one stream: its id is written beside the state and into the checkpoint. A checkpoint
without that id (a new or a foreign one would number its batches from 0 again and drop or overwrite rows) is refused.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featurepipe.sources.tables import read_or_empty

Fold = Callable[[DataFrame], DataFrame]


class ForeignCheckpoint(RuntimeError):
    """The checkpoint is not the one that the state was built from."""


class BatchLog:
    def __init__(self, spark: SparkSession, root: str, tables: Mapping[str, str]):
        """``tables``: schema of each table, without ``batch_id``."""
        self.spark, self.root, self.tables = spark, root.rstrip("/"), dict(tables)

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint"

    def claim(self) -> str:
        """The stream's id: a new state and a new checkpoint get one; otherwise both must have the same."""
        schema = "stream_id string"
        state, owner = (read_or_empty(self.spark, f"{p}/owner", schema).first() for p in (self.root, self.checkpoint))
        if state is None and owner is None:
            row = self.spark.createDataFrame([(uuid.uuid4().hex,)], schema).coalesce(1)
            row.write.parquet(f"{self.checkpoint}/owner")
            self.spark.read.parquet(f"{self.checkpoint}/owner").write.parquet(f"{self.root}/owner")
            return self.claim()
        if state is None or owner is None or state.stream_id != owner.stream_id:
            raise ForeignCheckpoint(f"the state at {self.root} belongs to stream {state and state.stream_id}, the checkpoint to {owner and owner.stream_id}: restore the checkpoint, or start with a new state")
        return state.stream_id

    def append(self, table: str, batch_id: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/{table}/batch_id={batch_id}")

    def commit(self, batch_id: int) -> None:
        row = self.spark.createDataFrame([(batch_id,)], "committed bigint").coalesce(1)
        row.write.mode("overwrite").parquet(f"{self.root}/commits/batch_id={batch_id}")

    def last(self) -> int:
        """The last committed batch, -1 before the first."""
        top = read_or_empty(self.spark, f"{self.root}/commits", "committed bigint, batch_id bigint").agg(F.max("committed")).first()[0]
        return -1 if top is None else top

    def base(self) -> int:
        """The batch up to which the state is folded into a base, -1 without one."""
        top = read_or_empty(self.spark, f"{self.root}/bases", "upto bigint").agg(F.max("upto")).first()[0]
        return -1 if top is None else top

    def read(self, table: str, before: int | None = None) -> DataFrame:
        """What the committed batches (those before ``before``) added, with ``batch_id``: the base and the folders since."""
        schema = f"{self.tables[table]}, batch_id bigint"
        base, last = self.base(), self.last()
        if before is not None:
            last = min(last, before - 1)
        rows = read_or_empty(self.spark, f"{self.root}/{table}", schema).where((F.col("batch_id") > base) & (F.col("batch_id") <= last))
        return rows if base < 0 else rows.unionByName(self.spark.read.schema(schema).parquet(f"{self.root}/base/upto={base}/{table}"))

    def compact(self, folds: Mapping[str, Fold]) -> int:
        """Fold every table into a new base and empty the folders it replaces; the batch up to which it holds.

        ``folds`` turns a table's rows into fewer rows of the same schema. The new base counts once its row in ``bases``
        is written; until then readers use the old one. Do not compact while the stream runs or a reader holds an older frame.
        """
        old, upto = self.base(), self.last()
        if upto <= old:
            return old
        for table, fold in folds.items():
            fold(self.read(table)).select(*[c.split(" ")[0] for c in self.tables[table].split(", ")], F.lit(upto).cast("bigint").alias("batch_id")).write.mode("overwrite").parquet(f"{self.root}/base/upto={upto}/{table}")
        self.spark.createDataFrame([(upto,)], "upto bigint").coalesce(1).write.mode("append").parquet(f"{self.root}/bases")
        for table in folds:
            for k in range(old + 1, upto + 1):
                self.spark.createDataFrame([], self.tables[table]).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/{table}/batch_id={k}")
        return upto

    def run(self, stream: DataFrame, work: Callable[[DataFrame, int], None], processing_time: str | None = None):
        """Start ``work`` on every micro-batch, committed after it; without ``processing_time`` it ends when the input is used up."""
        self.claim()

        def step(batch: DataFrame, batch_id: int) -> None:
            work(batch, batch_id)
            self.commit(batch_id)

        w = stream.writeStream.foreachBatch(step).option("checkpointLocation", self.checkpoint)
        return (w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)).start()


def merged_moments(parts: DataFrame, keys: list[str], **others) -> DataFrame:
    """``n_amt``, ``mean_amt`` and ``m2_amt`` (count, mean, sum of squared deviations) of parts merged per key around one value of it (Chan); ``others`` are aggregates."""
    shifted = parts.withColumn("_s", F.min("mean_amt").over(Window.partitionBy(*keys)))
    c, d = F.col("n_amt"), F.col("mean_amt") - F.col("_s")
    a = F.coalesce(F.sum(c * d), F.lit(0.0))
    total = F.sum("n_amt")
    return shifted.groupBy(*keys).agg(
        total.alias("n_amt"),
        (F.min("_s") + F.try_divide(a, total)).alias("mean_amt"),
        (F.sum("m2_amt") + F.coalesce(F.sum(c * d * d), F.lit(0.0)) - F.coalesce(F.try_divide(a * a, total), F.lit(0.0))).alias("m2_amt"),
        *[v.alias(k) for k, v in others.items()])
