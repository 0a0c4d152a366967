"""Streams of the event log: classified into two tables, safe to replay, with the sound repeats left to the gold layer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.crash import barrier
from tidemark.functions.times import instant
from tidemark.operators.quarantine import ACCEPTED, classify
from tidemark.sources.bronze import INGESTORS, IngestSpec

#: Folders of a batch by table; every row of the log lies in exactly one of them.
SILVER, QUARANTINE = "silver", "quarantine"


def write_batch(root: str, idempotent: bool = True) -> Callable[[DataFrame, int], None]:
    """Writer of one micro-batch, in one pass: accepted rows into batches/<n>/table=silver, the others, with their
    reason, into batches/<n>/table=quarantine.

    A replayed batch replaces its own folder, so it counts once. With idempotent=False all batches share a folder that
    is appended to, which is the negative control: a replay then counts twice.
    """

    def run(batch: DataFrame, n: int) -> None:
        tagged = classify(batch)
        placed = tagged.withColumn("table", F.when(F.col("quarantine_reason") == ACCEPTED, SILVER).otherwise(QUARANTINE))
        folder, mode = (f"{n:09d}", "overwrite") if idempotent else ("all", "append")
        barrier("before_write")
        placed.write.mode(mode).partitionBy("table").parquet(f"{root}/batches/{folder}")
        barrier("after_write")

    return run


def start(spark: SparkSession, spec: IngestSpec, root: str, *, ingestor: str = "jsonl", idempotent: bool = True) -> StreamingQuery:
    """Starts a stream of all files there are (availableNow), with its checkpoint below root."""
    stream = INGESTORS[ingestor].stream(spark, spec)
    return stream.writeStream.foreachBatch(write_batch(root, idempotent)).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()


def ingest(spark: SparkSession, spec: IngestSpec, root: str, **how) -> None:
    start(spark, spec, root, **how).awaitTermination()


def written(spark: SparkSession, root: str, table: str | None = None) -> DataFrame:
    """Rows of one table, or of both; which one a row is in follows from its folder."""
    rows = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/batches")
    rows = rows.withColumn("table", F.regexp_extract(F.col("_metadata.file_path"), "/table=([a-z]+)/", 1))
    return rows.where(F.col("table") == table).drop("table") if table else rows


def silver(spark: SparkSession, root: str) -> DataFrame:
    return written(spark, root, SILVER)


def reconciled(spark: SparkSession, root: str, lines: int) -> dict[str, int]:
    """Rows of silver and quarantine, held against the lines that came in; raises where one was lost or doubled."""
    counts = {r["table"]: r["count"] for r in written(spark, root).groupBy("table").count().collect()}
    out = {t: counts.get(t, 0) for t in (SILVER, QUARANTINE)}
    if sum(out.values()) != lines:
        raise ValueError(f"{lines} lines came in, {out} were written")
    return out


def append_stream(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Appends all there is of a stream to a folder of Parquet by the file sink, which commits each batch once."""
    stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path).awaitTermination()


def deduplicated_stream(stream: DataFrame, key: str = "event_id", arrival: str = "arrival_ts", delay: str = "2 hours") -> DataFrame:
    """An experiment: repeats within a watermark on arrival are dropped in the stream, later ones escape."""
    return stream.withColumn("_at", instant(F.col(arrival))).where(F.col("_at").isNotNull()).withWatermark("_at", delay).dropDuplicatesWithinWatermark([key]).drop("_at")
