"""A history kept up by a stream of changes: each micro-batch is a load of insert-only satellites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from tidemark.operators.satellites import SatelliteStore


def follow(changes: DataFrame, store: SatelliteStore, moment_us: Column, version: Column, checkpoint: str) -> None:
    """Takes in all changes there are. A micro-batch that is replayed finds its rows stored and appends none to the
    satellites, so the history is the same however often the stream breaks off."""

    def load(batch: DataFrame, n: int) -> None:
        store.load(batch, moment_us, version)

    changes.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
