"""Attributes as known at event time, from one change history per attribute.

An update is known from the later of its valid_from and its first arrival. Going through a customer's updates by that
instant, the one that stands is the one with the greatest (valid_from, version) so far; so "latest valid_from among
what was known" is a running maximum, and each attribute gets its own history (known_from, value) with a row only where
the value that stands changes. Events are matched with each history on its own, by the last row known, and the matched
values are pivoted back to one row per event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.timeline import CHUNK_ROWS, Chunks, last_known, previous, running_extreme


def first_arrivals(updates: DataFrame, key: str, valid_us: Column, arrival_us: Column, version: str, attributes: list[str]) -> DataFrame:
    """(key, valid_us, known_us, version, attributes...): one row per update, known from its first arrival on.

    Updates without key, valid_from or any readable arrival are never known. Copies combine before the shuffle.
    """
    rows = updates.select(key, valid_us.alias("valid_us"), arrival_us.alias("_arrival"), version, *attributes).where(F.col(key).isNotNull() & F.col("valid_us").isNotNull())
    once = rows.groupBy(key, "valid_us", version, *attributes).agg(F.min("_arrival").alias("_arrival")).where(F.col("_arrival").isNotNull())
    return once.withColumn("known_us", F.greatest("valid_us", "_arrival")).drop("_arrival")


def attribute_history(known: DataFrame, key: str, version: str, attribute: str, chunks: Chunks) -> DataFrame:
    """(key, at_us, value): the history of one attribute by the instant from which it was known; value is a struct, as
    null is a value. A row stands only where the value changes.

    chunks must be cut over a column named at_us. Of updates with equal valid_us and version the greatest value counts.
    """
    rank = F.struct("valid_us", F.col(version).isNotNull(), F.col(version).alias("_version"), F.col(attribute).isNotNull(), F.col(attribute).alias("_value"))
    rows = known.select(key, F.col("known_us").alias("at_us"), F.lit(0).alias("_kind"), F.lit(None).cast("string").alias("_event"), rank.alias("_update"))
    rows = chunks.add(rows).repartition(key, "_chunk")
    # Updates known at one instant act together: the greatest of them.
    rows = rows.groupBy(key, "_chunk", "at_us").agg(F.max("_update").alias("_update"))
    standing = running_extreme(rows, chunks, "_update", [F.col("at_us")], "_standing")
    h = previous(standing.select(key, "at_us", "_chunk", F.struct(F.col("_standing._value").alias("value")).alias("value")), chunks, F.col("value"), "_before")
    return h.where(F.col("_before").isNull() | ~F.col("_before.value").eqNullSafe(F.col("value.value"))).select(key, "at_us", "value")


def matched(events: DataFrame, key: str, event: str, at_us: str, history: DataFrame, chunks: Chunks) -> DataFrame:
    """(key, event, value) of the events for which a row of the history was known: the last one at or before the event.

    A history that changes at the very instant of an event counts for it. event is a text that tells events apart.
    """
    kind = history.schema["value"].dataType
    left = events.select(key, F.col(at_us).alias("at_us"), F.lit(1).alias("_kind"), F.col(event).alias("_event"), F.lit(None).cast(kind).alias("value"))
    right = history.select(key, "at_us", F.lit(0).alias("_kind"), F.lit(None).cast("string").alias("_event"), "value")
    filled = last_known(chunks.add(left.unionByName(right)), chunks, ["value"], [F.col("at_us"), F.col("_kind"), F.col("_event")])
    return filled.where((F.col("_kind") == 1) & F.col("value").isNotNull()).select(key, F.col("_event").alias(event), "value")


def _tie() -> Column:
    """Orders a timeline's rows of one instant: histories before events, then events by their text."""
    return F.concat(F.col("_kind").cast("string"), F.coalesce("_event", F.lit("")))


def timeline_chunks(events: DataFrame, updates: DataFrame, key: str, event: str, event_us: Column, known_us: Column, chunk_rows: int = CHUNK_ROWS) -> Chunks:
    """Chunks for matching: events and updates of a key count together."""
    left = events.select(key, event_us.alias("at_us"), F.lit(1).alias("_kind"), F.col(event).alias("_event"))
    right = updates.select(key, known_us.alias("at_us"), F.lit(0).alias("_kind"), F.lit(None).cast("string").alias("_event"))
    return Chunks.of(left.unionByName(right), key, "at_us", chunk_rows, _tie())


def as_known_at(events: DataFrame, key: str, event: str, at_us: str, histories: dict[str, DataFrame], chunks: Chunks) -> DataFrame:
    """(key, event, known_<attribute>...) of the events that anything was known for: one match per history, pivoted by event.

    event tells events apart. Each history is matched on its own, so histories may change asynchronously.
    """
    types = {n: h.schema["value"].dataType for n, h in histories.items()}
    long = None
    for name, h in histories.items():
        got = matched(events, key, event, at_us, h, chunks)
        part = got.select(key, event, *[(F.col("value") if n == name else F.lit(None).cast(t)).alias(n) for n, t in types.items()])
        long = part if long is None else long.unionByName(part)
    return long.groupBy(key, event).agg(*[F.max(F.col(n)).alias(n) for n in types]).select(key, event, *[F.col(f"{n}.value").alias(f"known_{n}") for n in types])
