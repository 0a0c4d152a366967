"""One copy of each message, by a total order of its copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def copy_rank(event_us: Column, arrival_us: Column, payload: list[str]) -> Column:
    """Order of copies: instant of the event, instant of arrival, unreadable or null ones last; then the values.

    Each key is led by its null flag, as a minimum of structs puts null first. The values make the order total, so that
    copies with equal instants give the same kept copy on any partitioning.
    """
    values = [F.struct(F.col(c).isNull(), F.col(c)).alias(c) for c in payload]
    return F.struct(event_us.isNull().alias("_ne"), event_us.alias("_event_us"), arrival_us.isNull().alias("_na"), arrival_us.alias("_arrival_us"), *values)


def kept_copies(events: DataFrame, key: str, event_us: Column, arrival_us: Column, columns: list[str], count: bool = False) -> DataFrame:
    """(key, event_us, arrival_us, columns...[, copies]): the kept copy of each key; rows without key are no message.

    A minimum of structs is combined before the shuffle, so a key with very many copies sends one row per map task.
    """
    rank = copy_rank(event_us, arrival_us, columns)
    aggregates = [F.min("_r").alias("_r")] + ([F.count("*").alias("copies")] if count else [])
    best = events.where(F.col(key).isNotNull()).select(key, rank.alias("_r")).groupBy(key).agg(*aggregates)
    out = [F.col("_r._event_us").alias("event_us"), F.col("_r._arrival_us").alias("arrival_us"), *[F.col(f"_r.{c}.{c}").alias(c) for c in columns]]
    return best.select(key, *out, *(["copies"] if count else []))
