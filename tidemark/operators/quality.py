"""Accounting of rows, invariants of histories, comparison of tables, canonical digests."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import instant_us
from tidemark.operators.timeline import CHUNK_ROWS, Chunks, following


def row_accounting(classified: DataFrame, key: str = "event_id", reason: str = "quarantine_reason", rescue: str = "_rescued_data") -> DataFrame:
    """(delivered, without_id, distinct_ids, repeated, accepted, quarantined, rescued) of a classified log; rescued are rows
    of which something didn't fit the declared columns.

    delivered = without_id + distinct_ids + repeated and delivered = accepted + quarantined always hold.
    """
    per = classified.groupBy(key).agg(F.count("*").alias("n"), F.count_if(F.col(reason) == "accepted").alias("ok"), F.count(rescue).alias("rs"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    return per.agg(
        zero(F.sum("n")).alias("delivered"),
        zero(F.sum(F.when(F.col(key).isNull(), F.col("n")))).alias("without_id"),
        F.count(key).alias("distinct_ids"),
        zero(F.sum(F.when(F.col(key).isNotNull(), F.col("n") - 1))).alias("repeated"),
        zero(F.sum("ok")).alias("accepted"),
        zero(F.sum(F.col("n") - F.col("ok"))).alias("quarantined"),
        zero(F.sum("rs")).alias("rescued"),
    )


def conserved(accounting: dict[str, int]) -> bool:
    a = accounting
    return a["delivered"] == a["without_id"] + a["distinct_ids"] + a["repeated"] == a["accepted"] + a["quarantined"]


def copies(df: DataFrame, key: str) -> DataFrame:
    """(key, copies): the multiset of a key."""
    return df.groupBy(key).agg(F.count("*").alias("copies"))


def history_violations(dim: DataFrame, key: str = "customer_id", start: str = "valid_from", end: str = "valid_to", current: str = "is_current", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(key, violation) of a history of versions: several open rows, gaps or overlaps, empty periods, wrong flags.

    start and end are readable times as text. Open rows are counted in a grouping; for the next version the timeline
    of a heavy key is cut into chunks.
    """
    rows = dim.withColumns({"_from_us": instant_us(F.col(start)), "_row": F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (start, end)])})
    chunks = Chunks.of(rows, key, "_from_us", chunk_rows, F.col("_row").cast("string"))
    rows = following(chunks.add(rows), chunks, F.struct(F.col(start).alias("s")), "_following").withColumn("_next", F.col("_following.s"))
    open_ = dim.groupBy(key).agg(F.count_if(F.col(end).isNull()).alias("_open")).where(F.col("_open") != 1)
    faults = F.array_compact(
        F.array(
            F.when(F.col("_next").isNotNull() & ~F.col(end).eqNullSafe(F.col("_next")), F.lit("gap_or_overlap")),
            F.when(F.col(end) <= F.col(start), F.lit("empty_period")),
            F.when(~F.col(current).eqNullSafe(F.col(end).isNull()), F.lit("wrong_flag")),
        )
    )
    several = open_.select(key, F.lit("not_one_open_version").alias("violation"))
    return rows.select(key, F.explode(faults).alias("violation")).distinct().unionByName(several)


def history_shape(dim: DataFrame, key: str = "customer_id", start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """(versions, entities, open_versions, closed_versions, first_start, last_start)."""
    return dim.agg(
        F.count("*").alias("versions"), F.count_distinct(key).alias("entities"), F.count_if(F.col(end).isNull()).alias("open_versions"),
        F.count_if(F.col(end).isNotNull()).alias("closed_versions"), F.min(start).alias("first_start"), F.max(start).alias("last_start"),
    )


def parity(a: DataFrame, b: DataFrame) -> DataFrame:
    """(columns..., only_in, copies): multiset difference of two tables with the same columns, in one aggregation."""
    both = a.withColumn("_n", F.lit(1)).unionByName(b.withColumn("_n", F.lit(-1)))
    diff = both.groupBy(*a.columns).agg(F.sum("_n").alias("_n")).where(F.col("_n") != 0)
    return diff.select(*a.columns, F.when(F.col("_n") > 0, "a").otherwise("b").alias("only_in"), F.abs("_n").cast("bigint").alias("copies"))


#: Tags of the canonical encoding, by type. Fixed values.
TAGS = {bool: "b", int: "i", Decimal: "d", float: "f", datetime: "t", date: "D", bytes: "x", str: "s"}


def encoded(value: object) -> str:
    """<tag>:<bytes>:<text> of a value; null is n:0:. Distinct values never share an encoding, equal ones always do.

    Decimals lose trailing zeros, negative zero its sign; what is no number is refused, as it isn't equal to itself.
    """
    if value is None:
        return "n:0:"
    if isinstance(value, float | Decimal):
        if not (math.isfinite(value) if isinstance(value, float) else value.is_finite()):
            raise ValueError(f"{value} has no canonical encoding")
        value = value + 0 if value else abs(value)
    if isinstance(value, Decimal):
        sign, digits, _ = value.normalize().as_tuple()
        value = format(value.normalize(), "f") if digits != (0,) else "0"
        return f"d:{len(value)}:{value}"
    text = value.hex() if isinstance(value, bytes | float) else value.isoformat() if isinstance(value, date | datetime) else str(value)
    return f"{TAGS[type(value)]}:{len(text.encode())}:{text}"


def digest(rows: Iterable[Iterable[object]]) -> str:
    """128 bits over the sorted encodings of rows: equal for equal multisets. For small results on the driver."""
    h = hashlib.blake2b(digest_size=16)
    for line in sorted("".join(encoded(v) for v in row) for row in rows):
        h.update(line.encode() + b"\n")
    return h.hexdigest()
