"""Windows over the timeline of a key that hold when one key has a third of all rows.

A window partitioned by a key puts all rows of that key into one task. Here the timelines of heavy keys are first cut
into chunks of like size; windows run by (key, chunk), and what must pass from one chunk to the next (last known
values, running maxima, the neighbouring row) is carried over by a table with one row per chunk. A cut lies between
two rows in the order of (order, tie), so rows of one instant are spread too where a tie tells them apart.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of one key that one task may sort.
CHUNK_ROWS = 500_000
#: Chunks of all heavy keys together: with more rows than CHUNK_ROWS * MOST_CHUNKS the chunks get larger instead, so
#: that at 10^12 rows a task sorts 5 * 10^7 of them, with spilling. The tables of cuts and of what is carried, which go
#: to all tasks, have at most 2 * MOST_CHUNKS rows.
MOST_CHUNKS = 20_000
#: Rows of a chunk that its cuts are chosen from, on the driver: at most PER_CHUNK * MOST_CHUNKS in all. Which ones
#: they are changes the sizes of chunks, never a result.
PER_CHUNK = 16


class Chunks:
    """Cuts of the heavy keys of a timeline. order is a BIGINT column (microseconds), tie a text expression or None.

    The windows' order must begin with order and go on with what tie orders by; a null order comes first.
    """

    def __init__(self, key: str, order: str, cuts: DataFrame | None, tie: Column | None = None):
        self.key, self.order, self.cuts, self.tie = key, order, cuts, F.lit("") if tie is None else tie

    @classmethod
    def of(cls, df: DataFrame, key: str, order: str, chunk_rows: int = CHUNK_ROWS, tie: Column | None = None) -> Chunks:
        """Counts rows by key (combined before the shuffle); cuts are computed for heavy keys only.

        A heavy key has more than chunk_rows and more than total / MOST_CHUNKS rows, so there are fewer than
        MOST_CHUNKS of them, and their chunks, one for each such number of rows and one more a key, are bounded alike.
        """
        counts = df.select(F.col(key).alias("_k")).groupBy("_k").agg(F.count("*").alias("_n")).where(F.col("_k").isNotNull() & (F.col("_n") > chunk_rows))
        most = counts.agg(F.sum("_n").alias("total")).first()
        if not most["total"]:
            return cls(key, order, None, tie)
        each = max(chunk_rows, most["total"] // MOST_CHUNKS)
        heavy = {r["_k"]: r["_n"] // each + 1 for r in counts.where(F.col("_n") > each).collect()}
        if not heavy:
            return cls(key, order, None, tie)
        spark, kind = df.sparkSession, df.schema[key].dataType.simpleString()
        names = F.broadcast(spark.createDataFrame([(k,) for k in heavy], f"_k {kind}"))
        rows = df.join(names, df[key] == F.col("_k")).select("_k", F.col(order).alias("o"), (F.lit("") if tie is None else tie).alias("t"))
        chosen: dict[object, list[tuple[int, str]]] = {}
        for r in rows.where(F.col("o").isNotNull()).sample(min(1.0, PER_CHUNK / each), 1).collect():
            chosen.setdefault(r["_k"], []).append((r["o"], r["t"] or ""))
        table = []
        for k, places in chosen.items():
            places.sort()
            cuts = sorted({places[i * len(places) // heavy[k]] for i in range(1, heavy[k])})
            step = max(1, math.isqrt(len(cuts)))
            table.append((k, step, [cuts[i : i + step] for i in range(0, len(cuts), step)]))
        return cls(key, order, spark.createDataFrame(table, f"_k {kind}, _cut_step int, _cuts array<array<struct<o: bigint, t: string>>>"), tie)

    def add(self, df: DataFrame) -> DataFrame:
        """df with _chunk: 0 for rows of ordinary keys, else the number of cuts at or before the row.

        The cuts lie in groups, so that a row is compared with about twice the root of their number.
        """
        if self.cuts is None:
            return df.withColumn("_chunk", F.lit(0))
        at = F.struct(F.col(self.order).alias("o"), self.tie.alias("t"))
        joined = df.withColumn("_cut_at", at).join(F.broadcast(self.cuts), df[self.key] == F.col("_k"), "left")
        group = F.size(F.filter("_cuts", lambda g: g[0] <= F.col("_cut_at")))
        within = F.size(F.filter(F.element_at("_cuts", F.greatest(F.col("_cut_group"), F.lit(1))), lambda c: c <= F.col("_cut_at")))
        chunk = F.when(F.coalesce(F.col("_cut_group"), F.lit(0)) < 1, 0).otherwise((F.col("_cut_group") - 1) * F.col("_cut_step") + within)
        return joined.withColumn("_cut_group", F.when(F.col("_cuts").isNotNull(), group)).withColumn("_chunk", chunk).drop("_k", "_cut_step", "_cuts", "_cut_at", "_cut_group")

    def window(self) -> Window:
        """All rows of one key in one chunk."""
        return Window.partitionBy(self.key, "_chunk")

    def carry(self, df: DataFrame, summary: dict[str, Column], onward: dict[str, Column]) -> DataFrame:
        """df with, for each chunk, the onward values over the earlier chunks' summaries (null where there are none).

        summary: aggregates by chunk. onward: window expressions over the summaries; Chunks.before() is the frame.
        """
        if self.cuts is None:
            return df.withColumns({n: F.lit(None).cast(_type(df, summary[n])) for n in onward})
        heavy = self.cuts.select(F.col("_k").alias("_hk"))
        per_chunk = df.join(F.broadcast(heavy), df[self.key] == F.col("_hk"), "left_semi").groupBy(self.key, "_chunk").agg(*[c.alias(n) for n, c in summary.items()])
        carried = per_chunk.select(F.col(self.key).alias("_ck"), F.col("_chunk").alias("_cc"), *[c.alias(f"_on_{n}") for n, c in onward.items()])
        out = df.join(F.broadcast(carried), (df[self.key] == F.col("_ck")) & (df["_chunk"] == F.col("_cc")), "left")
        return out.withColumns({n: F.col(f"_on_{n}") for n in onward}).drop("_ck", "_cc", *[f"_on_{n}" for n in onward])

    def before(self) -> Window:
        """Over chunk summaries: all earlier chunks of the key."""
        return Window.partitionBy(self.key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)

    def after(self) -> Window:
        """Over chunk summaries: all later chunks of the key."""
        return Window.partitionBy(self.key).orderBy("_chunk").rowsBetween(1, Window.unboundedFollowing)


def _type(df: DataFrame, aggregate: Column) -> str:
    return df.limit(0).agg(aggregate.alias("x")).schema["x"].dataType.simpleString()


def previous(df: DataFrame, chunks: Chunks, value: Column, name: str) -> DataFrame:
    """df with the value of the row before, by key and order; value must not be null (wrap nullable values in a struct)."""
    df = df.withColumn("_v", value)
    w = chunks.window().orderBy(chunks.order)
    df = chunks.carry(df, {"_carry": F.max_by("_v", chunks.order)}, {"_carry": F.last("_carry", True).over(chunks.before())})
    return df.withColumn(name, F.coalesce(F.lag("_v").over(w), F.col("_carry"))).drop("_v", "_carry")


def following(df: DataFrame, chunks: Chunks, value: Column, name: str) -> DataFrame:
    """df with the value of the row after, by key and order; value must not be null."""
    df = df.withColumn("_v", value)
    w = chunks.window().orderBy(chunks.order)
    df = chunks.carry(df, {"_carry": F.min_by("_v", chunks.order)}, {"_carry": F.first("_carry", True).over(chunks.after())})
    return df.withColumn(name, F.coalesce(F.lead("_v").over(w), F.col("_carry"))).drop("_v", "_carry")


def last_known(df: DataFrame, chunks: Chunks, columns: list[str], order: list[Column]) -> DataFrame:
    """df with each column replaced by its last value that isn't null, up to and including the row.

    order breaks ties of chunks.order; its first column must be chunks.order.
    """
    w = chunks.window().orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rank = F.struct(*order)
    df = chunks.carry(
        df,
        {f"_c_{c}": F.max_by(F.col(c), F.when(F.col(c).isNotNull(), rank)) for c in columns},
        {f"_c_{c}": F.last(f"_c_{c}", True).over(chunks.before()) for c in columns},
    )
    return df.withColumns({c: F.coalesce(F.last(c, True).over(w), F.col(f"_c_{c}")) for c in columns}).drop(*[f"_c_{c}" for c in columns])


def running_extreme(df: DataFrame, chunks: Chunks, value: str, order: list[Column], name: str, *, least: bool = False, before: bool = False) -> DataFrame:
    """df with the greatest (least) value so far, by key and order: up to and including the row, or before it."""
    of, pick = (F.min, F.least) if least else (F.max, F.greatest)
    w = chunks.window().orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if before else Window.currentRow)
    df = chunks.carry(df, {"_carry": of(value)}, {"_carry": of("_carry").over(chunks.before())})
    return df.withColumn(name, pick(of(value).over(w), F.col("_carry"))).drop("_carry")


def running_sum(df: DataFrame, chunks: Chunks, value: str, order: list[Column], name: str) -> DataFrame:
    """df with the sum of a BIGINT column so far, by key and order, up to and including the row."""
    w = chunks.window().orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = chunks.carry(df, {"_carry": F.sum(value)}, {"_carry": F.sum("_carry").over(chunks.before())})
    return df.withColumn(name, F.sum(value).over(w) + F.coalesce("_carry", F.lit(0))).drop("_carry")
