"""Row hashes that tell null from every value, and fingerprints that don't depend on row order."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_hash(columns: Iterable[Column], seed: int = 0) -> Column:
    """64 bits of a row. xxhash64 alone skips nulls, so each value is followed by whether it is null."""
    parts: list[Column] = [F.lit(seed)]
    for c in columns:
        parts += [c, c.isNull()]
    return F.xxhash64(*parts)


def payload_digest(columns: Iterable[Column]) -> Column:
    """SHA-256 of a row's values as text, 0x1f between them, nulls as NUL: equal payloads in any engine, 256 bits of them."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(c.cast("string"), F.lit("\x00")) for c in columns]), 256)


def fingerprint(df: DataFrame) -> DataFrame:
    """One row (row_count, sum_hash, xor_hash) that is equal for equal multisets of rows, in any order and partitioning."""
    h = row_hash([F.col(f"`{c}`") for c in df.columns])
    return df.select(h.alias("_h")).agg(
        F.count("*").alias("row_count"),
        F.coalesce(F.sum(F.col("_h").bitwiseAND(F.lit(0xFFFFFFFF))), F.lit(0)).alias("sum_hash"),
        F.coalesce(F.bit_xor("_h"), F.lit(0)).alias("xor_hash"),
    )


def ordered_fingerprint(df: DataFrame, columns: list[str], at_most: int | None = None) -> DataFrame:
    """SHA-256 over the sorted text lines of all rows, nulls written as chr(0).

    The lines are hashed first; the hashes form a tree by prefixes of three digits, so deep that a leaf holds some
    4,096 of them, and each node hashes its sorted children. So no task holds more than some thousand digests; equal
    lines are one digest with their number. The depth follows from the number of different lines, up to 2^24 it is 1;
    they are counted unless at_most, a bound of them, says so.
    """
    line = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns])
    level = df.select(F.sha2(line, 256).alias("_p")).groupBy("_p").agg(F.count("*").alias("_n")).withColumn("_d", F.col("_n").cast("string"))
    depth = 1
    if at_most is None or at_most > 4096**2:
        different = level.count()
        while 4096 ** (depth + 1) < different:
            depth += 1
    for d in range(depth, -1, -1):
        node = F.sha2(F.concat_ws("\n", F.sort_array(F.collect_list(F.concat_ws(":", "_p", "_d")))), 256).alias("_d")
        level = level.groupBy(F.substring("_p", 1, 3 * d).alias("_p")).agg(node, F.sum("_n").alias("_n"))
    none = F.sha2(F.lit(""), 256)
    return level.agg(F.coalesce(F.max("_d"), none).alias("digest"), F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("row_count"))


def text_fingerprint(df: DataFrame, columns: list[str]) -> DataFrame:
    """(row_count, sum_hash): a sum over 60 bits of the MD5 of each row's text, equal for equal multisets of rows; any
    engine that has MD5 can compute it too. Nulls are written as chr(0)."""
    line = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns])
    part = F.conv(F.substring(F.md5(line), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("row_count"), F.coalesce(F.sum(part), F.lit(0)).cast("decimal(38,0)").cast("string").alias("sum_hash"))
