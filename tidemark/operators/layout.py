"""Layout of files: statistics, skipping, clustering, partition profiles, and the freshness of what lies in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def file_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """(file, size, rows, min_<c>, max_<c>, nulls_<c>...) of the files a frame is read from."""
    return df.groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")).agg(F.count("*").alias("rows"), *[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max), ("nulls", lambda c: F.count_if(F.col(c).isNull())))])


def not_skippable(stats: DataFrame, column: str, value: object) -> DataFrame:
    """(files, files_read, bytes, bytes_read): what an equality on the column can't skip by minimum and maximum."""
    read = (F.col(f"min_{column}") <= F.lit(value)) & (F.col(f"max_{column}") >= F.lit(value))
    return stats.agg(F.count("*").alias("files"), F.count_if(read).alias("files_read"), F.sum("size").alias("bytes"), F.coalesce(F.sum(F.when(read, F.col("size"))), F.lit(0)).alias("bytes_read"))


def z_key(columns: list[Column], bits: int = 16) -> Column:
    """Bits of several columns (integers below 2^bits) interleaved: near in all columns, near in the key."""
    z = F.lit(0).cast("bigint")
    for b in range(bits):
        for i, c in enumerate(columns):
            bit = F.shiftright(c.cast("bigint"), b).bitwiseAND(F.lit(1))
            z = z.bitwiseOR(F.call_function("shiftleft", bit, F.lit(b * len(columns) + i)))
    return z


def buckets(df: DataFrame, column: str, bits: int) -> Column:
    """Place of a value among the quantiles of its column, from 0 to 2^bits - 1; quantiles come from one approximate
    aggregate. A column of few values is spread over the same range, so that it weighs as much as any other in a z-key."""
    n = 2**bits
    cuts = sorted(set(df.agg(F.percentile_approx(column, [i / n for i in range(1, n)], 10_000)).first()[0] or []))
    if not cuts:
        return F.lit(0)
    place = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col(column)))
    return F.floor(place * (n - 1) / len(cuts)).cast("int")


def clustered(df: DataFrame, columns: list[str], files: int, bits: int = 6) -> DataFrame:
    """df range-partitioned and sorted by the z-key of columns, ready to be written as `files` files."""
    z = df.withColumn("_z", z_key([buckets(df, c, bits) for c in columns], bits))
    return z.repartitionByRange(files, "_z").sortWithinPartitions("_z").drop("_z")


def partition_profile(df: DataFrame) -> DataFrame:
    """(partitions, rows, largest, skew): rows by physical partition; skew is largest / mean, in thousandths."""
    per = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"))
    return per.agg(F.count("*").alias("partitions"), F.sum("n").alias("rows"), F.max("n").alias("largest"), (F.max("n") * 1000 / F.avg("n")).cast("bigint").alias("skew"))


def salted_join(fact: DataFrame, dim: DataFrame, key: str, salts: int) -> DataFrame:
    """Inner join in which rows of one key are spread over `salts` tasks; the dimension is repeated for each salt."""
    left = fact.withColumn("_salt", F.pmod(F.xxhash64(*fact.columns), F.lit(salts)))
    right = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    return left.join(right, [key, "_salt"]).drop("_salt")


def skewed_fact(spark: SparkSession, rows: int, hot_share: float = 0.3, keys: int = 1000) -> DataFrame:
    """A synthetic fact table in which one key holds a share of all rows."""
    limit = int(hot_share * 1000)
    hot = F.pmod(F.col("id") * 2_654_435_761, F.lit(1000)) < limit
    return spark.range(rows).select("id", F.when(hot, F.lit(0)).otherwise(1 + F.pmod("id", F.lit(keys))).alias("k"), (F.col("id") % 97).alias("amount_cents"))


def freshness(df: DataFrame, arrival_us: Column, now_us: int, sla_minutes: int) -> DataFrame:
    """(last_arrival_us, lag_seconds, breach): no_data, ingestion_lag or none."""
    got = df.agg(F.max(arrival_us).alias("last_arrival_us"))
    lag = F.floor((F.lit(now_us) - F.col("last_arrival_us")) / 1_000_000)
    breach = F.when(F.col("last_arrival_us").isNull(), "no_data").when(lag > sla_minutes * 60, "ingestion_lag").otherwise("none")
    return got.select("last_arrival_us", lag.cast("bigint").alias("lag_seconds"), breach.alias("breach"))
