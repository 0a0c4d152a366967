"""Queries p8 to p10 over the driver's documents. None has SQL: DuckDB has no tokenizer and no n-gram models."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import mixing, residue, tokenizer
from tidemark.session import cut


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table; where it lies in fewer splits than there are cores, as only small ones do, its rows are spread over all cores."""
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenizer.encode(documents(spark, sf_dir), "doc_id", "text")


def _mixture(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    counted = tokenizer.encode(documents(spark, sf_dir), "doc_id", "text", keep=["source"], count_only=True)
    # Counted once, as each level of histograms reads the sizes again: 16 bytes a document in the shared folder.
    sized = cut(counted.select(F.col("doc_id").alias("key"), "source", F.col("n_tokens").alias("size")))
    targets = spark.read.parquet(f"{sf_dir}/mix_targets.parquet")
    return mixing.mixture(sized, targets), targets


def p9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens, copies): the documents of the mixture and how often each is used."""
    mixed, _ = _mixture(spark, sf_dir)
    return mixed.select(F.col("key").alias("doc_id"), "source", F.col("size").alias("n_tokens"), "copies")


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shares reached, in tokens."""
    return mixing.shares(*_mixture(spark, sf_dir)).withColumnRenamed("size", "n_tokens")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.judged(documents(spark, sf_dir), "doc_id", "text").where(F.col("reason").isNotNull()).select("doc_id")


def p10_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, reason, residue_chars, chars) of every document; reason is null where it is natural."""
    return residue.judged(documents(spark, sf_dir), "doc_id", "text")


def p10_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that remain, with all their columns."""
    docs = documents(spark, sf_dir)
    return docs.join(residue.judged(docs, "doc_id", "text").where(F.col("reason").isNull()).select("doc_id"), "doc_id", "left_semi")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p8_ids, p9_mixture, p9_shares, p10_found, p10_reasons, p10_rest)}
SQL: dict[str, str] = {}
