"""History of changing attributes as insert-only satellites with end dates computed in views.

The hub is the entity. Each satellite holds attributes of a like change rate and gets a row only where the hash of its
attributes differs from that of the update before it in the order of valid_from. Rows are never changed or deleted:
a correction is a further row, and end dates exist in the view alone, as the begin of the next version.
"""

from __future__ import annotations

import json
import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import commits
from tidemark.functions.hashing import row_hash
from tidemark.operators.timeline import CHUNK_ROWS, Chunks, following, last_known, previous
from tidemark.session import cut


def standing_updates(updates: DataFrame, key: str, moment_us: Column, version: Column, attributes: list[str]) -> DataFrame:
    """(key, at_us, attributes...) with one update per key and instant: the one with the greatest version (nulls lowest).

    Updates without key or instant don't count. Repeated deliveries and a heavy pair collapse before the shuffle; ties
    in version are decided by the attributes' values.
    """
    rank = F.struct(version.isNotNull(), version.alias("_version"), *[F.struct(F.col(c).isNotNull(), F.col(c)).alias(c) for c in attributes])
    best = updates.select(F.col(key).alias(key), moment_us.alias("at_us"), rank.alias("_r")).where(F.col(key).isNotNull() & F.col("at_us").isNotNull()).groupBy(key, "at_us").agg(F.max("_r").alias("_r"))
    return best.select(key, "at_us", *[F.col(f"_r.{c}.{c}").alias(c) for c in attributes])


def satellite(standing: DataFrame, key: str, attributes: list[str], chunks: Chunks) -> DataFrame:
    """(key, at_us, hash_diff, attributes...): the updates whose hash differs from that of the update before."""
    rows = standing.select(key, "at_us", *attributes, row_hash([F.col(c) for c in attributes], 3).alias("hash_diff"))
    rows = previous(chunks.add(rows), chunks, F.col("hash_diff"), "_before")
    return rows.where(F.col("_before").isNull() | (F.col("_before") != F.col("hash_diff"))).select(key, "at_us", "hash_diff", *attributes)


def split_by_change_rate(standing: DataFrame, key: str, attributes: list[str], chunks: Chunks) -> list[list[str]]:
    """Groups of attributes whose rates of change, over all updates, lie within the same power of two."""
    rows = chunks.add(standing)
    for c in attributes:
        rows = previous(rows, chunks, F.struct(c), f"_b_{c}")
    changed = rows.agg(F.count("*").alias("n"), *[F.sum((F.col(f"_b_{c}").isNotNull() & ~F.col(f"_b_{c}").getField(c).eqNullSafe(F.col(c))).cast("long")).alias(c) for c in attributes]).first()
    groups: dict[int, list[str]] = {}
    for c in attributes:
        groups.setdefault(round(math.log2((changed[c] or 0) / max(1, changed["n"]) + 1e-9)), []).append(c)
    return list(groups.values())


def history_view(satellites: list[tuple[DataFrame, list[str]]], key: str, chunk_rows: int = CHUNK_ROWS, chunks: Chunks | None = None) -> DataFrame:
    """(key, at_us, end_us, attributes...) over all satellites; end_us is null for the open version.

    A version begins where any satellite has a row; each satellite's attributes are then its last known ones.
    """
    parts = None
    names = [f"_s{i}" for i in range(len(satellites))]
    for i, (rows, attributes) in enumerate(satellites):
        value = F.struct(*attributes)
        part = rows.select(key, "at_us", *[(value if j == i else F.lit(None).cast(_struct_type(satellites[j]))).alias(n) for j, n in enumerate(names)])
        parts = part if parts is None else parts.unionByName(part)
    merged = parts.groupBy(key, "at_us").agg(*[F.max(n).alias(n) for n in names])
    chunks = Chunks.of(merged, key, "at_us", chunk_rows) if chunks is None else chunks
    merged = chunks.add(merged)
    if len(names) > 1:
        merged = last_known(merged, chunks, names, [F.col("at_us")])
    merged = following(merged, chunks, F.col("at_us"), "end_us")
    return merged.select(key, "at_us", "end_us", *[F.col(f"{n}.{c}").alias(c) for n, (_, attributes) in zip(names, satellites, strict=True) for c in attributes])


def _struct_type(sat: tuple[DataFrame, list[str]]):
    return sat[0].select(F.struct(*sat[1]).alias("s")).schema["s"].dataType


def build_history(updates: DataFrame, key: str, moment_us: Column, version: Column, attributes: list[str], chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The whole history from all updates: standing updates, satellites by change rate, view.

    An empty table gives an empty history; a null attribute is a value; updates that change nothing leave no version.
    """
    # Several steps read the standing updates; they are written once, so that what made them isn't done again.
    standing = cut(standing_updates(updates, key, moment_us, version, attributes))
    chunks = Chunks.of(standing, key, "at_us", chunk_rows)
    groups = split_by_change_rate(standing, key, attributes, chunks)
    return history_view([(satellite(standing, key, g, chunks), g) for g in groups], key, chunk_rows, chunks)


def append_batch(stored: DataFrame | None, log: DataFrame, batch_keys: DataFrame, key: str, attributes: list[str], load: str = "load", chunk_rows: int = CHUNK_ROWS, chunks: Chunks | None = None) -> DataFrame:
    """(key, at_us, hash_diff, attributes..., gone): rows to append to a stored satellite after a batch of updates.

    log holds the standing updates of all batches so far, batch_keys the keys of the new batch. Only these keys are
    derived anew and held against the rows that currently stand for them, the last load of each instant. A row is
    appended for each instant whose row changes; where a correction made an instant's row superfluous, one that is
    gone, with null attributes. Nothing is changed or deleted.
    """
    touched = log.join(batch_keys.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_semi")
    chunks = Chunks.of(touched, key, "at_us", chunk_rows) if chunks is None else chunks
    wanted = satellite(touched, key, attributes, chunks)
    if stored is None:
        return wanted.withColumn("gone", F.lit(False))
    standing = current_rows(stored.join(batch_keys.select(key).distinct(), key, "left_semi"), key, attributes, load)
    old = standing.select(key, "at_us", F.col("hash_diff").alias("_old"))
    both = wanted.withColumn("gone", F.lit(False)).join(old, [key, "at_us"], "full")
    changed = both.where(~F.col("_old").eqNullSafe(F.col("hash_diff")))
    return changed.select(key, "at_us", F.coalesce("hash_diff", F.lit(0).cast("bigint")).alias("hash_diff"), *attributes, F.coalesce("gone", F.lit(True)).alias("gone"))


def current_rows(stored: DataFrame, key: str, attributes: list[str], load: str = "load") -> DataFrame:
    """View of an insert-only satellite, (key, at_us, hash_diff, attributes...): the last load of each instant, less those gone."""
    last = stored.groupBy(key, "at_us").agg(F.max_by(F.struct("hash_diff", *attributes, "gone"), load).alias("_v")).select(key, "at_us", "_v.*")
    return last.where(~F.col("gone")).drop("gone")


#: Names that a satellite's own columns have.
RESERVED = {"at_us", "end_us", "hash_diff", "gone", "load", "_version"}


class SatelliteStore:
    """Insert-only satellites in a folder, a load after the other: log/<load>/ holds the updates as they came, sat<i>/
    <load>/ the rows appended to each satellite, commits/<load>.json what a load consists of. What no commit names
    doesn't exist; of two writers of one load one gets FileExistsError.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, groups: list[list[str]], chunk_rows: int = CHUNK_ROWS):
        clash = RESERVED & {key, *[c for g in groups for c in g]}
        if clash:
            raise ValueError(f"columns of a satellite itself: {sorted(clash)}")
        self.spark, self.path, self.key, self.groups, self.chunk_rows = spark, path.rstrip("/"), key, groups, chunk_rows

    def loads(self) -> list[str]:
        """Folders of the committed loads, in order."""
        return [json.loads(commits.read_text(self.spark, f"{self.path}/commits/{n}"))["folder"] for n in commits.names(self.spark, f"{self.path}/commits")]

    def _read(self, what: str, folders: list[str]) -> DataFrame | None:
        # The number of the load is the begin of its folder's name; it comes from the path.
        if not folders:
            return None
        df = self.spark.read.parquet(*[f"{self.path}/{what}/{f}" for f in folders])
        return df.withColumn("load", F.regexp_extract(F.col("_metadata.file_path"), rf"/{what}/(\d{{6}})-", 1).cast("int"))

    def load(self, updates: DataFrame, moment_us: Column, version: Column) -> None:
        """Takes in a batch of updates, late corrections included. An empty batch makes an empty load."""
        attributes = [c for g in self.groups for c in g]
        done = self.loads()
        folder = f"{len(done):06d}-{uuid.uuid4().hex}"
        slim = updates.select(F.col(self.key), moment_us.alias("at_us"), version.alias("_version"), *attributes).where(F.col(self.key).isNotNull() & F.col("at_us").isNotNull())
        slim.write.parquet(f"{self.path}/log/{folder}")
        new = self._read("log", [folder])
        keys = cut(new.select(self.key).distinct())
        touched = self._read("log", [*done, folder]).join(keys, self.key, "left_semi")
        standing = cut(standing_updates(touched, self.key, F.col("at_us"), F.col("_version"), attributes))
        chunks = Chunks.of(standing, self.key, "at_us", self.chunk_rows)
        for i, g in enumerate(self.groups):
            append_batch(self._read(f"sat{i}", done), standing, keys, self.key, g, chunks=chunks).write.parquet(f"{self.path}/sat{i}/{folder}")
        commits.publish(self.spark, f"{self.path}/commits/{len(done):06d}.json", json.dumps({"folder": folder}).encode())

    def history(self) -> DataFrame:
        """(key, at_us, end_us, attributes...) of all loads so far, end dates computed in the view."""
        done = self.loads()
        if not done:
            raise LookupError(f"no load in {self.path}")
        parts = [(current_rows(self._read(f"sat{i}", done), self.key, g), g) for i, g in enumerate(self.groups)]
        return history_view(parts, self.key, self.chunk_rows)
