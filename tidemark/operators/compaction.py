"""Many small files into few of good size: frozen manifest, first-fit decreasing, rewrite, verification, atomic commit."""

from __future__ import annotations

import json
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import commits
from tidemark.functions.hashing import row_hash
from tidemark.session import scratch

#: Content (before encoding) that a file should hold.
TARGET_BYTES = 32 * 1024 * 1024
#: Files of the manifest that one task packs; packing is done within such shards, so no task sees the whole list.
SHARD_FILES = 50_000
#: A manifest of more files than this isn't sent to all tasks but joined by a shuffle on the file and one of SALTS
#: numbers, so that a file with a third of all rows goes to many tasks.
SMALL_MANIFEST, SALTS = 50_000, 32


def content_bytes(df: DataFrame) -> Column:
    """Rough size of a row: the lengths of its text and 8 for any other value."""
    parts = [F.coalesce(F.octet_length(F.col(f"`{n}`")), F.lit(0)) if t == "string" else F.lit(8) for n, t in df.dtypes]
    size = parts[0]
    for p in parts[1:]:
        size = size + p
    return size.cast("bigint")


def _checks(h: Column) -> list[Column]:
    return [F.count("*").alias("rows"), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias("sum_hash"), F.bit_xor(h).alias("xor_hash")]


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """Bin of each size: the largest first, each into the first bin with room. Larger ones get a bin of their own.

    A tree of the room in the bins finds the first fit in logarithmic time.
    """
    n = max(1, len(sizes))
    width = 1 << (n - 1).bit_length()
    room, out = [capacity] * (2 * width), [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        need, at = min(sizes[i], capacity), 1
        while at < width:
            at = 2 * at if room[2 * at] >= need else 2 * at + 1
        out[i] = at - width
        room[at] -= need
        at //= 2
        while at:
            room[at] = max(room[2 * at], room[2 * at + 1])
            at //= 2
    return out


def packed(manifest: DataFrame, files: int, target_bytes: int, shard_files: int = SHARD_FILES) -> DataFrame:
    """manifest with bin (first one of the file) and parts: files beyond the target are cut into parts, a bin each."""
    shards = max(1, -(-files // shard_files))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bytes", "file"], ascending=[False, True]).reset_index(drop=True)
        parts = (pdf["bytes"] + target_bytes - 1) // target_bytes
        parts = parts.clip(lower=1)
        small = pdf[parts == 1]
        bins = pd.Series(0, index=pdf.index, dtype="int64")
        bins[small.index] = first_fit_decreasing([int(x) for x in small["bytes"]], target_bytes)
        used = int(bins[small.index].max()) + 1 if len(small) else 0
        for i in pdf.index[parts > 1]:
            bins[i] = used
            used += int(parts[i])
        return pdf.assign(bin=bins + pdf["shard"] * 2**32, parts=parts.astype("int64"))[["file", "bytes", "shard", "bin", "parts"]]

    slim = manifest.select("file", "bytes", F.pmod(F.xxhash64("file"), F.lit(shards)).alias("shard"))
    return slim.groupBy("shard").applyInPandas(one, "file string, bytes bigint, shard bigint, bin bigint, parts bigint").drop("shard", "bytes")


class Compaction:
    """Result of compact(): the committed folder, its manifest and its rows."""

    def __init__(self, spark: SparkSession, root: str, columns: list[str]):
        self.spark, self.root, self.columns = spark, root, columns

    def manifest(self) -> DataFrame:
        """(file, rows, bytes, sum_hash, xor_hash) as frozen before the rewrite."""
        return self.spark.read.parquet(f"{committed(self.spark, self.root)}/manifest")

    def rows(self) -> DataFrame:
        """The rows of the committed files."""
        return self.rows_read().select(*self.columns)

    def rows_read(self) -> DataFrame:
        """The same as a scan, with the file that each row lies in."""
        return read_committed(self.spark, self.root)


def committed(spark: SparkSession, root: str) -> str:
    """Folder of the attempt that was committed; those that weren't are invisible."""
    text = commits.read_text(spark, f"{root}/commit.json")
    if text is None:
        raise FileNotFoundError(f"{root} has no commit")
    return f"{root}/{json.loads(text)['attempt']}"


def read_committed(spark: SparkSession, root: str) -> DataFrame:
    """The rows of the committed version."""
    return spark.read.parquet(f"{committed(spark, root)}/data")


def compact(rows: DataFrame, file_column: str, *, target_bytes: int = TARGET_BYTES, root: str | None = None, small_manifest: int = SMALL_MANIFEST) -> Compaction:
    """Rewrites rows that came in many files into few files of about target_bytes of content each.

    1. The manifest (rows, bytes and order-free checksums of each file, null as the file '') is written and from then
    on stands. 2. Files are packed by first-fit decreasing; one beyond the target is cut into parts, so a file with a
    third of all rows, even equal ones, is no single task. 3. Each bin is written as one file. 4. What was written is read
    again and its counts and checksums are held against the manifest, file by file; a difference raises an error and
    nothing is committed. 5. The commit is one file under a name that only one writer can have; it names the folder that
    this writer wrote. A crash before it leaves the old state as it is.
    """
    spark = rows.sparkSession
    root = root or scratch(spark, "compaction")
    attempt = f"attempt-{uuid.uuid4().hex}"
    at = f"{root}/{attempt}"
    h = row_hash([F.col(f"`{c}`") for c in rows.columns], 5)
    file = F.coalesce(F.col(file_column), F.lit(""))
    manifest = rows.select(file.alias("file"), content_bytes(rows).alias("_b"), h.alias("_h")).groupBy("file").agg(*_checks(F.col("_h")), F.sum("_b").alias("bytes"))
    manifest.write.parquet(f"{at}/manifest")
    manifest = spark.read.parquet(f"{at}/manifest")
    total = manifest.agg(F.count("*").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    packed(manifest, total["files"], target_bytes).write.parquet(f"{at}/bins")
    bins = spark.read.parquet(f"{at}/bins").withColumnsRenamed({"file": "_pack_file", "bin": "_pack_bin0", "parts": "_pack_parts"})
    # A number that tells even equal rows apart spreads the rows of a file over its parts and, in the join, its salts.
    placed = rows.withColumns({"_pack_f": file, "_pack_no": F.xxhash64(F.monotonically_increasing_id())})
    if total["files"] <= small_manifest:
        placed = placed.join(F.broadcast(bins), F.col("_pack_f") == F.col("_pack_file"))
    else:
        salted = bins.withColumn("_pack_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        placed = placed.withColumn("_pack_s", F.pmod("_pack_no", F.lit(SALTS))).join(salted, (F.col("_pack_f") == F.col("_pack_file")) & (F.col("_pack_s") == F.col("_pack_salt")))
    placed = placed.withColumn("_pack_bin", F.col("_pack_bin0") + F.pmod(F.shiftright("_pack_no", 8), F.col("_pack_parts"))).select(*rows.columns, "_pack_bin")
    tasks = max(1, min(200_000, -(-int(total["bytes"]) // target_bytes) + 1))
    placed.repartition(tasks, "_pack_bin").write.partitionBy("_pack_bin").parquet(f"{at}/data")
    written = spark.read.parquet(f"{at}/data") if total["files"] else rows.limit(0).withColumn("_pack_bin", F.lit(0))
    again = written.select(file.alias("file"), h.alias("_h")).groupBy("file").agg(*_checks(F.col("_h")))
    wrong = manifest.drop("bytes").exceptAll(again).unionByName(again.exceptAll(manifest.drop("bytes")))
    if total["files"] and not wrong.isEmpty():
        raise ValueError(f"rows written differ from the manifest: {wrong.limit(5).collect()}")
    if not total["files"]:
        rows.limit(0).write.mode("overwrite").parquet(f"{at}/data")
    content = {"attempt": attempt, "files": total["files"], "bytes": int(total["bytes"])}
    commits.publish(spark, f"{root}/commit.json", json.dumps(content, sort_keys=True).encode())
    return Compaction(spark, root, rows.columns)


def small_files(manifest: DataFrame, below: int) -> DataFrame:
    """(file) of the manifest's files with at least 1 and fewer than `below` rows."""
    return manifest.where((F.col("rows") >= 1) & (F.col("rows") < below)).select("file")
