"""Exactly one row per identifier, by a Bloom filter for each time bucket.

Each task turns its identifiers into partial filters, one per time bucket, in sparse form: of an identifier only the
five bytes remain that its word and bits follow from, and one that a task has many times is there once. The partial
filters are merged by a shard of the hash; a bucket's filter in a shard is sized from the identifiers that came and
from a target rate. In the same task each bucket's identifiers are held against the filters of all other buckets.
What no filter knows and is single in its own bucket is definitely new: its rows are never shuffled. The rest, true
repeats and a few false alarms, are verified exactly, by gathering only the rows of the buckets that match.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import commits
from tidemark.operators.kept import copy_rank
from tidemark.session import cut

#: Share of single identifiers that may be taken for possible repeats: by the filters of the other buckets together,
#: and by the filter of possible repeats. Filters grow to hold it.
RATE = 0.005
#: Bits of the hash that stay of an identifier within its shard (5 bytes), and identifiers of a shard.
KEPT_BITS, SHARD_IDS = 40, 2**23
#: Bits that an identifier sets in its word of 64.
BITS = 4
#: The filter of possible repeats is sent to all tasks up to so many words (about 130 MB in an executor, 10 million
#: identifiers that repeat). With more of them the rows are grouped without it: screening would then move more bytes
#: than it spares.
MOST_WORDS = 2**21
#: Rows whose partial filters a task holds before it passes them on.
HELD_ROWS = 4_000_000


def month_bucket(us: Column) -> Column:
    """Calendar month (UTC) as a number of an instant in microseconds; -1 where there is none."""
    t = F.timestamp_micros(us)
    return F.coalesce(F.year(t) * 12 + F.month(t), F.lit(-1)).cast("int")


def false_alarms(ids_per_word: float) -> float:
    """Rate of false alarms of a filter whose words of 64 bits hold so many identifiers on average (Poisson)."""
    term, total = math.exp(-ids_per_word), 0.0
    for n in range(200):
        total += term * (1 - (1 - 1 / 64) ** (BITS * n)) ** BITS
        term *= ids_per_word / (n + 1)
    return total


@lru_cache(maxsize=256)
def ids_per_word(rate: float) -> float:
    """The most identifiers a word may hold on average for a rate of false alarms."""
    low, high = 1e-6, 64.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if false_alarms(mid) <= rate else (low, mid)
    return low


def words_for(ids: int, rate: float) -> int:
    return max(1, math.ceil(ids / ids_per_word(rate)))


# --- filters as arrays ---


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _places(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each identifier a number that its word follows from, and its bits."""
    m, one = _mixed(ids), np.uint64(1)
    bits = np.zeros(len(ids), np.uint64)
    for k in range(BITS):
        bits |= one << ((m >> np.uint64(6 * k)) & np.uint64(63))
    return m >> np.uint64(24), bits


def build(ids: np.ndarray, rate: float) -> np.ndarray:
    """The filter of a bucket in one shard, sized from the number of different identifiers and the rate."""
    words = np.zeros(words_for(len(ids), rate), np.uint64)
    at, bits = _places(ids)
    np.bitwise_or.at(words, (at % np.uint64(len(words))).astype(np.int64), bits)
    return words


def known(words: np.ndarray, places: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Whether the filter knows each identifier; never false for one it was built from."""
    at, bits = places
    return (words[(at % np.uint64(len(words))).astype(np.int64)] & bits) == bits


def possible(ids: np.ndarray, buckets: np.ndarray, repeated: np.ndarray, rate: float = RATE) -> np.ndarray:
    """Of a shard's identifiers, sorted by bucket and one per bucket, those that may be repeats: they are repeated in
    their bucket or another bucket's filter knows them. The rate is shared out among the filters an identifier meets."""
    of, starts = np.unique(buckets, return_index=True)
    ends = np.append(starts[1:], len(ids))
    each = rate / max(1, len(of) - 1)
    at, bits = _places(ids)
    filters = [build(ids[a:b], each) for a, b in zip(starts, ends, strict=True)]
    hit = repeated.copy()
    for i, (a, b) in enumerate(zip(starts, ends, strict=True)):
        for j, words in enumerate(filters):
            if j != i:
                hit[a:b] |= known(words, (at[a:b], bits[a:b]))
    return hit


def _distinct(bucket: np.ndarray, ids: np.ndarray, repeated: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, id) pairs once each, sorted, with whether they came more than once."""
    order = np.lexsort((ids, bucket))
    bucket, ids, repeated = bucket[order], ids[order], repeated[order]
    first = np.ones(len(ids), bool)
    first[1:] = (ids[1:] != ids[:-1]) | (bucket[1:] != bucket[:-1])
    start = np.flatnonzero(first)
    count = np.diff(np.append(start, len(ids)))
    return bucket[start], ids[start], np.logical_or.reduceat(repeated, start) | (count > 1) if len(start) else repeated


# --- possible repeats of a whole table ---


def shard_of(h: Column, shards: int) -> Column:
    return F.pmod(F.shiftrightunsigned(h, KEPT_BITS), F.lit(shards))


def kept_bits(h: Column) -> Column:
    return h.bitwiseAND(F.lit(2**KEPT_BITS - 1))


def _packed(shard: np.ndarray, bucket: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    """One row per shard: its identifiers in 5 bytes each, and bucket and repeated flag of each in 5 more.

    Sorted by bucket, the latter are long runs that the shuffle's compression takes away.
    """
    order = np.lexsort((ids, bucket, shard))
    shard, bucket, ids = shard[order], bucket[order], ids[order]
    first = np.ones(len(ids), bool)
    first[1:] = (ids[1:] != ids[:-1]) | (bucket[1:] != bucket[:-1]) | (shard[1:] != shard[:-1])
    start = np.flatnonzero(first)
    repeated = np.diff(np.append(start, len(ids))) > 1
    shard, bucket, ids = shard[start], bucket[start], ids[start]
    tags = np.zeros((len(ids), 5), np.uint8)
    tags[:, :4] = bucket.astype("<i4").view(np.uint8).reshape(-1, 4)
    tags[:, 4] = repeated
    five = np.ascontiguousarray(ids.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5])
    rows, begin = np.unique(shard, return_index=True)
    offsets = pa.py_buffer((np.append(begin, len(ids)) * 5).astype("<i8"))
    binary = lambda a: pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(rows), [None, offsets, pa.py_buffer(a.tobytes())]).cast(pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(rows.astype(np.int64)), binary(five), binary(tags)], ["shard", "ids", "tags"])


def _unpacked(five: list[bytes], tags: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"".join(five), np.uint8).reshape(-1, 5)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :5] = raw
    t = np.frombuffer(b"".join(tags), np.uint8).reshape(-1, 5)
    bucket = np.ascontiguousarray(t[:, :4]).view("<i4").reshape(-1)
    return bucket, wide.view("<u8").reshape(-1), t[:, 4].astype(bool)


def possible_repeats(slim: DataFrame, rows: int, rate: float = RATE) -> tuple[DataFrame, int]:
    """(bucket, shard, id) of the identifiers that may occur more than once, from (bucket, h), and the shards' number.

    Five bytes of an identifier are shuffled, a heavy one once per task. A shard holds about SHARD_IDS identifiers, so
    its task's memory is bounded whatever the number of rows.
    """
    spark = slim.sparkSession
    shards = max(spark.sparkContext.defaultParallelism, -(-rows // SHARD_IDS))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0

        def flush() -> pa.RecordBatch:
            h, bucket = (np.concatenate([x[i] for x in held]) for i in (0, 1))
            held.clear()
            return _packed((h >> np.uint64(KEPT_BITS)) % np.uint64(shards), bucket, h & np.uint64(2**KEPT_BITS - 1))

        for b in batches:
            held.append((b.column(1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64), b.column(0).to_numpy(zero_copy_only=False).astype(np.int32)))
            n += b.num_rows
            if n >= HELD_ROWS:
                yield flush()
                n = 0
        if n:
            yield flush()

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def judged(shard: int, five: list[bytes], tags: list[bytes]) -> pa.RecordBatch:
            bucket, ids, repeated = _distinct(*_unpacked(five, tags))
            hit = possible(ids, bucket, repeated, rate)
            n = int(hit.sum())
            return pa.RecordBatch.from_arrays([pa.array(bucket[hit], pa.int32()), pa.array(np.full(n, shard, np.int64)), pa.array(ids[hit].astype(np.int64))], ["bucket", "shard", "id"])

        at, five, tags = None, [], []
        for b in batches:
            for s, i, t in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if s != at and five:
                    yield judged(at, five, tags)
                    five, tags = [], []
                at = s
                five.append(i)
                tags.append(t)
        if five:
            yield judged(at, five, tags)

    partials = slim.select(F.col("bucket").cast("int"), "h").mapInArrow(partial, "shard bigint, ids binary, tags binary")
    by_shard = partials.repartition(min(shards, 100_000), "shard").sortWithinPartitions("shard")
    return by_shard.mapInArrow(merged, "bucket int, shard bigint, id bigint"), shards


def _mask(h: Column) -> Column:
    """Four of the 64 bits of a word, from 24 bits of a hash."""
    one = F.lit(1).cast("bigint")
    bit = lambda k: F.call_function("shiftleft", one, F.shiftright(h, 6 * k).bitwiseAND(F.lit(63)).cast("int"))
    return bit(0).bitwiseOR(bit(1)).bitwiseOR(bit(2)).bitwiseOR(bit(3))


def screened(events: DataFrame, key: str, bucket: Column, rate: float = RATE, most_words: int = MOST_WORDS) -> DataFrame:
    """events that have a key, with _dedup_maybe: false where the identifier is definitely single.

    Beyond most_words it is true of all rows; the exact check then combines them by identifier before its shuffle.
    """
    n = events.count()
    rows = events.where(F.col(key).isNotNull()).withColumns({"_dedup_bucket": F.coalesce(bucket.cast("int"), F.lit(-1)), "_dedup_h": F.xxhash64(F.col(key))})
    found, shards = possible_repeats(rows.select(F.col("_dedup_bucket").alias("bucket"), F.col("_dedup_h").alias("h")), n, rate)
    found = cut(found)
    words = words_for(max(1, found.count()), rate)
    if words > most_words:
        return rows.withColumn("_dedup_maybe", F.lit(True))
    place = lambda b, s, i: F.xxhash64(b, s, i)
    p = found.select(place(F.col("bucket"), F.col("shard"), F.col("id")).alias("p"))
    bits = p.groupBy(F.pmod(F.shiftright("p", 24), F.lit(words)).alias("_dedup_fw")).agg(F.bit_or(_mask(F.col("p"))).alias("_dedup_fb"))
    hit = rows.withColumn("_dedup_p", place(F.col("_dedup_bucket"), shard_of(F.col("_dedup_h"), shards), kept_bits(F.col("_dedup_h"))))
    hit = hit.join(F.broadcast(bits), F.pmod(F.shiftright("_dedup_p", 24), F.lit(words)) == F.col("_dedup_fw"), "left")  # at most most_words rows
    return hit.withColumn("_dedup_maybe", F.coalesce(F.col("_dedup_fb").bitwiseAND(_mask(F.col("_dedup_p"))) == _mask(F.col("_dedup_p")), F.lit(False))).drop("_dedup_p", "_dedup_fw", "_dedup_fb")


def repeated(events: DataFrame, key: str, bucket: Column, event_us: Column, arrival_us: Column, columns: list[str], **sizes) -> DataFrame:
    """(key, columns..., copies) of the kept copy of each identifier that has more than one row.

    Rows without identifier are no message. Copies are ordered as in kept.copy_rank. Only rows that the filters know
    are grouped, combined by identifier before the shuffle.
    """
    maybe = screened(events, key, bucket, **sizes).where("_dedup_maybe")
    best = maybe.select(key, copy_rank(event_us, arrival_us, columns).alias("_dedup_r")).groupBy(key).agg(F.min("_dedup_r").alias("_dedup_r"), F.count("*").alias("copies"))
    return best.where(F.col("copies") > 1).select(key, *[F.col(f"_dedup_r.{c}.{c}").alias(c) for c in columns], "copies")


def deduplicated(events: DataFrame, key: str, bucket: Column, event_us: Column, arrival_us: Column, **sizes) -> DataFrame:
    """events with exactly one row, the kept copy, for each identifier; rows without identifier are left out.

    Definitely single rows go straight through; only possible repeats are grouped, with all their columns.
    """
    marked = screened(events, key, bucket, **sizes)
    single = marked.where(~F.col("_dedup_maybe")).select(*events.columns)
    columns = [c for c in events.columns if c != key]
    best = marked.where("_dedup_maybe").select(key, copy_rank(event_us, arrival_us, columns).alias("_dedup_r")).groupBy(key).agg(F.min("_dedup_r").alias("_dedup_r"))
    kept = best.select(key, *[F.col(f"_dedup_r.{c}.{c}").alias(c) for c in columns])
    return single.unionByName(kept.select(*events.columns))


# --- batch after batch ---


class SeenStore:
    """Identifiers seen so far, for batches that come one after the other: storage by time bucket plus their filters.

    ids/<folder>/bucket=<b>/ holds (h, key) of a batch, filters/<folder>/ its filters by bucket and shard, sized from
    what the batch brought and the rate; commits/<n>.json names the folder and buckets of batch n and is published
    under a name that must be free. What isn't named there doesn't exist, so a batch that broke off leaves nothing,
    a store that is opened again goes on where it stood, and of two writers one gets FileExistsError.
    """

    def __init__(self, spark, path: str, shards: int = 64, rate: float = RATE):
        self.spark, self.path, self.rate = spark, path.rstrip("/"), rate
        first = self.batches()[:1]
        self.shards = first[0]["shards"] if first else shards

    def batches(self) -> list[dict]:
        """What was committed, in order."""
        return [json.loads(commits.read_text(self.spark, f"{self.path}/commits/{n}")) for n in commits.names(self.spark, f"{self.path}/commits")]

    def _filters(self, done: list[dict]) -> DataFrame:
        ddl = "bucket int, shard bigint, words binary"
        return self.spark.read.schema(ddl).parquet(*[f"{self.path}/filters/{b['folder']}" for b in done]) if done else self.spark.createDataFrame([], ddl)

    def _stored(self, done: list[dict], buckets: list[int]) -> DataFrame:
        """(bucket, h, key) of the matching buckets; the folders of the others aren't read."""
        paths = [f"{self.path}/ids/{b['folder']}/bucket={x}" for b in done for x in b["buckets"] if x in set(buckets)]
        if not paths:
            return self.spark.createDataFrame([], "bucket int, h bigint, key string")
        parts = [self.spark.read.schema("h bigint, key string, bucket int").option("basePath", f"{self.path}/ids/{b['folder']}").parquet(*[p for p in paths if f"/{b['folder']}/" in p]) for b in done if any(f"/{b['folder']}/" in p for p in paths)]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.select("bucket", "h", "key")

    def ingest(self, batch: DataFrame, key: str, bucket: Column, rank: Column) -> DataFrame:
        """The rows of the batch whose identifier was never seen before, one for each, the first by rank.

        Identifiers are screened by the stored filters, shard by shard; only those that a filter knows are looked up,
        and only in the storage of the buckets whose filters matched.
        """
        done, shards, rate = self.batches(), self.shards, self.rate
        rows = batch.where(F.col(key).isNotNull()).withColumns({"_dedup_bucket": F.coalesce(bucket.cast("int"), F.lit(-1)), "_dedup_h": F.xxhash64(F.col(key)), "_dedup_rank": rank})
        own = cut(rows.groupBy(key).agg(F.min_by(F.struct(*[F.col(c) for c in rows.columns]), "_dedup_rank").alias("_dedup_r")).select("_dedup_r.*").drop("_dedup_rank"))
        slim = own.select(shard_of(F.col("_dedup_h"), shards).alias("shard"), F.col("_dedup_h").alias("h"), F.col("_dedup_bucket").alias("bucket"))

        def matches(asked: pa.Table, filters: pa.Table) -> pa.Table:
            h = asked.column("h").to_numpy().astype(np.int64)
            places = _places(h.view(np.uint64) & np.uint64(2**KEPT_BITS - 1))
            hs, buckets = [], []
            for b, w in zip(filters.column("bucket").to_pylist(), filters.column("words").to_pylist(), strict=True):
                got = h[known(np.frombuffer(w, "<u8"), places)]
                hs.append(got)
                buckets.append(np.full(len(got), b, np.int32))
            return pa.table({"h": np.concatenate([*hs, np.zeros(0, np.int64)]), "bucket": np.concatenate([*buckets, np.zeros(0, np.int32)])})

        hits = slim.select("shard", "h").groupBy("shard").cogroup(self._filters(done).groupBy("shard")).applyInArrow(matches, "h bigint, bucket int")
        asked = cut(hits.distinct())
        matching = [r["bucket"] for r in asked.select("bucket").distinct().collect()]  # time buckets: few
        hit = asked.join(own.select(F.col("_dedup_h").alias("h"), F.col(key).cast("string").alias("key")), "h")
        seen = hit.join(self._stored(done, matching), ["bucket", "h", "key"], "left_semi").select(F.col("key").alias("_dedup_seen")).distinct()
        new = cut(own.join(seen, own[key].cast("string") == seen["_dedup_seen"], "left_anti"))

        def built(part: pa.Table) -> pa.Table:
            ids = np.unique(part.column("h").to_numpy().astype(np.int64).view(np.uint64) & np.uint64(2**KEPT_BITS - 1))
            return pa.table({"bucket": part.column("bucket")[:1], "shard": part.column("shard")[:1], "words": pa.array([build(ids, rate).astype("<u8").tobytes()], pa.binary())})

        folder = f"{len(done):06d}-{uuid.uuid4().hex}"
        ids = new.select(F.col("_dedup_h").alias("h"), F.col(key).cast("string").alias("key"), F.col("_dedup_bucket").alias("bucket"), shard_of(F.col("_dedup_h"), shards).alias("shard"))
        ids.drop("shard").write.partitionBy("bucket").parquet(f"{self.path}/ids/{folder}")
        ids.groupBy("bucket", "shard").applyInArrow(built, "bucket int, shard bigint, words binary").write.parquet(f"{self.path}/filters/{folder}")
        counts = {r["bucket"]: r["n"] for r in ids.groupBy("bucket").agg(F.count("*").alias("n")).collect()}
        content = {"batch": len(done), "folder": folder, "shards": shards, "buckets": sorted(counts), "rows": sum(counts.values())}
        commits.publish(self.spark, f"{self.path}/commits/{len(done):06d}.json", json.dumps(content).encode())
        return new.select(*batch.columns)
