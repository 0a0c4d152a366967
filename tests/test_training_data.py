"""Operators 1 to 7: brute force on small inputs, nulls, ties, repeats, empty tables, clashing names, heavy keys."""

import json
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tidemark.functions.times import instant_us, plain_month
from tidemark.operators import asof, bloom_dedup, compaction, lambda_views, reconcile, satellites
from tidemark.operators.kept import copy_rank, kept_copies
from tidemark.operators.timeline import Chunks, running_sum
from tidemark.sources import grammar, landing


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- times ---


@pytest.mark.parametrize(
    ("text", "ok"),
    [("2026-01-01T00:00:00Z", True), ("2026-01-01 00:00:00.5+05:30", True), ("2026-02-30T00:00:00Z", False), ("2026-01-01T24:00:01Z", False), ("2026-01-01T00:00:00", False), ("2026-01-01T00:00:00Z\n", False), ("epoch", False), ("", False), (None, False)],
)
def test_readable(spark, text, ok):
    df = spark.createDataFrame([(text,)], "t string")
    assert (df.select(instant_us(F.col("t"))).first()[0] is not None) == ok


def test_plain_month(spark):
    df = spark.createDataFrame([(x,) for x in ("2026-01", "2026-1", "202601", "2026/01", " 2026-01", "2026-01-01", "01/2026", "soon", None)], "m string")
    assert [r[0] for r in df.select(plain_month(F.col("m"))).collect()] == ["2026-01"] * 7 + ["soon", None]


# --- 1 ---


def test_field_arithmetic():
    import numpy as np

    r = random.Random(1)
    a, b = ([r.randrange(reconcile.PRIME) for _ in range(500)] for _ in range(2))
    assert [int(x) for x in reconcile.mulmod(np.array(a, np.uint64), np.array(b, np.uint64))] == [x * y % reconcile.PRIME for x, y in zip(a, b, strict=True)]


@pytest.mark.parametrize(("common", "only_a", "only_b"), [(0, 1, 0), (5, 0, 3), (40, 3, 2), (10, 8, 8), (0, 0, 0), (3, 1, 1)])
def test_decode(common, only_a, only_b):
    import numpy as np

    r, at = random.Random(f"elements {common}"), reconcile.points(0)
    x = [r.randrange(reconcile.PRIME) for _ in range(common + only_a + only_b)]
    a, b = x[: common + only_a], x[:common] + x[common + only_a :]
    va, vb = ([int(v) for v in row] for row in reconcile.evaluate([np.array(a, np.uint64), np.array(b, np.uint64)], at))
    got = reconcile.decode(len(a), len(b), va, vb, at)
    assert got is not None and (sorted(got[0]), sorted(got[1])) == (sorted(x[common : common + only_a]), sorted(x[common + only_a :]))


def test_decode_gives_up_beyond_its_points():
    import numpy as np

    at = reconcile.points(0)
    a = np.arange(1, 40, dtype=np.uint64)
    va = [int(v) for v in reconcile.evaluate([a], at)[0]]
    assert reconcile.decode(len(a), 0, va, [1] * len(at), at) is None


def _differences(spark, a, b, **kw):
    ddl = "k string, v int, x bigint, y string, field_name string"
    sides = [spark.createDataFrame(x, ddl).drop("field_name") for x in (a, b)]
    return reconcile.differences(*sides, ["k", "v"], missing_in_a="missing_in_a", missing_in_b="missing_in_b", **kw)


def test_differences(spark):
    a = [("a", 1, 5, "p", ""), ("a", 1, 5, "p", ""), ("b", 1, None, "p", ""), (None, None, 1, "n", ""), ("c", 2, 3, None, ""), ("m", 1, 1, "1", ""), ("gone", 9, 9, "", "")]
    b = [("a", 1, 6, "p", ""), ("b", 1, None, None, ""), (None, None, 1, "n", ""), ("c", 2, 3, None, ""), ("m", 1, 1, "1", ""), ("m", 1, 2, "1", ""), ("new", None, 0, "", "")]
    assert rows(_differences(spark, a, b)) == sorted([("a", 1, "x"), ("b", 1, "y"), ("m", 1, "x"), ("gone", 9, "missing_in_b"), ("new", None, "missing_in_a")], key=repr)


def test_differences_of_empty_tables(spark):
    assert rows(_differences(spark, [], [])) == []
    assert rows(_differences(spark, [("a", 1, 1, "", "")] * 3, [])) == [("a", 1, "missing_in_b")]


def test_differences_beyond_the_points(spark):
    """A bucket that differs in all its rows is cut until its points suffice."""
    a = [(f"k{i}", 1, i, "", "") for i in range(300)]
    b = [(f"k{i}", 1, i + (i % 2), "", "") for i in range(300)]
    assert len(rows(_differences(spark, a, b, bucket_rows=300))) == 150


# --- 2 ---


def history(updates):
    best = {}
    for c, at, e, s, k in updates:
        if c is not None and at is not None:
            x = (e is not None, e or "", s is not None, s or "", k is not None, k or "")
            if (c, at) not in best or x > best[c, at][0]:
                best[c, at] = (x, s, k)
    out = []
    for c in {c for c, _ in best}:
        v = []
        for at in sorted(t for x, t in best if x == c):
            s, k = best[c, at][1:]
            if not v or v[-1][1:] != (s, k):
                v.append((at, s, k))
        out += [(c, at, v[i + 1][0] if i + 1 < len(v) else None, s, k) for i, (at, s, k) in enumerate(v)]
    return sorted(out, key=repr)


def _updates(seed, n, keys):
    r = random.Random(seed)
    return [(r.choice([*keys, None]) if r.random() < 0.9 else keys[0], r.choice([*range(60), None]), f"e{r.randrange(n)}" if r.random() < 0.95 else None, r.choice(["a", "b", None]), r.choice(["x", "y", None])) for _ in range(n)]


DDL2 = "customer_id string, at bigint, event_id string, segment string, country string"


@pytest.mark.parametrize("chunk_rows", [1_000, 12])
def test_history(spark, chunk_rows):
    u = _updates(3, 400, ["hot", "b", "c"])
    df = spark.createDataFrame(u, DDL2)
    got = satellites.build_history(df, "customer_id", F.col("at"), F.col("event_id"), ["segment", "country"], chunk_rows)
    assert rows(got.select("customer_id", "at_us", "end_us", "segment", "country")) == history(u)


def test_history_of_nothing(spark):
    got = satellites.build_history(spark.createDataFrame([], DDL2), "customer_id", F.col("at"), F.col("event_id"), ["segment", "country"])
    assert rows(got) == []


UNDONE = [[("c", 1, "e1", "A", None), ("c", 2, "e2", "B", None)], [("c", 2, "e3", "A", None)]]
RESTORED = [[("c", 1, "e1", "A", None), ("c", 2, "e2", "B", "x")], [("c", 2, "e3", "C", "x")], [("c", 2, "e4", "B", "x"), (None, 1, "e0", "B", None)], []]


@pytest.mark.parametrize("batches", [UNDONE, RESTORED, 1, 2, 3])
def test_satellites_by_batches(spark, tmp_path, batches):
    """Loads batch by batch end at the history of one load: corrections that undo or restore a value, random batching."""
    if isinstance(batches, int):
        r = random.Random(batches)
        u = [(c, at, f"{e}-{i}", s, k) for i, (c, at, e, s, k) in enumerate(_updates(9 + batches, 90, ["a", "b"]))]
        cuts = sorted(r.sample(range(91), 3))
        batches = [u[a:b] for a, b in zip([0, *cuts], [*cuts, 90], strict=True)]
    for b in batches:
        store = satellites.SatelliteStore(spark, f"file://{tmp_path}/sat", "customer_id", [["segment"], ["country"]], chunk_rows=10)
        store.load(spark.createDataFrame(b, DDL2), F.col("at"), F.col("event_id"))
    whole = satellites.build_history(spark.createDataFrame([x for b in batches for x in b], DDL2), "customer_id", F.col("at"), F.col("event_id"), ["segment", "country"])
    columns = ["customer_id", "at_us", "end_us", "segment", "country"]
    assert rows(store.history().select(columns)) == rows(whole.select(columns))


# --- 3 ---


def test_first_fit_decreasing():
    r = random.Random(2)
    sizes = [r.randrange(1, 60) for _ in range(500)]
    bins = compaction.first_fit_decreasing(sizes, 100)
    totals = {}
    for s, b in zip(sizes, bins, strict=True):
        totals[b] = totals.get(b, 0) + s
    assert max(totals.values()) <= 100 and len(totals) <= 11 / 9 * -(-sum(sizes) // 100) + 1


@pytest.mark.parametrize("small_manifest", [100, 0])
def test_compaction_keeps_rows(spark, tmp_path, small_manifest):
    data = [(f"e{i}", None if i % 7 == 0 else f"f{i % 40}" if i % 3 else "big", i, "x" * (i % 50)) for i in range(3000)] + [("e1", "f1", 1, "x")] * 2
    df = spark.createDataFrame(data, "event_id string, file string, bytes int, _bin string").withColumnRenamed("_bin", "text")
    done = compaction.compact(df, "file", target_bytes=8_000, root=f"file://{tmp_path}/c", small_manifest=small_manifest)
    assert rows(done.rows()) == rows(df)
    files = list((tmp_path / "c").glob("attempt-*/data/*/*.parquet"))
    assert 2 < len(files) < 41 and done.manifest().agg(F.sum("rows")).first()[0] == len(data)
    with pytest.raises(FileExistsError):  # a second writer of the same folder; what it wrote stays invisible
        compaction.compact(df.limit(5), "file", root=f"file://{tmp_path}/c")
    assert done.rows().count() == len(data)


def test_compaction_cuts_a_file_of_equal_rows(spark, tmp_path):
    df = spark.range(4_000).select(F.lit("e").alias("event_id"), F.lit("f").alias("file"))
    done = compaction.compact(df, "file", target_bytes=1_000, root=f"file://{tmp_path}/c")
    sizes = spark.read.parquet(f"{compaction.committed(spark, done.root)}/data").groupBy("_pack_bin").count()
    assert done.rows().count() == 4_000 and sizes.agg(F.max("count")).first()[0] < 900


def test_compaction_of_nothing(spark, tmp_path):
    df = spark.createDataFrame([], "event_id string, file string")
    assert rows(compaction.compact(df, "file", root=f"file://{tmp_path}/c").rows()) == []


def test_uncommitted_is_invisible(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        compaction.read_committed(spark, f"file://{tmp_path}/none")


# --- 4 ---


def _calendar(spark):
    return spark.createDataFrame([("m", 0, 10), ("m", 1, 20), ("n", 0, 10)], "p string, v int, s bigint").select("p", "v", F.timestamp_seconds("s").alias("at"))


LAYERS = {"period": "p", "arrival_us": "us", "version": "v", "closed_at": "at"}


@pytest.mark.parametrize("small", [100, 0])
def test_versions_in_time(spark, small):
    log = spark.createDataFrame([("a", "m", 10_000_000), ("b", "m", 10_000_001), ("c", "m", 30_000_000), ("d", "n", 11_000_000), ("e", "none", 1)], "id string, p string, us bigint")
    got = lambda_views.first_version_in_time(log, _calendar(spark), **LAYERS, small=small)
    assert rows(got.select("id", "first_version", "late")) == [("a", 0, False), ("b", 1, True), ("c", -1, True), ("d", -1, True)]


def _log(spark, data):
    return lambda_views.first_version_in_time(spark.createDataFrame(data, "id string, p string, us bigint, qty bigint"), _calendar(spark), **LAYERS)


def test_layers(spark, tmp_path):
    """Any schedule ends at the same views; a wrong increment lasts until the next batch; frozen figures never change."""
    r = random.Random(4)
    data = [(f"e{i}", r.choice("mmmn"), r.randrange(1, 40) * 1_000_000, r.choice([None, 1, 2, 3])) for i in range(80)]
    log, ends = _log(spark, data), []
    figures = {"n": F.count("*"), "q": F.coalesce(F.sum("qty"), F.lit(0))}
    for k, batches in enumerate([[20], [5, 12, 20], [10, 30]]):
        store = lambda_views.LambdaStore(spark, f"file://{tmp_path}/s{k}", _calendar(spark), key="id", figures=figures, **LAYERS)
        for t in batches:
            store.batch(log, t * 1_000_000)
        store.increment(log, lambda_views.ALWAYS)
        ends.append((rows(store.versions()), rows(store.late()), rows(store.serve())))
    assert ends[0] == ends[1] == ends[2]
    at = {("m", 0): 10, ("m", 1): 20, ("n", 0): 10}
    arrived = lambda p, s: [q or 0 for _, x, us, q in data if x == p and us <= s * 1_000_000]
    assert ends[0][0] == sorted((p, v, len(arrived(p, s)), sum(arrived(p, s))) for (p, v), s in at.items())
    late = [(i, p, next((v for v in (0, 1) if (p, v) in at and us <= at[p, v] * 1_000_000), -1)) for i, p, us, _ in data]
    assert ends[0][1] == sorted(x for x in late if x[2])

    store = lambda_views.LambdaStore(spark, f"file://{tmp_path}/wrong", _calendar(spark), key="id", figures=figures, **LAYERS)
    store.increment(log.unionByName(log), 8_000_000)  # the fast layer counts everything twice
    assert rows(store.serve().where("p = 'm'").select("n")) == [(2 * len(arrived("m", 8)),)]
    store.batch(log, 8_000_000)
    assert rows(store.serve().where("p = 'm'").select("n", "status")) == [(len(arrived("m", 8)), "provisional")]
    for t in (10, 20, 25):
        store.batch(log, t * 1_000_000)
    store.increment(log, lambda_views.ALWAYS)
    assert (rows(store.versions()), rows(store.late()), rows(store.serve())) == ends[0]
    (tmp_path / "s0" / "commits" / "000002.json").unlink()  # the last increment broke off before it was published
    again = lambda_views.LambdaStore(spark, f"file://{tmp_path}/s0", _calendar(spark), key="id", figures=figures, **LAYERS)
    again.increment(log, lambda_views.ALWAYS)
    assert rows(again.late()) == ends[0][1]


def test_layers_of_nothing(spark, tmp_path):
    store = lambda_views.LambdaStore(spark, f"file://{tmp_path}/s", _calendar(spark), key="id", figures={"n": F.count("*")}, **LAYERS)
    assert rows(store.versions()) == rows(store.late()) == rows(store.serve()) == []
    store.batch(_log(spark, []), 50_000_000)
    assert rows(store.versions()) == [("m", 0, 0), ("m", 1, 0), ("n", 0, 0)] and rows(store.late()) == []


# --- 5 ---


@pytest.mark.parametrize("sizes", [{}, {"rate": 0.3}, {"most_words": 0}])
def test_deduplicated(spark, sizes):
    r = random.Random(5)
    data = [(f"id{r.randrange(900)}" if r.random() < 0.97 else None, r.choice([1, 2, 3, None]), r.choice([*range(50), None]), f"p{r.randrange(9)}") for _ in range(1500)] + [("hot", 1, 1, "x")] * 800
    df = spark.createDataFrame(data, "id string, ev bigint, ar bigint, _maybe string")
    bucket = F.coalesce((F.col("ar") / 10).cast("int"), F.lit(-1))
    best = {}
    count = {}
    for i, ev, ar, p in data:
        if i is not None:
            k = (ev is None, ev or 0, ar is None, ar or 0, p)
            best[i] = min(best.get(i, (k, None))[0], k), None
            count[i] = count.get(i, 0) + 1
    got = rows(bloom_dedup.deduplicated(df, "id", bucket, F.col("ev"), F.col("ar"), **sizes))
    assert [(g[0], g[3]) for g in got] == sorted(((i, b[0][4]) for i, b in best.items()), key=repr)
    again = rows(bloom_dedup.repeated(df, "id", bucket, F.col("ev"), F.col("ar"), ["ar"], **sizes).select("id", "copies"))
    assert again == sorted(((i, n) for i, n in count.items() if n > 1), key=repr)


def test_no_events(spark):
    df = spark.createDataFrame([], "id string, ev bigint, ar bigint")
    assert rows(bloom_dedup.deduplicated(df, "id", F.lit(1), F.col("ev"), F.col("ar"))) == []


@pytest.mark.parametrize("shards", [1, 8])
def test_seen_store(spark, tmp_path, shards):
    """Opened anew for each batch; only the first batch's identifiers have a null bucket."""
    got = []
    for i, ids in enumerate((["a", "b", "b", None], ["b", "c"], ["a", "c", "d", "d"], [])):
        store = bloom_dedup.SeenStore(spark, f"file://{tmp_path}/seen", shards=shards)
        df = spark.createDataFrame([(x, j) for j, x in enumerate(ids)], "id string, at int")
        got.append(sorted(r["id"] for r in store.ingest(df, "id", F.when(F.lit(i > 0), F.col("at") % 2), F.col("at")).collect()))
    assert got == [["a", "b"], ["c"], ["d"], []]
    assert [b["rows"] for b in store.batches()] == [2, 1, 1, 0]


def test_seen_store_ignores_what_was_not_committed(spark, tmp_path):
    at = f"file://{tmp_path}/seen"
    df = spark.createDataFrame([("a", 1)], "id string, at int")
    bloom_dedup.SeenStore(spark, at).ingest(df, "id", F.col("at"), F.col("at"))
    (tmp_path / "seen" / "commits" / "000000.json").unlink()
    assert bloom_dedup.SeenStore(spark, at).ingest(df, "id", F.col("at"), F.col("at")).count() == 1
    assert bloom_dedup.SeenStore(spark, at).ingest(df, "id", F.col("at"), F.col("at")).count() == 0


@pytest.mark.parametrize("scale", [10, 100])
def test_false_alarms_stay_rare(spark, scale):
    """With 10 and 100 times as many repeats the filters grow, so that single identifiers stay out of the exact check."""
    ids = spark.range(40_000 + 1_500 * scale).select(F.col("id"), F.when(F.col("id") < 40_000, 1).otherwise(2).alias("n"))
    df = ids.select(F.concat(F.lit("e"), "id").alias("id"), (F.col("id") < 40_000).alias("single"), F.explode(F.sequence(F.lit(1), "n")).alias("k"))
    df = df.withColumn("bucket", F.when(F.col("k") == 1, F.pmod(F.xxhash64("id"), F.lit(13))).otherwise(F.lit(3)))
    got = bloom_dedup.screened(df, "id", F.col("bucket")).groupBy("single").agg(F.avg(F.col("_dedup_maybe").cast("int")).alias("share")).collect()
    share = {r["single"]: r["share"] for r in got}
    assert share[False] == 1.0 and share[True] < 0.02


def test_rate_of_filters():
    import numpy as np

    r = np.random.default_rng(1)
    ids = r.integers(0, 2**40, 50_000).astype(np.uint64)
    words = bloom_dedup.build(np.unique(ids), 0.01)
    assert bloom_dedup.known(words, bloom_dedup._places(ids)).all()
    assert bloom_dedup.known(words, bloom_dedup._places(r.integers(0, 2**40, 200_000).astype(np.uint64))).mean() < 0.013


def test_kept_copy_of_unreadable_times(spark):
    df = spark.createDataFrame([("a", None, 1, "late"), ("a", 5, None, "no arrival"), ("a", 5, 9, "kept"), (None, 1, 1, "no id")], "id string, ev bigint, ar bigint, p string")
    assert rows(kept_copies(df, "id", F.col("ev"), F.col("ar"), ["p"], count=True)) == [("a", 5, 9, "kept", 3)]
    assert df.select(copy_rank(F.col("ev"), F.col("ar"), ["p"])).count() == 4


# --- 6 ---


@pytest.mark.parametrize("chunk_rows", [10_000, 15])
def test_as_known(spark, chunk_rows):
    r = random.Random(8)
    updates = [(r.choice(["hot", "hot", "b", None]), r.choice([*range(40), None]), r.choice([*range(60), None]), f"u{i % 50}", r.choice(["a", "b", None])) for i in range(150)]
    once = {}
    for c, v, a, u, s in updates:
        if c is not None and v is not None and a is not None:
            once[c, v, u, s] = min(a, once.get((c, v, u, s), a))
    events = [(f"e{i}", r.choice(["hot", "hot", "b", "z"]), r.randrange(70), i) for i in range(120)]
    want = []
    for e, c, t, _ in events:
        known = [(v, u, s is not None, s or "", s) for (k, v, u, s), a in once.items() if k == c and max(v, a) <= t]
        if known:
            m = max(known)
            want.append((e, m[1], m[4]))
    up = spark.createDataFrame(updates, "c string, valid bigint, arr bigint, u string, seg string")
    known = asof.first_arrivals(up, "c", F.col("valid"), F.col("arr"), "u", ["seg"]).withColumn("uid", F.col("u"))
    ev = spark.createDataFrame(events, "e string, c string, t bigint, at_us_too int")
    chunks = asof.timeline_chunks(ev, up, "c", "e", F.col("t"), F.greatest("valid", "arr"), chunk_rows)
    assert (chunks.cuts is None) == (chunk_rows > 1000)
    h = {a: asof.attribute_history(known, "c", "u", a, chunks) for a in ("uid", "seg")}
    got = asof.as_known_at(ev, "c", "e", "t", h, chunks)
    assert rows(got.select("e", "known_uid", "known_seg")) == sorted(want, key=repr)


def test_chunks_of_one_instant(spark):
    """A key whose rows share one instant is cut by the tie, and every key by as many cuts as its rows ask for."""
    df = spark.range(6_000).select(F.lit("hot").alias("k"), F.lit(7).cast("bigint").alias("at_us"), F.format_string("e%05d", "id").alias("tie"), F.lit(1).cast("bigint").alias("v"))
    chunks = Chunks.of(df, "k", "at_us", 4, F.col("tie"))
    sizes = chunks.add(df).groupBy("_chunk").count()
    assert sizes.count() > 1_024 and sizes.agg(F.max("count")).first()[0] <= 8
    total = running_sum(chunks.add(df), chunks, "v", [F.col("at_us"), F.col("tie")], "n")
    assert total.where(F.col("n") != F.substring("tie", 2, 5).cast("int") + 1).count() == 0


# --- 7 ---


def by_json(text, feed):
    """An independent reading of a line: the standard library's JSON, a hand-written split of delimited text."""
    if text is None:
        return None
    if feed == "jsonl":
        try:
            o = json.loads(text, parse_constant=lambda x: 1 / 0)
        except (ValueError, ZeroDivisionError):
            return None
        return {k: v for k, v in o.items() if v is not None} if isinstance(o, dict) else None
    fields, i = [], 0
    while True:
        if text[i : i + 1] == '"':
            j = i + 1
            while True:
                j = text.find('"', j)
                if j < 0:
                    return None
                if text[j + 1 : j + 2] != '"':
                    break
                j += 2
            fields.append(text[i + 1 : j].replace('""', '"'))
            i = j + 1
        else:
            j = i
            while j < len(text) and text[j] not in ',"\r\n':
                j += 1
            fields.append(text[i:j])
            i = j
        if i >= len(text):
            break
        if text[i] != ",":
            return None
        i += 1
    return {k: v for k, v in zip(landing.FIELDS, fields, strict=True) if v} if len(fields) == 15 else None


def reason(text, feed):
    o = by_json(text, feed)
    if o is None or "event_id" not in o:
        return "unparseable_json"
    kind = o.get("event_type")
    need = {"order_placed": ["order_id", "sku", "customer_id", "qty", "unit_price_cents", "currency"], "order_line_amended": ["order_id", "sku", "new_qty"], "return_registered": ["order_id", "sku", "qty"], "customer_upserted": ["customer_id"]}
    if not isinstance(kind, str) or kind not in need:
        return "unknown_event_type"

    def number(k):
        v = o.get(k)
        if feed == "csv":
            v = int(v) if v and re.fullmatch("-?[0-9]+", v) else None
        return v if isinstance(v, int) and not isinstance(v, bool) and -(2**63) <= v < 2**63 else None

    from datetime import datetime

    for k in ("event_ts", "arrival_ts"):
        v = o.get(k)
        try:
            if not re.fullmatch(r"\d{4}-\d\d-\d\d[T ]\d\d:\d\d:\d\d(\.\d{1,6})?(Z|[+-]\d\d:\d\d)", v):
                return "missing_required_field"
            datetime.fromisoformat(v)
        except (TypeError, ValueError):
            return "missing_required_field"
    if any((number(k) if k in landing.NUMBERS else o.get(k)) is None for k in need[kind]):
        return "missing_required_field"
    q = number("new_qty" if kind == "order_line_amended" else "qty") if kind != "customer_upserted" else 1
    if q < 1:
        return "non_positive_quantity"
    if kind == "order_placed":
        if number("unit_price_cents") < 0:
            return "negative_price"
        if o["currency"] != "EUR":
            return "unknown_currency"
    if q > 10000 or kind == "order_placed" and number("unit_price_cents") > 1000000:
        return "amount_out_of_range"
    return "accepted"


def test_landing_lines_against_json(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/landing_lines.parquet")
    want = {r["line_id"]: reason(r["line_text"], r["feed"]) for r in df.collect()}
    got = {r["line_id"]: r["quarantine_reason"] for r in landing.classified(df).collect()}
    assert got == want and len(set(want.values())) == 8


GOOD = '{"event_id":"e","event_type":"customer_upserted","event_ts":"2026-01-01T00:00:00Z","arrival_ts":"2026-01-01T00:00:00Z","customer_id":"c"}'


@pytest.mark.parametrize(
    ("text", "valid"),
    [
        (GOOD, True), (" \t" + GOOD + "\r\n", True), (GOOD + GOOD, False), (GOOD + ",", False), ("[" + GOOD + "]", False), ("{}", True), ('{"a":01}', False), ('{"a":1.}', False), ('{"a":"\t"}', False),
        ('{"a":NaN}', False), ('{"a":1,}', False), ('{"a":[1,2,{"b":[]}],"c":-0.5e+3}', True), ('{"a":[1,]}', False), ('{"a":{"b":1,}}', False), ('{"a":[}', False), ('{"a":"\\u00e9\\ud800"}', True), ('{"a":"\\x"}', False),
        ('{"a":' + "[" * 50_000 + "]" * 50_000 + "}", True), ('{"a":' + "[" * 50_000, False), ("﻿{}", False), ("", False), ("null", False), ("{'a':1}", False), ('{"a" 1}', False), ('{"a":tru}', False),
    ],
)
def test_json_grammar(text, valid):
    records = grammar.Json(text).records()
    assert (len(records) == 1 and records[0].fault is None) == valid


def test_recovery_after_broken_quotes():
    text = GOOD + '\n{"event_id":"broken,"sku":1}\n' + GOOD.replace('"e"', '"e2"')
    got = grammar.Json(text).records()
    assert [(r.fault is None, r.members.get("event_id", ("", ""))[1]) for r in got] == [(True, "e"), (False, "broken,"), (True, "e2")]
    assert text[got[1].fault.offset - 8 : got[1].fault.offset] == "broken,\""
    lines = 'a,"b ""c""",d\r\ne,"f,g\nh,i,j\nk,l,m'
    got = grammar.Delimited(lines, 3).records()
    assert [(r.fault is None, r.members) for r in got] == [(True, ["a", 'b "c"', "d"]), (False, ["e"]), (True, ["h", "i", "j"]), (True, ["k", "l", "m"])]


@pytest.mark.parametrize("text", ['"' + 'a""\n' * 40_000, 'x,"\n' * 40_000, '"a\n' + '"b" c\n' * 40_000, '{"a":{' * 30_000, '{"a":[{"b":"' * 20_000, '{"a" ' * 40_000])
def test_broken_texts_take_linear_time(text):
    began = time.perf_counter()
    (grammar.Json(text) if text[0] == "{" else grammar.Delimited(text, 3)).records()
    assert time.perf_counter() - began < 10


def test_quotes_that_cannot_close():
    """What is remembered of open quotes gives the records that scanning each quote anew gives."""
    r = random.Random(6)
    for _ in range(3_000):
        text = "".join(r.choice(['"', '""', "a", ",", "\n"]) for _ in range(r.randrange(1, 25)))
        clever, plain = grammar.Delimited(text, 2), grammar.Delimited(text, 2)
        plain.closes = lambda at: True
        assert clever.records() == plain.records(), text


def test_records_of_texts(spark):
    """Records behind a fault come out as rows, from lines and from files in which a quote is broken across lines."""
    second = GOOD.replace('"e"', '"e2"')
    texts = [(1, "jsonl", GOOD), (2, "jsonl", '{"event_id":"a"b"} ' + second), (3, "jsonl", GOOD + "\n{\"event_id\":\"bro\nken\n" + second), (4, "csv", 'e1,"x\n' + ",".join(["e5"] + [""] * 14)), (5, "csv", None), (6, "jsonl", "")]
    df = spark.createDataFrame(texts, "line_id bigint, feed string, line_text string")
    got = landing.records(df, "line_id", "feed", "line_text").where("fault_at is null")
    assert rows(got.select("line_id", "record_no", "line_no", "event_id", "whole")) == [(1, 0, 0, "e", True), (2, 1, 0, "e2", False), (3, 0, 0, "e", False), (3, 2, 3, "e2", False), (4, 1, 1, "e5", False)]
    assert rows(landing.recovered(df).select("line_id", "event_id", "quarantine_reason")) == [(2, "e2", "accepted"), (3, "e", "accepted"), (3, "e2", "accepted"), (4, "e5", "unknown_event_type")]


def test_typed_values():
    odd = landing.parse_line('{"event_id":7.0,"sku":123,"reason":{"a": [1]},"segment":true,"country":null}', "jsonl")[0]
    assert [odd[c] for c in ("event_id", "sku", "reason", "segment", "country")] == ["7.0", "123", '{"a": [1]}', "true", None]
    line = "e,order_placed,2026-01-01T00:00:00Z,2026-01-01T00:00:00Z,o,c,s,+5,,12,EUR,,\"a, \"\"b\"\"\",,"
    fields, offset, _, _ = landing.parse_line(line, "csv")
    assert (fields["qty"], fields["unit_price_cents"], fields["reason"], fields["country"], offset) == (None, 12, 'a, "b"', None, None)
    assert landing.parse_line(None, "csv")[1] == 0
    assert landing.parse_line(line + "\r\n", "csv")[1] is not None
    assert landing.parse_line('{"event_id":7,"qty":9223372036854775808}', "jsonl")[0]["qty"] is None


def test_empty_landing(spark):
    df = spark.createDataFrame([], "line_id bigint, feed string, line_text string, event_id string")
    assert rows(landing.classified(df)) == []
    odd = spark.createDataFrame([(1, None, None, "x"), (2, "jsonl", GOOD, "y")], "line_id bigint, feed string, line_text string, event_id string")
    assert rows(landing.classified(odd).select("line_id", "quarantine_reason")) == [(1, "unparseable_json"), (2, "accepted")]
