"""The engine's own operators: rules, closes by retraction, snapshot tables, streams and crashes, privacy, layout."""

import datetime
import hashlib
import hmac
import json
import math
import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tidemark.functions.hashing import fingerprint, ordered_fingerprint
from tidemark.functions.times import instant_us
from tidemark.operators import closes, governance, layout, quality, quarantine, run_log
from tidemark.sources import bronze
from tidemark.sources.snapshot import Conflict, SnapshotTable
from tidemark.streaming import ingest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


SALE = {"event_id": "e", "event_type": "order_placed", "event_ts": "2026-01-10T10:00:00Z", "arrival_ts": "2026-01-10T10:05:00Z", "order_id": "O1", "customer_id": "C1", "sku": "S1", "qty": 2, "unit_price_cents": 1000, "currency": "EUR"}
VARIANTS = [
    ({}, "accepted"), ({"event_id": None}, "unparseable_json"), ({"event_type": None}, "unknown_event_type"), ({"event_type": "ping", "qty": -1}, "unknown_event_type"), ({"event_ts": "epoch"}, "missing_required_field"), ({"arrival_ts": None}, "missing_required_field"),
    *[({k: None}, "missing_required_field") for k in ("order_id", "sku", "customer_id", "qty", "unit_price_cents", "currency")],
    ({"qty": 0}, "non_positive_quantity"), ({"qty": 0, "unit_price_cents": -1}, "non_positive_quantity"), ({"unit_price_cents": -1, "currency": "USD"}, "negative_price"), ({"currency": "eur"}, "unknown_currency"), ({"currency": "USD", "qty": 10001}, "unknown_currency"),
    ({"qty": 10001}, "amount_out_of_range"), ({"qty": 10000, "unit_price_cents": 1000000}, "accepted"), ({"unit_price_cents": 1000001}, "amount_out_of_range"), ({"unit_price_cents": 2**63 - 1}, "amount_out_of_range"), ({"unit_price_cents": 0}, "accepted"),
    ({"event_type": "order_line_amended", "new_qty": 0}, "non_positive_quantity"), ({"event_type": "order_line_amended"}, "missing_required_field"), ({"event_type": "return_registered", "qty": 10001}, "amount_out_of_range"), ({"event_type": "customer_upserted", "qty": -5}, "accepted"),
]


@pytest.fixture(scope="module")
def matrix(spark):
    data = [tuple((SALE | v | {"event_id": v.get("event_id", str(i))}).get(c) for c in [*bronze.COLUMNS, bronze.RESCUE]) for i, (v, _) in enumerate(VARIANTS)]
    return spark.createDataFrame(data, bronze.bronze_schema())


def test_rule_matrix(matrix):
    assert [r["quarantine_reason"] for r in quarantine.classify(matrix).collect()] == [w for _, w in VARIANTS]


def test_rules_fail_closed(spark, matrix):
    of = [("never_known", F.lit(None).cast("boolean"))]
    tagged = matrix.select(quarantine.quarantine_reason(of).alias("r"), quarantine.undecided_rule(of).alias("u")).distinct()
    assert rows(tagged) == [("never_known", "never_known")]
    counts = {r["rule"]: (r["passed"], r["failed"]) for r in quarantine.rule_counts(matrix).collect()}
    assert counts["unparseable_json"] == (len(VARIANTS) - 1, 1) and all(sum(v) == len(VARIANTS) for v in counts.values())


def test_split_and_accounting(matrix):
    tagged = quarantine.classify(matrix.unionByName(matrix))
    good, bad = quarantine.split(tagged)
    a = quality.row_accounting(tagged).first().asDict()
    assert quality.conserved(a) and a["accepted"] == good.count() and a["quarantined"] == bad.count() and a["without_id"] == 2


def test_classes_of_nothing(spark):
    df = spark.createDataFrame([], bronze.bronze_schema())
    assert quality.row_accounting(quarantine.classify(df)).first().asDict() == dict.fromkeys(("delivered", "without_id", "distinct_ids", "repeated", "accepted", "quarantined", "rescued"), 0)


# --- closes ---


@pytest.mark.parametrize("chunk_rows", [500, 3])
def test_retractions_against_every_cut(spark, chunk_rows):
    r = random.Random(6)
    data = [(r.choice(["a", "b", "c", None]), r.choice([*range(5), None]), r.choice([*range(12), None]), r.randrange(4)) for _ in range(60)]
    df = spark.createDataFrame(data, "k string, ev bigint, ar bigint, v int")
    changes = [tuple(x) for x in closes.retractions(df, "k", "ev", "ar", ["v"], chunk_rows).select("k", "arrival_us", "sign", "event_us", "v").collect()]
    for cut in range(12):
        best = {}
        for k, ev, ar, v in data:
            if k is not None and ar is not None and ar <= cut:
                x = (ev is None, ev or 0, ar, v)
                best[k] = min(best.get(k, x), x)
        state = {}
        for k, at, sign, ev, v in changes:
            if at <= cut:
                state[k, ev, v] = state.get((k, ev, v), 0) + sign
        assert {k for k, n in state.items() if n} == {(k, None if x[0] else x[1], x[3]) for k, x in best.items()}
        assert set(state.values()) <= {0, 1}


def test_versions_only_when_something_changed(spark):
    day = 86_400_000_000
    base = 1_770_000_000_000_000  # 2026-02-02
    changes = spark.createDataFrame([("2026-01", base, 1, 5), ("2026-01", base + 9 * day, 1, 2)], "m string, arrival_us bigint, sign int, q bigint")
    snaps = closes.snapshots(changes, "m", [base, base + day, base + 10 * day], {"q": F.col("q")})
    assert rows(closes.versions(snaps, "m", ["q"]).select("m", "close_version", "q")) == [("2026-01", 0, 5), ("2026-01", 1, 7)]


def test_ledger(spark):
    ddl = "k string, v int, x bigint"
    old = spark.createDataFrame([("a", 0, 1), ("b", 0, 2), ("b", 1, 3)], ddl)
    src = spark.createDataFrame([("a", 1), ("b", 9), ("c", None)], "k string, x bigint")
    rec = closes.to_record(src, old, ["k"], "v", ["x"])
    assert rows(rec) == [("b", 2, 9), ("c", 0, None)]
    new = closes.insert_only(old, rec, ["k", "v"])
    assert rows(closes.to_record(src, new, ["k"], "v", ["x"])) == []
    assert rows(closes.current_versions(new, ["k"], "v", ["x"])) == [("a", 0, 1), ("b", 2, 9), ("c", 0, None)]


def test_checks_catch_planted_faults(spark):
    ddl = "k string, close_version int, gross_cents bigint, returns_cents bigint, net_cents bigint, line_count bigint"
    df = spark.createDataFrame([("a", 0, 5, 1, 4, 1), ("a", 2, 5, 1, 4, 1), ("b", 0, 5, 6, -1, 1), ("b", 0, 5, 1, 3, -1)], ddl)
    assert dict(rows(closes.checks(df, ["k"], "close_version"))) == {"one_row_per_version": 1, "versions_are_dense": 1, "net_is_gross_minus_returns": 1, "returns_within_gross": 1, "no_negative_counts": 1}
    assert {n for _, n in rows(closes.checks(df.limit(0), ["k"], "close_version"))} == {0}


@pytest.mark.parametrize("chunk_rows", [500, 1])
def test_running_total_and_lines(spark, chunk_rows):
    df = spark.createDataFrame([("k", 1, 3, False), ("k", 2, 4, True), ("k", 3, 5, None), ("k", 4, 1, True)], "k string, t bigint, q int, c boolean")
    got = closes.running_total(df, ["k"], "t", "k", F.col("q"), F.col("c"), "s", chunk_rows)
    assert [r["s"] for r in got.orderBy("t").collect()] == [0, 4, 4, 5]
    kept = spark.createDataFrame(
        [("s2", "order_placed", 5, "o", "s", "c", 1, None, 7), ("s1", "order_placed", 5, "o", "s", "c", 2, None, 8), ("a1", "order_line_amended", 6, "o", "s", None, None, 3, None), ("a2", "order_line_amended", 6, "o", "s", None, None, 9, None)],
        "event_id string, event_type string, event_us bigint, order_id string, sku string, customer_id string, qty bigint, new_qty bigint, unit_price_cents bigint",
    )
    assert rows(closes.effective_lines(kept).select("qty", "unit_price_cents")) == [(9, 8)]


# --- fingerprints, parity, digests ---


def test_fingerprints(spark):
    df = spark.createDataFrame([(i, None if i % 3 else "x") for i in range(50)], "a int, b string")
    again = df.repartition(5).orderBy(F.rand(3))
    assert rows(fingerprint(df)) == rows(fingerprint(again)) != rows(fingerprint(df.limit(49)))
    assert rows(ordered_fingerprint(df, ["a", "b"])) == rows(ordered_fingerprint(again, ["a", "b"]))
    swapped = spark.createDataFrame([(None, 1), (2, None)], "a int, b int")
    assert rows(fingerprint(swapped)) != rows(fingerprint(spark.createDataFrame([(1, None), (None, 2)], "a int, b int")))
    assert rows(fingerprint(df.limit(0))) == [(0, 0, 0)]


def test_parity_and_digest(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    b = spark.createDataFrame([(1, None), (3, "y")], "a int, b string")
    assert rows(quality.parity(a, b)) == [(1, None, "a", 1), (2, "x", "a", 1), (3, "y", "b", 1)]
    assert quality.digest([(1, "a"), (2, None)]) == quality.digest([(2, None), (1, "a")]) != quality.digest([(1, "a"), (2, "")])
    assert quality.encoded(True) != quality.encoded(1) != quality.encoded("1")


@pytest.mark.parametrize("chunk_rows", [100, 1])
def test_history_violations(spark, chunk_rows):
    day = lambda n: n and f"2026-01-0{n}T00:00:00Z"
    data = [("ok", 1, 2, False), ("ok", 2, None, True), ("gap", 1, 2, False), ("gap", 3, None, True), ("two", 1, None, True), ("two", 2, None, True), ("flag", 1, None, False)]
    dim = spark.createDataFrame([(k, day(f), day(t), c) for k, f, t, c in data], "customer_id string, valid_from string, valid_to string, is_current boolean")
    want = [("flag", "wrong_flag"), ("gap", "gap_or_overlap"), ("two", "gap_or_overlap"), ("two", "not_one_open_version")]
    assert rows(quality.history_violations(dim, chunk_rows=chunk_rows)) == want


# --- snapshot tables ---


def test_snapshot_table(spark, tmp_path):
    ddl = "k int, v string"
    t = SnapshotTable(spark, f"file://{tmp_path}/t", ["k"], ["v"])
    t.create(spark.createDataFrame([(1, "a"), (2, "b")], ddl))
    assert t.insert_only(spark.createDataFrame([(2, "zzz"), (3, "c")], ddl)) == 1
    assert t.insert_only(spark.createDataFrame([(2, "zzz")], ddl)) == 1
    t.upsert(spark.createDataFrame([(1, "A"), (9, "n")], ddl), obsolete=spark.createDataFrame([(3,)], "k int"))
    assert rows(t.read()) == [(1, "A"), (2, "b"), (9, "n")] and rows(t.read(0)) == [(1, "a"), (2, "b")]
    assert rows(t.changes(1)) == [(1, "A", "update_after"), (1, "a", "update_before"), (3, "c", "delete"), (9, "n", "insert")]
    t.delete(F.col("k") == 9)
    t.compact(10**9)
    assert rows(t.read()) == [(1, "A"), (2, "b")] and t.manifest()["n_files"] == 1
    with pytest.raises(ValueError, match="several source rows"):
        t.upsert(spark.createDataFrame([(1, "x"), (1, "y")], ddl))
    assert rows(t.read(only=("v", "A", "A"))) == [(1, "A"), (2, "b")] and rows(t.read(only=("v", "x", "y"))) == []
    assert json.loads(t.history().where("operation = 'delete'").first()["metrics"])["rows_deleted"] == 1
    assert t.residual("v", "n") == [2]
    assert t.purge() > 0 and t.residual("v", "n") == [] and rows(t.read()) == [(1, "A"), (2, "b")]
    with pytest.raises(Exception, match="null in key"):
        t.append(spark.createDataFrame([(None, "x")], ddl))
    with pytest.raises(Conflict):
        t._publish(3, "late", t.files(), spark.createDataFrame([], ddl).schema, {})
    with pytest.raises(LookupError):
        t.read(99)


def test_statistics_are_typed(spark, tmp_path):
    t = SnapshotTable(spark, f"file://{tmp_path}/t", ["k"], ["k", "n", "d"])
    ddl = "k int, n bigint, d date"
    day = datetime.date(2026, 1, 9)
    t.create(spark.createDataFrame([(3, None, day), (10, None, day)], ddl).coalesce(1))
    assert t.read(only=("k", 2, 10)).count() == 2 and t.read(only=("k", 4, 9)).count() == 2 and t.read(only=("k", 11, 99)).count() == 0
    assert t.read(only=("n", 0, 9)).count() == 0 and t.read(only=("d", day, day)).count() == 2
    t.append(spark.createDataFrame([(None, None, None)], ddl).fillna({"k": 77}))
    assert rows(t.read(only=("k", 50, 99)).select("k")) == [(77,)] and t.residual("k", 77) == [1]


def test_one_of_two_writers_succeeds(spark, tmp_path):
    """Many writers publish one name at once: exactly one gets it, and the file holds its content alone."""
    from concurrent.futures import ThreadPoolExecutor

    from tidemark.functions import commits

    def write(i):
        try:
            commits.publish(spark, f"file://{tmp_path}/log/1.json", str(i).encode() * 1000)
            return i
        except FileExistsError:
            return None

    with ThreadPoolExecutor(8) as pool:
        won = [i for i in pool.map(write, range(16)) if i is not None]
    assert len(won) == 1 and commits.read_text(spark, f"file://{tmp_path}/log/1.json") == str(won[0]) * 1000
    assert commits.names(spark, f"file://{tmp_path}/log") == ["1.json"] and commits.read_text(spark, f"file://{tmp_path}/none") is None


# --- ingest ---


@pytest.fixture
def drop(tmp_path):
    d = tmp_path / "drop" / "batch=202601010000"
    d.mkdir(parents=True)
    for i in range(3):
        lines = [json.dumps(SALE | {"event_id": f"{i}-{j}"}) for j in range(5)] + ['{"event_id": "broken', json.dumps(SALE | {"event_id": f"big-{i}", "qty": 2**63}), ""]
        (d / f"part-{i}.json").write_text("\n".join(lines))
    return str(tmp_path / "drop")


def test_batch_scan(spark, drop):
    df = bronze.INGESTORS["jsonl"].read(spark, bronze.IngestSpec(drop))
    assert df.columns == [*bronze.COLUMNS, bronze.RESCUE, "_ingest_file"] and df.count() == bronze.line_count(spark, drop) == 21
    reasons = dict(rows(quarantine.classify(df).groupBy("quarantine_reason").count()))
    assert reasons == {"accepted": 15, "unparseable_json": 3, "missing_required_field": 3}
    assert bronze.as_of_cut(df, "2026-01-10T10:05:00Z").count() == 18 and bronze.as_of_cut(df, "2026-01-10T10:04:59Z").count() == 0


def test_stream_loses_and_repeats_nothing(spark, drop, tmp_path):
    out = f"{tmp_path}/out"
    for _ in range(2):
        ingest.ingest(spark, bronze.IngestSpec(drop, files_per_trigger=1), out)
    assert ingest.reconciled(spark, out, 21) == {"silver": 15, "quarantine": 6}


def test_stream_drops_repeats_within_the_watermark(spark, drop, tmp_path):
    stream = ingest.deduplicated_stream(bronze.INGESTORS["jsonl"].stream(spark, bronze.IngestSpec(drop)))
    q = stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start(f"{tmp_path}/o")
    q.awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/o").count() == 18


WORKER = """
import sys
sys.path.insert(0, {root!r})
from tidemark.session import build_session
from tidemark.sources.bronze import IngestSpec
from tidemark.streaming import ingest
spark = build_session("worker", master="local[2]", partitions=2)
ingest.ingest(spark, IngestSpec({drop!r}, files_per_trigger=1), {out!r}, idempotent={idempotent})
"""


@pytest.mark.parametrize(("point", "idempotent", "sound"), [("after_write:2", True, True), ("before_write:2", True, True), ("after_write:2", False, False)])
def test_crash_and_replay(spark, drop, tmp_path, point, idempotent, sound):
    out = f"{tmp_path}/out"
    code = WORKER.format(root=ROOT, drop=drop, out=out, idempotent=idempotent)
    crashed = subprocess.run([sys.executable, "-c", code], env=os.environ | {"TIDEMARK_CRASH": point}, capture_output=True, timeout=240)
    assert crashed.returncode == 17
    ingest.ingest(spark, bronze.IngestSpec(drop, files_per_trigger=1), out, idempotent=idempotent)
    assert (ingest.written(spark, out).count() == 21) == sound


# --- privacy, layout, runs ---


def test_privacy(spark):
    df = spark.createDataFrame([("C00000001", "2026-01-31T23:30:00Z", "x"), (None, "n/a", "about C00000001"), ("C2", None, None)], "id string, t string, note string")
    masked = governance.with_policy(df, {"id": "pseudonym", "t": "month"}, "s").collect()
    assert masked[0] == (hashlib.sha256(b"s\0C00000001").hexdigest()[:32], "2026-02") and tuple(masked[1]) == (None, None)
    want = hmac.new(b"key", b"C2", "sha256").hexdigest()[:24]
    assert df.where("id = 'C2'").select(governance.token(F.col("id"), b"key")).first()[0] == want
    assert rows(governance.exposure(df)) == [("id", 1, "C00000001"), ("note", 1, "about C00000001")]
    assert rows(governance.k_anonymity(df, ["note"])) == [(1, 3, 3)]
    assert rows(governance.secured(df, F.col("id") == "C2", {"id": F.lit("*")})) == [("*", None, None)]


def test_layout(spark, tmp_path):
    df = spark.range(4000).select((F.col("id") % 64).alias("a"), F.floor(F.col("id") / 64).alias("b"))
    layout.clustered(df, ["a", "b"], 8).write.parquet(f"{tmp_path}/z")
    stats = layout.file_stats(spark.read.parquet(f"{tmp_path}/z"), ["a", "b"])
    for c in ("a", "b"):
        r = layout.not_skippable(stats, c, 10).first()
        assert r["files_read"] < r["files"] and r["bytes_read"] < r["bytes"]
    few = spark.range(6_000).select((F.col("id") % 3).cast("int").alias("m"), F.pmod(F.xxhash64("id"), F.lit(1000)).cast("int").alias("s"))
    t = SnapshotTable(spark, f"file://{tmp_path}/t", [], ["m", "s"])
    t.create(few, cluster=["m", "s"], files=12)
    for c, v in (("m", 1), ("s", 500)):  # a column of few values is clustered as well as one of many
        assert t.files().where(t._may_hold(c, v, v)).count() < t.manifest()["n_files"]
    assert spark.range(1).select(layout.z_key([F.lit(3), F.lit(1)], 2)).first()[0] == 0b0111
    fact = layout.skewed_fact(spark, 5000)
    dim = fact.select("k").distinct().withColumn("name", F.lit("n"))
    assert layout.salted_join(fact, dim, "k", 4).count() == 5000
    assert layout.partition_profile(fact.repartition(4)).first()["rows"] == 5000


def test_freshness_and_runs(spark):
    df = spark.createDataFrame([(1_000_000,), (None,)], "us bigint")
    for now, want in ((1_000_000, "none"), (2_000_000_000, "ingestion_lag")):
        assert layout.freshness(df, F.col("us"), now, 15).first()["breach"] == want
    assert layout.freshness(df.limit(0), F.col("us"), 5, 15).first()["breach"] == "no_data"
    details = '{"progress": {"state": "%s", "expectations": [{"name": "n", "dataset": "d", "passed_records": 2, "failed_records": 1}]}}'
    log = spark.createDataFrame([("r1", 1, "INFO", details % "RUNNING"), ("r1", 2, "INFO", details % "FAILED"), ("r1", 3, "ERROR", "{}"), ("r2", 9, "INFO", details % "COMPLETED")], "run_id string, at int, level string, details string")
    assert [tuple(r) for r in run_log.run_states(log).collect()] == [("r2", "COMPLETED", 9, 9, 0), ("r1", "FAILED", 1, 3, 1)]
    assert rows(run_log.expectations(log)) == [("d", "n", 6, 3)]


def test_entry_without_texts():
    """The engine works where the subpackage for texts isn't there."""
    code = "import sys; sys.modules['tidemark.llm'] = None; import __spark_entry__ as e; q = e.queries(); assert 'p1_found' in q and set(e.oracle_sql()) <= set(q), q"
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT, timeout=60).returncode == 0


# --- generated log, serving, mutants of the rules ---


@pytest.fixture(scope="module")
def generated(spark, tmp_path_factory):
    from tidemark.sources import fixtures

    root = str(tmp_path_factory.mktemp("log"))
    return root, fixtures.generate(root, 400, 11)


def test_engine_finds_what_was_generated(spark, generated):
    from tidemark import cli

    root, ledger = generated
    log = bronze.INGESTORS["jsonl"].read(spark, bronze.IngestSpec(root))
    tagged = quarantine.classify(log)
    assert dict(rows(tagged.groupBy("quarantine_reason").count())) == ledger.reasons
    a = quality.row_accounting(tagged).first().asDict()
    assert (a["delivered"], a["repeated"]) == (ledger.lines, ledger.repeats) and quality.conserved(a)
    assert {r["accounting_month"]: r["gross_cents"] for r in cli.monthly(spark, root).collect()} == ledger.gross_cents
    assert "<td>2026-01</td>" in __import__("tidemark.operators.serving", fromlist=["x"]).report(cli.monthly(spark, root), "t", ["accounting_month", "gross_cents"])


@pytest.mark.parametrize("dropped", range(1, 7))
def test_every_rule_is_needed(matrix, dropped):
    """A classification that lacks one rule is told apart by the matrix of records."""
    of = [x for i, x in enumerate(quarantine.rules()) if i != dropped]
    got = [r["r"] for r in matrix.select(quarantine.quarantine_reason(of).alias("r")).collect()]
    assert got != [w for _, w in VARIANTS]


def test_rule_order_is_needed(matrix):
    got = [r["r"] for r in matrix.select(quarantine.quarantine_reason(quarantine.rules()[::-1]).alias("r")).collect()]
    assert got != [w for _, w in VARIANTS]


def test_serving(spark):
    from tidemark.operators import serving

    cents = spark.createDataFrame([(67269342,), (-5,), (0,), (100000,), (None,), (1234567890123456789,)], "c bigint")
    assert [r[0] for r in cents.select(serving.euros(F.col("c"))).collect()] == ["672 693,42", "-0,05", "0,00", "1 000,00", None, "12 345 678 901 234 567,89"]
    months = spark.createDataFrame([("2026-01",), ("2026-06",)], "m string")
    got = [r[0] for r in months.select(F.date_format(F.timestamp_micros(serving.deadline_us(F.col("m"))), "yyyy-MM-dd HH:mm:ss")).collect()]
    assert got == ["2026-02-05 22:59:59", "2026-07-05 21:59:59"]
    log = spark.createDataFrame([(1_768_000_000_000_000,), (None,)], "us bigint")
    ledger = spark.createDataFrame([("2025-12",)], "m string")
    assert [r["m"] for r in serving.overdue(log, "us", ledger, "m", 1_900_000_000_000_000).collect()] == ["2026-01"]


MERGE = """
import sys
sys.path.insert(0, {root!r})
from tidemark.session import build_session
from tidemark.sources.snapshot import SnapshotTable
spark = build_session("worker", master="local[2]", partitions=2)
SnapshotTable(spark, {at!r}, ["k"]).upsert(spark.createDataFrame([(1, "new"), (3, "c")], "k int, v string"))
"""
COMMIT = """
import sys
sys.path.insert(0, {root!r})
from tidemark.operators import compaction
from tidemark.session import build_session
spark = build_session("worker", master="local[2]", partitions=2)
compaction.compact(spark.createDataFrame([("e", "f")], "event_id string, file string"), "file", root={at!r})
"""


def _crash(code, point):
    return subprocess.run([sys.executable, "-c", code], env=os.environ | {"TIDEMARK_CRASH": point}, capture_output=True, timeout=240).returncode


def test_crash_amid_a_merge(spark, tmp_path):
    at = f"file://{tmp_path}/t"
    t = SnapshotTable(spark, at, ["k"])
    t.create(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"))
    assert _crash(MERGE.format(root=ROOT, at=at), "mid_merge") == 17
    assert t.versions() == [0] and rows(t.read()) == [(1, "a"), (2, "b")]
    t.upsert(spark.createDataFrame([(1, "new"), (3, "c")], "k int, v string"))
    assert rows(t.read()) == [(1, "new"), (2, "b"), (3, "c")]


def test_crash_before_a_commit(spark, tmp_path):
    from tidemark.operators import compaction

    at = f"file://{tmp_path}/c"
    assert _crash(COMMIT.format(root=ROOT, at=at), "before_close_marker") == 17
    with pytest.raises(FileNotFoundError):
        compaction.read_committed(spark, at)


def test_close_job(spark, tmp_path):
    from tidemark.operators import close_job

    figures = ["gross_cents", "returns_cents", "net_cents", "line_count"]
    ddl = "m string, gross_cents bigint, returns_cents bigint, net_cents bigint, line_count bigint"
    t = SnapshotTable(spark, f"file://{tmp_path}/l", ["m", "close_version"])
    t.create(spark.createDataFrame([], "m string, close_version int, gross_cents bigint, returns_cents bigint, net_cents bigint, line_count bigint"))
    first = spark.createDataFrame([("2026-01", 10, 1, 9, 2), ("2026-02", 5, 0, 5, 1)], ddl)
    got = close_job.run(first, t, ["m"], "close_version", figures)
    assert (got.branch, got.versions_written, got.ok) == ("recorded", 2, True)
    assert close_job.run(first, t, ["m"], "close_version", figures) == close_job.Status("nothing to record", 0)
    wrong = spark.createDataFrame([("2026-01", 10, 1, 8, 2)], ddl)
    got = close_job.run(wrong, t, ["m"], "close_version", figures)
    assert (got.versions_written, got.failed) == (1, {"net_is_gross_minus_returns": 1}) and t.read().count() == 3


def test_evidence_and_statistics(tmp_path):
    from tidemark.functions import statistics
    from tidemark.operators import evidence

    p = str(tmp_path / "chain.jsonl")
    evidence.append(p, {"a": 1})
    last = evidence.append(p, {"a": 2})
    assert evidence.verify(p) == last
    text = (tmp_path / "chain.jsonl").read_text()
    (tmp_path / "chain.jsonl").write_text(text.replace('"a": 1', '"a": 3'))
    with pytest.raises(ValueError, match="record 1"):
        evidence.verify(p)
    lo, hi = statistics.wilson(20, 20)
    assert 0.83 < lo < 0.85 and hi == 1.0 and statistics.wilson(0, 0) == (0.0, 1.0)
    assert abs(statistics.none_seen(20) - 0.1498) < 1e-4
    assert statistics.kappa([(1, 1), (0, 0), (1, 0), (0, 1)]) == 0 and math.isnan(statistics.kappa([])) and math.isnan(statistics.kappa([(1, 1), (1, 1)]))


SIGNED = "m string, close_version int, restated_at timestamp, gross_cents bigint, returns_cents bigint, net_cents bigint, line_count bigint"
STAMP = datetime.datetime(2026, 3, 5, tzinfo=datetime.timezone.utc)


def test_each_check_of_a_close_can_fail(spark):
    """One planted fault for each named check, and nulls that leave one undecided."""
    later = STAMP + datetime.timedelta(days=1)
    data = [
        ("2026-01", 0, STAMP, 9, 1, 8, 1), ("2026-01", 1, later, 9, 2, 7, 1), ("2025-01", 0, STAMP, 9, 1, 7, 1), ("2025-02", 1, STAMP, 9, 1, 8, 1), ("2025-03", 0, later, 9, 1, 8, 1), ("2025-03", 1, STAMP, 9, 1, 8, 1),
        ("2025-04", 0, STAMP, 9, 1, 8, 1), ("2026-03", 0, STAMP, 9, 1, 8, 1), ("2025-05", 0, STAMP, 9, 10, -1, 1), ("2025-06", 0, STAMP, 9, 1, 8, -1), ("2025-07", 0, STAMP, 9, None, 9, 1), ("2025-08", 0, STAMP, 9, 1, 8, 1), ("2025-08", 0, STAMP, 9, 1, 8, 2),
    ]
    ledger = spark.createDataFrame(data, SIGNED)
    figures = ["gross_cents", "returns_cents", "net_cents", "line_count"]
    source = ledger.where("m <> '2025-04'").groupBy("m").agg(*[F.max_by(f, F.struct("close_version", "restated_at", *figures)).alias(f) for f in figures])
    got = closes.verified(ledger, source, ["m"], "m", "close_version", figures)
    failed = {}
    for m, check in rows(got.where("not ok").select("m", "check_name")):
        failed.setdefault(m, set()).add(check)
    assert failed == {
        "2025-01": {"net_is_gross_minus_returns"}, "2025-02": {"versions_have_no_gaps"}, "2025-03": {"earlier_versions_are_older"}, "2025-04": {"written_equals_the_source"}, "2026-03": {"month_was_eligible_to_close"}, "2025-05": {"returns_within_gross"},
        "2025-06": {"no_negative_counts"}, "2025-07": {"net_is_gross_minus_returns", "returns_within_gross"}, "2025-08": {"versions_have_no_gaps"},
    }
    assert got.where("detail is null").count() == 0 and got.count() == 7 * 10


def test_months_in_progress_stay_open(spark, tmp_path):
    from tidemark.operators import close_job

    figures = ["gross_cents", "returns_cents", "net_cents", "line_count"]
    t = SnapshotTable(spark, f"file://{tmp_path}/l", ["m", "close_version"])
    t.create(spark.createDataFrame([], "m string, close_version int, gross_cents bigint, returns_cents bigint, net_cents bigint, line_count bigint, restated_at timestamp, restatement_reason string"))
    source = spark.createDataFrame([("2026-01", 10, 1, 9, 2), ("2026-02", 5, 0, 5, 1)], "m string, gross_cents bigint, returns_cents bigint, net_cents bigint, line_count bigint")
    at = lambda text: int(datetime.datetime.fromisoformat(text).timestamp() * 1_000_000)
    run = lambda s, when: close_job.run(s, t, ["m"], "close_version", figures, "m", at(when))
    assert run(source, "2026-02-28T22:59:59+00:00").versions_written == 1  # in Madrid February isn't over
    assert run(source, "2026-02-28T23:00:00+00:00").versions_written == 1
    assert run(source, "2026-03-02T00:00:00+00:00") == close_job.Status("nothing to record", 0)
    changed = source.withColumn("gross_cents", F.col("gross_cents") + 1).withColumn("net_cents", F.col("net_cents") + 1)
    got = run(changed, "2026-03-03T00:00:00+00:00")
    assert (got.versions_written, got.failed) == (2, {})
    assert rows(t.read().select("m", "close_version", "restatement_reason")) == [("2026-01", 0, "first close"), ("2026-01", 1, "late arrivals after close"), ("2026-02", 0, "first close"), ("2026-02", 1, "late arrivals after close")]
    assert run(changed.withColumn("net_cents", F.lit(0)), "2026-03-04T00:00:00+00:00").failed == {"net_is_gross_minus_returns": 2}


def test_money_and_restatement(spark):
    lines = spark.createDataFrame([("o", "s", 1_768_000_000_000_000, 3, 10), ("p", "s", 1_771_000_000_000_000, 1, 7)], "order_id string, sku string, sale_us bigint, qty bigint, unit_price_cents bigint")
    kept = spark.createDataFrame([("return_registered", "o", "s", 1_768_000_000_000_000, 2), ("return_registered", "o", "s", 1_767_000_000_000_000, 1), ("return_registered", "x", "s", 1_768_000_000_000_000, 1), ("order_placed", "o", "s", 1, 1)], "event_type string, order_id string, sku string, event_us bigint, qty bigint")
    assert rows(closes.money(lines, closes.returned(kept, lines)).select("accounting_month", "gross_cents", "returns_cents", "net_cents", "line_count", "return_count")) == [("2026-01", 30, 20, 10, 1, 1), ("2026-02", 7, 0, 7, 1, 0)]
    ledger = spark.createDataFrame([("a", 0, 1000), ("a", 1, 938), ("b", 0, -10), ("b", 1, -15), ("c", 0, 0), ("c", 1, 5), ("d", 0, 7)], "k string, v int, x bigint")
    got = closes.restatement(ledger, ["k"], "v", "x")
    assert rows(got.select("k", "delta", "delta_bp")) == [("a", -62, -620), ("b", -5, 5000), ("c", 5, None), ("d", 0, 0)]
    assert rows(closes.worst(got, ["k"]).select("k")) == [("a",)]


def test_schema_evolution(spark, tmp_path):
    """Fields nobody declared are kept aside, learnt and then columns; values a column can't hold and broken lines stay readable."""
    drop = tmp_path / "drop"
    drop.mkdir()
    lines = [json.dumps(SALE | {"shelf": "A7", "tags": [1, 2], "weight": 5}), '{"event_id": "broken', json.dumps(SALE | {"qty": "many", "weight": 2**70}), "", json.dumps(SALE)]
    (drop / "a.json").write_text("\n".join(lines))
    source, spec = bronze.INGESTORS["evolving"], bronze.IngestSpec(str(drop), options={"schema_log": f"file://{tmp_path}/log", "hints": "weight bigint"})
    first = source.read(spark, spec)
    got = [r[0] and (r[0] if r[0][:3] == '{"e' else json.loads(r[0])) for r in first.select(bronze.RESCUE).collect()]
    assert got == [{"shelf": "A7", "tags": "[1,2]"}, '{"event_id": "broken', {"qty": "many", "weight": str(2**70)}, None]
    assert source.evolve(spark, spec, first) == ["shelf", "tags"] and source.evolve(spark, spec, source.read(spark, spec)) == []
    second = source.read(spark, spec)
    assert rows(second.select("shelf", "tags", "weight", "qty")) == [("A7", "[1,2]", 5, 2), (None, None, None, 2), (None, None, None, None), (None, None, None, None)]
    assert second.where("_ingested_at is null").count() == 0
    ingest.append_stream(source.stream(spark, spec), f"{tmp_path}/out", f"{tmp_path}/c")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 4


def test_stream_from_a_table_of_the_catalog(spark, tmp_path):
    spark.range(5).selectExpr("id as k").write.mode("overwrite").option("path", f"{tmp_path}/t").saveAsTable("upstream_of_test")
    try:
        stream = bronze.INGESTORS["table"].stream(spark, bronze.IngestSpec("upstream_of_test"))
        ingest.append_stream(stream, f"{tmp_path}/out", f"{tmp_path}/c")
        assert spark.read.parquet(f"{tmp_path}/out").count() == 5
    finally:
        spark.sql("drop table upstream_of_test")


def test_alerts_and_breaches(spark):
    from tidemark.operators import serving

    details = '{"progress": {"state": "%s", "expectations": [{"name": "n", "dataset": "d", "passed_records": %d, "failed_records": 1}]}}'
    ddl = "run_id string, at int, level string, details string"
    log = spark.createDataFrame([("r1", 1, "INFO", details % ("FAILED", 5)), ("r2", 9, "INFO", details % ("COMPLETED", 2))], ddl)
    assert rows(run_log.alert(log)) == [(False, "r2", "COMPLETED")] and rows(run_log.alert(log.where("run_id = 'r1'"))) == [(True, "r1", "FAILED")]
    assert rows(run_log.alert(log.limit(0))) == [(True, None, None)]
    assert rows(run_log.last_run_expectations(log)) == [("r2", "d", "n", 2, 1)]
    ev = spark.createDataFrame([(1_768_000_000_000_000, 1_768_000_000_000_000)], "e bigint, a bigint")
    ledger = spark.createDataFrame([("2025-12",)], "m string")
    assert [r[:2] for r in rows(serving.breaches(ev, "e", "a", ledger, "m", 1_900_000_000_000_000, 15))] == [("close_overdue", "2026-01"), ("ingestion_lag", "log")]
    assert rows(serving.breaches(ev.limit(0), "e", "a", ledger, "m", 5, 15)) == [("no_data", "log", None)]
    assert rows(serving.breaches(ev, "e", "a", ledger, "m", 1_768_000_000_000_001, 15)) == []


def test_canonical_values_and_verdicts(spark):
    from decimal import Decimal

    from tidemark.operators import evidence

    assert quality.encoded(Decimal("1.50")) == quality.encoded(Decimal("1.5")) != quality.encoded(1.5)
    assert quality.encoded(Decimal("-0.0")) == quality.encoded(Decimal("0")) and quality.encoded(-0.0) == quality.encoded(0.0)
    for odd in (float("nan"), float("inf"), Decimal("NaN")):
        with pytest.raises(ValueError, match="canonical"):
            quality.encoded(odd)
    assert evidence.body_of(evidence.Pass("c", evidence.Rate(0, 20)))["interval"][1] == pytest.approx(0.1498, abs=1e-4)
    assert evidence.body_of(evidence.Fail("c", {"k": 1}))["ok"] is False
    with pytest.raises(ValueError, match="no trial"):
        evidence.body_of(evidence.Pass("c", evidence.Rate(0, 0)))
    df = spark.createDataFrame([("C1",), ("C1",), (None,)], "id string")
    assert governance.vault(df, "id", b"k").count() == 1
    with pytest.raises(ValueError, match="salt"):
        governance.pseudonym(F.col("id"), "")


def test_boundaries(spark, tmp_path):
    """Each border of the contract: reasons of its events, lines as of the close and in the end."""
    from tidemark.operators.kept import kept_copies
    from tidemark.plans.log_queries import PAYLOAD
    from tidemark.sources import fixtures

    close = datetime.datetime(2026, 2, 1, tzinfo=datetime.timezone.utc)
    cases = fixtures.write_boundaries(str(tmp_path), close)
    log = bronze.INGESTORS["jsonl"].read(spark, bronze.IngestSpec(str(tmp_path)))
    want = {e["event_id"]: r for c in cases for e, r in zip(c.events, c.reasons, strict=True)}
    assert {r["event_id"]: r["quarantine_reason"] for r in quarantine.classify(log).collect()} == want and len(cases) == 20

    def lines(rows_of):
        kept = kept_copies(rows_of, "event_id", instant_us(F.col("event_ts")), instant_us(F.col("arrival_ts")), PAYLOAD).where(quarantine.quarantine_reason() == "accepted")
        return {(r["order_id"], r["sku"]): r["qty"] for r in closes.effective_lines(kept).collect()}

    assert lines(bronze.as_of_cut(log, "2026-02-01T00:00:00Z")) == {k: v for c in cases for k, v in c.at_close.items()}
    assert lines(log) == {k: v for c in cases for k, v in c.in_the_end.items()}


def test_campaign(spark, drop, tmp_path):
    """Replays converge; a writer that appends is the control, which the campaign must find out."""
    from tidemark.functions.campaign import campaign

    code = lambda name, sound: WORKER.format(root=ROOT, drop=drop, out=f"{tmp_path}/{name}-{sound}", idempotent=sound)
    result = lambda name, sound: ingest.written(spark, f"{tmp_path}/{name}-{sound}").count()
    for sound, hits in ((True, 0), (False, 1)):
        got = campaign(["after_write:2"], 1, lambda n: code(n, sound), lambda n: result(n, sound), 21)  # noqa: B023
        assert (got.rate().hits, got.rate("after_write:2").n) == (hits, 1)


def test_changes_replayed(spark, tmp_path):
    """A stream of changes that starts again from the begin leaves the history as it was."""
    from tidemark.operators import satellites
    from tidemark.streaming import cdc

    df = spark.createDataFrame([("c", 1, "a"), ("c", 5, "b"), ("d", 2, None), (None, 3, "x")], "k string, at bigint, v string")
    df.repartition(2).write.parquet(f"{tmp_path}/drop")
    store = satellites.SatelliteStore(spark, f"file://{tmp_path}/s", "k", [["v"]])
    for i in range(2):
        stream = bronze.INGESTORS["parquet"].stream(spark, bronze.IngestSpec(f"{tmp_path}/drop", files_per_trigger=1))
        cdc.follow(stream, store, F.col("at"), F.col("v"), f"{tmp_path}/c{i}")
        assert rows(store.history()) == [("c", 1, 5, "a"), ("c", 5, None, "b"), ("d", 2, None, None)]


def test_command_line(tmp_path, capsys):
    from tidemark import cli

    assert cli.main(["doctor"]) == 0 and "java: there" in capsys.readouterr().out
    assert cli.main(["generate", str(tmp_path / "log"), "--orders", "20", "--boundaries"]) == 0 and "20 boundary cases" in capsys.readouterr().out
    assert cli.main(["evidence", str(tmp_path / "chain"), "--claim", "x"]) == 0 and cli.main(["evidence", str(tmp_path / "chain")]) == 0
    first, again = capsys.readouterr().out.split()
    assert first == again


def test_mutants_of_rules_are_noticed():
    """Small faults of the SQL that queries are held against change its rows on the test tables."""
    duckdb = pytest.importorskip("duckdb")
    from tidemark.functions import mutants
    from tidemark.plans.log_queries import SQL
    from tidemark.plans.training_sql import P2, P4, P6

    def witness(sf):
        con = duckdb.connect()
        con.execute("SET TimeZone='UTC'; SET threads=2")
        for t in ("bronze_events", "customer_updates", "close_calendar", "close_month"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/{sf}/{t}.parquet')")
        return lambda sql: sorted(map(repr, con.execute(sql).fetchall()))

    scores = {}
    for name, sql in (("p2", P2), ("p4", P4), ("p6", P6), ("reasons", SQL["quarantine_by_reason"]), ("versions", SQL["current_versions"])):
        run = witness("sf0.001")
        scores[name] = mutants.score(mutants.mutants(sql), run, run(sql))
    assert {n: len(s.killed) > 0 for n, s in scores.items()} == dict.fromkeys(scores, True)
    killed, survived = (sum(len(getattr(s, k)) for s in scores.values()) for k in ("killed", "survived"))
    assert killed / (killed + survived) > 0.6
    run = witness("sf0.01")  # a second witness: ten times the rows tell more mutants apart, never fewer kinds
    wider = mutants.score(mutants.mutants(P2), run, run(P2))
    assert wider.rate() >= scores["p2"].rate() and mutants.agreement(scores["p2"], scores["p2"]) == 1
    assert mutants.mutants("SELECT 'a <= 1' AS x") == [] and {m.fault for m in mutants.mutants("SELECT sum(x) FROM t WHERE a <= 5 ORDER BY b DESC")} == {"aggregate", "comparison", "number", "order"}
