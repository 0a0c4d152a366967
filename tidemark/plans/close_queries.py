"""Queries of closes, their verification, populations, layout claims and streams, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.hashing import ordered_fingerprint, payload_digest
from tidemark.functions.times import accounting_month, instant_us, utc_text
from tidemark.operators import closes, compaction, layout, quarantine, run_log, satellites, serving
from tidemark.plans.log_queries import AS_OF, CLASSIFIED, FIGURES, LEDGER, LINES, SHOP, SILVER, _run_log, events, ledger, silver
from tidemark.plans.training_data import _versions_of, table
from tidemark.plans.training_sql import P2, _kept, _ts
from tidemark.session import FRESHNESS_SLA_MINUTES, MAX_LINE_QUANTITY, MAX_UNIT_PRICE_CENTS, scratch
from tidemark.sources import bronze
from tidemark.sources.snapshot import SnapshotTable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
#: AS_OF in microseconds, and an instant long after all months.
AS_OF_US, NOW_US = 1_788_213_600_000_000, 1_808_400_000_000_000


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# --- money of a close ---

_MONTH = "strftime({} AT TIME ZONE 'Europe/Madrid', '%Y-%m')"
MONEY = f"""{LINES}, back AS (SELECT l.ev, s.qty * l.unit_price_cents AS cents FROM silver s JOIN lines l USING (order_id, sku)
 WHERE s.event_type = 'return_registered' AND s.ev >= l.ev),
both_ AS (SELECT {_MONTH.format("ev")} AS accounting_month, qty * unit_price_cents AS gross, 0 AS back, 1 AS l, 0 AS r FROM lines
 UNION ALL SELECT {_MONTH.format("ev")}, 0, cents, 0, 1 FROM back),
money AS (SELECT accounting_month, CAST(sum(gross) AS BIGINT) AS gross_cents, CAST(sum(back) AS BIGINT) AS returns_cents,
 CAST(sum(gross) - sum(back) AS BIGINT) AS net_cents, CAST(sum(l) AS BIGINT) AS line_count, CAST(sum(r) AS BIGINT) AS return_count FROM both_ GROUP BY 1)"""


def _money(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = silver(spark, sf_dir)
    lines = closes.effective_lines(kept)
    return closes.money(lines, closes.returned(kept, lines))


@query(f"WITH {MONEY} SELECT * FROM money")
def close_money(spark, sf_dir):
    """Gross, returns and net of each month of sale."""
    return _money(spark, sf_dir)


@query(f"WITH {MONEY} SELECT accounting_month, net_cents FROM money")
def stored_monthly_view(spark, sf_dir):
    """The monthly view as it is stored: computed, published in one commit, and read back."""
    view = SnapshotTable(spark, scratch(spark, "view"), ["accounting_month"], ["accounting_month"])
    view.replace(_money(spark, sf_dir))
    return view.read().select("accounting_month", "net_cents")


RESTATED = """restated AS (SELECT shop_id, accounting_month, arg_min(net_cents, close_version) AS first_value, arg_max(net_cents, close_version) AS last_value
 FROM ledger GROUP BY 1, 2),
bp AS (SELECT *, last_value - first_value AS delta, CASE WHEN first_value = 0 THEN NULL ELSE
 CAST(sign(last_value - first_value) * sign(first_value) * (abs(last_value - first_value) * 10000 // abs(first_value)) AS BIGINT) END AS delta_bp
 FROM restated)"""


@query(f"WITH {LEDGER}, {RESTATED} SELECT * FROM bp")
def restatement_percent(spark, sf_dir):
    """How far each signed month moved from its first to its last version, in hundredths of a percent."""
    return closes.restatement(ledger(spark, sf_dir), SHOP, "close_version", "net_cents")


@query(f"""WITH {LEDGER}, {RESTATED} SELECT shop_id, accounting_month, delta_bp
 FROM bp
 WHERE delta_bp IS NOT NULL
 ORDER BY delta_bp, shop_id NULLS FIRST, accounting_month NULLS FIRST LIMIT 1""")
def worst_restatement(spark, sf_dir):
    return closes.worst(closes.restatement(ledger(spark, sf_dir), SHOP, "close_version", "net_cents"), SHOP).select(*SHOP, "delta_bp")


@query(f"""WITH {LEDGER} SELECT shop_id, accounting_month, close_version FROM ledger
 WINDOW w AS (PARTITION BY shop_id, accounting_month ORDER BY close_version) QUALIFY lag(net_cents) OVER w > net_cents""")
def restated_downwards(spark, sf_dir):
    """Versions whose net is below that of the version before."""
    moved = closes.movement(ledger(spark, sf_dir), SHOP, "close_version", ["net_cents"])
    return moved.where(F.col("moved_net_cents") < 0).select(*SHOP, "close_version")


# --- recording and verifying a close ---

_CHANGED = " OR ".join(f"s.{f} IS DISTINCT FROM o.{f}" for f in FIGURES)
RECORDED = f"""{LEDGER}, old AS (SELECT * FROM ledger WHERE close_version = 0 AND shop_id <> 'SH0000002'),
src AS (SELECT * EXCLUDE (close_version) FROM ledger QUALIFY row_number() OVER (PARTITION BY shop_id, accounting_month ORDER BY close_version DESC) = 1),
rec AS (SELECT s.shop_id, s.accounting_month, CAST(coalesce(o.close_version + 1, 0) AS INTEGER) AS close_version, {", ".join("s." + f for f in FIGURES)},
 CASE WHEN o.close_version IS NULL THEN 'first close' ELSE 'late arrivals after close' END AS restatement_reason
 FROM src s LEFT JOIN old o USING (shop_id, accounting_month) WHERE s.accounting_month < '2026-09' AND (o.close_version IS NULL OR {_CHANGED}))"""


@query(f"WITH {RECORDED} SELECT * FROM rec")
def close_recorded(spark, sf_dir):
    """What a close on 2026-08-31T22:00Z, the first of September in Madrid, records: no month in progress."""
    full = ledger(spark, sf_dir)
    old = full.where((F.col("close_version") == 0) & (F.col("shop_id") != "SH0000002"))
    now = closes.current_versions(full, SHOP, "close_version", FIGURES).drop("close_version")
    return closes.to_record(now, old, SHOP, "close_version", FIGURES, "accounting_month", AS_OF_US).drop("restated_at")


SIGNED = "signed AS (SELECT DISTINCT shop_id, accounting_month, close_version, restated_at, " + ", ".join(FIGURES) + " FROM close_month)"
_SAME = " AND ".join(f"n.{f} IS NOT DISTINCT FROM s.{f}" for f in FIGURES)
VERIFIED = f"""{SIGNED}, {LEDGER}, src AS (SELECT shop_id, accounting_month, {", ".join(f"min({f}) AS {f}" for f in FIGURES)} FROM ledger
 WHERE close_version = 0 GROUP BY 1, 2),
n AS (SELECT * FROM signed QUALIFY row_number() OVER (PARTITION BY shop_id, accounting_month
 ORDER BY close_version DESC NULLS LAST, restated_at DESC NULLS LAST,
 {", ".join(f"{f} DESC NULLS LAST" for f in FIGURES)}) = 1),
p AS (SELECT shop_id, accounting_month, count(*) AS k, count(DISTINCT close_version) AS d, max(close_version) AS hi, min(close_version) AS lo, min(line_count) AS lc
 FROM signed GROUP BY 1, 2),
e AS (SELECT shop_id, accounting_month, max(s.restated_at) AS earlier FROM signed s JOIN p USING (shop_id, accounting_month)
 WHERE s.close_version < p.hi GROUP BY 1, 2),
j AS (SELECT n.*, p.k, p.d, p.hi, p.lo, p.lc, e.earlier, s.shop_id IS NOT NULL AS has_source, {_SAME} AS same FROM n
 JOIN p USING (shop_id, accounting_month) LEFT JOIN e USING (shop_id, accounting_month) LEFT
 JOIN src s ON s.shop_id = n.shop_id AND s.accounting_month = n.accounting_month),
v AS (SELECT shop_id, accounting_month, unnest([
 {{'c': 'net_is_gross_minus_returns', 'ok': net_cents = gross_cents - returns_cents}}, {{'c': 'versions_have_no_gaps', 'ok': k = hi + 1 AND d = k AND lo = 0}},
 {{'c': 'earlier_versions_are_older', 'ok': CASE WHEN earlier IS NULL THEN true ELSE earlier < restated_at END}}, {{'c': 'written_equals_the_source', 'ok': has_source AND same}},
 {{'c': 'month_was_eligible_to_close', 'ok': {_MONTH.format("(restated_at AT TIME ZONE 'UTC')")} > accounting_month}}, {{'c': 'returns_within_gross', 'ok': returns_cents <= gross_cents}},
 {{'c': 'no_negative_counts', 'ok': lc >= 0}}]) AS x FROM j)"""


def _verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    signed = table(spark, sf_dir, "close_month").select(*SHOP, "close_version", "restated_at", *FIGURES).distinct()
    source = ledger(spark, sf_dir).where(F.col("close_version") == 0).groupBy(*SHOP).agg(*[F.min(f).alias(f) for f in FIGURES])
    return closes.verified(signed, source, SHOP, "accounting_month", "close_version", FIGURES)


@query(f"""WITH {VERIFIED} SELECT x.c AS check_name, count(*) AS closes, count(*) FILTER (NOT coalesce(x.ok, false)) AS failed
 FROM v
 WHERE shop_id IS NOT NULL AND accounting_month IS NOT NULL
 GROUP BY 1""")
def close_verification(spark, sf_dir):
    """The seven named checks of every signed close, the first versions standing in for the source."""
    v = _verified(spark, sf_dir).where(F.col("shop_id").isNotNull() & F.col("accounting_month").isNotNull())
    return v.groupBy("check_name").agg(F.count("*").alias("closes"), F.count_if(~F.col("ok")).alias("failed"))


@query(f"""WITH {VERIFIED} SELECT n.shop_id, n.accounting_month, 'written gross ' || coalesce(CAST(n.gross_cents AS VARCHAR), 'null') || ', source gross ' || coalesce(CAST(s.gross_cents AS VARCHAR), 'null') AS detail
 FROM n LEFT JOIN src s ON s.shop_id = n.shop_id AND s.accounting_month = n.accounting_month
 WHERE n.shop_id IS NOT NULL AND n.accounting_month IS NOT NULL AND NOT (s.shop_id IS NOT NULL
 AND {_SAME})""")
def close_drift_details(spark, sf_dir):
    """Closes that no longer equal the source, with the numbers that decided it."""
    v = _verified(spark, sf_dir).where((F.col("check_name") == "written_equals_the_source") & ~F.col("ok"))
    return v.where(F.col("shop_id").isNotNull() & F.col("accounting_month").isNotNull()).select(*SHOP, "detail")


@query(f"""WITH {LEDGER} SELECT shop_id, accounting_month, close_version
 FROM ledger
 WHERE gross_cents > line_count * {MAX_LINE_QUANTITY * MAX_UNIT_PRICE_CENTS}""")
def beyond_the_ceiling(spark, sf_dir):
    """Closes with more money than their lines can hold under the contract's bounds."""
    most = F.col("line_count") * quarantine.bound(MAX_LINE_QUANTITY) * quarantine.bound(MAX_UNIT_PRICE_CENTS)
    return ledger(spark, sf_dir).where(F.col("gross_cents") > most).select(*SHOP, "close_version")


# --- populations ---

_PARTS = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in bronze.COLUMNS)
_COVERED = "event_id IS NOT NULL AND arrival_ts IS NOT NULL"


@query(f"""WITH l AS (SELECT sha256(array_to_string([{_PARTS}], chr(31))) AS d FROM bronze_events WHERE {_COVERED}), g AS (SELECT d,
 count(*) AS c FROM l GROUP BY 1),
p AS (SELECT substr(d, 1, 3) AS p, sha256(string_agg(d || ':' || c, chr(10) ORDER BY d || ':' || c)) AS d, sum(c) AS n FROM g GROUP BY 1)
SELECT sha256(string_agg(p || ':' || d, chr(10) ORDER BY p || ':' || d)) AS digest, CAST(sum(n) AS BIGINT) AS digest_rows, (SELECT
 count(*) FROM bronze_events WHERE NOT ({_COVERED})) AS rows_outside FROM p""")
def event_population(spark, sf_dir):
    """Digest over all payload columns of the rows that have an id and an arrival, and how many rows it doesn't cover."""
    df = events(spark, sf_dir)
    covered = F.col("event_id").isNotNull() & F.col("arrival_ts").isNotNull()
    text = df.where(covered).select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in bronze.COLUMNS])
    outside = df.where(~covered).count()
    d = ordered_fingerprint(text, bronze.COLUMNS)
    return d.select("digest", F.col("row_count").alias("digest_rows"), F.lit(outside).cast("bigint").alias("rows_outside"))


@query(f"""WITH {SILVER} SELECT count(*) AS n_rows, count(DISTINCT sha256(array_to_string([{', '.join(f'coalesce(CAST({c} AS VARCHAR), chr(0))' for c in ('event_type', 'order_id', 'sku', 'qty'))}], chr(31)))) AS payloads
 FROM silver""")
def silver_payloads(spark, sf_dir):
    """Rows of silver, and different payloads by their digests."""
    rows = silver(spark, sf_dir).select(payload_digest([F.col(c) for c in ("event_type", "order_id", "sku", "qty")]).alias("d"))
    return rows.agg(F.count("*").alias("n_rows"), F.count_distinct("d").alias("payloads"))


@query(f"""WITH {_kept('event_type')} SELECT {_MONTH.format('ev')} AS accounting_month, event_type, count(*) AS n
 FROM kept
 WHERE ev IS NOT NULL AND event_id NOT IN (SELECT event_id
 FROM bronze_events
 WHERE event_id IS NOT NULL AND {_ts('arrival_ts')} <= TIMESTAMPTZ '2026-08-31 22:00:00+00')
 GROUP BY 1, 2""")
def late_population(spark, sf_dir):
    """Messages that nothing had arrived of by the as-of instant, by month and type of their kept copy."""
    from tidemark.operators.kept import kept_copies

    df = events(spark, sf_dir)
    base = bronze.as_of_cut(df, AS_OF).select("event_id")
    kept = kept_copies(df, "event_id", instant_us(F.col("event_ts")), instant_us(F.col("arrival_ts")), ["event_type"])
    late = kept.join(base, "event_id", "left_anti").where(F.col("event_us").isNotNull())
    return late.groupBy(accounting_month(F.timestamp_micros("event_us")).alias("accounting_month"), "event_type").agg(F.count("*").alias("n"))


TABLES = ["bronze_events", "close_month", "close_month_copy", "customer_updates", "dim_customer_scd2", "landing_lines"]


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in TABLES))
def table_row_counts(spark, sf_dir):
    out = None
    for t in TABLES:
        part = table(spark, sf_dir, t).agg(F.count("*").alias("n")).select(F.lit(t).alias("table_name"), "n")
        out = part if out is None else out.unionByName(part)
    return out


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, CASE typeof({c}) WHEN 'VARCHAR' THEN 'string' ELSE lower(typeof({c})) END AS type_name, count(*) AS n FROM bronze_events GROUP BY ALL" for c in ("event_id", "event_ts", "qty", "unit_price_cents")))
def type_audit(spark, sf_dir):
    """Types that columns really have when the query runs."""
    df, out = events(spark, sf_dir), None
    for c in ("event_id", "event_ts", "qty", "unit_price_cents"):
        part = df.groupBy(F.lit(c).alias("column_name"), F.typeof(c).alias("type_name")).agg(F.count("*").alias("n"))
        out = part if out is None else out.unionByName(part)
    return out


# --- runs and freshness ---


@query(f"""WITH ar AS (SELECT max({_ts("arrival_ts")}) AS newest FROM bronze_events), m AS (SELECT DISTINCT {_MONTH.format(_ts("event_ts"))} AS m
 FROM bronze_events WHERE {_ts("event_ts")} IS NOT NULL),
due AS (SELECT m, CAST(m || '-05 23:59:59' AS TIMESTAMP) + INTERVAL 1 MONTH AS local_at FROM m),
o AS (SELECT m, CAST((1808400000000000 - epoch_us(local_at AT TIME ZONE 'Europe/Madrid')) // 1000000 AS BIGINT) AS lag_seconds
 FROM due WHERE epoch_us(local_at AT TIME ZONE 'Europe/Madrid') < 1808400000000000 AND m NOT IN (SELECT accounting_month
 FROM close_calendar))
SELECT CASE WHEN newest IS NULL THEN 'no_data' ELSE 'ingestion_lag' END AS breach, 'log' AS subject,
 CAST((1808400000000000 - epoch_us(newest)) // 1000000 AS BIGINT) AS lag_seconds FROM ar WHERE newest IS NULL
 OR (1808400000000000 - epoch_us(newest)) // 1000000 > 900
UNION ALL SELECT 'close_overdue', m, lag_seconds FROM o""")
def freshness_breaches(spark, sf_dir):
    """All breaches at one instant: of the log's freshness and of months without a close past their deadline."""
    log = events(spark, sf_dir).select(instant_us(F.col("event_ts")).alias("event_us"), instant_us(F.col("arrival_ts")).alias("arrival_us"))
    return serving.breaches(log, "event_us", "arrival_us", table(spark, sf_dir, "close_calendar"), "accounting_month", NOW_US, FRESHNESS_SLA_MINUTES)


_LAST = "WITH l AS (SELECT ingest_file AS run_id, listed_at AT TIME ZONE 'UTC' AS t, row_count FROM landing_files WHERE listed_at IS NOT NULL), last AS (SELECT run_id FROM l GROUP BY 1 ORDER BY max(t) DESC, run_id LIMIT 1)"


@query(f"""{_LAST} SELECT run_id, 'landing' AS dataset, 'has_rows' AS name, CAST(sum(coalesce(row_count, 0)) AS BIGINT) AS passed_records,
 count(*) FILTER (row_count IS NULL) AS failed_records
 FROM l
 JOIN last USING (run_id)
 GROUP BY 1""")
def last_run_expectations(spark, sf_dir):
    return run_log.last_run_expectations(_run_log(spark, sf_dir))


@query(f"""{_LAST} SELECT NOT (arg_max(row_count IS NOT NULL, t) AND count(*) FILTER (row_count IS NULL) = 0) AS alert, run_id
 FROM l
 JOIN last USING (run_id)
 GROUP BY run_id""")
def last_run_alert(spark, sf_dir):
    """Whether the last run asks for attention."""
    return run_log.alert(_run_log(spark, sf_dir)).select("alert", "run_id")


# --- layout ---


@query(f"SELECT strftime({_ts('event_ts')} AT TIME ZONE 'UTC', '%Y-%m') AS month, count(*) AS n FROM bronze_events GROUP BY 1")
def partitioned_write(spark, sf_dir):
    """The log written in folders by month, and counted by folder; rows without a readable time have a folder too."""
    at = scratch(spark, "by-month")
    month = F.substring(utc_text(instant_us(F.col("event_ts"))), 1, 7)
    df = events(spark, sf_dir).select("event_id", "sku", month.alias("month"))
    df.repartition("month", F.pmod(F.xxhash64("event_id"), F.lit(4))).write.partitionBy("month").parquet(at)
    return spark.read.schema("event_id string, sku string, month string").parquet(at).groupBy("month").agg(F.count("*").alias("n"))


@query()
def layout_lab(spark, sf_dir):
    """(claim, before, after): files before and after compaction, files that a predicate on sku reads before and after
    clustering, folders that one on the month reads, and rows copied for each row that a delete of a month removes."""
    df = events(spark, sf_dir).withColumn("month", F.substring(utc_text(instant_us(F.col("event_ts"))), 1, 7))
    slim, rows = df.select("event_id", "month", "sku", F.pmod(F.xxhash64("sku"), F.lit(1 << 16)).alias("sku_no")), []
    done = compaction.compact(events(spark, sf_dir), "ingest_file")
    rows.append(("files before and after compaction", done.manifest().count(), layout.file_stats(done.rows_read(), []).count()))
    at = scratch(spark, "lab")
    slim.repartition(16).write.parquet(f"{at}/plain")
    slim.repartitionByRange(16, "sku_no", "event_id").sortWithinPartitions("sku_no").write.parquet(f"{at}/clustered")
    probe = slim.where("sku_no is not null").agg(F.min("sku_no")).first()[0]
    read = [layout.not_skippable(layout.file_stats(spark.read.parquet(f"{at}/{n}"), ["sku_no"]), "sku_no", probe).first()["files_read"] for n in ("plain", "clustered")]
    rows.append(("files a sku's rows are sought in", *read))
    slim.repartition("month").write.partitionBy("month").parquet(f"{at}/by-month")
    months = layout.file_stats(spark.read.parquet(f"{at}/by-month"), ["month"])
    one = months.agg(F.max("max_month")).first()[0]
    rows.append(("files a month's rows are sought in", months.count(), layout.not_skippable(months, "month", one).first()["files_read"]))
    t = SnapshotTable(spark, f"{at}/table", [])
    t.create(slim.repartition(16))
    t.delete(F.col("month") == one)
    rows.append(("rows deleted and rows copied", t.manifest()["metrics"]["rows_deleted"], t.manifest()["metrics"]["rows_copied"]))
    return spark.createDataFrame(rows, "claim string, before bigint, after bigint")


# --- streams ---


@query("""SELECT 'shelf' AS field, count(*) AS n
 FROM bronze_events
 WHERE ingest_file IS NOT NULL
 UNION ALL SELECT 'event_id', count(event_id)
 FROM bronze_events""")
def stream_schema_evolution(spark, sf_dir):
    """The log with a field nobody declared, taken in by two streams: the first keeps it aside and learns its name, the
    second, from the start again, has it as a column."""
    from tidemark.streaming import ingest

    at = scratch(spark, "evolving")
    events(spark, sf_dir).select(*bronze.COLUMNS, F.col("ingest_file").alias("shelf")).repartition(3).write.json(f"{at}/drop")
    source, spec = bronze.INGESTORS["evolving"], bronze.IngestSpec(f"{at}/drop", options={"schema_log": f"{at}/schema"})
    ingest.append_stream(source.stream(spark, spec), f"{at}/first", f"{at}/c1")
    source.evolve(spark, spec, spark.read.parquet(f"{at}/first"))
    ingest.append_stream(source.stream(spark, spec), f"{at}/second", f"{at}/c2")
    got = spark.read.parquet(f"{at}/second")
    return got.agg(F.count("shelf").alias("s"), F.count("event_id").alias("e")).selectExpr("stack(2, 'shelf', s, 'event_id', e) as (field, n)")


@query(P2)
def stream_history(spark, sf_dir):
    """The history of customers kept up by a stream of their updates, fed through a view."""
    from tidemark.streaming import cdc

    at = scratch(spark, "cdc")
    table(spark, sf_dir, "customer_updates").repartition(3).write.parquet(f"{at}/drop")
    bronze.INGESTORS["parquet"].stream(spark, bronze.IngestSpec(f"{at}/drop", files_per_trigger=1)).createOrReplaceTempView("customer_changes")
    store = satellites.SatelliteStore(spark, f"{at}/store", "customer_id", [["segment"], ["country"]])
    cdc.follow(spark.table("customer_changes"), store, instant_us(F.col("valid_from")), F.col("event_id"), f"{at}/c")
    return _versions_of(store.history())


@query(f"WITH {CLASSIFIED} SELECT event_type, count(*) AS n FROM classified WHERE quarantine_reason = 'accepted' GROUP BY 1")
def stream_from_table(spark, sf_dir):
    """A second stream whose source is the table that a first one wrote."""
    from tidemark.streaming import ingest

    at = scratch(spark, "chained")
    events(spark, sf_dir).select(*bronze.COLUMNS, bronze.RESCUE).repartition(2).write.parquet(f"{at}/drop")
    ingest.append_stream(bronze.INGESTORS["parquet"].stream(spark, bronze.IngestSpec(f"{at}/drop")), f"{at}/bronze", f"{at}/c1")
    upstream = bronze.INGESTORS["table"].stream(spark, bronze.IngestSpec(f"{at}/bronze"))
    accepted = upstream.where(quarantine.quarantine_reason() == quarantine.ACCEPTED)
    ingest.append_stream(accepted, f"{at}/silver", f"{at}/c2")
    return spark.read.parquet(f"{at}/silver").groupBy("event_type").agg(F.count("*").alias("n"))
