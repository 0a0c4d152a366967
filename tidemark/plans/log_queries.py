"""Queries of the engine's own operators over the driver's tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.hashing import ordered_fingerprint, text_fingerprint
from tidemark.functions.times import accounting_month, instant, instant_us, utc_text
from tidemark.operators import closes, governance, layout, quality, quarantine, run_log, satellites
from tidemark.operators.kept import kept_copies
from tidemark.plans.training_data import table
from tidemark.plans.training_sql import _kept, _ts, _utc
from tidemark.session import FRESHNESS_SLA_MINUTES, scratch
from tidemark.sources import bronze
from tidemark.sources.snapshot import SnapshotTable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
AS_OF = "2026-08-31T22:00:00Z"
SHOP = ["shop_id", "accounting_month"]
FIGURES = ["gross_cents", "returns_cents", "net_cents", "line_count", "return_count", "returns_rejected_count"]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "bronze_events")


# --- scan, cut, classification ---


@query("SELECT event_type, count(*) AS n, count(event_id) AS with_id, count(DISTINCT ingest_file) AS files FROM bronze_events GROUP BY 1")
def bronze_scan_counts(spark, sf_dir):
    return events(spark, sf_dir).groupBy("event_type").agg(F.count("*").alias("n"), F.count("event_id").alias("with_id"), F.count_distinct("ingest_file").alias("files"))


@query(f"SELECT event_type, count(*) AS n FROM bronze_events WHERE {_ts('arrival_ts')} <= TIMESTAMPTZ '2026-08-31 22:00:00+00' GROUP BY 1")
def as_of_cut(spark, sf_dir):
    return bronze.as_of_cut(events(spark, sf_dir), AS_OF).groupBy("event_type").agg(F.count("*").alias("n"))


QUANTITY = "CASE WHEN event_type IN ('order_placed', 'return_registered') THEN qty WHEN event_type = 'order_line_amended' THEN new_qty ELSE 1 END"
FAULTS = {
    "unparseable_json": "event_id IS NULL",
    "unknown_event_type": "event_type IS NULL OR event_type NOT IN ('order_placed', 'order_line_amended', 'return_registered', 'customer_upserted')",
    "missing_required_field": f"{_ts('event_ts')} IS NULL OR {_ts('arrival_ts')} IS NULL OR (event_type = 'order_placed' AND (order_id IS NULL OR sku IS NULL OR customer_id IS NULL OR qty IS NULL OR unit_price_cents IS NULL OR currency IS NULL))"
    " OR (event_type = 'order_line_amended' AND (order_id IS NULL OR sku IS NULL OR new_qty IS NULL)) OR (event_type = 'return_registered' AND (order_id IS NULL OR sku IS NULL OR qty IS NULL)) OR (event_type = 'customer_upserted' AND customer_id IS NULL)",
    "non_positive_quantity": f"{QUANTITY} < 1",
    "negative_price": "event_type = 'order_placed' AND unit_price_cents < 0",
    "unknown_currency": "event_type = 'order_placed' AND currency <> 'EUR'",
    "amount_out_of_range": f"{QUANTITY} > 10000 OR (event_type = 'order_placed' AND unit_price_cents > 1000000)",
}
REASON = "CASE " + " ".join(f"WHEN coalesce({c}, true) THEN '{n}'" for n, c in FAULTS.items()) + " ELSE 'accepted' END"
CLASSIFIED = f"classified AS (SELECT *, {REASON} AS quarantine_reason FROM bronze_events)"


@query(f"WITH {CLASSIFIED} SELECT quarantine_reason, count(*) AS n FROM classified GROUP BY 1")
def quarantine_by_reason(spark, sf_dir):
    return quarantine.classify(events(spark, sf_dir)).groupBy("quarantine_reason").agg(F.count("*").alias("n"))


@query(f"""WITH {CLASSIFIED} SELECT event_type, count(*) FILTER (quarantine_reason = 'accepted') AS accepted,
 count(*) FILTER (quarantine_reason <> 'accepted') AS quarantined
 FROM classified
 GROUP BY 1""")
def accepted_split(spark, sf_dir):
    df = quarantine.classify(events(spark, sf_dir))
    return df.groupBy("event_type").agg(F.count_if(F.col("quarantine_reason") == "accepted").alias("accepted"), F.count_if(F.col("quarantine_reason") != "accepted").alias("quarantined"))


@query(" UNION ALL ".join(f"SELECT '{n}' AS rule, count(*) FILTER (NOT coalesce({c}, true)) AS passed, count(*) FILTER (coalesce({c}, true)) AS failed FROM bronze_events" for n, c in FAULTS.items()))
def rule_pass_fail(spark, sf_dir):
    return quarantine.rule_counts(events(spark, sf_dir))


_DECIDING = " ".join(f"WHEN ({c}) IS NULL THEN '{n}' WHEN {c} THEN NULL" for n, c in FAULTS.items())


@query(f"""SELECT rule, n FROM (SELECT CASE {_DECIDING} END AS rule, count(*) AS n FROM bronze_events GROUP BY 1)
 WHERE rule IS NOT NULL""")
def undecided_rules(spark, sf_dir):
    return events(spark, sf_dir).groupBy(quarantine.undecided_rule().alias("rule")).agg(F.count("*").alias("n")).where(F.col("rule").isNotNull())


_UNGUARDED = " ".join(f"WHEN ({c}) IS NULL THEN '{n}' WHEN {c} THEN NULL" for n, c in FAULTS.items() if n != "missing_required_field")


@query(f"""SELECT rule, n FROM (SELECT CASE {_UNGUARDED} END AS rule, count(*) AS n FROM bronze_events GROUP BY 1)
 WHERE rule IS NOT NULL""")
def undecided_without_presence_rule(spark, sf_dir):
    """Rules that nulls leave undecided once nothing asks for the fields' presence before them."""
    of = [r for r in quarantine.rules() if r[0] != "missing_required_field"]
    return events(spark, sf_dir).groupBy(quarantine.undecided_rule(of).alias("rule")).agg(F.count("*").alias("n")).where(F.col("rule").isNotNull())


@query(f"""WITH {CLASSIFIED}, per AS (SELECT event_id, count(*) n, count(*) FILTER (quarantine_reason = 'accepted') ok, count(_rescued_data) rs
 FROM classified
 GROUP BY 1) SELECT CAST(sum(n) AS BIGINT) AS delivered, CAST(coalesce(sum(n) FILTER (event_id IS NULL), 0) AS BIGINT) AS without_id,
 count(event_id) AS distinct_ids, CAST(sum(n - 1) FILTER (event_id IS NOT NULL) AS BIGINT) AS repeated,
 CAST(sum(ok) AS BIGINT) AS accepted, CAST(sum(n - ok) AS BIGINT) AS quarantined, CAST(sum(rs) AS BIGINT) AS rescued
 FROM per""")
def row_accounting(spark, sf_dir):
    return quality.row_accounting(quarantine.classify(events(spark, sf_dir)))


# --- silver: kept copies, then accepted ones ---

PAYLOAD = ["event_type", "event_ts", "arrival_ts", "order_id", "customer_id", "sku", "qty", "new_qty", "unit_price_cents", "currency", "segment", "country"]
SILVER = f"""{_kept(", ".join(f"{c} ASC NULLS LAST" for c in PAYLOAD))}, silver AS (SELECT * FROM (SELECT *, {REASON} AS quarantine_reason FROM kept) WHERE quarantine_reason = 'accepted')"""


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept copies first, accepted ones of them then: a refused copy that ranks first hides an accepted one."""
    kept = kept_copies(events(spark, sf_dir), "event_id", instant_us(F.col("event_ts")), instant_us(F.col("arrival_ts")), PAYLOAD)
    return kept.where(quarantine.quarantine_reason() == "accepted")


@query(f"WITH {SILVER} SELECT event_type, count(*) AS n, CAST(sum(coalesce(qty, 0)) AS BIGINT) AS units FROM silver GROUP BY 1")
def silver_events(spark, sf_dir):
    return silver(spark, sf_dir).groupBy("event_type").agg(F.count("*").alias("n"), F.sum(F.coalesce("qty", F.lit(0))).alias("units"))


@query(f"WITH {SILVER} SELECT event_type, count(*) AS n, CAST(sum(coalesce(qty, 0)) AS BIGINT) AS units FROM silver GROUP BY 1")
def redelivery_noop(spark, sf_dir):
    """The whole log delivered twice gives the same silver."""
    df = events(spark, sf_dir)
    twice = df.unionByName(df)
    kept = kept_copies(twice, "event_id", instant_us(F.col("event_ts")), instant_us(F.col("arrival_ts")), PAYLOAD).where(quarantine.quarantine_reason() == "accepted")
    return kept.groupBy("event_type").agg(F.count("*").alias("n"), F.sum(F.coalesce("qty", F.lit(0))).alias("units"))


@query("SELECT event_id, count(*) AS copies FROM bronze_events GROUP BY 1 HAVING count(*) > 1")
def multiset_copies(spark, sf_dir):
    return quality.copies(events(spark, sf_dir), "event_id").where(F.col("copies") > 1)


LINES = f"""{SILVER}, first_sale AS (SELECT order_id, sku, customer_id, ev, qty, unit_price_cents FROM silver
 WHERE event_type = 'order_placed' QUALIFY row_number() OVER (PARTITION BY order_id, sku ORDER BY ev NULLS LAST, event_id NULLS LAST) = 1),
last_amendment AS (SELECT order_id, sku, new_qty FROM silver WHERE event_type = 'order_line_amended'
 QUALIFY row_number() OVER (PARTITION BY order_id, sku ORDER BY ev DESC NULLS LAST, event_id DESC NULLS LAST) = 1),
lines AS (SELECT f.order_id, f.sku, f.customer_id, f.ev, coalesce(a.new_qty, f.qty) qty, f.unit_price_cents, a.new_qty IS NOT NULL amended
 FROM first_sale f LEFT JOIN last_amendment a USING (order_id, sku))"""


@query(f"WITH {LINES} SELECT order_id, sku, customer_id, {_utc('ev')} AS sale_at, qty, unit_price_cents, amended FROM lines")
def effective_lines(spark, sf_dir):
    lines = closes.effective_lines(silver(spark, sf_dir))
    return lines.select("order_id", "sku", "customer_id", utc_text(F.col("sale_us")).alias("sale_at"), "qty", "unit_price_cents", "amended")


@query(f"""WITH {LINES} SELECT strftime(ev AT TIME ZONE 'Europe/Madrid', '%Y-%m') AS accounting_month,
 CAST(sum(qty * unit_price_cents) AS BIGINT) AS gross_cents, count(*) AS line_count
 FROM lines
 GROUP BY 1""")
def gross_by_month(spark, sf_dir):
    return closes.monthly(closes.effective_lines(silver(spark, sf_dir)))


def _raw_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returns as they were delivered, for counting heavy order lines without the work that goes into the kept ones."""
    return events(spark, sf_dir).where(F.col("event_type") == "return_registered").select("event_id", "order_id", "sku", instant_us(F.col("event_ts")).alias("event_us"))


@query(f"""WITH {LINES}, r AS (SELECT s.event_id, s.order_id, s.sku, s.qty, s.ev, l.ev IS NOT NULL AND s.ev >= l.ev AS
 counts, l.ev IS NOT NULL AS has_sale FROM silver s LEFT JOIN lines l USING (order_id, sku)
 WHERE s.event_type = 'return_registered')
SELECT event_id, has_sale, CAST(sum(CASE WHEN counts THEN qty ELSE 0 END) OVER (PARTITION BY order_id, sku
 ORDER BY ev, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS returned_so_far FROM r""")
def running_returns(spark, sf_dir):
    """Returned units of each order line so far, counting returns from the sale on only."""
    kept = silver(spark, sf_dir)
    lines = closes.effective_lines(kept).select("order_id", "sku", "sale_us")
    returns = kept.where(F.col("event_type") == "return_registered").select("event_id", "order_id", "sku", "qty", "event_us").join(lines, ["order_id", "sku"], "left")
    total = closes.running_total(returns, ["order_id", "sku"], "event_us", "event_id", F.col("qty"), F.col("event_us") >= F.col("sale_us"), "returned_so_far", raw=_raw_returns(spark, sf_dir))
    return total.select("event_id", F.col("sale_us").isNotNull().alias("has_sale"), "returned_so_far")


@query(f"""WITH {LINES}, r AS (SELECT strftime(l.ev AT TIME ZONE 'Europe/Madrid', '%Y-%m') AS sale_month, s.qty
 FROM silver s LEFT JOIN lines l USING (order_id, sku) WHERE s.event_type = 'return_registered')
SELECT coalesce(g.m, r.sale_month) AS accounting_month, coalesce(lines_n, 0) AS line_count, coalesce(return_n, 0) AS return_count
 FROM (SELECT strftime(ev AT TIME ZONE 'Europe/Madrid', '%Y-%m') m, count(*) lines_n FROM lines
 GROUP BY 1) g FULL JOIN (SELECT sale_month, count(*) return_n FROM r WHERE sale_month IS NOT NULL
 GROUP BY 1) r ON g.m = r.sale_month""")
def returns_by_sale_month(spark, sf_dir):
    """Lines and returns by the month of the sale, as one aggregation over contributions instead of an outer join."""
    kept = silver(spark, sf_dir)
    lines = closes.effective_lines(kept)
    returns = kept.where(F.col("event_type") == "return_registered").select("order_id", "sku").join(lines.select("order_id", "sku", "sale_us"), ["order_id", "sku"])
    both = lines.select("sale_us", F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(returns.select("sale_us", F.lit(0).alias("l"), F.lit(1).alias("r")))
    return both.groupBy(accounting_month(F.timestamp_micros("sale_us")).alias("accounting_month")).agg(F.sum("l").alias("line_count"), F.sum("r").alias("return_count"))


# --- bitemporal closes ---

GOOD = "event_type = 'order_placed' AND qty BETWEEN 1 AND 10000"
SNAPSHOTS = f"""closes AS (SELECT DISTINCT closed_at AS c FROM close_calendar WHERE close_version = 0),
snap AS (SELECT c, strftime(ev AT TIME ZONE 'Europe/Madrid', '%Y-%m') AS accounting_month, count(*) AS sale_count, CAST(sum(qty) AS BIGINT) AS unit_count FROM (
 SELECT c, e.event_id, e.event_type, e.qty, {_ts("e.event_ts")} ev FROM closes JOIN bronze_events e ON {_ts("e.arrival_ts")} <= c WHERE e.event_id IS NOT NULL
 QUALIFY row_number() OVER (PARTITION BY c, e.event_id ORDER BY {_ts("e.event_ts")} NULLS LAST, {_ts("e.arrival_ts")} NULLS LAST, e.event_type NULLS LAST, e.qty NULLS LAST) = 1)
 WHERE {GOOD} AND ev IS NOT NULL GROUP BY 1, 2),
eligible AS (SELECT * FROM snap WHERE strftime(c AT TIME ZONE 'Europe/Madrid', '%Y-%m') > accounting_month),
changed AS (SELECT * FROM eligible WINDOW w AS (PARTITION BY accounting_month ORDER BY c) QUALIFY lag(sale_count) OVER w IS NULL
 OR lag(sale_count) OVER w <> sale_count OR lag(unit_count) OVER w <> unit_count),
versions AS (SELECT accounting_month, CAST(row_number() OVER (PARTITION BY accounting_month
 ORDER BY c) - 1 AS INTEGER) AS close_version, c, sale_count, unit_count FROM changed)"""


def _versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    calendar = table(spark, sf_dir, "close_calendar").where(F.col("close_version") == 0)
    at = sorted({r[0] for r in calendar.select(F.unix_micros(F.col("closed_at").cast("timestamp"))).collect()})  # the calendar: some dozens of closes
    changes = closes.retractions(events(spark, sf_dir).withColumns({"_ev": instant_us(F.col("event_ts")), "_ar": instant_us(F.col("arrival_ts"))}), "event_id", "_ev", "_ar", ["event_type", "qty"])
    sales = changes.where((F.col("event_type") == "order_placed") & F.col("qty").between(1, 10_000) & F.col("event_us").isNotNull())
    sales = sales.withColumn("accounting_month", accounting_month(F.timestamp_micros("event_us")))
    snaps = closes.snapshots(sales, "accounting_month", at, {"sale_count": F.lit(1), "unit_count": F.col("qty")})
    return closes.versions(snaps, "accounting_month", ["sale_count", "unit_count"])


@query(f"WITH {SNAPSHOTS} SELECT accounting_month, close_version, {_utc('c')} AS closed_at, sale_count, unit_count FROM versions")
def close_versions(spark, sf_dir):
    v = _versions(spark, sf_dir)
    return v.select("accounting_month", "close_version", utc_text(F.col("close_us")).alias("closed_at"), "sale_count", "unit_count")


@query(f"""WITH {SNAPSHOTS} SELECT accounting_month, arg_min(unit_count, close_version) AS first_value, arg_max(unit_count, close_version) AS last_value, arg_max(unit_count, close_version) - arg_min(unit_count, close_version) AS delta
 FROM versions
 GROUP BY 1""")
def restatement_magnitude(spark, sf_dir):
    return closes.restatement(_versions(spark, sf_dir), ["accounting_month"], "close_version", "unit_count").drop("delta_bp")


LEDGER = "ledger AS (SELECT DISTINCT shop_id, accounting_month, close_version, " + ", ".join(FIGURES) + " FROM close_month)"


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "close_month").select(*SHOP, "close_version", *FIGURES).distinct()


@query(f"WITH {LEDGER} SELECT * FROM ledger QUALIFY row_number() OVER (PARTITION BY shop_id, accounting_month ORDER BY close_version DESC) = 1")
def current_versions(spark, sf_dir):
    return closes.current_versions(ledger(spark, sf_dir), SHOP, "close_version", FIGURES)


@query(f"""WITH {LEDGER} SELECT shop_id, accounting_month, close_version, gross_cents - lag(gross_cents) OVER w AS moved_gross_cents, line_count - lag(line_count) OVER w AS moved_line_count
 FROM ledger
 WINDOW w AS (PARTITION BY shop_id, accounting_month
 ORDER BY close_version)""")
def version_movement(spark, sf_dir):
    return closes.movement(ledger(spark, sf_dir), SHOP, "close_version", ["gross_cents", "line_count"])


TO_RECORD = f"""{LEDGER}, old AS (SELECT * FROM ledger WHERE close_version = 0 AND shop_id <> 'SH0000002'), src AS (SELECT * EXCLUDE (close_version)
 FROM ledger QUALIFY row_number() OVER (PARTITION BY shop_id, accounting_month ORDER BY close_version DESC) = 1),
rec AS (SELECT s.shop_id, s.accounting_month, CAST(coalesce(o.close_version + 1, 0) AS INTEGER) AS close_version, {", ".join("s." + f for f in FIGURES)}
 FROM src s LEFT JOIN old o USING (shop_id, accounting_month) WHERE o.close_version IS NULL
 OR {" OR ".join(f"s.{f} IS DISTINCT FROM o.{f}" for f in FIGURES)})"""


@query(f"WITH {TO_RECORD} SELECT * FROM rec")
def close_merge_source(spark, sf_dir):
    """What recording the newest figures appends to a ledger that only has first versions and lacks one shop."""
    full = ledger(spark, sf_dir)
    old = full.where((F.col("close_version") == 0) & (F.col("shop_id") != "SH0000002"))
    return closes.to_record(closes.current_versions(full, SHOP, "close_version", FIGURES).drop("close_version"), old, SHOP, "close_version", FIGURES)


@query(f"WITH {TO_RECORD} SELECT * FROM old UNION ALL SELECT * FROM rec")
def close_after_second_run(spark, sf_dir):
    """The ledger after two runs of the same close: the second adds nothing."""
    full = ledger(spark, sf_dir)
    now, once = closes.current_versions(full, SHOP, "close_version", FIGURES).drop("close_version"), full.where((F.col("close_version") == 0) & (F.col("shop_id") != "SH0000002"))
    for _ in range(2):
        once = closes.insert_only(once, closes.to_record(now, once, SHOP, "close_version", FIGURES), [*SHOP, "close_version"])
    return once


@query(f"""WITH {LEDGER}, per AS (SELECT shop_id, accounting_month, count(*) n, count(DISTINCT close_version) d, min(close_version) lo, max(close_version) hi,
 sum((net_cents <> gross_cents - returns_cents)::INT) net, sum((returns_cents > gross_cents)::INT) ov,
 sum((line_count < 0)::INT) neg FROM ledger GROUP BY 1, 2)
SELECT 'one_row_per_version' AS check_name, CAST(coalesce(sum((n <> d)::INT), 0) AS BIGINT) AS violations
 FROM per UNION ALL SELECT 'versions_are_dense', CAST(coalesce(sum((lo <> 0 OR hi + 1 <> d)::INT), 0) AS BIGINT)
 FROM per UNION ALL SELECT 'net_is_gross_minus_returns', CAST(coalesce(sum(net), 0) AS BIGINT)
 FROM per
UNION ALL SELECT 'returns_within_gross', CAST(coalesce(sum(ov), 0) AS BIGINT) FROM per UNION ALL SELECT 'no_negative_counts',
 CAST(coalesce(sum(neg), 0) AS BIGINT) FROM per""")
def verify_ledger(spark, sf_dir):
    return closes.checks(ledger(spark, sf_dir), SHOP, "close_version")


@query(f"""WITH {LEDGER} SELECT m.accounting_month, c.close_version, count(l.shop_id) AS shops
 FROM (SELECT DISTINCT accounting_month
 FROM close_calendar) m
 JOIN close_calendar c USING (accounting_month)
 LEFT
 JOIN ledger l ON l.accounting_month = c.accounting_month AND l.close_version = c.close_version
 GROUP BY 1, 2
 HAVING count(l.shop_id) = 0""")
def verification_holes(spark, sf_dir):
    """Closes of the calendar that no shop has signed."""
    expected = table(spark, sf_dir, "close_calendar").select("accounting_month", "close_version")
    return closes.check_holes(expected, ledger(spark, sf_dir), ["accounting_month", "close_version"]).withColumn("shops", F.lit(0).cast("bigint"))


# --- dimension ---

STANDING = f"""{SILVER}, w AS (SELECT customer_id, ev, segment, country FROM silver WHERE event_type = 'customer_upserted'
 QUALIFY row_number() OVER (PARTITION BY customer_id, ev ORDER BY event_id DESC NULLS LAST) = 1),
ch AS (SELECT * FROM w WINDOW o AS (PARTITION BY customer_id ORDER BY ev) QUALIFY lag(ev) OVER o IS NULL
 OR segment IS DISTINCT FROM lag(segment) OVER o OR country IS DISTINCT FROM lag(country) OVER o),
dim AS (SELECT customer_id, {_utc("ev")} AS valid_from, {_utc("lead(ev) OVER (PARTITION BY customer_id ORDER BY ev)")} AS valid_to, segment, country FROM ch)"""


def _dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    ups = silver(spark, sf_dir).where(F.col("event_type") == "customer_upserted")
    h = satellites.build_history(ups, "customer_id", F.col("event_us"), F.col("event_id"), ["segment", "country"])
    return h.select("customer_id", utc_text(F.col("at_us")).alias("valid_from"), utc_text(F.col("end_us")).alias("valid_to"), "segment", "country", F.col("end_us").isNull().alias("is_current"))


@query(f"WITH {STANDING} SELECT *, valid_to IS NULL AS is_current FROM dim")
def dim_scd2(spark, sf_dir):
    return _dimension(spark, sf_dir)


@query("""SELECT count(*) AS versions, count(DISTINCT customer_id) AS entities, count(*) FILTER (valid_to IS NULL) AS open_versions,
 count(*) FILTER (valid_to IS NOT NULL) AS closed_versions, min(valid_from) AS first_start, max(valid_from) AS last_start
 FROM dim_customer_scd2""")
def scd2_shape(spark, sf_dir):
    return quality.history_shape(table(spark, sf_dir, "dim_customer_scd2"))


@query("""WITH r AS (SELECT *, lead(valid_from) OVER (PARTITION BY customer_id ORDER BY valid_from) nx,
 sum((valid_to IS NULL)::INT) OVER (PARTITION BY customer_id) op FROM dim_customer_scd2)
SELECT DISTINCT customer_id, violation FROM (SELECT customer_id, 'not_one_open_version' AS violation
 FROM r WHERE op <> 1 UNION ALL SELECT customer_id, 'gap_or_overlap' FROM r WHERE nx IS NOT NULL
 AND valid_to IS DISTINCT FROM nx UNION ALL SELECT customer_id, 'empty_period' FROM r WHERE valid_to <= valid_from
 UNION ALL SELECT customer_id, 'wrong_flag' FROM r WHERE is_current IS DISTINCT FROM (valid_to IS NULL))""")
def scd2_violations(spark, sf_dir):
    return quality.history_violations(table(spark, sf_dir, "dim_customer_scd2"))


@query(f"""WITH {STANDING}, both_ AS (SELECT customer_id, valid_from, valid_to, is_current FROM dim_customer_scd2
 UNION ALL SELECT customer_id, valid_from, valid_to, valid_to IS NULL FROM dim),
r AS (SELECT *, lead(valid_from) OVER (PARTITION BY customer_id ORDER BY valid_from) nx, sum((valid_to IS NULL)::INT) OVER (PARTITION BY customer_id) op FROM both_)
SELECT DISTINCT customer_id, violation FROM (SELECT customer_id, 'not_one_open_version' AS violation FROM r WHERE op <> 1
 UNION ALL SELECT customer_id, 'gap_or_overlap' FROM r WHERE nx IS NOT NULL AND valid_to IS DISTINCT FROM nx
 UNION ALL SELECT customer_id, 'empty_period' FROM r WHERE valid_to <= valid_from)""")
def violations_of_two_histories(spark, sf_dir):
    """What is wrong with a history that was appended to an older one instead of being merged with it."""
    columns = ["customer_id", "valid_from", "valid_to", "is_current"]
    both = table(spark, sf_dir, "dim_customer_scd2").select(columns).unionByName(_dimension(spark, sf_dir).select(columns))
    return quality.history_violations(both)


@query(f"""WITH {STANDING}, b AS (SELECT customer_id, valid_from, valid_to, segment, country
 FROM dim_customer_scd2) SELECT customer_id, valid_from, valid_to, segment, country, only_in, CAST(n AS BIGINT) AS copies
 FROM (SELECT *, 'a' AS only_in, count(*) n
 FROM (SELECT *
 FROM dim EXCEPT ALL SELECT *
 FROM b)
 GROUP BY ALL
 UNION ALL SELECT *, 'b', count(*)
 FROM (SELECT *
 FROM b EXCEPT ALL SELECT *
 FROM dim)
 GROUP BY ALL)""")
def parity_diff(spark, sf_dir):
    """Where the history of all updates differs from the one stored earlier."""
    return quality.parity(_dimension(spark, sf_dir).drop("is_current"), table(spark, sf_dir, "dim_customer_scd2").drop("is_current"))


@query("""SELECT u.event_id
 FROM customer_updates u
 WHERE u.event_id IS NOT NULL
 GROUP BY 1
 HAVING min(u.batch_no) >= 40 AND bool_and(NOT EXISTS (SELECT 1
 FROM customer_updates e
 WHERE e.event_id = u.event_id AND e.batch_no < 40))""")
def late_arrivals_not_in_base(spark, sf_dir):
    u = table(spark, sf_dir, "customer_updates").where(F.col("event_id").isNotNull())
    return u.where(F.col("batch_no") >= 40).select("event_id").distinct().join(u.where(F.col("batch_no") < 40), "event_id", "left_anti")


# --- fingerprints ---


_LINE = "array_to_string([" + ", ".join(f"coalesce(CAST({c} AS VARCHAR), chr(0))" for c in ("shop_id", "accounting_month", "close_version", "gross_cents", "net_cents")) + "], chr(31))"


@query(f"""SELECT count(*) AS row_count, CAST(coalesce(sum(CAST('0x' || substr(md5({_LINE}), 1, 15) AS BIGINT)), 0) AS VARCHAR) AS sum_hash
 FROM close_month""")
def population_fingerprint(spark, sf_dir):
    """The order-free fingerprint of a table, which must be the same in two partitionings."""
    df = table(spark, sf_dir, "close_month")
    of = lambda x: text_fingerprint(x, ["shop_id", "accounting_month", "close_version", "gross_cents", "net_cents"])
    return of(df).join(of(df.repartition(7, "net_cents")), ["row_count", "sum_hash"])


@query("""WITH l AS (SELECT sha256(array_to_string([coalesce(shop_id, chr(0)), coalesce(accounting_month, chr(0)), coalesce(CAST(close_version AS VARCHAR), chr(0)), coalesce(CAST(net_cents AS VARCHAR), chr(0))], chr(31))) d
 FROM close_month),
g AS (SELECT d, count(*) c FROM l GROUP BY 1), p AS (SELECT substr(d, 1, 3) p, sha256(string_agg(d || ':' || c, chr(10)
 ORDER BY d || ':' || c)) d, sum(c) n FROM g GROUP BY 1) SELECT sha256(string_agg(p || ':' || d, chr(10)
 ORDER BY p || ':' || d)) AS digest, CAST(sum(n) AS BIGINT) AS row_count FROM p""")
def population_digest(spark, sf_dir):
    return ordered_fingerprint(table(spark, sf_dir, "close_month"), ["shop_id", "accounting_month", "close_version", "net_cents"])


# --- privacy ---


@query(f"""SELECT CASE WHEN customer_id IS NULL THEN NULL ELSE substr(sha256('pepper' || chr(0) || customer_id), 1, 32) END AS customer_id, strftime({_ts('valid_from')} AT TIME ZONE 'Europe/Madrid', '%Y-%m') AS valid_from, segment
 FROM customer_updates""")
def policy_masked(spark, sf_dir):
    return governance.with_policy(table(spark, sf_dir, "customer_updates"), {"customer_id": "pseudonym", "valid_from": "month", "segment": "keep"}, "pepper")


@query(r"""SELECT 'text' AS column_name, count(*) AS exposed_rows, min(text) AS example
 FROM documents
 WHERE regexp_matches(text, '(?i)\bC[0-9]{6,}\b')
 HAVING count(*) > 0""")
def exposure_scan(spark, sf_dir):
    return governance.exposure(table(spark, sf_dir, "documents"))


@query("""SELECT min(n) AS k, count(*) AS groups, count(*) FILTER (n = 1) AS unique_groups
 FROM (SELECT count(*) n
 FROM customer_updates
 GROUP BY segment, country)""")
def k_anonymity(spark, sf_dir):
    return governance.k_anonymity(table(spark, sf_dir, "customer_updates"), ["segment", "country"])


@query("SELECT event_id, sha256(customer_id) AS customer_id, segment, country FROM customer_updates WHERE country = 'ES'")
def secured_view(spark, sf_dir):
    df = table(spark, sf_dir, "customer_updates").select("event_id", "customer_id", "segment", "country")
    return governance.secured(df, F.col("country") == "ES", {"customer_id": F.sha2("customer_id", 256)})


# --- freshness, runs, top k ---


@query(f"""SELECT CAST(epoch_us(max({_ts('arrival_ts')})) AS BIGINT) AS last_arrival_us, CAST((1808400000000000 - epoch_us(max({_ts('arrival_ts')}))) // 1000000 AS BIGINT) AS lag_seconds, CASE
 WHEN (1808400000000000 - epoch_us(max({_ts('arrival_ts')}))) // 1000000 > 900 THEN 'ingestion_lag'
 ELSE 'none' END AS breach
 FROM bronze_events""")
def freshness(spark, sf_dir):
    return layout.freshness(events(spark, sf_dir), instant_us(F.col("arrival_ts")), 1_808_400_000_000_000, FRESHNESS_SLA_MINUTES)


def _run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of runs made from the tables: each landing file is a run, its listings are the run's events."""
    f = table(spark, sf_dir, "landing_files").where(F.col("listed_at").isNotNull())
    state = F.when(F.col("row_count").isNull(), "FAILED").otherwise("COMPLETED")
    items = F.array(F.struct(F.lit("has_rows").alias("name"), F.lit("landing").alias("dataset"), F.coalesce("row_count", F.lit(0)).alias("passed_records"), F.when(F.col("row_count").isNull(), 1).otherwise(0).alias("failed_records")))
    details = F.to_json(F.struct(F.struct(state.alias("state"), items.alias("expectations")).alias("progress")))
    return f.select(F.col("ingest_file").alias("run_id"), F.col("listed_at").alias("at"), F.when(F.col("row_count").isNull(), "ERROR").otherwise("INFO").alias("level"), details.alias("details"))


@query("""WITH l AS (SELECT ingest_file run_id, listed_at AT TIME ZONE 'UTC' AS t, row_count FROM landing_files
 WHERE listed_at IS NOT NULL), g AS (SELECT run_id, max(t) mx, count(*) FILTER (row_count IS NULL) errors
 FROM l GROUP BY 1 ORDER BY mx DESC, run_id LIMIT 10)
SELECT run_id, strftime(mx, '%Y-%m-%dT%H:%M:%S.%fZ') AS ended, errors FROM g""")
def newest_runs(spark, sf_dir):
    return run_log.run_states(_run_log(spark, sf_dir)).select("run_id", utc_text(F.unix_micros("ended")).alias("ended"), "errors")


@query("""SELECT 'landing' AS dataset, 'has_rows' AS name, CAST(sum(coalesce(row_count, 0)) AS BIGINT) AS passed_records,
 count(*) FILTER (row_count IS NULL) AS failed_records
 FROM landing_files
 WHERE listed_at IS NOT NULL""")
def run_log_expectations(spark, sf_dir):
    return run_log.expectations(_run_log(spark, sf_dir))


# --- layout and joins ---


@query("""SELECT n_name, count(*) AS n_lines, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents
 FROM lineitem
 JOIN orders ON l_orderkey = o_orderkey
 JOIN customer ON o_custkey = c_custkey
 JOIN nation ON c_nationkey = n_nationkey
 GROUP BY 1""")
def lines_by_nation(spark, sf_dir):
    """Three equi-joins of a star; the side to send to all tasks is left to the sizes that the planner measures."""
    l, o, c, n = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer", "nation"))
    joined = l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name").agg(F.count("*").alias("n_lines"), F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("cents"))


@query("""SELECT sku, count(*) AS n_events, any_value(n_documents) AS n_documents
 FROM bronze_events
 JOIN (SELECT sku, count(*) AS n_documents
 FROM documents
 WHERE sku IS NOT NULL
 GROUP BY 1) USING (sku)
 GROUP BY 1""")
def skew_join(spark, sf_dir):
    """Events joined with a dimension of their sku, of which one holds a tenth of the rows, spread by a salt."""
    dim = table(spark, sf_dir, "documents").where(F.col("sku").isNotNull()).groupBy("sku").agg(F.count("*").alias("n_documents"))
    fact = events(spark, sf_dir).select("sku", "event_id", "ingest_file")
    return layout.salted_join(fact, dim, "sku", 8).groupBy("sku").agg(F.count("*").alias("n_events"), F.max("n_documents").alias("n_documents"))


@query()
def files_skippable(spark, sf_dir):
    """Files of the log a query on one sku can't skip, before and after clustering by month and sku."""
    df = events(spark, sf_dir).select("sku", "order_id", "qty", F.coalesce(F.month(instant(F.col("event_ts"))), F.lit(0)).alias("m"), F.pmod(F.xxhash64("sku"), F.lit(1 << 20)).alias("sku_no"))
    at, out = scratch(spark, "layout"), None
    df.repartition(16).write.parquet(f"{at}/plain")
    layout.clustered(df, ["m", "sku_no"], 16).write.parquet(f"{at}/clustered")
    for name in ("plain", "clustered"):
        stats = layout.file_stats(spark.read.parquet(f"{at}/{name}"), ["m"])
        row = layout.not_skippable(stats, "m", 6).select(F.lit(name).alias("layout"), "files", "files_read")
        out = row if out is None else out.unionByName(row)
    return out


@query()
def partition_profile(spark, sf_dir):
    return layout.partition_profile(events(spark, sf_dir).repartition(8, "sku"))


SHOP2 = "SELECT DISTINCT shop_id, accounting_month, close_version, net_cents FROM close_month WHERE shop_id IS NOT NULL AND accounting_month IS NOT NULL AND close_version IS NOT NULL"


def _snapshots(spark: SparkSession, sf_dir: str) -> SnapshotTable:
    rows = table(spark, sf_dir, "close_month").select(*SHOP, "close_version", "net_cents").distinct().where("shop_id is not null and accounting_month is not null and close_version is not null")
    t = SnapshotTable(spark, scratch(spark, "ledger"), [*SHOP, "close_version"], ["accounting_month"])
    t.create(rows.where("close_version = 0"))
    t.insert_only(rows)
    t.upsert(rows.where("close_version >= 1").withColumn("net_cents", F.col("net_cents") + 1))
    t.delete(F.col("accounting_month") == "2026-03")
    return t


@query(f"""SELECT 1 AS version, count(*) AS n, CAST(sum(net_cents) AS BIGINT) AS cents
 FROM ({SHOP2})
 UNION ALL SELECT 3, count(*), CAST(sum(net_cents + (close_version >= 1)::INT) AS BIGINT)
 FROM ({SHOP2})
 WHERE accounting_month <> '2026-03'""")
def snapshot_time_travel(spark, sf_dir):
    t = _snapshots(spark, sf_dir)
    read = lambda v: t.read(v).agg(F.count("*").alias("n"), F.sum("net_cents").alias("cents")).select(F.lit(v).alias("version"), "n", "cents")
    return read(1).unionByName(read(3))


@query(f"""SELECT change, count(*) AS n
 FROM (SELECT unnest(CASE WHEN accounting_month = '2026-03' THEN ['delete'] WHEN close_version >= 1 THEN ['update_before', 'update_after']
 ELSE [] END) AS change
 FROM ({SHOP2}))
 GROUP BY 1""")
def snapshot_changes(spark, sf_dir):
    return _snapshots(spark, sf_dir).changes(1, 3).groupBy("change").agg(F.count("*").alias("n"))


_LEFT = f"SELECT count(*) FROM ({SHOP2}) WHERE accounting_month <> '2026-03'"


@query(f"""SELECT 0 AS version, 'create' AS operation, (SELECT count(*)
 FROM ({SHOP2})
 WHERE close_version = 0) AS n_rows
 UNION ALL SELECT 1, 'insert', (SELECT count(*)
 FROM ({SHOP2}))
 UNION ALL SELECT 2, 'merge', (SELECT count(*)
 FROM ({SHOP2}))
 UNION ALL SELECT 3, 'delete', ({_LEFT})
 UNION ALL SELECT 4, 'compact', ({_LEFT})""")
def snapshot_history(spark, sf_dir):
    t = _snapshots(spark, sf_dir)
    t.compact(64_000_000)
    return t.history().select("version", "operation", "n_rows")


@query(f"SELECT count(*) FILTER (accounting_month = '2026-03') AS rows_deleted, CAST(0 AS BIGINT) AS rows_lost FROM ({SHOP2})")
def delete_accounting(spark, sf_dir):
    """Rows a predicate deletes, by the metrics of its commit, and rows that went although the predicate doesn't hold."""
    t = _snapshots(spark, sf_dir)
    deleted = t.manifest(3)["metrics"]["rows_deleted"]
    lost = t.read(2).where("accounting_month <> '2026-03'").join(t.read(3), t.keys, "left_anti")
    return lost.agg(F.count("*").alias("rows_lost")).select(F.lit(deleted).cast("bigint").alias("rows_deleted"), "rows_lost")


def _streamed(spark: SparkSession, sf_dir: str) -> str:
    from tidemark.streaming import ingest

    at = scratch(spark, "stream")
    events(spark, sf_dir).select(*bronze.COLUMNS).repartition(4).write.json(f"{at}/drop")
    ingest.ingest(spark, bronze.IngestSpec(f"{at}/drop", files_per_trigger=2), f"{at}/out")
    return f"{at}/out"


@query(f"WITH {CLASSIFIED} SELECT quarantine_reason, count(*) AS n FROM classified GROUP BY 1")
def stream_ingest_counts(spark, sf_dir):
    """The whole log written as JSON lines and taken in again as a stream: no line lost, the same reasons."""
    from tidemark.streaming import ingest

    at = _streamed(spark, sf_dir)
    ingest.reconciled(spark, at, events(spark, sf_dir).count())
    return ingest.written(spark, at).groupBy("quarantine_reason").agg(F.count("*").alias("n"))
