"""SQL for the oracle of the queries in training_data, for DuckDB."""

from __future__ import annotations


def _ts(c: str) -> str:
    return rf"(CASE WHEN regexp_full_match({c}, '\d{{4}}-\d{{2}}-\d{{2}}[T ]\d{{2}}:\d{{2}}:\d{{2}}(\.\d{{1,9}})?(Z|[+-]\d{{2}}:\d{{2}})') THEN TRY_CAST({c} AS TIMESTAMPTZ) END)"


def _utc(c: str) -> str:
    return f"strftime({c} AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S.%fZ')"


MONTH = r"""(CASE WHEN regexp_full_match(trim(accounting_month), '\d{6}') THEN substr(trim(accounting_month), 1, 4) || '-' || substr(trim(accounting_month), 5, 2)
 WHEN regexp_full_match(trim(accounting_month), '\d{4}[-/]\d{1,2}([-/]\d{1,2})?')
 THEN regexp_extract(trim(accounting_month), '^(\d{4})', 1) || '-' || lpad(regexp_extract(trim(accounting_month), '^\d{4}[-/](\d{1,2})', 1), 2, '0')
 ELSE trim(accounting_month) END)"""
FIELDS = ["gross_cents", "returns_cents", "net_cents", "line_count", "return_count", "returns_rejected_count", "restated_at", "restatement_reason"]

P1 = f"""WITH a AS (SELECT DISTINCT * REPLACE ({MONTH} AS accounting_month) FROM close_month),
b AS (SELECT DISTINCT * REPLACE ({MONTH} AS accounting_month) FROM close_month_copy),
j AS (SELECT coalesce(a.shop_id, b.shop_id) shop_id, coalesce(a.accounting_month, b.accounting_month) accounting_month, coalesce(a.close_version, b.close_version) close_version,
 a.rowid_a IS NULL na, b.rowid_b IS NULL nb, {", ".join(f"a.{f} IS DISTINCT FROM b.{f} d_{f}" for f in FIELDS)}
 FROM (SELECT *, 1 rowid_a FROM a) a FULL JOIN (SELECT *, 1 rowid_b FROM b) b
 ON a.shop_id IS NOT DISTINCT FROM b.shop_id AND a.accounting_month IS NOT DISTINCT FROM b.accounting_month
 AND a.close_version IS NOT DISTINCT FROM b.close_version)
SELECT shop_id, accounting_month, close_version, 'missing_in_copy' AS field_name FROM j WHERE nb
UNION ALL SELECT shop_id, accounting_month, close_version, 'missing_in_close_month' FROM j WHERE na
""" + "".join(f"UNION ALL SELECT shop_id, accounting_month, close_version, '{f}' FROM j WHERE NOT na AND NOT nb AND d_{f}\n" for f in FIELDS)

P2 = f"""WITH u AS (SELECT customer_id, {_ts("valid_from")} vf, event_id, segment, country FROM customer_updates WHERE customer_id IS NOT NULL),
w AS (SELECT * FROM u WHERE vf IS NOT NULL QUALIFY row_number() OVER (PARTITION BY customer_id, vf ORDER BY event_id DESC NULLS LAST) = 1),
c AS (SELECT *, lag(vf) OVER o IS NULL first, lag(segment) OVER o s, lag(country) OVER o k FROM w WINDOW o AS (PARTITION BY customer_id ORDER BY vf)),
v AS (SELECT * FROM c WHERE first OR segment IS DISTINCT FROM s OR country IS DISTINCT FROM k)
SELECT customer_id, {_utc("vf")} AS valid_from, coalesce({_utc("lead(vf) OVER (PARTITION BY customer_id ORDER BY vf)")}, '') AS valid_to, coalesce(segment, '') AS segment
 FROM v"""

P3 = "SELECT ingest_file FROM bronze_events WHERE ingest_file IS NOT NULL GROUP BY 1 HAVING count(*) < 100"
P3_ROWS = "SELECT event_id, count(*) AS n_rows FROM bronze_events GROUP BY 1"


def _kept(ties: str) -> str:
    return f"""kept AS (SELECT * FROM (SELECT *, {_ts("event_ts")} ev, {_ts("arrival_ts")} ar, count(*) OVER (PARTITION BY event_id) copies
 FROM bronze_events WHERE event_id IS NOT NULL)
 QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ev ASC NULLS LAST, ar ASC NULLS LAST, {ties}) = 1)"""


VERSIONED = f"""{_kept(ties="event_type, arrival_ts, qty")},
sales AS (SELECT *, strftime(ev AT TIME ZONE 'Europe/Madrid', '%Y-%m') mon FROM kept WHERE event_type = 'order_placed' AND ev IS NOT NULL AND ar IS NOT NULL),
versioned AS (SELECT s.*, (SELECT min(c.close_version) FROM close_calendar c WHERE c.accounting_month = s.mon
 AND c.closed_at >= s.ar) fv FROM sales s WHERE mon IN (SELECT accounting_month FROM close_calendar))"""

P4 = f"""WITH {VERSIONED} SELECT event_id, mon AS accounting_month, CAST(coalesce(fv, -1) AS INTEGER) AS close_version FROM versioned v
WHERE ar > (SELECT closed_at FROM close_calendar c WHERE c.accounting_month = v.mon AND c.close_version = 0)"""

P4_VERSIONS = f"""WITH {VERSIONED} SELECT c.accounting_month, c.close_version, count(v.event_id) AS sale_count,
CAST(coalesce(sum(CASE WHEN qty BETWEEN 1 AND 10000 THEN qty END), 0) AS BIGINT) AS unit_count
FROM close_calendar c LEFT JOIN versioned v ON v.mon = c.accounting_month AND v.ar <= c.closed_at GROUP BY 1, 2"""

P4_SERVING = f"""WITH {VERSIONED}, ends AS (SELECT accounting_month, max(closed_at) cut_at FROM close_calendar GROUP BY 1),
t AS (SELECT *, TIMESTAMPTZ '2026-08-15 00:00:00+00' lb FROM versioned v JOIN ends e ON v.mon = e.accounting_month
 WHERE ar <= TIMESTAMPTZ '2026-08-20 00:00:00+00')
SELECT mon AS accounting_month, count(*) AS sale_count, CAST(coalesce(sum(CASE WHEN qty BETWEEN 1 AND 10000 THEN qty END), 0) AS BIGINT) AS unit_count,
CASE WHEN cut_at <= lb THEN 'frozen' ELSE 'provisional' END AS status FROM t WHERE cut_at > lb OR ar <= cut_at GROUP BY 1, 4"""

P5 = f"""WITH {_kept(ties="arrival_ts")} SELECT event_id, arrival_ts FROM kept WHERE copies > 1"""

COLUMNS = ["event_type", "event_ts", "arrival_ts", "order_id", "customer_id", "sku", "qty", "new_qty", "unit_price_cents", "currency", "return_id", "reason", "segment", "country", "boundary", "_rescued_data", "ingest_file"]
P5_ROWS = f"""WITH {_kept(", ".join(f"{c} ASC NULLS LAST" for c in COLUMNS))} SELECT event_id, {", ".join(COLUMNS)} FROM kept"""

P5_BATCHES = f"""WITH d AS (SELECT event_id, strftime({_ts("arrival_ts")} AT TIME ZONE 'UTC', '%Y-%m') m FROM bronze_events WHERE event_id IS NOT NULL)
SELECT event_id, CAST(min(CASE WHEN m >= '2026-07' THEN 2 WHEN m >= '2026-04' THEN 1 ELSE 0 END) AS INTEGER) AS delivery FROM d GROUP BY 1"""

KNOWN = f"""{_kept(ties="customer_id")},
sales AS (SELECT event_id, customer_id, ev FROM kept WHERE event_type = 'order_placed' AND ev IS NOT NULL AND customer_id IS NOT NULL),
u AS (SELECT customer_id, event_id update_event_id, {_ts("valid_from")} vf, min({_ts("arrival_ts")}) fa, any_value(segment) segment, any_value(country)
 country FROM customer_updates WHERE customer_id IS NOT NULL GROUP BY 1, 2, 3),
m AS (SELECT s.event_id, s.customer_id, arg_max(struct_pack(id := u.update_event_id, seg := u.segment, cou := u.country), struct_pack(vf := u.vf, id := u.update_event_id)) b
 FROM sales s JOIN u ON s.customer_id = u.customer_id AND u.vf <= s.ev AND u.fa <= s.ev GROUP BY 1, 2)"""
P6 = f"WITH {KNOWN} SELECT event_id, b.id AS update_event_id FROM m"
P6_ATTRIBUTES = f"WITH {KNOWN} SELECT event_id, customer_id, b.id AS known_update_id, b.seg AS known_segment, b.cou AS known_country FROM m"

_STRING = r'"([^"\\\x00-\x1f]|\\(["\\/bfnrt]|u[0-9a-fA-F]{4}))*"'
_PLAIN = rf"({_STRING}|-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?|true|false|null)"


def _json_object(depth: int) -> str:
    """Pattern of a JSON object (RFC 8259) whose values are nested at most so deep."""
    b, value = r"[ \t\n\r]*", _PLAIN
    for _ in range(depth):
        value = rf"({_PLAIN}|\[{b}({value}{b}(,{b}{value}{b})*)?\]|\{{{b}({_STRING}{b}:{b}{value}{b}(,{b}{_STRING}{b}:{b}{value}{b})*)?\}})"
    return rf"{b}\{{{b}({_STRING}{b}:{b}{value}{b}(,{b}{_STRING}{b}:{b}{value}{b})*)?\}}{b}"


RECORD = ["event_id", "event_type", "event_ts", "arrival_ts", "order_id", "customer_id", "sku", "qty", "new_qty", "unit_price_cents", "currency", "return_id", "reason", "segment", "country"]
_FIELD = r'("(?:[^"]|"")*"|[^",\r\n]*)'
_CSV = ",".join([_FIELD] * len(RECORD))


def _csv_field(i: int) -> str:
    raw = f"regexp_extract(line_text, '^(?:[^\",\r\n]*,|\"(?:[^\"]|\"\")*\",){{{i}}}{_FIELD}', 1)"
    return f"nullif(CASE WHEN starts_with({raw}, '\"') THEN replace(substr({raw}, 2, length({raw}) - 2), '\"\"', '\"') ELSE {raw} END, '')"


def _json_field(f: str) -> str:
    if f in ("qty", "new_qty", "unit_price_cents"):
        return f"CAST(json_extract(line_text, '$.{f}') AS VARCHAR)"
    return f"json_extract_string(line_text, '$.{f}')"


P7_LINES = f"""l AS (SELECT line_id, feed, ingest_file, line_text, coalesce(CASE WHEN feed = 'jsonl' THEN regexp_full_match(line_text, '{_json_object(2)}')
 ELSE regexp_full_match(line_text, '{_CSV}') END, false) AS whole FROM landing_lines),
f AS (SELECT line_id, whole, {", ".join(f"CASE WHEN NOT whole THEN NULL WHEN feed = 'jsonl' THEN {_json_field(c)} ELSE {_csv_field(i)} END AS {c}" for i, c in enumerate(RECORD))}
 FROM l),
n AS (SELECT * REPLACE ({", ".join(f"CASE WHEN regexp_full_match({c}, '-?[0-9]+') THEN TRY_CAST({c} AS BIGINT) END AS {c}" for c in ("qty", "new_qty", "unit_price_cents"))})
 FROM f),
q AS (SELECT *, CASE WHEN event_type = 'order_line_amended' THEN new_qty WHEN event_type IN ('order_placed', 'return_registered') THEN qty
 ELSE 1 END AS quantity FROM n),
classified AS (SELECT *, CASE WHEN NOT whole OR event_id IS NULL THEN 'unparseable_json'
 WHEN event_type IS NULL OR event_type NOT IN ('order_placed', 'order_line_amended', 'return_registered', 'customer_upserted') THEN 'unknown_event_type'
 WHEN {_ts("event_ts")} IS NULL OR {_ts("arrival_ts")} IS NULL OR quantity IS NULL OR (event_type = 'customer_upserted'
 AND customer_id IS NULL) OR (event_type <> 'customer_upserted' AND (order_id IS NULL OR sku IS NULL))
 OR (event_type = 'order_placed' AND (customer_id IS NULL OR unit_price_cents IS NULL OR currency IS NULL)) THEN 'missing_required_field'
 WHEN quantity < 1 THEN 'non_positive_quantity' WHEN event_type = 'order_placed' AND unit_price_cents < 0 THEN 'negative_price'
 WHEN event_type = 'order_placed' AND currency <> 'EUR' THEN 'unknown_currency'
 WHEN quantity > 10000 OR (event_type = 'order_placed' AND unit_price_cents > 1000000) THEN 'amount_out_of_range' ELSE 'accepted' END AS reason_found FROM q)"""
P7 = f"WITH {P7_LINES} SELECT line_id, reason_found AS quarantine_reason FROM classified WHERE reason_found <> 'accepted'"
P7_VALUES = f"""WITH {P7_LINES} SELECT line_id, {", ".join(f"{_utc(_ts(c))} AS {c}" if c.endswith("_ts") else c for c in RECORD)} FROM classified WHERE reason_found = 'accepted'"""

SQL = {
    "p1_found": P1,
    "p2_found": P2,
    "p2_batches": P2,
    "p3_found": P3,
    "p3_rows": P3_ROWS,
    "p4_found": P4,
    "p4_versions": P4_VERSIONS,
    "p4_serving": P4_SERVING,
    "p5_found": P5,
    "p5_rows": P5_ROWS,
    "p5_batches": P5_BATCHES,
    "p6_found": P6,
    "p6_attributes": P6_ATTRIBUTES,
    "p7_found": P7,
    "p7_values": P7_VALUES,
}
