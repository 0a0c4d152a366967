"""Typed records and located faults from raw lines of a landing drop."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.quarantine import quarantine_reason
from tidemark.sources.grammar import PLAIN_INTEGER, Delimited, Json, Record

#: The fields of a record in the order of the delimited feed.
FIELDS = ["event_id", "event_type", "event_ts", "arrival_ts", "order_id", "customer_id", "sku", "qty", "new_qty", "unit_price_cents", "currency", "return_id", "reason", "segment", "country"]
NUMBERS = {"qty", "new_qty", "unit_price_cents"}
BIGINT = 2**63


def integer(text: str | None) -> int | None:
    """A plain integer that fits BIGINT, else None."""
    if text is None or not PLAIN_INTEGER.fullmatch(text) or len(text) > 4000:
        return None
    n = int(text)
    return n if -BIGINT <= n < BIGINT else None


def typed(record: Record) -> dict[str, str | int | None]:
    """The fields of a record; a missing one, and a number field that is no plain integer, is None.

    A text field that holds a number, a word or something nested has its source as text.
    """
    if isinstance(record.members, list):
        got = {k: v or None for k, v in zip(FIELDS, record.members, strict=False)}
        return {k: integer(got.get(k)) if k in NUMBERS else got.get(k) for k in FIELDS}
    out: dict[str, str | int | None] = {}
    for k in FIELDS:
        kind, text = record.members.get(k, ("word", "null"))
        if kind == "word" and text == "null":
            out[k] = None
        elif k in NUMBERS:
            out[k] = integer(text) if kind == "number" else None
        else:
            out[k] = text
    return out


def records_of(text: str, feed: str | None) -> list[Record]:
    """All records of a text and the faults between them. A text of an unknown feed is read as JSON if it starts with
    a brace, else as delimited."""
    if feed not in ("jsonl", "csv"):
        feed = "jsonl" if text.lstrip().startswith("{") else "csv"
    return (Json(text) if feed == "jsonl" else Delimited(text, len(FIELDS))).records()


def is_whole(text: str, found: list[Record]) -> bool:
    """Whether a line is exactly one record."""
    return len(found) == 1 and found[0].fault is None and (isinstance(found[0].members, dict) or found[0].end == len(text))


def parse_line(text: str | None, feed: str | None) -> tuple[dict, int | None, str | None, int]:
    """fields, offset of the fault, what was expected there, records recovered from the line.

    Of a broken line the fields are those of the first record, or piece of one, with an event_id. A null line has none.
    """
    if text is None:
        return dict.fromkeys(FIELDS), 0, "a line", 0
    records = records_of(text, feed)
    if is_whole(text, records):
        return typed(records[0]), None, None, 1
    if not records:
        return dict.fromkeys(FIELDS), 0, "object", 0
    fault = next((r.fault for r in records if r.fault), None)
    offset, expected = (fault.offset, fault.expected) if fault else (records[0].end, "end of line")
    candidates = [typed(r) for r in records]
    best = next((c for c in candidates if c["event_id"]), candidates[0])
    return best, offset, expected, sum(r.fault is None for r in records)


def records(texts: DataFrame, key: str, feed: str, text: str) -> DataFrame:
    """(key, record_no, line_no, begin_at, end_at, the 15 fields, fault_at, fault_expected, whole): every record and
    every fault of each text, in order.

    A text may be a line or a whole file: parsing goes on behind a fault at the next anchor, also where a quote is
    broken across lines. whole says whether the text is exactly this record. Null and empty texts have no records.
    """
    selected = texts.select(F.col(key).alias("_key"), F.col(feed).alias("_feed"), F.col(text).alias("_text"))
    ddl = [f"`{key}` {dict(selected.dtypes)['_key']}", "record_no int", "line_no int", "begin_at int", "end_at int", *[f"{f} {'bigint' if f in NUMBERS else 'string'}" for f in FIELDS], "fault_at int", "fault_expected string", "whole boolean"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32()] * 4 + [pa.int64() if f in NUMBERS else pa.string() for f in FIELDS] + [pa.int32(), pa.string(), pa.bool_()]
        for b in batches:
            of, out = [], []
            for i, (f, t) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)):
                found, line, at = records_of(t, f) if t else [], 0, 0
                whole = is_whole(t, found) if t else False
                for no, r in enumerate(found):
                    line, at = line + t.count("\n", at, r.start), r.start
                    fields = typed(r)
                    of.append(i)
                    out.append((no, line, r.start, r.end, *[fields[c] for c in FIELDS], r.fault.offset if r.fault else None, r.fault.expected if r.fault else None, whole))
            columns = list(zip(*out, strict=True)) if out else [()] * len(kinds)
            keys = b.column(0).take(pa.array(of, pa.int64()))
            yield pa.RecordBatch.from_arrays([keys, *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], [key, "record_no", "line_no", "begin_at", "end_at", *FIELDS, "fault_at", "fault_expected", "whole"])

    return selected.mapInArrow(run, ", ".join(ddl))


def recovered(lines: DataFrame, line_id: str = "line_id", feed: str = "feed", text: str = "line_text") -> DataFrame:
    """(line_id, record_no, the 15 fields, quarantine_reason) of the whole records that stand in broken lines."""
    found = records(lines, line_id, feed, text).where(~F.col("whole") & F.col("fault_at").isNull())
    return found.select(line_id, "record_no", *FIELDS).withColumn("quarantine_reason", quarantine_reason())


def parsed(lines: DataFrame, line_id: str, feed: str, text: str, carry: list[str] | None = None) -> DataFrame:
    """(line_id, carry..., the 15 fields, fault_offset, fault_expected, recovered) of every line, in batches of Arrow."""
    carry = carry or []
    selected = lines.select(F.col(line_id).alias("line_id"), F.col(feed).alias("_feed"), F.col(text).alias("_text"), *carry)
    types = {c: t for c, t in selected.dtypes if c in carry}
    ddl = ["line_id " + dict(selected.dtypes)["line_id"], *[f"`{c}` {t}" for c, t in types.items()], *[f"{f} {'bigint' if f in NUMBERS else 'string'}" for f in FIELDS], "fault_offset int", "fault_expected string", "recovered int"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [parse_line(t, f) for t, f in zip(b.column(2).to_pylist(), b.column(1).to_pylist(), strict=True)]
            own = [pa.array([g[0][f] for g in got], pa.int64() if f in NUMBERS else pa.string()) for f in FIELDS]
            ends = [pa.array([g[1] for g in got], pa.int32()), pa.array([g[2] for g in got], pa.string()), pa.array([g[3] for g in got], pa.int32())]
            names = ["line_id", *types, *FIELDS, "fault_offset", "fault_expected", "recovered"]
            yield pa.RecordBatch.from_arrays([b.column(0), *[b.column(i + 3) for i in range(len(types))], *own, *ends], names)

    return selected.mapInArrow(run, ", ".join(ddl))


def classified(lines: DataFrame, line_id: str = "line_id", feed: str = "feed", text: str = "line_text", carry: list[str] | None = None) -> DataFrame:
    """parsed() with quarantine_reason, 'accepted' for valid lines. A line the grammar refuses is unparseable_json."""
    records = parsed(lines, line_id, feed, text, carry)
    return records.withColumn("quarantine_reason", F.when(F.col("fault_offset").isNotNull(), F.lit("unparseable_json")).otherwise(quarantine_reason()))
