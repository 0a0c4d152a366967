"""A seeded log of events with the outcome of every record known by construction."""

from __future__ import annotations

import json
import os
import random
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone


@dataclass
class Ledger:
    """What a correct engine must find in the generated log."""

    lines: int = 0
    repeats: int = 0
    reasons: dict[str, int] = field(default_factory=dict)
    gross_cents: dict[str, int] = field(default_factory=dict)


def _text(at: datetime, r: random.Random) -> str:
    zone = r.choice([timezone.utc, timezone(timedelta(hours=1)), timezone(timedelta(hours=5, minutes=30))])
    return at.astimezone(zone).isoformat()


#: Ways to break a sale, and the reason each must get. Fixed values.
BROKEN = [
    ({"event_id": None}, "unparseable_json"), ({"event_type": "ping"}, "unknown_event_type"), ({"event_ts": "soon"}, "missing_required_field"), ({"sku": None}, "missing_required_field"), ({"qty": 2**63}, "missing_required_field"),
    ({"qty": 0}, "non_positive_quantity"), ({"unit_price_cents": -5}, "negative_price"), ({"currency": "XXX"}, "unknown_currency"), ({"unit_price_cents": 2**62}, "amount_out_of_range"),
]


def generate(root: str, orders: int, seed: int, months: int = 3, repeat_share: float = 0.12, broken_share: float = 0.05) -> Ledger:
    """Writes root/batch=<day>/part-0.json, one file a day of arrival, and returns the ledger.

    Sales lie at noon UTC, so their month is the same in every zone of Europe.
    """
    from zoneinfo import ZoneInfo

    r, ledger, days = random.Random(seed), Ledger(), {}
    for i in range(orders):
        at = datetime(2026, 1, 1, 12, tzinfo=timezone.utc) + timedelta(days=r.randrange(months * 30), seconds=r.randrange(3600))
        e = {"event_id": f"op-{i}", "event_type": "order_placed", "event_ts": _text(at, r), "order_id": f"O{i}", "customer_id": f"C{r.randrange(50):08d}", "sku": f"S{r.randrange(20)}", "qty": r.randint(1, 9), "unit_price_cents": r.randint(0, 5000), "currency": "EUR"}
        month, reason = at.astimezone(ZoneInfo("Europe/Madrid")).strftime("%Y-%m"), "accepted"
        if r.random() < broken_share:
            change, reason = r.choice(BROKEN)
            e = {k: v for k, v in (e | change).items() if v is not None}
        else:
            ledger.gross_cents[month] = ledger.gross_cents.get(month, 0) + e["qty"] * e["unit_price_cents"]
        copies = 2 if reason == "accepted" and r.random() < repeat_share else 1
        ledger.repeats += copies - 1
        for k in range(copies):
            arrival = at + timedelta(minutes=r.randint(1, 90), days=k * r.randint(0, 20))
            days.setdefault(arrival.strftime("%Y%m%d"), []).append((arrival, json.dumps(e | {"arrival_ts": _text(arrival, r)})))
            ledger.lines += 1
            ledger.reasons[reason] = ledger.reasons.get(reason, 0) + 1
    for day, lines in days.items():
        os.makedirs(f"{root}/batch={day}", exist_ok=True)
        with open(f"{root}/batch={day}/part-0.json", "w") as f:
            f.write("\n".join(line for _, line in sorted(lines)) + "\n")
    return ledger


@dataclass(frozen=True)
class Boundary:
    """Events that lie on a border of a rule, and what must come of them: the reason of each event, and the quantity of
    each order line as of the close and in the end (absent where there is no line)."""

    name: str
    events: list[dict]
    reasons: list[str]
    at_close: dict[tuple[str, str], int] = field(default_factory=dict)
    in_the_end: dict[tuple[str, str], int] = field(default_factory=dict)


def boundaries(close: datetime) -> list[Boundary]:
    """One case for each border of the contract that isn't a rule of the business; close is the instant of a close."""
    base, out = close - timedelta(days=9), []
    iso = lambda t: t.astimezone(timezone.utc).isoformat()

    def event(name: str, kind: str, no: int = 0, at: datetime = base, arrived: timedelta | datetime = timedelta(minutes=5), **fields) -> dict:
        came = arrived if isinstance(arrived, datetime) else at + arrived
        own = {"event_id": f"{name}-{kind[-3:]}-{no}", "event_type": kind, "event_ts": iso(at), "arrival_ts": iso(came), "order_id": f"B-{name}", "sku": "SB", "boundary": name}
        return own | ({"customer_id": "C00000001", "qty": 3, "unit_price_cents": 100, "currency": "EUR"} if kind == "order_placed" else {}) | fields

    def case(name: str, events: list[dict], reasons: str | list[str] = "accepted", close_qty: int | None = None, end_qty: int | None = None) -> None:
        line = (f"B-{name}", "SB")
        qty = lambda n: {} if n is None else {line: n}
        out.append(Boundary(name, events, [reasons] * len(events) if isinstance(reasons, str) else reasons, qty(close_qty), qty(end_qty)))

    sale, amended, returned, hour, tick = "order_placed", "order_line_amended", "return_registered", timedelta(hours=1), timedelta(microseconds=1)
    case("free-line", [event("free-line", sale, unit_price_cents=0)], close_qty=3, end_qty=3)
    case("no-units", [event("no-units", sale, qty=0)], "non_positive_quantity")
    case("return-of-nothing", [event("return-of-nothing", sale), event("return-of-nothing", returned, qty=0)], ["accepted", "non_positive_quantity"], 3, 3)
    case("return-at-the-sale", [event("return-at-the-sale", sale), event("return-at-the-sale", returned, qty=3)], "accepted", 3, 3)
    case("arrives-at-the-close", [event("arrives-at-the-close", sale, arrived=close)], "accepted", 3, 3)
    case("arrives-a-tick-late", [event("arrives-a-tick-late", sale, arrived=close + tick)], "accepted", None, 3)
    case("arrives-an-hour-late", [event("arrives-an-hour-late", sale, at=close - hour, arrived=close + hour)], "accepted", None, 3)
    case("amended-after-the-close", [event("amended-after-the-close", sale, qty=2), event("amended-after-the-close", amended, arrived=close + hour, new_qty=7)], "accepted", 2, 7)
    case("amendments-that-tie", [event("amendments-that-tie", sale), event("amendments-that-tie", amended, 1, new_qty=5), event("amendments-that-tie", amended, 2, new_qty=9)], "accepted", 9, 9)
    case("amended-to-nothing", [event("amended-to-nothing", sale, qty=4), event("amended-to-nothing", amended, new_qty=0)], ["accepted", "non_positive_quantity"], 4, 4)
    case("sales-in-time-order", [event("sales-in-time-order", sale, 1, base + hour, qty=5), event("sales-in-time-order", sale, 2, base, qty=6)], "accepted", 6, 6)
    case("sales-that-tie", [event("sales-that-tie", sale, 2, qty=5), event("sales-that-tie", sale, 1, qty=6)], "accepted", 6, 6)
    for name, kind, column, bound in (("price", sale, "unit_price_cents", 1_000_000), ("units", sale, "qty", 10_000), ("returned-units", returned, "qty", 10_000), ("amended-units", amended, "new_qty", 10_000)):
        case(f"{name}-at-the-bound", [event(f"{name}-at-the-bound", kind, **{column: bound})], "accepted", *([bound if column == "qty" else 3] * 2 if kind == sale else []))
        case(f"{name}-past-the-bound", [event(f"{name}-past-the-bound", kind, **{column: bound + 1})], "amount_out_of_range")
    return out


def write_boundaries(root: str, close: datetime) -> list[Boundary]:
    """Writes root/batch=boundaries/part-0.json with the events of all cases and returns the cases."""
    cases = boundaries(close)
    os.makedirs(f"{root}/batch=boundaries", exist_ok=True)
    with open(f"{root}/batch=boundaries/part-0.json", "w") as f:
        f.write("\n".join(json.dumps(e) for c in cases for e in c.events) + "\n")
    return cases
