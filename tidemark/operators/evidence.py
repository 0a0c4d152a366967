"""A chain of records in JSON lines: each names the digest of the one before, so a change anywhere shows."""

from __future__ import annotations

import hashlib
import json
import os
from dataclasses import dataclass

from tidemark.functions.statistics import none_seen, wilson

@dataclass(frozen=True)
class Rate:
    """hits of n trials, with the interval that n allows to state."""

    hits: int
    n: int

    def interval(self) -> tuple[float, float]:
        return (0.0, none_seen(self.n)) if self.hits == 0 else wilson(self.hits, self.n)


@dataclass(frozen=True)
class Pass:
    claim: str
    rate: Rate | None = None


@dataclass(frozen=True)
class Fail:
    claim: str
    counterexample: object = None


def body_of(verdict: Pass | Fail) -> dict:
    """What the chain records of a verdict. A pass without a single trial is refused, as it would claim what nobody saw."""
    if isinstance(verdict, Fail):
        return {"claim": verdict.claim, "ok": False, "counterexample": repr(verdict.counterexample)}
    if verdict.rate is not None and verdict.rate.n == 0:
        raise ValueError(f"{verdict.claim}: no trial was run")
    return {"claim": verdict.claim, "ok": True} | ({} if verdict.rate is None else {"hits": verdict.rate.hits, "n": verdict.rate.n, "interval": list(verdict.rate.interval())})


START = "0" * 32


def _digest(before: str, body: dict) -> str:
    return hashlib.blake2b((before + json.dumps(body, sort_keys=True)).encode(), digest_size=16).hexdigest()


def append(path: str, body: dict) -> str:
    """Adds a record to the chain (a file of small records, kept by the driver) and returns its digest."""
    before = verify(path)
    own = _digest(before, body)
    with open(path, "a") as f:
        f.write(json.dumps({"before": before, "body": body, "digest": own}, sort_keys=True) + "\n")
    return own


def verify(path: str) -> str:
    """Digest of the last record; ValueError with the line of the first one that doesn't fit."""
    before = START
    if os.path.exists(path):
        with open(path) as f:
            for i, line in enumerate(f, 1):
                r = json.loads(line)
                if r["before"] != before or r["digest"] != _digest(before, r["body"]):
                    raise ValueError(f"record {i} doesn't fit the chain")
                before = r["digest"]
    return before
