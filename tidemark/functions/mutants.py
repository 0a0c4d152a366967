"""Mutants of SQL texts, to see whether data and checks would notice a small fault of a rule."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from tidemark.functions.statistics import kappa

#: What a fault may look like: name, pattern and what stands in its place. Fixed values.
FAULTS: list[tuple[str, str, str | Callable[[re.Match], str]]] = [
    ("comparison", r"<=", "<"), ("comparison", r">=", ">"), ("comparison", r"(?<![<>=!])<(?![=>])", "<="), ("comparison", r"(?<![<>=!-])>(?!=)", ">="), ("equality", r"<>", "="),
    ("number", r"(?<![\w.'{}$:])\d+(?![\w.'}])", lambda m: str(int(m[0]) + 1)), ("join", r"\bLEFT JOIN\b", "JOIN"), ("join", r"\bFULL JOIN\b", "LEFT JOIN"), ("aggregate", r"\bsum\(", "max("), ("aggregate", r"\bmin\(", "max("),
    ("aggregate", r"\bmax\(", "min("), ("order", r"\bDESC\b", "ASC"), ("order", r"\bASC\b", "DESC"), ("nulls", r"\bNULLS LAST\b", "NULLS FIRST"), ("logic", r"\bAND\b(?! (?:CURRENT|UNBOUNDED|\d))", "OR"), ("logic", r"\bOR\b", "AND"),
    ("null", r"\bIS NOT DISTINCT FROM\b", "="), ("null", r"\bIS DISTINCT FROM\b", "<>"), ("null", r"\bIS NOT NULL\b", "IS NULL"), ("set", r"\bUNION ALL\b", "UNION"), ("arithmetic", r" - ", " + "), ("distinct", r"\bDISTINCT\b(?! FROM)", ""),
]
TEXTS = re.compile(r"'(?:[^']|'')*'")


@dataclass(frozen=True)
class Mutant:
    fault: str
    at: int
    sql: str


def mutants(sql: str) -> list[Mutant]:
    """One mutant for each place where a fault can stand; what is within quotes isn't touched."""
    quoted = [(m.start(), m.end()) for m in TEXTS.finditer(sql)]
    out = []
    for name, pattern, instead in FAULTS:
        for m in re.finditer(pattern, sql):
            if not any(a <= m.start() < b for a, b in quoted):
                new = instead(m) if callable(instead) else instead
                out.append(Mutant(name, m.start(), sql[: m.start()] + new + sql[m.end() :]))
    return out


@dataclass
class Score:
    """Mutants that a witness told from the original, those that it didn't, and those that don't run."""

    killed: list[Mutant]
    survived: list[Mutant]
    broken: list[Mutant]

    def rate(self) -> float:
        """Share of killed ones among those that run; broken mutants prove nothing."""
        n = len(self.killed) + len(self.survived)
        return len(self.killed) / n if n else float("nan")


def score(of: Iterable[Mutant], run: Callable[[str], object], original: object) -> Score:
    out = Score([], [], [])
    for m in of:
        try:
            same = run(m.sql) == original
        except Exception:  # a mutant that isn't SQL any more, or that the engine refuses
            out.broken.append(m)
            continue
        (out.survived if same else out.killed).append(m)
    return out


def agreement(a: Score, b: Score) -> float:
    """Cohen's kappa of two witnesses over the mutants that both ran: near 1 they are one witness twice."""
    kills = {m: True for m in a.killed} | {m: False for m in a.survived}
    others = {m: True for m in b.killed} | {m: False for m in b.survived}
    return kappa([(kills[m], others[m]) for m in kills if m in others])
