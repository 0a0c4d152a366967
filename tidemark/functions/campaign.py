"""Crash campaigns: a worker is killed at a point, started again, and what it leaves is held against a clean run."""

from __future__ import annotations

import os
import subprocess
import sys
from collections.abc import Callable
from dataclasses import dataclass, field

from tidemark.functions.crash import CRASHED
from tidemark.operators.evidence import Rate


@dataclass
class Outcome:
    """By point: runs that crashed as asked for, and those of them that didn't converge."""

    crashed: dict[str, int] = field(default_factory=dict)
    diverged: dict[str, int] = field(default_factory=dict)

    def rate(self, point: str | None = None) -> Rate:
        """Divergence of one point or of all; with none seen, Rate.interval() gives its upper bound."""
        of = lambda d: d.get(point, 0) if point else sum(d.values())
        return Rate(of(self.diverged), of(self.crashed))


def worker(code: str, crash: str | None, timeout: int = 300) -> int:
    """Exit code of a Python process that runs code, told to crash at a point (name:nth) or not."""
    env = os.environ | {"TIDEMARK_CRASH": crash or ""}
    return subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, timeout=timeout).returncode


def campaign(points: list[str], runs: int, code_of: Callable[[str], str], result_of: Callable[[str], object], clean: object) -> Outcome:
    """runs crashes at each point. code_of(name) is the worker of a run, whose result result_of(name) reads.

    A run that doesn't crash where it was told to raises an error, as its result would say nothing.
    """
    out = Outcome()
    for point in points:
        for i in range(runs):
            name = f"{point.replace(':', '-')}-{i}"
            if worker(code_of(name), point) != CRASHED:
                raise RuntimeError(f"{name} didn't crash")
            if worker(code_of(name), None) != 0:
                raise RuntimeError(f"{name} didn't come up again")
            out.crashed[point] = out.crashed.get(point, 0) + 1
            out.diverged[point] = out.diverged.get(point, 0) + (result_of(name) != clean)
    return out
