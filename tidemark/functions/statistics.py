"""Intervals and agreement for rates that are reported with few observations."""

from __future__ import annotations

import math


def wilson(hits: int, n: int, z: float = 1.959964) -> tuple[float, float]:
    """Wilson score interval of a rate; (0, 1) without observations."""
    if n == 0:
        return 0.0, 1.0
    p, d = hits / n, 1 + z * z / n
    middle, half = (p + z * z / (2 * n)) / d, z / d * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    return max(0.0, middle - half), min(1.0, middle + half)


def none_seen(n: int, confidence: float = 0.95) -> float:
    """Upper bound of a rate when none of n trials showed it, by the rule of three: -ln(1 - confidence) / n, 1 at most."""
    return 1.0 if n == 0 else min(1.0, -math.log(1 - confidence) / n)


def kappa(pairs: list[tuple[object, object]]) -> float:
    """Cohen's kappa of two raters; not a number where it is undefined: without pairs, or where both always say one thing."""
    n = len(pairs)
    if not n:
        return math.nan
    seen = sum(a == b for a, b in pairs) / n
    chance = sum((sum(a == v for a, _ in pairs) / n) * (sum(b == v for _, b in pairs) / n) for v in {x for p in pairs for x in p})
    return math.nan if chance == 1 else (seen - chance) / (1 - chance)
