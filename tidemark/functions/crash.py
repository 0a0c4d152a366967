"""Places at which a test can end the process, to see that what comes after a crash is sound."""

from __future__ import annotations

import os

#: before and after a micro-batch is written; between the files of a merge and its publication; before a commit marker.
CRASH_POINTS = ("before_write", "after_write", "mid_merge", "before_close_marker")


#: Exit code of a process that was told to crash.
CRASHED = 17


def barrier(point: str) -> None:
    """Ends the process at once if TIDEMARK_CRASH names this point; at the n-th pass, if it says point:n."""
    asked = os.environ.get("TIDEMARK_CRASH", "")
    name, _, nth = asked.partition(":")
    if name == point:
        left = int(nth or 1) - 1
        os.environ["TIDEMARK_CRASH"] = f"{name}:{left}" if left else ""
        if not left:
            os._exit(CRASHED)
