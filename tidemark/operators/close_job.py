"""The close as a job: record what changed, verify it, or verify that nothing had to, and say how it went."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import closes
from tidemark.sources.snapshot import SnapshotTable


@dataclass
class Status:
    """ok holds only if every check of the branch that ran found nothing."""

    branch: str
    versions_written: int
    failed: dict[str, int] = field(default_factory=dict)

    @property
    def ok(self) -> bool:
        return not self.failed


def not_restated(ledger: DataFrame, source: DataFrame, keys: list[str], version: str, figures: list[str], period: str | None = None, as_of_us: int | None = None) -> dict[str, int]:
    """Violations of a run that wrote nothing: source keys the ledger lacks, and keys whose figures have moved.

    With period and as_of_us months that aren't over yet are left alone.
    """
    if period is not None:
        source = source.where(closes.eligible(F.col(period), as_of_us))
    latest = closes.current_versions(ledger, keys, version, figures)
    joined = source.join(latest.select(*keys, F.struct(*figures).alias("_old")), keys, "left")
    r = joined.agg(F.count_if(F.col("_old").isNull()).alias("absent"), F.count_if(F.col("_old").isNotNull() & ~F.col("_old").eqNullSafe(F.struct(*figures))).alias("drifted")).first()
    return {k: r[k] for k in ("absent", "drifted") if r[k]}


def run(source: DataFrame, table: SnapshotTable, keys: list[str], version: str, figures: list[str], period: str | None = None, as_of_us: int | None = None) -> Status:
    """One run over an append-only ledger. Run twice over the same source, the second writes nothing and checks that.

    With period and as_of_us the ledger has restated_at and restatement_reason, months in progress stay open, and each
    close that was written gets its seven named checks; otherwise the ledger as a whole is checked. The rows are inserted in one version of the table, so a crash leaves the ledger as it was.
    """
    before = table.read()
    rows = closes.to_record(source, before, keys, version, figures, period, as_of_us)
    base = table.versions()[-1]
    if table.insert_only(rows) == base:
        return Status("nothing to record", 0, not_restated(before, source, keys, version, figures, period, as_of_us))
    written = table.manifest()["metrics"]["rows"]
    after = table.read()
    if period is None:
        failed = {r["check_name"]: r["violations"] for r in closes.checks(after, keys, version).collect() if r["violations"]}
    else:
        closed = after.join(rows.select(*keys).distinct(), keys, "left_semi")
        per = closes.verified(closed, source, keys, period, version, figures).where(~F.col("ok")).groupBy("check_name").count()
        failed = {r["check_name"]: r["count"] for r in per.collect()}
    failed |= not_restated(after, source, keys, version, figures, period, as_of_us)
    return Status("recorded", written, failed)
