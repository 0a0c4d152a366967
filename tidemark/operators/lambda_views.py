"""Figures per period that late events correct until a cut-off: a lambda architecture of two stored layers.

The log holds kept messages. The fast layer adds what arrived since it last ran to the provisional figures of the
periods that are open. The scheduled batch computes the open periods anew from the whole log and replaces whatever the
fast layer made of them, so a fault of the fast layer lasts until the next batch only; periods whose last close has
passed it freezes, and what arrives for them later is recorded as too late and changes no figure.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import commits

#: Most rows a calendar may have to be sent to all tasks. A longer one is joined by period and one of SALTS numbers,
#: so that a period with a third of all rows goes to many tasks.
SMALL_CALENDAR, SALTS = 10_000, 64
#: Before every instant, and after every one.
NEVER, ALWAYS = -(2**62), 2**62


def versions_by_period(calendar: DataFrame, period: str, version: str, closed_at: str) -> DataFrame:
    """(period, _versions): the versions of each period with the microsecond of their close, in order of version."""
    us = F.unix_micros(F.col(closed_at).cast("timestamp"))
    return calendar.groupBy(period).agg(F.sort_array(F.collect_set(F.struct(F.col(version).cast("int").alias("v"), us.alias("us")))).alias("_versions"))


def first_version_in_time(log: DataFrame, calendar: DataFrame, *, period: str, arrival_us: str, version: str, closed_at: str, small: int = SMALL_CALENDAR) -> DataFrame:
    """log with first_version, late and cut_us: the first version of its period that a row had arrived for, -1 if it
    came after the last; whether it missed version 0; and the last close of its period.

    An arrival at the very instant of a close is in time. Rows of a period without a calendar are left out.
    """
    versions = versions_by_period(calendar, period, version, closed_at)
    if calendar.count() <= small:
        joined = log.join(F.broadcast(versions), period)
    else:
        salted = versions.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in log.columns if c != period]), F.lit(SALTS)).cast("int")
        joined = log.withColumn("_salt", salt).join(salted, [period, "_salt"]).drop("_salt")
    in_time = F.filter("_versions", lambda x: x["us"] >= F.col(arrival_us))
    first = F.coalesce(F.array_min(F.transform(in_time, lambda x: x["v"])), F.lit(-1))
    late = F.exists("_versions", lambda x: (x["v"] == 0) & (x["us"] < F.col(arrival_us)))
    cut_us = F.array_max(F.transform("_versions", lambda x: x["us"]))
    return joined.withColumns({"first_version": first.cast("int"), "late": late, "cut_us": cut_us}).drop("_versions")


def batch_view(deltas: DataFrame, calendar: DataFrame, *, period: str, version: str, figures: list[str]) -> DataFrame:
    """(period, version, figures...) of the calendar's versions: what had arrived by the close of each.

    Periods without rows have zeros. The deltas have at most one row per period and version, so their sums per version
    are a small join by period.
    """
    versions = calendar.select(period, F.col(version).cast("int").alias(version)).distinct()
    d = deltas.where(F.col("first_version") >= 0)
    joined = versions.join(d, period, "left").where(F.col("first_version").isNull() | (F.col("first_version") <= F.col(version)))
    missing = versions.join(d.select(period, "first_version"), period, "left").groupBy(period, version).agg(F.min("first_version").alias("_m"))
    sums = joined.groupBy(period, version).agg(*[F.sum(c).alias(c) for c in figures])
    return missing.drop("_m").join(sums, [period, version], "left").select(period, version, *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in figures])


class LambdaStore:
    """The two layers in a folder. Each run writes folders of its own and then publishes, under the next number, what
    the views consist of; a run that broke off leaves nothing, and of two writers one gets FileExistsError.

    log, in all methods, is what first_version_in_time gives: one row per kept message with a period, with the
    columns of the figures. figures are aggregates of a group of rows that are sums (counts, sums), with zero for none.
    """

    def __init__(self, spark: SparkSession, path: str, calendar: DataFrame, *, key: str, period: str, arrival_us: str, version: str, closed_at: str, figures: dict[str, Column]):
        self.spark, self.path, self.calendar, self.key, self.period = spark, path.rstrip("/"), calendar, key, period
        self.arrival_us, self.version, self.closed_at, self.figures = arrival_us, version, closed_at, figures

    def state(self) -> dict:
        """now_us and batch_us: up to when the fast layer and the batch have taken in the log; and the views' folders."""
        done = commits.names(self.spark, f"{self.path}/commits")
        if not done:
            return {"no": -1, "now_us": NEVER, "batch_us": NEVER, "fast": [], "open": None, "frozen": [], "too_late": []}
        return json.loads(commits.read_text(self.spark, f"{self.path}/commits/{done[-1]}"))

    def _publish(self, state: dict) -> None:
        state["no"] += 1
        commits.publish(self.spark, f"{self.path}/commits/{state['no']:06d}.json", json.dumps(state).encode())

    def _sums(self, rows: DataFrame, *by) -> DataFrame:
        """Figures of groups; they combine before the shuffle, so a heavy period sends one row per map task."""
        return rows.groupBy(*by).agg(*[c.cast("bigint").alias(n) for n, c in self.figures.items()])

    def _late(self, rows: DataFrame, frozen: Column) -> DataFrame:
        return rows.where("late").select(self.key, self.period, "first_version", frozen.alias("frozen"))

    def increment(self, log: DataFrame, until_us: int) -> None:
        """Fast layer: takes in what arrived since the last run up to until_us.

        Rows of open periods are added to their provisional figures; rows that missed version 0 are recorded with the
        version they are in time for, those of frozen periods as too late.
        """
        state = self.state()
        new = log.where((F.col(self.arrival_us) > state["now_us"]) & (F.col(self.arrival_us) <= until_us))
        folder, frozen = f"fast-{uuid.uuid4().hex}", F.col("cut_us") <= state["batch_us"]
        self._sums(new.where(~frozen), self.period).write.parquet(f"{self.path}/{folder}/totals")
        self._late(new, frozen).write.parquet(f"{self.path}/{folder}/late")
        state |= {"now_us": until_us, "fast": [*state["fast"], folder]}
        self._publish(state)

    def batch(self, log: DataFrame, at_us: int) -> None:
        """Batch layer: computes all open periods anew from the whole log up to at_us and replaces their figures; those
        whose last close lies at or before at_us are frozen and never computed again."""
        if self.state()["now_us"] < at_us:
            self.increment(log, at_us)  # what came for frozen periods is too late, and only the fast layer sees it
        state = self.state()
        rows = log.where((F.col("cut_us") > state["batch_us"]) & (F.col(self.arrival_us) <= at_us))
        folder, frozen = f"batch-{uuid.uuid4().hex}", F.col("cut_us") <= at_us
        counted = rows.where(~frozen | (F.col(self.arrival_us) <= F.col("cut_us")))
        self._sums(counted, self.period, frozen.alias("frozen")).write.parquet(f"{self.path}/{folder}/totals")
        us = F.unix_micros(F.col(self.closed_at).cast("timestamp"))
        ends = self.calendar.groupBy(self.period).agg(F.max(us).alias("cut_us")).where(F.col("cut_us") > state["batch_us"])
        closed = self.calendar.where(us <= at_us).join(ends, self.period)
        view = batch_view(self._sums(rows, self.period, "first_version"), closed, period=self.period, version=self.version, figures=list(self.figures))
        view.join(ends, self.period).withColumn("frozen", frozen).drop("cut_us").write.parquet(f"{self.path}/{folder}/versions")
        self._late(rows, frozen).write.parquet(f"{self.path}/{folder}/late")
        state |= {"batch_us": at_us, "open": folder, "frozen": [*state["frozen"], folder], "too_late": [*state["too_late"], *state["fast"]], "fast": []}
        self._publish(state)

    def _read(self, what: str, folders: list[str], ddl: str, frozen: bool | None = None) -> DataFrame:
        paths = [f"{self.path}/{f}/{what}" for f in folders if f]
        df = self.spark.read.schema(ddl).parquet(*paths) if paths else self.spark.createDataFrame([], ddl)
        return df if frozen is None else df.where(F.col("frozen") if frozen else ~F.col("frozen"))

    def _ddl(self, *more: str) -> str:
        return ", ".join([f"`{self.period}` {dict(self.calendar.dtypes)[self.period]}", *more, *[f"`{n}` bigint" for n in self.figures]])

    def versions(self) -> DataFrame:
        """(period, version, figures...) of all closed versions, as of the last batch: frozen ones and those of open periods."""
        state, ddl = self.state(), self._ddl(f"`{self.version}` int", "frozen boolean")
        both = self._read("versions", state["frozen"], ddl, True).unionByName(self._read("versions", [state["open"]], ddl, False))
        return both.drop("frozen")

    def late(self, key_type: str = "string") -> DataFrame:
        """(key, period, first_version) of the rows that missed version 0, as the layers recorded them."""
        state = self.state()
        ddl = f"`{self.key}` {key_type}, `{self.period}` {dict(self.calendar.dtypes)[self.period]}, first_version int, frozen boolean"
        parts = [self._read("late", state["frozen"], ddl, True), self._read("late", [state["open"]], ddl, False), self._read("late", state["fast"], ddl), self._read("late", state["too_late"], ddl, True)]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.drop("frozen")

    def serve(self) -> DataFrame:
        """(period, figures..., status) now: frozen figures stand, the others are the batch's plus the fast layer's."""
        state, ddl = self.state(), self._ddl("frozen boolean")
        frozen = self._read("totals", state["frozen"], ddl, True).drop("frozen").withColumn("status", F.lit("frozen"))
        open_ = self._read("totals", [state["open"]], ddl, False).drop("frozen").unionByName(self._read("totals", state["fast"], self._ddl()))
        provisional = open_.groupBy(self.period).agg(*[F.sum(n).cast("bigint").alias(n) for n in self.figures])
        return frozen.unionByName(provisional.withColumn("status", F.lit("provisional")))
