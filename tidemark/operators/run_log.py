"""Queries over a log of runs: (run_id, at, event_type, level, details) with details as JSON text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EXPECTATIONS = "array<struct<name:string,dataset:string,passed_records:bigint,failed_records:bigint>>"


def run_states(log: DataFrame, newest: int = 10) -> DataFrame:
    """(run_id, state, started, ended, errors) of the newest runs; the state is that of the last progress, by time."""
    state = F.get_json_object("details", "$.progress.state")
    per = log.groupBy("run_id").agg(
        F.max_by(state, F.when(state.isNotNull(), F.col("at"))).alias("state"),
        F.min("at").alias("started"),
        F.max("at").alias("ended"),
        F.count_if(F.col("level") == "ERROR").alias("errors"),
    )
    return per.orderBy(F.col("ended").desc(), "run_id").limit(newest)


def expectations(log: DataFrame) -> DataFrame:
    """(dataset, name, passed_records, failed_records) summed over the log's progress events."""
    items = log.select(F.explode(F.from_json(F.get_json_object("details", "$.progress.expectations"), EXPECTATIONS)).alias("e"))
    return items.groupBy("e.dataset", "e.name").agg(F.sum("e.passed_records").alias("passed_records"), F.sum("e.failed_records").alias("failed_records"))


def last_run_expectations(log: DataFrame) -> DataFrame:
    """(run_id, dataset, name, passed_records, failed_records) of the run that ended last: one row joined with its own."""
    last = log.groupBy("run_id").agg(F.max("at").alias("ended")).orderBy(F.col("ended").desc(), "run_id").limit(1).select("run_id")
    own = log.join(F.broadcast(last), "run_id")
    items = own.select("run_id", F.explode(F.from_json(F.get_json_object("details", "$.progress.expectations"), EXPECTATIONS)).alias("e"))
    return items.groupBy("run_id", "e.dataset", "e.name").agg(F.sum("e.passed_records").alias("passed_records"), F.sum("e.failed_records").alias("failed_records"))


def alert(log: DataFrame, sound: str = "COMPLETED") -> DataFrame:
    """(alert, run_id, state): one row, alert being true where the last run isn't sound or no run is known."""
    last = run_states(log, 1).select("run_id", "state", "errors")
    got = last.agg(F.max("run_id").alias("run_id"), F.max("state").alias("state"), F.max("errors").alias("errors"))
    return got.select((~F.coalesce((F.col("state") == sound) & (F.col("errors") == 0), F.lit(False))).alias("alert"), "run_id", "state")
