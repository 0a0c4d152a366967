"""Queries p1 to p7 over the driver's tables, and their SQL for the oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import accounting_month, instant, instant_us, plain_month, utc_text
from tidemark.operators import asof, bloom_dedup, compaction, lambda_views, reconcile, satellites
from tidemark.operators.kept import copy_rank, kept_copies
from tidemark.operators.timeline import Chunks
from tidemark.session import cut, scratch
from tidemark.sources import landing

#: A file with fewer rows than this is too small.
SMALL_FILE_ROWS = 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    ntz = {n: F.col(n).cast("timestamp") for n, t in df.dtypes if t == "timestamp_ntz"}
    return df.withColumns(ntz) if ntz else df


# --- 1 ---


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    sides = [table(spark, sf_dir, t).withColumn("accounting_month", plain_month(F.col("accounting_month"))) for t in ("close_month", "close_month_copy")]
    return reconcile.differences(*sides, ["shop_id", "accounting_month", "close_version"], missing_in_a="missing_in_close_month", missing_in_b="missing_in_copy")


# --- 2 ---


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return satellites.build_history(table(spark, sf_dir, "customer_updates"), "customer_id", instant_us(F.col("valid_from")), F.col("event_id"), ["segment", "country"])


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _versions_of(_history(spark, sf_dir))


def _versions_of(h: DataFrame) -> DataFrame:
    return h.select("customer_id", utc_text(F.col("at_us")).alias("valid_from"), F.coalesce(utc_text(F.col("end_us")), F.lit("")).alias("valid_to"), F.coalesce("segment", F.lit("")).alias("segment"))


#: Numbers of the batches at which a further load begins.
LOADS = (14, 27, 40)


def p2_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history after loading the updates by batch_no, late corrections included: equal to p2_found."""
    updates = table(spark, sf_dir, "customer_updates")
    no = sum((F.coalesce("batch_no", F.lit(0)) >= b).cast("int") for b in LOADS)
    at = scratch(spark, "satellites")
    for i in range(len(LOADS) + 1):
        store = satellites.SatelliteStore(spark, at, "customer_id", [["segment"], ["country"]])
        store.load(updates.where(no == i), instant_us(F.col("valid_from")), F.col("event_id"))
    return _versions_of(store.history())


# --- 3 ---


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = compaction.compact(table(spark, sf_dir, "bronze_events"), "ingest_file")
    return compaction.small_files(done.manifest(), SMALL_FILE_ROWS).where(F.col("file") != "").select(F.col("file").alias("ingest_file"))


def p3_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per event_id after the rewrite: the same as before it."""
    done = compaction.compact(table(spark, sf_dir, "bronze_events"), "ingest_file")
    return done.rows().groupBy("event_id").agg(F.count("*").alias("n_rows"))


# --- 4 ---


def _sales(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    events = table(spark, sf_dir, "bronze_events")
    kept = kept_copies(events, "event_id", instant_us(F.col("event_ts")), instant_us(F.col("arrival_ts")), ["event_type", *columns])
    return kept.where(F.col("event_type") == "order_placed")


def _versioned_sales(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    sales = _sales(spark, sf_dir, columns).where(F.col("event_us").isNotNull() & F.col("arrival_us").isNotNull())
    log = sales.withColumn("accounting_month", accounting_month(F.timestamp_micros("event_us")))
    return lambda_views.first_version_in_time(log, table(spark, sf_dir, "close_calendar"), period="accounting_month", arrival_us="arrival_us", version="close_version", closed_at="closed_at")


FIGURES: dict[str, Callable[[], Column]] = {
    "sale_count": lambda: F.count("*"),
    "unit_count": lambda: F.coalesce(F.sum("qty"), F.lit(0)),
}


def _layers(spark: SparkSession, sf_dir: str) -> tuple[lambda_views.LambdaStore, DataFrame, DataFrame]:
    """An empty store, the log of kept sales with their versions, written once as all runs read it, and the calendar."""
    calendar, at = table(spark, sf_dir, "close_calendar"), scratch(spark, "layers")
    log = _versioned_sales(spark, sf_dir, ["qty"]).withColumn("qty", F.when(F.col("qty").between(1, 10_000), F.col("qty")))
    log.select("event_id", "accounting_month", "arrival_us", "qty", "first_version", "late", "cut_us").write.parquet(f"{at}/log")
    store = lambda_views.LambdaStore(
        spark, f"{at}/store", calendar, key="event_id", period="accounting_month", arrival_us="arrival_us", version="close_version", closed_at="closed_at", figures={n: f() for n, f in FIGURES.items()}
    )
    return store, spark.read.parquet(f"{at}/log"), calendar


def _run_to_the_end(spark: SparkSession, sf_dir: str) -> lambda_views.LambdaStore:
    """Batches a third and two thirds through the closes and at the last one, the fast layer in between and afterwards."""
    store, log, calendar = _layers(spark, sf_dir)
    at = calendar.agg(F.percentile(F.unix_micros(F.col("closed_at").cast("timestamp")), [1 / 3, 2 / 3, 1.0]).alias("at")).first()["at"]
    for t in at or []:
        store.batch(log, int(t))
    store.increment(log, lambda_views.ALWAYS)
    return store


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the layers recorded of the sales that missed version 0."""
    late = _run_to_the_end(spark, sf_dir).late()
    return late.select("event_id", "accounting_month", F.col("first_version").alias("close_version"))


def p4_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly figures of each close version, as corrected by what had arrived by then: the view of the last batch."""
    return _run_to_the_end(spark, sf_dir).versions()


def p4_serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The serving view on 2026-08-20T00:00Z, the last batch having run on 2026-08-15T00:00Z."""
    store, log, _ = _layers(spark, sf_dir)
    store.batch(log, 1_786_752_000_000_000)
    store.increment(log, 1_787_184_000_000_000)
    return store.serve()


# --- 5 ---


def _bucket() -> Column:
    return bloom_dedup.month_bucket(instant_us(F.col("arrival_ts")))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "bronze_events").select("event_id", "event_ts", "arrival_ts")
    found = bloom_dedup.repeated(events, "event_id", _bucket(), instant_us(F.col("event_ts")), instant_us(F.col("arrival_ts")), ["arrival_ts"])
    return found.select("event_id", "arrival_ts")


def p5_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly one row, with all its columns, for each event_id."""
    events = table(spark, sf_dir, "bronze_events")
    return bloom_dedup.deduplicated(events, "event_id", _bucket(), instant_us(F.col("event_ts")), instant_us(F.col("arrival_ts")))


#: Arrival months from which the second and the third delivery of the log begin; unreadable arrivals come with the first.
DELIVERIES = ("2026-04", "2026-07")


def p5_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, delivery): the log taken in by three deliveries, the store being opened anew for each; one row per event_id."""
    month = F.date_format(instant(F.col("arrival_ts")), "yyyy-MM")
    events = table(spark, sf_dir, "bronze_events").select("event_id", "event_ts", "arrival_ts", sum((month >= m).cast("int") for m in DELIVERIES).alias("delivery"))
    events = events.withColumn("delivery", F.coalesce("delivery", F.lit(0)))
    at, out = scratch(spark, "seen"), None
    for d in range(len(DELIVERIES) + 1):
        rank = copy_rank(instant_us(F.col("event_ts")), instant_us(F.col("arrival_ts")), ["arrival_ts"])
        new = bloom_dedup.SeenStore(spark, at).ingest(events.where(F.col("delivery") == d), "event_id", _bucket(), rank).select("event_id", "delivery")
        out = new if out is None else out.unionByName(new)
    return out


# --- 6 ---


def _known(spark: SparkSession, sf_dir: str, attributes: list[str]) -> tuple[DataFrame, Callable[[str], DataFrame], Chunks]:
    """Sales, the history of an attribute by its name, and the chunks of both timelines."""
    updates = table(spark, sf_dir, "customer_updates").withColumnRenamed("event_id", "update_event_id")
    valid, arrived = instant_us(F.col("valid_from")), instant_us(F.col("arrival_ts"))
    known = asof.first_arrivals(updates, "customer_id", valid, arrived, "update_event_id", attributes).withColumn("update_id", F.col("update_event_id"))
    sales = _sales(spark, sf_dir, ["customer_id"]).where(F.col("event_us").isNotNull() & F.col("customer_id").isNotNull())
    raw = table(spark, sf_dir, "bronze_events").where(F.col("event_type") == "order_placed")
    chunks = asof.timeline_chunks(raw, updates, "customer_id", "event_id", instant_us(F.col("event_ts")), F.greatest(valid, arrived))
    return sales, lambda a: asof.attribute_history(known, "customer_id", "update_event_id", a, chunks), chunks


def p6_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, customer_id, known_update_id, known_segment, known_country) of every sale that an update was known for."""
    sales, history, chunks = _known(spark, sf_dir, ["segment", "country"])
    out = asof.as_known_at(cut(sales), "customer_id", "event_id", "event_us", {a: history(a) for a in ("update_id", "segment", "country")}, chunks)
    return out.select("event_id", "customer_id", "known_update_id", "known_segment", "known_country")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of all attributes only the update itself is asked for, so only its history is built and matched."""
    sales, history, chunks = _known(spark, sf_dir, [])
    out = asof.matched(sales, "customer_id", "event_id", "event_us", history("update_id"), chunks)
    return out.select("event_id", F.col("value.value").alias("update_event_id"))


# --- 7 ---


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = landing.classified(table(spark, sf_dir, "landing_lines"))
    return lines.where(F.col("quarantine_reason") != "accepted").select("line_id", "quarantine_reason")


def p7_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line that isn't valid with its reason, its event_id where one can be read, and the place of the fault."""
    lines = landing.classified(table(spark, sf_dir, "landing_lines"), carry=["feed", "ingest_file"])
    return lines.where(F.col("quarantine_reason") != "accepted").select("line_id", "feed", "ingest_file", "event_id", "quarantine_reason", "fault_offset", "fault_expected", "recovered")


def p7_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All valid lines as typed records."""
    lines = landing.classified(table(spark, sf_dir, "landing_lines"))
    valid = lines.where(F.col("quarantine_reason") == "accepted")
    return valid.select("line_id", *[instant(F.col(f)).alias(f) if f.endswith("_ts") else f for f in landing.FIELDS])


def p7_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with times as text in UTC, as any engine can compare them."""
    records = p7_records(spark, sf_dir)
    return records.select("line_id", *[utc_text(F.unix_micros(f)).alias(f) if f.endswith("_ts") else f for f in landing.FIELDS])


def p7_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole records that stand in lines that aren't valid, each with what the rules say of it."""
    return landing.recovered(table(spark, sf_dir, "landing_lines"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p1_found, p2_found, p2_batches, p3_found, p3_rows, p4_found, p4_versions, p4_serving, p5_found, p5_rows, p5_batches, p6_found, p6_attributes, p7_found, p7_quarantine, p7_records, p7_values, p7_recovered)
}
