"""What readers of a close get: deadlines and breaches, money text, a report."""

from __future__ import annotations

import html

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import accounting_month
from tidemark.session import ACCOUNTING_ZONE


def deadline_us(month: Column, day: int = 5, zone: str = ACCOUNTING_ZONE) -> Column:
    """Microsecond at which a month (yyyy-MM) must be closed: the last second of a day of the next month, in the zone.

    A day beyond the end of that month is its last day.
    """
    first = F.add_months(F.to_date(F.concat(month, F.lit("-01")), "yyyy-MM-dd"), 1)
    at = F.least(F.date_add(first, day - 1), F.last_day(first))
    return F.unix_micros(F.to_utc_timestamp(F.concat(at.cast("string"), F.lit(" 23:59:59")).cast("timestamp"), zone))


def overdue(log: DataFrame, event_us: str, ledger: DataFrame, period: str, now_us: int, day: int = 5) -> DataFrame:
    """(period, deadline_us) of months with events whose deadline has passed and that the ledger doesn't have."""
    months = log.where(F.col(event_us).isNotNull()).select(accounting_month(F.timestamp_micros(event_us)).alias(period)).distinct()
    due = months.withColumn("deadline_us", deadline_us(F.col(period), day)).where(F.col("deadline_us") < now_us)
    return due.join(ledger.select(period).distinct(), period, "left_anti")


def breaches(log: DataFrame, event_us: str, arrival_us: str, ledger: DataFrame, period: str, now_us: int, sla_minutes: int, day: int = 5) -> DataFrame:
    """(breach, subject, lag_seconds): no_data, or ingestion_lag and a close_overdue for each month past its deadline.

    No rows means that all is well. A log without arrivals is no_data alone, as nothing can be said of its months.
    """
    last = log.agg(F.max(arrival_us).alias("at"))
    lag = F.call_function("div", F.lit(now_us).cast("bigint") - F.col("at"), F.lit(1_000_000).cast("bigint"))
    of_log = last.select(F.when(F.col("at").isNull(), "no_data").when(lag > sla_minutes * 60, "ingestion_lag").alias("breach"), F.lit("log").alias("subject"), lag.alias("lag_seconds"))
    due = overdue(log, event_us, ledger, period, now_us, day)
    of_months = due.select(F.lit("close_overdue").alias("breach"), F.col(period).alias("subject"), F.call_function("div", F.lit(now_us).cast("bigint") - F.col("deadline_us"), F.lit(1_000_000).cast("bigint")).alias("lag_seconds"))
    return of_log.where(F.col("breach").isNotNull()).unionByName(of_months)


def euros(cents: Column, signed: bool = False) -> Column:
    """Cents as text with blanks between thousands and a decimal comma, by integers only: 672 693,42."""
    whole = F.regexp_replace(F.call_function("div", F.abs(cents), F.lit(100).cast("bigint")).cast("string"), r"(?<=\d)(?=(\d{3})+\z)", " ")
    sign = F.when(cents < 0, "-").when(F.lit(signed) & (cents > 0), "+").otherwise("")
    return F.concat(sign, whole, F.lit(","), F.lpad(F.pmod(F.abs(cents), F.lit(100)).cast("string"), 2, "0"))


def report(versions: DataFrame, title: str, columns: list[str]) -> str:
    """An HTML page with one row per version. versions is a ledger of months: small, and read on the driver."""
    rows = versions.select(*[F.col(c).cast("string").alias(c) for c in columns]).orderBy(*columns[:2]).collect()
    cell = lambda tag, v: f"<{tag}>{html.escape('' if v is None else str(v))}</{tag}>"
    head = "".join(cell("th", c) for c in columns)
    body = "\n".join("<tr>" + "".join(cell("td", v) for v in r) + "</tr>" for r in rows)
    return f"<!doctype html>\n<meta charset='utf-8'><title>{html.escape(title)}</title>\n<h1>{html.escape(title)}</h1>\n<table>\n<tr>{head}</tr>\n{body}\n</table>\n"
