"""Instants written as text, the accounting month and canonical UTC text. All are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.session import ACCOUNTING_ZONE

#: ISO 8601 date and time, T or a blank between, with Z or an offset. \z, as $ would allow a line break at the end.
READABLE = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}:\d{2})\z"


def instant(text: Column) -> Column:
    """TIMESTAMP of a readable time, else null; never an error. Days and hours that don't exist give null."""
    return F.when(text.rlike(READABLE), F.try_to_timestamp(text))


def instant_us(text: Column) -> Column:
    """Microseconds since the epoch of a readable time, else null."""
    return F.unix_micros(instant(text))


def utc_text(us: Column) -> Column:
    """yyyy-MM-ddTHH:mm:ss.SSSSSSZ in UTC of microseconds (session zone UTC)."""
    return F.date_format(F.timestamp_micros(us), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def accounting_month(moment: Column, zone: str = ACCOUNTING_ZONE) -> Column:
    """yyyy-MM of an instant in the accounting zone, never the prefix of its text (session zone UTC)."""
    return F.date_format(F.from_utc_timestamp(moment, zone), "yyyy-MM")


def plain_month(text: Column) -> Column:
    """yyyy-MM of a month however written: 2026-1, 202601, 2026/01, 2026-01-15, 01/2026, with blanks around.

    Text that is no month stays as it is, without blanks around; null stays null.
    """
    t = F.regexp_replace(text, r"^[\s ]+|[\s ]+\z", "")
    year_first = r"^(\d{4})(?:[-/._ ]?(0[1-9]|1[0-2])|[-/._ ]([1-9]))(?:[-/._ ]?\d{1,2}(?:[T ].*)?)?\z"
    month_first = r"^(0?[1-9]|1[0-2])[-/._ ](\d{4})\z"
    month = F.concat(F.regexp_extract(t, year_first, 2), F.regexp_extract(t, year_first, 3))
    return (
        F.when(t.rlike(year_first), F.concat(F.regexp_extract(t, year_first, 1), F.lit("-"), F.lpad(month, 2, "0")))
        .when(t.rlike(month_first), F.concat(F.regexp_extract(t, month_first, 2), F.lit("-"), F.lpad(F.regexp_extract(t, month_first, 1), 2, "0")))
        .otherwise(t)
    )
