"""Privacy by built-in expressions: policies, masks, tokens, exposure scan, k-anonymity, secured views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import instant
from tidemark.session import ACCOUNTING_ZONE

#: What an identifier of a customer looks like in free text. Fixed value.
IDENTIFIER = r"(?i)\bC\d{6,}\b"


def pseudonym(c: Column, salt: str) -> Column:
    """First 32 hexadecimal digits of a salted SHA-256, NUL between; null stays null. The salt must not be empty."""
    if not salt:
        raise ValueError("an empty salt gives hashes that anyone can compute")
    return F.substring(F.sha2(F.concat(F.lit(salt), F.lit("\x00"), c), 256), 1, 32)


def token(c: Column, key: bytes) -> Column:
    """First 24 hexadecimal digits of HMAC-SHA256, written out with two nested SHA-256, so it stays in the JVM."""
    import hashlib

    key = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    inner, outer = (F.lit(bytearray(b ^ x for b in key)) for x in (0x36, 0x5C))
    return F.substring(F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, F.encode(c, "UTF-8")), 256))), 256), 1, 24)


def vault(df: DataFrame, column: str, key: bytes) -> DataFrame:
    """(token, value): what those with access need to go back from tokens; kept apart from the data."""
    return df.where(F.col(column).isNotNull()).select(token(F.col(column), key).alias("token"), F.col(column).alias("value")).distinct()


def generalised(text: Column, to: str, zone: str = ACCOUNTING_ZONE) -> Column:
    """A readable time cut down to its day, month or year in the accounting zone."""
    pattern = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}[to]
    return F.date_format(F.from_utc_timestamp(instant(text), zone), pattern)


def with_policy(df: DataFrame, policy: dict[str, str], salt: str) -> DataFrame:
    """df under a policy by column: keep, drop, pseudonym, day, month or year. Columns not named are dropped."""
    out = []
    for name in df.columns:
        rule = policy.get(name, "drop")
        if rule == "keep":
            out.append(F.col(name))
        elif rule == "pseudonym":
            out.append(pseudonym(F.col(name), salt).alias(name))
        elif rule != "drop":
            out.append(generalised(F.col(name), rule).alias(name))
    return df.select(*out)


def exposure(df: DataFrame, pattern: str = IDENTIFIER) -> DataFrame:
    """(column_name, exposed_rows, example) of every text column that holds an identifier, in one pass over all rows."""
    names = [n for n, t in df.dtypes if t == "string"]
    hit = {n: F.col(n).rlike(pattern) for n in names}
    sums = df.agg(*[F.count_if(hit[n]).alias(f"n_{n}") for n in names], *[F.min(F.when(hit[n], F.col(n))).alias(f"e_{n}") for n in names])
    parts = ", ".join(f"'{n}', `n_{n}`, `e_{n}`" for n in names)
    return sums.selectExpr(f"stack({len(names)}, {parts}) as (column_name, exposed_rows, example)").where(F.col("exposed_rows") > 0)


def k_anonymity(df: DataFrame, quasi: list[str]) -> DataFrame:
    """(k, groups, unique_groups): size of the smallest group of equal quasi-identifiers."""
    g = df.groupBy(*quasi).agg(F.count("*").alias("n"))
    return g.agg(F.min("n").alias("k"), F.count("*").alias("groups"), F.count_if(F.col("n") == 1).alias("unique_groups"))


def secured(df: DataFrame, row_filter: Column, masked: dict[str, Column]) -> DataFrame:
    """A view for readers without rights: the rows they may see, with masked columns."""
    return df.where(row_filter).select(*[masked[c].alias(c) if c in masked else F.col(c) for c in df.columns])
