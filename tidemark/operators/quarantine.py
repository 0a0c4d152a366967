"""Rules as data: an ordered, total, null-safe classification of records, and reports about its rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import instant
from tidemark.session import CURRENCY, MAX_LINE_QUANTITY, MAX_UNIT_PRICE_CENTS

#: Fixed values of the contract.
REQUIRED = {
    "order_placed": ["order_id", "sku", "customer_id", "qty", "unit_price_cents", "currency"],
    "order_line_amended": ["order_id", "sku", "new_qty"],
    "return_registered": ["order_id", "sku", "qty"],
    "customer_upserted": ["customer_id"],
}
ACCEPTED = "accepted"

Rules = list[tuple[str, Column]]


def bound(value: int) -> Column:
    """A BIGINT literal, so that a bound keeps its width against text columns too."""
    return F.lit(value).cast("bigint")


def rules() -> Rules:
    """(reason, fault) in the order of the contract; a fault that is null counts as a fault."""
    kind, col = F.col("event_type"), F.col
    sale, amended, returned = kind == "order_placed", kind == "order_line_amended", kind == "return_registered"
    missing = F.lit(False)
    for k, names in REQUIRED.items():
        absent = F.lit(False)
        for n in names:
            absent = absent | col(n).isNull()
        missing = missing | ((kind == k) & absent)
    quantity = F.when(sale | returned, col("qty").cast("bigint")).when(amended, col("new_qty").cast("bigint")).otherwise(bound(1))
    return [
        ("unparseable_json", col("event_id").isNull()),
        ("unknown_event_type", ~F.coalesce(kind.isin(*REQUIRED), F.lit(False))),
        ("missing_required_field", instant(col("event_ts")).isNull() | instant(col("arrival_ts")).isNull() | missing),
        ("non_positive_quantity", quantity < bound(1)),
        ("negative_price", sale & (col("unit_price_cents").cast("bigint") < bound(0))),
        ("unknown_currency", sale & (col("currency") != CURRENCY)),
        ("amount_out_of_range", (quantity > bound(MAX_LINE_QUANTITY)) | (sale & (col("unit_price_cents").cast("bigint") > bound(MAX_UNIT_PRICE_CENTS)))),
    ]


def quarantine_reason(of: Rules | None = None) -> Column:
    """The first rule that holds or can't be decided; accepted only where every rule is decided and doesn't hold.

    Every row gets exactly one value; a row that no branch decides raises an error instead of passing.
    """
    of = of or rules()
    sound = F.lit(True)
    for _, fault in of:
        sound = sound & F.coalesce(~fault, F.lit(False))
    reason = F.when(sound, F.lit(ACCEPTED)).otherwise(F.raise_error(F.lit("no rule decided a row")).cast("string"))
    for name, fault in reversed(of):
        reason = F.when(F.coalesce(fault, F.lit(True)), F.lit(name)).otherwise(reason)
    return reason


def undecided_rule(of: Rules | None = None) -> Column:
    """Name of the deciding rule if it was null rather than true; null where the decision was clear."""
    of = of or rules()
    out = F.lit(None).cast("string")
    for name, fault in reversed(of):
        out = F.when(fault.isNull(), F.lit(name)).when(fault, F.lit(None).cast("string")).otherwise(out)
    return out


def classify(df: DataFrame, of: Rules | None = None) -> DataFrame:
    """df with quarantine_reason; no row is removed."""
    return df.withColumn("quarantine_reason", quarantine_reason(of))


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted rows without the tag, and quarantined rows with it."""
    return df.where(F.col("quarantine_reason") == ACCEPTED).drop("quarantine_reason"), df.where(F.col("quarantine_reason") != ACCEPTED)


def rule_counts(df: DataFrame, of: Rules | None = None) -> DataFrame:
    """(rule, passed, failed) of each rule by itself, in one pass; an undecided rule fails."""
    of = of or rules()
    sums = [F.coalesce(F.sum(F.coalesce(f, F.lit(True)).cast("bigint")), F.lit(0)).alias(n) for n, f in of]
    totals = df.agg(F.count("*").alias("_n"), *sums)
    pairs = ", ".join(f"'{n}', _n - `{n}`, `{n}`" for n, _ in of)
    return totals.selectExpr(f"stack({len(of)}, {pairs}) as (rule, passed, failed)")
