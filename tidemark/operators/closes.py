"""Closes of a log: lines by key, running totals, bitemporal versions by retraction, ledgers and their checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.times import accounting_month
from tidemark.operators.kept import copy_rank
from tidemark.operators.timeline import CHUNK_ROWS, Chunks, running_extreme, running_sum


def first_per_key(df: DataFrame, keys: list[str], order: list[Column], columns: list[str]) -> DataFrame:
    """(keys..., columns...) of each key's first row; nulls in the order come last. Combined before the shuffle."""
    rank = F.struct(*[x for c in order for x in (c.isNull(), c)], *[F.struct(F.col(c).isNull(), F.col(c)).alias(f"v_{c}") for c in columns])
    return df.select(*keys, rank.alias("_r")).groupBy(*keys).agg(F.min("_r").alias("_r")).select(*keys, *[F.col(f"_r.v_{c}.{c}").alias(c) for c in columns])


def last_per_key(df: DataFrame, keys: list[str], order: list[Column], columns: list[str]) -> DataFrame:
    """(keys..., columns...) of each key's last row; nulls in the order count as lowest. Combined before the shuffle."""
    rank = F.struct(*[x for c in order for x in (c.isNotNull(), c)], *[F.struct(F.col(c).isNotNull(), F.col(c)).alias(f"v_{c}") for c in columns])
    return df.select(*keys, rank.alias("_r")).groupBy(*keys).agg(F.max("_r").alias("_r")).select(*keys, *[F.col(f"_r.v_{c}.{c}").alias(c) for c in columns])


def running_total(df: DataFrame, keys: list[str], at_us: str, tie: str, amount: Column, counts: Column, name: str, chunk_rows: int = CHUNK_ROWS, raw: DataFrame | None = None) -> DataFrame:
    """df with the sum of the amounts that count, from the key's first row to this one, by (at_us, tie).

    Rows that don't count add 0. at_us is BIGINT and not null, tie a text. A key with very many rows is cut along its timeline;
    nulls in a key are a value.
    Which keys are heavy is counted in raw, where it is given: rows with the keys, at_us and tie that df was made from, so
    that making df isn't done twice.
    """
    key = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    one = df.withColumns({"_key": key, "_amount": F.when(F.coalesce(counts, F.lit(False)), amount.cast("bigint")).otherwise(F.lit(0))})
    chunks = Chunks.of(one if raw is None else raw.withColumn("_key", key), "_key", at_us, chunk_rows, F.col(tie).cast("string"))
    return running_sum(chunks.add(one), chunks, "_amount", [F.col(at_us), F.col(tie)], name).drop("_key", "_amount", "_chunk")


def effective_lines(kept: DataFrame) -> DataFrame:
    """(order_id, sku, customer_id, sale_us, qty, unit_price_cents, amended) of each order line.

    The first sale by (event_us, event_id) stands; the last amendment by the same order replaces its quantity.
    """
    keys, order = ["order_id", "sku"], [F.col("event_us"), F.col("event_id")]
    sales = first_per_key(kept.where(F.col("event_type") == "order_placed"), keys, order, ["customer_id", "event_us", "qty", "unit_price_cents"])
    amended = last_per_key(kept.where(F.col("event_type") == "order_line_amended"), keys, order, ["new_qty"])
    joined = sales.join(amended, keys, "left")
    return joined.select(*keys, "customer_id", F.col("event_us").alias("sale_us"), F.coalesce("new_qty", "qty").alias("qty"), "unit_price_cents", F.col("new_qty").isNotNull().alias("amended"))


def returned(kept: DataFrame, lines: DataFrame) -> DataFrame:
    """Returns that belong to a line, at or after its sale: (order_id, sku, sale_us, qty, unit_price_cents), nothing else
    being asked of them."""
    returns = kept.where(F.col("event_type") == "return_registered").select("order_id", "sku", F.col("event_us").alias("return_us"), F.col("qty").alias("return_qty"))
    joined = returns.join(lines.select("order_id", "sku", "sale_us", "unit_price_cents"), ["order_id", "sku"]).where(F.col("return_us") >= F.col("sale_us"))
    return joined.select("order_id", "sku", "sale_us", F.col("return_qty").alias("qty"), "unit_price_cents")


def money(lines: DataFrame, returns: DataFrame) -> DataFrame:
    """(accounting_month, gross_cents, returns_cents, net_cents, line_count, return_count) by the month of the sale.

    One aggregation over signed contributions instead of an outer join; a month with only one kind has zeros.
    """
    part = lambda df, sale: df.select("sale_us", (F.col("qty") * F.col("unit_price_cents")).alias("cents"), F.lit(sale).alias("sale"))
    both = part(lines, True).unionByName(part(returns, False))
    of = lambda sale, c: F.coalesce(F.sum(F.when(F.col("sale") == F.lit(sale), c)), F.lit(0)).cast("bigint")
    month = accounting_month(F.timestamp_micros("sale_us")).alias("accounting_month")
    got = both.groupBy(month).agg(of(True, F.col("cents")).alias("gross_cents"), of(False, F.col("cents")).alias("returns_cents"), of(True, F.lit(1)).alias("line_count"), of(False, F.lit(1)).alias("return_count"))
    return got.withColumn("net_cents", F.col("gross_cents") - F.col("returns_cents"))


def monthly(lines: DataFrame) -> DataFrame:
    """(accounting_month, gross_cents, line_count) by the month of the sale in the accounting zone."""
    month = accounting_month(F.timestamp_micros("sale_us"))
    return lines.groupBy(month.alias("accounting_month")).agg(F.coalesce(F.sum(F.col("qty") * F.col("unit_price_cents")), F.lit(0)).cast("bigint").alias("gross_cents"), F.count("*").alias("line_count"))


def retractions(copies: DataFrame, key: str, event_us: str, arrival_us: str, payload: list[str], chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(key, arrival_us, sign, event_us, payload...): how the kept copy of each key changes as copies arrive.

    Going by arrival, a copy that ranks before all earlier ones becomes the kept one: it is added (+1) and the one that
    was kept so far is taken back (-1). The sum of the signs up to an instant is the log as of that instant, so any
    number of closes needs one pass instead of one evaluation each.
    """
    rank = copy_rank(F.col(event_us), F.col(arrival_us), payload)
    rows = copies.where(F.col(key).isNotNull() & F.col(arrival_us).isNotNull()).select(key, F.col(arrival_us).alias("_at"), rank.alias("_r"))
    best = rows.groupBy(key, "_at").agg(F.min("_r").alias("_r"))  # repeated copies of one instant combine before the shuffle
    chunks = Chunks.of(copies.select(key, F.col(arrival_us).alias("_at")), key, "_at", chunk_rows)
    so_far = running_extreme(chunks.add(best), chunks, "_r", [F.col("_at")], "_old", least=True, before=True)
    changed = so_far.where(F.col("_old").isNull() | (F.col("_r") < F.col("_old")))
    both = F.array(F.struct(F.lit(1).alias("sign"), F.col("_r").alias("r")), F.struct(F.lit(-1).alias("sign"), F.col("_old").alias("r")))
    out = changed.select(key, F.col("_at").alias("arrival_us"), F.explode(both).alias("_x")).where(F.col("_x.r").isNotNull())
    return out.select(key, "arrival_us", "_x.sign", F.col("_x.r._event_us").alias("event_us"), *[F.col(f"_x.r.{c}.{c}").alias(c) for c in payload])


def snapshots(changes: DataFrame, period: str, closes_us: list[int], figures: dict[str, Column]) -> DataFrame:
    """(period, close_no, close_us, figures...) as of each close, from retractions; figures are per-row amounts.

    Each change counts from the first close at or after its arrival on; sums over the closes so far are windows over at
    most one row per period and close. Periods appear from the first close that knows them.
    """
    at = F.array(*[F.lit(c).cast("bigint") for c in closes_us])
    no = F.size(F.filter(at, lambda c: c < F.col("arrival_us")))
    sums = changes.withColumn("close_no", no).where(F.col("close_no") < len(closes_us)).groupBy(period, "close_no").agg(*[F.sum(F.col("sign") * c).cast("bigint").alias(n) for n, c in figures.items()])
    every = sums.groupBy(period).agg(F.min("close_no").alias("_from")).select(period, F.explode(F.sequence("_from", F.lit(len(closes_us) - 1))).alias("close_no"))
    w = Window.partitionBy(period).orderBy("close_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = every.join(sums, [period, "close_no"], "left")
    return filled.select(period, "close_no", F.element_at(at, F.col("close_no") + 1).alias("close_us"), *[F.sum(F.coalesce(F.col(n), F.lit(0))).over(w).cast("bigint").alias(n) for n in figures])


def versions(snaps: DataFrame, period: str, figures: list[str]) -> DataFrame:
    """(period, close_version, close_us, figures...): snapshots that changed something, numbered from 0.

    A period can be closed once the close lies in a later month of the accounting zone.
    """
    eligible = snaps.where(accounting_month(F.timestamp_micros("close_us")) > F.col(period))
    w = Window.partitionBy(period).orderBy("close_us")
    before = F.lag(F.struct(*figures)).over(w)
    changed = eligible.withColumn("_b", before).where(F.col("_b").isNull() | ~F.col("_b").eqNullSafe(F.struct(*figures)))
    return changed.withColumn("close_version", (F.row_number().over(w) - 1).cast("int")).select(period, "close_version", "close_us", *figures)


def current_versions(ledger: DataFrame, keys: list[str], version: str, columns: list[str]) -> DataFrame:
    """The newest version of each key."""
    return last_per_key(ledger, keys, [F.col(version)], [version, *columns])


def movement(ledger: DataFrame, keys: list[str], version: str, figures: list[str]) -> DataFrame:
    """(keys..., version, moved_<figure>...): difference of each version to the one before it; null for the first."""
    w = Window.partitionBy(*keys).orderBy(version)
    return ledger.select(*keys, version, *[(F.col(f) - F.lag(f).over(w)).alias(f"moved_{f}") for f in figures])


def restatement(ledger: DataFrame, keys: list[str], version: str, figure: str) -> DataFrame:
    """(keys..., first, last, delta, delta_bp) of a figure over all versions of a key.

    delta_bp is the change in hundredths of a percent of the first value, cut off towards zero; null where that is 0.
    """
    got = ledger.groupBy(*keys).agg(F.min_by(figure, version).alias("first_value"), F.max_by(figure, version).alias("last_value"))
    delta = F.col("last_value") - F.col("first_value")
    size = F.call_function("div", F.abs(delta) * F.lit(10_000).cast("bigint"), F.nullif(F.abs("first_value"), F.lit(0).cast("bigint")))
    return got.withColumns({"delta": delta, "delta_bp": F.when(F.signum(delta) == F.signum("first_value"), size).otherwise(-size)})


def worst(restated: DataFrame, keys: list[str]) -> DataFrame:
    """The key that lost most by its restatement, in hundredths of a percent; of equal ones the first."""
    return restated.where(F.col("delta_bp").isNotNull()).orderBy("delta_bp", *keys).limit(1)


def eligible(period: Column, as_of_us: int) -> Column:
    """Whether a month (yyyy-MM) can be closed at an instant: it lies before the instant's month in the accounting zone."""
    return accounting_month(F.timestamp_micros(F.lit(as_of_us))) > period


FIRST, RESTATED = "first close", "late arrivals after close"


def to_record(source: DataFrame, ledger: DataFrame, keys: list[str], version: str, figures: list[str], period: str | None = None, as_of_us: int | None = None) -> DataFrame:
    """Rows a close appends to a ledger: (keys..., version, figures...) of keys that are new or whose figures changed.

    With period and as_of_us only months that are over at that instant are recorded; rows then also have restated_at and
    restatement_reason. The ledger itself is never rewritten; a second run right after the first gives no rows.
    """
    if period is not None:
        source = source.where(eligible(F.col(period), as_of_us))
    latest = current_versions(ledger, keys, version, figures).select(*keys, F.col(version).alias("_v"), F.struct(*figures).alias("_old"))
    joined = source.join(latest, keys, "left")
    changed = joined.where(F.col("_v").isNull() | ~F.col("_old").eqNullSafe(F.struct(*figures)))
    stamp = [] if period is None else [F.timestamp_micros(F.lit(as_of_us)).alias("restated_at"), F.when(F.col("_v").isNull(), FIRST).otherwise(RESTATED).alias("restatement_reason")]
    return changed.select(*keys, F.coalesce(F.col("_v") + 1, F.lit(0)).cast("int").alias(version), *figures, *stamp)


def insert_only(ledger: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """ledger plus the rows whose key it doesn't have; keys of both are matched null-safely by an anti-join."""
    return ledger.unionByName(rows.join(ledger.select(*keys).distinct(), keys, "left_anti"))


def checks(ledger: DataFrame, keys: list[str], version: str) -> DataFrame:
    """(check_name, violations): named checks of a signed ledger, in one aggregation per key."""
    per = ledger.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.count_distinct(version).alias("d"),
        F.min(version).alias("lo"),
        F.max(version).alias("hi"),
        F.sum((F.col("net_cents") != F.col("gross_cents") - F.col("returns_cents")).cast("int")).alias("net"),
        F.sum((F.col("returns_cents") > F.col("gross_cents")).cast("int")).alias("over"),
        F.sum((F.col("line_count") < 0).cast("int")).alias("negative"),
    )
    s = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    one = per.agg(
        s((F.col("n") != F.col("d")).cast("int")).alias("a"),
        s(((F.col("lo") != 0) | (F.col("hi") + 1 != F.col("d"))).cast("int")).alias("b"),
        s("net").alias("c"),
        s("over").alias("d"),
        s("negative").alias("e"),
    )
    return one.selectExpr("stack(5, 'one_row_per_version', a, 'versions_are_dense', b, 'net_is_gross_minus_returns', c, 'returns_within_gross', d, 'no_negative_counts', e) as (check_name, violations)")


def verified(ledger: DataFrame, source: DataFrame, keys: list[str], period: str, version: str, figures: list[str]) -> DataFrame:
    """(keys..., check_name, ok, detail): seven named checks of each close of a ledger, with what decided them.

    ledger has restated_at besides the figures. A key's newest version is the greatest, of equal ones the last stamped,
    so that broken numbering gives a verdict too. A check that can't be decided (nulls, no source row) isn't ok. Keys are
    grouped once; a key has some versions, however many rows the log has.
    """
    whole = F.struct(version, "restated_at", *figures)
    per = ledger.groupBy(*keys).agg(
        F.max(F.struct(F.col(version), F.col("restated_at"), whole.alias("row"))).alias("_n"), F.count("*").alias("_rows"), F.count_distinct(version).alias("_distinct"),
        F.max(version).alias("_top"), F.min(version).alias("_least"), F.min("line_count").alias("_lines"),
        F.sort_array(F.collect_list(F.struct(F.col(version).alias("v"), F.col("restated_at").alias("at")))).alias("_stamps"),
    )
    per = per.withColumn("_n", F.col("_n.row")).join(source.select(*keys, F.struct(*figures).alias("_source")), keys, "left")
    n, text = (lambda c: F.col(f"_n.{c}")), (lambda c: F.coalesce(c.cast("string"), F.lit("null")))
    earlier = F.array_max(F.transform(F.filter("_stamps", lambda s: s["v"] < F.col("_top")), lambda s: s["at"]))
    of = {
        "net_is_gross_minus_returns": (n("net_cents") == n("gross_cents") - n("returns_cents"), F.concat(F.lit("gross "), text(n("gross_cents")), F.lit(" - returns "), text(n("returns_cents")), F.lit(", net says "), text(n("net_cents")))),
        "versions_have_no_gaps": ((F.col("_rows") == F.col("_top") + 1) & (F.col("_distinct") == F.col("_rows")) & (F.col("_least") == 0), F.concat(text(F.col("_rows")), F.lit(" rows for versions 0.."), text(F.col("_top")))),
        "earlier_versions_are_older": (F.when(earlier.isNull(), F.lit(True)).otherwise(earlier < n("restated_at")), F.concat(text(F.size("_stamps")), F.lit(" stamps"))),
        "written_equals_the_source": (F.when(F.col("_source").isNotNull(), F.struct(*[n(f).alias(f) for f in figures]).eqNullSafe(F.col("_source"))), F.concat(F.lit("written gross "), text(n("gross_cents")), F.lit(", source gross "), text(F.col("_source.gross_cents")))),
        "month_was_eligible_to_close": (accounting_month(n("restated_at")) > F.col(period), F.concat(F.lit("closed in "), text(accounting_month(n("restated_at"))))),
        "returns_within_gross": (n("returns_cents") <= n("gross_cents"), F.concat(F.lit("returns "), text(n("returns_cents")), F.lit(" of "), text(n("gross_cents")))),
        "no_negative_counts": (F.col("_lines") >= 0, F.concat(F.lit("least line count "), text(F.col("_lines")))),
    }
    rows = F.array(*[F.struct(F.lit(name).alias("check_name"), F.coalesce(ok, F.lit(False)).alias("ok"), detail.alias("detail")) for name, (ok, detail) in of.items()])
    return per.select(*keys, F.explode(rows).alias("x")).select(*keys, "x.*")


def check_holes(expected: DataFrame, observed: DataFrame, keys: list[str]) -> DataFrame:
    """Expected checks that nobody ran."""
    return expected.join(observed.select(*keys), keys, "left_anti")
