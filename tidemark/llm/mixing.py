"""Mixing sources to target weights by thresholds on a hash, found in nested histograms instead of by sorting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut

#: Bits of the hash that one level of histograms resolves, and its levels: 12 * 5 = 60 bits.
LEVEL_BITS, LEVELS = 12, 5
#: A table of up to so many sources is sent to all tasks; a longer one is joined by source and one of SALTS numbers, so
#: that a source with a third of all records goes to many tasks.
SMALL_TARGETS, SALTS = 10_000, 64


def position(key: Column, seed: int) -> Column:
    """Uniform 60-bit place of a record; records whose key repeats share it and are taken or left together."""
    return F.xxhash64(F.lit(seed), key).bitwiseAND(F.lit(2 ** (LEVEL_BITS * LEVELS) - 1))


def with_source(records: DataFrame, table: DataFrame, sources: int, small: int = SMALL_TARGETS) -> DataFrame:
    """Inner join of records (source, at, ...) with a table of one row per source."""
    if sources <= small:
        return records.join(F.broadcast(table), "source")
    salted = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return records.withColumn("_salt", F.pmod("at", F.lit(SALTS)).cast("int")).join(salted, ["source", "_salt"]).drop("_salt")


def thresholds(sized: DataFrame, budgets: DataFrame, sources: int, small: int = SMALL_TARGETS) -> DataFrame:
    """(source, below): the greatest threshold for which the sizes of the records placed below it fit the budget.

    budgets is (source, budget). A level sums sizes by source and bucket, 4,096 buckets a source at most, adds them up
    in order until the budget is met, and refines only the boundary bucket with the next bits. All of it is done by
    source in tables; the driver only asks whether a boundary is left.
    """
    state = cut(budgets.select("source", F.col("budget").alias("left"), F.lit(0).cast("bigint").alias("below"), (F.col("budget") > 0).alias("open")))
    for level in range(LEVELS):
        shift = LEVEL_BITS * (LEVELS - 1 - level)
        open_ = state.where("open")
        if open_.isEmpty():
            break
        inside = with_source(sized.select("source", "at", "size"), open_.select("source", "below"), sources, small)
        inside = inside.where(F.shiftright("at", shift + LEVEL_BITS) == F.shiftright("below", shift + LEVEL_BITS))
        bucket = F.shiftright("at", shift).bitwiseAND(F.lit(2**LEVEL_BITS - 1)).alias("bucket")
        sums = inside.groupBy("source", bucket).agg(F.sum("size").alias("size"), F.count("*").alias("n"))
        so_far = F.sum("size").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        at = sums.withColumn("so_far", so_far).join(open_.select("source", "left"), "source")
        fits = F.col("so_far") <= F.col("left")
        found = at.groupBy("source").agg(F.coalesce(F.max(F.when(fits, F.col("so_far"))), F.lit(0)).alias("used"), F.min(F.when(~fits, F.struct("bucket", "n"))).alias("edge"))
        joined = state.join(found, "source", "left")
        step = F.when(F.col("used").isNull(), F.lit(0)).otherwise(F.coalesce(F.col("edge.bucket"), F.lit(2**LEVEL_BITS)))
        moved = F.col("below") + F.call_function("shiftleft", step.cast("bigint"), F.lit(shift))
        # A single record that doesn't fit leaves nothing to refine, nor does a source of which everything fits.
        still = F.col("open") & F.coalesce(F.col("edge.n") > 1, F.lit(False))
        state = cut(joined.select("source", (F.col("left") - F.coalesce("used", F.lit(0))).alias("left"), moved.alias("below"), still.alias("open")))
    return state.select("source", "below")


def plan(totals: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, rounds, rest): the largest mixture with the target shares and the caps on repeats.

    totals is (source, size), targets (source, target_share, max_repeats). The size of the mixture is the least, over
    the sources, of what a source can give at most divided by its share. A source without any size, or with share 0,
    can't hold a share: it is left out and the others' shares are kept in proportion.
    """
    t = targets.select("source", F.col("target_share").cast("double").alias("w"), F.col("max_repeats").cast("bigint").alias("r"))
    usable = totals.join(t, "source").where((F.col("w") > 0) & (F.col("r") > 0) & (F.col("size") > 0))
    whole = usable.agg(F.min(F.col("size") * F.col("r") / F.col("w")).alias("whole")).first()["whole"] or 0.0
    budget = F.least(F.floor(F.lit(whole) * F.col("w") + 1e-6).cast("bigint"), F.col("size") * F.col("r"))
    return usable.select("source", F.call_function("div", budget, F.col("size")).alias("rounds"), F.pmod(budget, F.col("size")).alias("rest"))


def mixture(sized: DataFrame, targets: DataFrame, seed: int = 7, small: int = SMALL_TARGETS) -> DataFrame:
    """(key, source, size, copies) of the records in the mixture.

    sized is (key, source, size). Records of no target source, without size (null, empty texts: 0), or with copies 0
    are not in the mixture. Each source gives every record `rounds` times, and those below its threshold once more, so
    no record is used more than max_repeats times and the shares are met up to the size of one record a source. Of a
    source named twice in targets the first row by its values counts.
    """
    one = targets.where(F.col("source").isNotNull()).groupBy("source").agg(F.min(F.struct("target_share", "max_repeats")).alias("t")).select("source", "t.*")
    sized = sized.where(F.col("size") > 0).withColumn("at", position(F.col("key"), seed))
    totals = sized.groupBy("source").agg(F.sum("size").alias("size"))
    made = cut(plan(totals, one))
    sources = made.count()
    below = thresholds(sized, made.select("source", F.col("rest").alias("budget")), sources, small)
    placed = with_source(sized, made.select("source", "rounds").join(below, "source"), sources, small)
    return placed.withColumn("copies", (F.col("rounds") + (F.col("at") < F.col("below")).cast("int")).cast("int")).where(F.col("copies") > 0).select("key", "source", "size", "copies")


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, size, reached_share, most_copies) of every target source; size 0 where it gave nothing."""
    got = mixed.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("_size"), F.max("copies").alias("most_copies"))
    joined = targets.select("source", "target_share").join(got, "source", "left").withColumn("size", F.coalesce("_size", F.lit(0)))
    total = got.agg(F.sum("_size")).first()[0]
    return joined.select("source", "target_share", "size", (F.col("size") / F.lit(total)).alias("reached_share"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"))
