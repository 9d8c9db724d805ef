"""The metric over a calendar given as a table: periods of any length, which may overlap.

A subscription counts in a period when it started on or before the period's last day and was
not canceled on or before it: the last day lies in [start, cancel). The reference joins
calendar and subscriptions by these inequalities. Here an interval of days is cut into
dyadic blocks (at most two a level, of 2^level days), which hold a day once or not at all; a
day lies in one block a level. So "the day lies in the interval" is an equality of blocks,
and cents are summed per (block, divisor) before the periods are joined: what is joined is
bounded by days, not by subscriptions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import columns as C
from ledgerline.operators.metric import active_subscriptions

#: Levels of blocks: 2^22 days reach from year 1 beyond year 9999.
LEVELS = 22


def day_number(day: Column) -> Column:
    return F.date_diff(day, F.lit("0001-01-01").cast("date"))


def blocks_of_interval(first: Column, end: Column) -> Column:
    """Dyadic blocks (level, block) that make up the day numbers [first, end)."""
    parts = []
    for k in range(LEVELS + 1):
        lo, hi = F.ceil(first / F.lit(float(1 << k))).cast("int"), F.shiftright(end, k)
        some = lo < hi
        parts.append(F.when(some & (lo % 2 == 1), F.struct(F.lit(k).alias("level"), lo.alias("block"))))
        parts.append(F.when(some & (hi % 2 == 1), F.struct(F.lit(k).alias("level"), (hi - 1).alias("block"))))
    return F.filter(F.array(*parts), lambda b: b.isNotNull())


def blocks_of_day(day: Column) -> Column:
    """The blocks, one a level, that hold a day number."""
    return F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright(day, k).alias("block")) for k in range(LEVELS + 1)])


def mrr_by_period(subs: DataFrame, periods: DataFrame) -> DataFrame:
    """(period_id, active, mrr_amount DECIMAL(38,9)) for ``periods`` (period_id, last_day); a
    period in which nothing is active has 0. ``active`` counts subscriptions whose interval
    is unsupported too; these add 0, as in the reference's total over the inner join."""
    sub = active_subscriptions(subs).where(F.col("sub_start_date").isNotNull()).select(
        day_number(F.col("sub_start_date")).alias("first"),
        F.coalesce(day_number(F.col("sub_canceled_date")), F.lit(1 << LEVELS)).alias("end"),
        "unit_amount_cents",
        C.monthly_divisor("interval_type", "interval_count").alias("divisor"),
    )
    per_block = sub.select("unit_amount_cents", "divisor", F.inline(blocks_of_interval(F.col("first"), F.col("end")))).groupBy(
        "level", "block", "divisor").agg(F.count(F.lit(1)).alias("n"), F.sum("unit_amount_cents").alias("cents"))
    days = periods.select("period_id", F.inline(blocks_of_day(day_number(F.col("last_day")))))
    dollars = F.coalesce(F.col("cents").cast("decimal(28,0)") / F.col("divisor").cast("decimal(10,0)"), F.lit(0))
    summed = days.join(per_block, ["level", "block"]).groupBy("period_id", "divisor").agg(F.sum("n").alias("n"), F.sum("cents").alias("cents"))
    per_period = summed.groupBy("period_id").agg(F.sum("n").alias("active"), F.sum(dollars).alias("mrr_amount"))
    return periods.select("period_id").join(per_period, "period_id", "left").select(
        "period_id", F.coalesce("active", F.lit(0)).alias("active"), F.coalesce("mrr_amount", F.lit(0)).cast("decimal(38,9)").alias("mrr_amount"))
