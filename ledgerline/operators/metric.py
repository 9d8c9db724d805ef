"""Monthly recurring revenue under the end-of-month snapshot rule.

A subscription contributes to month M when it ever activated, started on or before
LAST_DAY(M), and was not canceled on or before LAST_DAY(M). Its contribution is the
price normalised to one month (month: cents/count/100, year: cents/12/count/100;
other intervals contribute nothing).

Physical form. The reference cross-joins months with subscriptions and filters. Here
each subscription instead generates exactly the months it is active in (a bounded
``sequence`` clipped to the window) and the result is aggregated with a map-side
partial step: no join, no broadcast, one small shuffle of at most
(#months x #distinct divisors) rows per map task. Cents are summed as BIGINT per
(month, divisor) so the result is exact and independent of partitioning; the
division into dollars happens on those few groups only.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import columns as C

END_OF_MONTH = "end_of_month"  # canceled date > LAST_DAY(M)  (the rule in force)
ANY_PART_OF_MONTH = "any_part"  # canceled date >= first day of M (retired rule, regression guard)


def _month(d) -> dt.date:
    d = dt.date.fromisoformat(d) if isinstance(d, str) else d
    return d.replace(day=1)


def window_months(start, end) -> int:
    a, b = _month(start), _month(end)
    n = (b.year - a.year) * 12 + (b.month - a.month) + 1
    if n < 1:
        raise ValueError(f"empty month window {start}..{end}")
    return n


def month_series(spark: SparkSession, start, end) -> DataFrame:
    """One row per first-of-month date in [start, end] (``month_start``)."""
    window_months(start, end)
    a, b = _month(start), _month(end)
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(a), F.lit(b), F.expr("INTERVAL 1 MONTH"))).alias("month_start")
    )


def active_subscriptions(subs: DataFrame) -> DataFrame:
    """A5 + F1 + P1-P3: the projection the metric reads, never-activated statuses removed."""
    return subs.where(~F.col("status").isin(*C.NEVER_ACTIVATED)).select(
        "stripe_subscription_id",
        "stripe_customer_id",
        C.ts_to_date("start_date").alias("sub_start_date"),
        C.nullable_ts_to_date("canceled_at").alias("sub_canceled_date"),
        "status",
        F.col("unit_amount_cents").cast("bigint").alias("unit_amount_cents"),
        C.lower_interval("interval").alias("interval_type"),
        F.col("interval_count").cast("bigint").alias("interval_count"),
    )


def _active_range(start_date: Column, cancel_date: Column, w0: dt.date, w1: dt.date, rule: str):
    # greatest() skips NULLs: a NULL start must stay NULL (never active), not become w0
    lo = F.when(start_date.isNotNull(), F.greatest(F.trunc(start_date, "MM"), F.lit(w0)))
    if rule == END_OF_MONTH:
        # cancel > LAST_DAY(M)  <=>  M < trunc(cancel)  <=>  M <= trunc(cancel) - 1 month
        last = F.add_months(F.trunc(cancel_date, "MM"), -1)
    elif rule == ANY_PART_OF_MONTH:
        # cancel >= M  <=>  M <= trunc(cancel)
        last = F.trunc(cancel_date, "MM")
    else:
        raise ValueError(f"unknown rule {rule!r}")
    hi = F.least(F.coalesce(last, F.lit(w1)), F.lit(w1))
    return lo, hi


def contributions(subs: DataFrame, start, end, rule: str = END_OF_MONTH, keep_unsupported: bool = False) -> DataFrame:
    """One row per (month, subscription) the subscription is active in.

    Columns: month, stripe_subscription_id, stripe_customer_id, unit_amount_cents,
    divisor (NULL for unsupported intervals), amount (double dollars or NULL).
    ``keep_unsupported`` keeps rows whose interval does not normalise (amount NULL),
    which is what an inner theta join without the final NULL filter returns.
    """
    window_months(start, end)
    w0, w1 = _month(start), _month(end)
    act = active_subscriptions(subs).withColumn("divisor", C.monthly_divisor("interval_type", "interval_count"))
    if not keep_unsupported:
        act = act.where(F.col("divisor").isNotNull())
    lo, hi = _active_range(F.col("sub_start_date"), F.col("sub_canceled_date"), w0, w1, rule)
    # The guard lives inside the expression: a reversed sequence raises, and a filter
    # placed before it may be reordered by the optimizer.
    months = F.when(lo <= hi, F.sequence(lo, hi, F.expr("INTERVAL 1 MONTH")))
    return act.select(
        F.explode(months).alias("month"),
        "stripe_subscription_id",
        "stripe_customer_id",
        "unit_amount_cents",
        "divisor",
        (F.col("unit_amount_cents") / F.col("divisor")).alias("amount"),
    )


def _exact_dollars(cents: Column, divisor: Column) -> Column:
    return cents.cast("decimal(28,0)") / divisor.cast("decimal(10,0)")


def mrr_monthly(subs: DataFrame, start, end, rule: str = END_OF_MONTH) -> DataFrame:
    """G1: (month DATE, mrr_amount DECIMAL(38,9)); months with nothing active are absent."""
    per_group = (
        contributions(subs, start, end, rule)
        .groupBy("month", "divisor")
        .agg(F.sum("unit_amount_cents").alias("cents"))
    )
    return (
        per_group.groupBy("month")
        .agg(F.sum(_exact_dollars(F.col("cents"), F.col("divisor"))).alias("mrr_amount"))
        .select("month", F.col("mrr_amount").cast("decimal(38,9)").alias("mrr_amount"))
        .orderBy("month")
    )


def mrr_monthly_filled(subs: DataFrame, start, end, rule: str = END_OF_MONTH) -> DataFrame:
    """Every month of the window, 0 when nothing is active (the documented contract)."""
    months = month_series(subs.sparkSession, start, end).withColumnRenamed("month_start", "month")
    strict = mrr_monthly(subs, start, end, rule)
    return (
        months.join(strict, "month", "left")
        .select("month", F.coalesce("mrr_amount", F.lit(0).cast("decimal(38,9)")).alias("mrr_amount"))
        .orderBy("month")
    )


def mrr_any_part_of_month(subs: DataFrame, start, end) -> DataFrame:
    """The retired 'alive any day of M' rule, kept as a regression guard."""
    return mrr_monthly(subs, start, end, ANY_PART_OF_MONTH)


def mrr_window_total(subs: DataFrame, start, end) -> DataFrame:
    """One SUM over all (month, subscription) contributions of the window."""
    per_group = contributions(subs, start, end).groupBy("divisor").agg(F.sum("unit_amount_cents").alias("cents"))
    return per_group.agg(
        F.coalesce(F.sum(_exact_dollars(F.col("cents"), F.col("divisor"))), F.lit(0)).cast("decimal(38,9)").alias(
            "window_total"
        )
    )


def theta_pairs_per_month(subs: DataFrame, start, end) -> DataFrame:
    """The inner (months x subscriptions) theta join, summarised per month.

    Unsupported intervals are joined but add 0, as ``SUM(CASE ... ELSE 0)`` does.
    """
    per_group = (
        contributions(subs, start, end, keep_unsupported=True)
        .groupBy("month", "divisor")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("unit_amount_cents").alias("cents"))
    )
    dollars = F.when(F.col("divisor").isNotNull(), _exact_dollars(F.col("cents"), F.col("divisor"))).otherwise(
        F.lit(0)
    )
    return per_group.groupBy("month").agg(
        F.sum("n").alias("active_pairs"), F.sum(dollars).cast("decimal(38,9)").alias("mrr_amount")
    )


def signed_contributions(changes: DataFrame, start, end) -> DataFrame:
    """What a change feed (before, after) adds to each (month, divisor): cents, signed."""
    both = changes.select(F.inline(F.array(
        F.struct(F.lit(-1).alias("sign"), F.col("before").alias("row")), F.struct(F.lit(1).alias("sign"), F.col("after").alias("row")))))
    rows = both.where(F.col("row").isNotNull()).select("sign", "row.*")
    # the sign goes through the metric's own rule as the amount's sign
    signed = rows.withColumn("unit_amount_cents", F.col("unit_amount_cents") * F.col("sign"))
    return contributions(signed, start, end).groupBy("month", "divisor").agg(F.sum("unit_amount_cents").alias("cents"))


def advance(state: DataFrame | None, changes: DataFrame, start, end) -> DataFrame:
    """State (month, divisor, cents) after a change feed; without a state, of an empty table."""
    deltas = signed_contributions(changes, start, end).select("month", "divisor", "cents")
    rows = deltas if state is None else state.select("month", "divisor", "cents").unionByName(deltas)
    return rows.groupBy("month", "divisor").agg(F.sum("cents").alias("cents"))


def mrr_of_state(state: DataFrame) -> DataFrame:
    """G1 from a kept state: (month, mrr_amount)."""
    dollars = F.sum(_exact_dollars(F.col("cents"), F.col("divisor"))).cast("decimal(38,9)")
    return state.groupBy("month").agg(dollars.alias("mrr_amount")).orderBy("month")
