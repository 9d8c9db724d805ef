"""Tier-change pairing and leave-one-out MRR, computed for every candidate at once.

The reference checks one subscription (``ORDER BY id LIMIT 1``) by recomputing the
whole metric without it. Recomputing per candidate would cost |candidates| full
passes; instead the monthly totals are computed once and each candidate's own
contribution is subtracted (exact decimal arithmetic, so total - own == sum of others).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import columns as C
from ledgerline.operators import metric


def exact_amount(cents: Column, interval: Column, count: Column) -> Column:
    """Normalised monthly dollars as decimal(38,10); NULL for unsupported intervals."""
    div = C.monthly_divisor(interval, count)
    return F.when(div.isNotNull(), cents.cast("decimal(28,0)") / div.cast("decimal(10,0)"))


def exact_contribution(month: Column, start_date: Column, cancel_date: Column, status: Column, amount: Column) -> Column:
    """Amount when the subscription is active at the end of ``month``, else 0 (NULL amount -> 0)."""
    eom = F.last_day(month)
    active = (
        ~status.isin(*C.NEVER_ACTIVATED)
        & (start_date <= eom)
        & (cancel_date.isNull() | (cancel_date > eom))
    )
    zero = F.lit(0).cast("decimal(38,10)")
    return F.when(F.coalesce(active, F.lit(False)), F.coalesce(amount, zero)).otherwise(zero)


def monthly_totals(subs: DataFrame, start, end) -> DataFrame:
    """(month, total decimal(38,10)) for every month of the window, 0 when empty.

    One row a month; joins to it are left to the planner, which checks its size.
    """
    per_group = (
        metric.contributions(subs, start, end)
        .groupBy("month", "divisor")
        .agg(F.sum("unit_amount_cents").alias("cents"))
    )
    strict = per_group.groupBy("month").agg(
        F.sum(F.col("cents").cast("decimal(28,0)") / F.col("divisor").cast("decimal(10,0)")).alias("total")
    )
    months = metric.month_series(subs.sparkSession, start, end).withColumnRenamed("month_start", "month")
    return months.join(strict, "month", "left").select(
        "month",
        F.col("total").isNotNull().alias("in_strict"),
        F.coalesce("total", F.lit(0).cast("decimal(38,10)")).cast("decimal(38,10)").alias("total"),
    )


def swept_totals(subs: DataFrame, start, end) -> DataFrame:
    """(month, total decimal(38,10)) by another way than the series: a running sum of what
    starts and what ends, by month.

    The checks compare the series with it, so a fault of one form shows against the other.
    Events are summed map-side by (month, divisor); the running sum has a row a month.
    """
    w0, w1 = F.lit(metric._month(start)), F.lit(metric._month(end))
    act = metric.active_subscriptions(subs).withColumn("divisor", C.monthly_divisor("interval_type", "interval_count"))
    act = act.where(F.col("divisor").isNotNull() & F.col("sub_start_date").isNotNull())
    begins = C.month_floor("sub_start_date")
    ends = F.greatest(C.month_floor("sub_canceled_date"), begins)  # canceled before its start: no month counts
    cents = F.col("unit_amount_cents")
    events = F.array(
        F.struct(begins.alias("month"), cents.alias("cents")),
        F.struct(F.when(F.col("sub_canceled_date").isNotNull(), ends).alias("month"), (-cents).alias("cents")),
    )
    deltas = (
        act.select("divisor", F.inline(events))
        .where(F.col("month").isNotNull() & (F.col("month") <= w1))
        .groupBy(F.greatest("month", w0).alias("month"), "divisor")
        .agg(F.sum("cents").alias("cents"))
        .groupBy("month")
        .agg(F.sum(F.col("cents").cast("decimal(28,0)") / F.col("divisor").cast("decimal(10,0)")).alias("delta"))
    )
    months = metric.month_series(subs.sparkSession, start, end).withColumnRenamed("month_start", "month")
    running = F.sum("delta").over(Window.orderBy("month").rowsBetween(Window.unboundedPreceding, 0))
    return months.join(deltas, "month", "left").select(
        "month", F.coalesce(running, F.lit(0)).cast("decimal(38,10)").alias("total")
    )


def swept_and_series(subs: DataFrame, start, end, series: DataFrame | None = None) -> DataFrame:
    """(month, total, mrr_strict): the swept total beside the checked series (default: G1)."""
    series = metric.mrr_monthly(subs, start, end) if series is None else series
    return swept_totals(subs, start, end).join(
        series.select("month", F.col("mrr_amount").alias("mrr_strict")), "month", "left"
    )


def _sub_side(subs: DataFrame, prefix: str) -> DataFrame:
    return subs.select(
        F.col("stripe_customer_id"),
        F.col("stripe_subscription_id").alias(f"{prefix}_sub_id"),
        F.col("status").alias(f"{prefix}_status"),
        C.ts_to_date("start_date").alias(f"{prefix}_start_date"),
        C.nullable_ts_to_date("canceled_at").alias(f"{prefix}_cancel_date"),
        F.col("unit_amount_cents").cast("bigint").alias(f"{prefix}_unit_cents"),
        F.col("interval").alias(f"{prefix}_interval"),
        F.col("interval_count").cast("bigint").alias(f"{prefix}_interval_count"),
    )


def tier_change_pairs(subs: DataFrame, lo, hi) -> DataFrame:
    """(v0, v1) of one customer where v1 starts on v0's cancel date or the day after.

    Expressed as an equi-join on (customer, day): each v0 asks for the two days it can
    be followed on, so a customer with many subscriptions never produces the
    all-pairs product a join on customer alone would. Output rows are the pairs only.
    """
    v0 = (
        _sub_side(subs, "v0")
        .where(F.col("v0_cancel_date").isNotNull())
        .where(F.col("v0_cancel_date").between(F.lit(lo).cast("date"), F.lit(hi).cast("date")))
        .withColumn("_day", F.explode(F.array(F.col("v0_cancel_date"), F.date_add("v0_cancel_date", 1))))
    )
    v1 = _sub_side(subs, "v1").where(F.col("v1_start_date").isNotNull()).withColumn("_day", F.col("v1_start_date"))
    return (
        v0.join(v1, ["stripe_customer_id", "_day"])
        .where(F.col("v0_sub_id") != F.col("v1_sub_id"))
        .drop("_day")
    )


def cancel_candidates(subs: DataFrame, start, end) -> DataFrame:
    """Canceled subscriptions whose cancel month and previous month are in the window."""
    w0, w1 = metric._month(start), metric._month(end)
    s = _sub_side(subs, "s")
    cand = s.where(
        (F.col("s_status") == "canceled")
        & F.col("s_cancel_date").isNotNull()
        & (F.col("s_cancel_date") >= F.add_months(F.lit(w0), 1))
        & (F.col("s_cancel_date") < F.lit(w1))
    )
    return cand.select(
        F.col("s_sub_id").alias("stripe_subscription_id"),
        "s_status", "s_start_date", "s_cancel_date",
        exact_amount(F.col("s_unit_cents"), F.col("s_interval"), F.col("s_interval_count")).alias("contribution"),
        C.month_floor("s_cancel_date").alias("cancel_month"),
    )


def own_in(month: Column) -> Column:
    """What a row of :func:`cancel_candidates` contributes in ``month``."""
    return exact_contribution(month, F.col("s_start_date"), F.col("s_cancel_date"), F.col("s_status"), F.col("contribution"))


def leave_one_out(subs: DataFrame, start, end) -> DataFrame:
    """G3 for every canceled subscription whose cancel month and previous month are in the window.

    Columns: stripe_subscription_id, cancel_month, month (prev or cancel month),
    contribution (the sub's own monthly amount), own (its contribution in ``month``),
    mrr_excluding (total of ``month`` without it), mrr_strict (G1 value, NULL if absent).
    """
    cand = cancel_candidates(subs, start, end).withColumn(
        "month", F.explode(F.array(C.prev_month("cancel_month"), F.col("cancel_month")))
    )
    totals = monthly_totals(subs, start, end)
    own = own_in(F.col("month"))
    return cand.join(totals, "month").select(
        "stripe_subscription_id",
        "cancel_month",
        "month",
        "contribution",
        own.alias("own"),
        (F.col("total") - own).alias("mrr_excluding"),
        F.when(F.col("in_strict"), F.col("total")).alias("mrr_strict"),
    )


def excluding_pair(subs: DataFrame, start, end, totals: DataFrame | None = None) -> DataFrame:
    """G4 for every tier-change pair whose v0 cancel date lies in the window.

    Columns: pair columns of J4 plus month (transition month), c0, c1 (own amounts),
    mrr_excluding_pair, mrr_strict. ``totals``: (month, total, mrr_strict) to use instead
    of the series' own totals.
    """
    w0, w1 = metric._month(start), metric._month(end)
    pairs = tier_change_pairs(subs, w0, w1).withColumn("month", C.month_floor("v0_cancel_date"))
    c0 = exact_amount(F.col("v0_unit_cents"), F.col("v0_interval"), F.col("v0_interval_count"))
    c1 = exact_amount(F.col("v1_unit_cents"), F.col("v1_interval"), F.col("v1_interval_count"))
    pairs = pairs.withColumn("c0", c0).withColumn("c1", c1)
    own0 = exact_contribution(F.col("month"), F.col("v0_start_date"), F.col("v0_cancel_date"), F.col("v0_status"), F.col("c0"))
    own1 = exact_contribution(F.col("month"), F.col("v1_start_date"), F.col("v1_cancel_date"), F.col("v1_status"), F.col("c1"))
    if totals is None:
        strict = F.when(F.col("in_strict"), F.col("total")).alias("mrr_strict")
        totals = monthly_totals(subs, start, end).select("month", "total", strict)
    return pairs.join(totals, "month").select(
        "stripe_customer_id", "v0_sub_id", "v1_sub_id", "month", "c0", "c1",
        (F.col("total") - own0 - own1).alias("mrr_excluding_pair"),
        "mrr_strict",
    )
