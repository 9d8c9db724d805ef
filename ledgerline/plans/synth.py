"""Synthetic customer lifecycles (D1, D2) and their invariants.

The reference draws each customer's plan from one seeded sequential RNG. Here every
draw is an independent hash of (seed, field, customer index), so plans are generated
in parallel from ``spark.range``-like input with no ordering or driver loop, and the
same draw can be recomputed anywhere (the DuckDB oracle uses the same md5 digits).
Contract = the invariants, not the exact sequence of the reference's generator.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import columns as C
from ledgerline.operators.flatten import ts_literal
from ledgerline.operators.relational import TIER_AMOUNTS_CENTS, TIER_ORDER

# Fixed values of the lifecycle model.
SEED = 42
ACTIVE_PCT, CANCELED_PCT = 70, 20  # the rest is past_due
STATUS_BOUNDS = {"active": (65, 75), "canceled": (15, 25), "past_due": (8, 12)}
START_MONTH_MAX = 4  # start month 0..4
TIER_CHANGE_RATE = 0.30
TIER_CHANGE_DELTA = (1, 2)  # months after start
CANCEL_MONTHS = (3, 4)
NUM_MONTHS = 6
DAYS_PER_MONTH = 30
CUSTOMERS_PER_BATCH = 3
TIER_CHANGE_RATE_BAND = (0.20, 0.35)


def draw(idx: Column, field: str, seed: int = SEED) -> Column:
    """32-bit unsigned draw: first 8 hex digits of md5('<seed>:<field>:<idx>')."""
    digest = F.md5(F.concat(F.lit(f"{seed}:{field}:"), idx.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def lifecycle_plan(customers: DataFrame, idx: str = "cust_idx", seed: int = SEED,
                   tier_change_rate: float = TIER_CHANGE_RATE) -> DataFrame:
    """One plan row per customer index."""
    i = F.col(idx)
    roll_status = F.pmod(draw(i, "status", seed), F.lit(100)) + 1
    status = F.when(roll_status <= ACTIVE_PCT, "active").when(roll_status <= ACTIVE_PCT + CANCELED_PCT, "canceled").otherwise(
        "past_due"
    )
    start = F.pmod(draw(i, "start_month", seed), F.lit(START_MONTH_MAX + 1)).cast("int")
    tier_pos = F.pmod(draw(i, "tier", seed), F.lit(len(TIER_ORDER))).cast("int")
    tiers = F.array(*[F.lit(t) for t in TIER_ORDER])
    initial = F.element_at(tiers, tier_pos + 1)
    roll = draw(i, "tier_change_roll", seed).cast("double") / F.lit(float(2**32))
    delta = (F.pmod(draw(i, "tier_change_delta", seed), F.lit(2)) + TIER_CHANGE_DELTA[0]).cast("int")
    others = F.array_except(tiers, F.array(initial))
    new_tier = F.element_at(others, (F.pmod(draw(i, "new_tier", seed), F.lit(2)) + 1).cast("int"))
    change_month = start + delta
    has_change = (status != "past_due") & (roll < F.lit(tier_change_rate)) & (change_month <= START_MONTH_MAX)
    cancel_draw = (F.pmod(draw(i, "cancel_month", seed), F.lit(2)) + CANCEL_MONTHS[0]).cast("int")
    cancel = F.when(
        status == "canceled",
        F.when(has_change & (cancel_draw <= change_month), F.least(change_month + 1, F.lit(NUM_MONTHS - 1))).otherwise(cancel_draw),
    )
    return customers.select(
        i.alias("cust_idx"),
        C.seed_email(i).alias("email"),
        C.seed_name(i).alias("name"),
        status.alias("status"),
        start.alias("start_month"),
        initial.alias("initial_tier"),
        F.when(has_change, change_month).alias("tier_change_month"),
        F.when(has_change, new_tier).alias("new_tier"),
        cancel.alias("cancel_month"),
    )


def plans_for_customers(customer: DataFrame, seed: int = SEED) -> DataFrame:
    """D1 over the supplied ``customer`` table: one plan per customer (index = c_custkey - 1)."""
    return lifecycle_plan(customer.select((F.col("c_custkey") - 1).alias("cust_idx")), seed=seed)


def lifecycle_to_subscriptions(plans: DataFrame, t0: dt.datetime) -> DataFrame:
    """The subscription rows the month walk produces (v0 and, on a tier change, v1).

    Month m happens at t0 + 30*m days; inside a month the walk creates, then changes
    tier, then cancels. A cancel scheduled before the start month never happens; a
    cancel in the start month gives a zero-length subscription.
    """
    def at(m: Column) -> Column:
        return F.timestamp_add("DAY", m * DAYS_PER_MONTH, ts_literal(t0))

    start, change, cancel = F.col("start_month"), F.col("tier_change_month"), F.col("cancel_month")
    cancels = cancel.isNotNull() & (cancel >= start)
    cus = F.concat(F.lit("cus_seed_"), F.col("cust_idx").cast("string"))
    amounts = F.create_map(*[x for t in TIER_ORDER for x in (F.lit(t), F.lit(TIER_AMOUNTS_CENTS[t]))])
    live = F.when(F.col("status") == "past_due", "past_due").otherwise("active")

    def row(version: int, tier: Column, begin: Column, end: Column | None) -> Column:
        return F.struct(
            F.concat(F.lit("sub_seed_"), F.col("cust_idx").cast("string"), F.lit(f"_v{version}")).alias("stripe_subscription_id"),
            tier.alias("tier"),
            at(begin).alias("start_date"),
            (at(end) if end is not None else F.lit(None).cast("timestamp")).alias("canceled_at"),
            F.lit(version).alias("version"),
        )

    v0_end = F.when(change.isNotNull(), change).when(cancels, cancel)
    v0 = row(0, F.col("initial_tier"), start, v0_end)
    v1 = row(1, F.col("new_tier"), change, F.when(cancels, cancel))
    subs = F.when(change.isNotNull(), F.array(v0, v1)).otherwise(F.array(v0))
    exploded = plans.select("cust_idx", "status", cus.alias("stripe_customer_id"), F.explode(subs).alias("s"))
    return exploded.select(
        F.col("s.stripe_subscription_id").alias("stripe_subscription_id"),
        "stripe_customer_id",
        F.when(F.col("s.canceled_at").isNotNull(), F.lit("canceled")).otherwise(live).alias("status"),
        F.col("s.tier").alias("tier"),
        amounts[F.col("s.tier")].cast("bigint").alias("unit_amount_cents"),
        F.lit("usd").alias("currency"),
        F.lit("month").alias("interval"),
        F.lit(1).cast("bigint").alias("interval_count"),
        F.col("s.start_date").alias("start_date"),
        F.col("s.canceled_at").alias("canceled_at"),
        F.col("s.start_date").alias("created_at"),
        C.seed_idempotency_key(F.col("stripe_customer_id"), 0).alias("idempotency_key_v0"),
        F.col("s.version").alias("version"),
    )


def status_distribution(plans: DataFrame) -> DataFrame:
    """G11 (+P27): count and floor percentage per status, and whether it is inside its band."""
    total = F.sum("n").over(Window.partitionBy())  # over the (at most 3) status rows
    counts = plans.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    with_pct = counts.withColumn("pct", C.pct_floor(F.col("n"), total))
    lo = F.create_map(*[x for k, (a, _) in STATUS_BOUNDS.items() for x in (F.lit(k), F.lit(a))])
    hi = F.create_map(*[x for k, (_, b) in STATUS_BOUNDS.items() for x in (F.lit(k), F.lit(b))])
    return with_pct.select(
        "status", F.col("n").alias("customers"), "pct",
        ((F.col("pct") >= lo[F.col("status")]) & (F.col("pct") <= hi[F.col("status")])).alias("in_band"),
    )


def distinct_start_months(plans: DataFrame) -> DataFrame:
    """G14."""
    return plans.agg(F.countDistinct("start_month").alias("start_months"))


def tier_change_rate(plans: DataFrame) -> DataFrame:
    """Share of non-past_due customers with a tier change."""
    eligible = plans.where(F.col("status") != "past_due")
    agg = eligible.agg(F.count(F.lit(1)).alias("eligible"), F.count("tier_change_month").alias("changed"))
    lo, hi = TIER_CHANGE_RATE_BAND
    return agg.withColumn(
        "in_band", (F.col("changed") >= F.col("eligible") * lo) & (F.col("changed") <= F.col("eligible") * hi)
    )


def check_plan_invariants(plans: DataFrame) -> DataFrame:
    """Violation counts of the plan invariants (all must be 0) and the rate band."""
    change, cancel, start = F.col("tier_change_month"), F.col("cancel_month"), F.col("start_month")
    eligible = F.col("status") != "past_due"
    return plans.agg(
        F.count(F.when(change.isNotNull() & (change <= start), 1)).alias("change_not_after_start"),
        F.count(F.when(change.isNotNull() & cancel.isNotNull() & (cancel <= change), 1)).alias("cancel_not_after_change"),
        F.count(F.when(change.isNotNull() & (F.col("new_tier") == F.col("initial_tier")), 1)).alias("same_tier_change"),
        F.count(F.when((F.col("status") == "past_due") & change.isNotNull(), 1)).alias("past_due_changed"),
        F.count(F.when((start < 0) | (start > START_MONTH_MAX), 1)).alias("start_out_of_range"),
        F.count(F.when(eligible, 1)).alias("eligible"),
        F.count(F.when(eligible & change.isNotNull(), 1)).alias("changed"),
    )
