"""Lifecycle generator: plan invariants, distributions, subscription rows."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators import metric
from ledgerline.plans import synth


def plans(spark, n):
    return synth.lifecycle_plan(spark.range(n).select(F.col("id").alias("cust_idx")))


def test_invariants_hold(spark):
    v = synth.check_plan_invariants(plans(spark, 5000)).collect()[0]
    for k in ["change_not_after_start", "cancel_not_after_change", "same_tier_change", "past_due_changed",
              "start_out_of_range"]:
        assert v[k] == 0, k
    assert 0.20 <= v["changed"] / v["eligible"] <= 0.35


def test_status_distribution_in_band(spark):
    rows = synth.status_distribution(plans(spark, 1000)).collect()
    assert {r["status"] for r in rows} == {"active", "canceled", "past_due"}
    assert all(r["in_band"] for r in rows)
    assert synth.distinct_start_months(plans(spark, 1000)).collect()[0][0] == 5


def test_rate_zero_disables_changes(spark):
    p = synth.lifecycle_plan(spark.range(500).select(F.col("id").alias("cust_idx")), tier_change_rate=0.0)
    assert p.where(F.col("tier_change_month").isNotNull()).count() == 0


def test_subscription_rows_and_metric(spark):
    p = plans(spark, 300)
    subs = synth.lifecycle_to_subscriptions(p, dt.datetime(2025, 11, 3))
    changed = p.where(F.col("tier_change_month").isNotNull()).count()
    assert subs.count() == 300 + changed
    # one contribution per customer per month at most (no double count of tier changes)
    pairs = metric.contributions(subs, "2025-11-01", "2026-05-01")
    assert pairs.groupBy("month", "stripe_customer_id").count().where("count > 1").count() == 0
