"""Metric rule: golden edge rows, equivalence of the physical forms, checks."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline.operators import metric, reconcile, sqlform
from ledgerline.plans import checks

W0, W1 = "2025-11-01", "2026-05-01"
SCHEMA = (
    "stripe_subscription_id string, stripe_customer_id string, status string, unit_amount_cents bigint, "
    "interval string, interval_count bigint, start_date timestamp, canceled_at timestamp"
)


def ts(s):
    return dt.datetime.fromisoformat(s) if s else None


# Hand-written edge rows (one per rule) and the contributions they must produce.
GOLDEN = [
    ("E1v0", "c1", "canceled", 5000, "month", 1, "2025-11-03", "2025-12-09 10:00:00"),
    ("E1v1", "c1", "active", 10000, "month", 1, "2025-12-09 10:00:00", None),
    ("E2", "c2", "canceled", 5000, "month", 1, "2025-11-03", "2026-02-15"),
    ("E3a", "c3", "canceled", 5000, "month", 1, "2025-11-03", "2025-12-31 23:59:59"),
    ("E3b", "c4", "canceled", 5000, "month", 1, "2025-11-03", "2026-01-01 00:00:01"),
    ("N2", "c5", "active", 10000, "month", 2, "2025-11-03", None),
    ("NY1", "c6", "active", 120000, "YEAR", 1, "2025-11-03", None),
    ("NY2", "c7", "active", 240000, "year", 2, "2025-11-03", None),
    ("W", "c8", "active", 5000, "week", 1, "2025-11-03", None),
    ("I", "c9", "incomplete", 5000, "month", 1, "2025-11-03", None),
    ("S", "c10", "active", 5000, "month", 1, None, None),
    ("L", "c11", "active", 5000, "month", 1, "2025-11-30 23:59:59", None),
]
EXPECTED = {"2025-11-01": 500, "2025-12-01": 500, "2026-01-01": 450, "2026-02-01": 400, "2026-03-01": 400,
            "2026-04-01": 400, "2026-05-01": 400}


def golden(spark):
    rows = [(a, b, c, d, e, f, ts(g), ts(h)) for a, b, c, d, e, f, g, h in GOLDEN]
    return spark.createDataFrame(rows, SCHEMA)


def test_golden_series(spark):
    out = {r["month"].isoformat(): r["mrr_amount"] for r in metric.mrr_monthly(golden(spark), W0, W1).collect()}
    assert out == {k: Decimal(v).quantize(Decimal("1.000000000")) for k, v in EXPECTED.items()}


def test_golden_contributions_per_row(spark):
    pairs = metric.contributions(golden(spark), W0, W1)
    got = {}
    for r in pairs.collect():
        got.setdefault(r["stripe_subscription_id"], []).append((r["month"].isoformat()[:7], round(r["amount"], 2)))
    assert got["E1v0"] == [("2025-11", 50.0)]
    assert [m for m, _ in got["E1v1"]] == ["2025-12", "2026-01", "2026-02", "2026-03", "2026-04", "2026-05"]
    assert [m for m, _ in got["E2"]] == ["2025-11", "2025-12", "2026-01"]
    assert [m for m, _ in got["E3a"]] == ["2025-11"]
    assert [m for m, _ in got["E3b"]] == ["2025-11", "2025-12"]
    assert {a for _, a in got["NY1"]} == {100.0} and {a for _, a in got["NY2"]} == {100.0}
    assert {a for _, a in got["N2"]} == {50.0}
    assert "W" not in got and "I" not in got and "S" not in got
    assert len(got["L"]) == 7


def test_any_part_rule_double_counts_tier_change(spark):
    strict = {r["month"]: r["mrr_amount"] for r in metric.mrr_monthly(golden(spark), W0, W1).collect()}
    anypart = {r["month"]: r["mrr_amount"] for r in metric.mrr_any_part_of_month(golden(spark), W0, W1).collect()}
    dec = dt.date(2025, 12, 1)
    assert anypart[dec] > strict[dec]  # v0 and v1 both counted in the transition month


def test_filled_keeps_empty_months(spark):
    strict = metric.mrr_monthly(golden(spark), "2025-08-01", W1).collect()
    filled = metric.mrr_monthly_filled(golden(spark), "2025-08-01", W1).collect()
    assert len(strict) == 7 and len(filled) == 10
    assert [r["mrr_amount"] for r in filled[:3]] == [0, 0, 0]


def test_sql_form_equals_dataframe_form(spark):
    g = golden(spark)
    g.createOrReplaceTempView("golden_subs")
    a = {tuple(r) for r in metric.mrr_monthly(g, W0, W1).collect()}
    b = {tuple(r) for r in sqlform.mrr_monthly_sql(spark, "golden_subs", W0, W1).collect()}
    assert a == b


def test_explode_form_equals_theta_join(spark):
    from ledgerline.sources import fixtures

    subs = fixtures.subscriptions(spark, "/root/testdata/sf0.001")
    w0, w1 = "1994-10-01", "2002-01-01"
    months = metric.month_series(spark, w0, w1)
    act = metric.active_subscriptions(subs)
    eom = F.last_day("month_start")
    amount = F.when(F.col("interval_type") == "month", F.col("unit_amount_cents") / F.col("interval_count") / 100.0).when(
        F.col("interval_type") == "year", F.col("unit_amount_cents") / F.lit(12.0) / F.col("interval_count") / 100.0)
    theta = (
        act.join(F.broadcast(months), (F.col("sub_start_date") <= eom)
                 & (F.col("sub_canceled_date").isNull() | (F.col("sub_canceled_date") > eom)))
        .where(amount.isNotNull())
        .groupBy("month_start").agg(F.round(F.sum(amount), 2).alias("v"))
    )
    a = {(r[0], float(round(r[1], 2))) for r in metric.mrr_monthly(subs, w0, w1).collect()}
    b = {(r[0], r[1]) for r in theta.collect()}
    assert a == b and len(a) > 50


def test_checks_hold_on_derived_data(spark):
    from ledgerline.sources import fixtures

    subs = fixtures.subscriptions(spark, "/root/testdata/sf0.001")
    w0, w1 = "1994-10-01", "2002-01-01"
    c3 = checks.check_total_reconciles(subs, w0, w1).collect()[0]
    assert c3["reconciles"]
    c1 = checks.check_cancel_month(subs, w0, w1).join(
        subs.select("stripe_subscription_id", F.trunc(F.col("start_date").cast("date"), "MM").alias("start_month")),
        "stripe_subscription_id")
    assert c1.count() > 0
    # a canceled subscription counts in the month before its cancel month when it had started by then...
    started_before = F.col("start_month") < F.col("cancel_month")
    assert c1.where(started_before & ~F.col("prev_ok")).count() == 0
    assert c1.where(~started_before & F.col("prev_ok")).count() == 0
    # ...and never in its cancel month
    assert c1.where(~F.col("cancel_ok")).count() == 0


def test_tier_change_pairs_match_self_join(spark):
    from ledgerline.sources import fixtures

    subs = fixtures.subscriptions(spark, "/root/testdata/sf0.001")
    pairs = reconcile.tier_change_pairs(subs, "1994-10-01", "2002-01-01")
    a, b = subs.alias("a"), subs.alias("b")
    cd, sd = F.col("a.canceled_at").cast("date"), F.col("b.start_date").cast("date")
    brute = a.join(b, (F.col("a.stripe_customer_id") == F.col("b.stripe_customer_id"))
                   & (F.col("a.stripe_subscription_id") != F.col("b.stripe_subscription_id"))
                   & F.col("a.canceled_at").isNotNull() & (sd >= cd) & (sd <= F.date_add(cd, 1)))
    assert pairs.count() == brute.count() > 0


def test_empty_windows_are_refused_and_long_ones_are_not(spark):
    import pytest

    with pytest.raises(ValueError):
        metric.month_series(spark, "2026-05-01", "2025-11-01")
    assert metric.window_months("1000-01-01", "2999-01-01") == 1999 * 12 + 1
    assert metric.month_series(spark, "1000-01-01", "2999-01-01").count() == 1999 * 12 + 1


def test_pairs_with_a_hot_customer(spark):
    # one customer owns a third of all subscriptions; pairs stay the exact set, no all-pairs blow-up
    n = 6000
    base = spark.range(n).select(
        F.concat(F.lit("sub_"), F.col("id").cast("string")).alias("stripe_subscription_id"),
        F.when(F.col("id") % 3 == 0, F.lit("cus_hot")).otherwise(F.concat(F.lit("cus_"), (F.col("id") % 500).cast("string")))
        .alias("stripe_customer_id"),
        F.lit("canceled").alias("status"), F.lit(5000).cast("bigint").alias("unit_amount_cents"),
        F.lit("month").alias("interval"), F.lit(1).cast("bigint").alias("interval_count"),
        F.timestamp_seconds(F.lit(900000000) + F.col("id") * 3600).alias("start_date"),
        F.timestamp_seconds(F.lit(900000000) + F.col("id") * 3600 + 86400).alias("canceled_at"),
    )
    pairs = reconcile.tier_change_pairs(base, "1998-01-01", "2002-01-01")
    a, b = base.alias("a"), base.alias("b")
    cd, sd = F.col("a.canceled_at").cast("date"), F.col("b.start_date").cast("date")
    brute = a.join(b, (F.col("a.stripe_customer_id") == F.col("b.stripe_customer_id"))
                   & (F.col("a.stripe_subscription_id") != F.col("b.stripe_subscription_id"))
                   & (sd >= cd) & (sd <= F.date_add(cd, 1)) & (cd >= F.lit("1998-01-01").cast("date"))
                   & (cd <= F.lit("2002-01-01").cast("date")))
    assert pairs.count() == brute.count() > 0


def test_checks_fail_on_a_wrong_series(spark):
    subs = golden(spark)
    wrong = metric.mrr_monthly(subs, W0, W1).withColumn("mrr_amount", F.col("mrr_amount") * 3 + 12345)
    right, bad = checks.check_cancel_month(subs, W0, W1), checks.check_cancel_month(subs, W0, W1, wrong)
    assert all(r.prev_ok and r.cancel_ok for r in right.collect()) and right.count() == 4
    assert not any(r.prev_ok or r.cancel_ok for r in bad.collect())
    assert checks.check_tier_change(subs, W0, W1).where("v1_only_ok AND no_double_count").count() == 1
    assert checks.check_tier_change(subs, W0, W1, wrong).where("v1_only_ok").count() == 0
    assert checks.check_total_reconciles(subs, W0, W1).first().reconciles
    assert not checks.check_total_reconciles(subs, W0, W1, wrong).first().reconciles


def test_swept_totals_equal_the_series(spark):
    subs = golden(spark)
    swept = {r.month: round(r.total, 2) for r in reconcile.swept_totals(subs, W0, W1).collect()}
    filled = {r.month: round(r.mrr_amount, 2) for r in metric.mrr_monthly_filled(subs, W0, W1).collect()}
    assert swept == filled
