"""Billing tables derived from the supplied TPC-H-like parquet data.

The reference keeps three flat tables (customers, subscriptions, invoices). The test
data has no billing objects, so they are derived, deterministically and row for row,
from ``orders``, ``customer`` and ``lineitem``:

* one subscription per order; a canceled order ends when the customer's next order
  starts (cancel-and-recreate, the reference's tier-change shape);
* one customer per TPC-H customer;
* one invoice per line item (ids deliberately not unique: dedupe tests need that).

Every derived table grows with its base table; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.windows import lead_by_key
from ledgerline.sources.base import table

# Fixed values of the derivation (shared with the DuckDB oracle text in plans/oracle.py).
# status by o_orderkey % 8:
STATUS_BY_MOD8 = ["active", "canceled", "past_due", "trialing", "incomplete", "incomplete_expired", "unpaid", "canceled"]
# unit amount (cents) by o_orderkey % 3:
AMOUNT_BY_MOD3 = [5000, 10000, 25000]
# billing interval by the first character of o_orderpriority ('5' and anything else: NULL):
INTERVAL_BY_PRIORITY = {"1": "month", "2": "MONTH", "3": "year", "4": "week"}
# run stamp written as synced_at on derived flat rows
FIXTURE_SYNCED_AT = "2026-01-01 00:00:00"
# customer creation epoch: base + c_custkey minutes
CUSTOMER_EPOCH_BASE = 770000000


def _case(col, mapping: dict, default=None):
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == F.lit(k), F.lit(v)) if expr is None else expr.when(col == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default))


def subscriptions_from_orders(orders: DataFrame) -> DataFrame:
    """Flat ``subscriptions`` table (reference column names) from ``orders``."""
    k = F.col("o_orderkey")
    base = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    # next order of the same customer; a customer's orders are spread over (customer, day) groups
    with_next = lead_by_key(
        base, "o_custkey", ["o_orderdate", "o_orderkey"], "o_orderdate", "_next_start", bucket=F.to_date("o_orderdate")
    )
    status = _case(k % 8, dict(enumerate(STATUS_BY_MOD8)))
    amount = _case(k % 3, dict(enumerate(AMOUNT_BY_MOD3))).cast("bigint")
    interval = _case(F.substring("o_orderpriority", 1, 1), INTERVAL_BY_PRIORITY)
    canceled = F.when((k % 8).isin(1, 7), F.col("_next_start"))
    sub_id = F.concat(F.lit("sub_"), k.cast("string"))
    cus_id = F.concat(F.lit("cus_"), F.col("o_custkey").cast("string"))
    idem = F.concat(F.lit("seed-sub-"), cus_id, F.lit("-"), sub_id)
    return with_next.select(
        sub_id.alias("stripe_subscription_id"),
        cus_id.alias("stripe_customer_id"),
        status.alias("status"),
        F.concat(F.lit("price_"), (k % 3).cast("string")).alias("current_price_id"),
        amount.alias("unit_amount_cents"),
        F.lit("usd").alias("currency"),
        interval.alias("interval"),
        (F.lit(1) + k % 3).cast("bigint").alias("interval_count"),
        F.col("o_orderdate").alias("billing_cycle_anchor"),
        F.col("o_orderdate").alias("current_period_start"),
        F.col("o_orderdate").alias("current_period_end"),
        F.col("o_orderdate").alias("start_date"),
        canceled.alias("canceled_at"),
        canceled.alias("ended_at"),
        F.col("o_orderdate").alias("created_at"),
        F.lit(False).alias("livemode"),
        idem.alias("idempotency_key"),
        F.to_json(F.create_map(F.lit("idempotency_key"), idem)).alias("metadata"),
        F.to_timestamp_ntz(F.lit(FIXTURE_SYNCED_AT)).alias("synced_at"),
    )


def customers_from_customer(customer: DataFrame) -> DataFrame:
    """Flat ``customers`` table from ``customer``."""
    ck = F.col("c_custkey")
    clock = F.concat(F.lit("clock_"), F.floor(ck / 3).cast("bigint").cast("string"))
    created = F.timestamp_seconds(F.lit(CUSTOMER_EPOCH_BASE) + ck * 60).cast("timestamp_ntz")
    return customer.select(
        F.concat(F.lit("cus_"), ck.cast("string")).alias("stripe_customer_id"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.col("c_name").alias("name"),
        created.alias("created_at"),
        F.lit("usd").alias("default_currency"),
        (ck % 10 == 0).alias("livemode"),
        clock.alias("test_clock_id"),
        F.to_json(F.create_map(F.lit("test_clock_id"), clock)).alias("metadata"),
        F.to_timestamp_ntz(F.lit(FIXTURE_SYNCED_AT)).alias("synced_at"),
    )


def invoices_from_lineitem(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Flat ``invoices`` table: one invoice per line item, joined to its order for the customer."""
    li = lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_shipdate")
    o = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    j = li.join(o, "l_orderkey")
    total = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    status = _case(F.col("l_returnflag"), {"R": "void", "A": "paid"}, "open")
    paid = F.col("l_returnflag") == "A"
    return j.select(
        F.concat_ws("_", F.lit("in"), "l_orderkey", "l_linenumber", "l_partkey").alias("stripe_invoice_id"),
        F.concat(F.lit("cus_"), F.col("o_custkey").cast("string")).alias("stripe_customer_id"),
        F.when(F.col("l_linenumber") != 1, F.concat(F.lit("sub_"), F.col("l_orderkey").cast("string"))).alias(
            "stripe_subscription_id"
        ),
        F.col("l_shipdate").alias("period_start"),
        F.col("l_shipdate").alias("period_end"),
        status.alias("status"),
        total.alias("total_cents"),
        F.when(paid, total).otherwise(F.lit(0).cast("bigint")).alias("amount_paid_cents"),
        F.when(paid, F.lit(0).cast("bigint")).otherwise(total).alias("amount_due_cents"),
        F.lit("usd").alias("currency"),
        F.when(paid, F.col("l_shipdate")).alias("paid_at"),
        F.col("o_orderdate").alias("created_at"),
        F.lit(False).alias("livemode"),
        F.lit(None).cast("string").alias("metadata"),
        F.to_timestamp_ntz(F.lit(FIXTURE_SYNCED_AT)).alias("synced_at"),
    )


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subscriptions_from_orders(table(spark, sf_dir, "orders"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers_from_customer(table(spark, sf_dir, "customer"))


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return invoices_from_lineitem(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"))
