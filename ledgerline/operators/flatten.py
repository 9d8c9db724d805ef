"""Raw nested objects -> flat typed rows (P13-P21, F2, F8), as column expressions only.

Each transform returns the parsed rows with a ``reject_reason`` column: NULL for rows
that load, otherwise why the row is kept out (``not_json``, ``invalid_status``,
``bad_created``, ``missing_required``). ``accepted`` / ``rejected`` split on it, so a malformed object costs
one row, never the batch.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import columns as C

# Flat column order of the three tables and the bookmark table.
CUSTOMER_COLUMNS = [
    "stripe_customer_id", "email", "name", "created_at", "default_currency", "livemode",
    "test_clock_id", "metadata", "synced_at",
]
SUBSCRIPTION_COLUMNS = [
    "stripe_subscription_id", "stripe_customer_id", "status", "current_price_id", "unit_amount_cents", "currency",
    "interval", "interval_count", "billing_cycle_anchor", "current_period_start", "current_period_end", "start_date",
    "canceled_at", "ended_at", "created_at", "livemode", "idempotency_key", "metadata", "synced_at",
]
INVOICE_COLUMNS = [
    "stripe_invoice_id", "stripe_customer_id", "stripe_subscription_id", "period_start", "period_end", "status",
    "total_cents", "amount_paid_cents", "amount_due_cents", "currency", "paid_at", "created_at", "livemode",
    "metadata", "synced_at",
]
PRIMARY_KEYS = {"customers": "stripe_customer_id", "subscriptions": "stripe_subscription_id", "invoices": "stripe_invoice_id"}


def stamp(run_ts: dt.datetime | str) -> Column:
    """One constant run timestamp for every row of a run (replays reproduce it).

    Passed as ISO text and parsed by Spark in the session zone (UTC), so the value does
    not depend on the time zone of the driver process.
    """
    return ts_literal(run_ts)


def ts_literal(ts: dt.datetime | str) -> Column:
    text = ts.isoformat(sep=" ") if isinstance(ts, dt.datetime) else str(ts)
    return F.to_timestamp(F.lit(text))


def _reason(id_col: Column, created: Column, extra: Column | None = None, required: Column | None = None) -> Column:
    """Why a row does not load; ``required`` is a column that the table declares NOT NULL."""
    r = F.when(id_col.isNull(), F.lit("not_json"))
    if extra is not None:
        r = r.when(extra, F.lit("invalid_status"))
    r = r.when(created.isNull(), F.lit("bad_created"))
    return r if required is None else r.when(required.isNull(), F.lit("missing_required"))


def _carried(raw: DataFrame) -> list[Column]:
    """What the transform passes on beside the table's columns, where the listing has it."""
    return [F.col(c) for c in ("_order", "corrupt_line") if c in raw.columns]


def flatten_customers(raw: DataFrame, run_ts) -> DataFrame:
    """9-column customer rows plus ``reject_reason``."""
    created = C.epoch_to_ts("created")
    return raw.select(
        F.col("id").alias("stripe_customer_id"),
        "email",
        "name",
        created.alias("created_at"),
        F.col("default_source.currency").alias("default_currency"),
        F.coalesce("livemode", F.lit(False)).alias("livemode"),
        C.metadata_get("metadata", "test_clock_id").alias("test_clock_id"),
        C.metadata_json("metadata").alias("metadata"),
        stamp(run_ts).alias("synced_at"),
        _reason(F.col("id"), created).alias("reject_reason"),
        *_carried(raw),
    )


def flatten_subscriptions(raw: DataFrame, run_ts) -> DataFrame:
    """P20 + F2: 19-column subscription rows (first item's price inlined) plus ``reject_reason``."""
    created = C.epoch_to_ts("created")
    price = C.first_item_price("items")
    invalid = ~F.coalesce(F.col("status").isin(*C.VALID_STATUSES), F.lit(False))
    return raw.select(
        F.col("id").alias("stripe_subscription_id"),
        F.col("customer").alias("stripe_customer_id"),
        "status",
        price.getField("id").alias("current_price_id"),
        price.getField("unit_amount").alias("unit_amount_cents"),
        price.getField("currency").alias("currency"),
        price.getField("recurring").getField("interval").alias("interval"),
        price.getField("recurring").getField("interval_count").alias("interval_count"),
        C.epoch_to_ts("billing_cycle_anchor").alias("billing_cycle_anchor"),
        C.epoch_to_ts("current_period_start").alias("current_period_start"),
        C.epoch_to_ts("current_period_end").alias("current_period_end"),
        C.epoch_to_ts("start_date").alias("start_date"),
        C.epoch_to_ts("canceled_at").alias("canceled_at"),
        C.epoch_to_ts("ended_at").alias("ended_at"),
        created.alias("created_at"),
        F.coalesce("livemode", F.lit(False)).alias("livemode"),
        C.metadata_get("metadata", "idempotency_key").alias("idempotency_key"),
        C.metadata_json("metadata").alias("metadata"),
        stamp(run_ts).alias("synced_at"),
        _reason(F.col("id"), created, invalid, F.col("customer")).alias("reject_reason"),
        *_carried(raw),
    )


def flatten_invoices(raw: DataFrame, run_ts) -> DataFrame:
    """15-column invoice rows plus ``reject_reason``."""
    created = C.epoch_to_ts("created")
    return raw.select(
        F.col("id").alias("stripe_invoice_id"),
        F.col("customer").alias("stripe_customer_id"),
        F.col("subscription").alias("stripe_subscription_id"),
        C.epoch_to_ts("period_start").alias("period_start"),
        C.epoch_to_ts("period_end").alias("period_end"),
        "status",
        F.col("total").alias("total_cents"),
        F.col("amount_paid").alias("amount_paid_cents"),
        F.col("amount_due").alias("amount_due_cents"),
        "currency",
        C.epoch_to_ts("status_transitions.paid_at").alias("paid_at"),
        created.alias("created_at"),
        F.coalesce("livemode", F.lit(False)).alias("livemode"),
        C.metadata_json("metadata").alias("metadata"),
        stamp(run_ts).alias("synced_at"),
        _reason(F.col("id"), created, required=F.col("customer")).alias("reject_reason"),
        *_carried(raw),
    )


def accepted(flat: DataFrame) -> DataFrame:
    return flat.where(F.col("reject_reason").isNull()).drop("reject_reason", "corrupt_line")


def rejected(flat: DataFrame) -> DataFrame:
    return flat.where(F.col("reject_reason").isNotNull())


def reject_counts(flat: DataFrame, entity: str) -> DataFrame:
    """F8 side table: (entity, reason, rows)."""
    return rejected(flat).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(entity).alias("entity"), F.col("reject_reason").alias("reason"), "rows"
    )
