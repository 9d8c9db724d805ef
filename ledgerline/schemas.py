"""Flat table schemas (DDL text, usable before a session exists)."""

from __future__ import annotations

# Columns and types of the three entity tables and the bookmark table.
CUSTOMERS_DDL = (
    "stripe_customer_id STRING NOT NULL, email STRING, name STRING, created_at TIMESTAMP NOT NULL, "
    "default_currency STRING, livemode BOOLEAN NOT NULL, test_clock_id STRING, metadata STRING, "
    "synced_at TIMESTAMP NOT NULL"
)
SUBSCRIPTIONS_DDL = (
    "stripe_subscription_id STRING NOT NULL, stripe_customer_id STRING NOT NULL, status STRING NOT NULL, "
    "current_price_id STRING, unit_amount_cents BIGINT, currency STRING, `interval` STRING, interval_count BIGINT, "
    "billing_cycle_anchor TIMESTAMP, current_period_start TIMESTAMP, current_period_end TIMESTAMP, "
    "start_date TIMESTAMP, canceled_at TIMESTAMP, ended_at TIMESTAMP, created_at TIMESTAMP NOT NULL, "
    "livemode BOOLEAN NOT NULL, idempotency_key STRING, metadata STRING, synced_at TIMESTAMP NOT NULL"
)
INVOICES_DDL = (
    "stripe_invoice_id STRING NOT NULL, stripe_customer_id STRING NOT NULL, stripe_subscription_id STRING, "
    "period_start TIMESTAMP, period_end TIMESTAMP, status STRING, total_cents BIGINT, amount_paid_cents BIGINT, "
    "amount_due_cents BIGINT, currency STRING, paid_at TIMESTAMP, created_at TIMESTAMP NOT NULL, "
    "livemode BOOLEAN NOT NULL, metadata STRING, synced_at TIMESTAMP NOT NULL"
)
WATERMARK_TABLE = "_sync_watermarks"

TABLE_DDL = {"customers": CUSTOMERS_DDL, "subscriptions": SUBSCRIPTIONS_DDL, "invoices": INVOICES_DDL}

# What orders the versions of one object, all ascending (the first one is in force): the arrival,
# negated so that the latest comes first; the scope that listed it; a tie-break of the entity;
# a digest of the line.
VERSION_ORDER = {
    "arrival": "BIGINT", "scope_rank": "INT", "scope": "STRING", "tie_number": "BIGINT", "tie_amount": "BIGINT", "tie_text": "STRING",
    "digest": "BIGINT",
}

# Result of the metric and of the exported series.
MRR_RESULT_DDL = "month DATE, mrr_amount DECIMAL(38,9)"
SERIES_JSON_DDL = "month DATE, mrr_amount DECIMAL(38,9)"
