"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator key."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.functions import columns as C
from ledgerline.operators import bitmap, difference, flatten, joins, markers, metric, periods, reconcile
from ledgerline.operators import relational, sqlform
from ledgerline.operators import upsert as upsert_ops
from ledgerline.plans import checks, series, synth, sync
from ledgerline.plans.params import WINDOW_END, WINDOW_START
from ledgerline.session import checkpoint_dir, configure
from ledgerline.sinks import tables
from ledgerline.streaming import incremental
from ledgerline.sources import fixtures, raw
from ledgerline.sources.base import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run

    return deco


def _subs(spark, sf_dir):
    return fixtures.subscriptions(spark, sf_dir)


@register("mrr_monthly")
def q_mrr_monthly(spark, sf_dir):
    """G1 (flagship): strict MRR series over the window."""
    out = metric.mrr_monthly(_subs(spark, sf_dir), WINDOW_START, WINDOW_END)
    return out.select("month", C.to_cents_decimal("mrr_amount").alias("mrr_amount"))


def _money(c):
    return C.to_cents_decimal(c)


@register("mrr_monthly_filled")
def q_mrr_monthly_filled(spark, sf_dir):
    """Every month of the window, zero-filled."""
    out = metric.mrr_monthly_filled(_subs(spark, sf_dir), WINDOW_START, WINDOW_END)
    return out.select("month", _money("mrr_amount").alias("mrr_amount"))


@register("mrr_any_part_of_month")
def q_mrr_any_part(spark, sf_dir):
    """Retired 'alive any day of M' rule (regression guard, differs from G1)."""
    out = metric.mrr_any_part_of_month(_subs(spark, sf_dir), WINDOW_START, WINDOW_END)
    return out.select("month", _money("mrr_amount").alias("mrr_amount"))


@register("mrr_window_total")
def q_mrr_window_total(spark, sf_dir):
    """One total over all months x subscriptions."""
    out = metric.mrr_window_total(_subs(spark, sf_dir), WINDOW_START, WINDOW_END)
    return out.select(_money("window_total").alias("window_total"))


@register("mrr_active_pairs")
def q_mrr_active_pairs(spark, sf_dir):
    """Every (month, subscription) pair that contributes, with its amount."""
    out = metric.contributions(_subs(spark, sf_dir), WINDOW_START, WINDOW_END)
    return out.select("month", "stripe_subscription_id", _money("amount").alias("amount"))


@register("mrr_left_fill")
def q_mrr_left_fill(spark, sf_dir):
    """Months LEFT JOIN subscriptions on the rule; empty months kept with 0."""
    subs = _subs(spark, sf_dir)
    inner = metric.theta_pairs_per_month(subs, WINDOW_START, WINDOW_END)
    months = metric.month_series(spark, WINDOW_START, WINDOW_END).withColumnRenamed("month_start", "month")
    return months.join(inner, "month", "left").select(
        "month",
        F.coalesce("active_pairs", F.lit(0)).cast("bigint").alias("active_pairs"),
        _money(F.coalesce("mrr_amount", F.lit(0))).alias("mrr_amount"),
    )


@register("mrr_inner_theta")
def q_mrr_inner_theta(spark, sf_dir):
    """Inner months x subscriptions join per month (unsupported intervals add 0)."""
    out = metric.theta_pairs_per_month(_subs(spark, sf_dir), WINDOW_START, WINDOW_END)
    return out.select("month", F.col("active_pairs").cast("bigint").alias("active_pairs"),
                      _money("mrr_amount").alias("mrr_amount"))


@register("tier_change_pairs")
def q_tier_change_pairs(spark, sf_dir):
    """Cancel-and-recreate pairs (v1 starts on v0's cancel day or the next)."""
    out = reconcile.tier_change_pairs(_subs(spark, sf_dir), WINDOW_START, WINDOW_END)
    return out.select("stripe_customer_id", "v0_sub_id", "v1_sub_id", "v0_cancel_date", "v1_start_date")


@register("mrr_leave_one_out")
def q_mrr_leave_one_out(spark, sf_dir):
    """MRR of the month before and of the cancel month without each canceled subscription."""
    out = reconcile.leave_one_out(_subs(spark, sf_dir), WINDOW_START, WINDOW_END)
    return out.select("stripe_subscription_id", "month", _money("mrr_excluding").alias("mrr_excluding"))


@register("mrr_excluding_pair")
def q_mrr_excluding_pair(spark, sf_dir):
    """Transition-month MRR without both sides of each tier-change pair."""
    out = reconcile.excluding_pair(_subs(spark, sf_dir), WINDOW_START, WINDOW_END)
    return out.select("v0_sub_id", "v1_sub_id", "month", _money("mrr_excluding_pair").alias("mrr_excluding_pair"))


@register("check_cancel_month")
def q_check_cancel_month(spark, sf_dir):
    """Cancel-month verdicts for every canceled subscription in range."""
    out = checks.check_cancel_month(_subs(spark, sf_dir), WINDOW_START, WINDOW_END)
    return out.select("stripe_subscription_id", "cancel_month", _money("contribution").alias("contribution"),
                      "prev_ok", "cancel_ok")


@register("check_tier_change")
def q_check_tier_change(spark, sf_dir):
    """Transition-month verdicts for every tier-change pair."""
    return checks.check_tier_change(_subs(spark, sf_dir), WINDOW_START, WINDOW_END)


@register("check_total_reconciles")
def q_check_total_reconciles(spark, sf_dir):
    """Sum of the series equals the window total."""
    return checks.check_total_reconciles(_subs(spark, sf_dir), WINDOW_START, WINDOW_END)


# ---------------------------------------------------------------------------------------
# Raw objects and flatten
# ---------------------------------------------------------------------------------------

RUN_TS = "2026-01-01 00:00:00"


def _ntz(c):
    return F.col(c).cast("timestamp_ntz").alias(c)


#: Folders of exported objects, by session, data and entity: the supplied tables hold none, so
#: they are written once, and every query reads the files.
_EXPORTS: dict[tuple, str] = {}

_LISTED = {
    "customers": raw.customer_listing,
    "subscriptions": raw.subscription_listing,
    "invoices": raw.invoice_listing,
    "invoices by customer": lambda spark, sf_dir: raw.invoice_listing(spark, sf_dir, by_customer=True),
}


def _listing(spark, sf_dir, entity):
    """Lines of the exported objects of an entity, read from files."""
    key = (spark.sparkContext.applicationId, sf_dir, entity)
    if key not in _EXPORTS:
        root = f"{_scratch(spark, 'export').root}/{entity.replace(' ', '-')}"
        raw.write_listing(_LISTED[entity](spark, sf_dir), root)
        _EXPORTS[key] = root
    return raw.read_listing(spark, _EXPORTS[key])


def _loaded_subs(spark, sf_dir):
    return raw.load_subscriptions(_listing(spark, sf_dir, "subscriptions"))


def _loaded_customers(spark, sf_dir):
    return raw.load_customers(_listing(spark, sf_dir, "customers"))


def _loaded_invoices(spark, sf_dir):
    return raw.load_invoices(_listing(spark, sf_dir, "invoices"))


def _flat(df, columns):
    return df.select(*[_ntz(c) if c in TS_COLUMNS else F.col(c) for c in columns])


TS_COLUMNS = {
    "created_at", "synced_at", "billing_cycle_anchor", "current_period_start", "current_period_end", "start_date",
    "canceled_at", "ended_at", "period_start", "period_end", "paid_at",
}


@register("load_customers")
def q_load_customers(spark, sf_dir):
    """A1: raw customers as fetched (live mode skipped, one row per id, first listing wins)."""
    c = _loaded_customers(spark, sf_dir).where(F.col("id").isNotNull())
    return c.select("id", "email", "name", "created", "livemode")


@register("load_subscriptions")
def q_load_subscriptions(spark, sf_dir):
    """A2: raw subscriptions as fetched (all statuses, >= 1 item, live mode skipped, de-duplicated)."""
    s = _loaded_subs(spark, sf_dir).where(F.col("id").isNotNull())
    return s.select("id", "customer", "status", "created", F.size("items.data").cast("bigint").alias("n_items"))


@register("load_invoices")
def q_load_invoices(spark, sf_dir):
    """A3: raw invoices as fetched, de-duplicated by id."""
    i = _loaded_invoices(spark, sf_dir).where(F.col("id").isNotNull())
    return i.select("id", "customer", "subscription", "status", "total")


@register("scope_union")
def q_scope_union(spark, sf_dir):
    """A4: default listing union clock listings: winning scope and number of listings per customer id."""
    listed = raw.parse(_listing(spark, sf_dir, "customers"), raw.RAW_CUSTOMER).where(F.col("id").isNotNull())
    return listed.groupBy("id").agg(
        F.min_by("scope", F.struct("scope_rank", "scope")).alias("scope"),
        F.min_by("name", F.struct("scope_rank", "scope")).alias("name"),
        F.count(F.lit(1)).alias("listings"),
    )


@register("union_distinct_by_id")
def q_union_distinct_by_id(spark, sf_dir):
    """Ids of all three entities after the cross-listing de-duplication."""
    parts = [
        _loaded_customers(spark, sf_dir).select(F.lit("customers").alias("entity"), "id"),
        _loaded_subs(spark, sf_dir).select(F.lit("subscriptions").alias("entity"), "id"),
        _loaded_invoices(spark, sf_dir).select(F.lit("invoices").alias("entity"), "id"),
    ]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.where(F.col("id").isNotNull())


@register("epoch_to_ts")
def q_epoch_to_ts(spark, sf_dir):
    """Created (epoch number, ISO text or junk) -> timestamp or NULL."""
    s = _loaded_subs(spark, sf_dir).where(F.col("id").isNotNull())
    return s.select("id", F.col("created").alias("created_raw"),
                    C.epoch_to_ts("created").cast("timestamp_ntz").alias("created_at"))


@register("flatten_price")
def q_flatten_price(spark, sf_dir):
    """First item's price fields; any missing level gives NULL."""
    s = _loaded_subs(spark, sf_dir).where(F.col("id").isNotNull())
    p = C.first_item_price("items")
    return s.select(
        "id",
        p.getField("id").alias("current_price_id"),
        p.getField("unit_amount").alias("unit_amount_cents"),
        p.getField("currency").alias("currency"),
        p.getField("recurring").getField("interval").alias("bill_interval"),
        p.getField("recurring").getField("interval_count").alias("interval_count"),
    )


@register("metadata_json")
def q_metadata_json(spark, sf_dir):
    """Metadata map as JSON text; absent -> NULL."""
    s = _loaded_subs(spark, sf_dir).where(F.col("id").isNotNull())
    return s.select("id", C.metadata_json("metadata").alias("metadata"))


@register("metadata_get")
def q_metadata_get(spark, sf_dir):
    """Key lookup in JSON text (events.props, key k)."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", C.json_get("props", "k").alias("k"))


@register("nested_field")
def q_nested_field(spark, sf_dir):
    """default_source.currency with a NULL parent struct."""
    c = _loaded_customers(spark, sf_dir).where(F.col("id").isNotNull())
    return c.select(F.col("id").alias("stripe_customer_id"), F.col("default_source.currency").alias("default_currency"))


@register("stamp_synced_at")
def q_stamp_synced_at(spark, sf_dir):
    """One run timestamp on every row."""
    c = flatten.accepted(flatten.flatten_customers(_loaded_customers(spark, sf_dir), RUN_TS))
    return c.select("stripe_customer_id", _ntz("synced_at"))


@register("flatten_customer")
def q_flatten_customer(spark, sf_dir):
    """Whole customer rows."""
    c = flatten.accepted(flatten.flatten_customers(_loaded_customers(spark, sf_dir), RUN_TS))
    return _flat(c, flatten.CUSTOMER_COLUMNS)


@register("flatten_subscription")
def q_flatten_subscription(spark, sf_dir):
    """P20: whole subscription rows (unknown statuses and bad created skipped)."""
    s = flatten.accepted(flatten.flatten_subscriptions(_loaded_subs(spark, sf_dir), RUN_TS))
    return _flat(s, flatten.SUBSCRIPTION_COLUMNS).withColumnRenamed("interval", "bill_interval")


@register("flatten_invoice")
def q_flatten_invoice(spark, sf_dir):
    """Whole invoice rows."""
    i = flatten.accepted(flatten.flatten_invoices(_loaded_invoices(spark, sf_dir), RUN_TS))
    return _flat(i, flatten.INVOICE_COLUMNS)


@register("valid_status")
def q_valid_status(spark, sf_dir):
    """admitted vs skipped statuses among loaded subscriptions."""
    s = _loaded_subs(spark, sf_dir).where(F.col("id").isNotNull())
    return s.groupBy("status").agg(F.count(F.lit(1)).alias("rows")).select(
        "status", F.col("status").isin(*C.VALID_STATUSES).alias("admitted"), "rows"
    )


@register("skip_livemode")
def q_skip_livemode(spark, sf_dir):
    """test-mode customers only."""
    c = raw.skip_livemode(fixtures.customers(spark, sf_dir))
    return c.select("stripe_customer_id")


@register("skip_no_items")
def q_skip_no_items(spark, sf_dir):
    """subscriptions dropped at load because they carry no item."""
    p = raw.skip_livemode(raw.parse(_listing(spark, sf_dir, "subscriptions"), raw.RAW_SUBSCRIPTION))
    empty = p.where(F.col("id").isNotNull() & (F.coalesce(F.size("items.data"), F.lit(0)) == 0))
    return empty.select("id").distinct()


@register("skip_malformed")
def q_skip_malformed(spark, sf_dir):
    """F8: rejected rows per entity and reason."""
    parts = [
        flatten.reject_counts(flatten.flatten_customers(_loaded_customers(spark, sf_dir), RUN_TS), "customers"),
        flatten.reject_counts(flatten.flatten_subscriptions(_loaded_subs(spark, sf_dir), RUN_TS), "subscriptions"),
        flatten.reject_counts(flatten.flatten_invoices(_loaded_invoices(spark, sf_dir), RUN_TS), "invoices"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("invoices_of_known_customers")
def q_invoices_of_known_customers(spark, sf_dir):
    """The default listing's invoices whoever their customer is, and of the listings by
    customer those of collected customers (left semi join on lines)."""
    listing = raw.of_known_customers(_listing(spark, sf_dir, "invoices by customer"), _accepted_customers(spark, sf_dir), "stripe_customer_id")
    inv = flatten.accepted(flatten.flatten_invoices(raw.load_invoices(listing), RUN_TS))
    return inv.select("stripe_invoice_id", "stripe_customer_id")


# ---------------------------------------------------------------------------------------
# Tables: staging, upsert, counts, sync, bookmarks, incremental load
# ---------------------------------------------------------------------------------------


def _batches(spark, sf_dir):
    """Two loads that cover the derived subscriptions together and overlap.

    First load: ids that are not 2 modulo 3. Second load: ids not divisible by 3, with a
    price 100 cents higher and, where the id is even, a creation time 40 days later, which
    moves it to another month (1 modulo 3: in both, update; 2 modulo 3: insert).
    """
    subs = _subs(spark, sf_dir)
    n = raw.numeric_id(F.col("stripe_subscription_id"))
    later = F.when(n % 2 == 0, F.col("created_at") + F.expr("INTERVAL 40 DAYS")).otherwise(F.col("created_at"))
    first = subs.where(n % 3 != 2)
    second = subs.where(n % 3 != 0).withColumns(
        {"unit_amount_cents": F.col("unit_amount_cents") + 100, "created_at": later}
    )
    return first, second


def _merged(spark, sf_dir, tag):
    """The two loads through the table path: warehouse and the counts of both."""
    wh = _scratch(spark, tag)
    tables.ensure_tables(spark, wh)
    counts = [
        tables.upsert(spark, wh, "subscriptions", _with_zone(load), "stripe_subscription_id")
        for load in _batches(spark, sf_dir)
    ]
    return wh, counts


def _with_zone(df):
    return df.select(*[F.col(c).cast("timestamp").alias(c) if t.startswith("timestamp") else F.col(c) for c, t in df.dtypes])


def _scratch(spark, tag: str) -> tables.Warehouse:
    import uuid

    root = f"{checkpoint_dir(spark).rstrip('/')}/ledgerline-scratch/{tag}-{uuid.uuid4().hex[:10]}"
    return tables.Warehouse(f"ll_{tag}_{uuid.uuid4().hex[:8]}", root)


@register("staged_append")
def q_staged_append(spark, sf_dir):
    """A partial batch staged in the full subscriptions schema (missing columns NULL), after
    the check that its keys are unique and its required columns filled."""
    wh = _scratch(spark, "stage")
    tables.ensure_tables(spark, wh)
    subs = _with_zone(_subs(spark, sf_dir)).select(
        "stripe_subscription_id", "stripe_customer_id", "status", "unit_amount_cents", "created_at", "livemode", "synced_at")
    path = tables.stage_source(spark, wh, "subscriptions", subs, tables.stage_root(spark, "subscriptions", wh.database))
    out = spark.read.parquet(path)
    tables.validate_source(out, "subscriptions", "stripe_subscription_id")
    return out.select("stripe_subscription_id", "status", "unit_amount_cents", "current_price_id",
                      _ntz("created_at"), _ntz("ended_at"))


@register("upsert_by_key")
def q_upsert_by_key(spark, sf_dir):
    """Table content after merging the second load into the first, by key."""
    wh, _ = _merged(spark, sf_dir, "upsert")
    out = spark.table(wh.table("subscriptions"))
    return out.select("stripe_subscription_id", "status", "unit_amount_cents", "created_month")


@register("upsert_counts")
def q_upsert_counts(spark, sf_dir):
    """Inserted / updated counts that the two upserts report."""
    _, counts = _merged(spark, sf_dir, "counts")
    rows = [(i + 1, c["inserted"], c["updated"]) for i, c in enumerate(counts)]
    return spark.createDataFrame(rows, "load int, inserted bigint, updated bigint")


@register("upsert_match")
def q_upsert_match(spark, sf_dir):
    """Key match between target and source: matched / source_only / target_only."""
    first, second = _batches(spark, sf_dir)
    return upsert_ops.match_sides(first, second, "stripe_subscription_id")


def _listings(spark, sf_dir):
    return {entity: _listing(spark, sf_dir, entity) for entity in sync.ENTITY_ORDER}


@register("dry_run")
def q_dry_run(spark, sf_dir):
    """Fetched and rejected counts of a sync that writes nothing."""
    wh = _scratch(spark, "dry")
    summary = sync.sync(spark, wh, _listings(spark, sf_dir), dt.datetime.fromisoformat(RUN_TS), dry_run=True)
    return summary.select("entity", "fetched", "inserted", "updated", "rejected")


@register("sync_summary")
def q_sync_summary(spark, sf_dir):
    """G16 (with B1, B2, B6, B4, B7): full-refresh sync into fresh tables, per-entity summary."""
    wh = _scratch(spark, "sync")
    summary = sync.sync(spark, wh, _listings(spark, sf_dir), dt.datetime.fromisoformat(RUN_TS), full_refresh=True)
    return summary.select("entity", "fetched", "inserted", "updated", "rejected", "errors")


@register("watermark_read")
def q_watermark_read(spark, sf_dir):
    """A9 (after B7): the bookmarks a completed sync left, read back per key, and the rows of the
    entity's table that carry the time of its bookmark."""
    wh = _scratch(spark, "wm")
    listings = {"customers": _listing(spark, sf_dir, "customers")}
    sync.sync(spark, wh, listings, dt.datetime.fromisoformat(RUN_TS))
    marks = tables.watermarks(spark, wh, ["customers", "invoices"])
    stamped = [
        spark.table(wh.table(entity)).groupBy("synced_at").agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(entity).alias("entity"), "synced_at", "n")
        for entity in ("customers", "invoices")
    ]
    rows = stamped[0].unionByName(stamped[1])
    of_mark = (F.col("entity") == F.col("sync_key")) & (F.col("synced_at") == F.col("last_synced_at"))
    return marks.join(rows, of_mark, "left").select(
        "sync_key", _ntz("last_synced_at"), F.coalesce("n", F.lit(0)).cast("bigint").alias("rows_synced"))


@register("incremental_upsert")
def q_incremental_upsert(spark, sf_dir):
    """Two arrivals of raw subscriptions streamed in out of order (availableNow) plus an empty re-run."""
    wh = _scratch(spark, "inc")
    raw_root = f"{wh.root}/raw/subscriptions"
    listing = _listing(spark, sf_dir, "subscriptions")
    n = raw.numeric_id(F.get_json_object("value", "$.id"))
    first = listing.where(n.isNull() | (n % 3 != 2))
    # second arrival: ids not divisible by 3 with a changed price (text edit of the JSON line)
    second = listing.where(n % 3 != 0).withColumn(
        "value", F.regexp_replace("value", r'"unit_amount":(\d+)', '"unit_amount":1$1')
    )
    # the later arrival is drained first and must stay in force when the earlier one comes
    incremental.write_arrival(second, raw_root, 2)
    incremental.incremental_upsert(spark, wh, "subscriptions", raw_root)
    incremental.write_arrival(first, raw_root, 1)
    incremental.incremental_upsert(spark, wh, "subscriptions", raw_root)
    incremental.incremental_upsert(spark, wh, "subscriptions", raw_root)
    return spark.table(wh.table("subscriptions")).select("stripe_subscription_id", "status", "unit_amount_cents")


@register("check_resync_idempotent")
def q_check_resync_idempotent(spark, sf_dir):
    """C4: the subscriptions of each customer, whole rows but for the time of the sync, are unchanged
    by a second sync of the same objects."""
    wh = _scratch(spark, "resync")
    listings = {"subscriptions": _listing(spark, sf_dir, "subscriptions")}
    first = dt.datetime.fromisoformat(RUN_TS)
    sync.sync(spark, wh, listings, first, full_refresh=True)
    # a version's table keeps its rows while the table moves on
    columns = [c for c in tables.schema_columns("subscriptions") if c != "synced_at"]
    row = F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])

    def per_customer(df, side):
        return df.groupBy("stripe_customer_id").agg(
            F.count(F.lit(1)).alias(f"subs_{side}"), F.bit_xor(row).alias(f"rows_{side}"))

    before = per_customer(spark.table(tables.attach(spark, wh, "subscriptions")), "before")
    sync.sync(spark, wh, listings, first + dt.timedelta(days=1))  # a run of its own, not a replay
    after = per_customer(spark.table(wh.table("subscriptions")), "after")
    same = (F.col("subs_before") == F.col("subs_after")) & (F.col("rows_before") == F.col("rows_after"))
    return before.join(after, "stripe_customer_id", "full_outer").select(
        "stripe_customer_id", "subs_before", "subs_after",
        F.coalesce(same, F.lit(False)).alias("unchanged"),
    )


# ---------------------------------------------------------------------------------------
# Scans and scalar projections
# ---------------------------------------------------------------------------------------


@register("scan_subscriptions")
def q_scan_subscriptions(spark, sf_dir):
    """A5 (+F1): the six-column projection the metric scans, never-activated statuses removed."""
    out = metric.active_subscriptions(_subs(spark, sf_dir))
    return out.select("stripe_subscription_id", "sub_start_date", "sub_canceled_date", "status",
                      "unit_amount_cents", "interval_type", "interval_count")


@register("dataset_param")
def q_dataset_param(spark, sf_dir):
    """The metric as SQL over a table name passed as a parameter (IDENTIFIER(:tbl))."""
    import uuid

    view = f"ll_subscriptions_{uuid.uuid4().hex[:8]}"
    _subs(spark, sf_dir).createOrReplaceTempView(view)
    out = sqlform.mrr_monthly_sql(spark, view, WINDOW_START, WINDOW_END)
    return out.select("month", _money("mrr_amount").alias("mrr_amount"))


@register("month_series")
def q_month_series(spark, sf_dir):
    """First-of-month dates from the first to the last month in which a subscription starts."""
    start = C.month_floor(C.ts_to_date("start_date"))
    bounds = _subs(spark, sf_dir).agg(F.min(start).alias("lo"), F.max(start).alias("hi"))
    return bounds.select(F.explode(F.expr("sequence(lo, hi, INTERVAL 1 MONTH)")).alias("month_start"))


@register("unnest_literal_dates")
def q_unnest_literal_dates(spark, sf_dir):
    """A two-date array (previous month, cancel month) to rows, per canceled subscription."""
    c = relational.canceled_in_range(_subs(spark, sf_dir), "0001-01-01", "9999-12-31")
    cm = C.month_floor(C.nullable_ts_to_date("canceled_at"))
    return c.select("stripe_subscription_id", F.explode(F.array(C.prev_month(cm), cm)).alias("month_start"))


@register("table_schema")
def q_table_schema(spark, sf_dir):
    """Columns of the loaded subscriptions table as the catalog has them, with non-null counts."""
    wh = _scratch(spark, "schema")
    tables.ensure_tables(spark, wh)
    tables.upsert(spark, wh, "subscriptions", _with_zone(_subs(spark, sf_dir)), "stripe_subscription_id")
    fields = [f for f in tables.table_schema(spark, wh, "subscriptions").fields if f.name != tables.PARTITION_COLUMN]
    counts = spark.table(wh.table("subscriptions")).agg(*[F.count(f.name).alias(f.name) for f in fields])
    rows = F.array(*[
        F.struct(F.lit(i).alias("ordinal"), F.lit(f.name).alias("column_name"),
                 F.lit(f.dataType.simpleString()).alias("data_type"), F.col(f.name).alias("non_null"))
        for i, f in enumerate(fields)
    ])
    return counts.select(F.inline(rows))


def _projection(spark, sf_dir, *cols):
    return _subs(spark, sf_dir).select("stripe_subscription_id", *cols)


@register("ts_to_date")
def q_ts_to_date(spark, sf_dir):
    """UTC date of the start instant."""
    return _projection(spark, sf_dir, C.ts_to_date("start_date").alias("sub_start_date"))


@register("nullable_ts_to_date")
def q_nullable_ts_to_date(spark, sf_dir):
    """UTC date of the cancel instant, NULL kept."""
    return _projection(spark, sf_dir, C.nullable_ts_to_date("canceled_at").alias("sub_canceled_date"))


@register("lower_interval")
def q_lower_interval(spark, sf_dir):
    """Case-folded billing interval."""
    return _projection(spark, sf_dir, C.lower_interval("interval").alias("interval_type"))


@register("normalize_monthly")
def q_normalize_monthly(spark, sf_dir):
    """Monthly dollars (NULL for day/week/unknown intervals)."""
    amt = C.normalize_monthly("unit_amount_cents", "interval", "interval_count")
    return _projection(spark, sf_dir, _money(amt).alias("monthly_amount"))


@register("last_day")
def q_last_day(spark, sf_dir):
    """P5: last day of the start month."""
    return _projection(spark, sf_dir, C.last_day(C.ts_to_date("start_date")).alias("month_end"))


@register("coalesce_zero")
def q_coalesce_zero(spark, sf_dir):
    """Monthly amount with NULL -> 0."""
    amt = C.coalesce_zero(C.normalize_monthly("unit_amount_cents", "interval", "interval_count"))
    return _projection(spark, sf_dir, _money(amt).alias("monthly_amount"))


@register("cast_numeric")
def q_cast_numeric(spark, sf_dir):
    """Monthly amount (double) as NUMERIC(38,9)."""
    amt = C.normalize_monthly("unit_amount_cents", "interval", "interval_count")
    return _projection(spark, sf_dir, C.cast_numeric(amt).alias("monthly_numeric"))


@register("round_cents")
def q_round_cents(spark, sf_dir):
    """ROUND(amount, 2) as a double."""
    amt = C.normalize_monthly("unit_amount_cents", "interval", "interval_count")
    return _projection(spark, sf_dir, C.round_cents(amt).alias("monthly_rounded"))


@register("date_add_day")
def q_date_add_day(spark, sf_dir):
    """The day after the cancel date."""
    return _projection(spark, sf_dir, C.date_add_day(C.nullable_ts_to_date("canceled_at")).alias("day_after_cancel"))


@register("month_floor")
def q_month_floor(spark, sf_dir):
    """P10: first of the start month."""
    return _projection(spark, sf_dir, C.month_floor(C.ts_to_date("start_date")).alias("start_month"))


@register("prev_month")
def q_prev_month(spark, sf_dir):
    """The month before the cancel month (January rolls to December)."""
    return _projection(spark, sf_dir, C.prev_month(C.nullable_ts_to_date("canceled_at")).alias("month_before_cancel"))


@register("cast_int")
def q_cast_int(spark, sf_dir):
    """Cents as INT64."""
    return _projection(spark, sf_dir, C.cast_int("unit_amount_cents").alias("cents"))


def _plans(spark, sf_dir):
    return synth.plans_for_customers(table(spark, sf_dir, "customer"))


def _indexed_customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").select((F.col("c_custkey") - 1).alias("cust_idx"), "c_name")


def _tiers(spark, sf_dir):
    """Each derived subscription with the tier its price id names."""
    tiers = F.array(*[F.lit(t) for t in relational.TIER_ORDER])
    position = (raw.numeric_id(F.col("current_price_id")) + 1).cast("int")
    return _subs(spark, sf_dir).select("stripe_subscription_id", F.element_at(tiers, position).alias("tier"))


@register("format_id")
def q_format_id(spark, sf_dir):
    """P25: zero-padded seed e-mails, names and idempotency keys of every customer."""
    p = _indexed_customers(spark, sf_dir)
    cus = F.concat(F.lit("cus_seed_"), F.col("cust_idx").cast("string"))
    return p.select("cust_idx", C.seed_email("cust_idx").alias("email"), C.seed_name("cust_idx").alias("name"),
                    C.seed_idempotency_key(cus, 0).alias("idempotency_key"))


@register("batch_index")
def q_batch_index(spark, sf_dir):
    """Batch of three per customer index, and the ceil-div number of batches.

    The total is a scalar subquery, not a window over all rows, so no task ever holds
    every customer and nothing runs while the query is built.
    """
    p = _indexed_customers(spark, sf_dir)
    total = p.agg(F.count(F.lit(1))).scalar()
    return p.select("cust_idx", C.batch_index("cust_idx").alias("batch"), C.batch_count(total).alias("batches"))


# ---------------------------------------------------------------------------------------
# Filters, joins, aggregates, ordering, set operations
# ---------------------------------------------------------------------------------------


@register("ever_activated")
def q_ever_activated(spark, sf_dir):
    """never-activated statuses removed (NULL status dropped, as SQL NOT IN does)."""
    s = _subs(spark, sf_dir)
    return s.where(~F.col("status").isin(*C.NEVER_ACTIVATED)).select("stripe_subscription_id", "status")


@register("start_boundary")
def q_start_boundary(spark, sf_dir):
    """per month of the window, activated subscriptions started on or before its last day."""
    s = _subs(spark, sf_dir).where(~F.col("status").isin(*C.NEVER_ACTIVATED)).where(F.col("start_date").isNotNull())
    sd = C.ts_to_date("start_date")
    first = F.greatest(C.month_floor(sd), F.lit(WINDOW_START).cast("date"))
    per_month = s.groupBy(first.alias("month_start")).agg(F.count(F.lit(1)).alias("n"))
    return _running(spark, per_month, "started")


def _running(spark, per_month, name):
    """Running total over the window's months (one row per month: a bounded, single-partition window)."""
    months = metric.month_series(spark, WINDOW_START, WINDOW_END)
    w = Window.orderBy("month_start").rowsBetween(Window.unboundedPreceding, 0)
    return months.join(per_month, "month_start", "left").fillna(0, ["n"]).select(
        "month_start", F.sum("n").over(w).cast("bigint").alias(name))


@register("cancel_boundary")
def q_cancel_boundary(spark, sf_dir):
    """per month, activated subscriptions canceled on or before its last day (cumulative)."""
    s = _subs(spark, sf_dir).where(~F.col("status").isin(*C.NEVER_ACTIVATED)).where(F.col("canceled_at").isNotNull())
    first = F.greatest(C.month_floor(C.nullable_ts_to_date("canceled_at")), F.lit(WINDOW_START).cast("date"))
    per_month = s.groupBy(first.alias("month_start")).agg(F.count(F.lit(1)).alias("n"))
    return _running(spark, per_month, "canceled")


@register("supported_interval")
def q_supported_interval(spark, sf_dir):
    """subscriptions whose monthly amount is defined (month/year intervals)."""
    amt = C.normalize_monthly("unit_amount_cents", "interval", "interval_count")
    return _subs(spark, sf_dir).where(amt.isNotNull()).select("stripe_subscription_id", C.lower_interval("interval").alias("interval_type"))


@register("canceled_in_range")
def q_canceled_in_range(spark, sf_dir):
    """canceled with a cancel date in [window start + 1 month, window end)."""
    s = relational.canceled_in_range(_subs(spark, sf_dir), "1994-11-01", WINDOW_END)
    return s.select("stripe_subscription_id", C.nullable_ts_to_date("canceled_at").alias("cancel_date"))


@register("exclude_ids")
def q_exclude_ids(spark, sf_dir):
    """subscriptions outside every tier-change pair (anti join on a data-sized id set)."""
    subs = _subs(spark, sf_dir)
    pairs = reconcile.tier_change_pairs(subs, WINDOW_START, WINDOW_END)
    ids = pairs.select(F.explode(F.array("v0_sub_id", "v1_sub_id")).alias("id"))
    return relational.exclude_ids(subs, "stripe_subscription_id", ids).select("stripe_subscription_id")


@register("name_pattern")
def q_name_pattern(spark, sf_dir):
    """seed customers by e-mail marker and seed clocks by name, among all customers.

    Every fifth customer has a seed e-mail, every seventh a smoke-test one; clocks take
    their names from a rule on the key, one of them the exact smoke name.
    """
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    plain = F.concat(F.lower("c_name"), F.lit("@example.com"))
    email = F.when(k % 5 == 0, C.seed_email(k - 1)).when(k % 7 == 0, F.concat(F.lit("smoke-test-"), plain)).otherwise(plain)
    n = k.cast("string")
    clock = (
        F.when(k % 11 == 0, F.concat(F.lit("mrr-seed-clock-"), n)).when(k % 13 == 0, F.concat(F.lit("mrr-smoke-clock-"), n))
        .when(k == 17, F.lit("mrr-seed-smoke-clock")).otherwise(F.concat(F.lit("old-mrr-seed-clock-"), n))
    )
    people = relational.seed_customers(c.select(email.alias("email"))).select(F.lit("customer").alias("kind"), F.col("email").alias("name"))
    clocks = relational.seed_clocks(c.select(clock.alias("name"))).select(F.lit("clock").alias("kind"), "name")
    return people.unionByName(clocks)


@register("metadata_predicate")
def q_metadata_predicate(spark, sf_dir):
    """events whose props k = '7' and whose type is 'purchase'."""
    ev = table(spark, sf_dir, "events")
    out = relational.metadata_predicate(ev, "props", "k", "7", F.col("event_type") == "purchase")
    return out.select("event_id", "user_id")


@register("price_catalog_filter")
def q_price_catalog_filter(spark, sf_dir):
    """first matching price per tier on the seed product."""
    t = relational.tier_prices(relational.price_catalog(spark, sf_dir))
    return t.select("tier", "price_id", "unit_amount", "candidates")


@register("sensitive_token_scan")
def q_sensitive_token_scan(spark, sf_dir):
    """documents containing any credential marker (whole texts)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = relational.sensitive_token_scan(docs, "text")
    return out.select("doc_id", F.array_join("markers", ",").alias("markers"))


@register("new_customers_only")
def q_new_customers_only(spark, sf_dir):
    """Candidate customers whose e-mail does not exist yet (existing = even clocks)."""
    c = fixtures.customers(spark, sf_dir)
    clock_no = raw.numeric_id(F.col("test_clock_id"))
    existing = c.where(clock_no % 2 == 0).select("email")
    return joins.new_only(c.select("stripe_customer_id", "email"), existing, "email").select("stripe_customer_id", "email")


@register("tier_price_lookup")
def q_tier_price_lookup(spark, sf_dir):
    """Tier of a subscription -> monthly price, through the three-row tier dimension."""
    return joins.lookup_dimension(_tiers(spark, sf_dir), relational.tier_dimension(spark), "tier")


@register("status_count_and_sum")
def q_status_count_and_sum(spark, sf_dir):
    """COUNT(*) and SUM(cents) per status."""
    return relational.status_count_and_sum(_subs(spark, sf_dir))


@register("distinct_customers")
def q_distinct_customers(spark, sf_dir):
    """Exact distinct customers."""
    return relational.distinct_customers(_subs(spark, sf_dir))


@register("multi_sub_customers")
def q_multi_sub_customers(spark, sf_dir):
    """Customers with two or more subscriptions."""
    return relational.multi_sub_customers(_subs(spark, sf_dir))


@register("customer_sub_count")
def q_customer_sub_count(spark, sf_dir):
    """Subscriptions per customer."""
    return relational.customer_sub_count(_subs(spark, sf_dir))


@register("table_row_counts")
def q_table_row_counts(spark, sf_dir):
    """Rows per derived table."""
    return relational.table_row_counts({
        "customers": fixtures.customers(spark, sf_dir),
        "subscriptions": _subs(spark, sf_dir),
        "invoices": fixtures.invoices(spark, sf_dir),
    })


@register("status_distribution")
def q_status_distribution(spark, sf_dir):
    """G11 (+P27): subscriptions per status, floor percentages, inside the bands (null: a status without one)."""
    return synth.status_distribution(_subs(spark, sf_dir)).withColumnRenamed("customers", "subscriptions")


@register("distinct_start_months")
def q_distinct_start_months(spark, sf_dir):
    """Distinct months in which a subscription starts."""
    return synth.distinct_start_months(
        _subs(spark, sf_dir).select(C.month_floor(C.ts_to_date("start_date")).alias("start_month")))


@register("tier_change_rate")
def q_tier_change_rate(spark, sf_dir):
    """Subscriptions with a tier change / eligible ones, and the 20-35 % band."""
    subs = _subs(spark, sf_dir)
    changed = reconcile.tier_change_pairs(subs, WINDOW_START, WINDOW_END).groupBy("v0_sub_id").agg(
        F.min(C.month_floor("v0_cancel_date")).alias("tier_change_month"))
    return synth.tier_change_rate(
        subs.select("stripe_subscription_id", "status")
        .join(changed.withColumnRenamed("v0_sub_id", "stripe_subscription_id"), "stripe_subscription_id", "left"))


@register("price_resolution_count")
def q_price_resolution_count(spark, sf_dir):
    """Three tiers resolved to three distinct prices."""
    return relational.price_resolution_count(relational.price_catalog(spark, sf_dir))


@register("order_by_month")
def q_order_by_month(spark, sf_dir):
    """O1: the strict series in month order, with its ordinal."""
    out = metric.mrr_monthly(_subs(spark, sf_dir), WINDOW_START, WINDOW_END)
    out = relational.with_ordinal(out.select("month", _money("mrr_amount").alias("mrr_amount")), "month")
    return out.withColumn("ordinal", F.col("ordinal").cast("bigint"))


@register("first_by_key")
def q_first_by_key(spark, sf_dir):
    """O2: the first canceled-in-range subscription by id (string order)."""
    s = relational.canceled_in_range(_subs(spark, sf_dir), "1994-11-01", WINDOW_END)
    return relational.first_by(s.select("stripe_subscription_id"), "stripe_subscription_id")


@register("limit_one")
def q_limit_one(spark, sf_dir):
    """O3: one customer with two or more subscriptions (ordered, so deterministic)."""
    per = relational.customer_sub_count(_subs(spark, sf_dir)).where(F.col("subscriptions") >= 2)
    return relational.first_by(per, "stripe_customer_id")


@register("row_limit")
def q_row_limit(spark, sf_dir):
    """The per-entity row cap of the sync (first 1000 subscription ids)."""
    return relational.row_limit(_subs(spark, sf_dir).select("stripe_subscription_id"), "stripe_subscription_id", 1000)


@register("monotone_months")
def q_monotone_months(spark, sf_dir):
    """The filled series is one ascending contiguous run of months with the window end-points."""
    out = metric.mrr_monthly_filled(_subs(spark, sf_dir), WINDOW_START, WINDOW_END)
    return relational.monotone_months(out)


@register("other_tiers")
def q_other_tiers(spark, sf_dir):
    """The two tiers a subscription could change to."""
    p = relational.other_tiers(_tiers(spark, sf_dir), "tier")
    return p.select("stripe_subscription_id", F.array_join("other_tiers", ",").alias("other_tiers"))


# ---------------------------------------------------------------------------------------
# Generator (D1, D2, C5) and series export
# ---------------------------------------------------------------------------------------

SEED_T0 = dt.datetime(2025, 11, 3)


@register("lifecycle_plan")
def q_lifecycle_plan(spark, sf_dir):
    """One lifecycle plan per supplied customer."""
    p = _plans(spark, sf_dir).drop("email", "name")
    return p.select(*[F.col(c).cast("bigint").alias(c) if c.endswith("_month") else F.col(c) for c in p.columns])


@register("lifecycle_to_subscriptions")
def q_lifecycle_to_subscriptions(spark, sf_dir):
    """The subscription rows the plans produce."""
    s = synth.lifecycle_to_subscriptions(_plans(spark, sf_dir), SEED_T0)
    return s.select("stripe_subscription_id", "stripe_customer_id", "status", "unit_amount_cents",
                    _ntz("start_date"), _ntz("canceled_at"))


@register("lifecycle_mrr")
def q_lifecycle_mrr(spark, sf_dir):
    """D2 -> G1: the metric over generated lifecycles, seed window Nov 2025 .. May 2026."""
    s = synth.lifecycle_to_subscriptions(_plans(spark, sf_dir), SEED_T0)
    out = metric.mrr_monthly_filled(s, "2025-11-01", "2026-05-01")
    return out.select("month", _money("mrr_amount").alias("mrr_amount"))


@register("check_plan_invariants")
def q_check_plan_invariants(spark, sf_dir):
    """Invariant violation counts over all plans."""
    return synth.check_plan_invariants(_plans(spark, sf_dir))


def _filled_series(spark, sf_dir):
    out = metric.mrr_monthly_filled(_subs(spark, sf_dir), WINDOW_START, WINDOW_END)
    return out.select("month", F.col("mrr_amount").cast("decimal(18,2)").alias("mrr_amount"))


@register("json_series_write")
def q_json_series_write(spark, sf_dir):
    """The series as one JSON document; points, end-points and the sum of amounts parsed back from the text."""
    doc = series.series_document(_filled_series(spark, sf_dir))
    pts = F.from_json("json", "array<struct<month: string, mrr_amount: double>>")
    return doc.select(
        F.size(pts).cast("bigint").alias("points"),
        F.element_at(pts, 1).getField("month").alias("first_month"),
        F.element_at(pts, -1).getField("month").alias("last_month"),
        F.aggregate(
            pts, F.lit(0).cast("decimal(28,2)"), lambda acc, p: (acc + p.mrr_amount.cast("decimal(18,2)")).cast("decimal(28,2)")
        ).cast("decimal(18,2)").alias("total_amount"),
    )


@register("json_series_read")
def q_json_series_read(spark, sf_dir):
    """A10: the written document read back into typed rows."""
    path = f"{_scratch(spark, 'series').root}/mrr.json"
    series.write_series(_filled_series(spark, sf_dir), path)
    back = series.read_series(spark, path)
    return back.select("month", _money("mrr_amount").alias("mrr_amount"))


@register("month_label")
def q_month_label(spark, sf_dir):
    """P22: 'Nov 2025'-style labels."""
    return series.labels(_filled_series(spark, sf_dir)).select("month", "month_label")


@register("currency_label")
def q_currency_label(spark, sf_dir):
    """P23: '$2,700.00' and '$2,700' labels."""
    return series.labels(_filled_series(spark, sf_dir)).select("month", "amount_label", "axis_label")


@register("iso_month")
def q_iso_month(spark, sf_dir):
    """Month as 'YYYY-MM-DD' text next to its value."""
    return series.labels(_filled_series(spark, sf_dir)).select("month_iso", "month")


@register("series_min_max")
def q_series_min_max(spark, sf_dir):
    """Min, max, first and last values of the series."""
    return series.series_min_max(_filled_series(spark, sf_dir))


# ---------------------------------------------------------------------------------------
# Table maintenance as registered operations (B1, B2, B6, B7, B8) and P27
# ---------------------------------------------------------------------------------------


def _accepted_customers(spark, sf_dir):
    return flatten.accepted(flatten.flatten_customers(_loaded_customers(spark, sf_dir), RUN_TS))


@register("ensure_database")
def q_ensure_database(spark, sf_dir):
    """B1: create the database twice (idempotent), load customers into it, count them back."""
    wh = _scratch(spark, "db")
    tables.ensure_database(spark, wh)
    tables.ensure_database(spark, wh)
    tables.ensure_tables(spark, wh)
    tables.upsert(spark, wh, "customers", _accepted_customers(spark, sf_dir), "stripe_customer_id")
    n = spark.table(wh.table("customers")).count()
    exists = spark.catalog.databaseExists(wh.database)
    return spark.createDataFrame([(exists, n)], "database_exists boolean, customers bigint")


@register("ensure_tables")
def q_ensure_tables(spark, sf_dir):
    """B2: create the four tables twice (idempotent) and load all three entities; rows per table."""
    wh = _scratch(spark, "tbl")
    tables.ensure_tables(spark, wh)
    tables.ensure_tables(spark, wh)
    sync.sync(spark, wh, _listings(spark, sf_dir), dt.datetime.fromisoformat(RUN_TS))
    return relational.table_row_counts(
        {name: spark.table(wh.table(name)) for name in ["customers", "subscriptions", "invoices", "_sync_watermarks"]}
    )


@register("truncate_table")
def q_truncate_table(spark, sf_dir):
    """Rows before and after emptying the customers table (other tables untouched)."""
    wh = _scratch(spark, "trunc")
    sync.sync(spark, wh, {"customers": _listing(spark, sf_dir, "customers")}, dt.datetime.fromisoformat(RUN_TS))
    before = spark.table(wh.table("customers")).count()
    tables.truncate_table(spark, wh, "customers")
    after = spark.table(wh.table("customers")).count()
    return spark.createDataFrame([("customers", before, after)], "table_name string, rows_before bigint, rows_after bigint")


def _bookmarks_from_data(spark, sf_dir, wh):
    """Bookmark per entity = newest creation time among its accepted rows (derived from data)."""
    tables.ensure_tables(spark, wh)
    newest = [
        _accepted_customers(spark, sf_dir).agg(F.max("created_at").alias("last_synced_at"))
        .select(F.lit("customers").alias("sync_key"), "last_synced_at"),
        flatten.accepted(flatten.flatten_subscriptions(_loaded_subs(spark, sf_dir), RUN_TS))
        .agg(F.max("created_at").alias("last_synced_at"))
        .select(F.lit("subscriptions").alias("sync_key"), "last_synced_at"),
        flatten.accepted(flatten.flatten_invoices(_loaded_invoices(spark, sf_dir), RUN_TS))
        .agg(F.max("created_at").alias("last_synced_at"))
        .select(F.lit("invoices").alias("sync_key"), "last_synced_at"),
    ]
    tables.write_watermarks(spark, wh, newest[0].unionByName(newest[1]).unionByName(newest[2]))
    return spark.table(wh.table("_sync_watermarks")).select("sync_key", _ntz("last_synced_at"))


@register("watermark_write")
def q_watermark_write(spark, sf_dir):
    """One bookmark per entity (newest accepted creation time), written as single-partition overwrites."""
    return _bookmarks_from_data(spark, sf_dir, _scratch(spark, "wmw"))


@register("watermark_reset")
def q_watermark_reset(spark, sf_dir):
    """Bookmarks written then cleared: what each key reads before and after (nothing)."""
    wh = _scratch(spark, "wmr")
    written = _bookmarks_from_data(spark, sf_dir, wh).withColumnRenamed("last_synced_at", "before_reset").collect()  # one an entity
    before = spark.createDataFrame(written, "sync_key string, before_reset timestamp_ntz")
    tables.watermark_reset(spark, wh)
    after = tables.watermarks(spark, wh, [r.sync_key for r in written])
    return before.join(after, "sync_key", "left").select(
        "sync_key", "before_reset", _ntz("last_synced_at").alias("after_reset"))


@register("pct_floor")
def q_pct_floor(spark, sf_dir):
    """Floor percentage of canceled subscriptions per batch of three customers (0 when a batch is empty)."""
    index = raw.numeric_id(F.col("stripe_customer_id"))  # customer keys start at 0
    per = _subs(spark, sf_dir).groupBy(C.batch_index(index).alias("batch")).agg(
        F.count(F.when(F.col("status") == "canceled", 1)).alias("canceled"), F.count(F.lit(1)).alias("n"))
    return per.select("batch", C.pct_floor("canceled", "n").alias("pct_canceled"))


@register("lifecycle_tier_change")
def q_lifecycle_tier_change(spark, sf_dir):
    """C2 on generated lifecycles: in each tier-change month only v1 counts (seed window)."""
    s = synth.lifecycle_to_subscriptions(_plans(spark, sf_dir), SEED_T0)
    return checks.check_tier_change(s, "2025-11-01", "2026-05-01")


# ---------------------------------------------------------------------------------------
# Change feed, differences, irregular calendars, filtered anti joins, marker tables
# ---------------------------------------------------------------------------------------


@register("upsert_changes")
def q_upsert_changes(spark, sf_dir):
    """B5 row by row: what the second load inserted or updated, with the cents before and after."""
    wh, _ = _merged(spark, sf_dir, "feed")
    feed = tables.changes(spark, wh, "subscriptions")
    return feed.select(
        F.col("after.stripe_subscription_id").alias("stripe_subscription_id"), "op",
        F.col("before.unit_amount_cents").alias("cents_before"), F.col("after.unit_amount_cents").alias("cents_after"))


@register("mrr_from_changes")
def q_mrr_from_changes(spark, sf_dir):
    """G1 kept current from the change feeds of two loads, without reading the table."""
    wh, _ = _merged(spark, sf_dir, "delta")
    state = None
    for number in (1, 2):
        state = metric.advance(state, tables.changes(spark, wh, "subscriptions", number), WINDOW_START, WINDOW_END)
    out = metric.mrr_of_state(state)
    return out.select("month", _money("mrr_amount").alias("mrr_amount"))


@register("mrr_by_period")
def q_mrr_by_period(spark, sf_dir):
    """J1/J3 over a calendar given as a table: a period a customer, which ends on the day of their last order."""
    ends = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("period_id")).agg(
        F.max("o_orderdate").cast("date").alias("last_day"))
    out = periods.mrr_by_period(_subs(spark, sf_dir), ends)
    return out.select("period_id", "active", _money("mrr_amount").alias("mrr_amount"))


@register("resync_difference")
def q_resync_difference(spark, sf_dir):
    """C4: two versions of a table of which the second has one cent more on every 500th subscription: the rows found."""
    wh = _scratch(spark, "diff")
    tables.ensure_tables(spark, wh)
    subs = _with_zone(_subs(spark, sf_dir))
    every = raw.numeric_id(F.col("stripe_subscription_id")) % 500 == 7
    cents = F.col("unit_amount_cents") + every.cast("bigint")
    for load in (subs, subs.withColumn("unit_amount_cents", cents)):
        tables.upsert(spark, wh, "subscriptions", load, "stripe_subscription_id")
    old, new = (spark.table(tables.attach(spark, wh, "subscriptions", tables.version(spark, wh, "subscriptions", n))) for n in (1, 2))
    columns = [c for c in tables.schema_columns("subscriptions") if c != "synced_at"]
    found = difference.differences(old, new, "stripe_subscription_id", columns, tables.PARTITION_COLUMN)
    return found.select(
        F.col("key").alias("stripe_subscription_id"), F.col("before.unit_amount_cents").alias("cents_before"),
        F.col("after.unit_amount_cents").alias("cents_after"))


@register("subscriptions_without_paid_invoice")
def q_subscriptions_without_paid_invoice(spark, sf_dir):
    """F10/J7 at scale: subscriptions that no paid invoice names, by an anti join behind a bitmap of keys."""
    paid = fixtures.invoices(spark, sf_dir).where(F.col("status") == "paid").select("stripe_subscription_id")
    return bitmap.anti_join(_subs(spark, sf_dir).select("stripe_subscription_id", "status"), paid, "stripe_subscription_id")


@register("marker_table_scan")
def q_marker_table_scan(spark, sf_dir):
    """F14 with a table of markers: names of all customers, and of every document the twelve
    characters from its 50th on; documents that contain any, whole texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    names = table(spark, sf_dir, "customer").select(F.col("c_name").alias("marker"))
    listed = names.unionByName(docs.select(F.substring("text", 50, 12).alias("marker")))
    return markers.marker_scan(docs, listed, "text", "marker").select("doc_id", F.array_join("markers", "\n").alias("markers"))
