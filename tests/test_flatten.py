"""Raw object parsing and flattening: the transform cases of the reference tests."""

import json

from pyspark.sql import functions as F

from ledgerline.functions import columns as C
from ledgerline.operators import flatten
from ledgerline.sources import raw

RUN = "2026-01-01 00:00:00"


def listing(spark, objs, scope="default"):
    rows = [(scope, 0 if scope == "default" else 1, o if isinstance(o, str) else json.dumps(o)) for o in objs]
    return spark.createDataFrame(rows, raw.LISTING_SCHEMA)


SUB = {
    "id": "sub_1", "customer": "cus_1", "status": "active", "created": 1609459200, "livemode": False,
    "start_date": 1609459200, "canceled_at": None, "ended_at": None, "billing_cycle_anchor": 1609459200,
    "current_period_start": 1609459200, "current_period_end": 1612137600,
    "metadata": {"idempotency_key": "seed-sub-cus_1-v0"},
    "items": {"data": [{"quantity": 1, "price": {"id": "price_1", "unit_amount": 5000, "currency": "usd",
                                                  "recurring": {"interval": "month", "interval_count": 1}}}]},
}


def test_subscription_row(spark):
    flat = flatten.flatten_subscriptions(raw.load_subscriptions(listing(spark, [SUB])), RUN)
    r = flatten.accepted(flat).collect()[0]
    assert r["current_price_id"] == "price_1" and r["unit_amount_cents"] == 5000
    assert r["interval"] == "month" and r["interval_count"] == 1
    assert r["idempotency_key"] == "seed-sub-cus_1-v0"
    assert json.loads(r["metadata"]) == {"idempotency_key": "seed-sub-cus_1-v0"}
    assert r["created_at"].isoformat().startswith("2021-01-01")
    assert r["canceled_at"] is None


def test_subscription_rejections(spark):
    bad_status = dict(SUB, id="sub_2", status="unknown_status")
    no_items = dict(SUB, id="sub_3", items={"data": []})
    live = dict(SUB, id="sub_4", livemode=True)
    junk = dict(SUB, id="sub_5", created="not-a-time")
    iso = dict(SUB, id="sub_6", created="2021-01-01T00:00:00Z")
    no_meta = dict(SUB, id="sub_7", metadata=None)
    loaded = raw.load_subscriptions(listing(spark, [SUB, bad_status, no_items, live, junk, iso, no_meta, "{not json"]))
    flat = flatten.flatten_subscriptions(loaded, RUN)
    ok = {r["stripe_subscription_id"]: r for r in flatten.accepted(flat).collect()}
    assert set(ok) == {"sub_1", "sub_6", "sub_7"}
    assert ok["sub_7"]["metadata"] is None and ok["sub_7"]["idempotency_key"] is None
    assert ok["sub_6"]["created_at"] == ok["sub_1"]["created_at"]
    reasons = {r["reason"]: r["rows"] for r in flatten.reject_counts(flat, "subscriptions").collect()}
    assert reasons == {"invalid_status": 1, "bad_created": 1, "not_json": 1}


def test_customer_partial_and_nested(spark):
    full = {"id": "cus_test123", "email": "a@b.c", "name": "A", "created": 1609459200, "default_source": None,
            "livemode": False, "metadata": {"test_clock_id": "clock_1"}}
    partial = {"id": "cus_2", "email": None, "name": None, "created": 1609459200, "livemode": False, "metadata": {},
               "default_source": {"currency": "eur"}}
    flat = flatten.accepted(flatten.flatten_customers(raw.load_customers(listing(spark, [full, partial])), RUN))
    got = {r["stripe_customer_id"]: r for r in flat.collect()}
    assert got["cus_test123"]["test_clock_id"] == "clock_1" and got["cus_test123"]["default_currency"] is None
    assert got["cus_2"]["metadata"] is None and got["cus_2"]["email"] is None
    assert got["cus_2"]["default_currency"] == "eur"


def test_invoice_without_subscription(spark):
    inv = {"id": "in_1", "customer": "cus_1", "subscription": None, "period_start": 1609459200,
           "period_end": 1612137600, "status": "paid", "total": 5000, "amount_paid": 5000, "amount_due": 0,
           "currency": "usd", "status_transitions": {"paid_at": 1609459300}, "created": 1609459200,
           "livemode": False, "metadata": {}}
    flat = flatten.accepted(flatten.flatten_invoices(raw.load_invoices(listing(spark, [inv])), RUN)).collect()[0]
    assert flat["stripe_subscription_id"] is None and flat["total_cents"] == 5000
    assert flat["paid_at"] is not None and flat["metadata"] is None


def test_first_listing_wins(spark):
    a = listing(spark, [dict(SUB, status="active")])
    b = listing(spark, [dict(SUB, status="past_due")], scope="clock_9")
    loaded = raw.load_subscriptions(b.unionByName(a)).collect()
    assert len(loaded) == 1 and loaded[0]["status"] == "active" and loaded[0]["scope"] == "default"


def test_epoch_parsing(spark):
    df = spark.createDataFrame([("1609459200",), ("2021-01-01T00:00:00Z",), ("junk",), (None,)], "x string")
    got = [r[0] for r in df.select(C.epoch_to_ts("x").cast("string")).collect()]
    assert got[0] == got[1] == "2021-01-01 00:00:00" and got[2] is None and got[3] is None


def test_read_listing_from_json_lines_folders(spark, tmp_root):
    a = listing(spark, [dict(SUB, status="active"), dict(SUB, id="sub_2")])
    b = listing(spark, [dict(SUB, status="past_due")], scope="clock_9")
    a.select("value").write.text(f"{tmp_root}/default")
    b.select("value").write.text(f"{tmp_root}/clock_9")
    back = raw.read_listing(spark, tmp_root)
    assert {(r["scope"], r["scope_rank"]) for r in back.collect()} == {("default", 0), ("clock_9", 1)}
    loaded = {r["id"]: r for r in raw.load_subscriptions(back).collect()}
    assert set(loaded) == {"sub_1", "sub_2"} and loaded["sub_1"]["status"] == "active"


def test_epochs_out_of_range_are_null(spark):
    rows = spark.createDataFrame([("99999999999999999",), ("253402300800",), ("253402300799",), ("-62135596801",)], "x string")
    got = [r[0] for r in rows.select(C.epoch_to_ts("x").cast("string")).collect()]
    assert got[0] is None and got[1] is None and got[2].startswith("9999-12-31") and got[3] is None
