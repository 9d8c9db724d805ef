"""End to end: raw listings -> warehouse tables -> metric over the table -> JSON series."""

from pyspark.sql import functions as F

from ledgerline.operators import flatten, metric, sqlform
from ledgerline.plans import series, sync
from ledgerline.sinks import tables
from ledgerline.sources import raw

SF = "/root/testdata/sf0.001"
W0, W1 = "1994-10-01", "2002-01-01"


def test_sync_then_metric_then_export(spark, tmp_root):
    wh = tables.Warehouse("ll_t_pipeline", tmp_root)
    listing = raw.subscription_listing(spark, SF)
    sync.sync(spark, wh, {"subscriptions": listing}, full_refresh=True)
    table_name = wh.table("subscriptions")
    from_table = {tuple(r) for r in sqlform.mrr_monthly_sql(spark, table_name, W0, W1).collect()}
    direct = flatten.accepted(flatten.flatten_subscriptions(raw.load_subscriptions(listing), "2026-01-01 00:00:00"))
    expected = {tuple(r) for r in metric.mrr_monthly(direct, W0, W1).collect()}
    assert from_table == expected and len(expected) > 50

    path = f"{tmp_root}/mrr.json"
    filled = metric.mrr_monthly_filled(spark.table(table_name), W0, W1)
    series.write_series(filled, path)
    back = series.read_series(spark, path)
    assert back.count() == filled.count() == metric.window_months(W0, W1)
    got = {(r["month"], round(float(r["mrr_amount"]), 2)) for r in back.collect()}
    want = {(r["month"], round(float(r["mrr_amount"]), 2)) for r in filled.collect()}
    assert got == want
    text = spark.read.text(path).collect()[0][0]
    assert text.startswith('[{"month":"1994-10-01","mrr_amount":0.0}')
