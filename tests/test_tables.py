"""Warehouse tables: upsert by key with counts, truncate, bookmarks, replay, streaming load."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import sync
from ledgerline.sinks import tables, versions
from ledgerline.sources import fixtures, raw
from ledgerline.streaming import incremental

SF = "/root/testdata/sf0.001"


def _few_lines(listing):
    """Lines of objects of the first months: commits take time for every month they write."""
    return listing.where(F.get_json_object("value", "$.created").try_cast("bigint") < 804556800)


def _flat_subs(spark):
    s = fixtures.subscriptions(spark, SF).where("created_at < '1995-07-01'")
    return s.select(*[F.col(c).cast("timestamp").alias(c) if t.startswith("timestamp") else F.col(c)
                      for c, t in s.dtypes])


def test_upsert_counts_and_state(spark, tmp_root):
    wh = tables.Warehouse("ll_t_upsert", tmp_root)
    tables.ensure_tables(spark, wh)
    subs = _flat_subs(spark)
    n = raw.numeric_id(F.col("stripe_subscription_id"))
    first, second = subs.where(n % 2 == 0), subs.where(n % 3 == 0).withColumn("unit_amount_cents", F.lit(1))
    c1 = tables.upsert(spark, wh, "subscriptions", first, "stripe_subscription_id")
    assert c1 == {"inserted": first.count(), "updated": 0}
    c2 = tables.upsert(spark, wh, "subscriptions", second, "stripe_subscription_id")
    assert c2 == {"inserted": second.where(n % 2 != 0).count(), "updated": second.where(n % 2 == 0).count()}
    t = spark.table(wh.table("subscriptions"))
    assert t.count() == subs.where((n % 2 == 0) | (n % 3 == 0)).count()
    assert t.groupBy("stripe_subscription_id").count().where("count > 1").count() == 0
    assert t.where(F.col("unit_amount_cents") == 1).count() == second.count()
    # empty source: no-op
    assert tables.upsert(spark, wh, "subscriptions", second.limit(0), "stripe_subscription_id")["inserted"] == 0
    tables.truncate_table(spark, wh, "subscriptions")
    assert spark.table(wh.table("subscriptions")).count() == 0


def test_a_writer_that_stops_before_it_publishes_changes_nothing(spark, tmp_root, monkeypatch):
    wh = tables.Warehouse("ll_t_replay", tmp_root)
    tables.ensure_tables(spark, wh)
    subs = _flat_subs(spark)
    n, key = subs.count(), "stripe_subscription_id"
    half = subs.where(F.abs(F.xxhash64(key)) % 2 == 0)
    inserted = tables.upsert(spark, wh, "subscriptions", half, key)["inserted"]
    before = versions.current(spark, wh.location("subscriptions"))

    def stop(*_):
        raise InterruptedError

    for step in ("write_commit", "publish"):  # before the data, between data and pointer
        with monkeypatch.context() as m:
            m.setattr(versions, step, stop)
            with pytest.raises(InterruptedError):
                tables.upsert(spark, wh, "subscriptions", subs, key, "stopped")
        assert versions.current(spark, wh.location("subscriptions")) == before
        assert tables.read(spark, wh, "subscriptions").count() == inserted
    got = tables.upsert(spark, wh, "subscriptions", subs, key, "stopped")
    assert got == {"inserted": n - inserted, "updated": inserted}
    number = versions.current(spark, wh.location("subscriptions")).number
    # a replay of what was published reports the same and writes nothing
    assert tables.upsert(spark, wh, "subscriptions", subs, key, "stopped") == got
    assert versions.current(spark, wh.location("subscriptions")).number == number
    assert tables.read(spark, wh, "subscriptions").count() == n
    # the folders of stopped commits are not listed by anyone; vacuum removes them
    used = set(versions.current(spark, wh.location("subscriptions")).months.values())
    assert set(versions.children(spark, f"{wh.location('subscriptions')}/data")) > used
    versions.vacuum(spark, wh.location("subscriptions"), keep=1)
    assert set(versions.children(spark, f"{wh.location('subscriptions')}/data")) == used
    assert tables.read(spark, wh, "subscriptions").count() == n


def test_of_two_writers_one_starts_again(spark, tmp_root, monkeypatch):
    wh = tables.Warehouse("ll_t_two", tmp_root)
    tables.ensure_tables(spark, wh)
    subs, key = _flat_subs(spark), "stripe_subscription_id"
    a, b = subs.where(F.abs(F.xxhash64(key)) % 2 == 0), subs.where(F.abs(F.xxhash64(key)) % 3 == 0).withColumn("unit_amount_cents", F.lit(7))
    publish, calls = versions.publish, []

    def other_first(spark_, location, new):
        calls.append(new.number)
        if len(calls) == 1:  # while this writer merges, another one publishes the same number
            monkeypatch.setattr(versions, "publish", publish)
            tables.upsert(spark, wh, "subscriptions", a, key)
            monkeypatch.setattr(versions, "publish", other_first)
        return publish(spark_, location, new)

    monkeypatch.setattr(versions, "publish", other_first)
    got = tables.upsert(spark, wh, "subscriptions", b, key)
    both = a.join(b.select(key), key, "left_semi").count()
    assert calls == [1, 2] and got == {"inserted": b.count() - both, "updated": both}
    t = tables.read(spark, wh, "subscriptions")
    assert t.count() == a.count() + b.count() - both == t.select(key).distinct().count()
    assert t.where("unit_amount_cents = 7").count() == b.count()


def test_a_reader_keeps_its_version_while_the_table_moves_on(spark, tmp_root):
    wh = tables.Warehouse("ll_t_reader", tmp_root)
    tables.ensure_tables(spark, wh)
    subs, key = _flat_subs(spark), "stripe_subscription_id"
    settings = dict(spark.sparkContext.getConf().getAll()) | {"mode": spark.conf.get("spark.sql.sources.partitionOverwriteMode")}
    tables.upsert(spark, wh, "subscriptions", subs.where("unit_amount_cents = 5000"), key)
    reader = spark.table(wh.table("subscriptions"))
    held = reader.agg(F.count("*"), F.sum("unit_amount_cents"))
    first = held.first()
    tables.upsert(spark, wh, "subscriptions", subs.withColumn("unit_amount_cents", F.lit(1)), key)
    assert reader.agg(F.count("*"), F.sum("unit_amount_cents")).first() == first  # planned before the commit
    assert spark.table(wh.table("subscriptions")).agg(F.sum("unit_amount_cents")).first()[0] == subs.count()
    assert settings == dict(spark.sparkContext.getConf().getAll()) | {"mode": spark.conf.get("spark.sql.sources.partitionOverwriteMode")}


def test_the_merge_does_not_shuffle_the_table(spark, tmp_root):
    wh = tables.Warehouse("ll_t_plan", tmp_root)
    tables.ensure_tables(spark, wh)
    subs, key = _flat_subs(spark), "stripe_subscription_id"
    tables.upsert(spark, wh, "subscriptions", subs, key)
    target = spark.table(tables.attach(spark, wh, "subscriptions"))
    path = tables.stage_source(spark, wh, "subscriptions", subs, tables.stage_root(spark, "subscriptions", "plan"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = tables.merge_rows(target, spark.read.parquet(path), key, tables.schema_columns("subscriptions"), wh.buckets)
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan and "Bucketed: true" in plan


def test_changes_are_what_differs_between_two_versions(spark, tmp_root):
    wh = tables.Warehouse("ll_t_feed", tmp_root)
    tables.ensure_tables(spark, wh)
    subs, key = _flat_subs(spark), "stripe_subscription_id"
    n = raw.numeric_id(F.col(key))
    tables.upsert(spark, wh, "subscriptions", subs.where(n % 4 != 0), key)
    assert tables.changes(spark, wh, "subscriptions").where("op != 'inserted' OR before IS NOT NULL").count() == 0
    old = tables.read(spark, wh, "subscriptions").drop("created_month", "synced_at").collect()
    second = subs.where(n % 3 != 0).withColumns({
        "unit_amount_cents": F.when(n % 2 == 0, F.col("unit_amount_cents") + 1).otherwise(F.col("unit_amount_cents")),
        "created_at": F.when(n % 5 == 0, F.col("created_at") + F.expr("INTERVAL 70 DAYS")).otherwise(F.col("created_at")),
        "synced_at": F.lit("2027-01-01").cast("timestamp"),
    })
    tables.upsert(spark, wh, "subscriptions", second, key)
    new = tables.read(spark, wh, "subscriptions").drop("created_month", "synced_at").collect()
    feed = tables.changes(spark, wh, "subscriptions").withColumns({
        "before": F.col("before").dropFields("synced_at"), "after": F.col("after").dropFields("synced_at")}).collect()
    a, b = {r[key]: r for r in old}, {r[key]: r for r in new}
    want = {k: (a.get(k), r) for k, r in b.items() if a.get(k) != r}
    assert {r["after"][key]: (r["before"], r["after"]) for r in feed} == want and len(feed) == len(want)
    counts = tables.last_counts(spark, wh, "subscriptions")
    assert counts["inserted"] == sum(v[0] is None for v in want.values())
    assert counts["updated"] - counts["unchanged"] == sum(v[0] is not None for v in want.values()) and counts["unchanged"] > 0


def test_any_order_of_arrivals_gives_one_table(spark, tmp_root):
    listing = _few_lines(raw.subscription_listing(spark, SF))
    n = raw.numeric_id(F.get_json_object("value", "$.id"))
    results = []
    for k, order in enumerate(([1, 2, 3], [3, 1, 2], [2, 3, 1])):
        wh = tables.Warehouse(f"ll_t_order_{k}", f"{tmp_root}/{k}")
        landing = f"{wh.root}/raw"
        for arrival in order:  # drained one by one, older ones after newer ones
            lines = listing.where(n % 4 != arrival).withColumn("value", F.regexp_replace("value", r'"unit_amount":(\d+)', f'"unit_amount":{arrival}$1'))
            incremental.write_arrival(lines.coalesce(2), landing, arrival)
            incremental.incremental_upsert(spark, wh, "subscriptions", landing, max_files_per_trigger=1 + k)
        results.append(sorted(tuple(r) for r in tables.read(spark, wh, "subscriptions").select("stripe_subscription_id", "unit_amount_cents").collect()))
    assert results[0] == results[1] == results[2] and len(results[0]) > 50
    assert {str(r[1])[0] for r in results[0]} == {"2", "3"}


def test_an_entity_that_fails_is_counted_and_keeps_its_bookmark(spark, tmp_root):
    wh = tables.Warehouse("ll_t_errors", tmp_root)
    listings = {"customers": raw.customer_listing(spark, SF), "subscriptions": raw.subscription_listing(spark, SF).drop("value")
                .withColumn("value", F.raise_error(F.lit("unreadable")).cast("string"))}
    got = {r["entity"]: r for r in sync.sync(spark, wh, listings).collect()}
    assert got["subscriptions"]["errors"] == 1 and "unreadable" in got["subscriptions"]["error"] and got["total"]["errors"] == 1
    assert got["customers"]["errors"] == 0 and got["customers"]["inserted"] > 0
    assert tables.watermark_read(spark, wh, "customers") is not None and tables.watermark_read(spark, wh, "subscriptions") is None
    assert tables.read(spark, wh, "subscriptions").count() == 0


def test_a_run_started_again_reports_the_same_counts(spark, tmp_root):
    wh = tables.Warehouse("ll_t_again", f"{tmp_root}/wh")
    raw.write_listing(raw.customer_listing(spark, SF), f"{tmp_root}/customers")
    listings, ts = {"customers": raw.read_listing(spark, f"{tmp_root}/customers")}, dt.datetime(2026, 1, 1)
    first = sync.sync(spark, wh, listings, ts).drop("duration_s").collect()
    assert sync.sync(spark, wh, listings, ts).drop("duration_s").collect() == first and first[0]["inserted"] > 0
    later = sync.sync(spark, wh, listings, dt.datetime(2026, 1, 2)).collect()
    assert (later[0]["inserted"], later[0]["updated"]) == (0, first[0]["inserted"])


def test_invoices_of_unknown_customers_stay_in_the_default_listing(spark, tmp_root):
    wh = tables.Warehouse("ll_t_scopes", tmp_root)
    customers = raw.customer_listing(spark, SF).where(raw.numeric_id(F.get_json_object("value", "$.id")) % 2 == 0)
    invoices = _few_lines(raw.invoice_listing(spark, SF, by_customer=True))
    sync.sync(spark, wh, {"customers": customers, "invoices": invoices})
    t, known = tables.read(spark, wh, "invoices"), tables.read(spark, wh, "customers")
    unknown = t.join(known, "stripe_customer_id", "left_anti")
    scoped = raw.numeric_id(F.col("stripe_invoice_id")) % 3 == 0
    assert unknown.count() > 0 and unknown.where(scoped).count() == 0 and t.where(scoped).count() > 0


def test_bookmarks(spark, tmp_root):
    wh = tables.Warehouse("ll_t_wm", tmp_root)
    tables.ensure_tables(spark, wh)
    assert tables.watermark_read(spark, wh, "customers") is None
    t1, t2 = dt.datetime(2026, 1, 1), dt.datetime(2026, 2, 1)
    tables.watermark_write(spark, wh, "customers", t1)
    tables.watermark_write(spark, wh, "invoices", t1)
    tables.watermark_write(spark, wh, "customers", t2)
    assert tables.watermark_read(spark, wh, "customers") == t2
    assert tables.watermark_read(spark, wh, "invoices") == t1
    tables.watermark_reset(spark, wh)
    assert tables.watermark_read(spark, wh, "customers") is None


def test_sync_and_dry_run(spark, tmp_root):
    wh = tables.Warehouse("ll_t_sync", tmp_root)
    listings = {"customers": raw.customer_listing(spark, SF), "subscriptions": _few_lines(raw.subscription_listing(spark, SF))}
    dry = {r["entity"]: r for r in sync.sync(spark, wh, listings, dry_run=True).collect()}
    real = {r["entity"]: r for r in sync.sync(spark, wh, listings, full_refresh=True).collect()}
    assert dry["total"]["fetched"] == real["total"]["fetched"] and dry["total"]["inserted"] == 0
    assert real["subscriptions"]["inserted"] == spark.table(wh.table("subscriptions")).count()
    again = {r["entity"]: r for r in sync.sync(spark, wh, listings).collect()}
    assert again["subscriptions"]["inserted"] == 0
    assert again["subscriptions"]["updated"] == real["subscriptions"]["inserted"]
    assert tables.watermark_read(spark, wh, "subscriptions") is not None


def test_streaming_incremental(spark, tmp_root):
    wh = tables.Warehouse("ll_t_stream", tmp_root)
    landing = f"{tmp_root}/landing"
    lst = _few_lines(raw.subscription_listing(spark, SF))
    n = raw.numeric_id(F.get_json_object("value", "$.id"))
    incremental.write_arrival(lst.where(n % 2 == 0), landing)
    s1 = incremental.incremental_upsert(spark, wh, "subscriptions", landing)
    changed = lst.where(n % 3 == 0).withColumn("value", F.regexp_replace("value", r'"unit_amount":(\d+)', '"unit_amount":7'))
    incremental.write_arrival(changed, landing)
    s2 = incremental.incremental_upsert(spark, wh, "subscriptions", landing)
    s3 = incremental.incremental_upsert(spark, wh, "subscriptions", landing)
    assert len(s1) == 1 and len(s2) == 1 and s3 == []  # nothing new: no batch at all
    t = spark.table(wh.table("subscriptions"))
    assert t.groupBy("stripe_subscription_id").count().where("count > 1").count() == 0
    m = raw.numeric_id(F.col("stripe_subscription_id"))
    assert t.where(m % 3 == 0).where(F.col("unit_amount_cents") != 7).count() == 0
    assert t.where((m % 3 != 0)).where(F.col("unit_amount_cents") == 7).count() == 0


def test_streaming_in_bounded_batches(spark, tmp_root):
    # the same arrivals drained one file per micro-batch end in the same table
    lst = _few_lines(raw.subscription_listing(spark, SF))
    n = raw.numeric_id(F.get_json_object("value", "$.id"))
    landing = f"{tmp_root}/landing"
    incremental.write_arrival(lst.where(n % 2 == 0).repartition(3), landing)
    incremental.write_arrival(lst.where(n % 2 == 1).repartition(2), landing)
    small = tables.Warehouse("ll_t_stream_small", f"{tmp_root}/small")
    stats = incremental.incremental_upsert(spark, small, "subscriptions", landing, max_files_per_trigger=1)
    whole = tables.Warehouse("ll_t_stream_whole", f"{tmp_root}/whole")
    incremental.incremental_upsert(spark, whole, "subscriptions", landing)
    assert len(stats) >= 4
    a = spark.table(small.table("subscriptions")).drop("synced_at")
    b = spark.table(whole.table("subscriptions")).drop("synced_at")
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0


def _raises(message, call, *args):
    try:
        call(*args)
    except ValueError as e:
        assert message in str(e)
    else:
        raise AssertionError("nothing raised")


def test_existing_folder_keeps_its_rows(spark, tmp_root):
    subs = _flat_subs(spark)
    n = subs.count()
    old = tables.Warehouse("ll_t_attach_a", tmp_root)
    tables.ensure_tables(spark, old)
    tables.upsert(spark, old, "subscriptions", subs, "stripe_subscription_id")
    new = tables.Warehouse("ll_t_attach_b", tmp_root)
    tables.ensure_tables(spark, new)
    assert spark.table(new.table("subscriptions")).count() == n
    got = tables.upsert(spark, new, "subscriptions", subs.limit(1), "stripe_subscription_id")
    assert got == {"inserted": 0, "updated": 1}
    assert spark.table(new.table("subscriptions")).count() == n


def test_a_key_that_changes_month_stays_one_row(spark, tmp_root):
    wh = tables.Warehouse("ll_t_moved", tmp_root)
    tables.ensure_tables(spark, wh)
    one = _flat_subs(spark).orderBy("stripe_subscription_id").limit(1)
    tables.upsert(spark, wh, "subscriptions", one, "stripe_subscription_id")
    moved = one.withColumn("created_at", F.col("created_at") + F.expr("INTERVAL 60 DAYS"))
    got = tables.upsert(spark, wh, "subscriptions", moved, "stripe_subscription_id")
    assert got == {"inserted": 0, "updated": 1}
    assert spark.table(wh.table("subscriptions")).count() == 1
    again = tables.Warehouse("ll_t_moved_again", tmp_root)  # nor do files of the emptied month come back
    tables.ensure_tables(spark, again)
    assert spark.table(again.table("subscriptions")).count() == 1


def test_bad_sources_write_nothing(spark, tmp_root):
    wh = tables.Warehouse("ll_t_bad", tmp_root)
    tables.ensure_tables(spark, wh)
    one = _flat_subs(spark).limit(1)
    key = "stripe_subscription_id"
    _raises("more than once", tables.upsert, spark, wh, "subscriptions", one.unionByName(one), key)
    empty = one.withColumn("stripe_customer_id", F.lit(None).cast("string"))
    _raises("required", tables.upsert, spark, wh, "subscriptions", empty, key)
    assert spark.table(wh.table("subscriptions")).count() == 0


def test_latest_arrival_wins_for_every_batch_size(spark, tmp_root):
    listing = _few_lines(raw.subscription_listing(spark, SF))
    changed = listing.withColumn("value", F.regexp_replace("value", r'"unit_amount":(\d+)', '"unit_amount":1$1'))
    totals = []
    for files in (None, 1):
        wh = tables.Warehouse(f"ll_t_latest_{files}", f"{tmp_root}/{files}")
        landing = f"{wh.root}/raw"
        incremental.write_arrival(listing.coalesce(2), landing, 1)
        incremental.write_arrival(changed.coalesce(2), landing, 2)
        incremental.incremental_upsert(spark, wh, "subscriptions", landing, max_files_per_trigger=files)
        t = spark.table(wh.table("subscriptions"))
        totals.append(t.agg(F.count(F.lit(1)), F.sum("unit_amount_cents")).first())
    assert totals[0] == totals[1]


def test_buckets_grow_with_the_table(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(tables, "ROWS_A_BUCKET", 20)
    key, subs = "stripe_subscription_id", _flat_subs(spark)
    n = raw.numeric_id(F.col(key))
    rows, first = subs.count(), subs.where(n % 3 != 2)
    second = subs.where(n % 3 != 0).withColumn("unit_amount_cents", F.col("unit_amount_cents") + 100)
    wh = tables.Warehouse("ll_t_grow", tmp_root, 1)
    tables.ensure_tables(spark, wh)
    seen = []
    for load in (first, second, second.limit(0)):
        tables.upsert(spark, wh, "subscriptions", load, key)
        seen.append(versions.current(spark, wh.location("subscriptions")).buckets)
    assert seen[0] == -(-first.count() // 20) > 1 and seen[1] >= 2 * seen[0] and seen[2] == seen[1]
    want = subs.select(key, (F.col("unit_amount_cents") + F.when(n % 3 != 0, 100).otherwise(0)).alias("cents"))
    got = spark.table(wh.table("subscriptions")).select(key, "unit_amount_cents")
    assert got.count() == rows and got.exceptAll(want).count() == 0
    feed = tables.changes(spark, wh, "subscriptions", 2).groupBy("op").count().collect()
    assert {r["op"]: r["count"] for r in feed} == {"inserted": subs.where(n % 3 == 2).count(), "updated": subs.where(n % 3 == 1).count()}


def _files_a_month(spark, wh, name):
    """Files of each month of the newest version, and its buckets."""
    at = versions.current(spark, wh.location(name))
    folders = [f"{wh.location(name)}/data/{c}/{tables.PARTITION_COLUMN}={m}" for m, c in at.months.items()]
    return [sum(f.endswith(".parquet") for f in versions.children(spark, folder)) for folder in folders], at.buckets


def test_a_commit_writes_a_file_a_month_and_bucket_at_most(spark, tmp_root, monkeypatch):
    """With fewer buckets than shuffle partitions too: each task of a merge has one bucket."""
    key, subs = "stripe_subscription_id", _flat_subs(spark)
    n = raw.numeric_id(F.col(key))
    wh = tables.Warehouse("ll_t_files", tmp_root, 1)
    tables.ensure_tables(spark, wh)
    monkeypatch.setattr(tables, "ROWS_A_BUCKET", -(-subs.count() // 5))
    for load in (subs.where(n % 2 == 0), subs):  # the second one deals the table anew
        tables.upsert(spark, wh, "subscriptions", load, key)
        files, buckets = _files_a_month(spark, wh, "subscriptions")
        assert buckets in (3, 6) and max(files) <= buckets  # 8 shuffle partitions
        assert tables.read(spark, wh, "subscriptions").count() == load.count()
    assert buckets == 6


def test_a_load_of_keys_that_are_there_does_not_deal_the_table_anew(spark, tmp_root, monkeypatch):
    key, subs = "stripe_subscription_id", _flat_subs(spark)
    wh = tables.Warehouse("ll_t_again", tmp_root, 1)
    tables.ensure_tables(spark, wh)
    monkeypatch.setattr(tables, "ROWS_A_BUCKET", -(-subs.count() // 3))
    seen = []
    for cents in (1, 2):
        got = tables.upsert(spark, wh, "subscriptions", subs.withColumn("unit_amount_cents", F.lit(cents)), key)
        seen.append(versions.current(spark, wh.location("subscriptions")).buckets)
    assert got == {"inserted": 0, "updated": subs.count()} and seen == [3, 3]
    assert tables.read(spark, wh, "subscriptions").agg(F.sum("unit_amount_cents")).first()[0] == 2 * subs.count()
