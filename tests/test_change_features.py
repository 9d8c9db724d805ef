"""Metric from change feeds, irregular calendars, differences, bitmap joins, marker tables."""

import datetime as dt
import random

from pyspark.sql import functions as F

from ledgerline.operators import bitmap, difference, markers, metric, periods
from ledgerline.sinks import tables
from ledgerline.sources import fixtures, raw

SF = "/root/testdata/sf0.001"
W0, W1 = "1994-10-01", "1996-01-01"
KEY = "stripe_subscription_id"


def _subs(spark, until="1995-04-01"):
    s = fixtures.subscriptions(spark, SF).where(f"created_at < '{until}'")
    return s.select(*[F.col(c).cast("timestamp").alias(c) if t.startswith("timestamp") else F.col(c) for c, t in s.dtypes])


def test_ten_upserts_by_their_feeds_equal_a_full_recompute(spark, tmp_root):
    wh = tables.Warehouse("ll_t_delta", tmp_root, 1)
    tables.ensure_tables(spark, wh)
    subs, rng, state = _subs(spark, "1995-02-10"), random.Random(2), None
    n = raw.numeric_id(F.col(KEY))
    for _ in range(10):
        some = subs.where((n + rng.randrange(50)) % rng.randint(2, 5) == 0).withColumns({
            "unit_amount_cents": F.lit(rng.randint(1, 90000)).cast("bigint"),
            "status": F.lit(rng.choice(["active", "canceled", "unpaid", "active"])),
            "canceled_at": F.when(n % rng.randint(2, 4) == 0, F.col("created_at") + F.expr(f"INTERVAL {rng.randint(0, 300)} DAYS")),
            "interval": F.lit(rng.choice(["month", "year", "month", "week"])).cast("string"),
        })
        tables.upsert(spark, wh, "subscriptions", some, KEY)
        feed = tables.changes(spark, wh, "subscriptions")
        rows = metric.advance(state, feed, W0, W1).collect()
        state = spark.createDataFrame(rows, "month date, divisor long, cents long")
    kept = {r["month"]: r["mrr_amount"] for r in metric.mrr_of_state(state).collect() if r["mrr_amount"]}
    full = {r["month"]: r["mrr_amount"] for r in metric.mrr_monthly(tables.read(spark, wh, "subscriptions"), W0, W1).collect() if r["mrr_amount"]}
    assert kept == full and len(full) > 5


def test_the_feed_reads_its_commit_only(spark, tmp_root):
    wh = tables.Warehouse("ll_t_feed_files", tmp_root, 1)
    tables.ensure_tables(spark, wh)
    tables.upsert(spark, wh, "subscriptions", _subs(spark), KEY)
    tables.upsert(spark, wh, "subscriptions", _subs(spark).limit(1).withColumn("unit_amount_cents", F.lit(1)), KEY)
    assert len(tables.changes(spark, wh, "subscriptions").inputFiles()) == 1
    tables.truncate_table(spark, wh, "subscriptions")
    assert tables.changes(spark, wh, "subscriptions").count() == 0
    assert tables.version(spark, wh, "subscriptions", 3).kind == "truncated"


def test_periods_equal_the_theta_join(spark):
    rng, day = random.Random(5), dt.date(1995, 1, 1)
    rows = [(i, day + dt.timedelta(days=rng.randint(-400, 900))) for i in range(60)] + [(100, None), (101, dt.date(1, 1, 1)), (102, dt.date(9999, 12, 31))]
    calendar = spark.createDataFrame(rows, "period_id int, last_day date")
    subs = fixtures.subscriptions(spark, SF).withColumn("start_date", F.when(F.rand(1) < 0.9, F.col("start_date")))
    subs = spark.createDataFrame(subs.collect(), subs.schema)
    got = {r["period_id"]: (r["active"], r["mrr_amount"]) for r in periods.mrr_by_period(subs, calendar).collect()}
    sub = metric.active_subscriptions(subs).withColumn("divisor", periods.C.monthly_divisor("interval_type", "interval_count"))
    alive = (F.col("sub_start_date") <= F.col("last_day")) & (F.col("sub_canceled_date").isNull() | (F.col("sub_canceled_date") > F.col("last_day")))
    cents = F.col("unit_amount_cents").cast("decimal(28,0)") / F.col("divisor").cast("decimal(10,0)")
    want = calendar.join(sub, alive, "left").groupBy("period_id").agg(
        F.count("stripe_subscription_id").alias("n"), F.coalesce(F.sum(cents), F.lit(0)).cast("decimal(38,6)").alias("amount")).collect()
    assert set(got) == {r["period_id"] for r in want} and len({n for n, _ in got.values()}) > 10
    assert all(got[r["period_id"]][0] == r["n"] and abs(got[r["period_id"]][1] - r["amount"]) < 0.01 for r in want)
    plan = periods.mrr_by_period(subs, calendar)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_dyadic_blocks_cover_an_interval_once(spark):
    ends = [(a, b) for a in (0, 1, 5, 6, 8, 31) for b in (0, 1, 6, 7, 8, 32, 45)]
    df = spark.createDataFrame(ends, "a int, b int")
    blocks = df.select("a", "b", periods.blocks_of_interval(F.col("a"), F.col("b")).alias("blocks")).collect()
    for r in blocks:
        days = [d for x in r["blocks"] for d in range(x["block"] << x["level"], (x["block"] + 1) << x["level"])]
        assert sorted(days) == list(range(r["a"], r["b"]))


def test_differences_are_found_and_only_their_partitions_compared(spark):
    a = spark.range(5000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 7).alias("p"), (F.col("id") * 3).alias("v"), F.lit(None).cast("int").alias("w"))
    b = a.where("k <> '10'").withColumns({"v": F.when(F.col("k") == "701", F.col("v") + 1).otherwise(F.col("v")), "p": F.when(F.col("k") == "14", F.lit(3)).otherwise(F.col("p"))})
    b = b.unionByName(spark.createDataFrame([("new", 2, 5, None)], "k string, p long, v long, w int"))
    got = {r["key"]: (r["before"] and r["before"]["v"], r["after"] and r["after"]["v"]) for r in difference.differences(a, b, "k", ["v", "w", "p"], "p").collect()}
    assert got == {"10": (30, None), "701": (2103, 2104), "14": (42, 42), "new": (None, 5)}
    assert difference.differing_leaves(a, b, "k", ["v", "w", "p"], "p").select("p").distinct().count() <= 5
    assert difference.differences(a, a, "k", ["v", "w"], "p").count() == 0


def test_bitmap_joins_are_exact_and_let_little_through(spark):
    rows = spark.range(20000).select(F.when(F.col("id") % 100 != 0, F.concat(F.lit("k"), "id")).alias("k"), "id")
    keys = rows.where("id % 11 = 0").select("k").unionByName(rows.where("id % 11 = 0").select("k"))
    want = {r["id"] for r in rows.join(keys, "k", "left_anti").collect()}
    assert {r["id"] for r in bitmap.anti_join(rows, keys, "k").collect()} == want
    assert {r["id"] for r in bitmap.semi_join(rows, keys, "k").collect()} == set(range(20000)) - want
    assert bitmap.anti_join(rows, keys.where("false"), "k").count() == 20000
    assert bitmap.semi_join(rows, keys.where("false"), "k").count() == 0
    known = bitmap.Bitmap(keys, "k")
    passed = rows.where(known.may_hold(F.col("k"))).count()
    assert 0 <= passed - (20000 - len(want)) < 20000 * 0.1


def test_markers_equal_a_search_for_each(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choice("abcé \n") for _ in range(rng.randint(0, 400))) for _ in range(300)] + [None, "", "a", "sk_live_" * 3000 + "é"]
    docs = spark.createDataFrame([(i % 290, t, "x") for i, t in enumerate(texts)], "doc_id int, text string, gram string")
    listed = [t[5:rng.randint(7, 30)] for t in texts[:200] if t and len(t) > 40] + ["sk_live_", "sk_live_s", "b", "éa", "", None, "no such marker", "b"]
    table = spark.createDataFrame([(m,) for m in listed], "marker string")
    got = sorted((r["doc_id"], r["text"], tuple(r["markers"])) for r in markers.marker_scan(docs, table, "text", "marker").collect())
    wanted = {m for m in listed if m}
    want = sorted((i % 290, t, tuple(sorted(m for m in wanted if m in t))) for i, t in enumerate(texts) if t and any(m in t for m in wanted))
    assert got == want
    assert markers.marker_scan(docs, table.where("false"), "text", "marker").count() == 0


def test_texts_meet_few_markers_that_they_do_not_hold(spark):
    texts = ["the cat and the dog of the house" + c for c in "abcdefgh"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    listed = [f"cat and {w} of the" for w in ("one", "two", "six", "ten", "the dog")] + ["é" * 13, "dog"]
    table = spark.createDataFrame([(m,) for m in listed], "marker string")
    sizes = {r["marker"]: len(r["gram"]) for r in markers.index(table, "marker").collect()}
    assert sizes == {m: 12 if len(m) >= 12 else len(m) for m in listed}  # whole short ones, the longest grams of others
    got = markers.marker_scan(docs, table, "text", "marker").collect()
    assert sorted((r["doc_id"], tuple(r["markers"])) for r in got) == [(i, ("cat and the dog of the", "dog")) for i in range(8)]


def test_gram_hashes_of_pieces_equal_those_of_the_whole(spark, monkeypatch):
    monkeypatch.setattr(markers, "PIECE", 5)
    texts = ["x😀é" * 9 + "needle in the hay" + "é" * 20, "needle", "nothing"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    table = spark.createDataFrame([(m,) for m in ("needle in the", "needle", "é😀", "x😀éx😀é")], "marker string")
    got = {r["doc_id"]: r["markers"] for r in markers.marker_scan(docs, table, "text", "marker").collect()}
    assert got == {0: ["needle", "needle in the", "x😀éx😀é"], 1: ["needle"]}


def test_few_ngrams_that_no_marker_has_are_shuffled(spark):
    rng = random.Random(3)
    listed = ["".join(rng.choices("abcdefgh", k=12)) for _ in range(2000)]
    text = "".join(rng.choices("abcdefgh", k=20_000)) + listed[7]
    entries = markers._keyed(markers.index(spark.createDataFrame([(m,) for m in listed], "marker string"), "marker"))
    words = markers.bitmap(entries, len(listed))
    texts = spark.createDataFrame([(1, text)], "_digest long, text string")
    through = markers.looked_up(texts, [12], words)
    assert through.join(entries, "key").select("marker").collect() == [(listed[7],)]
    assert through.count() < 200  # of 20,001; one bit an entry lets some 1,200 through
