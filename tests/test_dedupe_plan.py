"""De-duplication of listings: one copy of the payload, reduced before the shuffle."""

from pyspark.sql import functions as F

from ledgerline.sources import raw

SF = "/root/testdata/sf0.001"


def test_payload_is_not_aggregated_and_hot_ids_are_reduced_in_map_tasks(spark, tmp_root):
    raw.write_listing(raw.subscription_listing(spark, SF), tmp_root)
    loaded = raw.load_subscriptions(raw.read_listing(spark, tmp_root))
    plan = loaded._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("Exchange") == 1 and plan.count("from_json") == 1
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_files_give_the_lines_back(spark, tmp_root):
    listing = raw.customer_listing(spark, SF)
    raw.write_listing(listing, tmp_root)
    back = raw.read_listing(spark, tmp_root)
    cols = ["scope", "scope_rank", "value"]
    assert back.count() == listing.count() and back.select(cols).exceptAll(listing.select(cols)).count() == 0
    assert raw.read_listing(spark, tmp_root, "2100-01-01T00:00:00").count() == 0


def test_a_line_that_is_not_json_keeps_its_text_and_equal_ones_all_count(spark):
    rows = [("default", 0, "{cut"), ("default", 0, "{cut"), ("c", 1, "{cut"), ("default", 0, '{"id": "a", "created": "1"}')]
    parsed = raw.parse(spark.createDataFrame(rows, raw.LISTING_SCHEMA), "id string, created string")
    out = raw.dedupe_first_listed(parsed)
    assert sorted((r["id"] or "", r["corrupt_line"] or "") for r in out.collect()) == [("", "{cut")] * 3 + [("a", "")]
    assert out.where(F.col("id").isNull()).count() == 3


def test_a_listing_is_computed_once_and_compressed(spark, tmp_root):
    runs = spark.sparkContext.accumulator(0)

    def counted(rows):
        for b in rows:
            runs.add(b.num_rows)
            yield b

    rows = [("default", 0, '{"id": "a\\tb"}'), ("c", 1, "{cut"), (None, 1, "lost"), ("d", 1, '{"id":\t"c"}')]
    listing = spark.createDataFrame(rows, raw.LISTING_SCHEMA).mapInArrow(counted, raw.LISTING_SCHEMA)
    raw.write_listing(listing, tmp_root)
    assert runs.value == len(rows)
    read = raw.read_listing(spark, tmp_root)
    assert all(f.endswith(".gz") for f in read.inputFiles())
    assert sorted(tuple(r) for r in read.collect()) == sorted(r for r in rows if r[0])


def test_no_order_column_is_shuffled(spark, tmp_root):
    raw.write_listing(raw.subscription_listing(spark, SF), tmp_root)
    plan = raw.load_subscriptions(raw.read_listing(spark, tmp_root))._jdf.queryExecution().optimizedPlan().toString()
    assert "_order" not in plan and "line_digest" not in plan
