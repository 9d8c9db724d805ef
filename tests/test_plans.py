"""Physical-plan shape: the properties the design relies on at scale."""

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    df = entry.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_has_no_nested_loop_and_pruned_scan(spark):
    p = plan(spark, "mrr_monthly")
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "partial_sum" in p  # map-side partial aggregation before the shuffle
    scans = [line for line in p.split("\n") if "FileScan parquet" in line]
    assert scans and all("o_totalprice" not in s and "o_orderstatus" not in s for s in scans)


def test_pairs_and_leave_one_out_use_equi_joins(spark):
    for name in ["tier_change_pairs", "mrr_leave_one_out", "check_tier_change"]:
        p = plan(spark, name)
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_json_parsed_in_one_operator(spark):
    p = plan(spark, "flatten_subscription")
    parsing_nodes = [line for line in p.split("\n") if "from_json" in line and ("Generate" in line or "Filter" in line)]
    assert len([line for line in parsing_nodes if "Filter" in line]) == 0
    assert len([line for line in parsing_nodes if "Generate" in line]) == 1
