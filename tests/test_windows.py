"""Skew-safe neighbour and first-row helpers against plain window functions."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators.windows import first_by_key, lead_by_key


def _check(df):
    got = lead_by_key(df, "k", ["t", "id"], "t", "nx", bucket=F.to_date("t"))
    ref = df.withColumn("nx2", F.lead("t").over(Window.partitionBy("k").orderBy("t", "id")))
    j = got.join(ref, "id")
    assert j.where(~F.col("nx").eqNullSafe(F.col("nx2"))).count() == 0
    assert got.count() == df.count()


def test_lead_matches_window_on_orders(spark):
    o = spark.read.parquet("/root/testdata/sf0.01/orders.parquet").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("k"), F.col("o_orderdate").alias("t"))
    _check(o)


def test_lead_with_one_hot_key(spark):
    # a third of the rows on one key, spread over many days, several rows per day
    rows = spark.range(30000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("k"),
        F.timestamp_seconds(F.lit(800000000) + (F.col("id") * 7919) % 5000000).alias("t"),
    )
    _check(rows)


def test_first_by_key_is_deterministic(spark):
    df = spark.range(2000).select((F.col("id") % 50).alias("k"), (F.col("id") % 7).alias("r"), F.col("id").alias("v"))
    a = first_by_key(df, "k", ["r"]).collect()
    b = first_by_key(df.repartition(13), "k", ["r"]).collect()
    assert sorted(a) == sorted(b) and len(a) == 50
    assert all(row["r"] == 0 for row in a)


def test_lead_of_another_column(spark):
    # generic path: the led value is not the leading order column
    rows = spark.range(20000).select(
        F.col("id"),
        F.when(F.col("id") % 4 == 0, F.lit(3)).otherwise(F.col("id") % 300).alias("k"),
        F.timestamp_seconds(F.lit(800000000) + (F.col("id") * 104729) % 9000000).alias("t"),
    )
    got = lead_by_key(rows, "k", ["t", "id"], "id", "nx", bucket=F.to_date("t"))
    ref = rows.withColumn("nx2", F.lead("id").over(Window.partitionBy("k").orderBy("t", "id")))
    assert got.join(ref, "id").where(~F.col("nx").eqNullSafe(F.col("nx2"))).count() == 0


def test_dedupe_with_hot_id(spark):
    from ledgerline.sources import raw

    # one id on a third of the lines, listed in two scopes: exactly one row per id survives
    lines = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit("default")).otherwise(F.lit("clock_1")).alias("scope"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.lit(1)).alias("scope_rank"),
        F.to_json(F.struct(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("x"), F.col("id").cast("string"))).alias("id"),
            F.col("id").cast("string").alias("created"),
        )).alias("value"),
    )
    parsed = raw.parse(lines, "id string, created string")
    out = raw.dedupe_first_listed(parsed)
    assert out.count() == 1 + 6000
    hot = out.where(F.col("id") == "hot").collect()[0]
    assert hot["scope"] == "default" and hot["created"] == "0"
