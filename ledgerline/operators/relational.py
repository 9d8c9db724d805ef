"""Filters, small aggregates, ordering and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import columns as C
from ledgerline.sources.base import table

# Markers that must never appear in logged text.
SENSITIVE_MARKERS = ["sk_test_", "sk_live_", "GOOGLE_APPLICATION_CREDENTIALS", "service_account", "client_secret"]
# Seed object name patterns (cleanup selection).
SEED_EMAIL_MARKERS = ["mrr-seed-", "smoke-test-"]
SEED_CLOCK_PREFIXES = ["mrr-seed-clock-", "mrr-smoke-clock-"]
SEED_CLOCK_EXACT = "mrr-seed-smoke-clock"
# Price tiers in their fixed order, monthly amounts in cents, and the tier metadata key.
TIER_ORDER = ["basic", "pro", "enterprise"]
TIER_AMOUNTS_CENTS = {"basic": 5000, "pro": 10000, "enterprise": 25000}
TIER_METADATA_KEY = "mrr-seed-tier"
SEED_PRODUCT = "prod_0"

# --- filters ---------------------------------------------------------------------------------


def canceled_in_range(subs: DataFrame, lo, hi) -> DataFrame:
    """status 'canceled' and UTC cancel date in [lo, hi)."""
    cd = C.nullable_ts_to_date("canceled_at")
    return subs.where(
        (F.col("status") == "canceled") & F.col("canceled_at").isNotNull()
        & (cd >= F.lit(lo).cast("date")) & (cd < F.lit(hi).cast("date"))
    )


def exclude_ids(df: DataFrame, key: str, ids: DataFrame | list[str]) -> DataFrame:
    """drop rows whose key is in ``ids`` (a literal list, or a DataFrame -> anti join)."""
    if isinstance(ids, list):
        return df.where(~F.col(key).isin(*ids))
    return df.join(ids.select(F.col(ids.columns[0]).alias(key)).distinct(), key, "left_anti")


def seed_customers(df: DataFrame, email: str = "email") -> DataFrame:
    """customers whose e-mail contains a seed marker."""
    e = F.col(email)
    return df.where(reduce(lambda a, b: a | b, [e.contains(m) for m in SEED_EMAIL_MARKERS]))


def seed_clocks(df: DataFrame, name: str = "name") -> DataFrame:
    """clocks named by the seeder (prefixes or the one exact smoke name)."""
    n = F.col(name)
    return df.where(reduce(lambda a, b: a | b, [n.startswith(p) for p in SEED_CLOCK_PREFIXES]) | (n == SEED_CLOCK_EXACT))


def metadata_predicate(df: DataFrame, json_col: str, key: str, value: str, extra: Column | None = None) -> DataFrame:
    """``metadata[key] = value`` (JSON text column) AND an optional second predicate."""
    cond = C.json_get(json_col, key) == F.lit(value)
    return df.where(cond & extra if extra is not None else cond)


def sensitive_token_scan(df: DataFrame, text: str) -> DataFrame:
    """rows whose text contains any sensitive marker, with the list of markers found.

    One ``contains`` per marker (literal substring search, JVM side); rows are streamed,
    whole texts are searched.
    """
    t = F.col(text)
    found = F.filter(
        F.array(*[F.when(t.contains(m), F.lit(m)) for m in SENSITIVE_MARKERS]), lambda x: x.isNotNull()
    )
    return df.withColumn("markers", found).where(F.size("markers") > 0)


# --- price catalog (derived from `part`) -----------------------------------------------------


def price_catalog(spark, sf_dir: str) -> DataFrame:
    """A price object per part: product, type, currency, active flag, tier metadata."""
    k = F.col("p_partkey")
    tier = F.element_at(F.array(*[F.lit(t) for t in TIER_ORDER]), (k % 3 + 1).cast("int"))
    meta = F.when(k % 11 != 0, F.to_json(F.create_map(F.lit(TIER_METADATA_KEY), tier))).otherwise(F.lit("{}"))
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("price_"), k.cast("string")).alias("price_id"),
        F.concat(F.lit("prod_"), (k % 7).cast("string")).alias("product"),
        F.when(k % 4 == 0, "one_time").otherwise("recurring").alias("type"),
        F.when(k % 5 == 0, "eur").otherwise("usd").alias("currency"),
        (k % 6 != 0).alias("active"),
        F.round(F.col("p_retailprice") * 100).cast("bigint").alias("unit_amount"),
        meta.alias("metadata"),
        k.alias("listing_order"),
    )


def tier_prices(prices: DataFrame, product: str = SEED_PRODUCT) -> DataFrame:
    """per tier, the first active recurring USD price of ``product`` tagged with that tier.

    A partial aggregate (``min_by`` on listing order) per tier: no sort of all prices.
    """
    tier = C.json_get("metadata", TIER_METADATA_KEY)
    cands = prices.where(
        (F.col("product") == product) & (F.col("type") == "recurring") & (F.col("currency") == "usd") & F.col("active")
    ).withColumn("tier", tier).where(F.col("tier").isin(*TIER_ORDER))
    return cands.groupBy("tier").agg(
        F.min_by("price_id", "listing_order").alias("price_id"),
        F.min_by("unit_amount", "listing_order").alias("unit_amount"),
        F.count(F.lit(1)).alias("candidates"),
    )


def price_resolution_count(prices: DataFrame) -> DataFrame:
    """Tiers resolved and distinct prices among them (both must be 3)."""
    t = tier_prices(prices)
    return t.agg(F.count("tier").alias("tiers_resolved"), F.countDistinct("price_id").alias("distinct_prices"))


def tier_dimension(spark) -> DataFrame:
    """Three-row tier -> amount dimension (fixed size: safe to broadcast)."""
    return spark.createDataFrame([(t, TIER_AMOUNTS_CENTS[t]) for t in TIER_ORDER], "tier string, amount_cents bigint")


# --- aggregates ------------------------------------------------------------------------------


def status_count_and_sum(subs: DataFrame) -> DataFrame:
    """G6 for every status at once: COUNT(*) and SUM(cents) (0 when all NULL)."""
    return subs.groupBy("status").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.coalesce(F.sum(F.col("unit_amount_cents").cast("bigint")), F.lit(0).cast("bigint")).alias("total_cents"),
    )


def distinct_customers(subs: DataFrame) -> DataFrame:
    """Exact COUNT(DISTINCT customer) (partial aggregation on the key, then count)."""
    return subs.agg(F.countDistinct("stripe_customer_id").alias("customers"))


def multi_sub_customers(subs: DataFrame, minimum: int = 2) -> DataFrame:
    """Number of customers with at least ``minimum`` subscriptions."""
    per = subs.groupBy("stripe_customer_id").agg(F.count(F.lit(1)).alias("n"))
    return per.where(F.col("n") >= minimum).agg(F.count(F.lit(1)).alias("customers"))


def customer_sub_count(subs: DataFrame) -> DataFrame:
    """G9 for every customer: COUNT(*) of its subscriptions."""
    return subs.groupBy("stripe_customer_id").agg(F.count(F.lit(1)).alias("subscriptions"))


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One (table, rows) row per table (a union of global counts)."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


# --- ordering --------------------------------------------------------------------------------


def first_by(df: DataFrame, order: str) -> DataFrame:
    """O2: ``ORDER BY order LIMIT 1`` (TakeOrderedAndProject: a top-1 per task, then one row)."""
    return df.orderBy(order).limit(1)


def row_limit(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first ``n`` rows by key (the sync's per-entity ``--limit``)."""
    return df.orderBy(key).limit(n)


def monotone_months(series: DataFrame, month: str = "month") -> DataFrame:
    """Points, first and last month, and whether the months are one contiguous ascending run."""
    return series.agg(
        F.count(F.lit(1)).alias("points"),
        F.min(month).alias("first_month"),
        F.max(month).alias("last_month"),
        (F.months_between(F.max(month), F.min(month)).cast("bigint") + 1 == F.count(F.lit(1))).alias("contiguous"),
    )


# --- set operations --------------------------------------------------------------------------


def other_tiers(df: DataFrame, tier: str = "initial_tier") -> DataFrame:
    """Every tier except the row's own, in the fixed tier order."""
    tiers = F.array(*[F.lit(t) for t in TIER_ORDER])
    return df.withColumn("other_tiers", F.array_except(tiers, F.array(F.col(tier))))


def with_ordinal(df: DataFrame, order: str, name: str = "ordinal") -> DataFrame:
    """Ordinal over a small, bounded frame (e.g. a monthly series)."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(order)))
