"""Raw billing objects: JSON lines in, typed nested rows out (A1-A4).

The reference pulls nested objects page by page from a billing API. Here the same
objects arrive as JSON lines (one object per line, one folder per listing scope) and
are parsed by Spark against an explicit schema, in parallel, with no inference. Epoch
fields are read as text so numbers, ISO text and junk all load; junk becomes NULL
later (P13) instead of failing the whole batch. A line that is not JSON at all parses
to an all-NULL row and is rejected by the flatten step.

For the supplied data, ``*_listing`` builds those lines from the derived flat tables
(sources/fixtures.py) with ``to_json`` and a few deterministic corruption rules, so the
listings grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.schemas import VERSION_ORDER
from ledgerline.sources import fixtures

# ------------------------------------------------------------------------------------------
# Read schemas (epochs as text)
# ------------------------------------------------------------------------------------------

RAW_CUSTOMER = (
    "id string, email string, name string, created string, livemode boolean, "
    "default_source struct<currency: string>, metadata map<string,string>"
)

RAW_SUBSCRIPTION = (
    "id string, customer string, status string, created string, livemode boolean, "
    "start_date string, canceled_at string, ended_at string, billing_cycle_anchor string, "
    "current_period_start string, current_period_end string, metadata map<string,string>, "
    "items struct<data: array<struct<quantity: int, price: struct<id: string, unit_amount: bigint, "
    "currency: string, recurring: struct<interval: string, interval_count: bigint>>>>>"
)

RAW_INVOICE = (
    "id string, customer string, subscription string, period_start string, period_end string, "
    "status string, total bigint, amount_paid bigint, amount_due bigint, currency string, "
    "status_transitions struct<paid_at: string>, created string, livemode boolean, metadata map<string,string>"
)

LISTING_SCHEMA = "scope string, scope_rank int, value string"

# Corruption rules on the derived objects, by (numeric id) % 101.
RULE_MOD = 101
RULE_ISO_CREATED = 3  # created given as ISO-8601 text (still valid)
RULE_JUNK_CREATED = 5  # created is junk text -> row rejected
RULE_NO_ITEMS = 7  # subscription with an empty item list -> skipped at load
RULE_UNKNOWN_STATUS = 11  # status outside the admitted set -> skipped by the transform
RULE_LIVEMODE = 13  # live-mode object -> skipped at load
RULE_NOT_JSON = 17  # the line is cut short -> not JSON -> rejected
RULE_NO_METADATA = 19  # metadata absent
RULE_NO_RECURRING = 23  # price without recurring block -> interval NULL
# Objects whose numeric id is divisible by this are listed a second time in their clock scope.
RULE_SECOND_SCOPE = 4


def numeric_id(id_col: Column) -> Column:
    return F.regexp_extract(id_col, r"(\d+)", 1).cast("bigint")


def _epoch(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _created(ts: Column, r: Column) -> Column:
    return (
        F.when(r == RULE_ISO_CREATED, _iso(ts))
        .when(r == RULE_JUNK_CREATED, F.lit("not-a-time"))
        .otherwise(_epoch(ts).cast("string"))
    )


def _as_line(obj: Column, r: Column) -> Column:
    text = F.to_json(obj)
    return F.when(r == RULE_NOT_JSON, F.substring(text, 1, 20)).otherwise(text)


def customer_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw customer lines: default scope for all, clock scope again for every 4th (name upper-cased)."""
    c = fixtures.customers(spark, sf_dir)
    r = numeric_id(F.col("stripe_customer_id")) % RULE_MOD

    def obj(name: Column) -> Column:
        return F.struct(
            F.col("stripe_customer_id").alias("id"),
            F.col("email").alias("email"),
            name.alias("name"),
            _created(F.col("created_at"), r).alias("created"),
            ((r == RULE_LIVEMODE) | F.col("livemode")).alias("livemode"),
            F.when(numeric_id(F.col("stripe_customer_id")) % 2 == 0, F.struct(F.col("default_currency").alias("currency"))).alias(
                "default_source"
            ),
            F.when(r != RULE_NO_METADATA, F.create_map(F.lit("test_clock_id"), F.col("test_clock_id"))).alias("metadata"),
        )

    # one pass: each customer yields its default line and, for every 4th, a clock-scope line
    scopes = F.array(F.struct(F.lit("default").alias("scope"), F.lit(0).alias("scope_rank"), F.col("name").alias("nm")))
    second = F.array(F.struct(F.col("test_clock_id").alias("scope"), F.lit(1).alias("scope_rank"), F.upper("name").alias("nm")))
    listed = F.when(numeric_id(F.col("stripe_customer_id")) % RULE_SECOND_SCOPE == 0, F.concat(scopes, second)).otherwise(scopes)
    return c.select("*", F.explode(listed).alias("_s")).select(
        F.col("_s.scope").alias("scope"), F.col("_s.scope_rank").alias("scope_rank"), _as_line(obj(F.col("_s.nm")), r).alias("value")
    )


def subscription_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw subscription lines (price expanded inline); every 4th listed again in a clock scope."""
    s = fixtures.subscriptions(spark, sf_dir)
    n = numeric_id(F.col("stripe_subscription_id"))
    r = n % RULE_MOD
    recurring = F.when(
        r != RULE_NO_RECURRING,
        F.struct(F.col("interval").alias("interval"), F.col("interval_count").alias("interval_count")),
    )
    price = F.struct(
        F.col("current_price_id").alias("id"),
        F.col("unit_amount_cents").alias("unit_amount"),
        F.col("currency").alias("currency"),
        recurring.alias("recurring"),
    )
    item = F.struct(F.lit(1).alias("quantity"), price.alias("price"))
    items = F.struct(F.when(r == RULE_NO_ITEMS, F.array().cast("array<" + item_type() + ">")).otherwise(F.array(item)).alias("data"))

    def ts(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), _epoch(F.col(c)).cast("string"))

    obj = F.struct(
        F.col("stripe_subscription_id").alias("id"),
        F.col("stripe_customer_id").alias("customer"),
        F.when(r == RULE_UNKNOWN_STATUS, F.lit("unknown_status")).otherwise(F.col("status")).alias("status"),
        _created(F.col("created_at"), r).alias("created"),
        (r == RULE_LIVEMODE).alias("livemode"),
        ts("start_date").alias("start_date"),
        ts("canceled_at").alias("canceled_at"),
        ts("ended_at").alias("ended_at"),
        ts("billing_cycle_anchor").alias("billing_cycle_anchor"),
        ts("current_period_start").alias("current_period_start"),
        ts("current_period_end").alias("current_period_end"),
        F.when(r != RULE_NO_METADATA, F.create_map(F.lit("idempotency_key"), F.col("idempotency_key"))).alias("metadata"),
        items.alias("items"),
    )
    clock = F.concat(F.lit("clock_"), F.floor(numeric_id(F.col("stripe_customer_id")) / 3).cast("bigint").cast("string"))
    scopes = F.array(F.struct(F.lit("default").alias("scope"), F.lit(0).alias("scope_rank")))
    second = F.array(F.struct(clock.alias("scope"), F.lit(1).alias("scope_rank")))
    listed = F.when(n % RULE_SECOND_SCOPE == 0, F.concat(scopes, second)).otherwise(scopes)
    return s.select(_as_line(obj, r).alias("value"), F.explode(listed).alias("_s")).select(
        F.col("_s.scope").alias("scope"), F.col("_s.scope_rank").alias("scope_rank"), "value"
    )


def item_type() -> str:
    return (
        "struct<quantity:int,price:struct<id:string,unit_amount:bigint,currency:string,"
        "recurring:struct<interval:string,interval_count:bigint>>>"
    )


def invoice_listing(spark: SparkSession, sf_dir: str, by_customer: bool = False) -> DataFrame:
    """Raw invoice lines; ids repeat (see fixtures), so dedupe has real work. With ``by_customer``
    every third order's invoices are listed for their customer only, the others by default."""
    inv = fixtures.invoices(spark, sf_dir)
    r = numeric_id(F.col("stripe_invoice_id")) % RULE_MOD

    def ts(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), _epoch(F.col(c)).cast("string"))

    obj = F.struct(
        F.col("stripe_invoice_id").alias("id"),
        F.col("stripe_customer_id").alias("customer"),
        F.col("stripe_subscription_id").alias("subscription"),
        ts("period_start").alias("period_start"),
        ts("period_end").alias("period_end"),
        F.col("status").alias("status"),
        F.col("total_cents").alias("total"),
        F.col("amount_paid_cents").alias("amount_paid"),
        F.col("amount_due_cents").alias("amount_due"),
        F.col("currency").alias("currency"),
        F.struct(ts("paid_at").alias("paid_at")).alias("status_transitions"),
        _created(F.col("created_at"), r).alias("created"),
        F.lit(False).alias("livemode"),
        F.create_map().cast("map<string,string>").alias("metadata"),
    )
    scoped = (numeric_id(F.col("stripe_invoice_id")) % 3 == 0) & F.lit(by_customer)
    return inv.select(
        F.when(scoped, F.col("stripe_customer_id")).otherwise("default").alias("scope"), scoped.cast("int").alias("scope_rank"),
        _as_line(obj, r).alias("value"),
    )


# ------------------------------------------------------------------------------------------
# Reading and parsing
# ------------------------------------------------------------------------------------------


#: Folder of a listing root whose lines name their own scope (scope, tab, object): there can be
#: thousands of scopes with a few objects each.
MIXED = "mixed"


#: Lines of an exported file at most: compressed text is not split, and one task reads a file.
LINES_A_FILE = 50_000


def write_listing(listing: DataFrame, root: str) -> None:
    """Export a listing (scope, value) as text files, in one pass: every line names its scope.
    The fastest level of compression: at the default one it takes longer than making the lines."""
    line = F.concat("scope", F.lit("\t"), F.coalesce("value", F.lit("")))
    files = listing.where(F.col("scope").isNotNull()).select(line.alias("value")).write.option("maxRecordsPerFile", LINES_A_FILE)
    files.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(f"{root.rstrip('/')}/{MIXED}")


def read_listing(spark: SparkSession, root: str, modified_after: str | None = None) -> DataFrame:
    """Lines of the files under ``root/<scope>/`` (scope 'default' ranks first), and of
    ``root/mixed/``. ``modified_after`` (a timestamp's text) leaves out files that are older."""
    reader = spark.read.option("modifiedAfter", modified_after) if modified_after else spark.read
    folder = F.substring_index(F.substring_index("_metadata.file_path", "/", -2), "/", 1)
    lines = reader.text(f"{root.rstrip('/')}/*/").select(folder.alias("folder"), "value")
    mixed = F.col("folder") == MIXED
    scope = F.when(mixed, F.substring_index("value", "\t", 1)).otherwise(F.col("folder"))
    line = F.when(mixed, F.expr("substring(value, instr(value, '\t') + 1)")).otherwise(F.col("value"))
    return lines.select(scope.alias("scope"), F.when(scope == "default", 0).otherwise(1).alias("scope_rank"), line.alias("value"))


def parse(listing: DataFrame, schema: str) -> DataFrame:
    """One typed row per line (``schema`` is a DDL string); non-JSON lines give an all-NULL object
    with the line itself in ``corrupt_line``.

    The parsed struct is emitted through a generator (``inline``): predicates on parsed
    fields then stay above it instead of being pushed below with ``from_json`` inlined
    into each of them, so every line is parsed exactly once.
    """
    parsed = F.from_json("value", f"{schema}, corrupt_line string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt_line"})
    carried = [c for c in ("scope", "scope_rank", "arrival") if c in listing.columns]
    return listing.select(*carried, F.xxhash64("value").alias("line_digest"), F.inline(F.array(parsed)))


def skip_livemode(df: DataFrame) -> DataFrame:
    """live-mode objects are never loaded (NULL livemode is kept, as a falsy flag would be)."""
    return df.where(~F.coalesce(F.col("livemode"), F.lit(False)))


def skip_no_items(df: DataFrame) -> DataFrame:
    """subscriptions must carry at least one item."""
    has_items = F.coalesce(F.size(F.col("items.data")), F.lit(0)) >= 1
    return df.where(F.col("id").isNull() | has_items)


def version_order(df: DataFrame, tie_break: list[Column] | None = None) -> Column:
    """What orders the lines of one object (see ``schemas.VERSION_ORDER``)."""
    arrival = -F.col("arrival") if "arrival" in df.columns else F.lit(None)
    ties = [*(tie_break or []), *[F.lit(None)] * 3][:3]
    values = [arrival, F.col("scope_rank"), F.col("scope"), *ties, F.col("line_digest")]
    return F.struct(*[v.cast(t).alias(n) for v, (n, t) in zip(values, VERSION_ORDER.items(), strict=True)])


def dedupe_first_listed(df: DataFrame, key: str = "id", tie_break: list[Column] | None = None) -> DataFrame:
    """Union of listings, one row per id, the first-listed scope wins.

    Where lines carry an ``arrival`` number, the latest arrival wins before the scope does,
    and the order stays with the row (``_order``) so that a merge can hold it against the
    table's. Without, what is left equal is ordered by the row's own columns, and no column
    for the order travels with the row.

    The first row of an id is found by ``row_number() = 1``, of which Spark keeps one row an
    id in every map task before the shuffle: a row travels once, and a hot id is reduced where
    it is read. Rows without an id (non-JSON lines) all pass through, for the flatten step to
    count as rejects: a number keeps equal ones apart (of rows that are read from files, the
    same one whenever a task is run again).
    """
    arrivals = "arrival" in df.columns
    apart = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    if arrivals:
        ordered, order = df.withColumn("_order", version_order(df, tie_break)), ["_order"]
    else:
        ordered = df
        order = ["scope_rank", "scope", *(tie_break or []), *[c for c in _orderable(df) if c not in ("scope", "scope_rank", "line_digest")]]
    window = Window.partitionBy(key, "_apart").orderBy(*order)
    numbered = ordered.withColumn("_apart", apart).withColumn("_rn", F.row_number().over(window))
    return numbered.where(F.col("_rn") == 1).drop("_rn", "_apart", "line_digest", "arrival")


def _orderable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]


def load_customers(listing: DataFrame) -> DataFrame:
    """A1: fetch semantics for customers: live mode skipped, de-duplicated across scopes."""
    return dedupe_first_listed(skip_livemode(parse(listing, RAW_CUSTOMER)))


def load_subscriptions(listing: DataFrame) -> DataFrame:
    """A2: all statuses, price inline, at least one item, live mode skipped, de-duplicated."""
    return dedupe_first_listed(skip_no_items(skip_livemode(parse(listing, RAW_SUBSCRIPTION))))


def of_known_customers(listing: DataFrame, customers: DataFrame, key: str = "id") -> DataFrame:
    """The default listing whoever its customers are, and the listings by customer (their
    scope is the customer's id) of those in ``customers``. Lines are chosen before they are parsed."""
    default = F.col("scope") == "default"
    known = customers.select(F.col(key).alias("scope"))
    return listing.where(default).unionByName(listing.where(~default).join(known, "scope", "left_semi").select(*listing.columns))


def load_invoices(listing: DataFrame) -> DataFrame:
    """A3: invoices, live mode skipped, de-duplicated by id."""
    # ids repeat inside one scope: ties break on the earlier period, then the total, then status
    tie = [F.col("period_start").try_cast("bigint"), F.col("total"), F.col("status")]
    return dedupe_first_listed(skip_livemode(parse(listing, RAW_INVOICE)), tie_break=tie)
